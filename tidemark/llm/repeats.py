"""Suffix-array dedup of repeated byte strings, by longest previous factors.

The longest previous factor of a position is the longest string that starts there and also starts
earlier. In suffix order it is the longer of the common prefixes with the nearest suffixes on either
side that start earlier (previous and next smaller positions). A position is a later copy if its
longest previous factor has ``length`` bytes; with the nearest greater positions, the longest next
factor, it is a repeat. Factors are followed up to ``length``: what is longer changes nothing.

One suffix array over all texts would be many times the input, so Spark first finds what can repeat
at all. Every window of ``length`` bytes is assigned its anchor, the least-hashed GRAM-byte string in
it (equal windows have equal anchors); neighbouring windows with one anchor form a run, and only runs
whose anchor occurs again go on. Equal runs are counted and kept once: all but the first have the
first as their previous factor. Distinct runs of one anchor meet in one task, where suffix order by
prefix doubling compares their bytes exactly. Where more than CROWD distinct runs have one anchor, they
are cut by where in the window the anchor stands, into halves, and meet by the bytes that all windows of
a half have in common, which grow with every cut; so groups get smaller until they fit. After at most
eight cuts a group's windows are common bytes from end to end, and Spark groups them by those.

Positions are ordered by doc_id, text and place, everywhere; rows without an id come last. A removed
byte thus always has a copy at a smaller position, and the smallest stays. Identical rows have one
position; of them the row that is read first keeps its text.

Cases: a null or empty text has no bytes and loses none; texts shorter than ``length`` lose nothing;
repeated rows are copies of each other like any other texts; windows never cross documents; an empty
table gives no rows; extra columns are ignored, whatever their names. A text of any length is worked
on whole, in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import CODES, U, buffers, mix, powers, slices
from tidemark.llm.shared import documents, drop_saved, save, spread

#: Bytes of a repeat, and of an anchor string; distinct runs of an anchor that are compared together
#: (about 1 MB of run bytes).
LENGTH, GRAM, CROWD = 200, 48, 4_000
SLICE_BYTES = 1 << 20
#: Bytes of a block of a long text whose windows are looked at together; blocks overlap by a window.
BLOCK = 2 << 20
#: Bytes of runs that one suffix sort takes.
SORT_BYTES = 1 << 20


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor: row, start in the row, windows, anchor hash, run hash.

    A long text is read in blocks; a run over a block's edge is two, which changes no window.
    """
    if len(offsets) > 2 or offsets[-1] - offsets[0] <= BLOCK + length:
        return _block_runs(data, offsets, length, gram)
    found = []
    for low in range(int(offsets[0]), int(offsets[1]) - length + 1, BLOCK):
        part = _block_runs(data, np.array([low, min(low + BLOCK + length - 1, int(offsets[1]))]), length, gram)
        if part:
            found.append((part[0], part[1] + (low - int(offsets[0])), *part[2:]))
    return tuple(map(np.concatenate, zip(*found))) if found else None


def _block_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    base, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    if n < length:
        return None
    rows = offsets - base
    up, down = powers(n + 1)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(CODES[data[base : base + n]] * up[:n], out=total[1:])
    grams = mix((total[gram:] - total[:-gram]) * down[: n + 1 - gram])
    low = U(n.bit_length())
    least = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    width, reach = 1, length - gram + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if reach > width:
        least = np.minimum(least[: width - reach], least[reach - width :])
    anchor = (least & ((U(1) << low) - U(1))).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, np.int8)
    sizes = np.diff(rows)
    whole = sizes >= length
    np.add.at(valid, rows[:-1][whole], 1)
    np.add.at(valid, rows[1:][whole] - length + 1, -1)
    inside = np.cumsum(valid[:-1]) > 0
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    fresh[rows[:-1][whole]] = True
    start = np.flatnonzero(fresh)
    if not len(start):
        return None
    last = inside.copy()
    last[:-1] &= ~inside[1:] | fresh[1:]
    count = np.flatnonzero(last) + 1 - start
    row = np.searchsorted(rows, start, "right") - 1
    end = start + count + length - 1
    run = mix((total[end] - total[start]) * down[start] + count.astype(np.uint64))
    return row, start - rows[row], count, grams[anchor[start]].view(np.int64), run.view(np.int64)


def suffix_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes at each start, in suffix order, by prefix doubling."""
    padded = np.zeros(len(data) + length + 8, np.uint8)
    padded[: len(data)] = data
    rank = np.zeros(len(data) + length, np.uint64)
    for j in range(8):
        rank = (rank << U(8)) | padded[j : j + len(rank)]
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    width = min(8, length)
    while width < length:
        step = min(width, length - width)
        pair = rank[: len(rank) - step] << U(32) | rank[step:]
        if width + step == length:
            pair = pair[starts]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.uint64)
        width += step
    return rank if length > 8 else rank[starts]


def nearest_smaller(x: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, or -1; all places step back together."""
    found = np.arange(-1, len(x) - 1)
    open_ = np.flatnonzero(found >= 0)
    while len(open_):
        open_ = open_[x[found[open_]] >= x[open_]]
        found[open_] = found[found[open_]]
        open_ = open_[found[open_] >= 0]
    return found


def factors(rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix has a full-length previous factor, and a full-length next one.

    ``rank`` orders suffixes by their first bytes, up to the full length; ``place`` is their position.
    The previous and next smaller (greater) places in suffix order are the nearest earlier (later)
    matches on either side; the factor has full length where one of them has the same rank. Only
    suffixes that share their rank are looked at.
    """
    order = np.argsort(rank, kind="stable")
    equal = rank[order][1:] == rank[order][:-1]
    shared = np.append(equal, False) | np.append(False, equal)
    order = order[shared]
    r, p = rank[order], place[order]
    n = len(order)
    out = []
    for values in (p, -p):
        before = nearest_smaller(values)
        behind = n - 1 - nearest_smaller(values[::-1])[::-1]
        whole = np.zeros(len(rank), bool)
        whole[order] = ((before >= 0) & (r[before] == r)) | ((behind < n) & (r[np.minimum(behind, n - 1)] == r)) if n else False
        out.append(whole)
    return out[0], out[1]


def flat_intervals(flags: np.ndarray) -> list[int]:
    """start, end, start, end ... of the true stretches."""
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))).tolist()


RUN = "key string, doc_id long, p int, m int, h long, g long"
INFO = "h long, g long, repeated array<int>, earlier array<int>"


def find_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, repeated, later): per text with repeats, its byte spans as flat start, end lists.

    ``docs`` has key, doc_id and text. ``repeated`` holds spans covered by strings that start anywhere
    else, ``later`` those covered by strings that start earlier (by doc_id, key and place).
    """
    parts = spread(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for lo, hi in slices(offsets, SLICE_BYTES):
                found = window_runs(data, offsets[lo : hi + 1], length, gram)
                if found:
                    row, start, count, h, g = found
                    at = pa.array(row + lo)
                    yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("doc_id").take(at), pa.array(start, pa.int32()), pa.array(count, pa.int32()), pa.array(h), pa.array(g)], ["key", "doc_id", "p", "m", "h", "g"])

    runs = save(docs.select("key", "doc_id", "text").mapInArrow(cut, RUN), "runs")
    anchors = save(runs.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "anchors")
    again = save(runs.join(anchors, "h").select(*runs.columns), "runs-again")
    drop_saved(runs)
    drop_saved(anchors)
    kinds = again.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "key", "p")).alias("first"), F.first("m").alias("m"))
    kinds = save(kinds, "run-kinds")
    several = kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = kinds.join(several, "h").groupBy("first.key").agg(F.collect_list(F.struct("first.doc_id", "first.p", "m", "h", "g", "kinds")).alias("runs"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            lists = batch.column("runs")
            sizes = np.diff(np.asarray(lists.offsets))
            row = np.repeat(np.arange(batch.num_rows), sizes)
            flat = lists.flatten()
            p, m = flat.field("p").to_numpy(), flat.field("m").to_numpy()
            for low in range(0, len(row), 20_000):
                part = slice(low, low + 20_000)
                begin = offsets[row[part]] + p[part]
                raw = [data[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + m[part] + length - 1).tolist())]
                names = ("doc_id", "p", "m", "h", "g", "kinds")
                key = batch.column("key").take(pa.array(row[part]))
                yield pa.RecordBatch.from_arrays([key, *(flat.field(c).slice(low, len(raw)) for c in names), pa.array(raw, pa.binary())], ["key", *names, "raw"])

    context = docs.select("key", "text").join(wanted, "key").mapInArrow(read, "key string, doc_id long, p int, m int, h long, g long, kinds long, raw binary")
    context = save(context.dropDuplicates(["h", "g"]), "run-bytes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, SORT_BYTES, "met"):
            data, offsets = buffers(table.column("raw"))
            base = int(offsets[0])
            m = table.column("m").to_numpy().astype(np.int64)
            run = np.repeat(np.arange(len(m)), m)
            inner = np.arange(len(run)) - np.repeat(np.cumsum(m) - m, m)
            rank = suffix_ranks(data[base : int(offsets[-1])], offsets[run] - base + inner, length)
            p, skip = (table.column(c).to_numpy() for c in ("p", "skip"))
            first = np.lexsort((p + skip, np.array(table.column("key").to_pylist(), str), table.column("doc_id").to_numpy()))
            order = np.empty(len(m), np.int64)
            order[first] = np.arange(len(m))
            # a text's runs do not overlap, so the order of runs, then of windows in them, is the order of places
            earlier, later = factors(rank, order[run] << 32 | inner)
            edges = np.append(0, np.cumsum(m))
            spans = [tuple([x + k for x in flat_intervals(flags[a:b])] for flags in (earlier | later, earlier)) for a, b, k in zip(edges, edges[1:], skip.tolist())]
            keep = [i for i, (x, _) in enumerate(spans) if x]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([table.column("h").combine_chunks().take(at), table.column("g").combine_chunks().take(at), *(pa.array([spans[i][k] for i in keep], pa.list_(pa.int32())) for k in (0, 1))], ["h", "g", "repeated", "earlier"])

    together = context.withColumns({"met": F.col("h"), "skip": F.lit(0), "low": F.lit(0), "high": F.lit(length - gram)})
    fitting, crowded = [together.where(F.col("kinds") <= CROWD)], together.where(F.col("kinds") > CROWD).drop("kinds")
    info = None
    while crowded.limit(1).count():
        halves = save(crowded.mapInArrow(_halver(length, gram), CUT), "run-halves")
        size = halves.groupBy("met").agg(F.count("*").alias("kinds")).where("kinds > 1")
        halves = save(halves.hint("merge").join(size, "met"), "run-groups")
        fitting.append(halves.where(F.col("kinds") <= CROWD))
        whole = (F.col("kinds") > CROWD) & (F.col("low") == F.col("high"))
        same = _equal_windows(halves.where(whole))
        info = same if info is None else info.unionByName(same)
        crowded = halves.where((F.col("kinds") > CROWD) & ~whole).drop("kinds")
    for rows in fitting:
        found = rows.drop("kinds").repartition(parts, "met").sortWithinPartitions("met").mapInArrow(compare, INFO)
        info = found if info is None else info.unionByName(found)
    facts = kinds.select("h", "g", "n", F.col("first.doc_id").alias("doc"), F.col("first.p").alias("at"), F.col("first.key").alias("of")).join(info.hint("merge"), ["h", "g"], "left")
    # written, so that the runs meet it in a join of its own: a common passage's runs can then be split
    facts = save(facts.where("n > 1 or repeated is not null"), "run-facts")
    spans = again.hint("merge").join(facts, ["h", "g"])
    whole, none = F.array(F.lit(0), F.col("m")), F.array().cast("array<int>")
    is_first = (F.col("key") == F.col("of")) & (F.col("p") == F.col("at"))
    repeated = F.when(F.col("n") > 1, whole).otherwise(F.coalesce("repeated", none))
    later = F.when(is_first, F.coalesce("earlier", none)).otherwise(whole)
    spans = spans.select("key", "p", repeated.alias("repeated"), later.alias("later")).where(F.size("repeated") > 0)
    place = lambda c: F.transform(c, lambda x, i: x + F.col("p") + F.when(i % 2 == 1, length - 1).otherwise(0))
    spans = spans.select("key", place("repeated").alias("repeated"), place("later").alias("later"))
    return spans.groupBy("key").agg(F.flatten(F.collect_list("repeated")).alias("repeated"), F.flatten(F.collect_list("later")).alias("later"))


def _whole_groups(batches: Iterator[pa.RecordBatch], most: int, by: str) -> Iterator[pa.Table]:
    """Tables of whole groups, of about ``most`` bytes, out of a stream sorted by group."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        low = 0
        while low < batch.num_rows:
            if kept and size >= most:  # what still belongs to the last group, then a table
                other = batch.column(by).to_numpy()[low:] != kept[-1].column(by)[-1].as_py()
                same = int(other.argmax()) if other.any() else len(other)
                if same:
                    kept.append(batch.slice(low, same))
                low += same
                if other.any():
                    yield pa.Table.from_batches(kept)
                    kept, size = [], 0
                continue
            bytes_ = np.cumsum(np.diff(buffers(batch.column("raw"))[1])[low:])
            take = int(np.searchsorted(bytes_, most - size)) + 1
            part = batch.slice(low, take)
            kept.append(part)
            size += int(bytes_[min(take, len(bytes_)) - 1])
            low += part.num_rows
    if kept:
        yield pa.Table.from_batches(kept)


CUT = "key string, doc_id long, p int, m int, h long, g long, raw binary, met long, skip int, low int, high int"


def _halver(length: int, gram: int):
    """Cuts runs by the place of their anchor in the window, ``low`` to ``high``, into two halves.

    ``met`` becomes a hash of the bytes that all windows of the half have: those from the first byte of
    the window in which the anchor stands foremost to the last byte of the one in which it stands last.
    """

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                data, offsets = buffers(part.column("raw"))
                base, n = int(offsets[0]), int(offsets[-1] - offsets[0])
                up, down = powers(n + 1)
                total = np.concatenate([[U(0)], np.cumsum(CODES[data[base : base + n]] * up[:n], dtype=np.uint64)])
                begin, h, m, skip, low, high = (offsets[:-1] - base, *(part.column(c).to_numpy() for c in ("h", "m", "skip", "low", "high")))
                row = np.searchsorted(begin, np.arange(n + 1 - gram), "right") - 1
                hits = np.flatnonzero(mix((total[gram:] - total[:-gram]) * down[: n + 1 - gram]).view(np.int64) == h[row])
                anchor = hits[np.searchsorted(row[hits], np.arange(len(m)))]  # the first one is the anchor
                middle = (low + high) // 2
                cut = np.clip(anchor - begin - middle, 0, m)
                for a, b, lo, hi in ((np.zeros(len(m), int), cut, middle + 1, high), (cut, m, low, middle)):
                    at = np.flatnonzero(b > a)
                    x, y = (anchor - lo)[at], (anchor - hi)[at] + length
                    met = mix((total[y] - total[x]) * down[x] + ((lo << 16) + hi)[at].astype(np.uint64)).view(np.int64)
                    first, last = (begin + a)[at], (begin + b)[at] + length - 1
                    raw = [data[base + i : base + j].tobytes() for i, j in zip(first.tolist(), last.tolist())]
                    columns = [*(part.column(c).take(pa.array(at)) for c in ("key", "doc_id", "p")), pa.array((b - a)[at], pa.int32()), *(part.column(c).take(pa.array(at)) for c in ("h", "g")), pa.array(raw, pa.binary())]
                    columns += [pa.array(met), *(pa.array(np.asarray(c)[at], pa.int32()) for c in (skip + a, lo, hi))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "p", "m", "h", "g", "raw", "met", "skip", "low", "high"])

    return halve


def _equal_windows(rows: DataFrame) -> DataFrame:
    """Single windows of groups that are still large: equal ones by their bytes, one row each."""
    place = F.struct("doc_id", "key", (F.col("p") + F.col("skip")).alias("at"))
    met = rows.groupBy("raw").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    one = F.array(F.col("skip"), F.col("skip") + 1)
    return rows.hint("merge").join(met, "raw").select("h", "g", one.alias("repeated"), F.when(place > F.col("first"), one).otherwise(F.array().cast("array<int>")).alias("earlier"))


def merged(flat: np.ndarray) -> np.ndarray:
    """Maximal runs (start, end) of a flat list of spans that may overlap or touch."""
    if not len(flat):
        return np.zeros((0, 2), np.int64)
    spans = flat.reshape(-1, 2)[np.argsort(flat[::2], kind="stable")].astype(np.int64)
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.append(True, spans[1:, 0] > reach[:-1])
    return np.column_stack([spans[first, 0], reach[np.append(first[1:], True)]])


def _kept(text: np.ndarray, spans: np.ndarray) -> bytes:
    keep = np.ones(len(text), bool)
    for a, b in spans.tolist():
        keep[a:b] = False
    return text[keep].tobytes()


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _with_spans(rows: DataFrame, docs: DataFrame, length: int, column: str) -> DataFrame:
    """``rows``, which have a key, with the spans found in ``docs`` and, for later copies, whether the row is an identical one's first.

    The first of identical rows is the one with the least number, and the numbers are written with the
    rows, so that they stay as they are when a task is tried again.
    """
    keyed = docs.select(_key(F.col("doc_id"), F.col("text")).alias("key"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = find_repeats(keyed, length).select("key", F.col(column).alias("spans"))
    if column == "repeated":
        return rows.join(found.hint("merge"), "key", "left").withColumn("first", F.lit(True)).drop("key")
    rows = save(rows.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    least = rows.groupBy("key").agg(F.min("_number").alias("_least"))
    found = least.join(found, "key", "left")
    return rows.join(found.hint("merge"), "key").withColumn("first", F.col("_number") == F.col("_least")).drop("key", "_number", "_least")


def _removed(size: int, spans, first: bool, length: int) -> np.ndarray:
    """The merged spans of a text; a further identical row is a later copy from end to end."""
    if not first and size >= length:
        return np.array([[0, size]], np.int64)
    return merged(np.asarray(spans.values) if spans.is_valid else np.zeros(0, np.int64))


def _key(doc_id: Column, text: Column) -> Column:
    """Tells rows apart by id and text."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))


def measure_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """What removing repeats leaves of each text: all their copies, or all but the first."""
    column = {"none": "repeated", "first": "later"}[keep]
    rows = docs.select(_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            out = []
            for i, (doc, spans, first) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("spans"), batch.column("first").to_pylist())):
                text = data[offsets[i] : offsets[i + 1]]
                found = _removed(len(text), spans, first, length)
                out.append((doc, len(text), int((found[:, 1] - found[:, 0]).sum()), len(found), hashlib.sha256(_kept(text, found)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return _with_spans(rows, docs, length, column).mapInArrow(run, SCHEMA)


def remove_later_copies(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with every later copy of a repeated string cut out of ``text``; the first copy stays.

    A cut never splits a character. Null texts stay null.
    """
    names = [f"_{i}" for i in range(len(docs.columns))]  # own names, so that no input column clashes
    own = names[docs.columns.index("text")]
    rows = docs.toDF(*names)
    whole = rows.select(_key(F.col(names[docs.columns.index("doc_id")]), F.col(own)).alias("key"), *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(own))
            texts = batch.column(own).to_pylist()
            for i, (spans, first) in enumerate(zip(batch.column("spans"), batch.column("first").to_pylist())):
                text = data[offsets[i] : offsets[i + 1]]
                found = _removed(len(text), spans, first, length)
                if len(found):
                    for span in found:
                        while span[0] < span[1] and text[span[0]] & 0xC0 == 0x80:
                            span[0] += 1
                        while span[0] < span[1] < len(text) and text[span[1]] & 0xC0 == 0x80:
                            span[1] -= 1
                    texts[i] = _kept(text, found).decode()
            at = batch.schema.get_field_index(own)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type)).select(names)

    return _with_spans(whole, docs, length, "later").mapInArrow(run, rows.schema).toDF(*docs.columns)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_repeats(documents(spark, sf_dir))
