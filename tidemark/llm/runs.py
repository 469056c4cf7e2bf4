"""Periodic run detection by longest common extensions over a difference cover.

A run is a stretch of words with smallest period q and at least EXPONENT * q words that no neighbouring
word extends. Wherever a word equals the one q further on, the stretch of such places around it gives
the run of period q there; a run has at least (EXPONENT - 1) * q of them in a row, so it holds a point
of the grid of that width. For all periods the grids have about n ln(n) / 3 points together, the
harmonic series, and each costs two longest common extensions, to the right and to the left.

Extensions come from suffixes sampled by a difference cover: the places i with i mod 31 in COVER, less
than a fifth of all. Any two places reach, after the same number of steps under 31, places that are
both sampled: those few words are compared directly, and then the common prefix of the two samples is
the least of the prefixes between their neighbours in sorted order, out of a sparse table. Only samples
are sorted: by their first 31 words, then by doubling, because 31 words further on is a sample again.

All texts of a slice are one sequence in which a word of its own ends each text, so short texts are
worked on together and no extension leaves its text. Rows are worked on where they are, without a
shuffle; a text is worked on whole and takes about 100 bytes of memory a word.

Cases: a null text, an empty one and one without words have no runs, nulls for the longest one, and
the digests of nothing; of equally long runs the first counts, then the shorter period; repeated rows
are judged one by one; a row without an id is not rewritten; an empty table gives no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import buffers, slices
from tidemark.llm.shared import documents

#: Periods that a run has at least, and words.
EXPONENT, LEAST = 4, 6
#: A perfect difference set: every difference modulo WIDTH but 0 is that of exactly one pair.
WIDTH, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Bytes of text that are one sequence; a longer text is one of its own.
SLICE_BYTES = 1 << 20
#: Grid points that are looked at together.
POINTS = 1 << 19


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Number of each residue in the cover (or -1), and the steps after which two residues are in it."""
    slot = np.full(WIDTH, -1, np.int64)
    slot[list(COVER)] = np.arange(len(COVER))
    steps = np.full((WIDTH, WIDTH), WIDTH, np.int64)
    i, j = np.indices((WIDTH, WIDTH))
    for step in range(WIDTH - 1, -1, -1):
        both = (slot[(i + step) % WIDTH] >= 0) & (slot[(j + step) % WIDTH] >= 0)
        steps[both] = step
    return slot, steps


_SLOT, _STEPS = _tables()


class Extensions:
    """Longest common extensions to the right in a sequence whose last word occurs nowhere else."""

    def __init__(self, words: np.ndarray):
        self.words, n, per = words, len(words), len(COVER)
        padded = np.concatenate([words, np.zeros(2 * WIDTH, words.dtype)])
        turns = -(-n // WIDTH)
        place = (np.arange(turns)[:, None] * WIDTH + np.array(COVER)).ravel()
        block = padded[place[:, None] + np.arange(WIDTH)]
        rank = np.unique(block.astype(">i4").view(f"S{4 * WIDTH}").ravel(), return_inverse=True)[1].ravel()
        levels, jump = [rank.astype(np.int32)], per
        while int(rank.max(initial=-1)) + 1 < len(rank) and jump < len(rank):
            pair = (rank.astype(np.int64) + 1) << 32
            pair[:-jump] |= rank[jump:] + 1
            rank = np.unique(pair, return_inverse=True)[1]
            levels.append(rank.astype(np.int32))
            jump *= 2
        order = np.argsort(rank, kind="stable")  # samples behind the end are all alike, and never asked for
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))
        a, b = order[:-1].copy(), order[1:].copy()
        same = np.zeros(len(a), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            inside = np.maximum(a, b) < len(rank)
            equal = inside & (levels[level][np.minimum(a, len(rank) - 1)] == levels[level][np.minimum(b, len(rank) - 1)])
            same += np.where(equal, WIDTH << level, 0)
            a += np.where(equal, per << level, 0)
            b += np.where(equal, per << level, 0)
        for low in range(0, len(a), POINTS):
            at = slice(low, low + POINTS)
            x, y = (np.minimum(k[at], len(rank) - 1) for k in (a, b))
            same[at] += (block[x] != block[y]).argmax(axis=1)
        table, width = [same.astype(np.int32)], 1
        while 2 * width <= len(same):
            last = table[-1]
            table.append(np.append(np.minimum(last[:-width], last[width:]), last[len(last) - width :]))
            width *= 2
        self.least = np.array(table)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i < j the number of words that are equal from there on."""
        words, out = self.words, np.zeros(len(i), np.int64)
        need = _STEPS[i % WIDTH, j % WIDTH]
        met, open_ = [np.flatnonzero(need == 0)], np.flatnonzero(need > 0)
        step = 0
        while len(open_):
            open_ = open_[words[i[open_] + step] == words[j[open_] + step]]
            step += 1
            out[open_] = step
            done = need[open_] == step
            met.append(open_[done])
            open_ = open_[~done]
        at = np.concatenate(met)
        if len(at):
            a, b = (self.rank[p // WIDTH * len(COVER) + _SLOT[p % WIDTH]] for p in (i[at] + need[at], j[at] + need[at]))
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(float))[1] - 1
            out[at] += np.minimum(self.least[level, low], self.least[level, high - (1 << level)])
        return out


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """(start, end, period) of all runs of a sequence of texts, each ended by a word of its own; by start, then period.

    ``longest`` is the number of words of the longest text.
    """
    n, found = len(words), []
    if longest < LEAST:
        return np.zeros((0, 3), np.int64)
    ahead, back = Extensions(words), None
    wide = EXPONENT - 1
    low, most = 1, longest // EXPONENT
    while low <= most:
        high = low + 1
        points = n // (wide * low) + 1
        while high <= most and points < POINTS:
            points += n // (wide * high) + 1
            high += 1
        periods = np.arange(low, high)
        count = np.maximum(0, (n - periods + wide * periods - 1) // (wide * periods))
        q = np.repeat(periods, count)
        i = (np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)) * q * wide
        equal = words[i] == words[i + q]
        i, q = i[equal], q[equal]
        beside = words[np.minimum(i + 1, n - 1)] == words[np.minimum(i + q + 1, n - 1)]
        beside |= (i > 0) & (words[np.maximum(i - 1, 0)] == words[np.maximum(i + q - 1, 0)])  # one place does not make a run
        i, q = i[beside], q[beside]
        if len(i):
            end = i + q + ahead(i, i + q)
            if back is None:  # what stands before a text's first word is the last text's end
                back = Extensions(np.append(words[::-1], words.max() + 1))
            start = i.copy()
            inner = np.flatnonzero(i > 0)
            start[inner] -= back(n - i[inner] - q[inner], n - i[inner])
            size = end - start
            keep = size >= np.maximum(LEAST, EXPONENT * q)
            found.append(np.column_stack([start, end, q])[keep])
        low = high
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # longer periods of a stretch are multiples of its smallest one
    first = np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))[: len(runs)]
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


class Texts:
    """Words of the texts of a slice, their runs and what is left without repetitions."""

    def __init__(self, column: pa.Array, seeds: np.ndarray | None = None):
        lists = pc.split_pattern_regex(pc.fill_null(column, ""), r"[\x20\x09-\x0D]+")
        flat, edges = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
        edges -= edges[0]
        real = pc.not_equal(flat, "")
        self.edges = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))[edges]
        self.words = flat.filter(real)
        self.sizes = np.diff(self.edges)
        if seeds is not None:
            self._rewrite(seeds)

    def _rewrite(self, seeds: np.ndarray) -> None:
        """The tails of texts whose seed is a multiple of 10 repeat a stretch of words; a negative seed stands for none."""
        n, g = self.sizes, seeds // 10
        chosen = (seeds >= 0) & (seeds % 10 == 0) & (n > 0)
        a = np.where(chosen, g % np.maximum(n, 1), n)
        p = 1 + (n - a) // (3 + g % 8)
        row = np.repeat(np.arange(len(n)), n)
        i = np.arange(len(row)) - self.edges[row]
        source = np.where(i >= a[row], a[row] + (i - a[row]) % p[row], i)
        self.words = self.words.take(pa.array(self.edges[row] + source))

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, start, end, period) of all runs, by row, start and period; and the words that stay."""
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        coded = self.words.dictionary_encode()
        words = np.empty(len(row) + len(self.sizes), np.int32)
        words[np.arange(len(row)) + row] = coded.indices.to_numpy() + 1
        words[self.edges[1:] + np.arange(len(self.sizes))] = len(coded.dictionary) + 1 + np.arange(len(self.sizes))
        found = find_runs(words, int(self.sizes.max(initial=0)))
        of = np.searchsorted(self.edges[1:] + np.arange(len(self.sizes)), found[:, 0])
        found[:, :2] -= of[:, None]  # ends of texts are no words
        change = np.zeros(len(row) + 1, np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 1], -1)
        found[:, :2] -= self.edges[of][:, None]
        return np.column_stack([of, found]), np.cumsum(change[:-1]) == 0

    def joined(self, kept: np.ndarray) -> pa.Array:
        """The words that stay, one space between them."""
        edges = np.append(0, np.cumsum(kept))[self.edges]
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), self.words.filter(pa.array(kept)))
        return pc.binary_join(lists, " ")


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def measure_runs(docs: DataFrame, seed=None) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the text without repetitions.

    ``seed`` is a column of whole numbers; where it is a multiple of 10 the text is searched with its tail
    rewritten to repeat itself. Without it texts are searched as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = pc.fill_null(batch.column("seed"), -1).to_numpy(zero_copy_only=False)
            for lo, hi in slices(buffers(batch.column("text"))[1], SLICE_BYTES):
                texts = Texts(batch.column("text").slice(lo, hi - lo), seeds[lo:hi])
                found, kept = texts.runs()
                bounds = np.searchsorted(found[:, 0], np.arange(hi - lo + 1))
                left = texts.joined(kept)
                out = []
                for k, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                    mine = [(s, e - s, q) for s, e, q in found[a:b, 1:].tolist()]
                    best = min(mine, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                    milli = 1000 * best[1] // best[2] if mine else None
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in mine)
                    out.append((len(mine), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left[k].as_buffer()).hexdigest()))
                kinds = (*(pa.int64(),) * 5, pa.string(), pa.string())
                names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *(pa.array([x[c] for x in out], t) for c, t in enumerate(kinds))], ["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.lit(-1) if seed is None else seed).cast("long").alias("seed"))
    return rows.mapInArrow(run, SCHEMA)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with every repetition after the first period of a run taken out of ``text``.

    Texts without runs stay as they are; the words of the others are joined by one space. Null texts stay null.
    """
    names = [f"_{i}" for i in range(len(docs.columns))]  # own names, so that no input column clashes
    own = names[docs.columns.index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(own)
            out = []
            for lo, hi in slices(buffers(column)[1], SLICE_BYTES):
                texts = Texts(column.slice(lo, hi - lo))
                found, kept = texts.runs()
                changed = np.zeros(hi - lo, bool)
                changed[found[:, 0]] = True
                out.append(pc.if_else(pa.array(changed), texts.joined(kept), column.slice(lo, hi - lo)))
            at = batch.schema.get_field_index(own)
            yield batch.set_column(at, batch.schema.field(at), pa.concat_arrays(out) if out else column).select(names)

    rows = docs.toDF(*names)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_runs(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string").cast("binary")))


#: By all pairs of equal words up to a quarter of the text apart, for DuckDB; it has no CRC, so that is written out.
ORACLE = r"""
with texts as materialized (
    select row_number() over () as rid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws,
        xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda ch: ord(ch)::bigint)),
            lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) as h
    from documents),
cuts as (select rid, len(ws) as n, h % 10 = 0 and len(ws) > 0 as chosen, (h // 10) % greatest(len(ws), 1) as a, h // 10 as g from texts),
sizes as (select rid, n, case when chosen then a else n end as a, 1 + (n - a) // (3 + g % 8) as p from cuts),
places as (select rid, n, a, p, unnest(range(n)) as i from sizes),
words as materialized (select s.rid, s.n, s.i, t.ws[case when s.i >= s.a then s.a + (s.i - s.a) % s.p else s.i end + 1] as word from places s join texts t using (rid)),
equal as (select x.rid, y.i - x.i as q, x.i from words x join words y on x.rid = y.rid and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
islands as (select rid, q, i, i - row_number() over (partition by rid, q order by i) as island from equal),
stretches as (select rid, q, min(i) as start, count(*) + q as length from islands group by rid, q, island having count(*) >= 3 * q and count(*) + q >= 6),
runs as materialized (select rid, start, length, min(q) as period from stretches group by rid, start, length),
listed as (select rid, count(*) as n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256 from runs group by rid),
best as (select * from runs qualify row_number() over (partition by rid order by length desc, start, period) = 1),
gone as (select distinct rid, unnest(range(start + period, start + length)) as i from runs),
kept as (select rid, string_agg(word, ' ' order by i) as collapsed from words anti join gone using (rid, i) group by rid)
select t.doc_id, coalesce(l.n_runs, 0) as n_runs, b.start, b.length, b.period, 1000 * b.length // b.period as exponent_milli,
    coalesce(l.runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(k.collapsed, '')) as collapsed_sha256
from texts t left join listed l using (rid) left join best b using (rid) left join kept k using (rid)
"""
