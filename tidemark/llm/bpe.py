"""BPE encoding and decoding; long unsplit texts are encoded in halves by several tasks and joined.

A text up to LEAF characters is encoded at once. A longer one is cut in halves, again and again,
until the leaves fit; the leaves are rows that any task encodes. Then neighbours are joined pairwise
up the tree: the text around the join is encoded anew in a growing window until it agrees with the
left side at its first token and with the right side at its last one.

Why agreement is exact. The pre-tokenizer reads from left to right without looking back, so from a
common word start on it splits equal text equally; and a word's merges depend on that word alone. The
window begins at a word start of the left side and ends at one that both the window and the right
side have, each farther than the pattern looks ahead, or a special string is long, from where its text was cut.

Where one long word (a run of letters, digits, marks or spaces) lies over the join and out of the
window on both sides, the window is of tokens: the last ones of the left part and the first ones of
the right part are encoded anew together, until the result begins with the left side's token and ends
with the right side's. A word's tokens are its encoding exactly if every two neighbours are what their
bytes together encode to; neighbours in the left part, in the window and in the right part are, so
with both end tokens shared all are. If there is no such place, the window grows to all of both sides.

Cases: a null text is empty and has no ids; a special token's string inside a text becomes that
token, and cuts never fall inside one; texts of any length are encoded whole; repeated rows are
encoded one by one (a row number tells long ones apart); an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import documents, sorted_groups, spread

#: Characters of a leaf, and of the first window on each side of a join.
LEAF, WINDOW = 1 << 15, 64
#: Runs that the pattern never splits and that read the same on either side of a cut.
RUNS = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"
#: More than any alternative of the pattern looks ahead beyond a word's end.
LOOK = 8
#: Fixed value: the byte-level pre-tokenizer's pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the rest from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """A byte-level vocabulary file with fast encoding and decoding."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        byte_of = _byte_of()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.special = special
        self.bpe = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.known: dict[str, np.ndarray] = {}
        self.renewed = 0  # characters or tokens that joins encoded anew
        self.words, self.runs = regex.compile(PATTERN), regex.compile(RUNS)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.look = max([LOOK, *(len(x) + 1 for x in special)])

    def encode(self, text: str) -> np.ndarray:
        return self.bpe.encode_to_numpy(text, allowed_special="all", disallowed_special=())

    def word(self, raw: bytes) -> np.ndarray:
        """The tokens of one word, or of a part of one."""
        return np.array(self.bpe._encode_single_piece(raw), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.bpe.decode_bytes(ids.tolist()).decode("utf-8", "replace")

    def _words(self, text: str) -> Iterator[tuple[int, str]]:
        """Words with their places; special strings are cut out first and are words of their own."""
        at = 0
        for i, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                yield at, part
            else:
                for m in self.words.finditer(part):
                    yield at + m.start(), m.group()
            at += len(part)

    def piece(self, text: str) -> Piece:
        """``text`` encoded word by word; each distinct word is encoded once."""
        starts, tokens, parts, n = [], [], [], 0
        for at, word in self._words(text):
            ids = self.known.get(word)
            if ids is None:
                ids = self.encode(word)
                if len(self.known) < 200_000 and len(word) < 64:
                    self.known[word] = ids
            starts.append(at)
            tokens.append(n)
            parts.append(ids)
            n += len(ids)
        return Piece(text, np.array(starts, np.int64), np.array(tokens, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint32))


class Piece(NamedTuple):
    """An encoded text: where its words start in characters and in tokens, and its ids."""

    text: str
    starts: np.ndarray
    tokens: np.ndarray
    ids: np.ndarray

    def part(self, low: int, high: int, at: int, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words low to high, moved so that the first starts at ``at`` and has ``before`` tokens before it."""
        ends = np.append(self.tokens, len(self.ids))
        return self.starts[low:high] + at, self.tokens[low:high] - ends[low] + before, self.ids[ends[low] : ends[high]]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _one_run(coder: Codec, left: Piece, right: Piece, reach: int) -> bool:
    """Whether one word lies over the join that is longer than ``reach`` on both sides."""
    cut = len(left.text)
    if not (len(left.starts) and len(right.starts)) or cut - int(left.starts[-1]) <= reach:
        return False
    if (int(right.starts[1]) if len(right.starts) > 1 else len(right.text)) <= reach:
        return False
    return coder.runs.fullmatch(left.text[cut - reach :] + right.text[:reach]) is not None


def join_tokens(coder: Codec, left: np.ndarray, right: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The tokens of a word of which two parts are encoded, by re-encoding a growing window of tokens."""
    reach = window
    while True:
        a, b = max(0, len(left) - reach), min(len(right), reach)
        found = coder.word(coder.bpe.decode_bytes([*left[a:].tolist(), *right[:b].tolist()]))
        coder.renewed += len(left) - a + b
        if (a == 0 or found[0] == left[a]) and (b == len(right) or found[-1] == right[b - 1]) and (len(found) > 1 or a == 0 or b == len(right)):
            return np.concatenate([left[:a], found, right[b:]])
        reach *= 2


def join(coder: Codec, left: Piece, right: Piece, window: int = WINDOW) -> Piece:
    """The encoding of both texts together, by re-encoding a growing window around the join."""
    cut = len(left.text)
    reach = window
    while True:
        if reach > coder.look and _one_run(coder, left, right, reach):
            last = int(left.tokens[-1])
            second = int(right.tokens[1]) if len(right.tokens) > 1 else len(right.ids)
            middle = join_tokens(coder, left.ids[last:], right.ids[:second], window)
            behind = right.part(1, len(right.starts), cut + int(right.starts[1]), last + len(middle)) if len(right.starts) > 1 else right.part(0, 0, 0, 0)
            ids = np.concatenate([left.ids[:last], middle, behind[2]])
            return Piece(left.text + right.text, np.append(left.starts, behind[0]), np.append(left.tokens, behind[1]), ids)
        first = int(np.searchsorted(left.starts, cut - max(reach, coder.look), "right")) - 1
        first = max(first, 0)
        begin = int(left.starts[first]) if len(left.starts) else 0
        end = min(len(right.text), reach)
        around = coder.piece(left.text[begin:] + right.text[:end])
        coder.renewed += cut - begin + end
        trusted = end if end == len(right.text) else end - coder.look
        ours = around.starts + begin - cut
        common = np.intersect1d(ours[(ours > 0) & (ours < trusted)], right.starts)
        if len(common) or end == len(right.text):
            break
        reach *= 2
    meet = int(common[0]) if len(common) else len(right.text)
    parts = [left.part(0, first, 0, 0)]
    count = len(parts[0][2])
    parts.append(around.part(0, int(np.searchsorted(ours, meet)), begin, count))
    count += len(parts[1][2])
    parts.append(right.part(int(np.searchsorted(right.starts, meet)), len(right.starts), cut, count))
    return Piece(left.text + right.text, *(np.concatenate([p[i] for p in parts]) for i in range(3)))


def join_tree(coder: Codec, pieces: list[Piece]) -> Piece:
    while len(pieces) > 1:
        pieces = [join(coder, *pieces[i : i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    return pieces[0]


def leaves(text: str, special, most: int = LEAF) -> list[str]:
    """``text`` in halves of halves of at most ``most`` characters; no cut inside a special string."""
    if len(text) <= most:
        return [text]
    cut = len(text) // 2
    for word in special:
        at = text.find(word, max(0, cut - len(word) + 1), cut + len(word) - 1)
        if at >= 0 and at < cut < at + len(word):
            cut = at if at else at + len(word)
    return [*leaves(text[:cut], special, most), *leaves(text[cut:], special, most)] if 0 < cut < len(text) else [text]


SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _row(coder: Codec, ids: np.ndarray) -> tuple[int, str, str]:
    decoded = coder.decode(ids).encode()
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _table(ids: list, rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode_documents(docs: DataFrame, path: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the text decoded from them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            yield _table(batch.column("doc_id").to_pylist(), [_row(coder, coder.encode(x.as_py())) for x in batch.column("text")])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for key, doc, x in zip(*(batch.column(c) for c in ("key", "doc_id", "text"))):
                parts = leaves(x.as_py(), coder.special, leaf)
                yield pa.RecordBatch.from_pydict({"key": pa.array([key.as_py()] * len(parts)), "doc_id": pa.array([doc.as_py()] * len(parts), pa.int64()), "leaf": pa.array(range(len(parts)), pa.int32()), "text": pa.array(parts)})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            pieces = [coder.piece(x.as_py()) for x in batch.column("text")]
            packed = [pa.array([np.asarray(p[i]).astype(kind).tobytes() for p in pieces], pa.binary()) for i, kind in ((1, "<u4"), (2, "<u4"), (3, "<u4"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *packed], [*batch.schema.names, "starts", "tokens", "ids"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for group in sorted_groups(batches, "key"):
            number = group.column("leaf").to_numpy()
            copies = int((number == 0).sum())
            pieces = []
            for i in range(0, group.num_rows, copies):  # repeated rows give equal leaves side by side
                at = {c: group.column(c)[i].as_py() for c in ("text", "starts", "tokens", "ids")}
                pieces.append(Piece(at["text"], *(np.frombuffer(at[c], "<u4").astype(t) for c, t in (("starts", np.int64), ("tokens", np.int64), ("ids", np.uint32)))))
            found = _row(coder, join_tree(coder, pieces).ids)
            yield _table([group.column("doc_id")[0].as_py()] * copies, [found] * copies)

    parts = spread(docs.sparkSession)
    long = rows.where(F.length("text") > leaf).select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    long = long.mapInArrow(split, "key long, doc_id long, leaf int, text string").repartition(parts, "key", "leaf")
    long = long.mapInArrow(encode, "key long, doc_id long, leaf int, text string, starts binary, tokens binary, ids binary")
    long = long.repartition(parts, "key").sortWithinPartitions("key", "leaf").mapInArrow(gather, SCHEMA)
    return rows.where(F.length("text") <= leaf).mapInArrow(whole, SCHEMA).unionByName(long)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), default_tokenizer())
