"""Secret scans: one minimal deterministic automaton for all rules, run once over the bytes of each text.

Rule regexes (a small dialect: literals, classes, ``? * + {n,}``, groups, ``|``) become one
nondeterministic automaton, then by subset construction and partition refinement a minimal
deterministic one, kept as a transition array. The forward array starts anew at every byte, so one
pass marks where some match of each rule ends. For those few places a reversed array of the rule
walks back to the leftmost start and an anchored one forward to the longest end, which gives the
leftmost-longest, non-overlapping spans of each kind.

Cases: a null or empty text has no spans; offsets are code points, ends exclusive; a long text is
scanned whole; repeated rows are scanned one by one; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.arrow_text import buffers, slices
from tidemark.llm.shared import documents

#: The base rules (kind, pattern, least length: of the value behind the sign for assign, else of the match), then this method's own.
BASE = (
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 12),
    ("access", r"AKIA[A-Z0-9]+", 18),
    ("hex", r"[0-9a-f]{16,}", 16),
)
EXTRA = (
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    ("google", r"AIza[A-Za-z0-9_-]+", 39),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    ("login", r"://[A-Za-z0-9._-]+:[A-Za-z0-9._!%-]+@", 12),
)
#: Bytes scanned at once; of a piece, whose row's pieces are scanned side by side; first states of pieces that are kept.
SCAN_BYTES, PIECE, KEPT = 4 << 20, 2048, 128


class Nfa:
    """Thompson construction; an edge carries a set of bytes, or None for an empty step.

    A short one stops at the least repetition of a pattern's last part: enough to see that it matches.
    """

    def __init__(self, short: bool = False):
        self.edges: list[list[tuple[frozenset | None, int]]] = []
        self.short = short

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def parse(self, pattern: str) -> tuple[int, int]:
        self.text, self.at = pattern, 0
        return self._either()

    def _either(self) -> tuple[int, int]:
        ends = [self._sequence()]
        while self.text[self.at : self.at + 1] == "|":
            self.at += 1
            ends.append(self._sequence())
        if len(ends) == 1:
            return ends[0]
        a, b = self.state(), self.state()
        for x, y in ends:
            self.edges[a].append((None, x))
            self.edges[y].append((None, b))
        return a, b

    def _sequence(self) -> tuple[int, int]:
        a = b = self.state()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            x, y = self._repeated()
            self.edges[b].append((None, x))
            b = y
        return a, b

    def _repeated(self) -> tuple[int, int]:
        begin = self.at
        a, b = self._atom()
        stop = self.at
        mark = self.text[self.at : self.at + 1]
        least = {"?": 0, "*": 0, "+": 1}.get(mark)
        if mark == "{":
            close = self.text.index(",}", self.at)
            least, self.at = int(self.text[self.at + 1 : close]), close + 2
        elif least is None:
            return a, b
        else:
            self.at += 1
        after = self.at
        for _ in range(least - 1):
            self.at = begin
            x, y = self._atom()
            assert self.at == stop
            self.edges[b].append((None, x))
            last, b = x, y
        self.at = after
        if mark != "?" and not (self.short and after == len(self.text)):
            self.edges[b].append((None, last if least > 1 else a))
        if least == 0:
            first, end = self.state(), self.state()
            self.edges[first] += [(None, a), (None, end)]
            self.edges[b].append((None, end))
            return first, end
        end = self.state()
        self.edges[b].append((None, end))
        return a, end

    def _atom(self) -> tuple[int, int]:
        c = self.text[self.at]
        if c == "(":
            self.at += 1
            inner = self._either()
            self.at += 1
            return inner
        chosen = self._class() if c == "[" else frozenset([self._byte()])
        a, b = self.state(), self.state()
        self.edges[a].append((chosen, b))
        return a, b

    def _byte(self) -> int:
        c = self.text[self.at]
        if c == "\\":
            if self.text[self.at + 1] == "x":
                self.at += 4
                return int(self.text[self.at - 2 : self.at], 16)
            self.at += 1
            c = self.text[self.at]
        self.at += 1
        return ord(c)

    def _class(self) -> frozenset:
        self.at += 1
        found: set[int] = set()
        while self.text[self.at] != "]":
            low = self._byte()
            if self.text[self.at] == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                found.update(range(low, self._byte() + 1))
            else:
                found.add(low)
        self.at += 1
        return frozenset(found)

    def reverse(self) -> Nfa:
        out = Nfa()
        out.edges = [[] for _ in self.edges]
        for a, edges in enumerate(self.edges):
            for on, b in edges:
                out.edges[b].append((on, a))
        return out


def determinise(nfa: Nfa, starts: list[int], accepts: dict[int, int], floating: bool) -> tuple[np.ndarray, np.ndarray]:
    """Minimal deterministic automaton: next state for state * 256 + byte, and each state's accept mask.

    ``accepts`` gives each final state its mask. A floating automaton may start at every byte; in an
    anchored one, state 0 is the start and dead states are marked by a mask of -1.
    """

    def closure(states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for on, b in nfa.edges[todo.pop()]:
                if on is None and b not in seen:
                    seen.add(b)
                    todo.append(b)
        return frozenset(seen)

    start = closure(starts)
    found, todo, table = {start: 0}, [start], []
    while todo:
        here = todo.pop(0)
        row: list[set[int]] = [set() for _ in range(256)]
        for a in here:
            for on, b in nfa.edges[a]:
                for byte in on or ():
                    row[byte].add(b)
        known: dict[frozenset, int] = {}
        line = np.zeros(256, np.int32)
        for byte, to in enumerate(row):
            key = frozenset(to)
            if key not in known:
                full = closure(key | start) if floating else closure(key)
                if full not in found:
                    found[full] = len(found)
                    todo.append(full)
                known[key] = found[full]
            line[byte] = known[key]
        table.append(line)
    moves = np.array(table)
    masks = np.zeros(len(found), np.int64)
    for states, i in found.items():
        for s in states:
            masks[i] |= accepts.get(s, 0)
        if not states:
            masks[i] = -1
    part = np.unique(masks, return_inverse=True)[1]
    while True:  # refine until the blocks agree on where every byte leads
        finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    order = {b: i for i, b in enumerate(dict.fromkeys(part.tolist()))}
    part = np.array([order[b] for b in part.tolist()])
    first = np.array([np.flatnonzero(part == b)[0] for b in range(len(order))])
    return (part[moves[first]] * 256).astype(np.int32).ravel(), masks[first]


class Scanner:
    """Transition arrays for a list of (kind, pattern, least length) rules."""

    def __init__(self, rules):
        self.rules = rules
        nfa, starts, accepts = Nfa(short=True), [], {}
        for k, (_, pattern, _) in enumerate(rules):
            a, b = nfa.parse(pattern)
            starts.append(a)
            accepts[b] = 1 << k
        self.moves, self.masks = determinise(nfa, starts, accepts, True)
        self.table, self.marks, self.accepting = self.moves.tolist(), self.masks.tolist(), self.masks != 0
        self.ahead, self.back = [], []
        for _, pattern, _ in rules:
            one = Nfa()
            a, b = one.parse(pattern)
            self.ahead.append(determinise(one, [a], {b: 1}, False))
            self.back.append(determinise(one.reverse(), [b], {a: 1}, False))

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, end, mask) wherever some rule accepts, by row and place: one pass, pieces of the rows side by side.

        A row's later pieces are begun in the first state. Where the piece before has ended in another one,
        a piece is read again from that until both ways are in one state, mostly after a few bytes.
        """
        lengths = np.diff(offsets)
        count = -(-lengths // PIECE)
        row = np.repeat(np.arange(len(lengths)), count)
        skip = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * PIECE
        begin, left = offsets[:-1][row] + skip, np.minimum(PIECE, lengths[row] - skip)
        if not len(row):
            return
        order = np.argsort(-left, kind="stable")
        at = begin[order]
        alive = np.searchsorted(-left[order], -np.arange(int(left.max())), "left")
        state, path, found = np.zeros(len(order), np.int32), [], [np.zeros((3, 0), np.int64)]
        wide = np.repeat(self.accepting, 256)
        for i, n in enumerate(alive.tolist()):
            s = self.moves[state[:n] + data[at[:n] + i]]
            state[:n] = s
            if i < KEPT:
                path.append(s)
            flagged = wide[s]
            if flagged.any():
                lanes = np.flatnonzero(flagged)
                found.append(np.array([order[lanes], np.full(len(lanes), i), self.masks[s[lanes] >> 8]]))
        lane = np.empty(len(order), np.int64)
        lane[order] = np.arange(len(order))
        ends, holds, again = state[lane], np.zeros(len(order), np.int64), [(0, 0, 0)]
        for p in np.flatnonzero(skip).tolist():
            s, k, other = int(ends[p - 1]), int(lane[p]), 0
            if not s:
                continue
            for j, byte in enumerate(data[begin[p] : begin[p] + left[p]].tobytes()):
                s, other = self.table[s + byte], int(path[j][k]) if j < KEPT else self.table[other + byte]
                if s == other:
                    holds[p] = j
                    break
                if self.marks[s >> 8]:
                    again.append((row[p], skip[p] + j + 1, self.marks[s >> 8]))
            else:
                holds[p], ends[p] = left[p], s
        piece, step, mask = np.concatenate(found, axis=1)
        true = step >= holds[piece]
        piece, step, mask = piece[true], step[true], mask[true]
        rows, places, masks = (np.concatenate(x) for x in zip((row[piece], skip[piece] + step + 1, mask), np.array(again[1:], np.int64).reshape(-1, 3).T))
        for k in np.lexsort((places, rows)).tolist():
            yield int(rows[k]), int(places[k]), int(masks[k])

    def spans(self, text: bytes, ends: list[list[int]]) -> list[tuple[int, int, int]]:
        """(start, end, kind's number) in bytes, given the places where each rule accepted."""
        found = []
        for k, places in enumerate(ends):
            done = 0
            for e in places:
                if e <= done:
                    continue
                start = self._walk(self.back[k], text, e - 1, done - 1, -1)
                if start is None:
                    continue
                end = self._walk(self.ahead[k], text, start, len(text), 1)
                found.append((start, end, k))
                done = end
        return sorted(found)

    @staticmethod
    def _walk(automaton, text: bytes, at: int, stop: int, step: int) -> int | None:
        """The farthest accepting place on the way from ``at`` to before ``stop``."""
        moves, masks = automaton
        state, best = 0, None
        while at != stop:
            state = int(moves[state + text[at]])
            mask = masks[state >> 8]
            if mask < 0:
                break
            if mask:
                best = at if step < 0 else at + 1
            at += step
        return best


@lru_cache(maxsize=4)
def scanner(rules=BASE + EXTRA) -> Scanner:
    """Compiled once on the driver; tasks get the arrays."""
    return Scanner(rules)


def find_secrets(column: pa.Array, machine: Scanner) -> list[list[tuple[str, int, int]]]:
    """Each text's (kind, start, end) in code points, by start and then by the rules' order."""
    rules = machine.rules
    data, offsets = buffers(column)
    out: list[list[tuple[str, int, int]]] = []
    for lo, hi in slices(offsets, SCAN_BYTES):
        ends: dict[int, list[list[int]]] = {}
        for row, end, mask in machine.hits(data, offsets[lo : hi + 1]):
            places = ends.setdefault(row, [[] for _ in rules])
            for k in range(len(rules)):
                if mask >> k & 1:
                    places[k].append(end)
        for row in range(hi - lo):
            if row not in ends:
                out.append([])
                continue
            text = data[offsets[lo + row] : offsets[lo + row + 1]]
            raw = text.tobytes()
            points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
            spans = []
            for a, b, k in machine.spans(raw, ends[row]):
                if (_value_length(raw, a, b) if rules[k][0] == "assign" else b - a) >= rules[k][2]:
                    spans.append((rules[k][0], int(points[a]), int(points[b])))
            out.append(spans)
    return out


def _value_length(raw: bytes, a: int, b: int) -> int:
    """Length of the value behind the first : or = of an assignment."""
    sign = min(i for i in (raw.find(b":", a, b), raw.find(b"=", a, b)) if i >= 0)
    value = raw[sign + 1 : b].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'"))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, rules=BASE + EXTRA) -> DataFrame:
    """One row per document: base counts, the digest of the base spans, and all spans."""
    base, machine = [rule[0] for rule in BASE], scanner(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = find_secrets(batch.column("text"), machine)
            joined = lambda found: ",".join(f"{k}:{a}:{b}" for k, a, b in found)
            counts = [pa.array([sum(x[0] == kind for x in found) for found in spans], pa.int64()) for kind in base]
            digest = pa.array([hashlib.sha256(joined([x for x in found if x[0] in base]).encode()).hexdigest() for found in spans], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digest, pa.array([joined(found) for found in spans], pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, SCHEMA)


def redact_secrets(docs: DataFrame, mark: str = "[REDACTED]", rules=BASE + EXTRA) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; other texts stay as they are."""
    fields, machine = docs.schema, scanner(rules)

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            found = find_secrets(column, machine)
            if any(found):
                texts = column.to_pylist()
                for i, spans in enumerate(found):
                    if spans:
                        parts, done = [], 0
                        for _, a, b in spans:
                            if b > done:
                                parts += [texts[i][done : max(a, done)], mark] if a >= done else []
                                done = b
                        texts[i] = "".join([*parts, texts[i][done:]])
                batch = batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"), pa.array(texts, column.type))
            yield batch

    return docs.mapInArrow(redact, fields)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))
