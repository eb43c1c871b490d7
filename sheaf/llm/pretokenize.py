"""Operator 6, byte-level BPE encoding and decoding without regular expressions.

Pre-tokenising: every code point gets a class from a table (letter, number, other, white space,
with one character of lookahead folded in: the white space that ends a run, an apostrophe that opens a
contraction). A class is a transition function on nine states, and function composition is
associative, so the states of all positions come from a scan: compose the functions of each block of
positions, scan the compositions over the blocks, then replay every block from its known start
state, all blocks at once. A state and the next class tell whether a token starts there.

Merging: equal slices are merged once per batch and remembered in a bounded cache of the worker.
Missing slices are merged together, a round at a time: every slice applies its leftmost
lowest-ranked pair, found in a hash table of pairs. Decoding gathers each id's bytes by its offset.

Defined results: a null text is empty (no ids); equal rows give equal rows; a null id is
passed on; texts are whole, however long; other columns of the input are not looked at. Code points that
Python's ``unicodedata`` does not know yet count as neither letter nor number.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import mix, ship, span_hashes, text_slices

# Classes of code points (before and after lookahead).
LETTER, NUMBER, OTHER, SPACE, BLANK = 0, 1, 2, 3, 4
ONE, TWO, PREFIX, LAST = 5, 6, 7, 3
#: Unicode's White_Space code points.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
         0x205F, 0x3000]
# States: what the token that holds the previous character can still take.
START, IN_L, IN_N, IN_O, IN_W, AFTER_P, ONE_LEFT, TWO_LEFT, ENDED = range(9)
FIRST = 8  # added to the class of a text's first character: its function ignores the state


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, token starts here) by class * 16 + state."""
    nxt, cut = np.zeros((16, 16), np.uint8), np.ones((16, 16), bool)
    for c in range(8):
        for s in range(9):
            go, new = {LETTER: (IN_L, True), NUMBER: (IN_N, True), OTHER: (IN_O, True),
                       BLANK: (IN_W, True), ONE: (ONE_LEFT, True), TWO: (TWO_LEFT, True),
                       PREFIX: (AFTER_P, True), LAST: (ENDED, True)}[c]
            if c == LETTER and s == ONE_LEFT:
                go, new = ENDED, False
            elif c == LETTER and s == TWO_LEFT:
                go, new = ONE_LEFT, False
            elif c in (LETTER, NUMBER, OTHER, BLANK):
                own = {LETTER: IN_L, NUMBER: IN_N, OTHER: IN_O, BLANK: IN_W}[c]
                new = not (s == own or (s == AFTER_P and c != BLANK))
            elif c in (ONE, TWO) and s in (IN_O, AFTER_P):
                go, new = IN_O, False
            nxt[c, s], cut[c, s] = go, new
        nxt[c + FIRST], cut[c + FIRST] = nxt[c, START], True
    return nxt.ravel(), cut.ravel()


_NEXT, _CUT = _automaton()
_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    if not _CLASSES:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)),
                            np.uint8, 0x110000)
        table[WHITE] = BLANK
        table[0x20] = SPACE
        _CLASSES.append(table)
    return _CLASSES[0]


def classify(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class codes with lookahead; ``first`` are the positions where (non-empty) texts start."""
    c = _classes()[points]
    n = len(c)
    ends = np.zeros(n + 1, bool)  # a text ends before this position
    ends[first] = True
    ends[n] = True
    white = (c == SPACE) | (c == BLANK)
    before_solid = white.copy()
    before_solid[:-1] &= ~white[1:]
    before_solid &= ~ends[1:]
    out = c.copy()
    out[white] = BLANK
    out[before_solid & (c == SPACE)] = PREFIX
    out[before_solid & (c == BLANK)] = LAST
    mark = np.flatnonzero(points == 0x27)
    if len(mark):
        pad = np.zeros(2, points.dtype)
        p = np.concatenate([points, pad])
        same1 = ~ends[mark + 1]
        a = np.where(same1, p[mark + 1], 0)
        same2 = same1 & ~ends[np.minimum(mark + 2, n)]
        b = np.where(same2, p[mark + 2], 0)
        out[mark[np.isin(a, [ord(x) for x in "stmd"])]] = ONE
        two = np.zeros(len(mark), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        out[mark[two]] = TWO
    out[first] += FIRST
    return out


def token_starts(code: np.ndarray, block: int = 256) -> np.ndarray:
    """Positions where tokens start, by an associative scan of transition functions."""
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    rows = -(-n // block)
    grid = np.full(rows * block, BLANK + FIRST, np.uint8)
    grid[:n] = code
    grid = np.ascontiguousarray(grid.reshape(rows, block).T).astype(np.uint16) << 4
    # The function of each block: where every possible state ends up.
    f = np.tile(np.arange(9, dtype=np.uint8), (rows, 1))
    for step in grid:
        f = _NEXT[step[:, None] + f]
    # Inclusive scan over the blocks: compose with the block 1, 2, 4, ... before.
    shift = 1
    while shift < rows:
        f[shift:] = np.take_along_axis(f[shift:], f[:-shift], 1)
        shift *= 2
    state = np.empty(rows, np.uint8)
    state[0] = START
    state[1:] = f[:-1, START]
    cut = np.empty((block, rows), bool)
    for i, step in enumerate(grid):
        at = step + state
        cut[i] = _CUT[at]
        state = _NEXT[at]
    return np.flatnonzero(cut.T.ravel()[:n])


class Merger:
    """Pair merging by rank for one vocabulary, with a bounded cache of merged slices."""

    def __init__(self, path: str, cached: int = 400_000):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for t, i in ranks.items():
            tokens[i] = t
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.length) - self.length
        text = [b"%d," % i for i in range(size)]
        self.digits = np.frombuffer(b"".join(text), np.uint8)
        self.digits_length = np.array([len(t) for t in text], np.int64)
        self.digits_at = np.cumsum(self.digits_length) - self.digits_length
        pairs = {}
        for t, i in ranks.items():
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = i
        self.pairs = pairs
        self._hash(np.fromiter(pairs, np.int64, len(pairs)),
                   np.fromiter(pairs.values(), np.int64, len(pairs)))
        self.cached = cached
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.store: list[np.ndarray] = []

    NONE = 1 << 40

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open-addressing table with one vectorised round per probe."""
        bits = max(8, int(len(keys) * 4).bit_length())
        self.mask = (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        self.value = np.full(1 << bits, self.NONE, np.int64)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.key[slot] < 0
            self.key[slot[free]] = keys[left[free]]  # one of those that meet here stays
            won = self.key[slot] == keys[left]
            self.value[slot[won]] = values[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64).copy()) & np.uint64(self.mask)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes; NONE if it makes none."""
        keys = a << 20 | b
        slot = self._slot(keys)
        out = np.full(len(keys), self.NONE, np.int64)
        left = np.arange(len(keys))
        while len(left):
            there = self.key[slot]
            hit = there == keys[left]
            out[left[hit]] = self.value[slot[hit]]
            more = ~hit & (there >= 0)
            left, slot = left[more], (slot[more] + 1) & self.mask
        return out

    def merge(self, slices: list[bytes]) -> list[np.ndarray]:
        """Ids of each slice; all slices of usual length together, a merge each per round."""
        out: list[np.ndarray] = [None] * len(slices)  # type: ignore[list-item]
        usual = []
        for i, s in enumerate(slices):
            if len(s) > 256:
                out[i] = self._merge_long(s)
            else:
                usual.append(i)
        if not usual:
            return out
        lens = np.array([len(slices[i]) for i in usual], np.int64)
        sym = self.byte_rank[np.frombuffer(b"".join([slices[i] for i in usual]), np.uint8)]
        word = np.repeat(np.arange(len(usual)), lens)
        rank = np.full(len(sym), self.NONE, np.int64)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        done_word, done_sym = [], []
        while len(sym):
            at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, at)
            live = low < self.NONE
            count = np.diff(np.r_[at, len(sym)])
            keep = np.repeat(live, count)
            if not live.all():
                done_word.append(word[~keep])
                done_sym.append(sym[~keep])
                sym, word, rank = sym[keep], word[keep], rank[keep]
                if not len(sym):
                    break
                low, count = low[live], count[live]
            hit = np.flatnonzero(rank == np.repeat(low, count))
            owner = word[hit]
            hit = hit[np.r_[True, owner[1:] != owner[:-1]]]  # leftmost of each slice
            sym[hit] = rank[hit]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            new = hit - np.arange(len(hit))  # its place after the removal
            sym, word, rank = sym[stay], word[stay], rank[stay]
            rank[new] = self.NONE
            right = new[(new + 1 < len(sym))]
            right = right[word[right] == word[right + 1]]
            rank[right] = self.rank(sym[right], sym[right + 1])
            left = new[new > 0] - 1
            left = left[word[left] == word[left + 1]]
            rank[left] = self.rank(sym[left], sym[left + 1])
        word = np.concatenate(done_word)
        sym = np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        sym, ends = sym[order], np.cumsum(np.bincount(word, minlength=len(usual)))
        sym, start = sym.astype(np.int32), 0
        for i, end in zip(usual, ends.tolist()):
            out[i] = sym[start:end].copy()  # a view would keep the whole batch in the cache
            start = end
        return out

    def _merge_long(self, s: bytes) -> np.ndarray:
        """One long slice, with a heap of pairs over a linked list."""
        sym = self.byte_rank[np.frombuffer(s, np.uint8)].tolist()
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1)
                if (r := self.pairs.get(sym[i] << 20 | sym[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := self.pairs.get(r << 20 | sym[k])) is not None:
                    heapq.heappush(heap, (q, i, r, sym[k]))
            if (h := before[i]) >= 0 and (q := self.pairs.get(sym[h] << 20 | r)) is not None:
                heapq.heappush(heap, (q, h, sym[h], r))
        return np.array([x for x in sym if x >= 0], np.int32)

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all slices, number of ids of each slice)."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        _, at, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        distinct = [raw[a:z] for a, z in zip(starts[at].tolist(), ends[at].tolist())]
        if len(self.index) + len(distinct) > self.cached:
            self._clear()
        missing = [s for s in distinct if s not in self.index]
        for s, ids in zip(missing, self.merge(missing)):
            self.index[s] = len(self.store)
            self.store.append(ids)
        got = [self.store[self.index[s]] for s in distinct]
        lens = np.array([len(x) for x in got], np.int64)
        flat, begin = np.concatenate(got), np.cumsum(lens) - lens
        n = lens[which]
        return gather(flat, begin[which], n), n

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.bytes, self.at[ids], self.length[ids])


def gather(flat: np.ndarray, begin: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The concatenation of ``flat[begin[i]:begin[i] + lens[i]]``."""
    to = np.cumsum(lens)
    total = int(to[-1]) if len(to) else 0
    return flat[np.arange(total) + np.repeat(begin - (to - lens), lens)]


def pre_tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans (starts, ends) of the pre-tokens of a slice of texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    char_at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.searchsorted(char_at, np.unique(off[:-1][off[1:] > off[:-1]]))
    starts = char_at[token_starts(classify(points, first))]
    return starts, np.r_[starts[1:], len(data)]


_MERGERS: dict[str, Merger] = {}


def _merger(path: str) -> Merger:
    if path not in _MERGERS:
        _MERGERS[path] = Merger(path)
    return _MERGERS[path]


def _encoded(batches: Iterator[pa.RecordBatch], path: str):
    """(rows, data, off, ids, first id of each text, ids of each slice, slice starts)"""
    m = _merger(path)
    for rows, data, off in text_slices(batches, "text"):
        starts, ends = pre_tokens(data, off)
        ids, n = m.encode(data, starts, ends)
        total = np.r_[0, np.cumsum(n)]
        yield m, rows, off, ids, total[np.searchsorted(starts, off)], starts, total


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for _, rows, off, ids, first, starts, total in _encoded(batches, path):
        slices = np.searchsorted(starts, off)
        text = np.repeat(np.arange(len(off) - 1), np.diff(slices))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.ListArray.from_arrays(first.astype(np.int32), pa.array(ids)),
             pa.ListArray.from_arrays(slices.astype(np.int32), pa.array((starts - off[text]).astype(np.int32))),
             pa.ListArray.from_arrays(slices.astype(np.int32),
                                      pa.array((total[:-1] - first[text]).astype(np.int32)))],
            names=["doc_id", "ids", "slice_byte", "slice_id"])


def byte_bpe_encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids; and by pre-token its first byte in the text and the index of its first id."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _encode(it, ranks),
                           "doc_id long, ids array<int>, slice_byte array<int>, slice_id array<int>")


def byte_bpe_decode(encoded: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the decoded bytes of its ids as column ``decoded``."""
    ship(encoded.sparkSession)

    def decode(batches):
        m = _merger(ranks)
        for b in batches:
            out = [m.decode(np.asarray(x.values, np.int64)).tobytes() if x.is_valid else None
                   for x in b.column(b.schema.get_field_index(ids_col))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())],
                                             names=[*b.schema.names, "decoded"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(decode, schema + ", decoded binary")


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for m, rows, _, ids, first, _, _ in _encoded(batches, path):
        whole = m.decode(ids)
        text = gather(m.digits, m.digits_at[ids], m.digits_length[ids])
        b_at = np.r_[0, np.cumsum(m.length[ids])][first]
        d_at = np.r_[0, np.cumsum(m.digits_length[ids])][first]
        sha = lambda x: hashlib.sha256(x).hexdigest()
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.diff(first), pa.int64()),
             pa.array([sha(text[a:max(a, z - 1)]) for a, z in zip(d_at[:-1], d_at[1:])]),
             pa.array([sha(whole[a:z]) for a, z in zip(b_at[:-1], b_at[1:])])],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def byte_bpe_digests(docs: DataFrame, ranks: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes they decode to."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _digests(it, ranks),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
