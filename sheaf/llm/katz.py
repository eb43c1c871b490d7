"""Operator 8, language-model scoring: a Katz backoff bigram model.

Tokens are lower-cased words and one end per text; a text starts in a begin state. With Good-Turing
discounts d(r) (r up to ``TRUSTED``, from the counts of counts of the whole corpus):

    P(w)   = d1(c) c / N                        known words; the rest of the mass is one unknown word's
    P(w|h) = d2(c) c / D(h)                     c = count of h w, if it was seen
           = a(h) P(w)                          if not; a(h) makes the sum over all words exactly 1
    P(w|h) = P(w)                               after an unknown h

D(h) is the count of h, and one more where no count of h is discounted, so that a(h) > 0.

The corpus is cut into slices of about ``slice_tokens`` tokens, written once with a vocabulary of their own. A
slice sends its distinct words and bigrams, with counts, as packed sorted signatures to hash bins; the bins add
the counts and send each slice its totals back in the order it sent them. That written table is partitioned
by slice, n-gram order and bin. Each distinct bigram is owned by one slice, which adds its share to the
sums of its history; a second round of bins adds these up to backoff weights (a written table, partitioned by
bin) and returns them. Every token is then scored from these tables inside its slice. A word or pair that
fills a third of the corpus is one entry per slice, and memory is bounded by slices and bins.

Defined results: a null or empty text is one end token; rows that repeat all count; a null id counts as
the empty string in the fold rule and is passed on; without training text every token is the unknown
word (probability 1 in the unigram model); other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import Scratch, fan_out, mix, ship, text_slices, words, written

TRUSTED = 5  # counts above this are not discounted
END, BEGIN = np.uint64(0x1D8E4E27C47D124F), np.uint64(0xEB44ACCAB455D165)
_HISTORY = np.uint64(0x9E6C63D0876A3F6B)
WORD, PAIR, WEIGHT = 0, 1, 2  # kinds of table


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as zstd-compressed byte planes."""
    parts = []
    for a in arrays:
        if a.dtype.kind in "iu" and len(a):
            a = a.astype(np.min_scalar_type(int(a.max()))) if a.dtype.kind == "u" or a.min() >= 0 else a
        parts.append((a.dtype.str, len(a), np.ascontiguousarray(
            a.view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b""))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(parts))


def expand(raw: bytes) -> list[np.ndarray]:
    out = []
    for kind, n, body in pickle.loads(zstandard.ZstdDecompressor().decompress(raw)):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(body, np.uint8).reshape(size, n) if n else np.zeros((size, 0), np.uint8)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
    return out


def _delta(sig: np.ndarray) -> np.ndarray:
    return np.diff(sig, prepend=np.uint64(0))


class Slice:
    """Tokens of some texts over a vocabulary of their own (sorted by hash)."""

    def __init__(self, vocab: np.ndarray, tokens: np.ndarray, length: np.ndarray, held: np.ndarray,
                 ids: np.ndarray, null: np.ndarray):
        self.vocab, self.tokens, self.length = vocab, tokens, length
        self.held, self.ids, self.null = held, ids, null
        self.train = np.repeat(~held, length)
        first = np.cumsum(length) - length
        history = np.empty(len(tokens), np.int64)
        history[1:] = tokens[:-1]
        history[first] = len(vocab)  # the begin state
        self.history, self.first = history, first

    @staticmethod
    def pack(tokens: np.ndarray, length: np.ndarray, held: np.ndarray, ids: np.ndarray,
             null: np.ndarray) -> bytes:
        vocab, at, n = np.unique(tokens, return_inverse=True, return_counts=True)
        place = np.empty(len(vocab), np.int64)
        place[np.argsort(-n, kind="stable")] = np.arange(len(vocab))  # small numbers for frequent words
        return squeeze(_delta(vocab), n.astype(np.uint64), place[at].astype(np.uint64), length.astype(np.uint64),
                       held.astype(np.uint8), ids, null.astype(np.uint8))

    @staticmethod
    def load(raw: bytes) -> Slice:
        delta, n, code, length, held, ids, null = expand(raw)
        order = np.argsort(-n.astype(np.int64), kind="stable")
        return Slice(np.cumsum(delta.astype(np.uint64), dtype=np.uint64), order[code], length.astype(np.int64),
                     held.astype(bool), ids.astype(np.int64), null.astype(bool))

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.vocab))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct bigrams by signature: (signature, history, word), and which one each token is."""
        v = len(self.vocab)
        code, at = np.unique(self.history * (v + 1) + self.tokens, return_inverse=True)
        h, w = np.divmod(code, v + 1)
        sig = mix(self.history_hash()[h] * _HISTORY + self.vocab[w])
        order = np.argsort(sig)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return sig[order], h[order], w[order], place[at]

    def history_hash(self) -> np.ndarray:
        return np.append(self.vocab, BEGIN)


def _cut(sig: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bin, from, to) of the runs of sorted signatures."""
    bins, at = np.unique(sig >> np.uint64(64 - bits), return_index=True)
    yield from zip(bins.tolist(), at.tolist(), [*at[1:].tolist(), len(sig)])


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    waiting = number = part = 0

    def flush() -> pa.RecordBatch:
        tokens, length, out, ids, null = (np.concatenate(x) for x in zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 24) + number], pa.int64()),
             pa.array([Slice.pack(tokens, length, out, ids, null)], pa.binary())], names=["slice", "body"])

    for rows, data, off in text_slices(batches, "text"):
        part = rows.column("part")[0].as_py()
        _, _, h, first = words(data, off, lower=True)
        ids = rows.column("doc_id")
        held.append((np.insert(h, first[1:], END), np.diff(first) + 1,
                     rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool),
                     ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
        waiting += len(held[-1][0])
        if waiting >= most:
            yield flush()
            held, waiting, number = [], 0, number + 1
    if held:
        yield flush()


_SENT = "slice long, kind int, bin int, body binary"


def _rows(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in names.split(", ")]
    cols = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)],
                                      names=[n for n, _ in fields])


def _send_counts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for number, body in zip(b.column("slice").to_pylist(), b.column("body")):
            s = Slice.load(body.as_py())
            sig, _, _, which = s.pairs()
            n = np.bincount(which[s.train], minlength=len(sig))
            out = []
            for kind, keys, counts in ((WORD, s.vocab, s.word_counts()), (PAIR, sig, n)):
                counts = counts.astype(np.uint64)
                out += [(number, kind, i, squeeze(_delta(keys[a:z]), counts[a:z])) for i, a, z in _cut(keys, bits)]
            yield _rows(out, _SENT)


def _merged(bodies: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, start of each group, group length, where each sender ends) of sorted signature lists."""
    sig = np.concatenate([np.cumsum(x[0].astype(np.uint64), dtype=np.uint64) for x in bodies])
    order = np.argsort(sig, kind="stable")
    sig = sig[order]
    at = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    return order, at, np.diff(np.r_[at, len(sig)]), np.cumsum([len(x[0]) for x in bodies])


def _add_counts(g: pd.DataFrame) -> pd.DataFrame:
    """Totals of one bin, sent back to each slice in its own order; with a row of counts of counts."""
    bodies = [expand(x) for x in g["body"]]
    order, at, n, ends = _merged(bodies)
    count = np.concatenate([x[1].astype(np.int64) for x in bodies])[order]
    total = np.add.reduceat(count, at)
    back, own = np.empty(len(order), np.int64), np.zeros(len(order), bool)
    back[order] = np.repeat(total, n)
    own[order[at]] = total > 0
    kind, number = int(g["kind"].iloc[0]), int(g["bin"].iloc[0])
    out = {"slice": [-1], "kind": [kind], "bin": [number], "body": [None],
           "stats": [[int(total.sum()), int((total > 0).sum()),
                      *np.bincount(np.minimum(total, TRUSTED + 2), minlength=TRUSTED + 3)[1:TRUSTED + 2].tolist()]]}
    start = 0
    for slice_, end in zip(g["slice"].tolist(), ends.tolist()):
        out["slice"].append(slice_)
        out["kind"].append(kind)
        out["bin"].append(number)
        out["body"].append(squeeze(back[start:end].astype(np.uint64), np.packbits(own[start:end])))
        out["stats"].append(None)
        start = end
    return pd.DataFrame(out)


def good_turing(n: list[int]) -> np.ndarray:
    """d(0) .. d(TRUSTED + 1) from the numbers n[0], n[1], ... of types seen once, twice, ..."""
    d = np.ones(TRUSTED + 2)
    d[0] = 0.0
    if n[0] > 0:
        common = (TRUSTED + 1) * n[TRUSTED] / n[0]
        for r in range(1, TRUSTED + 1):
            if n[r - 1] > 0 and n[r] > 0 and common < 1:
                x = ((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common)
                if 0 < x < 1:
                    d[r] = x
    return d


class Model:
    """The corpus-wide constants."""

    def __init__(self, stats: dict[int, list[int]]):
        self.tokens, self.types = stats.get(WORD, [0, 0])[:2]
        self.d1 = good_turing(stats[WORD][2:]) if self.tokens else np.ones(TRUSTED + 2)
        self.d2 = good_turing(stats[PAIR][2:]) if self.tokens else np.ones(TRUSTED + 2)
        # The discounted mass of all words; the unknown word has what is left.
        seen = self.tokens - sum((1 - self.d1[r]) * r * n for r, n in
                                 enumerate(stats[WORD][2:2 + TRUSTED], 1)) if self.tokens else 0.0
        self.whole = self.tokens + (0 if seen < self.tokens else 1)
        self.unknown = 1.0 - seen / self.whole

    def mass(self, c: np.ndarray, d: np.ndarray) -> np.ndarray:
        return d[np.minimum(c, TRUSTED + 1)] * c

    def word(self, c: np.ndarray) -> np.ndarray:
        """P(w) for words with training counts ``c``."""
        return np.where(c > 0, self.mass(c, self.d1) / self.whole, self.unknown)


def _returned(r: pd.DataFrame, kind: int) -> list[list[np.ndarray]]:
    part = r[r["kind"] == kind].sort_values("bin")
    return [expand(x) for x in part["body"]]


def _counts(r: pd.DataFrame, kind: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    got = _returned(r, kind)
    total = np.concatenate([x[0].astype(np.int64) for x in got]) if got else np.zeros(0, np.int64)
    own = np.concatenate([np.unpackbits(x[1], count=len(x[0])).astype(bool) for x in got]) if got else total > 0
    assert len(total) == n, "counts do not belong to the slice"
    return total, own


def _history_counts(s: Slice, words_: np.ndarray) -> np.ndarray:
    """Training counts of the histories: of each word, and of the begin state (one per text)."""
    ends = words_[np.searchsorted(s.vocab, END)]
    return np.append(words_, ends)


def _send_sums(s: pd.DataFrame, r: pd.DataFrame, model: Model, bits: int) -> pd.DataFrame:
    """For each history of a slice: its count, and the sums over the bigrams that the slice owns."""
    out: dict[str, list] = {"slice": [], "kind": [], "bin": [], "body": []}
    for number, body in zip(s["slice"].tolist(), s["body"]):
        x = Slice.load(body)
        c1, _ = _counts(r, WORD, len(x.vocab))
        sig, h, w, which = x.pairs()
        c2, own = _counts(r, PAIR, len(sig))
        size = len(x.vocab) + 1
        seen = np.bincount(h[own], model.mass(c2, model.d2)[own], size)
        below = np.bincount(h[own], model.word(c1)[w[own]], size)
        ask = np.zeros(size, bool)
        ask[h[c2 == 0]] = True
        keys = x.history_hash()
        order = np.argsort(keys)
        count = _history_counts(x, c1)[order].astype(np.uint64)
        keys, seen, below, ask = keys[order], seen[order], below[order], ask[order]
        for b, a, z in _cut(keys, bits):
            out["slice"].append(number)
            out["kind"].append(WEIGHT)
            out["bin"].append(b)
            out["body"].append(squeeze(_delta(keys[a:z]), count[a:z], seen[a:z], below[a:z], np.packbits(ask[a:z])))
    return pd.DataFrame(out)


def _weights(g: pd.DataFrame) -> pd.DataFrame:
    """Backoff weights of one bin: the table's own row (slice -1), and what each slice asks for."""
    bodies = [expand(x) for x in g["body"]]
    order, at, n, ends = _merged(bodies)
    count = np.concatenate([x[1].astype(np.int64) for x in bodies])[order][at]
    seen = np.add.reduceat(np.concatenate([x[2] for x in bodies])[order], at)
    below = np.add.reduceat(np.concatenate([x[3] for x in bodies])[order], at)
    plain = (seen >= count * (1 - 1e-12)) & (count > 0)  # no count was discounted
    with np.errstate(divide="ignore", invalid="ignore"):
        weight = np.where(count > 0, (1 - seen / (count + plain)) / (1 - below), 1.0)
    back, flag = np.empty(len(order)), np.empty(len(order), bool)
    back[order], flag[order] = np.repeat(weight, n), np.repeat(plain, n)
    number = int(g["bin"].iloc[0])
    sig = np.concatenate([np.cumsum(x[0].astype(np.uint64), dtype=np.uint64) for x in bodies])[order][at]
    out = {"slice": [-1], "kind": [WEIGHT], "bin": [number], "body": [squeeze(_delta(sig), weight)]}
    start = 0
    for slice_, end, x in zip(g["slice"].tolist(), ends.tolist(), bodies):
        ask = np.unpackbits(x[4], count=end - start).astype(bool)
        out["slice"].append(slice_)
        out["kind"].append(WEIGHT)
        out["bin"].append(number)
        out["body"].append(squeeze(np.packbits(flag[start:end]), x[4], back[start:end][ask],
                                   np.array([end - start], np.uint64)))
        start = end
    return pd.DataFrame(out)


_RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double")


def _score(s: pd.DataFrame, r: pd.DataFrame, model: Model) -> pd.DataFrame:
    parts = []
    for body in s["body"]:
        x = Slice.load(body)
        c1, _ = _counts(r, WORD, len(x.vocab))
        sig, h, w, which = x.pairs()
        c2, _ = _counts(r, PAIR, len(sig))
        plain, weight = [], []
        for flag, ask, alpha, n in _returned(r, WEIGHT):
            n = int(n[0])
            full = np.ones(n)
            full[np.unpackbits(ask, count=n).astype(bool)] = alpha
            plain.append(np.unpackbits(flag, count=n))
            weight.append(full)
        order = np.argsort(x.history_hash())
        size = len(x.vocab) + 1
        extra, alpha = np.empty(size, np.int64), np.empty(size)
        extra[order], alpha[order] = np.concatenate(plain), np.concatenate(weight)
        whole = _history_counts(x, c1) + extra
        p = model.word(c1)
        with np.errstate(divide="ignore", invalid="ignore"):
            pair = np.where(c2 > 0, model.mass(c2, model.d2) / whole[h], alpha[h] * p[w])
        token = np.log10(pair)[which]
        base = np.log10((c1 + 1) / (model.tokens + 1 * (model.types + 1)))
        total = lambda v: np.add.reduceat(v, x.first) if len(x.first) else v
        parts.append(pd.DataFrame({
            "doc_id": pd.array(np.where(x.null, 0, x.ids), "Int64").copy(), "held_out": x.held, "n_tokens": x.length,
            "n_known": total((c1 > 0)[x.tokens].astype(np.int64)), "train_tokens": model.tokens,
            "base_score": total(base[x.tokens]), "score": total(token)}))
        parts[-1].loc[x.null, "doc_id"] = pd.NA
    return pd.concat(parts) if parts else pd.DataFrame({f.split()[0]: [] for f in _RESULT.split(", ")})


def katz_tables(docs: DataFrame, slice_tokens: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text",
                folds: int = 7, fold: int = 2, write=written) -> tuple[DataFrame, DataFrame, DataFrame, Model]:
    """(slices, counts, weights, model): the written tables of the module text, and the constants."""
    spark = docs.sparkSession
    ship(spark)
    held = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("doc_id"),
                       held.alias("held_out"), F.col(text_col).alias("text"))
    bits = max(4, min(16, (fan_out(spark) - 1).bit_length()))
    slices = write(rows.mapInArrow(lambda it: _slices(it, slice_tokens), "slice long, body binary"), "slices")
    counts = write(
        slices.mapInArrow(lambda it: _send_counts(it, bits), _SENT).groupBy("kind", "bin")
        .applyInPandas(_add_counts, _SENT + ", stats array<long>"), "counts")
    stats = counts.filter("slice = -1").groupBy("kind").agg(
        *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(TRUSTED + 3)]).collect()  # two rows
    model = Model({r["kind"]: [int(v) for v in r[1:]] for r in stats})
    back = counts.filter("slice >= 0").select("slice", "kind", "bin", "body")
    sums = (slices.groupBy("slice").cogroup(back.groupBy("slice"))
            .applyInPandas(lambda a, b: _send_sums(a, b, model, bits), _SENT))
    weights = write(sums.groupBy("bin").applyInPandas(_weights, _SENT), "weights")
    return slices, back, weights, model


def katz_scores(docs: DataFrame, slice_tokens: int = 1 << 20, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    with Scratch(docs.sparkSession) as tmp:
        slices, counts, weights, model = katz_tables(docs, slice_tokens, id_col, text_col, write=tmp.write)
        back = counts.union(weights.filter("slice >= 0"))
        return written(slices.groupBy("slice").cogroup(back.groupBy("slice"))
                       .applyInPandas(lambda a, b: _score(a, b, model), _RESULT), "scores")
