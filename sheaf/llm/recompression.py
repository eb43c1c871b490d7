"""Operator 5, substring dedup by recompression.

Every text is a sequence of word symbols. A round names the maximal runs of equal symbols, then splits
the symbols in two halves by a hash bit and names every adjacent (first half, second half) pair. A name
is a hash of what it stands for, so it is global without a dictionary: equal substrings of any two
documents get the same symbols in their interior, at every level. Each symbol also carries its context, the
span of words that its name and borders depend on; a symbol whose context lies inside a window is the same
in every occurrence of the window.

A window of ``window`` words is represented by one symbol of any level whose context it contains, together with that
context: the longest one, in letters and words of context (of several, the one whose context has the least hash), as
long symbols are rare and few are shared by chance. Two equal windows have the same representative, so only documents that share a representative with another text can share a window. They
are found by a packed shuffle of (symbol, text class) pairs, and only their windows are then verified:
the hash of all the window's words, with the smallest document that holds it, by a second packed
shuffle over those few.

Texts with the same words are one class, whose smallest document stands for it; in the others every
window is a repeat. A symbol or window that a third of all documents share is one entry per task in
its bin (see ``exchange``). Word and window identities are 64-bit hashes.

Defined results: a null, empty or blank text has no words; a text shorter than a window keeps all
of them; of rows that repeat an id and words, all have the same result, and those with the same id but
other words are told apart; a null id takes no part (nothing is removed from it, nor because of
it); other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import (Scratch, fan_out, fresh, mix, powers, ship, text_mark, text_slices, window_hashes, words,
                              written)
from sheaf.llm.exchange import SCHEMA, Exchange, by_owner, groups

_STEP = 0xD6E8FEB86659FD93  # base of the running hash over words, and its inverse modulo 2**64
_BACK = pow(_STEP, -1, 1 << 64)
_WORD = 16  # letters that a word of context counts for
_RUN = np.uint64(0xC2B2AE3D27D4EB4F)
_PAIR = np.uint64(0x165667B19E3779F9)


class Symbols:
    """Parallel arrays: name, words [s, e), context [cs, ce), and text number; ``first`` are the
    texts' first words. All four borders never decrease."""

    def __init__(self, name, s, e, cs, ce, doc, first):
        self.name, self.s, self.e, self.cs, self.ce, self.doc, self.first = name, s, e, cs, ce, doc, first

    def _inner(self) -> np.ndarray:
        """Whether a symbol and the next one are in the same text."""
        return self.doc[1:] == self.doc[:-1]

    def _beside(self) -> tuple[np.ndarray, np.ndarray]:
        """Context start of the symbol before and context end of the one after; outside the text at its
        borders, so that no window contains such a context."""
        inner = self._inner()
        before, after = self.first[self.doc] - 1, self.first[self.doc + 1] + 1
        before[1:][inner] = self.cs[:-1][inner]
        after[:-1][inner] = self.ce[1:][inner]
        return before, after

    def runs(self) -> Symbols:
        """Name the maximal runs. A run's context holds the different symbols on both sides."""
        if not len(self.name):
            return self
        new = np.r_[True, ~((self.name[1:] == self.name[:-1]) & self._inner())]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(new)] - 1
        n = (last - first + 1).astype(np.uint64)
        name = self.name[first]
        name = np.where(n > 1, mix(name + n * _RUN), name)
        before, after = self._beside()
        return Symbols(name, self.s[first], self.e[last], before[first], after[last], self.doc[first],
                       self.first)

    def pairs(self, level: int) -> Symbols:
        """Name adjacent (first half, second half) pairs; a symbol's half is a bit of its name."""
        if not len(self.name):
            return self
        left = (mix(self.name ^ np.uint64(level * 0x9E37)) & np.uint64(1)) == 0
        pair = np.zeros(len(left), bool)
        pair[:-1] = left[:-1] & ~left[1:] & self._inner()
        second = np.r_[False, pair[:-1]]
        before, after = self._beside()
        name, e, ce, cs = self.name.copy(), self.e.copy(), self.ce.copy(), self.cs.copy()
        at = np.flatnonzero(pair)
        name[at] = mix(self.name[at] * _PAIR + self.name[at + 1])
        e[at], ce[at] = self.e[at + 1], self.ce[at + 1]
        alone = ~pair & ~second
        ce[alone & left] = np.maximum(ce, after)[alone & left]  # it depends on the next one's half
        cs[alone & ~left] = np.minimum(cs, before)[alone & ~left]
        keep = ~second
        return Symbols(name[keep], self.s[keep], e[keep], cs[keep], ce[keep], self.doc[keep], self.first)

    def least(self, code: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
        """For each window, the least code of the symbols whose context it contains (all ones: none).

        They are neighbours, at most ``window`` of them: a range minimum over runs of 1, 2, 4, ... symbols.
        """
        none = ~np.uint64(0)
        lo = np.searchsorted(self.cs, starts)
        n = np.searchsorted(self.ce, starts + window, "right") - lo
        out = np.full(len(starts), none)
        run, size = code, 1
        while True:
            at = np.flatnonzero((n >= size) & (n < 2 * size))
            out[at] = np.minimum(run[lo[at]], run[lo[at] + n[at] - size])
            if not (n >= 2 * size).any():
                return out
            run = np.minimum(run[:-size], run[size:])
            size *= 2


def representatives(h: np.ndarray, size: np.ndarray, first: np.ndarray, window: int,
                    rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, symbol) of every window of the texts whose words ``h`` of ``size`` bytes start at ``first``."""
    n = np.diff(first)
    starts = np.flatnonzero(_window_starts(n, first, window, len(h)))
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(h))
    total = np.r_[0, np.cumsum(size)]
    run = np.r_[np.uint64(0), np.cumsum(h * powers(_STEP, len(h)))]
    back = powers(_BACK, len(h) + 1)

    def code(sym: Symbols) -> np.ndarray:
        """Rarest first, by letters and words of context, then by the hash of its context: 12 bits and 52."""
        a, z = np.maximum(sym.cs, 0), np.minimum(sym.ce, len(h))
        weight = total[sym.e] - total[sym.s] + _WORD * np.minimum(z - a, window // 2 + 1)
        short = (4095 - np.minimum(weight, 4095)).astype(np.uint64)
        return short << np.uint64(52) | mix((run[z] - run[a]) * back[a]) >> np.uint64(12)

    words_ = sym = Symbols(h, at, at + 1, at, at + 1, doc, first)
    got = np.full(len(starts), ~np.uint64(0))
    for level in range(1, rounds + 1):
        sym = sym.runs().pairs(level)
        got = np.minimum(got, sym.least(code(sym), starts, window))
    bare = np.flatnonzero(got == ~np.uint64(0))
    if len(bare):  # no context fits: a word of the window
        got[bare] = words_.least(code(words_), starts[bare], window)
    return starts, mix(got)


def _window_starts(n: np.ndarray, first: np.ndarray, window: int, total: int) -> np.ndarray:
    """Marks the words that start a window."""
    edge = np.zeros(total + 1, np.int32)
    long = n >= window
    np.add.at(edge, first[:-1][long], 1)
    np.add.at(edge, first[1:][long] - window + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _sha(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> str:
    return hashlib.sha256(b" ".join([raw[a:z] for a, z in zip(starts.tolist(), ends.tolist())])).hexdigest()


def _key(sha: str) -> int:
    return int(sha[:12], 16)


def _words_sha(data: np.ndarray, off: np.ndarray) -> tuple[list[int], list[str]]:
    """Number of words and the digest of the words joined by one space, of each text of a slice."""
    raw = data.tobytes()
    n, sha = [], []
    for a, z in zip(off[:-1].tolist(), off[1:].tolist()):
        w = raw[a:z].split()
        n.append(len(w))
        sha.append(hashlib.sha256(b" ".join(w)).hexdigest())
    return n, sha


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns after id and text (a mark of the text) are passed on."""
    for rows, data, off in text_slices(batches, "text"):
        n, sha = _words_sha(data, off)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), *rows.columns[2:]],
            names=["doc_id", "n_words", "sha", *rows.schema.names[2:]])


def _of_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose words have the digest ``sha``; others only have the id in common with it."""
    for rows, data, off in text_slices(batches, "text"):
        own = pa.array(_words_sha(data, off)[1], pa.string())
        yield rows.filter(pc.equal(own, rows.column("sha")))


def _symbols(batches: Iterator[pa.RecordBatch], window: int, rounds: int, way: Exchange,
             most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    sig: list[np.ndarray] = []
    key: list[np.ndarray] = []
    waiting = salt = 0
    for rows, data, off in text_slices(batches, "text"):
        salt = rows.column("part")[0].as_py() * 1009 + salt + 1
        w, e, h, first = words(data, off, lower=False)
        starts, got = representatives(h, e - w, first, window, rounds)
        if not len(starts):
            continue
        doc = np.searchsorted(first, starts, "right") - 1
        keep = np.r_[True, (got[1:] != got[:-1]) | (doc[1:] != doc[:-1])]
        raw = data.tobytes()
        keys = {d: _key(hashlib.sha256(b" ".join(raw[off[d]:off[d + 1]].split())).hexdigest())
                for d in np.unique(doc).tolist()}
        sig.append(got[keep])
        key.append(np.fromiter((keys[d] for d in doc[keep].tolist()), np.int64, int(keep.sum())))
        waiting += len(sig[-1])
        if waiting >= most:
            yield way.pack(np.concatenate(sig), np.concatenate(key), salt)
            sig, key, waiting = [], [], 0
    if waiting:
        yield way.pack(np.concatenate(sig), np.concatenate(key), salt)


def _shared(rows: pd.DataFrame, way: Exchange) -> pd.DataFrame:
    """(owner, sigs) for the symbols that two text classes or more hold."""
    (sig, own, several), (ds, do, _) = way.unpack(rows)
    at, count = groups(sig)
    many = (np.minimum.reduceat(own, at) < np.maximum.reduceat(own, at)) if len(at) else np.zeros(0, bool)
    some = many | (np.logical_or.reduceat(several, at) if len(at) else many)
    keep = np.repeat(some, count)
    return by_owner(np.concatenate([sig[keep], ds]), np.concatenate([own[keep], do]))


def _repeated(rows: pd.DataFrame, way: Exchange) -> pd.DataFrame:
    """(owner, sigs) for the windows that start in a smaller document too."""
    (sig, own, _), (ds, do, dm) = way.unpack(rows)
    at, count = groups(sig)
    later = own > np.repeat(np.minimum.reduceat(own, at), count) if len(at) else np.zeros(0, bool)
    direct = do > dm
    return by_owner(np.concatenate([sig[later], ds[direct]]), np.concatenate([own[later], do[direct]]))


def _suspect_windows(batches: Iterator[pa.RecordBatch], window: int, rounds: int, symbols: Exchange,
                     way: Exchange, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    sig: list[np.ndarray] = []
    own: list[np.ndarray] = []
    waiting = salt = 0
    for rows, data, off in text_slices(batches, "text"):
        salt = rows.column("part")[0].as_py() * 1009 + salt + 1
        w, e, h, first = words(data, off, lower=False)
        starts, got = representatives(h, e - w, first, window, rounds)
        got = symbols.name(got).view(np.int64)
        whole = window_hashes(h, window)
        cut = np.searchsorted(starts, first)
        ids = rows.column("doc_id").to_numpy()
        for i, sigs in enumerate(rows.column("sigs").to_pylist()):
            a, z = cut[i], cut[i + 1]
            known = np.frombuffer(b"".join(sigs), "<i8")
            hit = starts[a:z][np.isin(got[a:z], known)]
            sig.append(np.unique(whole[hit]))
            own.append(np.full(len(sig[-1]), ids[i], np.int64))
            waiting += len(sig[-1])
        if waiting >= most:
            yield way.pack(np.concatenate(sig), np.concatenate(own), salt)
            sig, own, waiting = [], [], 0
    if waiting:
        yield way.pack(np.concatenate(sig), np.concatenate(own), salt)


def _covered(h: np.ndarray, repeated: np.ndarray, window: int) -> np.ndarray:
    """Which words of one text a repeated window covers."""
    hit = np.isin(window_hashes(h, window).view(np.int64), repeated)
    edge = np.zeros(len(h) + 1, np.int64)
    edge[:len(hit)] += hit
    edge[window:window + len(hit)] -= hit
    return np.cumsum(edge[:-1]) > 0


def _remove(batches: Iterator[pa.RecordBatch], window: int, texts: bool) -> Iterator[pa.RecordBatch]:
    names = ["key", "doc_id", "n_removed", "kept_sha256", *["kept_text"] * texts]
    for rows, data, off in text_slices(batches, "text"):
        starts, ends, h, first = words(data, off, lower=False)
        raw = data.tobytes()
        out = []
        for i, sigs in enumerate(rows.column("sigs").to_pylist()):
            a, z = first[i], first[i + 1]
            gone = _covered(h[a:z], np.frombuffer(b"".join(sigs), "<i8"), window)
            kept = [raw[x:y] for x, y in zip(starts[a:z][~gone].tolist(), ends[a:z][~gone].tolist())]
            text = b" ".join(kept)
            out.append((int(gone.sum()), hashlib.sha256(text).hexdigest(), text.decode("utf-8", "replace")))
        yield pa.RecordBatch.from_arrays(
            [rows.column("key"), rows.column("doc_id"), pa.array([o[0] for o in out], pa.int64()),
             pa.array([o[1] for o in out]), *[pa.array([o[2] for o in out])] * texts], names=names)


def _changed(suspects: DataFrame, window: int, rounds: int, symbols: Exchange, whole: Exchange,
             texts: bool) -> DataFrame:
    """The suspects that lose words, as a written table."""
    repeats = (suspects.select("doc_id", "text", "sigs", F.spark_partition_id().alias("part"))
               .mapInArrow(lambda it: _suspect_windows(it, window, rounds, symbols, whole), SCHEMA)
               .groupBy("bin").applyInPandas(lambda g: _repeated(g, whole), "owner long, sigs binary")
               .groupBy(F.col("owner").alias("doc_id")).agg(F.collect_list("sigs").alias("sigs")))
    changed = (suspects.select("doc_id", "text", F.col("sha").alias("key")).hint("merge").join(repeats, "doc_id")
               .select("key", "doc_id", "text", "sigs")
               .mapInArrow(lambda it: _remove(it, window, texts), "key string, doc_id long, n_removed long, "
                           "kept_sha256 string" + ", kept_text string" * texts))
    return written(changed.dropDuplicates(["key"]), "changed")


def repeated_words(docs: DataFrame, window: int = 13, rounds: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", texts: bool = False) -> tuple[DataFrame, DataFrame]:
    """(all, changed): doc_id, n_words, n_removed, kept_sha256 of every row; and the same of the
    documents that stand for their class and lose words. With ``texts``, the first also has ``sha`` (of all
    words, the ``key`` of the second) and ``mark`` (of the text), the second ``kept_text``, the words left."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    mark = ["mark"] * texts
    rows = written(docs.select("*", *[text_mark("text").alias(c) for c in mark]).mapInArrow(
        _classes, "doc_id long, n_words long, sha string" + ", mark string" * texts), "words")
    key = F.conv(F.substring("sha", 1, 12), 16, 10).cast("long")
    classes = (rows.filter(f"doc_id IS NOT NULL AND n_words >= {window}").groupBy("sha")
               .agg(F.min("doc_id").alias("first")).withColumn("key", key))
    bits = max(8, min(20, (fan_out(spark) - 1).bit_length()))
    symbols, whole = Exchange(bits, 4), Exchange(bits, 7)
    shared = (docs.filter("doc_id IS NOT NULL").select("text", F.spark_partition_id().alias("part"))
              .mapInArrow(lambda it: _symbols(it, window, rounds, symbols), SCHEMA)
              .groupBy("bin").applyInPandas(lambda g: _shared(g, symbols), "owner long, sigs binary")
              .groupBy(F.col("owner").alias("key")).agg(F.collect_list("sigs").alias("sigs")))
    wanted = classes.join(shared, "key").select("first", "sha", "sigs")
    # Of every class that shares a symbol, the text of its smallest document.
    suspects = (docs.hint("merge").join(wanted, docs["doc_id"] == wanted["first"])
                .select("doc_id", "text", "sha", "sigs")
                .mapInArrow(_of_class, "doc_id long, text string, sha string, sigs array<binary>"))
    with Scratch(spark) as tmp:
        changed = _changed(tmp.write(suspects, "suspects"), window, rounds, symbols, whole, texts)
    # A copy of an earlier text loses everything; its class may lose words of its first document.
    first = written(classes.select("sha", "first").join(
        changed.select(F.col("key").alias("sha"), "n_removed", "kept_sha256"), "sha", "left"), "classes")
    out = rows.hint("merge").join(first, "sha", "left")
    copy = F.col("doc_id") > F.col("first")
    out = out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).when(F.col("doc_id") == F.col("first"), F.coalesce("n_removed", F.lit(0)))
        .otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest()))
        .when(F.col("doc_id") == F.col("first"), F.coalesce("kept_sha256", "sha")).otherwise(F.col("sha"))
        .alias("kept_sha256"), *(["sha", "mark"] if texts else []))
    return out, changed


def substring_dedup(docs: DataFrame, window: int = 13, rounds: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    return repeated_words(docs, window, rounds, id_col, text_col)[0]


def drop_repeats(docs: DataFrame, window: int = 13, rounds: int = 2) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (what is left is joined by single spaces) and
    ``n_chars``, where there is one, counted anew. Documents without a repeat are as they were;
    one that is a repeat as a whole stays with an empty text. Rows are found again by id and text, so texts
    that have an id in common are told apart."""
    every, changed = repeated_words(docs, window, rounds, texts=True)
    new_id, new, mark = (fresh(c, docs.columns) for c in ("new_id", "new_text", "mark"))
    left = changed.select(F.col("key").alias("sha"), "doc_id", "kept_text")
    # What loses words and did not stand for its class is a copy and loses all of them.
    cut = (every.filter("n_removed > 0").select("doc_id", "sha", F.col("mark")).distinct()
           .join(left, ["doc_id", "sha"], "left")
           .select(F.col("doc_id").alias(new_id), F.col("mark").alias(mark),
                   F.coalesce("kept_text", F.lit("")).alias(new)))
    out = docs.hint("merge").join(cut, (F.col("doc_id") == F.col(new_id)) & (text_mark("text") == F.col(mark)), "left")
    same = F.col(new_id).isNull()
    cols = {"text": F.when(same, F.col("text")).otherwise(F.col(new))}
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.when(same, F.col("n_chars")).otherwise(
            F.char_length(new).cast(docs.schema["n_chars"].dataType))
    return out.withColumns(cols).select(*[F.col(f"`{c}`") for c in docs.columns])
