"""Operator 12, cross-tokenizer alignment with an identity-map fast path.

Tokenizer A is byte-level BPE over a space and the text, tokenizer B SentencePiece over the text (it adds the space
itself). Both cut the same bytes; where tokens of both end, the text is cut into groups, and tokens link where their
bytes overlap. Between two neighbouring ends (of either) lies exactly one link, so the union of the ends enumerates
the links.

Most groups are one token against one. ``identity`` maps an A id to the B id with the same bytes;
groups that hold just such a pair are counted in a vector as long as A's vocabulary, one per task. Only links of
other groups enter the pair shuffle, summed per slice of documents before.

Texts are encoded once. A slice (about a quarter of a million characters) is written as one row: per document its
numbers, the A ids of its identity links, and its other links as places in the slice's list of pairs. The totals come
back the same way: those of the identity pairs and the highest count of each B id are vectors of vocabulary length,
which go to every task (the vocabularies bound them); the counts of the other pairs are joined by pair with
the slices that hold them, each pair once per slice, and packed to one row per slice. A pair in every slice has as
many rows as there are slices, so no key is hot, and neither texts nor tokens are shuffled.

Defined results: null and empty texts, and texts whose joined A or B bytes are not a space and the text, have no
tokens (zeros, an empty ``groups_sha256``); ids are passed on, repeated or null; an empty table has no rows; special
tokens' strings are plain text; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import Scratch, ship, written
from sheaf.llm.exchange import narrow, widen
from sheaf.llm.packing import _byte_letters, encoder

_PAIR = 1 << 20  # a pair is a * _PAIR + b
_SLICE = 1 << 18  # characters of a slice (one document at least)


class Vocabularies:
    """Both tokenizers with the bytes of every token, by id."""

    def __init__(self, a_path: str, b_path: str):
        self.a: tiktoken.Encoding = encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        entries = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        size = max([*entries.values(), *special.values()]) + 1
        self.a_bytes = [b""] * size
        for t, i in entries.items():
            self.a_bytes[i] = t.encode() if t in special else bytes(letters[c] for c in t)
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.identity = identity_map(self.a_bytes, self.b_bytes, [self.b.is_byte(i) for i in range(len(self.b_bytes))])
        # An id with what follows it: more of its group's side, the other side, the next group, the end.
        self.written = [[f"{i}{end}" for end in (",", "|", ";", "")] for i in range(max(size, len(self.b_bytes)))]
        self.written = [x for one in self.written for x in one]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, none if either does not hold the bytes of a space and the text."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        raw = b" " + text.encode()
        b = self.b.encode(text, num_threads=1)
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return none, none
        a = self.a.encode_ordinary(" " + text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw:
            return none, none
        return np.array(a, np.int64), np.array(b, np.int64)


@lru_cache(maxsize=4)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def identity_map(a: list[bytes], b: list[bytes], fallback: list[bool]) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 if there is none; a piece goes before a byte token."""
    by_bytes: dict[bytes, int] = {}
    for i in sorted(range(len(b)), key=lambda i: (fallback[i], i)):
        by_bytes.setdefault(b[i], i)
    by_bytes.pop(b"", None)
    return np.array([by_bytes.get(x, -1) for x in a], np.int64)


class Links:
    """The links of one document: for each, the places of its A and B token and whether it is a group of its own."""

    def __init__(self, a: np.ndarray, b: np.ndarray, v: Vocabularies):
        ends_a, ends_b = np.cumsum(v.a_len[a]), np.cumsum(v.b_len[b])
        ends = np.union1d(ends_a, ends_b)
        self.a, self.b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.closes = (ends_a[np.minimum(self.a, len(a) - 1)] == ends) & (ends_b[np.minimum(self.b, len(b) - 1)] == ends)
        opens = np.r_[True, self.closes[:-1]][:len(ends)]
        self.group = np.cumsum(opens) - 1
        a_ids, b_ids = a[self.a], b[self.b]
        self.exact = opens & self.closes & (v.identity[a_ids] == b_ids)
        self.identical = a_ids[self.exact]
        self.pairs = a_ids[~self.exact] * _PAIR + b_ids[~self.exact]

    @property
    def n_groups(self) -> int:
        return int(self.closes.sum())

    def group_text(self, a: np.ndarray, b: np.ndarray, v: Vocabularies) -> str:
        """``a1,a2|b1;a3|b2,b3``."""
        side = np.r_[np.zeros(len(a), np.int64), np.ones(len(b), np.int64)]
        group = np.empty(len(a) + len(b), np.int64)
        group[self.a] = self.group
        group[len(a) + self.b] = self.group
        order = np.argsort(2 * group + side, kind="stable")
        group, side, ids = group[order], side[order], np.r_[a, b][order]
        end = np.full(len(ids), 3)
        end[:-1] = np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
        return "".join(map(v.written.__getitem__, (4 * ids + end).tolist()))


_PER_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_same", "n_other"]
_SLICES = ("slice long, " + ", ".join(f"{c} array<long>" for c in _PER_DOC)
           + ", groups_sha256 array<string>, groups array<string>, same binary, other binary, pairs binary, counts binary")


def _flat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *parts])


def _align(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, with_groups: bool) -> Iterator[pa.RecordBatch]:
    """One row per slice: its documents' numbers and links."""
    v = vocabularies(a_path, b_path)
    names = [c.split()[0] for c in _SLICES.split(", ")]
    docs: list[tuple] = []
    same: list[np.ndarray] = []
    other: list[np.ndarray] = []
    part = count = size = 0

    def flush() -> pa.RecordBatch:
        pairs, place, n = np.unique(_flat(other), return_inverse=True, return_counts=True)
        cols = [list(c) for c in zip(*docs)]
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + count], pa.int64()), *[pa.array([c], pa.list_(pa.int64())) for c in cols[:6]],
             *[pa.array([c], pa.list_(pa.string())) for c in cols[6:]],
             *[pa.array([narrow(x)], pa.binary()) for x in (_flat(same), place, pairs, n)]], names=names)

    for batch in batches:
        for p, doc, text in zip(batch.column(0), batch.column(1), batch.column(2)):
            part, text = p.as_py(), text.as_py() or ""
            a, b = v.encode(text)
            if len(a):
                links = Links(a, b, v)
                groups = links.group_text(a, b, v)
                same.append(links.identical)
                other.append(links.pairs)
                docs.append((doc.as_py(), len(a), len(b), links.n_groups, len(same[-1]), len(other[-1]),
                             hashlib.sha256(groups.encode()).hexdigest(), groups if with_groups else None))
            else:
                docs.append((doc.as_py(), 0, 0, 0, 0, 0, "", "" if with_groups else None))
            size += len(text)
            if size >= _SLICE:
                yield flush()
                docs, same, other, size, count = [], [], [], 0, count + 1
    if docs:
        yield flush()


def _count(batches: Iterator[pa.RecordBatch], identity: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(slice, pair, n): the irregular links of each slice, and a task's identity links under slice -1."""
    vector = np.zeros(len(identity), np.int64)

    def rows(slice_: int, pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), slice_, np.int64)), pa.array(pair), pa.array(n)],
                                          names=["slice", "pair", "n"])

    for batch in batches:
        for slice_, same, pairs, counts in zip(*(batch.column(i) for i in range(4))):
            vector += np.bincount(widen(same.as_py()), minlength=len(vector))
            yield rows(slice_.as_py(), widen(pairs.as_py()), widen(counts.as_py()))
    a = np.flatnonzero(vector)
    yield rows(-1, a * _PAIR + identity[a], vector[a])


def _pack(rows: pd.DataFrame, best: np.ndarray) -> pd.DataFrame:
    """Of one slice's pairs, in their order: the corpus counts, and which are the highest of their B id."""
    rows = rows.sort_values("pair")
    total = rows["total"].to_numpy(np.int64)
    top = total == best[rows["pair"].to_numpy(np.int64) % _PAIR]
    return pd.DataFrame({"of": [rows["slice"].iloc[0]], "totals": [narrow(total)], "tops": [np.packbits(top).tobytes()]})


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``n`` values."""
    run, end = np.r_[0, np.cumsum(values)], np.cumsum(n)
    return run[end] - run[end - n]


def _identical(batches: Iterator[pa.RecordBatch], totals: np.ndarray, top: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices with count_sum and n_best of the identity links in their place."""
    kind = pa.list_(pa.int64())
    for batch in batches:
        at, by = batch.schema.get_field_index("same"), batch.schema.get_field_index("n_same")
        count, best = [], []
        for n, raw in zip(batch.column(by), batch.column(at)):
            n, same = np.array(n.as_py(), np.int64), widen(raw.as_py())
            count.append(_sums(totals[same], n).tolist())
            best.append(_sums(top[same].astype(np.int64), n).tolist())
        batch = batch.drop_columns(["same", "n_same"])
        yield batch.append_column("count_sum", pa.array(count, kind)).append_column("n_best", pa.array(best, kind))


_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string, groups string")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of slices that have met the counts of their other pairs."""
    names = [c.split()[0] for c in _OUT.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
            col = {k: np.array(row[k], np.int64) for k in ("n_a", "n_b", "n_groups", "n_other", "count_sum", "n_best")}
            place = widen(row["other"])
            links = np.maximum(col["n_a"] + col["n_b"] - col["n_groups"], 0)
            if len(place):
                totals = widen(row["totals"])
                top = np.unpackbits(np.frombuffer(row["tops"], np.uint8), count=len(totals)).astype(np.int64)
                col["count_sum"] += _sums(totals[place], col["n_other"])
                col["n_best"] += _sums(top[place], col["n_other"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), *[pa.array(x) for x in (
                    col["n_a"], col["n_b"], col["n_groups"], links, col["n_best"], col["count_sum"])],
                 pa.array(row["groups_sha256"], pa.string()), pa.array(row["groups"], pa.string())], names=names)


def pair_counts(partial: DataFrame) -> DataFrame:
    """(pair, a, b, total) from the (slice, pair, n) rows of all slices and tasks."""
    a, b = F.floor(F.col("pair") / _PAIR).cast("int"), F.pmod(F.col("pair"), F.lit(_PAIR)).cast("int")
    return partial.groupBy("pair").agg(F.sum("n").alias("total")).select("pair", a.alias("a"), b.alias("b"), "total")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    (and the ``groups`` themselves)."""
    spark = docs.sparkSession
    ship(spark)
    v = vocabularies(a_path, b_path)
    identity = v.identity
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    slices = written(rows.mapInArrow(lambda it: _align(it, a_path, b_path, with_groups), _SLICES), "slices")
    with Scratch(spark) as tmp:
        partial = tmp.write(slices.select("slice", "same", "pairs", "counts").mapInArrow(
            lambda it: _count(it, identity), "slice long, pair long, n long"), "pairs")
        totals = tmp.write(pair_counts(partial), "totals")
        best = np.zeros(len(v.b_bytes), np.int64)  # of vocabulary length, as the next one
        for r in totals.groupBy("b").agg(F.max("total").alias("n")).toLocalIterator():
            best[r["b"]] = r["n"]
        known = spark.createDataFrame([(int(a) * _PAIR + int(b),) for a, b in enumerate(identity) if b >= 0],
                                      "pair long")
        same = np.zeros(len(v.a_bytes), np.int64)
        for r in totals.join(F.broadcast(known), "pair", "left_semi").select("a", "total").toLocalIterator():
            same[r["a"]] = r["total"]
        top = same == best[identity]
        looked = written(partial.filter("slice >= 0").join(totals.select("pair", "total"), "pair").groupBy("slice")
                         .applyInPandas(lambda g: _pack(g, best), "of long, totals binary, tops binary"), "slice-counts")
    names = ["slice", *_PER_DOC, "groups_sha256", "groups", "other"]
    kinds = dict(c.split() for c in _SLICES.split(", "))
    out = [c for c in names if c != "n_same"]
    schema = ", ".join(f"{c} {kinds[c]}" for c in out) + ", count_sum array<long>, n_best array<long>"
    half = slices.select(*names, "same").mapInArrow(lambda it: _identical(it, same, top), schema)
    done = half.join(looked, F.col("slice") == F.col("of"), "left").drop("of").mapInArrow(_finish, _OUT)
    return done if with_groups else done.drop("groups")
