"""Operator 11, line dedup: two Bloom filters, for hashes seen once and hashes seen twice.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of ``least`` code points
or more that occur in ``docs_least`` documents or more lose their lines everywhere but in the document with the
largest id that holds them.

1. Each scan task hashes its documents' distinct long keys and marks two positions of a global bit space
   per hash; it sends the positions of a range of that space to the range's task, packed, with a flag for those
   that it hit several times itself. A task of the range sets the bits it meets in the ``once`` filter, and those
   it finds set already in the ``twice`` filter. No bit space is ever whole in one place; its size follows the bytes of
   text, of which a long key takes ``least + 1`` at least, so the filters are never fuller than planned.
2. The ``twice`` filter is folded (positions modulo a smaller power of two, which loses no member) to a size in
   proportion to its members, that is, to the repeated lines. If this is within ``filter_bytes``, a second scan
   probes it. Lines that it does not know occur in one document: they stay and are not shuffled, and a
   document of such lines only is finished in the scan. Beyond that bound all long keys count as suspects, which
   gives the same result for one shuffle of the lines.
3. Suspects are confirmed exactly: (key, document) pairs are grouped by the key's text, counted by
   distinct documents, with the largest id. Keys that hold over a thousandth of all pairs (so, fewer than a thousand)
   meet their pairs in a broadcast join, the others in a shuffled one, so no key is hot there.
4. Only documents with suspects are joined with their dropped keys by id.

Defined results: null and empty texts are one empty line; all rows with one id are one document; rows with a
null id keep all their lines and count for no key; repeated lines of one document count once, and all
of them stay or go together; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import Scratch, fan_out, mix, ship, written
from sheaf.llm.exchange import narrow, widen

_STRIP = b" \t\n\x0b\x0c\r"
_BITS_PER_KEY = 16  # of the bit space, for two positions a key
_CHUNK = 20  # log2 of the bits in a row of the folded filter


def line_key(line: bytes) -> bytes:
    return line.strip(_STRIP).lower()  # of bytes: A-Z only


def long_keys(text: bytes, least: int) -> set[bytes]:
    """The distinct keys of a text that have ``least`` code points or more."""
    return {k for k in map(line_key, text.split(b"\n"))
            if len(k) >= least and (k.isascii() or len(k.decode()) >= least)}


def positions(h: np.ndarray, lg: int) -> np.ndarray:
    """The two positions of each hash in a space of ``2**lg`` bits."""
    shift = np.uint64(64 - lg)
    return np.stack([h >> shift, mix(h.copy()) >> shift]).astype(np.int64)


def _text(value: pa.Scalar) -> bytes:
    raw = value.as_buffer()
    return raw.to_pybytes() if raw is not None else b""


def _marks(batches: Iterator[pa.RecordBatch], least: int, lg: int, bits: int,
           most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """(range, positions, several): what a task saw, a row per range of the bit space."""
    held: list[int] = []

    def flush() -> pa.RecordBatch:
        pos, n = np.unique(positions(np.array(held, np.uint64), lg), return_counts=True)
        part = pos >> (lg - bits)
        used, at = np.unique(part, return_index=True)
        cuts = list(zip(at.tolist(), [*at[1:].tolist(), len(pos)]))
        inner = pos & ((1 << (lg - bits)) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array([narrow(inner[a:z]) for a, z in cuts], pa.binary()),
             pa.array([np.packbits(n[a:z] > 1).tobytes() for a, z in cuts], pa.binary())],
            names=["range", "positions", "several"])

    for b in batches:
        for t in b.column(0):
            held.extend(map(xxhash.xxh3_64_intdigest, long_keys(_text(t), least)))
            if len(held) >= most:
                yield flush()
                held = []
    if held:
        yield flush()


def _seen_twice(rows: pd.DataFrame, lg: int, bits: int) -> pd.DataFrame:
    """One range: the positions that were set more than once, from the two filters."""
    once = np.zeros(max(1, 1 << max(0, lg - bits - 3)), np.uint8)
    twice = np.zeros_like(once)
    for raw, several in zip(rows["positions"], rows["several"]):
        pos = widen(raw)
        byte, bit = pos >> 3, np.left_shift(1, pos & 7).astype(np.uint8)
        again = (once[byte] & bit) > 0
        again |= np.unpackbits(np.frombuffer(several, np.uint8), count=len(pos)).astype(bool)
        np.bitwise_or.at(twice, byte[again], bit[again])
        np.bitwise_or.at(once, byte, bit)
    found = np.flatnonzero(np.unpackbits(twice, bitorder="little"))
    found = found + (int(rows["range"].iloc[0]) << (lg - bits))
    return pd.DataFrame({"n": [len(found)], "positions": [narrow(found.astype(np.int64))]})


def _fold(batches: Iterator[pa.RecordBatch], lg: int) -> Iterator[pa.RecordBatch]:
    """(chunk, positions) of the filter folded to ``2**lg`` bits."""
    for b in batches:
        for raw in b.column(0):
            pos = np.unique(widen(raw.as_py()) & ((1 << lg) - 1))
            chunk, at = np.unique(pos >> _CHUNK, return_index=True)
            ends = [*at[1:].tolist(), len(pos)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.astype(np.int32)),
                 pa.array([narrow(pos[a:z] & ((1 << _CHUNK) - 1)) for a, z in zip(at.tolist(), ends)], pa.binary())],
                names=["chunk", "positions"])


def _or(rows: pd.DataFrame, lg: int) -> pd.DataFrame:
    chunk = np.zeros(1 << max(0, min(lg, _CHUNK) - 3), np.uint8)
    for raw in rows["positions"]:
        pos = widen(raw)
        np.bitwise_or.at(chunk, pos >> 3, np.left_shift(1, pos & 7).astype(np.uint8))
    return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "bits": [chunk.tobytes()]})


def repeat_filter(docs: DataFrame, least: int, lg: int, filter_bytes: int,
                  tmp: Scratch) -> tuple[int, Broadcast] | None:
    """(log2 of the bits, the broadcast bits) of the folded twice-seen filter of the texts' long keys, which is built
    over ``2**lg`` bits; None if it would take over ``filter_bytes``."""
    spark = docs.sparkSession
    bits = max(2, min(20, lg - 10, (fan_out(spark) - 1).bit_length()))
    marks = docs.select("text").mapInArrow(lambda it: _marks(it, least, lg, bits),
                                           "range int, positions binary, several binary")
    twice = tmp.write(marks.groupBy("range").applyInPandas(lambda g: _seen_twice(g, lg, bits),
                                                           "n long, positions binary"), "twice")
    members = twice.agg(F.sum("n")).first()[0] or 0
    small = min(lg, max(16, (8 * members).bit_length()))
    if 1 << small - 3 > filter_bytes:
        return None
    chunks = (twice.select("positions").mapInArrow(lambda it: _fold(it, small), "chunk int, positions binary")
              .groupBy("chunk").applyInPandas(lambda g: _or(g, small), "chunk int, bits binary"))
    out = np.zeros(1 << small - 3, np.uint8)
    for r in chunks.toLocalIterator():  # at most filter_bytes in all
        at = r["chunk"] << _CHUNK - 3
        out[at:at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return small, spark.sparkContext.broadcast(out)


def known(h: np.ndarray, lg: int, filter_: np.ndarray, space: int) -> np.ndarray:
    """Which hashes the folded filter holds."""
    pos = positions(h, space) & ((1 << lg) - 1)
    return ((filter_[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).all(0)


_SEEN = "doc_id long, n_lines long, suspect boolean, text string, keys array<string>"


def _suspects(batches: Iterator[pa.RecordBatch], least: int, space: int, held: tuple[int, Broadcast] | None,
              with_text: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            rows = b.slice(lo, 256)
            texts = [_text(t) for t in rows.column(1)]
            keys = [list(long_keys(t, least)) if i.is_valid else [] for i, t in zip(rows.column(0), texts)]
            if held is not None:
                flat = np.array([xxhash.xxh3_64_intdigest(k) for own in keys for k in own], np.uint64)
                hit = iter(known(flat, held[0], held[1].value, space).tolist())
                keys = [[k for k in own if next(hit)] for own in keys]
            some = [len(own) > 0 for own in keys]
            sent = [t.decode() if s or with_text else None for s, t in zip(some, texts)]
            sha = [None if s else t for s, t in zip(some, texts)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()),
                 pa.array(some, pa.bool_()), pa.array(sent, pa.string()),
                 pa.array([[k.decode() for k in own] for own in keys], pa.list_(pa.string())),
                 pa.array(sha, pa.binary())],
                names=["doc_id", "n_lines", "suspect", "text", "keys", "clean"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_lines, n_dropped, text) of documents with the keys that they lose."""
    for b in batches:
        out, gone = [], []
        for t, keys in zip(b.column(2), b.column(3)):
            lines = _text(t).split(b"\n")
            lost = {k.encode() for k in keys.as_py() or ()}
            stay = [ln for ln in lines if line_key(ln) not in lost] if lost else lines
            out.append(b"\n".join(stay).decode())
            gone.append(len(lines) - len(stay))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(gone, pa.int64()),
                                          pa.array(out, pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"])


def line_dedup(docs: DataFrame, least: int = 20, docs_least: int = 3, filter_bytes: int = 1 << 26,
               id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256 (and the kept ``text``)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with Scratch(spark) as tmp:
        named = rows.filter("doc_id IS NOT NULL")
        size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        space = max(16, (_BITS_PER_KEY * int(size) // (least + 1)).bit_length())
        held = repeat_filter(named, least, space, filter_bytes, tmp)
        seen = rows.mapInArrow(lambda it: _suspects(it, least, space, held, with_text), _SEEN + ", clean binary")
        digest = F.when(~F.col("suspect"), F.sha2("clean", 256)).alias("kept_sha256")
        seen = written(seen.select("doc_id", "n_lines", "suspect", "text", "keys", digest), "line-suspects")
        pairs = seen.filter("suspect").select("doc_id", F.explode("keys").alias("key"))
        total = seen.agg(F.sum(F.size("keys"))).first()[0] or 0
        found = tmp.write(pairs.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keep"))
                          .filter(F.col("n") >= docs_least), "lines")
        hot = F.col("n") * 1000 > total
        lost = pairs.join(F.broadcast(found.filter(hot)), "key").unionByName(
            pairs.join(found.filter(~hot), "key")).filter("doc_id <> keep")
        lost = written(lost.groupBy("doc_id").agg(F.collect_set("key").alias("lost")), "lost-lines")
    text = ["text"] if with_text else []
    clean = seen.filter("NOT suspect").select("doc_id", "n_lines", F.lit(0).cast("long").alias("n_dropped"),
                                              "kept_sha256", *text)
    cut = (seen.filter("suspect").select("doc_id", "n_lines", "text").join(lost, "doc_id", "left")
           .mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, text string"))
    return clean.unionByName(cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"),
                                        *text))


def drop_repeated_lines(docs: DataFrame, least: int = 20, docs_least: int = 3) -> DataFrame:
    """doc_id and the text without the lines that ``line_dedup`` drops."""
    return line_dedup(docs, least, docs_least, with_text=True).select("doc_id", "text")


SQL = r"""
WITH rows_ AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM rows_),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(k.doc_id <> f.keep, FALSE) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
