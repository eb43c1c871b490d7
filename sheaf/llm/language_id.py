"""Operator 7, language identification by rank-order n-gram profiles.

Letters are lower-cased; everything else counts as one blank between words. The n-grams of one to
three characters that lie in a word with at most its bordering blanks are counted. A language's profile is
its ``size`` most frequent n-grams in rank order, over all of its training texts; a text is given the
language whose profile has the least out-of-place distance to the text's own ``size`` most frequent
n-grams: the sum of rank differences, ``size`` for an n-gram that the profile lacks.

Training sums counts per (language, n-gram) inside each task before the shuffle, so a language or
source that holds most rows arrives as one row per n-gram and task. Only the profiles (``size`` rows
per language) reach the driver. Prediction is one pass over the texts without a shuffle.

Defined results: ``und`` with score 0 for a null or empty text, one without a letter, or when no
training text has a language; equal counts rank by n-gram, equal distances by language name; rows
without a language are predicted but teach nothing; a null id counts as the empty string in the
fold rule; rows that repeat are each predicted; other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.llm.common import fresh, ship, text_slices

UNKNOWN = "und"
_FOLD: list[np.ndarray] = []


def _folded() -> np.ndarray:
    """Lower-case code point of every letter, 0 for everything else."""
    if not _FOLD:
        table = np.zeros(0x110000, np.int64)
        for i in range(0x110000):
            c = chr(i)
            if unicodedata.category(c)[0] == "L":
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _FOLD.append(table)
    return _FOLD[0]


def text_grams(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The n-grams of each text of a slice, as integers (21 bits a character)."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    char_at = np.flatnonzero((data & 0xC0) != 0x80)
    fold = _folded()[points]
    first = np.searchsorted(char_at, off)
    out = []
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        c = np.zeros(z - a + 2, np.int64)
        c[1:-1] = fold[a:z]
        c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]  # one blank between words
        pair = c[:-1] << 21 | c[1:]
        triple = (pair[:-1] << 21 | c[2:])[c[1:-1] != 0]
        # A pair that starts with a blank would equal a single letter, a triple a pair: mark lengths.
        out.append(np.concatenate([c[c != 0], pair | 1 << 62, -triple]) if len(c) > 1
                   else np.zeros(0, np.int64))
    return out


def _ranked(grams: np.ndarray, size: int) -> np.ndarray:
    keys, n = np.unique(grams, return_counts=True)
    if len(keys) > size:  # a stable sort of 16-bit keys is a radix sort
        if n.max() < 1 << 16:
            order = np.argsort((65535 - n).astype(np.uint16), kind="stable")
        else:
            order = np.argsort(-n, kind="stable")
        return keys[order[:size]]
    return keys[np.argsort(-n, kind="stable")]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, grams: np.ndarray) -> None:
        keys, n = np.unique(grams, return_counts=True)
        if lang in total:
            both = np.concatenate([total[lang][0], keys])
            keys, where = np.unique(both, return_inverse=True)
            n = np.bincount(where, np.concatenate([total[lang][1], n])).astype(np.int64)
        total[lang] = keys, n

    for rows, data, off in text_slices(batches, "text"):
        grams: dict[str, list] = {}
        for lang, g in zip(rows.column("lang").to_pylist(), text_grams(data, off)):
            grams.setdefault(lang, []).append(g)
        for lang, gs in grams.items():
            add(lang, np.concatenate(gs))
    for lang, (keys, n) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)],
                                         names=["lang", "gram", "n"])


def train_profiles(docs: DataFrame, size: int = 300, text_col: str = "text",
                   lang_col: str = "lang") -> dict[str, list[int]]:
    """Language -> its ``size`` most frequent n-grams, most frequent first."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = (rows.mapInArrow(_count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    out: dict[str, list] = {}
    for r in top.collect():  # size rows per language
        out.setdefault(r["lang"], []).append((r["rank"], r["gram"]))
    return {lang: [g for _, g in sorted(v)] for lang, v in sorted(out.items())}


class Profiles:
    """Ranks of all profile n-grams as one table: a row per n-gram, a column per language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size, self.langs = size, list(profiles)
        self.keys = np.unique(np.array([g for p in profiles.values() for g in p] or [-1], np.int64))
        self.rank = np.full((len(self.keys) + 1, len(profiles)), -1, np.int32)
        for j, p in enumerate(profiles.values()):
            self.rank[np.searchsorted(self.keys, np.array(p, np.int64)), j] = np.arange(len(p))

    def predict(self, grams: np.ndarray) -> tuple[str, float]:
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        own = _ranked(grams, self.size)
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        at[self.keys[at] != own] = len(self.keys)
        rank = self.rank[at]
        off = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own), dtype=np.int32)[:, None]))
        far = off.sum(0)
        best = int(far.argmin())
        return self.langs[best], 1.0 - float(far[best]) / (self.size * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], size: int = 300, text_col: str = "text",
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two more columns, ``names``: the language, and a score (1: the text's n-grams rank
    as in the profile, 0: nothing in common)."""
    ship(docs.sparkSession)
    final = [*docs.columns, *names]
    # Positional names inside: Python tasks cannot be handed a column with a dot in its name.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = docs.columns.index(text_col)
    schema = T.StructType([*plain.schema.fields, T.StructField("lang", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Profiles(profiles, size)
        for rows, data, off in text_slices(batches, f"c{at}"):
            got = [table.predict(g) for g in text_grams(data, off)]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=[*rows.schema.names, "lang", "score"])
    return plain.mapInArrow(run, schema).toDF(*final)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2):
    """The fold rule: crc32 of the id as text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds == fold


def language_id(docs: DataFrame, size: int = 300, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"))
    profiles = train_profiles(rows.filter(~held_out()), size)
    out = predict(rows.select("doc_id", held_out().alias("held_out"), "text"), profiles, size)
    return out.drop("text")


def drop_unidentified(docs: DataFrame, size: int = 300, min_score: float = 0.0) -> DataFrame:
    """``docs`` without the rows whose language is unknown (or whose score is under ``min_score``).

    If no language could be learned, nothing tells texts apart: all with a letter stay.
    """
    profiles = train_profiles(docs.filter(~held_out()), size)
    if not profiles:
        profiles, min_score = {"": []}, 0.0
    lang, score = fresh("lang_pred", docs.columns), fresh("score", docs.columns)
    out = predict(docs, profiles, size, names=(lang, score))
    return out.filter((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
