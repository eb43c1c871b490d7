import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.llm import exact_dedup as X

COLS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_rows(make, odd_rows):
    got = X.exact_dedup(make(odd_rows)).select(COLS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(odd_rows)


def test_empty_table(make):
    assert X.exact_dedup(make([])).collect() == []
    assert X.drop_exact_duplicates(make([])).collect() == []


def test_hot_group(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id) END AS text")
    got = {r.doc_id: r for r in X.exact_dedup(df).collect()}
    assert got[0].keep_id == 2997 and got[0].group_size == 1000 and sum(r.kept for r in got.values()) == 2001


def test_drop_keeps_all_columns(make, odd_rows):
    df = make(odd_rows)
    out = X.drop_exact_duplicates(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {None, 3, 2, 5, 7, 8, 9}


@pytest.mark.parametrize("turn", [1, -1])
def test_a_text_stays_if_another_with_its_id_goes(make, turn):
    rows = [(5, "A"), (9, "A"), (5, "B"), (None, "A")][::turn]
    got = {(r.doc_id, r.text) for r in X.drop_exact_duplicates(make(rows)).collect()}
    assert got == {(9, "A"), (5, "B"), (None, "A")}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=200), st.integers(1, 7), st.integers(4, 10))
def test_filters_merge_without_loss(values, parts, bits):
    """Filters of any split, merged by sorted remainders, count like one filter of everything."""
    import pandas as pd
    fp = (np.array(values, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rows = [r for p in range(parts) if len(fp[p::parts]) for r in X._slots(fp[p::parts], bits).to_pylist()]
    found = {}
    if rows:
        for _, g in pd.DataFrame(rows).groupby("slot"):
            m = X._merge(g, bits)
            found |= dict(zip(m["fp"].to_numpy().view(np.uint64).tolist(), m["n"].tolist()))
    keys, n = np.unique(fp, return_counts=True)
    assert found == {int(k): int(c) for k, c in zip(keys, n) if c > 1}


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_equal_fingerprints_of_unlike_texts_are_told_apart(spark, sf, monkeypatch):
    """With a fingerprint that always collides, byte verification still decides."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(X.F, "xxhash64", lambda *_: F.lit(5).cast("long"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in X.exact_dedup(df).collect()} == {1: 3, 2: 2, 3: 3}


@pytest.mark.parametrize("filter_bytes", [1 << 26, 1 << 12, 1])
def test_with_and_without_a_filter(spark, filter_bytes):
    """A filter with room, one that is nearly half full, and none give the same rows."""
    rows = [(i, f"text {i % 1000 if i < 3000 else i}") for i in range(12_000)]
    if filter_bytes == 1 << 12:
        rows += [(20_000 + i, f"more {i % 13_000}") for i in range(26_000)]
    got = X.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), filter_bytes=filter_bytes)
    assert sorted(map(tuple, got.select(COLS).collect()), key=repr) == brute(rows)


def test_only_suspects_are_shuffled_as_texts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    out = X.exact_dedup(df)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(fp" not in plan and "hashpartitioning(text#" in plan and "BroadcastHashJoin" in plan


def test_filter_knows_its_hashes(spark):
    from sheaf.llm.common import KeyFilter
    from pyspark.sql import functions as F
    held = spark.range(0, 90_000, 3).select(F.xxhash64("id").alias("h"))
    known = KeyFilter.of(held, 30_000)
    rows = known.mark(spark.range(90_000).withColumnRenamed("id", "row"), F.xxhash64("row"), "hit").collect()
    assert rows[0].asDict().keys() == {"row", "hit"} and all(r.hit for r in rows if r.row % 3 == 0)
    assert sum(r.hit for r in rows if r.row % 3) < 0.05 * 60_000
    assert KeyFilter.of(held, 30_000, filter_bytes=4096) is None
    edges = spark.createDataFrame([(x,) for x in (-2**63, -1, 0, 32767, 32768, 2**63 - 1)], "h long")
    marked = KeyFilter.of(edges, 6).mark(edges, F.col("h"), "hit")
    assert all(r.hit for r in marked.collect())


def test_without_removes_by_id_and_text(spark):
    from sheaf.llm.common import text_mark, without
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(i if i % 10 else None, f"t{i}", i) for i in range(3000)], "gone int, hit string, place int")
    pick = docs.filter("place % 7 = 0").select(F.col("gone").cast("long"), text_mark("hit"))
    other = spark.createDataFrame([(1, "x")], "a long, b string")
    got = without(docs, "gone", "hit", pick.union(other))
    assert got.columns == docs.columns
    assert sorted(r.place for r in got.collect()) == [i for i in range(3000) if i % 10 == 0 or i % 7]
    assert without(docs, "gone", "hit", pick.limit(0)).count() == 3000
