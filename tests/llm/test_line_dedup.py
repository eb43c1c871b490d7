import hashlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.llm import line_dedup as L
from sheaf.llm.common import mix

COLS = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows, least=20, docs_least=3):
    holders = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key_of(line)) >= least:
                holders.setdefault(key_of(line), set()).add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key_of(x), ())) < docs_least
                or max(holders[key_of(x)]) == i]
        text = "\n".join(kept)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df, **how):
    return sorted(map(tuple, L.line_dedup(df, **how).select(COLS).collect()), key=repr)


FOOT = "All rights reserved by the press."
ROWS = [(1, f"one\n{FOOT}\n{FOOT}"), (2, f"{FOOT.upper()}\t\ntwo"), (3, f" \x0b{FOOT}\r\n\nthree"), (9, FOOT),
        (4, "a line that two documents hold"), (5, "a line that two documents hold\n"), (6, "short\n" * 3), (7, "short"),
        (8, "short"), (10, "ÜBER DEN WOLKEN IST ALLES BLAU"), (11, "über den wolken ist alles blau"),
        (12, "Über den Wolken ist alles blau"), (13, "ÜBER den WOLKEN ist alles blau"), (14, "ÜBER den Wolken ist alles BLAU"),
        (15, "漢字漢字漢字漢字漢字漢字漢字"), (16, "漢字漢字漢字漢字漢字漢字漢字"), (17, "漢字漢字漢字漢字漢字漢字漢字")]


@pytest.mark.parametrize("filter_bytes", [1 << 26, 1], ids=["filter", "beyond its bound"])
def test_rules(make, filter_bytes):
    assert run(make(ROWS), filter_bytes=filter_bytes) == brute(ROWS)


@pytest.mark.parametrize("filter_bytes", [1 << 26, 1])
def test_odd_rows(make, odd_rows, filter_bytes):
    line = "a line of more than twenty code points"
    rows = odd_rows + [(20, line), (20, line), (21, line), (None, line), (None, line), (22, f"{line}\n{line}"), (22, "other")]
    assert run(make(rows), filter_bytes=filter_bytes) == brute(rows)


def test_null_and_repeated_ids_do_not_make_three(make):
    line = "a line of more than twenty code points"
    rows = [(1, line), (1, line), (1, line), (2, line), (None, line), (None, line)]
    assert run(make(rows)) == brute(rows)
    assert all(r[2] == 0 for r in run(make(rows)))


def test_empty_table(make):
    assert run(make([])) == []


def test_a_line_in_a_third_of_all_rows(spark):
    df = spark.range(6000).selectExpr(
        "id AS doc_id", "concat('own line number ', id, ' of this text\n', "
        "CASE WHEN id % 3 = 0 THEN 'the same boilerplate line\nx' ELSE 'x' END) AS text")
    got = {r.doc_id: r.n_dropped for r in L.line_dedup(df.repartition(8)).collect()}
    assert sum(got.values()) == 1999 and got[5997] == 0 and got[3] == 1


def test_only_suspects_are_shuffled(spark):
    """Lines of one document each stay out of the exact confirmation, but for the filter's few errors."""
    df = spark.range(4000).selectExpr("id AS doc_id", "concat('a line that only one text holds: ', sha2(string(id), 256)) AS text")
    with L.Scratch(spark) as tmp:
        space = 20
        lg, held = L.repeat_filter(df, 20, space, 1 << 26, tmp)
        h = np.array([L.xxhash.xxh3_64_intdigest(L.line_key(r.text.encode())) for r in df.collect()], np.uint64)
        assert L.known(h, lg, held.value, space).mean() < 0.05


def test_texts(make):
    got = {r.doc_id: r.text for r in L.drop_repeated_lines(make(ROWS)).collect()}
    assert got[1] == "one" and got[9] == FOOT and got[3] == "\nthree" and got[6] == "short\n" * 3


def test_sql_equals_brute_force():
    import duckdb
    con = duckdb.connect()
    docs = pd.DataFrame([(i, t) for i, t in ROWS + [(30, None), (31, "")]], columns=["doc_id", "text"])
    con.register("documents", docs)
    assert sorted(con.execute(L.SQL).fetchall(), key=repr) == brute(ROWS + [(30, None), (31, "")])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=40), min_size=1, max_size=5), st.integers(2, 4))
def test_filters_lose_no_repeat(tasks, bits):
    """Every hash that two tasks hold, or one task twice, is known to the folded filter."""
    lg = 16
    hashes = [mix(np.array(t, np.uint64) + np.uint64(1)) for t in tasks]
    marks = []
    for h in hashes:
        pos, n = np.unique(L.positions(h, lg), return_counts=True)
        for r in np.unique(pos >> (lg - bits)):
            own = pos >> (lg - bits) == r
            marks.append((int(r), L.narrow(pos[own] & ((1 << lg - bits) - 1)), np.packbits(n[own] > 1).tobytes()))
    twice = np.zeros(1 << lg, bool)
    rows = pd.DataFrame(marks, columns=["range", "positions", "several"])
    for _, g in rows.groupby("range"):
        twice[L.widen(L._seen_twice(g, lg, bits)["positions"][0])] = True
    small = 12
    folded = np.packbits(twice.reshape(-1, 1 << small).any(0), bitorder="little")
    values, n = np.unique(np.concatenate([np.array(t, np.uint64) for t in tasks]), return_counts=True)
    repeated = mix(values[n > 1] + np.uint64(1))
    assert L.known(repeated, small, folded, lg).all()
