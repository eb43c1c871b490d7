import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.llm import postorder_manifest as M

COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n_chars, text)])


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def tree(nodes):
    """(root, siblings of each leaf's path as (left, right) by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            run = at[i] // 8 * 8
            p.append((nodes[run:at[i]], nodes[at[i] + 1:run + 8]))
            at[i] //= 8
        nodes = [h(*nodes[k:k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r))) for g in langs}
    trees = {g: tree([leaf(*r) for r in own[g]]) for g in langs}
    if not rows:
        return []
    root, above = tree([trees[g][0] for g in langs])
    out = []
    for g, up in zip(langs, above):
        sub, paths = trees[g]
        for r, path in zip(own[g], paths):
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            now = leaf(*r[:4], lower(r[4])) if hit else leaf(*r)
            for left, right in path + up:
                now = h(*left, now, *right)
            proof = h(*[x for left, right in path + up for x in left + right])
            out.append((r[0], leaf(*r), sub, root, proof, now, now == root))
    return sorted(out, key=repr)


def run(df, **how):
    return sorted(map(tuple, M.proofs(df, M.tampered(df), **how).select(COLS).collect()), key=repr)


def as_rows(rows):
    return [(r[0], "s", r[2] if len(r) > 2 else "en", None if r[1] is None else len(r[1]), r[1]) for r in rows]


def test_odd_rows(make, odd_rows):
    rows = odd_rows + [(30, "Null LANG", None), (31, "Null LANG", None), (3, "UPPER", "Zz"), (6, "Ä É", "é"), (7, "x", "")]
    assert run(make(rows)) == brute(as_rows(rows))


def test_null_columns(spark):
    rows = [(1, None, None, None, None), (None, None, None, None, None), (3, "a", "b", -4, "T"), (12, "a", "b", None, "T")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert run(df) == brute(rows)


@pytest.mark.parametrize("n", [1, 9, 73])
def test_sizes(make, n):
    rows = [(i, f"Text {i}", "ab"[i % 7 == 0]) for i in range(n)]
    assert run(make(rows)) == brute(as_rows(rows))


def test_several_tiers(make):
    """With small segments, trees of one, two and three tiers, and many languages."""
    rows = [(i, f"Text {i}", "big") for i in range(150)] + [(i, f"T{i}", f"l{i % 11}") for i in range(200, 230)]
    rows += [(400 + i, "x", "mid") for i in range(9)]
    assert run(make(rows), size=8) == brute(as_rows(rows))


def test_empty_table(make):
    assert run(make([])) == []


def test_tampering_is_found(make):
    rows = [(i, "Capital" if i % 2 else "small") for i in range(40)]
    for r in M.proofs(make(rows), M.tampered(make(rows))).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0 or r.doc_id % 2 == 0)
    assert all(r.verified for r in M.proofs(make(rows)).collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700))
def test_places_are_those_of_the_append_log(n):
    """The closed form gives every node's place: the log read at those places is the tree built level by level."""
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    log = np.frombuffer(M.append_log(leaves, M.height(n)), np.uint8).reshape(-1, 32)
    level, taken = leaves, []
    for v in range(M.height(n) + 1):
        at = M.position(v, np.arange(len(level)), n)
        taken += at.tolist()
        assert [log[p].tobytes() for p in at] == level
        level = [M.digest(*level[k:k + 8]) for k in range(0, len(level), 8)]
    assert sorted(taken) == list(range(len(log)))


def test_log_entries(make):
    with M.Scratch(make([]).sparkSession) as tmp:
        trees, top = M.manifest(make([(i, f"t{i}") for i in range(20)]), tmp)
        rows = M.log_entries(trees).collect()
        assert len(rows) == 20 + 3 + 1 and sorted(r.place for r in rows) == list(range(24))
        assert max(rows, key=lambda r: r.place).digest == bytes(trees.subroots().first()["top"]).hex()
        assert top.subroots().count() == 1
