import hashlib
import random

import numpy as np
import pytest

from sheaf.llm import recompression as R
from sheaf.llm.common import words


def brute(rows, window):
    docs = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    first = {}
    for i, w in docs:
        for j in range(len(w) - window + 1 if i is not None else 0):
            k = tuple(w[j:j + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in docs:
        gone = np.zeros(len(w), bool)
        for j in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[j:j + window])] < i:
                gone[j:j + window] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def shared_passages(seed, n=80):
    r = random.Random(seed)
    pool = [r.choices([f"p{i}" for i in range(30)], k=r.choice([5, 12, 13, 14, 20, 60])) for _ in range(12)]
    pool += [["run"] * 40, ["run"] * 13, ["a", "b"] * 15, ["a", "b"] * 7]
    rows = []
    for i in r.sample(range(1000), n):
        w = []
        for _ in range(r.randint(0, 4)):
            w += r.choices([f"q{x}" for x in range(2000)], k=r.randint(0, 20)) if r.random() < 0.6 else []
            p = r.choice(pool)
            a = r.randrange(len(p))
            w += p[a:a + r.randint(1, 60)] if r.random() < 0.4 else p
        rows.append((i, r.choice([" ", "\n", " \t"]).join(w)))
    return rows


@pytest.mark.parametrize("window,rounds,seed", [(13, 2, 1), (13, 2, 2), (13, 4, 3), (5, 2, 4), (13, 1, 5), (1, 2, 6)])
def test_matches_brute_force(make, window, rounds, seed):
    rows = shared_passages(seed)
    got = R.substring_dedup(make(rows), window, rounds).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, window)


def test_odd_rows(make, odd_rows):
    got = R.substring_dedup(make(odd_rows)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(odd_rows, 13)


def test_empty_table(make):
    assert R.substring_dedup(make([])).collect() == []
    assert R.drop_repeats(make([])).collect() == []


def test_equal_windows_have_equal_representatives():
    """Whatever stands around a window, also runs that go on past its borders."""
    r = random.Random(0)
    for _ in range(300):
        core = r.choices("abcde", k=13) if r.random() < 0.6 else ["a"] * r.randint(5, 12) + ["b"] * 8
        core = core[:13]
        seen = set()
        for _ in range(6):
            before = r.choices("abcde", k=r.randint(0, 9)) if r.random() < 0.7 else [core[0]] * r.randint(0, 9)
            after = r.choices("abcde", k=r.randint(0, 9)) if r.random() < 0.7 else [core[-1]] * r.randint(0, 9)
            text = " ".join(before + core + after).encode()
            data = np.frombuffer(text, np.uint8)
            s, e, h, first = words(data, np.array([0, len(data)]), False)
            starts, got = R.representatives(h, e - s, first, 13, 3)
            seen.add(int(got[np.searchsorted(starts, len(before))]))
        assert len(seen) == 1


def test_a_hot_passage(spark):
    """A passage in a third of all documents, in many tasks."""
    hot = " ".join(f"h{i}" for i in range(50))
    rows = [(i, f"u{i} " * 5 + (hot if i % 3 == 0 else "") + f" v{i}" * 20) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    assert sorted(map(tuple, R.substring_dedup(df).collect()), key=repr) == brute(rows, 13)


def test_drop_repeats_edits_texts(make):
    rows = shared_passages(9)
    df = make(rows)
    out = R.drop_repeats(df)
    assert out.columns == df.columns
    want = {i: sha for i, _, _, sha in brute(rows, 13)}
    changed = {i for i, _, n, _ in brute(rows, 13) if n}
    before = dict(rows)
    for r in out.collect():
        assert hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() == want[r.doc_id]
        assert r.n_chars == len(r.text)
        assert r.doc_id in changed or r.text == before[r.doc_id]


@pytest.mark.parametrize("turn", [1, -1])
def test_texts_with_one_id_are_told_apart(make, turn):
    """(1, D), (5, A), (5, B): D holds A's passage, B has nothing to do with either."""
    passage = " ".join(f"p{i}" for i in range(17))
    a, b, d = f"x y {passage} z", " ".join(f"b{i}" for i in range(30)), f"{passage} and more words of its own"
    rows = [(1, d), *[(5, a), (5, b)][::turn]]
    got = sorted(map(tuple, R.substring_dedup(make(rows)).collect()), key=repr)
    assert got == brute(rows, 13)
    cut = {(r.doc_id, r.text) for r in R.drop_repeats(make(rows)).collect()}
    assert cut == {(1, d), (5, "x y z"), (5, b)}
