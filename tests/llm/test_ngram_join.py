import collections
import random
import re

import numpy as np
import pytest

from sheaf.llm import ngram_join as J


def word_sets(rows, k):
    out = {}
    for i, t, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out[i] = (frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k
                  else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, k, num, den):
    sets = word_sets(rows, k)
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(root)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i) if i is not None else None) for i in sets}


def near_copies(seed, n=60, words=120, vocabulary=4000):
    """Groups of copies of all sizes, edited by none to a quarter of their words, and boilerplate."""
    r = random.Random(seed)
    notice = r.choices([f"n{i}" for i in range(50)], k=25)
    rows = []
    for _ in range(n):
        base = r.choices([f"v{i}" for i in range(vocabulary)], k=r.choice([2, 3, 5, 9, 10, 12, 20, 33, words, 3 * words]))
        for _ in range(r.choice([1, 1, 2, 4])):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                at = r.randrange(len(w))
                w[at:at + 1] = r.choice([[], [f"e{r.random()}"], [w[at], "ins"]])
            if r.random() < 0.3:
                at = r.randrange(len(w) + 1)
                w[at:at] = notice
            rows.append((len(rows), " ".join(w).title() if r.random() < 0.2 else "  ".join(w)))
    return rows


@pytest.mark.parametrize("k,num,den,seed", [(3, 90, 100, 1), (5, 80, 100, 2), (1, 80, 100, 3)])
def test_matches_all_pairs(make, k, num, den, seed):
    rows = near_copies(seed)
    got = {tuple(r) for r in J.ngram_components(make(rows), k, num, den).collect()}
    assert got == brute(rows, k, num, den)


def test_odd_rows(make, odd_rows):
    got = sorted(map(tuple, J.ngram_components(make(odd_rows)).collect()), key=repr)
    n = len(word_sets(odd_rows, 3)[6])
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 2, None), (4, 2, 4), (5, 2, 4), (5, 2, 4), (6, n, 6),
                          (7, n, 6), (8, 1, 8), (9, 2, 9)], key=repr)


def test_empty_table(make):
    assert J.ngram_components(make([])).collect() == []
    assert J.drop_near_duplicates(make([])).collect() == []


def test_chain_of_links_is_one_component(make):
    """Neighbours link, the ends do not: components follow links, not similarity to one document."""
    w = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(w[6 * i:6 * i + 200])) for i in range(30)]
    assert {r.component_id for r in J.ngram_components(make(rows)).collect()} == {0}


def test_near_copies_around_one_text(make):
    """A large group whose members differ from each other more than from the original."""
    r = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        w = list(base)
        for at in r.sample(range(150), r.choice([1, 2, 3])):
            w[at] = f"x{i}_{at}"
        rows.append((i, " ".join(w)))
    assert {tuple(x) for x in J.ngram_components(make(rows)).collect()} == brute(rows, 3, 90, 100)


def bridged(seed, n=40, vocabulary=14):
    """Copies of copies, so that groups are linked over few bridges."""
    r = random.Random(seed)
    base = r.sample(range(vocabulary), 8)
    texts = []
    for _ in range(n):
        w = set(base) if not texts or r.random() < 0.2 else set(r.choice(texts))
        for _ in range(r.randint(1, 3)):
            if r.random() < 0.5 and len(w) > 2:
                w.remove(r.choice(sorted(w)))
            else:
                w.add(r.randrange(vocabulary))
        texts.append(sorted(w))
    return [(i, " ".join(f"w{x}" for x in w)) for i, w in enumerate(texts)]


def test_bridged_groups_over_many_partitions(spark):
    rows = bridged(744)
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 20), "doc_id long, text string")
    got = {tuple(r) for r in J.ngram_components(docs, 1, 60, 100).collect()}
    assert got == brute(rows, 1, 60, 100)


def test_lists_of_several_components(spark):
    """The smallest pivot names the group, its component is the main one."""
    for root, of_five in (({5: 5, 6: 5, 7: 7, 8: 7}, 5), ({5: 5, 6: 5, 7: 2, 8: 2}, 5), ({5: 1, 6: 1, 7: 0, 8: 0}, 1)):
        rows = [(1, k, k, r, k in (5, 7)) for k, r in root.items()] + [(2, 5, 5, 5, True), (2, 6, 6, 5, False)]
        on = spark.createDataFrame(rows, "list long, k long, key long, root long, is_pivot boolean")
        assert [(r["list"], r["p"], r["main"]) for r in J._mixed(on).collect()] == [(1, 5, of_five)]


def long_copies(n, seed=3, words=1500, edits=40):
    """A group of long near copies that do not link, but for every fifth, which is close to the one before it."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        w = list(base) if i % 5 else list(rows[-1]) if rows else list(base)
        for at in r.sample(range(words), edits if i % 5 else 3):
            w[at] = f"x{i}_{at}"
        rows.append(w)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def test_large_groups_of_unlinked_copies_pass_on_few_rows(spark, make, monkeypatch):
    """Rows that leave the meetings follow the members and the pivots they share, not their pairs."""
    sizes = []
    plain = J.Scratch.write

    def write(self, df, name):
        out = plain(self, df, name)
        if name in ("near", "links"):
            sizes[-1].append(out.count())
        return out
    monkeypatch.setattr(J.Scratch, "write", write)
    for n in (20, 100):
        sizes.append([])
        got = {tuple(x) for x in J.ngram_components(make(long_copies(n)), 5, 80, 100).collect()}
        assert got == brute(long_copies(n), 5, 80, 100)
    near, *links = sizes[1]
    assert near < 50 * 100 and max(links) < 100


def test_meetings_find_all_links_across_components():
    """The members named by sketches, then joined by their sets, give the components of all pairs."""
    import pandas as pd
    rng = np.random.default_rng(4)
    for num, den in ((80, 100), (90, 100), (1, 2)):
        base = rng.integers(0, 2**63, 600, dtype=np.uint64)
        sets = []
        for _ in range(60):
            s = base.copy() if not sets or rng.random() < 0.3 else sets[rng.integers(len(sets))].copy()
            s = np.unique(np.r_[rng.permutation(s)[rng.integers(0, 60):], rng.integers(0, 2**63, rng.integers(0, 60), dtype=np.uint64)])
            sets.append(s)
        rows = [(1, 0, 0, side, i, len(s), i, J.wide_sketch(s, J.wide_bits(len(s), num, den)).tobytes(), s.view(np.int64))
                for side in (0, 1) for i, s in enumerate(sets) if side or i]
        g = pd.DataFrame(rows, columns=["p", "cl", "cr", "side", "key", "n", "root", "wide", "items"])
        near = J._near(g.drop(columns="items"), num, den)
        links = J._joined(near.merge(g[["key", "side", "items"]], on=["key", "side"]), num, den)
        root = list(range(len(sets)))

        def comps(pairs):
            root = list(range(len(sets)))

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x
            for a, b in pairs:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
            return [find(i) for i in root]
        every = [(a, b) for a in range(len(sets)) for b in range(a) if J.linked(sets[a], sets[b], num, den)]
        assert comps(list(zip(links.a, links.b))) == comps(every)
        assert len(links) < len(sets)


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (1, 2)])
def test_linked_sets_share_a_signature(num, den):
    """Pairs right at the threshold, of all sizes, on both sides of the boundary."""
    rng = np.random.default_rng(0)
    for boundary in (0, 12):
        plan = J.Plan(num, den, boundary)
        for a in [1, 2, 5, 9, 10, 11, 12, 13, 14, 15, 20, 40, 100, 333]:
            for b in sorted({a, a + 1, *list(plan.partners(a))[-1:]}):
                need = plan.need(a, b)
                if need > a:
                    continue
                for _ in range(20):
                    x = rng.integers(0, 2**63, a + b, dtype=np.uint64) * np.uint64(2)
                    s, t = np.unique(x[:a]), np.unique(np.r_[x[:need], x[a:a + b - need]])
                    assert set(J.signatures(s, plan).tolist()) & set(J.signatures(t, plan).tolist()), (a, b)


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(50):
        s = rng.integers(0, 2**63, 300, dtype=np.uint64)
        t = np.r_[s[rng.integers(0, 60):], rng.integers(0, 2**63, rng.integers(0, 60), dtype=np.uint64)]
        ham = np.bitwise_count((J.sketch(s) ^ J.sketch(t)).view(np.uint64)).sum()
        assert ham <= len(set(s.tolist()) ^ set(t.tolist()))


def test_wide_sketch_is_a_lower_bound_that_halves():
    rng = np.random.default_rng(2)
    for _ in range(30):
        s = np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64))
        t = np.unique(np.r_[s[rng.integers(0, 600):], rng.integers(0, 2**63, rng.integers(0, 600), dtype=np.uint64)])
        x, y = J.wide_sketch(s, 4096), J.wide_sketch(t, 8192)
        half = J._halved(y[None], 4096)[0]
        assert np.array_equal(half, J.wide_sketch(t, 4096))
        assert np.bitwise_count(x ^ half).sum() <= len(set(s.tolist()) ^ set(t.tolist()))


def test_boundary_follows_cost():
    assert J.least_cost_boundary({}, 90, 100) == 0
    sizes = collections.Counter({s: 1000 for s in range(1, 65)})
    x = J.least_cost_boundary(sizes, 90, 100)
    assert 3 <= x <= 30
    assert J.least_cost_boundary({40: 10}, 80, 100) < 40  # too many subsets: heavy


def test_drop_keeps_one_of_each_group(make):
    rows = near_copies(7)
    df = make(rows)
    out = J.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {i for i, _, c in brute(rows, 5, 80, 100) if i == c}


@pytest.mark.parametrize("turn", [1, -1])
def test_drop_tells_texts_with_one_id_apart(make, turn):
    w = [f"w{i}" for i in range(60)]
    rows = [(3, " ".join(w)), (5, " ".join(w[:-1])), (5, "some other text that is like none of them at all")][::turn]
    got = {(r.doc_id, r.text) for r in J.drop_near_duplicates(make(rows)).collect()}
    assert got == {rows[0][:2], rows[2][:2]} if turn == 1 else {rows[2][:2], rows[0][:2]}
