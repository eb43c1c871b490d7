import collections
import math
import zlib

import numpy as np
import pytest

from sheaf.llm import katz as K


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


class Plain:
    """The model in dictionaries."""

    def __init__(self, rows):
        self.docs = [(i, held(i), (t or "").encode().lower().split() + [None]) for i, t, *_ in rows]
        self.uni, self.bi, self.hist = collections.Counter(), collections.Counter(), collections.Counter()
        for _, out, w in self.docs:
            for h, x in zip(["<s>"] + w, w) if not out else ():
                self.uni[x] += 1
                self.bi[h, x] += 1
                self.hist[h] += 1
        self.n = sum(self.uni.values())
        d1, d2 = (K.good_turing([list(c.values()).count(r) for r in range(1, K.TRUSTED + 2)]) for c in (self.uni, self.bi))
        mass = lambda d, c: d[min(c, K.TRUSTED + 1)] * c
        seen = sum(mass(d1, c) for c in self.uni.values())
        whole = self.n + (seen >= self.n - 1e-9)
        self.word = lambda w: mass(d1, self.uni[w]) / whole if self.uni[w] else 1 - (seen / whole if whole else 0)
        total, below = collections.Counter(), collections.Counter()
        for (h, w), c in self.bi.items():
            total[h] += mass(d2, c)
            below[h] += self.word(w)
        self.d = {h: n + (total[h] >= n * (1 - 1e-12)) for h, n in self.hist.items()}
        self.a = {h: (1 - total[h] / self.d[h]) / (1 - below[h]) for h in self.hist}
        self.seen = lambda h, w: mass(d2, self.bi[h, w]) / self.d[h]

    def p(self, h, w):
        return self.seen(h, w) if self.bi[h, w] else self.a.get(h, 1.0) * self.word(w)

    def rows(self):
        for i, out, w in self.docs:
            base = sum(math.log10((self.uni[x] + 1) / (self.n + len(self.uni) + 1)) for x in w)
            score = sum(math.log10(self.p(h, x)) for h, x in zip(["<s>"] + w, w))
            yield i, out, len(w), sum(self.uni[x] > 0 for x in w), self.n, base, score


def same(got, rows):
    a = sorted(map(tuple, got), key=lambda r: (repr(r[0]), r[5]))
    b = sorted(Plain(rows).rows(), key=lambda r: (repr(r[0]), r[5]))
    assert [r[:5] for r in a] == [r[:5] for r in b]
    assert np.allclose([r[5:] for r in a], [r[5:] for r in b], rtol=1e-9)


def corpus(seed=0, n=150):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(f"{'W' if rng.random() < .1 else 'w'}{min(int(rng.zipf(1.4)), 400)}" for _ in range(rng.integers(0, 60))))
            for i in range(n)]


@pytest.mark.parametrize("tokens", [50, 1 << 20])
def test_matches_dictionaries(make, tokens):
    rows = corpus()
    same(K.katz_scores(make(rows).repartition(3), tokens).collect(), rows)


def test_every_distribution_sums_to_one():
    m = Plain(corpus(1))
    for h in list(m.hist)[:40] + ["never seen"]:
        assert sum(m.p(h, w) for w in m.uni) + m.p(h, b"\x00unknown") == pytest.approx(1, abs=1e-12)


def test_odd_rows(make, odd_rows):
    same(K.katz_scores(make(odd_rows)).collect(), odd_rows)


def test_empty_and_untrained(make):
    assert K.katz_scores(make([])).collect() == []
    only = [(i, "some words") for i in range(300) if held(i)][:3]
    got = K.katz_scores(make(only)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in got)
    same(K.katz_scores(make([(0, None), (1, None)])).collect(), [(0, None), (1, None)])


def test_beats_the_base_on_held_out_texts(make):
    rng = np.random.default_rng(2)
    follow = rng.integers(0, 300, (300, 3))
    rows = []
    for i in range(400):
        w = [int(rng.integers(0, 300))]
        for _ in range(40):
            w.append(int(follow[w[-1], rng.integers(0, 3)]) if rng.random() < 0.8 else int(rng.integers(0, 300)))
        rows.append((i, " ".join(f"w{x}" for x in w)))
    r = [x for x in K.katz_scores(make(rows)).collect() if x.held_out]
    assert sum(x.score for x in r) > sum(x.base_score for x in r)


def test_tables_are_written_and_weights_normalise(make):
    slices, counts, weights, model = K.katz_tables(make(corpus(3)))
    table = {}
    for r in weights.filter("slice = -1").collect():
        delta, w = K.expand(bytes(r.body))
        table |= dict(zip(np.cumsum(delta.astype(np.uint64), dtype=np.uint64).tolist(), w.tolist()))
    plain = Plain(corpus(3))
    assert sorted(table.values()) == pytest.approx(sorted([*plain.a.values(), *[1.0] * (len(table) - len(plain.a))]))
    assert model.tokens == plain.n and model.types == len(plain.uni)


def test_good_turing_discounts():
    d = K.good_turing([1000, 400, 200, 120, 80, 60])
    assert d[0] == 0 and all(0 < x < 1 for x in d[1:6]) and d[6] == 1
    assert K.good_turing([0] * 6).tolist() == [0, 1, 1, 1, 1, 1, 1]
