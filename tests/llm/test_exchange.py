import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.llm import exchange as X


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(-5, 5)), max_size=150), st.integers(1, 5), st.sampled_from([4, 7]))
def test_pairs_of_shared_signatures_all_come_back(pairs, tasks, width):
    """Whatever the split into tasks: all pairs of signatures with several owners, and of no other."""
    way = X.Exchange(8, width)
    sig = np.array([p[0] for p in pairs], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own = np.array([p[1] for p in pairs], np.int64)
    rows = [r for t in range(tasks) if len(sig[t::tasks]) for r in way.pack(sig[t::tasks], own[t::tasks], t).to_pylist()]
    got = set()
    for _, g in pd.DataFrame(rows).groupby("bin") if rows else ():
        (s, o, several), (ds, do, dm) = way.unpack(g)
        at, n = X.groups(s)
        for a, k in zip(at, n):
            if len(set(o[a:a + k].tolist())) > 1:
                got |= set(zip(s[a:a + k].tolist(), o[a:a + k].tolist()))
        got |= set(zip(ds.tolist(), do.tolist()))
        assert (do >= dm).all()
    name = way.name(sig).view(np.int64)
    owners = {}
    for s, o in zip(name.tolist(), own.tolist()):
        owners.setdefault(s, set()).add(o)
    assert got == {(s, o) for s, os in owners.items() if len(os) > 1 for o in os}


def test_narrow_round_trip():
    for x in ([], [0], [5, 5], [-3, 1 << 40], [-(1 << 63), (1 << 63) - 1], list(range(300))):
        x = np.array(x, np.int64)
        assert X.widen(X.narrow(x)).tolist() == x.tolist()


def test_a_hot_signature_costs_its_bin_one_entry():
    way = X.Exchange(6, 4)
    batch = way.pack(np.full(50_000, 77, np.uint64), np.arange(50_000), 3).to_pandas()
    heads = batch[~batch["direct"]]
    assert len(heads) == 1 and len(X.widen(heads["own"].iloc[0])) == 1
    direct = batch[batch["direct"]]
    assert sum(len(X.widen(x)) for x in direct["own"]) == 50_000 and direct["bin"].nunique() > 2
