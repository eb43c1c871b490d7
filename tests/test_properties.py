"""Property tests: operators against plain-Python references on random input."""

import math
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sheaf.functions import round_half_up
from sheaf.operators.hours import opening_hours
from sheaf.operators.profile import exact_quantiles_multi

HOURS = [f"hours_{d}" for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                "Saturday", "Sunday")]
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _hour(text, side):
    """Reference parse: text before/after '-', then before ':', as a 16-bit integer."""
    if text is None:
        return None
    parts = text.split("-")
    if side >= len(parts):
        return None
    h = parts[side].split(":")[0]
    try:
        v = int(h.strip())
    except ValueError:
        return None
    return v if -32768 <= v <= 32767 else None


def _reference(week):
    opens = [_hour(d, 0) for d in week]
    closes = [_hour(d, 1) for d in week]
    days = sum(o is not None for o in opens)
    morning = sum(1 for o in opens if o is not None and o < 11)
    night = sum(1 for c in closes if c is not None and (c < 4 or c > 18))
    return (0 if any(o is None for o in opens[:5]) else 1,
            0 if any(o is None for o in opens[5:]) else 1,
            days, 1 if days == 0 else 0,
            morning / days if days else 0.0, night / days if days else 0.0)


day = st.one_of(st.none(), st.just(""), st.just("closed"),
                st.builds(lambda a, b, c: f"{a}:0-{b}:{c}", st.integers(0, 30), st.integers(0, 30),
                          st.sampled_from(["0", "30", "x"])),
                st.builds(lambda a: f"{a}:15", st.integers(0, 23)))


@SETTINGS
@given(st.lists(st.lists(day, min_size=7, max_size=7), min_size=1, max_size=6))
def test_opening_hours_match_reference(spark, weeks):
    df = spark.createDataFrame([tuple(w) for w in weeks], ", ".join(f"{h} string" for h in HOURS))
    got = [tuple(r)[7:] for r in opening_hours(df).collect()]
    for g, w in zip(got, weeks):
        want = _reference(w)
        assert g[:4] == want[:4]
        assert math.isclose(g[4], want[4]) and math.isclose(g[5], want[5])


@SETTINGS
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=20))
def test_round_half_up_matches_decimal(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    for g, x in zip(got, xs):
        assert g == float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=400), st.integers(5, 400),
       st.lists(st.floats(0.01, 1.0), min_size=1, max_size=4))
def test_exact_quantiles_match_sorting(spark, xs, max_exact, probs):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = exact_quantiles_multi(df, ["v"], probs, max_exact_rows=max_exact, accuracy=20)["v"]
    s = np.sort(np.array(xs, dtype=float))
    want = [s[min(len(s), max(1, math.ceil(p * len(s) - 1e-9))) - 1] for p in probs]
    assert got == want
