"""DuckDB SQL for the oracle check, written independently of the Spark plans.

``sql(body, *ctes)`` prefixes ``body`` with the named CTEs and everything they depend on. The
fixture CTEs come from ``sheaf.sources.fixtures.FIXTURE_SQL``; the staged CTEs below mirror the plan
stages (``biz`` = prepared business, ``hrs`` = with opening hours, ``rest`` = allow-list filtered,
``rev`` / ``chk`` / ``tipr`` / ``cov`` = rollups, ``feat`` = star join).
"""

from __future__ import annotations

from sheaf.operators.filters import DEFAULT_EXCLUSIONS
from sheaf.sources.fixtures import ACTIVITY_AS_OF, FIXTURE_EXCLUSIONS, FIXTURE_SQL, REVIEW_AS_OF
from sheaf.sources.schemas import ATTRIBUTES, DAYS


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def r2(e: str, scale: int = 2) -> str:
    """Half-up on the double's shortest decimal text, exact to 18 places; as it is beyond 1e20."""
    x = f"CAST({e} AS DOUBLE)"
    return (f"COALESCE(CAST(round(TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {scale}) AS DOUBLE), "
            f"{x})")


def as_bool_int(e: str) -> str:
    return (f"CASE WHEN lower(trim({e})) IN ('t','true','y','yes','1') THEN 1 "
            f"WHEN lower(trim({e})) IN ('f','false','n','no','0') THEN 0 END")


def _flag(e: str) -> str:
    return f"CASE WHEN {e} = 'False' OR {e} IS NULL THEN 0 ELSE 1 END"


_TAKE, _DELIV = '"attributes.RestaurantsTakeOut"', '"attributes.RestaurantsDelivery"'
_HOURS = [f"hours_{d}" for d in DAYS]
_CATS = [f"cat{i}" for i in range(1, 6)]
EXCLUSIONS = DEFAULT_EXCLUSIONS + FIXTURE_EXCLUSIONS


def _open(i: int) -> str:
    return f"TRY_CAST(split_part(split_part({_HOURS[i]}, '-', 1), ':', 1) AS SMALLINT)"


def _close(i: int) -> str:
    return f"TRY_CAST(split_part(split_part({_HOURS[i]}, '-', 2), ':', 1) AS SMALLINT)"


def _nulls(idx) -> str:
    return " + ".join(f"CAST(_o{i} IS NULL AS INTEGER)" for i in idx)


_DAYS_OPEN = f"(7 - ({_nulls(range(7))}))"
_MORNING = " + ".join(f"CASE WHEN _o{i} < 11 THEN 1 ELSE 0 END" for i in range(7))
_NIGHT = " + ".join(f"CASE WHEN _c{i} < 4 OR _c{i} > 18 THEN 1 ELSE 0 END" for i in range(7))


def _date_of_text(e: str) -> str:
    return f"TRY_CAST(split_part({e}, ' ', 1) AS DATE)"


def _days(as_of: str, e: str) -> str:
    return f"CAST(date_diff('day', CAST({e} AS DATE), DATE '{as_of}') AS INTEGER)"


STAGES: dict[str, tuple[str, tuple[str, ...]]] = {
    "biz": (f"""
SELECT business_id, name, address, city, state, postal_code, latitude, longitude, stars,
  review_count, is_open, categories,
  {_flag(_TAKE)} AS attributes_RestaurantsTakeOut,
  {_flag(_DELIV)} AS attributes_RestaurantsDelivery,
  {", ".join(f'"attributes.{a}" AS attributes_{a}' for a in ATTRIBUTES[2:])},
  {", ".join(f'"hours.{d}" AS hours_{d}' for d in DAYS)},
  CASE WHEN {_flag(_TAKE)} = 1 OR {_flag(_DELIV)} = 1 THEN 1 ELSE 0 END AS pseudo_target,
  {", ".join(f"trim(string_split(categories, ',')[{i}]) AS cat{i}" for i in range(1, 6))}
FROM business""", ("business",)),
    "tok": ("""
SELECT business_id, trim(t) AS category
FROM (SELECT business_id, unnest(string_split(categories, ',')) AS t FROM biz)""", ("biz",)),
    "topk": ("""
SELECT category, count(category) AS frequency FROM tok GROUP BY category
ORDER BY frequency DESC, category LIMIT 100""", ("tok",)),
    "allow": (f"""
SELECT category FROM topk WHERE category NOT IN ({", ".join(lit(e) for e in EXCLUSIONS)})""",
              ("topk",)),
    "hrs0": (f"""
SELECT *, {", ".join(f"{_open(i)} AS _o{i}" for i in range(7))},
  {", ".join(f"{_close(i)} AS _c{i}" for i in range(7))}
FROM biz""", ("biz",)),
    "hrs": (f"""
SELECT * EXCLUDE ({", ".join([f"_o{i}" for i in range(7)] + [f"_c{i}" for i in range(7)])}),
  CASE WHEN {_nulls(range(5))} > 0 THEN 0 ELSE 1 END AS Opens_All_Weekdays,
  CASE WHEN {_nulls(range(5, 7))} > 0 THEN 0 ELSE 1 END AS Opens_Weekends_sunday,
  {_DAYS_OPEN} AS Days_open,
  CASE WHEN {_DAYS_OPEN} = 0 THEN 1 ELSE 0 END AS no_info_open,
  COALESCE(({_MORNING}) / NULLIF({_DAYS_OPEN}, 0), CAST(0 AS DOUBLE)) AS Opened_morning,
  COALESCE(({_NIGHT}) / NULLIF({_DAYS_OPEN}, 0), CAST(0 AS DOUBLE)) AS Opened_night
FROM hrs0""", ("hrs0",)),
    "rest": (f"""
SELECT * FROM hrs WHERE {" OR ".join(f"{c} IN (SELECT category FROM allow)" for c in _CATS)}""",
             ("hrs", "allow")),
    "rev0": (f"""
SELECT *, cool + funny + useful AS total_votes, {_days(REVIEW_AS_OF, "date")} AS recency
FROM review""", ("review",)),
    "rev1": (f"""
SELECT business_id, {r2("avg(stars)")} AS avg_stars, count(DISTINCT review_id) AS nbr_reviews,
  CAST(sum(cool) AS BIGINT) AS total_cool, CAST(sum(funny) AS BIGINT) AS total_funny,
  CAST(sum(useful) AS BIGINT) AS total_useful, CAST(sum(total_votes) AS BIGINT) AS total_votes,
  {r2("avg(total_votes)")} AS avg_votes, min(recency) AS recent_review
FROM rev0 GROUP BY business_id""", ("rev0",)),
    "rev": (f"""
SELECT *, {", ".join(f"{r2(f'total_{v} / NULLIF(total_votes, 0)')} AS ratio_{v}"
                     for v in ("cool", "funny", "useful"))}
FROM rev1""", ("rev1",)),
    "chk": (f"""
SELECT business_id,
  CAST(date_diff('day', max({_date_of_text("date")}), DATE '{ACTIVITY_AS_OF}') AS INTEGER)
    AS "days_since last_check",
  count(date) AS nbr_checkin
FROM checkin GROUP BY business_id""", ("checkin",)),
    "tipr": (f"""
SELECT business_id, CAST(sum(compliment_count) AS BIGINT) AS compliment_count,
  CAST(date_diff('day', max({_date_of_text("date")}), DATE '{ACTIVITY_AS_OF}') AS INTEGER)
    AS "days_since last_tip"
FROM tip GROUP BY business_id""", ("tip",)),
    "cov": (f"""
SELECT business_id, max({as_bool_int('"delivery or takeout"')}) AS "delivery or takeout"
FROM covid GROUP BY business_id""", ("covid",)),
    "feat": (f"""
SELECT * EXCLUDE ({", ".join(_HOURS)})
FROM rest LEFT JOIN rev USING (business_id) LEFT JOIN chk USING (business_id)
  LEFT JOIN tipr USING (business_id) LEFT JOIN cov USING (business_id)""",
             ("rest", "rev", "chk", "tipr", "cov")),
}

_FIXTURE_NAMES = {"users": "user"}


def _definition(name: str) -> tuple[str, tuple[str, ...]]:
    if name in STAGES:
        return STAGES[name]
    return FIXTURE_SQL[_FIXTURE_NAMES.get(name, name)], ()


def sql(body: str, *ctes: str) -> str:
    """``WITH`` every CTE ``body`` needs (dependencies first), then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _definition(n)[1]:
            visit(d)
        order.append(n)

    for c in ctes:
        visit(c)
    if not order:
        return body.strip()
    parts = [f"{n} AS ({_definition(n)[0].strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


# Column kinds of the staged tables, for the per-column profiles: i = integer, f = floating, s = text.
BIZ_KINDS = ([("business_id", "i"), ("name", "s"), ("address", "s"), ("city", "s"), ("state", "s"),
              ("postal_code", "s"), ("latitude", "f"), ("longitude", "f"), ("stars", "f"),
              ("review_count", "i"), ("is_open", "i"), ("categories", "s"),
              ("attributes_RestaurantsTakeOut", "i"), ("attributes_RestaurantsDelivery", "i")]
             + [(f"attributes_{a}", "s") for a in ATTRIBUTES[2:]]
             + [(h, "s") for h in _HOURS] + [("pseudo_target", "i")] + [(c, "s") for c in _CATS])

FEAT_KINDS = ([(c, k) for c, k in BIZ_KINDS if not c.startswith("hours")]
              + [("Opens_All_Weekdays", "i"), ("Opens_Weekends_sunday", "i"), ("Days_open", "i"),
                 ("no_info_open", "i"), ("Opened_morning", "f"), ("Opened_night", "f"),
                 ("avg_stars", "f"), ("nbr_reviews", "i"), ("total_cool", "i"),
                 ("total_funny", "i"), ("total_useful", "i"), ("total_votes", "i"),
                 ("avg_votes", "f"), ("recent_review", "i"), ("ratio_cool", "f"),
                 ("ratio_funny", "f"), ("ratio_useful", "f"), ("days_since last_check", "i"),
                 ("nbr_checkin", "i"), ("compliment_count", "i"), ("days_since last_tip", "i"),
                 ("delivery or takeout", "i")])


def missing_sql(kinds, empty: bool) -> str:
    out = []
    for c, k in kinds:
        e = ident(c)
        cond = f"{e} IS NULL"
        if k == "f":
            cond += f" OR isnan({e})"
        elif k == "s":
            cond += f" OR COALESCE(isnan(TRY_CAST({e} AS DOUBLE)), false)"
            if empty:
                cond += f" OR {e} = ''"
        out.append(f"CAST(count_if({cond}) AS BIGINT) AS {ident(c)}")
    return ", ".join(out)


def share_sql(kinds) -> str:
    return ", ".join(f"1.0 - count({ident(c)}) / count(*) AS {ident(c)}" for c, _ in kinds)
