"""Declared schemas for the six JSON-lines tables of the workload.

Declaring the schema skips Spark's inference pass (a full extra scan of every file) and pins types that
inference gets wrong: date-like text and "TRUE"/"FALSE" flags stay strings, counters are bigint.
Flat attribute and hour fields carry dotted names, as in the parsed input files.
"""

from __future__ import annotations

from pyspark.sql import types as T

DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Attribute fields the workload reads.
ATTRIBUTES = ("RestaurantsTakeOut", "RestaurantsDelivery", "BusinessAcceptsCreditCards",
              "RestaurantsPriceRange2", "BusinessParking")

# User compliment counters.
COMPLIMENTS = ("cool", "cute", "funny", "hot", "list", "more", "note", "photos", "plain", "profile",
               "writer")


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


S, L, D = T.StringType(), T.LongType(), T.DoubleType()

BUSINESS = _fields(
    [("business_id", S), ("name", S), ("address", S), ("city", S), ("state", S), ("postal_code", S),
     ("latitude", D), ("longitude", D), ("stars", D), ("review_count", L), ("is_open", L),
     ("categories", S)]
    + [(f"attributes.{a}", S) for a in ATTRIBUTES]
    + [(f"hours.{d}", S) for d in DAYS])

REVIEW = _fields([("review_id", S), ("user_id", S), ("business_id", S), ("stars", D), ("useful", L),
                  ("funny", L), ("cool", L), ("text", S), ("date", S)])

TIP = _fields([("user_id", S), ("business_id", S), ("text", S), ("date", S),
               ("compliment_count", L)])

CHECKIN = _fields([("business_id", S), ("date", S)])

COVID = _fields([("business_id", S), ("highlights", S), ("delivery or takeout", S),
                 ("Grubhub enabled", S), ("Call To Action enabled", S),
                 ("Request a Quote Enabled", S), ("Covid Banner", S),
                 ("Temporary Closed Until", S), ("Virtual Services Offered", S)])

USER = _fields([("user_id", S), ("name", S), ("review_count", L), ("yelping_since", S),
                ("useful", L), ("funny", L), ("cool", L), ("elite", S), ("friends", S),
                ("fans", L), ("average_stars", D)]
               + [(f"compliment_{c}", L) for c in COMPLIMENTS])

SCHEMAS: dict[str, T.StructType] = {"business": BUSINESS, "review": REVIEW, "tip": TIP,
                                    "checkin": CHECKIN, "covid": COVID, "user": USER}

# Casts applied to the user table (P1): counters to short, rating to float, signup text to date.
USER_CASTS: dict[str, str] = {"average_stars": "float",
                              **{f"compliment_{c}": "short" for c in COMPLIMENTS},
                              "cool": "short", "fans": "short", "funny": "short",
                              "review_count": "short", "useful": "short", "yelping_since": "date"}
