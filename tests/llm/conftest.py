import random

import pytest

TYPES = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = {"key": "1", "sha": "'s'", "part": "2", "bin": "3", "kept": "true", "score": "0.5", "lang_pred": "'zz'",
            "new_id": "7", "new_text": "'t'", "gone": "9", "root": "1", "slice": "4", "node": "5", "keep_id": "6",
            "a.b": "'dot'"}


@pytest.fixture
def make(spark):
    """Documents from (id, text[, lang]) rows, with extra columns whose names clash with inner ones."""
    def build(rows, clash=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, TYPES)
        return df.selectExpr("*", *[f"{v} AS `{k}`" for k, v in CLASHING.items()]) if clash else df
    return build


@pytest.fixture
def odd_rows():
    """Null, empty and blank texts, a null id, repeated rows, ties, and a very long text."""
    long = " ".join(random.Random(3).choices([f"w{i}" for i in range(500)], k=20_000))
    return [(1, None), (2, ""), (3, " \t\n "), (None, "a null id here"), (4, "same words in both"),
            (5, "same words in both"), (5, "same words in both"), (6, long), (7, long), (8, "x"), (9, "ünï çödé 漢字 😀")]
