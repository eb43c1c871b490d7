import random
import zlib

import pytest

from sheaf.llm import language_id as L

ENDS = {"aa": ["tion", "ing", "the ", "of ", "and "], "bb": ["ung", "sch", "der ", "und ", "ß "], "cc": ["eau", "oi", "les ", "é ", "que "]}


def docs(n=240, seed=0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(list(ENDS))
        text = "".join(r.choice(ENDS[lang] + ["a", "e ", "n"]) for _ in range(r.randint(30, 200)))
        out.append((i, text, None if i % 10 == 0 else lang))
    return out


def plain_profile(texts, size):
    """The same counts, a word at a time."""
    import collections
    import unicodedata
    n = collections.Counter()
    for t in texts:
        low = "".join((c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] == "L" else " " for c in t)
        for w in low.split():
            n.update(w)
            p = f" {w} "
            n.update(p[i:i + 2] for i in range(len(p) - 1))
            n.update(p[i:i + 3] for i in range(len(p) - 2))
    return n


def test_counts_match_plain_code():
    import collections

    import numpy as np
    text = "Ab1c  éÉ ß-x\nİ 漢字漢 a"
    data = np.frombuffer(text.encode(), np.uint8)
    grams = L.text_grams(data, np.array([0, len(data)]))[0]
    assert sorted(collections.Counter(grams.tolist()).values()) == sorted(plain_profile([text], 0).values())


def test_held_out_accuracy(make):
    rows = docs()
    got = {r.doc_id: r for r in L.language_id(make(rows)).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[i].lang_pred, lang) for i, _, lang in rows if got[i].held_out and lang]
    assert len(held) > 20 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_learns_from_the_other_folds_only(make):
    rows = docs()
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    wrong = [(i, t, "xx" if i in held else lang) for i, t, lang in rows]
    got = lambda x: {r.doc_id: (r.lang_pred, r.score) for r in L.language_id(make(x)).collect()}
    assert got(rows) == got(wrong)


def test_odd_rows(make, odd_rows):
    rows = odd_rows + [(20, "123 ,.- 456"), (21, "٣٤")]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.language_id(make(rows)).collect()]
    assert len(got) == len(rows)
    assert {x for x in got if x[0] in (1, 2, 3, 20, 21)} == {(i, "und", 0.0) for i in (1, 2, 3, 20, 21)}
    assert L.language_id(make([])).collect() == []


def test_no_language_to_learn(make):
    assert {r.lang_pred for r in L.language_id(make([(1, "abc", None), (3, "def", None)])).collect()} == {"und"}


def test_profile_is_deterministic(make):
    a = L.train_profiles(make(docs()).repartition(7))
    assert a == L.train_profiles(make(docs()).repartition(2)) and all(len(p) <= 300 for p in a.values())


def test_filter_keeps_columns(make, odd_rows):
    df = make(docs() + [(1000, None), (1001, "12 34"), (1002, "Ωμέγα και άλφα", None)])
    out = L.drop_unidentified(df, min_score=0.1)
    assert out.columns == df.columns
    assert {r.doc_id for r in df.collect()} - {r.doc_id for r in out.collect()} == {1000, 1001, 1002}


def code(gram):
    """The integer that orders n-grams (see ``text_grams``)."""
    c = [0 if x == " " else ord(x) for x in gram]
    return c[0] if len(c) == 1 else (c[0] << 21 | c[1]) | 1 << 62 if len(c) == 2 else -(c[0] << 42 | c[1] << 21 | c[2])


def ranked(counts, size):
    return [g for g, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))[:size]]


def plain_language(rows, size):
    """Out-of-place distances with plain lists: {id: (language, score)}."""
    import collections
    counts = collections.defaultdict(collections.Counter)
    for i, text, lang in rows:
        if lang and text and zlib.crc32(str(i).encode()) % 4 != 2:
            counts[lang].update(plain_profile([text], 0))
    profiles = {lang: ranked(n, size) for lang, n in sorted(counts.items())}
    out = {}
    for i, text, _ in rows:
        own = ranked(plain_profile([text or ""], 0), size)
        far = {lang: sum(abs(k - p.index(g)) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(far, key=lambda x: (far[x], x)) if own and far else None
        out[i] = (best, 1 - far[best] / (size * len(own))) if best else ("und", 0.0)
    return out


@pytest.mark.parametrize("size", [5, 40, 300])
def test_language_and_distance_match_plain_code(make, size):
    """Also with profiles so short that ranks tie, equal distances and languages with equal profiles."""
    rows = docs(80, seed=size) + [(500, "", None), (501, "a", None), (502, "ing ung eau", None), (503, "12", None)]
    rows += [(600 + i, "same words here", lang) for i, lang in enumerate(["dd", "ee", "dd", "ee", "ff", "ff", "dd", "ee"])]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.language_id(make(rows), size).collect()}
    want = plain_language(rows, size)
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in want.items()}
    assert all(got[i][1] == pytest.approx(want[i][1], abs=1e-12) for i in got)
