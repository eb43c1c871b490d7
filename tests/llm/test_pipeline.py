import hashlib
import sys

import pytest

import corpus_pipeline as C
from sheaf.llm import queries as Q
from sheaf.llm.common import written

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_ngram_join import brute as near  # noqa: E402
from test_recompression import brute as repeats  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert [k.split("_")[0] for k in sorted(Q.QUERIES, key=lambda k: int(k[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]
    assert [n for n, _ in C.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "substring dedup", "packing"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first and after every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), "test")
        out.append(docs)
    return [{r.doc_id: r for r in d.collect()} if i < 5 else d.collect() for i, d in enumerate(out)]


def test_stages_against_plain_code(stages):
    docs, lang, exact, near_, cut, pieces = stages
    assert set(lang) == {i for i, r in docs.items() if any(c.isalpha() for c in r.text or "")}
    last = {}
    for i, r in lang.items():
        last[r.text] = max(last.get(r.text, i), i)
    assert set(exact) == set(last.values())
    rows = [(i, r.text) for i, r in exact.items()]
    assert set(near_) == {i for i, _, c in near(rows, 5, 80, 100) if i == c}
    want = {i: sha for i, _, _, sha in repeats([(i, r.text) for i, r in near_.items()], 13)}
    assert {i: hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() for i, r in cut.items()} == want
    assert {p.doc_id for p in pieces} == set(cut)


def test_all_but_the_last_return_the_columns_of_documents(spark, make, odd_rows):
    df = make(odd_rows)
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns and out.dtypes == df.dtypes
        out.collect()
    for _, stage in C.STAGES:
        stage(spark, make([]), SF).collect()


def test_language_stage_keeps_short_texts_and_those_of_rare_letters(make):
    plain = [(i, "the old bridge over the river and the new road to the town") for i in range(20)]
    short = [(90, "\u0416 12", None), (91, "\u6f22\u5b57", None), (92, "x", None)]
    rows = [*plain, *short, (93, "12 - 34"), (94, ""), (95, None)]
    got = {r.doc_id for r in C.identify_language(None, make(rows), SF).collect()}
    assert got == {i for i, *_ in plain + short}


def test_language_stage_without_a_language_to_learn(make):
    rows = [(i, t, None) for i, t in enumerate(["some text", "12", "\u6f22\u5b57", "", None])]
    assert {r.doc_id for r in C.identify_language(None, make(rows), SF).collect()} == {0, 2}


def test_run(spark, stages):
    """The whole run packs the ids of the documents that plain code keeps after the stages before."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*t.encode(r.text, add_special_tokens=False).ids, 1] for i, r in stages[4].items()}
    got = C.run(spark, SF).collect()
    for i, ids in want.items():
        pieces = sorted((p for p in got if p.doc_id == i), key=lambda p: p.start)
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids) == pieces[0].doc_tokens
        for p in pieces:
            raw = b"".join(x.to_bytes(4, "little") for x in ids[p.start:p.start + p.length])
            assert zlib.crc32(raw) == p.ids_crc32
    assert {p.doc_id for p in got} == set(want)
