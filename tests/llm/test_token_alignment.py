import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sheaf.llm import token_alignment as T
from sheaf.llm.packing import _byte_letters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B), _byte_letters()


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def tokens(text, tools):
    t, s, letters = tools
    if not text:
        return None
    a = t.encode(" " + text, add_special_tokens=False).ids
    pa = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
    b = s.encode(text)
    pb = []
    for i in b:
        p = s.id_to_piece(i)
        pb.append(bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
    raw = (" " + text).encode()
    return (a, b, spans(pa), spans(pb)) if b"".join(pa) == raw == b"".join(pb) else None


def brute(rows, tools):
    docs, total = [], Counter()
    for i, text, *_ in rows:
        got = tokens(text, tools)
        links = []
        if got:
            a, b, sa, sb = got
            links = [(a[x], b[y]) for x in range(len(a)) for y in range(len(b))
                     if sa[x][0] < sb[y][1] and sb[y][0] < sa[x][1]]
            total.update(links)
        docs.append((i, got, links))
    best = {}
    for (_, y), n in total.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for i, got, links in docs:
        if not got:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, sa, sb = got
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, lo = [], 0
        for c in cuts:
            groups.append(",".join(str(x) for x, (_, e) in zip(a, sa) if lo < e <= c) + "|"
                          + ",".join(str(y) for y, (_, e) in zip(b, sb) if lo < e <= c))
            lo = c
        out.append((i, len(a), len(b), len(groups), len(links), sum(total[x] == best[x[1]] for x in links),
                    sum(total[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    return sorted(map(tuple, T.align(df, A, B).select(COLS).collect()), key=repr)


def test_odd_rows(make, tools):
    long = " ".join(random.Random(3).choices(["straße", "token", "😀", "alignment", "x1"], k=400))
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a null id here"), (4, "same words in both"), (5, "same words in both"),
            (5, "same words in both"), (6, long), (7, "a ▁ here"), (8, "ünï çödé 漢字 😀"), (9, "<|endoftext|> <s> </s> <0x41>"),
            (10, "  two  spaces "), (11, "nul\x00 and \x01"), (12, "ﬁ ① Å"), (13, "A")]
    assert run(make(rows)) == brute(rows, tools)


def test_given_documents(spark, tools):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect() if len(r.text or "") < 1500]
    small = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(small) == brute(rows, tools)


def test_empty_table(make):
    assert run(make([])) == []


def test_a_text_in_a_third_of_all_rows(make, tools):
    rows = [(i, "the hot text of them" if i % 3 == 0 else f"other words {i}") for i in range(60)]
    assert run(make(rows)) == brute(rows, tools)


def test_groups_column(make):
    r = T.align(make([(1, "hello there")]), A, B, with_groups=True).first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256


def test_identity_map():
    assert T.identity_map([b"x", b"y", b"", b"zz"], [b"", b"x", b"x", b"zz"], [False, True, False, False]).tolist() == [2, -1, -1, 3]


def test_slices_are_bounded(spark, monkeypatch, tools):
    """Many slices give the result of one."""
    monkeypatch.setattr(T, "_SLICE", 40)  # on the driver; the workers keep theirs
    rows = [(i, f"piece {i} of the larger text with unusual wörds {i * 7919}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    slices = list(T._align(iter(df.selectExpr("0 AS part", "*").toArrow().to_batches()), A, B, False))
    assert len(slices) >= 30
    assert run(df) == brute(rows, tools)


def test_special_tokens_are_text(tools):
    v = T.vocabularies(A, B)
    a, b = v.encode("a <|endoftext|> b")
    assert 50256 not in a and b"".join(v.b_bytes[i] for i in b) == b" a <|endoftext|> b"
    assert np.array_equal(a, tools[0].encode(" a <|endoftext|> b", add_special_tokens=False).ids)
