import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sheaf.llm import packing as K

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokens():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 63), max_size=60))
def test_assign_places_every_id_once_without_padding(lengths):
    size, lengths = 64, np.array(lengths, np.int64)
    rows = K.assign(lengths, size)
    for i, n in enumerate(lengths.tolist()):
        cuts = sorted((s, k) for p, s, k, _, _ in rows if p == i)
        assert [s for s, _ in cuts] == np.cumsum([0, *[k for _, k in cuts]])[:-1].tolist() and sum(k for _, k in cuts) == n
    fill = {}
    for _, _, k, seq, offset in sorted(rows, key=lambda r: (r[3], r[4])):
        assert offset == fill.get(seq, 0)
        fill[seq] = offset + k
    assert all(n <= size and n & (n - 1) == 0 for n in fill.values())


def test_assign_balances_cost():
    lengths = np.array([1000] * 8 + [24] * 200)
    rows = K.assign(lengths, 2048)
    cost = {}
    for _, _, n, seq, _ in rows:
        cost[seq] = cost.get(seq, 0) + n + n * n / 2048
    full = sorted(cost.values())[-int(lengths.sum()) // -2048 - 1:]
    assert max(full) < 1.5 * np.mean(full)


def check(rows, docs, tokens):
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0) and r.length > 0
        fill[r.sequence_id] = r.offset + r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in fill.values())
    ids = {i: np.array(tokens(t) + [1], "<u4") for i, t, *_ in docs}
    covered = {}
    for r in sorted(rows, key=lambda r: (repr(r.doc_id), r.start)):
        want = ids[r.doc_id]
        assert r.doc_tokens == len(want) and r.ids_crc32 == zlib.crc32(want[r.start:r.start + r.length].tobytes())
        covered[r.doc_id] = covered.get(r.doc_id, 0) + r.length
    times = {i: sum(1 for d in docs if d[0] == i) for i in ids}
    assert covered == {i: len(x) * times[i] for i, x in ids.items()}


def test_odd_rows(make, odd_rows, tokens):
    check(K.pack(make(odd_rows).repartition(3), PATH).collect(), odd_rows, tokens)
    assert K.pack(make([]), PATH).collect() == []


def test_small_windows_and_specials(make, tokens):
    docs = [(i, f"text <|endoftext|> {'word ' * (i * 37 % 900)}") for i in range(40)]
    check(K.pack(make(docs), PATH, window=3000).collect(), docs, tokens)


def test_ids_are_kept_on_request(make, tokens):
    docs = [(1, "some text"), (2, "more " * 3000)]
    rows = sorted(K.pack(make(docs), PATH, with_ids=True).collect(), key=lambda r: (r.doc_id, r.start))
    assert sum((r.ids for r in rows if r.doc_id == 2), []) == tokens(docs[1][1]) + [1]
    with pytest.raises(ValueError):
        K.pack(make(docs), PATH, size=2000)


def test_encoder_equals_the_tokenizer(spark, tokens):
    enc = K.encoder(PATH)
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300).collect():
        assert K.encode(enc, r.text) == tokens(r.text)
    for t in ["'s 's don't I'LL", " \u0085\x1c\xa0　 x", "漢字 😀é", "<|endoftext|>", "\n\n  a\t\tb "]:
        assert K.encode(enc, t) == tokens(t)


@pytest.mark.parametrize("text", ["hi <|endoftext|> there", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext|", "a<|endoftext|>b "])
def test_special_tokens_in_a_text(tokens, text):
    assert K.encode(K.encoder(PATH), text) == tokens(text)
