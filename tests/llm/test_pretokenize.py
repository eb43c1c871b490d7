import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as P
import tiktoken

from sheaf.llm import pretokenize as T

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())],
                                       names=["doc_id", "text"])
    return [x for b in T._encode(iter([batch]), PATH) for x in b.column("ids").to_pylist()]


def test_random_texts_match(reference):
    r = random.Random(1)
    parts = ["'", " ", "\n", "\t", "s", "t", "re", "ve", "ll", "m", "d", "a", "B", "é", "1", "²", "٣", "!", "-", "_", "漢",
             "\xa0", " ", "\u0085", "\x1c", "😀", "é", "'S", "the ", "  ", "​", "ⅷ"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(5000)]
    assert encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_long_slices_match(reference):
    texts = ["", "a" * 700 + "b" * 300, "=" * 3000, " " * 600 + "x", "\n" * 300, "ab" * 400, "漢字" * 500, "z" * 256, "z" * 257]
    assert encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_scan_does_not_depend_on_blocks():
    code = np.random.default_rng(0).integers(0, 8, 5000).astype(np.uint8)
    code[[0, 700, 701, 4999]] += T.FIRST
    want = T.token_starts(code, 1 << 13).tolist()
    assert all(T.token_starts(code, b).tolist() == want for b in (1, 2, 7, 256))


def test_query_over_odd_rows(make, odd_rows, reference):
    got = T.byte_bpe_digests(make(odd_rows), PATH).collect()
    want = []
    for i, t, *_ in odd_rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert T.byte_bpe_digests(make([]), PATH).collect() == []


def test_round_trip_and_offsets(make, odd_rows):
    enc = T.byte_bpe_encode(make(odd_rows), PATH)
    texts = sorted(((t or "").encode() for _, t, *_ in odd_rows))
    rows = T.byte_bpe_decode(enc, PATH).collect()
    assert sorted(bytes(r.decoded) for r in rows) == texts
    merger = T.Merger(PATH)
    for r in rows:
        for i, (byte, first) in enumerate(zip(r.slice_byte, r.slice_id)):
            end = r.slice_id[i + 1] if i + 1 < len(r.slice_id) else len(r.ids)
            part = merger.decode(np.array(r.ids[first:end], np.int64)).tobytes()
            assert bytes(r.decoded)[byte:byte + len(part)] == part


def test_cache_is_bounded(reference):
    m = T.Merger(PATH, cached=50)
    for i in range(20):
        texts = " ".join(f"w{i}x{j}" for j in range(40)).encode()
        data = np.frombuffer(texts, np.uint8)
        ids, _ = m.encode(data, *T.pre_tokens(data, np.array([0, len(data)])))
        assert ids.tolist() == reference.encode_ordinary(texts.decode()) and len(m.index) <= 80 + 40
