"""Wavelet-matrix shards: round trips, rank and select, digests of whole tables."""

import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import odd_rows, SF
from groundsheet.llm import token_files
from groundsheet.llm.queries import QUERIES
from groundsheet.llm.wavelet import WaveletMatrix, build
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000])
@pytest.mark.parametrize("planes", [1, 5, 16, 20])
def test_wavelet_matrix(n, planes):
    draw = random.Random(n * 100 + planes)
    ids = [draw.randrange(min(1 << planes, 50)) for _ in range(n)]
    if n:
        ids[-1] = (1 << planes) - 1
    matrix = WaveletMatrix(build(np.array(ids, np.int64), planes))
    assert matrix.decode().tolist() == ids and len(matrix) == n
    assert [matrix.access(k) for k in range(n)] == ids
    for token in {*ids, 0, 3}:
        places = [k for k, x in enumerate(ids) if x == token]
        assert [matrix.select(token, k) for k in range(len(places))] == places
        assert matrix.count(token) == len(places)
        assert matrix.count(token, n // 3, 2 * n // 3) == sum(n // 3 <= p < 2 * n // 3 for p in places)
        with pytest.raises(IndexError):
            matrix.select(token, len(places))
    with pytest.raises(IndexError):
        matrix.access(n)


def test_words_encode_like_whole_texts():
    texts = [
        "Don't say “foo's”, 123abc!!!", "İSTANBUL ÀÉ é,x ½ x\x0by\x1cz", "a<|endoftext|>b <|startoftext|>", "!", " ! a ! ", "",
        "tab\there nbsp　wide", "word.) \"quoted\" it's we'll 'tis", "ß ſ K",
    ]
    import pyarrow as pa

    ids, counts = token_files.WordEncoder(PATH).encode(pa.array(texts))
    plain = [Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(p) for p in plain] and ids.tolist() == [x for p in plain for x in p]


def digest(spark, df, **more):
    path = tempfile.mkdtemp(prefix="tokens-") + "/shards"
    token_files.write_token_shards(df, path, PATH, 2, **more)
    return sorted(map(tuple, token_files.token_digest(spark, path).collect()), key=lambda r: r[1]), path


@pytest.mark.parametrize("shard", [1, 50, 1 << 18])
def test_odd_rows(spark, clashing, shard):
    got, _ = digest(spark, clashing, shard_tokens=shard)
    assert got == expected([(r[0], r[1]) for r in odd_rows()])


def test_empty_table(spark, none):
    assert digest(spark, none)[0] == []


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op1_token_shards"](spark, SF).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)


def test_find_token(spark, odd):
    _, path = digest(spark, odd, shard_tokens=40)
    tokenizer = Tokenizer.from_file(PATH)
    token = tokenizer.encode("river", add_special_tokens=False).ids[0]
    found = sorted((r.doc_id or -1, r.place) for r in token_files.find_token(spark, path, token).collect())
    want = []
    for r in odd_rows():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
        want += [(r[0] or -1, k) for k, x in enumerate(ids) if x == token]
    assert found == sorted(want)
