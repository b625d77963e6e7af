"""Sampled segmentations: lossless, reproducible, distributed like the lattice."""

import collections
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from conftest_llm import SF, odd_rows
from groundsheet.llm import pieces
from groundsheet.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def weights():
    """log weight of each piece text, from the rule in the module's docstring."""
    texts = {}
    for k in range(MODEL.vocab_size()):
        if not (MODEL.is_byte(k) or MODEL.is_control(k) or MODEL.is_unknown(k)):
            texts.setdefault(MODEL.id_to_piece(k).replace("▁", " "), k)
    first = min(texts.values())
    raw = {t: -pieces.ALPHA * math.log(k - first + 2.7) for t, k in texts.items()}
    total = math.log(sum(map(math.exp, raw.values())))
    return {t: (texts[t], w - total) for t, w in raw.items()}


def segmentations(text, known, low):
    if not text:
        yield (), 0.0
        return
    for size in range(1, len(text) + 1):
        head = text[:size]
        options = [(known[head][0],), known[head][1]] if head in known else None
        if options is None and size == 1:
            options = [tuple(MODEL.piece_to_id(f"<0x{b:02X}>") for b in head.encode()), low]
        if options:
            for tail, weight in segmentations(text[size:], known, low):
                yield options[0] + tail, options[1] + weight


def test_samples_follow_the_lattice():
    known = weights()
    low = min(w for _, w in known.values()) - 2.0
    n, text = 40_000, "the☃ cats"
    lattice = pieces.lattice(PATH)
    ids, counts = lattice.encode(pa.array([text] * n), pieces.seeds(pa.array(range(n)), 1))
    ends = np.cumsum(counts)
    got = collections.Counter(tuple(ids[e - c : e].tolist()) for e, c in zip(ends, counts, strict=True))
    all_ = dict(segmentations(" the☃", known, low)), dict(segmentations(" cats", known, low))
    chance = collections.Counter()
    scale = [sum(map(math.exp, part.values())) for part in all_]
    for a, wa in all_[0].items():
        for b, wb in all_[1].items():
            chance[a + b] += math.exp(wa + wb) / scale[0] / scale[1]
    assert set(got) <= set(chance)
    for ids_, p in chance.most_common(8):
        assert abs(got[ids_] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_odd_rows(spark, clashing):
    rows = pieces.encode_documents(clashing, PATH).collect()
    texts = {r[0]: r[1] for r in odd_rows() if r[0] is not None}
    assert len(rows) == len(odd_rows()) and all(r.lossless for r in rows)
    for r in rows:
        assert r.n_ids == len(r.ids)
        if r.doc_id is not None:
            assert r.n_ids > 0 or not texts[r.doc_id]
            if "▁" not in (texts[r.doc_id] or ""):
                assert MODEL.decode(r.ids) == (texts[r.doc_id] or "")
    again = pieces.encode_documents(clashing.repartition(5), PATH)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    other = pieces.encode_documents(clashing, PATH, seed=7).collect()
    assert sorted(map(str, other)) != sorted(map(str, rows))


def test_decoding_in_spark(spark, odd, none):
    encoded = pieces.encode_documents(odd, PATH)
    back = pieces.decode_ids(encoded, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), r[1] or "") for r in odd_rows())
    assert pieces.encode_documents(none, PATH).collect() == []


def test_a_batch_does_not_change_a_text():
    lattice = pieces.lattice(PATH)
    texts = [r[1] or "" for r in odd_rows()]
    seeds = pieces.seeds(pa.array(range(len(texts))), 0)
    ids, counts = lattice.encode(pa.array(texts), seeds)
    alone = [lattice.encode(pa.array([t]), seeds[k : k + 1])[0].tolist() for k, t in enumerate(texts)]
    assert ids.tolist() == [x for a in alone for x in a] and counts.tolist() == list(map(len, alone))


def test_whole_table(spark):
    rows = QUERIES["op6_piece_samples"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts) and all(MODEL.decode(r.ids) == texts[r.doc_id] for r in rows)
