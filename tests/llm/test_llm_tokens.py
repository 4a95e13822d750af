"""Token counts, Huffman id files and packing against the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import documents, frame
from tokenizers import Tokenizer

from satlens.llm import huffman_ids as H
from satlens.llm import packing, token_count
from satlens.llm.common import materialize, shared_path
from satlens.llm.pretokens import PieceEncoder

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


def ids_of(path, t):
    return Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module", params=[WORD, BYTE])
def encoder(request):
    return PieceEncoder(request.param)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r\x0b\x85'srevmtldabZ1²½!?.é\xa0Σσ日́ŉ<|", max_size=40), max_size=6))
def test_pieces_equal_library(encoder, texts):
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want


def test_long_text_is_cut_where_pieces_end(encoder, monkeypatch):
    monkeypatch.setattr("satlens.llm.pretokens.CHUNK_CHARS", 50)
    t = "it's  a long\n\n text with  blanks and wordswithoutanyblankbetweenthem'll " * 20
    assert next(encoder.encode([t])).tolist() == encoder.library.encode(t, add_special_tokens=False).ids


def test_whole_tokens_are_single(spark):
    whole = token_count.prove_whole_tokens(WORD)
    assert "the" in whole and len(whole) > 20_000
    library = Tokenizer.from_file(WORD)
    alone = [t for t in random.Random(1).sample(sorted(whole), 500) if len(library.pre_tokenizer.pre_tokenize_str(t)) == 1
             and t == library.normalizer.normalize_str(t)]
    assert len(alone) > 300 and all(len(e.ids) == 1 for e in library.encode_batch(alone, add_special_tokens=False))


def test_count_tokens(spark):
    rows = documents()
    got = token_count.count_tokens(frame(spark, rows), WORD, limit=300).collect()
    want = Counter((d, len((t or "").encode()), n := len(ids_of(WORD, t)), n > 300) for d, t, _ in rows)
    assert Counter(map(tuple, got)) == want
    assert token_count.count_tokens(frame(spark, []), WORD).count() == 0


def test_huffman_files(spark):
    rows = documents()
    folder = shared_path(spark, "ids")
    H.write_ids(frame(spark, rows), BYTE, folder, end_id=2)
    stored = materialize(H.read_ids(spark, folder), "rows")
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist()) for r in H.with_start(stored).collect())
    ids = lambda t: [*ids_of(BYTE, t), 2]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len(ids(r[1]))))
    start, want = 0, []
    for d, t, _ in order:
        want.append((start, d, len(ids(t)), ids(t)))
        start += len(ids(t))
    assert got == want


def test_huffman_empty(spark):
    folder = shared_path(spark, "ids")
    H.write_ids(frame(spark, []), BYTE, folder, end_id=2)


def test_huffman_blocks_roundtrip_and_damage():
    rng = np.random.default_rng(1)
    counts = np.maximum(1, 1e6 / np.arange(1, 3001) ** 1.2).astype(np.int64)
    counts[5:50] = 0
    for most in (12, 18):
        lengths = H.code_lengths(counts, most)
        assert lengths.max() <= most and abs((0.5 ** lengths[lengths > 0].astype(float)).sum() - 1) < 1e-12
        codes = H.canonical_codes(lengths)
        docs = [(i or None, rng.choice(np.flatnonzero(counts), n).astype(np.uint32)) for i, n in enumerate((1, 0, 5, 256, 257, 9000, 3))]
        data = H.file_head(lengths) + H.block(docs[:4], codes, lengths) + H.block(docs[4:], codes, lengths)
        table = lambda raw: H.decode_table(np.frombuffer(raw, np.uint8))
        got = [(k, ids[e - n:e].tolist()) for ks, ns, ids in H.read_blocks(data, table) for k, n, e in zip(ks, ns, np.cumsum(ns))]
        assert got == [(k, v.tolist()) for k, v in docs]
        broken = bytearray(data)
        broken[-20] ^= 1
        with pytest.raises(ValueError):
            list(H.read_blocks(bytes(broken), table))


def test_code_lengths_are_optimal():
    import heapq
    counts = np.random.default_rng(2).integers(1, 1000, 300)
    heap = [int(c) for c in counts]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        total += s
        heapq.heappush(heap, s)
    assert int((H.code_lengths(counts, 30) * counts).sum()) == total
    assert H.code_lengths(np.zeros(4, np.int64)).tolist() == [0, 0, 0, 0]
    assert H.code_lengths(np.array([0, 7])).tolist() == [0, 1]


def test_packing(spark):
    rows = documents()
    out = packing.pack_documents(frame(spark, rows), WORD, end_id=0, capacity=128).collect()
    want = Counter()
    for d, t, _ in rows:
        ids = [*ids_of(WORD, t), 0]
        for p, at in enumerate(range(0, len(ids), 128)):
            want[d, p, at, len(ids[at:at + 128]), crc(ids[at:at + 128])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 128
    total = sum(n for s in sequences.values() for _, n in s)
    assert len(sequences) <= -(-total // 128) + 1
    assert packing.pack_documents(frame(spark, []), WORD).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=40))
def test_plan_uses_every_piece_once(counts):
    steps = packing.plan(counts, 64)
    used = Counter()
    for lengths, times in steps:
        assert sum(lengths) <= 64 and times > 0
        for n in lengths:
            used[n] += times
    assert used == Counter(counts)
    spans = packing.places(steps)
    assert set(spans) == set(counts)


def test_plan_prefers_exact_fills():
    steps = dict(packing.plan({30: 2, 34: 2, 10: 1, 20: 1, 64: 3}, 64))
    assert steps == {(64,): 3, (34, 30): 2, (20, 10): 1}
    assert dict(packing.plan({40: 1, 14: 1, 10: 1}, 64)) == {(40, 14, 10): 1}
    assert dict(packing.plan({40: 1, 12: 1, 8: 1, 4: 1}, 64)) == {(40, 12, 8, 4): 1}
