"""Workers hold short pieces of a batch; results do not depend on the pieces."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from satlens.llm import huffman_ids, packing, pretokens, sparse_logistic, toxicity
from satlens.llm.common import BATCH_ROWS, WIDE_ROWS, materialize, slices
from satlens.llm.shingles import Shingler


def test_shingles_hold_a_short_piece_of_the_texts():
    texts = [" ".join(f"w{(i * 31 + j * j) % 977}" for j in range(300)) for i in range(2000)] + ["", "one", None]
    tracemalloc.start()
    sizes = [len(s) for s in Shingler(4).sets(texts)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(map(len, texts[:-1])) > 2 << 20 and peak < 30e6  # over 100 MB in pieces of 2 MB
    assert sizes[-3:] == [0, 1, 0] and all(np.array_equal(a, b) for a, b in zip(Shingler(4).sets(texts[:9]), (next(Shingler(4).sets([t])) for t in texts[:9])))


def test_slices_hold_every_row_in_order():
    batches = [pa.record_batch({"a": list(range(1200))}), pa.record_batch({"a": pa.array([], pa.int64())}), pa.record_batch({"a": [7]})]
    got = [b.column(0).to_pylist() for b in slices(batches)]
    assert [len(x) for x in got] == [512, 512, 176, 1] and sum(got, []) == [*range(1200), 7]


def test_verdicts_of_a_batch_in_pieces(spark):
    rng = np.random.default_rng(5)
    links = [toxicity.Link(rng.normal(size=64), rng.normal(size=k), 0.1) for k in range(2)]
    chain = toxicity.ToxicityChain(["a", "b"], toxicity.Settings(slots=64), links)
    rows = 2 * toxicity.PIECE + 3
    d = spark.range(rows, numPartitions=1).withColumn("text", F.when(F.col("id") % 7 > 0, F.expr("repeat(chr(97 + id % 23) || ' word ', int(id % 4))")))
    got = d.select("id", chain.verdict(F.col("text")).alias("v"), toxicity.word_slots(toxicity.text_words(F.col("text")), 64).alias("at")).collect()
    want = toxicity.chained(links, pa.array([r["at"] for r in got], pa.list_(pa.int32())))
    assert len(got) == rows and np.allclose([r.v.p_a for r in got], want[0]) and np.allclose([r.v.p_b for r in got], want[1])


def test_wide_rows_reach_workers_in_short_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(BATCH_ROWS)
    d = spark.range(1300, numPartitions=1).mapInArrow(sizes, "n bigint")
    assert sorted(r.n for r in materialize(d, "sizes", WIDE_ROWS).collect()) == [276, 512, 512]
    assert [r.n for r in materialize(d, "sizes").collect()] == [1300] and spark.conf.get(BATCH_ROWS) == before


class Rows:
    """Stands for a table: hands over the function that workers would run."""

    def __init__(self, df):
        self.schema = df.schema

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_tokenising_workers_hold_a_short_piece_of_a_batch(spark):
    d = Rows(spark.createDataFrame([], "doc_id bigint, text string"))
    batch = pa.record_batch({"doc_id": pa.array(range(1300), pa.int64()), "text": [f"text number {i}" for i in range(1299)] + [None]})
    for run, rows in ((packing.tokenize_pieces(d, public_tokenizers.path("word_bpe_49k.json")), "doc_id"),
                      (huffman_ids.tokenized(d, public_tokenizers.path("byte_bpe_50k.json"), [], 2, "doc_id", "text"), "doc")):
        got = list(run(iter([batch])))
        assert [b.num_rows for b in got] == [512, 512, 276]  # 1300 in one before
        assert sum((b.column(rows).to_pylist() for b in got), []) == [*range(1300)]


def test_learning_a_few_pieces_does_not_copy_the_memo():
    enc = pretokens.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    library, enc.encode_pieces = enc.encode_pieces, lambda pieces: [[len(p)] for p in pieces]
    for a in range(0, 280_000, 20_000):
        assert sum(int(x.sum()) for x in enc.encode([" ".join(f"x{i}q" for i in range(a, a + 20_000))])) > 20_000
    enc.encode_pieces = library
    text = "a few words that nobody met"
    tracemalloc.start()
    got = next(enc.encode([text])).tolist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == enc.library.encode(text, add_special_tokens=False).ids and peak < 1e6  # over 10 MB with a sorted memo


def test_a_full_memo_is_forgotten(monkeypatch):
    enc = pretokens.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(pretokens, "MEMO_ENTRIES", 60)
    monkeypatch.setattr(pretokens, "CHUNK_CHARS", 200)
    texts = [" ".join(f"word{(i * j) % 83} é{j}" for j in range(25)) for i in range(40)]
    assert [x.tolist() for x in enc.encode(texts)] == [e.ids for e in enc.library.encode_batch(texts, add_special_tokens=False)]


def test_equal_places_of_a_table_are_told_apart():
    enc = pretokens.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))
    keys = np.arange(1, 3001, dtype=np.uint64) << np.uint64(40)  # all begin at one place
    enc._learn(keys, [f"w{i}" for i in range(len(keys))])
    assert enc._find(keys).tolist() == [*range(3000)] and enc._find(np.array([5, 1 << 39], np.uint64)).tolist() == [-1, -1]


def test_a_fit_holds_eight_bytes_a_place(monkeypatch):
    rng = np.random.default_rng(2)
    n, sizes = 6000, np.full(6000, 200)
    at = np.sort(rng.integers(0, 900, (n, 200)).astype(np.int32), axis=1)
    sample = sparse_logistic.Sample(at.ravel(), sizes, rng.random((n, 1)), (at[:, 0] % 3 == 0).astype(float))
    tracemalloc.start()
    some = sparse_logistic.fit(sample, 1024, 1e-3, 3, 1e-6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6  # 1.2 million places; 39.6 MB before
    monkeypatch.setattr(sparse_logistic, "PIECE", 1000)
    assert np.array_equal(some, sparse_logistic.fit(sample, 1024, 1e-3, 3, 1e-6)) and np.count_nonzero(some) > 1


def test_pieces_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(sparse_logistic, "PIECE", 5)
    sizes = np.array([0, 3, 9, 0, 1, 1, 1, 2, 0])
    got = list(sparse_logistic.pieces(np.cumsum(sizes)))
    assert [i for a, b in got for i in range(a, b)] == [*range(9)] and max(sizes[a:b].sum() for a, b in got if b - a > 1) <= 5
    used, at, row = sparse_logistic.Sample(np.arange(17, dtype=np.int32) % 4, sizes, np.zeros((9, 0)), np.zeros(9)).reduced(6, 0.0)
    assert used.tolist() == [0, 1, 2, 3] and at.tolist() == [*np.arange(17) % 4] and row.tolist() == np.repeat(np.arange(9), sizes).tolist()
