"""The corpus pipeline, stage by stage and whole, and the registered queries."""

import os
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from llm_cases import plain_words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as C
from satlens.llm import mixing, queries
from satlens.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    out = {"input": spark.read.parquet(f"{SF}/documents.parquet")}
    last = out["input"]
    for name, stage in C.STAGES:
        last = out[name] = materialize(stage(spark, last, SF), f"test-{name}")
    return out


def rows(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()))


def test_names_and_columns(stages):
    assert list(stages) == ["input", "toxicity", "near_copies", "private_data", "mix", "pack"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages["input"].columns and stages[name].count() > 0
        assert stages[name].where(F.length("text") != F.col("n_chars")).count() == 0


def test_filters_keep_texts(stages):
    assert set(rows(stages["toxicity"])) <= set(rows(stages["input"]))
    assert set(rows(stages["near_copies"])) <= set(rows(stages["toxicity"]))
    assert len(set(t for _, t in rows(stages["near_copies"]))) == stages["near_copies"].count()
    assert stages["private_data"].count() == stages["near_copies"].count()
    assert stages["private_data"].where(F.col("text").rlike(r"\w@mail\d\.example\.com|555-\d{4}")).count() == 0


def test_near_copies_keep_the_smallest_of_each_group(stages):
    def grams(t):
        w = plain_words(t.encode().lower().decode())
        return frozenset(zip(w, w[1:], w[2:], w[3:])) or frozenset([tuple(w)])
    before = [(d, grams(t)) for d, t in rows(stages["toxicity"])]
    root = {d: d for d, _ in before}
    for i, (d, a) in enumerate(before):
        for e, b in before[:i]:
            if 100 * len(a & b) >= 85 * len(a | b):
                r, s = root[d], root[e]
                root = {k: min(r, s) if v in (r, s) else v for k, v in root.items()}
    assert {d for d, _ in rows(stages["near_copies"])} == set(root.values())


def test_mix_is_near_its_targets(stages):
    sizes, taken = {}, {}
    for name, into in (("private_data", sizes), ("mix", taken)):
        for r in stages[name].select("source", "text").collect():
            into[r["source"]] = into.get(r["source"], 0) + len(plain_words(r["text"]))
    for s, t in mixing.targets(sizes, mixing.Mix()).items():
        assert abs(taken.get(s, 0) - t) <= 64


def test_pack_covers_every_token(stages):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = sorted(zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 0][a:a + 2048], "<u4").tobytes())
                  for _, t in rows(stages["mix"]) for a in range(0, len(library.encode(t, add_special_tokens=False).ids) + 1, 2048))
    assert sorted(r["ids_crc32"] for r in stages["pack"].collect()) == want
    used = stages["pack"].groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert used.where("n > 2048").count() == 0


def test_run_equals_the_stages(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, C.run(spark, SF).select(key).collect())) == sorted(map(tuple, stages["pack"].select(key).collect()))


def test_queries_are_registered_once():
    numbers = [int(n.split("_")[0][2:]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(queries.SQL) <= set(queries.QUERIES)


def test_the_rest_works_without_the_subpackage(tmp_path):
    """The entry imports and lists its other queries where llm and the pipeline are gone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('satlens.llm'):\n"
            "            raise ModuleNotFoundError(name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "q = e.queries()\n"
            "assert len(q) >= 145 and not any(n.startswith('op') for n in q) and set(e.oracle_sql()) <= set(q)\n")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
