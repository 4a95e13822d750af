"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a table; between stages the
rows are written as Parquet and read again, so that a lost executor costs one
stage at most.  All stages but the last keep the columns of ``docs``.

1. toxicity      fits the classifier chain on the labels and drops documents that it finds toxic.
2. near_copies   joins documents on their word 4-grams; the one with the smallest id of each group stays.
3. private_data  replaces personal data by surrogates; no document goes.
4. mix           takes words of each source up to its target; documents taken more than once come as copies.
5. pack          tokenises what is left and packs it into sequences of at most 2048 tokens.

Null texts pass stages 1 to 4 and are packed as one end token; rows without an
id pass stage 2 unless an equal row does; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlens.llm import mixing, ngram_join, packing, pii_surrogate, queries, toxicity
from satlens.llm.common import broadcast_if_small, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    chain = toxicity.fit_chain(docs, labels, toxicity.default_categories())
    return docs.where(~chain.verdict(F.col("text"))["toxic"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """An id that comes with several texts stays if one of them is its group's document; rows equal in id and text are one."""
    found = materialize(ngram_join.join_components(docs), "components")
    per_id = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("_stays"), F.count("*").alias("_rows"))
    dropped = broadcast_if_small(per_id.where("not _stays").select("_id"))
    repeated = broadcast_if_small(per_id.where("_stays and _rows > 1").select("_id"))
    kept = docs.join(dropped, docs["doc_id"] == dropped["_id"], "left_anti")
    several = kept.join(repeated, kept["doc_id"] == repeated["_id"], "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, kept["doc_id"] == repeated["_id"], "left_anti").unionByName(several)


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(pii_surrogate.replace_pii(docs, queries.SURROGATE_KEY), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return counted(mixing.mixed_documents(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


def counted(out: DataFrame, docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("private_data", replace_private_data),
          ("mix", mix_sources), ("pack", pack)]
#: The chain of classifiers, hashed draws and the tokenizer have no SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
