"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlens.llm import (balltree, exact_dedup, huffman_ids, importance, mixing, ngram_join, packing, pii_surrogate, quality_llr,
                         token_count, toxicity, warc, zone_kmeans)
from satlens.llm.common import materialize, shared_path, table

#: Key of the surrogates; production passes its own secret.
SURROGATE_KEY = "satlens-surrogates"
QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return keep


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                    limit=2048)


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                  end_id=0, capacity=2048)


@query("op7_huffman_ids")
def op7_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "huffman")
    huffman_ids.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=2)
    rows = huffman_ids.read_ids(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return huffman_ids.with_start(materialize(rows, "huffman-digests")).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op8_mix_sources")
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), mixing.Mix())
    return mixed.taken().select("doc_id", "size", "source_size", "target", "taken")


@query("op4_ngram_llr")
def op4_ngram_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_llr.score(table(spark, sf_dir, "documents"), trusted)


@query("op9_ball_tree_top_k", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 10""")
def op9_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, 10)


@query("op3_warc_salvage", """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id <> f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id <> f.first THEN f.first END AS refers_to,
       coalesce(p.page_id % 64 = 0, false) AS after_gap
FROM p LEFT JOIN f ON p.payload_bytes >= 100 AND p.payload_digest = f.payload_digest""")
def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_path(spark, "warc")
    # a damaged copy before every 64th page: the reader has to log it as a gap and find the page behind it
    warc.write_warc(table(spark, sf_dir, "pages"), folder, damaged_copy_every=64)
    found = warc.read_warc(spark, folder, payloads=False).where("kind = 'record'")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "after_gap")


@query("op1_toxicity_chain")
def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), toxicity.default_categories())
    return chain.score(docs.select("doc_id", "text")).drop("text")


@query("op5_pii_surrogates")
def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogate.replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


@query("op2_ngram_jaccard_join", r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g
    FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 85 * (nx.n + ny.n - o)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, b.y FROM reach JOIN both_ways b ON reach.r = b.x)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r) AS component_id FROM n JOIN reach ON n.doc_id = reach.doc_id GROUP BY ALL""")
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"), width=4, percent=85)


@query("op11_exact_dedup", """
WITH h AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM h WINDOW g AS (PARTITION BY text_sha256)""")
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


@query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def kmeans_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds written out one after the other; all values are integers below 2**53, so doubles are exact."""
    out = [f"""WITH v AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
    SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS c, v FROM (
        SELECT sha256('2:' || vec_id) AS h, v FROM v ORDER BY h LIMIT {k}))"""]
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (
    SELECT vec_id, v, min(struct_pack(d := d, c := c)) AS m FROM (
        SELECT vec_id, v.v, c, list_dot_product(v.v, v.v) - 2 * list_dot_product(v.v, c{i}.v) + list_dot_product(c{i}.v, c{i}.v) AS d
        FROM v, c{i}) GROUP BY vec_id, v)""")
        if i < rounds:
            out.append(f"""m{i} AS (
    SELECT c, list(x ORDER BY i) AS v FROM (
        SELECT c, i, floor(sum(x) / count(*)) AS x FROM (SELECT m.c AS c, unnest(v) AS x, unnest(range(64)) AS i FROM a{i}) GROUP BY c, i)
    GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return ",\n".join(out) + f"""
SELECT vec_id, m.c AS cluster, m.d::BIGINT AS distance, (sum(m.d) OVER (PARTITION BY m.c))::BIGINT AS cluster_inertia,
    (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c{rounds}.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = m.c"""


@query("op13_zone_map_clustering", kmeans_sql())
def op13_zone_map_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_kmeans.cluster_report(table(spark, sf_dir, "embeddings"), k=40, rounds=5, width=64, scale=256, seed=2)
