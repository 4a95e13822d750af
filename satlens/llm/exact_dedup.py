"""Exact duplicates with a split between frequent and other digests, in DataFrame functions only.

Texts are equal when their SHA-256 is; null counts as empty.  Every row's digest
is stored once.  Then

1. a Misra-Gries summary (``approx_top_k_accumulate``, merged in two steps) names
   digests that may hold a large share of all rows: a row per summary, never a row per text;
2. one aggregate verifies them: those with at least ``total / HEAVY`` rows by exact
   count are the winners, at most ``HEAVY`` of them, each with its group's last row;
3. winners are broadcast, and their rows get the answer where they lie, unshuffled;
4. all other digests, none with more than ``total / HEAVY`` rows beyond the summary's
   error, meet by an ordinary shuffle, of which only repeated ones are joined back.

Of equal texts the row with the largest id stays; a null id is below every id.
Rows that share text and id are told apart by a row number, so that exactly one
row of each group stays.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens.llm.common import materialize

#: A digest with more than one row in so many is heavy; so no more than this many are.
HEAVY = 1024
#: Digests that a summary follows; its error is below one row in HEAVY.
TRACKED = 3072
#: Partial summaries, merged into one.
SUMMARIES = 64


def digests(docs: DataFrame, *, id_col: str, text_col: str, keep: bool = False) -> DataFrame:
    """Stored (id, digest, row), with the whole row as ``doc`` if ``keep``; row numbers are fixed by being stored."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("digest"),
                       F.monotonically_increasing_id().alias("row"), *([F.struct("*").alias("doc")] if keep else []))
    return materialize(rows, "digests")


def frequent(rows: DataFrame, k: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """(digest) of at most ``k`` candidates of the Misra-Gries summary."""
    summaries = (rows.select("digest", F.pmod(F.spark_partition_id(), F.lit(SUMMARIES)).alias("_part"))
                 .groupBy("_part").agg(F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("_s")))
    # a group, though there is only one: without it, partitions without a summary send an empty state that cannot be merged
    merged = summaries.groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"))
    return merged.select(F.explode(F.expr(f"approx_top_k_estimate(_s, {k})")).alias("_t")).select(F.col("_t.item").alias("digest"))


def grouped(rows: DataFrame) -> DataFrame:
    """(digest, size, last): map-side sums first, so a digest costs a row a task."""
    return rows.groupBy("digest").agg(F.count("*").alias("size"), F.max(F.struct("id", "row")).alias("last"))


def winners(rows: DataFrame, total: int, heavy: int = HEAVY) -> DataFrame:
    """Stored (digest, size, last) of the digests with at least total / heavy rows, by exact count."""
    candidates = F.broadcast(frequent(rows, heavy))  # heavy rows at most
    found = grouped(rows.join(candidates, "digest", "left_semi"))
    return materialize(found.where((F.col("size") > 1) & (F.col("size") * heavy >= total)), "heavy-digests")


def marked(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``rows`` (stored digests) with size and last of their group."""
    top = F.broadcast(winners(rows, rows.count(), heavy))  # heavy rows at most
    answered = rows.join(top, "digest")
    rest = rows.join(top, "digest", "left_anti")
    repeated = grouped(rest.select("id", "digest", "row")).where("size > 1")
    last = F.coalesce("last", F.struct("id", "row"))
    met = (rest.join(repeated, "digest", "left")
           .select(*rows.columns, F.coalesce("size", F.lit(1)).cast("long").alias("size"), last.alias("last")))
    return answered.select(*rows.columns, "size", "last").unionByName(met)


def duplicate_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row."""
    found = marked(digests(docs, id_col=id_col, text_col=text_col), heavy)
    return found.select(F.col("id").alias(id_col), F.col("last.id").alias("keep_id"), F.col("size").alias("group_size"),
                        (F.col("row") == F.col("last.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = digests(docs, id_col=id_col, text_col=text_col, keep=True)
    found = marked(rows.drop("doc"), heavy).where(F.col("row") == F.col("last.row")).select("row")
    return rows.join(found, "row", "left_semi").select("doc.*")
