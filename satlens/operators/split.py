"""Reproducible splits, folds and class balance (§2.10 M1-M3, M9).

Rows are ordered by a seeded hash of the key.  Exact per-stratum ranks are
computed without sending a stratum to one task: rows are first counted per
(stratum, hash bucket) - a small table of at most strata x buckets rows - whose
running counts give each bucket's offset; inside a bucket the rank is a window
over only that bucket's rows.  A stratum holding a third of the data is thus
spread over all buckets.  Offsets and window meet on one column (stratum and
bucket), so rows are shuffled once, and without their hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlens import config as C
from satlens.operators.joins import left_join_null_safe

HASH = "__h"
RANK = "__rank"
SIZE = "__n"


def seeded_hash(key: str, seed) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_rank(df: DataFrame, strata: Sequence[str], key: str = C.ID, seed=0,
                    bucket_hex_digits: int = 3) -> DataFrame:
    """Adds ``__rank`` (1-based order of the seeded hash within the stratum) and
    ``__n`` (stratum size).  With 16^3 buckets a window holds about
    rows / 4096 rows of one stratum; the offset table has at most
    strata x 4096 rows, and no more groups a task are counted."""
    strata = list(strata)
    prefix = F.conv(F.substring(seeded_hash(key, seed), 1, bucket_hex_digits), 16, 10).cast("int")
    # fields of a struct are equal where both are NULL
    t = df.withColumn("__at", F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(strata)], prefix.alias("b")))
    counts = t.groupBy("__at").agg(F.count(F.lit(1)).alias("__c"))
    own = [F.col(f"__at.s{i}") for i in range(len(strata))]
    w = Window.partitionBy(*own).orderBy("__at.b")
    offs = counts.select(F.col("__at").alias("__of"),
                         F.coalesce(F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
                         F.sum("__c").over(Window.partitionBy(*own)).alias(SIZE))
    t = t.repartition("__at").join(offs, F.col("__at") == F.col("__of")).withColumn(HASH, seeded_hash(key, seed))
    inner = Window.partitionBy("__at").orderBy(HASH, key)
    return t.withColumn(RANK, F.col("__off") + F.row_number().over(inner)).drop("__at", "__of", "__off")


def _ceil_frac(n: Column, frac: float) -> Column:
    return F.ceil(n * F.lit(frac)).cast("long")


def split_stratified(df: DataFrame, strata: Sequence[str], test: float = 0.2, val: float = 0.2,
                     key: str = C.ID, seed=0) -> DataFrame:
    """Stratified train / val / test labels by two successive cuts: test =
    first ceil(test * n) ranks of each stratum, val = next ceil(val * rest)."""
    t = stratified_rank(df, strata, key, seed)
    n = F.col(SIZE)
    n_test = _ceil_frac(n, test)
    n_val = _ceil_frac(n - n_test, val) if val else F.lit(0)
    r = F.col(RANK)
    label = F.when(r <= n_test, "test").when(r <= n_test + n_val, "val").otherwise("train")
    return t.withColumn("split", label).drop(HASH, RANK, SIZE)


def kfold_ids(df: DataFrame, k: int, strata: Sequence[str] = (), key: str = C.ID, seed=1,
              out: str = "fold") -> DataFrame:
    """Fold number 0..k-1 = (rank - 1) mod k over a seeded order; stratified
    by ``strata`` (e.g. the label) if given."""
    strata = list(strata) or []
    if strata:
        t = stratified_rank(df, strata, key, seed)
    else:
        t = stratified_rank(df.withColumn("__all", F.lit(0)), ["__all"], key, seed).drop("__all")
    return t.withColumn(out, ((F.col(RANK) - 1) % k).cast("int")).drop(HASH, RANK, SIZE)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight per row: (largest class size) / (own class size)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    sizes = sizes.withColumn(out, F.max("__c").over(Window.partitionBy()) / F.col("__c")).drop("__c")
    return left_join_null_safe(df, sizes, [label])


def undersample(df: DataFrame, label: str, key: str = C.ID, seed=0) -> DataFrame:
    """Keep every minority row and as many majority rows (lowest seeded hash);
    adds ``weight`` = majority size / minority size for the minority rows."""
    t = stratified_rank(df, [label], key, seed)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    m = sizes.agg(F.min("__c").alias("lo"), F.max("__c").alias("hi"))
    lo, hi = m.select("lo").scalar(), m.select("hi").scalar()
    kept = t.filter(F.col(RANK) <= lo)
    return kept.withColumn("weight", F.when(F.col(SIZE) == lo, hi / lo).otherwise(F.lit(1.0))) \
        .drop(HASH, RANK, SIZE)
