"""Joins and join audits (§2.3, §2.8).

No broadcast hints: AQE measures each side at runtime and turns a sort-merge
join into a broadcast join only when the measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it, the join stays a
shuffle join and AQE splits skewed partitions.  Audits never materialise the
many-to-many pairs: they join per-key counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_safe_condition(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        right_keys: Sequence[str] | None = None):
    right_keys = list(right_keys or keys)
    cond = None
    for lk, rk in zip(keys, right_keys):
        c = left[lk].eqNullSafe(right[rk])
        cond = c if cond is None else cond & c
    return cond


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        how: str = "left") -> DataFrame:
    """Equi join on ``keys`` where NULL matches NULL (pandas merge semantics).

    Right-side key columns are dropped; non-key clashes keep the left column.
    """
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys and c not in left.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def fallback_join(left: DataFrame, right: DataFrame, levels: Sequence[Sequence[str]], sums: Sequence[str],
                  level_col: str = "match_level") -> DataFrame:
    """Left join on the most specific key list that matches: ``levels`` from many keys to few, each a subset of the first.

    The columns ``sums`` of ``right`` are added up for every key of every level, so a
    row meets one record however many rows its key has there.  NULL matches NULL.
    ``level_col`` is the number of keys of the match, NULL (like the sums) where no
    level matches.

    Rows and finest records move once, dealt by the keys that all levels share; windows
    give each row its sums at every level.  Rows of ``left`` with equal keys meet in a
    task: where they may be many, count them by key before.
    """
    keys = list(levels[0])
    if any(set(lv) - set(keys) for lv in levels) or len({len(lv) for lv in levels}) < len(levels):
        raise ValueError("levels must be subsets of the first, each of another length")
    finest = right.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    types, own = ({f.name: f.dataType for f in df.schema.fields} for df in (finest, left))
    carried = [c for c in left.columns if c not in keys or own[c] != types[c]]
    rows = left.select(*[F.col(k).cast(types[k]).alias(f"__k_{k}") for k in keys], *[F.col(c).alias(f"__l_{c}") for c in carried],
                       F.lit(None).cast("int").alias("__records"), *[F.lit(None).cast(types[c]).alias(f"__s_{c}") for c in sums])
    records = finest.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.lit(None).cast(own[c]).alias(f"__l_{c}") for c in carried],
                            F.lit(1).alias("__records"), *[F.col(c).alias(f"__s_{c}") for c in sums])
    both = rows.unionByName(records)
    order = list(dict.fromkeys(f"__k_{k}" for lv in reversed(levels) for k in lv))  # nested levels need one order
    if shared := [f"__k_{k}" for k in keys if all(k in lv for lv in levels)]:
        both = both.repartition(*shared).sortWithinPartitions(*order)
    found = {}
    for lv in levels:
        w = Window.partitionBy(*[k for k in order if k[len("__k_"):] in lv])
        found[len(lv)] = [F.sum(c).over(w).alias(f"{c}_{len(lv)}") for c in ("__records", *[f"__s_{c}" for c in sums])]
    both = both.select("*", *[c for cs in found.values() for c in cs]).where(F.col("__records").isNull())

    def finest_match(value) -> Column:
        return F.coalesce(*[F.when(F.col(f"__records_{n}") > 0, F.struct(value(n).alias("v"))) for n in found])["v"]

    out = {c: F.col(f"__l_{c}" if c in carried else f"__k_{c}") for c in left.columns}
    out = {level_col: finest_match(F.lit), **{c: finest_match(lambda n, c=c: F.col(f"__s_{c}_{n}")) for c in sums}} | out
    return both.select(*[out[c].alias(c) for c in dict.fromkeys([*left.columns, level_col, *sums])])


def join_dictionary(df: DataFrame, dictionary: DataFrame, left_key: str, right_key: str,
                    value_col: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Left join a code dictionary with a differently named key; the looked-up
    value is lower-cased and trimmed, NULLs and excluded codes dropped, key removed."""
    d = dictionary.select(F.col(right_key).alias("__k"), F.col(value_col).alias("__v"))
    out = df.join(d, df[left_key] == d["__k"], "left").drop("__k")
    out = out.withColumn(value_col, F.lower(F.trim(F.col("__v")))).drop("__v")
    out = out.filter(F.col(value_col).isNotNull())
    if exclude:
        out = out.filter(~F.col(value_col).isin(list(exclude)))
    return out


def join_audit(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a full outer merge would tag left_only / right_only / both.

    Computed from per-key counts (partial aggregation on each side), so a
    many-to-many key contributes n_left * n_right without emitting the pairs.
    """
    lc = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nl"))
    rc = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nr"))
    j = lc.join(rc, null_safe_condition(lc, rc, keys), "full_outer")
    nl, nr = F.col("__nl"), F.col("__nr")
    side = (F.when(nl.isNotNull() & nr.isNotNull(), "both")
            .when(nl.isNotNull(), "left_only").otherwise("right_only"))
    rows = F.when(nl.isNotNull() & nr.isNotNull(), nl * nr).otherwise(F.coalesce(nl, nr))
    return (j.select(side.alias("merge_side"), rows.alias("__rows"))
            .groupBy("merge_side").agg(F.sum("__rows").cast("bigint").alias("n_rows"),
                                       F.count(F.lit(1)).alias("n_keys")))


def key_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys on each side and in both (one aggregate after a key-level join)."""
    lk = left.select(*keys).distinct().withColumn("__l", F.lit(1))
    rk = right.select(*keys).distinct().withColumn("__r", F.lit(1))
    j = lk.join(rk, null_safe_condition(lk, rk, keys), "full_outer")
    return j.agg(F.count("__l").alias("n_left"), F.count("__r").alias("n_right"),
                 F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).alias("n_both"))


def snapshot_diff(today: DataFrame, yesterday: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows of ``today`` with no identical row (NULL = NULL) in ``yesterday``,
    comparing all columns except ``ignore`` (e.g. the snapshot stamp)."""
    cols = [c for c in today.columns if c not in ignore]
    y = yesterday.select(*[F.col(c).alias(f"__y_{c}") for c in cols]).distinct()
    cond = None
    for c in cols:
        e = today[c].eqNullSafe(y[f"__y_{c}"])
        cond = e if cond is None else cond & e
    return today.join(y, cond, "left_anti")


def join_fanout(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count an inner join on ``keys`` would produce (sum of n_l * n_r), per key
    count and total, without running the join itself."""
    lc = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))
    rc = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_right"))
    j = left_join_null_safe(lc, rc, keys, "inner")  # pandas matches missing keys too
    return j.agg(F.count(F.lit(1)).alias("n_keys"),
                 F.sum(F.col("n_left") * F.col("n_right")).cast("bigint").alias("n_pairs"),
                 F.max(F.col("n_left") * F.col("n_right")).cast("bigint").alias("max_pairs_per_key"))


def target_encode(df: DataFrame, category: str, pos: str, neg: str, out: str) -> DataFrame:
    """Per-category mean(pos) - mean(neg) fed back to the rows.

    Aggregate first (partial per task), then an equi join back; a hot category
    is one row on the small side, so AQE's skew handling splits the big side.
    """
    enc = df.groupBy(category).agg((F.avg(pos) - F.avg(neg)).alias(out))
    return left_join_null_safe(df, enc, [category])


def resolve_suffix(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                   prefer: str = "left") -> DataFrame:
    """Join and resolve clashing non-key columns to one column (no _x/_y pair):
    the preferred side's value, falling back to the other side's when NULL."""
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    l = left.select(*[F.col(c).alias(f"__l_{c}") if c in clash else F.col(c) for c in left.columns])
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in clash else F.col(c) for c in right.columns])
    j = left_join_null_safe(l, r, keys, how)
    for c in clash:
        a, b = (f"__l_{c}", f"__r_{c}") if prefer == "left" else (f"__r_{c}", f"__l_{c}")
        j = j.withColumn(c, F.coalesce(F.col(a), F.col(b))).drop(f"__l_{c}", f"__r_{c}")
    return j
