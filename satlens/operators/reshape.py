"""Melt / pivot / stack (§2.4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens import config as C
from satlens.functions.scalar import map_lookup, safe_ratio


def load_factor_ratios(lf: DataFrame, cabins: Sequence[str] = ("business", "premium_ec", "economy")) -> DataFrame:
    """pax / capacity per cabin; zero capacity -> NULL."""
    return lf.withColumns({f"load_factor_{c}": safe_ratio(f"pax_{c}", f"capacity_{c}") for c in cabins})


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str, val: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), var, val)


def melt_load_factor(lf: DataFrame, cabin_lf: Mapping[str, str] = C.CABIN_LF,
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Wide load factor (one column per cabin) -> (ids..., cabin, load_factor).

    Only the id columns that are needed are kept before the melt, since the
    melt triples the row count.
    """
    value_cols = [f"load_factor_{s}" for s in cabin_lf.values()]
    ids = list(keep) if keep is not None else [c for c in lf.columns
                                               if c not in value_cols and not c.startswith(("pax_", "capacity_"))]
    long = lf.select(*ids, *value_cols).unpivot(ids, value_cols, "__var", "load_factor")
    label = {f"load_factor_{s}": cabin for cabin, s in cabin_lf.items()}
    return long.select(*ids, map_lookup("__var", label).alias(C.CABIN), "load_factor")


def pivot_counts(df: DataFrame, group: Sequence[str], category: str, values: Sequence) -> DataFrame:
    """Counts per group unstacked into one column per category value, 0-filled.
    The category values are given, so the pivot needs no extra distinct pass."""
    out = df.groupBy(*group).pivot(category, list(values)).agg(F.count(F.lit(1)))
    return out.na.fill(0, subset=[str(v) for v in values])


def explanation_wide(expl: DataFrame, keys: Sequence[str], features: Sequence[str],
                     value: str = "value") -> DataFrame:
    """Long explanation (keys..., feature, value) -> one row per key with a
    ``<feature>_nps`` column per feature (feature list given: no distinct pass)."""
    return (expl.groupBy(*keys).pivot("feature", list(features)).agg(F.first(value))
            .withColumnsRenamed({f: f"{f}_nps" for f in features}))


def tag_union(frames: Mapping[str, DataFrame], tag: str = "period") -> DataFrame:
    """Stack samples with a tag column (union by name, missing columns NULL)."""
    out = None
    for name, df in frames.items():
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
