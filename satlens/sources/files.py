"""File sources and sinks (§2.1).

Multi-file scans are single Spark reads (one job over all files, not a Python
loop with a concat); snapshots are Hive-style partitioned folders so that a
date filter becomes a partition filter; sinks use dynamic partition
overwrite so re-running one day rewrites only that day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: bool = True,
             mode: str = "PERMISSIVE", columns: Sequence[str] | None = None) -> DataFrame:
    """Typed CSV scan of a prefix / glob / list of paths.  With PERMISSIVE the
    raw text of malformed lines lands in ``_corrupt_record`` (kept, countable);
    DROPMALFORMED drops them; FAILFAST raises."""
    reader = spark.read.option("header", header).option("mode", mode)
    if mode == "PERMISSIVE":
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(schema).csv(path)
    return df.select(*columns) if columns else df


def scan_tolerant(spark: SparkSession, path, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows).  Zero-byte and unreadable files are skipped
    (``ignoreCorruptFiles``); malformed lines are returned, not just logged."""
    reader = (spark.read.option("header", header).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("ignoreCorruptFiles", "true"))
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    df = reader.schema(full).csv(path)
    # Spark refuses raw-file plans whose only referenced column is the
    # corrupt-record column (e.g. a bare count of either side).  A predicate
    # that is always true but reads every data column keeps them in the scan.
    parsed = F.length(F.concat_ws("|", *[F.col(f.name).cast("string") for f in schema.fields])) >= 0
    good = df.filter(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull() & parsed).select(schema.fields[0].name, CORRUPT)
    return good, bad


def scan_outcomes(spark: SparkSession, path: str, schema: T.StructType, header: bool = False) -> DataFrame:
    """One row per file under ``path``: name, bytes, status, n_good and n_rejected rows.

    status: ``read``, ``empty`` (no bytes) or ``unreadable`` (bytes, but no row came
    out of it: damaged, or without any data line).  Spark's scans pass over files without bytes,
    so the names come from the file index, which the driver holds for any read, and the sizes and
    counts join them.  Of a file that breaks off the rows before the fault count.  Names starting with ``_`` or ``.`` are no data.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    rows = (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("ignoreCorruptFiles", "true").schema(full).csv(path))
    parsed = F.length(F.concat_ws("|", *[F.col(f.name).cast("string") for f in schema.fields])) >= 0  # see scan_tolerant
    counts = rows.where(parsed).groupBy(F.col("_metadata.file_path").alias("__file")).agg(
        F.count_if(F.col(CORRUPT).isNull()).alias("n_good"), F.count_if(F.col(CORRUPT).isNotNull()).alias("n_rejected"))
    def plain(name):  # the index writes file:///x, the metadata column file:/x
        return F.regexp_replace(name, "^([A-Za-z0-9+.-]+):/+", "$1:/")

    index = spark.read.format("binaryFile").load(path)
    listed = spark.createDataFrame([(f,) for f in index.inputFiles()], "file string")
    sizes = index.select(F.col("_metadata.file_path").alias("__sized"), F.col("length").alias("__length"))
    j = (listed.join(sizes, plain("file") == plain("__sized"), "left").join(counts, plain("file") == plain("__file"), "left")
         .withColumn("n_bytes", F.coalesce("__length", F.lit(0)).cast("bigint")))
    return j.select("file", "n_bytes", F.when(F.col("n_bytes") == 0, "empty").when(F.col("n_good").isNull(), "unreadable")
                    .otherwise("read").alias("status"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_good", "n_rejected")])


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, on whatever file system the path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(content))
    out.close()


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames whose columns differ; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet",
                      mode: str = "overwrite") -> None:
    """Partitioned sink; overwrite replaces only the partitions present in ``df``."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
     .format(fmt).option("header", True).save(path))


def read_partition(spark: SparkSession, path: str, column: str, value, fmt: str = "parquet",
                   schema: T.StructType | None = None) -> DataFrame:
    """One snapshot partition; the equality becomes a PartitionFilter (only that
    folder is listed and read)."""
    r = spark.read.format(fmt).option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path).filter(F.col(column) == F.lit(value))


def partition_asof(df: DataFrame, column: str, as_of, n: int = 1) -> DataFrame:
    """Rows of the n-th latest partition value <= as_of (empty if none).

    The distinct partition values are few (one per snapshot); ranking them is
    a tiny window, and the pick is a semi join back to the table."""
    vals = df.filter(F.col(column) <= F.lit(as_of)).select(column).distinct()
    ranked = vals.withColumn("__r", F.dense_rank().over(Window.orderBy(F.col(column).desc())))
    pick = ranked.filter(F.col("__r") == n).select(column)
    return df.join(pick, column, "left_semi")


def parse_partition_date(text: Column) -> Column:
    """'k=YYYY-MM-DD', 'YYYY-MM-DD' or 'YYYYMMDD' -> date (NULL otherwise)."""
    v = F.regexp_extract(text, r"(?:^|=)(\d{4}-?\d{2}-?\d{2})$", 1)
    return F.coalesce(F.try_to_date(v, "yyyy-MM-dd"), F.try_to_date(v, "yyyyMMdd"))


def partition_parts(text: Column) -> list[Column]:
    d = parse_partition_date(text)
    return [d.alias("partition_date"), F.year(d).alias("year"), F.month(d).alias("month"),
            F.dayofmonth(d).alias("day")]


def incremental_slice(df: DataFrame, column: str, day) -> DataFrame:
    return df.filter(F.col(column) == F.lit(day))


def by_run_mode(historic: DataFrame, incremental: DataFrame, use_type: str) -> DataFrame:
    """Training reads the full history, prediction the day's increment."""
    if use_type == "train":
        return historic
    if use_type == "predict":
        return incremental
    raise ValueError("use_type must be 'train' or 'predict'")


def write_explanations(expl: DataFrame, path: str) -> None:
    """Explanation store: one folder per (year, month) of the period."""
    out = expl.withColumns({"year": F.year("period"), "month": F.month("period")})
    write_partitioned(out, path, ["year", "month"])


def load_explanation(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """The stored explanation of one month; a missing month gives no rows."""
    df = spark.read.parquet(path)
    return df.filter((F.col("year") == year) & (F.col("month") == month)).drop("year", "month")
