"""Mixing sources to target weights, in DataFrame functions only.

The words of a source, its documents in id order, are packed into blocks of
``block_words``.  Sources get a share of the mix by weight, capped at
``max_repeats`` times their size.  The mix is a run of output shards of
``shard_slots`` slots; every slot draws its source with the sources' shares as
odds, which makes a shard's source counts multinomial.  A source's slots are
numbered through all shards, and slot k takes the source's block
perm(epoch k div n, k mod n): each epoch is a keyed pseudorandom permutation of
its n blocks (swap-or-not), so that no block comes back before all others.
Slots that a draw gives a source beyond its quota go to the sources that are
below theirs, so that each source ends within a block of its target.  Slots and
blocks are then joined by (source, block).

Null sources form a source of their own, last in order; null texts have size 0;
repeated rows count as often as they occur; an empty table gives an empty
result.  A hot source is only ever summed over hash buckets, never gathered.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlens.llm.common import WORD, let, materialize, words

#: Rows that one prefix-sum bucket should hold, and at most so many buckets.
BUCKET_ROWS = 256
MAX_BUCKETS = 1 << 20
ROUNDS = 12


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5  # of all sizes
    max_repeats: int = 2
    block_words: int = 32
    shard_slots: int = 4096
    seed: int = 17


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"))


def targets(sizes: dict[str | None, int], mix: Mix) -> dict[str | None, float]:
    """Shares by weight in code-point order, null last; what a cap cuts off goes to the others by weight."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    cap = {s: float(mix.max_repeats * sizes[s]) for s in order}
    total, out, open_ = mix.share * sum(sizes.values()), {}, list(order)
    while open_:
        rest, odds = total - sum(out.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / odds > cap[s]]
        if not over:
            return out | {s: rest * weight[s] / odds for s in open_}
        out |= {s: cap[s] for s in over}
        open_ = [s for s in open_ if s not in out]
    return out


def positions(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds first: the words of a source before this document, its documents in (bucket, id) order."""
    buckets = int(min(MAX_BUCKETS, max(1, n_rows // BUCKET_ROWS)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    inside = Window.partitionBy("source_no", "bucket").orderBy(F.asc_nulls_first("doc_id"), "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = (rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("in_bucket"))
            .select("source_no", "bucket", (F.sum("in_bucket").over(across) - F.col("in_bucket")).alias("base")))
    return (rows.withColumn("inner", F.sum("size").over(inside) - F.col("size"))
            .join(base, ["source_no", "bucket"])
            .withColumn("first", F.col("base") + F.col("inner")).drop("bucket", "base", "inner"))


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """A keyed permutation of 0..size-1: in each round, an index and its mirror image swap or stay together."""
    def swap(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), size) - x, size)
        return F.when(F.pmod(F.xxhash64(*key, r, F.greatest(x, mirror)), F.lit(2)) == 1, mirror).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), swap)


def slots(spark, quotas: list[tuple[int, int, int]], mix: Mix) -> DataFrame:
    """(shard, slot, source_no, block_no) of the whole mix; quotas: (source, slots, blocks) for each source."""
    total = sum(q for _, q, _ in quotas)
    edges, at = [], 0.0
    for _, q, _ in quotas:
        at += q
        edges.append(at / max(total, 1))
    # one draw a slot: the number of edges that a uniform number has passed
    drawn = spark.range(total).select((F.col("id") / mix.shard_slots).cast("long").alias("shard"), F.col("id").alias("slot"))
    unit = F.pmod(F.xxhash64(F.lit(mix.seed), "shard", "slot"), F.lit(1 << 52)).cast("double") / float(1 << 52)
    drawn = drawn.withColumn("pick", F.size(F.filter(F.lit(edges[:-1]), lambda e: e <= unit)) if len(edges) > 1 else F.lit(0))
    counts = drawn.groupBy("shard", "pick").agg(F.count("*").alias("n"))
    # a source's slots are numbered through the shards; shards are dealt over runs so that no window holds them all
    runs = counts.withColumn("run", (F.col("shard") / 1024).cast("long"))
    per_run = runs.groupBy("pick", "run").agg(F.sum("n").alias("r"))
    before = lambda *by: Window.partitionBy(*by)
    per_run = per_run.select("pick", "run", (F.sum("r").over(before("pick").orderBy("run")) - F.col("r")).alias("base"))
    base = (runs.withColumn("in_run", F.sum("n").over(before("pick", "run").orderBy("shard")) - F.col("n"))
            .join(per_run, ["pick", "run"]).select("pick", "shard", (F.col("base") + F.col("in_run")).alias("base")))
    numbered = (drawn.withColumn("in_shard", F.row_number().over(before("shard", "pick").orderBy("slot")) - 1)
                .join(base, ["shard", "pick"]).withColumn("k", F.col("base") + F.col("in_shard")).drop("base", "in_shard"))
    # slots beyond a quota fill the quotas that the draw left open, in order
    had = {r["pick"]: r["n"] for r in counts.groupBy("pick").agg(F.sum("n").alias("n")).collect()}  # one row a source
    spill, short, spilled, filled = [], [], 0, 0
    for i, (_, q, _) in enumerate(quotas):
        n = had.get(i, 0)
        spill.append(spilled)
        spilled += max(0, n - q)
        if n < q:
            short.append((filled, i, n))
            filled += q - n

    def of(values: list[int], i: Column) -> Column:
        return F.get(F.lit(values or [0]), i.cast("int")).cast("long")

    def redealt(spare: Column) -> Column:
        i = F.size(F.filter(F.lit([a for a, _, _ in short] or [0]), lambda a: a <= spare)) - 1
        return let(i, lambda j: F.struct(of([i for _, i, _ in short], j).alias("pick"),
                                         (spare - of([a for a, _, _ in short], j) + of([n for _, _, n in short], j)).alias("k")))

    pick, k, quota = F.col("pick"), F.col("k"), of([q for _, q, _ in quotas], F.col("pick"))
    kept = F.struct(pick.cast("long").alias("pick"), k.cast("long").alias("k"))
    place = F.when(k < quota, kept).otherwise(let(of(spill, pick) + k - quota, redealt))

    def found(p: Column) -> Column:
        source, blocks = of([s for s, _, _ in quotas], p["pick"]), of([b for _, _, b in quotas], p["pick"])
        return let(F.struct(source.alias("s"), blocks.alias("n"), p["k"].alias("k")), lambda x: F.struct(
            x["s"].alias("source_no"),
            permuted(F.pmod(x["k"], x["n"]), x["n"], F.lit(mix.seed), x["s"], F.floor(x["k"] / x["n"])).alias("block_no")))

    return numbered.select("shard", "slot", let(place, found).alias("_at")).select("shard", "slot", "_at.*")


@dataclass(frozen=True)
class Mixed:
    """documents: (doc_id, source, source_no, size, source_size, target, first); blocks: (source_no, block_no,
    doc_id, first, begin, words), a row for each document in a block; slots: (shard, slot, source_no, block_no)."""

    documents: DataFrame
    blocks: DataFrame
    slots: DataFrame

    def taken(self) -> DataFrame:
        """Documents with taken: the words that the mix takes of each, repeats counted."""
        uses = self.slots.groupBy("source_no", "block_no").agg(F.count("*").alias("uses"))
        per_doc = (self.blocks.join(uses, ["source_no", "block_no"]).groupBy("source_no", "doc_id", "first")
                   .agg(F.sum(F.col("words") * F.col("uses")).alias("taken")))
        d, t = self.documents.alias("d"), per_doc.alias("t")
        same = (F.col("d.source_no") == F.col("t.source_no")) & F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & \
            (F.col("d.first") == F.col("t.first")) & (F.col("d.size") > 0)
        return d.join(t, same, "left").select("d.*", F.coalesce("t.taken", F.lit(0)).alias("taken"))


def mix_sources(docs: DataFrame, mix: Mix = Mix(), *, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> Mixed:
    spark = docs.sparkSession
    rows = materialize(sized(docs, id_col, text_col, source_col), "sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # one row a source
    sizes = {r["source"]: r["size"] for r in found}
    target = targets(sizes, mix)
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    quotas = []
    for i, s in enumerate(order):
        blocks = ceil(sizes[s] / mix.block_words)
        whole = sizes[s] / max(blocks, 1)  # mean words of a block: the last one may be short
        quotas.append((i, min(round(target[s] / whole), mix.max_repeats * blocks) if blocks else 0, blocks))
    facts = spark.createDataFrame([(i, s, sizes[s], float(target[s])) for i, s in enumerate(order)],
                                  "source_no long, source string, source_size long, target double")
    named = rows.alias("r").join(F.broadcast(facts).alias("f"), F.col("r.source").eqNullSafe(F.col("f.source"))) \
        .select("doc_id", "r.source", "source_no", "size", "source_size", "target")
    documents = materialize(positions(named, sum(r["n"] for r in found)), "positions")
    step = F.lit(mix.block_words).cast("long")
    blocks = (documents.where("size > 0")
              .select("source_no", "doc_id", "first", "size",
                      F.explode(F.sequence(F.floor(F.col("first") / step), F.floor((F.col("first") + F.col("size") - 1) / step)))
                      .alias("block_no"))
              .withColumn("begin", F.greatest(F.col("first"), F.col("block_no") * step) - F.col("first"))
              .withColumn("words", F.least(F.col("first") + F.col("size"), (F.col("block_no") + 1) * step) - F.col("first") - F.col("begin"))
              .drop("size"))
    return Mixed(documents, blocks, slots(spark, quotas, mix))


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), *, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A source whose every block is taken m times gives m whole copies of each of
    its documents; words of blocks that are taken once more make a further copy
    that holds only them, in order, joined by blanks.  Rows equal in id and text
    are one document here; documents of which nothing is taken have no row,
    except those without words, which are neither taken nor left out: they stay.
    """
    keyed = docs.withColumn("_key", F.xxhash64(text_col)).dropDuplicates([id_col, "_key"])
    one = materialize(keyed.select(F.xxhash64(id_col, "_key").alias("_row"), text_col, source_col), "mix-rows")
    mixed = mix_sources(one, mix, id_col="_row", text_col=text_col, source_col=source_col)
    uses = mixed.slots.groupBy("source_no", "block_no").agg(F.count("*").alias("uses"))
    # sources whose blocks are all taken at least once: the smallest use, 0 where a block is left out
    used = mixed.blocks.join(uses, ["source_no", "block_no"], "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
    used = materialize(used, "mix-uses")
    whole = used.groupBy(F.col("source_no").alias("s")).agg(F.min("uses").alias("whole"))  # one row a source
    spans = (used.join(whole, F.col("source_no") == F.col("s")).groupBy(F.col("doc_id").alias("_of"))
             .agg(F.first("whole").alias("_whole"), F.sort_array(F.collect_list(
                 F.when(F.col("uses") > F.col("whole"), F.struct("begin", "words")))).alias("_spans")))
    joined = keyed.withColumn("_row", F.xxhash64(id_col, "_key")).join(spans, F.col("_row") == F.col("_of"), "left")
    text, spans = F.col(text_col), F.col("_spans")
    some = let(words(text), lambda w: F.array_join(F.flatten(F.transform(
        spans, lambda x: F.slice(w, (x["begin"] + 1).cast("int"), x["words"].cast("int")))), " "))
    copies = F.concat(F.array_repeat(text, F.col("_whole").cast("int")), F.when(F.size(spans) > 0, F.array(some)).otherwise(F.array().cast("array<string>")))
    out = joined.withColumn("_text", F.explode(F.when(F.col("_of").isNull(), F.array(text)).otherwise(copies)))
    return out.select(*[F.col("_text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
