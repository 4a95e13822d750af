"""Similarity join of documents on the Jaccard similarity of their word n-gram sets.

1. Documents with equal sets form a class; from here on classes are joined.
2. A short filter in hash order drops most classes: two sets over the threshold
   share at least l of their (n - q + l) smallest hashes, q = ceil(t n).  Each
   task sends those hashes in packed blocks, a bucket of hashes each; hashes
   that two classes of the task share are settled there and sent once.
3. For the rest the document frequency of every n-gram is counted.  An n-gram of
   one class links nothing; the others are sorted rarest first, and each class
   posts its prefix of n - q + 1 (those of one class count as its head).
4. Postings are joined on the n-gram and pairs pass the length filter, the
   positional filter (what may still follow the common place) and the suffix
   filter (the sets' counts in 64 hash ranges bound their overlap).
5. Each pair left is verified once against the full sets.

Not all pairs of a large group are needed for its component: every posting list
first meets only its hub, the class with the largest share of common n-grams;
then classes that are still in different components meet, except those that the
list's hub component holds together.  No candidate between two components is
left out.

Null or blank texts have an empty set and are linked with nothing; rows without
an id are returned, with the smallest id that their text reaches, or null;
repeated rows are returned as often as they occur; an empty table gives an empty
result.  The rows of an id with several texts are documents of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlens.llm.common import WIDE_ROWS, broadcast_if_small, materialize, parts, slices
from satlens.llm.components import connected
from satlens.llm.shingles import Shingler, signature

#: Share of a set that the first filter posts beyond the shortest prefix.
EXTRA = 0.05
RANGES = 64
BLOCK_HASHES = 1 << 20
_SHINGLERS: dict[int, Shingler] = {}


def shingler(width: int) -> Shingler:
    return _SHINGLERS.setdefault(width, Shingler(width))


def least_overlap(n: Column, percent: int) -> Column:
    """q: elements that a set of n shares at least with any set over the threshold."""
    return F.ceil(n * percent / F.lit(100.0) - 1e-9).cast("int")


# -- classes -----------------------------------------------------------------
def members(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, s1, s2, n) of every row."""
    def run(batches):
        for b in slices(batches):
            of = [(*signature(s), len(s)) for s in shingler(width).sets(b.column(1).to_pylist())]  # no set is kept
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([x[i] for x in of], pa.int64()) for i in range(3))], names=["doc_id", "s1", "s2", "n"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(
        run, "doc_id bigint, s1 bigint, s2 bigint, n bigint")


# -- first filter ------------------------------------------------------------
def likely(docs: DataFrame, width: int, percent: int, text_col: str) -> DataFrame:
    """(s1) of the classes that share enough of their smallest hashes with others."""
    buckets = 4 * parts(docs.sparkSession)

    def packed(classes: dict[int, np.ndarray]):
        keys = np.fromiter(classes, np.int64, len(classes))
        n = np.array([len(s) for s in classes.values()], np.int64)
        q = -(-percent * n // 100)
        extra = np.maximum(1, np.ceil(EXTRA * n)).astype(np.int64)
        need = np.maximum(1, np.ceil(EXTRA * q)).astype(np.int64)  # a partner may be shorter and post less
        post = np.minimum(n, n - q + extra)
        h = np.concatenate([s[:p] for s, p in zip(classes.values(), post)])
        c = np.repeat(np.arange(len(keys)), post)
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        size = np.diff(np.append(np.flatnonzero(first), len(h)))
        shared = np.repeat(size > 1, size)
        settled = np.bincount(c[shared], minlength=len(keys))
        send = first  # a shared hash is sent once, under the mark 0
        owner = np.where(shared, 0, keys[c])[send]
        h = h[send]
        bucket = ((h.view(np.uint64) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, h, owner = bucket[order], h[order], owner[order]
        at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        stop = np.append(at[1:], len(h))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[at].astype(np.int32)), pa.array([h[i:j].tobytes() for i, j in zip(at, stop)], pa.binary()),
             pa.array([owner[i:j].tobytes() for i, j in zip(at, stop)], pa.binary()),
             pa.array([np.stack([keys, settled, need]).tobytes() if not i else None for i in at], pa.binary())],
            names=["bucket", "hashes", "owners", "own"])

    def post(batches):
        classes, held = {}, 0
        for b in slices(batches):
            for s in shingler(width).sets(b.column(0).to_pylist()):
                if len(s):
                    key = signature(s)[0] or 1
                    held += 0 if key in classes else len(s)
                    classes[key] = s
                if held > BLOCK_HASHES:
                    yield from packed(classes)
                    classes, held = {}, 0
        if classes:
            yield from packed(classes)

    def meet(group: pa.Table) -> pa.Table:
        h = np.frombuffer(b"".join(group["hashes"].to_pylist()), np.int64)
        s = np.frombuffer(b"".join(group["owners"].to_pylist()), np.int64)
        order = np.lexsort((s, h))
        h, s = h[order], s[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (s[1:] != s[:-1])])
        h, s = h[new], s[new]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.append(first, len(h)))
        shared = np.repeat((size > 1) | np.logical_or.reduceat(s == 0, first), size) & (s != 0)
        key, k = np.unique(s[shared], return_counts=True)
        own = [np.frombuffer(x, np.int64).reshape(3, -1) for x in group["own"].to_pylist() if x is not None]
        keys, ks, needs = np.concatenate([np.stack([key, k, np.zeros_like(key)]), *own], axis=1)
        return pa.table({"s1": keys, "k": ks, "need": needs})

    blocks = docs.select(text_col).mapInArrow(post, "bucket int, hashes binary, owners binary, own binary")
    return (blocks.groupBy("bucket").applyInArrow(meet, "s1 bigint, k bigint, need bigint")
            .groupBy("s1").agg(F.sum("k").alias("k"), F.max("need").alias("need")).where("k >= need").select("s1"))


# -- sets and prefixes -------------------------------------------------------
def class_sets(docs: DataFrame, classes: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(cls, n, hashes, ranges) of the classes, from the text of one document each."""
    one = broadcast_if_small(classes.select("cls", "s1", "s2", F.col("doc_id").alias("_id")))
    rows = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text")) \
        .join(one, F.col("_doc") == F.col("_id")).select("cls", "s1", "s2", "_text")

    def run(batches):
        for b in slices(batches):
            cls, s1, s2 = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            held = ([], [], [])
            for i, s in enumerate(shingler(width).sets(b.column(3).to_pylist())):
                if signature(s) == (s1[i], s2[i]):  # an id may come with other texts too
                    held[0].append(cls[i])
                    held[1].append(s)
                    held[2].append(np.bincount((s >> 58) + RANGES // 2, minlength=RANGES).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[0], pa.int64()), pa.array([len(s) for s in held[1]], pa.int32()),
                 pa.array(held[1], pa.list_(pa.int64())), pa.array(held[2], pa.list_(pa.int32()))],
                names=["cls", "n", "hashes", "ranges"])

    return rows.mapInArrow(run, "cls bigint, n int, hashes array<bigint>, ranges array<int>")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(gram, cls, n, pos, ranges): the prefix of every class in rarest-first order, without n-grams of one class."""
    grams = sets.select("cls", F.explode("hashes").alias("gram"))
    common = grams.groupBy(F.col("gram").alias("g")).agg(F.count("*").alias("df")).where("df > 1")
    ordered = (grams.join(common, F.col("gram") == F.col("g")).groupBy(F.col("cls").alias("c"))
               .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("order")))
    q = least_overlap(F.col("n"), percent)
    head = F.col("n") - F.size("order")  # n-grams that no other class has come first
    return (ordered.join(sets.select("cls", "n", "ranges"), F.col("c") == F.col("cls")).where(F.size("order") >= q)
            .select("cls", "n", "ranges", head.alias("head"),
                    F.posexplode(F.slice("order", F.lit(1), F.greatest(F.col("n") - q + 1 - head, F.lit(0)))).alias("i", "x"))
            .select(F.col("x.gram").alias("gram"), "cls", "n", (F.col("head") + F.col("i")).alias("pos"), "ranges"))


def may_match(a: str, b: str, percent: int) -> Column:
    """Length, positional and suffix filter of two postings of one n-gram."""
    na, nb, pa_, pb = (F.col(x) for x in (f"{a}.n", f"{b}.n", f"{a}.pos", f"{b}.pos"))
    need = F.ceil((na + nb) * percent / F.lit(100.0 + percent) - 1e-9)
    length = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    positional = F.least(na - pa_, nb - pb) >= need
    both = F.aggregate(F.zip_with(f"{a}.ranges", f"{b}.ranges", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return length & positional & (both >= need)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    side = lambda c, s: sets.select(F.col("cls").alias(c), F.col("hashes").alias(s))
    rows = pairs.join(side("a", "left"), "a").join(side("b", "right"), "b").select("a", "b", "left", "right")

    def run(batches):
        for b in batches:
            ends = [(x.offsets.to_numpy(), x.values.to_numpy()) for x in (b.column(2), b.column(3))]
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = (v[o[i]:o[i + 1]] for o, v in ends)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield b.select([0, 1]).filter(pa.array(keep))

    return rows.mapInArrow(run, "a bigint, b bigint")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) over the threshold whose components are those of all such pairs."""
    posts = materialize(prefixes(sets, percent), "prefixes")
    pair = [F.least("p.cls", "o.cls").alias("a"), F.greatest("p.cls", "o.cls").alias("b")]
    # round 1: each posting list meets its hub
    hubs = posts.groupBy(F.col("gram").alias("g")).agg(F.min(F.struct(
        (F.col("pos") / F.col("n")).alias("rare"), F.col("n"), F.col("cls"), F.col("pos"), F.col("ranges"))).alias("hub"),
        F.count("*").alias("size")).where("size > 1").select("g", "hub.n", "hub.cls", "hub.pos", "hub.ranges")
    hubs = materialize(hubs, "hubs")
    met = materialize(posts.alias("p").join(hubs.alias("o"), (F.col("p.gram") == F.col("o.g")) & (F.col("p.cls") != F.col("o.cls"))
                                            & may_match("p", "o", percent)).select(*pair).distinct(), "hub-pairs")
    first = materialize(verified(met, sets, percent), "hub-links", WIDE_ROWS)
    # round 2: classes of a list that are in another component than its hub meet all of another component
    label = materialize(connected(first), "labels")
    named = (posts.join(label, F.col("cls") == F.col("node"), "left").withColumn("label", F.coalesce("root", "cls"))
             .drop("node", "root"))
    main = hubs.select("g", "cls").join(label, F.col("cls") == F.col("node"), "left") \
        .select(F.col("g").alias("mg"), F.coalesce("root", "cls").alias("main"))
    named = materialize(named.join(main, F.col("gram") == F.col("mg")).withColumn("off", F.col("label") != F.col("main"))
                        .drop("mg", "main"), "labelled")
    apart = (F.col("p.gram") == F.col("o.gram")) & (F.col("p.label") != F.col("o.label")) & \
        (~F.col("o.off") | (F.col("p.cls") < F.col("o.cls"))) & may_match("p", "o", percent)
    rest = named.where("off").alias("p").join(named.alias("o"), apart).select(*pair).distinct()
    rest = materialize(rest.join(met, ["a", "b"], "left_anti"), "other-pairs")
    return first.unionByName(materialize(verified(rest, sets, percent), "other-links", WIDE_ROWS))


def join_components(docs: DataFrame, *, width: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id: the smallest id reachable by links."""
    rows = materialize(members(docs, width, id_col, text_col), "members", WIDE_ROWS)
    groups = rows.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))
    near = likely(docs, width, percent, text_col).withColumnRenamed("s1", "likely")
    classes = materialize(groups.where("doc_id is not null").join(near, F.coalesce(F.nullif("s1", F.lit(0)), F.lit(1)) == F.col("likely"))
                          .drop("likely").withColumn("cls", F.monotonically_increasing_id()), "classes", WIDE_ROWS)
    sets = materialize(class_sets(docs, classes, width, id_col, text_col), "sets", WIDE_ROWS)
    root = connected(links(sets, percent))
    named = classes.join(root, F.col("cls") == F.col("node"))
    least = named.groupBy(F.col("root").alias("r")).agg(F.min("doc_id").alias("component"))
    linked = named.join(least, F.col("root") == F.col("r")).select(F.col("s1").alias("t1"), F.col("s2").alias("t2"), "component")
    per_class = (groups.join(linked, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2")), "left")
                 .select(F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.coalesce("component", "doc_id").alias("component")))
    same = (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") > 0)
    return rows.join(per_class, same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id"))
