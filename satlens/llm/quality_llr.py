"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Unigrams and bigrams of every whole text are hashed into ``buckets`` bins.  One
pass counts the bins over all documents (the raw corpus) and over the trusted
ones (the target); both counts, smoothed by ``prior`` a bin, give a multinomial.
A document's score is the mean over its n-grams of log(target / raw), so that
length does not move it, and the verdict is score >= threshold: every document
is decided by the same rule, with nothing drawn.

The table of weights has ``buckets`` numbers, whatever the corpus size.  A null
or blank text has no words, fails the base rules and scores 0; repeated rows
repeat their result; ids may be null (such rows are never trusted); without any
trusted document all weights are 0 and the base rules decide alone.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlens.llm.common import broadcast_if_small, let, words

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def stripped(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def repeated_words(hashes: Column) -> Column:
    """Words inside a window of five words that the text has twice or more, the first included."""
    def covered(at: Column) -> Column:  # sorted places of repeated windows
        reach = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    def places(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, j: (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"]))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def of(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(ordered, places))

    def windows(h: Column) -> Column:
        first = F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))
        return F.transform(first, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))))

    return let(hashes, lambda h: let(windows(h), of)).cast("long")


def features(hashes: Column, buckets: int) -> Column:
    """Bins of the unigrams and bigrams."""
    def both(h: Column) -> Column:
        pairs = F.transform(F.slice(h, F.lit(2), F.greatest(F.size(h) - 1, F.lit(0))),
                            lambda x, i: F.pmod(F.xxhash64(F.get(h, i), x), F.lit(buckets)).cast("int"))
        return F.concat(F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int")), pairs)
    return let(hashes, both)


def bucket_weights(docs: DataFrame, trusted: DataFrame, *, id_col: str, text_col: str, buckets: int,
                   prior: float) -> list[float]:
    """log(target / raw) of every bin, counted over all documents; trusted: one column of ids."""
    ids = broadcast_if_small(trusted.select(F.col(trusted.columns[0]).alias("_trusted")).where("_trusted is not null").distinct())
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marked = d.join(ids, d["_id"] == ids["_trusted"], "left")
    bins = marked.select(F.col("_trusted").isNotNull().alias("_t"), F.explode(features(word_hashes(F.col("_text")), buckets)).alias("_bin"))
    rows = bins.groupBy("_bin", "_t").agg(F.count("*").alias("n")).collect()  # two rows a bin at most
    raw, target = [prior] * buckets, [prior] * buckets
    for r in rows:
        raw[r["_bin"]] += r["n"]
        if r["_t"]:
            target[r["_bin"]] += r["n"]
    if not any(r["_t"] for r in rows):
        return [0.0] * buckets
    base = log(sum(raw)) - log(sum(target))
    return [log(t) - log(r) + base for t, r in zip(target, raw)]


def score(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = 10_000,
          prior: float = 1.0, threshold: float = -0.05) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept) of every document."""
    weights = F.lit(bucket_weights(docs, trusted, id_col=id_col, text_col=text_col, buckets=buckets, prior=prior))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(stripped(x, BLANKS)) > 0)

    def measured(h: Column) -> Column:
        bins = features(h, buckets)
        total = F.aggregate(bins, F.lit(0.0), lambda a, x: a + F.get(weights, x))
        return F.struct(F.size(h).cast("long").alias("n_words"), repeated_words(h).alias("n_repeat_words"),
                        (total / F.greatest(2 * F.size(h) - 1, F.lit(1))).alias("llr"))

    rows = docs.select(
        F.col(id_col), let(word_hashes(F.col(text_col)), measured).alias("_m"),
        F.length(stripped(text, BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(stripped(text, SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    failed = (F.col("_m.n_words") < 10) | (100 * F.col("_m.n_repeat_words") > 20 * F.col("_m.n_words"))
    return rows.select(id_col, "_m.n_words", "word_chars", "n_symbols", "n_dup_lines", "_m.n_repeat_words", "_m.llr",
                       failed.alias("base_failed"), (~failed & (F.col("_m.llr") >= threshold)).alias("kept"))
