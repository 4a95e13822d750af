"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other.  Each link is a logistic model
over the words of a text and the probabilities of all earlier categories.  While
fitting, the earlier probabilities come from models that did not see the row
(out-of-fold), so that a later link learns how far to trust them; scoring uses
the models fitted on all training rows.

Every word has a weight: words are hashed to ``slots`` places, so no vocabulary is
gathered, and a model is an array of that many numbers whatever the corpus holds.
The earlier probabilities take the places after them.  Models are fitted on at
most ``max_labelled`` labelled rows, picked by a hash of the id, so a fit fits one
task; the models of a link (one for all rows, one without each fold) are tasks
side by side, and the driver gets their weights other than 0.  Every document is
scored, over its whole text: its slots come from DataFrame functions, an Arrow
function gathers their weights link by link.  The decision threshold is the one
with the best F1 on the out-of-fold probabilities of the last category.

Null or blank texts score like a text without known words; rows with a null id
are scored but never train; repeated labels of an id count once (their maximum);
repeated rows repeat their result.  ``verdict`` adds nothing to a table; ``score``
replaces columns that bear the name of a result.  Without a labelled row of both
kinds every probability is 0 and nothing is toxic.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlens.llm import sparse_logistic
from satlens.llm.common import materialize

#: Seed words of the finer categories: words for a person, words that degrade.
INSULTS = ("idiot", "moron", "loser", "clown", "scum", "trash")
DEGRADING = ("worthless", "pathetic", "disgusting", "stupid")
#: Texts judged at once: two numbers are held for each of their words.
PIECE = 1024


@dataclass(frozen=True)
class Settings:
    max_labelled: int = 20_000
    folds: int = 3
    slots: int = 1 << 18
    penalty: float = 1e-4  # of a weight's absolute value: few words get one
    iterations: int = 60
    tolerance: float = 1e-6


def text_words(text: Column) -> Column:
    """Lower-case letter runs of a whole text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}]+"), F.lit(""))


def word_slots(words: Column, slots: int) -> Column:
    """The places of a text's distinct words, ascending."""
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(slots)).cast("int"))))


@dataclass(frozen=True)
class Link:
    """One category's model: a weight a slot, a weight for each earlier probability."""

    words: np.ndarray
    earlier: np.ndarray
    intercept: float


def probability(link: Link, slots: pa.ListArray, earlier: list[np.ndarray]) -> np.ndarray:
    """The category's probability for a batch of texts, given those of all earlier categories."""
    at = slots.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(slots)), np.diff(slots.offsets.to_numpy()))
    margin = link.intercept + np.bincount(row, link.words[at], minlength=len(slots)) + sum(w * p for w, p in zip(link.earlier, earlier))
    return 1 / (1 + np.exp(-np.clip(margin, -700, 700)))


def chained(links: list[Link], slots: pa.ListArray) -> list[np.ndarray]:
    """Probabilities of all categories for a batch of texts."""
    out: list[np.ndarray] = []
    for link in links:
        out.append(probability(link, slots, out))
    return out


@dataclass
class ToxicityChain:
    categories: list[str]
    settings: Settings = Settings()
    links: list[Link] = field(default_factory=list)
    threshold: float = 0.5
    #: precision and recall of the last category at the threshold, by models that did not see the row
    held_out: tuple[float, float] = (0.0, 0.0)

    def verdict(self, text: Column) -> Column:
        """A struct of p_<category> for each category, and toxic: the last one reaches the threshold."""
        names = [f"p_{c}" for c in self.categories]
        if not self.links:
            return F.struct(*[F.lit(0.0).alias(n) for n in names], F.lit(False).alias("toxic"))
        links, threshold = self.links, self.threshold

        @F.arrow_udf(", ".join(f"`{n}` double" for n in names) + ", toxic boolean")
        def judged(slots: pa.Array) -> pa.Array:
            pieces = [chained(links, slots.slice(at, PIECE)) for at in range(0, max(len(slots), 1), PIECE)]
            p = [np.concatenate(c) for c in zip(*pieces)]
            return pa.StructArray.from_arrays([*map(pa.array, p), pa.array(p[-1] >= threshold)], names=[*names, "toxic"])

        return judged(word_slots(text_words(text), self.settings.slots))

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with the fields of ``verdict`` as columns; they replace columns of the same names."""
        fields = [*(f"p_{c}" for c in self.categories), "toxic"]
        keep = [c for c in docs.columns if c not in fields]
        judged = docs.select(F.struct(*keep).alias("row"), self.verdict(F.col(text_col)).alias("verdict"))
        return judged.select("row.*", "verdict.*")


def training_rows(docs: DataFrame, labels: DataFrame, settings: Settings, id_col: str, text_col: str) -> DataFrame:
    """(text, y, fold) of at most ``max_labelled`` labelled documents; the picked ids are few enough to broadcast."""
    labelled = (labels.select(F.col(labels.columns[0]).alias("_id"), F.col(labels.columns[1]).alias("y"))
                .where("_id is not null and y is not null").groupBy("_id").agg(F.max("y").cast("int").alias("y")))
    picked = labelled.orderBy(F.xxhash64("_id", F.lit("train")), "_id").limit(settings.max_labelled)
    d = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (d.join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
            .select("text", "y", F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(settings.folds)).cast("int").alias("fold")))


def fit_links(train: DataFrame, label: str, k: int, settings: Settings) -> list[Link]:
    """The models without fold 0, 1, ..., and last the model of all rows; each is fitted by one task."""
    models = F.filter(F.sequence(F.lit(0), F.lit(settings.folds)), lambda m: m != F.col("fold"))
    rows = train.select(F.explode(models).alias("model"), "at", earlier(k).alias("p"), F.col(label).alias("y"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        slots, p = table.column("at").combine_chunks(), table.column("p").combine_chunks()
        sample = sparse_logistic.Sample(
            slots.flatten().to_numpy(zero_copy_only=False), np.diff(slots.offsets.to_numpy()),
            p.flatten().to_numpy(zero_copy_only=False).reshape(len(slots), k), table.column("y").to_numpy())
        w = sparse_logistic.fit(sample, settings.slots, settings.penalty, settings.iterations, settings.tolerance)
        used = np.flatnonzero(w)
        pa.default_memory_pool().release_unused()  # the worker stays for later stages
        return pa.table({"model": pa.array([key[0].as_py()] * len(used), pa.int32()), "slot": pa.array(used.astype(np.int32)), "w": w[used]})

    weights = np.zeros((settings.folds + 1, settings.slots + k + 1))
    for r in rows.groupBy("model").applyInArrow(run, "model int, slot int, w double").collect():  # at most a number a slot and model
        weights[r["model"], r["slot"]] = r["w"]
    return [Link(w[:settings.slots].copy(), w[settings.slots:-1].copy(), float(w[-1])) for w in weights]


def earlier(k: int) -> Column:
    return F.array(*[F.col(f"p{i}") for i in range(k)]).cast("array<double>")


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], settings: Settings = Settings(), *,
              id_col: str = "doc_id", text_col: str = "text") -> ToxicityChain:
    """categories: name -> boolean over (y, words), in the order of the chain; labels: (id, 0/1)."""
    chain = ToxicityChain(list(categories), settings)
    rows = training_rows(docs, labels, settings, id_col, text_col).withColumn("words", text_words(F.col("text")))
    marks = {f"y{k}": c.cast("double") for k, c in enumerate(categories.values())}
    train = materialize(rows.withColumns(marks).select("y", "fold", *marks, word_slots(F.col("words"), settings.slots).alias("at"))
                        .coalesce(4), "toxicity-train")
    if train.select("y").distinct().count() < 2:
        return chain
    for k in range(len(categories)):
        *apart, whole = fit_links(train, f"y{k}", k, settings)
        chain.links.append(whole)
        train = materialize(train.withColumn(f"p{k}", out_of_fold(apart, k)), f"toxicity-link{k}")
    chain.threshold, chain.held_out = best_threshold(train, f"p{k}", f"y{k}")
    return chain


def out_of_fold(models: list[Link], k: int) -> Column:
    """The probability of a training row by the model that did not see its fold, over p0 .. p(k-1) that came about in the same way."""
    @F.arrow_udf("double")
    def held(at: pa.Array, fold: pa.Array, p: pa.Array) -> pa.Array:
        fold = fold.to_numpy(zero_copy_only=False)
        before = list(p.flatten().to_numpy(zero_copy_only=False).reshape(len(at), k).T)
        return pa.array(np.choose(fold, [probability(m, at, before) for m in models]))

    return held("at", "fold", earlier(k))


def best_threshold(scored: DataFrame, p: str, y: str) -> tuple[float, tuple[float, float]]:
    """The threshold of 0.05, 0.10, ... with the best F1, the middle one of equals; its precision and recall."""
    steps = [i / 20 for i in range(1, 20)]
    sums = scored.agg(F.sum(y).alias("pos"), *[F.sum((F.col(p) >= s).cast("double")).alias(f"n{i}") for i, s in enumerate(steps)],
                      *[F.sum(F.when(F.col(p) >= s, F.col(y)).otherwise(0.0)).alias(f"t{i}") for i, s in enumerate(steps)]).first()
    f1 = [2 * sums[f"t{i}"] / max(sums[f"n{i}"] + sums["pos"], 1.0) for i in range(len(steps))]
    best = [i for i, f in enumerate(f1) if f == max(f1)]
    i = best[len(best) // 2]
    return steps[i], (sums[f"t{i}"] / max(sums[f"n{i}"], 1.0), sums[f"t{i}"] / max(sums["pos"], 1.0))


def default_categories() -> dict[str, Column]:
    """insult and degrading: toxic rows with a seed word of the kind; toxic: the label itself."""
    has = lambda seeds: F.arrays_overlap("words", F.array(*map(F.lit, seeds)))
    toxic = F.col("y") == 1
    return {"insult": toxic & has(INSULTS), "degrading": toxic & has(DEGRADING), "toxic": toxic}
