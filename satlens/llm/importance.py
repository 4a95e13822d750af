"""Importance resampling towards a target distribution, over hashed n-grams.

Features are all runs of one to three words, repeats counted; a feature's bucket
is the CRC-32 of its bytes modulo ``BUCKETS``.  Bucket counts of all documents and
of all target texts give each bucket a gain; a document's weight is the sum over
its features, and weights with Gumbel noise from a hash of the id give an exact
draw without replacement: the highest scores.

Texts are read a batch at a time.  The n-grams of a batch are interned in an
open-addressed NumPy table: xxhash64 of the bytes is the key, a match is verified
byte by byte, and a slot holds the n-gram's bucket and count.  The first pass sums
slot counts per bucket; the second fills slots with gains, and the slot ids of the
occurrences gather them into documents.  Batches hold ``PIECE_WORDS`` words: long
texts continue in the next batch with their last words, so memory does not grow
with a text.

Ranks come from one range shuffle by score; positions inside the sorted
partitions, and counts of whole partitions, give every row its place.

Null or wordless texts have no features and weight 0.  A null id draws the noise
of the empty id and comes after all ids on ties; repeated rows are drawn apart.
An empty target gives the gains of its smoothing alone; empty documents give an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlens.llm.common import materialize, parts

BUCKETS = 10_000
WIDTH = 3
#: Words of a batch.
PIECE_WORDS = 1 << 17
#: Bytes of one text cut into words at once.
CUT_BYTES = 1 << 20
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: A-Z to a-z, separators to blanks.
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Low k bytes of a little-endian word.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_BYTE = np.uint64(255)


def _crc_tables() -> np.ndarray:
    """tables[k][b]: the CRC-32 remainder of byte b with k bytes after it."""
    one = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], np.uint32)  # without the initial and final inversion
    out = [one]
    for _ in range(7):
        out.append((out[-1] >> np.uint32(8)) ^ one[out[-1] & np.uint32(255)])
    return np.array(out)


_CRC = _crc_tables()


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


class Grams:
    """N-grams as spans of one buffer of words joined by blanks."""

    def __init__(self, words: list[bytes]):
        size = np.fromiter(map(len, words), np.int64, len(words))
        self.stop = np.cumsum(size + 1) - 1  # of each word
        self.begin = self.stop - size
        self.data = b" ".join(words) + bytes(8)
        #: The eight bytes from every place on.
        self.eight = np.ndarray((len(self.data) - 7,), "<u8", buffer=self.data, strides=(1,))

    def spans(self, first: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, length, last word) of the n-grams that end in a ``fresh`` word and start at ``first`` of it or later."""
        begin, length, last = [], [], []
        for width in range(WIDTH):
            at = np.flatnonzero(fresh & (np.arange(len(first)) - width >= first))
            begin.append(self.begin[at - width])
            length.append(self.stop[at] - begin[-1])
            last.append(at)
        return tuple(map(np.concatenate, (begin, length, last)))

    def keys(self, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """xxhash64 of each span."""
        h = _P5 + length.astype(np.uint64)
        for k in range(3):
            on = np.flatnonzero(length >= 8 * (k + 1))
            lane = _turned(self.eight[begin[on] + 8 * k] * _P2, 31) * _P1
            h[on] = _turned(h[on] ^ lane, 27) * _P1 + _P4
        rest, at = length & 7, begin + (length & ~7)
        on = np.flatnonzero(rest >= 4)
        h[on] = _turned(h[on] ^ (self.eight[at[on]] & _LOW[4]) * _P1, 23) * _P2 + _P3
        at[on] += 4
        rest = rest & 3
        for k in range(3):
            on = np.flatnonzero(rest > k)
            h[on] = _turned(h[on] ^ (self.eight[at[on] + k] & _LOW[1]) * _P5, 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(length >= 32).tolist():  # longer ones have another shape
            h[i] = xxhash.xxh64_intdigest(self.data[begin[i]:begin[i] + length[i]])
        return h

    def equal(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Whether spans (begin, length) hold the same bytes."""
        same = a[1] == b[1]
        open_, done = np.flatnonzero(same & (a[0] != b[0])), 0
        while len(open_):
            left = a[1][open_] - done
            differ = (self.eight[a[0][open_] + done] ^ self.eight[b[0][open_] + done]) & _LOW[np.minimum(left, 8)]
            same[open_[differ != 0]] = False
            open_, done = open_[(differ == 0) & (left > 8)], done + 8
        return same

    def intern(self, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot of every span, span that owns each slot or -1) of an open-addressed table with linear probing.

        All open spans probe at once.  Equal spans probe the same slots in the
        same rounds, so they end in one; of spans that reach a free slot together
        one becomes its owner.
        """
        keys = self.keys(begin, length)
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        owner, slot = np.full(size, -1, np.int64), (keys & np.uint64(size - 1)).astype(np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            at = slot[open_]
            free = owner[at] < 0
            owner[at[free]] = open_[free]
            own = owner[at]
            hit = np.flatnonzero(keys[own] == keys[open_])
            hit = hit[self.equal((begin[own[hit]], length[own[hit]]), (begin[open_[hit]], length[open_[hit]]))]
            missed = np.ones(len(open_), bool)
            missed[hit] = False
            open_ = open_[missed]
            slot[open_] = (slot[open_] + 1) & (size - 1)
        return slot, owner

    def buckets(self, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC-32 of each span modulo BUCKETS: eight bytes at a time, then single ones."""
        crc, at, left = np.full(len(begin), 0xFFFFFFFF, np.uint32), begin.copy(), length.copy()
        open_ = np.flatnonzero(left >= 8)
        while len(open_):
            lane = self.eight[at[open_]] ^ crc[open_]
            new = _CRC[7][lane & _BYTE]
            for k in range(1, 8):
                new ^= _CRC[7 - k][(lane >> np.uint64(8 * k)) & _BYTE]
            crc[open_] = new
            at[open_] += 8
            left[open_] -= 8
            open_ = open_[left[open_] >= 8]
        for k in range(7):
            on = np.flatnonzero(left > k)
            crc[on] = _CRC[0][(crc[on] ^ self.eight[at[on] + k]) & _BYTE] ^ (crc[on] >> np.uint32(8))
        return (~crc % np.uint32(BUCKETS)).astype(np.int64)


def pieces(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(words, text, first word of the text here, fresh) of whole batches; the last words of a cut text come again, not fresh."""
    words, text, first, fresh = [], [], [], []

    def batch():
        return (words, *(np.repeat(np.array([x[0] for x in part], np.int64), [x[1] for x in part]) for part in (text, first)),
                np.repeat(np.array([x[0] for x in fresh], bool), [x[1] for x in fresh]))

    for i, raw in enumerate(texts):
        folded, at, carry = (raw or b"").translate(_FOLD), 0, []
        while at < len(folded):
            end = len(folded)
            if at + CUT_BYTES < end:
                end = folded.find(b" ", at + CUT_BYTES) % (end + 1)  # not found: the end
            new = folded[at:end].split()
            at = end
            text.append((i, len(carry) + len(new)))
            first.append((len(words), len(carry) + len(new)))
            fresh += [(False, len(carry)), (True, len(new))]
            words += carry
            words += new
            carry = (carry + new)[1 - WIDTH:]
            if len(words) >= PIECE_WORDS:
                yield batch()
                words, text, first, fresh = [], [], [], []
    if words:
        yield batch()


def counted(texts: list[bytes | None], into: np.ndarray) -> None:
    """Adds the features of ``texts`` to the counts of their buckets."""
    for words, _, first, fresh in pieces(texts):
        grams = Grams(words)
        begin, length, _ = grams.spans(first, fresh)
        slot, owner = grams.intern(begin, length)
        used = np.flatnonzero(owner >= 0)
        bucket = grams.buckets(begin[owner[used]], length[owner[used]])
        count = np.bincount(slot, minlength=len(owner))[used]
        np.add.at(into, bucket, count)


def weighed(texts: list[bytes | None], gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, features, sum of gains) of each text."""
    n_words, n_features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
    for words, text, first, fresh in pieces(texts):
        grams = Grams(words)
        begin, length, last = grams.spans(first, fresh)
        slot, owner = grams.intern(begin, length)
        used = np.flatnonzero(owner >= 0)
        gain = np.zeros(len(owner), np.int64)
        gain[used] = gains[grams.buckets(begin[owner[used]], length[owner[used]])]
        of = text[last]
        n_words += np.bincount(text[fresh], minlength=len(texts))
        n_features += np.bincount(of, minlength=len(texts))
        # sums of integers below 2**53: exact
        weight += np.bincount(of, gain[slot], minlength=len(texts)).astype(np.int64)
    return n_words, n_features, weight


def raw_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def bucket_counts(rows: DataFrame, text_col: str = "text") -> np.ndarray:
    """Features of all texts in each bucket; a task sends one row a bucket."""
    def run(batches):
        sums = np.zeros(BUCKETS, np.int64)
        for b in batches:
            counted(raw_texts(b.column(0)), sums)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(sums[used])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    tasks = rows.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket int, n bigint")
    for r in tasks.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all = int(raw.sum()), int(target.sum())
    return np.array([floor(1000 * log((t + 1.0) * (s_all + float(BUCKETS)) / ((s + 1.0) * (t_all + float(BUCKETS)))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, *, id_col: str, text_col: str) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    def run(batches):
        for b in batches:
            found = weighed(raw_texts(b.column(1)), gains)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, found)], names=["id", "n_words", "n_features", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, weight bigint"))


def in_order(rows: DataFrame) -> DataFrame:
    """Stored rows of (id, eligible, score, ...) with part and place: eligible ones first, the highest score first, then smaller ids."""
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("id")]
    ordered = rows.repartitionByRange(parts(rows.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches):
        part, done = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(done, done + b.num_rows))],
                names=[*b.schema.names, "part", "place"])
            done += b.num_rows

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return materialize(ordered.mapInArrow(run, schema + ", part int, place bigint"), "importance-order")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every row of ``docs``; rank is null where it is not drawn.

    Of the N rows with at least ``least_words`` words floor(percent * N / 100) are drawn.
    """
    gains = bucket_gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    rows = (weights(docs, gains, id_col=id_col, text_col=text_col)
            .withColumns({"score": F.col("weight") + noise, "eligible": F.col("n_words") >= least_words}))
    rows = in_order(materialize(rows, "importance-weights"))  # stored: a range shuffle reads its input twice
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"), F.count_if("eligible").alias("e")).orderBy("part").collect()  # a row a partition
    drawn = percent * sum(r["e"] for r in sizes) // 100
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r["part"], before))
        before += r["n"]
    starts = F.broadcast(docs.sparkSession.createDataFrame(offsets, "part int, _before bigint"))
    rank = F.col("_before") + F.col("place") + 1
    return rows.join(starts, "part").select(
        F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def drawn_documents(docs: DataFrame, drawn: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn in ``drawn`` (a result of ``resample``)."""
    return docs.join(drawn.where("rank is not null").select(id_col), id_col, "left_semi").select(*docs.columns)
