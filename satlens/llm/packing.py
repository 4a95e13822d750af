"""Best-fit packing of tokenised documents by exact complements.

1. ``tokenize_pieces``: ids of each text, an end id, cut into pieces of at most
   ``capacity`` tokens (only longer documents are cut).
2. The number of pieces of each length - at most ``capacity`` numbers, whatever
   the corpus size - goes to the driver, where ``plan`` fills sequences in
   multiples: for each length, longest first, the gap is looked up in the index
   of single, pair and triple length sums; a combination that fills it exactly
   is consumed as often as the counts of its lengths allow, which uses up at
   least one length.  What is left goes best-fit, also in multiples.
3. Every piece gets its rank among the pieces of its length (a prefix sum over
   hash buckets, so that no window holds a length whole) and its rank selects
   its place in the plan.

A null text is an empty document of one end id.  Repeated rows are packed as
often as they occur; ties in rank go by id, piece and start, and rows equal in
all of these may swap places.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satlens.llm.common import WIDE_ROWS, materialize, slices
from satlens.llm.pretokens import encoder

#: Rows of one length that a rank window should hold, and at most so many buckets.
RANK_ROWS = 1000
MAX_BUCKETS = 1 << 16


def tokenize_pieces(docs: DataFrame, tokenizer: str, *, end_id: int = 0, capacity: int = 2048,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        enc = encoder(tokenizer)
        for b in slices(batches):
            keys = b.column(0)
            row, piece, start, length, ids, held = [], [], [], [], [], 0

            def out():
                return pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=[id_col, "piece", "start", "length", "ids"])

            for r, got in enumerate(enc.encode(b.column(1).to_pylist())):
                got = np.append(got, np.uint32(end_id)).astype("<u4")
                for p, at in enumerate(range(0, len(got), capacity)):
                    part = got[at:at + capacity]
                    row.append(r), piece.append(p), start.append(at), length.append(len(part))
                    ids.append(part.tobytes())
                    held += len(part)
                if held > 2_000_000:  # 8 MB of ids
                    yield out()
                    row, piece, start, length, ids, held = [], [], [], [], [], 0
            yield out()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids binary")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of one sequence, how many such sequences)]; every piece is used once.

    The work depends on the number of distinct lengths (at most ``capacity``), not
    on how many pieces there are.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    out: list[tuple[tuple[int, ...], int]] = []
    have = sum(1 << n for n in left)  # bit n: length n is left
    mirrored = sum(1 << (capacity - n) for n in left)  # bit capacity - n: length n is left

    def take(combo: tuple[int, ...]) -> bool:
        """Consumes a combination as often as the counts allow."""
        nonlocal have, mirrored
        need = {n: combo.count(n) for n in combo}
        times = min(left.get(n, 0) // k for n, k in need.items())
        if not times:
            return False
        out.append((combo, times))
        for n, k in need.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
                have ^= 1 << n
                mirrored ^= 1 << (capacity - n)
        return True

    def pairs(total: int):
        """Lengths a >= total - a, both left, from the index of pair sums; large a first."""
        if total < 2:
            return
        found = have & (mirrored >> (capacity - total)) & ((1 << total) - 1)
        found >>= (total + 1) // 2
        while found:
            a = found.bit_length() - 1
            found ^= 1 << a
            a += (total + 1) // 2
            yield a, total - a

    def fill(size: int, gap: int) -> bool:
        """Consumes one single, pair or triple that fills the gap exactly."""
        if gap in left and take((size, gap)):
            return True
        if any(take((size, *p)) for p in pairs(gap)):
            return True
        return any(take((size, a, *p)) for a in sorted(left, reverse=True) if a <= gap - 2
                   for p in pairs(gap - a) if p[0] <= a)

    for size in sorted(left, reverse=True):
        gap = capacity - size
        if not gap:
            take((size,))
        while size in left and fill(size, gap):
            pass
    return out + best_fit(left, capacity)


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first; sequences with equal contents are handled as one group."""
    gaps: list[int] = []  # sorted gaps of open sequences
    open_: dict[int, list[list]] = {}  # gap -> [[lengths, how many]]

    def put(lengths: tuple[int, ...], times: int, gap: int) -> None:
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append([lengths, times])

    for size in sorted(left, reverse=True):
        todo = left[size]
        while todo:
            at = bisect_left(gaps, size)
            if at == len(gaps):
                break
            gap = gaps[at]
            group = open_[gap][-1]
            each = min(gap // size, todo)
            times = min(group[1], todo // each)
            todo -= each * times
            group[1] -= times
            lengths = group[0]
            if not group[1]:
                open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[at]
            put(lengths + (size,) * each, times, gap - each * size)
        per = capacity // size
        if todo >= per:
            put((size,) * per, todo // per, capacity - per * size)
        if todo % per:
            put((size,) * (todo % per), 1, capacity - (todo % per) * size)
    return [(tuple(lengths), times) for groups in open_.values() for lengths, times in groups]


def places(steps: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence, pieces of that length per sequence, offset of the first of them."""
    out: dict[int, list] = {}
    sequence = 0
    for lengths, times in steps:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            k = lengths.count(n)
            rows = out.setdefault(n, [])
            rank = rows[-1][0] + rows[-1][2] * rows[-1][4] if rows else 0
            rows.append((rank, sequence, k, offset, times))
            offset += k * n
        sequence += times
    return {n: tuple(np.array(x, np.int64) for x in list(zip(*rows))[:4]) for n, rows in out.items()}


def with_rank(pieces: DataFrame, order: list[str], total: int) -> DataFrame:
    """Adds _rank: the rank of a piece among those of its length.

    A length is dealt over hash buckets; counts per (length, bucket) give each
    bucket's first rank, and only a bucket is ever sorted.
    """
    buckets = int(min(MAX_BUCKETS, total // RANK_ROWS + 1))
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    first = (spread.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
             .withColumn("_first", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n"))
             .select(F.col("length").alias("_l"), F.col("_bucket").alias("_b"), "_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*order)
    return (spread.withColumn("_in", F.row_number().over(inside) - 1)
            .join(first, (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b")))
            .withColumn("_rank", F.col("_first") + F.col("_in"))
            .drop("_bucket", "_in", "_l", "_b", "_first"))


def pack(pieces: DataFrame, *, capacity: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (a stored table with id, piece, start and length)."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(plan(counts, capacity))  # bounded by the number of lengths
    ranked = with_rank(pieces, [id_col, "piece", "start"], sum(counts.values()))
    names = [c for c in ranked.columns if c != "_rank"]

    def run(batches):
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = b.column(b.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                first, seq, k, off = table[int(n)]
                i = np.searchsorted(first, rank[at], "right") - 1
                inside = rank[at] - first[i]
                sequence[at] = seq[i] + inside // k[i]
                offset[at] = off[i] + inside % k[i] * n
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in names] + [pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop("_rank").schema)
    return ranked.mapInArrow(run, schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, *, end_id: int = 0, capacity: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, digest and pack ``docs``: (id, piece, start, length, ids_crc32, sequence_id, offset)."""
    pieces = tokenize_pieces(docs, tokenizer, end_id=end_id, capacity=capacity, id_col=id_col, text_col=text_col)
    pieces = materialize(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces", WIDE_ROWS)
    return pack(pieces, capacity=capacity, id_col=id_col)
