"""Token-id files with canonical, length-limited Huffman codes.

``write_ids`` tokenises documents once into a table of the shared folder, counts
every id of the corpus, builds one codebook (package-merge, at most
``MAX_BITS`` bits a code) and writes files in ascending id order.  A file is

    magic "SLHF", u8 version, u8 most bits, u16 0, u32 number of ids, u32 n, n bytes: zlib of a code length for each id
    blocks: magic "BLOK", u32 documents, u64 ids, u32 checkpoints, u64 bytes, u32 crc32 of what follows;
            u8 id is null, i64 id, u64 ids for each document; u64 bit offset for each checkpoint; the code bits

Integers are little-endian, code bits run from the high bit of each byte.  A
block holds whole documents, at least ``BLOCK_IDS`` ids unless it is the file's
last, and needs nothing but the codebook; a checkpoint stands at every
``CHECKPOINT_IDS``-th id, so that a reader can enter there, and so that decoding
follows all checkpoints in step, one table lookup an id.

Null texts are empty documents (their end id only); null ids sort first;
repeated ids stay apart, shorter documents first; an empty table writes no file.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satlens.llm.common import parts, shared_path, slices
from satlens.llm.files import committed
from satlens.llm.pretokens import encoder

MAX_BITS = 18
BLOCK_IDS = 1 << 16
CHECKPOINT_IDS = 256
#: A file is closed after so many bytes.
FILE_BYTES = 16 << 20
#: Ids decoded at once.
DECODE_IDS = 1 << 21
HEAD, BLOCK = struct.Struct("<4sBBHII"), struct.Struct("<4sIQIQI")


# -- codes -------------------------------------------------------------------
def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal lengths of at most ``max_bits`` for ids with a count, 0 for the rest (package-merge)."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    max_bits = max(max_bits, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.float64)  # sums stay exact below 2**53
    # list 1 holds the coins; each further list holds them and the pairs of the list before
    is_coin, merged = [], coins
    for _ in range(max_bits - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        every = np.concatenate([coins, pairs])
        rank = np.argsort(every, kind="stable")
        merged = every[rank]
        is_coin.append(rank < len(coins))
    take, length = 2 * (len(order) - 1), np.zeros(len(order), np.int64)
    for flags in reversed(is_coin):  # from the last list back to the second
        n = int(flags[:take].sum())
        length[:n] += 1
        take = 2 * (take - n)
    length[:take] += 1
    out[order] = length
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    size = lengths[ids].astype(np.int64)
    top = int(size[-1]) if len(ids) else 0
    room = np.left_shift(np.int64(1), top - size)  # share of the code space, in codes of the longest length
    codes[ids] = ((np.cumsum(room) - room) >> (top - size)).astype(np.uint64)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """id and length for each window of the longest length's bits."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    top = int(lengths.max()) if len(ids) else 1
    share = np.left_shift(np.int64(1), top - lengths[ids].astype(np.int64))
    symbol, size = np.zeros(1 << top, np.uint32), np.ones(1 << top, np.uint8)
    n = int(share.sum())
    symbol[:n], size[:n] = np.repeat(ids, share), np.repeat(lengths[ids], share)
    return symbol, size, top


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The code bits of ``ids`` and the bit offset of every checkpoint."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    start = end - size
    word = start >> 5
    bits = codes[ids] << (64 - size - (start & 31)).astype(np.uint64)
    n = int(end[-1] >> 5) + 2 if len(ids) else 0
    # the bits of different codes never meet, so that sums (exact below 2**53) join them
    total = np.bincount(word, (bits >> np.uint64(32)).astype(np.float64), n)
    total += np.bincount(word + 1, (bits & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    raw = total.astype(">u4").tobytes()
    return raw[:(int(end[-1]) + 7) // 8 if len(ids) else 0], start[::CHECKPOINT_IDS].astype("<u8")


def decode_bits(raw: bytes, offsets: np.ndarray, counts: np.ndarray, table) -> np.ndarray:
    """Ids of every run: run i begins at bit offsets[i] and has counts[i] ids; counts fall or stay equal."""
    symbol, size, top = table
    data = np.frombuffer(raw + b"\0\0\0\0", np.uint8).astype(np.uint32)
    window = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
    at, mask = offsets.astype(np.int64), np.uint32((1 << top) - 1)
    out = np.zeros((int(counts[0]) if len(counts) else 0, len(counts)), np.uint32)
    for step in range(len(out)):
        live = int(np.searchsorted(-counts, -step, "left"))  # runs that have an id at this step
        pos = at[:live]
        look = window[pos >> 3] >> (32 - top - (pos & 7)).astype(np.uint32) & mask
        out[step, :live] = symbol[look]
        at[:live] += size[look]
    return out


# -- blocks ------------------------------------------------------------------
def file_head(lengths: np.ndarray) -> bytes:
    packed = zlib.compress(lengths.tobytes())
    return HEAD.pack(b"SLHF", 1, int(lengths.max(initial=0)), 0, len(lengths), len(packed)) + packed


def block(docs: list[tuple[int | None, np.ndarray]], codes: np.ndarray, lengths: np.ndarray) -> bytes:
    flat = np.concatenate([ids for _, ids in docs])
    raw, marks = encode_bits(flat, codes, lengths)
    body = (bytes(d is None for d, _ in docs) + np.array([d or 0 for d, _ in docs], "<i8").tobytes()
            + np.array([len(ids) for _, ids in docs], "<u8").tobytes() + marks.tobytes() + raw)
    return BLOCK.pack(b"BLOK", len(docs), len(flat), len(marks), len(raw), zlib.crc32(body)) + body


def read_blocks(content: bytes, table_of):
    """Yields (document ids, lengths, token ids) of each block of a file; raises on a damaged one."""
    magic, version, _, _, n, packed = HEAD.unpack_from(content)
    if magic != b"SLHF" or version != 1:
        raise ValueError("not an id file")
    table = table_of(zlib.decompress(content[HEAD.size:HEAD.size + packed]))
    at, waiting, held = HEAD.size + packed, [], 0
    while at < len(content):
        magic, docs, ids, marks, size, crc = BLOCK.unpack_from(content, at)
        at += BLOCK.size
        stop = at + 17 * docs + 8 * marks + size
        if magic != b"BLOK" or zlib.crc32(memoryview(content)[at:stop]) != crc:
            raise ValueError(f"damaged block before byte {stop}")
        null = np.frombuffer(content, np.uint8, docs, at)
        key = np.frombuffer(content, "<i8", docs, at + docs)
        length = np.frombuffer(content, "<u8", docs, at + 9 * docs).astype(np.int64)
        mark = np.frombuffer(content, "<u8", marks, at + 17 * docs).astype(np.int64)
        waiting.append(([None if x else int(k) for k, x in zip(key, null)], length, mark, ids,
                        content[stop - size:stop]))
        held, at = held + ids, stop
        if held >= DECODE_IDS:
            yield from decode_blocks(waiting, table)
            waiting, held = [], 0
    yield from decode_blocks(waiting, table)


def decode_blocks(blocks, table):
    """Decodes several blocks together: their checkpoints are followed in step."""
    if not blocks:
        return
    base = np.concatenate([[0], np.cumsum([len(b[4]) for b in blocks])]) * 8
    offsets = np.concatenate([b[2] + base[i] for i, b in enumerate(blocks)])
    counts = np.concatenate([np.minimum(CHECKPOINT_IDS, b[3] - CHECKPOINT_IDS * np.arange(len(b[2]))) for b in blocks])
    order = np.argsort(-counts, kind="stable")
    grid = decode_bits(b"".join(b[4] for b in blocks), offsets[order], counts[order], table)
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    runs = grid.T[place]  # one row for each checkpoint
    flat = runs[np.arange(runs.shape[1]) < counts[:, None]]
    at = 0
    for keys, length, _, ids, _ in blocks:
        yield keys, length, flat[at:at + ids]
        at += ids


# -- Spark -------------------------------------------------------------------
def tokenized(docs: DataFrame, tokenizer: str, bounds: list, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(part, id, ids): part by the id's place between ``bounds``."""

    def run(batches):
        enc = encoder(tokenizer)
        kind = "<u2" if enc.library.get_vocab_size() <= 1 << 16 else "<u4"
        for b in slices(batches):
            keys = b.column(0).cast(pa.int64())
            part = np.searchsorted(bounds, keys.fill_null(0).to_numpy(zero_copy_only=False), "right")
            part[np.asarray(keys.is_null())] = 0
            ids = [np.append(x, np.uint32(end_id)).astype(kind).tobytes() for x in enc.encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), keys, pa.array(ids, pa.binary())],
                                             names=["part", "doc", "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, "part int, doc bigint, ids binary")


def id_counts(stored: DataFrame, kind: str, vocabulary: int) -> np.ndarray:
    """Exact count of every id; at most one row an id and task is shuffled."""

    def run(batches):
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            ids = np.frombuffer(b"".join(b.column(0).to_pylist()), kind)
            total += np.bincount(ids, minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[used])], names=["id", "n"])

    out = np.zeros(vocabulary, np.int64)
    for r in stored.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]  # bounded by the vocabulary
    return out


def write_ids(docs: DataFrame, tokenizer: str, folder: str, *, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Writes the files of the corpus into ``folder``; part by part, ids ascending."""
    spark = docs.sparkSession
    n = parts(spark)
    cuts = docs.approxQuantile(id_col, [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    vocabulary = max(encoder(tokenizer).library.get_vocab_size(), end_id + 1)
    kind = "<u2" if encoder(tokenizer).library.get_vocab_size() <= 1 << 16 else "<u4"
    store = shared_path(spark, "token-ids")
    tokenized(docs, tokenizer, sorted(set(map(int, cuts))), end_id, id_col, text_col) \
        .write.option("compression", "zstd").parquet(store)
    stored = spark.read.parquet(store)
    lengths = code_lengths(id_counts(stored, kind, vocabulary))
    book = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))

    def run(batches):
        codes, sizes = book.value
        rows = ((p, d, np.frombuffer(i, kind)) for b in batches for p, d, i in zip(*(c.to_pylist() for c in b.columns)))
        names, row = [], next(rows, None)
        while row:
            part, number = row[0], 0
            while row and row[0] == part:
                name = f"part-{part:06d}-{number:06d}.ids"
                with committed(folder, name) as out:
                    out.write(file_head(sizes))
                    while row and row[0] == part and out.tell() < FILE_BYTES:
                        docs_, held = [], 0
                        while row and row[0] == part and held < BLOCK_IDS:
                            docs_.append(row[1:])
                            held += len(row[2])
                            row = next(rows, None)
                        out.write(block(docs_, codes, sizes))
                names.append(name)
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["file"])

    (stored.withColumn("_size", F.length("ids")).withColumn("_crc", F.crc32("ids"))
     .repartition(n, "part").sortWithinPartitions("part", F.asc_nulls_first("doc"), "_size", "_crc")
     .select("part", "doc", "ids").mapInArrow(run, "file string").write.format("noop").mode("overwrite").save())


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(part, number, at, doc_id, n_tokens, ids) from the files: the file's place in the order, the document's
    place in the file, and its ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        tables = {}

        def table_of(raw):
            if raw not in tables:
                tables.clear()
                tables[raw] = decode_table(np.frombuffer(raw, np.uint8))
            return tables[raw]

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part, number = map(int, path.rsplit("/", 1)[1].removesuffix(".ids").split("-")[1:])
                before = 0
                for keys, length, ids in read_blocks(content, table_of):
                    raw, end = ids.astype("<u4").tobytes(), np.cumsum(length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * len(keys), pa.int32()), pa.array([number] * len(keys), pa.int32()),
                         pa.array(before + end - length), pa.array(keys, pa.int64()), pa.array(length),
                         pa.array([raw[4 * (e - n):4 * e] for e, n in zip(end, length)], pa.binary())],
                        names=["part", "number", "at", "doc_id", "n_tokens", "ids"])
                    before += int(end[-1])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.ids")
             .schema("path string, modificationTime timestamp, length bigint, content binary").load(folder))
    return files.select("path", "content").mapInArrow(
        run, "part int, number int, at bigint, doc_id bigint, n_tokens bigint, ids binary")


def with_start(rows: DataFrame) -> DataFrame:
    """Adds start, the ids of all documents before, to stored rows of ``read_ids`` (without their ids)."""
    per_file = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("_n"))
    in_part = Window.partitionBy("part").orderBy("number")
    in_file = per_file.select("part", "number", (F.sum("_n").over(in_part) - F.col("_n")).alias("_file"))
    per_part = per_file.groupBy("part").agg(F.sum("_n").alias("_n"))  # one row a part
    in_all = per_part.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_part"))
    return (rows.join(in_file, ["part", "number"]).join(in_all, "part")
            .withColumn("start", F.col("_part") + F.col("_file") + F.col("at"))
            .drop("part", "number", "at", "_part", "_file"))
