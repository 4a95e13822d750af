"""Ball-tree search and WARC archives against plain Python."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from satlens.llm import balltree, warc
from satlens.llm.common import shared_path


# -- search ------------------------------------------------------------------
def brute(rows, k, wanted):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if not wanted(q):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    v = centres[rng.integers(0, 8, n)] + 0.3 * rng.normal(size=(n, dim))
    return [(i, [float(np.float32(x)) for x in row / np.linalg.norm(row)]) for i, row in enumerate(v)]


@pytest.mark.parametrize("shard_rows, block_queries, most_pivots", [(4096, 4096, 1024), (150, 4, 1024), (90, 4, 2)])
def test_top_k(spark, shard_rows, block_queries, most_pivots):
    rows = vectors(900, 16, 1)
    same = rows[7][1]
    rows += [(1000 + i, same) for i in range(30)] + [(2000, None), (2001, [None] * 16), (2002, [float("nan")] * 16), (2003, [float("inf")] * 16),
                                                   (None, same), (2100, same[:3]), (2200, same[:3]), (2101, []), (2300, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = balltree.top_k(df, lambda i: i % 100 == 0, 10, shard_rows=shard_rows, block_queries=block_queries, most_pivots=most_pivots).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10, lambda i: i % 100 == 0)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, -0.5])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, balltree.top_k(df, lambda i: i % 100 == 0).collect())) == [(0, 1, 1, 1024 * 512)]
    assert balltree.top_k(df.limit(0), lambda i: i % 100 == 0).count() == 0


def test_tree_prunes():
    rng = np.random.default_rng(3)
    centres = 1000 * np.eye(8)
    v = np.repeat(centres, 500, axis=0) + rng.integers(-20, 20, (4000, 8))
    tree, seen = balltree.BallTree(np.arange(4000), v), []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ np.asarray(other)
    tree.vectors = tree.vectors.view(Counted)
    scores, ids = tree.search(centres[2], -1, 10, float("-inf"))
    want = sorted(zip(-(v @ centres[2]), range(4000)))[:10]
    assert sorted(zip(-scores, ids)) == want and sum(seen) < 2000


def test_cells_below_the_kth_score_are_left_out():
    """Every dropped cell holds no candidate of the least score; of clusters far apart, most are dropped."""
    rng = np.random.default_rng(5)
    v = np.floor(np.repeat(1000 * np.eye(8), 100, axis=0) + rng.integers(-50, 50, (800, 8)))
    pivots = {8: v[::100]}
    df = pd.DataFrame({"vec_id": np.arange(800), "dim": 8, "v": list(v)})
    told = pd.concat(balltree._assigned(pivots)([df]))
    each = told.groupby("cell").agg(away=("away", "max"), norm=("norm", "max")).reset_index()
    cells = {8: (each["cell"].to_numpy(), each["away"].to_numpy() + 1e-6, each["norm"].to_numpy())}
    least = np.sort(v @ v.T, axis=1)[:, -11]
    q = pd.DataFrame({"own": np.arange(800), "width": 8, "query": list(v), "home_cell": 0, "home": 0, "least": least})
    pairs = pd.concat(balltree._reaching(pivots, cells)([q]))
    met = set(zip(pairs["own"], pairs["cell"]))
    score, cell = v @ v.T, told.sort_values("vec_id")["cell"].to_numpy()
    assert all((i, cell[j]) in met for i in range(800) for j in np.nonzero(score[i] >= least[i])[0])
    assert len(met) < 800 * 8 / 4


# -- archives ----------------------------------------------------------------
def test_write_and_read(spark):
    long = "<p>" + "é" * 100 + "</p>"
    rows = [(3, "http://a/ b", long), (1, None, long), (2, "http://c", "x"), (4, "http://d", "x"), (5, "http://e", None), (6, "http://f", ""),
            (7, "http://g\r\nX: y", "<html>" + "z" * 300_000), (1, None, long), (None, "http://h", long), (-9, "http://n", "a" * 100), (8, "u", "a" * 100),
            (9, "v", "WARC/1.1\r\n\r\n" * 30)]
    df = spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], "page_id long, url string, html string, digest string")
    folder = shared_path(spark, "warc")
    warc.write_warc(df, folder)
    got = warc.read_warc(spark, folder).collect()
    assert {r["kind"] for r in got} == {"record"}
    first = {}
    for i, _, h in rows:
        if h and i is not None and len(h.encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = Counter((i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(),
                    *(("revisit", first[h]) if h in first and i not in (None, first[h]) else ("response", None))) for i, _, h in rows)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    texts = {(r["page_id"], bytes(r["payload"]).decode()) for r in got if r["record_type"] == "response"}
    assert {(7, rows[6][2]), (5, ""), (2, "x"), (None, long), (9, rows[11][2])} <= texts


def test_empty_archive(spark):
    folder = shared_path(spark, "warc")
    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.read_warc(spark, folder).count() == 0


def archive(n=40, seed=4):
    rng = random.Random(seed)
    payloads = [rng.randbytes(200 + 11 * i) + (b"\x1f\x8b\x08" if i % 5 == 0 else b"WARC/1.1\r\n") for i in range(n)]
    return [warc.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), len(p), None) for i, p in enumerate(payloads)]


def read(data):
    found = list(warc.salvage(data))
    return [x[4]["page_id"] for x in found if x[0] == "record"], [x[1:4] for x in found if x[0] == "gap"]


def test_salvage_of_members():
    members = archive()
    at = [0, *np.cumsum([len(m) for m in members]).tolist()]
    data = bytearray(b"".join(members))
    assert read(bytes(data)) == (list(range(40)), [])
    data[at[10] + 60] ^= 255  # inside member 10
    data[at[20]] = 0  # magic of member 20
    ids, gaps = read(bytes(data))
    assert ids == [i for i in range(40) if i not in (10, 20)]
    assert [(a, b) for a, b, _ in gaps] == [(at[10], at[11]), (at[20], at[21])]
    ids, gaps = read(b"junk" * 100 + bytes(data[:at[5]]) + b"\0" * 50 + bytes(data[at[5]:at[8] - 30]))
    assert ids == list(range(7)) and [(a, b) for a, b, _ in gaps] == [(0, 400), (400 + at[5], 450 + at[5]), (450 + at[7], 450 + at[8] - 30)]


def test_salvage_of_plain_records_and_of_one_member():
    plain = [zlib.decompress(m, 31) for m in archive()]
    data = bytearray(b"".join(plain))
    third = len(plain[0]) + len(plain[1]) + len(plain[2])
    data[third + len(plain[3]) - 40] ^= 1  # block of record 3
    ids, gaps = read(bytes(data))
    assert ids == [i for i in range(40) if i != 3] and [(a, b) for a, b, _ in gaps] == [(third, third + len(plain[3]))]
    wrong = b"".join(plain[:5]).replace(b"Content-Length: %d\r\n\r\nHTTP" % (len(plain[1].split(b"\r\n\r\n", 1)[1]) - 4),
                                        b"Content-Length: 999999\r\n\r\nHTTP") + b"".join(plain[5:8])
    assert read(wrong)[0] == [0, *range(2, 8)]
    whole = zlib.compressobj(6, zlib.DEFLATED, 31)
    one = whole.compress(bytes(data)) + whole.flush()
    assert read(one)[0] == [i for i in range(40) if i != 3]
    ids, gaps = read(one[:len(one) // 2])
    assert ids[:3] == [0, 1, 2] and len(gaps) == 2  # record 3, and the part that is cut off


def test_salvage_of_nothing():
    assert read(b"") == ([], []) and read(b"x" * 10) == ([], [(0, 10, "no version line")])


def test_urls_of_any_length_come_back():
    """Alone, behind damage, and as a bare record of a file without compression."""
    url, body = "http://a.example/" + "x" * 200_000, b"page"
    one = warc.record(5, url, body, hashlib.sha256(body).hexdigest(), len(body), None)
    for data, gaps in ((one, 0), (b"\x1f\x8b\x08 damage WARC/1.1 WARC/1.1\r\nno header" + one, 1), (zlib.decompress(one, 31), 0)):
        got = list(warc.salvage(data))
        assert [(g[4]["page_id"], g[4]["target_uri"]) for g in got if g[0] == "record"] == [(5, url)]
        assert sum(g[0] == "gap" for g in got) == gaps


def test_gaps_inside_a_member_have_its_bytes():
    plain = [zlib.decompress(m, 31) for m in archive(5)]
    at = [0, *np.cumsum([len(p) for p in plain]).tolist()]
    pack = lambda b: (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(bytes(b)) + c.flush()
    for spoilt, ids in ((0, [1, 2, 3, 4]), (2, [0, 1, 3, 4]), (4, [0, 1, 2, 3])):
        data = bytearray(b"".join(plain))
        data[at[spoilt] + (0 if spoilt == 0 else 400)] ^= 1
        one = pack(data)
        found = list(warc.salvage(one + pack(plain[0])))
        assert [f.record["page_id"] for f in found if f.kind == "record"] == [*ids, 0]
        assert [f[1:3] + f[5:7] for f in found if f.kind == "gap"] == [(0, len(one), at[spoilt], at[spoilt + 1])]
        assert [f.record["page_id"] for f in found if f.after_gap] == [i for i in ids if i == spoilt + 1]
        assert all(f[5:7] == (at[f.record["page_id"]], at[f.record["page_id"] + 1]) for f in found[:-1] if f.kind == "record")
    one = bytearray(pack(b"".join(plain)))
    one[-6] ^= 1  # checksum: the records say so, the end is a gap; a member of one record is lost
    found = list(warc.salvage(bytes(one) + pack(plain[1])))
    assert [(f.record["page_id"], f.reason is None) for f in found if f.kind == "record"] == [*((i, False) for i in range(5)), (1, True)]
    assert [f[1:3] + f[5:7] for f in found if f.kind == "gap"] == [(0, len(one), at[5], None)]
    alone = bytearray(pack(plain[0]))
    alone[-6] ^= 1
    assert read(bytes(alone) + pack(plain[1])) == ([1], [(0, len(alone), "gzip: checksum or length differs")])


def test_one_changed_byte_is_a_gap_wherever_it_is():
    """Members: every byte of the deflate stream and its trailer; bare records: the mandatory fields' names and the type."""
    members = archive(3)
    for place in range(10, len(members[1])):
        spoilt = members[1][:place] + bytes([members[1][place] ^ 4]) + members[1][place + 1:]
        assert read(members[0] + spoilt + members[2])[0] == [0, 2]
    plain = [zlib.decompress(m, 31) for m in members]
    for old, new in ((b"WARC-Type:", b"WARC-Typf:"), (b": response", b": rfsponse"), (b"WARC-Record-ID", b"WARC-Recorc-ID"), (b"WARC-Date", b"WARB-Date")):
        spoilt = plain[1].replace(old, new, 1)
        ids, gaps = read(plain[0] + spoilt + plain[2])
        assert ids == [0, 2] and [g[:2] for g in gaps] == [(len(plain[0]), len(plain[0]) + len(spoilt))]


def test_many_false_heads_take_little_time():
    body = b"page"
    good = warc.record(5, "http://a", body, hashlib.sha256(body).hexdigest(), len(body), None)
    began = time.perf_counter()
    for rest, reason in ((b"\1" * 6, "gzip: no end of name"), (b"\0" * 6, "gzip: Error -3 while decompressing data: invalid stored block lengths")):
        junk = (b"\x1f\x8b\x08\x18" + rest + b"ab") * 50_000  # names and comments without end, and ended ones before no stream
        assert read(junk + good) == ([5], [(0, len(junk), reason)])
    assert time.perf_counter() - began < 30


def test_damaged_copies_are_logged_and_left(spark):
    rows = [(i, "u", "p" * (i % 300)) for i in range(-70, 200)] + [(None, "u", "x")]
    folder = shared_path(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, damaged_copy_every=10)
    got = warc.read_warc(spark, folder, payloads=False).collect()
    assert Counter(r["page_id"] for r in got if r["kind"] == "record") == Counter(i for i, _, _ in rows)
    assert {r["page_id"] for r in got if r["after_gap"]} == set(range(-70, 200, 10)) and sum(r["kind"] == "gap" for r in got) == 27
