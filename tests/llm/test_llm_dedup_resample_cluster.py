"""Exact duplicates, importance resampling and centroid clustering against plain Python."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
import xxhash
from llm_cases import SCHEMA, documents, frame, text

from satlens.llm import exact_dedup, importance, queries, zone_kmeans
from satlens.llm.common import table


# -- exact duplicates --------------------------------------------------------
def brute_groups(rows):
    """Rows as (id, keep_id, size, kept, digest); of rows that share id and text any one stays."""
    groups = {}
    for d, t, _ in rows:
        groups.setdefault(t or "", []).append(d)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest, left = hashlib.sha256(t.encode()).hexdigest(), 1
        for d in ids:
            stays = d == keep and left == 1
            left -= stays
            out[d, keep, len(ids), stays, digest] += 1
    return out


@pytest.mark.parametrize("heavy", [2, 8, 1024])
def test_exact_groups(spark, heavy):
    rows = documents() + [(2000 + i, "one text of many", "a") for i in range(150)] + [(i, f"pair {i // 2}", "b") for i in range(3000, 3040)]
    got = exact_dedup.duplicate_groups(frame(spark, rows).repartition(7), heavy=heavy)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_groups(rows)


def test_exact_kept_rows_and_empty(spark):
    rows = documents() + [(None, None, "z"), (None, "", "z")]
    docs = frame(spark, rows)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"] or "") for r in kept.collect()]
    assert len(got) == len({t or "" for _, t, _ in rows}) == len({t for _, t in got})
    assert Counter(got) == Counter((d, t) for t, d in {t or "": max((i for i, u, _ in rows if (u or "") == (t or "") and i is not None), default=None)
                                                       for _, t, _ in rows}.items())
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicate_groups(empty).count() == 0 and exact_dedup.deduplicate(empty).count() == 0


def test_exact_groups_where_most_partitions_hold_no_summary(spark):
    rows = [(i, f"text {i % 40}", "a") for i in range(200)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    try:
        got = exact_dedup.duplicate_groups(frame(spark, rows).coalesce(1)).collect()
    finally:
        spark.conf.unset(name)
    assert Counter(map(tuple, got)) == brute_groups(rows)


def test_heavy_digests_are_verified(spark):
    rows = [(i, "hot" if i % 3 == 0 else "warm" if i % 3 == 1 and i < 900 else f"cold {i}", "a") for i in range(3000)]
    stored = exact_dedup.digests(frame(spark, rows), id_col="doc_id", text_col="text")
    found = {r["digest"]: (r["size"], r["last"]["id"]) for r in exact_dedup.winners(stored, 3000, heavy=8).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert found == {digest("hot"): (1000, 2997)}  # "warm" has 300 rows, below 3000 / 8


# -- importance resampling ---------------------------------------------------
def plain_features(t):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    return len(w), [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_draw(rows, target, percent=5, least=20):
    bucket = lambda f: crc32(f.encode()) % 10_000
    found = [(d, *plain_features(t)) for d, t, _ in rows]
    raw, aim = Counter(bucket(f) for _, _, fs in found for f in fs), Counter(bucket(f) for t in target for f in plain_features(t)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (s + 10_000) / ((raw[b] + 1) * (t + 10_000))))
    out = []
    for d, n, fs in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        out.append([d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[5] = k + 1
    return Counter(map(tuple, out))


@pytest.mark.parametrize("piece_words, cut_bytes, percent", [(1 << 17, 1 << 20, 5), (50, 64, 60)])
def test_resampling(spark, monkeypatch, piece_words, cut_bytes, percent):
    monkeypatch.setattr(importance, "PIECE_WORDS", piece_words)
    monkeypatch.setattr(importance, "CUT_BYTES", cut_bytes)
    rows = documents() + [(500 + i, text(i, 30) + " Über-größe 7even\x7f{x}[y] " + "w" * i, "a") for i in range(40)]
    target = [text(2, 90), None, "alpha BETA gamma", "größe"]
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, rank int")
    got = importance.resample(frame(spark, rows), goal, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_draw(rows, target, percent)


def test_resampling_edges(spark):
    goal = spark.createDataFrame([], "text string")
    rows = documents()
    got = importance.resample(frame(spark, rows), goal, percent=50)
    assert Counter(map(tuple, got.collect())) == brute_draw(rows, [], 50)
    drawn = importance.drawn_documents(frame(spark, rows), got)
    assert {r["doc_id"] for r in drawn.collect()} == {r["doc_id"] for r in got.collect() if r["rank"] and r["doc_id"]}
    assert importance.resample(spark.createDataFrame([], SCHEMA), goal).count() == 0


def test_resampling_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"], None) for r in table(spark, folder, "documents").collect()]
    target = [r["text"] for r in table(spark, folder, "benchmark").collect()]
    want = Counter({(r[0], *r[2:]): n for r, n in brute_draw(rows, target).items()})
    assert Counter(map(tuple, queries.QUERIES["op12_importance_resampling"](spark, folder).collect())) == want


def test_interned_spans():
    words = [b"a", b"bb", "größe".encode(), b"c" * 7, b"d" * 8, b"e" * 31, b"f" * 40, b"a", b"bb"] * 30
    grams = importance.Grams(words)
    begin, length, _ = grams.spans(np.zeros(len(words), np.int64), np.ones(len(words), bool))
    texts = [grams.data[a:a + n] for a, n in zip(begin, length)]
    assert grams.keys(begin, length).tolist() == [xxhash.xxh64_intdigest(t) for t in texts]
    assert grams.buckets(begin, length).tolist() == [crc32(t) % 10_000 for t in texts]
    for keys in (grams.keys, lambda b, n: np.zeros(len(b), np.uint64)):  # also when every key collides: the bytes decide
        grams.keys = keys
        slot, owner = grams.intern(begin, length)
        assert [texts[owner[s]] for s in slot] == texts
        assert len(set(slot.tolist())) == len(set(texts)) == (owner >= 0).sum()


# -- clustering --------------------------------------------------------------
def brute_clusters(rows, k, rounds, width, scale=256, seed=2):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    order = sorted(kept, key=lambda r: (digest(f"{seed}:{'' if r[0] is None else r[0]}"), r[1]))
    centroids = [v for _, v in order[:k]]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        sums, sizes = [[0] * width for _ in centroids], [0] * len(centroids)
        for _, v in kept:
            c = near(v)[0]
            sizes[c] += 1
            sums[c] = [a + b for a, b in zip(sums[c], v)]
        centroids = [[a // n for a in s] if n else c for s, n, c in zip(sums, sizes, centroids)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], sum(inertia.values()), digest(",".join(map(str, centroids[c])))) for i, c, d in found)


VECTORS = "vec_id long, embedding array<double>, cluster int, distance long, key string, low int"


def vectors(n, width, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(9, width))
    rows = [(i, (centre[i % 9] + 0.1 * rng.normal(size=width)).tolist()) for i in range(n)]
    same = rows[3][1]
    return rows + [(n + i, same) for i in range(n // 3)] + [(3, same), (None, same), (None, rows[5][1]), (n * 2, None), (n * 2 + 1, same[1:]),
                                                            (n * 2 + 2, [None] * width), (n * 2 + 3, [math.nan] + same[1:]), (n * 2 + 4, [math.inf] + same[1:])]


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1, "x", 1) for i, v in rows], VECTORS)


@pytest.mark.parametrize("block_rows, width, k", [(64, 64, 40), (4, 8, 12)])
def test_clusters(spark, monkeypatch, block_rows, width, k):
    monkeypatch.setattr(zone_kmeans, "BLOCK_ROWS", block_rows)
    rows = vectors(300, width)
    got = zone_kmeans.cluster_report(vector_frame(spark, rows), k=k, width=width)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == brute_clusters(rows, k, 5, width)


def test_clusters_of_few_none_and_large_values(spark):
    few = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [-7.0, 2.0])]
    got = zone_kmeans.cluster_report(vector_frame(spark, few), k=5, width=2)
    assert Counter(map(tuple, got.collect())) == brute_clusters(few, 5, 5, 2)
    large = [(i, [3e5 * (-1) ** i + i, 1e5 * (i % 5)]) for i in range(50)]
    got = zone_kmeans.cluster_report(vector_frame(spark, large), k=4, width=2)
    assert Counter(map(tuple, got.collect())) == brute_clusters(large, 4, 5, 2)
    beyond = zone_kmeans.cluster_report(vector_frame(spark, [(1, [1e300, 0.0]), (2, [5e5 * 2, 0.0]), (3, [0.0, 0.0])]), k=2, width=2)
    assert beyond.count() == 3  # clamped, not dropped
    for none in ([], [(1, None), (2, [1.0])]):
        assert zone_kmeans.cluster_report(vector_frame(spark, none), width=2).count() == 0


def test_hilbert_curve_is_a_path():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        keys = [k.tobytes() for k in zone_kmeans.hilbert_keys(cells, bits)]
        path = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert len(set(keys)) == len(keys) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_leave_out_centroids(spark):
    found = zone_kmeans.cluster(vector_frame(spark, vectors(2000, 8)), k=9, width=8)
    assert found.rounds[-1].compared < 0.7 * found.rounds[-1].pairs
    rng = np.random.default_rng(1)
    for _ in range(50):  # the nearest centroid of a point of the box is never left out
        v, c = rng.integers(-50, 50, (20, 6)), rng.integers(-80, 80, (15, 6))
        assert np.isin(zone_kmeans.nearest(v, c)[0], zone_kmeans.candidates(v.min(axis=0), v.max(axis=0), c)).all()
