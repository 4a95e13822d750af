"""Join, quality rules, surrogates, mixing and toxicity against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from llm_cases import WORDS, documents, frame, plain_words, text

from satlens.llm import mixing, ngram_join, pii_surrogate, quality_llr, toxicity
from satlens.llm.components import connected


# -- n-gram Jaccard join -----------------------------------------------------
def lowered(t):
    return (t or "").encode().lower().decode()


def shingles(t, width):
    w = plain_words(lowered(t))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute_components(rows, width, percent):
    sets = [shingles(t, width) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    out = Counter()
    for i, (d, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else [d]
        out[d, len(sets[i]), min((x for x in ids if x is not None), default=None)] += 1
    return out


def edited(t, k, step):
    w = t.split()
    for i in range(k):
        w[(i * step + step) % len(w)] = f"edit{k}x{i}"
    return " ".join(w)


def test_join_components(spark):
    base, other = text(4, 300), " ".join(f"w{i}" for i in range(200))
    rows = documents() + [(200 + k, edited(base, k, 31), "a") for k in range(9)] + \
        [(300 + k, edited(other, k, 17), "a") for k in range(6)] + [(400, other + " " + base, "a"), (401, "One TWO", "b")]
    got = ngram_join.join_components(frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == brute_components(rows, 4, 85)


def test_join_of_one_large_group(spark):
    base = " ".join(f"w{i % 97}q{i}" for i in range(120))
    rows = [(i, edited(base, i % 4, 7 + i % 50), "a") for i in range(300)] + [(1000 + i, base, "a") for i in range(50)]
    got = ngram_join.join_components(frame(spark, rows)).collect()
    assert Counter(map(tuple, got)) == brute_components(rows, 4, 85)


def test_join_other_widths_and_empty(spark):
    rows = documents()
    assert Counter(map(tuple, ngram_join.join_components(frame(spark, rows), width=5, percent=80).collect())) == brute_components(rows, 5, 80)
    assert ngram_join.join_components(frame(spark, [])).count() == 0


def test_components_of_a_path(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(map(tuple, connected(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


# -- quality -----------------------------------------------------------------
def hashed(*values, seed=42):
    """Spark's xxhash64 of longs or of one string."""
    for v in values:
        raw = v.encode() if isinstance(v, str) else int(v).to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed & (1 << 64) - 1)
    return seed - (1 << 64) if seed >> 63 else seed


def bins(t, buckets):
    h = [hashed(w) for w in plain_words(t)]
    return [x % buckets for x in h] + [hashed(a, b) % buckets for a, b in zip(h, h[1:])]


def test_quality(spark):
    rows = [(d, t, s) for d, t, s in documents()]
    trusted = [100, 101, 102, 5, None, 77777]
    buckets = 64
    got = quality_llr.score(frame(spark, rows), spark.createDataFrame([(x,) for x in trusted], "doc_id long"), buckets=buckets,
                            threshold=-0.05).collect()
    raw, target = [1.0] * buckets, [1.0] * buckets
    for d, t, _ in rows:
        for b in bins(t, buckets):
            raw[b] += 1
            if d in trusted and d is not None:
                target[b] += 1
    weight = [math.log(x / sum(target)) - math.log(r / sum(raw)) for x, r in zip(target, raw)]
    want = Counter()
    for d, t, _ in rows:
        t = t or ""
        w, windows, inside = plain_words(t), Counter(), set()
        for i in range(len(w) - 4):
            windows[tuple(w[i:i + 5])] += 1
        for i in range(len(w) - 4):
            if windows[tuple(w[i:i + 5])] > 1:
                inside.update(range(i, i + 5))
        lines = [x for x in t.split("\n") if plain_words(x)]
        f = bins(t, buckets)
        llr = sum(weight[b] for b in f) / max(len(f), 1)
        failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
        want[d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside),
             round(llr, 9) + 0.0, failed, not failed and llr >= -0.05] += 1
    assert Counter((*r[:6], round(r["llr"], 9) + 0.0, r["base_failed"], r["kept"]) for r in got) == want


def test_quality_without_trusted_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long")
    got = quality_llr.score(frame(spark, documents()), none).collect()
    assert all(r["llr"] == 0 and r["kept"] != r["base_failed"] for r in got)
    assert quality_llr.score(frame(spark, []), none).count() == 0


# -- surrogates --------------------------------------------------------------
def replaced(spark, texts, key="k"):
    rows = pii_surrogate.replace_pii(frame(spark, list(zip(range(len(texts)), texts, ["s"] * len(texts)))), key).orderBy("doc_id").collect()
    return [r["text"] for r in rows]


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def test_surrogates_keep_type_shape_and_coreference(spark):
    a = "Mail Jo.Doe77@Mail3.example.com or jo.doe77@mail3.example.com, call +1 (017) 555-7713 or 017-555-7713!"
    b = "card 4111 1111 1111 1111 = 4111111111111111, not 4111111111111112; ip 10.20.30.40 not 300.1.2.3, token 04dbebab91ab85687d33eeaaf9ac699e1188f962"
    c = "Anna Müller met Mr. Smith and John; Анна Петрова wrote. Anna smiled. ANNABEL did not."
    plain, null = "nothing 12 to 3.5 see", None
    out = replaced(spark, [a, b, c, plain, null, a, "", "jo.doe77@mail3.example.com###"])
    assert out[3] == plain and out[4] is None and out[5] == out[0] and out[6] == ""
    one, two = re.findall(r"\S+@\S+?(?=[ ,])", out[0])
    assert one.lower() == two.lower() and one.lower() != "jo.doe77@mail3.example.com" and out[7] == two.lower() + "###"
    assert re.fullmatch(r"Mail \w{2}\.\w{3}\d\d@\w{4}\d\.\w{7}\.com or \S+, call \+1 \(\d{3}\) \d{3}-\d{4} or \d{3}-\d{3}-\d{4}!", out[0], re.I)
    m = re.fullmatch(r"card (\d{4} \d{4} \d{4} \d{4}) = (\d{16}), not 4111111111111112; ip (\d+\.\d+\.\d+\.\d+) not 300.1.2.3, token ([0-9a-f]{40})", out[1])
    assert m and m[1].replace(" ", "") == m[2] != "4111111111111111" and m[2][0] == "4" and luhn(m[2])
    assert m[3] != "10.20.30.40" and all(0 < int(x) < 255 for x in m[3].split(".")) and not m[4].startswith("04dbebab")
    m = re.fullmatch(r"(\w+) (\w+) met Mr\. (\w+) and (\w+); (\w+) (\w+) wrote\. (\w+) smiled\. ANNABEL did not\.", out[2])
    female, male = pii_surrogate.GIVEN["female", "latin"], pii_surrogate.GIVEN["male", "latin"]
    assert m and m[1] == m[7] in female and m[1] != "Anna" and m[4] in male and m[4] != "John"
    assert m[5] in pii_surrogate.GIVEN["female", "cyrillic"] and re.fullmatch("[А-Я][а-я]+", m[6]) and m[3] != "Smith" and m[2] != "Müller"


def test_surrogates_stay_distinct_and_depend_on_the_key(spark):
    names = pii_surrogate.GIVEN["female", "latin"]  # as many as the list of surrogates: collisions are certain
    texts = [f"{n} and 10.0.0.{i}" for i, n in enumerate(names)]
    out = replaced(spark, texts)
    got = [t.split(" and ") for t in out]
    assert len({g[0] for g in got}) == len(names) and len({g[1] for g in got}) == len(names)
    assert not {g[0] for g in got} & set(names) and not {g[1] for g in got} & {f"10.0.0.{i}" for i in range(len(names))}
    assert out == replaced(spark, texts) and out != replaced(spark, texts, "other")


def test_surrogates_keep_gender_and_script_where_every_name_occurs(spark):
    kinds = {n: k for k, names in pii_surrogate.GIVEN.items() for n in names}
    pool = pii_surrogate.POOL
    assert all(len(p) == len(set(p)) >= 200 and not set(p) & set(kinds) for p in pool.values())
    assert sum(map(len, pool.values())) == len({n for p in pool.values() for n in p})
    out = replaced(spark, [f"{n} wrote" for n in kinds])
    got = [t.removesuffix(" wrote") for t in out]
    assert len(set(got)) == len(kinds) and all(g in pool[k] for g, k in zip(got, kinds.values()))


def test_surrogates_of_other_phones_cards_and_lone_surnames(spark):
    phones = ["+44 20 7946 0958", "+49 30 1234567", "06 12 34 56 78", "+15551234567", "(030) 1234567", "+33 (0)6 12 34 56 78", "020/7946-0958"]
    cards = ["378282246310005", "3782 822463 10005", "4222222222222", "4111 1111 1111 1111"]
    plain = "on 01.02.2024, 31.01.2024 12:30 and 2024-01-02 03:04, 09.30-17.00, 0.1234567 of 012345678, ip 0.0.0"
    name = "Anna Petrova-Lind met Mr. Smith. Smith and Petrova-Lind left; Smithson, Mc-Smith and smith stayed"
    out = replaced(spark, [f"call {p}!" for p in phones] + [f"card {c}." for c in cards] + [plain, name, "+1 555 123 4567", "4111 1111 1111 1111 123", "Smith"])
    for p, t in zip(phones, out):
        assert t != f"call {p}!" and re.sub(r"\d", "9", t) == re.sub(r"\d", "9", f"call {p}!")
    assert out[0].startswith("call +44 ") and out[2].startswith("call 06 ") and out[3].startswith("call +1")
    number = lambda t: re.sub(r"\D", "", t)
    got = out[7:11]
    assert all(t != f"card {c}." and luhn(number(t)) and len(number(t)) == len(number(c)) for c, t in zip(cards, got))
    assert number(got[0]) == number(got[1]) and out[14].startswith(number(got[3])[:4]) and number(out[14]) == number(got[3]) + "123"
    assert out[11] == plain and number(out[13]) == number(out[3]) and out[15] == "Smith"
    m = re.fullmatch(r"(\w+) ([\w-]+) met Mr\. (\w+)\. (\w+) and ([\w-]+) left; Smithson, Mc-Smith and smith stayed", out[12])
    assert m and m[2] == m[5] != "Petrova-Lind" and m[3] == m[4] != "Smith"


def test_surrogates_keep_rows_and_columns(spark):
    rows = documents() + [(1, "call 017-555-7713", "a"), (None, "call 017-555-7713", "a")]
    before = frame(spark, rows)
    after = pii_surrogate.replace_pii(before, "k")
    assert after.columns == before.columns and after.count() == len(rows)
    assert pii_surrogate.replace_pii(frame(spark, []), "k").count() == 0


# -- mixing ------------------------------------------------------------------
def test_targets_stop_at_the_cap():
    mix = mixing.Mix()
    got = mixing.targets({"b": 100, "a": 1000, None: 50, "c": 10}, mix)
    assert got["b"] <= 200 and got["c"] == 20 and got[None] == 100 and abs(sum(got.values()) - 1.5 * 1160) < 1e-9
    assert mixing.targets({}, mix) == {} and mixing.targets({"a": 0}, mix) == {"a": 0}


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F
    for n in (1, 2, 7, 100):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit("s")).alias("p")).collect()
        assert sorted(r["p"] for r in rows) == list(range(n))


@pytest.mark.parametrize("block", [4, 32])
def test_mix(spark, block):
    rows = documents()
    docs = frame(spark, rows)
    mix = mixing.Mix(block_words=block, shard_slots=64)
    mixed = mixing.mix_sources(docs, mix)
    got = mixed.taken().collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(plain_words(t))) for d, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(plain_words(t))
    want = mixing.targets(dict(sizes), mix)
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 2 * block for s in sizes)
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix_sources(docs, mix).taken().collect()))
    per_slot = mixed.slots.groupBy("source_no", "block_no").count().collect()
    assert max(r["count"] for r in per_slot) <= 2
    assert mixing.mix_sources(frame(spark, [])).taken().count() == 0


def test_mixed_documents(spark):
    rows = documents()
    docs = frame(spark, rows)
    out = mixing.mixed_documents(docs, mixing.Mix(block_words=8))
    assert out.columns == docs.columns
    texts = {t for _, t, _ in rows}
    found = out.collect()
    for r in found:
        assert r["text"] in texts or set(plain_words(r["text"])) <= {w for d, t, _ in rows if d == r["doc_id"] for w in plain_words(t)}
    distinct = {(d, t, s) for d, t, s in rows}
    assert abs(sum(len(plain_words(r["text"])) for r in found) - 1.5 * sum(len(plain_words(t)) for _, t, _ in distinct)) < 100
    assert mixing.mixed_documents(frame(spark, [])).count() == 0


def test_surrogates_of_long_domains_and_runs(spark):
    """No pattern recurses once a label, digit or letter."""
    cases = {"labels": "a@b" + ".c" * 2000, "many": "write to joe@mail" + ".com" * 100_000 + " now", "digits": "7" * 300_000, "hex": "ab12" * 50_000,
             "letters": "x" * 500_000 + "@", "dots": "a@" + "b." * 50_000, "plus": "+" + "1 " * 50_000, "at": "@" * 100_000,
             "names": "Anna " + "Lee-" * 20_000, "mixed": ("joe.doe@example.com " + "z" * 100 + " ") * 2000}
    docs = spark.createDataFrame(list(cases.items()), "doc_id string, text string")
    got = {r["doc_id"]: r["text"] for r in pii_surrogate.replace_pii(docs, "key").collect()}
    assert got["labels"] == cases["labels"] and got["letters"] == cases["letters"]
    assert "joe@" not in got["many"] and "joe.doe" not in got["mixed"] and len(set(re.findall(r"\S+@\S+", got["mixed"]))) == 1
    for name in ("digits", "hex"):  # long secrets
        assert got[name] != cases[name] and len(got[name]) == len(cases[name])


def test_surrogates_end_where_all_forms_of_a_length_occur(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    entities = [("surname", a + b) for a in letters for b in letters] + [("email", f"{a}@b.org") for a in letters] + [("ipv4", "1.2.3.4")]
    got = pii_surrogate.surrogates(spark.createDataFrame(entities, "type string, canon string"), "key").collect()
    assert sorted((r["type"], r["canon"]) for r in got) == sorted(entities)
    cores = [(r["type"], r["core"]) for r in got]
    assert len(set(cores)) == len(cores) and not set(cores) & set(entities)
    assert all(re.fullmatch("[a-z]{3,}", c) for t, c in cores if t == "surname")


# -- toxicity ----------------------------------------------------------------
def labelled():
    bad = ["idiot", "moron", "worthless", "stupid"]
    rows = []
    for i in range(240):
        words = [WORDS[(i * 5 + j * (i % 7 + 1)) % 24] for j in range(12 + i % 20)]
        if i % 4 == 0:
            words[3], words[7] = bad[i // 4 % 4], bad[(i // 4 + 1) % 4]
        rows.append((i, " ".join(words), "a"))
    return rows, [(i, int(i % 4 == 0)) for i in range(160)] + [(3, 0), (None, 1), (5, None)]


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled()
    docs = frame(spark, rows + [(900, None, "a"), (901, "", "a"), (None, "you idiot moron", "a"), (902, "alpha " * 9000 + "idiot moron", "a")])
    chain = toxicity.fit_chain(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), toxicity.default_categories())
    assert [len(m.earlier) for m in chain.links] == [0, 1, 2] and min(chain.held_out) > 0.9
    got = chain.score(docs)
    assert got.columns == docs.columns + ["p_insult", "p_degrading", "p_toxic", "toxic"]
    by_id = {r["doc_id"]: r["toxic"] for r in got.collect()}
    held = [(i, i % 4 == 0) for i in range(160, 240)]
    assert sum(by_id[i] == y for i, y in held) >= 78
    assert not by_id[900] and not by_id[901] and by_id[None] and by_id[902]


def test_toxicity_gives_every_word_a_weight(spark):
    """Hashed slots: a rare word counts like any other, and nothing grows with the number of words."""
    rows, labels = labelled()
    many = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(17_000)]
    rows += [(1000 + i, " ".join(many) + (" vile" if i < 3 else ""), "a") for i in range(6)]
    labels = labels + [(1000 + i, int(i < 3)) for i in range(6)]
    settings = toxicity.Settings(folds=2)
    chain = toxicity.fit_chain(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), {"toxic": F.col("y") == 1}, settings)
    assert len(chain.links[0].words) == settings.slots
    got = {r["doc_id"]: r["toxic"] for r in chain.score(frame(spark, rows)).collect()}
    assert [got[1000 + i] for i in range(6)] == [True] * 3 + [False] * 3


def test_toxicity_equals_a_plain_chain(spark):
    """Links solved by plain proximal gradient steps in numpy, with the same folds."""
    rows, labels = labelled()
    settings = toxicity.Settings(slots=512, folds=3, iterations=1000, penalty=0.01, tolerance=1e-12)
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    chain = toxicity.fit_chain(docs, marks, toxicity.default_categories(), settings)

    def matrix(texts):
        x = np.zeros((len(texts), settings.slots))
        for i, t in enumerate(texts):
            for w in re.findall(r"[^\W\d_]+", t.lower()):
                h = xxhash.xxh64_intdigest(w.encode(), 42)  # Spark's xxhash64 is signed, with seed 42
                x[i, (h - (1 << 64) if h >= 1 << 63 else h) % settings.slots] = 1
        return x

    def fitted(x, y):
        one = np.column_stack([x, np.ones(len(x))])
        price = np.append(np.full(x.shape[1], settings.penalty), 0)
        step = 4 * len(x) / np.linalg.norm(one, 2) ** 2
        beta = np.zeros(one.shape[1])
        for _ in range(20_000):
            beta = beta - step * (one.T @ (1 / (1 + np.exp(-one @ beta)) - y)) / len(y)
            beta = np.sign(beta) * np.maximum(np.abs(beta) - step * price, 0)
        return beta[:-1], beta[-1]

    p = lambda m, x: 1 / (1 + np.exp(-(x @ m[0] + m[1])))
    kept = toxicity.training_rows(docs, marks, settings, "doc_id", "text").collect()
    texts, y, fold = [r["text"] for r in kept], np.array([r["y"] for r in kept]), np.array([r["fold"] for r in kept])
    has = lambda seeds: np.array([bool(set(seeds) & set(t.split())) for t in texts])
    x, every = matrix(texts), matrix([t for _, t, _ in rows])
    for target in (y * has(toxicity.INSULTS), y * has(toxicity.DEGRADING), y):
        own = fitted(x, target)
        apart = np.zeros(len(x))
        for f in range(3):
            apart[fold == f] = p(fitted(x[fold != f], target[fold != f]), x[fold == f])
        x, every = np.column_stack([x, apart]), np.column_stack([every, p(own, every)])
    got = {r["doc_id"]: [r["p_insult"], r["p_degrading"], r["p_toxic"]] for r in chain.score(docs).collect()}
    assert np.allclose([got[d] for d, _, _ in rows], every[:, -3:], atol=2e-3)


def test_toxicity_with_clashing_columns(spark):
    rows, labels = labelled()
    docs = frame(spark, rows).withColumns({"toxic": F.lit("own"), "p_toxic": F.lit(7), "row": F.lit(1), "verdict": F.lit(2), "slots": F.lit(3)})
    chain = toxicity.fit_chain(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), toxicity.default_categories())
    got = chain.score(docs)
    assert len(got.columns) == len(set(got.columns)) and got.schema["toxic"].dataType.simpleString() == "boolean"
    kept = docs.where(~chain.verdict(F.col("text"))["toxic"])
    assert kept.columns == docs.columns and {r["toxic"] for r in kept.collect()} == {"own"} and {r["p_toxic"] for r in kept.collect()} == {7}


def test_toxicity_without_labels_of_both_kinds(spark):
    rows, _ = labelled()
    for labels in ([], [(1, 0), (2, 0)]):
        chain = toxicity.fit_chain(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), toxicity.default_categories())
        assert not any(r["toxic"] for r in chain.score(frame(spark, rows)).collect())


def test_scan_finds_what_its_patterns_find_one_by_one(spark):
    """The joined pattern against the plain alternatives, and the tests before it, on random strings of telling pieces."""
    rng = random.Random(9)
    pieces = ["a", "Z", "é", "Ж", "0", "7", "12", "255", "4111", "1234567", "0" * 32, "DEADBEEF" * 4, "beef" * 8, "@", ".", "-", "+", "_", "%", " ", "  ", "(", ")",
              "/", "\n", "Anna", "Иван", "Mary", "Dr", "Mr. ", "Ivanov", "Smith-Jones", "x@y.org", "10.0.0.1", "4111 1111 1111 1111", "017 555-7713", "+44 20 7946 0958",
              "06 12 34 56 78", "12.03.2001", "1.2.3.4@h.de"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = "|".join(f"(?:{p})" for p in pii_surrogate.PATTERNS.values())
    found = lambda p: F.regexp_extract_all("text", F.lit(p), F.lit(0))
    needed = F.exists(F.array(*[F.col("text").rlike(p) for p in pii_surrogate.NEEDED]), lambda x: x)
    got = df.agg(F.count_if(found(plain) != found(pii_surrogate.ANY)).alias("other"), F.count_if((F.size(found(plain)) > 0) & ~needed).alias("missed"),
                 F.count_if(F.size(found(plain)) > 0).alias("with"), F.count_if(~needed).alias("without")).first()
    assert got["other"] == 0 and got["missed"] == 0 and got["with"] > 5000 and got["without"] > 1000
