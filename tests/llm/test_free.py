"""The other operators against brute force, held-out accuracy or their own bounds, with odd rows."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from conftest import DATA

from tidemark.llm import html_extract, jaccard_join, licenses, lm_scoring, mixing, toxicity
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_sets, slices, word_hashes

DOC = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# Shingles and components


def test_words_and_shingles():
    import pyarrow as pa

    texts = ["A b c d e f", "a B c d e f", None, "", " x\ty\n", "x y", "é é é é é é é", "a b c d e", "q r"]
    sets = []
    for _, data, offsets in slices(pa.array(texts)):
        own, rows = shingle_sets(*word_hashes(data, offsets))
        sets += [own[a:b].tolist() for a, b in zip(rows, rows[1:], strict=False)]
    assert sets[0] == sets[1] and len(sets[0]) == 2
    assert sets[2] == sets[3] == [] and sets[4] == sets[5] and len(sets[4]) == 1
    assert len(sets[6]) == 1 and sets[7][0] in sets[0] and len(sets[8]) == 1


@pytest.mark.parametrize("n", [0, 1, 40])
def test_components(spark, n):
    rng = random.Random(n)
    links = [(rng.randint(0, n), rng.randint(0, n)) for _ in range(n)] + [(k, k + 1) for k in range(100, 100 + n)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


# Jaccard join


def joined(docs):
    sets = []
    for _, text in docs:
        w = WORD.findall(lower(text))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    least = collections.defaultdict(lambda: math.inf)
    for k, (d, _) in enumerate(docs):
        least[find(k)] = min(least[find(k)], d)
    return sorted((d, len(sets[k]), least[find(k)]) for k, (d, _) in enumerate(docs))


def test_jaccard_join(spark, documents):
    rng = random.Random(4)
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    docs += [(1000, None), (1001, ""), (1002, " \n"), (1003, "few words"), (1004, "FEW words"), (1005, "few"), (1006, "e " * 9), docs[0], (1007, "long " + " ".join(f"x{k}" for k in range(30_000)))]
    base = [f"b{k}" for k in range(150)]  # a group of near copies at about the threshold
    for k in range(60):
        own = list(base)
        for j in rng.sample(range(150), rng.randint(0, 6)):
            own[j] = f"n{rng.randint(0, 999)}"
        docs.append((2000 + k, " ".join(own)))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, DOC).selectExpr("*", "1 AS n", "2 AS comp")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(df).collect())
    assert got == joined(docs)
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({d for d, _, c in got if d == c})
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("setting", [{"STAR_ROUNDS": 0}, {"HEAVY": 3, "CELL": 64, "PACK": 500}, {"FAN": 2, "EDGES": 1}])
def test_jaccard_exact(spark, monkeypatch, setting):
    """Sets of all sizes from 1 at about the threshold; also without hubs, in many cells, with dealt hubs."""
    for name, value in setting.items():
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(9)
    docs = []
    for size in [*range(5, 24), 40, 100, 300]:
        base = [f"b{size}_{k}" for k in range(size)]
        for _ in range(14 if size == 100 else 6):
            own = base[rng.randint(0, size // 8) : size - rng.randint(0, size // 8)]
            for j in rng.sample(range(len(own)), rng.randint(0, 1 + size // 40)):
                own[j] = f"n{rng.randint(0, 9)}"
            docs.append((len(docs), " ".join(own)))
    found = jaccard_join.near_duplicates(spark.createDataFrame(docs, DOC).repartition(5))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    expected = joined(docs)
    assert got == expected
    assert 20 < len({c for _, _, c in expected}) < len(docs) - 20


def test_jaccard_pairs(spark, monkeypatch):
    """The tiles, ranks, bands and bitmaps lose no link: pairs of random subsets, each against brute force."""
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(np.arange(1, 41, dtype=np.uint64) << np.uint64(50), rng.integers(1, 41), replace=False)) for _ in range(120)]
    rows = np.cumsum([0] + [len(x) for x in sets])
    keys, row, rank, _ = jaccard_join.prefixes(np.concatenate(sets), rows, (np.concatenate(sets) >> np.uint64(53)).astype(np.int64))
    places = [dict(zip(keys[row == k].tolist(), rank[row == k].tolist(), strict=True)) for k in range(len(sets))]
    n_links = 0
    for a in range(len(sets)):
        for b in range(a):
            common, n_a, n_b = jaccard_join.overlap(sets[a], sets[b]), len(sets[a]), len(sets[b])
            if 100 * common >= 75 * (n_a + n_b - common):
                n_links += 1
                least = -(-3 * (n_a + n_b) // 7)
                assert any(places[a][x] <= n_a - least + 1 and places[b][x] <= n_b - least + 1 for x in places[a].keys() & places[b].keys())
                assert 7 * jaccard_join.differing(jaccard_join.signature(sets[a]), jaccard_join.signature(sets[b])) <= n_a + n_b
            assert jaccard_join.differing(jaccard_join.signature(sets[a]), jaccard_join.signature(sets[b])) <= n_a + n_b - 2 * common
    assert n_links > 5


def test_one_of_each_odd_ids(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(2, a), (5, b), (5, a), (5, a), (None, a + " x"), (None, b), (7, None), (7, None), (None, ""), (9, "one two"), (9, "one two"), (None, "other words here"), (None, "Other words here")]
    df = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS stays", "2 AS node")
    kept = jaccard_join.one_of_each(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    others = [x for x in got if x[0] is None and x[1]]
    assert len(others) == 1 and others[0][1].lower() == "other words here"
    assert [x for x in got if x not in others] == sorted([(2, a), (5, b), (7, None), (7, None), (None, ""), (9, "one two")], key=repr)


# Licenses


def test_licenses(spark, documents):
    notice = "Released under teh MIT Licence"
    texts = [None, "", "The MIT License, and the mit license.", notice, "x " * 1000 + "cc-by CC BY", "permission is hereby granted, free of charge, to any persn obtaining a copy", "a clean text about permission", "MIT LICENSE " * 3]
    texts += [r["text"] for r in documents.select("text").collect()]
    rows = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), DOC).selectExpr("*", "1 AS n_words")).collect()}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        places = sorted((label, i) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
        assert rows[k]["n_words"] == len(w)
        assert sorted((x["label"], x["first_word"]) for x in rows[k]["phrases"]) == places
    assert [(x["label"], x["first_word"], x["last_word"]) for x in rows[3]["notices"]] == [("mit", 0, 4)]
    assert rows[3]["notices"][0]["edits"] == 3
    assert [x["label"] for x in rows[5]["notices"]] == ["mit"]
    assert not rows[6]["notices"] and not rows[0]["phrases"]


def test_notices_by_edit_distance():
    """The seeded search finds what an exhaustive bounded-error search of all windows finds."""
    rng = random.Random(6)
    scanner = licenses.Scanner()
    for _ in range(60):
        n = rng.choice(licenses.NOTICES)
        own = list(n.text)
        for _ in range(rng.randint(0, n.edits)):
            j = rng.randrange(len(own))
            own[j : j + 1] = rng.choice([[], [rng.choice("abcxyz")], [own[j], "q"]])
        body = " " + " ".join(f"w{k}" for k in range(20)) + " " + "".join(own) + " tail "
        body = re.sub(" +", " ", body)
        if scanner.matched(licenses.NOTICES.index(n), body):
            assert n.label in {x["label"] for x in scanner.find(body)}, own


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("licensed under CC BY-SA 4.0", {"cc-by-sa"}),
        ("licensed under CC BY 4.0", set()),
        ("lisensed under CC-BY-NC", {"cc-by-nc"}),
        ("released under the ISC license", {"isc"}),
        ("released under the BSD licence", {"bsd"}),
        ("relased under the MIT licence", {"mit"}),
        ("GNU Affero General Public License", {"agpl"}),
        ("the GNU Leser General Public License", set()),
        ("the GNU Lesser Genral Public License", {"lgpl"}),
        ("", set()),
    ],
)
def test_notices_that_differ_in_a_word(text, labels):
    assert {x["label"] for x in licenses.scan_text(text, licenses.Scanner())["notices"]} == labels


def test_licenses_of_an_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], DOC)).count() == 0


# Mixing


def test_targets():
    got = mixing.targets({"a": 100, "b": 1000, None: 1000, "c": 50})
    assert sum(got.values()) == pytest.approx(1.5 * 2150)
    assert got["a"] == 200
    assert all(got[s] <= 2 * n + 1e-9 for s, n in {"a": 100, "b": 1000, None: 1000, "c": 50}.items())
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def reshared(sizes, share=1.5, most=2.0):
    """Targets by brute force: give out the words in small steps by weight, none over its cap."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)}
    low, high = 0.0, 2.0 * most * sum(sizes.values()) + 1
    for _ in range(200):
        level = (low + high) / 2
        given = sum(min(most * sizes[s], level * weight[s]) for s in order)
        low, high = (level, high) if given < share * sum(sizes.values()) else (low, level)
    return {s: min(most * sizes[s], high * weight[s]) for s in order}


@pytest.mark.parametrize("seed", range(4))
def test_targets_against_bisection(spark, seed):
    rng = random.Random(seed)
    names = [None, *rng.sample(["", "a", "B", "é", "zz", "Z", "src10", "src2", "\U0001f600", "ﬀ"], 1 + 3 * seed)]
    sizes = {s: rng.choice([0, 3, rng.randint(1, 100), rng.randint(1, 10**6)]) for s in names}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.target_table(rows).collect()}
    expected = reshared(sizes)
    for s in sizes:
        assert got[s] == pytest.approx(expected[s], rel=1e-6, abs=1e-6) == pytest.approx(mixing.targets(sizes)[s], rel=1e-6, abs=1e-6)


def test_flight_and_landing():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 400)
    p = np.full(400, 0.37)
    flown = mixing.flight(p, size, rng.random(400))
    assert ((flown > 0) & (flown < 1)).sum() <= 2
    assert flown.sum() == pytest.approx(p.sum()) and flown @ size == pytest.approx(p @ size)
    landed = mixing.landing(mixing.flight(p, size, rng.random(400), mixing.LAND), size)
    assert set(landed) <= {0.0, 1.0} and abs(landed @ size - p @ size) < 5 and abs(landed.sum() - p.sum()) < 1
    share = np.mean([mixing.flight(p[:30], size[:30], np.random.default_rng(k).random(30), 0) for k in range(800)], axis=0)
    assert np.abs(share - 0.37).max() < 0.09  # the probabilities are kept


@pytest.mark.parametrize("group_rows", [2_000, 7])
def test_mix(spark, documents, group_rows, monkeypatch):
    plain = mixing.balanced
    monkeypatch.setattr(mixing, "balanced", lambda docs: plain(docs, group_rows))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    rows += [(5000, None, "src1"), (5001, "a b c", None), (5002, "", "empty"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, DOC + ", source string").repartition(3)
    out = mixing.mix(df).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in out) == sorted((r["doc_id"], r["taken"]) for r in mixing.mix(df).collect())
    assert len(out) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    goal = mixing.targets(dict(sizes))
    taken = collections.Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    largest = max(r["size"] for r in out)
    assert all(abs(taken[s] - goal[s]) <= max(largest, 0.05 * goal[s]) for s in goal)
    mixed = mixing.taken_documents(df)
    assert sum(r["taken"] for r in mixed.collect()) == sum(taken.values())
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_small_source_beside_a_large_one(spark):
    """A source of one group lands with its dozen documents, whatever the others have."""
    rng = random.Random(3)
    rows = [(no, k, max(1, int(rng.lognormvariate(5, 1))), rng.getrandbits(62), 0.4) for no, n in ((0, 20), (1, 100), (2, 500)) for k in range(n)]
    own = [mixing.OWN + c for c in ("source_no", "row", "size", "order", "p")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(own, ("int", "long", "long", "long", "double"), strict=True)))
    got = {(r[0], r[1]): r[4] for r in mixing.balanced(df, 120).select(*own).collect()}
    assert len(got) == len(rows) and set(got.values()) == {0.0, 1.0}
    alone = {(r[0], r[1]): r[4] for r in mixing.balanced(df.filter(f"{own[0]} < 2"), 120).select(*own).collect()}
    assert all(got[k] == p for k, p in alone.items())
    for no in range(3):
        expected = sum(0.4 * size for n, _, size, _, _ in rows if n == no)
        assert abs(sum(size * got[n, k] for n, k, size, _, _ in rows if n == no) - expected) <= 0.03 * expected


# LM scoring


def test_lm_base_and_score(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(7000, None), (7001, ""), (7002, "unseenword " * 5), (None, "null id")]
    out = lm_scoring.score(spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS n_tokens").repartition(3)).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = collections.Counter()
    for d, t in rows:
        if not held(d):
            counts.update([*WORD.findall(lower(t)), None])
    n, v = sum(counts.values()), len(counts)
    by_id = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    for d, t in rows:
        tokens = [*WORD.findall(lower(t)), None]
        r = by_id[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(d), len(tokens), sum(counts[x] > 0 for x in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens))
        assert r["score"] < 0
    unseen = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_lm_is_a_distribution():
    """The probabilities of all codes in one place sum to one, whatever the tables."""
    rng = np.random.default_rng(1)
    tables = rng.normal(0, 2, (lm_scoring.TABLES, lm_scoring.SLOTS)).astype(np.float32)
    hashes = rng.integers(0, 2**63, 1 << lm_scoring.DEPTH).astype(np.uint64)
    before = rng.integers(0, 1 << lm_scoring.DEPTH, 70)
    total, alone = 0.0, None
    for code in range(1 << lm_scoring.DEPTH):
        codes = np.append(before, code)
        full = lm_scoring.score_batch(np.array([71]), codes, hashes[codes], tables)[0]
        alone = lm_scoring.score_batch(np.array([70]), before, hashes[before], tables)[0] if alone is None else alone
        total += 2 ** (full - alone)
    assert total == pytest.approx(1, abs=1e-3)


def mixed_by_loops(codes, hashes, tables, matches, rest_bits):
    """The log2 probability of one document: every decision, weight and shift for itself."""
    L, n = lm_scoring, len(codes)
    ctx = L.contexts(codes, hashes, np.arange(n) == 0)
    weights = {(d, k): float((L.INITIAL_MATCH if d == L.DEPTH else L.INITIAL)[k]) for d in range(L.DEPTH + 1) for k in range(L.TABLES + 1)}
    shifts = collections.defaultdict(float)
    total, learnt = 0.0, []
    bounds = {0, 1, 3, 7, 15, 31, *range(64, n + 64, 32)} if n else set()
    for t in range(n):
        if t in bounds:
            for key, step in learnt:
                if key[0] == "w":
                    weights[key[1:]] += step
                else:
                    shifts[key[1]] += step
            for key in shifts:
                shifts[key] = min(2.0, max(-2.0, shifts[key]))
            learnt = []
        decisions = []
        has, hit, how = (x[t] for x in matches)
        if has:
            decisions.append((L.DEPTH, float(hit), [float(how[0]), float(how[1]), 0.0, 0.0, 0.3]))
        if not (has and hit):
            total += rest_bits[t]
            for d in range(L.DEPTH):
                node = np.array([1 << d | int(codes[t]) >> (L.DEPTH - d)], np.uint64)
                x = [float(tables[k][L.slots_of(ctx[k][t : t + 1], node)[0]]) for k in range(L.TABLES)]
                decisions.append((d, float(int(codes[t]) >> (L.DEPTH - 1 - d) & 1), [*x, 0.3]))
        for d, bit, x in decisions:
            z = sum(weights[d, k] * x[k] for k in range(len(x)))
            bucket = min(L.ODDS - 1, max(0, int(z + L.ODDS / 2))) + (L.ODDS if d == L.DEPTH else 0)
            p = 1 / (1 + math.exp(-min(12, max(-12, z + shifts[bucket]))))
            total += math.log2(p if bit else 1 - p)
            learnt += [(("w", d, k), L.RATE * (bit - p) * x[k]) for k in range(len(x))] + [(("s", bucket), L.SHIFT_RATE * (bit - p))]
    return total


@pytest.mark.parametrize("n", [1, 2, 40, 150])
def test_lm_against_loops(n):
    rng = np.random.default_rng(n)
    tables = rng.normal(0, 1.5, (lm_scoring.TABLES, lm_scoring.SLOTS)).astype(np.float32)
    codes = rng.integers(0, 1 << lm_scoring.DEPTH, n)
    hashes = rng.integers(0, 2**63, n).astype(np.uint64)
    has = rng.random(n) < 0.4
    matches = has, has & (rng.random(n) < 0.8), rng.normal(1, 1, (n, 2)).astype(np.float32)
    rest = -rng.random(n) * 9
    other = np.array([3, n])  # beside another document
    both = lambda a: np.concatenate([a[:1].repeat(3, axis=0), a])
    got = lm_scoring.score_batch(other, both(codes), both(hashes), tables, tuple(both(x) for x in matches), both(rest))[1]
    assert got == pytest.approx(mixed_by_loops(codes, hashes, tables, matches, rest), rel=2e-3)


def test_lm_learns_in_short_texts():
    blocks = lm_scoring.block_of(np.arange(200))
    assert (np.diff(blocks) >= 0).all() and np.flatnonzero(np.diff(blocks)).tolist() == [0, 2, 6, 14, 30, 63, 95, 127, 159, 191]


def test_lm_matches(spark):
    """Text that another document repeats is cheap; a text that stands once is not made cheap by itself."""
    rng = random.Random(12)
    text = lambda: " ".join(f"w{rng.randint(0, 50_000)}" for _ in range(400))
    once, twice, thrice = [text() for _ in range(40)], [text() for _ in range(20)], text()
    rows = list(enumerate([*once, *twice, *twice, thrice, thrice, thrice]))
    out = {r["doc_id"]: r["bits_per_byte"] for r in lm_scoring.score(spark.createDataFrame(rows, DOC)).collect()}
    train = lambda k: zlib.crc32(str(k).encode()) % 7 != 2
    alone = [out[k] for k in range(40)]
    copied = [out[k] for k in range(40, 80) if train(40 + (k - 40 + 20) % 40)]  # the other copy trains
    assert max(copied) < 0.5 * min(alone)
    assert all(out[k] < 0.5 * min(alone) for k in range(80, 83))


def test_lm_match_decision_is_no_gain_without_a_match():
    """With a prediction, the probabilities of the predicted token and of all codes sum to one at most."""
    rng = np.random.default_rng(4)
    tables = rng.normal(0, 2, (lm_scoring.TABLES, lm_scoring.SLOTS)).astype(np.float32)
    codes = rng.integers(0, 1 << lm_scoring.DEPTH, 10)
    hashes = rng.integers(0, 2**63, 10).astype(np.uint64)
    has, how = np.arange(10) == 9, np.ones((10, 2), np.float32)
    score = lambda c, hit: lm_scoring.score_batch(np.array([10]), np.append(codes[:9], c), hashes, tables, (has, hit & has, how))[0]
    before = lm_scoring.score_batch(np.array([9]), codes[:9], hashes[:9], tables)[0]
    miss = sum(2 ** (score(c, np.zeros(10, bool)) - before) for c in range(1 << lm_scoring.DEPTH))
    assert miss + 2 ** (score(0, np.ones(10, bool)) - before) == pytest.approx(1, abs=1e-3)


def test_lm_batches_of_one_shape(spark):
    """Batches with the same ids and the same pattern of tokens, but other words, keep their own counts."""
    texts = [f"w{k}" for k in range(8) for _ in range(k + 1)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(None, t) for t in texts], len(texts)), DOC)
    counts = collections.Counter(texts) + collections.Counter({None: len(texts)})
    n, v = 2 * len(texts), len(counts)
    base = lambda t: sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in (t, None))
    got = sorted(r["base_score"] for r in lm_scoring.score(docs).collect())
    assert got == pytest.approx(sorted(base(t) for t in texts))


def test_lm_shuffles_less_than_thrice_its_text(spark):
    """Dictionaries that have most of a batch's words, the worst case for counts that travel by token."""
    rng = random.Random(5)
    rows = [(k, " ".join(f"word{rng.randint(0, 500_000)}" for _ in range(40_000))) for k in range(16)]
    docs = spark.createDataFrame(rows, DOC).repartition(4, "doc_id")
    written = lambda: sum(x.totalShuffleWrite() for x in _executors(spark))
    before = written()
    assert lm_scoring.score(docs).count() == len(rows)
    ratio = (written() - before) / sum(len(t) for _, t in rows)
    assert ratio < 3


def _executors(spark) -> list:
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return [found.apply(k) for k in range(found.size())]


def test_lm_without_training(spark):
    only = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2]
    out = lm_scoring.score(spark.createDataFrame([(k, "a b") for k in only], DOC)).collect()
    assert all(r["base_score"] == 0 and r["n_known"] == 0 and r["train_tokens"] == 0 for r in out)
    assert lm_scoring.score(spark.createDataFrame([], DOC)).count() == 0


# HTML extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="home">
<header><h1>Site</h1><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav></header><div class="cookie notice"><p>We use cookies on this site.</p></div>
<!-- ad --><div class="ad">Buy now this thing.</div><article><h1>A &amp; title</h1><p><b>First  line.<br><p>Second &eacute; &#x41;
line.</p><form><label>Your name</label><input></form><p>Third <i>and</i> <a href=x>last</a> one.</p></article>
<section id="comments"><p>A reader says this is good.</p></section><aside><p>Related things to read.</p></aside><footer>&copy; site &middot; All text.</footer></body></html>"""


def test_extract():
    model = html_extract.default_model()
    assert html_extract.extract_text(PAGE, model) == "A & title\n\nFirst line.\n\nSecond é A line.\n\nThird and last one."
    for empty in (None, "", "<html></html>", "<script>x</script>", "   "):
        assert html_extract.extract_text(empty, model) == ""
    assert len(html_extract.blocks_of("<div>" * 3000 + "deep")) == 1


def test_extract_without_head_end_and_body():
    texts = lambda page: [text for _, text, _, _ in html_extract.blocks_of(page)]
    assert texts("<head><title>T</title><meta charset=x><article><p>One.</p><p>Two.</p></article>") == ["One.", "Two."]
    assert texts("<html><head><title>T</title><b>Bold</b> text.") == ["Bold text."]
    assert texts("<head><title>T</title>Text.") == ["Text."]
    assert texts("<head><noscript><link href=x></noscript><style>p{}</style></head><body><p>One.") == ["One."]
    page = "<body><article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p><noscript><p>No script.</p></noscript><object><p>An object.</p></object><video>A film.</video><audio>A song.</audio></article>"
    assert texts(page) == ["Let x=2 be.", "No script.", "An object.", "A film.", "A song."]


#: Layouts of other kinds than the model's templates; blocks labelled by hand: + content, - other.
LAYOUTS = [
    """<body><div id=page><div class="hd"><a href=/>- Daily</a></div><div class="primary-navigation"><a href=1>- News</a> <a href=2>Sport</a></div>
    <div id=x><div><p>+ The council met on Monday and talked about the bridge for hours.</p><p>+ It will be rebuilt next year, they said, if money is found.</p></div></div>
    <div class="ft">- © 2024 Daily · All rights</div></div></body>""",
    """<body><article class="post tags"><h1>+ A tagged post</h1><p>+ Its first paragraph is quite long and tells a story about a small boat.</p><p>+ Short one.</p></article>
    <section class="comments-area"><article class="comment"><p>- I like this post a lot, thank you for writing it down.</p></article></section></body>""",
    """<body class="home blog sidebar-left"><header class="site-header"><h1>- Site</h1></header><main id="primary"><div class="entry-header"><h2>- By someone</h2></div>
    <div class="entry-content"><p>+ Growing tomatoes needs sun, water and a little patience every day.</p><ul><li>+ Sun</li><li>+ Water</li></ul><figure><img><figcaption>+ A tomato in June.</figcaption></figure>
    <div class="newsletter-signup"><p>- Get our letter every week.</p></div><p>+ In autumn the plants are cut back.</p></div></main>
    <aside class="widget-area"><h3>- Popular</h3><ul><li><a href=1>- Ten ways to cook</a></li></ul></aside><footer>- Contact us</footer></body>""",
    """<head><title>t</title><p>+ No body tag here, and no end of the head; the text goes on for a while.<p>+ A second paragraph that is not closed either, as is allowed.""",
    """<div class=wrapper><ul class="breadcrumbs"><li><a href=1>- Home</a><li><a href=2>- Articles</a></ul><div class="main-content"><h1>+ Rivers</h1><blockquote>+ All rivers run to the sea.</blockquote>
    <p>+ The formula <math><mi>v</mi><mo>=</mo><mn>3</mn></math> holds for <svg><text>small</text></svg> rivers, with <b>few</b> bends.</p><pre>+ code here</pre>
    <table><tr><td>+ Elbe</td><td>+ 1094</td></tr></table></div><div id="cookiebanner"><p>- This site uses cookies to work.</p></div><form><label>- Search</label></form></div>""",
    """<body><nav><a href=1>- A</a><a href=2>B</a></nav><section><h2>+ Opening</h2><p>+ Once there was a king who had three daughters and no money at all.</p></section>
    <section><h2>+ Ending</h2><p>+ They all lived well until the money came back, and then they did not.</p></section><div class="sponsored-box">- Buy shoes now</div><footer><small>- © The king</small></footer></body>""",
]


def test_extract_hand_labelled_layouts():
    model, right, total = html_extract.default_model(), 0, 0
    for page in LAYOUTS:
        blocks = html_extract.blocks_of(page)
        decoded = model.decode(html_extract.features([(p, text[2:] if text[:2] in ("+ ", "- ") else text, n, leaf) for p, text, n, leaf in blocks]))
        for (_, text, _, _), keep in zip(blocks, decoded, strict=True):
            assert text[0] in "+-", text
            total += 1
            right += keep == (text[0] == "+")
            if keep != (text[0] == "+"):
                print(text, keep)
    assert total >= 39 and right >= 0.95 * total
    texts = [text for _, text, _, _ in html_extract.blocks_of(LAYOUTS[4])]
    assert "+ The formula v=3 holds for small rivers, with few bends." in texts


def test_extract_cases(spark):
    html = "<canvas>In a canvas.</canvas><iframe>In a frame.</iframe>"
    assert [x[1] for x in html_extract.blocks_of(html)] == ["In a canvas.", "In a frame."]
    pages = spark.createDataFrame([(1, None, "u"), (1, "<article><p>Some words.</p></article>", None), (1, "<article><p>Some words.</p></article>", None)], "page_id long, html string, url string").selectExpr("*", "'q' AS text", "2 AS body")
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract(pages).collect()) == [(1, "", 0), (1, "Some words.", 11), (1, "Some words.", 11)]
    assert html_extract.extract(pages, ("page_id", "body")).columns == ["page_id", "body", "text", "n_chars"]
    with pytest.raises(ValueError, match="text"):
        html_extract.extract(pages, ("page_id", "text"))
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_extract_held_out():
    """Pages of another seed: the model has not seen them."""
    model = html_extract.default_model()
    right = wrong = 0
    for rows, labels in html_extract.examples(html_extract.labelled_pages(60, seed=99)):
        for a, b in zip(model.decode(rows), labels, strict=True):
            right, wrong = right + (a == b), wrong + (a != b)
    assert wrong <= 0.02 * right


def test_viterbi():
    """The decoded sequence scores best of all."""
    import itertools

    rng = np.random.default_rng(3)
    crf = html_extract.Crf({"x": 0, "y": 1, "z": 2}, rng.normal(size=(3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    rows = [["x"], ["y", "z"], ["x", "y"], ["z"], ["x"]]
    s = crf.scores(rows)
    value = lambda y: crf.start[y[0]] + sum(s[k, y[k]] for k in range(5)) + sum(crf.moves[a, b] for a, b in zip(y, y[1:], strict=False))
    assert crf.decode(rows) == list(max(itertools.product((0, 1), repeat=5), key=value))


def test_extract_pages(spark):
    """The articles of all pages, as a parser of these pages alone sees them."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    out = {r["page_id"]: r for r in html_extract.extract(pages).collect()}
    import html

    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert out[r["page_id"]]["text"] == "\n\n".join(x for x in blocks if x)
        assert out[r["page_id"]]["n_chars"] == len(out[r["page_id"]]["text"])


# Toxicity


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    chain = toxicity.train(docs, labels.filter("doc_id % 4 <> 1"))
    out = toxicity.score(docs, chain).join(labels.filter("doc_id % 4 = 1"), "doc_id").select("p_toxic", labels["toxic"]).collect()
    right = sum((r["p_toxic"] >= 0.5) == bool(r["toxic"]) for r in out)
    assert right >= 0.9 * len(out)
    assert all(r["toxic"] or r["p_toxic"] < 0.5 for r in out)


def test_chain_by_hand():
    """Each model by plain gradient descent, on out-of-fold probabilities that are worked out row by row."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 2))
    goals = [(rng.random(60) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float), (rng.random(60) < 1 / (1 + np.exp(-x[:, 1]))).astype(float)]

    def descend(rows, y):
        w = np.zeros(rows.shape[1])
        for _ in range(20_000):
            p = 1 / (1 + np.exp(-rows @ w))
            w += 0.01 * (rows.T @ (y - p) - np.append(np.ones(len(w) - 1), 1e-6) * w)
        return w

    full = np.column_stack([x, np.ones(60)])
    earlier = np.zeros(60)
    for k in range(60):
        others = [j for j in range(60) if j % toxicity.FOLDS != k % toxicity.FOLDS]
        if k < toxicity.FOLDS:
            by_fold = {} if not k else by_fold
            by_fold[k] = descend(full[others], goals[0][others])
        earlier[k] = 1 / (1 + np.exp(-full[k] @ by_fold[k % toxicity.FOLDS]))
    expected = [descend(full, goals[0]), descend(np.column_stack([x, earlier, np.ones(60)]), goals[1])]
    for got, w in zip(toxicity.chained(x, goals), expected, strict=True):
        assert np.allclose(got, w, atol=1e-3)


def test_kinds():
    """Clusters of made-up kinds of texts, the larger first."""
    rng = np.random.default_rng(5)
    x = np.zeros((90, 12))
    kind = np.arange(90) % 3 == 0  # a third
    x[kind, :6], x[~kind, 6:] = rng.random((30, 6)), rng.random((60, 6))
    assert np.array_equal(toxicity.kinds_of(x), kind.astype(int))
    assert toxicity.kinds_of(x[:1]).tolist() == [0] and len(toxicity.kinds_of(x[:0])) == 0


def test_toxicity_of_several_labels(spark):
    docs = spark.createDataFrame([(k, "you idiot moron" if k % 3 == 0 else "utter trash here" if k % 3 == 1 else "a fine day") for k in range(60)], DOC)
    labels = spark.createDataFrame([(k, int(k % 3 == 0), int(k % 3 == 1), int(k % 3 < 2)) for k in range(60)], "doc_id long, insult int, contempt int, toxic int")
    chain = toxicity.train(docs, labels, label=("insult", "contempt", "toxic"))
    out = toxicity.score(docs, chain)
    assert out.columns == ["doc_id", "p_insult", "p_contempt", "p_toxic", "toxic"]
    for r in out.collect():
        assert [r["p_insult"] > 0.5, r["p_contempt"] > 0.5, r["toxic"]] == [r["doc_id"] % 3 == 0, r["doc_id"] % 3 == 1, r["doc_id"] % 3 < 2]


def test_toxicity_cases(spark):
    docs = spark.createDataFrame([(0, None), (1, ""), (2, "you idiot moron trash"), (3, "a fine day"), (3, "a fine day")], DOC).selectExpr("*", "1 AS toxic")
    none = spark.createDataFrame([(9, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity.train(docs, none) is None
    assert [r["p_toxic"] for r in toxicity.score(docs, None).collect()] == [None] * 5
    chain = toxicity.train(docs, spark.createDataFrame([(2, 1), (2, 1), (3, 1)], "doc_id long, toxic int"))
    out = toxicity.score(docs, chain).collect()
    assert len(out) == 5 and all(r["toxic"] for r in out)
    assert toxicity.score(docs.limit(0), chain).count() == 0


def test_logistic():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=(2000, 2)), np.ones(2000)])
    y = (rng.random(2000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] - 0.5)))).astype(float)
    assert np.allclose(toxicity.logistic(x, y, ridge=1e-6), [2, -1, -0.5], atol=0.3)
