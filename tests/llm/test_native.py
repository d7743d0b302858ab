"""The native operators (1, 3, 4, 8) against brute force, with odd rows."""

from __future__ import annotations

import collections
import random
import re

import duckdb
import pytest
import xxhash
from conftest import DATA

from tidemark.llm import decontaminate, line_dedup, quality_rules, registry, url_filters
from tidemark.llm.common import OWN

DOC = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, schema=DOC):
    return spark.createDataFrame(list(enumerate(texts)), schema)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, same_as_sql, name):
    same_as_sql(registry.queries()[name](spark, DATA), registry.oracle_sql()[name])


# Quality rules


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


ODD = [None, "", " \t\n", "one", "a b a b a b", "x\n\nx\n y \nx\n", "é ö #*$%&|<> \x0b\x0c\r", "w " * 60, "\U0001f600 " * 3, "a b c d a b c", "word " * 30_000]


def test_quality_features(spark, documents):
    texts = ODD + [r["text"] for r in documents.select("text").collect()]
    judged = quality_rules.judge(docs_of(spark, texts)).collect()
    got = {r["doc_id"]: (*[r[OWN + c] for c in quality_rules.FEATURES], r[OWN + "base_failed"]) for r in judged}
    assert got == {k: base(t) for k, t in enumerate(texts)}
    assert all(not (r[OWN + "base_failed"] and r[OWN + "kept"]) for r in judged)


def test_quality_posterior(spark, documents):
    """The SQL posterior is the model's, and follows the labels."""
    judged = quality_rules.judge(documents).join(spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality"), "doc_id", "left").collect()
    counts = collections.Counter(r[OWN + "votes"] for r in judged)
    families = [f for f, _, _ in quality_rules.rules().values()]
    share, table = quality_rules.fit(counts, families)
    for r in judged:
        assert r[OWN + "p_good"] == pytest.approx(quality_rules._member(quality_rules.digits(r[OWN + "votes"], len(families)), share, table)[0], abs=1e-9)
    told = [r for r in judged if r["quality"] is not None and not r[OWN + "base_failed"]]
    assert sum(r[OWN + "kept"] == bool(r["quality"]) for r in told) >= 0.95 * len(told)


def test_quality_estimates():
    """EM finds the classes of made-up votes, and which rules are right."""
    rng = random.Random(1)
    patterns = collections.Counter()
    for _ in range(3000):
        bad = rng.random() < 0.2
        vote = [2 if rng.random() < (0.9 if bad else 0.02) else 1 for _ in range(2)] + [2 if rng.random() < 0.3 else 1 for _ in range(2)]
        patterns[sum(v * 3**k for k, v in enumerate(vote))] += 1
    model = quality_rules.fit(patterns, ["a", "a", "b", "b"])
    right = quality_rules.accuracies(patterns, model)
    assert min(right[:2]) > max(right[2:])
    assert quality_rules._member([2, 2, 1, 1], *model)[0] < 0.1 < 0.5 < quality_rules._member([1, 1, 1, 1], *model)[0]


def test_quality_rules_alike_at_every_length(spark):
    """A vocabulary that suits a text of 900 words suits one of 5,000 too: no rule changes at a length."""
    rng = random.Random(4)
    for n in (900, 5_000):
        text = " ".join(f"w{rng.randint(0, 399)}" for _ in range(n))
        names = list(quality_rules.rules())
        vote = quality_rules.judge(docs_of(spark, [text])).first()[OWN + "votes"]
        assert quality_rules.digits(vote, len(names))[names.index("few_distinct_words")] == quality_rules.KEEP


def good_by_loops(all_votes):
    """P(good) of each document by EM in plain loops over documents."""
    families = [f for f, _, _ in quality_rules.rules().values()]
    kinds = list(dict.fromkeys(families))
    member = []
    for v in all_votes:
        against = [sum(x == 2 for x, f in zip(v, families, strict=True) if f == kind) / families.count(kind) for kind in kinds]
        raw = [max(0.01, 1 - sum(against)), *against]
        member.append([x / sum(raw) for x in raw])
    for _ in range(40):
        mass = [sum(m[c] for m in member) for c in range(len(kinds) + 1)]
        share = [(0.5 + x) / (0.5 * len(mass) + len(all_votes)) for x in mass]
        table = [[[(0.5 + sum(m[c] for m, v in zip(member, all_votes, strict=True) if v[k] == x)) / (1.5 + mass[c]) for x in (0, 1, 2)] for k in range(len(families))] for c in range(len(mass))]
        member = []
        for v in all_votes:
            raw = [share[c] for c in range(len(mass))]
            for k, x in enumerate(v):
                raw = [p * table[c][k][x] for c, p in enumerate(raw)]
            member.append([p / sum(raw) for p in raw])
    return [m[0] for m in member]


def test_quality_against_loops(spark, documents):
    """EM, the posterior and the verdict of every document against sums in plain loops."""
    judged = quality_rules.judge(documents).collect()
    for r, good in zip(judged, good_by_loops([quality_rules.digits(r[OWN + "votes"], len(quality_rules.rules())) for r in judged]), strict=True):
        assert r[OWN + "p_good"] == pytest.approx(good, abs=1e-6)
        assert r[OWN + "kept"] == (not base(r["text"])[-1] and r[OWN + "p_good"] >= 0.5)


def test_quality_empty_and_extra_columns(spark):
    extra = docs_of(spark, ODD).selectExpr("*", "'x' AS n_words", "1 AS kept")
    assert quality_rules.keep_good(extra).columns == extra.columns
    assert quality_rules.keep_good(extra.limit(0)).count() == 0
    twice = "The quick brown fox jumps over a lazy dog. " + " ".join(f"w{k}" for k in range(120))
    assert quality_rules.keep_good(docs_of(spark, [twice, twice])).count() == 2


# URL filters

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "HTTP://WWW.Example.COM/en/75?x#y",
    "http://example.com/en/8",
    "http://example.com/en/7",
    "http://notexample.com/en/7",
    "http://com/en/",
    "http://a.net/de/8",
    "http://a.example.net/de/8x",
    "http://x.org/es/?q",
    "http://x.org/es",
    "http://x.org#/es/",
    "http://www.casino-win.example.com/fr/1",
    "http://mycasino-win.example.com/fr/1",
    "x://a?b://c/en/",
    "http://example.com//en/7",
]


def test_urls(spark, duck, same_as_sql):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    got = url_filters.filter_urls(pages)
    rows = {r["page_id"]: r for r in got.collect()}
    assert len(rows) == len(URLS)
    for k, u in enumerate(URLS):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [r for r in url_filters.SITE_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        spam = any(re.search(r.pattern, host + path) for r in url_filters.PATTERN_RULES)
        verdict = best.verdict if best else "block" if spam else "allow"
        assert (rows[k]["host"], rows[k]["path"], rows[k]["rule"], rows[k]["verdict"]) == (host, path, best.text if best else None, verdict), u
    assert url_filters.filter_urls(pages.limit(0)).count() == 0
    assert url_filters.filter_urls(pages.union(pages)).count() == 2 * len(URLS)


def test_urls_odd_rules(spark, monkeypatch):
    """Capitals in a rule's path, rules without a token, keys named like results, very long URLs."""
    urls = ["http://a.example.com/Foo/x", "http://a.example.com/foo/x", "http://b.org/-/", "http://c.org/x", None, "http://d.org/" + "y" * 200_000 + "/z9z", "http://E.Example.com/"]
    sites = (url_filters.SiteRule("block", "Example.com", "/Foo/"), url_filters.SiteRule("allow", "example.com", "/"))
    patterns = (url_filters.PatternRule("/-/$", ()), url_filters.PatternRule("z9z$", ("Z9Z",)))
    pages = spark.createDataFrame(list(enumerate(urls)), "host long, url string").selectExpr("*", "1 AS rule", "2 AS token")
    for bound in (50_000, 0):
        monkeypatch.setattr(url_filters, "BROADCAST_RULES", bound)
        got = {r["host"]: (r["verdict"], r["rule"]) for r in url_filters.filter_urls(pages, "host", "url", sites, patterns).collect()}
        assert [got[k][0] for k in range(len(urls))] == ["block", "allow", "block", "allow", "allow", "block", "allow"]
        assert got[0][1] == "Example.com/Foo/" and got[1][1] == got[6][1] == "example.com/"
    assert url_filters.filter_urls(pages, "host").columns == ["host", "url_host", "path", "rule", "verdict", "pattern"]


def test_urls_past_the_broadcast_bound(spark, monkeypatch):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    near = sorted(url_filters.filter_urls(pages).collect())
    monkeypatch.setattr(url_filters, "BROADCAST_RULES", 0)
    assert sorted(url_filters.filter_urls(pages).collect(), key=repr) == sorted(near, key=repr)


# Line dedup


def chunks(text):
    """(first, last) of the content-defined chunks."""
    lines = text.split("\n")
    n = [len(WORD.findall(x)) for x in lines]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    first = 0
    for i in range(len(lines)):
        rolled = h[i] ^ ((h[i - 1] << 1) & (2**64 - 1) if i else 0)
        if i == len(lines) - 1 or n[i] > 50 or n[i + 1] > 50 or rolled & 3 == 0:
            yield first, i
            first = i + 1


def windows(text):
    """(first, last) of the fewest lines with over 50 words from or up to each line with words."""
    n = [len(WORD.findall(x)) for x in text.split("\n")]
    worded = [i for i, x in enumerate(n) if x]
    for k, i in enumerate(worded):
        last = next((j for j in worded[k:] if sum(n[i : j + 1]) > 50), None)
        first = next((j for j in worded[k::-1] if sum(n[j : i + 1]) > 50), None)
        yield from [(i, last)] if last is not None else []
        yield from [(first, i)] if first is not None else []


def deduplicated(docs):
    """By text of each (id, text), with ids in order."""
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42)
    out, kept = {}, {}  # kept: of each chunk's bytes, where it stands first
    for k, t in sorted({(k, t) for k, t in docs if t is not None}, key=lambda x: (x[0], signed(x[1]) - (2**64 if signed(x[1]) >= 2**63 else 0))):
        lines, gone = t.split("\n"), set()
        n = [len(WORD.findall(x)) for x in lines]
        for a, b in sorted({*chunks(t), *windows(t)}):
            if sum(x > 0 for x in n[a : b + 1]) >= 2 or sum(n[a : b + 1]) > 50:
                where = kept.setdefault("\n".join(lines[a : b + 1]), (k, t, a, b))
                if where[:2] != (k, t) or a > where[3]:
                    gone |= set(range(a, b + 1))
        out[k, t] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_line_dedup(spark, documents):
    long = " ".join(f"p{k}" for k in range(60))
    texts = [None, "", "\n", "a b\nc d", f"start one\n{long}\nend one", f"{long}\nother end", f"x\n{long}", "a b\nc d", f"{long}\n{long}", " \n\t"]
    texts += [r["text"] for r in documents.select("text").collect()]
    rows = list(enumerate(texts)) + [(4, texts[4])]
    got = [(r["doc_id"], r["text"], r[f"{OWN}removed"]) for r in line_dedup.deduplicate(spark.createDataFrame(rows, DOC)).collect()]
    expected = deduplicated(rows)
    assert len(got) == len(rows)
    by_id = collections.defaultdict(set)
    for k, t in rows:
        by_id[k].add(t if t is None else expected[k, t])
    assert all(t in by_id[k] for k, t, _ in got)
    assert by_id[5] == {"other end"} and by_id[4] == {f"start one\n{long}\nend one"} and by_id[8] == {""}
    kept = line_dedup.clean(spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS n_lines"))
    assert kept.columns == ["doc_id", "text", "n_lines"]
    assert 8 not in {r["doc_id"] for r in kept.collect()} and {0, 1} <= {r["doc_id"] for r in kept.collect()}
    assert line_dedup.clean(spark.createDataFrame([], DOC)).count() == 0


def test_line_dedup_past_the_broadcast_bound(spark, documents, monkeypatch):
    near = sorted(line_dedup.clean(documents).collect())
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    assert sorted(line_dedup.clean(documents).collect()) == near


@pytest.mark.parametrize("n_lines,n_words", [(3, 18), (5, 12), (6, 12), (8, 12), (20, 12), (3, 20), (2, 40), (1, 51)])
def test_line_dedup_planted_passages(spark, n_lines, n_words):
    """All lines of a passage of over 50 words go from the later texts, whatever short lines are around it."""
    rng = random.Random(n_lines)
    line = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    rows, expected = [], {}
    for k in range(30):
        passage = [line(n_words) for _ in range(n_lines)]
        if n_lines > 2:
            passage.insert(2, "")
        for copy in range(3):
            before, after = [line(rng.randint(3, 15)) for _ in range(rng.randint(0, 9))], [line(rng.randint(3, 15)) for _ in range(rng.randint(0, 9))]
            rows.append((3 * k + copy, "\n".join(before + passage + after)))
            expected[3 * k + copy] = "\n".join(before + after if copy else before + passage + after)
    got = line_dedup.deduplicate(spark.createDataFrame(rows, DOC)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == expected


def test_line_dedup_has_no_switch_by_line_length(spark):
    """A repeated line of 19, 20 or 50 words alone is no passage; one of 51 words is."""
    rng = random.Random(8)
    for n, goes in ((19, False), (20, False), (50, False), (51, True)):
        line = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
        rows = [(k, "\n".join([f"before {n} {k}", line, f"after {n} {k}"])) for k in range(40)]
        got = line_dedup.deduplicate(spark.createDataFrame(rows, DOC)).filter(f"{OWN}removed > 0").count()
        assert got == (39 if goes else 0)


def test_line_dedup_hot_chunk(spark, monkeypatch):
    """One passage in all documents is dealt over many tasks."""
    monkeypatch.setattr(line_dedup, "FAN", 7)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage}\nown words {k}") for k in range(200)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {k: t if not k else f"own words {k}" for k, t in rows}


def test_line_dedup_repeats_within_a_text(spark):
    """Equal lines: what overlaps the first occurrence is no repetition."""
    same, short = "ten words in a line that stands here many times", "\n".join(["a b c d e"] * 10)
    got = line_dedup.removals(spark.createDataFrame([(0, "\n".join([same] * 12)), (1, short)], DOC)).filter("NOT cut").collect()
    assert all(r["first"] > 0 for r in got)
    assert {k for r in got for k in range(r["first"], r["last"] + 1)} == set(range(6, 12))


def test_chunks_resist_shifts():
    """Lines put in front move no chunk beyond the first boundary."""
    rng = random.Random(5)
    lines = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 9))) for _ in range(80)]
    cut = lambda own: {"\n".join(own[a : b + 1]) for a, b in chunks("\n".join(own))}
    before = cut(lines)
    after = cut(["new line", "another"] + lines)
    assert len(before - after) <= 2


# Decontamination


def contained(docs, items):
    def words(t):
        return [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]

    def grams(w, width):
        return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}

    for i, item in items:
        w = words(item)
        own = grams(w, min(5, len(w))) if w else set()
        for d, text in docs:
            found = len(own & grams(words(text), min(5, len(w)))) if own else 0
            if own and found * 100 >= 75 * len(own):
                yield d, i, found, len(own)


def test_decontamination(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda: f"w{rng.randint(0, 400)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([3, 5, 8, 30, 60])))) for k in range(20)] + [(20, None), (21, "  ,, "), (22, "One two"), (23, "One two")]
    docs = [(0, None), (1, ""), (2, "so one, TWO three"), (3, " ".join(word() for _ in range(20_000)))]
    for k, (_, text) in enumerate(items[:20]):
        own = text.split()
        for j in rng.sample(range(len(own)), len(own) // 20):
            own[j] = "changed"
        docs.append((4 + k, " ".join([word() for _ in range(rng.randint(0, 300))] + [x.upper() + "," for x in own] + [word() for _ in range(40)])))
    docs.append(docs[5])
    docs += [(30, "so One,two it is"), (31, "one too"), (32, " ".join(word() for _ in range(700)) + " one two")]
    d = spark.createDataFrame(docs, DOC).selectExpr("*", "7 AS item_id")
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(set(contained(docs, items)))
    got = lambda: sorted((r["doc_id"], r["item_id"], r["n_found"], r["n_item"]) for r in decontaminate.leaks(d, b).collect())
    assert got() == expected and len(expected) > 10
    assert {r["doc_id"] for r in decontaminate.without_leaks(d, b).collect()} == {k for k, _ in docs} - {k for k, *_ in expected}
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert got() == expected
    con = duckdb.connect()
    import pandas

    con.register("documents", pandas.DataFrame({"doc_id": [k for k, _ in docs], "text": [t for _, t in docs]}))
    con.register("benchmark", pandas.DataFrame({"item_id": [k for k, _ in items], "text": [t for _, t in items]}))
    by_sql = con.execute(f"SELECT doc_id, item_id, n_found, n_item FROM ({decontaminate.ORACLE_SQL})").fetchall()
    assert sorted(by_sql) == expected and {(30, 22), (32, 23)} <= {x[:2] for x in expected}
    assert decontaminate.leaks(d.limit(0), b).count() == 0 and decontaminate.leaks(d, b.limit(0)).count() == 0
