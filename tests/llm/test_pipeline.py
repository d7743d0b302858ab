"""The corpus pipeline: each stage against brute force on its own input, odd rows, and what it leaves behind."""

from __future__ import annotations

import collections
import os
import random

import corpus_pipeline
import pytest
from conftest import DATA
from test_free import WORD, joined, reshared
from test_native import base, contained, deduplicated, good_by_loops

from tidemark.llm import quality_rules
from tidemark.llm.common import OWN, mark, scratch_dir

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The documents with odd rows and planted copies, and the benchmark."""
    path = str(tmp_path_factory.mktemp("sf"))
    rng = random.Random(1)
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    words = lambda n: " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))
    own = words(200)
    rows += [
        (9000, None, None, None, None), (9001, "", "en", "x", 0), (None, words(120), None, None, None), (9002, own, "en", None, 1), (9002, own, "en", None, 1),
        (9003, own.replace("w1", "v1", 1), "en", "x", 1), (9004, words(90) + "\n" + items[0] + "\n" + words(90), "en", "y", 2), (9005, "long " + words(30_000), "en", "z", 3),
    ]
    spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'c' AS comp", "7 AS size").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_each_stage_against_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        given = rows_of(docs)
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        got = collections.Counter(rows_of(after))
        if k < 4:
            assert sorted(after.columns) == sorted(docs.columns), name
        if name == "quality rules":
            votes = [(r["doc_id"], r["text"], quality_rules.digits(r[OWN + "votes"], len(quality_rules.rules()))) for r in quality_rules.judge(docs).collect()]
            good = good_by_loops([v for *_, v in votes])
            assert got == collections.Counter((d, t) for (d, t, _), p in zip(votes, good, strict=True) if p >= 0.5 and not base(t)[-1])
        elif name == "line dedup":
            named = [(d if d is not None else -1, t) for d, t in given]  # a null id comes first
            cleaned = deduplicated(named)
            texts = [(d, cleaned[d if d is not None else -1, t]) for d, t in given]
            assert got == collections.Counter((d, t) for d, t in texts if WORD.search(t))
        elif name == "n-gram Jaccard join":
            named = sorted({(d if d is not None else 10**9, t) for d, t in given})
            stays = {(d if d != 10**9 else None, t) for (d, t), (i, _, c) in zip(named, sorted(joined(named)), strict=True) if i == c}
            assert set(got) == stays and set(got.values()) == {1}
        elif name == "benchmark decontamination":
            leaks = {d for d, *_ in contained(given, items)}
            assert got == collections.Counter((d, t) for d, t in given if d not in leaks) and 9004 in leaks
        else:
            sizes = collections.Counter()
            for r in docs.collect():
                sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
            goal, taken = reshared(dict(sizes)), collections.Counter()
            for r in after.collect():
                assert (r["size"], r["taken"]) == (len(WORD.findall(r["text"])), r["copies"] * r["size"]) and 1 <= r["copies"] <= 2
                assert r["target"] == pytest.approx(goal[r["source"]], rel=1e-6)
                taken[r["source"]] += r["taken"]
            largest = max(len(WORD.findall(t)) for _, t in given)
            assert all(abs(taken[s] - goal[s]) <= max(largest, 0.05 * goal[s]) for s in goal)
            assert set(got) <= set(given)
        assert got and len(got) < len(given) or k in (1, 4)
        docs = after


def test_run_leaves_no_scratch(spark, sf_dir):
    before = mark(spark)
    root = f"{scratch_dir(spark)}/tidemark".removeprefix("file:")
    os.makedirs(root, exist_ok=True)
    there = set(os.listdir(root))
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and mark(spark) <= before
    left = set(os.listdir(root)) - there
    assert len(left) == 1 and os.listdir(f"{root}/{left.pop()}") == ["4"]  # the result alone


def test_empty_table(spark, sf_dir, tmp_path):
    empty = str(tmp_path / "sf")
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_stages_called_without_writing(spark, sf_dir):
    """A stage drops no table that its docs still read."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() > 0
