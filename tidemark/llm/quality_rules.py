"""Quality rules with weak supervision (native).

Every rule looks at the features of a text and votes keep, reject or abstains. The rules come in
families, two views of one kind of defect. Latent classes (good, and one for each kind of defect)
explain the votes; expectation-maximisation estimates, for each rule and class, how often it casts
each vote, and how many texts each class has. The posterior probability of the good class replaces
all-must-pass filtering: one stray vote against a text that else looks good does not lose it.

The votes of a text form one small integer (3 ** number of rules values). The driver sees only the
counts of these patterns, so what it fits on has a fixed bound (3 ** 10 = 59,049 rows) but covers
all texts. The patterns' posteriors go back as a broadcast table of the same bound. Features and
votes are column expressions; no Python runs on the executors.

Cases: a null or empty text has no words, votes like a short one and fails the base rules; repeated
rows are judged alike, each on its own; an empty table gives an empty result; other columns pass
through untouched.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import OWN, materialize, read_table, words

ABSTAIN, KEEP, REJECT = 0, 1, 2
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_features(df: DataFrame, text: str = "text", prefix: str = OWN) -> DataFrame:
    """Add the features of a text as columns prefix + name."""
    p = prefix
    body = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn(f"{p}w", words(F.col(text)))
    w, n = F.col(f"{p}w"), F.size(f"{p}w")
    df = df.withColumn(
        f"{p}tri",
        F.when(
            n >= 3,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), n - 3),
                    lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
                )
            ),
        ),
    )
    tri = F.col(f"{p}tri")
    again = F.filter(tri, lambda x, k: F.get(tri, k - 1)["h"].eqNullSafe(x["h"]) | F.get(tri, k + 1)["h"].eqNullSafe(x["h"]))
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    df = df.withColumn(f"{p}lines", F.filter(F.split(body, "\n"), lambda line: F.length(F.translate(line, " \t\x0b\x0c\r", "")) > 0))
    lines = F.col(f"{p}lines")
    return df.withColumns(
        {
            f"{p}n_words": n.cast("long"),
            f"{p}word_chars": F.length(F.array_join(w, "")).cast("long"),
            f"{p}n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
            f"{p}n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            f"{p}n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            f"{p}n_distinct": F.size(F.array_distinct(w)).cast("long"),
            f"{p}n_symbol_words": F.regexp_count(body, F.lit(r"[#*$%&|<>]+(?![^\x20\x09-\x0D])")).cast("long"),
            f"{p}n_lines": F.size(lines).cast("long"),
            f"{p}n_caps": F.regexp_count(body, F.lit(r"[A-ZÀ-ÖØ-Þ]{2,}")).cast("long"),
            f"{p}n_bangs": (F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))).cast("long"),
        }
    ).drop(f"{p}w", f"{p}tri", f"{p}lines")


def rules(prefix: str = OWN) -> dict[str, tuple[str, Column, Column]]:
    """Name: (family, rejects, keeps); neither is an abstention."""
    f = lambda name: F.col(prefix + name)
    n = f("n_words")
    return {
        "words": ("short", n < 50, n >= 50),
        "characters": ("short", f("word_chars") < 150, f("word_chars") >= 200),
        "symbols": ("symbols", 10 * f("n_symbols") > 2 * n, 20 * f("n_symbols") < n),
        "symbol_words": ("symbols", 10 * f("n_symbol_words") > n, 50 * f("n_symbol_words") < n),
        "repeated_windows": ("repetition", 100 * f("n_repeat_words") > 40 * n, 100 * f("n_repeat_words") < 15 * n),
        # Against the root of the length: the share of distinct words falls with the length of any text.
        "few_distinct_words": ("repetition", f("n_distinct") * f("n_distinct") < 9 * n, f("n_distinct") * f("n_distinct") > 16 * n),
        "capitals": ("shouting", 10 * f("n_caps") > 2 * n, 20 * f("n_caps") < n),
        "exclamation": ("shouting", 10 * f("n_bangs") > 2 * n, 20 * f("n_bangs") < n),
        "copied_lines": ("copied lines", 3 * f("n_dup_lines") > f("n_lines"), 10 * f("n_dup_lines") < f("n_lines")),
        "word_length": ("word length", (f("word_chars") > 14 * n) | (f("word_chars") < 2 * n), (f("word_chars") <= 10 * n) & (f("word_chars") >= 3 * n)),
    }


def votes(prefix: str = OWN) -> Column:
    """The votes of all rules as one integer to base 3, the first rule in its lowest digit."""
    total = F.lit(0)
    for k, (_, rejects, keeps) in enumerate(rules(prefix).values()):
        total = total + F.when(rejects, REJECT).when(keeps, KEEP).otherwise(ABSTAIN) * 3**k
    return total.cast("int")


def digits(pattern: int, n_rules: int) -> list[int]:
    return [pattern // 3**k % 3 for k in range(n_rules)]


Model = tuple[list[float], list[list[list[float]]]]


def fit(patterns: dict[int, int], families: list[str], rounds: int = 40, smooth: float = 0.5) -> Model:
    """EM over the counted vote patterns: the share of each class, and P(vote | class, rule).

    families: that of each rule. Class 0 is good; the others are the families in order. A text
    starts in the classes of the rules that reject it, and half in the good one if they are few.
    All sums are over arrays of patterns x votes.
    """
    kinds, n_rules = list(dict.fromkeys(families)), len(families)
    votes_of = np.array([digits(p, n_rules) for p in sorted(patterns)])
    n = np.array([patterns[p] for p in sorted(patterns)], float)
    against = np.column_stack([(votes_of[:, [f == kind for f in families]] == REJECT).mean(axis=1) for kind in kinds])
    member = np.column_stack([np.maximum(0.01, 1 - against.sum(axis=1)), against])
    member /= member.sum(axis=1, keepdims=True)
    cast = (votes_of[:, :, None] == np.arange(3)).reshape(len(n), -1).astype(float)
    for _ in range(rounds):
        mass = member.T @ n
        share = (smooth + mass) / (smooth * (len(kinds) + 1) + n.sum())
        table = (smooth + (member * n[:, None]).T @ cast) / (3 * smooth + mass)[:, None]
        logs = np.log(share) + cast @ np.log(table).T
        member = np.exp(logs - logs.max(axis=1, keepdims=True))
        member /= member.sum(axis=1, keepdims=True)
    return share.tolist(), table.reshape(len(kinds) + 1, n_rules, 3).tolist()


def _member(vote: list[int], share: list[float], table: list[list[list[float]]]) -> list[float]:
    logs = [math.log(share[c]) + sum(math.log(table[c][k][x]) for k, x in enumerate(vote)) for c in range(len(share))]
    top = max(logs)
    raw = [math.exp(x - top) for x in logs]
    return [x / sum(raw) for x in raw]


def accuracies(patterns: dict[int, int], model: Model) -> list[float]:
    """For each rule, the estimated share of its votes (not abstentions) that are right."""
    share, table = model
    right, cast = [0.0] * len(table[0]), [0.0] * len(table[0])
    for p, n in patterns.items():
        v = digits(p, len(table[0]))
        good = _member(v, share, table)[0]
        for k, x in enumerate(v):
            if x != ABSTAIN:
                cast[k] += n
                right[k] += n * (good if x == KEEP else 1 - good)
    return [r / c if c else math.nan for r, c in zip(right, cast, strict=True)]


def posteriors(patterns: dict[int, int], model: Model) -> list[tuple[int, float]]:
    """(pattern, P(good | votes)) of each pattern that occurs."""
    n_rules = len(model[1][0])
    return [(p, _member(digits(p, n_rules), *model)[0]) for p in sorted(patterns)]


def judge(df: DataFrame, text: str = "text", columns: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """The rows with columns OWN + feature, OWN + 'base_failed', OWN + 'p_good', OWN + 'kept'.

    columns: those of df to carry along (all by default). One pass over the texts: features and
    votes are written to the shared scratch folder, counted there, and judged when read again.
    """
    columns = df.columns if columns is None else columns
    table = with_features(df.select(*{*columns, text}), text)
    table = table.withColumn(f"{OWN}votes", votes())
    own = [c for c in table.columns if c.startswith(OWN)]
    table = materialize(table.select(*columns, *own))
    counted = {r[0]: r[1] for r in table.groupBy(f"{OWN}votes").count().collect()}  # 3 ** rules rows at most
    n, r = F.col(f"{OWN}n_words"), F.col(f"{OWN}n_repeat_words")
    failed = (n < 50) | (100 * r > 50 * n)
    known = posteriors(counted, fit(counted, [family for family, _, _ in rules().values()])) if counted else []
    good = df.sparkSession.createDataFrame(known, f"{OWN}votes int, {OWN}p_good double")  # as few rows
    table = table.join(F.broadcast(good), f"{OWN}votes")
    return table.withColumn(f"{OWN}base_failed", failed).withColumn(f"{OWN}kept", ~failed & (F.col(f"{OWN}p_good") >= threshold))


def keep_good(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of df whose text the rules keep, with the columns of df."""
    return judge(df, text, threshold=threshold).filter(f"{OWN}kept").select(*df.columns)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read_table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", *[F.col(OWN + c).alias(c) for c in FEATURES], *[F.col(OWN + c).alias(c) for c in ("base_failed", "kept", "p_good")])
