"""URL filters indexed by token (native).

Two kinds of rules judge a URL. Site rules (a host with all its subdomains, and a path prefix) say
block or allow, the longest that fits wins. Pattern rules are regular expressions over the URL that
block what no site rule decides. Every rule is filed under one literal token that each URL it fits
must contain: the one that is rarest in the URLs at hand. A URL's tokens fetch the candidate rules,
and only those run their regular expression. Rules without such a token run on every URL. Tokens and
hosts are compared with A-Z lower-cased, paths as they are.

The rule table is the caller's parameter; it is broadcast while it has at most BROADCAST_RULES
rows. Beyond that a bitmap of the rules' tokens, of a fixed size, thins out the URLs' tokens before a
shuffle join by token.

Cases: a null URL or one without "://" has an empty host and path, which no site rule fits, and is
allowed unless a pattern blocks it (null: never); repeated rows are judged alike, each on its own;
an empty table gives an empty result; other columns are not carried; a key named like a column of
the result keeps its name, and that column is then called url_ + its name; URLs are judged whole,
however long.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import OWN, ascii_lower, likely_in, materialize, read_table

BROADCAST_RULES = 50_000


def _lower(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return text.translate({c: c + 32 for c in range(65, 91)})


@dataclass(frozen=True)
class SiteRule:
    verdict: str
    host: str
    path: str  # starts with /

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """Over host + path, where the host has no slash."""
        return rf"^(?:[^/]*\.)?{re.escape(_lower(self.host))}{re.escape(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Those that a fitting URL has whole: the last of the path may go on in the URL."""
        path = re.findall("[a-z0-9]+", _lower(self.path))
        if re.search("[A-Za-z0-9]$", self.path):
            path = path[:-1]
        return re.findall("[a-z0-9]+", _lower(self.host)) + path


@dataclass(frozen=True)
class PatternRule:
    """Blocks a URL whose host + path has the pattern. tokens: literals that it must then contain as whole tokens."""

    pattern: str
    tokens: tuple[str, ...]
    verdict: str = "block"

    @property
    def text(self) -> str:
        return self.pattern


#: The site rules that the contract fixes.
SITE_RULES = (
    SiteRule("block", "com", "/en/"),
    SiteRule("allow", "example.com", "/en/7"),
    SiteRule("allow", "net", "/de/"),
    SiteRule("block", "example.net", "/de/8"),
    SiteRule("block", "org", "/es/"),
)

#: Words that a host label names an unwanted kind of site by, alone or between hyphens.
UNWANTED = {
    "gambling": "bets betting bingo casino casinos gambling jackpot lottery poker roulette slots sportsbook",
    "medicines": "cialis meds pharma pills steroids viagra xanax",
    "adult": "adult cams escort hentai nude porn sex xxx",
    "advertising": "ads adserver adservice advert banners clickbait popunder popups tracker",
    "spam and malware": "crack cracks hacked keygen linkfarm malware nulled phishing spam torrent torrents warez",
    "loans": "forex loans payday",
}


def host_word(word: str) -> PatternRule:
    """Blocks hosts with the word in a label."""
    return PatternRule(rf"^(?:[^/]*[^a-z0-9/])?{word}(?:[^a-z0-9/]|/|$)", (word,))


PATTERN_RULES = tuple(host_word(w) for words in UNWANTED.values() for w in words.split())


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.locate("://", url) + 3)
    return F.when(F.locate("://", url) > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.locate("://", url) + 3)
    return F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _tokens(site: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(ascii_lower(site), "[^a-z0-9]+"), ""))


def _fetched(urls: DataFrame, table: DataFrame, n_rules: int, how: str = "inner") -> DataFrame:
    """urls, a row a token, joined with a table by token."""
    if n_rules > BROADCAST_RULES:
        return likely_in(urls, F.xxhash64("token"), table, F.xxhash64("token"), n_rules).join(table, "token", how)
    return urls.join(F.broadcast(table), "token", how)


def index(sites: DataFrame, rules: list) -> DataFrame:
    """The rules as rows (token, text, verdict, pattern, is_site), each under its rarest token; '' for a rule without any.

    sites: has OWN + 'tokens', the distinct tokens of each URL; all URLs count.
    """
    schema = "rule_no int, text string, verdict string, pattern string, is_site boolean, tokens array<string>"
    rows = [(k, r.text, r.verdict, r.pattern, isinstance(r, SiteRule), [_lower(t) for t in r.tokens] or [""]) for k, r in enumerate(rules)]
    table = sites.sparkSession.createDataFrame(rows, schema).select("*", F.explode("tokens").alias("token"))
    wanted = table.select("token").distinct()
    seen = _fetched(sites.select(F.explode(f"{OWN}tokens").alias("token")), wanted, len(rules), "left_semi").groupBy("token").count()
    rarest = F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token"))
    return table.join(seen, "token", "left").groupBy("rule_no", "text", "verdict", "pattern", "is_site").agg(rarest.alias("token"))


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", site_rules: tuple = SITE_RULES, pattern_rules: tuple = PATTERN_RULES) -> DataFrame:
    """(key, host, path, rule, verdict, pattern): one row for each row of pages.

    rule: the text of the longest fitting site rule (the last by text among equals); pattern: the
    first by text that blocks, where no site rule fits.
    """
    rules = [*site_rules, *pattern_rules]
    no, host, path = f"{OWN}row", f"{OWN}host", f"{OWN}path"
    sites = pages.select(F.col(key).alias(f"{OWN}key"), host_of(F.col(url)).alias(host), path_of(F.col(url)).alias(path))
    sites = sites.withColumn(f"{OWN}tokens", _tokens(F.concat(host, path)))
    large = len(rules) > BROADCAST_RULES
    filed = index(sites, rules)
    sites = sites.withColumn(no, F.monotonically_increasing_id())
    sites = materialize(sites) if large else sites
    every = F.array(F.lit("")) if any(not r.tokens for r in rules) else F.array().cast("array<string>")
    own = [no, f"{OWN}key", host, path]
    if large:
        met = _fetched(sites.select(no, F.explode(F.concat(every, f"{OWN}tokens")).alias("token")), filed, len(rules))
        fetched = sites.select(*own).join(met, no, "left")
    else:
        # The tokens of a row stay in its partition: partial aggregation leaves one row a page to shuffle.
        fetched = sites.select(*own, F.explode_outer(F.concat(every, f"{OWN}tokens")).alias("token")).join(F.broadcast(filed), "token", "left")
    fits = F.col("pattern").isNotNull() & F.regexp_like(F.concat(host, path), F.col("pattern"))
    best = F.max(F.when(fits & F.col("is_site"), F.struct(F.length("text").alias("n"), F.col("text").alias("text"), F.col("verdict").alias("verdict"))))
    out = fetched.groupBy(*own).agg(best.alias("site"), F.min(F.when(fits & ~F.col("is_site"), F.struct("text", "verdict"))).alias("other"))
    columns = {
        "host": F.col(host),
        "path": F.col(path),
        "rule": F.col("site.text"),
        "verdict": F.coalesce("site.verdict", "other.verdict", F.lit("allow")),
        "pattern": F.when(F.col("site").isNull(), F.col("other.text")),
    }
    return out.select(F.col(f"{OWN}key").alias(key), *[c.alias(f"url_{n}" if n == key else n) for n, c in columns.items()])


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages")).drop("pattern")


ORACLE_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), sites AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), fits AS (
  SELECT s.page_id, s.host, s.path, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY s.page_id, s.host, s.path ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS place
  FROM sites s LEFT JOIN rules r ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host || path, '^([^/]*[^a-z0-9/])?({'|'.join(w for words in UNWANTED.values() for w in words.split())})([^a-z0-9/]|/|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE place = 1
"""
