"""License scans: fuzzy search for short notices.

A text is reduced to its words (runs of ASCII letters, digits and other than ASCII characters; A-Z
lower-cased), joined by single spaces. Two searches run over the whole of it:

* phrases: places where a phrase's words stand consecutively (`base`);
* notices with up to k edits (insertions, deletions, substitutions): a notice is split into k + 1
  pieces, of which an occurrence with k edits keeps one unchanged (pigeonhole). An Aho-Corasick
  automaton finds all pieces of all notices at once; around each hit the regex library's
  bounded-error matching finds the best match, its span and its edits.

Both work on one text at a time, so the rows stay where they are: no shuffle.

Cases: null and empty texts have no words, no labels and score 0; other columns are not carried;
repeated rows are scanned alike; an empty table gives an empty result; very long texts are scanned
whole, in time that grows with their length and the number of hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table

#: Phrases and labels that the contract fixes.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


@dataclass(frozen=True)
class Notice:
    text: str  # words joined by single spaces
    label: str
    edits: int
    must: tuple[str, ...] = ()  # words that tell the license: edits are only allowed in the rest

    def pieces(self) -> list[tuple[int, str]]:
        """edits + 1 pieces that make up the text, with their offsets."""
        cuts = [len(self.text) * k // (self.edits + 1) for k in range(self.edits + 2)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


NOTICES = (
    Notice("licensed under the gnu general public license", "gpl", 4, ("general",)),
    Notice("gnu lesser general public license", "lgpl", 2, ("lesser",)),
    Notice("gnu affero general public license", "agpl", 2, ("affero",)),
    Notice("licensed under the apache license version 2 0", "apache", 4, ("apache",)),
    Notice("licensed under cc by nc", "cc-by-nc", 2, ("cc", "by", "nc")),
    Notice("licensed under cc by sa", "cc-by-sa", 2, ("cc", "by", "sa")),
    Notice("licensed under cc by nd", "cc-by-nd", 2, ("cc", "by", "nd")),
    Notice("creative commons attribution", "cc-by", 3),
    Notice("creative commons attribution noncommercial", "cc-by-nc", 4, ("noncommercial",)),
    Notice("creative commons attribution sharealike", "cc-by-sa", 4, ("sharealike",)),
    Notice("creative commons zero", "cc0", 2, ("zero",)),
    Notice("released under the mit license", "mit", 3, ("mit",)),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    Notice("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc", 8),
    Notice("released under the isc license", "isc", 3, ("isc",)),
    Notice("redistribution and use in source and binary forms with or without modification", "bsd", 7),
    Notice("released under the bsd license", "bsd", 3, ("bsd",)),
    Notice("boost software license", "bsl", 2, ("boost",)),
    Notice("subject to the terms of the mozilla public license", "mpl", 5, ("mozilla",)),
    Notice("eclipse public license", "epl", 2, ("eclipse",)),
    Notice("common development and distribution license", "cddl", 4, ("development",)),
    Notice("european union public licence", "eupl", 2, ("european",)),
    Notice("sil open font license", "ofl", 2, ("font",)),
    Notice("open database license", "odbl", 2, ("database",)),
    Notice("released into the public domain", "public-domain", 3),
    Notice("free and unencumbered software", "unlicense", 3),
    Notice("all rights reserved", "all-rights-reserved", 2),
)

_SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("score", pa.float64())])
_FIELDS = pa.schema([("n_words", pa.int64()), ("phrases", pa.list_(_SPAN)), ("notices", pa.list_(_SPAN))])
_SPARK_SPAN = "array<struct<label:string,first_word:bigint,last_word:bigint,edits:int,score:double>>"

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normalized(text: bytes) -> tuple[int, str]:
    """The number of words, and the words between single spaces, with one before and after."""
    words = text.translate(_TABLE).split()
    return len(words), " " + " ".join(x.decode() for x in words) + " " if any(c >= 128 for c in text) else (b" " + b" ".join(words) + b" ").decode()


def find_phrases(body: str, phrases=PHRASES) -> list[dict]:
    """All places of the phrases, overlapping ones too."""
    out = []
    for phrase, label in phrases:
        sought, at = f" {phrase} ", -1
        while (at := body.find(sought, at + 1)) >= 0:
            first = body.count(" ", 0, at)
            out.append({"label": label, "first_word": first, "last_word": first + phrase.count(" "), "edits": 0, "score": 1.0})
    return out


class Scanner:
    """Finds notices with a bounded number of edits."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        self.notices = notices
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.text, special_only=True)}){{e<={n.edits}}}") for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(notices):
            for offset, piece in n.pieces():
                seeds.setdefault(piece, []).append((k, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, own in seeds.items():
            self.seeds.add_word(piece, (len(piece), own))
        self.seeds.make_automaton()

    def matched(self, k: int, body: str, a: int = 0, b: int | None = None) -> regex.Match | None:
        """The best match of a notice in a part of a text, if the words that it must have are whole in it."""
        m = self.patterns[k].search(body, a, len(body) if b is None else b)
        whole = m and f" {' '.join(m[0].split())} "
        # An edit at the match's ends may have cut a word of the text: then it isn't whole either.
        if m and m.start() and body[m.start() - 1] != " " and body[m.start()] != " ":
            whole = whole[1:]
        if m and m.end() < len(body) and body[m.end()] != " " and body[m.end() - 1] != " ":
            whole = whole[:-1]
        return m if m and all(f" {w} " in whole for w in self.notices[k].must) else None

    def find(self, body: str) -> list[dict]:
        """The best match around each seed; of overlapping matches of one label, the best."""
        windows = {}
        for end, (length, own) in self.seeds.iter(body):
            for k, offset in own:
                n = self.notices[k]
                a = end - length + 1 - offset - n.edits
                windows.setdefault((k, a // (n.edits + 1)), (max(0, a - n.edits), a + len(n.text) + 3 * n.edits))
        found: dict[str, list[tuple[int, int, int, float]]] = {}
        for (k, _), (a, b) in sorted(windows.items()):
            if m := self.matched(k, body, a, b):
                start, stop = m.span()
                while start < stop and body[start] == " ":
                    start += 1
                while stop > start and body[stop - 1] == " ":
                    stop -= 1
                n = self.notices[k]
                found.setdefault(n.label, []).append((sum(m.fuzzy_counts), start, stop, 1 - sum(m.fuzzy_counts) / len(n.text)))
        out = []
        for label, matches in found.items():
            taken: list[tuple[int, int]] = []
            for edits, start, stop, score in sorted(matches):
                if all(stop <= a or start >= b for a, b in taken):
                    taken.append((start, stop))
                    out.append({"label": label, "first_word": body.count(" ", 0, start) - 1, "last_word": body.count(" ", 0, stop) - 1, "edits": edits, "score": score})
        return sorted(out, key=lambda x: (x["first_word"], x["label"]))


def scan_text(text: str | None, scanner: Scanner) -> dict:
    n, body = normalized((text or "").encode())
    return {"n_words": n, "phrases": find_phrases(body), "notices": scanner.find(body)}


def _scan(notices: tuple[Notice, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            rows = [scan_text(x.as_py(), scanner) for x in batch.column(1)]
            table = [pa.array([r[f.name] for r in rows], f.type) for f in _FIELDS]
            yield pa.record_batch([batch.column(0), *table], names=[batch.schema.names[0], *_FIELDS.names])

    return run


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """(key, n_words, phrases, notices): spans in words, with edits and a score from 0 to 1."""
    rows = docs.select(key, F.col(text).cast("string"))
    return rows.mapInArrow(_scan(notices), f"`{key}` {rows.schema[0].dataType.simpleString()}, n_words bigint, phrases {_SPARK_SPAN}, notices {_SPARK_SPAN}")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"))
    labels = lambda spans: F.transform(spans, lambda x: x["label"])
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    starts = F.transform("phrases", lambda x: x["first_word"])
    scores = F.transform(F.concat("phrases", "notices"), lambda x: x["score"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(labels(F.col("phrases"))).alias("base_labels"),
        joined(F.concat(labels(F.col("phrases")), labels(F.col("notices")))).alias("labels"),
        F.coalesce(F.array_max(scores), F.lit(0.0)).alias("score"),
        F.size("notices").cast("long").alias("n_notices"),
    )
