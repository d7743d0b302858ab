import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import copytext
from tidemark.sources import snapshot

VECTORS = [
    (b"plain words", "plain words"),
    (rb'say \"hi\" and \'bye\'', "say \"hi\" and 'bye'"),
    (rb"up\ndown\tright\\left", "up\ndown\tright\\left"),
    (rb"bell\x7", "bell\x07"),
    (rb"\x5A\x5a0", "ZZ0"),
    (rb"\xE2\x82\xAC 5", "€ 5"),
    (rb"\342\202\254 6", "€ 6"),
    (rb"\60\0601", "001"),
    (rb"\N", None),
    (rb"\\N", "\\N"),
    (rb"no\Name", "noName"),
    (b"last\\", "last\\"),
    (rb"\xyz", "xyz"),
    (rb"\400\377", "400\ufffd"),
    (rb"\.\z", ".z"),
    (rb"\f\v\b\r", "\x0c\x0b\x08\r"),
    (b"\xc3\x28", "\ufffd("),
    (b"tab\\\there", "tab\there"),
]


@pytest.mark.parametrize(("raw", "text"), VECTORS)
def test_decode_field(raw, text):
    assert copytext.decode_field(raw) == text


def test_split_rows():
    assert copytext.split_rows(b"1\t2\n3\\\t4\t\n5\\\n6\t7\\\\\n8") == [[b"1", b"2"], [b"3\\\t4", b""], [b"5\\\n6", b"7\\\\"]]
    assert copytext.split_rows(b"") == []


@pytest.mark.parametrize("part", [None, 7])
def test_files_with_escaped_line_feeds(spark, tmp_path, part):
    """Also where a row goes on in the part of the file that another task reads."""
    rows = [[str(k), ("x\n" * (k % 5)) + "y", None if k % 3 else "\\"] for k in range(60)]
    raw = b"".join(b"\t".join(b"\\N" if x is None else x.encode().replace(b"\\", b"\\\\").replace(b"\n", b"\\\n") for x in r) + b"\n" for r in rows)
    (tmp_path / "t.copy").write_bytes(raw)
    (tmp_path / "u.copy").write_bytes(b"-1\ta\tb\\")
    if part:
        spark.conf.set("spark.sql.files.maxPartitionBytes", part)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = copytext.decode_lines(snapshot.read_copy_lines(spark, str(tmp_path)), canonical=None).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r["fields"] for r in got), key=lambda f: int(f[0])) == [["-1", "a", "b\\"], *rows]


def test_wrong_number_of_fields(spark):
    fields = spark.createDataFrame([(["1", "2"],), (["1"],)], "fields array<string>")
    with pytest.raises(Exception, match="has not 2 fields but 1"):
        snapshot.named_fields(fields, ["a", "b"]).collect()


def test_vectors_in_spark(spark):
    lines = spark.createDataFrame([(k, bytearray(raw + b"\t1")) for k, (raw, _) in enumerate(VECTORS) if not raw.endswith(b"\\")], "k int, value binary")
    for canonical in (False, None):
        got = {r["k"]: r["fields"] for r in copytext.decode_lines(lines, canonical=canonical).collect()}
        assert got == {k: [text, "1"] for k, (raw, text) in enumerate(VECTORS) if not raw.endswith(b"\\")}


@settings(max_examples=25, deadline=None)
@given(rows=st.lists(st.lists(st.none() | st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00")), min_size=2, max_size=2), min_size=1, max_size=5))
def test_round_trip(spark, rows):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string")
    lines = df.select("k", copytext.encode_line([F.col("a"), F.col("b")]).alias("value"))
    for canonical in (True, False, None):
        got = {r["k"]: r["fields"] for r in copytext.decode_lines(lines, canonical=canonical).collect()}
        assert got == {k: list(r) for k, r in enumerate(rows)}
