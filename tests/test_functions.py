import pytest
from pyspark.sql import functions as F

from tidemark.functions import coerce, documents, pgoutput
from tidemark.functions.types import ReplicaType, from_document, from_udt


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "items"),
    [
        ('{"oak plank","four legs"}', ["oak plank", "four legs"]),
        ('{"7 mm, 9 mm","steel","a {b}"}', ["7 mm, 9 mm", "steel", "a {b}"]),
        ("{a,b}", ["a,b"]),
        ("{}", [""]),
        (None, [""]),
    ],
)
def test_string_array(spark, text, items):
    assert one(spark, coerce.string_array(F.lit(text).cast("string"))) == items


@pytest.mark.parametrize("text", ["1999-12-31 23:59:58.000001+00", "1999-12-31 23:59:58.5", "1999-12-31 23:59:58+00", "1999-12-31 23:59:58-05"])
def test_without_fraction(spark, text):
    assert one(spark, coerce.without_fraction(F.lit(text))) == "1999-12-31 23:59:58"


def test_date_alone(spark):
    assert one(spark, coerce.without_fraction(F.lit("2020-03-09"))) == "2020-03-09"


@pytest.mark.parametrize(("text", "n"), [("12", 12), (" 12 ", 12), ("1.5", 0), ("18446744073709551615", 18446744073709551615), ("18446744073709551616", 0), ("-9223372036854775808", -(2**63)), (None, 0)])
def test_integer(spark, text, n):
    assert int(one(spark, coerce.integer(F.lit(text).cast("string")))) == n


@pytest.mark.parametrize(("text", "n"), [("1e5", 1e5), ("1d", 0.0), ("inf", float("inf")), (".5", 0.5), ("x", 0.0), (None, 0.0)])
def test_real(spark, text, n):
    assert one(spark, coerce.real(F.lit(text).cast("string"))) == n


def test_types():
    assert from_udt("_int4", True).text() == "Array(Int32)"
    assert from_udt("timestamptz", True).text() == "Nullable(DateTime)"
    assert from_udt("uuid", False).text() == "String"
    assert from_document("objectId", "_id").text() == "String"
    assert from_document("objectId", "other").text() == "Nullable(String)"
    assert from_document("null") is None
    assert ReplicaType("Int8", True).text() == "Nullable(Int8)"


def _decode(spark, data: bytes):
    return pgoutput.decode(spark.createDataFrame([(bytearray(data),)], "data binary"))


def _tuple(*cells):
    out = len(cells).to_bytes(2, "big")
    for c in cells:
        out += c if c in (b"n", b"u") else b"t" + len(c).to_bytes(4, "big") + c
    return out


REL = (4_000_000_000).to_bytes(4, "big")


def test_messages(spark):
    row = _decode(spark, b"I" + REL + b"N" + _tuple("é".encode(), b"n")).first()
    assert (row["op"], row["relation_id"], [(c["kind"], c["text"]) for c in row["payload"]]) == ("I", 4_000_000_000, [("t", "é"), ("n", None)])
    row = _decode(spark, b"U" + REL + b"O" + _tuple(b"1", b"old") + b"N" + _tuple(b"1", b"u")).select(pgoutput.backfill(F.col("payload"), F.col("old_values")).alias("p")).first()
    assert [c["text"] for c in row["p"]] == ["1", "old"]
    row = _decode(spark, b"U" + REL + b"N" + _tuple(b"1", b"u")).select(pgoutput.backfill(F.col("payload"), F.col("old_values")).alias("p")).first()
    assert [(c["kind"], c["text"]) for c in row["p"]] == [("t", "1"), ("n", None)]
    row = _decode(spark, b"D" + REL + b"K" + _tuple(b"7", b"n")).first()
    assert (row["op"], row["payload"][0]["text"]) == ("D", "7")
    row = _decode(spark, b"T" + (1).to_bytes(4, "big") + b"\0" + REL).first()
    assert (row["op"], row["relation_id"]) == ("T", 4_000_000_000)
    assert _decode(spark, b"B" + b"\0" * 20).first()["op"] is None


@pytest.mark.parametrize("data", [b"", b"Z123", b"T" + bytes(4) + b"\0" + REL])
def test_broken_messages(spark, data):
    with pytest.raises(Exception, match="empty message|unknown message|no relation"):
        _decode(spark, data).collect()


@pytest.mark.parametrize(
    ("value", "kind", "text"),
    [
        ('{"$oid":"65"}', "objectId", "65"),
        ('{"$numberInt":"1"}', "int", " "),
        ('{"$date":{"$numberLong":"86400000"}}', "date", "1970-01-02 00:00:00"),
        ('{"$timestamp":{"t":60,"i":1}}', "timestamp", "1970-01-01 00:01:00"),
        ('"x"', "string", "x"),
        ("true", "bool", " "),
        ("null", "null", " "),
        ('{"a":1}', "document", " "),
        ("[1]", "array", " "),
    ],
)
def test_document_values(spark, value, kind, text):
    doc = documents.parse(F.lit('{"v":' + value + "}"))
    assert one(spark, documents.kind_of(documents.field(doc, "v"))) == kind
    assert one(spark, documents.to_string(documents.field(doc, "v"))) == text


@pytest.mark.parametrize(
    ("millis", "text"),
    [
        (2932896 * 86_400_000, "9999-12-31 00:00:00"),
        (2932897 * 86_400_000, "10000-01-01 00:00:00"),
        (6_000_000 * 86_400_000 + 3_661_999, "18397-06-11 01:01:01"),
        (-1, "1969-12-31 23:59:59"),
        (-719_529 * 86_400_000, "-0001-12-31 00:00:00"),
        (2**63 - 1, "1970-01-01 00:00:00"),
        (-(2**63), "1970-01-01 00:00:00"),
    ],
)
def test_far_dates(spark, millis, text):
    """Years after 9999 have no sign; a date that no timestamp holds is the epoch; the session's zone doesn't matter."""
    value = documents.field(documents.parse(F.lit('{"v":{"$date":{"$numberLong":"%d"}}}' % millis)), "v")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, documents.to_string(value)) == text
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
