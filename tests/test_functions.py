import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stockledger import functions as C
from stockledger.operators import split_negative, split_unparsable
from stockledger.sources import avro
from tests.conftest import rows

LONGS = [0, 1, -1, 42, -999999, 2**63 - 1, -(2**63)]


def _value(spark, column, value, kind):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column(F.col("v")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, number",
    [("5", 5), ("-3", -3), ("+7", 7), ("007", 7), (str(2**63 - 1), 2**63 - 1)],
)
def test_whole_numbers_parse(spark, text, number):
    assert _value(spark, C.strict_long, text, "string") == number
    assert _value(spark, C.try_long, text, "string") == number


@pytest.mark.parametrize("text", ["x", "", " 5", "5 ", "5\n", "6.5", "1e3", "--1", str(2**63), None])
def test_anything_else_fails_or_is_null(spark, text):
    assert _value(spark, C.try_long, text, "string") is None
    with pytest.raises(PySparkException, match="not a whole number"):
        _value(spark, C.strict_long, text, "string")


def test_required(spark):
    assert _value(spark, C.required, 3, "bigint") == 3
    with pytest.raises(PySparkException, match="must not be null"):
        _value(spark, C.required, None, "bigint")


def test_non_negative(spark):
    assert _value(spark, C.non_negative, 0, "bigint") == 0
    with pytest.raises(PySparkException, match="must not be negative"):
        _value(spark, C.non_negative, -1, "bigint")


def test_fills(spark):
    assert _value(spark, C.zero_fill, None, "bigint") == 0
    assert _value(spark, C.zero_fill, 4, "bigint") == 4
    assert _value(spark, C.or_unknown, None, "bigint") == 999999


def test_long_codec_round_trip(spark):
    df = spark.createDataFrame([(v,) for v in LONGS], "v bigint")
    coded = df.select("v", C.long_to_bytes("v").alias("b")).select(
        "v", F.length("b").alias("n"), F.hex("b").alias("h"), C.long_from_bytes("b").alias("back")
    )
    for r in coded.collect():
        assert (r["n"], r["back"]) == (8, r["v"])
        assert r["h"] == r["v"].to_bytes(8, "big", signed=True).hex().upper()


def test_signs(spark):
    df = spark.createDataFrame([("+", 5), ("-", 2)], "s string, v bigint")
    assert rows(df.select(C.signed_case("s", "v").alias("v"))) == [(-2,), (5,)]
    bad = spark.createDataFrame([("?", 5)], "s string, v bigint")
    with pytest.raises(PySparkException, match="sign must be"):
        bad.select(C.signed_case("s", "v")).collect()


def test_upper_is_full_case_mapping(spark):
    assert _value(spark, C.upper_line, "straße é", "string") == "STRASSE É"


def test_splits(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "2"), ("1", None)], "a string, b string")
    good, bad = split_unparsable(df, ["a", "b"])
    assert rows(good) == [(1, 2)]
    assert rows(bad) == [("1", None), ("x", "2")]
    numbers = spark.createDataFrame([(3,), (-3,), (0,), (None,)], "quantity bigint")
    good, bad = split_negative(numbers)
    assert rows(good) == [(0,), (3,)] and rows(bad) == [(-3,), (None,)]


def test_registry_framing(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),)], "p binary")
    framed = df.select(avro.frame(F.col("p"), 258).alias("value"))
    got = framed.select("value", avro.schema_id("value").alias("id"), avro.payload("value").alias("p"))
    r = got.first()
    assert bytes(r["value"]) == b"\x00\x00\x00\x01\x02abc"
    assert r["id"] == 258 and bytes(r["p"]) == b"abc"
    with pytest.raises(PySparkException, match="framing byte"):
        df.select(avro.payload("p")).collect()
