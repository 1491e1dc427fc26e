"""Computed and reported column statistics."""

import base64
import json
from decimal import Decimal

from pyspark.sql import functions as F

from metaspark.operators import profile as pr


def sample(spark):
    return spark.createDataFrame(
        [(1, 1.5, "a", True, Decimal("1.10"), None), (None, 2.5, "bbb", False, None, bytearray(b"\xc3\xa9")),
         (3, None, None, None, Decimal("-7.25"), bytearray(b"x")), (3, 2.5, "é", True, Decimal("1.10"), bytearray(b"x"))],
        "i int, d double, s string, b boolean, m decimal(10,2), x binary",
    )


def test_number_exact(spark):
    got = {r.column_name: r for r in pr.number_stats(sample(spark), ["i", "d"]).collect()}
    assert (got["i"].low_value, got["i"].high_value, got["i"].nulls_count, got["i"].unique_count) == (1.0, 3.0, 1, 2)
    assert got["d"].mean_value is None and got["d"].median_value is None
    more = {r.column_name: r for r in pr.number_stats(sample(spark), ["d"], extended=True).collect()}
    assert round(more["d"].mean_value, 6) == round(6.5 / 3, 6) and more["d"].median_value == 2.5


def test_lengths_count_characters_or_bytes(spark):
    s = pr.string_stats(sample(spark), ["s"]).first()
    assert (s.max_length, round(s.avg_length, 6), s.nulls_count, s.unique_count) == (3, round(5 / 3, 6), 1, 3)
    x = pr.binary_stats(sample(spark), ["x"]).first()
    assert (x.max_length, x.nulls_count, x.unique_count) == (2, 1, 2)
    assert "unique_count" not in pr.binary_stats(sample(spark), ["x"], distinct=None).columns


def test_boolean_and_decimal(spark):
    b = pr.boolean_stats(sample(spark), ["b"]).first()
    assert (b.true_count, b.false_count, b.nulls_count) == (2, 1, 1)
    m = pr.decimal_stats(sample(spark), ["m"]).first()
    assert (m.low_value, m.high_value, m.unique_count) == (Decimal("-7.25"), Decimal("1.10"), 2)


def test_exact_and_approximate_modes_agree(spark):
    df = spark.range(20000).selectExpr("id % 977 as a", "cast(id % 13 as double) as b")
    exact = {r.column_name: r for r in pr.number_stats(df, ["a", "b"]).collect()}
    approx = {r.column_name: r for r in pr.number_stats(df, ["a", "b"], distinct="approx").collect()}
    for name in exact:
        assert exact[name].low_value == approx[name].low_value and exact[name].high_value == approx[name].high_value
        assert abs(exact[name].unique_count - approx[name].unique_count) <= 0.15 * exact[name].unique_count


def test_profile_covers_every_column(spark):
    got = {r.column_name: r.kind for r in pr.profile(sample(spark)).collect()}
    assert got == {"i": "number", "d": "number", "s": "string", "b": "boolean", "m": "number", "x": "binary"}


def encode(value, width):
    return base64.b64encode(value.to_bytes(width, "big", signed=True)).decode()


def test_reported_decimal(spark):
    values = [(0, 1), (1, 1), (-1, 1), (12345, 4), (-12345, 4), (2**63, 9), (-(2**63), 8), (10**37, 16), (-(10**37), 16)]
    df = spark.createDataFrame([(i, encode(v, w)) for i, (v, w) in enumerate(values)], "i int, e string")
    got = [int(r[0]) for r in df.select("i", pr.unscaled_value(F.col("e")).alias("v")).orderBy("i").select("v").collect()]
    assert got == [v for v, _ in values]


def test_reported_kinds(spark):
    reports = [
        {"Type": "LONG", "LongColumnStatisticsData": {"MinimumValue": 1, "MaximumValue": 9, "NumberOfNulls": 2, "NumberOfDistinctValues": 5}},
        {"Type": "DECIMAL", "DecimalColumnStatisticsData": {
            "MinimumValue": {"UnscaledValue": encode(-250, 2), "Scale": 2}, "MaximumValue": {"UnscaledValue": encode(1234, 2), "Scale": 1},
            "NumberOfNulls": 0, "NumberOfDistinctValues": 3}},
        {"Type": "STRING", "StringColumnStatisticsData": {"MaximumLength": 7, "AverageLength": 2.5, "NumberOfNulls": 1, "NumberOfDistinctValues": 4}},
        {"Type": "BINARY", "BinaryColumnStatisticsData": {"MaximumLength": 7, "AverageLength": 2.5, "NumberOfNulls": 1}},
        {"Type": "BOOLEAN", "BooleanColumnStatisticsData": {"NumberOfTrues": 1, "NumberOfFalses": 2, "NumberOfNulls": 3}},
        {"Type": "NEW"},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(reports)], "i int, value string")
    got = {r.i: r for r in pr.reported_stats(df.select("i", F.from_json("value", pr.REPORTED).alias("report"))).collect()}
    assert [got[i].kind for i in range(6)] == ["number", "number", "string", "binary", "boolean", None]
    assert (float(got[0].low_value), float(got[0].high_value), got[0].nulls_count, got[0].unique_count) == (1.0, 9.0, 2, 5)
    assert (float(got[1].low_value), float(got[1].high_value)) == (-2.5, 123.4)
    assert got[2].unique_count == 4 and got[3].unique_count is None and got[3].max_length == 7
    assert (got[4].true_count, got[4].false_count, got[4].nulls_count) == (1, 2, 3)


def test_stats_reach_top_level_fields_only(spark):
    fields = spark.createDataFrame([("t", "a", 0), ("t", "a", 1), ("t", "z", 0)], "entity_rn string, name string, depth int")
    stats = spark.createDataFrame([("t", "a", 5)], "entity_rn string, column_name string, unique_count int")
    got = {(r.name, r.depth): r.unique_count for r in pr.join_stats(fields, stats).collect()}
    assert got == {("a", 0): 5, ("a", 1): None, ("z", 0): None}
