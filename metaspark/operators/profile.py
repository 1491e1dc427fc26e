"""Column statistics of five kinds, computed from data or decoded from reported ones.

Each function returns one row per column.  ``distinct="exact"`` aggregates every column
on its own, so Spark pre-aggregates by value before the shuffle and reads each column
once; ``distinct="approx"`` is a single pass over all columns with one small aggregation
buffer per column (HyperLogLog, relative error about 5 %) - the choice for very large
tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# (output column, aggregate of the profiled column)
Measures = Callable[[Column], dict[str, Column]]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _collect_measures(df: DataFrame, columns: dict[str, Column], measures: Measures, distinct: str | None) -> DataFrame:
    if not columns:
        raise ValueError("no columns to profile")
    if distinct == "exact":
        return _union(
            [
                df.select(column.alias("v"))
                .agg(*[m.alias(k) for k, m in measures(F.col("v")).items()], F.count_distinct("v").alias("unique_count"))
                .select(F.lit(name).alias("column_name"), "*")
                for name, column in columns.items()
            ]
        )
    if distinct not in ("approx", None):
        raise ValueError(f"unknown distinct mode {distinct!r}")
    wide, rows = [], []
    renamed = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns.values())])
    for i, name in enumerate(columns):
        parts = dict(measures(F.col(f"c{i}")))
        if distinct:
            parts["unique_count"] = F.approx_count_distinct(f"c{i}")
        wide += [m.alias(f"{k}_{i}") for k, m in parts.items()]
        rows.append(F.struct(F.lit(name).alias("column_name"), *[F.col(f"{k}_{i}").alias(k) for k in parts]))
    return renamed.agg(*wide).select(F.inline(F.array(*rows)))


def _named(df: DataFrame, columns: list[str] | dict[str, Column]) -> dict[str, Column]:
    return columns if isinstance(columns, dict) else {name: df[name] for name in columns}


def number_stats(
    df: DataFrame, columns: list[str] | dict[str, Column], distinct: str = "exact", extended: bool = False
) -> DataFrame:
    """low, high, nulls, distinct; mean and (approximate) median only when ``extended``."""

    def measures(v: Column) -> dict[str, Column]:
        number = v.cast("double")
        missing = F.lit(None).cast("double")
        return {
            "low_value": F.min(number),
            "high_value": F.max(number),
            "mean_value": F.avg(number) if extended else F.max(missing),
            "median_value": F.percentile_approx(number, 0.5).cast("double") if extended else F.max(missing),
            "nulls_count": F.count_if(v.isNull()),
        }

    return _collect_measures(df, _named(df, columns), measures, distinct)


def datetime_stats(df: DataFrame, columns: list[str] | dict[str, Column], distinct: str = "exact") -> DataFrame:
    def measures(v: Column) -> dict[str, Column]:
        return {"low_value": F.min(v), "high_value": F.max(v), "nulls_count": F.count_if(v.isNull())}

    return _collect_measures(df, _named(df, columns), measures, distinct)


def decimal_stats(df: DataFrame, columns: list[str] | dict[str, Column], distinct: str = "exact") -> DataFrame:
    """Same as numbers, but low and high keep their decimal type."""
    return datetime_stats(df, columns, distinct)


def _length_stats(df: DataFrame, columns: dict[str, Column], length: Callable, distinct: str) -> DataFrame:
    def measures(v: Column) -> dict[str, Column]:
        return {
            "max_length": F.max(length(v)).cast("bigint"),
            "avg_length": F.avg(length(v)),
            "nulls_count": F.count_if(v.isNull()),
        }

    return _collect_measures(df, columns, measures, distinct)


def string_stats(df: DataFrame, columns: list[str] | dict[str, Column], distinct: str = "exact") -> DataFrame:
    """Longest and average length in characters, nulls, distinct values."""
    return _length_stats(df, _named(df, columns), F.length, distinct)


def binary_stats(df: DataFrame, columns: list[str] | dict[str, Column], distinct: str | None = "exact") -> DataFrame:
    """Longest and average length in bytes, nulls and, unless ``distinct`` is None, distinct values."""
    return _length_stats(df, _named(df, columns), F.octet_length, distinct)


def boolean_stats(df: DataFrame, columns: list[str] | dict[str, Column]) -> DataFrame:
    def measures(v: Column) -> dict[str, Column]:
        return {
            "true_count": F.count_if(v),
            "false_count": F.count_if(~v),
            "nulls_count": F.count_if(v.isNull()),
        }

    return _collect_measures(df, _named(df, columns), measures, None)


FIELD_STATS = [
    ("kind", "string"),
    ("low_value", "string"),
    ("high_value", "string"),
    ("mean_value", "double"),
    ("median_value", "double"),
    ("max_length", "bigint"),
    ("avg_length", "double"),
    ("true_count", "bigint"),
    ("false_count", "bigint"),
    ("nulls_count", "bigint"),
    ("unique_count", "bigint"),
]


def as_field_stats(stats: DataFrame, kind: str) -> DataFrame:
    """Widen one kind's rows to the common statistics columns."""
    have = set(stats.columns)
    common = [
        F.lit(kind).alias(name) if name == "kind" else (F.col(name) if name in have else F.lit(None)).cast(t).alias(name)
        for name, t in FIELD_STATS
    ]
    keys = [c for c in stats.columns if c not in dict(FIELD_STATS)]
    return stats.select(*keys, *common)


def profile(df: DataFrame, distinct: str = "approx") -> DataFrame:
    """Statistics of every column of a table, the kind chosen by its type.

    Whole numbers and decimals keep their digits; columns of other types (lists, structs)
    have no statistics.
    """
    kinds: dict[str, list[str]] = {}
    for name, dtype in df.dtypes:
        base = dtype.split("(")[0]
        if base in ("tinyint", "smallint", "int", "bigint"):
            kinds.setdefault("whole", []).append(name)
        elif base in ("float", "double"):
            kinds.setdefault("number", []).append(name)
        elif base == "decimal":
            kinds.setdefault("decimal", []).append(name)
        elif base in ("timestamp", "timestamp_ntz", "date"):
            kinds.setdefault("datetime", []).append(name)
        elif base in ("string", "varchar", "char"):
            kinds.setdefault("string", []).append(name)
        elif base == "binary":
            kinds.setdefault("binary", []).append(name)
        elif base == "boolean":
            kinds.setdefault("boolean", []).append(name)
    parts = []
    for kind, names in kinds.items():
        if kind == "boolean":
            stats = boolean_stats(df, names)
        elif kind == "whole":
            stats = datetime_stats(df, {n: df[n].cast("bigint") for n in names}, distinct)
        elif kind == "decimal":
            stats = _union([decimal_stats(df, [n], distinct).withColumns(
                {"low_value": F.col("low_value").cast("string"), "high_value": F.col("high_value").cast("string")}
            ) for n in names])
        else:
            run = {"number": number_stats, "datetime": datetime_stats, "string": string_stats, "binary": binary_stats}
            stats = _datetime_text(run[kind], df, names, distinct)
        parts.append(as_field_stats(stats, "number" if kind in ("decimal", "whole") else kind))
    return _union(parts)


def _datetime_text(run: Callable, df: DataFrame, names: list[str], distinct: str) -> DataFrame:
    """Dates and both timestamp types share an array only as one type."""
    if run is datetime_stats:
        return run(df, {n: df[n].cast("timestamp_ntz") for n in names}, distinct)
    return run(df, names, distinct)


# --- reported statistics -----------------------------------------------------------

_NUMERIC = "struct<MinimumValue:{0},MaximumValue:{0},NumberOfNulls:bigint,NumberOfDistinctValues:bigint>"
_LENGTH = (
    "struct<MaximumLength:bigint,AverageLength:double,NumberOfNulls:bigint,NumberOfDistinctValues:bigint>"
)
REPORTED = (
    "struct<Type:string,"
    f"LongColumnStatisticsData:{_NUMERIC.format('bigint')},"
    f"DoubleColumnStatisticsData:{_NUMERIC.format('double')},"
    f"DateColumnStatisticsData:{_NUMERIC.format('string')},"
    f"DecimalColumnStatisticsData:{_NUMERIC.format('struct<UnscaledValue:string,Scale:int>')},"
    f"StringColumnStatisticsData:{_LENGTH},"
    f"BinaryColumnStatisticsData:{_LENGTH},"
    "BooleanColumnStatisticsData:struct<NumberOfTrues:bigint,NumberOfFalses:bigint,NumberOfNulls:bigint>>"
)
_KIND_OF = {
    "LONG": "number",
    "DOUBLE": "number",
    "DECIMAL": "number",
    "DATE": "datetime",
    "STRING": "string",
    "BINARY": "binary",
    "BOOLEAN": "boolean",
}


def unscaled_value(encoded: Column) -> Column:
    """Base64 of a big-endian two's-complement integer -> DECIMAL(38,0)."""
    raw = F.unbase64(encoded)
    width = F.octet_length(raw)
    digits = F.hex(raw)

    def add_byte(total: Column, i: Column) -> Column:
        byte = F.conv(F.substr(digits, i * 2 - 1, F.lit(2)), 16, 10).cast("decimal(3,0)")
        return (total * F.lit(256).cast("decimal(3,0)") + byte).cast("decimal(38,0)")

    # starting from the sign, shifting in each byte gives the signed value
    negative = F.substr(digits, F.lit(1), F.lit(1)).isin("8", "9", "A", "B", "C", "D", "E", "F")
    start = F.when(negative, F.lit(-1)).otherwise(F.lit(0)).cast("decimal(38,0)")
    return F.aggregate(F.sequence(F.lit(1), width), start, add_byte)


def scaled_decimal(value: Column) -> Column:
    """``unscaled * 10^-scale`` of a reported decimal as text, digit by digit."""
    unscaled = unscaled_value(value["UnscaledValue"]).cast("string")
    scale = F.greatest(value["Scale"], F.lit(0))
    sign = F.when(unscaled.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    digits = F.regexp_replace(unscaled, "^-", "")
    digits = F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
    whole = F.substr(digits, F.lit(1), F.length(digits) - scale)
    fraction = F.substr(digits, F.length(digits) - scale + 1, scale)
    zeros = F.repeat(F.lit("0"), F.greatest(-value["Scale"], F.lit(0)))
    return F.when(scale > 0, F.concat(sign, whole, F.lit("."), fraction)).otherwise(F.concat(unscaled, zeros))


def reported_stats(reports: DataFrame) -> DataFrame:
    """Field statistics from catalog reports; needs a ``report`` column of type ``REPORTED``."""
    r = F.col("report")

    def pick(**by_type: Column) -> Column:
        expr = None
        for report_type, value in by_type.items():
            expr = (F if expr is None else expr).when(r["Type"] == report_type, value)
        return expr

    kind = pick(**{t: F.lit(k) for t, k in _KIND_OF.items()})
    source = {t: r[f"{t.title()}ColumnStatisticsData"] for t in _KIND_OF}
    numeric = ("LONG", "DOUBLE", "DATE")
    keys = [c for c in reports.columns if c != "report"]

    def bound(side: str) -> Column:
        plain = {t: source[t][side].cast("string") for t in numeric}
        return pick(**plain, DECIMAL=scaled_decimal(source["DECIMAL"][side]))

    return reports.select(
        *keys,
        kind.alias("kind"),
        bound("MinimumValue").alias("low_value"),
        bound("MaximumValue").alias("high_value"),
        F.lit(None).cast("double").alias("mean_value"),
        F.lit(None).cast("double").alias("median_value"),
        pick(STRING=source["STRING"]["MaximumLength"], BINARY=source["BINARY"]["MaximumLength"]).alias("max_length"),
        pick(STRING=source["STRING"]["AverageLength"], BINARY=source["BINARY"]["AverageLength"]).alias("avg_length"),
        pick(BOOLEAN=source["BOOLEAN"]["NumberOfTrues"]).alias("true_count"),
        pick(BOOLEAN=source["BOOLEAN"]["NumberOfFalses"]).alias("false_count"),
        pick(**{t: source[t]["NumberOfNulls"] for t in _KIND_OF}).alias("nulls_count"),
        pick(**{t: source[t]["NumberOfDistinctValues"] for t in _KIND_OF if t != "BOOLEAN"}).alias("unique_count"),
    )


def join_stats(fields: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach statistics to the top-level fields by entity and column name; others get nulls.

    ``stats`` needs ``entity_rn, column_name`` plus statistic columns.  The key is unique
    on the statistics side, so no row is multiplied.
    """
    # a nested field has no key and can never match a statistics row
    keyed = fields.withColumn("stats_key", F.when(F.col("depth") == 0, F.col("name")))
    named = stats.withColumnRenamed("column_name", "stats_key")
    return keyed.join(named, ["entity_rn", "stats_key"], "left").drop("stats_key")
