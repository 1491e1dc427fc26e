"""Native type -> normalised type lookups for the seven dialects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The normalised type of every native base type, per dialect.
ARROW = {
    "int8": "INTEGER", "int16": "INTEGER", "int32": "INTEGER", "int64": "INTEGER",
    "uint8": "INTEGER", "uint16": "INTEGER", "uint32": "INTEGER", "uint64": "INTEGER",
    "float": "NUMBER", "float8": "NUMBER", "float16": "NUMBER", "float32": "NUMBER",
    "float64": "NUMBER", "halffloat": "NUMBER", "double": "NUMBER",
    "decimal": "NUMBER", "decimal128": "NUMBER", "decimal256": "NUMBER",
    "time32": "TIME", "time64": "TIME",
    "timestamp": "DATETIME", "date32": "DATETIME", "date64": "DATETIME",
    "duration": "DURATION", "month_day_nano_interval": "DURATION",
    "binary": "BINARY", "large_binary": "BINARY", "fixed_size_binary": "BINARY",
    "string": "STRING", "utf8": "STRING", "large_string": "STRING", "large_utf8": "STRING",
    "varchar": "STRING", "bool": "BOOLEAN",
    "list": "LIST", "map": "MAP", "struct": "STRUCT", "union": "UNION", "dictionary": "STRUCT",
    "unknown": "UNKNOWN",
}
HIVE = {
    "int": "INTEGER", "smallint": "INTEGER", "timestamp": "INTEGER", "tinyint": "INTEGER",
    "double": "NUMBER", "bigint": "NUMBER", "decimal": "NUMBER", "float": "NUMBER",
    "string": "STRING", "varchar": "STRING", "boolean": "BOOLEAN", "char": "CHAR",
    "date": "DATETIME", "interval": "DURATION", "binary": "BINARY",
    "list": "LIST", "map": "MAP", "struct": "STRUCT", "union": "UNION",
}
DELTA = {
    "float": "NUMBER", "double": "NUMBER", "decimal": "NUMBER",
    "tinyint": "INTEGER", "byte": "INTEGER", "smallint": "INTEGER", "short": "INTEGER",
    "int": "INTEGER", "integer": "INTEGER", "bigint": "INTEGER", "long": "INTEGER",
    "boolean": "BOOLEAN", "binary": "BINARY", "string": "STRING",
    "date": "DATETIME", "timestamp": "TIME", "timestamp_ntz": "TIME", "interval": "DURATION",
    "array": "LIST", "list": "LIST", "map": "MAP", "struct": "STRUCT", "void": "UNKNOWN",
}
BI = {"INTEGER": "INTEGER", "DECIMAL": "NUMBER", "STRING": "STRING", "DATETIME": "DATETIME"}
KEY_VALUE = {"N": "NUMBER", "S": "STRING", "B": "BINARY"}
FEATURE = {"Integral": "INTEGER", "Fractional": "NUMBER", "String": "STRING"}

TYPE_MAPS: dict[str, dict[str, str]] = {
    "arrow": ARROW,
    "glue": HIVE,
    "athena": HIVE,
    "delta": DELTA,
    "bi": BI,
    "kv": KEY_VALUE,
    "feature": FEATURE,
}


def normalised_type(dialect: str, base: Column) -> Column:
    """Constant-size map lookup; an unmapped base type is UNKNOWN."""
    entries = [F.lit(x) for pair in TYPE_MAPS[dialect].items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), base), F.lit("UNKNOWN"))


def normalised_type_of(dialect: Column, base: Column, dialects: list[str] | None = None) -> Column:
    """Same, for a dialect column."""
    expr = F.lit("UNKNOWN")
    for name in dialects or list(TYPE_MAPS):
        expr = F.when(dialect == name, normalised_type(name, base)).otherwise(expr)
    return expr
