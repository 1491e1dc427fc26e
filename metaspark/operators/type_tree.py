"""Type text -> tree of field rows, for a whole table of column definitions.

Flat types never leave the JVM.  Nested ones pass through one Arrow-batched function
that remembers the trees it has built, so a type shared by a third of all columns costs a
lookup per row; there is no shuffle, hence nothing to skew.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.types import TYPE_MAPS, normalised_type_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REMEMBERED = 100_000  # types a task remembers
DIALECTS = ["arrow", "glue", "athena", "delta"]

NODE = (
    "struct<ordinal:int,depth:int,rel_path:string,parent_rel_path:string,name:string,base:string,"
    "logical_type:string,is_key:boolean,is_value:boolean,is_nullable:boolean,reject_reason:string>"
)

# name, optional (1, 2) or [unit] arguments
_LEAF = r"^\s*([A-Za-z_][A-Za-z_0-9]*)\s*(\([^()<>]*\)|\[[^\[\]<>]*\])?\s*$"


def _split_top(text: str) -> list[str]:
    """Split on commas that are outside every bracket pair."""
    parts, depth, start = [], 0, 0
    for i, c in enumerate(text):
        if c in "<([":
            depth += 1
        elif c in ">)]":
            depth -= 1
        elif c == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    return [*parts, text[start:]]


def _read_text(text: str) -> tuple:
    """(base, logical, [(role, member name, subtree)]) of a bracketed type text."""
    leaf = re.match(_LEAF, text)
    if leaf:
        base, args = leaf.group(1).lower(), leaf.group(2) or ""
        return base, base + re.sub(r"\s*,\s*", ", ", args), []
    outer = re.match(r"^\s*([A-Za-z_]+)\s*<(.*)>\s*(\[\d+\])?\s*$", text, re.DOTALL)
    if not outer:
        raise ValueError(f"not a type: {text}")
    head, inner = outer.group(1).lower(), outer.group(2)
    if head == "dictionary":
        return head, head, []
    parts = _split_top(inner)
    if head == "struct":
        members = [p.split(":", 1) for p in parts if p.strip()]
        return head, head, [("member", m[0].strip(), _read_text(m[1])) for m in members]
    if head == "union":
        return head, head, [("member", None, _read_text(p)) for p in parts if p.strip()]
    if head == "map" and len(parts) == 2:
        return head, head, [("key", None, _read_text(parts[0])), ("value", None, _read_text(parts[1]))]
    if head in ("list", "array", "set", "large_list", "fixed_size_list") and len(parts) == 1:
        # the columnar format names the element, the catalogs do not
        element = re.sub(r"^\s*\w+\s*:\s*(?=\S)", "", parts[0])
        return "list", "list", [("element", None, _read_text(element))]
    raise ValueError(f"not a type: {text}")


def _read_json(node) -> tuple:
    """Same, for the JSON types of a transaction log schema."""
    if isinstance(node, str):
        return _read_text(node)
    kind = node["type"]
    if kind == "struct":
        members = [("member", f["name"], _read_json(f["type"]), f.get("nullable", True)) for f in node["fields"]]
        return kind, kind, members
    if kind == "array":
        return "list", "list", [("element", None, _read_json(node["elementType"]), node.get("containsNull", True))]
    if kind == "map":
        key = ("key", None, _read_json(node["keyType"]), False)
        value = ("value", None, _read_json(node["valueType"]), node.get("valueContainsNull", True))
        return kind, kind, [key, value]
    raise ValueError(f"not a type: {kind}")


def _nodes(dialect: str, text: str) -> list[dict]:
    known = TYPE_MAPS.get(dialect, {})
    list_is_value = dialect in ("arrow", "delta")
    rows: list[dict] = []

    def add(tree, name, rel, parent, depth, role, nullable):
        base, logical, members = tree
        if base not in known:
            raise ValueError(f"unknown type {base}")
        rows.append(
            {
                "ordinal": len(rows), "depth": depth, "rel_path": rel, "parent_rel_path": parent, "name": name,
                "base": base, "logical_type": logical, "is_key": role == "key",
                "is_value": role == "value" or (role == "element" and list_is_value),
                "is_nullable": nullable, "reject_reason": None,
            }
        )
        for member in members:
            child_role, child_name, subtree = member[:3]
            child_nullable = member[3] if len(member) > 3 else None
            if child_role == "key":
                segment = "keys"
            elif child_role == "value" or (child_role == "element" and list_is_value):
                segment = "values"
            else:
                segment = "subcolumns"
            label = child_name if child_name is not None else subtree[0]
            add(subtree, label, f"{rel}/{segment}/{label}", rel, depth + 1, child_role, child_nullable)

    try:
        tree = _read_json(json.loads(text)) if dialect == "delta" and text.lstrip()[:1] in '{"' else _read_text(text)
        add(tree, None, "", None, 0, "root", None)
        return rows
    except (ValueError, KeyError, IndexError, TypeError) as problem:
        unknown = {
            "ordinal": 0, "depth": 0, "rel_path": "", "parent_rel_path": None, "name": None, "base": "unknown",
            "logical_type": text, "is_key": False, "is_value": False, "is_nullable": None, "reject_reason": None,
        }
        if dialect != "arrow":
            unknown["reject_reason"] = f"unreadable type: {problem}"
        return [unknown]


def _nested_nodes() -> Column:
    @F.pandas_udf("string")
    def trees(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[tuple[str, str], str] = {}  # catalogs repeat their types
        for dialect, text in batches:
            out = []
            for key in zip(dialect, text):
                if key not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[key] = json.dumps(_nodes(*key))
                out.append(known[key])
            yield pd.Series(out, dtype=object)

    return F.from_json(trees("dialect", "type_string"), f"array<{NODE}>")


def _flat_node() -> Column:
    """The single node of a type without brackets, as a JVM expression."""
    text = F.col("type_string")
    if_quoted = F.regexp_replace(text, r'^\s*"(.*)"\s*$', "$1")
    text = F.when(F.col("dialect") == "delta", if_quoted).otherwise(text)
    base = F.coalesce(F.lower(F.regexp_extract(text, _LEAF, 1)), F.lit(""))
    args = F.regexp_replace(F.regexp_extract(text, _LEAF, 2), r"\s*,\s*", ", ")
    known = F.lit(False)
    for dialect in DIALECTS:
        known = known | ((F.col("dialect") == dialect) & base.isin(list(TYPE_MAPS[dialect])))
    reason = F.concat(F.lit("unreadable type: "), F.coalesce(text, F.lit("none")))
    reject = F.when(text.isNull() | (~known & (F.col("dialect") != "arrow")), reason)
    return F.struct(
        F.lit(0).alias("ordinal"),
        F.lit(0).alias("depth"),
        F.lit("").alias("rel_path"),
        F.lit(None).cast("string").alias("parent_rel_path"),
        F.lit(None).cast("string").alias("name"),
        F.when(known, base).otherwise(F.lit("unknown")).alias("base"),
        F.when(known, F.concat(base, args)).otherwise(text).alias("logical_type"),
        F.lit(False).alias("is_key"),
        F.lit(False).alias("is_value"),
        F.lit(None).cast("boolean").alias("is_nullable"),
        reject.alias("reject_reason"),
    )


def flatten_types(columns: DataFrame) -> DataFrame:
    """One row per field of every column definition.

    Needs ``dialect`` and ``type_string``; all input columns are kept and a ``node``
    struct is added, with ``node.reject_reason`` set for hive/log types that cannot be
    read (the columnar dialect gives type UNKNOWN with the raw text instead) and for a missing
    type text.
    """
    has_brackets = F.coalesce(F.col("type_string").rlike("[<{]"), F.lit(False))
    flat = columns.filter(~has_brackets).withColumn("node", _flat_node())
    nested = columns.filter(has_brackets).withColumn("node", F.explode(_nested_nodes()))
    return flat.unionByName(nested)


def field_rows(columns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fields, rejects) of column definitions.

    Needs ``entity_rn, column_rn, position, column_name, dialect, type_string,
    is_nullable, description``.
    """
    flat = flatten_types(columns)
    ok = flat.filter(F.col("node.reject_reason").isNull())
    fields = ok.select(
        "entity_rn",
        F.concat("column_rn", "node.rel_path").alias("field_rn"),
        F.when(F.col("node.depth") > 0, F.concat("column_rn", "node.parent_rel_path")).alias("parent_field_rn"),
        "position",
        F.col("node.ordinal").alias("ordinal"),
        F.col("node.depth").alias("depth"),
        F.coalesce("node.name", "column_name").alias("name"),
        normalised_type_of(F.col("dialect"), F.col("node.base"), DIALECTS).alias("type"),
        F.col("node.logical_type").alias("logical_type"),
        F.coalesce("node.is_nullable", F.when(F.col("node.depth") == 0, F.col("is_nullable")), F.lit(True)).alias(
            "is_nullable"
        ),
        F.col("node.is_key").alias("is_key"),
        F.col("node.is_value").alias("is_value"),
        F.when(F.col("node.depth") == 0, F.col("description")).alias("description"),
    )
    rejects = flat.filter(F.col("node.reject_reason").isNotNull()).select(
        F.lit("fields").alias("job"),
        F.col("column_rn").alias("key"),
        F.col("node.reject_reason").alias("reason"),
    )
    return fields, rejects
