"""The common type of a column that files of one dataset store in different types.

Types form a lattice: integers widen, numbers meet in ``double``, dates in timestamps, lists and
maps by their parts, structs by the union of their members.  Types of different families meet
in a conflict, which keeps the common type of each.  The least upper bound is associative and commutative, so
columns are reduced in two levels of Spark aggregates, in any order of the files, and only
columns of more than one type leave the JVM.
"""

from __future__ import annotations

import json
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import type_tree

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SALTS = 16
_ALIASES = {
    "float16": "halffloat", "float32": "float", "float64": "double", "float8": "halffloat", "utf8": "string",
    "large_utf8": "large_string", "varchar": "string",
}
# Types of which the later holds the earlier, by family; decimals are numbers too.
_RANKS = {
    "signed": ["int8", "int16", "int32", "int64"],
    "unsigned": ["uint8", "uint16", "uint32", "uint64"],
    "floating": ["halffloat", "float", "double"],
    "text": ["string", "large_string"],
    "bytes": ["binary", "large_binary"],
}
_UNITS = ["s", "ms", "us", "ns"]
# Decimal digits that hold every value of an integer type, in the order of the ranks.
_DIGITS = {"signed": [3, 5, 10, 19], "unsigned": [3, 5, 10, 20]}

# A tree has a part for each family of its types: {} for null, one for a type, several for a
# conflict.  Parts: numbers [signed, unsigned, floating ranks from 1, whole digits, scale], "text"
# and "bytes" a rank, "date" [date, unit ranks], "zone ..." a unit's rank, "list" a tree, "map" two
# trees, "struct" [name, place, tree] of each member, "as ..." any other type.


def tree_of(text: str) -> dict:
    """The tree of a type text as the columnar format writes it."""
    try:
        return _tree(type_tree._read_text(text))
    except (ValueError, IndexError):
        return {f"as {text.strip()}": 1}


def _tree(node: tuple) -> dict:
    base, logical, members = node
    if base == "struct":
        return {"struct": [[name, place, _tree(sub)] for place, (_, name, sub) in enumerate(members)]}
    if base == "list" and members:
        return {"list": _tree(members[0][2])}
    if base == "map" and len(members) == 2:
        return {"map": [_tree(members[0][2]), _tree(members[1][2])]}
    return _leaf(_ALIASES.get(base, base), logical)


def _leaf(base: str, logical: str) -> dict:
    if base == "null":
        return {}
    for at, family in enumerate(("signed", "unsigned", "floating")):
        if base in _RANKS[family]:
            return {"number": [_RANKS[family].index(base) + 1 if k == at else 0 for k in range(3)] + [0, 0]}
    if digits := re.fullmatch(r"decimal(?:128|256)?\((\d+), ?(-?\d+)\)", logical):
        scale = max(0, int(digits[2]))
        return {"number": [0, 0, 0, int(digits[1]) - int(digits[2]), scale]}
    for family in ("text", "bytes"):
        if base in _RANKS[family]:
            return {family: _RANKS[family].index(base)}
    if moment := re.fullmatch(r"timestamp\[(s|ms|us|ns)(?:, tz=([^\]]*))?\]", logical):
        rank = _UNITS.index(moment[1]) + 1
        return {f"zone {moment[2]}": rank} if moment[2] else {"date": [0, rank]}
    if base in ("date32", "date64"):
        return {"date": [1 + (base == "date64"), 0]}
    return {f"as {logical}": 1}


def _text(family: str, part) -> str:
    """The type text of one part of a tree."""
    if family == "number":
        signed, unsigned, floating, whole, scale = part
        held = [_DIGITS[f][rank - 1] for f, rank in (("signed", signed), ("unsigned", unsigned)) if rank]
        if floating:
            return "double" if held or whole or scale else _RANKS["floating"][floating - 1]
        if whole or scale:
            digits = max([whole, *held]) + scale
            return "double" if digits > 76 else f"decimal{128 if digits <= 38 else 256}({digits}, {scale})"
        if not signed or not unsigned:
            return _RANKS["signed"][signed - 1] if signed else _RANKS["unsigned"][unsigned - 1]
        wider = max(signed, unsigned + 1)
        return _RANKS["signed"][wider - 1] if wider <= 4 else "decimal128(20, 0)"
    if family in _RANKS:
        return _RANKS[family][part]
    if family == "date":
        return f"timestamp[{_UNITS[part[1] - 1]}]" if part[1] else ("date32[day]", "date64[ms]")[part[0] - 1]
    if family == "list":
        return f"list<element: {text_of(part)}>"
    if family == "map":
        return f"map<{text_of(part[0])}, {text_of(part[1])}>"
    if family == "struct":
        return "struct<" + ", ".join(f"{name}: {text_of(sub)}" for name, _, sub in part) + ">"
    kind, _, rest = family.partition(" ")
    return f"timestamp[{_UNITS[part - 1]}, tz={rest}]" if kind == "zone" else rest


def text_of(tree: dict) -> str:
    """The type text of a tree; null and a conflict are of type unknown."""
    return _text(*next(iter(tree.items()))) if len(tree) == 1 else "unknown"


def conflicts(tree: dict, at: str = "") -> list[str]:
    """What has no common type, as ``path: types``."""
    found = [f"{at or '/'}: {', '.join(sorted(_text(*part) for part in tree.items()))}"] if len(tree) > 1 else []
    for name, _, sub in tree.get("struct", ()):
        found += conflicts(sub, f"{at}/{name}")
    if "list" in tree:
        found += conflicts(tree["list"], f"{at}/list")
    for side, sub in zip(("key", "value"), tree.get("map", ())):
        found += conflicts(sub, f"{at}/{side}")
    return found


def bound(a: dict, b: dict) -> dict:
    """Least upper bound of two trees: that of each family they share, and the families that one of them has."""
    out = {**a, **b}
    for family in a.keys() & b.keys():
        x, y = a[family], b[family]
        if family == "struct":
            members = {name: (place, sub) for name, place, sub in x}
            for name, place, sub in y:
                at, own = members.get(name, (place, {}))
                members[name] = (min(at, place), bound(own, sub))
            out[family] = sorted(([n, p, t] for n, (p, t) in members.items()), key=lambda m: (m[1], m[0]))
        elif family == "list":
            out[family] = bound(x, y)
        elif family == "map":
            out[family] = [bound(p, q) for p, q in zip(x, y)]
        elif isinstance(x, list):
            out[family] = [max(p, q) for p, q in zip(x, y)]
        else:
            out[family] = max(x, y)
    return out


def merge_types(columns: DataFrame) -> DataFrame:
    """One row per (``entity_rn``, ``column_name``): ``position`` (the least), ``type_string`` and ``conflicts``.

    ``columns`` has a row of ``entity_rn``, ``column_name``, ``position``, ``type_string`` for each column of
    each file, as ``scan_schemas`` reads it.  Types of a column are reduced by hash first, so
    a dataset with most of the files, or one of many types, is not in one task.
    """
    key = ["entity_rn", "column_name"]
    seen = cut_lineage(columns.groupBy(*key, "type_string").agg(F.min("position").alias("position")))
    per = seen.groupBy(*key).agg(F.min("position").alias("position"), F.count("*").alias("n"), F.min("type_string").alias("type_string"))
    none = F.lit(None).cast("array<string>")
    single = per.filter("n = 1").select(*key, "position", "type_string", none.alias("conflicts"))

    @F.pandas_udf("string")
    def joined(groups: pd.Series) -> pd.Series:
        out = []
        for texts in groups:
            tree: dict = {}
            for text in texts:
                tree = bound(tree, json.loads(text[1:]) if text[:1] == "=" else tree_of(text))
            out.append("=" + json.dumps(tree))
        return pd.Series(out, dtype=object)

    @F.pandas_udf("type_string string, conflicts array<string>")
    def shown(trees: pd.Series) -> pd.DataFrame:
        read = [json.loads(t[1:]) for t in trees]
        return pd.DataFrame({"type_string": [text_of(t) for t in read], "conflicts": [conflicts(t) for t in read]})

    several = seen.join(per.filter("n > 1").select(*key), key, "left_semi")
    salt = F.pmod(F.xxhash64("type_string"), F.lit(SALTS)).alias("salt")
    salted = several.groupBy(*key, salt).agg(F.min("position").alias("position"), F.collect_list("type_string").alias("types"))
    salted = salted.withColumn("tree", joined("types"))
    whole = salted.groupBy(*key).agg(F.min("position").alias("position"), F.collect_list("tree").alias("trees"))
    merged = whole.select(*key, "position", shown(joined("trees")).alias("m")).select(*key, "position", "m.type_string", "m.conflicts")
    return single.unionByName(merged)
