"""Object path, URL and ARN expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, last_segment


def strip_protocol(path: Column) -> Column:
    """Drop a leading ``s3://``, ``s3a://`` or ``s3n://``."""
    return F.regexp_replace(path, r"^s3[an]?://", "")


def url_bucket(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def url_key(url: Column) -> Column:
    """Path of a URL without leading slashes, query or fragment."""
    return F.ltrim(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1), F.lit("/"))


def join_prefix(bucket: Column, prefix: Column) -> Column:
    """``bucket/prefix`` with outer slashes trimmed; a missing prefix leaves the bucket."""
    clean_bucket = F.btrim(bucket, F.lit("/"))
    clean_prefix = F.btrim(prefix, F.lit("/"))
    has_prefix = prefix.isNotNull() & (prefix != "")
    return F.when(has_prefix, F.concat_ws("/", clean_bucket, clean_prefix)).otherwise(clean_bucket)


def base_name(path: Column) -> Column:
    return last_segment(path)


def parent_path(path: Column) -> Column:
    """Everything before the last slash; null at the top."""
    return blank_to_null(F.regexp_extract(path, r"^(.*)/[^/]*$", 1))


def prefixes(path: Column) -> Column:
    """Array of the path's proper ancestors, shortest first (``a/b/c`` -> ``[a, a/b]``)."""
    n_slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    counts = F.when(n_slashes > 0, F.sequence(F.lit(1), n_slashes)).otherwise(F.array().cast("array<int>"))
    return F.transform(counts, lambda i: leading_segments(path, i))


def leading_segments(path: Column, count: Column) -> Column:
    """The first ``count`` slash-separated segments."""
    return F.call_function("substring_index", path, F.lit("/"), count)


def object_name(path: Column) -> Column:
    """Name of an object inside its bucket: first segment dropped, ``/`` written as two backslashes."""
    inner = F.regexp_replace(F.btrim(path, F.lit("/")), r"^[^/]*/", "")
    return F.replace(inner, F.lit("/"), F.lit("\\\\"))


def first_extension(name: Column) -> Column:
    """Lower-case letters after the first dot that is followed by one; null when none."""
    return blank_to_null(F.regexp_extract(name, r"\.([a-z]+)", 1))


def all_suffixes(name: Column) -> Column:
    """All suffixes of the base name joined (``.csv.gz``), empty when there is none."""
    stem = F.regexp_replace(F.ltrim(base_name(name), F.lit(".")), r"\.$", "")
    ends_with_dot = base_name(name).rlike(r"\.$")
    return F.when(ends_with_dot, F.lit("")).otherwise(F.regexp_extract(stem, r"^[^.]*((\.[^.]*)*)$", 1))


def suffix_format(name: Column) -> Column:
    """csv / tsv (optionally gz or bz2) / parquet by suffix; null for anything else."""
    return (
        F.when(name.rlike(r"\.csv(\.gz|\.bz2)?$"), F.lit("csv"))
        .when(name.rlike(r"\.tsv(\.gz|\.bz2)?$"), F.lit("tsv"))
        .when(name.rlike(r"\.parquet$"), F.lit("parquet"))
    )


def file_format(name: Column, mode: str = "suffix") -> Column:
    """Format of a file name.

    ``suffix`` looks at the end of the name and falls back to the last extension;
    ``first_dot`` takes the first extension, so ``x.snappy.parquet`` is ``snappy``.
    """
    if mode == "first_dot":
        return first_extension(name)
    if mode != "suffix":
        raise ValueError(f"unknown format mode {mode!r}")
    last = blank_to_null(F.regexp_extract(base_name(name), r"\.([A-Za-z0-9]+)$", 1))
    return F.coalesce(suffix_format(name), F.lower(last))


def arn_resource_kind(arn: Column) -> Column:
    """Kind of the resource an ARN names: ``...:artifact/x`` -> ``artifact``."""
    return F.split_part(F.split_part(arn, F.lit(":"), F.lit(6)), F.lit("/"), F.lit(1))


def arn_names_a(arn: Column, kind: str) -> Column:
    """Whether the resource part of an ARN is of a kind (one pass, nothing is split)."""
    return arn.rlike(f"^([^:]*:){{5}}{kind}(/|:|$)")


def arn_tail(arn: Column) -> Column:
    return last_segment(arn)
