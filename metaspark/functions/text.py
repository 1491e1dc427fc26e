"""Small text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    A later filter on a plain projected column would be pushed below it, with the whole
    expression repeated in the filter; it cannot pass a generate step.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def snake_case(key: Column) -> Column:
    """``DataSetArnsID`` -> ``data_set_arns_id``; keys without capitals are unchanged."""
    words = F.regexp_replace(key, r"([A-Z]+)([A-Z][a-z])", r"$1_$2")
    snake = F.lower(F.regexp_replace(words, r"([a-z0-9])([A-Z])", r"$1_$2"))
    return F.when(F.lower(key) == key, key).otherwise(snake)


def last_segment(path: Column, sep: str = "/") -> Column:
    """Text after the last separator (the whole text when there is none)."""
    return F.element_at(F.split(path, sep), -1)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def matches_any(text: Column, patterns: list[str] | None) -> Column:
    """True when any of the regular expressions is found in ``text``."""
    hit = F.lit(False)
    for pattern in patterns or []:
        hit = hit | text.rlike(pattern)
    return hit


def allowed(text: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Include/exclude filter with *search* semantics; no include list allows everything."""
    included = matches_any(text, include) if include else F.lit(True)
    return included & ~matches_any(text, exclude)


def job_name(component: Column) -> Column:
    """Readable job name inside a generated training/processing component name.

    The middle part of ``<prefix>-<id>-NAME-...-aws-(training|processing)-job``,
    otherwise the name itself.
    """
    # Fixed value: must accept exactly the names the service generates.
    generated = r"^([a-z]*-[a-z|0-9]*-+)(.*)(-.*-aws-(training|processing)-job)$"
    return F.when(component.rlike(generated), F.regexp_extract(component, generated, 2)).otherwise(component)


def iso_text(ts: Column, offset: str = "Z") -> Column:
    """ISO-8601 rendering of a wall-clock time, for consumers that want text."""
    return F.concat(F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(offset))
