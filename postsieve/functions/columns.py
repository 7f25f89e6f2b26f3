"""Small ``Column`` helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as p


def has_text(col: Column) -> Column:
    """True when anything but whitespace is left."""
    return col.rlike(p.NON_SPACE)


def has_letter_or_digit(col: Column) -> Column:
    return col.rlike(p.ASCII_LETTER_OR_DIGIT)


def required(name: str, cast: str = "string") -> Column:
    """Value of a mandatory attribute; the job fails where it is missing.

    Integer attributes go through an ANSI cast, which fails on bad digits; with
    ANSI mode off the cast yields NULL and the same error is raised here.
    """
    message = F.lit(f"missing or malformed attribute {name}")
    return F.coalesce(F.col(name).cast(cast), F.raise_error(message).cast(cast))


def dataset_slug(dataset: Column, job_name: str | None = None) -> Column:
    """Lower-case name keeping ``[-a-z0-9]`` only, optionally after a job name."""
    slug = F.regexp_replace(F.lower(dataset), p.OUTSIDE_SLUG, "")
    return slug if job_name is None else F.concat(F.lit(f"{job_name}-"), slug)


def in_order(pairs: Column, field: str) -> Column:
    """Sort collected ``struct(position, field)`` pairs and keep ``field``."""
    return F.transform(F.array_sort(pairs), lambda pair: pair[field])


def or_empty(col: Column) -> Column:
    """Replace a NULL text list by an empty one."""
    return F.coalesce(col, F.array().cast("array<string>"))


def as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)
