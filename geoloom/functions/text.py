"""File-name and attribute text as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.model import LOCK_PATTERNS


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def suffix(name: Column) -> Column:
    """Last extension in lower case, with its dot."""
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]+)$", 1))


def stem(name: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]+$", "")


def layer_stem(name: Column) -> Column:
    return F.regexp_replace(F.lower(stem(name)), "_+$", "")


def safe_name(text: Column, length: int) -> Column:
    """Non-word characters become ``_``; word characters include all of Unicode."""
    # One character becomes one, so cutting first gives the same name from less work.
    return F.regexp_replace(F.substring(text, 1, length), r"(?U)[^\w]", "_")


def is_lock(name: Column) -> Column:
    return F.coalesce(name.rlike("(?i)" + "|".join(f"(?:{p})" for p in LOCK_PATTERNS)), F.lit(False))


def clean_attr(raw: Column, default: str) -> Column:
    """Null or empty becomes ``default``; then lower case without outer blanks."""
    value = F.coalesce(F.nullif(raw, F.lit("")), F.lit(default))
    return F.regexp_replace(F.lower(value), r"^\s+|\s+$", "")


def exact_match(raw: Column, table: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for key_label in table.items() for x in key_label]
    return F.try_element_at(F.create_map(*pairs), raw)


def first_contained(raw: Column, table: Mapping[str, str], both_ways: bool) -> Column:
    """Label of the first key inside ``raw`` (or ``raw`` inside the key).

    The tables are fixed and short, so they travel in the plan as array literals
    and need neither a join nor a broadcast.
    """
    dims = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("label")) for k, v in table.items()])

    def hit(d: Column) -> Column:
        inside = F.contains(raw, d["key"])
        return inside | F.contains(d["key"], raw) if both_ways else inside

    return F.get(F.filter(dims, hit), 0)["label"]
