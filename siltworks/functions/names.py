"""Safe column names, worked out on the schema only (no job runs)."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import count

from pyspark.sql import DataFrame

# What a name may not hold, and what it must.
_UNSAFE_RUN = re.compile(r"[^A-Za-z0-9_]+")
_ALNUM = re.compile(r"[A-Za-z0-9]")
FALLBACK_NAME = "col"


def quoted(name: str) -> str:
    """Back-quoted identifier, so dots and spaces in a name are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def safe_name(name: str | None) -> str:
    cleaned = _UNSAFE_RUN.sub("_", (name or "").strip())
    return cleaned if _ALNUM.search(cleaned) else FALLBACK_NAME


def safe_names(names: Iterable[str]) -> list[str]:
    """Safe names, unique without regard to case: the base if it is free, else with the smallest free number."""
    given: list[str] = []
    used: set[str] = set()
    for base in map(safe_name, names):
        name = base if base.lower() not in used else next(n for i in count(1) if (n := f"{base}_{i}").lower() not in used)
        given.append(name)
        used.add(name.lower())
    return given


def with_safe_names(df: DataFrame) -> DataFrame:
    """Rename by position; a frame that needs no change is returned as it is."""
    wanted = safe_names(df.columns)
    return df if wanted == df.columns else df.toDF(*wanted)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    absent = [old for old in mapping if old not in df.columns]
    if absent:
        raise ValueError(f"cannot rename columns that do not exist: {absent}")
    return df.withColumnsRenamed({old: new for old, new in mapping.items() if old != new})
