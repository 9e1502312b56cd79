"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "n/a"


def concat_skip_null(*parts: Column | str) -> Column:
    """Concatenate, taking NULL parts as empty text (plain strings are literals)."""
    columns = [F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts]
    return F.concat(*columns)


def map_codes(
    code: Column, names: Mapping[str, str], default: str = UNKNOWN, ignore_case: bool = True
) -> Column:
    """Replace codes by names after trimming; everything else, NULL included, is ``default``."""
    key = F.upper(F.trim(code)) if ignore_case else F.trim(code)
    result = None
    for value, name in names.items():
        result = (F if result is None else result).when(key == value, name)
    return result.otherwise(default)


def strip_prefix(value: Column, prefix: str) -> Column:
    """Drop ``prefix`` where the value starts with it."""
    return F.when(value.startswith(prefix), F.substr(value, F.lit(len(prefix) + 1))).otherwise(value)
