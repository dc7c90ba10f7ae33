"""Class id -> class name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.schema import LABEL_NAMES


def label_name(
    label: Column, names: Mapping[int, str] = LABEL_NAMES, default: str | None = None
) -> Column:
    """Name of the class; a class without a name gives `default` (None = null)."""
    named = F
    for cls, name in names.items():
        named = named.when(label == cls, name)
    return named.otherwise(F.lit(default).cast("string"))
