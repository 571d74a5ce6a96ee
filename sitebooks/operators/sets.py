"""Unions by name and the split of a frame by a match."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sitebooks.operators.project import conform


def union_all(
    frames: Iterable[DataFrame], schema: StructType | None = None, optional: Sequence[str] = ()
) -> DataFrame:
    """UNION ALL by name; with ``schema`` every branch is cast to it first.

    A column of the schema may be missing in some branches; in all only if ``optional``.
    """
    frames = list(frames)
    if schema is not None:
        known = [c for f in frames for c in f.columns]
        frames = [conform(f, schema, optional=[*known, *optional]) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Iterable[DataFrame], schema: StructType | None = None) -> DataFrame:
    """UNION: one distinct over all branches, not one per branch."""
    return union_all(frames, schema).distinct()
