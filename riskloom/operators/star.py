"""Star join of feature tables to the performance table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.scalar import quoted


def star_left_join(
    fact: DataFrame,
    features: Sequence[DataFrame],
    key: str,
    columns: Sequence[str] | None = None,
    check_unique: bool = False,
) -> DataFrame:
    """Left-join every feature table on ``key``; fact columns first, all fact rows kept.

    With ``columns`` only the tables that own one of them are joined: the key is
    unique on the right, so an unneeded left join changes nothing - which the
    optimizer cannot know.  ``check_unique`` verifies that claim first.
    """
    if check_unique:
        for i, f in enumerate(features):
            if f.groupBy(key).count().where(F.col("count") > 1).limit(1).count():
                raise ValueError(f"feature table {i} repeats a {key}")
    wanted = None if columns is None else set(columns)
    picked = []
    for f in features:
        cols = [c for c in f.columns if c != key and (wanted is None or c in wanted)]
        if cols:
            picked.append(f.select(quoted(key), *[quoted(c) for c in cols]))
    head = fact if wanted is None else fact.select(*[quoted(c) for c in fact.columns if c == key or c in wanted])
    return reduce(lambda left, right: left.join(right, key, "left"), picked, head)


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a source for SQL users."""
    df.createOrReplaceTempView(name)
    return df
