"""Latest-wins deduplication and last-non-null attribute picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlake.functions.columns import blank_key


def _order_cols(order: Sequence[str | Column], descending: bool) -> list[Column]:
    out = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        out.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return out


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              tiebreak: Sequence[str | Column] = (), blank_keys: Sequence[str] = (), hashed: bool = False) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order`` (then ``tiebreak``).

    ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1``. Keys in
    ``blank_keys`` are compared as ``IFNULL(k, '')``. Spark turns the
    ``row_number() = 1`` filter into a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most one row per key: a hot key
    cannot pile up in one reducer.

    ``hashed`` puts a hash in front of the keys: sorts compare one number where they would compare
    text after text (keys that begin with a channel are alike in their first column). The result is
    then not partitioned by ``keys`` for a following step.
    """
    part = [blank_key(k) if k in blank_keys else F.col(k) for k in keys]
    if hashed:
        df, part = df.withColumn("__hk", F.hash(*part)), [F.col("__hk"), *part]
    w = W.partitionBy(*part).orderBy(*_order_cols(list(order) + list(tiebreak), True))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn", "__hk"))
