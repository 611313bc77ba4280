"""Join helpers.

Which side is broadcast is the planner's choice, from sizes in bytes (re-checked by AQE at runtime); only reference
tables of fixed size carry a hint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broadcast_reference(df: DataFrame) -> DataFrame:
    """Broadcast a reference table whose size is fixed by definition (the
    region and nation lists, a source's region list): its bound does not
    depend on the data volume, so no runtime check is spent on it."""
    return F.broadcast(df)


def same_keys(keys: list[str], prefix: str = "_other_") -> Column:
    """Null-safe equality (NULL matches NULL) of the key columns and those of
    another side, which carry a prefix (see ``prefixed``)."""
    return reduce(lambda x, y: x & y, [F.col(f"`{k}`").eqNullSafe(F.col(f"`{prefix}{k}`")) for k in keys])


def prefixed(df: DataFrame, keys: list[str], prefix: str = "_other_") -> DataFrame:
    """``df`` with a prefix on its key columns."""
    return df.withColumnsRenamed({k: prefix + k for k in keys})


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE-style upsert: rows of ``updates`` replace target rows with the same
    key (NULL keys match NULL keys), new keys are added, other target rows stay.

    A key with two updates fails the job, as a MERGE does.  Updates are counted
    per key first (combined map side); the anti join reuses that shuffle.
    """
    others = [c for c in target.columns if c not in keys]
    once = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in others])
    twice = F.raise_error(F.concat(F.lit("several updates of one key: "),
                                   F.to_json(F.struct(*keys)))).cast("boolean")
    once = once.where(F.when(F.col("_n") > 1, twice).otherwise(F.lit(True))).drop("_n")
    kept = target.join(prefixed(once.select(*keys), keys), same_keys(keys), "left_anti")
    return kept.unionByName(once.select(*target.columns))
