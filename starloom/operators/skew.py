"""Joins whose keys are far from evenly used."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from starloom.operators.rows import with_keys


#: Rows that one task of a join should make, and how many keys are looked at for that.
ROWS_PER_TASK = 1_000_000
MOST_HOT = 10_000


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float, right: DataFrame | None = None, spread: int = 64
) -> DataFrame:
    """Keys that hold at least ``share`` of the rows; there can be at most ``1 / share``.

    With ``right`` the rows counted are those that a join with it makes: the product
    of both sides' counts (a key without a partner counts once). ``_slots`` says over
    how many partitions a key's rows should be dealt: its part of ``spread``, two at least.

    One job counts rows per key, on the map side first, and adds the counts up on
    the way; only the largest ``1 / share`` counts come to the driver.
    """
    return _hot_keys(df, keys, share, right, spread)[0]


def _hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    share: float,
    right: DataFrame | None,
    spread: int,
    rows_per_task: int | None = None,
) -> tuple[DataFrame, int]:
    """:func:`hot_keys`, and how many tasks the join's rows need, 1 without ``rows_per_task``.

    With it a key that makes so many rows is hot too, and ``spread`` is as many tasks at least.
    """
    if not 0 < share <= 1:
        raise ValueError("share is above 0 and at most 1")
    counts = with_keys(df, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    if right is not None:
        partners = with_keys(right, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_partners"))
        made = F.col("_rows") * F.coalesce("_partners", F.lit(1))
        counts = counts.join(partners, list(keys), "left").select(*keys, made.alias("_rows"))
    seen = Observation()
    seen_counts = counts.observe(seen, F.sum("_rows").alias("total"))
    most = math.ceil(1 / share)
    most = max(most, MOST_HOT) if rows_per_task else most
    largest = seen_counts.orderBy(F.desc("_rows")).limit(most).collect()
    # A limit that Spark knows to be no limit leaves a sort, which samples and so counts twice.
    total = sum(row["_rows"] for row in largest) if len(largest) < most else seen.get["total"]
    tasks = max(1, math.ceil(total / rows_per_task)) if rows_per_task else 1
    spread = max(spread, tasks)
    hot = [
        (*[row[key] for key in keys], max(2, math.ceil(spread * row["_rows"] / total)))
        for row in largest
        if row["_rows"] >= min(total * share, rows_per_task or total)
    ]
    schema = df.select(*keys).schema.add("_slots", IntegerType())
    return df.sparkSession.createDataFrame(hot, schema), tasks


def join_spreading_hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    spread: int = 64,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equi-join that deals the left rows of each hot key over up to ``spread`` partitions.

    A key is hot if the join makes at least ``share`` of its rows from it, or
    ``rows_per_task`` rows. The right rows of a hot key are repeated once per partition;
    all others stay single. ``how`` is ``inner`` or ``left``. The hot keys number at most
    ``1 / share`` or ``MOST_HOT``, so they are broadcast and collected safely.

    Spark chooses partitions by what goes into a join. One that makes many rows of few
    gets partitions, and hot keys slots, for what comes out: ``rows_per_task`` each.

    The partition follows from the row's values and the input partition it is in,
    so it stays the same when a lost task runs again, and copies of one row are
    dealt out too.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    hot, tasks = _hot_keys(left, keys, share, right, spread, rows_per_task)
    hot, spread = F.broadcast(hot), max(spread, tasks)
    place = F.xxhash64(*[F.col(name) for name in left.columns], F.spark_partition_id())
    # Rows without a key match nothing and may go anywhere.
    keyless = F.lit(False)
    for key in keys:
        keyless = keyless | F.col(key).isNull()
    size = F.when(keyless, F.lit(spread)).otherwise(F.coalesce("_slots", F.lit(1)))
    dealt = left.join(hot, list(keys), "left").withColumn("_slot", F.pmod(place, size).cast("int"))
    slots = F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1)
    copied = right.join(hot, list(keys), "left").withColumn("_slot", F.explode(slots))
    dealt, copied, on = dealt.drop("_slots"), copied.drop("_slots"), [*keys, "_slot"]
    if tasks > 1:
        dealt, copied = dealt.repartition(tasks, *on), copied.repartition(tasks, *on)
    joined = dealt.join(copied, on, how)
    return joined.drop("_slot")
