"""Shards by a weighted hash tree: region, rack, shard.

A row walks down the tree. At each level every child draws ``-ln(u) / weight``
from a hash of the row's key and the child's name, and the least draw wins, so a
child gets rows in proportion to its weight and the draws of its siblings do not
depend on it. Changing weights below one region therefore moves rows only into
or out of the subtrees on the changed paths.

A shard that is added later (``grown``) must take rows only into itself, even
though its region and rack grow with it. It therefore draws once at the root,
against the draw with which the old tree was won: both are exponential with rates
equal to the weights, so it wins its exact share and no old shard gains a row.

Defined results: a NULL key is a key like any other (one shard for all NULLs);
rows with the same key share a shard; an empty table gives an empty table; extra
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.tables import only
from starloom.storage import materialize


@dataclass(frozen=True)
class HashTree:
    """``regions[r][k][s]`` is the weight of a shard; ``added`` those of shards grown later.

    Shards are numbered from 0 in the order of the tree, then in the order added.
    """

    regions: tuple[tuple[tuple[float, ...], ...], ...]
    added: tuple[float, ...] = ()

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> HashTree:
        return cls((((1.0,) * shards,) * racks,) * regions)

    def __post_init__(self) -> None:
        weights = [w for region in self.regions for rack in region for w in rack] + list(self.added)
        if not weights or min(weights) < 0 or max(weights) <= 0:
            raise ValueError("weights must not be negative and not all zero")

    @property
    def planted(self) -> int:
        """Shards of the tree itself."""
        return sum(len(rack) for region in self.regions for rack in region)

    @property
    def shards(self) -> int:
        return self.planted + len(self.added)

    def grown(self, weight: float = 1.0) -> HashTree:
        """The tree with one more shard, which takes rows only into itself."""
        return HashTree(self.regions, (*self.added, float(weight)))


def _draw(key: Column, weight, *name) -> Column:
    """Exponential with rate ``weight``, decided by the key and the child's name."""
    bits = F.shiftrightunsigned(F.xxhash64(key, *[n if isinstance(n, Column) else F.lit(n) for n in name]), 11)
    unit = (bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)
    return -F.log(unit) / weight


def _race(runners: Sequence[tuple[Column | float, Column, Column | int]]) -> Column:
    """The least draw with its number; runners without weight do not start."""
    entries = []
    for weight, draw, number in runners:
        weight = weight if isinstance(weight, Column) else F.lit(float(weight))
        entry = F.struct(draw.alias("draw"), (number if isinstance(number, Column) else F.lit(number)).alias("n"))
        entries.append(F.when(weight > 0, entry))
    return F.array_min(F.array(*entries))


def _table(values: Sequence[Sequence[float]], row: Column, at: int) -> Column:
    """``values[row][at]``, 0 where a row has no such place."""
    return F.element_at(F.array(*[F.lit(float(v[at]) if at < len(v) else 0.0) for v in values]), row + 1)


def descend(df: DataFrame, tree: HashTree, key: str, shard: str) -> DataFrame:
    """Add ``shard`` by the draws of ``key``; temporary columns stay inside."""
    names = df.columns
    k = F.col(key)
    weights = [sum(map(sum, region)) for region in tree.regions]
    region = _race([(w, _draw(k, F.lit(float(w)), "region", i), i) for i, w in enumerate(weights)])
    df = df.withColumn("_region", region)
    if sum(weights) > 0:
        r = F.col("_region.n")
        racks = [[float(sum(rack)) for rack in region] for region in tree.regions]
        runs = []
        for i in range(max(map(len, racks))):
            w = _table(racks, r, i)
            runs.append((w, _draw(k, w, "rack", r, i), i))
        df = df.withColumn("_rack", _race(runs).getField("n"))
        flat = [rack for region in tree.regions for rack in region]
        first_rack = F.element_at(F.array(*[F.lit(sum(map(len, tree.regions[:i]))) for i in range(len(racks))]), r + 1)
        df = df.withColumn("_flat", first_rack + F.col("_rack"))
        place = F.col("_flat")
        runs = []
        for i in range(max(map(len, flat))):
            w = _table(flat, place, i)
            runs.append((w, _draw(k, w, "shard", place, i), i))
        first_shard = F.element_at(F.array(*[F.lit(sum(map(len, flat[:i]))) for i in range(len(flat))]), place + 1)
        df = df.withColumn("_old", first_shard + _race(runs).getField("n"))
        root = [(1.0, F.col("_region.draw"), F.col("_old"))]
    else:
        root = []
    late = [
        (w, _draw(k, F.lit(float(w)), "added", tree.planted + i), tree.planted + i)
        for i, w in enumerate(tree.added)
    ]
    df = df.withColumn(shard, _race(root + late).getField("n").cast("int"))
    return df.select(*names, shard)


def number_rows(df: DataFrame, group: str, slot: str) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, in the order they are stored.

    Rows are written once; each keeps the number of its input partition and its
    place there. A window then sees only the rows of one group in one partition,
    however large the group is, and adds the count of the partitions before.
    """
    stored = materialize(
        df.withColumns({"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()}), "slots"
    )
    counts = stored.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(group, "_part", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy(group, "_part").orderBy("_seq")).cast("long") - 1
    numbered = stored.withColumn("_place", place)
    return numbered.join(offsets, [group, "_part"]).select(
        *df.columns, (F.col("_before") + F.col("_place")).alias(slot)
    )


def assign(
    docs: DataFrame, tree: HashTree, id_col: str = "doc_id", text_col: str = "text", grow_by: float = 1.0
) -> DataFrame:
    """Every row with its size, checksum, shard, slot in the shard, and shard after one more is added."""
    rows = only(docs, doc_id=id_col, text=text_col)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = rows.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = descend(rows, tree, "doc_id", "shard")
    rows = descend(rows, tree.grown(grow_by), "doc_id", "grown_shard")
    return number_rows(rows, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
