"""Versions of tables that become readable together.

Each load writes its tables to new directories. One small numbered file in the log
then makes all of them current at once; until that happens readers see the previous
state, and a failed load leaves no trace in it.

Several loaders may work at the same time. Each builds on the state it has read; the
next number of the log can be taken once, so of two that finish together one is second,
reads the first one's state and adds its own tables to that. What a loader made out of
the earlier rows of a table does not fit any more if another loader has changed that
table: :class:`Conflict` is raised, nothing is published, and the loader does that part
again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starloom.functions.keys import place_in_range, range_of, range_starts
from starloom.operators.load import write_table
from starloom.operators.quality import Watch
from starloom.storage import children, create_new, read_text, remove

LOG = "_published"
ENTRY = re.compile(r"(\d{20})\.json")
VERSION = "version"
STAGING = "_staging"
NUMBERS = "_numbers"


@dataclass(frozen=True)
class Published:
    """What readers see of a table: its versions, oldest first, and its columns.

    ``sequence`` is the log entry that changed it last. Files in ``dropped`` have been
    replaced by those of a later version. Versions in ``marked`` hold marks in the column
    ``number`` (see :func:`write_numbered`).
    """

    versions: tuple[str, ...]
    schema: StructType
    sequence: int
    dropped: tuple[str, ...] = ()
    marked: tuple[str, ...] = ()
    number: str | None = None


class Conflict(RuntimeError):
    """Tables that a load was built on have been changed by another one."""


def _latest(spark: SparkSession, root: str) -> tuple[int, dict[str, Published]]:
    """The number of the last log entry, and the state of every table that it holds."""
    entries = [name for name in children(spark, f"{root}/{LOG}") if ENTRY.fullmatch(name)]
    if not entries:
        return 0, {}
    state = json.loads(read_text(spark, f"{root}/{LOG}/{entries[-1]}"))
    found = {
        table: Published(
            tuple(e["versions"]),
            StructType.fromJson(e["columns"]),
            e["sequence"],
            tuple(e["dropped"]),
            tuple(e["marked"]),
            e["number"],
        )
        for table, e in state.items()
    }
    return int(entries[-1].partition(".")[0]), found


def _append(spark: SparkSession, root: str, number: int, state: Mapping[str, Published]) -> bool:
    """Write the log entry ``number`` unless another loader has."""
    entries = {
        table: {
            "versions": each.versions,
            "columns": each.schema.jsonValue(),
            "sequence": each.sequence,
            "dropped": each.dropped,
            "marked": each.marked,
            "number": each.number,
        }
        for table, each in state.items()
    }
    return create_new(spark, f"{root}/{LOG}/{number:020d}.json", json.dumps(entries))


def current(spark: SparkSession, root: str) -> dict[str, Published]:
    """The published state of every table."""
    return _latest(spark, root)[1]


def write_version(
    df: DataFrame,
    root: str,
    table: str,
    version: str,
    partition_by: Sequence[str] = (),
    number: str | None = None,
    order_by: Sequence[str] = (),
    watch: Watch | None = None,
) -> DataFrame:
    """Store rows under a version that nobody reads yet; gives the stored rows.

    With ``order_by`` each file holds a range of these columns; ``watch`` counts the rows.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    path = f"{root}/{table}/{VERSION}={version}"
    write_table(df, path, "overwrite", partition_by, number=number, watch=watch)
    schema = df.schema
    if number:
        schema = StructType([StructField(number, LongType()), *schema.fields])
    return read_versions(df.sparkSession, root, table, [version], schema)


def write_numbered(
    df: DataFrame, root: str, table: str, version: str, number: str, start: int, watch: Watch | None = None
) -> DataFrame:
    """Store rows that are to be numbered ``start``, ``start + 1``, ... in their order; gives them numbered.

    They are written once, with a mark of their task and place. A small table beside the
    version has the first number of each task's rows (one row per task), and readers add the
    two. Publish the version as ``marked``.
    """
    marks = write_version(df, root, table, version, number=number, watch=watch)
    range_starts(marks, number, start).coalesce(1).write.mode("overwrite").parquet(_numbers(root, table, version))
    return read_versions(df.sparkSession, root, table, [version], marks.schema, [version], number)


def last_number(spark: SparkSession, root: str, table: str, version: str) -> int | None:
    """The largest number of a marked version, from its small table; None if it has no rows."""
    starts = spark.read.parquet(_numbers(root, table, version))
    return starts.agg(F.max(F.col("_first") + F.col("_rows") - 1)).first()[0]


def _numbers(root: str, table: str, version: str) -> str:
    return f"{root}/{NUMBERS}/{table}/{VERSION}={version}"


def publish(
    spark: SparkSession,
    root: str,
    version: str,
    modes: Mapping[str, str],
    schemas: Mapping[str, StructType],
    based_on: Mapping[str, int] | None = None,
    dropped: Mapping[str, Sequence[str]] | None = None,
    marked: Mapping[str, str] | None = None,
) -> int:
    """Make ``version`` current for the given tables; gives the number of the log entry.

    ``modes`` maps a table to ``overwrite`` (only this version is read from now
    on) or ``append`` (this version joins those already published, less the files
    that it replaces, ``dropped``). ``based_on`` maps tables whose earlier rows went
    into the load to the ``sequence`` they had (0 for none): if one has another by
    now, :class:`Conflict` is raised. ``marked`` maps tables written by
    :func:`write_numbered` to the column of the number.
    """
    for table, mode in modes.items():
        if mode not in ("overwrite", "append"):
            raise ValueError(f"{table}: mode is 'overwrite' or 'append'")
    while True:
        number, now = _latest(spark, root)
        changed = [t for t, at in (based_on or {}).items() if (now[t].sequence if t in now else 0) != at]
        if changed:
            raise Conflict(f"{', '.join(changed)} changed while version {version} was made")
        state = dict(now)
        for table, mode in modes.items():
            versions, gone = (version,), ()
            number_col = (marked or {}).get(table)
            marks = (version,) if number_col else ()
            if mode == "append" and table in now:
                versions = (*[v for v in now[table].versions if v != version], version)
                gone = (*now[table].dropped, *(dropped or {}).get(table, ()))
                marks = (*[v for v in now[table].marked if v != version], *marks)
                number_col = number_col or now[table].number
            state[table] = Published(versions, schemas[table], number + 1, gone, marks, number_col)
        # Whoever is second reads the other's entry and tries the next number.
        if _append(spark, root, number + 1, state):
            return number + 1


def touched_files(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> list[str]:
    """Names of the files of ``stored`` (as :func:`read_versions` gives it) that hold a key of ``incoming``.

    Only the key columns are read. The driver gets one name per file.
    """
    held = stored.select(*keys, F.col("_metadata.file_name").alias("_file"))
    return [row[0] for row in held.join(incoming.select(*keys), list(keys), "left_semi").select("_file").distinct().collect()]


def in_files(stored: DataFrame, files: Sequence[str], inside: bool = True) -> DataFrame:
    """The rows of ``stored`` in the named files, or outside of them; other files are not opened."""
    named = F.col("_metadata.file_name").isin(list(files))
    return stored.filter(named if inside else ~named)


def compact(
    spark: SparkSession, root: str, table: str, version: str, partition_by: Sequence[str] = ()
) -> None:
    """Put all versions of a table into one, ``version``, and make that current."""
    now = current(spark, root)[table]
    if len(now.versions) > 1:
        rows = read_state(spark, root, table, now)
        write_version(rows, root, table, version, partition_by)
        publish(spark, root, version, {table: "overwrite"}, {table: now.schema}, {table: now.sequence})


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Remove what no reader needs any more; gives what was removed.

    These are versions that were replaced, compacted or never published, files that
    later versions replace, staged raw files, and log entries but the last. Only while
    no load is running, and when no reader still works on an older version.
    """
    gone = []
    number, state = _latest(spark, root)
    for table, each in state.items():
        names = children(spark, f"{root}/{table}")
        kept = {f"{VERSION}={version}" for version in each.versions}
        gone += [f"{table}/{name}" for name in names if name.startswith(f"{VERSION}=") and name not in kept]
        if each.dropped:
            held = [f"{table}/{of}/{name}" for of in kept for name in children(spark, f"{root}/{table}/{of}")]
            gone += [path for path in held if path.rpartition("/")[2] in each.dropped]
        starts = f"{NUMBERS}/{table}"
        read = {f"{VERSION}={version}" for version in each.marked}
        gone += [f"{starts}/{name}" for name in children(spark, f"{root}/{starts}") if name not in read]
    gone += [f"{STAGING}/{name}" for name in children(spark, f"{root}/{STAGING}")]
    gone += [f"{LOG}/{name}" for name in children(spark, f"{root}/{LOG}") if name != f"{number:020d}.json"]
    for path in gone:
        remove(spark, f"{root}/{path}")
    return gone


def read_versions(
    spark: SparkSession,
    root: str,
    table: str,
    versions: Sequence[str],
    schema: StructType,
    marked: Sequence[str] = (),
    number: str | None = None,
) -> DataFrame:
    """Rows of the named versions; only their directories are listed."""

    def read(some: Sequence[str]) -> DataFrame:
        reader = spark.read.schema(schema).option("basePath", f"{root}/{table}")
        stored = reader.parquet(*[f"{root}/{table}/{VERSION}={v}" for v in some])
        return stored.select(*schema.names)

    parts = [read(plain)] if (plain := [v for v in versions if v not in marked]) else []
    for version in [v for v in versions if v in marked]:
        # One row per task that wrote the version.
        starts = spark.read.parquet(_numbers(root, table, version)).drop("_rows")
        rows = read([version]).withColumn("_range", range_of(number)).join(F.broadcast(starts), "_range")
        value = (place_in_range(number) + F.col("_first")).alias(number)
        parts.append(rows.select(*[value if name == number else F.col(name) for name in schema.names]))
    return reduce(DataFrame.union, parts)


def read_state(spark: SparkSession, root: str, table: str, state: Published) -> DataFrame:
    """The rows of a published state, without those of replaced files."""
    rows = read_versions(spark, root, table, state.versions, state.schema, state.marked, state.number)
    return in_files(rows, state.dropped, inside=False) if state.dropped else rows


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current rows of a table."""
    found = current(spark, root).get(table)
    if found is None:
        raise LookupError(f"{table} has not been published under {root}")
    return read_state(spark, root, table, found)
