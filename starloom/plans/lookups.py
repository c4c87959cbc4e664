"""CSV event files to one staged file and the lookup tables built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.load import write_quoted_csv
from starloom.operators.lookup import LOOKUP_TABLES, store_lookup
from starloom.operators.rows import non_empty
from starloom.schemas import RAW_EVENT_CSV, STAGED_LISTEN
from starloom.sources import conform, scan_csv


def stage_listens(
    spark: SparkSession,
    source: str,
    target: str,
    quoted_newlines: bool = True,
    glob: str = "*.csv",
    compression: str = "none",
) -> DataFrame:
    """Rows with an artist, cut to the eleven staged columns and stored as quoted CSV.

    ``glob`` names the files below ``source``, ``compression`` is that of the staged files.
    """
    events = scan_csv(spark, source, RAW_EVENT_CSV, glob, quoted_newlines)
    staged = conform(non_empty(events, "artist"), STAGED_LISTEN)
    write_quoted_csv(staged, target, compression=compression)
    return scan_csv(spark, target, STAGED_LISTEN, "*.csv*", quoted_newlines)


def load_lookups(staged: DataFrame, output: str, order: Sequence[str] = ()) -> dict[str, str]:
    """Build and store every lookup table; gives the path of each.

    ``staged`` is read once per table, which needs other columns and another
    order each time.
    """
    paths = {}
    for lookup in LOOKUP_TABLES:
        paths[lookup.name] = f"{output}/{lookup.name}"
        store_lookup(staged, paths[lookup.name], lookup, order)
    return paths
