"""Staging: raw files to a typed Parquet table, read once."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.sources.convert import conform, convert
from starloom.sources.files import CORRUPT, require_files, scan_csv, scan_json, scan_parquet

REJECTED = "is_rejected"
TOP_LEVEL_PATH = re.compile(r"\$(?:\.(\w+)|\['([^'\]]+)'\])")


@dataclass(frozen=True)
class Staged:
    """``rows`` that could be read, and the text of lines that could not."""

    rows: DataFrame
    rejected: DataFrame


def stage(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    raw_schema: StructType | None = None,
    fmt: str = "json",
    json_paths: Sequence[str] | str | None = None,
    glob: str | None = None,
    quoted_newlines: bool = True,
    on_reject: str = "quarantine",
    delimiter: str = ",",
    header: bool = True,
) -> Staged:
    """Load the files below ``source`` into the staging table ``target``.

    ``fmt`` is ``json``, ``csv`` or ``parquet``. JSON fields are matched by name,
    or by ``json_paths``, one path per column of ``schema`` in its order, given as
    a list or as the path of a mapping file.
    ``raw_schema`` declares the kinds in the files where they differ from
    ``schema``. Without ``glob`` every file below ``source`` is read, compressed ones
    too; a source without any file raises ``FileNotFoundError``. The files are parsed
    once; unreadable lines land in a partition of their own, or end the load with
    ``on_reject="fail"``.
    """
    if on_reject not in ("quarantine", "fail"):
        raise ValueError("on_reject is 'quarantine' or 'fail'")
    raw = raw_schema or schema
    if fmt == "json" and json_paths is not None:
        lines = spark.read.option("recursiveFileLookup", "true")
        if glob:
            lines = lines.option("pathGlobFilter", glob)
        if isinstance(json_paths, str):
            json_paths = read_json_paths(spark, json_paths)
        written = require_files(lines.text(source), source).filter(F.trim("value") != "")
        parsed = by_json_paths(written, schema, json_paths)
    elif fmt == "json":
        parsed = typed(require_files(scan_json(spark, source, raw, glob), source), schema)
    elif fmt == "csv":
        found = scan_csv(spark, source, raw, glob, quoted_newlines, CORRUPT, delimiter, header)
        parsed = typed(require_files(found, source), schema)
    elif fmt == "parquet":
        parsed = typed(require_files(scan_parquet(spark, source), source), schema)
    else:
        raise ValueError(f"format {fmt!r} is not one of json, csv, parquet")

    write_staged(parsed, target)
    staged = read_staged(spark, target, schema)
    if on_reject == "fail" and not staged.rejected.isEmpty():
        raise ValueError(f"{source} has lines that do not fit; see {target}")
    return staged


def write_staged(parsed: DataFrame, target: str) -> None:
    """Store parsed rows; those with corrupt text go to a partition of their own."""
    marked = parsed.withColumn(REJECTED, F.col(CORRUPT).isNotNull())
    marked.write.mode("overwrite").partitionBy(REJECTED).parquet(target)


def read_staged(spark: SparkSession, target: str, schema: StructType) -> Staged:
    """A table written by :func:`write_staged`. Either half reads only its own directory."""
    stored = spark.read.schema(
        StructType([*schema.fields]).add(CORRUPT, StringType()).add(REJECTED, "boolean")
    ).parquet(target)
    return Staged(
        rows=stored.filter(~F.col(REJECTED)).select(*schema.names),
        rejected=stored.filter(F.col(REJECTED)).select(CORRUPT),
    )


def read_json_paths(spark: SparkSession, path: str) -> list[str]:
    """The paths in a mapping file: ``{"jsonpaths": ["$.first", "$['second']", ...]}``."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return json.loads(text)["jsonpaths"]


def by_json_paths(
    lines: DataFrame, schema: StructType, json_paths: Sequence[str], value: str = "value"
) -> DataFrame:
    """Columns of ``schema`` taken from JSON text in ``value``, one path per column.

    All paths to top-level members share one parse of the line. Other columns of
    ``lines`` are kept in front.
    """
    if len(json_paths) != len(schema):
        raise ValueError(f"{len(schema)} columns but {len(json_paths)} paths")
    kept = [name for name in lines.columns if name != value]
    members = [TOP_LEVEL_PATH.fullmatch(path) for path in json_paths]
    names = sorted({match[1] or match[2] for match in members if match})
    parse_as = StructType([StructField(name, StringType()) for name in names])
    parse_as = parse_as.add(CORRUPT, StringType())
    parsed = lines.withColumn(
        "_json",
        F.from_json(value, parse_as, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}),
    )

    def text_at(path: str, match: re.Match | None) -> Column:
        if match:
            return F.col("_json").getField(match[1] or match[2])
        return F.get_json_object(value, path)

    found = [
        convert(text_at(path, match), StringType(), field.dataType).alias(field.name)
        for field, path, match in zip(schema, json_paths, members)
    ]
    return parsed.select(*kept, *found, F.col("_json").getField(CORRUPT).alias(CORRUPT))


def typed(raw: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` plus the corrupt text, which is NULL where there is no such column."""
    if CORRUPT not in raw.columns:
        raw = raw.withColumn(CORRUPT, F.lit(None).cast("string"))
    return conform(raw, StructType([*schema.fields]).add(CORRUPT, StringType()))
