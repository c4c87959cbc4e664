"""Star tables in the session's catalog, with the types that a profile gives them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql.types import DataType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from starloom import schemas
from starloom.operators import tables
from starloom.plans.load import read_table
from starloom.plans.profiles import Profile
from starloom.schemas import Table

WEEKDAY_NUMBERS = ("sunday0", "sunday1")


def star_tables(profile: Profile) -> tuple[Table, ...]:
    """The registry's star tables as ``profile`` fills them, dimensions first."""
    key = StringType() if profile.play_key == "hash" else LongType()
    place = None if profile.coordinate_scale is None else DecimalType(18, profile.coordinate_scale)
    types: dict[str, dict[str, DataType]] = {
        "songs": {"duration": DecimalType(18, profile.duration_scale)},
        "artists": {} if place is None else {"latitude": place, "longitude": place},
        "time": {
            "month": StringType() if profile.month_as_text else IntegerType(),
            "weekday": IntegerType() if profile.weekday_style in WEEKDAY_NUMBERS else StringType(),
        },
        "songplays": {"songplay_id": key},
    }
    added: dict[str, list[StructField]] = {
        "time": [StructField("ts", LongType())] if profile.time_keeps_epoch else [],
        "songplays": [StructField(name, IntegerType()) for name in profile.calendar_columns],
    }
    return tuple(
        replace(table, schema=_retyped(table.schema, types.get(table.name, {}), added.get(table.name, [])))
        for table in schemas.STAR
    )


def _retyped(schema: StructType, types: dict[str, DataType], added: list[StructField]) -> StructType:
    fields = [StructField(f.name, types.get(f.name, f.dataType)) for f in schema]
    return StructType([*fields, *added])


def recreate_star(
    spark: SparkSession, profile: Profile, database: str | None = None, location: str | None = None
) -> None:
    """Drop the profile's tables, dependants first, and create them empty."""
    tables.recreate_all(spark, star_tables(profile), database, location)


def load_catalog(
    spark: SparkSession, output: str, profile: Profile, database: str | None = None, truncate: bool = True
) -> None:
    """Put what a load has published under ``output`` into the profile's catalog tables."""
    for table in star_tables(profile):
        name = f"`{database}`.`{table.name}`" if database else f"`{table.name}`"
        tables.insert_by_name(read_table(spark, output, table.name), name, truncate)
