"""A whole load: stage the files, build the star, check it, make it current."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom import schemas
from starloom.operators import dims, publish, quality
from starloom.operators.rows import distinct_rows, plays_only
from starloom.operators.upsert import insert_absent, merge_upsert
from starloom.plans.profiles import Profile
from starloom.plans.star import build_catalogue, build_songplays, build_time, build_users
from starloom.sources import read_staged, stage
from starloom.storage import materialize, scratch

MERGE_UPDATES = {"users": dims.USER_UPDATE, "artists": dims.ARTIST_UPDATE}
REGISTRY = {table.name: table for table in schemas.STAR}

#: How often a load is built that others overtake.
ATTEMPTS = 10

PRIMARY_KEYS = {table.name: list(table.primary_key) for table in schemas.DIMENSIONS}


@dataclass(frozen=True)
class Sources:
    """Where the raw files are and how they are written.

    Without a glob every file below a folder is read. CSV has the columns of the
    staging tables in their order, unless ``events_raw`` says otherwise; large files
    whose fields hold no line breaks are split with ``quoted_newlines=False``.
    """

    songs: str
    events: str
    songs_format: str = "json"
    events_format: str = "json"
    songs_json_paths: Sequence[str] | str | None = None
    events_json_paths: Sequence[str] | str | None = None
    songs_glob: str | None = None
    events_glob: str | None = None
    events_raw: StructType = schemas.RAW_EVENT
    delimiter: str = ","
    header: bool = True
    quoted_newlines: bool = True
    on_reject: str = "quarantine"


def run(
    spark: SparkSession,
    sources: Sources,
    output: str,
    profile: Profile,
    version: str | None = None,
) -> str:
    """Load everything under ``output``; gives the name of the version.

    Tables are written to directories of their own and published together at
    the end, after the checks; a load that fails before leaves readers with
    what they had. Several loads may run at the same time: one that was built on
    tables that another has changed meanwhile builds them again from its staged rows.
    """
    version = version or uuid.uuid4().hex
    staged = _stage(spark, sources, output, version)
    for attempt in range(ATTEMPTS):
        # Intermediates of the keys are of no use once the versions are written.
        with scratch(spark):
            try:
                _build(spark, staged["songs"], staged["events"], output, profile, version)
                break
            except publish.Conflict:
                if attempt + 1 == ATTEMPTS:
                    raise
    return version


def _stage(spark: SparkSession, sources: Sources, output: str, version: str) -> dict[str, DataFrame]:
    """The raw files as typed tables, songs and events."""
    staging = f"{output}/{publish.STAGING}/{version}"
    staged: dict[str, DataFrame] = {}

    def stage_files(name: str, path: str, fmt: str, paths, glob, typed, raw) -> None:
        staged[name] = stage(
            spark,
            path,
            f"{staging}/{name}",
            typed,
            raw,
            fmt=fmt,
            json_paths=paths,
            glob=glob,
            quoted_newlines=sources.quoted_newlines,
            on_reject=sources.on_reject,
            delimiter=sources.delimiter,
            header=sources.header,
        ).rows

    songs_from = (sources.songs, sources.songs_format, sources.songs_json_paths, sources.songs_glob)
    events_from = (sources.events, sources.events_format, sources.events_json_paths, sources.events_glob)
    _together(
        [
            (stage_files, "songs", *songs_from, schemas.STAGED_SONG, schemas.RAW_SONG),
            (stage_files, "events", *events_from, schemas.STAGED_EVENT, sources.events_raw),
        ]
    )
    return staged


def _build(
    spark: SparkSession, raw_songs: DataFrame, events: DataFrame, output: str, profile: Profile, version: str
) -> None:
    published = publish.current(spark, output)
    replaced: dict[str, list[str]] = {}
    watches: dict[str, quality.Watch] = {}

    def earlier(table: str) -> DataFrame:
        return publish.read_state(spark, output, table, published[table])

    def whole(table: str) -> DataFrame:
        """The table as readers will see it."""
        if modes[table] == "append" and table in published:
            rows = earlier(table)
            if table in replaced:
                rows = publish.in_files(rows, replaced[table], inside=False)
            return rows.unionByName(stored[table])
        return stored[table]

    modes: dict[str, str] = {}
    stored: dict[str, DataFrame] = {}

    def write(table: str, df: DataFrame, number: str | None = None) -> None:
        mode = profile.load_modes.get(table, "overwrite")
        if table in published and mode in ("merge", "insert"):
            if mode == "merge":
                # Only files that hold an incoming key are written again.
                keys, rows, df = PRIMARY_KEYS[table], earlier(table), materialize(df, f"incoming-{table}")
                files = publish.touched_files(rows, df, keys)
                df = merge_upsert(publish.in_files(rows, files), df, keys, MERGE_UPDATES[table])
                replaced[table] = files
            else:
                within = "start_time" if table == "time" else None
                df = insert_absent(earlier(table), df, PRIMARY_KEYS[table], within)
        stored[table] = publish.write_version(
            df,
            output,
            table,
            version,
            profile.partition_by.get(table, ()),
            number,
            PRIMARY_KEYS[table] if mode == "merge" else (),
            watches.setdefault(table, quality.Watch(REGISTRY[table])),
        )
        modes[table] = "append" if mode in ("append", "insert", "merge") else "overwrite"

    catalogue = build_catalogue(raw_songs, profile)
    _together([(write, name, df) for name, df in catalogue.items()])
    # Plays are matched against the songs of earlier loads too, where those stay.
    catalogue = {name: whole(name) for name in catalogue}

    first_id = 1
    if profile.play_key == "dense" and "songplays" in published:
        first_id = 1 + _last_id(spark, output, published["songplays"])
    marked: dict[str, str] = {}
    if profile.play_key == "monotonic":
        unnumbered = replace(profile, play_key="none")
        songplays = build_songplays(events, raw_songs, catalogue, unnumbered)
        write("songplays", songplays, number="songplay_id")
    elif profile.play_key == "dense" and not profile.partition_by.get("songplays"):
        # Written once; the numbers follow from where rows stand when they are read.
        ranged = build_songplays(events, raw_songs, catalogue, replace(profile, play_key="ranged"))
        watch = watches["songplays"] = quality.Watch(REGISTRY["songplays"])
        numbered = (output, "songplays", version, "songplay_id", first_id, watch)
        stored["songplays"] = publish.write_numbered(ranged, *numbered)
        mode = profile.load_modes.get("songplays", "overwrite")
        modes["songplays"], marked["songplays"] = "append" if mode == "append" else "overwrite", "songplay_id"
    else:
        write("songplays", build_songplays(events, raw_songs, catalogue, profile, first_id))
    _together(
        [
            (write, "users", build_users(events, profile)),
            (write, "time", build_time(events, stored["songplays"], profile)),
        ]
    )
    # What readers will see counts: a load that repeats an earlier one may add nothing. New rows
    # have been counted by the jobs that wrote them.
    if profile.check:
        quality.require_not_empty({name: whole(name) for name in stored if not watches[name].rows})
    if profile.enforce:
        frames = {name: whole(name) for name in stored}
        checks = [quality.check_table(table, frames, rows=False) for table in schemas.STAR]
        for table in schemas.STAR:
            if modes[table.name] == "append" and table.name in published:
                checks += quality.check_rows(table, earlier(table.name))
        failures = [line for watch in watches.values() for line in watch.failures()]
        quality.require(quality.report([each for each in checks if each is not None]), failures)
    columns = {name: df.schema for name, df in stored.items()}
    built_on = {name for name in stored if profile.load_modes.get(name) in ("merge", "insert")}
    if profile.play_key == "dense":
        built_on.add("songplays")
    if profile.match_against == "dimensions":
        built_on |= {name for name in catalogue if modes[name] == "append"}
    based_on = {name: published[name].sequence if name in published else 0 for name in built_on}
    publish.publish(spark, output, version, modes, columns, based_on, replaced, marked)


def _last_id(spark: SparkSession, output: str, plays: publish.Published) -> int:
    """The largest key given so far. Keys grow from version to version, so the
    last version with any rows has it."""
    for version in reversed(plays.versions):
        if version in plays.marked:
            largest = publish.last_number(spark, output, "songplays", version)
            if largest is not None:
                return largest
            continue
        rows = publish.read_versions(spark, output, "songplays", [version], plays.schema)
        largest = rows.agg(F.max("songplay_id")).first()[0]
        if largest is not None:
            return largest
    return 0


def _together(jobs: Sequence[tuple]) -> None:
    """Run independent writes at the same time; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for done in [pool.submit(copy_context().run, *job) for job in jobs]:
            done.result()


def read_table(spark: SparkSession, output: str, table: str) -> DataFrame:
    """The current rows of a star table."""
    return publish.read_published(spark, output, table)


def fan_out(spark: SparkSession, output: str, version: str, profile: Profile) -> DataFrame:
    """One row: plays that a load brought, fact rows that it made of them, and their ratio.

    Needs the load's staged events, which stay until :func:`publish.vacuum`.
    """
    staged = read_staged(spark, f"{output}/{publish.STAGING}/{version}/events", schemas.STAGED_EVENT)
    plays = plays_only(staged.rows, profile.play_page)
    if profile.dedup_raw:
        plays = distinct_rows(plays)
    state = publish.current(spark, output)["songplays"]
    fact = publish.read_versions(spark, output, "songplays", [version], state.schema)
    return quality.fan_out(plays, fact)


def create_views(spark: SparkSession, output: str, profile: Profile | None = None) -> list[str]:
    """Temporary views of all published tables, for SQL; with the profile's headings if given."""
    published = publish.current(spark, output)
    for name, state in published.items():
        rows = publish.read_state(spark, output, name, state)
        if profile:
            rows = labelled(rows, name, profile)
        rows.createOrReplaceTempView(name)
    return sorted(published)


def labelled(df: DataFrame, table: str, profile: Profile) -> DataFrame:
    """``df`` under the profile's own column headings."""
    return df.withColumnsRenamed(dict(profile.labels.get(table, {})))
