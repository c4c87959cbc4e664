"""Repeated loads: each run takes the files that arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starloom import schemas
from starloom.operators import dims, publish, quality
from starloom.operators.load import write_table
from starloom.operators.match import join_catalogue
from starloom.operators.rows import ROW_HASH, distinct_rows, plays_only, row_hash, with_keys
from starloom.operators.upsert import merge_states, rows_of
from starloom.plans.profiles import Profile
from starloom.plans.star import build_catalogue, build_songplays, build_time
from starloom.sources.staging import read_staged, typed, write_staged
from starloom.storage import children, remove

BATCH = "batch_id"
COMPACTED = ("users", "time", "songplays", "events")

# Of a stored play: its batch and place there, whether it has a song, and the last batch
# of songs that it has been matched with.
OF_BATCH, PLAY_ROW, MATCHED, THROUGH, SINCE = "_batch", "_play", "matched", "songs_through", "_since"

# Of a stored event: its hash and its day.
DAY, DAY_MS = "_day", 24 * 60 * 60 * 1000
EVENT_HASHES = StructType([StructField(name, LongType()) for name in (*ROW_HASH, DAY)])


def load_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    checkpoint: str,
    apply_batch: Callable[[DataFrame, int], None],
    fmt: str = "json",
    max_files: int | None = None,
    glob: str | None = None,
    corrupt_column: str | None = None,
) -> None:
    """Hand new files to ``apply_batch`` in batches of up to ``max_files``, then stop.

    ``checkpoint`` remembers what has been read and numbers the batches; it
    belongs to the tables the batches go to and must live as long as they do. A
    batch may be handed over again after a failure, so ``apply_batch`` must give
    the same result the second time. With ``corrupt_column`` lines of JSON or CSV
    that cannot be read arrive with their text in that column.
    """
    if corrupt_column:
        schema = StructType([*schema.fields]).add(corrupt_column, StringType())
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    query = (
        reader.load(source)
        .writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_batch(df: DataFrame, path: str, batch_id: int) -> DataFrame:
    """Store one batch's rows and give them back; a batch that comes again replaces itself."""
    target = f"{path}/{BATCH}={batch_id}"
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


@dataclass(frozen=True)
class IncrementalStar:
    """The star kept up to date batch by batch; what readers see equals one load of all files.

    Each batch adds its own files and touches nothing stored before: raw songs that are
    new, or plays, distinct times, and one state per user. Reading merges the states into
    the first names seen and the last level, by event time, whatever order the batches
    came in. :meth:`compact` replaces many small batches by one table and :meth:`vacuum`
    removes them.

    **Songs that come after their plays.** Plays are matched with the songs of the batches
    so far, and the directory of a batch says up to which. Each play is stored with what
    it is matched on, and those without a song apart. A batch of songs finds the keys
    whose songs it changes, looks for stored plays with such a key - only among those
    without a song, unless the key had songs before - and stores all rows of these plays
    again as a correction. Readers take, for each key, the rows of the last correction
    that came after the play's own batch.

    **Events that come again.** With ``dedup_raw`` in the profile an event counts once,
    however many batches bring it. Stored events carry a hash and lie in directories by
    day, and a batch is compared with the hashes of its own days only: a repeated event
    has the same time. Nothing expires, so there is no bound on how late it may come.

    Plays need a key that a repeated batch gives again, so ``profile`` must use the hash
    key. Batches of songs and of events may come in any order, and a batch that failed may
    come again after batches of the other kind, but only one is loaded at a time. With
    ``checked`` every batch of events leaves a quality report, and ends in an error if a
    table has no rows.
    """

    root: str
    profile: Profile
    event_schema: StructType
    order: Sequence[str] = dims.EVENT_ORDER
    checked: bool = False

    def __post_init__(self) -> None:
        if self.profile.play_key != "hash":
            raise ValueError("repeated batches need the hash key")

    # Songs

    def song_loader(self, spark: SparkSession) -> Callable[[DataFrame, int], None]:
        """The function that takes batches of raw songs."""

        def apply_batch(songs: DataFrame, batch_id: int) -> None:
            target = f"{self.root}/staged_songs/{BATCH}={batch_id}"
            write_staged(typed(songs, schemas.STAGED_SONG), target)
            staged = distinct_rows(read_staged(spark, target, schemas.STAGED_SONG).rows)
            hashes = row_hash(schemas.STAGED_SONG.names)
            known = self.raw_songs(spark, batch_id - 1).select(*hashes)
            fresh = staged.select("*", *hashes).join(known, list(ROW_HASH), "left_anti").drop(*ROW_HASH)
            write_batch(fresh, f"{self.root}/raw_songs", batch_id)
            self._correct(spark, batch_id)

        return apply_batch

    def raw_songs(self, spark: SparkSession, through: int | None = None) -> DataFrame:
        """Distinct raw rows of the batches of songs, up to one of them if it is named."""
        rows = self._read(spark, "raw_songs", schemas.STAGED_SONG)
        if through is not None:
            rows = rows.filter(F.col(BATCH) <= through)
        return rows.drop(BATCH)

    def songs(self, spark: SparkSession) -> DataFrame:
        return build_catalogue(self.raw_songs(spark), self.profile)["songs"]

    def artists(self, spark: SparkSession) -> DataFrame:
        return build_catalogue(self.raw_songs(spark), self.profile)["artists"]

    @property
    def _keys(self) -> list[str]:
        return [f"_match{i}" for i in range(len(self.profile.match_keys))]

    def _matchable(self, raw_songs: DataFrame) -> DataFrame:
        """The ids of songs and the keys by which plays find them."""
        songs = raw_songs
        if self.profile.match_against == "dimensions":
            known = build_catalogue(raw_songs, self.profile)
            songs = join_catalogue(known["songs"], known["artists"])
        keys = [key.of_song().alias(name) for name, key in zip(self._keys, self.profile.match_keys)]
        return with_keys(songs.select(*keys, "song_id", "artist_id"), *self._keys)

    def _correct(self, spark: SparkSession, batch_id: int) -> None:
        """Store the plays whose songs a batch of songs changes again, with all their songs."""
        keys = self._keys
        before = self._matchable(self.raw_songs(spark, batch_id - 1))
        after = self._matchable(self.raw_songs(spark, batch_id))
        if self.profile.match_against == "raw":
            # Raw rows are only added to.
            new = self._read(spark, "raw_songs", schemas.STAGED_SONG).filter(F.col(BATCH) == batch_id)
            changed = self._matchable(new.drop(BATCH)).select(*keys).distinct()
        else:
            changed = before.exceptAll(after).union(after.exceptAll(before)).select(*keys).distinct()
        known = changed.join(before.select(*keys), keys, "left_semi")
        plays = self._play_rows(spark, batch_id - 1)
        found = plays.filter(~F.col(MATCHED)).join(changed, keys, "left_semi")
        if not known.isEmpty():
            found = found.union(plays.filter(MATCHED).join(known, keys, "left_semi"))
        # A play with several songs has several rows; they are made anew.
        found = found.dropDuplicates([OF_BATCH, PLAY_ROW]).drop("song_id", "artist_id", MATCHED, THROUGH)
        songs = after.join(changed, keys, "left_semi")
        if self.profile.match_duplicates == "first":
            songs = songs.groupBy(*keys).agg(F.min(F.struct("song_id", "artist_id")).alias("_pick"))
            songs = songs.select(*keys, "_pick.*")
        again = found.join(songs.withColumn(MATCHED, F.lit(True)), keys, "left")
        again = again.withColumn(MATCHED, F.coalesce(MATCHED, F.lit(False)))
        write_batch(again.select(*self._play_schema(spark).names, SINCE), f"{self.root}/corrections", batch_id)

    # Events

    def loader(
        self,
        raw_songs: DataFrame | None = None,
        catalogue: dict[str, DataFrame] | None = None,
        spark: SparkSession | None = None,
    ) -> Callable[[DataFrame, int], None]:
        """The function that takes batches of events, to hand to :func:`load_available`.

        Without ``raw_songs`` the songs are those of the batches loaded so far, in
        the session ``spark``, and plays find songs of later batches too.
        """
        if raw_songs is None and spark is None:
            raise ValueError("either the songs or the session is needed")

        def apply_batch(events: DataFrame, batch_id: int) -> None:
            # Parsed once, then read by each table with only the columns it needs, in
            # the caller's session: a streaming batch comes in one of its own.
            session = spark or raw_songs.sparkSession
            target = f"{self.root}/staging/{BATCH}={batch_id}"
            write_staged(typed(events, self.event_schema), target)
            staged = read_staged(session, target, self.event_schema).rows
            if self.profile.dedup_raw:
                staged = self._new_events(session, staged, batch_id)
            through = max(self._numbers(session, "raw_songs"), default=-1)
            songs = raw_songs
            if songs is None:
                songs = self.raw_songs(session, through)
            elif self.profile.dedup_raw:
                songs = distinct_rows(songs)
            known = catalogue or build_catalogue(songs, self.profile)
            plays = self._write_plays(staged, songs, known, batch_id, through)
            users = dims.users_state(plays_only(staged, self.profile.play_page), self.order)
            write_batch(users, f"{self.root}/users", batch_id)
            time = write_batch(build_time(staged, plays, self.profile), f"{self.root}/time", batch_id)
            if self.checked:
                self._check(session, batch_id, known, plays, time)

        return apply_batch

    def _new_events(self, spark: SparkSession, staged: DataFrame, batch_id: int) -> DataFrame:
        """The events of a batch that no earlier one had, once each."""
        day = F.coalesce(F.floor(F.col("ts") / DAY_MS).cast("long"), F.lit(-1)).alias(DAY)
        rows = staged.select("*", *row_hash(staged.columns), day)
        # One value per calendar day that the batch touches.
        days = [row[0] for row in rows.select(DAY).distinct().collect()]
        seen = self._stored(spark, "events", EVENT_HASHES, batch_id - 1).filter(F.col(DAY).isin(days))
        fresh = rows.join(seen.select(*ROW_HASH), list(ROW_HASH), "left_anti").dropDuplicates(ROW_HASH)
        target = f"{self.root}/events/{BATCH}={batch_id}"
        write_table(fresh, target, partition_by=[DAY])
        return spark.read.schema(fresh.schema).parquet(target).select(*staged.columns)

    def _write_plays(
        self, staged: DataFrame, songs: DataFrame, known: dict[str, DataFrame], batch_id: int, through: int
    ) -> DataFrame:
        keys = [key.of_event().alias(name) for name, key in zip(self._keys, self.profile.match_keys)]
        marked = staged.select(
            "*", *keys, F.lit(batch_id).cast("long").alias(OF_BATCH), F.monotonically_increasing_id().alias(PLAY_ROW)
        )
        plays = self._matched(marked, songs, known)
        target = f"{self.root}/songplays/{BATCH}={batch_id}"
        remove(staged.sparkSession, target)
        target = f"{target}/{THROUGH}={through}"
        plays.write.partitionBy(MATCHED).parquet(target)
        plays = staged.sparkSession.read.schema(plays.schema).parquet(target)
        return self._public(plays)

    def _matched(self, marked: DataFrame, songs: DataFrame, known: dict[str, DataFrame]) -> DataFrame:
        # Repeated raw rows are gone by now; plays without a song are kept for later ones.
        profile = replace(self.profile, match_how="left", dedup_raw=False, dedup_fact=False)
        keep = [*self._keys, OF_BATCH, PLAY_ROW]
        # Each batch meets the whole catalogue: a broadcast would bring all of it to the driver each time.
        known = {name: table.hint("merge") for name, table in known.items()}
        plays = build_songplays(marked, songs.hint("merge"), known, profile, keep=keep)
        found = F.col("song_id").isNotNull() | F.col("artist_id").isNotNull()
        return plays.withColumn(MATCHED, found)

    def _play_schema(self, spark: SparkSession) -> StructType:
        events = spark.createDataFrame([], self.event_schema)
        songs = spark.createDataFrame([], schemas.STAGED_SONG)
        keys = [key.of_event().alias(name) for name, key in zip(self._keys, self.profile.match_keys)]
        number = F.lit(0).cast("long")
        marked = events.select("*", *keys, number.alias(OF_BATCH), number.alias(PLAY_ROW))
        return self._matched(marked, songs, build_catalogue(songs, self.profile)).schema

    def _play_rows(self, spark: SparkSession, through: int | None = None) -> DataFrame:
        """Stored plays with their songs as of the batch of songs ``through``, or of all.

        ``songs_through`` is the last batch of songs that a row has seen, ``_since`` the last
        that the play's own batch had seen: a batch of events that came again, or was
        compacted, makes corrections of its former rows void.
        """
        schema, base = self._play_schema(spark), self._base(spark, "songplays")
        stored = self._read(spark, "songplays", StructType([*schema.fields]).add(THROUGH, LongType()))
        live = [number for number in self._numbers(spark, "songplays") if not base or number > _through(base)]
        rows = stored.filter(F.col(BATCH).isin(live)).drop(BATCH).withColumn(SINCE, F.col(THROUGH))
        valid = [(n, at) for n in live for at in self._numbers(spark, f"songplays/{BATCH}={n}", THROUGH)]
        corrected = self._read(spark, "corrections", StructType([*schema.fields]).add(SINCE, LongType()))
        if through is not None:
            corrected = corrected.filter(F.col(BATCH) <= through)
        corrected = corrected.withColumnRenamed(BATCH, THROUGH)
        stands = F.concat_ws(":", OF_BATCH, SINCE).isin([f"{number}:{at}" for number, at in valid])
        if base:
            at = int(base.versions[0].partition("-")[2])
            folded = publish.read_published(spark, self.root, "songplays_base")
            folded = folded.withColumns({THROUGH: F.lit(at).cast("long"), SINCE: F.lit(at).cast("long")})
            rows = folded.select(*rows.columns).union(rows)
            stands |= (F.col(OF_BATCH) <= _through(base)) & (F.col(SINCE) == at)
        corrected = corrected.filter(stands).select(*rows.columns)
        last = corrected.groupBy(*self._keys).agg(F.max(THROUGH).alias("_last"))
        both = rows.union(corrected).join(last, self._keys, "left")
        return both.filter(F.coalesce(F.col(THROUGH) >= F.col("_last"), F.lit(True))).select(*rows.columns)

    def _public(self, plays: DataFrame) -> DataFrame:
        if self.profile.match_how == "inner":
            plays = plays.filter(MATCHED)
        plays = plays.drop(*self._keys, OF_BATCH, PLAY_ROW, MATCHED, THROUGH, SINCE)
        return distinct_rows(plays) if self.profile.dedup_fact else plays

    def _numbers(self, spark: SparkSession, table: str, name: str = BATCH) -> list[int]:
        """The numbers of the directories ``name=...`` of a table."""
        found = children(spark, f"{self.root}/{table}")
        return sorted(int(each.partition("=")[2]) for each in found if each.startswith(f"{name}="))

    def _read(self, spark: SparkSession, table: str, schema: StructType) -> DataFrame:
        """All batches of a table with their number; no rows if there is none."""
        whole = StructType([*schema.fields]).add(BATCH, LongType())
        if not self._numbers(spark, table):
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).parquet(f"{self.root}/{table}")

    def _check(self, spark: SparkSession, batch_id: int, known: dict[str, DataFrame], plays, time) -> None:
        # A batch may bring no play; what readers see must have rows.
        whole = {name: getattr(self, name)(spark) for name in ("users", "time", "songplays")}
        key = next(k for k in schemas.SONGPLAYS.foreign_keys if k.table == "time")
        report = quality.report(
            [
                quality.check_not_empty({**known, **whole}),
                quality.check_not_null("songplays", plays, plays.columns),
                quality.check_foreign_key("songplays", plays, time, key),
            ]
        )
        found = write_batch(report, f"{self.root}/quality", batch_id)
        quality.require(found.filter(F.col("check_name") != "not_null"))

    def reports(self, spark: SparkSession) -> DataFrame:
        """The quality reports of all batches of events."""
        return self._batches(spark, "quality")

    def _batches(self, spark: SparkSession, table: str) -> DataFrame:
        stored = spark.read.option("basePath", f"{self.root}/{table}").parquet(f"{self.root}/{table}")
        return stored.withColumn(BATCH, F.col(BATCH).cast(LongType()))

    def rejected(self, spark: SparkSession) -> DataFrame:
        """The text of all lines that could not be read."""
        return read_staged(spark, f"{self.root}/staging", self.event_schema).rejected

    def songplays(self, spark: SparkSession) -> DataFrame:
        """Plays with the songs of all batches so far."""
        return self._public(self._play_rows(spark))

    def time(self, spark: SparkSession) -> DataFrame:
        """Calendar rows; a time that several batches met appears once."""
        if self.profile.time_scope == "fact" and self.profile.match_how == "inner":
            return build_time(None, self.songplays(spark), self.profile)
        return distinct_rows(self._stored(spark, "time"))

    def users(self, spark: SparkSession) -> DataFrame:
        """One row per user as of all batches so far."""
        states = merge_states(self._stored(spark, "users"), ["user_id"])
        return rows_of(states, ["user_id"], dims.USER_KEEP, dims.USER_UPDATE)

    def _base(self, spark: SparkSession, table: str) -> publish.Published | None:
        return publish.current(spark, self.root).get(f"{table}_base")

    def _stored(
        self, spark: SparkSession, table: str, schema: StructType | None = None, through: int | None = None
    ) -> DataFrame:
        """Rows of the compacted table and of the batches after it."""
        base = self._base(spark, table)
        if base and children(spark, f"{self.root}/{table}") == []:
            return publish.read_published(spark, self.root, f"{table}_base")
        rows = self._batches(spark, table) if schema is None else self._read(spark, table, schema)
        if base:
            rows = rows.filter(F.col(BATCH) > _through(base))
        if through is not None:
            rows = rows.filter(F.col(BATCH) <= through)
        rows = rows.drop(BATCH)
        if base:
            rows = publish.read_published(spark, self.root, f"{table}_base").unionByName(rows)
        return rows

    def compact(self, spark: SparkSession, through: int, tables: Sequence[str] = COMPACTED) -> None:
        """Fold all batches of events up to ``through`` into one table each, without what repeats."""
        for table in tables:
            base, version = self._base(spark, table), str(through)
            if base and _through(base) >= through:
                continue
            if table == "songplays":
                version += f"-{max(self._numbers(spark, 'raw_songs'), default=-1)}"
                rows = self._play_rows(spark).filter(F.col(OF_BATCH) <= through).drop(THROUGH, SINCE)
            elif table == "events":
                if not self.profile.dedup_raw:
                    continue
                rows = self._stored(spark, table, EVENT_HASHES, through).select(*EVENT_HASHES.names)
            else:
                rows = self._stored(spark, table, through=through)
                rows = merge_states(rows, ["user_id"]) if table == "users" else distinct_rows(rows)
            name = f"{table}_base"
            publish.write_version(rows, self.root, name, version, [DAY] if table == "events" else ())
            publish.publish(spark, self.root, version, {name: "overwrite"}, {name: rows.schema})

    def compact_users(self, spark: SparkSession, through: int) -> None:
        """Fold the user states of all batches up to ``through`` into one table."""
        self.compact(spark, through, ("users",))

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Remove batches that have been compacted, and earlier compactions; gives what was removed.

        A batch that has been removed must not be handed over again.
        """
        gone = publish.vacuum(spark, self.root)
        for table in COMPACTED:
            base = self._base(spark, table)
            done = _through(base) if base else -1
            gone += self._remove(spark, table, lambda number, done=done: number <= done)
        # Corrections that all remaining plays have seen.
        base, live = self._base(spark, "songplays"), self._numbers(spark, "songplays")
        seen = [at for n in live for at in self._numbers(spark, f"songplays/{BATCH}={n}", THROUGH)]
        if base:
            seen.append(int(base.versions[0].partition("-")[2]))
        return gone + self._remove(spark, "corrections", lambda number: number <= min(seen, default=-1))

    def _remove(self, spark: SparkSession, table: str, which: Callable[[int], bool]) -> list[str]:
        gone = [f"{table}/{BATCH}={number}" for number in self._numbers(spark, table) if which(number)]
        for path in gone:
            remove(spark, f"{self.root}/{path}")
        return gone


def _through(base: publish.Published) -> int:
    """The last batch that a compacted table holds."""
    return int(base.versions[0].partition("-")[0])
