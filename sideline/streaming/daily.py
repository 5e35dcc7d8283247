"""The daily analysis-ready run, by affected keys: only what new data touches is computed again.

Finding new files is a Structured Streaming query (``trigger(availableNow=True)``, started by any scheduler once a
day) over the listing alone: it appends the paths of files not yet seen to a table. A run then reads its files by
header names, unfiltered, and lands them as one batch, split by a hash of the player into a fixed number of buckets.
The analysis-ready table has the same partitions, (landed_batch, player_bucket).

An incident or a game date may arrive days after the activity it belongs to, or be withdrawn. So each run compares
the players with windowed incidents and the game dates with those of the last finished run, and recomputes

* the partitions of the batches that are new,
* the bucket of each player who is now, or no longer, among the incidents, in all batches,
* the partitions that hold a game whose date is new, changed or gone (by a small table of the games in each partition).

Other partitions are neither read nor written. The result equals the batch job J4 over everything that has arrived.

A run's state (players, game dates, files) is written last, behind a marker: a run that dies is repeated as if it had
not been, over the same batch number. Nothing here may run twice at a time on one output folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import INCIDENT_DATE_FORMATS, parse_date
from ..operators.joins import lookup, restrict_to
from ..operators.stats import dedup_first
from ..plans.jobs import ACTIVITY_COLUMNS, SEASON_END, SEASON_START, windowed_incidents
from ..sources.readers import read_csv
from ..sources.sinks import write_parquet

# Activity file columns read as text.
ACTIVITY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ACTIVITY_COLUMNS])

BATCH, BUCKET = "landed_batch", "player_bucket"
#: Buckets of players within a batch; part of the layout, the same from run to run.
PLAYER_BUCKETS = 16
_PARTS = T.StructType([T.StructField(BATCH, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def discover_files(spark: SparkSession, activity_dir: str, seen: str, checkpoint: str,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start one pass that appends the paths of new files of ``activity_dir`` to the table ``seen``. Their contents
    are not read. ``max_files_per_trigger`` bounds a micro-batch when a large backlog has arrived."""
    reader = spark.readStream.format("binaryFile").schema(_LISTING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(activity_dir).where("length > 0").select("path").writeStream.format("parquet")
                  .option("path", seen).option("checkpointLocation", checkpoint)
                  .outputMode("append").trigger(availableNow=True).start())


def read_activity(spark: SparkSession, files: list[str], file_format: str = "csv",
                  schema: T.StructType = ACTIVITY_SCHEMA) -> DataFrame:
    """The columns of ``schema`` from activity files, by name. A file that lacks one is refused (``KeyError``)."""
    if file_format == "csv":
        return read_csv(spark, files, schema=schema, required=schema.names)
    return spark.read.schema(schema).format(file_format).load(files)


def land(df: DataFrame, landed: str, games: str, batch: int, buckets: int = PLAYER_BUCKETS) -> None:
    """Write activity as batch ``batch``, replacing what an unfinished run left of it, and the games in each bucket."""
    df = df.withColumn(BUCKET, F.pmod(F.xxhash64("playerNameI"), F.lit(buckets)).cast("int"))
    write_parquet(df, f"{landed}/{BATCH}={batch}", [BUCKET])
    written = df.sparkSession.read.schema(df.schema).parquet(f"{landed}/{BATCH}={batch}")
    write_parquet(written.select("gameId", BUCKET).distinct(), f"{games}/{BATCH}={batch}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _partitions(spark: SparkSession, path: str) -> dict[tuple[int, int], set[str]]:
    """(batch, bucket) of the folders of a table and the names of their files, by one listing."""
    fs, p = _fs(spark, f"{path}/{BATCH}=*/{BUCKET}=*/*.parquet")
    out: dict[tuple[int, int], set[str]] = {}
    for x in fs.globStatus(p) or []:
        batch, bucket, name = x.getPath().toString().rsplit("/", 3)[1:]
        out.setdefault((int(batch.partition("=")[2]), int(bucket.partition("=")[2])), set()).add(name)
    return out


class State:
    """What the last finished run knew: ``players``, ``games`` and its number (-1: no run has finished)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        fs, p = _fs(spark, folder)
        done = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
        self.run = max((int(n[5:]) for n in done if n.startswith("done-")), default=-1)

    def table(self, name: str, schema: str) -> DataFrame:
        if self.run < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}-{self.run}")

    def landed_files(self) -> DataFrame:
        """Paths of the files that finished runs landed."""
        if self.run < 0:
            return self.spark.createDataFrame([], "path string")
        return self.spark.read.schema("path string").parquet(*[f"{self.folder}/files-{i}" for i in range(self.run + 1)])

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """A table of the next run's state, written and read back; it counts once the run has finished."""
        path = f"{self.folder}/{name}-{self.run + 1}"
        write_parquet(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, about: dict) -> None:
        """Write the marker of the next run; only then drop the state before."""
        self.spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/done-{self.run + 1}")
        for name in ("players", "games", "done"):
            if self.run >= 0:
                _delete(self.spark, f"{self.folder}/{name}-{self.run}")


def _changed(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys whose row is new, gone or another than before; one row per key on either side."""
    one = lambda df, mark: df.select(key, F.struct(*df.columns).alias(mark))
    both = one(now, "_now").join(one(before, "_before"), key, "full_outer")
    return both.where(~F.col("_now").eqNullSafe(F.col("_before"))).select(key)


def _touched(state: State, batch: int, players: DataFrame, games: DataFrame, games_landed: DataFrame, buckets: int) -> tuple[list[int], list[tuple]]:
    """Buckets to recompute in all batches, and single (batch, bucket) partitions of earlier batches."""
    changed = _changed(players, state.table("players", "playerNameFormatted string"), "playerNameFormatted")
    at = F.pmod(F.xxhash64("playerNameFormatted"), F.lit(buckets)).cast("int")
    hot = sorted(r[0] for r in changed.select(at.alias("b")).distinct().collect())  # at most ``buckets``
    if len(hot) == buckets or not batch:
        return hot, []
    dated = _changed(games, state.table("games", "gameId string, gameDate date"), "gameId")
    parts = (games_landed.where((F.col(BATCH) < batch) & ~F.col(BUCKET).isin(hot)).join(dated, "gameId", "left_semi")
             .select(BATCH, BUCKET).distinct())
    return hot, sorted((r[0], r[1]) for r in parts.collect())  # at most one per partition


def _where(batch: int, hot: list[int], parts: list[tuple]):
    """The partitions to recompute, as a filter that prunes folders."""
    cond = (F.col(BATCH) >= batch) | F.col(BUCKET).isin(hot)
    by_batch: dict[int, list[int]] = {}
    for b, p in parts:
        by_batch.setdefault(b, []).append(p)
    for b, own in by_batch.items():
        cond = cond | ((F.col(BATCH) == b) & F.col(BUCKET).isin(own))
    return cond


def run_daily(spark: SparkSession, activity_dir: str, incidents: DataFrame, game_dates: DataFrame,
              out_prefix: str, checkpoint: str | None = None, start: str = SEASON_START,
              end: str = SEASON_END, file_format: str = "csv", schema: T.StructType = ACTIVITY_SCHEMA,
              max_files_per_trigger: int | None = None, buckets: int = PLAYER_BUCKETS) -> DataFrame:
    """Land what is new, then bring ``injuries_windowed`` and ``analysis_ready`` under ``out_prefix`` up to date;
    returns the latter, without its partition columns. ``checkpoint`` defaults to a folder under ``out_prefix``; it,
    ``schema`` and ``buckets`` must stay the same from run to run."""
    base = out_prefix.rstrip("/")
    seen, landed, games_at, final_at = f"{base}/_seen", f"{base}/activity", f"{base}/games_landed", f"{base}/analysis_ready"
    discover_files(spark, activity_dir, seen, checkpoint or f"{base}/_landing", max_files_per_trigger).awaitTermination()
    state = State(spark, f"{base}/_state")
    batch = state.run + 1
    listed = spark.read.schema("path string").parquet(seen) if _exists(spark, seen) else spark.createDataFrame([], "path string")
    files = sorted(r.path for r in listed.join(state.landed_files(), "path", "left_anti").collect())
    for at in (landed, games_at):  # what an unfinished run left of this batch
        _delete(spark, f"{at}/{BATCH}={batch}")
    if files:
        land(read_activity(spark, files, file_format, schema), landed, games_at, batch, buckets)

    inc = windowed_incidents(incidents, start, end)
    write_parquet(inc, f"{base}/injuries_windowed")
    inc = spark.read.schema(inc.schema).parquet(f"{base}/injuries_windowed")
    players = state.put("players", inc.select("playerNameFormatted").where("playerNameFormatted IS NOT NULL").distinct())
    games = game_dates.select(F.col("GAMEID").cast("string").alias("gameId"), parse_date("gameDate", INCIDENT_DATE_FORMATS).alias("gameDate"))
    games = state.put("games", dedup_first(games.where("gameId IS NOT NULL"), ["gameId"]))
    state.put("files", spark.createDataFrame([(f,) for f in files], "path string"))
    rows = T.StructType([*schema.fields, *_PARTS.fields])
    final_schema = T.StructType([T.StructField("gameId", T.StringType()), *[f for f in schema.fields if f.name != "gameId"],
                                 T.StructField("playerNameFormatted", T.StringType()), T.StructField("gameDate", T.DateType()), *_PARTS.fields])
    if not _exists(spark, landed):  # nothing has ever been landed
        state.finish({"files": 0})
        return spark.createDataFrame([], final_schema).drop(BATCH, BUCKET)
    held = spark.read.schema(T.StructType([T.StructField("gameId", T.StringType()), *_PARTS.fields])).parquet(games_at)
    hot, parts = _touched(state, batch, players, games, held, buckets)
    activity = spark.read.schema(rows).parquet(landed).where(_where(batch, hot, parts))
    final = lookup(restrict_to(activity, "playerNameI", players, "playerNameFormatted"), games, "gameId").select(*final_schema.names)
    before = _partitions(spark, final_at)
    (final.hint("rebalance", BATCH, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(BATCH, BUCKET).parquet(final_at))
    after, touched = _partitions(spark, final_at), set(parts)
    for (b, k), names in before.items():  # touched partitions that were not written: no player is left in them
        if (b >= batch or k in hot or (b, k) in touched) and after.get((b, k)) == names:
            _delete(spark, f"{final_at}/{BATCH}={b}/{BUCKET}={k}")
    state.finish({"files": len(files), "buckets": hot, "partitions": len(parts)})
    return spark.read.schema(final_schema).parquet(final_at).drop(BATCH, BUCKET)
