"""Facts and marts that follow the raw loads: each load changes only what it touches.

A store is a folder of tables, cut into buckets. A load writes a new version of each bucket it touches, under its batch
number, and then, in one commit, says which. The newest committed version of a bucket counts. A load whose
number is committed is skipped, so a replay changes nothing; one that broke off is overwritten.

Winners are the preferred row of each match: the one that the batch brings or the one stored, by the same total
order as in ``core``, so they do not depend on the order of loads. Buckets of winners are ranges of match ids, because
new matches have new ids: a load reads and writes the ranges it falls into.

Marts rest on sums over player and match rows: picks and wins of a hero and window, appearances of an account, and so on.
When the winner of a match changes, its old rows are subtracted and the new ones added. A key whose
count falls to zero is gone. So a minimum, or a number of different keys, comes from keys that are still there. Only the
buckets of changed keys are read and written.

One writer at a time. ``vacuum`` deletes versions that no longer count.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from arenalake.config import DEFAULTS, Settings
from arenalake.functions.numeric import flag
from arenalake.plans import core, marts, staging
from arenalake.sources.json_files import load_time, require_values
from arenalake.sources.schemas import ENVELOPE, MANIFEST_COLUMNS, RAW_TABLES

_LOG = "table string, bucket bigint, batch bigint"

#: Keys of each sum table, and what is summed; the first sum says whether a key is still there.
SUMS = {
    "hero": (("hero_id", "recency_window"), ("picks", "wins")),
    "account": (("account_id", "recency_window", "start_time"), ("rows",)),
    "own_account": (("account_id", "recency_window"), ("rows",)),
    "own_hero": (("hero_id", "recency_window"), ("rows",)),
    "match": (marts.MATCH_GROUP, ("matches", "seconds", "timed", "radiant")),
}

#: What the sums need of a match and of a player.
MATCH_ATTRIBUTES = ("recency_window", "start_time", "patch", "league_id", "duration_seconds", "radiant_win")
PLAYER_ATTRIBUTES = ("player_slot", "hero_id", "account_id", "win")

#: An id with more rows in a load is ranked before its rows go to their bucket.
CROWDED = 10_000


@dataclass(frozen=True)
class Store:
    """``span`` is the number of match ids in a bucket of winners, ``buckets`` that of a sum table."""

    spark: SparkSession
    root: str
    settings: Settings = DEFAULTS
    span: int = 1 << 16
    buckets: int = 64

    # Versions

    def _rows(self, path: str, schema: str, kind: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).format(kind).load(f"{self.root}/{path}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _log(self) -> DataFrame:
        return self._rows("log", f"{_LOG}, load bigint", "json")

    def is_committed(self, batch: int) -> bool:
        return not self._log().where(F.col("load") == batch).isEmpty()

    def _versions(self, table: str) -> DataFrame:
        """The version that counts of each bucket."""
        of_table = self._log().where(F.col("table") == table)
        return of_table.groupBy("bucket").agg(F.max("batch").alias("batch"))

    def rows(self, table: str, columns: str, touched: list[int] | None = None) -> DataFrame:
        """What counts of a table, or of some of its buckets."""
        stored = self._rows(table, f"{columns}, batch bigint, bucket bigint", "parquet")
        if touched is not None:
            stored = stored.where(F.col("bucket").isin(touched))  # other folders are not listed
        return stored.join(self._versions(table), ["batch", "bucket"]).drop("batch", "bucket")

    def _write(self, table: str, placed: DataFrame, batch: int) -> None:
        """Write rows that lie together by bucket."""
        placed.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{table}/batch={batch}")

    def _commit(self, touched: dict[str, list[int]], batch: int) -> None:
        """One small file; buckets that became empty are named as well."""
        entries = [(t, b, batch) for t, buckets in touched.items() for b in buckets] or [("", -1, batch)]
        rows = self.spark.createDataFrame(entries, _LOG).coalesce(1)
        rows.write.mode("overwrite").json(f"{self.root}/log/load={batch}")

    # Loads

    def apply(self, raw_matches: DataFrame, batch: int) -> bool:
        """Take a load; false if it was taken before."""
        if self.is_committed(batch):
            return False
        staged = staging.stg_matches(raw_matches)
        typed = core.typed_payloads(raw_matches)
        touched = {}
        in_load = [rows.select(self._span()) for rows in (staged, typed)]
        spans = [r[0] for r in in_load[0].union(in_load[1]).distinct().collect()]  # ranges of ids in the load
        known_matches = self.matches(spans)
        known_payloads = self.payloads(spans)
        self._write("matches", self._chosen(known_matches, staged, core.fct_match), batch)
        self._write("payloads", self._chosen(known_payloads, typed, core.preferred_payloads), batch)
        touched["matches"] = touched["payloads"] = spans
        new_matches = self._version("matches", known_matches, batch)
        new_payloads = self._version("payloads", known_payloads, batch)
        changed = self._changed((known_matches, known_payloads), (new_matches, new_payloads), batch)
        for table, delta in self._changes(changed).items():
            touched[table] = self._add(table, delta, batch)
        self._commit(touched, batch)
        return True

    def _span(self) -> Column:
        return F.floor(F.col("match_id") / self.span)

    def _chosen(self, known: DataFrame, load: DataFrame, choose: Callable[..., DataFrame]) -> DataFrame:
        """The winners among stored rows and a load, ranked where their bucket is written: one shuffle.

        Ids with very many rows in the load are ranked before that, so that no bucket has them all.
        """
        counts = load.groupBy("match_id").agg(F.count("*").alias("n"))
        crowded = F.broadcast(counts.where(F.col("n") > CROWDED).select(F.col("match_id").alias("crowded")))
        same = F.col("match_id") == F.col("crowded")
        first = choose(load.join(crowded, same, "left_semi"), self.settings)
        rows = known.unionByName(load.join(crowded, same, "left_anti")).unionByName(first)
        placed = rows.withColumn("bucket", self._span()).repartition("bucket")
        return choose(placed, self.settings, ("bucket", "match_id"))

    def _version(self, table: str, like: DataFrame, batch: int) -> DataFrame:
        path = f"{self.root}/{table}/batch={batch}"
        return self.spark.read.schema(like.schema).parquet(path)

    def _changed(
        self, known: tuple[DataFrame, DataFrame], new: tuple[DataFrame, DataFrame], batch: int
    ) -> DataFrame:
        """Matches with their players as they were (-1) and are (1), where a load made a difference.

        Stored once, as all sums read them, and with the attributes that sums need only.
        """
        def attributes(matches: DataFrame, payloads: DataFrame, name: str) -> DataFrame:
            own = marts.in_target_windows(matches, self.settings)
            narrow = F.transform("players", lambda p: F.struct(*(p[f].alias(f) for f in PLAYER_ATTRIBUTES)))
            of_match = F.struct(F.col("recency_window").alias("own_window"), narrow.alias("players"))
            with_players = own.select("match_id", F.struct(*MATCH_ATTRIBUTES).alias("match")).join(
                payloads.select("match_id", of_match.alias("payload")).hint("merge"), "match_id", "left"
            )
            return with_players.select("match_id", F.struct("match", "payload").alias(name))

        both = attributes(*known, "was").join(attributes(*new, "now").hint("merge"), "match_id", "full")
        sides = F.array(*(F.struct(F.lit(k).alias("sign"), F.col(c).alias("row")) for k, c in ((-1, "was"), (1, "now"))))
        rows = both.where(~F.col("was").eqNullSafe(F.col("now"))).select("match_id", F.explode(sides).alias("side"))
        rows = rows.where("side.row IS NOT NULL").select("match_id", "side.sign", "side.row.*")
        path = f"{self.root}/changed/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _changes(self, changed: DataFrame) -> dict[str, DataFrame]:
        """For each sum table, what to add to its keys."""
        deltas: dict[str, list[DataFrame]] = {name: [] for name in SUMS}
        for sign in (-1, 1):
            side = changed.where(F.col("sign") == sign)
            own = side.select("match_id", "match.*")
            joined = side.where("payload IS NOT NULL").select(
                "match.recency_window", "match.start_time", "payload.own_window", "payload.players"
            )
            carried = ("recency_window", "start_time", "own_window")
            rows = core.explode_players(joined, carried, PLAYER_ATTRIBUTES)
            in_own = F.col("own_window").isin(list(self.settings.labels))
            one = F.lit(sign).cast("bigint")
            known = rows.where("account_id IS NOT NULL")
            deltas["hero"].append(rows.select(*SUMS["hero"][0], one.alias("picks"), (one * flag(F.col("win") == 1)).alias("wins")))
            deltas["account"].append(known.select(*SUMS["account"][0], one.alias("rows")))
            deltas["own_account"].append(known.where(in_own).select(*SUMS["own_account"][0], one.alias("rows")))
            deltas["own_hero"].append(rows.where(in_own).select(*SUMS["own_hero"][0], one.alias("rows")))
            groups = marts.match_groups(own)
            deltas["match"].append(
                groups.select(*marts.MATCH_GROUP, *((one * F.coalesce(c, F.lit(0))).alias(c) for c in SUMS["match"][1]))
            )
        return {name: self._summed(name, old.unionByName(new)) for name, (old, new) in deltas.items()}

    def _summed(self, table: str, rows: DataFrame, *place: str) -> DataFrame:
        keys, sums = SUMS[table]
        return rows.groupBy(*place, *keys).agg(*(F.sum(c).cast("bigint").alias(c) for c in sums))

    def _add(self, table: str, delta: DataFrame, batch: int) -> list[int]:
        """Add to the stored sums, and return the buckets that changed."""
        keys, sums = SUMS[table]
        path = f"{self.root}/delta_{table}/batch={batch}"
        changed = delta.where(" OR ".join(f"{c} <> 0" for c in sums))
        changed.write.mode("overwrite").parquet(path)
        delta = self.spark.read.schema(delta.schema).parquet(path)
        bucket = F.pmod(F.xxhash64(keys[0]), F.lit(self.buckets))
        touched = [r[0] for r in delta.select(bucket).distinct().collect()]  # at most ``buckets``
        known = self.rows(table, self._columns(table), touched)
        placed = known.unionByName(delta).withColumn("bucket", bucket).repartition("bucket")
        self._write(table, self._summed(table, placed, "bucket").where(F.col(sums[0]) > 0), batch)
        return touched

    @staticmethod
    def _columns(table: str) -> str:
        keys, sums = SUMS[table]
        kinds = [f"{k} {'string' if k == 'recency_window' else 'bigint'}" for k in keys]
        return ", ".join([*kinds, *(f"{c} bigint" for c in sums)])

    # Results

    def sums(self, table: str) -> DataFrame:
        return self.rows(table, self._columns(table))

    def matches(self, touched: list[int] | None = None) -> DataFrame:
        """The match fact."""
        return self._winners("matches", staging.stg_matches(_no_raw(self.spark)), touched)

    def payloads(self, touched: list[int] | None = None) -> DataFrame:
        return self._winners("payloads", core.typed_payloads(_no_raw(self.spark)), touched)

    def _winners(self, table: str, like: DataFrame, touched: list[int] | None) -> DataFrame:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in like.schema)
        return self.rows(table, columns, touched).select(*like.columns)

    def players(self) -> DataFrame:
        """The player fact."""
        return core.player_fact(self.payloads(), settings=self.settings)

    def hero_meta_shift(self, dim_heroes: DataFrame) -> DataFrame:
        counted = []
        for label in self.settings.labels:
            here = F.col("recency_window") == label
            counted += [F.sum(F.when(here, F.col(c)).otherwise(0)).alias(f"{c} {label}") for c in ("picks", "wins")]
        counts = self.sums("hero").groupBy("hero_id").agg(*counted)
        return marts.meta_shift_of(counts, dim_heroes, self.settings)

    def liveops_summary(self) -> DataFrame:
        heroes = self.sums("own_hero").groupBy("recency_window").agg(
            F.sum("rows").alias("player_row_count"), F.count("*").alias("distinct_hero_count")
        )
        accounts = self.sums("own_account").groupBy("recency_window").agg(F.count("*").alias("known_account_count"))
        players = heroes.join(F.broadcast(accounts), "recency_window", "left").na.fill(0, ["known_account_count"])
        return marts.summary_of(players, marts.match_metrics_of(self.sums("match")))

    def returning_players(self) -> DataFrame:
        seen = [
            F.max(flag(F.col("recency_window") == label)).alias(f"seen {label}") for label in self.settings.labels
        ]
        accounts = self.sums("account").groupBy("account_id").agg(F.min("start_time").alias("first_seen"), *seen)
        return marts.returning_of(marts.status_of(accounts, self.settings))

    def vacuum(self) -> int:
        """Delete versions that do not count, and how many there were."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        entries = self._log().where("bucket >= 0 OR table IN ('matches', 'payloads')")
        latest = entries.groupBy("table", "bucket").agg(F.max("batch").alias("last"))
        gone = 0
        for r in entries.join(latest, ["table", "bucket"]).where("batch < last").toLocalIterator():
            path = hadoop.Path(f"{self.root}/{r['table']}/batch={r['batch']}/bucket={r['bucket']}")
            gone += bool(path.getFileSystem(conf).delete(path, True))
        return gone


def _no_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_TABLES["raw_matches"])


def stream_core(
    store: Store, landing: str, checkpoint: str, *, loaded_at: str | None = None, max_files_per_batch: int = 1000
) -> StreamingQuery:
    """Take all envelope files that no earlier run has taken into the store, then stop."""
    envelopes = (
        store.spark.readStream.schema(ENVELOPE)
        .option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .json(landing)
    )

    def take(batch: DataFrame, batch_id: int) -> None:
        rows = require_values(batch, (*MANIFEST_COLUMNS, "payload")).select(
            *MANIFEST_COLUMNS, F.col("payload").alias("raw_payload"), load_time(loaded_at).alias("loaded_at")
        )
        store.apply(rows, batch_id)

    return (
        envelopes.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
