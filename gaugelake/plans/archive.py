"""The archive's tables on shared storage."""

from __future__ import annotations

import json
import time
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import columns as C
from ..operators import gate, merge, quarantine, rollup
from ..sinks import tables as sink

SCHEMAS = {
    "station": S.STATION, "series": S.SERIES, "observation": S.OBSERVATION, "pull_run": S.PULL_RUN,
    "audit_log": S.AUDIT_LOG, "audit_discrepancy": S.AUDIT_DISCREPANCY, "quarantine": S.QUARANTINE,
}
LARGE_BATCH = 1_000_000  # rows of a batch that no planner would broadcast
VERSIONED = ("station", "series", "observation")


class Archive:
    """Station, series, observation and ledger tables under one root.

    Observations lie in folders by span (daily or instant), month and bucket of series, sorted by series and time
    inside. An upsert rewrites only the buckets its batch touches, a new daily history leaves instant readings alone, and
    time filters skip whole months. Each write also stores its folders' readings counted per series (``partial``), which
    come into effect with the rows and from which reports take their counts and spans. ``buckets`` counts for a new archive and is stored with it: take one so that a bucket of
    a month holds some hundred MB. Opening an archive changes nothing; jobs that write hold its lock.
    """

    PARTITION = ["span", "ym", "bucket"]
    SORT = ["series_uid", "datetime_utc"]

    def __init__(self, spark: SparkSession, root: str, leftover_seconds: float = 86_400.0, buckets: int = 4):
        self.spark, self.root, self.leftover_seconds = spark, root.rstrip("/"), leftover_seconds
        self._wanted_buckets, self._buckets = buckets, None
        self._scratch: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @contextmanager
    def lock(self, owner: str, wait_seconds: float = 0.0):
        """Hold the archive for one writer. A second one waits for up to ``wait_seconds`` and is then refused.

        Leftovers of crashed runs are cleared here, but only those older than ``leftover_seconds``: a writer that came
        without the lock, or whose lock was broken by hand, keeps what it has just written. A lock whose owner has died
        is removed by hand (:meth:`unlock`).

        The lock and the manifests are files made only where none is: the storage below ``root`` must refuse to create
        a file that exists (HDFS and local disks do; an object store needs conditional writes).
        """
        path, until = self.path("_lock"), time.monotonic() + wait_seconds
        while not sink.create(self.spark, path, f"{owner} since {datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S} UTC"):
            if time.monotonic() >= until:
                raise RuntimeError(f"{self.root} is in use: {sink.content(self.spark, path)}")
            time.sleep(0.2)
        try:
            for folder in sink.older(self.spark, self.path("_stage"), self.leftover_seconds):
                sink.delete(self.spark, folder)
            for name in VERSIONED:
                sink.sweep(self.spark, self.path(name), min_age_seconds=self.leftover_seconds)
            sink.sweep_beside(self.spark, self.path("observation"), self.path("partial"), self.leftover_seconds)
            yield
        finally:
            self.clear_scratch()
            self.unlock()

    def unlock(self) -> None:
        sink.delete(self.spark, self.path("_lock"))

    def buckets(self) -> int:
        """Buckets a month, as stored by the first write; the first of several writers decides."""
        if self._buckets is None:
            path = self.path("_layout")
            if not sink.exists(self.spark, path):
                sink.create(self.spark, path, json.dumps({"buckets": self._wanted_buckets}))
            self._buckets = json.loads(sink.content(self.spark, path))["buckets"]
        return self._buckets

    def read(self, name: str) -> DataFrame:
        """A table as last committed; observations come with their month ``ym``, on which filters skip folders."""
        if name == "observation":
            return self._placed().select(*S.OBSERVATION.names, "ym")
        schema = SCHEMAS[name]
        if name in VERSIONED:
            found = sink.read(self.spark, self.path(name), schema)
        else:
            found = self.spark.read.schema(schema).parquet(self.path(name)) if sink.exists(self.spark, self.path(name)) else None
        if found is None:
            return self.spark.createDataFrame([], schema)
        return self._closed(found) if name == "pull_run" else found

    @staticmethod
    def _closed(ledger: DataFrame) -> DataFrame:
        """One row per run: the row written at its end, or the one from its start while it runs."""
        newest = Window.partitionBy("run_id").orderBy(F.col("finished_ts").desc_nulls_last())
        return ledger.withColumn("_row", F.row_number().over(newest)).filter("_row = 1").drop("_row")

    def tables(self) -> dict[str, DataFrame]:
        """All tables, and the ``partial`` counts of just the state that ``observation`` shows."""
        _, parts = sink.manifest(self.spark, self.path("observation"))
        return {name: self.read(name) for name in SCHEMAS if name != "observation"} | {
            "observation": self._placed(parts).select(*S.OBSERVATION.names, "ym"), "partial": self.partials(parts)}

    def partials(self, parts: dict[str, str] | None = None) -> DataFrame:
        """Readings counted per series, source, approval level and folder, as stored by each write. Versions written
        without them (by an older release, or a folder put in by hand) are counted from their readings."""
        if parts is None:
            _, parts = sink.manifest(self.spark, self.path("observation"))
        stored = {folder.rsplit("/v=", 1)[1] for folder in sink.children(self.spark, self.path("partial"))}
        kept = sink.read(self.spark, self.path("partial"), S.PARTIAL, {k: v for k, v in parts.items() if v in stored})
        rest = {k: v for k, v in parts.items() if v not in stored}
        counted = rollup.partials(self._placed(rest), self.PARTITION) if rest or kept is None else None
        return counted if kept is None else kept if counted is None else kept.unionByName(counted)

    def _store_partials(self, version: str) -> None:
        """Count what a version holds, from its files: few columns, and aggregates that combine before the shuffle."""
        rows = (self.spark.read.schema(self._placed_schema()).parquet(f"{self.path('observation')}/v={version}"))
        rollup.partials(rows, self.PARTITION).write.mode("errorifexists").parquet(f"{self.path('partial')}/v={version}")

    def stage(self, df: DataFrame, purpose: str) -> DataFrame:
        """Rows written aside once, to be read several times in one run."""
        staged, path = sink.stage(df, self.root, purpose)
        self._scratch.append(path)
        return staged

    def stage_split(self, tagged: DataFrame, purpose: str, kind: str | tuple[str, ...], run_id: int, as_of) -> DataFrame:
        """The good rows of a tagged table, staged; the bad ones are appended to the quarantine. Of several kinds, each row
        says its own in the column ``kind``."""
        path = self.path(f"_stage/{purpose}-{uuid.uuid4().hex}")
        self._scratch.append(path)
        good, bad = quarantine.split(tagged, path)
        if not bad.isEmpty():
            for one in (kind,) if isinstance(kind, str) else kind:
                own = bad if isinstance(kind, str) else bad.filter(F.col("kind") == one)
                self.append("quarantine", quarantine.unknown(quarantine.quarantined(own, one, run_id, as_of), self.read("quarantine")))
        return good if isinstance(kind, str) else good.drop("kind")

    def gated(self, batch: DataFrame, table: str, source: str, run_id: int, as_of, committed: dict[str, DataFrame] | None = None) -> DataFrame:
        """Rows of a batch that keep the table's rules, staged; the others are appended to the quarantine with the rule they
        break. To be used before a merge of rows that come from outside, as :meth:`insert_checked` does. The batch is staged
        first, since every rule that looks beyond a row reads it again."""
        batch = self.stage(batch, f"batch-{table}")
        rows = gate.with_body(gate.tagged(batch, table, self.tables() | (committed or {})), table, source)
        return self.stage_split(rows, f"gate-{table}", f"{table} row", run_id, as_of).select(batch.columns)

    def insert_checked(self, batch: DataFrame, source: str, run_id: int, as_of) -> None:
        """:meth:`insert_observations` behind the gate."""
        self.insert_observations(self.gated(S.conform(batch, S.OBSERVATION), "observation", source, run_id, as_of))

    def clear_scratch(self) -> None:
        """Drop what :meth:`stage` wrote, at the end of a run."""
        while self._scratch:
            sink.delete(self.spark, self._scratch.pop())

    # --- dimensions -----------------------------------------------------

    def write_dimension(self, name: str, df: DataFrame) -> None:
        sink.commit(S.conform(df, SCHEMAS[name]), self.path(name), sort_by=S.PRIMARY_KEYS[name])

    def add_series(self, found: DataFrame) -> None:
        """Insert series not yet known."""
        self.write_dimension("series", merge.insert_ignore(
            self.read("series"), S.conform(found, S.SERIES), ["series_uid"]))

    def upsert_stations(self, incoming: DataFrame, wells: bool = False) -> None:
        self.write_dimension("station", merge.upsert_station(self.read("station"), incoming, wells))

    # --- observations ---------------------------------------------------

    @staticmethod
    def _placed_schema() -> T.StructType:
        return T.StructType([*S.OBSERVATION.fields, T.StructField("span", T.StringType()),
                             T.StructField("ym", T.IntegerType()), T.StructField("bucket", T.IntegerType())])

    def _placed(self, parts: dict[str, str] | None = None) -> DataFrame:
        """Observations with their folder columns, of the newest state or the folder versions given."""
        schema = self._placed_schema()
        found = sink.read(self.spark, self.path("observation"), schema, parts)
        # With the filter the planner knows that there is nothing to merge with: a first load meets no join.
        return self.spark.createDataFrame([], schema).filter(F.lit(False)) if found is None else found

    def place(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({
            "span": C.span_of(F.col("series_uid")), "ym": C.year_month(F.col("datetime_utc")),
            "bucket": F.pmod(F.xxhash64("series_uid"), F.lit(self.buckets())).cast("int")})

    def folders_of(self, placed: DataFrame) -> list[str]:
        """Folders that placed rows lie in: at most spans times months of the calendar times buckets."""
        return self._named(placed.select(self.PARTITION).distinct().collect())

    def _named(self, places: list) -> list[str]:
        return sorted("/".join(f"{c}={r[c]}" for c in self.PARTITION) for r in places)

    def _in_folders(self, folders: list[str]) -> DataFrame:
        """What the archive holds in these folders; other folders are not opened."""
        place = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in self.PARTITION))
        return self._placed().filter(place.isin(folders)).select(S.OBSERVATION.names)

    def write_observations(self, rows: DataFrame, touched: str | None = None, emptied: list[str] = ()) -> int | None:
        return sink.commit(self.place(rows), self.path("observation"), self.PARTITION, self.SORT, touched, emptied,
                           beside=self._store_partials)

    def upsert_observations(self, incoming: DataFrame, update: list[str],
                            order_by: list[str] | None = None, on_dup: str = "last") -> int:
        """Merge a batch into the folders it touches; returns rows inserted plus updated.

        ``incoming`` is read twice (folders, merge); pass staged rows.
        """
        places = self.place(incoming).groupBy(self.PARTITION).agg(F.count(F.lit(1)).alias("n")).collect()  # as folders_of
        if not places:
            return 0
        merged = merge.upsert(self._in_folders(self._named(places)), incoming, S.OBSERVATION_KEY, update, order_by, on_dup,
                              touched="touched", large=sum(r["n"] for r in places) >= LARGE_BATCH)
        return self.write_observations(merged, "touched")

    def insert_observations(self, incoming: DataFrame) -> None:
        """Bulk load that leaves present readings alone."""
        folders = self.folders_of(self.place(incoming))
        if folders:
            self.write_observations(merge.insert_ignore(self._in_folders(folders), incoming, S.OBSERVATION_KEY))

    def replace_observations(self, predicate: Column, new: DataFrame, span: str | None = None) -> int:
        """Full refresh of a slice: only folders that hold old or new rows of it are rewritten. ``span`` says that the
        slice lies in one span, whose folders alone are looked at. Returns the number of new rows."""
        placed = self._placed()
        old = placed.filter(predicate & (F.col("span") == span) if span else predicate)
        folders = sorted({*self.folders_of(old), *self.folders_of(self.place(new))})
        if not folders:
            return 0
        kept = self._in_folders(folders).withColumn("touched", F.lit(False))
        rows = merge.replace_slice(kept, predicate, S.conform(new, S.OBSERVATION).withColumn("touched", F.lit(True)))
        return self.write_observations(rows, "touched", emptied=folders)

    # --- ledgers --------------------------------------------------------

    def append(self, name: str, df: DataFrame) -> None:
        S.conform(df, SCHEMAS[name]).write.mode("append").parquet(self.path(name))

    def append_row(self, name: str, row: dict) -> None:
        schema = SCHEMAS[name]
        df = self.spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields)], schema)
        self.append(name, df.coalesce(1))
