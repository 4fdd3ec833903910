"""Writing tables so that a lost executor or a lost driver cannot lose rows.

A table is a folder of versions (``v=<id>``) and a numbered list of manifests naming the version of each
partition. A write adds a version and then one manifest; readers follow the newest manifest and never see
half a write. Files are deleted only by a job that holds the archive's lock, see :func:`sweep`.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffles_freed, workspace

log = logging.getLogger(__name__)


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []


def older(spark: SparkSession, path: str, seconds: float) -> list[str]:
    """Entries of a folder last changed at least so many seconds ago, by the storage's own clock and this one's."""
    fs, p = _fs(spark, path)
    until = (time.time() - seconds) * 1000
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getModificationTime() <= until) if fs.exists(p) else []


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file; False if it is there already. Of several that try, one succeeds."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as error:  # noqa: BLE001 - only "exists" is expected
        if fs.exists(p):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def content(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def stage(df: DataFrame, root: str, purpose: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a new folder below ``root`` and read it back; returns the rows and the folder.

    Computed once and safe from lost executors. Reading files also gives the planner the true
    size, so a later join broadcasts the rows only when they really are small.
    """
    path = f"{root}/_stage/{purpose}-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Rows written to a new scratch folder of the application and read back: computed once, of known size."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_raw(df: DataFrame, root: str, source: str, run_id: int, on: date, partition_by: str | None = None) -> bool:
    """Immutable raw copy under {source}/{yyyy}/{mm}/{dd}/{source}-run{id}.csv; with ``partition_by`` a folder for each
    value of that column inside, all in one write.

    Best effort as the rest of the run must not depend on it; an existing landing is never
    touched.
    """
    path = f"{root}/{source}/{on:%Y/%m/%d}/{source}-run{run_id}.csv"
    try:
        writer = df.write.mode("errorifexists").option("header", True).option("nullValue", "NA")
        (writer.partitionBy(partition_by) if partition_by else writer).csv(path)
        return True
    except Exception as error:  # noqa: BLE001 - reported, not raised
        log.warning("raw landing %s failed: %s", path, error)
        return False


def write_csv(df: DataFrame, path: str, single_file: bool = False, packed: bool = False) -> None:
    """CSV with a header; times as text, whole to the microsecond. ``single_file`` is for report-sized results, ``packed``
    (gzip, a file a task) for bulk ones."""
    df = df.select(*(F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName().startswith("timestamp") else F.col(f.name)
                     for f in df.schema.fields))
    writer = (df.coalesce(1) if single_file else df).write.mode("errorifexists").option("header", True)
    with shuffles_freed(df.sparkSession):
        (writer.option("compression", "gzip") if packed else writer).csv(path)


def export_tables(tables: dict[str, DataFrame], root: str) -> None:
    """Bulk export, packed; times as UTC text, one-element flag arrays as their element."""
    for name, df in tables.items():
        columns = []
        for field in df.schema.fields:
            c = F.col(field.name)
            kind = field.dataType.typeName()
            if kind.startswith("timestamp"):
                c = c.cast("string")
            elif kind == "array":
                c = F.array_join(c, ",")
            elif kind == "struct":
                continue
            columns.append(c.alias(field.name))
        write_csv(df.select(columns), f"{root}/{name}", packed=True)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the machines' own file system has it; None on other storage."""
    fs, p = _fs(spark, path)
    return p.toUri().getPath() if fs.getScheme() == "file" else None


def text_file_per_run(folder: str) -> Callable:
    """For ``mapInArrow`` over rows (names, line): each run of equal names, a JSON object, becomes one new text file in the
    folders ``name=value`` below ``folder``, called and escaped as ``partitionBy`` has them. A file gets its name when it is
    whole, and a task that is run again replaces the files of its first run. Returns how many files a task has written."""
    suffix = f"{uuid.uuid4().hex}.txt"

    def write(batches):
        import hashlib
        import json
        import os
        import re

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def place(names: str) -> str:
            levels = []
            for name, value in json.loads(names).items():
                value = "".join(f"%{ord(c):02X}" if re.match(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", c) else c for c in value or "")
                levels.append(f"{name}={value or '__HIVE_DEFAULT_PARTITION__'}")
            return os.path.join(folder, *levels)

        def finish() -> None:
            out.close()
            os.replace(out.name, os.path.join(os.path.dirname(out.name), file_name(now)))

        def file_name(names: str) -> str:
            return f"part-{hashlib.md5(names.encode()).hexdigest()}-{suffix}"

        now, out, n = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = pc.run_end_encode(batch.column("names"))
            ends = np.concatenate(([0], np.asarray(runs.run_ends))).astype(np.int32)
            lines = batch.column("line")
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), lines), "\n")
            for names, text in zip(runs.values.to_pylist(), texts.to_pylist()):
                if names != now:
                    if out:
                        finish()
                    target = place(names)
                    os.makedirs(target, exist_ok=True)
                    now, n = names, n + 1
                    out = open(os.path.join(target, f".{file_name(now)}.{os.getpid()}"), "w", encoding="utf-8", newline="")
                out.write(text + "\n")
        if out:
            finish()
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    return write


def partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders ``depth`` levels below a version, as paths like ``a=1/b=2``, found in one listing."""
    fs, _ = _fs(spark, folder)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(folder + "/*=*" * depth)
    return sorted("/".join(s.getPath().toString().split("/")[-depth:]) for s in fs.globStatus(pattern) or [])


WHOLE = ""  # the one partition of an unpartitioned table


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of the newest manifest (0: none) and the version of each partition."""
    found = children(spark, f"{path}/_manifest")
    if not found:
        return 0, {}
    return int(found[-1].rsplit("/", 1)[1]), json.loads(content(spark, found[-1]))


def read(spark: SparkSession, path: str, schema, parts: dict[str, str] | None = None) -> DataFrame | None:
    """The table as its newest manifest has it, or as ``parts`` says; None where it holds nothing. ``schema`` holds the
    partition column too.

    Whole versions are listed, and a filter on the folder columns, which prunes before any file is opened, leaves the
    partitions of each that the manifest names.
    """
    if parts is None:
        _, parts = manifest(spark, path)
    if not parts:
        return None
    live: dict[str, list[str]] = {}
    for part, version in sorted(parts.items()):
        live.setdefault(version, []).append(part)
    rows = (spark.read.schema(T.StructType([*schema.fields, T.StructField("v", T.StringType())])).option("basePath", path)
            .parquet(*(f"{path}/v={version}" for version in live)))
    if WHOLE not in parts:
        columns = [level.split("=")[0] for level in next(iter(parts)).split("/")]
        wanted = [f"{version}/{'/'.join(level.split('=')[1] for level in part.split('/'))}" for part, version in parts.items()]
        rows = rows.filter(F.concat_ws("/", "v", *(F.col(c).cast("string") for c in columns)).isin(wanted))
    return rows.select(schema.names)


def commit(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None,
           touched: str | None = None, emptied: list[str] = (), beside: Callable[[str], None] | None = None) -> int | None:
    """Replace the table at ``path``, or only its partitions that ``df`` holds and those in ``emptied``.

    The rows are written whole as a new version before the manifest names it. So ``df`` may read the table it
    replaces, running queries keep the files they began with, and a crash leaves the old state. A second
    writer that commits in between makes this one fail instead of losing the other's rows.

    The rebalancing shuffle gathers small partitions in one task and splits a hot one over many
    by its measured size; unlike range partitioning it does not compute the rows twice to sample
    them. Rows are sorted inside each file, for compression and row-group statistics.

    ``beside`` is called with the new version once its rows are written and before the manifest names it: what it stores
    under that version comes into effect with the rows.

    Returns the number of rows where the boolean column ``touched`` (not stored) is true.
    """
    spark = df.sparkSession
    number, parts = manifest(spark, path)
    df = df.hint("rebalance", *partition_by or [])
    layout = (partition_by or []) + (sort_by or [])
    if layout:
        df = df.sortWithinPartitions(*layout)
    seen = None
    if touched:
        # Observed after the last shuffle: only the writing tasks count.
        seen = Observation()
        df = df.observe(seen, F.count_if(F.col(touched)).alias("n")).drop(touched)
    version = uuid.uuid4().hex
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_freed(spark):
        writer.parquet(f"{path}/v={version}")
    new = dict.fromkeys(partitions(spark, f"{path}/v={version}", len(partition_by)) if partition_by else [WHOLE], version)
    kept = {k: v for k, v in parts.items() if k not in emptied}
    if beside:
        beside(version)
    if not create(spark, f"{path}/_manifest/{number + 1:012d}", json.dumps(kept | new)):
        delete(spark, f"{path}/v={version}")
        raise RuntimeError(f"another writer has changed {path}")
    return int(seen.get["n"]) if seen else None


def sweep(spark: SparkSession, path: str, manifests: int = 2, min_age_seconds: float = 0.0) -> None:
    """Delete what the last ``manifests`` states do not name, if it was written at least ``min_age_seconds`` ago: a
    write whose manifest is still to come is younger, and a reader that began under an earlier state has had that long
    to finish. The caller holds the archive's lock."""
    found = children(spark, f"{path}/_manifest")
    old = [m for m in older(spark, f"{path}/_manifest", min_age_seconds) if m in found[:-manifests]]
    states = [json.loads(content(spark, m)) for m in found if m not in old]
    live = {v for state in states for v in state.values()}
    for folder in older(spark, path, min_age_seconds):
        name = folder.rsplit("/", 1)[1]
        if name.startswith("v=") and name[2:] not in live:
            delete(spark, folder)
        elif name.startswith("v="):
            named = {part for state in states for part, version in state.items() if version == name[2:]}
            depth = next(iter(named)).count("/") + 1 if named != {WHOLE} else 0
            for part in partitions(spark, folder, depth) if depth else []:
                if part not in named:
                    delete(spark, f"{folder}/{part}")
    for m in old:
        delete(spark, m)


def sweep_beside(spark: SparkSession, path: str, beside: str, min_age_seconds: float = 0.0) -> None:
    """Delete what was stored ``beside`` versions of the table at ``path`` that are gone; to be called after :func:`sweep`."""
    present = {folder.rsplit("/", 1)[1] for folder in children(spark, path)}
    for folder in older(spark, beside, min_age_seconds):
        if folder.rsplit("/", 1)[1] not in present:
            delete(spark, folder)
