"""Input that cannot be used, kept for repair, and its way back.

Every input row is tagged once with the reason it cannot be used (NULL: it can). The tagged rows are written once, good and
bad in folders of their own, and both sides are read from there. Bad rows go to the archive's quarantine table with their
text as it came and the pull they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..sources import files

# Kinds of bodies and how they are read again.
PAGE, READING, LINE = "page", "reading", "export line"
KEY = ["pulled_from", "kind", "body", "nth"]
_READING = "STATION_NUMBER string, DATETIME string, LEVEL double, DISCHARGE double, LEVEL_SYM string, DISCHARGE_SYM string"


def tag_pages(pages: DataFrame, quarantine_column: str = "_corrupt") -> DataFrame:
    """Pages with ``reason`` and ``body``; a page that is JSON but holds no list of features is as bad as a broken one."""
    return pages.withColumns({
        "reason": F.when(F.col("features").isNull(), F.when(F.col(quarantine_column).isNotNull(), "unreadable page").otherwise("no features")),
        "body": F.when(F.col("features").isNull(), F.coalesce(quarantine_column, F.lit("")))})


def tag_readings(pull: DataFrame) -> DataFrame:
    """Wide readings with ``reason`` and ``body`` (the reading as JSON)."""
    reason = (F.when(F.col("STATION_NUMBER").isNull(), "no station")
              .when(C.parse_wsc_time(F.col("DATETIME")).isNull(), "unreadable time"))
    fields = ["STATION_NUMBER", "DATETIME", "LEVEL", "DISCHARGE", "LEVEL_SYM", "DISCHARGE_SYM"]
    return pull.withColumn("reason", reason).withColumn("body", F.when(F.col("reason").isNotNull(), F.to_json(F.struct(*fields))))


def tag_pull(pages: DataFrame, quarantine_column: str = "_corrupt") -> DataFrame:
    """Pages as :func:`tag_pages` and their readings as :func:`tag_readings` tell them apart, in one pass: ``kind`` says which
    of both a row is, and a bad page is a row without a reading."""
    page = F.col("page_reason").isNotNull()
    tagged = tag_pages(pages, quarantine_column).withColumnsRenamed({"reason": "page_reason", "body": "page_body"})
    order = [c for c in files.CARRIED if c in pages.columns]
    # Of a page without features nothing is left, as explode() has it; explode_outer() keeps the pages whose list is null.
    rows = tagged.filter(page | (F.size("features") > 0)).select(*order, "page_reason", "page_body", F.explode_outer("features").alias("feature"))
    rows = tag_readings(rows.select("page_reason", "page_body", *order, *files.feature_fields()))
    return rows.withColumns({
        "kind": F.when(page, PAGE).otherwise(READING), "reason": F.when(page, F.col("page_reason")).otherwise(F.col("reason")),
        "body": F.when(page, F.col("page_body")).otherwise(F.col("body"))}).drop("page_reason", "page_body")


def tag_lines(lines: DataFrame) -> DataFrame:
    """Export lines (with ``complete``) with ``reason`` and ``body``. A line without a value is no loss and stays good."""
    fields = F.from_csv("line", "ts string", {"nullValue": "NA", "mode": "PERMISSIVE"})
    # The pattern of a time holds no comma: in a line without quotes it is found, or not, before the first one.
    time = F.when(files.plain_line(F.col("line")), C.parse_export_time(F.col("line"))).otherwise(C.parse_export_time(fields["ts"]))
    reason = F.when(~F.col("complete"), "short file").when(time.isNull(), "unreadable time")
    return lines.withColumn("reason", reason).withColumn("body", F.when(F.col("reason").isNotNull(), F.col("line")))


def split(tagged: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad rows of a tagged table, computed once: one write with a folder for each side."""
    side = F.when(F.col("reason").isNull(), "good").otherwise("bad")
    tagged.withColumn("side", side).write.mode("errorifexists").partitionBy("side").parquet(path)
    back = tagged.sparkSession.read.schema(tagged.withColumn("side", side).schema).parquet(path)
    return back.filter("side = 'good'").drop("side", "reason", "body"), back.filter("side = 'bad'").drop("side")


def quarantined(bad: DataFrame, kind: str, run_id: int, as_of) -> DataFrame:
    """Bad rows as rows of the quarantine table. Equal rows of one pull are told apart by ``nth``."""
    same = Window.partitionBy("pulled_from", "body").orderBy("reason")
    dataset = F.col("dataset") if "dataset" in bad.columns else F.lit(None)
    return S.conform(bad.select(
        F.lit(run_id).alias("run_id"), "pulled_at", "pulled_from", F.lit(kind).alias("kind"), "reason", "body",
        (F.row_number().over(same) - 1).alias("nth"), dataset.alias("dataset"), F.lit("open").alias("status"),
        C.instant(as_of).alias("changed_ts")), S.QUARANTINE)


def still_open(quarantine: DataFrame) -> DataFrame:
    """Rows never replayed, one of each, as first seen."""
    closed = quarantine.filter("status = 'replayed'").select(*KEY).distinct()
    first = Window.partitionBy(*KEY).orderBy("changed_ts", "run_id")
    rows = quarantine.filter("status = 'open'").withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")
    return rows.join(closed, KEY, "left_anti").select(quarantine.columns)


def unknown(rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows the table does not hold yet: a landing that keeps its broken files brings them again with every run."""
    return rows.join(quarantine.select(*KEY).distinct(), KEY, "left_anti").select(rows.columns)


def repaired(open_rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """Open rows with ``fixed``, their repaired text. ``repairs`` has ``pulled_from``, ``body`` and ``fixed``; one text
    mended in one way everywhere leaves ``pulled_from`` NULL. A repair for the row's own pull goes before such a one."""
    own = repairs.filter("pulled_from IS NOT NULL").groupBy("pulled_from", "body").agg(F.max("fixed").alias("own"))
    everywhere = repairs.filter("pulled_from IS NULL").groupBy("body").agg(F.max("fixed").alias("everywhere"))
    return (open_rows.join(own, ["pulled_from", "body"], "left").join(everywhere, "body", "left")
            .withColumn("fixed", F.coalesce("own", "everywhere")).filter("fixed IS NOT NULL").drop("own", "everywhere"))


def pages_of(fixed: DataFrame) -> DataFrame:
    """Repaired pages as :func:`files.geojson_pages` gives them, with what else is known of their rows."""
    page = F.from_json("fixed", S.GEOJSON_PAGE, {"mode": "PERMISSIVE"})
    return fixed.filter(F.col("kind") == PAGE).select("*", page["features"].alias("features"))


def readings_of(fixed: DataFrame) -> DataFrame:
    """Repaired wide readings."""
    rows = fixed.filter(F.col("kind") == READING).withColumn("r", F.from_json("fixed", _READING))
    return rows.select(*fixed.columns, "r.*")


def not_older(rows: DataFrame, archived: DataFrame) -> DataFrame:
    """Rows whose reading the archive lacks, or has not taken again since the row was first seen (``seen_ts``): a replay
    never undoes a later pull."""
    held = archived.select(*S.OBSERVATION_KEY, F.col("ingest_ts").alias("_held"))
    return rows.join(held, S.OBSERVATION_KEY, "left").filter(F.col("_held").isNull() | (F.col("_held") <= F.col("seen_ts"))).drop("_held")
