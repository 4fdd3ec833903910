"""Readers for the landed upstream shapes. Every reader has a fixed schema."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C

_METADATA_LINES = 5
# Files up to this size are read as one row each: opening one costs more than its text.
_WHOLE_BYTES = 4 << 20
# What the text source unpacks by the file's ending.
_PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd|xz|lzo|passthrough)$"
_LINE_END = r"\r\n|\r|\n"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Columns that say which pull a row is from: the later pull wins, the file's name breaks ties.
PULL_ORDER = ["pulled_at", "pulled_from"]
# What rows bring along through parsing where they have it; repaired rows also know when they were first seen.
CARRIED = [*PULL_ORDER, "seen_ts"]


def pull_time(path: Column, modified: Column) -> Column:
    """When a landed file was pulled: the time in its path (a folder ``pull=<ISO time or date>``, or folders yyyy/mm/dd),
    so that copying or landing an old pull again does not make it new; without one the file's own time."""
    named = F.url_decode(F.regexp_extract(path, r"/pull=(\d{4}-\d\d-\d\d[^/]*)/", 1)).try_cast("timestamp_ntz")
    dated = F.regexp_replace(F.regexp_extract(path, r"/(\d{4}/\d\d/\d\d)/", 1), "/", "-").try_cast("timestamp_ntz")
    return F.coalesce(named, dated, modified.cast("timestamp_ntz"))


def _pull_order() -> list[Column]:
    path = F.col("_metadata.file_path")
    return [pull_time(path, F.col("_metadata.file_modification_time")).alias("pulled_at"), path.alias("pulled_from")]


def geojson_pages(spark: SparkSession, path: str, multiline: bool = True,
                  quarantine_column: str = "_corrupt") -> DataFrame:
    """Feature pages as read: one row per page, unreadable pages kept as text.

    A page holds at most the upstream page size of features, so one page per file
    (``multiline``) and one page per line are both bounded rows.
    """
    schema = S.T.StructType([*S.GEOJSON_PAGE.fields, S.T.StructField(quarantine_column, S.T.StringType())])
    return (spark.read.schema(schema).option("multiLine", multiline)
            .option("columnNameOfCorruptRecord", quarantine_column).json(path).select("*", *_pull_order()))


def wide_pull(pages: DataFrame) -> DataFrame:
    """Pages to one row per feature; a property that is null or absent is NULL."""
    order = [c for c in CARRIED if c in pages.columns]
    return pages.select(F.explode("features").alias("feature"), *order).select(*order, *feature_fields())


def feature_fields() -> list[Column]:
    """The wide columns of a ``feature``."""
    p = "feature.properties."
    return [F.col(p + "STATION_NUMBER").alias("STATION_NUMBER"), F.col(p + "DATETIME").alias("DATETIME"),
            F.col(p + "LEVEL").alias("LEVEL"), F.col(p + "DISCHARGE").alias("DISCHARGE"),
            F.col(p + "LEVEL_SYMBOL_EN").alias("LEVEL_SYM"), F.col(p + "DISCHARGE_SYMBOL_EN").alias("DISCHARGE_SYM")]


def unreadable_pages(pages: DataFrame, quarantine_column: str = "_corrupt") -> DataFrame:
    """Pages that are no valid JSON, as text, for counting and later repair."""
    bad = F.col(quarantine_column).isNotNull() & F.col("features").isNull()
    return pages.filter(bad).select(F.col("pulled_from").alias("path"), quarantine_column)


def since(df: DataFrame, ts: str, as_of, days: int | None, strict: bool = False) -> DataFrame:
    """Rows of the last ``days`` days (None keeps all). An archive's month folders are pruned too."""
    if days is None:
        return df
    start = C.days_before(as_of, days)
    out = df.filter(F.col(ts) > start if strict else F.col(ts) >= start)
    if "ym" in df.columns:
        out = out.filter(F.col("ym") >= C.year_month(start))
    return out


@contextmanager
def _listed_by_few_tasks(spark: SparkSession):
    """Of a landing of many folders each task lists many; by default up to 10,000 tasks list a folder or two each."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), 8 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def _export_heads(lines: DataFrame) -> DataFrame:
    """Number of the first line of each file, and whether its header has four columns or more: one row a file.

    Lines are numbered as they are read, so those of a file's first split are consecutive. The rank keeps six lines a
    file in each task before anything moves; the planner sees that only where the rank itself is limited.
    """
    place = Window.partitionBy("pulled_from").orderBy("line_id")
    first = (lines.filter("block_start = 0").withColumn("line_no", F.row_number().over(place))
             .filter(F.col("line_no") <= _METADATA_LINES + 1))
    header = (F.col("line_no") == _METADATA_LINES + 1) & (_column_count(F.col("line")) >= 4)
    return first.groupBy("pulled_from").agg(F.min("line_id").alias("first_id"), F.max(header).alias("complete"))


def _lines_of_split_files(spark: SparkSession, path: str, wanted: Column, dataset: Column) -> DataFrame:
    """Body lines of files of any size. Files are split like any text, so a dataset is read by many tasks. The text is read
    twice, for the files' heads and for the body; heads are one row a file and the planner broadcasts them once it knows
    their size."""
    with _listed_by_few_tasks(spark):
        text = spark.read.option("recursiveFileLookup", True).text(path)
    lines = (text.filter(wanted).select(F.col("value").alias("line"), *_pull_order(), F.col("_metadata.file_block_start").alias("block_start"))
             .withColumn("line_id", F.monotonically_increasing_id()))
    body = (F.col("block_start") > 0) | (F.col("line_id") > F.col("first_id") + _METADATA_LINES) | ~F.col("complete")
    return lines.join(_export_heads(lines), "pulled_from").filter(body).select(dataset, *PULL_ORDER, "line", "complete")


def _lines_of_whole_files(whole: DataFrame, dataset: Column) -> DataFrame:
    """Body lines of files that are a row each: one read, and no line has to meet its file's head. What is told from the path
    is told once a file."""
    kept = ["dataset", *PULL_ORDER]
    text = F.col("text")
    cut = (whole.select(*_pull_order(), F.regexp_replace(F.col("content").cast("string"), "^\ufeff", "").alias("text"))
           .select(dataset, *PULL_ORDER, F.when(F.contains(text, F.lit("\r")), F.split(text, _LINE_END)).otherwise(F.split(text, "\n")).alias("cut")))
    # Behind the last line end there is no further line.
    lines = F.when(F.element_at("cut", -1) == "", F.slice("cut", F.lit(1), F.size("cut") - 1)).otherwise(F.col("cut"))
    header = F.get("lines", F.lit(_METADATA_LINES))
    told = (cut.select(*kept, lines.alias("lines"))
            .select(*kept, "lines", F.coalesce(_column_count(header) >= 4, F.lit(False)).alias("complete")))
    body = F.when(F.col("complete"), F.slice("lines", F.lit(_METADATA_LINES + 2), F.size("lines"))).otherwise(F.col("lines"))
    return told.select(*kept, "complete", F.explode(body).alias("line")).select(*kept, "line", "complete")


def tagged_lines(spark: SparkSession, path: str, dataset_pattern: str = r"([^/]+?)(?:\.csv)?$") -> DataFrame:
    """Lines of metadata-prefixed CSV exports after their headers: dataset (from the file's path), pull order, line, and
    ``complete``: false for all lines of a file that ends before a header of at least four columns.

    The five metadata lines and the header go by their place, never by their text. Small files, of which a landing has one a
    dataset and pull, are read once, each as a row; larger and packed ones line by line, in splits, twice. Which are which is
    told from the listing, before any file is opened.
    """
    with _listed_by_few_tasks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    whole = (F.col("_metadata.file_size") <= _WHOLE_BYTES) & ~F.col("_metadata.file_name").rlike(_PACKED)
    dataset = _unescaped(F.regexp_extract("pulled_from", dataset_pattern, 1)).alias("dataset")
    lines = _lines_of_whole_files(files.filter(whole), dataset)
    if not files.filter(~whole).select("_metadata.file_path").isEmpty():
        lines = lines.unionByName(_lines_of_split_files(spark, path, ~whole, dataset))
    return lines


def export_lines(spark: SparkSession, path: str, dataset_pattern: str = r"([^/]+?)(?:\.csv)?$") -> DataFrame:
    """Lines of complete exports; see :func:`tagged_lines`."""
    return tagged_lines(spark, path, dataset_pattern).filter("complete").drop("complete")


def short_exports(spark: SparkSession, path: str) -> DataFrame:
    """Paths of export files that end before a header of at least four columns."""
    return tagged_lines(spark, path).filter(~F.col("complete")).select(F.col("pulled_from").alias("path")).distinct()


def export_rows(lines: DataFrame) -> DataFrame:
    """Lines to positional fields (ts, value, grade, approval, qualifier or NULL), all text.

    ``inline`` makes the parsed line an operator of its own. As a plain projection the parse would
    be copied into every later filter and run several times per line.
    """
    names = ["ts", "value", "grade", "approval", "qualifier"]
    parsed = F.from_csv("line", ", ".join(f"{n} string" for n in names), {"nullValue": "NA", "mode": "PERMISSIVE"})
    fields = [F.nullif(F.nullif(F.get("cut", F.lit(i)), F.lit("")), F.lit("NA")).alias(n) for i, n in enumerate(names)]
    order = [c for c in CARRIED if c in lines.columns]
    cut = lines.select("dataset", *order, "line", F.when(plain_line(F.col("line")), F.split("line", ",", len(names) + 1)).alias("cut"))
    row = F.when(F.col("cut").isNotNull(), F.struct(*fields)).otherwise(parsed)
    return cut.select("dataset", *order, F.inline(F.array(row)))


def plain_line(line: Column) -> Column:
    """Whether commas alone part the fields of a CSV line, so that no CSV parser is needed: no quotes, line ends or NULs."""
    return ~line.rlike(r'["\r\n\x00]')


def _unescaped(path_part: Column) -> Column:
    """File paths come percent-encoded; a plus in them is a plus."""
    return F.url_decode(F.replace(path_part, F.lit("+"), F.lit("%2B")))


def _column_count(header: Column) -> Column:
    """Commas outside quotes, plus one."""
    return F.size(F.split(F.regexp_replace(header, r'"[^"]*"', "q"), ","))


def daily_history(spark: SparkSession, path: str, fmt: str = "parquet",
                  stations: DataFrame | None = None) -> DataFrame:
    """Daily flows or levels, restricted to ``stations(STATION_NUMBER)`` when given."""
    reader = spark.read.schema(S.DAILY_HISTORY)
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", "NA")
    history = reader.format(fmt).load(path)
    return history if stations is None else history.join(stations, "STATION_NUMBER", "left_semi")


def station_metadata(stations: DataFrame, regulation: DataFrame) -> DataFrame:
    return stations.join(regulation, "STATION_NUMBER", "left")


def by_name(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A CSV as text columns named by its header; an absent required column is an error."""
    text = spark.read.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    missing = [c for c in required if c not in text.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return text


def zone_free(c: Column) -> Column:
    """Text times in UTC, with or without the offset +00 or Z, to wall-clock times."""
    return F.regexp_replace(c, r"(\+00(:?00)?|Z)$", "").try_cast("timestamp_ntz")


def _typed(spark: SparkSession, path: str, schema, required: list[str]) -> DataFrame:
    """A CSV by its header's names as ``schema``; 'NA' and '' are NULL, columns it lacks are NULL."""
    text = by_name(spark, path, required)
    clean = text.select(*(F.nullif(C.null_if_empty(F.col(f"`{c}`")), F.lit("NA")).alias(c) for c in text.columns))
    return S.conform(clean, schema)


def station_table(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, S.STATION_META, ["STATION_NUMBER"])


def regulation_table(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, S.STATION_REGULATION, ["STATION_NUMBER", "REGULATED"])


def station_network(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, S.STATION_NETWORK, ["STATION_NUMBER", "STATION_NAME"])


def station_registry(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, S.STATION_REGISTRY, ["station_uid"])


def dataset_registry(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark, path, S.DATASET_REGISTRY, ["moe_id", "parameter", "label", "canon"])


def staged_observations(spark: SparkSession, path: str) -> DataFrame:
    """Bulk CSV by name with UTC text times; '' stays '' until :func:`normalize.staged_to_observation`."""
    return S.conform(by_name(spark, path, ["series_uid", "datetime_utc", "source"]), S.STAGED_OBS)
