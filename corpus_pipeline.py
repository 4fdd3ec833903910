"""From documents to packed training sequences: language, near copies, repeated passages, personal data, packing.

Every stage works on all that the one before it kept. ORACLE_SQL is None: sketches, alignments and tokenisers have no
SQL form; ``tests/llm/test_pipeline.py`` compares with a brute-force version.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm import language_id, near_dedup, packing, pii, substring_dedup, vocab
from gaugelake.llm.common import documents, keep, ship
from gaugelake.llm.queries import WORD_VOCABULARY

LEAST_COSINE = 0.14  # above nearly all random letters, below nearly all prose: see README
FEW_LETTERS = 25  # texts of fewer letters are kept if they have any: a cosine of so few trigrams says little
BATCH_ROWS = 1000
VERDICT = "gaugelake verdict"  # no clash with columns of the documents


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those of FEW_LETTERS letters and more that are near to no language learned from
    ``lang``. Without any ``lang`` only the former go. Columns named like a verdict's fields are no matter."""
    judged = language_id.verdict(language_id.prototypes(docs.select("lang", "text")))(F.col("text").cast("string"))
    own = docs.withColumn(VERDICT, judged)
    near = (F.col(f"`{VERDICT}`.score") >= LEAST_COSINE) | (F.col(f"`{VERDICT}`.letters") < FEW_LETTERS)
    lettered = F.col(f"`{VERDICT}`.letters") > 0
    some = F.col(f"`{VERDICT}`.lang_pred") == language_id.UNKNOWN
    return own.where(lettered & (near | some)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the least id."""
    return near_dedup.one_of_each(docs)


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; what is left of such a text is joined by single blanks.
    A document that loses all its words goes."""
    found = substring_dedup.remove_passages(docs, carry=True)
    left = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return with_length(left.select(*(text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind; all documents stay."""
    return with_length(pii.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in packed sequences."""
    return packing.pack_documents(docs, vocab.path(WORD_VOCABULARY))


STAGES = [("language", languages), ("near_duplicates", near_copies), ("passages", passages),
          ("personal_data", personal_data), ("packing", packed)]
ORACLE_SQL = None


def in_small_batches(stage):
    """A stage whose Python workers take BATCH_ROWS rows at a time: whole texts pass through several stages of one
    application, and what the batches of one leave behind in the executors is the memory of the next. The setting stays
    on the session, since results are computed after the stage has returned."""
    @wraps(stage)
    def set_and_run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for session in (spark, docs.sparkSession):
            session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)
    return set_and_run


STAGES = [(name, in_small_batches(stage)) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(ship(spark), sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = keep(docs, f"pipeline-{name}")
    return docs
