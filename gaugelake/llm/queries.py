"""One query per operator over the whole tables, with the digest columns of its results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake.llm import (conversations, language_id, near_dedup, packing, pieces, pii, quality, simhash, substring_dedup, suffix_dedup, topk,
                           training_order, vocab, whitening)
from gaugelake.llm.common import documents, ship
from gaugelake.session import workspace

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(ship(spark), sf_dir))


def op2_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_passages(documents(ship(spark), sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rules(documents(ship(spark), sf_dir), vocab.path(PIECE_VOCABULARY))


def op4_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(ship(spark), sf_dir), vocab.path(WORD_VOCABULARY))


def span_list(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(*kinds: str) -> F.Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(ship(spark), sf_dir))
    return found.select("doc_id", *(F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE),
                        F.sha2(span_list(of_kinds(*pii.BASE)), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"),
                        *(F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS if kind not in pii.BASE),
                        F.size("spans").cast("long").alias("n_spans"),
                        F.array_join(F.transform("spans", lambda s: s["score"].cast("decimal(3,2)").cast("string")), ",").alias("scores"))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = training_order.in_training_order(documents(ship(spark), sf_dir), vocab.path(WORD_VOCABULARY),
                                              workspace(spark, "training-shards"))
    return placed.select("slot", "shard", "byte_offset", "n_tokens", "ids_crc32", F.col("docs.doc_id").alias("doc_ids"))


def op7_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(documents(ship(spark), sf_dir), vocab.path(PIECE_VOCABULARY))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(ship(spark), sf_dir))


def op9_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(ship(spark).read.parquet(f"{sf_dir}/embeddings.parquet"), copies=topk.K)
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0)


def op10_column_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(ship(spark), sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_checkpointed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = ship(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.report(conversations.searched(conversations.damaged(talks)))


def op12_vantage_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(documents(ship(spark), sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def op13_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(whitening.integers(ship(spark).read.parquet(f"{sf_dir}/embeddings.parquet")))
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "own")
    return (white.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error", parts)
            .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "own.whitened", "own.explained", "identity_error"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_order_minhash, op2_phrase_automata, op3_fertility, op4_swap_packing, op5_pii,
                            op6_training_order, op7_chunk_table, op8_hyperdimensional, op9_dual_tree,
                            op10_column_transform, op11_checkpointed_repair, op12_vantage_point,
                            op13_bit_sliced)}

SQL: dict[str, str] = {
    "op2_phrase_automata": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
        spans AS (SELECT doc_id, pos, list(word) OVER next AS code, count(*) OVER next AS n FROM words
                  WINDOW next AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
        firsts AS (SELECT code, min(doc_id) AS least FROM spans WHERE n = 50 GROUP BY code),
        starts AS (SELECT doc_id, pos FROM spans JOIN firsts USING (code) WHERE doc_id > least),
        marked AS (SELECT words.doc_id, word, words.pos,
                          coalesce(max(starts.pos) OVER (PARTITION BY words.doc_id ORDER BY words.pos) >= words.pos - 49, false) AS gone
                   FROM words LEFT JOIN starts USING (doc_id, pos))
        SELECT doc_id, count(pos) AS n_words, count(pos) FILTER (gone) AS n_removed,
               sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM d LEFT JOIN marked USING (doc_id) GROUP BY doc_id""",
    "op9_dual_tree": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                     CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                     vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
}
