import hashlib
import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from gaugelake.llm import near_dedup, pii
from gaugelake.llm.queries import PIECE_VOCABULARY, QUERIES, SQL, WORD_VOCABULARY
from gaugelake.llm import vocab
from helpers import awkward, corpus, frame
from test_near import by_hand
from test_repeats import passages_by_hand
from test_texts import plain


def test_stages_by_hand(spark, tmp_path):
    texts = corpus(n=30)
    frame(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    known = {r.doc_id for r in corpus_pipeline.languages(spark, docs, str(tmp_path)).collect()}
    assert {i for i, t in enumerate(texts) if t and len(t.split()) > 4} - known <= {texts.index("la " * 13 + "la")}
    assert not known & {i for i, t in enumerate(texts) if not t or not any(c.isalpha() for c in t)}
    rows = [(i, t) for i, t in enumerate(texts) if i in known]
    classes = by_hand(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    after = {i: (n, gone, kept) for i, n, gone, kept in passages_by_hand(rows, 50)}
    rows = [(i, pii.redacted(after[i][2] if after[i][1] else t)) for i, t in rows if after[i][1] < after[i][0]]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(rows)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = vocab.word_ids(vocab.path(WORD_VOCABULARY)).tokenizer
    tokens = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    assert {r.doc_id for r in packed} == set(tokens)
    assert sum(r.length for r in packed) == sum(tokens.values())


def test_language_stage_takes_clashing_columns_and_empty_tables(spark, tmp_path):
    rng = random.Random(6)
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(60))
    texts = [*[f"the words of this text are plain and they are number {i} of the many that we have here" for i in range(40)], noise, "A.", "12 34"]
    docs = frame(spark, texts).withColumns({"score": F.lit(1.0), "lang_pred": F.lit("x"), "letters": F.lit(2), "lang": F.lit("en")})
    labelled = docs.withColumn("lang", F.when(F.col("doc_id") < 40, "en"))
    kept = corpus_pipeline.languages(spark, labelled, "")
    assert kept.columns == labelled.columns
    assert {r.doc_id for r in kept.collect()} == {*range(40), 41}  # noise and a text without letters go, a short one stays
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.languages(spark, bare, "").collect()} == {*range(42)}
    frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(SQL) <= set(QUERIES) and [n for n, _ in corpus_pipeline.STAGES][1] == "near_duplicates"


def test_digest_columns(spark, tmp_path):
    """The queries' digests over documents of every awkward kind, against the plain definitions."""
    texts = [*awkward(), "write to x.y@z.org or 10.1.2.3, card 4111-1111-1111-1111 and +49 30 1234567", "two  words"]
    frame(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")

    def sha(data):
        return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
    run = {name: {r.doc_id: r for r in q(spark, str(tmp_path)).collect()} for name, q in QUERIES.items()
           if name.startswith(("op2", "op3", "op5", "op7", "op8", "op10"))}
    model = vocab.chunk_ids(vocab.path(PIECE_VOCABULARY)).model
    for i, text in enumerate(texts):
        text = text or ""
        spans = [f"{k}:{s}:{e}" for k, s, e in plain(text)]
        r = run["op5_pii"][i]
        assert r.base_sha256 == sha(",".join(spans)) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s.startswith(k) for s in spans) for k in ("email", "ip", "card", "phone")]
        assert set(spans) <= set(r.spans.split(","))  or not spans
        ids = model.encode(text)
        r = run["op7_chunk_table"][i]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)))
        words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
        r = run["op2_phrase_automata"][i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(words), 0, sha(" ".join(words)))
        assert run["op10_column_transform"][i].n_bytes == len(text.encode())
        assert run["op3_fertility"][i].base_failed is (len(words) < 20 or run["op3_fertility"][i].n_repeat_words * 100 > 30 * len(words))
        assert run["op8_hyperdimensional"][i].held_out in (True, False)
    assert run["op10_column_transform"][8].n_removed == 3000 and run["op10_column_transform"][8].n_spans == 1
