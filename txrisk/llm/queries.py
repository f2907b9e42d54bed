"""The operators on the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txrisk.llm import (bpe, ctph, exact_dedup, langid, neighbours, periods, pfair, repetition, secrets, simhash, token_counts, toxicity,
                        warc, whitening)
from txrisk.llm.common import id_hash, text_column
from txrisk.session import shared_dir

# Texts can be long: few rows go to Python at once.
ROWS_AT_ONCE = "512"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a repository of its source, the owner."""
    spans, _ = secrets.scan(_table(spark, sf_dir, "documents"), "doc_id", "text", "doc_id", "source")
    base = F.filter("spans", lambda s: s["own"])

    def of_kind(number: int):
        return F.size(F.filter(base, lambda s: s["kind"] == number)).cast("long")

    return spans.select(
        F.col("id").alias("doc_id"), of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "archives")
    arc, done = os.path.join(base, "arc"), os.path.join(base, "warc")
    warc.write_arc(_table(spark, sf_dir, "pages"), arc)
    warc.convert(spark, arc, done)
    return warc.read_warc(spark, done, payloads=False).select(
        F.col("key").alias("page_id"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_key").alias("refers_to"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.training_lang()).select(
        F.col("id").alias("doc_id"), (id_hash("id") % 5 == 0).alias("held_out"), F.col("lang").alias("lang_pred"), "score",
        "entropy", "rejected")


def op4_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights are document counts to the power 0.7, of rows without a source too; a block has 32 documents."""
    mixed = pfair.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"), block_docs=32)
    return mixed.select("doc_id", "source", "position", F.floor(F.col("position") / 32).alias("slot"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store has one name in the shared folder: texts that an earlier run counted aren't encoded again."""
    counts = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       shared_dir(spark, "token-counts", fresh=False))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark(_table(spark, sf_dir, "documents"), keep="largest")
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Token counts of documents, and digests of their ids and decoded texts."""
    return bpe.decode(bpe.encode(docs, path), path).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, id_hash("doc_id") % 3 != 1)
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", (id_hash("doc_id") % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


def op10_ctph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with equal ids follow each other by a hash of their texts."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", text_column("text").alias("text"))
    order = neighbours.Descending(docs.withColumn("tie", F.xxhash64("text")), "doc_id", "tie")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = order.rows.withColumn("next_text", F.coalesce(order.next("text"), F.lit(""))).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)))
    edited = edited.select(*order.rows.columns, "edited", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    prints = ctph.fingerprints(edited, {"text": "fingerprint", "edited": "edited_fingerprint"},
                               {"near_edited": ("fingerprint", "edited_fingerprint")}, keep_texts=False)
    prints = order.only(prints.withColumn("next_fingerprint", order.next("fingerprint")))
    return prints.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                         ctph.likeness_column("fingerprint", "next_fingerprint").alias("near_next"))


def op11_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = repetition.measure(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                           "n_repeats", "longest_repeat", "covered_chars")


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    model = whitening.fit(table)
    explained = F.array(*map(F.lit, model.explained)) if model.explained else F.array().cast("array<double>")
    rows = whitening.transform(table, model, keep=["vec_id"])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def periodic_tail(text: Column, id_: Column) -> Column:
    """The text of every tenth id (by hash) with its last words made periodic; the others as they are, null ids too."""
    h = F.crc32(id_.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words)
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(words, lambda word, i: F.when(
            i >= a, F.get(words, (a + (i - a) % p).cast("int"))).otherwise(word)), " ")

    # In an array of one, so that the words are split once and not for each of them.
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), changed), F.lit(0))).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", periodic_tail(F.col("text"), F.col("doc_id")).alias("text"))
    found = periods.find(docs, keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"), F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_secret_scan": op1_secret_scan, "op2_arc_to_warc": op2_arc_to_warc, "op3_language_id": op3_language_id,
    "op4_pfair_mix": op4_pfair_mix, "op5_token_counts": op5_token_counts, "op6_exact_dedup": op6_exact_dedup,
    "op7_bpe": op7_bpe, "op8_simhash": op8_simhash, "op9_toxicity": op9_toxicity, "op10_ctph": op10_ctph,
    "op11_suffix_repetition": op11_suffix_repetition, "op12_feast_whitening": op12_feast_whitening,
    "op13_periodic_runs": op13_periodic_runs, "pipeline": pipeline,
}

ORACLES = {
    "op2_arc_to_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS best FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
        FROM r""",
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT doc_id, text, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM g""",
}
