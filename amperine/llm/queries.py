"""Registered queries of the corpus operators, one each, over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from amperine.llm import (
    exact, language, language_model, minhash, mixing, packing, quality, rules, spelling, toxicity, urls, warc, whitening,
)
from amperine.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op3_source_mixing(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_classifier(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark, sf_dir):
    """The labels know one category; documents of low quality are the first link of the chain."""
    labels = table(spark, sf_dir, "labels")
    chances = toxicity.classify(
        table(spark, sf_dir, "documents"),
        labels.select("doc_id", (1 - F.col("quality")).alias("unfit"), "toxic"), ["unfit", "toxic"],
    )
    return chances.select(
        "doc_id", F.col("p_toxic").alias("score"), (F.col("p_toxic") >= 0.5).cast("int").alias("toxic"),
        F.col("p_unfit").alias("unfit_score"),
    )


def op6_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged = rules.judge(docs, rules.fit(docs, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_exact_dedup(spark, sf_dir):
    return exact.duplicate_groups(table(spark, sf_dir, "documents"))


def op8_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


def op9_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("file", "start")


def op11_embedding_whitening(spark, sf_dir):
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op12_lm_scoring(spark, sf_dir):
    """Learns from the documents outside fold 1 of five and scores all of them."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    scores = language_model.score(table(spark, sf_dir, "documents"), ~held_out)
    return scores.withColumn("held_out", held_out)


def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (
    op1_best_fit_packing, op2_minhash_dedup, op3_source_mixing, op4_quality_classifier, op5_toxicity, op6_quality_rules,
    op7_exact_dedup, op8_url_filters, op9_language_id, op10_warc, op11_embedding_whitening, op12_lm_scoring,
    op13_spelling_variants,
)}

SQL = {
    "op3_source_mixing": mixing.SQL,
    "op8_url_filters": urls.SQL,
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
}
