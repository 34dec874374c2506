"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.llm import (
    aho_rank,
    crf,
    hilbert,
    maxscore,
    nn_descent,
    packing,
    preference,
    rules,
    simhash,
    spm_transducer,
    substring,
    value_dictionaries,
    warc,
)
from incident_stream.llm.common import job, table, written
from incident_stream.settings import new_work_dir

Query = Callable[[SparkSession, str], DataFrame]


@job
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    manifest = warc.write_warcs(table(spark, sf_dir, "pages"), folder)
    return warc.read_warcs(manifest, folder).drop("url")


@job
def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = substring.remove_repeated(docs, carry=["doc_id"])
    digest = F.sha2(F.coalesce("kept_text", F.lit("")), 256)
    return found.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@job
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return spm_transducer.code(table(spark, sf_dir, "documents"), model)


@job
def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


@job
def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = written(rules.statistics(docs, carry=["doc_id"]).withColumnRenamed("c0", "doc_id"))
    found = rules.fit(stats, table(spark, sf_dir, "labels"), "doc_id")
    failed = rules.base_failed()
    return stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & found.kept()).alias("kept"),
        F.when(~failed, found.rule_number()).alias("rule"),
    )


def _spans_text(mask: str):
    return F.array_join(
        F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
    )


@job
def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = preference.conversations_of(table(spark, sf_dir, "conversations"))
    pairs = preference.preference_pairs(preference.last_reply_swapped(conversations))
    return pairs.select(
        "pair_id",
        "n_common",
        "prompt",
        "chosen",
        _spans_text("chosen_mask").alias("chosen_mask"),
        "rejected",
        _spans_text("rejected_mask").alias("rejected_mask"),
    )


@job
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )
    return packing.digested(pieces)


@job
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@job
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = crf.fit(docs, table(spark, sf_dir, "labels"))
    found = crf.tag(docs, model, carry=["doc_id"]).withColumnRenamed("c0", "doc_id")
    return found.select(
        "doc_id",
        (~crf.in_fold()).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= crf.THRESHOLD).cast("int").alias("predicted"),
        F.size("_spans").alias("n_spans"),
        F.try_element_at("_spans", F.lit(1))["start"].alias("first_start"),
    )


@job
def op10_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_dir(spark)
    return hilbert.digest(hilbert.write_shards(table(spark, sf_dir, "documents"), folder), spark)


@job
def op11_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, F.col("vec_id") % 50 == 0)


@job
def op12_aho_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aho_rank.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@job
def op13_value_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_dictionaries.with_label_errors(
        *value_dictionaries.encode(table(spark, sf_dir, "embeddings"))
    )


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_substring": op2_substring,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_nn_descent": op4_nn_descent,
    "op5_decision_list": op5_decision_list,
    "op6_preference": op6_preference,
    "op7_packing": op7_packing,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_hilbert": op10_hilbert,
    "op11_maxscore": op11_maxscore,
    "op12_aho_rank": op12_aho_rank,
    "op13_value_dictionaries": op13_value_dictionaries,
}
