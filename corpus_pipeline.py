"""The corpus pipeline: five stages, each over all documents that the one before has kept.

Belongs to the subpackage `incident_stream.llm`. No stage can be expressed in SQL: the first two
apply learned models, and the others hash, search or tokenise.

Every stage but the last takes and returns the columns of `documents`; a column that the table has
beside them is left out by the first. All take null, empty and very long texts, null and repeated
ids, repeated rows and an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_stream.llm import crf, packing, rules, simhash, substring
from incident_stream.llm.common import job, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@job
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the learned decision list reject.

    The list is fitted on the statistics of the labelled documents among those at hand. To judge,
    the statistics are made once more beside the columns of the documents: counting twice costs less
    than moving the texts for a join. Texts of fewer than ten words, null and empty ones among
    them, fail the base rules. Repeated rows are judged alike.
    """
    stats = written(rules.statistics(docs, carry=["doc_id"]).withColumnRenamed("c0", "doc_id"))
    found = rules.fit(stats, table(spark, sf_dir, "labels"), "doc_id")
    judged = rules.statistics(docs, carry=COLUMNS).where(~rules.base_failed() & found.kept())
    return judged.select([F.col(f"c{i}").alias(c) for i, c in enumerate(COLUMNS)])


@job
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score reaches the threshold. Null and empty texts score 0 and stay, and
    repeated rows are scored alike."""
    model = crf.fit(docs, table(spark, sf_dir, "labels"))
    judged = crf.tag(docs, model, carry=COLUMNS).where(F.col("_score") < crf.THRESHOLD)
    return judged.select([F.col(f"c{i}").alias(c) for i, c in enumerate(COLUMNS)])


@job
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id. Texts without
    words are copies of each other. Of repeated rows one stays."""
    found = written(simhash.near_duplicates(docs))
    return simhash.keep_one(docs, found).select(COLUMNS)


@job
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts. A document stays even if no word is left; a null text
    stays null, and n_chars is counted anew."""
    found = substring.remove_repeated(docs, carry=["doc_id", "lang", "source"])
    text = F.col("kept_text")
    return found.select(
        "doc_id", text.alias("text"), "lang", "source", F.length(text).cast("bigint").alias("n_chars")
    )


@job
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence, with its ids. A null or empty text is its end id alone;
    repeated rows are packed each."""
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", packed),
]

ORACLE_SQL = None


@job
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each result is written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
