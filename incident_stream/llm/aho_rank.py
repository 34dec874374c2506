"""Ranked lexical search that counts terms straight from the texts with an Aho-Corasick automaton.

No index of the documents is made. The terms of all items become the patterns of one automaton, each
between two guards, which also take the place of everything in a text that belongs to no term: so a
pattern is found where the term stands alone, and nowhere inside a longer one. The automaton's
output is the number of the term, and a table maps it on to the items that hold it.

Two passes read the texts: one counts the documents of each term, the other the scores. Both send
the sums or the best rows of a task only.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incident_stream.llm import textkernel
from incident_stream.llm.common import join_hot, written
from incident_stream.llm.ranking import Best, sortable

# The characters of a term, and the letters that are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

GUARD = 0x20
PORTION_BYTES = 8 << 20
TERM_OVERHEAD = 64
SCORE_CELLS = 1 << 20
HIT_NUMBERS = 1 << 20
DOCUMENTS, TERMS = -1, -2

_FOLDED = np.full(256, GUARD, dtype=np.uint8)
for _byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _FOLDED[_byte] = _byte
for _byte in range(0x41, 0x5B):
    _FOLDED[_byte] = _byte + 0x20

_known: dict[str, ahocorasick.Automaton] = {}


def distinct_terms(text: Column) -> Column:
    """The different terms of a text in ascending order; none for null."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_sort(F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))))


def automaton(key: str, terms: list[str]) -> ahocorasick.Automaton:
    """The automaton of these terms; a worker keeps the last one, under its key."""
    if key not in _known:
        _known.clear()
        made = ahocorasick.Automaton()
        guard = chr(GUARD)
        for number, term in enumerate(terms):
            # bytes as characters, as the texts are read
            made.add_word(f"{guard}{term.encode().decode('latin-1')}{guard}", number)
        made.make_automaton()
        _known[key] = made
    return _known[key]


def counted(texts: textkernel.Texts, found: ahocorasick.Automaton, n_terms: int):
    """Terms of each text with repeats, and (text, term, tf) for each term of the automaton that
    stands in a text, in ascending order."""
    lengths = np.diff(texts.offsets)
    starts = texts.offsets[:-1] + np.arange(len(texts))
    guarded = np.full(len(texts.data) + len(texts) + 1, GUARD, dtype=np.uint8)
    shift = np.repeat(np.arange(1, len(texts) + 1), lengths)
    guarded[np.arange(len(texts.data)) + shift] = _FOLDED[texts.data]
    firsts = (guarded[1:] != GUARD) & (guarded[:-1] == GUARD)
    before = np.concatenate(([0], np.cumsum(firsts)))
    n = before[starts + lengths + 1] - before[starts]
    numbers = chain.from_iterable(found.iter(guarded.tobytes().decode("latin-1")))
    pairs, tf = np.empty(0, np.int64), np.empty(0, np.int64)
    while len(hits := np.fromiter(islice(numbers, HIT_NUMBERS), dtype=np.int64)):
        end, term = hits[0::2], hits[1::2]
        text = np.searchsorted(starts, end - 1, "right") - 1
        more, times = np.unique(text * n_terms + term, return_counts=True)
        pairs, places = np.unique(np.concatenate([pairs, more]), return_inverse=True)
        tf = np.bincount(places, weights=np.concatenate([tf, times])).astype(np.int64)
    return n, pairs // max(1, n_terms), pairs % max(1, n_terms), tf


def _frequencies(key: str, terms):
    """Documents of each term, and how many documents with a term and how many terms there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = terms.value
        found = automaton(key, words)
        df, totals = np.zeros(len(words), dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            for texts in textkernel.chunks(batch.column(0)):
                n, _, term, _ = counted(texts, found, len(words))
                df += np.bincount(term, minlength=len(words))
                totals += [(n > 0).sum(), n.sum()]
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([[DOCUMENTS, TERMS], held])),
                pa.array(np.concatenate([totals, df[held]])),
            ],
            ["term", "n"],
        )

    return count


def _lengths_norm(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    kind = object if 90 * int(n.max(initial=0)) * documents >= 1 << 63 else np.int64
    return (100 - 90 + 90 * n.astype(kind) * documents // terms).astype(np.int64)


def _scored(key: str, terms, known, k: int):
    """The best documents of a task for every group of items."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, first, items, n_items, documents, all_terms = known.value
        n_terms = len(terms.value)
        found = automaton(key, terms.value)
        held = np.diff(first)
        best = Best(k, np.ones(n_items, dtype=np.int64))
        # as many texts at a time as the table of their scores has room for
        step = max(1, SCORE_CELLS // n_items)
        for batch in batches:
            ids, null = sortable(batch.column(0))
            for texts in textkernel.chunks(batch.column(1)):
                n, text, term, tf = counted(texts, found, n_terms)
                m = _lengths_norm(n, documents, all_terms)
                value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[text]))
                for lo in range(0, len(texts), step):
                    here = slice(*np.searchsorted(text, [lo, lo + step]))
                    sums = np.zeros((min(step, len(texts) - lo), n_items), dtype=np.int64)
                    of = term[here]
                    item = items[textkernel.expand(first[of], held[of])]
                    cell = np.repeat(text[here] - lo, held[of]) * n_items + item
                    np.add.at(sums.reshape(-1), cell, np.repeat(value[here], held[of]))
                    row, item = np.nonzero(sums >= best.floor)
                    at = texts.first + lo + row
                    if len(at):
                        best.add(item, sums[row, item], ids[at], null[at])
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.of), best.ids(), pa.array(best.score)], ["number", "doc_id", "score"]
        )

    return score


def _weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _portion_results(docs: DataFrame, groups: list, k: int) -> DataFrame:
    """(item_key, doc_id, score) of the best documents of each task, for some groups of items."""
    spark = docs.sparkSession
    words = sorted({t for g in groups for t in g["terms"]})
    number = {t: i for i, t in enumerate(words)}
    key, terms = uuid.uuid4().hex, spark.sparkContext.broadcast(words)
    partial = docs.select("text").mapInArrow(_frequencies(key, terms), "term bigint, n bigint")
    sums = dict(partial.groupBy("term").agg(F.sum("n")).collect())
    documents, all_terms = sums.get(DOCUMENTS, 0), sums.get(TERMS, 0)
    weights = np.array([_weight(documents, sums.get(i, 0)) for i in range(len(words))], dtype=np.int64)
    pairs = sorted((number[t], i) for i, g in enumerate(groups) for t in g["terms"])
    first = np.searchsorted([p[0] for p in pairs], np.arange(len(words) + 1))
    items = np.array([p[1] for p in pairs], dtype=np.int64)
    known = spark.sparkContext.broadcast(
        (weights, first, items, len(groups), documents, max(1, all_terms))
    )
    ddl = "number bigint, doc_id bigint, score bigint"
    found = docs.mapInArrow(_scored(key, terms, known, k), ddl)
    keys = spark.createDataFrame([(i, g["key"]) for i, g in enumerate(groups)], "number bigint, key string")
    return written(found.join(F.broadcast(keys), "number").select("key", "doc_id", "score"))


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """For each item its `k` documents with the highest scores above 0, as (item_id, rank, doc_id,
    score), equal scores by ascending doc_id.

    Terms are maximal runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. N
    is the number of documents with a term, L that of all their terms, n that of a document's, df
    the documents that hold a term and tf its occurrences in one. With w = floor(1000 * ln((2N + 2)
    / (2df + 1))) and m = 10 + (90 n N div L), a score is the sum of w * (10^9 tf div (1000 tf +
    8 m)) over the different terms of the item.

    Items with the same terms are ranked once. The terms go to the workers in portions of about
    PORTION_BYTES (an item is not divided), two passes over all texts for each; whole texts are read.
    A task keeps the best `k` documents of each item of the portion.

    A null or empty text has no terms; an item without terms, or with none that a document holds,
    gets no rows. Repeated documents are documents of their own, and so are repeated items, each with
    all its ranks. Null ids are kept; a null doc_id comes after all others of its score. Empty tables
    give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")
    )
    asked = items.select(F.col(item_column).alias("item_id"), distinct_terms(F.col(item_text_column)).alias("terms"))
    # terms hold no blank, so the joined terms say the same as the list
    asked = written(asked.where("size(terms) > 0").withColumn("key", F.sha2(F.array_join("terms", " "), 256)))
    size = F.aggregate("terms", F.lit(0).cast("bigint"), lambda a, t: a + F.octet_length(t) + TERM_OVERHEAD)
    groups = asked.groupBy("key").agg(F.first("terms").alias("terms"), F.count("*").alias("n"))
    groups = written(groups.withColumn("bytes", size))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    portions = -(-total // PORTION_BYTES)
    part = F.pmod(F.xxhash64("key"), F.lit(max(1, portions)))
    found = spark.createDataFrame([], "key string, doc_id bigint, score bigint")
    for i in range(portions):
        some = groups.where(part == i).select("key", "terms").collect()
        if some:
            found = found.union(_portion_results(texts, some, k))
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    lists = ranked.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id", "score"))).alias("best"))
    totals = written(groups.select("key", "n").join(lists, "key", "left"))
    answered = join_hot(asked.select("item_id", "key"), totals, "key", ["best"])
    return answered.select("item_id", F.inline("best"))
