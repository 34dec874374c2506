"""Quality rules as a learned decision list.

Statistics of every text are computed once. From labelled statistics, sequential covering grows
one rule after the other: a conjunction of threshold conditions that rejects, grown by information
gain on two thirds of the fitting rows, pruned on the last third, and kept only while it is precise
on all rows that are left. Rows that a rule covers are taken out before the next is grown. The list is handed out as an
ordered chain of Spark conditional expressions, readable as text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incident_stream.llm import textkernel as tk
from incident_stream.llm.common import hash_sample

REPEAT_WIDTH = 5
# The list is fitted on at most this many labelled rows, those first in the order of a hash.
MAX_FIT_ROWS = 20_000
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.97
MIN_COVER = 3

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?.,;:")] = True

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_bangs",
    "n_distinct",
)


def _repeats(number: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which entries have the number of an earlier entry of the same text."""
    keyed = doc * (int(number.max(initial=0)) + 1) + number
    _, first = np.unique(keyed, return_index=True)
    later = np.ones(len(number), dtype=bool)
    later[first] = False
    return later


def count_chunk(texts: tk.Texts) -> dict[str, np.ndarray]:
    """The counts of COUNTS for each text of a chunk."""
    data = texts.data
    spans = tk.words(texts)
    number, _ = tk.span_classes(texts, spans)
    starts_char = (data & 0xC0) != 0x80
    chars = tk.per_text_bytes(texts, starts_char & ~tk.SPACE[data])
    out = {
        "n_words": tk.per_text(texts, spans.doc),
        "word_chars": chars,
        "n_symbols": tk.per_text_bytes(texts, _SYMBOL[data]),
        "n_upper": tk.per_text_bytes(texts, _UPPER[data]),
        "n_digits": tk.per_text_bytes(texts, _DIGIT[data]),
        "n_marks": tk.per_text_bytes(texts, _MARK[data]),
        "n_bangs": tk.per_text_bytes(texts, data == 0x21),
    }
    lines = tk.lines(texts)
    inked = np.concatenate(([0], np.cumsum(~tk.SPACE[data])))
    full = inked[lines.end] > inked[lines.start]
    lines = tk.Spans(lines.start[full], lines.end[full], lines.doc[full])
    again = _repeats(tk.span_classes(texts, lines)[0], lines.doc)
    out["n_lines"] = tk.per_text(texts, lines.doc)
    out["n_dup_lines"] = tk.per_text(texts, lines.doc[again])
    out["n_distinct"] = out["n_words"] - tk.per_text(texts, spans.doc[_repeats(number, spans.doc)])
    starts = tk.window_starts(spans.doc, REPEAT_WIDTH)
    windows = tk.sequence_classes(number, REPEAT_WIDTH)[starts]
    keyed = spans.doc[starts] * (int(windows.max(initial=0)) + 1) + windows
    _, group, counts = np.unique(keyed, return_inverse=True, return_counts=True)
    twice = starts[counts[group] > 1]
    out["n_repeat_words"] = tk.per_text(
        texts, spans.doc[tk.covered(len(spans), twice, REPEAT_WIDTH)]
    )
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [count_chunk(texts) for texts in tk.chunks(batch.column(0))]
        if not parts:
            continue
        counts = [pa.array(np.concatenate([p[name] for p in parts])) for name in COUNTS]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *counts], [*batch.schema.names[1:], *[f"_{c}" for c in COUNTS]]
        )


def statistics(docs: DataFrame, text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns of `carry` (default: all) as c0, c1, ... and COUNTS of every whole text.

    A null or empty text has no words, and all its counts are 0. Texts of any length are counted
    whole. Repeated rows give equal rows, an empty table none. Columns that are called as a count
    or as an added column do no harm, as those of `carry` come out under their numbers.
    """
    carry = docs.columns if carry is None else carry
    rows = docs.select(
        F.col(text_column).alias("_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    )
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    ddl = ", ".join([*kinds, *[f"_{c} bigint" for c in COUNTS]])
    found = rows.mapInArrow(_counted, ddl)
    return found.withColumnsRenamed({f"_{c}": c for c in COUNTS})


def base_failed() -> Column:
    """Too short, or over a fifth of the words repeat."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _share(part: str, whole: str) -> str:
    return f"({part} / greatest({whole}, 1))"


# What the conditions may test: name, and the SQL expression over COUNTS.
FEATURES = {
    "words": "double(n_words)",
    "chars_per_word": _share("word_chars", "n_words"),
    "symbols_per_word": _share("n_symbols", "n_words"),
    "dup_line_share": _share("n_dup_lines", "n_lines"),
    "repeat_share": _share("n_repeat_words", "n_words"),
    "words_per_line": _share("n_words", "n_lines"),
    "upper_share": _share("n_upper", "word_chars"),
    "digit_share": _share("n_digits", "word_chars"),
    "marks_per_word": _share("n_marks", "n_words"),
    "bangs_per_word": _share("n_bangs", "n_words"),
    "distinct_share": _share("n_distinct", "n_words"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} double('{self.threshold!r}')"

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects."""

    conditions: tuple[Condition, ...]

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), dtype=bool)
        for c in self.conditions:
            out &= c.holds(x)
        return out


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def kept(self) -> Column:
        """False at the first rule that covers a row, else true."""
        verdict = F.lit(True)
        for rule in reversed(self.rules):
            verdict = F.when(F.expr(rule.sql()), F.lit(False)).otherwise(verdict)
        return verdict

    def rule_number(self) -> Column:
        """The number, from 1, of the rule that rejects a row; null if none does."""
        number = F.lit(None).cast("int")
        for i in range(len(self.rules), 0, -1):
            number = F.when(F.expr(self.rules[i - 1].sql()), F.lit(i)).otherwise(number)
        return number

    def text(self) -> str:
        lines = [f"REJECT IF {rule.sql()}" for rule in self.rules]
        return "\n".join([*lines, "ELSE KEEP"])


def _best_condition(x, bad: np.ndarray, held: np.ndarray) -> tuple[float, Condition] | None:
    """The condition with the largest information gain among the rows still held."""
    p0, n0 = int((held & bad).sum()), int((held & ~bad).sum())
    if p0 == 0 or n0 == 0:
        return None
    base = math.log2(p0 / (p0 + n0))
    best = None
    for feature, values in x.items():
        order = np.argsort(values[held], kind="stable")
        v, b = values[held][order], bad[held][order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if len(cut) == 0:
            continue
        p_below, n_below = np.cumsum(b)[cut], np.cumsum(~b)[cut]
        for above in (False, True):
            p, n = (p0 - p_below, n0 - n_below) if above else (p_below, n_below)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), -np.inf)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0]:
                threshold = float((v[cut[k]] + v[cut[k] + 1]) / 2)
                if not v[cut[k]] <= threshold < v[cut[k] + 1]:
                    threshold = float(v[cut[k]])
                best = (float(gain[k]), Condition(feature, above, threshold))
    return best if best and best[0] > 0 else None


def _worth(rule: Rule, x, bad: np.ndarray) -> float:
    covers = rule.covers(x)
    p, n = int((covers & bad).sum()), int((covers & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> DecisionList:
    """Sequential covering. Rows must come in a random order; every third prunes."""
    n = len(bad)
    third = np.arange(n) % 3 == 2
    left = np.ones(n, dtype=bool)
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        grow, prune = left & ~third, left & third
        if (grow & bad).sum() < MIN_COVER:
            break
        gx = {k: v[grow] for k, v in x.items()}
        px = {k: v[prune] for k, v in x.items()}
        held = np.ones(int(grow.sum()), dtype=bool)
        conditions: list[Condition] = []
        while len(conditions) < MAX_CONDITIONS:
            found = _best_condition(gx, bad[grow], held)
            if found is None:
                break
            conditions.append(found[1])
            held &= found[1].holds(gx)
        if not conditions:
            break
        shorter = [Rule(tuple(conditions[:k])) for k in range(len(conditions), 0, -1)]
        rule = max(shorter, key=lambda r: _worth(r, px, bad[prune]))
        covers = rule.covers(x) & left
        good = int((covers & ~bad).sum())
        if covers.sum() < MIN_COVER or good > (1 - MIN_PRECISION) * covers.sum():
            break
        rules.append(rule)
        left &= ~covers
    return DecisionList(tuple(rules))


def fit(stats: DataFrame, labels: DataFrame, id_column: str, max_rows: int = MAX_FIT_ROWS) -> DecisionList:
    """Fit on labelled rows that pass the base rules: `quality` 0 is what to reject.

    `stats` has COUNTS beside `id_column`. At most `max_rows` rows reach the driver, as numbers:
    those first in the order of a hash of their id, which is also a random order. Without labels
    of both kinds the list is empty and keeps everything.
    """
    known = labels.where("quality is not null").select(
        F.col("doc_id").alias("_label_id"), F.col("quality").alias("_quality")
    )
    rows = stats.where(~base_failed()).select(
        F.col(id_column).alias("_id"),
        *[F.expr(sql).alias(f"f_{name}") for name, sql in FEATURES.items()],
    )
    chosen = rows.join(known, F.col("_id") == F.col("_label_id")).drop("_label_id")
    sample = hash_sample(chosen, "_id", max_rows).toPandas()
    bad = sample["_quality"].to_numpy() == 0
    if len(bad) == 0 or bad.all() or not bad.any():
        return DecisionList(())
    return learn({name: sample[f"f_{name}"].to_numpy(float) for name in FEATURES}, bad)
