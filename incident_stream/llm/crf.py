"""Toxic spans and document scores from a linear-chain conditional random field.

Every token is toxic (T) or not (O). The emission score of a token adds up hashed features: the
word itself, its first and last bytes, the word before and the word after; transitions have weights
of their own. Labels exist for documents only, so the labelled tokens are drawn from them: in toxic
fitting documents a token is T if its word or stem tells toxic from clean documents nearly alone. Forward and
backward passes give the marginal probability of T for each token; a document's score is the
largest, and runs of tokens over one half are its offending spans.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_stream.llm import textkernel as tk
from incident_stream.llm.common import hash_sample, written

# The model is fitted on at most this many documents of each label, drawn by a hash of their id, and
# on at most so many bytes of each label: documents are taken in the order of a hash of their text
# until these are reached. A text that would take more than an eighth of them by itself gives a
# sample of its stretches, from all over the text.
MAX_FIT_DOCS = 1000
MAX_FIT_BYTES = 3 << 20
STRETCH_BYTES = 16 << 10
WORD_BITS, NEAR_BITS = 18, 14
STEMS = (3, 4, 5, 6, 8)
STEPS = 40
RATE = 0.3
DECAY = 1e-4
MIN_SUPPORT = 3
MIN_GAIN = 0.01
MIN_SHARE = 0.04
MIN_PRECISION = 0.95
# Words and stems of one length that may be expected to be taken by chance alone.
MAX_CHANCE = 0.5
THRESHOLD = 0.7

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x30:0x3A] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True


@dataclass
class Tokens:
    """Words without punctuation, in lower case: their place in the original bytes, and features."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    word: np.ndarray
    stems: list[np.ndarray]
    features: list[np.ndarray]


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the capital letters from U+00C0 to U+00DE in lower case; lengths stay."""
    out = _LOWER[data]
    wide = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[wide] += 0x20
    return out


def tokens_of(texts: tk.Texts) -> Tokens:
    stay = _LETTER[texts.data] | tk.SPACE[texts.data]
    at = np.flatnonzero(stay)
    count = np.concatenate(([0], np.cumsum(stay)))
    bare = tk.Texts(texts.first, _lowered(texts.data[at]), count[texts.offsets])
    spans = tk.words(bare)
    # stems and ends are those of the different words; a word no longer than a stem is its own
    number, values = tk.span_classes(bare, spans)
    known = values.to_pylist()
    word = tk.value_hashes(known)[0][number]
    stems = [tk.value_hashes([w[:size] for w in known])[0][number] for size in STEMS]
    tail = tk.value_hashes([w[-4:] for w in known])[1][number]
    edge = np.uint64(0)
    same = spans.doc[1:] == spans.doc[:-1]
    before, after = np.full(len(word), edge), np.full(len(word), edge)
    before[1:][same] = word[:-1][same]
    after[:-1][same] = word[1:][same]
    near = np.uint64(64 - NEAR_BITS)
    features = [
        (word >> np.uint64(64 - WORD_BITS)).astype(np.int32),
        *[(stem >> np.uint64(64 - WORD_BITS)).astype(np.int32) for stem in stems],
        (tail >> near).astype(np.int32),
        (before >> near).astype(np.int32),
        (after >> near).astype(np.int32),
    ]
    if len(spans) == 0:
        none = np.empty(0, np.int64)
        return Tokens(none, none, none, word, stems, features)
    return Tokens(at[spans.start], at[spans.end - 1] + 1, spans.doc, word, stems, features)


def all_tokens(texts: list[str]) -> Tokens:
    """The tokens of all texts, chunk by chunk, without their places."""
    parts = []
    for chunk in tk.chunks(pa.array(texts, pa.string())):
        found = tokens_of(chunk)
        none = np.empty(0, np.int64)
        doc = (found.doc + chunk.first).astype(np.int32)
        parts.append(Tokens(none, none, doc, found.word, found.stems, found.features))
    doc, word = (np.concatenate([getattr(p, name) for p in parts]) for name in ("doc", "word"))
    stems = [np.concatenate([p.stems.pop(0) for p in parts]) for _ in STEMS]
    features = [np.concatenate([p.features.pop(0) for p in parts]) for _ in range(len(STEMS) + 4)]
    return Tokens(none, none, doc, word, stems, features)


class Chains:
    """Tokens of several texts laid out step by step, so that one pass moves all texts at once."""

    def __init__(self, doc: np.ndarray, n_docs: int) -> None:
        length = np.bincount(doc, minlength=n_docs)
        order = np.argsort(-length, kind="stable")
        rank = np.empty(n_docs, dtype=np.int64)
        rank[order] = np.arange(n_docs)
        first = np.concatenate(([0], np.cumsum(length)[:-1]))
        step = np.arange(len(doc)) - first[doc]
        self.steps = int(length.max()) if n_docs and len(doc) else 0
        # texts still running at each step, and where the step begins
        self.active = n_docs - np.searchsorted(np.sort(length), np.arange(self.steps), "right")
        self.base = np.concatenate(([0], np.cumsum(self.active)))
        self.place = self.base[step] + rank[doc] if len(doc) else np.empty(0, np.int64)

    def ratios(self, odds: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward ratios of T to O for each token, given its odds of T by emission
        and the four transition weights O->O, O->T, T->O, T->T."""
        oo, ot, to, tt = move
        laid = np.empty(len(odds))
        laid[self.place] = odds
        forward, backward = np.empty(len(odds)), np.ones(len(odds))
        base, active = self.base, self.active
        for t in range(self.steps):
            lo, n = base[t], active[t]
            e = laid[lo : lo + n]
            if t == 0:
                forward[lo : lo + n] = e
            else:
                r = forward[base[t - 1] : base[t - 1] + n]
                forward[lo : lo + n] = e * (ot + r * tt) / (oo + r * to)
        for t in range(self.steps - 2, -1, -1):
            n = active[t + 1]
            nxt = base[t + 1]
            e = laid[nxt : nxt + n] * backward[nxt : nxt + n]
            backward[base[t] : base[t] + n] = (to + tt * e) / (oo + ot * e)
        return forward[self.place], backward[self.place]


@dataclass
class Model:
    tables: list[np.ndarray]
    bias: float
    move: np.ndarray

    def odds(self, tokens: Tokens) -> np.ndarray:
        score = np.full(len(tokens.doc), self.bias)
        for table, feature in zip(self.tables, tokens.features, strict=True):
            score += table[feature]
        return np.exp(np.clip(score, -30, 30))

    def marginals(self, tokens: Tokens, n_docs: int) -> np.ndarray:
        chains = Chains(tokens.doc, n_docs)
        forward, backward = chains.ratios(self.odds(tokens), np.exp(self.move))
        both = forward * backward
        return both / (1 + both)


def _beyond_chance(in_toxic: np.ndarray, in_clean: np.ndarray, toxic_share: float) -> np.ndarray:
    """Which units stand in more toxic documents than chance explains, given how many units there
    are to pick from: the probability of as many, bounded by Chernoff, times the number of units."""
    n = in_toxic + in_clean
    share = in_toxic / n
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = np.where(in_clean > 0, in_clean * np.log((1 - share) / (1 - toxic_share)), 0.0)
        apart = np.where(share > toxic_share, in_toxic * np.log(share / toxic_share) + rest, 0.0)
    units = max(1, int((n >= MIN_SUPPORT).sum()))
    return apart >= np.log(units / MAX_CHANCE)


def token_labels(tokens: Tokens, toxic: np.ndarray) -> np.ndarray:
    """T for the tokens of toxic documents whose word or stem marks toxic documents nearly alone.

    Words and stems are taken in the order of how many toxic documents they newly explain; those in
    MIN_SHARE of the toxic documents are taken in any case. With few documents some of many rare
    words stand in toxic ones only by chance; those are left out.
    """
    n_toxic, n_clean = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    n_docs = len(toxic)
    able, gains, places = [], [], []  # for each kind of unit: words, then stems of each length
    for units in (tokens.word, *tokens.stems):
        known, number = np.unique(units, return_inverse=True)
        pair = np.unique(number * n_docs + tokens.doc)
        unit, doc = pair // n_docs, pair % n_docs
        in_toxic = np.bincount(unit[toxic[doc]], minlength=len(known))
        in_clean = np.bincount(unit[~toxic[doc]], minlength=len(known))
        share, clean_share = in_toxic / n_toxic, in_clean / n_clean
        telling = (share >= MIN_PRECISION * (share + clean_share)) & (in_toxic >= MIN_SUPPORT)
        telling &= _beyond_chance(in_toxic, in_clean, n_toxic / n_docs)
        slot = np.cumsum(telling) - 1 + sum(map(len, able))
        able.append(share[telling] >= MIN_SHARE)
        use = toxic[doc] & telling[unit]
        gains.append((slot[unit[use]], doc[use]))
        places.append(np.where(telling, slot, -1)[number].astype(np.int32))
    chosen = np.concatenate(able)
    unit, of = (np.concatenate([g[i] for g in gains]) for i in (0, 1))
    left = toxic.copy()
    left[of[chosen[unit]]] = False
    while len(unit):
        gain = np.bincount(unit[left[of]], minlength=len(chosen))
        best = int(np.argmax(gain))
        if gain[best] < max(MIN_SUPPORT, MIN_GAIN * n_toxic):
            break
        chosen[best] = True
        left[of[unit == best]] = False
    taken = np.zeros(len(tokens.doc), dtype=bool)
    for place in places:
        hit = place >= 0
        taken[hit] |= chosen[place[hit]]
    return taken & toxic[tokens.doc]


def train(tokens: Tokens, n_docs: int, truth: np.ndarray) -> Model:
    """Maximum likelihood of the token labels, by Adam over all chains at once. The features are
    taken from `tokens`, which is of no use afterwards."""
    sizes = [*[1 << WORD_BITS] * (1 + len(STEMS)), *[1 << NEAR_BITS] * 3]
    last = len(sizes)
    used, slot = [], []
    while tokens.features:
        known, number = np.unique(tokens.features.pop(0), return_inverse=True)
        used.append(known)
        slot.append(number.astype(np.int32))
    params = [np.zeros(len(u)) for u in used] + [np.array([-2.0]), np.zeros(4)]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    chains = Chains(tokens.doc, n_docs)
    same = np.flatnonzero(tokens.doc[1:] == tokens.doc[:-1])
    a, b = truth[same], truth[same + 1]
    seen = np.array([(~a & ~b).sum(), (~a & b).sum(), (a & ~b).sum(), (a & b).sum()], float)
    for step in range(1, STEPS + 1):
        score = np.full(len(truth), float(params[last][0]))
        for p, s in zip(params, slot, strict=False):
            score += p[s]
        odds = np.exp(np.clip(score, -30, 30))
        move = np.exp(params[last + 1])
        forward, backward = chains.ratios(odds, move)
        both = forward * backward
        error = truth - both / (1 + both)
        e, r = (odds * backward)[same + 1], forward[same]
        del score, odds, forward, backward, both
        whole = move[0] + move[1] * e + move[2] * r + move[3] * r * e
        expected = [(w / whole).sum() for w in (move[0], move[1] * e, move[2] * r, move[3] * r * e)]
        del e, r, whole
        grads = [
            np.bincount(s, weights=error, minlength=len(u)) for s, u in zip(slot, used, strict=True)
        ]
        grads += [np.array([error.sum()]), seen - np.array(expected)]
        for i, g in enumerate(grads):
            # words that are frequent get no larger step than rare ones, as the steps are scaled
            g = g - DECAY * len(truth) * 1e-3 * params[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g * g
            scaled = first[i] / (1 - 0.9**step)
            params[i] = params[i] + RATE * scaled / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    tables = [np.zeros(size, dtype=np.float32) for size in sizes]
    for table, u, p in zip(tables, used, params, strict=False):
        table[u] = p
    return Model(tables, float(params[last][0]), params[last + 1])


def in_fold(id_column: str = "doc_id"):
    """Whether labels of a row may be learnt from: crc32 of its id as text, mod 3, is not 1."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 3 != 1


def _shortened(limit: int):
    """Texts beyond `limit` bytes as a sample of their stretches, which begin and end at blanks; the
    sample is that of the least checksums of the stretches, in the order of the text."""

    def sample(text: str) -> str:
        raw = text.encode()
        if len(raw) <= limit:
            return text
        blanks = np.flatnonzero(tk.SPACE[np.frombuffer(raw, dtype=np.uint8)])
        cuts = np.searchsorted(blanks, np.arange(STRETCH_BYTES, len(raw), STRETCH_BYTES))
        cuts = [0, *np.unique(blanks[cuts[cuts < len(blanks)]]).tolist(), len(raw)]
        stretches = [raw[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
        taken, size = [], 0
        for i in sorted(range(len(stretches)), key=lambda i: (zlib.crc32(stretches[i]), i)):
            if size + len(stretches[i]) <= limit:
                taken.append(i)
                size += len(stretches[i])
        return b"".join(stretches[i] for i in sorted(taken)).decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [sample(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), *batch.columns[1:]], batch.schema.names
            )

    return run


def _drawn(texts: DataFrame, kind: int, limit: int) -> list:
    """(text, id) of one label in the order of a hash of the text, up to `limit` bytes."""
    number = F.xxhash64("text")
    some = texts.where(F.col("toxic") == kind).withColumn("number", number)
    first = some.orderBy("number", "text").limit(MAX_FIT_DOCS)
    sizes = first.select("number", F.octet_length("text").alias("size")).collect()
    last, size = None, 0
    for row in sorted(sizes, key=lambda r: r["number"]):
        size += row["size"]
        if size > limit:
            break
        last = row["number"]
    if last is None:
        return []
    return first.where(F.col("number") <= last).select("text", "pick").collect()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_bytes: int = MAX_FIT_BYTES,
) -> Model | None:
    """Fit on labelled documents of the fitting fold; None without labels of both kinds.

    Of the labelled documents that exist, MAX_FIT_DOCS of each label are drawn by a hash of their id.
    Equal texts count once, as that with the smallest id, before anything is sent; at most
    MAX_FIT_DOCS texts and `max_bytes` bytes of each label reach the driver, long texts and short
    ones. Texts that are null or empty teach nothing. Ids that stand for several documents give all
    of them the label.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & in_fold())
    there = docs.select(F.col(id_column).alias("_there")).distinct()
    known = written(known.join(there, F.col("doc_id") == F.col("_there"), "left_semi").select("doc_id", "toxic"))
    chosen = [hash_sample(known.where(F.col("toxic") == kind), "doc_id", MAX_FIT_DOCS) for kind in (0, 1)]
    picked = chosen[0].union(chosen[1]).select(F.col("doc_id").alias("_pick"), "toxic").distinct()
    rows = docs.select(F.col(text_column).alias("text"), F.col(id_column).cast("bigint").alias("_id"))
    met = rows.where(F.length("text") > 0).join(F.broadcast(picked), F.col("_id") == F.col("_pick"))
    short = met.select("text", F.col("_pick").cast("bigint").alias("pick"), F.col("toxic").cast("int").alias("toxic"))
    texts = short.mapInArrow(_shortened(max_bytes // 8), "text string, pick bigint, toxic int")
    once = texts.groupBy("text").agg(F.min(F.struct("pick", "toxic")).alias("least"))
    once = written(once.select("text", "least.pick", "least.toxic"))
    taken = sorted(
        (row["pick"], row["text"], kind) for kind in (0, 1) for row in _drawn(once, kind, max_bytes)
    )
    toxic = np.array([t[2] == 1 for t in taken], dtype=bool)
    if not toxic.any() or toxic.all():
        return None
    n_docs = len(taken)
    tokens = all_tokens([t[1] for t in taken])
    del taken
    truth = token_labels(tokens, toxic)
    tokens.stems.clear()
    return train(tokens, n_docs, truth)


def _spans(texts: tk.Texts, tokens: Tokens, p: np.ndarray) -> list[list[dict]]:
    """For each text the runs of tokens over one half, as character offsets."""
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    hit = np.flatnonzero(p > 0.5)
    if len(hit) == 0:
        return out
    chars = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    new = np.concatenate(([True], (np.diff(hit) > 1) | (np.diff(tokens.doc[hit]) != 0)))
    groups = np.flatnonzero(new)
    for lo, hi in zip(groups, np.append(groups[1:], len(hit)), strict=True):
        i, j = hit[lo], hit[hi - 1]
        doc = int(tokens.doc[i])
        at = chars[texts.offsets[doc]]
        out[doc].append(
            {
                "start": int(chars[tokens.start[i]] - at),
                "end": int(chars[tokens.end[j]] - at),
                "score": float(p[i : j + 1].max()),
            }
        )
    return out


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            score = np.zeros(batch.num_rows)
            spans: list[list[dict]] = []
            for texts in tk.chunks(batch.column(0)):
                if model is None:
                    spans += [[] for _ in range(len(texts))]
                    continue
                tokens = tokens_of(texts)
                p = model.marginals(tokens, len(texts))
                np.maximum.at(score, tokens.doc + texts.first, p)
                spans += _spans(texts, tokens, p)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(score), pa.array(spans, _SPAN)],
                [*batch.schema.names[1:], "_score", "_spans"],
            )

    return run


def tag(docs: DataFrame, model: Model | None, text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns of `carry` (default: all) as c0, c1, ..., the `_score` of every whole text, and
    its `_spans`: character offsets (in code points) and scores of the offending runs.

    Texts without a word (null, empty) score 0. Texts of any length are tagged whole, in one chain.
    Without a model (no labels of both kinds) every score is 0. Repeated rows get equal scores.
    """
    carry = docs.columns if carry is None else carry
    rows = docs.select(
        F.col(text_column).alias("_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    )
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    tail = "_score double, _spans array<struct<start:int,end:int,score:double>>"
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scored(shared), ", ".join([*kinds, tail]))
