"""SentencePiece coding as a shortest path through a weighted transducer.

The transducer of a model has three parts. The normaliser rewrites the text: the model's table of
character rules is an automaton whose longest match at each place is replaced, then a space is put
in front and every space becomes the model's blank symbol. The piece part reads a run of symbols and
writes a piece; the fallback part reads a symbol of no piece and writes its UTF-8 bytes as byte
pieces. Composed with an input, the parts give a graph over its positions, with one arc for every
piece that stands there, and the coding is its shortest path in the tropical semiring: weights add
along a path, and the least sum wins.

No arc reaches across two symbols that stand side by side in no piece, so the shortest path of a
text is made of those of its units, the runs between such places. Only the different units of a
chunk of texts are composed.

Unigram models weigh a piece by its negated score. In a model of merges the pieces that may follow
each other are restricted: two neighbours are allowed if the merges turn their joined text into just
these two. That is the acceptor which the transducer is composed with; any other transition has an
infinite weight. A sequence in which every two neighbours are allowed is the coding of the whole:
the first merge across a border would also be made in the two pieces alone. So one path has a
finite weight, and a state is a position with the piece that ends there.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_stream.llm import textkernel as tk

BLANK = "▁"
UNIGRAM, MERGES = 1, 2
# A worker remembers coded units in two generations of so many bytes, units of up to so many symbols.
CACHE_BYTES = 160 << 20
ENTRY_BYTES = 200
LONGEST_KEPT = 256
CACHE_PAIRS = 2_000_000
CHUNK_BYTES = 1 << 20
# Side by side symbols are looked up in a table, of models with up to so many different symbols.
TABLE_SYMBOLS = 4096
SPACE, MARK = 0x20, 0x2581
INFINITE = float("inf")


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) pairs of one serialised message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(raw):
        key, at = number(at)
        kind = key & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


def character_rules(table: bytes) -> dict[str, str]:
    """What a model's table of character rules replaces, and by what.

    The table is a trie over UTF-8 in two arrays in one: a node holds where its children begin, and
    a child lies there, moved by its byte, if it carries that byte as its label; a leaf gives the
    place of a text in the pool that follows the trie.
    """
    if not table:
        return {}
    size = struct.unpack("<I", table[:4])[0]
    units = np.frombuffer(table[4 : 4 + size], dtype="<u4").astype(np.int64)
    pool = table[4 + size :]
    begins = (units >> 10) << ((units & (1 << 9)) >> 6)
    leaf, label = (units >> 8) & 1 == 1, units & ((1 << 31) | 0xFF)
    rules: dict[str, str] = {}
    every = np.arange(1, 256)
    waiting = [(int(begins[0]), b"")]
    while waiting:
        at, key = waiting.pop()
        children = at ^ every
        inside = children < len(units)
        found = every[inside][label[children[inside]] == every[inside]]
        for byte in found.tolist():
            node = at ^ byte
            below = node ^ int(begins[node])
            longer = key + bytes([byte])
            if leaf[node]:
                place = int(units[below]) & ((1 << 31) - 1)
                rules[longer.decode()] = pool[place : pool.index(b"\0", place)].decode()
            waiting.append((below, longer))
    return rules


class Transducer:
    """Compiled from a model file: normaliser, pieces, byte fallback, and which pieces may meet."""

    def __init__(self, model_file: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.kind, self.dummy_prefix, self.single_blanks = UNIGRAM, True, True
        rules: dict[str, str] = {}
        # Field numbers of the public model format.
        for field, value in _fields(model.serialized_model_proto()):
            if field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                spec = dict(_fields(value))
                rules = character_rules(spec.get(2, b""))
                self.dummy_prefix = bool(spec.get(3, 1))
                self.single_blanks = bool(spec.get(4, 1))
        if self.kind not in (UNIGRAM, MERGES):
            raise ValueError("only unigram models and models of merges are supported")
        n = model.get_piece_size()
        self.unknown = model.unk_id()
        self.bytes = {
            int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)
        }
        plain = [
            i for i in range(n)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.id_of = {model.id_to_piece(i): i for i in plain}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.fallback_weight = 10.0 - min(self.score.values(), default=0.0)
        # the bytes that each id stands for; ids that stand for nothing give none
        self.text_of = [b""] * n
        for piece, i in self.id_of.items():
            self.text_of[i] = piece.replace(BLANK, " ").encode()
        for byte, i in self.bytes.items():
            self.text_of[i] = bytes([byte])
        self.text_of[self.unknown] = " ⁇ ".encode()
        self.rules = None
        if rules:
            self.rules = ahocorasick.Automaton()
            for text, out in rules.items():
                self.rules.add_word(text, (len(text), out))
            self.rules.make_automaton()
        # which symbols stand side by side in a piece
        pairs = {pair for piece in self.id_of for pair in zip(piece, piece[1:], strict=False)}
        symbols = sorted({ord(c) for pair in pairs for c in pair})
        self.symbol = np.zeros(0x110000, dtype=np.int32)
        self.symbol[symbols] = np.arange(1, len(symbols) + 1)
        self.width = len(symbols) + 1
        codes = [int(self.symbol[ord(a)]) * self.width + int(self.symbol[ord(b)]) for a, b in pairs]
        self.pairs = np.unique(np.array(codes, dtype=np.int64))
        self.table = None
        if self.width <= TABLE_SYMBOLS:
            self.table = np.zeros(self.width * self.width, dtype=bool)
            self.table[self.pairs] = True
        # without byte pieces, neighbours in no piece become one unknown id and stay together
        self.lone = np.ones(0x110000, dtype=bool)
        self.lone[[ord(c) for c in set("".join(self.id_of))]] = False
        # what has been worked out, in two generations: the older one goes when the newer is full
        self.allowed: dict[tuple[str, str], bool] = {}
        self.known: dict[bytes, bytes] = {}
        self.known_before: dict[bytes, bytes] = {}
        self.known_bytes = 0
        # the bytes that ids stand for, one after the other
        self.text_length = np.array([len(t) for t in self.text_of], dtype=np.int64)
        self.text_first = np.cumsum(self.text_length) - self.text_length
        self.text_bytes = np.frombuffer(b"".join(self.text_of), dtype=np.uint8)

    @property
    def automaton(self) -> ahocorasick.Automaton:
        """The part of the pieces: run over symbols, it names every piece that ends at each, with
        its length and the weight of its arc. Made once for a set of pieces."""
        made = self.__dict__.get("_made")
        if made is None or made[0] is not self.id_of:
            found = ahocorasick.Automaton()
            for piece in self.id_of:
                arc = 1.0 if self.kind == MERGES else -self.score[piece]
                found.add_word(piece, (piece, len(piece), arc))
            found.make_automaton()
            made = self._made = (self.id_of, found)
        return made[1]

    def arcs(self, symbols: str) -> Iterable[tuple[int, tuple[str, int, float]]]:
        """(last symbol, (piece, length, weight)) of the composition with an input, by their ends.
        A symbol that is no piece has an arc of its own, that of the fallback."""
        found = self.automaton.iter(symbols) if self.id_of else []
        lone = set(symbols).difference(self.id_of)
        if lone:
            arc = 1.0 if self.kind == MERGES else self.fallback_weight
            rest = [(i, (c, 1, arc)) for i, c in enumerate(symbols) if c in lone]
            found = heapq.merge(found, rest, key=itemgetter(0))
        return found

    # --- normaliser ---------------------------------------------------------------------------

    def rewritten(self, text: str) -> str:
        """The character rules, applied from left to right, the longest that fits at each place."""
        out, at = [], 0
        for end, (size, by) in self.rules.iter_long(text):
            out += [text[at : end + 1 - size], by]
            at = end + 1
        return "".join([*out, text[at:]])

    def normalised(self, texts: tk.Texts) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all texts after normalising, and where each text's symbols end."""
        raw = texts.data.tobytes()
        if self.rules is not None:
            parts = [self.rewritten(texts.text(i).decode()) for i in range(len(texts))]
            lengths = np.array([len(p) for p in parts], dtype=np.int64)
            raw = "".join(parts).encode()
        else:
            firsts = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
            lengths = np.diff(firsts[texts.offsets])
        symbols = np.frombuffer(raw.decode().encode("utf-32-le"), dtype="<u4").astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), lengths)
        if self.single_blanks and len(symbols):
            blank = symbols == SPACE
            new = np.concatenate(([True], doc[1:] != doc[:-1]))
            again = np.concatenate(([False], blank[:-1])) | new
            stay = ~(blank & again)
            symbols, doc = symbols[stay], doc[stay]
            # at the end of a text also blank symbols that stood in it go
            ink = np.full(len(texts), -1, dtype=np.int64)
            inked = np.flatnonzero((symbols != SPACE) & (symbols != MARK))
            ink[doc[inked]] = inked
            stay = np.arange(len(symbols)) <= ink[doc]
            symbols, doc = symbols[stay], doc[stay]
        symbols[symbols == SPACE] = MARK
        lengths = np.bincount(doc, minlength=len(texts))
        if self.dummy_prefix:
            # a text that the rules leave nothing of has one as well
            full = np.flatnonzero(lengths if self.single_blanks else np.diff(texts.offsets))
            symbols = np.insert(symbols, (np.cumsum(lengths) - lengths)[full], MARK)
            lengths[full] += 1
        return symbols, np.cumsum(lengths)

    def units(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where the units start: at the texts' starts, and between symbols that no piece joins."""
        cut = np.ones(len(symbols), dtype=bool)
        if len(symbols) > 1:
            code = self.symbol[symbols]
            pair = code[:-1].astype(np.int64) * self.width + code[1:]
            if self.table is not None:
                joined = self.table[pair]
            else:
                place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
                joined = self.pairs[place] == pair if len(self.pairs) else np.zeros(len(pair), bool)
            if not self.bytes:
                lone = self.lone[symbols]
                joined = joined | (lone[:-1] & lone[1:])
            cut[1:] = ~joined
            cut[ends[:-1][ends[:-1] < len(symbols)]] = True
        return np.flatnonzero(cut)

    # --- which pieces may meet ------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The result of the merges: of all neighbours whose joined text is a piece, those with the
        best score become one, the leftmost first, until none is left."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (both := parts[i] + parts[j]) in self.score:
                heapq.heappush(heap, (-self.score[both], i, j, both))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def may_meet(self, left: str, right: str) -> bool:
        """Weight of the transition: 0 if true, infinite if not. `left` is empty at the start. Notes
        what it finds in `allowed`."""
        if len(self.allowed) >= CACHE_PAIRS:
            self.allowed = {}
        wanted = [left, right] if left else [right]
        found = self.allowed[left, right] = self.merged(left + right) == wanted
        return found

    # --- shortest path ----------------------------------------------------------------------------

    def shortest_path(self, symbols: str) -> list[str]:
        """The pieces, and single symbols of no piece, on the path of least weight."""
        n = len(symbols)
        if n == 1:
            return [symbols]
        weight = [0.0] + [INFINITE] * n
        last: list[str] = [""] * (n + 1)
        if self.kind == MERGES:
            allowed = self.allowed
            for end, (piece, size, arc) in self.arcs(symbols):
                end += 1
                total = weight[end - size] + arc
                if total < weight[end]:
                    left = last[end - size]
                    meets = allowed.get((left, piece))
                    if meets is None:
                        meets = self.may_meet(left, piece)
                        allowed = self.allowed
                    if meets:
                        weight[end], last[end] = total, piece
        else:
            for end, (piece, size, arc) in self.arcs(symbols):
                end += 1
                total = weight[end - size] + arc
                if total < weight[end]:
                    weight[end], last[end] = total, piece
        path = []
        while n:
            path.append(last[n])
            n -= len(last[n])
        return path[::-1]

    def ids_of(self, pieces: list[str]) -> list[int]:
        """Byte fallback: a symbol of no piece becomes the pieces of its bytes; without such
        pieces, a run of them becomes one unknown id."""
        try:
            return [self.id_of[piece] for piece in pieces]
        except KeyError:  # a symbol of no piece
            pass
        out: list[int] = []
        for piece in pieces:
            if piece in self.id_of:
                out.append(self.id_of[piece])
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    # --- whole texts --------------------------------------------------------------------------------

    def _unit(self, unit: bytes) -> bytes:
        """The ids of a unit, which comes in UTF-32, from the older generation or worked out."""
        found = self.known_before.get(unit)
        if found is None:
            ids = self.ids_of(self.shortest_path(unit.decode("utf-32-le")))
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(unit) <= 4 * LONGEST_KEPT:
            if self.known_bytes >= CACHE_BYTES:
                self.known_before, self.known, self.known_bytes = self.known, {}, 0
            self.known[unit] = found
            self.known_bytes += len(unit) + len(found) + ENTRY_BYTES
        return found

    def _coded(self, units: list[bytes]) -> list[bytes]:
        coded = list(map(self.known.get, units))
        for i in [i for i, found in enumerate(coded) if found is None]:
            coded[i] = self._unit(units[i])
        return coded

    def encode_chunk(self, texts: tk.Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids end."""
        symbols, ends = self.normalised(texts)
        starts = self.units(symbols, ends)
        if len(starts) == 0:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        raw = tk.Texts(0, symbols.astype("<u4").view(np.uint8), 4 * np.concatenate(([0], ends)))
        stops = np.append(starts[1:], len(symbols))
        doc = np.searchsorted(ends, starts, "right")
        number, values = tk.span_classes(raw, tk.Spans(4 * starts, 4 * stops, doc))
        coded = self._coded(values.to_pylist())
        length = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        flat = np.frombuffer(b"".join(coded), dtype="<u4")
        ids = flat[tk.expand((np.cumsum(length) - length)[number], length[number])]
        per_text = np.bincount(doc, weights=length[number], minlength=len(texts))
        return ids, np.cumsum(per_text).astype(np.int64)

    def encode(self, text: str) -> np.ndarray:
        (texts,) = tk.chunks(pa.array([text]))
        return self.encode_chunk(texts)[0]

    def decode_chunk(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts that runs of ids stand for."""
        length = self.text_length[ids]
        data = self.text_bytes[tk.expand(self.text_first[ids], length)].tobytes()
        stops = np.concatenate(([0], np.cumsum(length)))[ends].tolist()
        out = []
        firsts = [0, *ends[:-1].tolist()]
        for first, last, lo, hi in zip(firsts, ends.tolist(), [0, *stops[:-1]], stops, strict=True):
            # the blank of the prefix goes; without extra blanks, every piece at the front loses one
            for i in ids[first:last].tolist() if self.dummy_prefix or self.single_blanks else ():
                begins = self.text_of[i][:1] == b" "
                lo += begins
                if not (self.single_blanks and begins and len(self.text_of[i]) == 1):
                    break
            out.append(data[lo:hi].decode("utf-8", "replace"))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_chunk(ids, np.array([len(ids)]))[0]


_compiled: dict[str, Transducer] = {}


def _coded(model_file: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = _compiled.get(model_file)
        if transducer is None:  # a worker keeps it for its next tasks
            transducer = _compiled[model_file] = Transducer(model_file)
        for batch in batches:
            for texts in tk.chunks(batch.column(0), CHUNK_BYTES):
                ids, ends = transducer.encode_chunk(texts)
                decoded = transducer.decode_chunk(ids, ends)
                firsts = [0, *ends[:-1].tolist()]
                crc = [zlib.crc32(ids[lo:hi].tobytes()) for lo, hi in zip(firsts, ends.tolist(), strict=True)]
                rows = batch.slice(texts.first, len(texts))
                same = pc.equal(pc.fill_null(rows.column(0), ""), pa.array(decoded, rows.column(0).type))
                columns = [pa.array(np.diff(ends, prepend=0)), pa.array(crc, pa.int64()), same]
                names = ["_n", "_crc", "_same"]
                if with_ids:
                    offsets = pa.array([0, *ends.tolist()], pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                    columns += [lists, pa.array(decoded, pa.string())]
                    names += ["_ids", "_decoded"]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], *columns], [*batch.schema.names[1:], *names]
                )

    return run


def code(
    docs: DataFrame,
    model_file: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """The id column as doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit ids) and
    round_trip (the decoded ids are the text), and with `with_ids` also ids and decoded.

    Whole texts of any length are coded; a null text counts as empty and has no ids. Repeated rows
    give equal rows; an empty table gives none. Other columns are not read. With character rules in
    the model, or single blanks, a decoded text is the normalised one. The model file must be at the
    same place on every executor.
    """
    rows = docs.select(F.col(text_column).alias("_text"), F.col(id_column).alias("doc_id"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, _n bigint, _crc bigint, _same boolean"
    ddl += ", _ids array<int>, _decoded string" if with_ids else ""
    out = rows.mapInArrow(_coded(model_file, with_ids), ddl)
    names = {"_n": "n_ids", "_crc": "ids_crc32", "_same": "round_trip"}
    return out.withColumnsRenamed(names | ({"_ids": "ids", "_decoded": "decoded"} if with_ids else {}))
