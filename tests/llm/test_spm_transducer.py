import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from incident_stream.llm import spm_transducer
from incident_stream.llm import textkernel as tk
from incident_stream.llm.queries import op3_sentencepiece
from incident_stream.llm.spm_transducer import Transducer, _fields, code
from tests.llm.conftest import SMALL, documents, prose, rows_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return Transducer(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts():
    rng = random.Random(3)
    alphabet = "aaeeinrst  \n\t.,'-019ABCé中日本語ßñ😀▁​́\x00\x7f"
    for n in range(400):
        yield "".join(rng.choice(alphabet) for _ in range(n % 60))
    yield " " * 100
    yield "a" * 3000
    yield "▁▁ ▁a▁" * 20
    yield "".join(chr(c) for c in range(32, 3000))
    yield prose(1, 3000)


def test_same_ids_as_the_library(pair):
    ours, theirs = pair
    for text in random_texts():
        assert ours.encode(text).tolist() == theirs.encode(text), repr(text[:80])


def test_decoding_as_the_library(pair):
    ours, theirs = pair
    for text in random_texts():
        ids = theirs.encode(text)
        assert ours.decode(np.array(ids, dtype="<u4")) == theirs.decode(ids)


def test_only_one_path_is_finite(pair):
    ours, _ = pair
    pieces = ours.shortest_path("▁transducers")
    assert "".join(pieces) == "▁transducers"
    assert all(ours.may_meet(a, b) for a, b in zip(["", *pieces], pieces, strict=False))
    assert not ours.may_meet("▁", "t")  # the merges join these two


def test_a_unigram_model_takes_the_path_of_least_weight(pair):
    ours, _ = pair
    other = Transducer.__new__(Transducer)
    other.__dict__.update(ours.__dict__)
    other.kind, other.longest = 1, 3
    other.id_of = {"a": 1, "b": 2, "ab": 3, "bc": 4, "c": 5}
    other.score = {"a": -1.0, "b": -1.0, "ab": -2.5, "bc": -1.2, "c": -1.0}
    assert other.shortest_path("abc") == ["a", "bc"]
    assert other.shortest_path("axc") == ["a", "x", "c"]


def test_query(spark, pair):
    _, theirs = pair
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = op3_sentencepiece(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        ids = theirs.encode(texts[r["doc_id"]] or "")
        assert r["ids"] == ids and r["n_ids"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert r["decoded"] == (texts[r["doc_id"]] or "") and r["round_trip"]


def message(*fields):
    """A serialised message of (number, value): whole numbers and bytes."""

    def number(value):
        out = b""
        while value > 0x7F:
            out, value = out + bytes([value & 0x7F | 0x80]), value >> 7
        return out + bytes([value])

    return b"".join(
        number(n << 3 | 2) + number(len(v)) + v if isinstance(v, bytes) else number(n << 3) + number(v)
        for n, v in fields
    )


def with_normaliser(tmp_path, rule_name, dummy_prefix, single_blanks):
    """The model with the character rules of the library's own normaliser of that name."""
    rules = sentencepiece.SentencePieceNormalizer(rule_name=rule_name).serialized_model_proto()
    spec = dict(_fields(dict(_fields(rules))[3]))
    made = message((1, rule_name.encode()), (2, spec.get(2, b"")), (3, dummy_prefix), (4, single_blanks))
    raw = open(MODEL, "rb").read()
    rest = b"".join(message(f) for f in _fields(raw) if f[0] != 3)
    path = tmp_path / f"{rule_name}{dummy_prefix}{single_blanks}.model"
    path.write_bytes(rest + message((3, made)))
    return str(path)


@pytest.mark.parametrize("rule_name", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("flags", [(1, 1), (0, 0), (1, 0)])
def test_models_with_character_rules(tmp_path, rule_name, flags):
    path = with_normaliser(tmp_path, rule_name, *flags)
    ours, theirs = Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(8)
    alphabet = "aB ①ﾊﾞＡＢ　 \t\n\r…½ﬁÅé가각ᄀ\u0301\u3099ßİ\u200b\ufeff\x0c  "
    texts = ["".join(rng.choice(alphabet) for _ in range(n % 40)) for n in range(500)]
    texts += [*random_texts(), "  two  blanks  ", " "]
    for text in texts:
        assert ours.encode(text).tolist() == theirs.encode(text), repr(text[:80])
        ids = np.array(theirs.encode(text), dtype="<u4")
        assert ours.decode(ids) == theirs.decode(ids.tolist())


def test_scripts_without_blanks(pair, monkeypatch):
    """Long runs of characters, each text once: what is remembered stays within its bytes."""
    ours, theirs = pair
    rng = random.Random(4)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(400)) for _ in range(200)]
    texts += ["".join(rng.choice("あいうえおアイウ") for _ in range(3000)), "가나다라" * 500]
    monkeypatch.setattr(spm_transducer, "CACHE_BYTES", 20_000)
    for text in texts:
        assert ours.encode(text).tolist() == theirs.encode(text)
        assert ours.known_bytes <= 20_000 + 8 * 4 * spm_transducer.LONGEST_KEPT + 200
    held = [*ours.known.items(), *ours.known_before.items()]
    assert sum(len(k) + len(v) for k, v in held) <= 2 * 20_000
    assert max(len(k) for k, _ in held) <= 4 * spm_transducer.LONGEST_KEPT


def test_units_by_lookup_and_by_table_are_the_same(pair):
    ours, _ = pair
    other = Transducer.__new__(Transducer)
    other.__dict__.update(ours.__dict__)
    other.table = None
    texts = pa.array(list(random_texts()))
    for chunk in tk.chunks(texts, 5000):
        symbols, ends = ours.normalised(chunk)
        assert (ours.units(symbols, ends) == other.units(symbols, ends)).all()


def test_edges(spark, pair):
    _, theirs = pair
    texts = [None, "", " ", "x", "x", "\n", prose(2, 20_000)]
    docs = documents(spark, texts).withColumnRenamed("lang", "n_ids").withColumnRenamed("source", "_text")
    found = {r["doc_id"]: r for r in code(docs, MODEL).collect()}
    for i, text in enumerate(texts):
        assert found[i]["ids"] == theirs.encode(text or "")
        assert found[i]["decoded"] == (text or "") and found[i]["round_trip"]
    assert rows_of(code(documents(spark, []), MODEL)) == []
