import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from incident_stream.llm import substring
from incident_stream.llm.queries import op2_substring
from tests.llm.conftest import MIDDLE, WORDS, documents, prose, rows_of


def expected(texts, width=35):
    """(n_words, n_removed, kept words) for each text."""
    words = [re.findall(WORDS, (t or "").encode()) for t in texts]
    counts = Counter(
        tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1)
    )
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), sum(gone), b" ".join(kept).decode()))
    return out


def test_query_against_plain_python(spark):
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
    wanted = {
        (r["doc_id"], n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for r, (n, gone, kept) in zip(rows, expected([r["text"] for r in rows]), strict=True)
    }
    assert set(rows_of(op2_substring(spark, MIDDLE))) == wanted
    assert any(r[2] for r in wanted)


PASSAGE = prose(99, 60, 5000)
TEXTS = [
    None,
    "",
    "   \n\t ",
    prose(1, 34),
    prose(2, 35),
    f"{prose(3, 50)} {PASSAGE} {prose(4, 20)}",
    f"{prose(5, 3)}\n\n{PASSAGE.replace(' ', '  ', 9)}\t{prose(6, 40)}",
    " ".join(["same"] * 100),
    " ".join(["once", *["word"] * 35]),
    f"{prose(7, 35, 9000)} {prose(8, 1, 9000)} {prose(7, 35, 9000)}",
    prose(10, 20_000, 3000),
    "é ü x " * 50,
    "Ä\u0085b " * 36,
]


@pytest.mark.parametrize("bits", [17, 24])
def test_edges(spark, bits, monkeypatch):
    """A narrow sketch overestimates a great deal; the result must not change."""
    monkeypatch.setattr(substring, "ROW_BITS", bits)
    texts = [*TEXTS, TEXTS[10][: 4000], TEXTS[2], TEXTS[3], TEXTS[3]]
    docs = documents(spark, texts).withColumn("n_words", F.lit("mine"))
    found = substring.remove_repeated(docs, carry=["doc_id", "n_words"])
    assert found.columns == ["doc_id", "n_words", "kept_text", "n_words_", "n_removed"]
    got = {r[0]: (r[3], r[4], r[2]) for r in rows_of(found)}
    want = expected(texts)
    for i, text in enumerate(texts):
        n, gone, kept = want[i]
        assert got[i] == (n, gone, kept if text is not None else None), i


def test_repeated_ids_and_rows(spark):
    texts = [(1, prose(1, 50)), (1, prose(1, 50)), (1, prose(2, 50)), (None, prose(3, 50)), (None, prose(4, 50))]
    found = substring.remove_repeated(documents(spark, texts), carry=["doc_id"])
    assert sorted((r[2], r[3]) for r in rows_of(found)) == [(50, 0)] * 3 + [(50, 50)] * 2


def thue_morse(letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(1024))


def test_words_that_mirror_each_other_differ(spark):
    """Polynomials modulo 2 ** 64 agree on these two words, whatever their base."""
    common = " ".join(f"w{i}" for i in range(34))
    texts = [f"{common} {thue_morse('ab')}", f"{common} {thue_morse('ba')}"]
    found = substring.remove_repeated(documents(spark, texts), carry=["doc_id"])
    assert sorted((r[0], r[2], r[3]) for r in rows_of(found)) == [(0, 35, 0), (1, 35, 0)]


def test_rows_without_an_id_are_told_apart_by_their_whole_text(spark):
    """A third text has the passage of the first; the second, which also has no id, has the same
    32-bit hash of Spark as the first and passages that occur once."""
    from pyspark.sql.functions import col, hash

    words = spark.range(300_000).select(F.concat(F.lit("t"), "id", F.lit(" " + prose(50, 34))).alias("t"))
    twins = words.groupBy(hash(col("t")).alias("h")).agg(F.collect_list("t").alias("ts")).where("size(ts) > 1")
    one, two = twins.orderBy("h").first()["ts"][:2]
    texts = [(None, one), (None, two), (5, f"{prose(51, 40)} {one}"), (None, prose(52, 50)), (7, f"{one} {prose(53, 9)}")]
    found = substring.remove_repeated(documents(spark, texts), carry=["doc_id"])
    got = {(r[0], r[2], r[3]) for r in rows_of(found)}
    want = {(i, n, gone) for (i, _), (n, gone, _) in zip(texts, expected([t for _, t in texts]), strict=True)}
    assert got == want


def test_empty_table(spark):
    assert rows_of(substring.remove_repeated(documents(spark, []))) == []


def test_parts_of_a_sketch():
    codes = np.unique(np.random.default_rng(1).integers(0, 1 << 18, 5000)).astype(np.uint32)
    assert (substring._unpacked(substring._packed(codes)) == codes).all()


def test_anchors_of_equal_windows_are_counted_at_each_place():
    """However often a window occurs, its anchor is counted at least as often."""
    import pyarrow as pa

    from incident_stream.llm import textkernel as tk

    texts = ["a b c " * 30, "x " * 50, prose(1, 200, 4), "", "p q", prose(1, 200, 4), prose(2, 90)]
    for width in (1, 2, 3, 5, 35):
        (chunk,) = tk.chunks(pa.array(texts))
        found = substring.Windows(chunk, width)
        counted = Counter(found.anchored().tolist())
        windows = Counter(zip(found.hashes(found.starts)[0].tolist(), found.anchors.tolist(), strict=True))
        assert all(counted[anchor] >= n for (_, anchor), n in windows.items())
        assert len(windows) == len({h for h, _ in windows})
