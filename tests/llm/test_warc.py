import hashlib
import io
import random
from collections import defaultdict

import pytest
import zstandard

from incident_stream.llm import warc
from incident_stream.llm.queries import op1_warc
from tests.llm.conftest import SMALL, prose, rows_of

PAGES = "page_id bigint, url string, html string"


def expected(pages):
    first = {}
    for page_id, html in pages:
        payload = (html or "").encode()
        if len(payload) >= 100 and page_id is not None:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, html in pages:
        payload = (html or "").encode()
        to = first.get(payload) if len(payload) >= 100 else None
        revisit = to is not None and page_id != to
        out.append(
            (
                page_id,
                len(payload),
                hashlib.sha256(payload).hexdigest(),
                "revisit" if revisit else "response",
                to if revisit else None,
            )
        )
    return sorted(out, key=repr)


def found(df):
    return sorted((r[:5] for r in rows_of(df)), key=repr)


def run(spark, tmp_path, df):
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write_warcs(df, folder)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
    return manifest, warc.read_warcs(manifest, folder, with_payload=True).select(*columns, "payload")


def test_query_against_plain_python(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    result = op1_warc(spark, SMALL)
    assert found(result) == expected(pages)
    assert result.where("not intact").count() == 0


def test_edges(spark, tmp_path):
    long = "x" * 300_000
    rows = [
        (5, "http://a/\r\nX: y", "<p>" + "a" * 200),
        (3, None, "<p>" + "a" * 200),
        (9, "u", "<p>" + "a" * 200),
        (3, None, "<p>" + "a" * 200),
        (1, "u", None),
        (2, "u", ""),
        (4, "u", "short"),
        (6, "u", "short"),
        (7, "u", "é" * 50),
        (8, "u", "é" * 50),
        (10, "u", "é" * 49 + "x"),
        (11, "u", "é" * 49 + "x"),
        (12, "u", long),
        (13, "u", long),
        (None, "u", "null id " * 30),
        (None, "u", "<p>" + "a" * 200),
    ]
    df = spark.createDataFrame(rows, PAGES)
    _, result = run(spark, tmp_path, df.withColumn("digest", df.page_id).withColumn("first", df.url))
    assert found(result) == expected([(r[0], r[2]) for r in rows])
    payloads = {bytes(r["payload"]).decode() for r in result.collect() if r["payload"] is not None}
    assert payloads == {r[2] or "" for r in rows}


def test_empty_table(spark, tmp_path):
    manifest, result = run(spark, tmp_path, spark.createDataFrame([], PAGES))
    assert manifest.count() == 0 and result.count() == 0


def test_archive_has_a_dictionary_and_a_frame_per_record(tmp_path):
    records = [
        warc.record_bytes(i, f"http://h/{i}", prose(i, 300).encode(), "00", None, False)
        for i in range(200)
    ]
    stream = io.BytesIO()
    warc.write_archive(stream, records)
    raw = stream.getvalue()
    assert int.from_bytes(raw[:4], "little") == 0x184D2A5D
    size = int.from_bytes(raw[4:8], "little")
    dictionary = raw[8 : 8 + size]
    assert dictionary[:4] == bytes.fromhex("37a430ec")
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert opener.decompress(raw[8 + size :]) == records[0]  # the first frame alone
    assert list(warc.read_archive(io.BytesIO(raw))) == records
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(raw) - size < plain


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_archives_with_few_records(n):
    rng = random.Random(n)
    records = [rng.randbytes(rng.randrange(1, 50)) for _ in range(n)]
    stream = io.BytesIO()
    warc.write_archive(stream, records)
    assert list(warc.read_archive(io.BytesIO(stream.getvalue()))) == records


def test_a_cut_archive_is_an_error():
    stream = io.BytesIO()
    warc.write_archive(stream, [prose(1, 2000).encode()])
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(stream.getvalue()[:-5])))


def test_many_archives_in_a_task(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://h/{i}", prose(i % 40, 400)) for i in range(120)]
    df = spark.createDataFrame(rows, PAGES).coalesce(1)
    folder = f"file://{tmp_path}/warc"
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    held = warc._written(folder)
    names = defaultdict(int)
    ready = df.selectExpr(
        "page_id", "url", "cast(html as binary) payload", "sha2(html, 256) digest",
        "cast(null as bigint) first", "false revisit",
    )
    manifest = ready.mapInArrow(held, warc._MANIFEST).collect()
    for r in manifest:
        names[r["archive"]] += r["records"]
    assert sum(names.values()) == 120
