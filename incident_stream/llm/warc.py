"""WARC archives whose records are Zstandard frames with a dictionary of their own archive.

A task holds the records of one archive (a bounded number of bytes), builds a dictionary from them,
and writes: a skippable frame with the dictionary, then one frame per record, so that each record
can be read alone, given the head of the file. Records with an equal payload of at least 100 bytes
are stored once; the others are revisit records that refer to it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incident_stream.llm.common import join_hot, written
from incident_stream.settings import new_work_dir

# The skippable frame that holds a dictionary, and the profile of revisits.
SKIPPABLE_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_SHARED_BYTES = 100
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
# The dictionary is built from records spread evenly over the archive, of this many bytes at most.
SAMPLE_BYTES = 32 * DICTIONARY_BYTES
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id, url, payload: bytes, digest: str, first: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, whose length is that of the full payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    target = "".join(c for c in (url or "") if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(first)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Type, ids, digests and lengths of a record, and the payload that it holds itself."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [line[16:] for line in http.split(b"\r\n") if line.startswith(b"Content-Length: ")]
    revisit = fields["WARC-Type"] == "revisit"
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "payload_bytes": int(lengths[0]) if revisit else len(payload),
        "payload_digest": stated if revisit else hashlib.sha256(payload).hexdigest(),
        "record_type": fields["WARC-Type"],
        "refers_to": _page_of(fields["WARC-Refers-To"]) if revisit else None,
        "intact": revisit or hashlib.sha256(payload).hexdigest() == stated,
        "payload": None if revisit else payload,
    }


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from records spread over the archive; the first ones that are asked for if
    the builder finds too little in them, and nothing for an archive with hardly any bytes."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = records[::step]
    size = max(256, min(DICTIONARY_BYTES, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        pass
    try:  # few or short records: pieces of them are more samples
        parts = [r[i : i + 64] for r in samples for i in range(0, len(r), 64)]
        return zstandard.train_dictionary(size, parts, k=32, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archive(stream, records: list[bytes]) -> None:
    raw = build_dictionary(records)
    options = {}
    if raw:
        stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(raw)) + raw)
        options["dict_data"] = zstandard.ZstdCompressionDict(raw)
    packer = zstandard.ZstdCompressor(level=LEVEL, **options)
    for record in records:
        stream.write(packer.compress(record))


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one frame after the other."""
    head = stream.read(8)
    options, held = {}, head
    if len(head) == 8:
        magic, size = struct.unpack("<II", head)
        if magic == SKIPPABLE_MAGIC:
            options["dict_data"] = zstandard.ZstdCompressionDict(stream.read(size))
            held = b""
    opener = zstandard.ZstdDecompressor(**options)
    while True:
        if not held:
            held = stream.read(1 << 20)
            if not held:
                return
        one = opener.decompressobj()
        parts = []
        while not one.eof:
            parts.append(one.decompress(held))
            held = one.unused_data if one.eof else stream.read(1 << 20)
            if not one.eof and not held:
                raise ValueError("an archive ends inside a record")
        yield b"".join(parts)


_MANIFEST = "archive string, records bigint, bytes bigint"


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        held: list[bytes] = []
        size = made = 0

        def flush() -> pa.RecordBatch:
            # the attempt is in the name: what an attempt that failed has left is in no manifest
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.zst"
            with store.open_output_stream(f"{root}/{name}") as stream:
                write_archive(stream, held)
                length = stream.tell()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(held)]), pa.array([length])],
                ["archive", "records", "bytes"],
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                page_id, url, payload, digest, first, revisit = row
                record = record_bytes(page_id, url, payload, digest, first, revisit)
                held.append(record)
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    yield flush()
                    held, size, made = [], 0, made + 1
        if held:
            yield flush()

    return run


def write_warcs(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> DataFrame:
    """Write one record per row to archives in `folder` (shared by all executors) and return the
    manifest: archive, records, bytes. Only archives that it names count.

    The payload is the text in UTF-8, a null counts as empty. Of equal payloads of at least 100
    bytes the rows with the smallest id are responses (null is larger than any id), all others are
    revisits of it; shorter ones are all responses. Repeated rows with that id are responses each.
    An archive closes after 16 MB of records, so a task never holds more than that and one record.
    """
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    shared = F.when(F.octet_length("payload") >= MIN_SHARED_BYTES, F.col("digest"))
    rows = rows.withColumn("shared", shared)
    firsts = written(
        rows.where("shared is not null")
        .groupBy("shared")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    )
    met = join_hot(rows, firsts, "shared", ["first"], spread=["page_id", "digest"])
    revisit = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    ready = met.select("page_id", "url", "payload", "digest", "first", revisit.alias("revisit"))
    return written(ready.mapInArrow(_written(folder), _MANIFEST))


_READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, intact boolean"


def _read(folder: str, with_payload: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[dict] = []
                with store.open_input_stream(f"{root}/{name}") as stream:
                    for raw in read_archive(stream):
                        rows.append(parse_record(raw))
                        if len(rows) == 500:
                            yield _rows(rows, names, kinds)
                            rows = []
                if rows:
                    yield _rows(rows, names, kinds)

    return run


def _rows(rows: list[dict], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def read_warcs(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives that the manifest names. `intact`: the payload has the
    digest that its record states; a revisit holds no payload, its length is that in its head."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = manifest.select("archive").repartition(parts, "archive")
    return names.mapInArrow(_read(folder, with_payload), _READ + (", payload binary" if with_payload else ""))


def new_folder(spark) -> str:
    return f"{new_work_dir(spark)}/warc"
