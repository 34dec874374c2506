import os
import subprocess
import sys

import pytest
from pyspark.errors import AnalysisException

from incident_stream.operators.parse import parse_records
from incident_stream.settings import RecordSource
from incident_stream.sources import publish
from incident_stream.sources.publish import Manifest, file_lines, publish_lines, publish_new_files
from incident_stream.sources.records import read_record_stream

HEADER = "ID,Date,IUCR,Arrest,Domestic,District,ComArea,Latitude,Longitude"


def lines_of(spark, folder, **options):
    return sorted(row["value"] for row in file_lines(spark, str(folder), **options).collect())


def test_first_line_of_each_file_is_dropped(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n1,a\n2,a\n")
    (tmp_path / "b.csv").write_text("another header\n3,b\n")
    assert lines_of(spark, tmp_path) == ["1,a", "2,a", "3,b"]


def test_position_decides_and_not_the_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{HEADER}\n1,a\n{HEADER}\n")
    (tmp_path / "b.csv").write_text(f"1,a\n{HEADER}\n")
    assert lines_of(spark, tmp_path) == sorted([HEADER, "1,a", HEADER, HEADER])


def test_blank_lines_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n\n1,a\n\n\n")
    assert lines_of(spark, tmp_path) == ["", "", "", "1,a"]


def test_a_blank_first_line_is_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n1,a\n")
    assert lines_of(spark, tmp_path) == ["1,a"]


def test_lines_are_not_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f'{HEADER}\n1,"two\nlines"\n')
    assert lines_of(spark, tmp_path) == ['1,"two', 'lines"']


def test_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"h\r\n1\r\n2\n3")
    assert lines_of(spark, tmp_path) == ["1", "2", "3"]


def test_only_csv_files_of_the_folder_itself(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n1\n")
    (tmp_path / "a.txt").write_text("h\n2\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("h\n")
    assert lines_of(spark, tmp_path) == ["1"]


def test_sub_folders_do_no_harm(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n1\n")
    (tmp_path / "x=1").mkdir()
    (tmp_path / "x=1" / "b.csv").write_text("h\n2\n")
    (tmp_path / ".hidden.csv").write_text("h\n3\n")
    assert lines_of(spark, tmp_path) == ["1"]


@pytest.mark.parametrize("on_error", ["fail", "skip"])
def test_names_that_would_be_passed_over_are_an_error(spark, tmp_path, on_error):
    (tmp_path / "a.csv").write_text("h\n1\n")
    (tmp_path / "_b.csv").write_text("h\n2\n")
    with pytest.raises(ValueError, match="_b.csv"):
        file_lines(spark, str(tmp_path), on_error)
    (tmp_path / "_b.csv").rename(tmp_path / "b.txt")
    (tmp_path / "y.csv").mkdir()
    with pytest.raises(ValueError, match="y.csv"):
        publish_lines(spark, str(tmp_path), RecordSource.text(str(tmp_path / "out")), on_error)
    assert not (tmp_path / "out").exists()


def test_a_folder_without_csv_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("h\n1\n")
    assert lines_of(spark, tmp_path) == []


def test_missing_folder(spark, tmp_path):
    with pytest.raises(AnalysisException):
        file_lines(spark, str(tmp_path / "nowhere"))


def test_on_error_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        file_lines(spark, str(tmp_path), on_error="ignore")


def test_a_file_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\n1\n")
    (tmp_path / "b.csv").write_text("h\n2\n")
    strict = file_lines(spark, str(tmp_path))
    lenient = file_lines(spark, str(tmp_path), on_error="skip")
    (tmp_path / "b.csv").unlink()
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        strict.collect()
    assert [row["value"] for row in lenient.collect()] == ["1"]


@pytest.mark.parametrize("block", [64, 1000, 10_000_000])
@pytest.mark.parametrize("batch_rows", [1, 7, 10_000])
def test_blocks_batches_and_packed_files(spark, tmp_path, block, batch_rows):
    """Files cut into many blocks, several files in one task, and Arrow batches of any size."""
    wanted = []
    for f in range(5):
        body = [f"{f},{i}" for i in range(60 * f)]
        wanted += body
        (tmp_path / f"{f}.csv").write_text("\n".join([HEADER, *body]) + "\n")
    settings = {
        "spark.sql.files.maxPartitionBytes": block,
        "spark.sql.files.openCostInBytes": 1,
        "spark.sql.files.minPartitionNum": 1,
        "spark.sql.execution.arrow.maxRecordsPerBatch": batch_rows,
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        assert lines_of(spark, tmp_path) == sorted(wanted)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_workers_need_not_have_the_package(tmp_path):
    """A session that is started elsewhere and finds the package on the driver's path only."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("h\n1\n2\n")
    script = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession\n"
        "from incident_stream.sources.publish import file_lines\n"
        "spark = SparkSession.builder.master('local[2]')"
        ".config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('lines', file_lines(spark, sys.argv[2]).count())\n"
    )
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, "-c", script, repo, str(tmp_path / "in")],
        cwd=tmp_path,
        capture_output=True,
        text=True,
        timeout=120,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"},
    )
    assert "lines 2" in done.stdout, done.stderr[-2000:]


def test_published_lines_can_be_read_and_streamed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(f"{HEADER}\n1,2001-01-02,0110,True,False,9.0,,,\n\n")
    target = RecordSource.text(str(tmp_path / "lines"))
    publish_lines(spark, str(tmp_path / "in"), target)
    publish_lines(spark, str(tmp_path / "in"), target)  # a second run adds the lines again
    read = parse_records(read_record_stream(spark, target, streaming=False))
    assert read.count() == 4 and read.where("IUCR = '110'").count() == 2
    stream = read_record_stream(spark, target)
    assert stream.isStreaming and stream.columns == ["csv_line"]


class Writer:
    def __init__(self):
        self.noted = {}

    def format(self, name):
        self.noted["format"] = name
        return self

    def options(self, **options):
        self.noted.update(options)
        return self

    def option(self, name, value):
        self.noted[name] = value
        return self

    def load(self, *path):
        self.noted["path"] = path
        return self

    def selectExpr(self, text):
        self.noted["select"] = text
        return self

    def save(self):
        self.noted["saved"] = True


def test_kafka_source_options():
    """The connector is not installed here, so only what it is asked for can be checked."""

    class Session:
        readStream = Writer()
        read = Writer()

    source = RecordSource.kafka("h:9092", "lines", maxOffsetsPerTrigger="1000")
    read_record_stream(Session, source)
    assert Session.readStream.noted == {
        "format": "kafka",
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "lines",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "path": (),
        "select": "CAST(value AS STRING) AS csv_line",
    }
    read_record_stream(Session, source, streaming=False)
    assert Session.read.noted["format"] == "kafka"


def test_kafka_sink_options(monkeypatch):
    from incident_stream.sources import publish

    class Lines:
        write = Writer()

    monkeypatch.setattr(publish, "file_lines", lambda *args: Lines)
    publish_lines(None, "in", RecordSource.kafka("h:9092", "lines"))
    assert Lines.write.noted == {
        "format": "kafka",
        "kafka.bootstrap.servers": "h:9092",
        "topic": "lines",
        "saved": True,
    }


def test_binary_values_become_text(spark):
    frame = spark.createDataFrame([(b"1,2001-01-02,0110",)], "value binary")
    lines = frame.selectExpr("CAST(value AS STRING) AS csv_line")
    assert parse_records(lines).first()["IUCR"] == "110"


# --- manifest --------------------------------------------------------------------------------------


@pytest.fixture
def job(spark, tmp_path):
    """A folder of files, and a publishing of it with a manifest, file by file."""
    (tmp_path / "in").mkdir()

    class Job:
        folder = tmp_path / "in"

        def add(self, name, *lines):
            (self.folder / name).write_text("\n".join([HEADER, *lines]) + "\n")

        def publish(self, **options):
            sink, manifest = RecordSource.text(str(tmp_path / "out")), str(tmp_path / "manifest")
            return publish_new_files(spark, str(self.folder), sink, manifest, **options)

        def sent(self):
            return sorted(r["value"] for r in spark.read.text(str(tmp_path / "out")).collect())

        def noted(self):
            return sorted(f.name for f in Manifest(spark, str(tmp_path / "manifest")).known())

    return Job()


def test_a_second_publishing_sends_what_is_new(job):
    job.add("a.csv", "1")
    job.add("b.csv", "2", "3")
    assert job.publish() == 2 and job.publish() == 0
    assert job.sent() == ["1", "2", "3"]
    job.add("c.csv", "4")
    assert job.publish() == 1
    assert job.sent() == ["1", "2", "3", "4"] and job.noted() == ["a.csv", "b.csv", "c.csv"]


def test_a_publishing_that_failed_goes_on(job, monkeypatch):
    for number in range(4):
        job.add(f"{number}.csv", f"{number}")
    steps, send = [], publish._send

    def fail_at_the_second(lines, sink):
        steps.append(lines)
        if len(steps) == 2:
            raise OSError("gone")
        send(lines, sink)

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_send", fail_at_the_second)
        with pytest.raises(OSError, match="gone"):
            job.publish(step_bytes=1)
    assert job.sent() == ["0"] and job.noted() == ["0.csv"]
    assert job.publish(step_bytes=1) == 3
    assert job.sent() == ["0", "1", "2", "3"]


def test_a_file_that_has_changed_is_sent_again(job):
    job.add("a.csv", "1")
    job.publish()
    job.add("a.csv", "1", "2")
    assert job.publish() == 1
    assert job.sent() == ["1", "1", "2"]


def test_steps_are_bounded_in_bytes_and_ordered_by_name(spark, job, monkeypatch):
    for name in ("c", "a", "d", "b"):
        job.add(f"{name}.csv", name * 100)
    steps, real = [], publish.file_lines
    monkeypatch.setattr(
        publish, "file_lines", lambda s, d, e, names: steps.append(names) or real(s, d, e, names)
    )
    job.publish(step_bytes=300)
    assert steps == [["a.csv", "b.csv"], ["c.csv", "d.csv"]]
    assert job.sent() == [c * 100 for c in "abcd"]


def test_names_with_signs_of_a_pattern(job):
    for name in ("a[1].csv", "b{2}.csv", "c*.csv", "d?.csv", "e f.csv", "é.csv"):
        job.add(name, name)
    job.add("c1.csv", "other")
    assert job.publish(step_bytes=1) == 7
    assert job.sent() == sorted(["a[1].csv", "b{2}.csv", "c*.csv", "d?.csv", "e f.csv", "é.csv", "other"])


def test_a_manifest_of_an_empty_folder(job):
    assert job.publish() == 0 and job.noted() == []
