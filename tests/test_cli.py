import pytest

from incident_stream import cli
from incident_stream.settings import FileStore, JdbcStore

HEADER = "ID,Date,IUCR,Arrest,Domestic,District,ComArea,Latitude,Longitude"


def args_of(*words):
    return cli.build_parser().parse_args(words)


PROCESS = ["process", "--static-file", "f", "--checkpoint-location", "c", "--delay", "A"]


def test_defaults():
    args = args_of(*PROCESS)
    assert (args.window_days, args.threshold, args.sink_mode) == (7, 40.0, "upsert")


@pytest.mark.parametrize("missing", ["--static-file", "--checkpoint-location", "--delay"])
def test_required(missing):
    words = list(PROCESS)
    at = words.index(missing)
    del words[at : at + 2]
    with pytest.raises(SystemExit):
        args_of(*words)


def test_delay_is_a_or_c():
    with pytest.raises(SystemExit):
        args_of(*PROCESS[:-1], "B")


def test_sources():
    kafka = cli.source_of(
        args_of(
            *PROCESS, "--bootstrap-servers", "h:1", "--source-option", "maxOffsetsPerTrigger=9"
        )
    )
    assert kafka.format == "kafka" and kafka.options["subscribe"] == cli.DEFAULT_TOPIC
    assert kafka.options["maxOffsetsPerTrigger"] == "9"
    assert cli.source_of(args_of(*PROCESS, "--lines-dir", "d")).path == "d"
    with pytest.raises(SystemExit):
        cli.source_of(args_of(*PROCESS))


def test_triggers():
    assert cli.trigger_of(args_of(*PROCESS)) is None
    assert cli.trigger_of(args_of(*PROCESS, "--available-now")) == {"availableNow": True}
    paced = args_of(*PROCESS, "--processing-time", "1 minute")
    assert cli.trigger_of(paced) == {"processingTime": "1 minute"}


def test_stores(monkeypatch):
    monkeypatch.setenv("INCIDENT_DB_USER", "someone")
    monkeypatch.delenv("INCIDENT_DB_PASSWORD", raising=False)
    assert cli.store_of(args_of(*PROCESS, "--results-dir", "r")) == FileStore("r")
    url = "jdbc:postgresql://h/d"
    assert cli.store_of(args_of(*PROCESS, "--jdbc-url", url)) == JdbcStore(url, {"user": "someone"})
    with pytest.raises(SystemExit):
        cli.store_of(args_of(*PROCESS))


def test_results_need_a_folder_and_no_number_of_rows():
    with pytest.raises(SystemExit):
        args_of("results", "--results-dir", "r")
    args = args_of("results", "--results-dir", "r", "--out-dir", "o", "--connections", "1")
    assert args.rows is None and args.connections == 1
    assert args_of(*PROCESS, "--results", "anomalies").results == ["anomalies"]
    assert args_of(*PROCESS).results == ["aggregates", "anomalies"] and not args_of(*PROCESS).unique_codes


def test_publish_process_show(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        f"{HEADER}\n1,2024-01-02,0110,True,False,9.0,,,\n2,2024-03-02,0486,True,False,9.0,,,\n"
        + "".join(f"3,2024-03-02,0486,True,False,{100 + i},,,\n" for i in range(28))
    )
    (tmp_path / "codes.csv").write_text(
        "IUCR,PRIMARY DESCRIPTION,INDEX CODE\n0110,HOMICIDE,I\n0486,BATTERY,N\n"
    )
    lines, results = str(tmp_path / "lines"), str(tmp_path / "results")
    cli.main(["publish", "--in-dir", str(tmp_path / "in"), "--lines-dir", lines])
    cli.main(
        [
            "process",
            "--lines-dir",
            lines,
            "--static-file",
            str(tmp_path / "codes.csv"),
            "--checkpoint-location",
            str(tmp_path / "checkpoints"),
            "--results-dir",
            results,
            "--delay",
            "A",
            "-D",
            "2",
            "-P",
            "50",
            "--state-partitions",
            "2",
            "--available-now",
        ]
    )
    cli.main(["fold", "--results-dir", results, "--delay", "A"])
    out = str(tmp_path / "out")
    cli.main(["results", "--results-dir", results, "--delay", "A", "--out-dir", out, "--rows", "5"])
    shown = capsys.readouterr().out
    for table, rows in (("crime_aggregates", 30), ("crime_anomalies", 2)):
        assert spark.read.csv(f"{out}/{table}", header=True).count() == rows
    assert "crime" in shown and "100.0" in shown  # the preview
    counts = spark.read.csv(f"{out}/crime_aggregates", header=True).collect()
    assert {r["category"] for r in counts} == {"HOMICIDE", "BATTERY"}
    assert {r["year_month"] for r in counts} == {"2024-01", "2024-03"}
