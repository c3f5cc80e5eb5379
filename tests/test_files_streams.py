import pytest
from pyspark.sql import functions as F

from loomlog import streaming
from loomlog.operators import templates as tpl
from loomlog.operators import websignals as web
from loomlog.options import WebOptions
from loomlog.plans import reports
from loomlog.sources import readers, sinks

SYSLOG = [f"Jan 01 00:00:{i:02d} host prog: message {i}" for i in range(30)]


def test_line_numbers_span_splits_and_count_blank_lines(spark, tmp_path):
    body = "\n".join(f"line {i}" if i % 5 else "" for i in range(1, 2001)) + "\n"
    (tmp_path / "a.log").write_text(body)
    (tmp_path / "b.log").write_text("only\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_text_lines(spark, str(tmp_path), glob="*.log")
        rows = [(r["line_num"], r["value"]) for r in df.filter(F.col("source_file").endswith("a.log")).orderBy("line_num").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == [(i, f"line {i}" if i % 5 else "") for i in range(1, 2001)]


def test_directory_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text("\n".join(SYSLOG))
    (tmp_path / "in" / "b.txt").write_text("2024/01/01 00:00:00 [error] 1#2: *3 open failed\n\n")
    (tmp_path / "in" / "c.out").write_text("no format\n")
    (tmp_path / "in" / "skip.dat").write_text("2024/01/01 00:00:00 [error] 1#2: *3 x\n")
    parsed = readers.parse_directory(spark, str(tmp_path / "in"))
    got = {r["source_file"].rsplit("/", 1)[1]: (r["format"], r["count"]) for r in parsed.groupBy("source_file", "format").count().collect()}
    assert got == {"a.log": ("syslog", 30), "b.txt": ("nginx_error", 1)}
    out = sinks.write_parsed_directory(parsed, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(out).count() == 31


def test_source_choice_and_readers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('LineId,Level,Content\n1,INFO,"a, b"\n2,ERROR,"say ""hi"""\n')
    (tmp_path / "noext").write_text("a,b,c\n1,2,3\n")
    (tmp_path / "plain").write_text("\n".join(SYSLOG))
    (tmp_path / "bad.log").write_text("~~\n")
    kind = lambda n: readers.source_kind(spark, str(tmp_path / n))
    assert (kind("t.csv"), kind("noext"), kind("plain"), kind("bad.log")) == ("csv", "csv", "text", "text")
    rows = readers.read_log(spark, str(tmp_path / "t.csv")).orderBy("LineId").collect()
    assert [r["Content"] for r in rows] == ["a, b", 'say "hi"']
    assert readers.read_log(spark, str(tmp_path / "plain")).filter("parsed").count() == 30
    with pytest.raises(ValueError):
        readers.read_log(spark, str(tmp_path / "bad.log"))
    with pytest.raises(Exception):
        readers.read_log(spark, str(tmp_path / "missing.csv"))


def test_templates_and_structured_files(spark, tmp_path):
    df = spark.createDataFrame([("b <*>",), ("a: <*>",), ("b <*>",)], "template string")
    sinks.write_templates(df, str(tmp_path / "t"))
    assert {(r["id"], r["template"]) for r in readers.read_templates(spark, str(tmp_path / "t")).collect()} == {(1, "a: <*>"), (2, "b <*>")}
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "X_log_structured.csv").write_text("Time,Level,Content,EventTemplate\nSun Dec 04 04:47:44 2005,notice,hi,E1\n")
    found = readers.structured_datasets(spark, [str(tmp_path / "d")])
    found = [r["path"] for r in found.collect()]
    assert len(found) == 1 and readers.read_app_rows(spark, found[0]).first()["log_level"] == "INFO"
    raw = readers.read_csv_log(spark, found[0])
    sinks.write_unique_templates(raw, str(tmp_path / "u"))
    assert spark.read.text(str(tmp_path / "u")).first()[0] == "E1" and tpl.unique_templates(raw).count() == 1


def test_flow_loaders(spark, tmp_path):
    base = tmp_path / "flows"
    base.mkdir()
    (base / "KDDTrain+.txt").write_text(",".join(["0", "tcp", "http", "SF"] + ["1"] * 37 + ["normal", "20"]) + "\n")
    nsl = readers.load_nsl_kdd(spark, str(base))
    assert len(nsl.columns) == 43 and nsl.first()["label"] == "normal"
    with pytest.raises(FileNotFoundError):
        readers.load_unsw(spark, str(base))
    (base / "UNSW-NB15_1.csv").write_text("id,a,label\n1,2,0\n")
    (base / "UNSW-NB15_2.csv").write_text("id,b,label\n2,x,1\n")
    both = readers.load_unsw(spark, str(base), official_split=False)
    assert both.columns == ["id", "a", "label", "b"] and both.count() == 2
    assert readers.load_ctu_iot(spark, str(base)).count() == 2


def _stream(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_stream_rate_equals_batch(spark, tmp_path):
    rows = [(f"1.1.1.{i % 3}", i * 7) for i in range(400)]
    df = spark.createDataFrame(rows, "ip string, s long").select("ip", F.timestamp_seconds("s").alias("ts"))
    out = streaming.run_available(streaming.ip_rate_offenders(_stream(spark, df, str(tmp_path / "s")), 3), "rate")
    got = {(str(r["window_start"]), r["ip"], r["n"]) for r in out.collect()}
    batch = web.requests_per_minute(df, "ts").filter("n >= 3").filter(F.col("minute") + F.expr("interval 1 minute") <= F.lit("1970-01-01 00:44:33").cast("timestamp"))
    assert got == {(str(r["minute"]), r["ip"], r["n"]) for r in batch.collect()} and got


def test_stream_bursts_and_tags(spark, tmp_path):
    rows = [("9.9.9.9", "POST", "/login", 401, i * 20) for i in range(30)] + [("8.8.8.8", "GET", "/", 200, 5000)]
    df = spark.createDataFrame(rows, "ip string, method string, path string, status int, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    late = df.unionByName(df.filter("status = 401").limit(1).withColumn("ts", F.timestamp_seconds(F.lit(9000))))
    out = streaming.run_available(streaming.bruteforce_bursts(_stream(spark, late, str(tmp_path / "b")), WebOptions(bruteforce_threshold=15)), "burst")
    assert out.agg(F.max("failures")).first()[0] == 15
    lines = spark.createDataFrame([("Jan 01 00:00:00 h p: permission denied",)], "value string")
    tagged = streaming.run_available(streaming.parse_and_tag(_stream(spark, lines, str(tmp_path / "l")), "syslog"), "tag")
    assert tagged.first()["categories"] == ["authentication_errors"]


def test_report_is_written_by_section(spark, tmp_path):
    df = spark.createDataFrame([(1, "permission denied from 1.1.1.1")], "line_id int, message string")
    sections = reports.standard_sections(df)
    path = sinks.write_report(reports.combined(sections), str(tmp_path / "r"))
    back = spark.read.option("header", True).csv(path)
    assert back.filter("section = 'insights'").first()["key"] == "1.1.1.1"


def test_csv_in_two_encodings_with_quoted_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('Time,Größe,Content\n1,2,"first\nsecond, ""quoted"""\n2,3,café\n'.encode())
    (tmp_path / "b.csv").write_bytes("Time,Größe,Content\n3,4,caf\xe9\n4,5,too,many\n".encode("latin-1"))
    a = readers.read_csv_log(spark, str(tmp_path / "a.csv"))
    assert a.columns == ["Time", "Größe", "Content"] and [r["Content"] for r in a.orderBy("Time").collect()] == ['first\nsecond, "quoted"', "café"]
    b = readers.read_csv_log(spark, str(tmp_path / "b.csv"), infer=False)
    assert [tuple(r) for r in b.collect()] == [("3", "4", "café")]
    bad = readers.malformed_csv(spark, str(tmp_path / "b.csv")).collect()
    assert [r["record"] for r in bad] == ["4,5,too,many"] and bad[0]["source_file"].endswith("b.csv")
    assert readers.malformed_csv(spark, str(tmp_path / "a.csv")).count() == 0


def test_many_files_of_different_headers(spark, tmp_path):
    for k in range(40):
        names = [["id", "bytes"], ["bytes", "proto", "id"], ["id", "label"]][k % 3]
        values = {"id": k, "bytes": 10 * k, "proto": 'tc"p' if k % 2 else "ud,p", "label": "Benign"}
        line = ",".join('"' + str(values[n]).replace('"', '""') + '"' if n == "proto" else str(values[n]) for n in names)
        (tmp_path / f"f{k}.csv").write_text(",".join(names) + "\n" + line + "\n" + ("1,2,3,4,5\n" if k == 0 else "") + "\n")
    df = readers.load_ctu_iot(spark, str(tmp_path))
    assert dict(df.dtypes) == {"bytes": "double", "id": "double", "label": "string", "proto": "string"}
    rows = {int(r["id"]): r for r in df.collect()}
    assert len(rows) == 40
    for k, r in rows.items():
        assert r["bytes"] == (None if k % 3 == 2 else 10.0 * k) and r["label"] == ("Benign" if k % 3 == 2 else None)
        assert r["proto"] == (('tc"p' if k % 2 else "ud,p") if k % 3 == 1 else None)
