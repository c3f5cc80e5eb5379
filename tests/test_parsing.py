import pytest
from pyspark.sql import functions as F

from loomlog.functions.text import in_zone, to_number
from loomlog.operators import parsing

HDFS = [
    "081109 203615 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_1 src: /10.0.0.1:1",
    "081109 203807 145 INFO dfs.DataNode$PacketResponder: PacketResponder 1 terminating",
    "081109 204005 147 INFO dfs.FSNamesystem: BLOCK* addStoredBlock",
]
BGL = [
    "2005-06-03-15.42.50.363779 R02-M1-N0 KERNEL RAS INFO instruction cache parity error corrected",
    "2005-06-03-15.42.53.276129 R02-M1-N0 KERNEL RAS FATAL data TLB error interrupt",
    "2005-06-03-15.42.53.407289 R02-M1-N0 KERNEL RAS FATAL machine check interrupt",
]


def lines(spark, rows, source="f"):
    return spark.createDataFrame([(source, i, v) for i, v in enumerate(rows, 1)], "source_file string, line_num long, value string")


@pytest.mark.parametrize("rows,want", [(HDFS, "hdfs"), (BGL, "bgl"), (["~~"], "unknown"),
                                       (["2024-01-01 00:00:00.5 INFO 1 [t] c.C msg"], "simple")])
def test_detection_and_ties(spark, rows, want):
    assert parsing.detect_formats(lines(spark, rows), "source_file", "line_num").first()["format"] == want


def test_only_the_first_ten_physical_lines_count(spark):
    rows = [""] * 9 + ["~~"] + HDFS
    assert parsing.detect_formats(lines(spark, rows), "source_file", "line_num").first()["format"] == "unknown"


def test_hdfs_and_bgl_fields(spark):
    got = parsing.parse_lines(lines(spark, HDFS), "hdfs").orderBy("line_num").collect()
    assert [r["pid"] for r in got] == ["143", "145", "147"] and {r["level"] for r in got} == {"INFO"}
    got = parsing.parse_lines(lines(spark, BGL), "bgl").orderBy("line_num").collect()
    assert [r["level"] for r in got] == ["INFO", "FATAL", "FATAL"]


def test_parsed_is_never_null_and_unmatched_lines_stay(spark):
    got = parsing.parse_lines(lines(spark, HDFS + ["junk"]), "hdfs").orderBy("line_num").collect()
    assert [r["parsed"] for r in got] == [True, True, True, False]
    assert got[3]["raw_content"] == "junk" and got[3]["message"] is None


def test_optional_group_and_mark_character(spark):
    rows = ["Jan 01 00:00:00 h p: a\x1fb", "Jan 01 00:00:00 h p[7]: c"]
    got = parsing.parse_lines(lines(spark, rows), "syslog").orderBy("line_num").collect()
    assert got[0]["pid"] is None and got[0]["message"] == "a\x1fb"
    # the program field is greedy, so the bracketed number stays with it
    assert got[1]["message"] == "c" and got[1]["parsed"]


def test_line_need_not_end_where_the_format_does(spark):
    got = parsing.parse_lines(lines(spark, ["2024-01-01 00:00:00 1.1.1.1 GET /a 200 5 trailing words"]), "w3c_extended").first()
    assert got["size"] == "5" and str(got["datetime_obj"]) == "2024-01-01 00:00:00"


def test_zoned_time_is_kept_in_utc(spark):
    line = '1.1.1.1 - - [01/Jan/2024:05:30:00 +0530] "GET /a HTTP/1.1" 200 5'
    assert str(parsing.parse_lines(lines(spark, [line]), "apache_common").first()["datetime_obj"]) == "2024-01-01 00:00:00"


def test_registered_format_takes_part(spark):
    parsing.register_format("pipes", r"(\w+)\|(\w+)", ["a", "b"])
    try:
        assert parsing.detect_formats(lines(spark, ["x|y"]), "source_file", "line_num").first()["format"] == "pipes"
        with pytest.raises(ValueError):
            parsing.register_format("broken", r"(\w+)", ["a", "b"])
    finally:
        parsing.FORMATS.pop("pipes")
    with pytest.raises(ValueError):
        parsing.parse_lines(lines(spark, ["x"]), "nope")


def test_family_dispatch_order():
    family = parsing.structured_family
    assert family(["Month", "Date", "Time", "Level", "Component", "Content"]) == "linux"
    assert family(["Time", "Level", "Component", "Content", "Node"]) == "bgl"
    assert family(["Month", "Day", "Time", "Component", "Content"]) == "thunderbird"
    assert family(["Date", "Time", "Component", "Content"]) == "hdfs"
    assert family(["Time", "Level", "Content"]) == "apache"
    assert family(["a"]) is None


def test_structured_edges(spark):
    df = spark.createDataFrame([("Jul", None, "14:41:58", "x", "sshd", "Failed login")], "Month string, Date string, Time string, Level string, Component string, Content string")
    row = parsing.structured_rows(df).first()
    assert str(row["timestamp"]) == "2025-07-01 14:41:58" and row["log_level"] == "ERROR"
    df = spark.createDataFrame([(81109, 3615, "c", "m")], "Date int, Time int, Component string, Content string")
    assert str(parsing.hdfs_rows(df).first()["timestamp"]) == "2009-08-11 00:36:15"
    assert str(parsing.hdfs_rows(df, "yyMMdd").first()["timestamp"]) == "2008-11-09 00:36:15"
    df = spark.createDataFrame([("bad", "notice", "m"), ("Sun Dec 04 04:47:44 2005", "notice", "m")], "Time string, Level string, Content string")
    rows = parsing.structured_rows(df).collect()
    assert len(rows) == 1 and rows[0]["log_level"] == "INFO" and str(rows[0]["timestamp"]) == "2005-12-04 04:47:44"


def test_app_log_lines(spark):
    rows = ["// c", "# c", "", "2024-01-01 00:00:00,123 WARN [net] slow", "garbage"]
    got = parsing.parse_app_log(lines(spark, rows)).collect()
    assert len(got) == 1 and got[0]["module"] == "net" and got[0]["timestamp"].microsecond == 123000


def test_numbers_and_zone(spark):
    df = spark.createDataFrame([("1e3",), ("12abc",), ("1d",), (" 7 ",), (None,)], "v string")
    assert [r[0] for r in df.select(to_number(F.col("v"))).collect()] == [1000.0, None, None, 7.0, None]
    one = spark.sql("select timestamp'2024-01-01 00:00:00' as t").select(in_zone(F.col("t")))
    assert one.first()[0] == "2024-01-01 05:30:00"


def test_standard_log_json_round_trip(spark):
    df = spark.createDataFrame([(1, "c", "INFO", "hello"), (2, "c", None, "x")], "LineId int, Component string, Level string, Content string")
    entry = parsing.standard_from_structured(df)
    text = [r[0] for r in entry.select(parsing.to_json(entry)).collect()]
    assert '"level":"INFO"' in text[0] and "level" not in text[1].replace("Level", "") and "raw_content" not in text[0]
    back = entry.select(parsing.from_json(parsing.to_json(entry)).alias("e")).select("e.*").orderBy("log_id").collect()
    assert back[0]["message"] == "hello" and back[0]["raw_content"] == "hello" and back[0]["metadata"]["Component"] == "c"
    iso = spark.createDataFrame([("2024-01-01T00:00:00Z",)], "t string").select(parsing.iso_time(F.col("t"))).first()[0]
    assert str(iso) == "2024-01-01 00:00:00"


def test_dates_with_short_days_and_fractions_keep_their_rows(spark):
    apache = spark.createDataFrame([("Sun Dec  4 04:47:44 2005", "notice"), ("Sun Dec 14 04:47:44 2005", "error"), ("Sun Dec 4 04:47:44 2005", "error"), ("x", "error")],
                                   "Time string, Level string")
    assert [str(r.timestamp) for r in parsing.apache_rows(apache).collect()] == ["2005-12-04 04:47:44", "2005-12-14 04:47:44", "2005-12-04 04:47:44"]
    hdfs = spark.createDataFrame([("81109.0", "203615"), ("081109", "203615.0"), ("no", "1")], "Date string, Time string")
    assert [str(r.timestamp) for r in parsing.hdfs_rows(hdfs).collect()] == ["2009-08-11 20:36:15"] * 2


def test_indented_files_are_detected(spark):
    lines = spark.createDataFrame([("f", k, "\t127.0.0.1 - - [10/Oct/2000:13:55:36 +0000] \"GET /a HTTP/1.0\" 200 5\t") for k in range(3)], "source string, line_id int, value string")
    parsed = parsing.parse_by_source(lines, "source", "line_id").collect()
    assert len(parsed) == 3 and all(r.parsed for r in parsed)
