import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import model
from stockloom.sources.landing import LandingZone, default_name, scan_csv
from stockloom.sources.scan import headers, scan_files
from stockloom.sources.objectstore import ObjectStore
from stockloom.sources.scratch import scratch_path, scratch_root, stage


@pytest.fixture
def zone(spark, tmp_path):
    return LandingZone(spark, str(tmp_path))


def sample(spark):
    return spark.createDataFrame(
        [
            (1, 'Á Châu, "ACB"', Decimal("1.50"), date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5)),
            (2, None, None, None, None),
        ],
        "id bigint, name string, amount decimal(10,2), day date, at timestamp_ntz",
    )


@pytest.mark.parametrize("fmt", ["parquet", "csv", "JSON"])
def test_roundtrip(spark, zone, rows, fmt):
    df = sample(spark)
    path = zone.save_dataframe(df, "raw/x", "t", fmt)
    assert path.endswith(f"raw/x/t.{fmt.lower()}")
    assert rows(zone.read_dataframe("raw/x", "t", fmt, df.schema)) == rows(df)
    zone.save_dataframe(df.limit(1), "raw/x", "t", fmt)  # a repeated load replaces the file
    assert zone.read_dataframe("raw/x", "t", fmt, df.schema).count() == 1


def test_partitioned_parquet_replaces_only_its_partitions(spark, zone, rows):
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "v int, year int")
    zone.save_dataframe(df, "facts", partition_cols=["year"])
    zone.save_dataframe(spark.createDataFrame([(9, 2024)], "v int, year int"), "facts", partition_cols=["year"])
    back = zone.read_dataframe("facts")
    assert rows(back, "v", "year") == [(1, 2023), (9, 2024)]
    assert "PartitionFilters: [isnotnull(year" in back.where("year = 2024")._jdf.queryExecution().toString()


def test_guards(spark, zone):
    assert zone.save_dataframe(None, "raw", "x") is None
    assert zone.save_dataframe(spark.range(0), "raw", "x") is None
    with pytest.raises(ValueError):
        zone.save_dataframe(spark.range(1), "raw", "x", "orc")
    with pytest.raises(ValueError):
        zone.read_dataframe("raw", "x", "xml")
    for fmt in ("parquet", "csv", "json"):
        with pytest.raises(FileNotFoundError):
            zone.read_dataframe("raw", "missing", fmt)


def test_default_name(spark, zone):
    assert default_name(datetime(2024, 5, 6, 7, 8, 9)) == "data_20240506_070809"
    assert re.search(r"raw/data_\d{8}_\d{6}\.json$", zone.save_dataframe(spark.range(1), "raw", file_format="json"))


def write(tmp_path, name, text, encoding="utf-8"):
    (tmp_path / name).write_text(text, encoding=encoding)
    return str(tmp_path / name)


def test_scan_keeps_zeros_and_reads_bom_and_quotes(spark, tmp_path):
    path = write(
        tmp_path, "map.csv",
        'code,tax_code,industry_code\nGAS,3500102710,0620\nGVR,0301266564,0125\n"A, ""B""",,\n',
        "utf-8-sig",
    )
    got = [tuple(r) for r in scan_csv(spark, path, model.RAW_INDUSTRY_MAP).collect()]
    assert got == [("GAS", "3500102710", "0620"), ("GVR", "0301266564", "0125"), ('A, "B"', None, None)]


def test_scan_goes_by_name_and_casts_softly(spark, tmp_path):
    path = write(tmp_path, "x.csv", "extra,quantity,id\nz,5,001\nz,abc,002\n")
    shape = T.StructType().add("id", "string").add("quantity", "long").add("absent", "date")
    assert [tuple(r) for r in scan_csv(spark, path, shape).collect()] == [("001", 5, None), ("002", None, None)]


def test_files_with_another_header_are_refused(spark, tmp_path):
    write(tmp_path, "a.csv", "a,b\n1,2\n")
    write(tmp_path, "b.csv", "b,a\n2,1\n")
    with pytest.raises(Exception, match="CSV header"):
        scan_csv(spark, str(tmp_path)).collect()


def test_multiline_cells(spark, tmp_path):
    path = write(tmp_path, "m.csv", 'code,address\nACB,"line 1\nline 2"\n')
    assert scan_csv(spark, path, multiline=True).first().address == "line 1\nline 2"


def test_scratch_follows_the_session_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


class Session:
    """A session without the setting, on a given master."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master, self.folder = self, self, master, None

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_without_the_setting():
    local = Session("local[4]")
    root = scratch_root(local)
    assert root == local.folder and scratch_root(local) == root
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session("spark://host:7077"))


def test_stage_cuts_the_plan(spark):
    staged = stage(spark.range(10).withColumn("v", F.col("id") * 2), "t")
    assert staged.count() == 10 and len(staged.inputFiles()) > 0


def test_object_store_settings():
    settings = ObjectStore("http://host:9000", "key", "secret").spark_settings()
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://host:9000"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert settings["spark.hadoop.fs.s3a.committer.magic.enabled"] == "false"
    assert ObjectStore.root("lake") == "s3a://lake"


TEXTS = ["plain", " outer blanks ", "two\nlines", "cr\rlf\r\nend", 'a "quoted", cell', "", None, '""', "\\n", "\t", "'"]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_texts_and_times_survive(spark, zone, rows, fmt):
    from zoneinfo import ZoneInfo

    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    data = [(i, t, at, at.replace(tzinfo=ZoneInfo("UTC"))) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(data, "id int, text string, plain timestamp_ntz, at timestamp")
    assert zone.save_dataframe(df, "raw/t", "t", fmt).rows == len(TEXTS)
    assert rows(zone.read_dataframe("raw/t", "t", fmt, df.schema, multiline=True)) == rows(df)


def test_text_keys_of_partitions_stay_text(spark, zone, rows):
    df = spark.createDataFrame([("0620", 1), ("0125", 2)], "industry_code string, v int")
    zone.save_dataframe(df, "facts", partition_cols=["industry_code"])
    back = zone.read_dataframe("facts")
    assert back.schema == df.schema and rows(back) == rows(df)


def test_empty_tables_by_choice(spark, zone):
    df = spark.createDataFrame([(1,)], "v int")
    zone.save_dataframe(df, "raw", "x")
    assert zone.save_dataframe(df.limit(0), "raw", "x") is None
    assert zone.read_dataframe("raw", "x").count() == 1
    with pytest.raises(ValueError, match="no rows"):
        zone.save_dataframe(df.limit(0), "raw", "x", when_empty="fail")
    assert zone.save_dataframe(df.limit(0), "raw", "x", when_empty="write").rows == 0
    assert zone.read_dataframe("raw", "x").count() == 0


def test_files_with_differing_headers_are_one_table(spark, tmp_path, rows):
    write(tmp_path, "x_AAA.csv", 'a,b\n1,2\n"",\n', "utf-8-sig")
    write(tmp_path, "x_BBB.csv", "b,a,c\n4,3,5\n")
    write(tmp_path, "x_CCC.csv", "a,b\n6,7\n")
    write(tmp_path, "x_DDD.csv", "")
    assert [len(files) for files in headers(spark, str(tmp_path)).values()] == [2, 1]
    found = scan_files(spark, str(tmp_path), tags={"source": r"_([A-Z]+)\.csv"}).rows()
    assert rows(found, "source", "a", "b", "c") == [
        ("AAA", "", None, None), ("AAA", "1", "2", None), ("BBB", "3", "4", "5"), ("CCC", "6", "7", None),
    ]
    typed = scan_files(spark, str(tmp_path)).rows(T.StructType().add("c", "integer").add("a", "integer"))
    assert rows(typed) == [(5, 3), (None, 1), (None, 6), (None, None)]


def test_ragged_records_are_rejects(spark, tmp_path, rows):
    path = write(tmp_path, "r.csv", 'a,b,c\n1,2,3\nC,3,0630,EXTRA\nB,2\n"x,y","z",w\n')
    scan = scan_files(spark, path)
    assert rows(scan.rows()) == [("1", "2", "3"), ("x,y", "z", "w")]
    assert rows(scan.rejects(), "expected", "found", "record") == [(3, 2, "B,2"), (3, 4, "C,3,0630,EXTRA")]
    assert scan.rows().select("a").count() == 2 and scan.rejects().count() == 2  # whatever columns are read
    assert scan.rejects().first().file.endswith("r.csv")
    lines = write(tmp_path, "m.csv", 'code,address\nACB,"line 1\nline 2"\nX,"a\nb",c\n')
    scan = scan_files(spark, lines, multiline=True)
    assert rows(scan.rows()) == [("ACB", "line 1\nline 2")]
    assert [(r.expected, r.found) for r in scan.rejects().collect()] == [(2, 3)]


def test_nothing_to_scan(spark, tmp_path):
    write(tmp_path, "e.csv", "")
    scan = scan_files(spark, str(tmp_path))
    assert scan.rows().collect() == [] == scan.rejects().collect()


def test_nulls_of_a_single_column_survive(spark, zone, rows):
    df = spark.createDataFrame([("a",), (None,), ("",), ("\u0001",), (None,)], "v string")
    zone.save_dataframe(df, "raw", "one", "csv")
    assert rows(zone.read_dataframe("raw", "one", "csv")) == rows(df)
    assert rows(zone.read_dataframe("raw", "one", "csv", df.schema)) == rows(df)


def test_saves_of_one_second_keep_apart(spark, zone, monkeypatch):
    monkeypatch.setattr("stockloom.sources.landing.default_name", lambda: "data_20240506_070809")
    saved = [zone.save_dataframe(spark.range(n), "raw") for n in (1, 2, 3)]
    assert len(set(saved)) == 3 and [spark.read.parquet(p).count() for p in saved] == [1, 2, 3]
