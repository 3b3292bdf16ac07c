"""Readers, writers, store and streams, on temporary folders."""

import json

from pyspark.sql import functions as F

from siltstone.sources import files
from siltstone.streaming import streams


def test_companies(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("ticker,market,source,form_types,years,notes\nAAPL,us,EDGAR,10-K|10-Q,2023|x|2024,\nX,UK,EDGAR,10-K,2023,\n")
    got = sorted(tuple(r) for r in files.companies(spark, str(p)).collect())
    assert got == [("AAPL", "10-K", 2023), ("AAPL", "10-K", 2024), ("AAPL", "10-Q", 2023), ("AAPL", "10-Q", 2024)]


def test_jsonl_modes(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    assert [r.a for r in files.jsonl(spark, str(p), "a int").collect() if r._corrupt_record] == [None]
    assert [r.a for r in files.jsonl(spark, str(p), "a int", "DROPMALFORMED").collect()] == [1, 2]


def test_store_replaces_a_filing(spark, tmp_path):
    row = lambda v: spark.createDataFrame([("f1", "u1", v)], "filing_id string, unit_id string, measures string")
    for v in ("a", "b"):
        files.save_store({"units": row(v)}, str(tmp_path))
    assert [r.measures for r in files.load_store(spark, str(tmp_path))["units"].collect()] == ["b"]


def test_index_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", [0.1, 0.2]), ("b", [0.3, 0.4])], "id string, embedding array<float>")
    files.save_index(df, str(tmp_path))
    assert files.load_index(spark, str(tmp_path)).count() == 2


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2])], "a int, b array<int>")
    for fmt in ("parquet", "csv", "jsonl"):
        files.write(df, f"{tmp_path}/{fmt}", fmt)
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").first().b == "[1,2]"


def test_manifest(spark):
    a = spark.createDataFrame([("x", 2), ("y", 1), ("z", 1)], "k string, m int")
    done = spark.createDataFrame([("x", 1), ("y", 1)], "k string, m int")
    assert sorted(r.k for r in files.unprocessed(a, done, "k", "m").collect()) == ["x", "z"]


def test_filename_and_dates(spark):
    from siltstone.functions.text import meta_from_filename

    df = spark.createDataFrame([("US_AAPL_2023_10-K_0000320193-23-000106.html",), ("other.txt",)], "n string")
    got = [r[0] for r in df.select(meta_from_filename("n")).collect()]
    assert (got[0].ticker, got[0].year, got[0].accno) == ("AAPL", 2023, "0000320193-23-000106") and got[1].ticker is None
    null = F.lit(None).cast("string")
    assert df.select(files.filing_date(null, null, F.lit("0000320193-23-000106"))).first()[0] == "2023"


def test_stream_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text("\n".join(json.dumps({"d": i, "t": "x"}) for i in range(3)))
    s = streams.arriving_jsonl(spark, str(tmp_path / "in"), "d int, t string")
    streams.run_stage(s, lambda df: df.where("d > 0"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
