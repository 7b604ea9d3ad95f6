"""Sources, sinks and persistence: CSV round trip, discovery, fingerprints, ML reload."""

import os
import tempfile

from ledgerlake.operators.dedupe import dedupe_most_complete
from ledgerlake.operators.prep import NumericPrep, NumericPrepModel
from ledgerlake.operators.standardize import standardize_quarterly
from ledgerlake.sources.csv_scan import read_daily_csv, read_quarterly_csv
from ledgerlake.sources.discovery import discover_source, duplicate_files
from ledgerlake.sources.sinks import write_csv_gz, write_partitioned_splits


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_quarterly_csv_scan_and_file_order_tie_break(spark):
    d = tempfile.mkdtemp(prefix="ll-test-")
    _write(os.path.join(d, "q.csv"),
           "gvkey,datadate,tic,atq,niq,costat\n"
           "GV12,2020-03-31, aa ,1.0,2.0,NA\n"      # tie on completeness: first in file wins
           "12,2020-03-31,bb,1.0,3.0,A\n"
           "12,2020-13-31,cc,1.0,3.0,A\n"          # bad date → dropped
           "xx,2020-03-31,dd,1,1,A\n")             # no digits → dropped
    raw = read_quarterly_csv(spark, os.path.join(d, "q.csv"))
    typed = standardize_quarterly(raw)
    assert typed.count() == 2
    out = dedupe_most_complete(typed).collect()
    assert len(out) == 1
    r = out[0]
    assert r["gvkey_str"] == "000012" and r["tic"] == "BB" and r["niq"] == 3.0


def test_daily_csv_requires_columns(spark):
    d = tempfile.mkdtemp(prefix="ll-test-")
    _write(os.path.join(d, "p.csv"), "PERMNO,DlyCalDt\n1,2020-01-02\n")
    try:
        read_daily_csv(spark, os.path.join(d, "p.csv"))
        raise AssertionError("expected a missing-column error")
    except ValueError:
        pass


def test_discovery_and_duplicates(spark):
    d = tempfile.mkdtemp(prefix="ll-test-")
    hdr = "PERMNO,HdrCUSIP,PrimaryExch,ShareType,Ticker,PERMCO,DlyCalDt,DlyPrc,DlyRet,DlyVol,ShrOut\n"
    _write(os.path.join(d, "small.csv"), hdr + "1,c,n,NS,t,1,2020-01-02,1,0,1,1\n")
    _write(os.path.join(d, "big.csv"), hdr + "1,c,n,NS,t,1,2020-01-02,1,0,1,1\n" * 5)
    _write(os.path.join(d, "other.csv"), "a,b\n1,2\n" * 50)
    _write(os.path.join(d, "copy_a.csv"), "a,b\n1,2\n" * 50)
    found = discover_source(spark, d, hdr.strip().split(","), fmt="csv").collect()
    assert len(found) == 1 and found[0]["path"].endswith("big.csv")
    dups = {r["path"].rsplit("/", 1)[-1] for r in duplicate_files(spark, d).collect()}
    assert dups == {"other.csv", "copy_a.csv"}


def test_numeric_prep_reload_gives_same_transform(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,)], "a double")
    model = NumericPrep(inputCols=["a"], outputCols=["a_s"]).fit(df)
    path = os.path.join(tempfile.mkdtemp(prefix="ll-test-"), "prep")
    model.write().overwrite().save(path)
    again = NumericPrepModel.load(path)
    a = [r["a_s"] for r in model.transform(df).collect()]
    b = [r["a_s"] for r in again.transform(df).collect()]
    assert a == b


def test_split_sink_round_trip(spark):
    d = tempfile.mkdtemp(prefix="ll-test-")
    df = spark.createDataFrame([("000001", "train", 1.0), ("000002", "test", 2.0)], "k string, split string, v double")
    write_partitioned_splits(df, os.path.join(d, "splits"), "split")
    back = spark.read.parquet(os.path.join(d, "splits"))
    assert sorted((r["k"], r["split"]) for r in back.collect()) == [("000001", "train"), ("000002", "test")]
    write_csv_gz(df, os.path.join(d, "csv"))
    again = spark.read.option("header", True).csv(os.path.join(d, "csv"))
    assert again.count() == 2
