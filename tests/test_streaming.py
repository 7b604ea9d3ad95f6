"""Streaming monthly rollup equals the batch rollup on the closed months."""

import os
import tempfile

import pytest
from pyspark.errors import StreamingQueryException

from ledgerlake.operators.prices import daily_to_monthly, drop_bad_price_keys, type_daily
from ledgerlake.sources.csv_scan import read_daily_csv
from ledgerlake.streaming import monthly_price_stream

HDR = "PERMNO,HdrCUSIP,PrimaryExch,ShareType,Ticker,PERMCO,DlyCalDt,DlyPrc,DlyRet,DlyVol,ShrOut\n"


def _write(path, rows):
    with open(path, "w") as f:
        f.write(HDR + "".join(rows))


def test_stream_matches_batch_for_closed_month(spark):
    src = tempfile.mkdtemp(prefix="ll-stream-src-")
    ck = tempfile.mkdtemp(prefix="ll-stream-ck-")
    jan = ["1,c1,n,NS,t,5,2020-01-02,10,0.01,100,5\n", "1,c1,n,NS,t,5,2020-01-03,-11,,120,5\n",
           "2,c2,q,NS,u,6,2020-01-02,20,0.02,50,\n"]
    _write(os.path.join(src, "a.csv"), jan)
    stream = monthly_price_stream(spark, src, lateness="1 days")
    q = (stream.writeStream.outputMode("append").format("memory").queryName("ll_monthly")
         .option("checkpointLocation", ck).start())
    q.processAllAvailable()
    _write(os.path.join(src, "b.csv"), ["1,c1,n,NS,t,5,2020-04-01,12,0.02,100,5\n"])
    q.processAllAvailable()
    _write(os.path.join(src, "c.csv"), ["1,c1,n,NS,t,5,2020-06-01,12,0.02,100,5\n"])
    q.processAllAvailable()
    q.stop()
    got = {(r["PERMNO"], str(r["month_end"])): r for r in spark.sql("SELECT * FROM ll_monthly").collect()}
    batch = daily_to_monthly(drop_bad_price_keys(type_daily(read_daily_csv(spark, os.path.join(src, "a.csv")))))
    for r in batch.collect():
        s = got[(r["PERMNO"], str(r["month_end"]))]
        for c in ("crsp_obs_days", "crsp_ret_1m", "crsp_price_last", "crsp_avg_volume_1m", "cusip8"):
            assert s[c] == r[c], c


def _start(spark, src, name, **kw):
    ck = tempfile.mkdtemp(prefix="ll-stream-ck-")
    return (monthly_price_stream(spark, str(src), lateness="1 days", **kw).writeStream.outputMode("append").format("memory")
            .queryName(name).option("checkpointLocation", ck).start())


def test_stream_reads_columns_by_name(spark, tmp_path):
    head = "Note,DlyCalDt,PERMNO,HdrCUSIP,PrimaryExch,ShareType,Ticker,PERMCO,DlyPrc,DlyRet,DlyVol,ShrOut\n"
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(head + "x,2020-01-02,1,c1,n,NS,t,5,10,0.01,100,5\n")
    q = _start(spark, src, "ll_by_name")
    q.processAllAvailable()
    for k, d in enumerate(("2020-06-01", "2020-09-01")):
        (src / f"b{k}.csv").write_text(head + f"x,{d},1,c1,n,NS,t,5,10,0.02,100,5\n")
        q.processAllAvailable()
    q.stop()
    rows = spark.sql("SELECT PERMNO, month_end, crsp_price_last, cusip8, permco FROM ll_by_name ORDER BY month_end").collect()
    assert [(r[0], str(r[1]), *r[2:]) for r in rows][:1] == [(1, "2020-01-31", 10.0, "000000C1", 5)]


def test_stream_refuses_a_file_with_another_column_order(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src / "a.csv", ["1,c1,n,NS,t,5,2020-01-02,10,0.01,100,5\n"])
    q = _start(spark, src, "ll_other_order")
    q.processAllAvailable()
    (src / "b.csv").write_text("DlyCalDt,PERMNO,HdrCUSIP,PrimaryExch,ShareType,Ticker,PERMCO,DlyPrc,DlyRet,DlyVol,ShrOut\n"
                               "2020-06-01,1,c1,n,NS,t,5,10,0.02,100,5\n")
    with pytest.raises(StreamingQueryException):
        q.processAllAvailable()
    q.stop()


def test_stream_names_absent_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("PERMNO,DlyCalDt\n1,2020-01-02\n")
    with pytest.raises(ValueError, match="HdrCUSIP"):
        monthly_price_stream(spark, str(tmp_path))
