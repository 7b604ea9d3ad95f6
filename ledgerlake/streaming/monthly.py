"""Incremental daily → monthly price aggregation (A5 over a file stream)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.constants import PRICE_REQUIRED_COLUMNS
from ledgerlake.operators.prices import daily_to_monthly, drop_bad_price_keys, type_daily
from ledgerlake.sources.csv_scan import apply_csv_missing

MONTH_TS = "month_ts"
DAYS_IN_A_MONTH = 31


def monthly_price_stream(spark: SparkSession, source_dir: str, lateness: str = "40 days",
                         columns: list[str] | None = None) -> DataFrame:
    """Streaming DataFrame of monthly price aggregates from daily CSV files
    arriving in `source_dir`.

    `columns` is the header of the files, in their order; by default that of the files already
    there, or the required columns where there is none yet. A file with another header
    ends the query with an error: its values would otherwise be read into the wrong
    columns. Columns beyond the required ones are not used.

    The month (as a timestamp) is both a grouping key and the watermarked
    event-time column. The latest month end seen is up to a month ahead of the
    latest day seen, so the watermark waits a month longer than `lateness`: a
    row whose day is at most `lateness` behind the latest day seen is never
    dropped. In append mode a month's row is emitted once the watermark
    passes it, and its state is dropped. Start it with e.g.
    `.writeStream.outputMode("append").option("checkpointLocation", ...)`."""
    if columns is None:
        try:
            columns = spark.read.option("header", True).csv(source_dir).columns
        except AnalysisException:  # no file yet
            columns = list(PRICE_REQUIRED_COLUMNS)
    if absent := [c for c in PRICE_REQUIRED_COLUMNS if c not in columns]:
        raise ValueError(f"price files lack required columns: {absent}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # Without column pruning the whole header of every file is held against the schema.
    raw = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
           .option("columnPruning", False).csv(source_dir).select(*PRICE_REQUIRED_COLUMNS))
    daily = drop_bad_price_keys(type_daily(apply_csv_missing(raw)))
    daily = daily.withColumn(MONTH_TS, F.to_timestamp(F.col("month_end"))).withWatermark(MONTH_TS, f"{lateness} {DAYS_IN_A_MONTH} days")
    monthly = daily_to_monthly(daily, extra_keys=(MONTH_TS,))
    return monthly.drop(MONTH_TS)
