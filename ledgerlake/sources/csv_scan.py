"""CSV scans of the two raw inputs.

Header-only reads: every column arrives as text (no schema inference pass
over the data); typing happens in one projection downstream. Files are read in
splits. Quoted fields may hold line breaks (`multi_line`, the default): a first pass
counts quotes, and where a line has an odd number of them records are put together across lines and
splits (`csv_records.py`). Files known to hold no such field spare that pass with `multi_line=False`.
Either way a record whose number of fields differs from the header's ends the
read with an error instead of losing values (`malformed="FAILFAST"`); with
`malformed="PERMISSIVE"` it is padded or cut, and `malformed_records` counts
such records. A file-order
column (file path, split start, position in the split) is attached so that
"first row in file order" tie-breaks stay meaningful on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.constants import PRICE_REQUIRED_COLUMNS
from ledgerlake.functions import csv_missing_to_null
from ledgerlake.operators.standardize import ROW_ORDER
from ledgerlake.sources.csv_records import open_splits, parsed, record_lines, split_quotes, text_lines


def _reader(spark: SparkSession, malformed: str = "FAILFAST"):
    # Without column pruning the parser sees every field of every record.
    return (spark.read.option("header", True).option("escape", '"').option("columnPruning", False)
            .option("mode", malformed))


def _records(spark: SparkSession, path: str, names: list[str], malformed: str) -> DataFrame | None:
    """The parsed records and their file order where a field of the files may hold a line break, else None."""
    lines = text_lines(spark, path)
    splits = split_quotes(lines).collect()  # one row for each task of the scan
    if not any(r["breaks"] for r in splits):
        return None
    order = F.struct("file", "block", "pos").alias(ROW_ORDER)
    records = record_lines(lines, open_splits(splits)).select("*", order)
    return parsed(records, names, {"escape": '"', "multiLine": "true", "mode": malformed}, [ROW_ORDER])


def _rows(spark: SparkSession, path: str, multi_line: bool, malformed: str) -> DataFrame:
    """All columns of a CSV as text, and the file order."""
    plain = _reader(spark, malformed=malformed).csv(path)
    found = _records(spark, path, plain.columns, malformed) if multi_line else None
    return with_row_order(plain) if found is None else found.select(*plain.columns, ROW_ORDER)


def malformed_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row: how many records of a CSV have a first field, and how many do not have the header's fields."""
    corrupt = "_corrupt_record"
    names = _reader(spark, "PERMISSIVE").csv(path).columns
    lines = text_lines(spark, path)
    splits = split_quotes(lines).collect() if multi_line else []
    if any(r["breaks"] for r in splits):
        options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
        rows = parsed(record_lines(lines, open_splits(splits)), [*names, corrupt], options, [])
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, corrupt)])
        rows = _reader(spark, "PERMISSIVE").schema(schema).option("columnNameOfCorruptRecord", corrupt).csv(path)
    # Spark wants a data column beside the corrupt one.
    return rows.agg(F.count(names[0]).alias("with_first_field"), F.count(corrupt).alias("malformed"))


def apply_csv_missing(df: DataFrame) -> DataFrame:
    """Default missing-value spellings → null on every text column."""
    return df.select([csv_missing_to_null(c).alias(c) if t == "string" and c != ROW_ORDER else F.col(c)
                      for c, t in df.dtypes])


def with_row_order(df: DataFrame) -> DataFrame:
    order = F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"))
    return df.select(*df.columns, order.alias(ROW_ORDER))


def read_quarterly_csv(spark: SparkSession, path: str, multi_line: bool = True,
                       malformed: str = "FAILFAST") -> DataFrame:
    """Quarterly panel CSV: all columns as text, missing spellings nulled."""
    return apply_csv_missing(_rows(spark, path, multi_line, malformed))


def read_daily_csv(spark: SparkSession, path: str, multi_line: bool = True,
                   malformed: str = "FAILFAST") -> DataFrame:
    """Daily price CSV: the 11 required columns only."""
    raw = _rows(spark, path, multi_line, malformed)
    missing = [c for c in PRICE_REQUIRED_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"price file lacks required columns: {missing}")
    return apply_csv_missing(raw.select(*PRICE_REQUIRED_COLUMNS, ROW_ORDER))
