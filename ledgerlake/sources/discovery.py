"""Input discovery and duplicate-file detection.

File listings come from the `binaryFile` source with the content column
pruned (only path / length / modification time are read). Column sets come
from each file's header or footer through the normal reader, which reads
metadata only. Content is read only for files that share a size with
another file, and hashed on the executors with `sha2`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of the files below `directory`."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .load(directory).select("path", "length", "modificationTime"))


def file_columns(spark: SparkSession, path: str, fmt: str) -> list[str]:
    """Column names from the file's header (CSV) or footer (parquet)."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path).columns


def discover_source(spark: SparkSession, directory: str, required: list[str], fmt: str = "csv",
                    exclude: list[str] | None = None) -> DataFrame:
    """Among the files of `directory` (other than `exclude`), the largest one
    whose columns contain every `required` column (S3). Zero rows if none.

    The per-file loop touches metadata only, one entry per file."""
    pattern = f"*.{fmt}"
    files = list_files(spark, directory, pattern).select("path", "length").collect()
    skip = set(exclude or [])
    rows = []
    for f in files:
        name = f["path"].rsplit("/", 1)[-1]
        if name in skip:
            continue
        cols = file_columns(spark, f["path"], fmt)
        rows.append((f["path"], int(f["length"]), cols))
    cand = spark.createDataFrame(rows, "path string, length long, columns array<string>")
    req = F.array(*[F.lit(c) for c in required])
    ok = cand.where(F.size(F.array_except(req, F.col("columns"))) == 0)
    return ok.orderBy(F.col("length").desc(), F.col("path")).limit(1).select("path", "length")


def duplicate_files(spark: SparkSession, directory: str, pattern: str = "*.csv") -> DataFrame:
    """Groups of byte-identical files: size first, SHA-256 only for files that
    share a size (S4). Returns (path, length, sha256, copies)."""
    listing = list_files(spark, directory, pattern)
    same_size = listing.groupBy("length").count().where(F.col("count") > 1)
    cand = [r["path"] for r in listing.join(same_size, "length", "left_semi").select("path").collect()]
    if not cand:
        return spark.createDataFrame([], "path string, length long, sha256 string, copies long")
    hashed = (spark.read.format("binaryFile").load(cand)
              .select("path", "length", F.sha2(F.col("content"), 256).alias("sha256")))
    from pyspark.sql import Window
    w = Window.partitionBy("length", "sha256")
    return hashed.withColumn("copies", F.count(F.lit(1)).over(w)).where(F.col("copies") > 1)


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of one file (the raw-input fingerprint of the profile)."""
    return spark.read.format("binaryFile").load(path).select("path", "length",
                                                              F.sha2("content", 256).alias("sha256"))
