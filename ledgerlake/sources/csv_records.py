"""Records of CSV files read in splits, also where quoted fields hold line breaks.

A line begins a record exactly if the quotes before it in its file are even in
number: quotes enclose fields, and one inside a field is doubled. So

1. every split reports the parity of its quotes, and whether a line ends on
   an even or on an odd number of them (one row a split),
2. in the order of a file's splits, this tells for each whether it begins
   inside a quoted field, and which split the open record began in,
3. every split cuts its lines into records on its own. The lines of a record
   that crosses split borders leave each split as one fragment, and fragments
   meet by the split their record began in: at most two a split, however
   large the file.

If no line has an odd number of quotes (`breaks`), no field holds a line break, and the caller
can use the plain line reader. A file that ends inside a quoted field is refused: it has
a quote that neither encloses a field nor is doubled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE = '"'
_SCHEMA = "file string, owner long, block long, pos long, text string, whole boolean"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block): the lines of the files at `path`, and the start of the split they lie in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _odd(values: pa.Array) -> np.ndarray:
    """Whether each line has an odd number of quotes."""
    return pc.count_substring(pc.fill_null(values, ""), QUOTE).to_numpy(zero_copy_only=False) % 2 == 1


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split; its lines follow one another."""
    state: dict[tuple[str, int], list] = {}
    for b in batches:
        odd, block = _odd(b.column(0)), b.column(2).to_numpy(zero_copy_only=False)
        name = b.column(1).dictionary_encode()
        code = name.indices.to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((block[1:] != block[:-1]) | (code[1:] != code[:-1])) + 1
        for i, j in zip(np.r_[0, cut].astype(int), np.r_[cut, len(block)].astype(int)):
            if i == j:
                continue
            own = state.setdefault((name.dictionary[int(code[i])].as_py(), int(block[i])), [False, False, False, False])
            ends = np.logical_xor.accumulate(np.r_[own[0], odd[i:j]])[1:]
            own[:] = [bool(ends[-1]), own[1] or bool(odd[i:j].any()), own[2] or bool((~ends).any()), own[3] or bool(ends.any())]
    columns = [[k[0] for k in state], [k[1] for k in state], *([v[i] for v in state.values()] for i in range(4))]
    types = [pa.string(), pa.int64()] + [pa.bool_()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                     names=["file", "block", "odd", "breaks", "even_end", "odd_end"])


def split_quotes(lines: DataFrame) -> DataFrame:
    """(file, block, odd: an odd number of quotes, breaks: a line has an odd number, even_end and odd_end:
    some line ends on an even, an odd number of the split's quotes): one row a split."""
    return lines.mapInArrow(_reported, "file string, block long, odd boolean, breaks boolean, even_end boolean, odd_end boolean")


def open_splits(splits: list) -> dict[tuple[str, int], int | None]:
    """For each (file, block) the block that a record open at its first line began in, or None.
    `splits` has one row a split, as many as the scan has tasks."""
    out: dict[tuple[str, int], int | None] = {}
    file, owner = None, None
    for r in sorted(splits, key=lambda r: (r["file"], r["block"])):
        if r["file"] != file:
            if owner is not None:
                raise ValueError(f"{file} ends inside a quoted field")
            file = r["file"]
        out[r["file"], r["block"]] = owner
        inside = owner is not None
        if inside == r["odd"]:
            owner = None
        elif not inside or r["odd_end"]:  # the record left open began after a line end outside quotes, or with the split
            owner = r["block"]
    if owner is not None:
        raise ValueError(f"{file} ends inside a quoted field")
    return out


def _cut(begins: dict[tuple[str, int], int | None]):
    """Cuts the lines of each split into records and fragments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None  # the split being read
        held: list[str] = []
        odd, pos, first, owner = False, 0, 0, None
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 6
            rows.clear()
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                              names=["file", "owner", "block", "pos", "text", "whole"])

        def put(whole: bool) -> None:
            if held:
                rows.append((at[0], at[1] if owner is None else owner, at[1], first, "\n".join(held), whole))
                held.clear()

        for b in batches:
            for line, odd_line, file, block in zip(b.column(0).to_pylist(), _odd(b.column(0)).tolist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if (file, block) != at:
                    put(False)  # open at the end of its split
                    at, pos = (file, block), 0
                    owner = begins[at]
                    odd = owner is not None
                if not held:
                    first = pos
                held.append(line)
                pos += 1
                odd ^= odd_line
                if not odd:
                    put(owner is None)
                    owner = None
            yield flush()
        put(False)
        yield flush()

    return run


def record_lines(lines: DataFrame, begins: dict[tuple[str, int], int | None]) -> DataFrame:
    """(file, block, pos, text): the records, by the split and the line in it that they begin at."""
    cut = lines.mapInArrow(_cut(begins), _SCHEMA)
    parts = cut.filter(~F.col("whole")).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "pos", "text"))).alias("parts"))
    joined = parts.select("file", F.col("owner").alias("block"), F.get("parts", F.lit(0))["pos"].alias("pos"),
                          F.concat_ws("\n", F.transform("parts", lambda p: p["text"])).alias("text"))
    return cut.filter("whole").select("file", "block", "pos", "text").unionByName(joined)


def parsed(records: DataFrame, names: list[str], options: dict[str, str], keep: list[str]) -> DataFrame:
    """The fields of each record under `names`, as text, beside the columns `keep`; without
    header records (the first of each file) and blank lines."""
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    body = records.filter(((F.col("block") > 0) | (F.col("pos") > 0)) & (F.trim(F.regexp_replace("text", "[\r\n\t]", "")) != ""))
    fields = F.from_csv(F.regexp_replace("text", "\r$", ""), F.lit(schema), options)
    return body.select(*keep, fields.alias("__fields")).select(*keep, "__fields.*")
