"""CSV files read in splits equal pandas, with a quoted line break at every split border."""

import pandas as pd
import pytest

from ledgerlake.operators.standardize import ROW_ORDER
from ledgerlake.sources.csv_records import open_splits, record_lines, split_quotes, text_lines
from ledgerlake.sources.csv_scan import malformed_records, read_quarterly_csv

ROWS = [
    ("gvkey", "note", "atq"),
    ("1", "plain", "1.5"),
    ("2", "two\nlines", "2"),
    ("3", 'a "quoted" word', "3"),
    ("4", '"\n"\n,\n"', "4"),
    ("5", "", "5"),
    ("6", "comma, and\n\n\na blank line", "6"),
    ("7", "\n" * 40, "7"),
    ("8", "é ü 日本\n語", "8"),
    ("9", 'ends with a quote"', "9"),
    ("10", '"', "10"),
]


def quoted(v, always):
    return '"' + v.replace('"', '""') + '"' if always or any(c in v for c in ',"\n') else v


def write(path, rows, end="\n", always=False):
    with open(path, "w", newline="") as f:
        f.write("".join(",".join(quoted(v, always) for v in r) + end for r in rows))


@pytest.fixture
def split_bytes(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)


def by_pandas(path):
    d = pd.read_csv(path, dtype=str, keep_default_na=False)
    return [tuple(None if v == "" else v for v in r) for r in d.itertuples(index=False)]


def in_order(df):
    return [tuple(r)[:3] for r in sorted(df.select("gvkey", "note", "atq", ROW_ORDER).collect(), key=lambda r: tuple(r[ROW_ORDER]))]


@pytest.mark.parametrize("size", [7, 16, 23, 40, 64, 101, 1000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_pandas_for_any_split(spark, split_bytes, tmp_path, size, end):
    path = str(tmp_path / "q.csv")
    write(path, ROWS + ROWS[1:] * 3, end)
    split_bytes(size)
    got = read_quarterly_csv(spark, path)
    assert in_order(got) == by_pandas(path)
    if size < 1000:
        assert text_lines(spark, path).rdd.getNumPartitions() > 3


def test_a_line_break_at_every_split_border(spark, split_bytes, tmp_path):
    """Records of 31 bytes in splits of 32: the borders pass every place of a record."""
    rows = [f'{k:03d},"{"a" * (k % 21)}\n{"b" * (21 - k % 21)}",1\n' for k in range(96)]
    assert {len(r) for r in rows} == {31}
    path = str(tmp_path / "q.csv")
    with open(path, "w") as f:
        f.write("gvkey,note,atq\n" + "".join(rows))
    split_bytes(32)
    splits = split_quotes(text_lines(spark, path)).collect()
    begins = open_splits(splits)
    assert len(splits) > 60 and sum(v is not None for v in begins.values()) > 20
    assert in_order(read_quarterly_csv(spark, path)) == by_pandas(path)


def test_a_record_over_many_splits_is_one_fragment_each(spark, split_bytes, tmp_path):
    path = str(tmp_path / "q.csv")
    write(path, [ROWS[0], ("1", "line\n" * 200, "1"), ("2", "x", "2")])
    split_bytes(64)
    lines = text_lines(spark, path)
    begins = open_splits(split_quotes(lines).collect())
    assert sum(v is not None for v in begins.values()) > 10 and len({v for v in begins.values() if v is not None}) == 1
    rows = record_lines(lines, begins).collect()
    assert len(rows) == 3 and max(r.text.count("\n") for r in rows) == 200
    assert in_order(read_quarterly_csv(spark, path)) == by_pandas(path)


def test_several_files_each_with_its_own_header(spark, split_bytes, tmp_path):
    for k in range(3):
        write(str(tmp_path / f"{k}.csv"), [ROWS[0], *ROWS[1 + k:]])
    split_bytes(50)
    got = in_order(read_quarterly_csv(spark, str(tmp_path)))
    assert got == [r for k in range(3) for r in by_pandas(str(tmp_path / f"{k}.csv"))]


def test_without_line_breaks_the_plain_reader_is_used(spark, split_bytes, tmp_path):
    path = str(tmp_path / "q.csv")
    write(path, [r for r in ROWS if "\n" not in r[1]], always=True)
    split_bytes(30)
    got = read_quarterly_csv(spark, path)
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()
    assert in_order(got) == by_pandas(path)


def test_open_quotes_and_malformed_records(spark, split_bytes, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text('gvkey,note,atq\n1,"open,2\n3,x,4\n')
    with pytest.raises(ValueError, match="inside a quoted field"):
        read_quarterly_csv(spark, str(bad))
    short = tmp_path / "short.csv"
    short.write_text('gvkey,note,atq\n1,"a\nb",2\n3,x\n4,"y\nz",5,6\n')
    split_bytes(16)
    assert tuple(malformed_records(spark, str(short)).first()) == (3, 2)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_quarterly_csv(spark, str(short)).collect()
    assert read_quarterly_csv(spark, str(short), malformed="PERMISSIVE").count() == 3
