"""Input panels derived from the driver's TPC-H-style tables.

The two raw inputs the pipeline expects (a company x quarter accounting
panel and a security x day price panel) are not public, so equivalent
panels are derived from `orders`, `lineitem` by SQL: customers play the
companies, suppliers play the securities. These views only shape rows into
the expected schemas; all of the pipeline's work happens downstream in the
library's operators.

The SQL text is written once with `{table}` placeholders: DuckDB (the oracle)
runs it with table names substituted, Spark step by step with DataFrames bound
as arguments to `spark.sql`. The extra copies of rows, a UNION ALL in DuckDB, are
made in Spark from one pass over the panel.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import for_wide_rows

# Each panel as named steps, so that Spark gets plain nested plans: it tells that two plans read the
# same kept frame only where neither holds a WITH.
PANEL_Q_STEPS = {
    "q0": """
  SELECT o.o_custkey AS ck,
         last_day(CAST(date_trunc('quarter', o.o_orderdate) AS DATE) + INTERVAL '2' MONTH) AS datadate,
         CAST(year(o.o_orderdate) * 4 + quarter(o.o_orderdate) AS BIGINT) AS qn,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS ext,
         CAST(round(l.l_discount * 100) AS BIGINT) AS disc,
         CAST(round(l.l_tax * 100) AS BIGINT) AS tax,
         CAST(l.l_quantity AS BIGINT) AS qty,
         l.l_returnflag AS rf
  FROM {orders} o JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey""",
    "q1": """
  SELECT ck, datadate, qn,
         CAST(sum(ext) AS BIGINT) AS sale_c, CAST(sum(ext * (100 - disc)) AS BIGINT) AS net_c,
         CAST(sum(ext * tax) AS BIGINT) AS tax_c, CAST(sum(qty) AS BIGINT) AS qty,
         CAST(sum(CASE WHEN rf = 'R' THEN -ext ELSE ext END) AS BIGINT) AS ni_c
  FROM {q0} GROUP BY ck, datadate, qn""",
    "panel_q": """
SELECT CAST(ck AS STRING) AS gvkey, datadate,
       CASE WHEN ck % 13 = 0 THEN NULL ELSE CAST(50 + (ck * 37) % 9950 AS DOUBLE) END AS sic,
       CASE WHEN ck % 5 = 0 THEN ' a ' WHEN ck % 17 = 0 THEN 'null' ELSE 'I' END AS costat,
       'usd' AS curcdq,
       concat(' c', lpad(CAST(ck % 90 AS STRING), 7, '0'), '9 ') AS cusip,
       CASE WHEN (ck * 7 + qn) % 23 = 0 THEN -CAST(sale_c AS DOUBLE) / 100 ELSE CAST(sale_c AS DOUBLE) / 100 END AS saleq,
       CAST(net_c AS DOUBLE) / 10000 AS cogsq,
       CASE WHEN (ck + qn) % 11 = 0 THEN NULL ELSE CAST(ni_c AS DOUBLE) / 100 END AS niq,
       CAST(sale_c AS DOUBLE) / 20 + 1000 AS atq,
       CASE WHEN (ck + qn) % 29 = 0 THEN 0 ELSE CAST(sale_c AS DOUBLE) / 40 END AS ltq,
       CAST(qty AS DOUBLE) * 10 AS actq,
       CASE WHEN qty % 7 = 0 THEN 0 ELSE CAST(qty AS DOUBLE) * 6 END AS lctq,
       CASE WHEN (ck + qn) % 8 = 0 THEN -CAST(sale_c AS DOUBLE) / 200 ELSE CAST(sale_c AS DOUBLE) / 400 END AS dlttq,
       CAST(net_c AS DOUBLE) / 50000 AS xsgaq,
       CAST(sale_c AS DOUBLE) / 100 - CAST(net_c AS DOUBLE) / 12500 AS oibdpq,
       CASE WHEN (ck + qn) % 3 = 0 THEN NULL ELSE CAST(qty AS DOUBLE) END AS rstcheq,
       CASE WHEN (ck + qn) % 37 = 0 THEN 1.5 ELSE NULL END AS rstcheltq,
       CAST(CAST(sum(tax_c) OVER (PARTITION BY ck, year(datadate) ORDER BY datadate) AS BIGINT) AS DOUBLE) / 10000 AS oancfy,
       CASE WHEN (ck + qn) % 7 = 0 THEN NULL ELSE CAST(qty * (qn % 4 + 1) AS DOUBLE) END AS capxy,
       qn
FROM {q1}
""",
}

PANEL_Q_RAW_SQL = """
SELECT * FROM {panel_q}
UNION ALL
SELECT * FROM {panel_q} WHERE CAST(gvkey AS INT) % 97 = 0
UNION ALL
SELECT gvkey, datadate, sic, costat, curcdq, cusip, saleq, cogsq, CAST(NULL AS DOUBLE) AS niq, atq, ltq, actq, lctq,
       dlttq, xsgaq, oibdpq, rstcheq, rstcheltq, oancfy, capxy, qn
FROM {panel_q} WHERE CAST(gvkey AS INT) % 89 = 0 AND niq IS NOT NULL
UNION ALL
SELECT CASE WHEN CAST(gvkey AS INT) % 2 = 0 THEN 'no digits' ELSE gvkey END AS gvkey,
       CASE WHEN CAST(gvkey AS INT) % 2 = 0 THEN datadate ELSE CAST(NULL AS DATE) END AS datadate,
       sic, costat, curcdq, cusip, saleq, cogsq, niq, atq, ltq, actq, lctq,
       dlttq, xsgaq, oibdpq, rstcheq, rstcheltq, oancfy, capxy, qn
FROM {panel_q} WHERE CAST(gvkey AS INT) % 11 = 0 AND qn % 8 = 1
"""

PANEL_D_STEPS = {
    "d0": """
  SELECT l_suppkey AS sk, CAST(l_shipdate AS DATE) AS dt,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS ext,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
  FROM {lineitem} GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "d1": """SELECT sk, dt, qty, CAST(ext AS DOUBLE) / CAST(qty AS DOUBLE) / 100 AS prc FROM {d0}""",
    "d2": """SELECT sk, dt, qty, prc, lag(prc) OVER (PARTITION BY sk ORDER BY dt) AS p0 FROM {d1}""",
    "d3": """
SELECT CAST(sk AS INT) AS PERMNO, CAST(sk % 80 AS INT) AS PERMCO,
       concat('c', lpad(CAST(sk % 60 AS STRING), 7, '0')) AS HdrCUSIP,
       CASE WHEN sk % 3 = 0 THEN 'n' WHEN sk % 3 = 1 THEN 'q ' ELSE '' END AS PrimaryExch,
       'NS' AS ShareType, concat('t', CAST(sk AS STRING)) AS Ticker, dt AS DlyCalDt,
       CASE WHEN (sk + day(dt)) % 19 = 0 THEN -prc ELSE prc END AS DlyPrc,
       CASE WHEN (sk + day(dt)) % 31 = 0 THEN NULL ELSE (prc - p0) / p0 / 20 END AS DlyRet,
       CAST(qty AS DOUBLE) AS DlyVol,
       CASE WHEN sk % 25 = 0 THEN NULL ELSE CAST(1000 + sk AS DOUBLE) END AS ShrOut
FROM {d2}""",
}
PANEL_D_RAW_SQL = """
SELECT * FROM {d3}
UNION ALL
SELECT CASE WHEN PERMNO % 3 = 0 THEN NULL ELSE PERMNO END AS PERMNO, PERMCO,
       CASE WHEN PERMNO % 3 = 1 THEN NULL ELSE HdrCUSIP END AS HdrCUSIP,
       PrimaryExch, ShareType, Ticker, CASE WHEN PERMNO % 3 = 2 THEN NULL ELSE DlyCalDt END AS DlyCalDt,
       DlyPrc, DlyRet, DlyVol, ShrOut
FROM {d3} WHERE day(DlyCalDt) = 7
"""


def _with(steps: dict[str, str], last: str) -> str:
    """The steps and a statement that reads them as one statement for DuckDB, with placeholders for the tables."""
    named = {name: f"{{{name}}}" for name in re.findall(r"\{(\w+)\}", " ".join([*steps.values(), last]))} | {name: name for name in steps}
    ctes = ",\n".join(f"{name} AS ({sql.format(**named)})" for name, sql in steps.items())
    return f"\nWITH {ctes}\n{last.format(**named)}"


PANEL_Q_SQL = _with({n: t for n, t in PANEL_Q_STEPS.items() if n != "panel_q"}, PANEL_Q_STEPS["panel_q"].strip("\n") + "\n")
PANEL_D_SQL = _with(PANEL_D_STEPS, PANEL_D_RAW_SQL.strip("\n") + "\n")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cache_dir(spark: SparkSession) -> str | None:
    try:
        return spark.conf.get("ledgerlake.fixture.cache") or None
    except Exception:  # noqa: BLE001
        return None


def source_key(spark: SparkSession, sf_dir: str) -> tuple[str, str | None]:
    """What the derived panels are read from: equal keys, equal frames."""
    return os.path.normpath(sf_dir), _cache_dir(spark)


def _maybe_materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """When `ledgerlake.fixture.cache` is set (bench), write each derived input
    once as parquet and read it back, as a real pipeline reads its input files."""
    for_wide_rows(spark)
    cache = _cache_dir(spark)
    if not cache:
        return build()
    from ledgerlake.session import path_exists

    tag = os.path.basename(os.path.normpath(sf_dir))
    path = f"{cache.rstrip('/')}/{tag}/{name}.parquet"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _run_steps(spark: SparkSession, steps: dict[str, str], **tables: DataFrame) -> DataFrame:
    """The last of some steps, each a statement over the tables and the steps before it."""
    for name, sql in steps.items():
        used = set(re.findall(r"\{(\w+)\}", sql))
        tables[name] = spark.sql(sql, **{n: t for n, t in tables.items() if n in used})
    return tables[name]


def _with_copies(df: DataFrame, *conditions: str) -> DataFrame:
    """Each row as copy 0, and as copy k where condition k holds: what a UNION ALL of filters
    gives, with the rows computed once."""
    copies = ", ".join(f"IF({c}, {k}, NULL)" for k, c in enumerate(conditions, 1))
    return df.withColumn("_copy", F.explode(F.expr(f"filter(array(0, {copies}), x -> x IS NOT NULL)")))


def panel_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company x quarter accounting panel, one row per (gvkey, datadate)."""
    def build():
        return _run_steps(spark, PANEL_Q_STEPS, orders=table(spark, sf_dir, "orders"),
                          lineitem=table(spark, sf_dir, "lineitem"))
    return _maybe_materialized(spark, sf_dir, "panel_q", build)


def panel_q_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounting panel with exact and key duplicates, as delivered raw: the rows of PANEL_Q_RAW_SQL."""
    def build():
        panel = panel_q(spark, sf_dir)
        copied = _with_copies(panel, "CAST(gvkey AS INT) % 97 = 0", "CAST(gvkey AS INT) % 89 = 0 AND niq IS NOT NULL",
                              "CAST(gvkey AS INT) % 11 = 0 AND qn % 8 = 1")
        changed = {
            "gvkey": F.expr("IF(_copy = 3 AND CAST(gvkey AS INT) % 2 = 0, 'no digits', gvkey)"),
            "datadate": F.expr("IF(_copy = 3 AND CAST(gvkey AS INT) % 2 <> 0, NULL, datadate)"),
            "niq": F.expr("IF(_copy = 2, NULL, niq)"),
        }
        return copied.select(*[changed.get(c, F.col(c)).alias(c) for c in panel.columns])
    return _maybe_materialized(spark, sf_dir, "panel_q_raw", build)


def panel_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Security x day price panel: the rows of PANEL_D_SQL."""
    def build():
        daily = _run_steps(spark, PANEL_D_STEPS, lineitem=table(spark, sf_dir, "lineitem"))
        copied = _with_copies(daily, "day(DlyCalDt) = 7")
        changed = {c: F.expr(f"IF(_copy = 1 AND PERMNO % 3 = {k}, NULL, {c})") for k, c in enumerate(("PERMNO", "HdrCUSIP", "DlyCalDt"))}
        return copied.select(*[changed.get(c, F.col(c)).alias(c) for c in daily.columns])
    return _maybe_materialized(spark, sf_dir, "panel_d", build)


def as_text(df: DataFrame) -> DataFrame:
    """Every column rendered as text: the shape a header-only CSV read gives."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def duckdb_ctes() -> str:
    """The three views as DuckDB CTE definitions (no leading WITH)."""
    q = PANEL_Q_SQL.format(orders="orders", lineitem="lineitem")
    raw = PANEL_Q_RAW_SQL.format(panel_q="panel_q")
    d = PANEL_D_SQL.format(lineitem="lineitem")
    return f"panel_q AS ({q}),\npanel_q_raw AS ({raw}),\npanel_d AS ({d})"
