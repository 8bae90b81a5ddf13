"""Panel views derived from the driver's test tables.

The reference reads a daily store-traffic panel plus store, oil and holiday
tables. The test tables are a TPC-H-like star schema, so the same shapes are
derived from them (one row per series and ship date). A series is a supplier,
so the panel grows with the data; the per-series model jobs use the panel
whose series are the 25 nations, since they need longer series:

    tx        (store_nbr, date, transactions)     lineitem [x supplier]
    stores    (store_nbr, city, type, cluster)    supplier x nation, or nation
    oil       (date, dcoilwtico)                  daily max order price, null on weekends
    holidays  (date, type, locale, transferred)   calendar rule on ship dates

``with_views`` puts the same definitions in DuckDB SQL before a query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.core import iso_weekday, sized_broadcast

# Fixture split dates (the panel spans 1995..2001).
TRAIN_END = "1999-12-31"
VAL_END = "2000-12-31"


@dataclass
class Panel:
    tx: DataFrame
    stores: DataFrame
    oil: DataFrame
    holidays: DataFrame


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and change times of the table files: a rewritten folder has another state."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(sf_dir)
    listed = path.getFileSystem(conf).listStatus(path)
    return (sf_dir, *sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed))


def tx_view(spark: SparkSession, sf_dir: str, by: str = "supplier") -> DataFrame:
    """Rows per series and ship date. ``by="supplier"``: one series per supplier, so the number of series grows with
    the data; ``by="nation"``: 25 long series, for the jobs that need more rows per series than a supplier has."""
    li = _read(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate")
    if by == "supplier":
        key = F.col("l_suppkey")
    else:
        sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        # supplier grows with the data: hinted only under the size bound,
        # otherwise the planner joins by shuffle on the supplier key (AQE splits a hot key).
        li = li.join(sized_broadcast(sup), li.l_suppkey == sup.s_suppkey)
        key = F.col("s_nationkey")
    return li.groupBy((key.cast("bigint") + 1).alias("store_nbr"), F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("transactions"))


def stores_view(spark: SparkSession, sf_dir: str, by: str = "supplier") -> DataFrame:
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    key = F.col("n_nationkey")
    if by == "supplier":
        sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        n, key = sup.join(sized_broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")), F.col("s_suppkey")
    return n.select(
        (key.cast("bigint") + 1).alias("store_nbr"),
        F.col("n_name").alias("city"),
        F.substring(F.lit("ABCDE"), F.col("n_regionkey").cast("int") + 1, 1).alias("type"),
        (F.col("n_nationkey") % 17 + 1).cast("bigint").alias("cluster"),
    )


def oil_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    daily = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("mx"))
    return daily.select(
        "date",
        F.when(iso_weekday("date") <= 5, F.col("mx") / 1000).alias("dcoilwtico"),
    )


def holidays_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar rows on ship dates (one scan of lineitem): days 1, 10, 20
    and 25 December; 25 December also carries an extra national row."""
    li = _read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    m, d = F.month("date"), F.dayofmonth("date")
    xmas = (m == 12) & (d == 25)
    dates = li.where(d.isin(1, 10, 20) | xmas).distinct()
    mm = m % 6
    typ = (
        F.when(mm == 0, "Holiday").when(mm == 1, "Event").when(mm == 2, "Additional")
        .when(mm == 3, "Transfer").when(mm == 4, "Bridge").otherwise("Work Day")
    )
    loc = F.when(d.isin(1, 25), "National").when(d == 10, "Regional").otherwise("Local")
    rule = F.struct(typ.alias("type"), loc.alias("locale"), ((m % 4 == 0) & (d == 1)).alias("transferred"))
    extra = F.struct(F.lit("Additional").alias("type"), F.lit("National").alias("locale"),
                     F.lit(False).alias("transferred"))
    rows = F.when(xmas, F.array(rule, extra)).otherwise(F.array(rule))
    return dates.select("date", F.explode(rows).alias("_h")).select("date", "_h.type", "_h.locale", "_h.transferred")


def panel(spark: SparkSession, sf_dir: str, by: str = "supplier") -> Panel:
    """The four views of one table folder (lazy plans; nothing is cached or remembered)."""
    return Panel(
        tx=tx_view(spark, sf_dir, by),
        stores=stores_view(spark, sf_dir, by),
        oil=oil_view(spark, sf_dir),
        holidays=holidays_view(spark, sf_dir),
    )


# Same views in DuckDB SQL (tables lineitem, supplier, nation, orders are
# registered by the checker).
SERIES_CTES = {
    "supplier": """
tx AS (
  SELECT CAST(l_suppkey AS BIGINT) + 1 AS store_nbr, CAST(l_shipdate AS DATE) AS date,
         COUNT(*) AS transactions
  FROM lineitem GROUP BY 1, 2
),
stores AS (
  SELECT CAST(s_suppkey AS BIGINT) + 1 AS store_nbr, n_name AS city,
         substr('ABCDE', CAST(n_regionkey AS INTEGER) + 1, 1) AS type,
         CAST(n_nationkey % 17 + 1 AS BIGINT) AS cluster
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),""",
    "nation": """
tx AS (
  SELECT CAST(s_nationkey AS BIGINT) + 1 AS store_nbr, CAST(l_shipdate AS DATE) AS date,
         COUNT(*) AS transactions
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
),
stores AS (
  SELECT CAST(n_nationkey AS BIGINT) + 1 AS store_nbr, n_name AS city,
         substr('ABCDE', CAST(n_regionkey AS INTEGER) + 1, 1) AS type,
         CAST(n_nationkey % 17 + 1 AS BIGINT) AS cluster
  FROM nation
),""",
}
CALENDAR_CTES = """
oil AS (
  SELECT date, CASE WHEN isodow(date) <= 5 THEN mx / 1000 END AS dcoilwtico
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS mx FROM orders GROUP BY 1) t
),
holidays AS (
  SELECT date,
    CASE month(date) % 6 WHEN 0 THEN 'Holiday' WHEN 1 THEN 'Event' WHEN 2 THEN 'Additional'
                         WHEN 3 THEN 'Transfer' WHEN 4 THEN 'Bridge' ELSE 'Work Day' END AS type,
    CASE day(date) WHEN 1 THEN 'National' WHEN 25 THEN 'National' WHEN 10 THEN 'Regional'
                   ELSE 'Local' END AS locale,
    (month(date) % 4 = 0 AND day(date) = 1) AS transferred
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) t
  WHERE day(date) IN (1, 10, 20) OR (month(date) = 12 AND day(date) = 25)
  UNION ALL
  SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, 'Additional' AS type, 'National' AS locale,
         false AS transferred
  FROM lineitem WHERE month(l_shipdate) = 12 AND day(l_shipdate) = 25
)"""


def with_views(select: str, *ctes: str, by: str = "supplier") -> str:
    """``WITH <fixture views>[, extra ctes] <select>`` for DuckDB."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {SERIES_CTES[by]}{CALENDAR_CTES}{extra}\n{select}"
