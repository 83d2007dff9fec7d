"""Entity x month panels derived from the driver's star schema (FIXTURES.md part B).

``panel_dense``  supplier x ship month (lineitem, part, supplier, nation, region)
``panel_sparse`` customer x order month (orders, customer)

Scale notes
-----------
* lineitem is narrowed to what the panel needs before the part join and dealt by
  (entity, period) right after it; the aggregate to (supplier, month, brand), the
  brand ranking and the cell aggregate share that one exchange.  Most (supplier,
  month, brand) groups hold a line or two, so a map-side aggregate collapsed
  next to nothing and the wider aggregates were shuffled twice.  A hot supplier
  spreads over its months, a hot month over its suppliers, and a task aggregates
  the lines of a cell as it reads them: its memory holds the cell's brands only.
* The supplier -> nation -> region lookup is joined to the *aggregated* cells,
  not to lineitem.  nation / region are TPC-H fixed-size dimensions (25 / 5
  rows); the join strategy for supplier is left to AQE's runtime size check.
* orders are aggregated per (customer, month) before the customer join.
* Variance of quantity is merged from (n, sum, sum of squares); quantities are
  small integers, so the sums are exact in double precision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions.periods import yyyymm
from panelforge.sources.tables import read_table

DENSE_COLUMNS = ["entity", "period", "category", "ret", "n_lines", "n_brands", "aum", "hhi",
                 "top1_pct", "top3_pct", "small_pct", "large_pct", "avg_qty", "avg_retail", "sd_qty"]
DENSE_FEATURES = ["aum", "avg_qty", "avg_retail", "hhi", "large_pct", "n_brands", "n_lines",
                  "sd_qty", "small_pct", "top1_pct", "top3_pct"]
SPARSE_COLUMNS = ["entity", "period", "category", "n_orders", "aum", "sd_price", "ret"]
SPARSE_FEATURES = ["aum", "n_orders", "sd_price"]


def _region_of_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    # nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions.
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return (supplier.join(F.broadcast(geo), supplier.s_nationkey == geo.n_nationkey)
            .select(F.col("s_suppkey").alias("entity"), F.col("r_name").alias("category")))


def panel_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_shipdate"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size", "p_retailprice"])
    li = li.select("l_partkey", F.col("l_suppkey").alias("entity"), yyyymm("l_shipdate").alias("period"),
                   "l_quantity", "l_extendedprice", (F.col("l_discount") - F.col("l_tax")).alias("dt"))
    lines = (li.join(part, li.l_partkey == part.p_partkey)
             .select("entity", "period", F.col("p_brand").alias("brand"), "l_quantity", "l_extendedprice", "dt",
                     "p_retailprice", "p_size")
             .repartition("entity", "period"))
    by_brand = lines.groupBy("entity", "period", "brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_extendedprice").alias("bval"),
        F.sum("dt").alias("s_dt"),
        F.sum("l_quantity").alias("s_q"),
        F.sum(F.col("l_quantity") * F.col("l_quantity")).alias("s_q2"),
        F.sum("p_retailprice").alias("s_retail"),
        F.sum(F.when(F.col("p_size") <= 15, 1).otherwise(0)).alias("n_small"),
        F.sum(F.when(F.col("p_size") > 35, 1).otherwise(0)).alias("n_large"),
    )
    cell_w = Window.partitionBy("entity", "period").orderBy(F.col("bval").desc(), F.col("brand"))
    ranked = by_brand.withColumn("rk", F.row_number().over(cell_w))
    n = F.sum("n")
    s_q = F.sum("s_q")
    tot = F.sum("bval")
    var_q = F.when(n > 1, F.greatest(F.lit(0.0), (n * F.sum("s_q2") - s_q * s_q) / (n * (n - 1))))
    cells = ranked.groupBy("entity", "period").agg(
        F.round(F.sum("s_dt") / n * 100, 6).alias("ret"),
        n.cast("long").alias("n_lines"),
        F.count(F.lit(1)).cast("long").alias("n_brands"),
        F.round(tot, 6).alias("aum"),
        F.round(F.sum(F.col("bval") * F.col("bval")) / (tot * tot), 6).alias("hhi"),
        F.round(F.sum(F.when(F.col("rk") == 1, F.col("bval"))) / tot * 100, 6).alias("top1_pct"),
        F.round(F.sum(F.when(F.col("rk") <= 3, F.col("bval"))) / tot * 100, 6).alias("top3_pct"),
        F.round(F.sum("n_small") / n * 100, 6).alias("small_pct"),
        F.round(F.sum("n_large") / n * 100, 6).alias("large_pct"),
        F.round(s_q / n, 6).alias("avg_qty"),
        F.round(F.sum("s_retail") / n, 6).alias("avg_retail"),
        F.round(F.sqrt(var_q), 6).alias("sd_qty"),
    )
    return (cells.join(_region_of_supplier(spark, sf_dir), "entity")
            .select(*DENSE_COLUMNS))


def panel_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    cells = (orders.select(F.col("o_custkey").alias("entity"), yyyymm("o_orderdate").alias("period"),
                           "o_totalprice")
             .groupBy("entity", "period")
             .agg(F.count(F.lit(1)).cast("long").alias("n_orders"),
                  F.round(F.sum("o_totalprice"), 6).alias("aum"),
                  F.round(F.stddev_samp("o_totalprice"), 6).alias("sd_price"),
                  F.round(F.avg("o_totalprice") / 100000 - 1, 9).alias("ret")))
    cust = customer.select(F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("category"))
    return cells.join(cust, "entity").select(*SPARSE_COLUMNS)


def raw_drops(panel: DataFrame, *, first_end: int = 200012, second_start: int = 200001) -> DataFrame:
    """Two landed drops of the dense panel that overlap in year 2000, stacked as a raw
    ingestion would see them: the overlap produces exact duplicate rows and keys."""
    return panel.filter(F.col("period") <= first_end).unionByName(
        panel.filter(F.col("period") >= second_start))
