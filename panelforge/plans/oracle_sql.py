"""Independent DuckDB SQL for every SQL-checkable query, written from the definitions

The fixture CTEs are repeated in each statement.  Float outputs are rounded
at 6 digits on both sides (summation order differs between engines).
"""

from __future__ import annotations

# Dense panel: supplier x ship month.
DENSE_CTE = """
dense_lines AS (
  SELECT l.l_suppkey AS entity,
         CAST(year(l.l_shipdate) * 100 + month(l.l_shipdate) AS INTEGER) AS period,
         r.r_name AS category, p.p_brand AS brand, p.p_size, p.p_retailprice,
         l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
dense_brand AS (
  SELECT entity, period, brand, sum(l_extendedprice) AS bval
  FROM dense_lines GROUP BY entity, period, brand
),
dense_brand_ranked AS (
  SELECT entity, period, brand, bval,
         row_number() OVER (PARTITION BY entity, period ORDER BY bval DESC, brand) AS rk,
         sum(bval) OVER (PARTITION BY entity, period) AS tot
  FROM dense_brand
),
dense_conc AS (
  SELECT entity, period,
         CAST(count(*) AS BIGINT) AS n_brands,
         round(sum((bval / tot) * (bval / tot)), 6) AS hhi,
         round(sum(CASE WHEN rk = 1 THEN bval END) / max(tot) * 100, 6) AS top1_pct,
         round(sum(CASE WHEN rk <= 3 THEN bval END) / max(tot) * 100, 6) AS top3_pct
  FROM dense_brand_ranked GROUP BY entity, period
),
dense_cell AS (
  SELECT entity, period, category,
         round(avg(l_discount - l_tax) * 100, 6) AS ret,
         CAST(count(*) AS BIGINT) AS n_lines,
         round(sum(l_extendedprice), 6) AS aum,
         round(avg(CASE WHEN p_size <= 15 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100, 6) AS small_pct,
         round(avg(CASE WHEN p_size > 35 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100, 6) AS large_pct,
         round(avg(l_quantity), 6) AS avg_qty,
         round(avg(p_retailprice), 6) AS avg_retail,
         round(stddev_samp(l_quantity), 6) AS sd_qty
  FROM dense_lines GROUP BY entity, period, category
),
panel_dense AS (
  SELECT c.entity, c.period, c.category, c.ret, c.n_lines, k.n_brands, c.aum, k.hhi,
         k.top1_pct, k.top3_pct, c.small_pct, c.large_pct, c.avg_qty, c.avg_retail, c.sd_qty
  FROM dense_cell c JOIN dense_conc k ON c.entity = k.entity AND c.period = k.period
)"""

# Sparse panel: customer x order month.
SPARSE_CTE = """
panel_sparse AS (
  SELECT o.o_custkey AS entity,
         CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS INTEGER) AS period,
         c.c_mktsegment AS category,
         CAST(count(*) AS BIGINT) AS n_orders,
         round(sum(o.o_totalprice), 6) AS aum,
         round(stddev_samp(o.o_totalprice), 6) AS sd_price,
         round(avg(o.o_totalprice) / 100000 - 1, 9) AS ret
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY o.o_custkey, period, c.c_mktsegment
)"""


def split_cte(panel: str) -> str:
    """Rows in the order of their key hash, the first fifth (rounded up) is the test part."""
    return f"""
hashed AS (SELECT entity, period, row_number() OVER (ORDER BY CAST('0x' || substr(md5('42|' || CAST(entity AS VARCHAR) || '|'
                  || CAST(period AS VARCHAR)), 1, 13) AS BIGINT), entity, period) AS place, count(*) OVER () AS n FROM {panel}),
parts AS (SELECT entity, period, CASE WHEN place <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split FROM hashed)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def labelled_cte(panel: str = "panel_dense", target: str = "ret", name: str = "labelled",
                 train_end: int = 199912, val_end: int = 200012, test_end: int = 200112) -> str:
    """W1 + C2 from the definition: next row by period within entity, kept when it is
    exactly one calendar month later; split by target month."""
    return f"""
{name}_lead AS (
  SELECT p.*,
         lead({target}) OVER (PARTITION BY entity ORDER BY period) AS nxt_target,
         lead(period) OVER (PARTITION BY entity ORDER BY period) AS nxt_period
  FROM {panel} p
),
{name} AS (
  SELECT * EXCLUDE (nxt_target, nxt_period),
         nxt_target AS target,
         CAST(nxt_period AS INTEGER) AS target_month,
         CASE WHEN nxt_period <= {train_end} THEN 'train'
              WHEN nxt_period <= {val_end} THEN 'val'
              WHEN nxt_period <= {test_end} THEN 'test'
              ELSE 'prospective' END AS split
  FROM {name}_lead
  WHERE nxt_target IS NOT NULL
    AND ((nxt_period // 100) * 12 + nxt_period % 100) - ((period // 100) * 12 + period % 100) = 1
)"""


def preds_cte(fit_splits: str = "'train', 'val'", eval_split: str = "'test'") -> str:
    """Long holdout predictions of the five baselines, from their definitions."""
    return f"""
fit AS (SELECT * FROM labelled WHERE split IN ({fit_splits})),
hold AS (SELECT * FROM labelled WHERE split IN ({eval_split})),
fit_mean AS (SELECT avg(target) AS m FROM fit),
cat_mean AS (SELECT category, avg(target) AS cm FROM fit GROUP BY category),
ent_mean AS (SELECT entity, avg(target) AS em FROM fit GROUP BY entity),
preds AS (
  SELECT entity, period, target_month, category, split, target AS actual, 'zero_return' AS model,
         CAST(0 AS DOUBLE) AS pred FROM hold
  UNION ALL SELECT entity, period, target_month, category, split, target, 'persistence', ret FROM hold
  UNION ALL SELECT h.entity, h.period, h.target_month, h.category, h.split, h.target, 'category_mean',
                   coalesce(c.cm, (SELECT m FROM fit_mean))
            FROM hold h LEFT JOIN cat_mean c ON h.category = c.category
  UNION ALL SELECT h.entity, h.period, h.target_month, h.category, h.split, h.target, 'entity_mean',
                   coalesce(e.em, (SELECT m FROM fit_mean))
            FROM hold h LEFT JOIN ent_mean e ON h.entity = e.entity
  UNION ALL SELECT entity, period, target_month, category, split, target, 'development_mean',
                   (SELECT m FROM fit_mean) FROM hold
)"""
