"""End-to-end runs and the remaining inventory items as registered queries
(P2, W2, V15, V17, S3/S5 round trip, forecasting and explanatory comparisons)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import validate as va
from panelforge.operators.panel import log_aum
from panelforge.plans.catalog import ORACLE, register
from panelforge.plans.explanatory import run_explanatory
from panelforge.plans.forecasting import run_forecasting
from panelforge.plans.frames import labelled, panel
from panelforge.plans.oracle_sql import DENSE_CTE, SPARSE_CTE, labelled_cte, with_ctes
from panelforge.plans.q_streaming import scratch
from panelforge.plans.validation import run_validation
from panelforge.roles import DENSE_ROLES, select_features
from panelforge.sources.panels import DENSE_FEATURES
from panelforge.sources.scan import scan_processed
from panelforge.sources.sinks import sink_processed

_ACTIVE = DENSE_ROLES.active_features()


@register("select_features", with_ctes(f"""
SELECT entity, period, category, {', '.join(c if c != 'log_aum' else 'CASE WHEN aum >= 0 THEN ln(1 + aum) END AS log_aum'
                                            for c in _ACTIVE)}
FROM panel_dense""", DENSE_CTE))
def select_features_q(spark, sf_dir):
    """P1 + P2: keys plus the sorted active features (raw size replaced by its log)."""
    df = select_features(log_aum(panel(spark, sf_dir, "dense")), DENSE_ROLES)
    return df.select(*[F.round(c, 6).alias(c) if c == "log_aum" else F.col(c) for c in df.columns])


ORACLE["select_features"] = ORACLE["select_features"].replace(
    "CASE WHEN aum >= 0 THEN ln(1 + aum) END AS log_aum", "round(CASE WHEN aum >= 0 THEN ln(1 + aum) END, 6) AS log_aum")


@register("lag_feature", with_ctes("""
SELECT entity, target_month, ret AS lag_ret, target FROM labelled""", SPARSE_CTE, labelled_cte("panel_sparse")))
def lag_feature_q(spark, sf_dir):
    """The current month's return is the AR(1) feature of next month's target."""
    return labelled(spark, sf_dir, "sparse").select("entity", "target_month", F.col("ret").alias("lag_ret"), "target")


def _landed_csv(spark, sf_dir) -> tuple[str, str]:
    """A CSV drop of the dense panel in the shared folder: every row of 200001 twice, and a text in place of the
    amount in the rows of 199601 whose entity is divisible by 5. Returns its path and the declared schema."""
    p = panel(spark, sf_dir, "dense")
    bad = (F.col("entity") % 5 == 0) & (F.col("period") == 199601)
    text = p.withColumn("aum", F.when(bad, F.lit("n/a")).otherwise(F.col("aum").cast("string")))
    path = scratch(spark, "landing")
    text.unionByName(text.where("period = 200001")).write.option("header", "true").csv(path)
    return path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in p.schema.fields)


@register("validate_run", with_ctes("""
SELECT 'rejected_lines' AS check_name, CAST(count(*) AS BIGINT) AS n FROM panel_dense WHERE entity % 5 = 0 AND period = 199601
UNION ALL SELECT 'rows', count(*) FROM good
UNION ALL SELECT 'missing_values', count(*) FROM good WHERE sd_qty IS NULL
UNION ALL SELECT 'duplicate_rows', count(*) FROM panel_dense WHERE period = 200001
UNION ALL SELECT 'infinite_columns', 0 UNION ALL SELECT 'invalid_probability_columns', 0
UNION ALL SELECT 'negative_risk_columns', 0 UNION ALL SELECT 'constant_columns', 0
UNION ALL SELECT 'absent_columns', 1 UNION ALL SELECT 'prohibited_columns', 1
UNION ALL SELECT 'interim_rows', count(*) FROM (SELECT DISTINCT * FROM good)""", DENSE_CTE, """
good AS (SELECT * FROM panel_dense WHERE NOT (entity % 5 = 0 AND period = 199601)
         UNION ALL SELECT * FROM panel_dense WHERE period = 200001)"""))
def validate_run_q(spark, sf_dir):
    """The validation stage on a landed CSV drop: rejects, V1-V10, deduplicated interim panel published and read back."""
    drop, schema = _landed_csv(spark, sf_dir)
    return run_validation(spark, drop, schema, scratch(spark, "interim"), required=[*DENSE_FEATURES, "expense_ratio"],
                          target="ret", prohibited=["aum", "target"])["report"]


@register("interim_panel", with_ctes("""
SELECT DISTINCT entity, period, category, ret, aum, sd_qty FROM panel_dense WHERE NOT (entity % 5 = 0 AND period = 199601)""", DENSE_CTE))
def interim_panel_q(spark, sf_dir):
    """S1 -> S4 (O1) -> S2: the rows of the published interim panel."""
    drop, schema = _landed_csv(spark, sf_dir)
    out = run_validation(spark, drop, schema, scratch(spark, "interim"), required=DENSE_FEATURES, target="ret")
    return out["panel"].select("entity", "period", "category", "ret", "aum", "sd_qty")


@register("drop_counts", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_entities,
       CAST(count(DISTINCT strftime(o_orderdate, '%Y%m')) AS BIGINT) AS n_periods,
       CAST((SELECT count(*) FROM (DESCRIBE orders)) AS BIGINT) AS n_columns FROM orders""")
def drop_counts_q(spark, sf_dir):
    """V15 without the digest: rows, distinct customers and months, columns of the file's own footer."""
    return drop_profile_q(spark, sf_dir).select("n_rows", "n_entities", "n_periods", "n_columns")


@register("drop_profile")
def drop_profile_q(spark, sf_dir):
    """SHA-256, bytes, rows, columns, distinct customers and months of the landed orders file."""
    return va.drop_profile(spark, f"{sf_dir.rstrip('/')}/orders.parquet", entity="o_custkey",
                           period=F.date_format("o_orderdate", "yyyyMM"))


def _drift_sql() -> str:
    from panelforge.sources.panels import DENSE_COLUMNS

    def prof(src: str) -> str:
        parts = [f"""SELECT '{c}' AS column_name,
       CASE (SELECT typeof({c}) FROM {src} LIMIT 1) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
            WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' END AS data_type,
       CASE WHEN count(*) > 0 THEN (count(*) - count({c})) / count(*) ELSE 0 END AS null_rate
FROM {src}""" for c in DENSE_COLUMNS]
        return "\nUNION ALL ".join(parts)
    return with_ctes("""
SELECT coalesce(a.column_name, b.column_name) AS column_name, a.data_type AS active_type,
       a.null_rate AS active_null_rate, b.data_type AS new_type, b.null_rate AS new_null_rate,
       CASE WHEN a.data_type IS NULL THEN 'added' WHEN b.data_type IS NULL THEN 'removed'
            WHEN a.data_type <> b.data_type THEN 'type_changed'
            WHEN abs(b.null_rate - a.null_rate) > 0.05 THEN 'null_rate_shift' ELSE 'unchanged' END AS status
FROM prof_a a FULL OUTER JOIN prof_b b ON a.column_name = b.column_name""", DENSE_CTE, f"""
drop_a AS (SELECT * FROM panel_dense WHERE period < 200001),
drop_b AS (SELECT * FROM panel_dense WHERE period >= 200001),
prof_a AS ({prof("drop_a")}),
prof_b AS ({prof("drop_b")})""")


@register("schema_drift", _drift_sql())
def schema_drift_q(spark, sf_dir):
    """Column profile of the 1990s drop of the dense panel against the 2000s drop."""
    p = panel(spark, sf_dir, "dense")
    return va.schema_drift(p.where(F.col("period") < 200001), p.where(F.col("period") >= 200001))


@register("processed_roundtrip", ORACLE["preprocess"])
def processed_roundtrip_q(spark, sf_dir):
    """S5 -> S3: the T1 design table written partitioned by split and read back."""
    from panelforge.plans.q_models import preprocess_q
    root = scratch(spark, "processed")
    sink_processed(preprocess_q(spark, sf_dir), root, "forecasting")
    return scan_processed(spark, root, "forecasting")


@register("forecasting_comparison")
def forecasting_comparison_q(spark, sf_dir):
    """Forecasting run on the dense panel: validation comparison of ridge, elastic net, tree,
    mean and the four baselines (walk-forward CV inside)."""
    return run_forecasting(panel(spark, sf_dir, "dense"), DENSE_FEATURES)["comparison"]


@register("explanatory_comparison")
def explanatory_comparison_q(spark, sf_dir):
    """Explanatory run on the dense panel (random split): train / test comparison of every model."""
    return run_explanatory(panel(spark, sf_dir, "dense"), DENSE_FEATURES)["comparison"]
