"""Train-only preprocessing.

fit:   ONE aggregate over the fit rows gives, per numeric column, the non-missing
       count, mean, population variance and exact median.  Mean and population std
       *after* median imputation follow exactly from the parallel-variance merge of
       the observed values with m copies of the median, so no second pass is needed.
       Levels are counted by one grouped aggregate for all categorical columns and
       stay a table (column, level, index, n) in the shared folder, with a dense index
       in (column, level) order; the most frequent level (lowest on ties) follows from
       its counts.  The number of levels has no limit and none is collected.
transform_sparse: impute and scale by expressions, join each category to the level
       table, and return the row as a sparse vector (size, indices, values).
transform: the wide form for models with few levels, one 0/1 column per level (all zeros
       for an unknown level); pure column expressions inside whole-stage codegen.  Only
       this form asks the level table for its names, one for each output column.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.quantiles import exact_quantiles
from panelforge.operators.splits import dense_index


LEVELS = "column string, level string, index long, n long"


@dataclass
class PreprocessModel:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)
    n_levels: int = 0
    level_table: DataFrame | None = field(default=None, compare=False, repr=False)

    def level_names(self) -> dict[str, list[str]]:
        """Names of the wide form's 0/1 columns."""
        names: dict[str, list[str]] = {c: [] for c in self.categorical}
        if self.categorical:
            for r in self.level_table.orderBy("index").collect():
                names[r["column"]].append(r["level"])
        return names

    def output_columns(self) -> list[str]:
        names = self.level_names()
        return list(self.numeric) + [f"{c}_{lv}" for c in self.categorical for lv in names[c]]

    def _scaled(self) -> list:
        return [((F.coalesce(F.col(c).cast("double"), F.lit(self.medians.get(c)).cast("double")) - F.lit(self.means[c]))
                 / F.lit(self.scales[c])).alias(c) for c in self.numeric]

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Scaled numerics, then one-hot columns; other columns dropped except ``keep``."""
        out, names = [*[F.col(k) for k in (keep or [])], *self._scaled()], self.level_names()
        for c in self.categorical:
            v = F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c)))
            for lv in names[c]:
                out.append(F.when(v == F.lit(lv), 1.0).otherwise(0.0).alias(f"{c}_{lv}"))
        return df.select(*out)

    def transform_sparse(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """``keep`` and ``features``: struct(size, indices, values) of the wide form's row, without a column per level.

        Numerics fill the places 0 .. len(numeric) - 1, level i the place len(numeric) + i; an unknown level has none."""
        p = len(self.numeric)
        cats = [F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c))).alias(f"_c{j}") for j, c in enumerate(self.categorical)]
        out = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keep or [])], F.array(*self._scaled()).cast("array<double>").alias("_v"), *cats)
        for j, c in enumerate(self.categorical):
            levels = self.level_table.where(F.col("column") == c).select(F.col("level").alias(f"_c{j}"), (F.col("index") + p).cast("int").alias(f"_i{j}"))
            out = out.join(levels, f"_c{j}", "left")
        hot = F.filter(F.array(*[F.col(f"_i{j}") for j in range(len(self.categorical))]).cast("array<int>"), lambda i: i.isNotNull())
        ones = F.transform(hot, lambda i: F.lit(1.0))
        places = F.array(*[F.lit(i) for i in range(p)]).cast("array<int>")
        return out.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep or [])], F.struct(
            F.lit(p + self.n_levels).alias("size"), F.concat(places, hot).alias("indices"), F.concat("_v", ones).alias("values")).alias("features"))

    # --- persistence (S10): a small JSON parameter document and the level table, written through Spark
    def to_json(self) -> str:
        return json.dumps({k: v for k, v in self.__dict__.items() if k != "level_table"}, sort_keys=True)

    @classmethod
    def from_json(cls, s: str) -> "PreprocessModel":
        return cls(**json.loads(s))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "params string").coalesce(1).write.mode("overwrite").json(f"{path}/params")
        table = self.level_table if self.level_table is not None else spark.createDataFrame([], LEVELS)
        table.write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PreprocessModel":
        model = cls.from_json(spark.read.json(f"{path}/params").first()["params"])
        model.level_table = spark.read.schema(LEVELS).parquet(f"{path}/levels")
        return model


def level_table(df: DataFrame, categorical: list[str]) -> DataFrame:
    """(column, level, index, n): the levels of all ``categorical`` columns with a dense index by column, then level."""
    seen = F.explode(F.array(*[F.struct(F.lit(j).alias("_p"), F.lit(c).alias("column"), F.col(c).cast("string").alias("level"))
                               for j, c in enumerate(categorical)]))
    counts = df.select(seen.alias("s")).select("s.*").where(F.col("level").isNotNull()).groupBy("_p", "column", "level").agg(
        F.count(F.lit(1)).alias("n"))
    return dense_index(counts, ["_p", "level"], out="index").select("column", "level", "index", "n").checkpoint(eager=True)


def median_mode_fit(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """A12 as a table: (column_name, kind, median, mode) with the exact median of each numeric
    column and the most frequent value (lowest on ties) of each categorical column."""
    m = fit_preprocess(df, numeric, categorical)
    rows = [(c, "median", m.medians[c], None) for c in numeric]
    rows += [(c, "mode", None, m.modes[c]) for c in categorical]
    return df.sparkSession.createDataFrame(rows, "column_name string, kind string, median double, mode string")


def fit_preprocess(train: DataFrame, numeric: list[str], categorical: list[str]) -> PreprocessModel:
    aggs = []
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.var_pop(x).alias(f"v{i}")]
    aggs.append(F.count(F.lit(1)).alias("_rows"))
    row = train.agg(*aggs).first()
    medians = exact_quantiles(train, numeric, 0.5)
    model = PreprocessModel(list(numeric), list(categorical))
    n = row["_rows"]
    for i, c in enumerate(numeric):
        na, mean_a, var_a = row[f"n{i}"], row[f"a{i}"], row[f"v{i}"]
        med = medians[c]
        model.medians[c] = med
        if na == 0 or n == 0:
            model.means[c], model.scales[c] = 0.0, 1.0
            continue
        m = n - na
        mean = (na * mean_a + m * med) / n
        m2 = na * var_a + (med - mean_a) ** 2 * na * m / n
        std = math.sqrt(max(m2 / n, 0.0))
        model.means[c] = mean
        model.scales[c] = std if std > 0 else 1.0
    if categorical:
        model.level_table = level_table(train, categorical)
        best = model.level_table.groupBy("column").agg(F.min(F.struct(-F.col("n"), "level")).alias("m"), F.count(F.lit(1)).alias("k")).collect()
        model.modes = {c: None for c in categorical} | {r["column"]: r["m"]["level"] for r in best}
        model.n_levels = sum(r["k"] for r in best)
    return model
