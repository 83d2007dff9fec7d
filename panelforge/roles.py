"""Column roles and the sorted feature contract.

``ColumnRoles`` names the panel key, category, target and candidate numerics, and
lists the columns that must never reach a model (identifiers and target-derived
variables).  ``active_features`` is the contract of every design table: the
numerics minus the excluded ones, the raw size column replaced by its log, sorted.
``canonical`` renames a landed panel's identity columns to the names used by the
registered jobs (entity, period, category, ret).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnRoles:
    entity: str
    period: str
    category: str
    target: str
    numeric: tuple[str, ...]
    excluded: tuple[str, ...] = ()
    size: str | None = None
    log_size: str = "log_aum"
    ids: tuple[str, ...] = field(default=())

    def active_features(self, *, with_target: bool = False) -> list[str]:
        feats = [c for c in self.numeric if c not in self.excluded]
        if self.size in feats:
            feats.remove(self.size)
            feats.append(self.log_size)
        if with_target:
            feats.append(self.target)
        return sorted(set(feats))

    def prohibited(self) -> list[str]:
        return [c for c in self.excluded if c not in (self.entity, self.period, self.category)]


def select_features(df: DataFrame, roles: ColumnRoles, *, keys: bool = True, with_target: bool = False) -> DataFrame:
    """Key columns plus the sorted active features (Catalyst prunes the scan to them)."""
    feats = roles.active_features(with_target=with_target)
    missing = [c for c in feats if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    lead = [roles.entity, roles.period, roles.category] if keys else []
    return df.select(*[F.col(f"`{c}`") for c in [*lead, *feats]])


def canonical(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    """Rename the identity columns to entity / period / category / ret."""
    ren = {roles.entity: "entity", roles.period: "period", roles.category: "category", roles.target: "ret"}
    return df.select(*[F.col(f"`{c}`").alias(ren.get(c, c)) for c in df.columns])


# The reference's configured schema roles for its raw fund panel
# (identifiers, period, category, target, the 43 candidate numerics, the 22 excluded names).
REFERENCE_ROLES = ColumnRoles(
    entity="Scheme Name",
    period="TS_Month End",
    category="Category",
    target="Average",
    ids=("Scheme Code", "Scheme Name"),
    size="AUMT_AUM",
    log_size="log_AUM",
    numeric=(
        "TS_Total Equity Stocks Count", "TS_Top 1 Stocks (%)", "TS_Top 3 Stocks (%)", "TS_Top 10 Stocks (%)",
        "TS_Top 20 Stocks (%)", "TS_Top 30 Stocks (%)", "TS_Top 50 Stocks (%)", "TS_Total Sector Count",
        "TS_Top 1 Sectors (%)", "TS_Top 3 Sectors (%)", "TS_Top 5 Sectors (%)", "TS_Top 10 Sectors (%)",
        "AUMT_AUM", "ATAL_Cash & Cash Equivalents and Net Assets (%)", "MCA_Large Cap (%)", "MCA_Mid Cap (%)",
        "MCA_Small Cap (%)", "ER_Scheme PBV (x)", "ER_Scheme Dividend Yield (%)", "ER_Scheme PE (x)", "HHI", "SCI",
        "AALC_Equity Allocation (%)", "Standard Deviation", "Semi Standard Deviation", "Beta (Slope)",
        "Correlation", "Beta (Correlation)", "R-Squared", "Treynor", "Fama", "Sharpe", "Jensen`s Alpha", "Sortino",
        "Return due to Improper", "Return due to Selectivity", "Downside Probability", "Down Side Risk",
        "Tracking Error", "Information Ratio", "SD Annualised", "Concentration Sectoral_Avg Exposure",
        "Concentration Company_Avg Exposure",
    ),
    excluded=(
        "Scheme Code", "Scheme Name", "TS_Month End", "Category", "Return due to Selectivity",
        "Return due to Improper", "Standard Deviation", "Semi Standard Deviation", "Beta (Slope)", "Correlation",
        "Beta (Correlation)", "R-Squared", "Treynor", "Fama", "Sharpe", "Jensen`s Alpha", "Sortino",
        "Downside Probability", "Down Side Risk", "Tracking Error", "Information Ratio", "SD Annualised",
    ),
)

# Roles of the two panels derived from the driver's tables.
DENSE_ROLES = ColumnRoles(
    entity="entity", period="period", category="category", target="ret", size="aum", log_size="log_aum",
    numeric=("aum", "avg_qty", "avg_retail", "hhi", "large_pct", "n_brands", "n_lines", "sd_qty", "small_pct",
             "top1_pct", "top3_pct"),
    excluded=("entity", "period", "category"),
)
SPARSE_ROLES = ColumnRoles(
    entity="entity", period="period", category="category", target="ret", size="aum", log_size="log_aum",
    numeric=("aum", "n_orders", "sd_price"), excluded=("entity", "period", "category"),
)
