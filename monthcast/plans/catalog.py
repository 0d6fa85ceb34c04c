"""Query catalogue: one Spark plan per operator of the inventory, each paired
(where SQL can say it) with an independent DuckDB statement over the same
parquet tables. Keys are the inventory's query names.

Doubles derived through floating aggregation are rounded to 6 places on both
sides, since summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import labels as L
from ..operators import news as N
from ..operators import series as S
from . import oracle_sql as Q
from . import standins as SI
from .feature_table import build_feature_table

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)


def _load_all() -> None:
    # catalogue parts register on import
    from . import catalog_more  # noqa: F401


ENGINE_DEPENDENT = {"ppi_ma_3", "ppi_std_3", "low_cut", "high_cut"}


def rounded(df: DataFrame, cols=None, places: int = 6) -> DataFrame:
    """Round the DOUBLE columns whose last bits depend on the engine's
    algorithm (window mean/std, percentile interpolation). Values computed by
    identical IEEE operations (exact decimal sums, divisions, lags) are left
    alone: rounding them would only create tie-breaking differences."""
    names = set(ENGINE_DEPENDENT if cols is None else cols)
    return df.select(*[F.round(F.col(f.name), places).alias(f.name)
                       if f.name in names and isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------------------
# Stand-in pieces shared by several queries
# ---------------------------------------------------------------------------

def ppi_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SI.price_series(spark, sf_dir).withColumnRenamed("date", "month")


def clean_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.clean_news(SI.raw_news(spark, sf_dir))


def feature_table(spark: SparkSession, sf_dir: str, keep_unlabelled: bool = False) -> DataFrame:
    return build_feature_table(
        SI.price_series(spark, sf_dir), clean_news(spark, sf_dir), SI.lexicon(spark),
        indicators=SI.indicators(spark, sf_dir), keywords=SI.STANDIN_KEYWORDS,
        keep_unlabelled=keep_unlabelled, id_col="doc_id", **SI.sentiment_rules())


# ---------------------------------------------------------------------------
# 1. Minimum slice: series -> features -> target -> class
# ---------------------------------------------------------------------------

@register("monthly_mean", f"""
WITH {Q.WTI}
SELECT month, wti_oil_price FROM wti
""")
def q_monthly_mean(spark, sf_dir):
    li = SI.table(spark, sf_dir, "lineitem")
    return rounded(S.monthly_mean(li, "l_shipdate", "l_extendedprice", "wti_oil_price", exact_scale=2))


@register("series_features", f"""
WITH {Q.PPI},{Q.series_feature_ctes()}
SELECT month, ppi_value, ppi_pct_change, ppi_lag_1, ppi_pct_change_lag_1 FROM feat2
""")
def q_series_features(spark, sf_dir):
    df = S.series_features(ppi_monthly(spark, sf_dir))
    return rounded(df.select("month", "ppi_value", "ppi_pct_change", "ppi_lag_1", "ppi_pct_change_lag_1"))


PANEL_PPI = """
panel AS (
  SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o_totalprice) AS ppi_value
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2
)"""


@register("rolling_mean_std", f"""
WITH {PANEL_PPI},{Q.series_feature_ctes('panel', 'o_orderpriority')}
SELECT o_orderpriority, month, ppi_value, {Q.r6(['ppi_ma_3', 'ppi_std_3'])} FROM feat1
""")
def q_rolling_mean_std(spark, sf_dir):
    """Panel of one series per order priority: windows partition by key."""
    orders = SI.table(spark, sf_dir, "orders")
    panel = S.monthly_mean(orders, "o_orderdate", "o_totalprice", "ppi_value",
                           keys=["o_orderpriority"], exact_scale=2)
    df = S.series_features(panel, keys=["o_orderpriority"])
    return rounded(df.select("o_orderpriority", "month", "ppi_value", "ppi_ma_3", "ppi_std_3"))


@register("target_lead", f"""
WITH {Q.PPI},{Q.series_feature_ctes()}
SELECT month, ppi_pct_change, target_pct_change_next_month FROM feat2
""")
def q_target_lead(spark, sf_dir):
    df = S.target_lead(S.series_features(ppi_monthly(spark, sf_dir)))
    return rounded(df.select("month", "ppi_pct_change", "target_pct_change_next_month"))


@register("target_quantile_cuts", f"""
WITH {Q.PPI},{Q.series_feature_ctes()}
SELECT round(quantile_cont(target_pct_change_next_month, 0.33), 6) AS low_cut,
       round(quantile_cont(target_pct_change_next_month, 0.67), 6) AS high_cut
FROM feat2 WHERE target_pct_change_next_month IS NOT NULL
""")
def q_target_quantile_cuts(spark, sf_dir):
    df = S.target_lead(S.series_features(ppi_monthly(spark, sf_dir)))
    return rounded(L.quantile_cuts(df))


@register("target_class", f"""
WITH {Q.PPI},{Q.series_feature_ctes()},
cuts AS (
  SELECT *, quantile_cont(target_pct_change_next_month, 0.33) OVER () AS low_cut,
            quantile_cont(target_pct_change_next_month, 0.67) OVER () AS high_cut
  FROM feat2
)
SELECT month, target_pct_change_next_month,
       {Q.class_expr()} AS target_class
FROM cuts
""")
def q_target_class(spark, sf_dir):
    df = L.add_target_class(S.target_lead(S.series_features(ppi_monthly(spark, sf_dir))))
    return rounded(df.select("month", "target_pct_change_next_month", "target_class"))


# ---------------------------------------------------------------------------
# Flagship: the full model table
# ---------------------------------------------------------------------------

FEATURE_TABLE_COLUMNS = (
    ["month", "ppi_value", "article_count", "avg_sentiment", "negative_share", "avg_title_len",
     "unique_sources"]
    + [f"kw_{k}" for k in SI.STANDIN_KEYWORDS]
    + ["gscpi", "wti_oil_price", "ppi_pct_change", "ppi_lag_1", "ppi_pct_change_lag_1", "ppi_ma_3",
       "ppi_std_3"]
    + [f"{c}_{s}" for c in ("gscpi", "wti_oil_price") for s in ("pct_change", "lag_1", "pct_change_lag_1")]
    + ["target_pct_change_next_month", "target_class"]
)


def _feature_table_sql(part: str = "") -> str:
    """Model-table CTEs; with ``part`` the series is a panel keyed by that
    column of ``orders`` and every window is partitioned by it."""
    pb = f"PARTITION BY {part} " if part else ""
    ind_feats = []
    for c in ("gscpi", "wti_oil_price"):
        ind_feats.append(f"{Q.pct(c, part=part)} AS {c}_pct_change")
        ind_feats.append(f"lag({c}, 1) OVER ({pb}ORDER BY month) AS {c}_lag_1")
    lag_pct = ", ".join(f"lag({c}_pct_change, 1) OVER ({pb}ORDER BY month) AS {c}_pct_change_lag_1"
                        for c in ("gscpi", "wti_oil_price"))
    kw = ", ".join(f"coalesce(kw_{k}, 0) AS kw_{k}" for k in SI.STANDIN_KEYWORDS)
    doubles = [c for c in FEATURE_TABLE_COLUMNS
               if c not in {"month", "article_count", "unique_sources", "target_class"}
               and not c.startswith("kw_")]
    doubles = [f"round({c}, 6) AS {c}" if c in ENGINE_DEPENDENT else c for c in doubles]
    ints = ["article_count", "unique_sources"] + [f"kw_{k}" for k in SI.STANDIN_KEYWORDS]
    series_cte = PANEL_PPI if part else Q.PPI
    base = f"SELECT DISTINCT {part}, month, ppi_value FROM panel" if part else \
        "SELECT DISTINCT month, ppi_value FROM ppi"
    key_sel = f"base.{part}, " if part else ""
    key_out = f"{part}, " if part else ""
    return f"""{series_cte},{Q.INDICATORS},{Q.RAW_NEWS},{Q.CLEAN_NEWS},{Q.monthly_news_ctes()},
base AS (
  {base}
),
joined AS (
  SELECT {key_sel}base.month, base.ppi_value,
         coalesce(article_count, 0) AS article_count, coalesce(avg_sentiment, 0) AS avg_sentiment,
         coalesce(negative_share, 0) AS negative_share, coalesce(avg_title_len, 0) AS avg_title_len,
         coalesce(unique_sources, 0) AS unique_sources, {kw},
         ind.gscpi AS gscpi_raw, ind.wti_oil_price AS wti_raw
  FROM base LEFT JOIN news ON base.month = news.month LEFT JOIN ind ON base.month = ind.month
),
filled AS (
  SELECT * EXCLUDE (gscpi_raw, wti_raw),
    last_value(gscpi_raw IGNORE NULLS) OVER ({pb}ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gscpi,
    last_value(wti_raw IGNORE NULLS) OVER ({pb}ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wti_oil_price
  FROM joined
),{Q.series_feature_ctes('filled', part)},
ind1 AS (SELECT *, {", ".join(ind_feats)} FROM feat2),
ind2 AS (SELECT *, {lag_pct} FROM ind1),
cuts AS (
  SELECT *, quantile_cont(target_pct_change_next_month, 0.33) OVER ({pb.strip()}) AS low_cut,
            quantile_cont(target_pct_change_next_month, 0.67) OVER ({pb.strip()}) AS high_cut
  FROM ind2
),
labelled AS (SELECT *, {Q.class_expr()} AS target_class FROM cuts),
model_table AS (
SELECT {key_out}month, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ints)}, {", ".join(doubles)}, target_class
FROM labelled
WHERE ppi_lag_1 IS NOT NULL AND ppi_pct_change_lag_1 IS NOT NULL AND ppi_ma_3 IS NOT NULL
  AND ppi_std_3 IS NOT NULL AND target_class IS NOT NULL AND gscpi IS NOT NULL
  AND wti_oil_price IS NOT NULL
)"""


MODEL_TABLE_CTES = _feature_table_sql()


@register("feature_table", f"WITH {MODEL_TABLE_CTES}\nSELECT * FROM model_table")
def q_feature_table(spark, sf_dir):
    return rounded(feature_table(spark, sf_dir).select(*FEATURE_TABLE_COLUMNS))


@register("feature_table_panel", f"WITH {_feature_table_sql('o_orderpriority')}\nSELECT * FROM model_table")
def q_feature_table_panel(spark, sf_dir):
    """One model table per order priority (a panel of five series); the
    window stages partition by the series key."""
    orders = SI.table(spark, sf_dir, "orders")
    panel = (S.monthly_mean(orders, "o_orderdate", "o_totalprice", "ppi_value", keys=["o_orderpriority"],
                            exact_scale=2).withColumnRenamed("month", "date"))
    ft = build_feature_table(
        panel, clean_news(spark, sf_dir), SI.lexicon(spark), indicators=SI.indicators(spark, sf_dir),
        keywords=SI.STANDIN_KEYWORDS, keys=["o_orderpriority"], id_col="doc_id", **SI.sentiment_rules())
    return rounded(ft.select("o_orderpriority", *FEATURE_TABLE_COLUMNS))
