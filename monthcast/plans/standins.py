"""Stand-ins: the driver's tables playing the pipeline's roles.

The test data carries no price series and no news, so (fixed mapping):

* price series  = monthly mean order price of ``orders`` (exact decimal sum);
* raw news      = ``documents`` joined to ``orders`` on doc_id = o_orderkey:
                  the whole document text is the title, the order date the
                  seen date, the customer the URL (so URLs repeat);
* indicators    = ``lineitem`` monthly mean extended price (daily-like source)
                  and a quarterly index (discount, published for Jan/Apr/Jul/Oct);
* keywords, lexicon and modifier words below are stand-ins chosen from words
  that occur in the generated English prose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import series as S

# Fixed stand-in values (shared with the SQL oracle).
STANDIN_KEYWORDS = ["the", "her", "ram", "est"]
STANDIN_LEXICON = [
    ("that", 1.5), ("is", -0.8), ("was", -1.2), ("with", 0.9), ("this", -1.1),
    ("are", 1.9), ("from", -2.0), ("than", 0.7), ("ble", -0.5), ("ing", 0.3),
]
STANDIN_BOOSTERS_UP = ["the", "on"]
STANDIN_BOOSTERS_DOWN = ["a", "at"]
STANDIN_NEGATORS = ["to", "it"]
STANDIN_CONTRAST = "and"
QUARTER_MONTHS = [1, 4, 7, 10]
NEWS_URL_PREFIX = "https://news.example/c/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. How finely its scan is split is up to
    ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentiment_rules() -> dict:
    return dict(boosters_up=STANDIN_BOOSTERS_UP, boosters_down=STANDIN_BOOSTERS_DOWN,
                negators=STANDIN_NEGATORS, contrast_word=STANDIN_CONTRAST)


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STANDIN_LEXICON, "token string, valence double")


def price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date DATE, ppi_value DOUBLE), one value per month."""
    orders = table(spark, sf_dir, "orders")
    return (S.monthly_mean(orders, "o_orderdate", "o_totalprice", "ppi_value", exact_scale=2)
            .withColumnRenamed("month", "date"))


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw_news schema (all strings) over documents x orders."""
    d = table(spark, sf_dir, "documents")
    o = table(spark, sf_dir, "orders")
    j = d.join(o, d.doc_id == o.o_orderkey, "inner")
    return j.select(
        F.lit("guardian").alias("provider"),
        F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("window_start"),
        F.date_format(F.last_day("o_orderdate"), "yyyy-MM-dd").alias("window_end"),
        F.col("text").alias("title"),
        F.concat(F.lit(NEWS_URL_PREFIX), F.col("o_custkey").cast("string")).alias("url"),
        F.col("source").alias("source"),
        F.col("lang").alias("language"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("seen_date"),
        F.lit("").alias("social_image"),
        F.lit("").alias("source_country"),
        F.col("doc_id"),
    )


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, gscpi, wti_oil_price): full outer join of two monthly means."""
    li = table(spark, sf_dir, "lineitem")
    wti = S.monthly_mean(li, "l_shipdate", "l_extendedprice", "wti_oil_price", exact_scale=2)
    quarterly = li.where(F.month("l_shipdate").isin(QUARTER_MONTHS))
    gscpi = S.monthly_mean(quarterly, "l_shipdate", "l_discount", "gscpi", exact_scale=2)
    return S.outer_join_all([gscpi, wti]).select("month", "gscpi", "wti_oil_price")
