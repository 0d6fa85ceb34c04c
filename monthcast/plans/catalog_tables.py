"""Catalogue entries of provider payloads, named series, table scans and
sinks as round trips, and reject counts (registered on import)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import ml as ML
from ..operators import news as N
from ..operators import series as S
from ..session import scratch_path
from ..sinks.tables import export_csv, export_json, replace
from ..sources import payloads as P
from ..sources.series import read_named_series, read_series_csv
from ..sources.tables import read_feature_table, read_metrics_json, read_or_empty
from . import standins as SI
from .catalog import register

EVENT_URL = "https://events.example/"
#: The status and damage of a landed payload, by its event (shared with the SQL).
ERROR_EVENT, BROKEN_BELOW = "error", 5


def _event_url():
    return F.concat(F.lit(EVENT_URL), F.col("event_id").cast("string"))


def _windowed(events, *fields):
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select(F.to_json(F.struct(day.alias("window_start"), day.alias("window_end"), *fields)).alias("payload"))


@register("guardian_payload_flatten", f"""
SELECT 'guardian' AS provider, strftime(ts, '%Y-%m-%d') AS window_start, strftime(ts, '%Y-%m-%d') AS window_end,
       event_type AS title, '{EVENT_URL}' || CAST(event_id AS VARCHAR) AS url, 'The Guardian' AS source, 'en' AS language,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS seen_date,
       CASE WHEN value >= 10 THEN 'img' || CAST(user_id AS VARCHAR) END AS social_image, '' AS source_country
FROM events
""")
def q_guardian(spark, sf):
    """Without a thumbnail the payload has no such field."""
    fields = F.struct(F.when(F.col("value") >= 10, F.concat(F.lit("img"), F.col("user_id").cast("string"))).alias("thumbnail"))
    art = F.struct(F.col("event_type").alias("webTitle"), _event_url().alias("webUrl"),
                   F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("webPublicationDate"), fields.alias("fields"))
    response = F.struct(F.lit(1).alias("pages"), F.array(art).alias("results")).alias("response")
    return P.flatten_guardian(_windowed(SI.table(spark, sf, "events"), response))


@register("newsdata_payload_flatten", f"""
SELECT 'newsdata' AS provider, '{EVENT_URL}' || CAST(event_id AS VARCHAR) AS url, event_type AS title,
       CASE WHEN value < 10 THEN 'User ' || CAST(user_id AS VARCHAR) ELSE 'u' || CAST(user_id AS VARCHAR) END AS source,
       CASE WHEN value < 20 THEN 'en' ELSE 'english' END AS language, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen_date,
       CASE WHEN value < 30 THEN 'germany' ELSE 'spain,france' END AS source_country
FROM events WHERE event_type <> '{ERROR_EVENT}'
""")
def q_newsdata(spark, sf):
    """Empty source ids and languages fall back; countries are a list or one name."""
    user = F.col("user_id").cast("string")
    art = F.struct(
        F.col("event_type").alias("title"), _event_url().alias("link"),
        F.when(F.col("value") < 10, "").otherwise(F.concat(F.lit("u"), user)).alias("source_id"),
        F.concat(F.lit("User "), user).alias("source_name"),
        F.when(F.col("value") < 20, "").otherwise("english").alias("language"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("pubDate"),
        F.when(F.col("value") < 30, "germany").otherwise("<list>").alias("country"))
    status = F.when(F.col("event_type") == ERROR_EVENT, "error").otherwise("success").alias("status")
    landed = _windowed(SI.table(spark, sf, "events"), status, F.array(art).alias("results"))
    # the provider sends a name, or a list where the text to be written cannot hold one
    raw = F.replace("payload", F.lit('"<list>"'), F.lit('["spain","france"]'))
    return P.flatten_newsdata(landed.select(raw.alias("payload"))).select(
        "provider", "url", "title", "source", "language", "seen_date", "source_country")


@register("payload_reject_counts", f"""
SELECT COUNT(*) AS payloads, COUNT(*) FILTER (value < {BROKEN_BELOW}) AS corrupt,
       COUNT(*) FILTER (value >= {BROKEN_BELOW} AND event_type = '{ERROR_EVENT}') AS errors,
       COUNT(*) FILTER (value >= {BROKEN_BELOW} AND event_type <> '{ERROR_EVENT}') AS kept
FROM events
""")
def q_payload_reject_counts(spark, sf):
    """Payloads cut off in the middle, error payloads, and the rest."""
    ev = SI.table(spark, sf, "events")
    status = F.when(F.col("event_type") == ERROR_EVENT, "error").otherwise("ok")
    whole = F.to_json(F.struct(status.alias("status"), F.array().cast("array<struct<title:string>>").alias("articles")))
    landed = ev.select(F.when(F.col("value") < BROKEN_BELOW, '{"status": "ok", "articles": [').otherwise(whole).alias("payload"))
    return P.reject_counts(landed, schemas.NEWSAPI_PAYLOAD)


@register("timestamp_reject_counts", """
SELECT COUNT(*) AS articles, COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS unparsed,
       COUNT(*) FILTER (o_orderpriority <> '1-URGENT') AS kept
FROM orders
""")
def q_timestamp_reject_counts(spark, sf):
    orders = SI.table(spark, sf, "orders")
    seen = F.when(F.col("o_orderpriority") == "1-URGENT", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return N.timestamp_rejects(orders.select(seen.alias("seen_date")))


def _landed_series(spark, sf, *extra):
    """Order prices as CSV text; urgent ones carry a number only Java would read, blanks a missing price."""
    orders = SI.table(spark, sf, "orders")
    price = (F.when(F.col("o_orderpriority") == "1-URGENT", "10d").when(F.col("o_orderpriority") == "5-LOW", " ")
             .otherwise(F.col("o_totalprice").cast("string")))
    path = scratch_path(spark, "series-csv")
    export_csv(orders.select(*extra, F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"), price.alias("Price")), path)
    return path


SERIES_SQL = """
SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS price FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
"""


@register("series_csv_scan", SERIES_SQL)
def q_series_csv_scan(spark, sf):
    return read_series_csv(spark, _landed_series(spark, sf), "price")


@register("named_series_scan", SERIES_SQL)
def q_named_series_scan(spark, sf):
    """The two columns by name, from a file with others before them."""
    return read_named_series(spark, _landed_series(spark, sf, "o_orderkey", "o_orderstatus"), "Date", "Price", "price")


@register("relational_scan_or_empty", """
SELECT 'customer' AS source, COUNT(*) AS rows FROM customer UNION ALL SELECT 'missing', 0
""")
def q_relational_scan_or_empty(spark, sf):
    schema = SI.table(spark, sf, "customer").schema
    found = read_or_empty(spark, f"{sf}/customer.parquet", schema)
    missing = read_or_empty(spark, f"{scratch_path(spark, 'none')}/missing.parquet", schema)
    return (found.agg(F.count("*").alias("rows")).select(F.lit("customer").alias("source"), "rows")
            .unionByName(missing.agg(F.count("*").alias("rows")).select(F.lit("missing").alias("source"), "rows")))


@register("feature_table_csv_roundtrip", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CAST(SUM(CAST(round(o_totalprice, 2) AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(*) AS ppi_value,
       COUNT(*) AS article_count, CASE WHEN COUNT(*) % 2 = 0 THEN 'low' END AS target_class
FROM orders GROUP BY 1
""")
def q_feature_table_csv_roundtrip(spark, sf):
    """A model table through the CSV sink and back, null classes included."""
    orders = SI.table(spark, sf, "orders")
    mean = S.monthly_mean(orders, "o_orderdate", "o_totalprice", "ppi_value", exact_scale=2)
    count = orders.groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).agg(F.count("*").alias("article_count"))
    table = mean.join(count, "month").withColumn("target_class", F.when(F.col("article_count") % 2 == 0, "low"))
    path = scratch_path(spark, "model-csv")
    export_csv(table.select("month", "ppi_value", "article_count", "target_class"), path)
    return read_feature_table(spark, path, fmt="csv")


@register("metrics_json_roundtrip", """
SELECT 'orders' AS model, 'count' AS metric, o_orderpriority AS label, CAST(COUNT(*) AS DOUBLE) AS value FROM orders GROUP BY o_orderpriority
UNION ALL
SELECT 'orders', 'max', NULL, MAX(o_totalprice) FROM orders
""")
def q_metrics_json_roundtrip(spark, sf):
    orders = SI.table(spark, sf, "orders")
    count = orders.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").cast("double").alias("value"))
    most = orders.agg(F.max("o_totalprice").alias("value")).withColumn("label", F.lit(None).cast("string"))
    long = count.withColumn("metric", F.lit("count")).unionByName(most.withColumn("metric", F.lit("max")))
    path = scratch_path(spark, "metrics-json")
    export_json(long.withColumn("model", F.lit("orders")).select(*schemas.METRICS.fieldNames()).coalesce(1), path)
    return read_metrics_json(spark, path)


@register("table_replace", """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0
""")
def q_table_replace(spark, sf):
    """A second load replaces the first whole, partitions it does not have included."""
    customers = SI.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "replaced")
    for load in (customers, customers.where("c_acctbal >= 0")):
        replace(load, path, partition_by=["c_mktsegment"])
    return spark.read.schema(T.StructType(customers.schema.fields)).parquet(path)


@register("probability_map", """
SELECT l_orderkey, l_linenumber, l_tax AS proba_low, CAST(0.0 AS DOUBLE) AS proba_medium, l_discount AS proba_high FROM lineitem
""")
def q_probability_map(spark, sf):
    """Probabilities by label whatever the model's class order; a label that it never saw has 0."""
    probs = ML.label_probabilities(["high", "low"], F.array("l_discount", "l_tax"))
    return SI.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in probs.items()])
