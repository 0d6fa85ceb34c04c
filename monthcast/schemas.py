"""Declared schemas for every table boundary (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import RAW_NEWS_COLUMNS

RAW_NEWS = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_NEWS_COLUMNS])

CLEAN_NEWS = T.StructType(
    list(RAW_NEWS.fields)
    + [
        T.StructField("published_at", T.TimestampNTZType(), True),
        T.StructField("clean_text", T.StringType(), True),
        T.StructField("month", T.DateType(), True),
        T.StructField("title_len", T.IntegerType(), True),
    ]
)

SERIES = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("ppi_value", T.DoubleType(), True),
])

PREDICTION = T.StructType([
    T.StructField("month", T.DateType(), True),
    T.StructField("predicted_next_month_pressure", T.StringType(), True),
    T.StructField("proba_low", T.DoubleType(), True),
    T.StructField("proba_medium", T.DoubleType(), True),
    T.StructField("proba_high", T.DoubleType(), True),
])

METRICS = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

LEXICON = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("valence", T.DoubleType(), False),
])

# Provider payloads as landed JSON (one document per request).
GDELT_PAYLOAD = T.StructType([
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("articles", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("seendate", T.StringType()),
        T.StructField("socialimage", T.StringType()),
        T.StructField("sourcecountry", T.StringType()),
    ]))),
])

GUARDIAN_PAYLOAD = T.StructType([
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("response", T.StructType([
        T.StructField("pages", T.IntegerType()),
        T.StructField("results", T.ArrayType(T.StructType([
            T.StructField("webTitle", T.StringType()),
            T.StructField("webUrl", T.StringType()),
            T.StructField("webPublicationDate", T.StringType()),
            T.StructField("fields", T.StructType([
                T.StructField("trailText", T.StringType()),
                T.StructField("thumbnail", T.StringType()),
            ])),
        ]))),
    ])),
])

NEWSAPI_PAYLOAD = T.StructType([
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("totalResults", T.IntegerType()),
    T.StructField("articles", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("urlToImage", T.StringType()),
        T.StructField("source", T.StructType([
            T.StructField("id", T.StringType()),
            T.StructField("name", T.StringType()),
        ])),
    ]))),
])

# ``country`` arrives either as a list or as a scalar; it is landed as a raw
# JSON string and resolved by ``sources.payloads.country_to_text``.
NEWSDATA_PAYLOAD = T.StructType([
    T.StructField("window_start", T.StringType()),
    T.StructField("window_end", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("pubDate", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("country", T.StringType()),
    ]))),
])
