"""Provider payloads (landed JSON, one document per request) -> raw_news rows.

Each flattener takes a DataFrame with a ``payload`` STRING column (or an
already parsed struct column of the provider schema) and returns rows in
the raw_news layout. Parsing uses declared schemas; arrays are exploded
with ``explode_outer`` only where an empty list must still be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import RAW_NEWS_COLUMNS
from ..functions.numeric import falsy_coalesce


def read_payloads(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON files with the provider schema; corrupt records become a
    ``_corrupt_record`` column instead of failing the job."""
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(full).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def _parsed(df: DataFrame, schema: T.StructType) -> DataFrame:
    if "payload" in df.columns:
        return df.select(F.from_json(F.col("payload"), schema).alias("p")).select("p.*")
    return df


def _raw_row(provider: str, **cols: Column) -> list[Column]:
    out = []
    for c in RAW_NEWS_COLUMNS:
        if c == "provider":
            out.append(F.lit(provider).alias(c))
        else:
            out.append(cols.get(c, F.lit(None).cast("string")).cast("string").alias(c))
    return out


def screen_errors(df: DataFrame, status_col: str = "status") -> DataFrame:
    """Drop payloads whose status is 'error' (NULL status is kept)."""
    return df.where(~F.col(status_col).eqNullSafe(F.lit("error")))


def reject_counts(df: DataFrame, schema: T.StructType, status_col: str = "status") -> DataFrame:
    """One row (payloads, corrupt, errors, kept) of landed ``payload`` texts:
    what does not parse, what parses but reports an error, and the rest."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    p = F.from_json(F.col("payload"), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = df.select(p.alias("p")).select(
        (F.col("p").isNull() | F.col("p._corrupt_record").isNotNull()).alias("corrupt"),
        F.col("p")[status_col].eqNullSafe("error").alias("error"))
    return parsed.agg(F.count("*").alias("payloads"), F.count_if("corrupt").alias("corrupt"),
                      F.count_if(~F.col("corrupt") & F.col("error")).alias("errors"),
                      F.count_if(~F.col("corrupt") & ~F.col("error")).alias("kept"))


def flatten_gdelt(df: DataFrame) -> DataFrame:
    p = _parsed(df, schemas.GDELT_PAYLOAD)
    a = p.select("window_start", "window_end", F.explode("articles").alias("a"))
    return a.select(*_raw_row(
        "gdelt", window_start=F.col("window_start"), window_end=F.col("window_end"),
        title=F.col("a.title"), url=F.col("a.url"), source=F.col("a.domain"),
        language=F.col("a.language"), seen_date=F.col("a.seendate"),
        social_image=F.col("a.socialimage"), source_country=F.col("a.sourcecountry")))


def flatten_guardian(df: DataFrame) -> DataFrame:
    p = _parsed(df, schemas.GUARDIAN_PAYLOAD)
    a = p.select("window_start", "window_end", F.explode("response.results").alias("a"))
    return a.select(*_raw_row(
        "guardian", window_start=F.col("window_start"), window_end=F.col("window_end"),
        title=F.col("a.webTitle"), url=F.col("a.webUrl"), source=F.lit("The Guardian"),
        language=F.lit("en"), seen_date=F.col("a.webPublicationDate"),
        social_image=F.col("a.fields.thumbnail"), source_country=F.lit("")))


def country_to_text(raw_json: Column) -> Column:
    """``country`` is a JSON list (joined with ',') or a scalar."""
    as_list = F.from_json(raw_json, T.ArrayType(T.StringType()))
    return F.when(F.trim(raw_json).startswith("["), F.array_join(as_list, ",")).otherwise(
        F.regexp_replace(raw_json, r'^"|"$', ""))


def flatten_newsdata(df: DataFrame, default_language: str = "en") -> DataFrame:
    p = screen_errors(_parsed(df, schemas.NEWSDATA_PAYLOAD))
    a = p.select("window_start", "window_end", F.explode("results").alias("a"))
    return a.select(*_raw_row(
        "newsdata", window_start=F.col("window_start"), window_end=F.col("window_end"),
        title=F.col("a.title"), url=F.col("a.link"),
        source=falsy_coalesce(F.col("a.source_id"), F.col("a.source_name")),
        language=falsy_coalesce(F.col("a.language"), F.lit(default_language)),
        seen_date=F.col("a.pubDate"), social_image=F.col("a.image_url"),
        source_country=country_to_text(F.col("a.country"))))


def flatten_newsapi(df: DataFrame, language: str = "en") -> DataFrame:
    p = screen_errors(_parsed(df, schemas.NEWSAPI_PAYLOAD))
    a = p.select("window_start", "window_end", F.explode("articles").alias("a"))
    return a.select(*_raw_row(
        "newsapi", window_start=F.col("window_start"), window_end=F.col("window_end"),
        title=F.col("a.title"), url=F.col("a.url"),
        source=falsy_coalesce(F.col("a.source.name"), F.col("a.source.id")),
        language=F.lit(language), seen_date=F.col("a.publishedAt"),
        social_image=F.col("a.urlToImage"), source_country=F.lit("")))


def provider_union(*frames: DataFrame) -> DataFrame:
    """Bag union into the raw_news layout (missing columns become NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    first = [c for c in RAW_NEWS_COLUMNS if c in out.columns]
    return out.select(*first, *[c for c in out.columns if c not in RAW_NEWS_COLUMNS])
