"""Article-level cleaning, deduplication and the monthly news aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ARTICLE_DEDUP_KEYS, DEFAULT_KEYWORDS, ENGLISH_SPELLINGS
from ..functions.dates import parse_timestamps
from ..functions.text import clean_text, keyword_column_name, keyword_flags, text_length
from . import sentiment as S


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """The row of each key group that ``pick`` (min or max) takes under
    ``order``, then all other columns.

    Rows are grouped by two 64-bit hashes of the key (and which parts of it
    are null), with the key itself among the values: what is sorted and
    shuffled by is 17 bytes, however long the titles are.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    nulls = F.concat(*[F.when(F.col(k).isNull(), "1").otherwise("0") for k in keys])
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *[F.col(c) for c in rest],
                      *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    one = (df.groupBy(F.xxhash64(*keys, nulls).alias("__a"), F.xxhash64(nulls, *reversed(keys)).alias("__b"))
           .agg(pick(packed).alias("__one")))
    names = {f"__o{i}": c for i, c in enumerate(order)} | {c: c for c in rest} | {f"__k{i}": k for i, k in enumerate(keys)}
    return one.select(*[F.col("__one")[n].alias(c) for n, c in names.items()]).select(*df.columns)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of each key group under ``order`` (then all other
    columns as tie-break, so the choice is deterministic).

    ``min`` of a struct per key: map-side partial aggregation reduces a hot
    key holding a third of the rows inside each map task before the shuffle,
    unlike a ``row_number`` window which would sort the group in one task.
    """
    return _one_per_key(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Mirror of ``keep_first``: the last row per key under ``order``."""
    return _one_per_key(df, keys, order, F.max)


def language_filter(df: DataFrame, col: str = "language",
                    accepted: Sequence[str] = ENGLISH_SPELLINGS) -> DataFrame:
    """Keep accepted spellings or the empty string (NULLs were filled first)."""
    return df.where(F.col(col).isin(list(accepted)) | (F.col(col) == F.lit("")))


def parse_and_dedup(raw: DataFrame) -> DataFrame:
    """fill '' -> parse timestamps -> drop unparsed -> dedup (title, url,
    published_at) keeping the earliest ``seen_date``."""
    df = raw.fillna("", subset=["title", "source", "language"])
    df = df.withColumn("published_at", parse_timestamps("seen_date"))
    df = df.dropna(subset=["published_at"])
    return keep_first(df, ARTICLE_DEDUP_KEYS, ["seen_date"])


def timestamp_rejects(raw: DataFrame) -> DataFrame:
    """One row (articles, unparsed, kept): the rows that ``parse_and_dedup``
    drops because no known layout fits their ``seen_date``."""
    known = parse_timestamps("seen_date").isNotNull()
    return raw.select(known.alias("known")).agg(F.count("*").alias("articles"), F.count_if(~F.col("known")).alias("unparsed"),
                                                F.count_if("known").alias("kept"))


def clean_news(raw: DataFrame, accepted_languages: Sequence[str] = ENGLISH_SPELLINGS) -> DataFrame:
    """raw_news -> clean_news, in the reference order: ``parse_and_dedup``
    -> language filter (after the dedup) -> clean text, month, title length.
    """
    df = language_filter(parse_and_dedup(raw), accepted=accepted_languages)
    return df.withColumns({
        "clean_text": clean_text("title"),
        "month": F.trunc(F.col("published_at"), "month"),
        "title_len": text_length("title"),
    })


def article_id(keys: Sequence[str] = ARTICLE_DEDUP_KEYS):
    """Deterministic 128-bit id of an article from its dedup key (two xxhash64
    orders), so a recomputed task after an executor loss produces the same
    ids; collisions need 2^64-scale article counts."""
    cols = [F.col(k) for k in keys]
    return F.struct(F.xxhash64(*cols).alias("h1"), F.xxhash64(*reversed(cols)).alias("h2"))


def monthly_article_stats(clean: DataFrame, keywords: Sequence[str] = DEFAULT_KEYWORDS) -> DataFrame:
    """Per month: article count, mean title length, distinct sources
    (``''`` counts as a source) and one keyword-hit sum per keyword."""
    flagged = clean.withColumns(keyword_flags("clean_text", keywords))
    return (flagged.where(F.col("month").isNotNull())
            .groupBy("month")
            .agg(F.count("title").alias("article_count"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.avg("title_len").alias("avg_title_len"),
                 F.count_distinct("source").alias("unique_sources"),
                 *[F.sum(keyword_column_name(k)).cast("long").alias(keyword_column_name(k))
                   for k in keywords]))


def monthly_news_features(clean: DataFrame, lexicon: DataFrame,
                          keywords: Sequence[str] = DEFAULT_KEYWORDS, id_col: str = "__row_id",
                          approx_sources: bool = False, make_scorer=None, **rules) -> DataFrame:
    """One row per month: article_count, avg_sentiment, negative_share,
    avg_title_len, unique_sources, kw_*.

    One pass over the article text: keyword flags and length are computed
    per article and carried (as small columns) through the per-article
    sentiment aggregate, whose map-side partial aggregation leaves one row
    per article; a month aggregate finishes. No long text is shuffled and the
    cleaned text is produced once. ``approx_sources=True`` swaps the exact
    distinct-source count (per-month set state) for ``approx_count_distinct``
    (HyperLogLog++, fixed-size state) when months hold very many sources.
    ``make_scorer`` puts a user's scorer (``sentiment.score_with``) in the place of
    the rules; the article's row then never leaves its task before the month
    aggregate.
    """
    src = clean if id_col in clean.columns else clean.withColumn(id_col, article_id())
    src = src.where(F.col("month").isNotNull()).withColumns(keyword_flags("clean_text", keywords))
    kw_cols = [keyword_column_name(k) for k in keywords]
    carry = ["month", "title_len", "source", *kw_cols]
    if make_scorer is None:
        per_doc = S.score_all(src, "clean_text", id_col, lexicon, carry=carry, **rules)
    else:
        per_doc = S.score_with(src, "clean_text", make_scorer).select(*carry, F.round("sentiment", 4).alias("sentiment"))
    n = F.count(F.lit(1))
    return per_doc.groupBy("month").agg(
        n.alias("article_count"),
        # exact: scores carry 4 decimals, so a DECIMAL sum is order-independent
        (F.sum(F.col("sentiment").cast("decimal(38,4)")).cast("double") / n).alias("avg_sentiment"),
        (F.sum((F.col("sentiment") < 0).cast("long")) / n).alias("negative_share"),
        F.avg("title_len").alias("avg_title_len"),
        (F.approx_count_distinct("source") if approx_sources else F.count_distinct("source"))
        .alias("unique_sources"),
        *[F.sum(c).cast("long").alias(c) for c in kw_cols])
