"""Rule-based lexicon sentiment as a Spark join/aggregate plan.

Rules (the VADER rule set restricted to what survives text cleaning: no
capitals, punctuation or emoticons):

* a token found in the lexicon contributes its valence;
* each of the three preceding tokens that is *not* itself a lexicon word may
  boost it (+/-0.293 in the direction of the current valence, damped by
  1 / 0.95 / 0.9 with distance) and may negate it (times -0.74);
* with a contrast word (``but``) present, contributions before its first
  occurrence are halved and those after it are multiplied by 1.5;
* per text the sum ``s`` is normalised to ``s / sqrt(s^2 + 15)``, clipped to
  [-1, 1] and rounded to 4 decimals; texts without hits score 0.0.

Plan shape: each text is split once and every token is looked up in the word
list before anything is exploded (the lexicon's words are a hash set in the
expression, so a lookup costs the same for any lexicon size). Only hits leave
the row, each with its three predecessors and whether those are lexicon words;
their valences come from a broadcast of the lexicon. A partial aggregate makes
one row per text before the only shuffle, which is by text. No token is
shuffled, whatever kind of frame the lexicon is.

The lexicon's words reach the driver, so its size is checked: more than
``MAX_LEXICON`` rows are an error, never a cut or another plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    BOOSTER_DAMPING,
    BOOSTER_INCREMENT,
    COMPOUND_ALPHA,
    CONTRAST_AFTER,
    CONTRAST_BEFORE,
    DEFAULT_CONTRAST_WORD,
    NEGATION_SCALAR,
)

# Default word lists: a small market-news lexicon (user-replaceable).
DEFAULT_LEXICON = [
    ("surge", 1.9), ("gain", 1.6), ("growth", 1.8), ("strong", 2.3), ("recovery", 1.6),
    ("boost", 1.7), ("improve", 1.9), ("record", 0.6), ("demand", 0.4), ("good", 1.9),
    ("shortage", -1.8), ("crisis", -3.1), ("drop", -1.1), ("fall", -1.3), ("decline", -1.6),
    ("weak", -1.9), ("risk", -1.1), ("fear", -2.2), ("loss", -1.9), ("bad", -2.5),
]
DEFAULT_BOOSTERS_UP = ["very", "extremely", "highly", "sharply", "significantly", "more", "most"]
DEFAULT_BOOSTERS_DOWN = ["slightly", "somewhat", "barely", "less", "least", "marginally"]
DEFAULT_NEGATORS = ["not", "no", "never", "none", "nothing", "neither", "nor", "without",
                    "cannot", "isn", "aren", "wasn", "don", "doesn", "didn", "won"]
#: Rows of a lexicon, at most.
MAX_LEXICON = 50_000


def lexicon_frame(spark, entries: Sequence[tuple[str, float]] = DEFAULT_LEXICON) -> DataFrame:
    return spark.createDataFrame(list(entries), "token string, valence double")


def lexicon_words(lexicon: DataFrame) -> list[str]:
    """The distinct words of a lexicon of at most ``MAX_LEXICON`` rows."""
    rows = lexicon.select("token").limit(MAX_LEXICON + 1).collect()
    if len(rows) > MAX_LEXICON:
        raise ValueError(f"the lexicon has more than {MAX_LEXICON} rows")
    return sorted({r.token for r in rows if r.token is not None})


def lexicon_hits(df: DataFrame, text_col: str, id_col: str, words: Sequence[str],
                 contrast_word: str = DEFAULT_CONTRAST_WORD, carry: Sequence[str] = ()) -> DataFrame:
    """One row per token that is a lexicon word, and one with nulls for a text
    without any: (id, carry..., contrast_pos, pos, tok, p1..p3, p1_in_lex..p3_in_lex).

    ``pos``/``contrast_pos`` are 0-based (-1: no contrast word).
    """
    staged = df.select(F.col(id_col), *carry, F.split(F.col(text_col), " ").alias("__tok"))
    staged = staged.withColumn("__in", F.transform("__tok", lambda t: t.isin(list(words)) if words else F.lit(False)))
    found = F.filter(F.transform("__in", lambda hit, i: F.when(hit, i)), lambda i: i.isNotNull())

    def with_previous(i: Column) -> Column:
        # places before the first token are null, and so are their words
        before = [(k, F.when(i >= k, i - k)) for k in (1, 2, 3)]
        return F.struct(i.alias("pos"), F.get("__tok", i).alias("tok"), *[F.get("__tok", at).alias(f"p{k}") for k, at in before],
                        *[F.coalesce(F.get("__in", at), F.lit(False)).alias(f"p{k}_in_lex") for k, at in before])

    staged = staged.select(F.col(id_col), *carry, (F.array_position("__tok", contrast_word) - 1).cast("int").alias("contrast_pos"),
                           F.transform(found, with_previous).alias("__hits"))
    return (staged.select(id_col, *carry, "contrast_pos", F.explode_outer("__hits").alias("__hit"))
            .select(id_col, *carry, "contrast_pos", "__hit.*"))


def _adjusted_valence(boosters_up: Iterable[str], boosters_down: Iterable[str],
                      negators: Iterable[str]) -> Column:
    up, down, neg = list(boosters_up), list(boosters_down), list(negators)
    v = F.col("valence")
    for k in (1, 2, 3):
        prev, in_lex = F.col(f"p{k}"), F.col(f"p{k}_in_lex")
        applies = prev.isNotNull() & ~in_lex
        boost = (F.when(prev.isin(up), F.lit(BOOSTER_INCREMENT))
                  .when(prev.isin(down), F.lit(-BOOSTER_INCREMENT))
                  .otherwise(F.lit(0.0)))
        boost = F.when(v < 0, -boost).otherwise(boost) * F.lit(BOOSTER_DAMPING[k - 1])
        negate = F.when(prev.isin(neg), F.lit(NEGATION_SCALAR)).otherwise(F.lit(1.0))
        v = F.when(applies, (v + boost) * negate).otherwise(v)
    contrast = (F.when(F.col("contrast_pos") < 0, F.lit(1.0))
                 .when(F.col("pos") < F.col("contrast_pos"), F.lit(CONTRAST_BEFORE))
                 .when(F.col("pos") > F.col("contrast_pos"), F.lit(CONTRAST_AFTER))
                 .otherwise(F.lit(1.0)))
    return v * contrast


def _scored_hits(df: DataFrame, text_col: str, id_col: str, lexicon: DataFrame, carry: Sequence[str],
                 boosters_up, boosters_down, negators, contrast_word) -> DataFrame:
    """(id, carry..., pos, score); texts without hits give one NULL-score row."""
    hits = lexicon_hits(df, text_col, id_col, lexicon_words(lexicon), contrast_word, carry)
    lex = F.broadcast(lexicon.select(F.col("token").alias("__lex"), "valence"))      # checked by lexicon_words
    hits = hits.join(lex, F.col("tok") == F.col("__lex"), "left")
    return hits.select(id_col, *carry, "pos", _adjusted_valence(boosters_up, boosters_down, negators).alias("score"))


def valence_hits(df: DataFrame, text_col: str, id_col: str, lexicon: DataFrame,
                 boosters_up: Iterable[str] = DEFAULT_BOOSTERS_UP,
                 boosters_down: Iterable[str] = DEFAULT_BOOSTERS_DOWN,
                 negators: Iterable[str] = DEFAULT_NEGATORS,
                 contrast_word: str = DEFAULT_CONTRAST_WORD,
                 carry: Sequence[str] = ()) -> DataFrame:
    """Adjusted valence per lexicon hit: (id, carry..., pos, score)."""
    return _scored_hits(df, text_col, id_col, lexicon, carry, boosters_up, boosters_down, negators,
                        contrast_word).where(F.col("score").isNotNull())


def score_all(df: DataFrame, text_col: str, id_col: str, lexicon: DataFrame,
              carry: Sequence[str] = (),
              boosters_up: Iterable[str] = DEFAULT_BOOSTERS_UP,
              boosters_down: Iterable[str] = DEFAULT_BOOSTERS_DOWN,
              negators: Iterable[str] = DEFAULT_NEGATORS,
              contrast_word: str = DEFAULT_CONTRAST_WORD) -> DataFrame:
    """One row per input row: (id, carry..., sentiment), 0.0 without hits.

    A per-text aggregate (partial on the map side, so each text is one row
    before the shuffle) restores one row per text, carrying the small
    ``carry`` columns instead of re-joining the text table.
    """
    t = _scored_hits(df, text_col, id_col, lexicon, carry, boosters_up, boosters_down, negators, contrast_word)
    per = t.groupBy(id_col, *carry).agg(F.sum("score").alias("__s"), F.count("score").alias("__hits"))
    return per.select(id_col, *carry, F.when(F.col("__hits") > 0, compound(F.col("__s")))
                      .otherwise(F.lit(0.0)).alias("sentiment"))


def compound(total: Column) -> Column:
    """Normalise a valence sum into [-1, 1], rounded to 4 decimals."""
    norm = total / F.sqrt(total * total + F.lit(COMPOUND_ALPHA))
    return F.round(F.least(F.greatest(norm, F.lit(-1.0)), F.lit(1.0)), 4)


def text_sentiment(df: DataFrame, text_col: str, id_col: str, lexicon: DataFrame,
                   carry: Sequence[str] = (), **rules) -> DataFrame:
    """Compound score per text that has at least one lexicon hit:
    (id, carry..., sentiment). Texts without hits are absent (score 0.0)."""
    hits = valence_hits(df, text_col, id_col, lexicon, carry=carry, **rules)
    return hits.groupBy(id_col, *carry).agg(compound(F.sum("score")).alias("sentiment"))


def score_texts(df: DataFrame, text_col: str, id_col: str, lexicon: DataFrame,
                out: str = "sentiment", **rules) -> DataFrame:
    """Attach the compound score to every row of ``df`` (0.0 without hits).

    Joins back on ``id_col``; use ``text_sentiment`` + aggregation instead
    when only group-level figures are needed, to avoid moving the rows.
    """
    scores = text_sentiment(df, text_col, id_col, lexicon, **rules).withColumnRenamed("sentiment", out)
    return df.join(scores, id_col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


def score_with(df: DataFrame, text_col: str, make_scorer: Callable[[], Callable[[list[str | None]], list[float]]],
               out: str = "sentiment", batch: int = 1000) -> DataFrame:
    """Attach the scores of a user's own scorer: the extension point for
    models that have no expression form. The built-in rules don't use it.

    ``make_scorer`` runs once in each Python worker's task (a model is loaded there, not
    per batch) and gives a function from texts to as many scores; it gets
    ``batch`` texts at most at once. NULL texts are passed as None.
    """
    @F.pandas_udf("double")
    def run(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for texts in chunks:
            found: list[float] = []
            for i in range(0, len(texts), batch):
                part = [None if t is None else str(t) for t in texts.iloc[i: i + batch]]
                scores = list(scorer(part))
                if len(scores) != len(part):
                    raise ValueError(f"the scorer gave {len(scores)} scores for {len(part)} texts")
                found += scores
            yield pd.Series(found, dtype="float64")

    return df.withColumn(out, run(F.col(text_col)))
