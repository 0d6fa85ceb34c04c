"""Language ID (operator 5): word-first backoff.

Fit: words of labelled texts are counted per language by Spark; a word seen
at least ``min_count`` times is kept (the ``max_words`` most frequent of those
of ``max_letters`` letters at most), and character n-grams of 4, 3, 2 and 1
letters (with a mark at either end of a word) are counted over all words,
however long: where words aren't set apart, a clause is one. Fit is made on a bounded sample of
about ``max_docs`` labelled texts a language, by hash of the id. The model is
a bounded table: ``max_words + max_grams`` rows, so it may be sent to tasks.

Score: a known word adds its log frequency in each language. An unseen word is
covered left to right by its longest known n-grams, falling back to
progressively shorter ones, and adds the mean of their log frequencies. The
language with the largest total wins (ties: the first by name); the score is
its posterior under equal priors. Only the text enters a prediction.

Null text or a text without a letter: ``und``, score 0. No labelled text at
all: everything is ``und``. Empty tables give no rows; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, given_back

GRAM_SIZES = (4, 3, 2, 1)
_WORD = regex.compile(r"\p{L}+")
SCHEMA = "doc_id long, lang_pred string, score double"


def _letters_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


class Model:
    """Log frequencies per language of words and of n-grams: each unit's row
    in one flat table (of the words, and of each n-gram length)."""

    def __init__(self, languages: list[str], words: list[tuple], grams: list[tuple]):
        """From (word, language, count) and ((size, n-gram), language, count)."""
        table = lambda rows: pa.table({"unit": [r[0] for r in rows], "label": [r[1] for r in rows], "n": [r[2] for r in rows]})
        sizes = sorted({unit[0] for unit, _, _ in grams})
        self._set(languages, table(words) if words else None,
                  {k: table([(u[1], lang, n) for u, lang, n in grams if u[0] == k]) for k in sizes})

    @classmethod
    def of_tables(cls, languages: list[str], words: pa.Table, grams: dict[int, pa.Table]) -> Model:
        """From tables of (unit, label, n), n-grams by their size."""
        model = cls.__new__(cls)
        model._set(languages, words, grams)
        return model

    def _set(self, languages: list[str], words: pa.Table | None, grams: dict[int, pa.Table]) -> None:
        self.languages = languages
        self.words, self.word_logs = self._table(words)
        self.grams: dict[int, dict[str, int]] = {}
        self.gram_logs: dict[int, np.ndarray] = {}
        for size, rows in grams.items():
            self.grams[size], self.gram_logs[size] = self._table(rows)

    def _table(self, rows: pa.Table | None) -> tuple[dict[str, int], np.ndarray]:
        """The log shares of each unit. A share has a floor that is the same
        for all languages, however many words each was learned from."""
        if rows is None or not rows.num_rows:
            return {}, np.zeros((0, len(self.languages)))
        units = rows.column("unit").combine_chunks().dictionary_encode()
        label = pc.index_in(rows.column("label").combine_chunks(), pa.array(self.languages, rows.schema.field("label").type))
        counts = np.zeros((len(units.dictionary), len(self.languages)))
        np.add.at(counts, (units.indices.to_numpy(), label.to_numpy()), rows.column("n").to_numpy())
        place = {u: i for i, u in enumerate(units.dictionary.to_pylist())}
        return place, np.log(counts / np.maximum(counts.sum(axis=0), 1) + 1e-6)

    def score_unseen(self, word: str) -> np.ndarray:
        """Cover the word by its longest known n-grams, shorter ones where
        longer ones are unknown."""
        w, at, parts = f"\u0002{word}\u0003", 0, []
        while at < len(w):
            for n in GRAM_SIZES:
                row = self.grams.get(n, {}).get(w[at: at + n]) if at + n <= len(w) else None
                if row is not None:
                    parts.append(self.gram_logs[n][row])
                    at += max(1, n - 1)
                    break
            else:
                at += 1      # a letter never seen tells nothing
        return np.mean(parts, axis=0) if parts else np.zeros(len(self.languages))


def fit(docs: DataFrame, label: Column, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 4000,
        max_words: int = 60_000, max_grams: int = 60_000, min_count: int = 2, max_languages: int = 1000,
        max_letters: int = 40) -> Model:
    """Counts of the labelled rows (``label`` not null). The sample bound
    ``max_docs`` is per language; a further language than ``max_languages`` is
    an error, not a silent cut."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), label.alias("label")).where(
        F.col("label").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    if not sizes:
        return Model([], [], [])
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1 << 20, max_docs * (1 << 20) // n + 1))])
    taken = rows.where(F.pmod(F.xxhash64(F.col("id")), F.lit(1 << 20)) < share[F.col("label")])
    words = (taken.select("label", F.explode(_letters_words(F.col("text"))).alias("word"))
             .groupBy("word", "label").agg(F.count("*").alias("n")))
    words = words.persist()
    kept = (words.where(F.length("word") <= max_letters).groupBy("word").agg(F.sum("n").alias("all")).where(F.col("all") >= min_count)
            .orderBy(F.desc("all"), "word").limit(max_words).select("word"))
    # as Arrow tables: a row object of the driver's would take several times a word's own size
    known = words.join(kept, "word").select(F.col("word").alias("unit"), "label", "n").toArrow()
    # letters as an array: substrings of a long word would cost the square of its length
    marked = words.select("label", "n", F.split(F.concat(F.lit("\u0002"), F.col("word"), F.lit("\u0003")), "").alias("marked"))
    grams = {}
    for size in GRAM_SIZES:
        here = (marked.where(F.size("marked") >= size)
                .select("label", "n", F.explode(F.transform(
                    F.sequence(F.lit(0), F.size("marked") - size),
                    lambda i: F.concat(*[F.get("marked", i + j) for j in range(size)]))).alias("gram"))
                .groupBy("gram", "label").agg(F.sum("n").alias("n")))
        top = (here.groupBy("gram").agg(F.sum("n").alias("all")).where(F.col("all") >= min_count)
               .orderBy(F.desc("all"), "gram").limit(max_grams // len(GRAM_SIZES)).select("gram"))
        found = here.join(top, "gram").select(F.col("gram").alias("unit"), "label", "n").toArrow()
        if found.num_rows:
            grams[size] = found
    words.unpersist()
    return Model.of_tables(sorted(sizes), known, grams)


class Scorer:
    """Predictions of a block of texts; scores of unseen words are kept for
    the next blocks (``max_cached`` words at most)."""

    def __init__(self, model: Model, max_cached: int = 100_000):
        self.model, self.max_cached = model, max_cached
        self.seen: dict[str, int] = {}
        self.store = np.zeros((1024, len(model.languages)))

    def _unseen(self, words: list[str]) -> np.ndarray:
        if len(self.seen) > self.max_cached:
            self.seen.clear()
        places = []
        for w in words:
            k = self.seen.get(w)
            if k is None:
                k = self.seen[w] = len(self.seen)
                if k >= len(self.store):
                    self.store = np.concatenate([self.store, np.zeros_like(self.store)])
                self.store[k] = self.model.score_unseen(w)
            places.append(k)
        return self.store[places].sum(axis=0)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text else []
        if not words or not self.model.languages:
            return "und", 0.0
        get = self.model.words.get
        ids = np.array([get(w, -1) for w in words])
        total = self.model.word_logs[ids[ids >= 0]].sum(axis=0)
        rest = np.flatnonzero(ids < 0).tolist()
        if rest:
            total = total + self._unseen([words[i] for i in rest])
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(sent.value)
        for b in batches(it, 4 << 20):
            found = [score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([x for x, _ in found], pa.string()),
                                              pa.array([x for _, x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(given_back(run), SCHEMA)


def in_known_language(docs: DataFrame, model: Model, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language with ``least_score`` at
    least; all columns pass through as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(sent.value)
        for b in batches(it, 4 << 20):
            found = [score(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([x != "und" and p >= least_score for x, p in found], pa.bool_()))

    return docs.mapInArrow(given_back(run), docs.schema)
