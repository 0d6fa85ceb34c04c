"""Fixed values and defaults.

Everything under "Fixed values" must stay equal to the behaviour being
reproduced (keyword list, language spellings, class labels and cuts, split
size); everything else is a tunable default.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must match the reproduced pipeline for identical results)
# ---------------------------------------------------------------------------
DEFAULT_KEYWORDS = [
    "semiconductor",
    "supply chain",
    "shortage",
    "tariff",
    "memory",
    "nand",
    "dram",
    "ssd",
    "ram",
    "electronics",
    "ai demand",
]
ENGLISH_SPELLINGS = ["English", "english", "EN", "en"]
CLASS_LABELS = ["low", "medium", "high"]
LOW_QUANTILE = 0.33
HIGH_QUANTILE = 0.67
TEST_SIZE_MONTHS = 12
MIN_TRAIN_MARGIN = 6  # a table needs more than test_size + 6 rows
ARTICLE_DEDUP_KEYS = ["title", "url", "published_at"]
RAW_NEWS_KEYS = ["url"]
RAW_NEWS_COLUMNS = [
    "provider",
    "window_start",
    "window_end",
    "title",
    "url",
    "source",
    "language",
    "seen_date",
    "social_image",
    "source_country",
]
RECENT_ARTICLES_LIMIT = 20
API_ARTICLES_DEFAULT_LIMIT = 50
API_ARTICLES_MAX_LIMIT = 500
TREND_MONTHS = 18
GUARDIAN_PAGE_SIZE_CAP = 50
NEWSAPI_PAGE_SIZE_CAP = 100
MODEL_CANDIDATES = ["logistic_regression", "gradient_boosting"]
SELECTION_METRIC = "macro_f1"
RANDOM_STATE = 42

# Rule-based sentiment constants (published VADER rule set, Hutto & Gilbert 2014).
BOOSTER_INCREMENT = 0.293
NEGATION_SCALAR = -0.74
BOOSTER_DAMPING = [1.0, 0.95, 0.9]  # distance 1, 2, 3 before the scored word
CONTRAST_BEFORE = 0.5
CONTRAST_AFTER = 1.5
COMPOUND_ALPHA = 15.0
DEFAULT_CONTRAST_WORD = "but"

# Accepted timestamp layouts for article dates, tried in order (Spark patterns).
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyyMMdd'T'HHmmssX",
    "yyyyMMdd'T'HHmmss",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd",
]

# The columns of the article extracts, in their order.
ARTICLE_COLUMNS = ["published_at", "provider", "source", "title", "url", "language"]
API_COLUMNS = ["provider", "published_at", "seen_date", "month", "title", "url", "source", "language",
               "source_country", "clean_text"]

# Columns of the model table that are no features.
NOT_FEATURES = ["month", "date", "target_class", "target_pct_change_next_month"]
