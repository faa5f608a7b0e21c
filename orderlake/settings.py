"""Dates, limits, word lists and domains the results depend on."""

# Load time assumed for rows that were loaded before load metadata existed.
INITIAL_LOAD_AT = "2026-07-01"
# Incremental facts re-read this many days of recent loads.
LOOKBACK_DAYS = 3
# Validity start of restaurants that came with the initial load.
BEGINNING_OF_TIME = "1900-01-01"
# The calendar dimension.
CALENDAR_FROM, CALENDAR_TO = "2024-01-01", "2026-12-31"
# Text that stands for NULL in the CSV files.
NULL_TOKENS = ("", "\\N", "NULL")
# Value domains.
ORDER_STATUSES = ("Delivered", "Cancelled", "Refunded")
SENTIMENTS = ("positive", "negative", "neutral")
TOPICS = ("food quality", "delivery", "pricing", "service", "packaging", "other")
SENTIMENT_STARS = {"negative": (1, 2), "neutral": (3, 3), "positive": (4, 5)}
# Review search.
DEFAULT_QUESTION = "what customers say about their order"
EXAMPLES_PER_TEXT = 2
# Names under which the built-in labels and vectors are stored.
RULES_MODEL, HASHED_MODEL = "rules-1", "hashed-words-1"
# Size of a capped batch of reviews, for labelling models that are paid by the call.
REVIEWS_PER_RUN = 5
TEXTS_PER_REQUEST = 64
# Data profile.
TOP_CITIES = 40
# Columns that never reach analysts.
HIDDEN_COLUMNS = ("email",)
