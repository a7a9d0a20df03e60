"""Default parameters of every job, in one place.

Each function takes its own arguments; these are only the defaults.
"""

from __future__ import annotations

# --- reproducibility ---------------------------------------------------------
SEED = 42

# --- corpus ------------------------------------------------------------------
SUPPORTED_LANGUAGES = ["en", "sv", "fi"]
DEFAULT_LANGUAGE = "en"
CORPUS_COLUMNS = ["text", "label", "label_text", "language"]
MIN_WORDS = 1
PROFILE_MIN_WORDS = 3
TEST_SIZE = 0.2
DEMO_ROWS_PER_LANGUAGE = 100
EXAMPLE_PREDICTIONS = 20

# --- classifiers -------------------------------------------------------------
MAX_FEATURES = 10_000
MAX_TOKENS = 256
SCORING_BATCH = 32
TOP_CATEGORIES = 3
LOW_CONFIDENCE = 0.5

# --- tags --------------------------------------------------------------------
MAX_KEYWORDS = 8
MIN_KEYWORD_LENGTH = 3

# Entity label -> unified tag. Labels outside it become "misc".
ENTITY_TAGS = {
    "PERSON": "person",
    "PER": "person",
    "PRS": "person",
    "ORG": "organization",
    "GPE": "location",
    "LOC": "location",
    "FAC": "location",
    "NORP": "group",
    "DATE": "date",
    "TIME": "date",
    "TME": "date",
    "MONEY": "money",
    "PERCENT": "metric",
    "QUANTITY": "metric",
    "MSR": "metric",
    "CARDINAL": "number",
    "ORDINAL": "number",
    "PRODUCT": "product",
    "OBJ": "product",
    "EVENT": "event",
    "EVN": "event",
    "WORK_OF_ART": "work",
    "WRK": "work",
    "LAW": "law",
    "LANGUAGE": "language",
    "MISC": "misc",
}
UNKNOWN_TAG = "misc"

# Function words that never become keywords, per language. A language that is
# not listed uses the list of DEFAULT_LANGUAGE.
STOP_WORDS = {
    "en": "the and for with that this from are was were been have has had not but you your they "
          "their his her its our will would can could into about than then there which who what "
          "when where how all any some more most other such only also very".split(),
    "sv": "och att det som den för med till inte har var jag han hon kan vid från men ska nu ett "
          "eller din mitt dig denna dessa vad när hur där här om så av på är".split(),
    "fi": "ja on ei että se hän joka mutta niin kun kuin ovat oli olla myös tai jos minä sinä "
          "me te he tämä nämä mikä missä miten nyt vain sitä".split(),
}

# --- weight compression ------------------------------------------------------
TARGET_SPARSITY = 0.30
PRUNE_MIN_RANK = 2
EVAL_SAMPLE = 400

# --- physical bounds ---------------------------------------------------------
# A dimension side is broadcast only after it was measured and found to be within
# both bounds; beyond them the join is salted and shuffled.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# A key with more rows than this is spread over several tasks in a join that cannot broadcast.
HEAVY_ROWS = 1_000_000
# A language profile of at most this many grams and words, and a gazetteer of at most
# this many names, within the bytes above, is sent to the workers.
PROFILE_MAX_ROWS = 1_000_000
GAZETTEER_MAX_ROWS = 1_000_000
# Class names that travel with a plan, and class vectors with every row.
NAMES_MAX_BYTES = 4 * 1024 * 1024
VECTORS_MAX_BYTES = 16 * 1024 * 1024
