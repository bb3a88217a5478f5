"""Fixed values that results depend on: patterns, constants, word lists.

Nothing here is tunable; each value has to stay what it is for the results to
come out the same.  Java regular expressions are prefixed with ``(?Uid)``:
Unicode classes, ignore case, and ``.`` stopping at ``\\n`` only.
"""

# --- fixed values: distributions and defaults -----------------------------
DISTRIBUTIONS = ("normal", "uniform", "gamma", "categorical")
DEFAULT_DISTRIBUTION = "normal"
SOURCE_TYPES = ("pdf", "html")
DEFAULT_SOURCE_TYPE = "html"
RELEVANCE = {"pdf": 1.0, "html": 0.8}
MAX_RESULTS_PER_KIND = 5
MAX_EXPANDED_QUERIES = 4
KEEP_RUNS = 3

# --- fixed values: thresholds and weights of the fidelity score -------------
THRESHOLDS = {"ks_pvalue": 0.05, "corr_similarity": 0.8, "fidelity_score": 90.0}
WEIGHT_FIT, WEIGHT_CORRELATION, WEIGHT_BIAS = 0.4, 0.4, 0.2
BIAS_RELATIVE_MEAN = 0.2
BIAS_FREQUENCY = 0.1
PRIVACY_SAMPLE = 500

# --- fixed values: noise schedule -------------------------------------------
INITIAL_NOISE = 0.1
MIN_NOISE = 0.01
MAX_NOISE = 2.0
NOISE_UP = 1.1
NOISE_DOWN = 0.5
PATIENCE = 2
START_SCORE = -1.0

# --- fixed values: synthesis -------------------------------------------------
DEFAULT_ROWS = 10000
DEFAULT_SEED = 42
UNIFORM_HALF_WIDTH_STD = 2.0
BOUND_STD = 3.0

# --- fixed values: text patterns ----------------------------------------------
JAVA_FLAGS = "(?Uid)"
MEAN_WORD = r"(?:mean|average|μ)"
STD_WORD = r"(?:std|s\.?d\.?|standard\s+deviation|σ)"
SEPARATOR = r"\s*(?:is|=|:|of)?\s*"
NUMBER = r"(-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)"
GAP = r".{0,80}?"
COEFFICIENT = r"(-?(?:0?\.\d+|1(?:\.0+)?))"
PROBABILITY = r"(?:0?\.\d+|1(?:\.0+)?|0)"

MEAN_THEN_STD = MEAN_WORD + SEPARATOR + NUMBER + GAP + STD_WORD + SEPARATOR + NUMBER
STD_THEN_MEAN = STD_WORD + SEPARATOR + NUMBER + GAP + MEAN_WORD + SEPARATOR + NUMBER
CORRELATION_NAMED = r"correlation\s+between\s+(\w+)\s+and\s+(\w+)" + SEPARATOR + COEFFICIENT
CORRELATION_CALL = r"corr(?:elation)?\s*\(\s*(\w+)\s*,\s*(\w+)\s*\)" + SEPARATOR + COEFFICIENT
CATEGORY_PAIR = r"'([^']+)'\s+with\s+probability\s+(" + PROBABILITY + r")"
CATEGORY_JOINER = r"(?:\s*,\s*(?:and\s+)?|\s+and\s+)?"
CATEGORICAL_HEADER = r"categorical\s+variable\s+(\w+)\s+takes\s+value\s+"

# --- fixed values: sentences of a source text (numbers in four decimals) ------------------------------------
MEAN_STD_SENTENCE = "The variable %s has mean %s and std %s."
CATEGORY_PHRASE = "'%s' with probability %s"
CATEGORICAL_SENTENCE = "The categorical variable %s takes value %s."
CORRELATION_SENTENCE = "The correlation between %s and %s is %s."

# --- fixed values: names of extraction methods -------------------------------------
METHOD_REPLY = "llm"
METHOD_REGEX = "regex_fallback"
METHOD_TRUTH = "ground_truth"

# --- fixed values: layout of the data card -------------------------------------------
DATACARD = """# DATACARD: Synthetic Dataset

## Overview
- **Source**: %s
- **Generated**: %s
- **Rows**: %d
- **Columns**: %d
- **Fidelity Score**: **%s**/100

## Statistical Fidelity

### Distribution Fit (KS-test)
%s

### Correlation Preservation
**Correlation Similarity**: %s

## Bias Detection
**Bias Score**: %.2f%%

## Privacy
**Avg Nearest-Neighbour Distance**: %s
**Privacy Score**: %s
"""
