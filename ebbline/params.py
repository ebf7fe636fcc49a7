"""Default parameters. They decide the results."""

MONTHS_KEPT = 12
MIN_MONTHS = 12
HORIZON = 6

TOP_K_GENRES = 80
TOP_K_CATEGORIES = 120
CHART_TOP_N = 10

SEED = 12345
MAX_IDS = 0  # all
ROWS_PER_FILE = 1_000_000

TEST_SHARE = 0.2
QUANTILES = (0.10, 0.50, 0.90)
N_TREES = 300
LEARNING_RATE = 0.05
MAX_DEPTH = 3
MIN_LEAF_ROWS = 30
SUBSAMPLE = 0.8

DOWNTREND_FEATURE = "trend3_log_avg"
DOWNTREND_THRESHOLD = -0.05
DOWNTREND_WEIGHT = 1.8

MIN_BASE = 1e-9
