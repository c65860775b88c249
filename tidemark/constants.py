"""Defaults of the layers and questions.

Fixed values: these must equal the reference's for its results to be
reproduced; every operator takes them as overridable parameters.
"""

# ---- fixed values -----------------------------------------------------------

# bar files
BAR_DATE_FORMAT = "dd-MM-yyyy"
MIN_TRADE_DATE = "1993-01-01"
TICKER_FROM_PATH = r"([^/]+)\.csv$"
QUOTE_DATE_FROM_PATH = r"(\d{4}-\d{2}-\d{2})"
EXCHANGES = [(1, "nasdaq"), (2, "nyse"), (3, "sp500"), (4, "forbes2000")]

# daily metrics (row counts, not calendar spans)
SHORT_ROWS = 7          # 7-day volume mean, high, low
LONG_ROWS = 20          # 20-day volume mean, current day excluded
VOLATILITY_ROWS = 30    # 30-day sample stddev of the daily change
SPIKE_RATIO = 2.0       # volume / 20-day mean above this is a spike
DROP_PCT = -10.0        # daily change below this is a significant drop

# questions
TOP_N = 3               # Q01 best yearly returns per exchange and year
RECOVERY_ROWS = 3       # Q04 months in the recovery run
RECOVERY_LIMIT = 100    # Q04 report length
MIN_YEARS = 5           # Q06 years outperformed
MIN_STREAK = 6          # Q10 consecutive positive months
RETURN_DIGITS = 4
VOLATILITY_DIGITS = 6
RATE_DIGITS = 2

# stream questions: (window width, watermark delay)
SQ1_WINDOW = ("10 minutes", "5 minutes")
SQ2_WINDOW = ("1 minute", "2 minutes")
SQ3_WINDOW = ("10 minutes", "5 minutes")
SQ4_WINDOW = ("5 minutes", "10 minutes")
SQ5_WINDOW = ("1 minute", "2 minutes")
TRADES_PER_WINDOW_BASELINE = 10   # SQ3 constant baseline
HIGH_FREQUENCY_FACTOR = 2.0       # SQ3 flag: count > factor x baseline
NEAR_EXTREME_PCT = 2.0            # SQ4 near_high / near_low band
BASELINE_DAYS = 7                 # snapshot dates in the 7-day baselines
TRIGGER = "30 seconds"
