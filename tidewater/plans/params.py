"""Parameters shared by the catalog queries and their oracle SQL.

``as_of`` is always explicit (never ``current_date()``), so a query gives the
same answer on every run.
"""

# The test data's horizon and calendar (FIXTURES.md).
AS_OF = "2001-11-04"
CAL_START = "1995-01-01"
CAL_END = "2002-03-31"
DID_DATE = "1998-07-01"
MONTHS_BACK = 12
TOP_K = 10

# The reference's status split for the README form of impl_count.
ACTIVE_STATUSES = ["go-live", "pilot_ok"]

# Keywords for the document search over the test data.
SEARCH_KEYWORDS = ["license", "the", "que"]

# ISI weights: the README names w1..w3 without values; these are ours.
ISI_WEIGHTS = (0.5, 0.3, 0.2)

# Events span 2024-01-01..30; the recency filter looks back from the end.
EVENTS_AS_OF = "2024-01-30"
EVENTS_DAYS_BACK = 7

# Hot segments: period length, minimum volume in the current period.
HOT_DAYS = 180
HOT_MIN_VOLUME = 5

# What-if budget multipliers.
WHATIF_MULTIPLIERS = [0.5, 1.0, 1.5]

# Domains of the status and measure-type columns.
STATUSES = ["go-live", "pilot_ok", "pilot", "planned"]
MEASURE_TYPES = ["subsidy", "grant", "tax_benefit", "state_order"]

# Plausible ranges on the test data (ours; the reference's generator bounds
# describe its own random rows).
IMPL_RANGES = {"capex": (0, 1e9), "inv_turnover_delta": (0.0, 2.0), "lead_time_delta": (-3000, 3000)}
SUPPORT_RANGES = {"roi_pct": (0.0, 100.0), "amount_rub": (0, 1e9)}

# Freshness periods in days: monthly sources, daily events.
FRESH_MONTH_DAYS = 31
FRESH_DAY_DAYS = 1

# Matching: caliper on the score and sub-buckets per caliper width.
CALIPER = 25.0
CALIPER_SPLITS = 4

# Base URL prefixed to relative procurement links (a neutral placeholder).
PROCUREMENT_BASE_URL = "https://procurement.example"

# Staggered grants: the grant that starts an org's cohort, quarters around it.
LARGE_GRANT = 200
EVENT_QUARTERS = (-4, 8)
REPLICATES = 100

# Matching on covariates: caliper in standard deviations.
MATCH_CALIPER = 0.5

# How often each source is refreshed, in days.
SOURCE_DAYS = {"real_solutions": 31, "real_procurements": 1, "real_indicators": 31, "real_support_measures": 31}
