"""Fixed values.

These must equal the values the original reporting application uses, so that reports built
here agree with it. They are stated here once, in plain text; everything else in the library
takes them as defaults for parameters.
"""

from datetime import timedelta

# ---- Fixed values: power bands -------------------------------------------------------------
# Band names, best to worst.
MODES = ("High", "Medium", "Low", "Critical")
# Band for a snapshot row whose voltage is missing.
UNKNOWN_MODE = "Unknown"
# Voltage thresholds: High above 3.3 V, Medium above 3.22 V, Low above 3.18 V, else Critical.
HIGH_VOLTS = 3.3
MEDIUM_VOLTS = 3.22
CRITICAL_VOLTS = 3.18
# A reading is valid for the latest-state report when its voltage is above 2 V.
VALID_MIN_VOLTS = 2.0

# ---- Fixed values: legacy payload text -----------------------------------------------------
PAYLOAD_MARKER = "Battery Level"
PAYLOAD_ZERO = "Battery Level 0"
VOLTAGE_PATTERN = r"Battery Level (\d+\.\d+)"
MODE_PATTERN = r"Power mode (\w+)"
NO_LABEL = "None"
LEGACY_PORT = 1

# ---- Fixed values: time windows ------------------------------------------------------------
RECENCY = timedelta(weeks=12)          # "seen within 12 weeks" (two-sided)
LOOKBACK_MONTHS = 4                    # legacy look-back
LEGACY_CUTOFF_HOUR = 12                # legacy as-of is noon of the report date
WEEK_DAYS = 7                          # weekly report covers 7 dates, today included
MINUTES_PER_YEAR = 365 * 24 * 60

# Partition column of a readings / uplinks table stored by day (optional; see sources.tables).
DATE_PARTITION = "event_date"

# ---- Fixed values: devices -----------------------------------------------------------------
ACTIVE_STATUS = "Active"
SERIES_MIN = 6000                      # "6000-series": last four characters all digits, >= 6000
SERIES_DIGITS = 4

# ---- Fixed values: reports -----------------------------------------------------------------
PREVIEW_LIMIT = 30                     # rows shown per section table
SAMPLE_ROWS = 1000                     # newest uplinks in the connectivity sample
TABLE_MODES = ("Critical", "Low", "Medium")
TABLE_MODES_SHORT = ("Critical", "Low")
DROPPED_TABLE_COLUMNS = ("PayloadData", "index", "AssetId", "OrganizationId")

# ---- Fixed values: dates and file names ----------------------------------------------------
# Time-text formats tried in order on a whole column (Spark patterns). In the original
# application they read "%Y-%m-%d %H:%M:%S.%f", "%d/%m/%Y %H:%M", "%m/%d/%Y %H:%M".
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "d/M/yyyy H:m", "M/d/yyyy H:m")
TIME_FORMAT_NAMES = ("iso_fraction", "day_first", "month_first")
# Text shapes of the formats, with the ranges of the time of day. The date's fields are tested for being a date.
ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\.[0-9]{1,6}$"
SLASH_SHAPE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} ([01]?[0-9]|2[0-3]):[0-5]?[0-9]$"
LABEL_FORMAT = "dMMMyy"                # e.g. 5Jan26; parsing accepts 05Jan26 too
DISPLAY_FORMAT = "d MMM yyyy"          # e.g. 5 Jan 2026
DISPLAY_DAY_MONTH = "d MMMM"           # e.g. 5 January
DISPLAY_LONG = "d MMMM yyyy"           # e.g. 5 January 2026
DISPLAY_SHORT = "d MMM"                # e.g. 5 Jan
SNAPSHOT_PREFIX = "latest_batt_"
SNAPSHOT_SUFFIX = ".csv"
SOURCE_CURRENT = "smbs"
SOURCE_LEGACY = "debug"
