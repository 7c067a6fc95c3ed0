"""Column expressions. Every function here returns a ``Column``; none runs Python per row."""

from fleetvolt.functions.bands import power_band  # noqa: F401
from fleetvolt.functions.devices import is_numbered_series, is_paired  # noqa: F401
from fleetvolt.functions.payload import payload_mode, payload_voltage  # noqa: F401
from fleetvolt.functions.timecalc import (  # noqa: F401
    date_lit,
    day_at_hour,
    minute_index,
    minutes_between,
    ntz,
    ratio_percent,
)
from fleetvolt.functions.dates import date_label, display_date, parse_label  # noqa: F401
