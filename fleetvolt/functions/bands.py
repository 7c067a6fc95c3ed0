"""Power-band classification of a voltage column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetvolt import constants as K
from fleetvolt.config import PowerBands


def _number(v: Column | str) -> Column:
    """The voltage, with NaN as NULL: it is not a measurement, and Spark sorts it above all numbers."""
    v = F.col(v) if isinstance(v, str) else v
    return F.when(~F.isnan(v), v)


def power_band(v: Column | str, bands: PowerBands = PowerBands(), inclusive: bool = False,
               null_band: str = K.UNKNOWN_MODE) -> Column:
    """Band name of voltage ``v``.

    ``inclusive=False`` is the snapshot rule: High above ``high``, Medium above ``medium``,
    Low above ``low``, Critical at or below ``low``.
    ``inclusive=True`` is the dwell rule: thresholds are lower bounds (``>=``).
    A NULL voltage gets ``null_band`` (snapshot: Unknown; dwell: Critical).
    """
    v = _number(v)
    above = (lambda t: v >= F.lit(t)) if inclusive else (lambda t: v > F.lit(t))
    high, medium, low, critical = K.MODES
    return (
        F.when(v.isNull(), F.lit(null_band))
        .when(above(bands.high), F.lit(high))
        .when(above(bands.medium), F.lit(medium))
        .when(above(bands.low), F.lit(low))
        .otherwise(F.lit(critical))
    )


def power_band_code(v: Column | str, bands: PowerBands = PowerBands(), inclusive: bool = True,
                    null_code: int = 3) -> Column:
    """Band as a one-byte code (0 High, 1 Medium, 2 Low, 3 Critical, index into ``MODES``),
    for rows that travel through a shuffle; ``band_name`` turns it back into the name."""
    v = _number(v)
    above = (lambda t: v >= F.lit(t)) if inclusive else (lambda t: v > F.lit(t))
    code = (F.when(v.isNull(), F.lit(null_code)).when(above(bands.high), F.lit(0))
            .when(above(bands.medium), F.lit(1)).when(above(bands.low), F.lit(2)).otherwise(F.lit(3)))
    return code.cast("tinyint")


def band_name(code: Column | str) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return F.element_at(F.array(*[F.lit(m) for m in K.MODES]), c.cast("int") + 1)
