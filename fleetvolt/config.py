"""Parameter objects: power-band thresholds and customer-section definitions."""

from __future__ import annotations

from dataclasses import dataclass, field

from fleetvolt import constants as K


@dataclass(frozen=True)
class PowerBands:
    """Voltage thresholds of the four bands. ``low`` is the critical level (Low lies above it)."""

    high: float = K.HIGH_VOLTS
    medium: float = K.MEDIUM_VOLTS
    low: float = K.CRITICAL_VOLTS


@dataclass(frozen=True)
class SectionSpec:
    """One customer section (cohort) of the daily / weekly report.

    A snapshot row belongs to the section when
    ``lower(CustomerName) == lower(customer)`` and the device is paired (id differs from name)
    and was seen within the recency window, and, if set,
    ``DeviceID`` starts with ``id_prefix``, and, if ``listed_or_series`` is set,
    the device is on the allow-list OR (starts with ``series_prefix`` and is in the numbered
    series ``>= series_min``).
    """

    name: str
    customer: str
    id_prefix: str | None = None
    listed_or_series: bool = False
    series_prefix: str | None = None
    series_min: int = K.SERIES_MIN
    table_modes: tuple[str, ...] = field(default=K.TABLE_MODES)
