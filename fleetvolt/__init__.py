"""fleetvolt: battery-telemetry analytics for device fleets, written as Spark DataFrame plans.

Layout
------
``functions``  column expressions (power bands, payload text, device ids, dates, time arithmetic)
``sources``    typed readers for the input tables, the snapshot store, the sent-date log, exports
``operators``  DataFrame -> DataFrame building blocks (latest state, intervals, dwell, sections, ...)
``plans``      the jobs composed from the operators (daily snapshot, section report, weekly trend, ...)
``streaming``  notes on scheduling; the workload is a daily batch poll
"""

from fleetvolt.config import PowerBands, SectionSpec  # noqa: F401

__version__ = "0.1.0"
