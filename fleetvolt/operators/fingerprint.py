"""Digests of the readings up to cut-offs, so that a stored snapshot tells whether its input has changed.

A digest is the number of readings and the sum of their hashes up to a cut-off. Sums do not depend on the order or the layout
of the readings, and the digests of many cut-offs come from one aggregate: each reading counts for the first cut-off at or
after it, and the cut-offs' sums are added up in order (one row per cut-off).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetvolt.operators.latest import cut_index, time_range

_COLUMNS = ("ID", "OrganizationId", "AssetId", "EventTime", "Voltage")


def input_digests(readings: DataFrame, cuts: Sequence[datetime]) -> dict[datetime, str]:
    """The digest of the readings up to each of ``cuts`` (inclusive), in one pass. Readings without a time are in none."""
    ordered = sorted(set(cuts))
    if not ordered:
        return {}
    r = time_range(readings, "EventTime", hi=ordered[-1])
    per = (r.select(cut_index(ordered, "EventTime").alias("_k"), F.xxhash64(*_COLUMNS).cast("decimal(20,0)").alias("_h"))
           .groupBy("_k").agg(F.count("*").alias("n"), F.sum("_h").alias("s")).collect())
    found = {x["_k"]: (x["n"], int(x["s"])) for x in per}
    out, n, s = {}, 0, 0
    for i, cut in enumerate(ordered):
        more = found.get(i, (0, 0))
        n, s = n + more[0], s + more[1]
        out[cut] = f"{n}:{s}"
    return out
