"""Wall-clock expressions that do not depend on the session time zone.

``date_trunc``, ``date_format`` and ``unix_timestamp`` convert TIMESTAMP_NTZ through the session
zone, which shifts hours around a daylight-saving change. Interval arithmetic does not.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def timestamp_literal(moment: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal; a zone-aware moment is taken in UTC."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast(NTZ)


def _seconds_since(ts: Column, start: Column) -> Column:
    return (ts.cast(NTZ) - start).cast("interval second").cast("bigint")


def seconds_between(begin: Column, end: Column) -> Column:
    """Seconds from ``begin`` to ``end`` after dropping the fraction of each side."""
    epoch = timestamp_literal("1970-01-01 00:00:00")
    return _seconds_since(end, epoch) - _seconds_since(begin, epoch)


def hour_bucket(ts: Column) -> Column:
    """Start of the wall-clock hour that holds ``ts``."""
    ntz = ts.cast(NTZ)
    zero = F.lit(0)
    return ntz - F.make_dt_interval(zero, zero, F.minute(ntz), F.extract(F.lit("SECOND"), ntz))


def hour_label(bucket: Column) -> Column:
    """``2024-03-10T02:00:00`` for an hour bucket."""
    return F.replace(bucket.cast("string"), F.lit(" "), F.lit("T"))
