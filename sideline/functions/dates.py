"""Date and key expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c

# Accepted incident date formats, tried in this order (the first
# that parses wins; an ambiguous day/month text is read month-first).
INCIDENT_DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy")


# Date and time in ISO form; its date part is read.
_ISO_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{1,2}:\d{2}"


def parse_date(c: ColumnOrName, formats: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    """First successful parse among ``formats``; unparsable text gives NULL.

    ``try_to_date`` is used because ANSI mode makes ``to_date`` raise on a
    mismatch. ISO dates and ISO date-times are read whatever the formats, so DATE and
    TIMESTAMP columns (whose text they are) give their day; a time is truncated.
    """
    text = _c(c).cast("string")
    iso = F.try_to_date(F.when(text.rlike(_ISO_TIME), F.substring(text, 1, 10)), "yyyy-MM-dd")
    tried = list(formats) if "yyyy-MM-dd" in formats else [*formats, "yyyy-MM-dd"]
    return F.coalesce(*[F.try_to_date(text, f) for f in tried], iso)


def date_key(c: ColumnOrName) -> Column:
    """Integer day key YYYYMMDD."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def between_dates(c: ColumnOrName, lo: str, hi: str) -> Column:
    """Closed range [lo, hi] on a DATE column; NULL dates are excluded."""
    return _c(c).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
