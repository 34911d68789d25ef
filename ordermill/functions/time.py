from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import BLANKS, strip

_BLANK_RUN = f"[{BLANKS}]+"
_YEAR = "(?!0000)([0-9]{4})"
_MONTH = "(0?[1-9]|1[0-2])"
_DAY = "(0?[1-9]|[12][0-9]|3[01])"
_HOUR = "([01]?[0-9]|2[0-3])"
_SIXTY = "([0-5]?[0-9])"

EPOCH = "^[0-9]+$"
# A blank may stand in for the leading zero of the day, hence its second group.
ISO = f"{_YEAR}-{_MONTH}-(?:{_DAY}| ([1-9]))(?:[Tt]|{_BLANK_RUN}){_HOUR}:{_SIXTY}:{_SIXTY}$"
DAY_FIRST = f"{_DAY}/{_MONTH}/{_YEAR}{_BLANK_RUN}{_HOUR}:{_SIXTY}$"

LAST_EPOCH_SECOND = 253402300799  # 9999-12-31 23:59:59 UTC


def parse_order_ts(raw: Column) -> Column:
    """Order time as a UTC instant, or NULL when the text has none of the accepted forms.

    Accepted: epoch seconds, `yyyy-M-dTH:m:s`, `yyyy-M-d H:m:s` and `d/M/yyyy H:m`. Zones and
    fractions are not. Text in an accepted form is rewritten to one that casts, in UTC whatever the
    session time zone; the question mark put before the text stays on all other text, which
    therefore casts to NULL, as does a date that does not exist. Only digits reach the number cast,
    which is slow on failure.
    """
    text = strip(raw)
    seconds = text.try_cast("bigint")
    dated = F.concat(F.lit("?"), text)
    dated = F.regexp_replace(dated, rf"^\?{ISO}", "$1-$2-$3$4 $5:$6:$7Z")
    dated = F.regexp_replace(dated, rf"^\?{DAY_FIRST}", "$3-$2-$1 $4:$5:00Z")
    return F.when(
        text.rlike(EPOCH), F.when(seconds <= LAST_EPOCH_SECOND, F.timestamp_seconds(seconds))
    ).otherwise(dated.try_cast("timestamp"))


def ts_format(raw: Column) -> Column:
    """Which of the source formats a raw order time is written in."""
    text = strip(raw)
    return (
        F.when(text.isNull(), "missing")
        .when(text.rlike(EPOCH), "epoch")
        .when(text.rlike(f"^{ISO}"), F.when(F.upper(text).contains("T"), "iso").otherwise("iso_blank"))
        .when(text.rlike(f"^{DAY_FIRST}"), "day_first")
        .otherwise("other")
    )


def utc_date(instant: Column) -> Column:
    """Calendar day in UTC, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86400).cast("int"))
