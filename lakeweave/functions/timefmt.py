"""Time helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType



def event_time(text: Column) -> Column:
    """P5: ISO-8601 text -> TIMESTAMP; unparsable or empty text -> NULL.

    ``try_to_timestamp`` rather than ``to_timestamp``: with ANSI mode on
    (Spark 4 default) the latter raises on bad input instead of NULL.
    """
    return F.try_to_timestamp(text)


def _padded(ntz_text: Column, between: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.f]`` -> the same with six digits of a second."""
    parts = F.split(ntz_text, "\\.")
    return F.concat(F.replace(parts[0], F.lit(" "), F.lit(between)), F.lit("."),
                    F.rpad(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), 6, "0"))


def iso_utc(ts_ntz: Column) -> Column:
    """Wall-clock timestamp (read as UTC) -> ISO-8601 text with ``+00:00``.
    Casting a wall-clock value to text involves no time zone (``date_format``
    would: it moves times in a daylight-saving gap)."""
    return F.concat(_padded(ts_ntz.cast("timestamp_ntz").cast("string"), "T"), F.lit("+00:00"))


def flatten_window(df: DataFrame, window_col: str = "window") -> DataFrame:
    """``window`` struct -> ``window_start``, ``window_end`` first."""
    rest = [c for c in df.columns if c != window_col]
    return df.select(
        F.col(f"{window_col}.start").alias("window_start"),
        F.col(f"{window_col}.end").alias("window_end"),
        *rest,
    )


def timestamps_as_text(df: DataFrame) -> DataFrame:
    """P10: every timestamp column -> text ``yyyy-MM-dd HH:mm:ss.ffffff``.

    Instants (``TIMESTAMP``) are written as UTC wall-clock whatever the
    session time zone; wall-clock values (``TIMESTAMP_NTZ``) as they are.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            # microseconds since the epoch added to a wall-clock epoch: no time zone takes part
            utc = F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
            out.append(_padded(utc.cast("string"), " ").alias(f.name))
        elif isinstance(f.dataType, TimestampNTZType):
            out.append(_padded(c.cast("string"), " ").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
