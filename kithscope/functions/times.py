"""Account creation times: platform text form, ISO text and age in days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format of the platform, without the leading week day: "Oct 10 20:19:24 +0000 2018".
PLATFORM_FORMAT = "MMM dd HH:mm:ss Z yyyy"
MICROS_PER_DAY = 86_400_000_000


def parse_created_at(text: Column) -> Column:
    """Platform text or ISO text to a timestamp without zone (UTC); null when neither fits."""
    platform = F.try_to_timestamp(F.substring(text, F.lit(5), F.length(text)), F.lit(PLATFORM_FORMAT))
    iso = text.try_cast("timestamp")
    return F.coalesce(platform, iso).cast("timestamp_ntz")


def platform_text(ts: Column) -> Column:
    """Inverse of the platform form, used when records are written back as raw JSON."""
    return F.date_format(ts.cast("timestamp"), "EEE MMM dd HH:mm:ss Z yyyy")


def as_timestamp(moment: str | dt.datetime | Column) -> Column:
    return moment if isinstance(moment, Column) else F.lit(str(moment)).cast("timestamp_ntz")


def age_in_days(created_at: Column, as_of: str | dt.datetime | Column) -> Column:
    """Fractional days from creation to ``as_of``, never below zero; null for a missing date."""
    micros = F.unix_micros(as_timestamp(as_of).cast("timestamp")) - F.unix_micros(created_at.cast("timestamp"))
    return F.when(created_at.isNotNull(), F.greatest(F.lit(0.0), micros / F.lit(float(MICROS_PER_DAY))))
