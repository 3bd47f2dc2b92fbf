"""Identifiers, URLs and time labels."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

# Fixed value: kind prefix of a submission in link ids.
SUBMISSION_PREFIX = "t3_"

# A profile address: its host, then one path segment, at once or behind #!/ of an address without a path.
PROFILE = (
    r"^[A-Za-z][A-Za-z0-9+.-]*://(?i:(?:www\.)?twitter\.com)(?::\d*)?"
    r"(?=/*[^/?#]+/*(?:[?#]|$)|/?(?:\?[^#]*)?#!/+[^/]+/*$)(?:/?(?:\?[^#]*)?#!)?/+@*([^/?#]*)"
)


def base36_decode(code: Column) -> Column:
    return F.conv(code, 36, 10).cast("bigint")


def base36_encode(number: Column) -> Column:
    return F.conv(number.cast("string"), 10, 36)


def profile_name(url: Column) -> Column:
    """User name from a profile address, '' where the address is something else.

    A profile address has the host twitter.com or www.twitter.com and one path segment, with or without a leading @;
    old addresses have the name behind ``#!/``. An address of a single post (/name/status/1) is not a profile.
    """
    return F.coalesce(F.regexp_extract(F.trim(url), PROFILE, 1), F.lit(""))


def url_host(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"^https?://([^/?#]+)", 1)


def url_first_segment(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), r"^https?://[^/?#]+/([^/?#]*)", 1)


def moment(value: datetime) -> Column:
    """Zone-less timestamp constant; a plain literal would be read in the machine's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less UTC timestamp, whatever the session zone is.

    Built from date and clock fields: a cast to an instant would apply the session zone.
    """
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    minutes = days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    micros = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return minutes * 60_000_000 + micros


def epoch_seconds(ts: Column) -> Column:
    return epoch_micros(ts) / F.lit(1_000_000.0)


def utc(ts: Column) -> Column:
    """Zone-less UTC timestamp -> instant, as watermarks need it."""
    return F.timestamp_micros(epoch_micros(ts))


def day_end(ts: Column) -> Column:
    """Label of the day interval [d-1, d) that holds ``ts``: its end d."""
    return F.date_add(ts.cast("date"), 1).cast("timestamp_ntz")
