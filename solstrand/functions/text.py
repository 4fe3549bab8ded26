"""Checks and clean-up of free text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted e-mail format.  (?d) makes $ accept only a final "\n", not "\r\n".
EMAIL_PATTERN = r"(?d)^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def is_email(value: Column) -> Column:
    """TRUE or FALSE, never NULL."""
    return F.coalesce(value.rlike(EMAIL_PATTERN), F.lit(False))


def url_host(url: Column) -> Column:
    """Host of a URL, NULL when there is none or the text is no URL."""
    return F.try_parse_url(url, F.lit("HOST"))


def url_validity(url: Column) -> Column:
    return F.when(url_host(url).isNotNull(), "VALID")


def clean_timestamp(text: Column) -> Column:
    """Timestamp from text that may carry double quotes; NULL when it is none."""
    return F.replace(text, F.lit('"'), F.lit("")).try_cast("timestamp")
