"""Small column expressions shared by the plans."""

import datetime
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.schemas import MONEY


def lenient_timestamp(text: Column, layouts: Sequence[str] = ()) -> Column:
    """Text to timestamp; anything unreadable becomes NULL.

    ISO text is always read. Other layouts are declared by the data's owner, in order of trial:
    whether 10/02/2017 is in October or February is not for a row to tell.
    """
    tries = [F.try_to_timestamp(text, F.lit(layout)) for layout in layouts]
    return F.coalesce(F.try_to_timestamp(text), *tries)


def money(value: Column) -> Column:
    return F.round(value, 2).cast(MONEY)


def list_length(values: Column) -> Column:
    """Element count, NULL for a NULL list whatever the ANSI setting."""
    return F.when(values.isNotNull(), F.size(values))


def after_days(moment: Column, days: int) -> Column:
    return moment + F.expr(f"INTERVAL {int(days)} DAYS")


def date_label(day: datetime.date) -> str:
    """Partition label of a load date; the run date is always passed in."""
    return day.strftime("%Y-%m-%d")


def year_month(moment: Column) -> Column:
    """Integer yyyymm."""
    return F.year(moment) * 100 + F.month(moment)
