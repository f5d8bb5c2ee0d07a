"""Typed dates from the texts of the extracts.

Whether a day or a month comes first cannot be told from a value, so the forms are given per source.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date forms found in extracts.
DAY_MONTH_NAME_TIME = "dd-MMM-yyyy hh:mm:ss a"
DAY_FIRST_TIME = "dd/MM/yyyy HH:mm"
DAY_MONTH_NAME_SHORT = "d-MMM-yy"
DAY_MONTH_NAME = "dd-MMM-yyyy"
MONTH_FIRST_TIME = "M/d/yyyy H:mm"
MONTH_FIRST_TIME_12 = "MM/dd/yyyy hh:mm:ss a"
DAY_FIRST_FORMS = [DAY_MONTH_NAME_TIME, DAY_MONTH_NAME, DAY_MONTH_NAME_SHORT, DAY_FIRST_TIME]
MONTH_FIRST_FORMS = [DAY_MONTH_NAME_TIME, DAY_MONTH_NAME, DAY_MONTH_NAME_SHORT, MONTH_FIRST_TIME_12, MONTH_FIRST_TIME]


# What each part of a form looks like in a text.
_PARTS = {
    "d": r"\d{1,2}", "dd": r"\d{2}", "M": r"\d{1,2}", "MM": r"\d{2}", "MMM": "[A-Za-z]{3}", "yy": r"\d{2}",
    "yyyy": r"\d{4}", "H": r"\d{1,2}", "HH": r"\d{2}", "hh": r"\d{2}", "mm": r"\d{2}", "ss": r"\d{2}",
    "a": "[AaPp][Mm]",
}


def shape(form: str) -> str:
    """Pattern of the texts that have the form."""
    return "^" + re.sub(r"([A-Za-z])\1*", lambda part: _PARTS[part.group()], form) + "$"


def typed(col: Column, forms: Sequence[str]) -> Column:
    """Timestamp by the first form that fits; null if none does.

    A text is only parsed by a form whose shape it has: a failed parse costs many times a look at it.
    """
    return F.coalesce(*[F.when(col.rlike(shape(f)), F.try_to_timestamp(col, F.lit(f))) for f in forms])
