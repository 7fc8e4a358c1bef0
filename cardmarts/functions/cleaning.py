"""Column helpers that turn raw text into typed, masked values.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``,
so they stay inside whole-stage codegen. Parsing uses ``try_cast``: with ANSI
mode on (the Spark 4 default) a plain cast aborts the job on the first bad
value, whereas the data-quality flags downstream expect a null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the mask that replaces all but the last four card digits.
CARD_MASK = "************"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_currency(col: str | Column) -> Column:
    """``"$1,234.50"`` to 1234.5; text that is not a number gives null.

    Only ``$`` and ``,`` are removed, so ``"($5)"`` is null, not -5.
    """
    return F.regexp_replace(_c(col), r"[$,]", "").try_cast("double")


def mask_card_number(col: str | Column) -> Column:
    """Twelve stars plus the last four characters; null stays null."""
    return F.concat(F.lit(CARD_MASK), card_last4(col))


def card_last4(col: str | Column) -> Column:
    """The last four characters (fewer if the value is shorter)."""
    return F.substring(_c(col), -4, 4)


def round_coordinates(col: str | Column) -> Column:
    """Latitude or longitude text to a double rounded to two places (half up)."""
    return F.round(_c(col).try_cast("double"), 2)


def to_int(col: str | Column) -> Column:
    """Text to int, dropping a decimal fraction: ``"12.0"`` is 12, ``"-3.7"`` is -3.

    Surrounding blanks are allowed; exponents and other text give null.
    """
    return F.regexp_replace(_c(col), r"\.\d*(\s*)$", "$1").try_cast("int")


def to_boolean(col: str | Column) -> Column:
    """Text to boolean: yes/no, y/n, true/false, t/f, 1/0 in any case; else null."""
    return _c(col).try_cast("boolean")


def to_timestamp(col: str | Column) -> Column:
    """Text to a zone-free timestamp (``timestamp_ntz``); unparsable gives null."""
    return _c(col).try_cast("timestamp_ntz")


def to_date(col: str | Column) -> Column:
    """Text to date in the default ISO forms (``2002-09-01``, ``2002-09``, ``2002``)."""
    return _c(col).try_cast("date")


def label_to_boolean(col: str | Column) -> Column:
    """Exactly ``"Yes"`` is true and ``"No"`` false; anything else stays null."""
    c = _c(col)
    return F.when(c == "Yes", F.lit(True)).when(c == "No", F.lit(False))


def error_flag(col: str | Column) -> Column:
    """True when an error text is present; never null."""
    return _c(col).isNotNull()


def year_month(col: str | Column) -> tuple[Column, Column]:
    """Calendar year and month of a timestamp, as two int columns."""
    c = _c(col)
    return F.year(c), F.month(c)
