"""Column functions that turn raw text into clean values.

Every function takes a column (or its name) and gives a column; nothing here
leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values of the file format
NULL_TOKENS = (".", "?")
# --- fixed values of the file format
DATE_SHAPE = r"^(\d{4})-(\d{1,2})-(\d{1,2})$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_token(c, tokens=NULL_TOKENS) -> Column:
    """NULL where the value is exactly a null token; an empty text is kept."""
    c = _col(c)
    return F.when(~c.isin(*tokens), c)


def strip(c) -> Column:
    """Remove white space of every kind at both ends (``trim`` takes blanks only)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def blank_to_null(c, tokens=NULL_TOKENS) -> Column:
    """Strip, then NULL where nothing or a null token is left."""
    stripped = strip(c)
    return F.when(~stripped.isin("", *tokens), stripped)


def yes_no(c) -> Column:
    """``Y`` gives yes; NULL and anything else give no."""
    return F.when(F.upper(_col(c)) == "Y", "yes").otherwise("no")


def normalise_flag(c) -> Column:
    """``Y`` gives yes, ``N`` gives no, everything else stays, NULL included."""
    c = _col(c)
    return F.when(F.upper(c) == "Y", "yes").when(F.upper(c) == "N", "no").otherwise(c)


def parse_date(c) -> Column:
    """Date of a year-month-day text; NULL for another shape or an impossible day."""
    c = _col(c)
    return F.when(c.rlike(DATE_SHAPE), c).try_cast("date")


def date_problem(c) -> Column:
    """What is odd about a date text: ``invalid``, ``short`` (one-digit part) or NULL."""
    c = _col(c)
    return (
        F.when(c.isNull(), None)
        .when(parse_date(c).isNull(), "invalid")
        .when(~c.rlike(r"^\d{4}-\d\d-\d\d$"), "short")
    )


def typed(c, data_type: T.DataType) -> Column:
    """Strict cast of text to a column type; NULL where the text does not fit."""
    c = _col(c)
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, T.DateType):
        return parse_date(c)
    return c.try_cast(data_type)


def column_type(c) -> Column:
    """Column type for a dictionary type name; unknown names become text."""
    name = F.lower(_col(c))
    return (
        F.when(name.startswith("date"), "date")
        .when(name.startswith("int"), "integer")
        .otherwise("text")
    )


def is_known_type(c) -> Column:
    """Whether a dictionary type name is one the type rule knows."""
    return F.lower(_col(c)).rlike(r"^(float$|char|varchar|vchar|boolean|text|date|int)")


def epoch_if_null(c) -> Column:
    """A missing date counts as 1970-01-01."""
    return F.coalesce(_col(c), F.lit("1970-01-01").cast("date"))


def star_value(c) -> Column:
    """One value as STAR text: bare when it is a plain word, else quoted, else a text field.

    A semicolon that starts a line would end the text field, so a space goes before it.
    """
    c = _col(c).cast("string")
    bare = c.rlike(r"""^[^\s_#$'"\[\];][^\s]*$""") & ~c.rlike(r"(?i)^(data_|save_|loop_$|stop_$|global_$)")
    return (
        F.when(c.isNull(), ".")
        .when(bare & ~c.isin(*NULL_TOKENS), c)
        .when(~c.contains("\n") & ~c.contains("'"), F.concat(F.lit("'"), c, F.lit("'")))
        .when(~c.contains("\n") & ~c.contains('"'), F.concat(F.lit('"'), c, F.lit('"')))
        .otherwise(F.concat(F.lit("\n;"), F.replace(c, F.lit("\n;"), F.lit("\n ;")), F.lit("\n;")))
    )
