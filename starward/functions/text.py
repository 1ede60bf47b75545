"""Text rules as Column -> Column; all of them stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The exact markers written to the tables.  The e-mail marker ends in a space.
INVALID_EMAIL = " (Invalid) "
DELETED = " (Deleted)"
DELETED_TEST = "(Deleted)"


def joined(left: Column, right: Column) -> Column:
    """``left + ' ' + right``; NULL on either side gives NULL."""
    return F.concat(left, F.lit(" "), right)


def filled(value: Column, default, length: int | None = None) -> Column:
    """NULL replacement, then a cut to the declared length.  A cast to varchar does not cut."""
    out = F.coalesce(value, F.lit(default))
    return out if length is None else F.substring(out, 1, length)


def lacks(value: Column, piece: str) -> Column:
    """True where ``piece`` does not occur; NULL stays NULL and so never selects a row."""
    return F.instr(value, piece) == 0


def marked_email(email: Column) -> Column:
    """Append the marker to an address without ``@`` or without ``.com``."""
    bad = lacks(email, "@") | lacks(email, ".com")
    return F.when(bad, F.concat(email, F.lit(INVALID_EMAIL))).otherwise(email)


def marked_deleted(name: Column) -> Column:
    """Append the deletion marker once."""
    return F.when(F.instr(name, DELETED_TEST) > 0, name).otherwise(
        F.concat(name, F.lit(DELETED))
    )


def trimmed_city(city: Column) -> Column:
    return F.ltrim(city)


def cleaned_state(state: Column) -> Column:
    """Drop blanks and a city name that was typed into the state."""
    no_blanks = F.replace(state, F.lit(" "), F.lit(""))
    return F.replace(no_blanks, F.lit("Redmond"), F.lit(""))


def collated(value: Column, collation: str | None) -> Column:
    """Compare under another collation, e.g. ``UTF8_LCASE_RTRIM`` (case and end blanks ignored)."""
    return value if collation is None else F.collate(value, collation)
