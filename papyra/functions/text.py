"""String, date and nested-field expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped from both ends of a key.
BLANKS = " \t\n\r\x0b\x0c"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Both-ends strip that also removes tabs and line breaks."""
    return F.btrim(_col(c), F.lit(BLANKS))


def split_ids(c: Column | str) -> Column:
    """Array of the ids in a cell joined by ``;`` or ``,``."""
    return F.split(strip(c), r"\s*[;,]\s*")


def issn_key(c: Column | str) -> Column:
    """Serial number without hyphens and surrounding blanks."""
    return F.replace(strip(c), F.lit("-"), F.lit(""))


def parsed_year(c: Column | str) -> Column:
    """Year of a date text; null when the text is not a date.

    Year-only and year-month texts count as dates.
    """
    return F.year(F.try_to_timestamp(_col(c)))


def prefix_year(c: Column | str) -> Column:
    """Year from the first four characters; null when they are no number."""
    return F.substring(_col(c).cast("string"), 1, 4).try_cast("int")


def year_label(c: Column | str) -> Column:
    """Four-digit year text, or ``N/A`` when there is no date."""
    year = F.substring(_col(c).cast("string"), 1, 4)
    return F.coalesce(F.when(year != "", year), F.lit("N/A"))


def non_empty(c: Column | str) -> Column:
    """True for a text with at least one non-blank character."""
    return F.coalesce(strip(c) != "", F.lit(False))


def file_stem(path: Column | str) -> Column:
    """Base name of a path without its ``.json`` ending."""
    return F.regexp_extract(_col(path), r"([^/]+?)(?:\.json)?$", 1)


def joined_texts(parts: Column | str) -> Column:
    """Texts of an ``array<struct<text>>``, joined by one blank."""
    return F.concat_ws(" ", _col(parts).getField("text"))


def any_affiliation(authors: Column | str, countries: tuple[str, ...]) -> Column:
    """True when any author's country is in ``countries``, case-folded."""
    wanted = [c.lower() for c in countries]
    hit = F.exists(
        _col(authors),
        lambda a: F.coalesce(
            F.lower(strip(a["affiliation"]["location"]["country"])).isin(*wanted),
            F.lit(False),
        ),
    )
    return F.coalesce(hit, F.lit(False))
