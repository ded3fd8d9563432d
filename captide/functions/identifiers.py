"""Columns derived from show identifiers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from captide.editions import Edition

# Where the catalogue keeps shows, and the file names of their documents.
CATALOGUE_HOST = "http://archive.org"
META_SUFFIX = "_meta.xml"
PAGE_SUFFIX = ".html"
GZIP_SUFFIX = ".gz"


def source_columns(identifier: Column, compressed: bool = False, host: str = CATALOGUE_HOST) -> dict[str, Column]:
    """Addresses of a show's documents and the local names they are stored under."""
    gz = GZIP_SUFFIX if compressed else ""
    return {
        "download_url": F.concat(F.lit(f"{host}/download/"), identifier),
        "details_url": F.concat(F.lit(f"{host}/details/"), identifier),
        "meta_url": F.concat(
            F.lit(f"{host}/download/"), identifier, F.lit("/"), identifier, F.lit(META_SUFFIX)
        ),
        "meta_file": F.concat(identifier, F.lit(META_SUFFIX + gz)),
        "page_file": F.concat(identifier, F.lit(PAGE_SUFFIX + gz)),
    }


def member_name(archive_id: Column, edition: Edition) -> Column:
    """The name of a show's page inside the edition's archive."""
    return F.concat(F.lit(edition.member_prefix), archive_id, F.lit(edition.member_suffix))


def member_archive_id(name: Column, edition: Edition) -> Column:
    """The show of an archive member; NULL for members that are no pages."""
    prefix, suffix = edition.member_prefix, edition.member_suffix
    inner = F.substring(name, F.lit(len(prefix) + 1), F.length(name) - (len(prefix) + len(suffix)))
    return F.when(name.startswith(prefix) & name.endswith(suffix), inner)


def normal_date(date: str) -> str:
    """A date given by a user as ``YYYY-MM-DD``, after the same loose check as ``is_valid_date``."""
    try:
        year, month, day = (int(part) for part in date.split("-")[:3])
    except ValueError:
        raise ValueError(f"Invalid date: {date!r}") from None
    if year < 1 or not 1 <= month <= 12 or not 1 <= day <= 31:
        raise ValueError(f"Invalid date: {date!r}")
    return f"{year:04d}-{month:02d}-{day:02d}"


def is_valid_date(date: Column) -> Column:
    """Loose check: year above 0, month 1-12, day 1-31, further parts ignored.

    Accepts dates such as 31 February and parts without leading zeros.
    """
    parts = F.split(date, "-")

    def part(index: int) -> Column:
        # Digits may be grouped by single underscores, as in "1_000".
        digits = F.regexp_replace(F.get(parts, F.lit(index)), r"(?<=\d)_(?=\d)", "")
        return digits.try_cast("bigint")

    checks = (part(0) > 0) & part(1).between(1, 12) & part(2).between(1, 31)
    return F.coalesce(checks, F.lit(False))
