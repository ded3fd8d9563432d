"""Text columns: keyword positions and byte-literal clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A whole Python bytes literal in either quoting. Possessive repeats keep the match
# linear and free of recursion on long texts.
_LITERAL = r"""^b(?:'([^'\\]*+(?:\\.[^'\\]*+)*+)'|"([^"\\]*+(?:\\.[^"\\]*+)*+)")\z"""

# The escapes of a Python bytes literal, as percent codes. A doubled
# backslash goes first, so that what is left starts an escape.
_ESCAPES = [
    ("\\\\", "%5C"),
    ("\\n", "%0A"),
    ("\\r", "%0D"),
    ("\\t", "%09"),
    ("\\'", "%27"),
    ('\\"', "%22"),
    ("\\x", "%"),
]


def keyword_position(text: Column, keyword: str) -> Column:
    """Zero-based position of the first occurrence, -1 if there is none."""
    return (F.instr(text, keyword) - 1).cast("bigint")


def strip_repr_compat(text: Column, pattern: str) -> Column:
    """Drop every ``b'…'`` wrapper the edition's pattern finds, anywhere in the text.

    Escapes stay as they are and plain text that looks alike is damaged; use
    ``strip_repr`` unless the old releases have to be matched.
    """
    return F.regexp_replace(text, pattern, "$1")


def strip_repr(text: Column) -> Column:
    """The text inside a value that is a bytes literal as a whole; others unchanged.

    Escapes are turned into percent codes, which Spark decodes as UTF-8.
    """
    is_literal = text.rlike(_LITERAL)
    body = F.substring(text, F.lit(3), F.length(text) - 3)
    for plain, code in [("%", "%25"), ("+", "%2B"), *_ESCAPES]:
        body = F.replace(body, F.lit(plain), F.lit(code))
    return F.when(is_literal, F.coalesce(F.try_url_decode(body), text)).otherwise(text)


def strip_repr_columns(df: DataFrame, pattern: str | None = None) -> DataFrame:
    """Clean all string columns; ``pattern`` selects the compatible form."""

    def cleaned(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType):
            return column
        stripped = strip_repr(column) if pattern is None else strip_repr_compat(column, pattern)
        return stripped.alias(field.name)

    return df.select([cleaned(field) for field in df.schema.fields])
