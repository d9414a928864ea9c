"""Text expressions with the NULL behaviour the reports rely on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(part: Column | str) -> Column:
    return F.lit(part) if isinstance(part, str) else part.cast("string")


def concat_blank_null(*parts: Column | str) -> Column:
    """Concatenation in which a NULL counts as empty text. Plain strings are literals."""
    return F.concat(*[F.coalesce(_text(p), F.lit("")) for p in parts])


def concat_null(*parts: Column | str) -> Column:
    """Concatenation that is NULL as soon as one part is."""
    return F.concat(*[_text(p) for p in parts])


def indent(level: Column, text: Column, width: int = 4) -> Column:
    """``text`` moved right by ``width`` blanks for each level."""
    return F.concat(F.repeat(F.lit(" " * width), level), text)


def left_pad_digits(number: Column, width: int) -> Column:
    """The last ``width`` digits of ``number``, padded with zeros on the left."""
    return F.right(F.concat(F.lit("0" * width), number.cast("string")), F.lit(width))
