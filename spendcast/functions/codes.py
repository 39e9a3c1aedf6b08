"""Order-id and product-code predicates and rewrites.

Character classes are ASCII.  Patterns end in ``\\z`` (end of input): Java's
``$`` would also match before a final newline.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = r"^[0-9]+\z"
LETTERS = r"^[A-Za-z]+\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_digits(col: Column | str) -> Column:
    return _c(col).rlike(DIGITS)


def is_letters(col: Column | str) -> Column:
    return _c(col).rlike(LETTERS)


def order_id_anomalous(col: Column | str = "order_id") -> Column:
    """Not all digits and not a refund (first character is not ``C``)."""
    c = _c(col)
    return ~is_digits(c) & (F.substring(c, 1, 1) != "C")


def product_anomalous(col: Column | str = "product_id") -> Column:
    """First five characters are not all digits (``POST``, ``C2``, ``''``...)."""
    return ~is_digits(F.substring(_c(col), 1, 5))


def normalize_product_id(col: Column | str = "product_id") -> Column:
    """Drop the last character of codes that are neither all digits nor all
    letters (``85123A`` -> ``85123``); other codes and nulls pass through."""
    c = _c(col)
    return F.when(~is_digits(c) & ~is_letters(c),
                  c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def product_prefix(col: Column | str = "product_id", n: int = 3) -> Column:
    """Product family: first ``n`` characters of the normalised code."""
    return F.substring(normalize_product_id(col), 1, n)
