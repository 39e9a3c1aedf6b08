"""Fixed lookup tables, applied as map-literal expressions (no join, no
shuffle; the map lives in the generated code)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# EU flag per country name (20 countries 0, 21 countries 1).
# Countries missing from this table get a null flag.
EU_FLAG = {
    "Norway": 0, "Switzerland": 0, "Iceland": 0, "USA": 0, "Australia": 0,
    "United Arab Emirates": 0, "Japan": 0, "Unspecified": 0, "Nigeria": 0, "RSA": 0,
    "Singapore": 0, "Bahrain": 0, "Thailand": 0, "Israel": 0, "West Indies": 0,
    "Korea": 0, "Brazil": 0, "Canada": 0, "Lebanon": 0, "Saudi Arabia": 0,
    "United Kingdom": 1, "France": 1, "Belgium": 1, "EIRE": 1, "Germany": 1,
    "Portugal": 1, "Denmark": 1, "Netherlands": 1, "Poland": 1, "Channel Islands": 1,
    "Spain": 1, "Cyprus": 1, "Greece": 1, "Austria": 1, "Sweden": 1,
    "Finland": 1, "Italy": 1, "Malta": 1, "Lithuania": 1, "Czech Republic": 1,
    "European Community": 1,
}


def lookup(table: dict, col: Column | str) -> Column:
    """Map a column through a small fixed dict; unknown keys give null."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return m[c]


def eu_flag(col: Column | str = "country") -> Column:
    return lookup(EU_FLAG, col).cast("int")
