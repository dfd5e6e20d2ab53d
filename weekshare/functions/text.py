"""String cleaning: carrier codes (P10, P11) and export headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqltext import lit

# Characters with the Unicode White_Space property. The warehouse TRIM strips
# all of them; Spark's one-argument ``trim`` strips only U+0020, so the set is
# passed explicitly and the work stays a native string trim.
_WHITE_SPACE_RANGES = (
    (0x0009, 0x000D), (0x0020, 0x0020), (0x0085, 0x0085), (0x00A0, 0x00A0),
    (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F),
    (0x205F, 0x205F), (0x3000, 0x3000),
)
UNICODE_WHITE_SPACE = "".join(
    chr(code) for low, high in _WHITE_SPACE_RANGES for code in range(low, high + 1)
)

# Carrier recode applied at load, before any trim. Only the
# exact padded code is recoded; "QT" without the blank is left alone.
CARRIER_RECODE = {"QT ": "AV "}


def unicode_trim(col) -> Column:
    """Strip leading and trailing Unicode white space; NULL stays NULL."""
    col = F.col(col) if isinstance(col, str) else col
    return F.trim(col, F.lit(UNICODE_WHITE_SPACE))


def recode(col, mapping: dict[str, str] = CARRIER_RECODE) -> Column:
    """Replace whole values by exact match; all other values pass unchanged."""
    col = F.col(col) if isinstance(col, str) else col
    out = None
    for old, new in mapping.items():
        out = (F.when(col == old, F.lit(new)) if out is None
               else out.when(col == old, F.lit(new)))
    return col if out is None else out.otherwise(col)


# Pattern removed from export header names (white space,
# leading digits, parentheses and ampersands).
HEADER_JUNK = r"(?U)\s+|^\d+|\(|\)|&"


def clean_header_sql(cell: str) -> str:
    """One header cell normalised."""
    return f"regexp_replace(coalesce({cell}, ''), {lit(HEADER_JUNK)}, '')"
