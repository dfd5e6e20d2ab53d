"""IEEE-754 division that never raises under ANSI mode."""

from __future__ import annotations

def ieee_divide_sql(x: str, t: str) -> str:
    """``x / t`` over two SQL expressions, with IEEE results where plain ANSI
    division would fail: NULL in -> NULL; NaN in -> NaN; 0/0 -> NaN; x/0 ->
    +/-Infinity by the sign of ``x`` (a negative-zero denominator counts as
    +0). The NaN arm comes before the sign tests because Spark orders NaN
    above every number.
    """
    x, t = f"CAST({x} AS DOUBLE)", f"CAST({t} AS DOUBLE)"
    return (f"CASE WHEN {x} IS NULL OR {t} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN isnan({x}) OR isnan({t}) THEN CAST('NaN' AS DOUBLE) "
            f"WHEN {t} = 0.0D THEN CASE WHEN {x} = 0.0D THEN CAST('NaN' AS DOUBLE) "
            f"WHEN {x} > 0.0D THEN CAST('Infinity' AS DOUBLE) ELSE CAST('-Infinity' AS DOUBLE) END "
            f"ELSE {x} / {t} END")
