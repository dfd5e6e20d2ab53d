"""The report views as Spark SQL temporary views.

``register_views(spark, base, as_of)`` names each view and report so that
SQL users can query them (``SELECT * FROM ms_gateway ORDER BY Grupo, Rank``).
The views are lazy plans over ``base``; nothing runs until queried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import DateLike
from .market_share import market_share
from .reports import REPORTS, report
from .views import VIEWS


def register_views(spark: SparkSession, base: DataFrame, as_of: DateLike,
                   back_weeks: int = 1, prefix: str = "ms_") -> list[str]:
    """Create ``<prefix><view>``, ``<prefix>all`` and ``<prefix>report_<name>``
    temporary views; returns their names."""
    names = []
    for name, view in VIEWS.items():
        market_share(base, view, as_of, back_weeks).createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    market_share(base, list(VIEWS.values()), as_of, back_weeks).createOrReplaceTempView(f"{prefix}all")
    names.append(f"{prefix}all")
    for name in REPORTS:
        report(base, name, as_of, back_weeks).createOrReplaceTempView(f"{prefix}report_{name}")
        names.append(f"{prefix}report_{name}")
    return names
