"""Weekly cargo market share on Spark.

Public entry points::

    from weekshare import (load_base, save_base, read_base, market_share,
                           report_rows, write_reports, VIEWS, REPORTS)
"""

from .plans.market_share import market_share
from .plans.quality import bad_weeks, lagged_weeks, latest_week, owners_present
from .plans.reports import REPORTS, report, report_rows, write_reports
from .plans.sql_views import register_views
from .plans.views import AWB, AWB_SAO, FEEDER, GATEWAY, GATEWAY_SAO, VIEWS, ViewSpec
from .sources.export import load_base, prepare_base
from .sources.warehouse import ensure_table, read_base, save_base

__all__ = [
    "market_share", "report", "report_rows", "write_reports", "register_views",
    "load_base", "prepare_base", "save_base", "read_base", "ensure_table",
    "owners_present", "latest_week", "lagged_weeks", "bad_weeks",
    "ViewSpec", "VIEWS", "AWB", "AWB_SAO", "GATEWAY", "GATEWAY_SAO", "FEEDER", "REPORTS",
]
