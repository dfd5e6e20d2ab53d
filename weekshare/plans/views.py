"""The five report views as configurations of one pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column

from ..functions import rules as R
from ..functions.sqltext import in_list, lit


@dataclass(frozen=True)
class ViewSpec:
    """Settings that distinguish one market-share view.

    ``topn`` is the row-number threshold: competitors ranked ``>= topn`` by
    the newest week go to the others bucket, so 5 shows four named
    competitors (N8). ``topn_prefix`` overrides it for groups whose label
    starts with a prefix (the first that fits); a NULL label takes the first
    override, as in the feeder view, whatever the number of prefixes (W3).
    """
    name: str
    origin: R.RuleSet
    label: R.LabelSpec
    only_destinations: tuple | None = None     # extra filter (F2)
    topn: int = 5
    topn_prefix: tuple = ()                     # ((prefix, topn), ...)
    home: str = R.HOME_CARRIER
    others: str = R.OTHERS
    lag_weeks: dict = field(default_factory=lambda: dict(R.LATE_AIRPORTS))
    weeks: int = 5

    def origin_column(self) -> Column:
        return self.origin.column()

    def in_view_sql(self, origin: str = "`Origen`", dest: str = "`Destino`") -> str:
        """Row filter on classified columns (F1, F2); never NULL."""
        keep = f"{origin} != {lit(self.origin.fallback)} AND {dest} != {lit(R.FALLBACK)}"
        if self.only_destinations is not None:
            keep += f" AND {dest} IN {in_list(self.only_destinations)}"
        return f"coalesce({keep}, FALSE)"


    def threshold_sql(self, grupo: str = "`Grupo`") -> str:
        if not self.topn_prefix:
            return str(int(self.topn))
        # One rule for any number of prefixes: a label that misses all of them
        # takes ``topn``; a NULL label is not known to miss any, so it falls
        # through to the first prefix's threshold.
        (_, first), *_ = self.topn_prefix
        hits = [f"startswith({grupo}, {lit(p)})" for p, _ in self.topn_prefix]
        arms = " ".join(f"WHEN {h} THEN {int(n)}" for h, (_, n) in zip(hits, self.topn_prefix))
        return (f"CASE WHEN NOT ({' OR '.join(hits)}) THEN {int(self.topn)} {arms} "
                f"ELSE {int(first)} END")


# The five configured views.
AWB = ViewSpec("awb", R.AWB_ORIGIN, R.AWB_LABEL)
AWB_SAO = ViewSpec("awb_sao", R.AWB_ORIGIN, R.SAO_LABEL,
                   only_destinations=tuple(R.SAO_ALIAS))
GATEWAY = ViewSpec("gateway", R.GATEWAY_ORIGIN, R.GATEWAY_LABEL)
GATEWAY_SAO = ViewSpec("gateway_sao", R.GATEWAY_ORIGIN, R.SAO_LABEL)
FEEDER = ViewSpec("feeder", R.FEEDER_ORIGIN, R.FEEDER_LABEL, topn_prefix=(("ASIA", 10),))

VIEWS = {v.name: v for v in (AWB, AWB_SAO, GATEWAY, GATEWAY_SAO, FEEDER)}
