"""Route classification rules kept as ordered data.

A rule set is an ordered tuple of ``(label, condition)``; the first rule whose
condition is TRUE wins and rows matching none get the fallback label. A
condition is in disjunctive normal form: a tuple of alternatives, each a tuple
of terms ``(column, op, value)`` that must all hold, with ``op`` one of
``"="``, ``"!="``, ``"in"``. SQL three-valued logic applies: a NULL input
makes a term unknown, so the rule does not fire and evaluation falls through,
exactly as a searched ``CASE`` does.

Rules compile to one ``CASE WHEN`` expression, so classification runs inside
whole-stage codegen. ``any_sql`` gives the disjunction of all conditions;
since no rule outputs the fallback label, "label != fallback" is that
disjunction, which the Parquet reader can use to skip data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqltext import ident, in_list, lit

Term = tuple  # (column, op, value)
Condition = tuple  # tuple of alternatives, each a tuple of Terms


def term_sql(term: Term) -> str:
    column, op, value = term
    c = ident(column)
    if op == "=":
        return f"{c} = {lit(value)}"
    if op == "!=":
        return f"{c} != {lit(value)}"
    if op == "in":
        return f"{c} IN {in_list(value)}"
    raise ValueError(f"unknown operator {op!r} in rule term {term!r}")


def condition_sql(cond: Condition) -> str:
    return " OR ".join("(" + " AND ".join(term_sql(t) for t in alt) + ")" for alt in cond)


@dataclass(frozen=True)
class RuleSet:
    rules: tuple  # ((label, Condition), ...)
    fallback: str = "Otros"

    def sql(self) -> str:
        arms = " ".join(f"WHEN {condition_sql(c)} THEN {lit(label)}" for label, c in self.rules)
        return f"CASE {arms} ELSE {lit(self.fallback)} END"

    def column(self) -> Column:
        return F.expr(self.sql())

    def any_sql(self) -> str:
        """Disjunction of all rule conditions; NULL where all are unknown
        (a WHERE clause treats that as FALSE)."""
        return " OR ".join(f"({condition_sql(c)})" for _, c in self.rules)


def _is(column, value):
    return (column, "=", value)


def _not(column, value):
    return (column, "!=", value)


def _in(column, *values):
    return (column, "in", tuple(values))


# ---------------------------------------------------------------------------
# The reporting rules. Labels, region, zone, country and airport
# codes must equal the source system's values, including the misspelt region
# "Arfica" in the gateway rule. Listed in evaluation order.
# ---------------------------------------------------------------------------

# AWB origin (P3): Europe by the air waybill's region.
AWB_ORIGIN = RuleSet(rules=(
    ("EUR", ((_is("RegionOrigenAWB", "Europe"),),)),
))

# Gateway origin (P4): segment region, waybill region, segment and waybill country.
GATEWAY_ORIGIN = RuleSet(rules=(
    ("EUR", ((_is("RegionOrigenSegmento", "Europe"),
              _in("RegionOrigenAWB", "Europe", "Arfica", "Asia")),)),
    ("EUR", ((_not("RegionOrigenSegmento", "Europe"),
              _is("RegionOrigenAWB", "Europe"),
              _not("PaisOrigenSegmento", "USA")),)),
    ("USA", ((_is("PaisOrigenSegmento", "USA"),),
             (_not("PaisOrigenSegmento", "USA"), _is("PaisOrigenAWB", "USA")))),
))

# Feeder origin (P5): zone, then region, then country.
FEEDER_ORIGIN = RuleSet(rules=(
    ("FL", ((_is("ZonaOrigenAWB", "NA_USA_Florida"),),)),
    ("GSA NA", ((_in("ZonaOrigenAWB", "NA_Canada", "NA_USA_Midwest", "NA_USA_NorthEast",
                     "NA_USA_South", "NA_USA_SouthEast"),),)),
    ("JFK", ((_is("ZonaOrigenAWB", "NA_USA_NewYork"),),)),
    ("WEST", ((_is("ZonaOrigenAWB", "NA_USA_West"),),)),
    ("INDIA", ((_is("ZonaOrigenAWB", "AS_India"),),)),
    ("ASIA", ((_is("RegionOrigenAWB", "Asia"), _not("ZonaOrigenAWB", "AS_India")),)),
    ("MEX", ((_is("PaisOrigenAWB", "MEXICO"),),)),
    ("OCEANIA", ((_is("RegionOrigenAWB", "Oceania"),),)),
    ("DE", ((_is("PaisOrigenAWB", "ALEMANIA"),),)),
    ("ES", ((_is("PaisOrigenAWB", "ESPANA"),),)),
    ("NL", ((_is("PaisOrigenAWB", "PAISES BAJOS"),),)),
    ("IT", ((_is("PaisOrigenAWB", "ITALIA"),),)),
    ("FR", ((_is("PaisOrigenAWB", "FRANCIA"),),)),
    ("BE", ((_is("PaisOrigenAWB", "BELGICA"),),)),
    ("UK", ((_is("PaisOrigenAWB", "REINO UNIDO"),),)),
    ("SK", ((_in("PaisOrigenAWB", "DINAMARCA", "SUECIA", "FINLANDIA", "NORUEGA"),),)),
    ("OTROS EU", ((_is("RegionOrigenAWB", "Europe"),),)),
))

# Destination (P6): a tracked country by name, else a tracked airport by code.
DEST_COUNTRIES = ("CHILE",)
DEST_AIRPORTS = ("GRU", "VCP", "LIM")

# Airports whose data arrive late, and by how many weeks.
LATE_AIRPORTS = {"GRU": 2, "VCP": 2}

# Destinations merged into one label in the SAO views.
SAO_ALIAS = {"VCP": "SAO", "GRU": "SAO"}

HOME_CARRIER = "LA"
OTHERS = "Otros"
FALLBACK = "Otros"


def destination_sql(fallback: str = FALLBACK) -> str:
    """Reporting destination (P6): country beats airport."""
    return (f"CASE WHEN `PaisDestinoAWB` IN {in_list(DEST_COUNTRIES)} THEN `PaisDestinoAWB` "
            f"WHEN `PostaDestinoAWB` IN {in_list(DEST_AIRPORTS)} THEN `PostaDestinoAWB` "
            f"ELSE {lit(fallback)} END")


def destination(fallback: str = FALLBACK) -> Column:
    return F.expr(destination_sql(fallback))


def destination_tracked_sql(only: tuple | None = None) -> str:
    """Raw-column form of ``destination() != fallback``, or of ``destination()
    IN only``, for the scan; pushable to Parquet (NULL where unknown, which a
    WHERE clause treats as FALSE). It may keep a row whose country beats the
    airport; the exact test follows on the classified row."""
    countries = [c for c in DEST_COUNTRIES if only is None or c in only]
    airports = [a for a in DEST_AIRPORTS if only is None or a in only]
    tests = ([f"`PaisDestinoAWB` IN {in_list(countries)}"] if countries else []) + (
        [f"`PostaDestinoAWB` IN {in_list(airports)}"] if airports else [])
    return f"({' OR '.join(tests) or 'FALSE'})"


@dataclass(frozen=True)
class LabelSpec:
    """How a route group is labelled.

    ``Origen - Destino`` with destinations renamed through ``dest_alias``;
    on a typed route the flight type is appended after a blank. A typed route
    is ``(origin or None, destination, flight type or None)``; None matches
    anything. A NULL flight type on a typed route makes the label NULL (N2).
    """
    dest_alias: tuple = ()      # ((destination, shown as), ...)
    typed_routes: tuple = ()    # ((origin|None, destination, flight|None), ...)

    def sql(self, origin: str = "`Origen`", dest: str = "`Destino`",
            flight: str = "`TipoVuelo`") -> str:
        """Label expression over SQL expressions for origin, destination and
        flight type."""
        shown = dest
        if self.dest_alias:
            arms = " ".join(f"WHEN {dest} = {lit(d)} THEN {lit(a)}" for d, a in self.dest_alias)
            shown = f"CASE {arms} ELSE {dest} END"
        plain = f"concat({origin}, ' - ', {shown})"
        if not self.typed_routes:
            return plain
        tests = []
        for o, d, f in self.typed_routes:
            parts = [f"{dest} = {lit(d)}"]
            if o is not None:
                parts.append(f"{origin} = {lit(o)}")
            if f is not None:
                parts.append(f"{flight} = {lit(f)}")
            tests.append("(" + " AND ".join(parts) + ")")
        return (f"CASE WHEN {' OR '.join(tests)} THEN concat({plain}, ' ', {flight}) "
                f"ELSE {plain} END")

    def column(self, origin: str = "`Origen`", dest: str = "`Destino`",
               flight: str = "`TipoVuelo`") -> Column:
        return F.expr(self.sql(origin, dest, flight))

    @property
    def uses_flight_type(self) -> bool:
        return bool(self.typed_routes)


# Label variants of the five views.
AWB_LABEL = LabelSpec()
SAO_LABEL = LabelSpec(dest_alias=tuple(SAO_ALIAS.items()))
GATEWAY_LABEL = LabelSpec(typed_routes=((None, "CHILE", None), ("USA", "LIM", None)))
FEEDER_LABEL = LabelSpec(typed_routes=(("FL", "CHILE", "PAX"),))
