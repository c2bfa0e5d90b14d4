"""Named measures evaluated under any grouping and filter selection.

A measure states which filters it keeps: ``drop_tables`` ignores every filter and grouping on a
table, ``replace`` swaps the selection on a field, ``role`` decides whether station and line follow
the origin or the destination. All measures of one role share a single scan of the fact: rows are
added up on the fact's own keys first, the dimensions are joined to those sums, and each context
becomes a conditional sum. Dates of a trailing window need their own pass, because it looks back
beyond the date filter.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.functions.dates import calendar_attributes
from farelens.functions.numeric import as_decimal, fare_total, mean, ratio
from farelens.operators.trends import trailing_day_totals
from farelens.plans.rollups import smallest
from farelens.schemas import DIGITAL_TYPES, Rollup
from farelens.session import stage
from farelens.sources import tables

# A selection: a list of values (None = the blank member) or an inclusive (low, high) pair.
Selection = Sequence | tuple

STATION, LINE, DATE, FACT = "station", "line", "date", "fact"

# Field -> (table, column in the model). Fields of the date table derive from txn_date.
FIELDS: dict[str, tuple[str, str]] = {
    "date": (DATE, "txn_date"),
    "year": (DATE, "year"),
    "quarter": (DATE, "quarter"),
    "month_no": (DATE, "month_no"),
    "month_name": (DATE, "month_name"),
    "day_name": (DATE, "day_name"),
    "is_weekend": (DATE, "is_weekend"),
    "line_name": (LINE, "line_name"),
    "station_id": (STATION, "station_id"),
    "station_name": (STATION, "station_name"),
    "ticket_type": (FACT, "ticket_type"),
    "txn_type": (FACT, "txn_type"),
    "fare_type": (FACT, "fare_type"),
}

ROLE_KEYS = {"origin": "origin_station_id", "destination": "dest_station_id"}


@dataclass(frozen=True)
class ReportModel:
    """Fact with ``ticket_type`` as text, snowflaked stations and lines, and the calendar.

    The fact holds transactions (``fare_amount``) or a rollup of them (``rows`` and ``revenue``). ``rollups``
    hold the same on fewer keys; each part of an evaluation reads the smallest that has its columns.
    """

    fact: DataFrame
    stations: DataFrame
    lines: DataFrame
    calendar: DataFrame
    rollups: tuple[Rollup, ...] = ()

    def source(self, columns: Iterable[str]) -> DataFrame:
        chosen = smallest(self.rollups, columns)
        return self.fact if chosen is None else chosen.table


@dataclass(frozen=True)
class Context:
    """Which filters survive and which role the station plays."""

    drop_tables: frozenset[str] = frozenset()
    replace: tuple[tuple[str, tuple], ...] = ()
    role: str = "origin"

    def filters(self, selected: Mapping[str, Selection]) -> dict[str, Selection]:
        replaced = dict(self.replace)
        kept = {f: s for f, s in selected.items() if FIELDS[f][0] not in self.drop_tables and f not in replaced}
        return kept | {field: list(values) for field, values in replaced.items()}

    def keeps(self, field: str) -> bool:
        return FIELDS[field][0] not in self.drop_tables and field not in dict(self.replace)


@dataclass(frozen=True)
class Measure:
    """``base`` is rows, revenue, stations or days; ``per`` divides by another base and context."""

    base: str
    context: Context = Context()
    per: tuple[str, Context] | None = None
    trailing_days: int | None = None
    scale: str | None = None


_PLAIN = Context()


def catalogue(digital: Sequence[str] = DIGITAL_TYPES) -> dict[str, Measure]:
    digital_context = Context(replace=(("ticket_type", tuple(digital)),))
    return {
        "total_footfall": Measure("rows"),
        "total_revenue": Measure("revenue"),
        "avg_ticket_value": Measure("revenue", per=("rows", _PLAIN)),
        "stations_covered": Measure("stations"),
        "daily_avg_revenue": Measure("revenue", per=("days", _PLAIN)),
        "revenue_30d_rolling_avg": Measure("revenue", trailing_days=30),
        "revenue_share": Measure("revenue", per=("revenue", Context(drop_tables=frozenset({LINE})))),
        "digital_adoption": Measure("rows", digital_context, per=("rows", _PLAIN)),
        "revenue_by_destination": Measure("revenue", Context(role="destination")),
        # Fixed value: the target as a share of the observed daily average.
        "daily_revenue_target": Measure("revenue", per=("days", _PLAIN), scale="0.967"),
    }


def _selected(column: Column, selection: Selection) -> Column:
    if isinstance(selection, tuple):
        low, high = selection
        return column.between(F.lit(low), F.lit(high))
    values = [v for v in selection if v is not None]
    if all(v is not None for v in selection):
        return column.isin(values)
    return column.isNull() | column.isin(values) if values else column.isNull()


def _field(name: str) -> Column:
    return F.col(FIELDS[name][1])


def _with_date_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Derive the year, month and other date columns that ``fields`` name from ``txn_date``."""
    names = {FIELDS[name][1] for name in fields if FIELDS[name][0] == DATE} - {"txn_date"}
    if not names:
        return df
    derived = calendar_attributes(F.col("txn_date"))
    return df.withColumns({name: derived[name] for name in sorted(names)})


def _condition(filters: Mapping[str, Selection], fact: DataFrame | None = None) -> Column | None:
    parts = []
    for name, selection in filters.items():
        if fact is not None and name == "date" and isinstance(selection, tuple):
            parts.append(tables.days(fact, *selection))
        else:
            column = _field(name)
            if name == "date":
                selection = _as_dates(selection)
            parts.append(_selected(column, selection))
    return reduce(lambda a, b: a & b, parts) if parts else None


def selected_on_fact(filters: Mapping[str, Selection], fact: DataFrame) -> Column | None:
    """Condition of filters on dates and fact columns; none without filters."""
    return _condition(filters, fact)


def _as_dates(selection: Selection) -> Selection:
    cast = [None if v is None else F.lit(v).cast("date") for v in selection]
    return tuple(cast) if isinstance(selection, tuple) else cast


def _where(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.where(condition)


def _on_fact(name: str) -> bool:
    return FIELDS[name][0] in (DATE, FACT)


def _added_up(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and revenue per combination of the fact's own keys."""
    if "rows" in fact.columns:
        sums = [F.sum("rows").alias("rows"), F.sum("revenue").alias("revenue")]
    else:
        sums = [F.count("*").alias("rows"), fare_total().alias("revenue")]
    return fact.groupBy(*keys).agg(*sums)


def native_keys(fields: Sequence[str], role: str, whole_dates: bool = False) -> list[str]:
    """Fact columns that ``fields`` depend on; ``whole_dates`` keeps the date itself, not its parts."""
    keys = set()
    for name in fields:
        table, column = FIELDS[name]
        if table == DATE and whole_dates:
            column = "txn_date"
        keys.add(column if table in (DATE, FACT) else ROLE_KEYS[role])
    return sorted(keys)


def _on_calendar(sums: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sums by day with the days that the calendar lacks under the blank member."""
    days = calendar.select("date_key")
    return sums.join(days, sums["txn_date"] == days["date_key"], "left").drop("txn_date").withColumnRenamed("date_key", "txn_date")


def _scan(model: ReportModel, columns: Iterable[str], filters: Mapping[str, Selection]) -> DataFrame:
    """Rows with ``columns`` under filters on dates and fact columns, from the smallest table that has them all.

    Where the table lies in month folders, filters on the calendar's attributes choose folders too: the months
    of the calendar days they select prune the scan while it runs.
    """
    rows = model.source({*columns, *native_keys(list(filters), "origin", whole_dates=True)})
    on_calendar = {n: s for n, s in filters.items() if FIELDS[n][0] == DATE and not (n == "date" and isinstance(s, tuple))}
    if on_calendar and tables.MONTH in rows.columns:
        days = _with_date_fields(model.calendar.select(F.col("date_key").alias("txn_date")), list(on_calendar))
        months = _where(days, _condition(on_calendar)).select(tables.month_of(F.col("txn_date")).alias(tables.MONTH)).distinct()
        rows = rows.join(months, tables.MONTH, "left_semi")
    rows = _with_date_fields(rows, list(filters))
    return _where(rows, _condition(filters, rows))


def _with_dimensions(df: DataFrame, model: ReportModel, fields: Sequence[str], role: str) -> DataFrame:
    """Attach the station and line columns ``fields`` need; unmatched rows keep a blank member."""
    needed = {FIELDS[name][0] for name in fields}
    if needed & {STATION, LINE}:
        stations = model.stations.select("station_id", "station_name", F.col("line_id").alias("home_line_id"))
        df = df.join(stations, df[ROLE_KEYS[role]] == stations["station_id"], "left")
    if LINE in needed:
        lines = model.lines.select(F.col("line_id").alias("home_line_id"), "line_name")
        df = df.join(lines, "home_line_id", "left")
    return df


def _additive(model, specs: Mapping[str, Measure], group_by, filters, role: str) -> DataFrame:
    """All measures of one role over a single scan."""
    wanted = []
    for spec in specs.values():
        for item in [(spec.base, spec.context)] + ([spec.per] if spec.per else []):
            if item not in wanted:
                wanted.append(item)
    contexts = list(dict.fromkeys(context for _, context in wanted))
    surviving = {context: context.filters(filters) for context in contexts}
    common = {
        name: selection
        for name, selection in surviving[contexts[0]].items()
        if all(kept.get(name) == selection for kept in surviving.values())
    }
    special = {c: {n: s for n, s in kept.items() if n not in common} for c, kept in surviving.items()}

    fields = list(dict.fromkeys([*group_by, *common, *[n for kept in special.values() for n in kept]]))
    # A filter that every context shares is applied on the scan, so its column is no grouping key.
    beyond_scan = [n for n in fields if n in group_by or not (n in common and FIELDS[n][0] == FACT)]
    bases = {base for base, _ in wanted}
    dated = "days" in bases or any(FIELDS[n][0] == DATE for n in fields)
    keys = set(native_keys(beyond_scan, role, whole_dates=True))
    keys |= {"origin_station_id"} if "stations" in bases else set()
    keys |= {"txn_date"} if dated else set()

    # Date filters cut the scan too; which days the calendar has is seen on the sums.
    cut = {n: s for n, s in common.items() if FIELDS[n][0] == FACT or FIELDS[n][0] == DATE and None not in s}
    scan = _scan(model, keys, cut)
    cube = _added_up(scan, sorted(keys))
    if dated:
        cube = _with_date_fields(_on_calendar(cube, model.calendar), fields)
    cube = _with_dimensions(cube, model, beyond_scan, role)
    cube = _where(cube, _condition({n: s for n, s in common.items() if FIELDS[n][0] != FACT}))

    sums, columns = [], {}
    for index, (base, context) in enumerate(wanted):
        name = f"__{base}_{index}"
        columns[(base, context)] = name
        sums.append(_conditional(base, _condition(special[context])).alias(name))
    groups = [_field(name).alias(name) for name in group_by]
    grouped = cube.groupBy(*groups).agg(*sums)

    # Groupings a context ignores: add its sums up across them.
    for (_, context), name in columns.items():
        kept = [field for field in group_by if context.keeps(field)]
        if len(kept) < len(group_by):
            grouped = grouped.withColumn(name, F.sum(name).over(Window.partitionBy(*kept)))
    return grouped.select(
        *group_by, *[_value(spec, columns).alias(name) for name, spec in specs.items()]
    )


def selected_sums(model: ReportModel, keys: Sequence[str], filters: Mapping[str, Selection]) -> DataFrame:
    """Rows and revenue per combination of the fact's own ``keys`` under a selection."""
    on_fact = {n: s for n, s in filters.items() if FIELDS[n][0] == FACT or FIELDS[n][0] == DATE and None not in s}
    dated = any(FIELDS[n][0] == DATE for n in filters)
    others = [n for n in filters if FIELDS[n][0] != FACT]
    wanted = {*keys, *native_keys(others, "origin", whole_dates=True)}
    sums = _added_up(_scan(model, wanted, on_fact), sorted(wanted))
    if dated:
        sums = _with_date_fields(_on_calendar(sums, model.calendar), others)
    sums = _where(_with_dimensions(sums, model, others, "origin"), _condition({n: filters[n] for n in others}))
    return sums.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.sum("revenue").alias("revenue"))


def _conditional(base: str, condition: Column | None) -> Column:
    def only(column: Column) -> Column:
        return column if condition is None else F.when(condition, column)

    if base in ("rows", "revenue"):
        return F.sum(only(F.col(base)))
    column = F.col({"stations": "origin_station_id", "days": "txn_date"}[base])
    if base == "days":  # a day without revenue is no part of an average over days
        paid = F.col("revenue").isNotNull()
        condition = paid if condition is None else condition & paid
    # The blank counts as one value; nothing at all stays blank.
    distinct = F.count_distinct(only(column)) + F.coalesce(F.max(only(column.isNull().cast("int"))), F.lit(0))
    return F.nullif(distinct, F.lit(0))


def _value(spec: Measure, columns: Mapping) -> Column:
    value = F.col(columns[(spec.base, spec.context)])
    if spec.per:
        below = F.col(columns[spec.per])
        if spec.base == "rows":
            value = as_decimal(value)
        value = ratio(value, below if spec.per[0] == "revenue" else as_decimal(below))
    if spec.scale:
        value = value * F.lit(spec.scale).cast("decimal(6,3)")
    return value


def _trailing(model, name: str, spec: Measure, group_by, filters) -> DataFrame:
    """Mean of the daily totals over the calendar days that end at each group's last date.

    The date selection moves the end of the window and does not cut its start. Days without
    revenue are skipped, and a date without sales still gets a value.
    """
    dates = [f for f in group_by if FIELDS[f][0] == DATE]
    others = [f for f in group_by if FIELDS[f][0] != DATE]
    on_dates = {n: s for n, s in filters.items() if FIELDS[n][0] == DATE}
    rest = {n: s for n, s in spec.context.filters(filters).items() if n not in on_dates}

    calendar = _with_date_fields(model.calendar.select(F.col("date_key").alias("txn_date")), [*dates, *on_dates])
    chosen = _where(calendar, _condition(on_dates))
    anchors = chosen.groupBy(*[_field(n).alias(n) for n in dates]).agg(F.max("txn_date").alias("anchor"))

    beyond_scan = [n for n in dict.fromkeys([*others, *rest]) if n in others or not _on_fact(n)]
    role = spec.context.role
    keys = {"txn_date", *native_keys(beyond_scan, role)}
    scan = _scan(model, keys, {n: s for n, s in rest.items() if _on_fact(n)})
    span = filters.get("date")
    if isinstance(span, tuple):
        first = F.date_sub(F.lit(span[0]).cast("date"), spec.trailing_days - 1)
        scan = scan.where(tables.days(scan, first, span[1]))
    cube = _added_up(scan, sorted(keys))
    cube = _with_dimensions(cube, model, beyond_scan, role)
    cube = _where(cube, _condition({n: s for n, s in rest.items() if not _on_fact(n)}))
    daily = cube.groupBy(*[_field(n).alias(n) for n in others], "txn_date").agg(F.sum("revenue").alias("revenue"))
    days = model.calendar.select(F.col("date_key").alias("txn_date"))
    daily = daily.join(days, "txn_date", "left_semi")  # a window holds days of the calendar only

    windows = trailing_day_totals(daily, anchors, others, dates, "txn_date", "revenue", spec.trailing_days)
    return windows.select(*group_by, mean(F.col("window_total"), F.col("window_days")).alias(name))


def evaluate(
    model: ReportModel,
    measures: Sequence[str],
    group_by: Sequence[str] = (),
    filters: Mapping[str, Selection] | None = None,
    known: Mapping[str, Measure] | None = None,
    totals: bool = False,
) -> DataFrame:
    """One row per group with at least one non-blank measure; unrounded decimals.

    With ``totals`` also one row for each combination of fewer group fields and the grand total, every
    measure evaluated anew at each level: distinct stations, averages and shares don't add up from cells.
    ``level`` numbers them as grouping_id does: 0 is a plain cell, the last field's bit is 1.
    """
    known = known or catalogue()
    if totals:
        return _every_level(model, list(measures), list(group_by), dict(filters or {}), known)
    filters = dict(filters or {})
    group_by = list(group_by)
    specs = {name: known[name] for name in measures}
    parts = []
    for role in ROLE_KEYS:
        chosen = {n: s for n, s in specs.items() if s.trailing_days is None and s.context.role == role}
        if chosen:
            parts.append(_additive(model, chosen, group_by, filters, role))
    for name, spec in specs.items():
        if spec.trailing_days is not None:
            parts.append(_trailing(model, name, spec, group_by, filters))
    result = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if len(parts) > 1:
        result = result.groupBy(*group_by).agg(*[F.max(name).alias(name) for name in measures])
    if group_by:
        result = result.where(F.coalesce(*[F.col(name).cast("double") for name in measures]).isNotNull())
    return result.select(*group_by, *measures)


def _every_level(model: ReportModel, measures: list[str], group_by: list[str], filters: dict, known: Mapping[str, Measure]) -> DataFrame:
    """``evaluate`` for every subset of ``group_by`` over one rollup that has all their keys.

    The fact is read once; the levels read the rollup, which is staged because each of them does.
    """
    served = model if smallest(model.rollups, every_key(model, measures, group_by, filters, known)) else _rolled_up(
        model, every_key(model, measures, group_by, filters, known)
    )
    parts = []
    for level in range(1 << len(group_by)):
        kept = [name for at, name in enumerate(reversed(group_by)) if not level >> at & 1][::-1]
        rows = evaluate(served, measures, kept, filters, known)
        absent = [F.lit(None).cast(_field_type(model, name)).alias(name) for name in group_by if name not in kept]
        parts.append(rows.select("*", *absent, F.lit(level).alias("level")).select(*group_by, "level", *measures))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _field_type(model: ReportModel, name: str) -> str:
    table, column = FIELDS[name]
    if table == DATE:
        days = model.calendar.select(F.col("date_key").alias("txn_date"))
        return _with_date_fields(days, [name]).schema[column].dataType.simpleString()
    rows = {STATION: model.stations, LINE: model.lines, FACT: model.fact}[table]
    return rows.schema[column].dataType.simpleString()


def every_key(model: ReportModel, measures: Sequence[str], group_by: Sequence[str], filters: Mapping, known: Mapping) -> set[str]:
    """The fact's own keys that any part of such an evaluation groups or filters by."""
    specs = [known[name] for name in measures]
    replaced = [field for spec in specs for context in (spec.context, spec.per and spec.per[1]) if context for field, _ in context.replace]
    keys = set()
    for spec in specs:
        keys |= set(native_keys([*group_by, *filters, *replaced], spec.context.role, whole_dates=True))
        bases = {spec.base, spec.per and spec.per[0]}
        keys |= {"origin_station_id"} if "stations" in bases else set()
        keys |= {"txn_date"} if "days" in bases or spec.trailing_days else set()
    return keys


def _rolled_up(model: ReportModel, keys: Iterable[str]) -> ReportModel:
    """The model over a staged rollup of its fact on ``keys``."""
    return replace(model, fact=stage(_added_up(model.fact, sorted(keys)), "report-rollup"), rollups=())
