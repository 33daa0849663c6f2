"""Named dimensions and measures over one source; a query picks some of each.

Measures that refer to other measures by ``MEASURE(name)`` are computed from
the grouped result, so a ratio is always one of totals at the query's grain.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tarnwork import fixed_values as fv

_DISTINCT = re.compile(r"count\s*\(\s*distinct\s+([\w.]+)\s*\)", re.IGNORECASE)
_SUM = re.compile(r"sum\s*\([^()]*\)", re.IGNORECASE)
_REFERENCE = re.compile(r"MEASURE\(\s*(\w+)\s*\)", re.IGNORECASE)


@dataclass(frozen=True)
class MetricView:
    """Expressions are Spark SQL text; the source's columns may be written ``source.x``.

    ``details`` holds, per name, ``display_name``, ``comment``, ``synonyms`` and ``format``.
    """

    source: DataFrame
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    details: Mapping[str, Mapping] = field(default_factory=dict)

    @classmethod
    def from_spec(cls, source: DataFrame, spec: Mapping) -> MetricView:
        """From a definition with ``dimensions`` and ``measures`` lists, as read from YAML."""
        entries = [*spec.get("dimensions", []), *spec.get("measures", [])]
        return cls(
            source,
            {d["name"]: d["expr"] for d in spec.get("dimensions", [])},
            {m["name"]: m["expr"] for m in spec.get("measures", [])},
            {e["name"]: {k: v for k, v in e.items() if k not in ("name", "expr")} for e in entries},
        )

    def _plan(self, wanted: Sequence[str]) -> list[str]:
        """The wanted measures and all they refer to, referred ones first."""
        done: list[str] = []

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name not in self.measures:
                raise KeyError(f"unknown measure {name}")
            if name in path:
                raise ValueError(f"measures refer to each other in a circle: {' > '.join([*path, name])}")
            for other in _REFERENCE.findall(self.measures[name]):
                visit(other, (*path, name))
            if name not in done:
                done.append(name)

        for name in wanted:
            visit(name, ())
        return done

    def query(self, dimensions: Sequence[str], measures: Sequence[str], formatted: bool = False) -> DataFrame:
        """The measures per combination of the dimensions (or in total without any)."""
        unknown = [d for d in dimensions if d not in self.dimensions]
        if unknown:
            raise KeyError(f"unknown dimension {', '.join(unknown)}")
        plan = self._plan(measures)
        composed = [m for m in plan if _REFERENCE.search(self.measures[m])]
        keys = [F.expr(self.dimensions[d]).alias(d) for d in dimensions]
        result = self._aggregated(keys, {m: self.measures[m] for m in plan if m not in composed})
        for name in composed:
            result = result.withColumn(name, F.expr(_REFERENCE.sub(r"`\1`", self.measures[name])))
        shown = [self._format(n) if formatted else F.col(n) for n in [*dimensions, *measures]]
        names = [*dimensions, *measures]
        return result.select(*[c.alias(n, metadata=self._metadata(n)) for c, n in zip(shown, names)])

    def _aggregated(self, keys: list[Column], base: Mapping[str, str]) -> DataFrame:
        """The measures that refer to no other, per combination of the keys.

        Several distinct counts would send a copy of every row per count through the shuffle. Where all
        other measures are plain sums, the rows are first summed per combination of keys and counted values.
        """
        source = self.source.alias("source")
        distinct = {m: found[1] for m, text in base.items() if (found := _DISTINCT.fullmatch(text.strip()))}
        sums = {m: text for m, text in base.items() if _SUM.fullmatch(text.strip())}
        if len(distinct) < 2 or len(distinct) + len(sums) < len(base):
            return source.groupBy(*keys).agg(*[F.expr(text).alias(m) for m, text in base.items()])
        counted = [F.expr(text).alias(m) for m, text in distinct.items()]
        # A group must be there even if nothing is summed.
        parts = [F.expr(text).alias(m) for m, text in sums.items()] or [F.count("*").alias("_rows")]
        combined = source.groupBy(*keys, *counted).agg(*parts)
        names = combined.columns[: len(keys)]
        measures = [F.countDistinct(m).alias(m) if m in distinct else F.sum(m).alias(m) for m in base]
        return combined.groupBy(*names).agg(*measures)

    def descriptions(self) -> list[tuple[str, str, str | None, str | None, list[str]]]:
        """Kind, name, display name, comment and synonyms of all dimensions and measures."""
        kinds = [*[("dimension", d) for d in self.dimensions], *[("measure", m) for m in self.measures]]
        return [
            (kind, name, d.get("display_name"), d.get("comment"), list(d.get("synonyms", [])))
            for kind, name in kinds
            for d in [self.details.get(name, {})]
        ]

    def _metadata(self, name: str) -> dict:
        details = self.details.get(name, {})
        return {k: details[k] for k in ("comment", "display_name", "synonyms") if k in details}

    def _format(self, name: str) -> Column:
        """The column as display text, by its format."""
        form = self.details.get(name, {}).get("format", {})
        places = form.get("decimal_places", {}).get("places", 0)
        value = F.col(name)
        match form.get("type"):
            case "number":
                text = F.format_number(value, places)
                return F.replace(text, F.lit(","), F.lit("")) if form.get("hide_group_separator") else text
            case "percentage":
                return F.concat(F.format_number(value * 100, places), F.lit("%"))
            case "date":
                return F.date_format(value, "yyyy-MM-dd" if form.get("leading_zeros") else "yyyy-M-d")
        return value


SALES_DIMENSIONS = {
    "order_month": "date_trunc('MONTH', source.order_date)",
    "category": "source.category",
    "sub_category": "source.sub_category",
    "region": "source.region",
    "prefecture": "source.prefecture",
    "customer_segment": "source.customer_segment",
}
SALES_MEASURES = {
    "total_sales": "sum(source.sales_amount)",
    "total_profit": "sum(source.profit)",
    "total_quantity": "sum(source.quantity)",
    "order_count": "count(distinct source.order_id)",
    "customer_count": "count(distinct source.customer_id)",
    "profit_margin": "MEASURE(total_profit) / nullif(MEASURE(total_sales), 0)",
    "avg_order_value": "MEASURE(total_sales) / nullif(MEASURE(order_count), 0)",
}
_WHOLE = {"type": "number", "decimal_places": {"type": "exact", "places": 0}, "hide_group_separator": False}
_FORMATS = {
    "order_month": {"format": {"type": "date", "leading_zeros": False}},
    "total_sales": {"format": _WHOLE},
    "total_profit": {"format": _WHOLE},
    "profit_margin": {"format": {"type": "percentage", "decimal_places": {"type": "exact", "places": 1}}},
    "avg_order_value": {"format": _WHOLE},
}
SALES_DETAILS = {
    name: {"display_name": shown, "comment": comment, **({"synonyms": list(synonyms)} if synonyms else {}), **_FORMATS.get(name, {})}
    for name, (shown, comment, synonyms) in fv.METRIC_TEXTS.items()
}


def sales_metrics(sales: DataFrame) -> MetricView:
    return MetricView(sales, SALES_DIMENSIONS, SALES_MEASURES, SALES_DETAILS)
