"""Metric views (M0): a source, named joins, dimensions and measures.

``MetricView.query(dimensions, measures, where)`` groups by the chosen
dimensions only and evaluates the measures at that grain - the DataFrame the
reference's YAML metric views expand to at query time.

* Dimensions are Columns, or callables receiving the already defined
  dimensions (a dimension built on another dimension).
* Measures are aggregate Columns; *derived* measures are post-aggregation
  expressions over other measures (ratios, differences) and are computed
  after one aggregation pass.  Helper measures needed only by derived ones
  are computed and dropped.
* ``distinct_key`` measures sum a value once per key within each group
  (e.g. contract value once per contract, not once per invoice).  The relation
  is aggregated by (dimensions, key) and that by the dimensions: one read, and
  partial aggregation at both levels.  ``additive`` measures add up over the
  keys; others are aggregated by the dimensions alone and joined.
* Display metadata (comment, display name, format, synonyms) travels in the
  output columns' metadata.
Plain column names in dimensions and measures refer to the source; joined
tables are referenced by their join name (``F.col("contracts.x")``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Parts among which source rows without a join key are dealt.
KEYLESS_PARTS = 4096


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: object                       # column name, Column, or callable(dict[str, Column]) -> Column
    comment: str = ""
    display_name: str = ""
    synonyms: tuple = ()
    format: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Measure:
    name: str
    expr: Callable[[], Column] | None = None               # aggregate expression
    derived: Callable[[dict[str, Column]], Column] | None = None
    depends: tuple = ()                                     # measures used by ``derived``
    distinct_key: str | None = None                         # sum ``expr`` once per key
    additive: bool = True                                   # adds up over the parts of a group
    comment: str = ""
    display_name: str = ""
    synonyms: tuple = ()
    format: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Join:
    """A joined table; ``on`` is any condition.

    With ``key`` in place of ``on`` the table is joined by that column of both
    sides, and rows of the source without a key, which match nothing, are dealt by
    the hash of the columns ``deal``: otherwise all of them meet in one task.
    """

    name: str
    source: DataFrame
    on: Callable[[], Column] | None = None
    how: str = "left"
    key: str | None = None
    deal: tuple = ()


def _metadata(obj) -> dict:
    md = {k: v for k, v in (("comment", obj.comment), ("display_name", obj.display_name)) if v}
    if obj.synonyms:
        md["synonyms"] = list(obj.synonyms)
    if obj.format:
        md["format"] = obj.format
    return md


@dataclass(frozen=True)
class Fact:
    """A table of a drill-across view: the dimensions it knows and the measures it has."""

    source: DataFrame
    dimensions: dict[str, Column]
    measures: list[str]


def _side_by_side(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of two aggregates on keys that may be null; each is unique on them."""
    names = [c for c in right.columns if c not in keys]
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *names)
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] or [F.lit(True)]
    return left.join(right, on, "left").select(*left.columns, *names)


class MetricView:
    def __init__(self, name: str, source: DataFrame, dimensions: list[Dimension], measures: list[Measure],
                 joins: list[Join] = (), comment: str = ""):
        self.name, self.comment = name, comment
        self.source, self.joins = source, list(joins)
        self.dimensions = {d.name: d for d in dimensions}
        self.measures = {m.name: m for m in measures}

    def relation(self) -> DataFrame:
        source = self.source
        for j in self.joins:
            if j.key:
                spread = F.when(F.col(j.key).isNull(), F.pmod(F.xxhash64(*j.deal), F.lit(KEYLESS_PARTS)))
                source = source.withColumn(f"_{j.name}_part", spread)
        rel = source.alias("source")
        for j in self.joins:
            rel = rel.join(j.source.alias(j.name), self._by_key(j) if j.key else j.on(), j.how)
        return rel

    @staticmethod
    def _by_key(j: Join) -> Column:
        # Structs with a null field compare equal, so a source row without key needs its part to match no row.
        part = lambda p: p.cast("long").alias("part")
        return (F.struct(F.col(f"source.{j.key}").alias("key"), part(F.col(f"source._{j.name}_part")))
                == F.struct(F.col(f"{j.name}.{j.key}").alias("key"), part(F.lit(None))))

    def _dimension_columns(self, names: list[str]) -> dict[str, Column]:
        cols: dict[str, Column] = {}
        for d in self.dimensions.values():   # definition order: a dimension may use earlier ones
            e = d.expr
            if isinstance(e, str):
                col = F.col(e if "." in e else f"source.{e}")
            elif callable(e) and not isinstance(e, Column):
                col = e(cols)
            else:
                col = e
            cols[d.name] = col
        return {n: cols[n] for n in names}

    def _closure(self, names: list[str]) -> list[str]:
        order: list[str] = []

        def visit(n: str) -> None:
            if n in order:
                return
            for d in self.measures[n].depends:
                visit(d)
            order.append(n)

        for n in names:
            visit(n)
        return order

    def query(self, dimensions: list[str] | None = None, measures: list[str] | None = None,
              where: Column | None = None) -> DataFrame:
        dimensions = list(self.dimensions) if dimensions is None else list(dimensions)
        if measures is None:   # helper measures (leading underscore) are internal
            measures = [m for m in self.measures if not m.startswith("_")]
        measures = list(measures)
        rel = self.relation()
        if where is not None:
            rel = rel.where(where)
        dcols = self._dimension_columns(dimensions)
        keys = [dcols[n].alias(n) for n in dimensions]
        needed = self._closure(measures)
        plain = [m for m in needed if self.measures[m].expr is not None and self.measures[m].distinct_key is None]
        by_key: dict[str, list[str]] = {}
        for m in needed:
            if self.measures[m].distinct_key is not None:
                by_key.setdefault(self.measures[m].distinct_key, []).append(m)
        out = None
        for key, once in by_key.items():
            shared = [m for m in plain if self.measures[m].additive] if out is None else []
            part = self._once_per_key(rel, keys, dimensions, key, once, shared)
            plain = [m for m in plain if m not in shared]
            out = part if out is None else _side_by_side(out, part, dimensions)
        if plain or out is None:
            aggs = [self.measures[m].expr().alias(m) for m in plain]
            part = rel.groupBy(*keys).agg(*aggs) if aggs else rel.select(*keys).distinct()
            out = part if out is None else _side_by_side(out, part, dimensions)
        for m in needed:
            spec = self.measures[m]
            if spec.derived is not None:
                out = out.withColumn(m, spec.derived({n: F.col(n) for n in needed}))
        return out.select(*[F.col(n).alias(n, metadata=_metadata(self.dimensions[n])) for n in dimensions],
                          *[F.col(m).alias(m, metadata=_metadata(self.measures[m])) for m in measures])

    def _once_per_key(self, rel: DataFrame, keys: list[Column], dimensions: list[str], key: str, once: list[str],
                      shared: list[str]) -> DataFrame:
        """``once`` measures counted once per ``key``, and additive ``shared`` ones, by the dimensions."""
        column = F.col(key if "." in key else f"source.{key}")
        first = rel.groupBy(*keys, column.alias("_key")).agg(
            *[self.measures[m].expr().alias(m) for m in shared], *[F.max(self.measures[m].expr()).alias(m) for m in once])
        total = lambda m: F.sum(m).cast(first.schema[m].dataType) if m in shared else F.sum(m)
        return first.groupBy(*dimensions).agg(*[total(m).alias(m) for m in shared + once])

    def create_view(self, name: str | None = None, dimensions: list[str] | None = None,
                    measures: list[str] | None = None) -> DataFrame:
        """IO12: register a query of this view for SQL (``SELECT * FROM name``)."""
        df = self.query(dimensions, measures)
        df.createOrReplaceTempView(name or self.name)
        return df


class DrillAcrossView(MetricView):
    """A metric view over several facts of different grain.

    Each fact is aggregated to those of the chosen dimensions that it knows,
    and the aggregates are joined to the first fact's: no sum is multiplied by
    the other facts' rows, as it would be if the facts were joined first.  A
    fact that lacks a chosen dimension repeats its amounts along it.  ``where``
    is a condition on dimension names and applies to the facts that know all
    dimensions it names.
    """

    def __init__(self, name: str, facts: list[Fact], dimensions: list[Dimension], measures: list[Measure], comment: str = ""):
        super().__init__(name, facts[0].source, dimensions, measures, comment=comment)
        self.facts = facts

    def query(self, dimensions: list[str] | None = None, measures: list[str] | None = None,
              where: dict[str, object] | None = None) -> DataFrame:
        """``where`` gives the value, or the list of values, of each dimension that is restricted."""
        dimensions = list(self.dimensions) if dimensions is None else list(dimensions)
        measures = [m for m in self.measures if not m.startswith("_")] if measures is None else list(measures)
        needed = self._closure(measures)
        out = None
        for fact in self.facts:
            own = [m for m in needed if m in fact.measures]
            if out is not None and not own:
                continue
            rows = fact.source
            for name, value in (where or {}).items():
                if name in fact.dimensions:
                    rows = rows.where(fact.dimensions[name].isin(value if isinstance(value, list) else [value]))
            known = [d for d in dimensions if d in fact.dimensions]
            by = [fact.dimensions[d].alias(d) for d in known]
            aggs = [self.measures[m].expr().alias(m) for m in own]
            part = rows.groupBy(*by).agg(*aggs) if aggs else rows.select(*by).distinct()
            out = part if out is None else _side_by_side(out, part, known)
        for m in needed:
            if self.measures[m].derived is not None:
                out = out.withColumn(m, self.measures[m].derived({n: F.col(n) for n in needed}))
        return out.select(*[F.col(n).alias(n, metadata=_metadata(self.dimensions[n])) for n in dimensions],
                          *[F.col(m).alias(m, metadata=_metadata(self.measures[m])) for m in measures])
