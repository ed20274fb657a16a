"""Exact quantiles of columns of any size.

``percentile`` holds every distinct value of a column in one task. Here one scan makes a rank sketch
of every column, which brackets each wanted rank between two values. A second scan counts the rows
between the brackets and the distinct values inside them, so the input is read twice whatever the
values. The rank is then found among the bracketed values alone: each round counts them in equal
slices of the ranges still in question and looks closer at slices that hold a wanted rank.

The sketch only steers. Should a bracket miss its rank, the rounds run over the input for that column.
"""

from __future__ import annotations

import math
import sys
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credence.sources.staging import WorkTables

#: Size of a column's sketch, about 100 KB a group of tasks, and the share of ranks a bracket spans
#: on each side of a wanted one: over three times the sketch's error.
SKETCH, MARGIN = 4096, 0.005
#: Groups of tasks whose sketches are merged apart before all are.
SKETCH_GROUPS = 64
FIRST_SLICES = 4096
NEXT_SLICES = 1024


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]],
                    bounds: Mapping[str, tuple[float, float]] | None = None,
                    ) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; null for a column without values.

    ``bounds`` are ranges of columns where they are known, for a search beyond the brackets. A value
    outside its bounds is still ranked correctly.
    """
    def positions(count: int, probabilities: Sequence[float]) -> list[float]:
        return [p * (count - 1) for p in probabilities]

    def ranks(count: int, name: str) -> set[int]:
        return {r for at in positions(count, wanted[name])
                for r in (math.floor(at), math.ceil(at))}

    names = list(wanted)
    counts, found = _bracketed_values(df, names, ranks)
    missed = [n for n in names if n not in found and counts[n]]
    if missed:
        known = {n: b for n, b in (bounds or {}).items() if n in missed}
        found |= _ranked_values(df, missed, ranks, known)[1]
    result: dict[str, list[float | None]] = {}
    for name in names:
        count, values = counts.get(name, 0), found.get(name, {})
        if count == 0:
            result[name] = [None] * len(wanted[name])
            continue
        result[name] = []
        for at in positions(count, wanted[name]):
            low, high = values[math.floor(at)], values[math.ceil(at)]
            part = at - math.floor(at)
            gap = high - low
            result[name].append(high - gap * (1 - part) if part >= 0.5 else low + gap * part)
    return result


def _sketched(df: DataFrame, names: Sequence[str]) -> dict:
    """Row count, least and largest value and rank sketch of every column, in one scan."""
    parts = df.select(*[_number(n).alias(f"v{i}") for i, n in enumerate(names)]).groupBy(
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part")).agg(*[
            f(f"v{i}").alias(f"{k}{i}") for i in range(len(names)) for k, f in (
                ("n", F.count), ("min", F.min), ("max", F.max),
                ("sketch", lambda c: F.kll_sketch_agg_double(c, SKETCH)))])
    return parts.agg(*[
        f(f"{k}{i}").alias(f"{k}{i}") for i in range(len(names)) for k, f in (
            ("n", F.sum), ("min", F.min), ("max", F.max),
            ("sketch", lambda c: F.kll_merge_agg_double(c, SKETCH)))]).first()


def _brackets(spark, sketches: Mapping[str, tuple], ranks: Mapping[str, set[int]],
              ) -> dict[str, list[tuple[float, float]]]:
    """Disjoint ranges of values, in order, that should hold each column's wanted ranks."""
    names = list(sketches)

    def share(name: str, rank: int, side: int) -> float:
        return min(1.0, max(0.0, (rank + side) / sketches[name][0] + (2 * side - 1) * MARGIN))

    shares = {name: sorted({share(name, r, side) for r in ranks[name] for side in (0, 1)})
              for name in names}
    row = spark.createDataFrame(
        [tuple(bytes(sketches[name][3]) for name in names)],
        ", ".join(f"s{i} binary" for i in range(len(names)))).select(*[
            F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, shares[name])))
            for i, name in enumerate(names)]).first()
    result = {}
    for i, name in enumerate(names):
        value = dict(zip(shares[name], row[i])) | {0.0: sketches[name][1], 1.0: sketches[name][2]}
        ranges: list[tuple[float, float]] = []
        for r in sorted(ranks[name]):
            a, b = (value[share(name, r, side)] for side in (0, 1))
            if ranges and a <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(b, ranges[-1][1]))
            else:
                ranges.append((a, b))
        result[name] = ranges
    return result


def _cells(df: DataFrame, brackets: Mapping[str, list[tuple[float, float]]]) -> DataFrame:
    """(column, part, value, weight): rows by distinct value inside brackets, by gap between them.

    Odd parts are brackets, even ones gaps, in the order of values.
    """
    parts = []
    for name, ranges in brackets.items():
        ends = [-math.inf, *[v for r in ranges for v in r], math.inf]
        parts += [(name, k, ends[k], ends[k + 1], k % 2 == 1) for k in range(len(ends) - 1)]
    parts = F.broadcast(df.sparkSession.createDataFrame(
        parts, "column string, part int, low double, high double, inside boolean"))
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    here = F.when(F.col("inside"), (value >= low) & (value <= high)).otherwise(
        (value > low) & (value < high))
    rows = _long(df, list(brackets)).join(parts, "column").filter(here)
    return rows.groupBy("column", "part", F.when(F.col("inside"), value).alias("value")).agg(
        F.sum("weight").alias("weight"))


def _bracketed_values(df, names, ranks_of):
    """Row counts per column, and the values at the wanted ranks of columns whose brackets held."""
    spark, row = df.sparkSession, _sketched(df, names)
    facts = {n: tuple(row[f"{k}{i}"] for k in ("n", "min", "max", "sketch"))
             for i, n in enumerate(names)}
    counts = {n: f[0] or 0 for n, f in facts.items()}
    ranks = {n: ranks_of(counts[n], n) for n in names if counts[n]}
    brackets = _brackets(spark, {n: facts[n] for n in ranks}, ranks) if ranks else {}
    found: dict[str, dict[int, float]] = {}
    if not brackets:
        return counts, found
    with WorkTables(spark) as space:
        cells = space.table(_cells(df, brackets), "cells")
        sizes = {(r["column"], r["part"]): r["rows"] for r in cells.groupBy("column", "part").agg(
            F.sum("weight").alias("rows")).collect()}
        inside: dict[str, set[int]] = {}
        bounds, base_of = {}, {}
        for name, ranges in brackets.items():
            base, held = 0, set()
            for part in range(2 * len(ranges) + 1):
                size = sizes.get((name, part), 0)
                here = {r for r in ranks[name] if base <= r < base + size}
                if part % 2 and here:
                    key = f"{part}:{name}"
                    inside[key], base_of[key] = {r - base for r in here}, base
                    bounds[key] = ranges[part // 2]
                    held |= here
                base += size
            if held != ranks[name]:
                for key in [k for k in inside if k.partition(":")[2] == name]:
                    del inside[key]
        rows = cells.filter("value IS NOT NULL").select(
            F.concat("part", F.lit(":"), "column").alias("column"), "value", "weight")
        _, values = _ranked(lambda keys: rows.filter(F.col("column").isin(keys)), spark,
                            list(inside), lambda count, key: inside[key], bounds)
    for key, at in values.items():
        found.setdefault(key.partition(":")[2], {}).update(
            {r + base_of[key]: v for r, v in at.items()})
    return counts, found


def value_at_rank(df: DataFrame, column: str, rank: int,
                  bounds: tuple[float, float] | None = None) -> tuple[float, int]:
    """(value at 0-based ``rank`` in ascending order, rows strictly below that value)."""
    below: dict[tuple[str, int], int] = {}
    _, found = _ranked_values(df, [column], lambda count, name: {rank},
                              {column: bounds} if bounds else {}, below)
    return found[column][rank], below[column, rank]


def _ranked_values(df, names, ranks_of, bounds, below=None):
    """Row counts per column and the values at the wanted ranks, by rounds over the input."""
    bounds = {**_ranges(df, [n for n in names if n not in bounds]), **bounds}
    return _ranked(lambda columns: _long(df, columns), df.sparkSession, names, ranks_of, bounds,
                   below)


def _ranked(rows_of, spark, names, ranks_of, bounds, below=None):
    """Row counts and values at the wanted ranks, from (column, value, weight) rows of columns."""
    found: dict[str, dict[int, float]] = defaultdict(dict)
    counts: dict[str, int] = {}
    still_open = [_Range(name, *bounds[name], key={"column": name})
                  for name in names if bounds[name][0] is not None]
    levels: list[pa.Table] = []
    while still_open:
        levels.append(pa.Table.from_pylist(
            [{**r.key, "range": i, "low": r.low, "high": r.high}
             for i, r in enumerate(still_open)]))
        cells = defaultdict(list)
        columns = sorted({r.column for r in still_open})
        for cell in _histogram(spark, rows_of(columns), levels):
            cells[cell["parent"]].append(cell)
        inside_of, still_open = still_open, []
        for index, parent in enumerate(inside_of):
            base, ranks = parent.below, parent.ranks
            if ranks is None:
                counts[parent.column] = sum(cell["rows"] for cell in cells[index])
                ranks = ranks_of(counts[parent.column], parent.column)
            for cell in sorted(cells[index], key=lambda cell: cell["slice"]):
                held = {r for r in ranks if base <= r < base + cell["rows"]}
                if held and cell["low"] == cell["high"]:
                    found[parent.column].update(dict.fromkeys(held, cell["low"]))
                    if below is not None:
                        below.update({(parent.column, r): base for r in held})
                elif held:
                    still_open.append(_Range(
                        parent.column, cell["low"], cell["high"], base, held,
                        {"parent": index, "slice": cell["slice"]}))
                base += cell["rows"]
    return counts, found


@dataclass
class _Range:
    """A range of one column that still holds wanted ranks (None: not yet known which)."""

    column: str
    low: float
    high: float
    below: int = 0
    ranks: set[int] | None = None
    key: dict = field(default_factory=dict)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, weight) of every number."""
    return df.select(*[_number(c).alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value").filter(F.col("value").isNotNull()).withColumn(
        "weight", F.lit(1).cast("long"))


def _histogram(spark, rows: DataFrame, levels: Sequence[pa.Table]) -> list[dict]:
    """(parent, slice, rows, low, high) of the values that fall in the last level's ranges.

    Slices run between observed values, and the two ends of a range never share one, so the rounds
    end at any size. A level lists the ranges open in one round, at most two per wanted quantile, so it is always
    safe to broadcast; joining the levels in turn walks a value down to its range.
    """
    keys, slices = ["column"], FIRST_SLICES
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    for level in levels:
        # Halves keep the width finite. The two ends never share a slice, so every round splits.
        share = F.try_divide(value / 2 - low / 2, high / 2 - low / 2)
        cut = F.when(value >= high, slices - 1).when(value <= low, 0).otherwise(
            F.coalesce(F.least(F.lit(slices - 1), F.floor(share * slices)), F.lit(0)))
        ranges = F.broadcast(spark.createDataFrame(level))
        rows = rows.join(ranges, keys).select(
            "value", "weight", F.col("range").alias("parent"), cut.cast("long").alias("slice"))
        keys, slices = ["parent", "slice"], NEXT_SLICES
    return rows.groupBy("parent", "slice").agg(
        F.sum("weight").alias("rows"), F.min("value").alias("low"),
        F.max("value").alias("high")).toArrow().to_pylist()


def _number(name: str) -> Column:
    """The column as a finite double: NaN counts as missing, infinities as the largest doubles."""
    value = F.col(name).cast("double")
    largest = F.lit(sys.float_info.max)
    return F.when(value.isNotNull() & ~F.isnan(value),
                  F.greatest(-largest, F.least(largest, value)))


def _ranges(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[float, float]]:
    if not names:
        return {}
    row = df.agg(*[f(_number(n)).alias(f"{k}{i}")
                   for i, n in enumerate(names) for k, f in (("min", F.min), ("max", F.max))]
                 ).first()
    return {n: (row[f"min{i}"], row[f"max{i}"]) for i, n in enumerate(names)}
