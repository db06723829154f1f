"""Exact order statistics of stored columns without sorting or gathering them."""

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

BUCKETS = 4096
ACCURACY = 10_000  # of the sketch: ranks are right within a ten-thousandth of the rows


def _brackets(df: DataFrame, wanted: dict[str, list[float]], also: dict[str, Column]) -> tuple[Row, dict[str, list[tuple]]]:
    """One scan: row counts, the aggregates ``also``, and for each quantile values that a mergeable sketch puts around it."""
    slack = 2 / ACCURACY
    aggregates = [column.alias(f"also_{name}") for name, column in also.items()]
    for c, quantiles in wanted.items():
        ends = [e for q in quantiles for e in (max(0.0, q - slack), min(1.0, q + slack))]
        aggregates += [F.count(c).alias(f"count_{c}"), F.percentile_approx(c, ends, ACCURACY).alias(f"ends_{c}")]
    found = df.agg(*aggregates).first()
    brackets = {}
    for c in wanted:
        ends = found[f"ends_{c}"] or []
        brackets[c] = _merged([(float(a), float(b)) for a, b in zip(ends[::2], ends[1::2])])
    return found, {c: b for c, b in brackets.items() if b}


def _merged(ranges: list[tuple]) -> list[tuple]:
    out: list[tuple] = []
    for low, high in sorted(set(ranges)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _cell(v: Column, ranges: list[tuple]) -> Column:
    """The place of a value on its line: ranges cut into ``BUCKETS`` parts of equal width, and gaps before and after them."""
    cell = F.lit((BUCKETS + 1) * len(ranges)).cast("bigint")
    for i, (low, high) in reversed(list(enumerate(ranges))):
        # the lowest value falls in the first part and the highest in the last, so every pass narrows;
        # where the difference is beyond a double, that of the halves is not
        half = 1.0 if math.isfinite(high - low) else 0.5
        part = F.lit(0)
        if low < high:
            part = F.least(F.floor((v * half - F.lit(low * half)) / F.lit(high * half - low * half) * BUCKETS), F.lit(BUCKETS - 1))
        inside = F.lit((BUCKETS + 1) * i + 1) + part
        cell = F.when(v < low, F.lit((BUCKETS + 1) * i)).when(v <= high, inside).otherwise(cell)
    return cell


def ranked_values(df: DataFrame, wanted: dict[str, list[int]], ranges: dict[str, list[tuple]]) -> dict[str, dict[int, float]]:
    """The values at the wanted ranks (from 0, nulls left out) of each column.

    ``ranges`` are where they are looked for first. Every pass counts the rows of each column by cell, which
    are parts of the ranges and the gaps around them, with each cell's lowest and highest value: one scan and
    an aggregate of fixed size, combined on the map side. So ranks need not lie in the ranges. A rank that is
    the first or last of its cell is answered by the cell's bounds, any other makes the cell the next range.
    """
    found: dict[str, dict[int, float]] = {c: {} for c in wanted}
    while ranges:
        values = [F.col(c).cast("double") for c in ranges]
        cells = [F.struct(F.lit(i).alias("column"), _cell(v, r).alias("cell"), v.alias("v")) for i, (v, r) in enumerate(zip(values, ranges.values()))]
        cells = [F.when(v.isNotNull(), cell) for v, cell in zip(values, cells)]
        counted = (
            df.select(F.inline(F.array_compact(F.array(*cells))))
            .groupBy("column", "cell")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .collect()  # at most BUCKETS rows for each wanted rank, and the gaps
        )
        narrower = {}
        for i, c in enumerate(ranges):
            upto, inside = 0, []
            open_ranks = [r for r in wanted[c] if r not in found[c]]
            for b in sorted((b for b in counted if b["column"] == i), key=lambda b: b["cell"]):
                first, last = upto, upto + b["n"] - 1
                for rank in (r for r in open_ranks if first <= r <= last):
                    if b["low"] == b["high"] or rank == first:
                        found[c][rank] = b["low"]
                    elif rank == last:
                        found[c][rank] = b["high"]
                    else:
                        inside.append((b["low"], b["high"]))
                upto += b["n"]
            if inside:
                narrower[c] = _merged(inside)
        ranges = narrower
    return found


def quantiles_with(
    df: DataFrame, wanted: dict[str, list[float]], also: dict[str, Column]
) -> tuple[dict[str, list[float | None]], dict]:
    """Linearly interpolated quantiles of number columns, and the aggregates ``also`` of the same first scan.

    Nulls are ignored; None for a column without values. A sketch brackets every rank in one scan and a
    second counts inside the brackets; only where thousands of different values share a ten-thousandth of
    the rows is there a third, and each further one divides what is left by ``BUCKETS``. Every pass reads the
    columns again, so ``df`` should be stored data or a cheap projection of it.
    """
    first, ranges = _brackets(df, wanted, also)
    ranks = {}
    for c, quantiles in wanted.items():
        places = [q * (first[f"count_{c}"] - 1) for q in quantiles]
        ranks[c] = sorted({r for p in places for r in (math.floor(p), math.ceil(p))}) if first[f"count_{c}"] else []
    values = ranked_values(df.select(*wanted), ranks, ranges)
    out: dict[str, list[float | None]] = {}
    for c, quantiles in wanted.items():
        out[c] = []
        for q in quantiles:
            if not first[f"count_{c}"]:
                out[c].append(None)
                continue
            place = q * (first[f"count_{c}"] - 1)
            a, b = values[c][math.floor(place)], values[c][math.ceil(place)]
            out[c].append(a + (b - a) * (place - math.floor(place)))
    return out, {name: first[f"also_{name}"] for name in also}


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    return quantiles_with(df, wanted, {})[0]
