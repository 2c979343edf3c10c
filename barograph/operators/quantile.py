"""Medians of several columns at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct values per column that one ordered window may hold.
HISTOGRAM_LIMIT = 200_000
# Accuracy of the sketches that narrow the search, and the share of ranks kept
# on either side of the target (twice the error bound of the sketch).
SKETCH_ACCURACY = 10_000
SKETCH_MARGIN = 2.0 / SKETCH_ACCURACY


def approximate_medians(
    df: DataFrame, columns: list[str], relative_error: float = 1e-3
) -> dict[str, float | None]:
    """Medians within ``relative_error`` of rank, one pass for all columns."""
    found = df.approxQuantile(list(columns), [0.5], relative_error)
    return {name: values[0] if values else None for name, values in zip(columns, found)}


def exact_medians(
    df: DataFrame, columns: list[str], histogram_limit: int = HISTOGRAM_LIMIT
) -> dict[str, float | None]:
    """Exact lower medians (the smallest value with half the values at or below it).

    A bounded sketch brackets the median; the rows outside the bracket are only
    counted, and the bracket shrinks until its distinct values fit one histogram.
    Columns with few distinct values, such as measurements in tenths, need no
    bracket at all. NULL and NaN are ignored; all columns share each pass.
    """
    def value(name: str) -> Column:
        number = F.col(name).cast("double")
        return F.when(~F.isnan(number), number)

    around = [0.5 - SKETCH_MARGIN, 0.5 + SKETCH_MARGIN]
    first = _one_row(df, {
        name: [F.count(value(name)), F.approx_count_distinct(value(name)),
               F.percentile_approx(value(name), around, SKETCH_ACCURACY)]
        for name in columns
    })
    answers: dict[str, float | None] = {}
    # Per column: bracket (open on both sides), values below it, values in it,
    # distinct values in it, rank of the median.
    open_columns: dict[str, dict] = {}
    bounds: dict[str, list] = {}
    for name, (count, distinct, pair) in first.items():
        if count == 0:
            answers[name] = None
        else:
            open_columns[name] = {
                "low": None, "high": None, "below": 0, "inside": count,
                "distinct": distinct, "rank": (count + 1) // 2,
            }
            bounds[name] = pair

    def inside(name: str, state: dict) -> Column:
        number = value(name)
        kept = number.isNotNull()
        if state["low"] is not None:
            kept = kept & (number > F.lit(state["low"]))
        if state["high"] is not None:
            kept = kept & (number < F.lit(state["high"]))
        return F.when(kept, number)

    while True:
        wide = {
            name: state for name, state in open_columns.items()
            if min(state["inside"], state["distinct"]) > histogram_limit
        }
        if not wide:
            break
        missing = [name for name in wide if name not in bounds]
        if missing:
            sketched = _one_row(df, {
                name: [F.percentile_approx(
                    inside(name, wide[name]), _fractions(wide[name]), SKETCH_ACCURACY)]
                for name in missing
            })
            bounds.update({name: pair for name, (pair,) in sketched.items()})
        measured = _one_row(df, {
            name: _bracket_counts(inside(name, state), *bounds[name])
            for name, state in wide.items()
        })
        for name, (below, at_low, between, at_high, distinct) in measured.items():
            state, (low, high) = open_columns[name], bounds.pop(name)
            target = state["rank"] - state["below"]
            if target <= below:
                state.update(high=low, inside=below)
            elif target <= below + at_low:
                answers[name] = low
            elif target <= below + at_low + between:
                state.update(low=low, high=high, below=state["below"] + below + at_low,
                             inside=between, distinct=distinct)
            elif target <= below + at_low + between + at_high:
                answers[name] = high
            else:
                skipped = below + at_low + between + at_high
                state.update(low=high, below=state["below"] + skipped,
                             inside=state["inside"] - skipped)
        open_columns = {n: s for n, s in open_columns.items() if n not in answers}

    if open_columns:
        answers.update(_histogram_pick(df, open_columns, inside))
    return {name: answers[name] for name in columns}


def _fractions(state: dict) -> list[float]:
    """Bracket around the target rank, as fractions of the values in the bracket."""
    middle = (state["rank"] - state["below"] - 0.5) / state["inside"]
    return [max(0.0, middle - SKETCH_MARGIN), min(1.0, middle + SKETCH_MARGIN)]


def _bracket_counts(number: Column, low: float, high: float) -> list[Column]:
    between = (number > F.lit(low)) & (number < F.lit(high))
    at_high = (number == F.lit(high)) if high != low else F.lit(False)
    return [
        F.count_if(number < F.lit(low)), F.count_if(number == F.lit(low)),
        F.count_if(between), F.count_if(at_high),
        F.approx_count_distinct(F.when(between, number)),
    ]


def _one_row(df: DataFrame, aggregates: dict[str, list[Column]]) -> dict[str, list]:
    """Run all aggregates in one job; results by name, in order."""
    flat = [
        expr.alias(f"a{position}_{index}")
        for position, exprs in enumerate(aggregates.values())
        for index, expr in enumerate(exprs)
    ]
    row = df.agg(*flat).first()
    results, offset = {}, 0
    for name, exprs in aggregates.items():
        results[name] = list(row[offset:offset + len(exprs)])
        offset += len(exprs)
    return results


def _histogram_pick(df: DataFrame, states: dict[str, dict], inside) -> dict[str, float]:
    """Median per column from the histograms of the bracketed values."""
    pairs = F.array(*[
        F.struct(F.lit(position).alias("position"), inside(name, state).alias("number"))
        for position, (name, state) in enumerate(states.items())
    ])
    targets = F.array(*[F.lit(s["rank"] - s["below"]) for s in states.values()])
    histogram = (
        df.select(F.inline(pairs)).where(F.col("number").isNotNull())
        .groupBy("position", "number").agg(F.count(F.lit(1)).alias("copies"))
    )
    up_to = F.sum("copies").over(Window.partitionBy("position").orderBy("number"))
    target = F.get(targets, F.col("position"))
    picked = (
        histogram.withColumn("up_to", up_to)
        .where((F.col("up_to") >= target) & (F.col("up_to") - F.col("copies") < target))
        .select("position", "number").collect()
    )
    names = list(states)
    return {names[row["position"]]: row["number"] for row in picked}
