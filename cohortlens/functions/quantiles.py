"""Exact quantiles (linear interpolation) that scale past one task's memory."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import kept

SKETCH_ACCURACY = 1000
#: Values of an open interval that are counted one by one instead of being sketched again.
INTERVAL_VALUES = 100_000


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    interval_values: int = INTERVAL_VALUES,
) -> dict[str, list[float | None]]:
    """Exact quantiles per column; the result is columns x probabilities numbers.

    Each round brackets the wanted order statistics with a quantile sketch,
    counts exactly what lies below the brackets, and goes on inside them, until
    at most ``interval_values`` values are left; their distinct values are
    counted. No row is shuffled and the exact counts, not the sketch, decide, so
    the result is the same for every ``interval_values``. Null and NaN are left
    out; infinities are values like any other. Without values a quantile is null.
    """
    wanted, found = {}, {}
    with kept(df.select(*[_value(c).alias(c) for c in columns])) as narrow:
        counts = narrow.agg(*[F.count(c).alias(c) for c in columns]).first()
        for c in columns:
            for p in probabilities if counts[c] else ():
                position = (counts[c] - 1) * p
                wanted[c, p] = (math.floor(position), math.ceil(position), position)
        shares = {(c, k): p for (c, p), (lo, hi, _) in wanted.items() for k in (hi, lo)}
        if shares:
            found = _order_statistics(narrow, shares, counts, interval_values)
    result = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            if (c, p) not in wanted:
                result[c].append(None)
                continue
            lo, hi, position = wanted[c, p]
            low, high = found[c, lo], found[c, hi]
            # equal ends first: between two infinities there is nothing to interpolate
            between = (hi - position) * low + (position - lo) * high
            result[c].append(low if lo == hi or low == high else between)
    return result


def _value(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None))


def _inside(value: Column, low: float | None, high: float | None) -> Column:
    """Whether ``value`` lies in the open interval; a null end is no end."""
    inside = value.isNotNull()
    if low is not None:
        inside = inside & (value > F.lit(low))
    if high is not None:
        inside = inside & (value < F.lit(high))
    return inside


def _order_statistics(df, targets, counts, interval_values):
    """Value at each 0-based rank of ``targets`` {(column, rank): its probability}.

    The columns of ``df`` are doubles without NaN.
    """
    # open interval (low, high), number of values <= low, number inside
    state = {t: (None, None, 0, counts[t[0]]) for t in targets}
    found: dict[tuple[str, int], float] = {}

    margin = 2 / SKETCH_ACCURACY
    while True:
        wide = [t for t in targets if t not in found and state[t][3] > interval_values]
        if not wide:
            break
        # targets that still share an interval share one sketch of it, and the two
        # neighbours that one probability falls between share its bracket
        shared: dict[tuple, dict[float, list]] = {}
        for target in wide:
            own = shared.setdefault((target[0], *state[target]), {})
            own.setdefault(targets[target], []).append(target)
        proposals = []
        for i, ((column, low, high, below, size), own) in enumerate(shared.items()):
            value = F.col(column)
            places = [(members[0][1] - below) / size for members in own.values()]
            edges = [e for x in places for e in (max(x - margin, 0.0), min(x + margin, 1.0))]
            within = F.when(_inside(value, low, high), value)
            proposals.append(F.percentile_approx(within, edges, SKETCH_ACCURACY).alias(f"b{i}"))
        row = df.agg(*proposals).first()
        brackets = {}
        for i, own in enumerate(shared.values()):
            for j, members in enumerate(own.values()):
                for target in members:
                    brackets[target] = (row[i][2 * j], row[i][2 * j + 1])
        checked = sorted({(t[0], edge) for t in wide for edge in brackets[t]})
        seen = df.agg(
            *[
                count.alias(f"{name}{i}")
                for i, (column, edge) in enumerate(checked)
                for name, count in (
                    ("lt", F.count_if(F.col(column) < F.lit(edge))),
                    ("eq", F.count_if(F.col(column) == F.lit(edge))),
                )
            ]
        ).first()
        place = {key: i for i, key in enumerate(checked)}
        for target in wide:
            rank = target[1]
            low, high, below, size = state[target]
            c, d = brackets[target]
            at_c, at_d = place[target[0], c], place[target[0], d]
            c_below, c_upto = seen[f"lt{at_c}"], seen[f"lt{at_c}"] + seen[f"eq{at_c}"]
            d_below, d_upto = seen[f"lt{at_d}"], seen[f"lt{at_d}"] + seen[f"eq{at_d}"]
            if c_below <= rank < c_upto:
                found[target] = c
            elif d_below <= rank < d_upto:
                found[target] = d
            elif rank < c_below:
                state[target] = (low, c, below, c_below - below)
            elif rank < d_below:
                state[target] = (c, d, c_upto, d_below - c_upto)
            else:
                state[target] = (d, high, d_upto, below + size - d_upto)

    narrow: dict[tuple, list] = {}
    for target in targets:
        if target not in found:
            narrow.setdefault((target[0], *state[target]), []).append(target)
    if not narrow:
        return found
    # one pass counts the values of all remaining intervals; each holds at most
    # interval_values rows, so that is what comes back per interval
    picked = []
    for i, (column, low, high, _, _) in enumerate(narrow):
        value = F.col(column)
        picked.append(
            F.when(
                _inside(value, low, high),
                F.struct(F.lit(i).alias("interval"), value.alias("v")),
            )
        )
    histogram = (
        df.select(F.inline(F.array_compact(F.array(*picked))))
        .groupBy("interval", "v")
        .count()
        .orderBy("interval", "v")
        .toPandas()
    )
    for i, ((_, _, _, below, _), members) in enumerate(narrow.items()):
        entries = histogram[histogram["interval"] == i]
        upto = below + entries["count"].cumsum().to_numpy()
        for target in members:
            place = int((upto > target[1]).argmax())
            found[target] = float(entries["v"].iloc[place])
    return found
