"""Numeric column expressions used by enrichment."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# The published Lanczos coefficients for g = 7.
LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)


def log_gamma(x: Column) -> Column:
    """ln Γ(x) for x >= 1 (Spark has no built-in)."""
    z = x.cast("double") - 1.0
    series = F.lit(LANCZOS[0])
    for i, coefficient in enumerate(LANCZOS[1:], start=1):
        series = series + F.lit(coefficient) / (z + float(i))
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.ln(t) - t + F.ln(series)


def log_choose(n: Column, k: Column) -> Column:
    return log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1)


def hypergeometric_upper_tail(k: Column, drawn: Column, marked: Column, total: Column) -> Column:
    """P(X >= k) with X marked items among `drawn` of `total`, of which `marked` are marked.

    The probability at the largest point of [k, min(drawn, marked)] is taken from log-gammas once; the
    other terms follow by their ratio, which only shrinks away from that point, so nothing overflows.
    """
    k, drawn, marked, total = (c.cast("double") for c in (k, drawn, marked, total))
    low = F.greatest(k, drawn + marked - total, F.lit(0.0))
    high = F.least(drawn, marked)
    mode = F.floor((drawn + 1) * (marked + 1) / (total + 2)).cast("double")
    peak = F.least(F.greatest(mode, low), high)
    log_peak = log_choose(marked, peak) + log_choose(total - marked, drawn - peak) - log_choose(total, drawn)
    rest = total - marked - drawn
    start = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))

    def step(ratio):
        def fold(acc, i):
            t = acc["t"] * ratio(i.cast("double"))
            return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

        return fold

    upward = F.aggregate(
        F.when(high > peak, F.sequence(peak.cast("long"), high.cast("long") - 1)).otherwise(F.array().cast("array<bigint>")),
        start,
        step(lambda i: (marked - i) * (drawn - i) / ((i + 1) * (rest + i + 1))),
        lambda acc: acc["s"],
    )
    downward = F.aggregate(
        F.when(peak > low, F.sequence(peak.cast("long"), low.cast("long") + 1, F.lit(-1).cast("long"))).otherwise(
            F.array().cast("array<bigint>")
        ),
        start,
        step(lambda i: i * (rest + i) / ((marked - i + 1) * (drawn - i + 1))),
        lambda acc: acc["s"],
    )
    return F.when(low > high, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.exp(log_peak) * (1.0 + upward + downward)))


def neg_log10(p: Column) -> Column:
    """-log10(p + 1e-300)."""
    return -F.log10(p + F.lit(1e-300))


def axis_ticks(top: Column, step: int = 5) -> Column:
    """0, step, … up to the first multiple of `step` not below `top`."""
    return F.sequence(F.lit(0).cast("long"), (F.ceil(top / step) * step).cast("long"), F.lit(step).cast("long"))


def axis_offsets(low: Column, high: Column, widest_offset: float) -> Column:
    """Plot range and offsets left of the data: range is at least 1."""
    span = F.greatest(high - low, F.lit(1.0))
    return F.struct(
        span.alias("x_range"),
        (low - span * 0.15).alias("scatter_x"),
        (low - span * widest_offset).alias("left_lim"),
        (high + span * 0.1).alias("right_lim"),
    )
