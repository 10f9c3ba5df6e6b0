"""Numbers behind the dashboard: classes, buckets, half-steps and sizes.

Only numbers and class names; no colours.  Roundings that the reference does
on Python floats are done here in exact integer arithmetic (half to even), so
every engine gives the same answer bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values of the reference's dashboard. --------------------------------
POLARITY_THRESHOLD = 0.1          # |s| >= 0.1 is positive / negative
BUCKET_CUTS = (-1.0, -0.5, 0.0, 0.5)   # strict "<" cut points, buckets 0..4
HALF_STEP_LABELS = {-2: "very_negative", -1: "negative", 0: "neutral",
                    1: "positive", 2: "very_positive"}
MAX_SIZE_CHANGE = 0.4
BASE_SIZE_PERCENT = 120
NORMALISED_SHIFT = 0.49
# ------------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def polarity_class(score: Column | str, threshold: float = POLARITY_THRESHOLD) -> Column:
    s = _c(score)
    return (F.when(s >= threshold, F.lit("positive"))
            .when(s <= -threshold, F.lit("negative"))
            .otherwise(F.lit("neutral")))


def sentiment_bucket(score: Column | str) -> Column:
    """0 for ``x < -1`` (unreachable from scores in [-1, 1]) up to 4 for ``x >= 0.5``."""
    s = _c(score)
    out = F.when(s.isNull(), F.lit(None).cast("int")).when(s < BUCKET_CUTS[0], F.lit(0))
    for i, cut in enumerate(BUCKET_CUTS[1:], start=1):
        out = out.when(s < cut, F.lit(i))
    return out.otherwise(F.lit(len(BUCKET_CUTS)))


def half_steps(score: Column | str) -> Column:
    """``round(x * 2)`` half to even, as an integer number of half steps."""
    return F.bround(_c(score) * 2, 0).cast("int")


def half_step_label(steps: Column | str) -> Column:
    """Exact lookup of a half-step (-2..2) in the label map; other values give NULL."""
    pairs = []
    for key, name in HALF_STEP_LABELS.items():
        pairs += [F.lit(key), F.lit(name)]
    return F.element_at(F.create_map(*pairs), _c(steps))


def round_ratio_half_even(num: Column, den: Column) -> Column:
    """Integer ``num / den`` rounded half to even, exactly; ``den`` must be > 0."""
    r = F.pmod(num, den)
    # num - r is a multiple of den, so the double quotient is an exact integer
    q = ((num - r) / den).cast("bigint")
    twice = r * 2
    bump = (F.when(twice > den, F.lit(1))
            .when(twice == den, F.pmod(q, F.lit(2)))
            .otherwise(F.lit(0)))
    return q + bump


def size_change_hundredths(n: Column | str, low: Column | str, spread: Column | str) -> Column:
    """``round(((n - low) / spread) * 2 - 1, 2)`` in hundredths (integer), half to even."""
    n, low, spread = _c(n), _c(low), _c(spread)
    num = (n - low) * 200 - spread * 100
    return round_ratio_half_even(num, spread)


def relative_size(n: Column | str, low: Column | str, spread: Column | str) -> Column:
    """Font size in percent, 72 to 168: ``(change * 0.4 + 1) * 120``."""
    change = size_change_hundredths(n, low, spread) / 100
    return (change * MAX_SIZE_CHANGE + 1) * BASE_SIZE_PERCENT


def normalised_count(n: Column | str, low: Column | str, spread: Column | str) -> Column:
    """``(n - low) / (spread - low) - 0.49``; NULL when the denominator is 0."""
    n, low, spread = _c(n), _c(low), _c(spread)
    den = spread - low
    return F.when(den != 0, (n - low) / den - NORMALISED_SHIFT)


def normalised_half_steps(n: Column | str, low: Column | str, spread: Column | str) -> Column:
    """``round(normalised * 2)`` half to even on the exact fraction; NULL on a 0 denominator.

    ``2 (n - low) / d - 0.98 = (100 (n - low) - 49 d) / (50 d)``.
    """
    n, low, spread = _c(n), _c(low), _c(spread)
    d = spread - low
    sign = F.when(d < 0, F.lit(-1)).otherwise(F.lit(1))
    num = ((n - low) * 100 - d * 49) * sign
    den = d * 50 * sign
    return F.when(d != 0, round_ratio_half_even(num, den).cast("int"))


def title_case(col: Column | str) -> Column:
    return F.initcap(_c(col))
