"""Deep-time operators: years before present, overlap and precedence joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiq.session import dealt, settled

#: Units that convert to years, and the origins that count back.
UNIT_YEARS = {"years": 1.0, "thousand_years": 1e3, "million_years": 1e6, "calibrated_years": 1.0}
AGO_REFERENCES = ("before_present", "before_2000_ce", "not_stated")
#: Rows (some 60 bytes each) of a side of an overlap join that may be sent to all executors.
SENT = 100_000


def unit_years(unit: Column) -> Column:
    """Years of a unit; null for units that do not convert."""
    out = F.lit(None).cast("double")
    for name, years in UNIT_YEARS.items():
        out = F.when(unit == name, F.lit(years)).otherwise(out)
    return out


def span(oldest: Column, youngest: Column, unit: Column, reference: Column) -> tuple[Column, Column, Column]:
    """(comparable, old, young) in years before present.  Open bounds stay null;
    an interval without bounds, of another origin or unit is not comparable."""
    ok = unit_years(unit).isNotNull() & F.coalesce(reference, F.lit("not_stated")).isin(*AGO_REFERENCES) & (oldest.isNotNull() | youngest.isNotNull())
    return ok, F.when(ok, oldest * unit_years(unit)), F.when(ok, youngest * unit_years(unit))


def overlaps(a_old: Column, a_young: Column, b_old: Column, b_young: Column) -> Column:
    """Two intervals counted back share a moment; a null bound is open."""
    return (a_old.isNull() | b_young.isNull() | (a_old >= b_young)) & (b_old.isNull() | a_young.isNull() | (b_old >= a_young))


def strictly_younger(a_old: Column, b_young: Column) -> Column:
    """All of a lies after all of b; unknown bounds never do."""
    return a_old.isNotNull() & b_young.isNotNull() & (a_old < b_young)


def any_overlap(pairs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Per key pair of rows (a_old, a_young, b_old, b_young): whether any overlap."""
    hit = overlaps(*(F.col(c) for c in ("a_old", "a_young", "b_old", "b_young")))
    return pairs.groupBy(*keys).agg(F.bool_or(hit).alias("overlap"))


def overlap_join(left: DataFrame, right: DataFrame, width: float | None = None, *, key: str | None = None) -> DataFrame:
    """Pairs of intervals (``id``, ``young``, ``old``; counted back, closed, a null
    bound open) that overlap, as left_id, right_id.  Intervals whose bounds are
    both known and inverted overlap nothing.

    An interval stands on the level at which a bucket (of ``width``, doubled
    with each level; the mean length by default) is as long as it is, and in
    the two buckets at most that it touches there and on each level above that
    is one of the other side's own.  A pair meets on the higher of its levels
    and is reported in the first bucket it shares, so it appears once without
    a distinct and without a nested-loop join, however long an interval is.

    Only a side of at most ``SENT`` rows in buckets is sent to all executors."""
    left, right = (settled(df.select("id", "young", "old", *([key] if key else []))) for df in (left, right))
    known = left.select("young", "old").unionByName(right.select("young", "old"))
    low, high, mean = known.agg(F.least(F.min("young"), F.min("old")), F.greatest(F.max("young"), F.max("old")), F.avg(F.col("old") - F.col("young"))).head()
    low, high = (0.0, 0.0) if low is None else (float(low), float(high))
    width = float(width or mean or 0) if (width or mean or 0) > 0 else 1.0

    def placed(df: DataFrame, side: str) -> DataFrame:
        cols = [F.col(c).alias(f"{side}_{c}") for c in ("id", "young", "old")] + ([F.col(key).alias("k")] if key else [])
        begin, end = F.coalesce(F.col("young").cast("double"), F.lit(low)), F.coalesce(F.col("old").cast("double"), F.lit(high))
        own = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest((end - begin) / width, F.lit(1.0)))).cast("int"))
        sound = df.where(F.col("young").isNull() | F.col("old").isNull() | (F.col("young") <= F.col("old")))
        return sound.select(*cols, begin.alias("begin"), F.greatest(begin, end).alias("end"), own.alias(f"{side}_level"))

    a, b = placed(left, "left"), placed(right, "right")
    counts = [{r[0]: r[1] for r in df.groupBy(f"{side}_level").count().collect()} for df, side in ((a, "left"), (b, "right"))]  # a row per level

    def in_buckets(df: DataFrame, side: str, others: dict[int, int]) -> DataFrame:
        own = F.col(f"{side}_level")
        above = F.array(*[F.lit(x) for x in sorted(others)]).cast("array<int>")
        met = F.filter(above, lambda x: x > own)
        each = df.select("*", F.explode(F.when(own >= min(others, default=0), F.array_append(met, own)).otherwise(met)).alias("level"))
        size = F.lit(width) * F.pow(F.lit(2.0), F.col("level"))
        first, last = F.floor(F.col("begin") / size), F.floor(F.col("end") / size)
        return each.select("*", first.alias(f"{side}_first"), F.explode(F.sequence(first, last)).alias("bucket")).drop("begin", "end")

    most = [2 * n * (len(other) + 1) for n, other in ((sum(counts[0].values()), counts[1]), (sum(counts[1].values()), counts[0]))]
    a, b = in_buckets(a, "left", counts[1]), in_buckets(b, "right", counts[0])
    if min(most) > SENT:
        a = dealt(a)
    elif most[0] < most[1]:
        a = F.broadcast(a)
    else:
        b = F.broadcast(b)
    met = a.join(b, ["level", "bucket", *(["k"] if key else [])])
    met = met.where((F.col("level") == F.greatest("left_level", "right_level")) & (F.col("bucket") == F.greatest("left_first", "right_first")))
    return met.where(overlaps(*(F.col(c) for c in ("left_old", "left_young", "right_old", "right_young")))).select("left_id", "right_id")


def to_ma(value: Column, unit: Column) -> Column:
    """A bound in millions of years."""
    return value * unit_years(unit) / 1e6


def interval_shape(oldest: Column, youngest: Column, unit: Column) -> Column:
    """Shape of a mark: interval, point, minimum, from, geologic or unplaced."""
    return (
        F.when(unit == "geological_interval", "geologic").when(unit_years(unit).isNull(), "unplaced").when(oldest.isNull() & youngest.isNull(), "unplaced")
        .when(oldest.isNull(), "minimum").when(youngest.isNull(), "from").when(oldest == youngest, "point").otherwise("interval")
    )


def scale_linear(x: Column, lo: float, hi: float, a: float, b: float) -> Column:
    """Maps [lo, hi] to [a, b]."""
    return (x - lo) / (hi - lo) * (b - a) + a
