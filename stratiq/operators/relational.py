"""Joins, aggregations, windows and set operations of the ledger dataflow.

Each operator takes DataFrames and column names and returns a lazy DataFrame;
the physical strategy is Catalyst's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiq.functions.text import message_template


# -- joins ------------------------------------------------------------------
def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key: the first in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def dangling(df: DataFrame, ref: str, targets: DataFrame, ident: str) -> DataFrame:
    """Rows whose non-null reference has no target."""
    known = targets.select(F.col(ident).alias(ref)).distinct()
    return df.where(F.col(ref).isNotNull()).join(known, ref, "left_anti")


def dangling_lists(df: DataFrame, ident: str, refs: str, targets: DataFrame, target_id: str) -> DataFrame:
    """(``record_id``, ``other_id``) of list references without a target."""
    each = df.select(F.col(ident).alias("record_id"), F.explode(refs).alias("other_id"))
    return dangling(each, "other_id", targets, target_id)


def claimed_by(owners: DataFrame, included: str, excluded: str) -> DataFrame:
    """(``owner``, ``member``) of owners' included lists without the excluded ones."""
    return owners.select("owner", F.explode(F.array_except(F.coalesce(included, F.expr("array()")), F.coalesce(excluded, F.expr("array()")))).alias("member"))


def with_label(df: DataFrame, ref: str, labels: DataFrame, ident: str, chain: list[str], out: str) -> DataFrame:
    """``df`` with a label for ``ref``: the first non-null column of ``chain``, else the id."""
    named = labels.select(F.col(ident).alias(ref), F.coalesce(*chain).alias("__label"))
    return df.join(named, ref, "left").withColumn(out, F.coalesce("__label", F.col(ref).cast("string"))).drop("__label")


def one_way_links(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Links that one side has and the other lacks, with ``side`` (``a`` or ``b``)."""
    left, right = a.select(*keys).distinct().withColumn("__a", F.lit(True)), b.select(*keys).distinct().withColumn("__b", F.lit(True))
    met = left.join(right, keys, "full_outer")
    return met.where("__a is null or __b is null").select(*keys, F.when(F.col("__b").isNull(), "a").otherwise("b").alias("side"))


def back_links(links: DataFrame, target: str, source: str) -> DataFrame:
    """Per target the sorted distinct sources that point to it."""
    return links.where(F.col(target).isNotNull()).groupBy(target).agg(F.array_sort(F.collect_set(source)).alias("sources"))


def merged_links(old: Column, found: Column) -> Column:
    """The old list in its order, then what is new, sorted."""
    before = F.coalesce(old, F.expr("array()"))
    return F.concat(F.array_distinct(before), F.array_sort(F.array_except(F.coalesce(found, F.expr("array()")), before)))


def both_selected(pairs: DataFrame, selected: DataFrame) -> DataFrame:
    """(``owner``, ``a``, ``b``) of conflicting pairs that one owner selects both of."""
    one, two = selected.select("owner", F.col("member").alias("a")), selected.select("owner", F.col("member").alias("b"))
    return pairs.join(one, "a").join(two, ["owner", "b"]).select("owner", "a", "b").distinct()


#: Members of a block of a group, and pairs of a task.
BLOCK, PAIRS_A_TASK = 1024, 20_000_000


def rivals(groups: DataFrame) -> DataFrame:
    """Pairs of members (``a`` < ``b``) of one group, from (``grp``, ``member``), each once.

    A group's members are dealt over blocks, and every two blocks meet in a
    cell of their own, so no task holds a large group.  Members of several
    groups carry these, and two of them are told in the first group they share:
    pairs are never compared with each other."""
    from stratiq.session import settled

    held = groups.where("grp is not null and member is not null").groupBy("member").agg(F.array_sort(F.collect_set("grp")).alias("all"))
    rows = settled(held.select("member", F.when(F.size("all") > 1, F.col("all")).alias("more"), F.explode("all").alias("grp")))
    sizes = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    pairs = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).head()[0] or 0
    tasks = min(max(rows.sparkSession.sparkContext.defaultParallelism, int(pairs // PAIRS_A_TASK)), 20_000)
    large = sizes.where(F.col("n") > BLOCK).select("grp", F.ceil(F.col("n") / BLOCK).alias("blocks"))  # one for BLOCK members at most
    placed = rows.join(F.broadcast(large), "grp", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("member"), "blocks"))
    one = placed.select("grp", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), F.col("member").alias("x"), F.col("more").alias("x_more"))
    two = placed.select("grp", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"), F.col("block").alias("j"), F.col("member").alias("y"), F.col("more").alias("y_more"))
    met = one.repartition(tasks, "grp", "i", "j").join(two.repartition(tasks, "grp", "i", "j").hint("merge"), ["grp", "i", "j"]).where("i < j or x < y")
    first = F.col("x_more").isNull() | F.col("y_more").isNull() | (F.col("grp") == F.array_min(F.array_intersect("x_more", "y_more")))
    return met.where(first).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def unordered_pairs(df: DataFrame, ident: str, items: str) -> DataFrame:
    """(``id``, ``a``, ``b``) of the distinct items of each row's list, i < j, a <> b."""
    each = df.select(F.col(ident).alias("id"), F.posexplode(items).alias("i", "x"))
    later = each.select("id", F.col("i").alias("j"), F.col("x").alias("y"))
    return each.join(later, "id").where("i < j and x <> y").select("id", F.col("x").alias("a"), F.col("y").alias("b"))


def tiered(rows: DataFrame, tiers: list[DataFrame], key: str, value: str) -> DataFrame:
    """The value of the first tier that knows a row, and which tier it was."""
    found = None
    for n, tier in enumerate(tiers):
        part = tier.select(key, F.lit(n).alias("tier"), value)
        found = part if found is None else found.unionByName(part)
    best = found.groupBy(key).agg(F.min(F.struct("tier", value)).alias("b"))
    return rows.join(best, key, "left").select(*rows.columns, F.col(f"b.{value}").alias(value), F.col("b.tier").alias("tier"))


def keyed_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``key, change`` (new, retired, modified, unchanged) of two keyed tables."""
    cols = [c for c in old.columns if c != key]
    o = old.select(F.col(key), F.struct(*cols).alias("o"))
    n = new.select(F.col(key), F.struct(*cols).alias("n"))
    change = F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "retired").when(F.col("o") == F.col("n"), "unchanged").otherwise("modified")
    return o.join(n, key, "full_outer").select(key, change.alias("change"))


# -- aggregations -----------------------------------------------------------
def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ambiguous(df: DataFrame, label: str, owner: str) -> DataFrame:
    """Labels with more than one owner, and their owners in order."""
    out = df.groupBy(label).agg(F.array_sort(F.collect_set(owner)).alias("owners"))
    return out.where(F.size("owners") > 1)


def homonyms(df: DataFrame, spelling: str, authorship: str, rank: str, merged: str) -> DataFrame:
    """Spellings used by several records: severity by whether authorship (nulls
    set aside) or rank (null is a value) differ and whether any was merged."""
    g = df.groupBy(spelling).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(authorship).alias("authors"),
        F.countDistinct(F.coalesce(F.col(rank).cast("string"), F.lit("\x00"))).alias("ranks"),
        F.bool_or(F.coalesce(F.col(merged), F.lit(False))).alias("merged"),
    ).where("n > 1")
    differ = (F.col("authors") > 1) | (F.col("ranks") > 1)
    severity = F.when(F.col("merged") & differ, "ERROR").when(F.col("merged"), "WARNING").when(differ, "INFO").otherwise("WARNING")
    return g.select(spelling, "n", severity.alias("severity"))


def control_totals(actual: DataFrame, declared: DataFrame, key: str) -> DataFrame:
    """``key, declared, actual`` where the counts differ; a missing side counts 0."""
    a, d = actual.withColumnRenamed("n", "actual"), declared.withColumnRenamed("n", "declared")
    both = d.join(a, key, "full_outer").select(key, F.coalesce("declared", F.lit(0)).alias("declared"), F.coalesce("actual", F.lit(0)).alias("actual"))
    return both.where("declared <> actual")


def roll_up(findings: DataFrame, message: str = "message", order: str = "seq", examples: int = 3) -> DataFrame:
    """Findings by message template: count, when first seen, and up to three
    examples spread evenly over the group."""
    t = findings.withColumn("template", message_template(F.col(message)))
    w = Window.partitionBy("template")
    t = t.withColumn("r", F.row_number().over(w.orderBy(order)) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / examples))
    shown = (F.col("r") % step == 0) & (F.col("r") < step * examples)
    kept = F.array_sort(F.collect_list(F.when(shown, F.struct(F.col(order).alias("o"), F.col(message).alias("m")))))
    return t.groupBy("template").agg(F.first("n").alias("n"), F.min(order).alias("first_seen"), F.transform(kept, lambda x: x["m"]).alias("examples"))


def spread_sample(df: DataFrame, groups: list[str], order: list[str], k: int) -> DataFrame:
    """Every max(1, n // k)-th row of a group, k at most."""
    w = Window.partitionBy(*groups)
    r = df.withColumn("__r", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count(F.lit(1)).over(w))
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / k))
    return r.where((F.col("__r") % step == 0) & (F.col("__r") < step * k)).drop("__r", "__n")


def top_texts(df: DataFrame, text: str, k: int) -> DataFrame:
    """The k most frequent values, ties in order of the value."""
    return df.groupBy(text).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), text).limit(k)


# -- windows ----------------------------------------------------------------
def allocate_ids(df: DataFrame, prefix: str, taken: DataFrame, order: list[str], ident: str = "id") -> DataFrame:
    """``df`` with new ids ``PREFIX-NNNNNN`` above the highest one taken.

    Rows are numbered within ranges of their order and ranges by prefix sums,
    so no task sees all rows."""
    top = taken.where(F.col(ident).rlike(f"^{prefix}-[0-9]+$")).agg(F.coalesce(F.max(F.regexp_extract(ident, "([0-9]+)$", 1).cast("long")), F.lit(0)).alias("top")).head()[0]
    numbered = number_rows(df, order)
    digits = (F.col("row_number") + top).cast("string")
    return numbered.withColumn("new_id", F.concat(F.lit(f"{prefix}-"), F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits))).drop("row_number")


def number_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with a global ``row_number`` from 1 in the given order."""
    from stratiq.session import settled

    ranged = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().alias("__m")))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__first"))  # a row per range
    bases = sizes.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return ranged.join(bases, "__p").withColumn("row_number", F.col("__base") + F.col("__m") - F.col("__first") + 1).drop("__p", "__m", "__n", "__first", "__base")


def last_action(log: DataFrame, key: str, action: str, order: list[str]) -> DataFrame:
    """What was last done to each key."""
    return log.groupBy(key).agg(F.max_by(action, F.struct(*order)).alias(action))


def applied_stack(log: DataFrame, key: str, action: str, order: list[str], apply: str = "apply") -> DataFrame:
    """Keys whose last action is ``apply``."""
    return last_action(log, key, action, order).where(F.col(action) == apply)


def chain_gaps(df: DataFrame, groups: list[str], order: list[str], value: Column, expected) -> DataFrame:
    """Adjacent rows whose ``expected(previous, current)`` fails."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("current", value).where(F.col("previous").isNotNull() & ~expected(F.col("previous"), F.col("current")))


def islands(df: DataFrame, groups: list[str], order: list[str], breaks: Column) -> DataFrame:
    """``df`` with ``island``: how many breaks came up to and with each row."""
    w = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("island", F.sum(F.when(breaks, 1).otherwise(0)).over(w))


def mutual_first(pairs: DataFrame, a: str, b: str, order: list) -> DataFrame:
    """Pairs that are each other's first choice."""
    ra, rb = F.row_number().over(Window.partitionBy(a).orderBy(*order)), F.row_number().over(Window.partitionBy(b).orderBy(*order))
    return pairs.withColumn("__a", ra).withColumn("__b", rb).where("__a = 1 and __b = 1").drop("__a", "__b")


# -- sets -------------------------------------------------------------------
def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b)


def multiset_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersectAll(b)


def not_in_one_bucket(buckets: DataFrame, key: str) -> DataFrame:
    """Keys that are not in exactly one bucket: empty if the partition is complete."""
    return buckets.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n <> 1")


def new_errors(before: DataFrame, after: DataFrame, message: str = "message") -> DataFrame:
    """Messages after that were not there before, line numbers masked."""
    masked = lambda df: df.select(F.regexp_replace(message, ":[0-9]+", ":N").alias(message)).distinct()
    return masked(after).exceptAll(masked(before))
