"""Versioned state: change sets, ordered replay, snapshots and version diffs."""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiq.functions import text as t
from stratiq.operators.relational import mutual_first
from stratiq.session import dealt, settled


def check_delta(ledger: DataFrame, ops: DataFrame, reverse: bool = False) -> DataFrame:
    """Why a change set does not fit: (``seq``, ``record_id``, ``problem``).

    ``ledger`` is (``file``, ``record_id``, ``body``), ``ops`` (``seq``, ``file``,
    ``record_id``, ``before``, ``after``); adding needs a null ``before`` and the
    record's absence.  Several operations on one record must chain.  Reversing
    swaps before and after and runs from the last to the first.
    """
    ops = _directed(ops, reverse)
    w = Window.partitionBy("file", "record_id").orderBy("seq")
    now = ops.join(ledger.select("file", "record_id", F.col("body").alias("current")), ["file", "record_id"], "left")
    first = F.row_number().over(w) == 1
    expected = F.when(first, F.col("current")).otherwise(F.lag("after").over(w))
    odd = now.withColumn("is", expected)
    problem = (
        F.when(F.col("is").isNotNull() & F.col("before").isNull(), "already there")
        .when(F.col("is").isNull() & F.col("before").isNotNull(), "not there")
        .when(~F.col("is").eqNullSafe(F.col("before")), "differs from what was recorded")
        .when(F.col("after").isNotNull() & (F.get_json_object("after", "$.id") != F.col("record_id")), "carries another id")
    )
    return odd.select("seq", "record_id", problem.alias("problem")).where("problem is not null")


def _directed(ops: DataFrame, reverse: bool) -> DataFrame:
    if not reverse:
        return ops.select("seq", "file", "record_id", "before", "after")
    return ops.select((-F.col("seq")).alias("seq"), "file", "record_id", F.col("after").alias("before"), F.col("before").alias("after"))


def apply_delta(ledger: DataFrame, ops: DataFrame, reverse: bool = False) -> DataFrame:
    """The ledger after a change set; all or nothing: one that does not fit raises."""
    wrong = check_delta(ledger, ops, reverse).limit(5).collect()
    if wrong:
        raise ValueError("; ".join(f"{r['record_id']}: {r['problem']}" for r in wrong))
    last = _directed(ops, reverse).groupBy("file", "record_id").agg(F.max_by("after", "seq").alias("body"))
    kept = ledger.join(last.select("file", "record_id"), ["file", "record_id"], "left_anti")
    return kept.select("file", "record_id", "body").unionByName(last.where("body is not null"))


def pending_overlay(ledger: DataFrame, pending: DataFrame) -> DataFrame:
    """The ledger with unapplied change sets laid over it; the latest revision wins."""
    every = ledger.select("file", "record_id", "body", F.lit(-1).cast("long").alias("revision")).unionByName(pending.select("file", "record_id", F.col("after").alias("body"), F.col("revision").cast("long").alias("revision")))
    return every.groupBy("file", "record_id").agg(F.max_by("body", "revision").alias("body")).where("body is not null")


def applied(log: DataFrame) -> DataFrame:
    """(``delta``, ``depth``) of change sets on the stack after a log of (``seq``,
    ``delta``, ``action``): applying pushes, reverting takes the last one off."""
    step = F.when(F.col("action") == "apply", 1).otherwise(-1)
    return log.groupBy("delta").agg(F.sum(step).alias("depth")).where("depth > 0")


def log_problems(log: DataFrame) -> DataFrame:
    """Revisions that do not count on by one, and reverts of what is not the last applied."""
    w = Window.orderBy("seq")
    number = F.regexp_extract("revision", r"REV-([0-9]+)", 1).cast("long")
    steps = log.withColumn("n", number).withColumn("expected", F.lag("n").over(w) + F.when(F.col("action") == "apply", 1).otherwise(-1))
    jumps = steps.where("expected is not null and n <> expected").select("seq", "delta", F.lit("revision does not follow").alias("problem"))
    # a revert must undo the latest change set still applied: bracket depth pairs it with its apply
    depth = F.sum(F.when(F.col("action") == "apply", 1).otherwise(-1)).over(w)
    leveled = log.withColumn("level", F.when(F.col("action") == "apply", depth).otherwise(depth + 1))
    pair = Window.partitionBy("level").orderBy("seq")
    matched = leveled.withColumn("opened", F.lag("delta").over(pair)).withColumn("was", F.lag("action").over(pair))
    crossed = matched.where("action <> 'apply' and (was is null or was <> 'apply' or opened <> delta)").select("seq", "delta", F.lit("not the last one applied").alias("problem"))
    return jumps.unionByName(crossed)


def fingerprint(files: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(``files``, ``fingerprint``) of (``path``, ``sha256``), of each group of ``by``:
    order-free over input order.  The hash is of one list of all paths, which a
    group's task holds (some 100 bytes a file)."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda x: F.concat(x["path"], F.lit("\t"), x["sha256"], F.lit("\n")))
    return files.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.concat(F.lit("sha256:"), F.sha2(F.array_join(lines, "").cast("binary"), 256)).alias("fingerprint"))


def file_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(``path``, ``change``): changed, new or retired files."""
    o, n = old.select("path", F.col("sha256").alias("o")), new.select("path", F.col("sha256").alias("n"))
    kind = F.when(F.col("o").isNull(), "new").when(F.col("n").isNull(), "retired").otherwise("changed")
    return o.join(n, "path", "full_outer").where("not (o <=> n)").select("path", kind.alias("change"))


def translate_citations(rows: DataFrame, key: str, text: str, mapping: DataFrame, letter: str = "C") -> DataFrame:
    """(``key``, ``text``) with every citation replaced by its new number, all at
    once: texts are cut at citations, joined with ``mapping`` (``old``, ``new``)
    and put together again."""
    pattern = rf"\b{letter}-[0-9]+"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = rows.select(key, F.posexplode(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.concat(found, F.array(F.lit(""))).alias("old"))).alias("pos", "x"))
    named = parts.select(key, "pos", "x.gap", F.col("x.old").alias("old")).join(mapping.select("old", "new"), "old", "left")
    pieces = named.select(key, F.struct("pos", F.concat("gap", F.coalesce("new", "old")).alias("s")).alias("p"))
    return pieces.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["s"]), "").alias(text))


def match_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Pairs of old and new rows (``id``, ``section``, ``pos``, ``content``) that are
    one row in two versions: (``old``, ``new``, ``how``).

    In turn: same id and content; same content with citations masked; same with
    case and spacing set aside; what stands in gaps of equal length between
    matched neighbours.  Each turn takes mutual first choices among what is
    left, preferring same id, same section and nearness.
    """
    def left_over(df: DataFrame, pairs: DataFrame | None, side: str) -> DataFrame:
        return df if pairs is None else df.join(dealt(pairs.select(F.col(side).alias("id"))), "id", "left_anti")

    keys = [
        ("same", lambda: F.concat_ws("\x00", "id", "content")),
        ("renumbered", lambda: t.mask_citations(F.col("content"))),
        ("reworded", lambda: t.folded(t.mask_citations(F.col("content")))),
    ]
    pairs: DataFrame | None = None
    for how, key in keys:
        o, n = left_over(old, pairs, "old"), left_over(new, pairs, "new")
        side = lambda df, s: df.select(key().alias("k"), *[F.col(c).alias(f"{s}_{c}") for c in ("id", "section", "pos")])
        met = side(o, "o").join(dealt(side(n, "n")), "k")
        order = [F.col("o_id") != F.col("n_id"), F.col("o_section") != F.col("n_section"), F.abs(F.col("o_pos") - F.col("n_pos")), "o_id", "n_id"]
        found = mutual_first(met, "o_id", "n_id", order).select(F.col("o_id").alias("old"), F.col("n_id").alias("new"), F.lit(how).alias("how"))
        pairs = settled(found if pairs is None else pairs.unionByName(found))  # each turn starts from files

    def gaps(df: DataFrame, s: str) -> DataFrame:
        known = df.join(dealt(pairs.select(F.col(s).alias("id"), F.lit(1).alias("m"), F.col("old").alias("anchor"))), "id", "left")
        ahead, back = Window.partitionBy("section").orderBy("pos", "id"), Window.partitionBy("section").orderBy(F.desc("pos"), F.desc("id"))
        so_far = lambda w: F.last("anchor", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        run = known.withColumn("after", so_far(ahead)).withColumn("before", so_far(back)).where("m is null")  # a frame to the end would be read anew for each row
        inside = Window.partitionBy("section", "after", "before")
        return run.select("id", "section", F.coalesce("after", F.lit("")).alias("after"), F.coalesce("before", F.lit("")).alias("before"), F.row_number().over(inside.orderBy("pos", "id")).alias("i"), F.count(F.lit(1)).over(inside).alias("size"))

    a, b = gaps(old, "old").withColumnRenamed("id", "old"), gaps(new, "new").withColumnRenamed("id", "new")
    filled = a.join(dealt(b), ["section", "after", "before", "i", "size"]).select("old", "new", F.lit("in place").alias("how"))
    return settled(pairs.unionByName(filled))


def version_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(``id``, ``change``) of rows: unchanged, renumbered, modified, new or retired."""
    pairs = match_rows(old, new)
    o, n = old.select(F.col("id").alias("old"), F.col("content").alias("oc")), new.select(F.col("id").alias("new"), F.col("content").alias("nc"))
    kind = F.when(F.col("oc") == F.col("nc"), F.when(F.col("old") == F.col("new"), "unchanged").otherwise("renumbered")).when(t.mask_citations(F.col("oc")) == t.mask_citations(F.col("nc")), "renumbered").otherwise("modified")
    both = pairs.join(dealt(o), "old").join(dealt(n), "new").select(F.col("new").alias("id"), kind.alias("change"))
    gone = old.join(dealt(pairs.select(F.col("old").alias("id"))), "id", "left_anti").select("id", F.lit("retired").alias("change"))
    fresh = new.join(dealt(pairs.select(F.col("new").alias("id"))), "id", "left_anti").select("id", F.lit("new").alias("change"))
    return both.unionByName(gone).unionByName(fresh)


def _in_order(pairs: pa.Table) -> pa.Table:
    """Marks the pairs of a section that a longest run in the same order keeps as
    equal, the others as moved."""
    pairs = pairs.sort_by([("old_pos", "ascending"), ("new_pos", "ascending")])
    new = pairs["new_pos"].to_pylist()
    tails: list[int] = []  # the pair that ends the best run of each length
    before: list[int] = []
    for i, pos in enumerate(new):
        k = bisect.bisect_left(tails, pos, key=lambda t: new[t])
        before.append(tails[k - 1] if k else -1)
        tails[k : k + 1] = [i]
    change, at = ["moved"] * len(new), tails[-1] if tails else -1
    while at >= 0:
        change[at] = "equal"
        at = before[at]
    return pairs.append_column("change", pa.array(change, pa.string()))


def align_paragraphs(old: DataFrame, new: DataFrame) -> DataFrame:
    """(``section``, ``old_pos``, ``new_pos``, ``change``) of paragraphs (``section``,
    ``pos``, ``text``): equal (a longest run of matches in the same order), moved,
    changed (equal-length replacements between equal neighbours pair up),
    retired, new."""
    h = lambda df, s: df.select("section", F.col("pos").alias(f"{s}_pos"), F.sha2(F.col("text").cast("binary"), 256).alias("h"))
    order = [F.abs(F.col("old_pos") - F.col("new_pos")), "old_pos", "new_pos"]
    w1, w2 = Window.partitionBy("section", "h", "old_pos").orderBy(*order), Window.partitionBy("section", "h", "new_pos").orderBy(*order)
    same = h(old, "old").join(h(new, "new"), ["section", "h"]).withColumn("a", F.row_number().over(w1)).withColumn("b", F.row_number().over(w2)).where("a = 1 and b = 1")
    same = same.select("section", F.col("old_pos").cast("long").alias("old_pos"), F.col("new_pos").cast("long").alias("new_pos"))
    kept = same.groupBy("section").applyInArrow(_in_order, f"section {same.schema['section'].dataType.simpleString()}, old_pos long, new_pos long, change string")

    def runs(df: DataFrame, s: str) -> DataFrame:
        marked = df.select("section", F.col("pos").alias(f"{s}_pos")).join(kept.select("section", f"{s}_pos", F.col("old_pos").alias("anchor")), ["section", f"{s}_pos"], "left") if s == "new" else df.select("section", F.col("pos").alias("old_pos")).join(kept.select("section", "old_pos", F.col("old_pos").alias("anchor")), ["section", "old_pos"], "left")
        w = Window.partitionBy("section").orderBy(f"{s}_pos").rowsBetween(Window.unboundedPreceding, 0)
        loose = marked.withColumn("after", F.coalesce(F.last("anchor", ignorenulls=True).over(w), F.lit(-1))).where("anchor is null")
        inside = Window.partitionBy("section", "after")
        return loose.select("section", f"{s}_pos", "after", F.row_number().over(inside.orderBy(f"{s}_pos")).alias("i"), F.count(F.lit(1)).over(inside).alias("size"))

    o, n = runs(old, "old"), runs(new, "new")
    met = o.join(n, ["section", "after", "i", "size"], "full_outer")
    kind = F.when(F.col("new_pos").isNull(), "retired").when(F.col("old_pos").isNull(), "new").otherwise("changed")
    return kept.unionByName(met.select("section", "old_pos", "new_pos", kind.alias("change")))


def back_within(snapshot: DataFrame, now: DataFrame, reverted: DataFrame) -> DataFrame:
    """Groups whose count (``grp``, ``n``) fell below the snapshot's less what was
    reverted since."""
    s, a, r = snapshot.withColumnRenamed("n", "was"), now.withColumnRenamed("n", "now"), reverted.withColumnRenamed("n", "undone")
    return s.join(a, "grp", "left").join(r, "grp", "left").select("grp", "was", F.coalesce("now", F.lit(0)).alias("now"), F.coalesce("undone", F.lit(0)).alias("undone")).where("now < was - undone")
