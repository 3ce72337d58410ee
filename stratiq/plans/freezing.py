"""Freezes of a file layer and snapshots of a ledger: tables in, verified chains out.

A *freeze* fixes the files of a layer by path and hash under one fingerprint; it
is never rewritten.  A *snapshot* fixes the counts and files of a ledger and the
history up to then.  Everything here is lists of files, change sets and log
entries; texts and records are only ever seen by their hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiq.operators.versioning import file_changes, fingerprint

LISTED = "array<struct<path:string,sha256:string>>"


def freeze(files: DataFrame, *, version: str | None = None, cutoff: str | None = None, commit: str | None = None, decision: str | None = None, supersedes: str | None = None) -> DataFrame:
    """One row that fixes a layer of files (``path``, ``sha256``)."""
    told = {"version": version, "cutoff": cutoff, "commit": commit, "decision": decision, "supersedes": supersedes}
    listed = files.agg(F.array_sort(F.collect_list(F.struct("path", "sha256"))).alias("listed"))
    made = fingerprint(files).join(listed, F.lit(True))  # one row each
    return made.select(*[F.lit(v).cast("string").alias(k) for k, v in told.items()], "fingerprint", F.col("files").alias("file_count"), F.col("listed").alias("files"))


def refreeze(kept: DataFrame, fresh: DataFrame) -> DataFrame:
    """What becomes of a freeze where one (``kept``) may stand already: ``written``,
    ``already frozen`` (same fingerprint) or ``refused`` (another one)."""
    both = fresh.select(F.col("fingerprint").alias("new")).join(kept.select(F.col("fingerprint").alias("old")), F.lit(True), "left")
    return both.select(F.when(F.col("old").isNull(), "written").when(F.col("old") == F.col("new"), "already frozen").otherwise("refused").alias("outcome"))


def verify_freeze(record: DataFrame, files: DataFrame) -> DataFrame:
    """(``path``, ``change``) against a freeze: changed, new and retired files.  A
    record whose fingerprint or count is not that of its own list is one row,
    ``incoherent``, and nothing else is said."""
    listed = record.select(F.explode("files").alias("f")).select("f.path", "f.sha256")
    own = fingerprint(listed).select(F.col("fingerprint").alias("found"), F.col("files").alias("n"))
    odd = record.join(own, (F.col("fingerprint") != F.col("found")) | (F.coalesce("file_count", F.size("files")) != F.col("n"))).select(F.lit(None).cast("string").alias("path"), F.lit("incoherent").alias("change"))
    sound = file_changes(listed, files).join(odd.select("change"), F.lit(True), "left_anti")
    return odd.unionByName(sound)


def snapshot_id(existing: DataFrame) -> DataFrame:
    """The next ``SNAP-000000`` after those in ``id``."""
    last = F.max(F.nullif(F.regexp_extract("id", r"^SNAP-([0-9]+)", 1), F.lit("")).cast("long"))
    return existing.agg(F.concat(F.lit("SNAP-"), F.lpad((F.coalesce(last, F.lit(-1)) + 1).cast("string"), 6, "0")).alias("id"))


def revision_number(revision: Column) -> Column:
    """The number of ``REV-000012``; -1 if it is not of that form."""
    return F.coalesce(F.nullif(F.regexp_extract(revision, r"^REV-([0-9]+)$", 1), F.lit("")).cast("long"), F.lit(-1))


def snapshot(counts: DataFrame, files: DataFrame) -> DataFrame:
    """One row of ``counts`` (map of ``grp`` to ``n``) and ``files`` (``path``, ``sha256``)."""
    one = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("grp", F.col("n").cast("long"))))).alias("counts"))
    listed = files.agg(F.array_sort(F.collect_list(F.struct("path", "sha256"))).alias("files"))
    return one.join(listed, F.lit(True))  # one row each


def verify_snapshot(record: DataFrame, counts: DataFrame, files: DataFrame) -> DataFrame:
    """(``subject``, ``problem``): groups whose count differs, files that do."""
    was = record.select(F.explode("counts").alias("grp", "was"))
    met = was.join(counts.select("grp", F.col("n").alias("now")), "grp", "full_outer").where(~F.coalesce("was", F.lit(0)).eqNullSafe(F.coalesce("now", F.lit(0))))
    told = F.concat(F.lit("count "), F.coalesce("was", F.lit(0)).cast("string"), F.lit(" -> "), F.coalesce("now", F.lit(0)).cast("string"))
    listed = record.select(F.explode("files").alias("f")).select("f.path", "f.sha256")
    return met.select(F.col("grp").alias("subject"), told.alias("problem")).unionByName(file_changes(listed, files).select(F.col("path").alias("subject"), F.concat(F.lit("file "), "change").alias("problem")))


def prefix_hashes(log: DataFrame) -> DataFrame:
    """(``n``, ``sha256``) of the first ``n`` lines of a log (``seq``, ``line``), from
    0 on.  A log is one ordered list: its lines pass one task, one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, n = hashlib.sha256(), 0
        yield pa.RecordBatch.from_pydict({"n": [0], "sha256": [whole.hexdigest()]})
        for batch in batches:
            out = []
            for line in batch.column(0).cast(pa.binary()):
                whole.update((line.as_py() or b"") + b"\n")
                out.append(whole.hexdigest())
            yield pa.RecordBatch.from_pydict({"n": list(range(n + 1, n + len(out) + 1)), "sha256": out})
            n += len(out)

    ordered = log.repartition(1).sortWithinPartitions("seq").select("line")
    return ordered.mapInArrow(run, "n long, sha256 string")


def known_prefix(log: DataFrame, sha256: str) -> DataFrame:
    """The longest start of a log with that hash, as ``n`` lines; no row if none has it."""
    return prefix_hashes(log).where(F.col("sha256") == sha256).agg(F.max("n").alias("n")).where("n is not null")


def standing(log: DataFrame) -> DataFrame:
    """Change sets that stand after a log (``seq``, ``delta``, ``action``), with the
    ``seq`` of the application that was not reverted."""
    w = Window.partitionBy("delta").orderBy("seq")
    last = log.withColumn("__next", F.lead("action").over(w))
    return last.where("action = 'apply' and (__next is null or __next = 'apply')").select("delta", "seq")


def altered_deltas(log: DataFrame, files: DataFrame) -> DataFrame:
    """(``delta``, ``problem``): change sets that are gone, were applied without a
    hash, or are not what was first applied.  ``log`` has ``sha256``, ``files``
    is (``path``, ``sha256``) of the change sets as they are."""
    first = log.where("action = 'apply'").groupBy("delta").agg(F.min_by("sha256", "seq").alias("then"))
    met = first.join(files.select(F.col("path").alias("delta"), F.col("sha256").alias("now")), "delta", "left")
    problem = F.when(F.col("now").isNull(), "applied, but gone").when(F.col("then").isNull(), "applied without a hash").when(F.col("now") != F.col("then"), "not what was applied")
    return met.select("delta", problem.alias("problem")).where("problem is not null")


def altered_inputs(deltas: DataFrame, log: DataFrame, files: DataFrame) -> DataFrame:
    """(``delta``, ``path``, ``problem``): input files that are gone or differ from the
    hash their change set (``delta``, ``path``, ``sha256``) recorded, unless a
    later one uses the same path.  Those not applied come after all applied."""
    at = log.where("action = 'apply'").groupBy("delta").agg(F.min("seq").alias("seq"))
    placed = deltas.where("path is not null").join(at, "delta", "left").withColumn("place", F.coalesce("seq", F.lit(9223372036854775807)))
    last = placed.withColumn("latest", F.max("place").over(Window.partitionBy("path"))).where("place = latest")
    met = last.join(files.select("path", F.col("sha256").alias("now")), "path", "left")
    problem = F.when(F.col("now").isNull(), "gone").when(~F.col("now").eqNullSafe(F.col("sha256")), "not what was recorded")
    return met.select("delta", "path", problem.alias("problem")).where("problem is not null")


def freeze_chain(log: DataFrame, deltas: DataFrame, active: str | None) -> DataFrame:
    """(``delta``, ``problem``): where the freezes that change sets start from do not
    follow from those before.

    ``deltas`` has ``delta`` and either ``from`` and ``to`` (it moves the ledger
    from one freeze to another) or ``declared`` (it starts from that freeze);
    ``active`` is the freeze the ledger says it stands on (row without a delta).
    The order is that of a log: a few rows a change set, in one window."""
    chain = standing(log).join(deltas.select("delta", F.col("from").alias("src"), F.col("to").alias("dst"), "declared"), "delta")
    before = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    moves = F.col("dst").isNotNull()
    start = F.when(~moves, F.col("declared"))
    current = lambda w: F.coalesce(F.last("dst", ignorenulls=True).over(w), F.first(start, ignorenulls=True).over(w))
    walked = chain.withColumn("current", current(before))
    named = F.when(moves, F.col("src")).otherwise(F.col("declared"))
    odd = walked.where(F.col("current").isNotNull() & (named.isNotNull() | moves) & ~named.eqNullSafe(F.col("current")))
    steps = odd.select("delta", F.concat(F.when(moves, "moves from ").otherwise("starts from "), F.coalesce(named, F.lit("nothing")), F.lit(", stood on "), "current").alias("problem"))
    whole = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    end = chain.withColumn("current", current(whole)).agg(F.max_by("current", "seq").alias("current"))
    last = end.where(F.col("current").isNotNull() & ~F.col("current").eqNullSafe(F.lit(active).cast("string")))
    return steps.unionByName(last.select(F.lit(None).cast("string").alias("delta"), F.concat(F.lit("active is "), F.coalesce(F.lit(active).cast("string"), F.lit("nothing")), F.lit(", change sets leave "), "current").alias("problem")))
