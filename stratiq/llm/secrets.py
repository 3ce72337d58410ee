"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its content.  Each
distinct blob is scanned once per rule version; a stored ledger keeps what was
scanned, so a later run scans only blob and rule-version pairs it has not seen
and appends them.  Findings are read from the ledger and joined back to every
path that holds the blob, blobs that many paths hold in several tasks.

All of it is DataFrame expressions: offsets come from the lengths of the
pieces between matches (``split``) and of the matches (``regexp_extract_all``),
which the same regular-expression engine yields in the same order.  Matches are
taken in runs of ``RUN``, so a text's cost follows its matches, not their square.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiq.llm.common import scratch_path

SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule string, spans {SPANS}"
RUN = 256
PATH_SALTS = 16  # tasks among which the paths of one blob are dealt


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost without overlap; matches whose ``group``
    (0: the whole match) is shorter than ``least`` code points are dropped."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules, in the order in which kinds are listed.
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
)

#: A run of one class that is long enough: finding it first lets most texts skip the offset arithmetic.
_LONG_RUN = {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, though lambdas in it use it many times."""
    return F.transform(F.array(value), body)[0]


def _runs(array: Column) -> Column:
    """``array`` in runs of ``RUN``; at least one, if empty."""
    last = F.greatest(F.floor((F.size(array) - 1) / RUN).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(array, c * RUN + 1, F.lit(RUN)))


def _pattern(rule: Rule) -> str:
    """A maximal run holds no second start, so its bounded form finds the same spans."""
    return (_LONG_RUN.get(rule.kind) if rule.version == 1 else None) or rule.pattern


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans (code points, end exclusive) of ``rule`` in ``text``, in text order."""
    pattern = _pattern(rule)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = whole if pattern != rule.pattern or rule.group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(F.slice(gaps, 1, F.size(whole)), F.arrays_zip(whole.alias("w"), kept.alias("k")), lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["w"]).alias("len"), F.length(m["k"]).alias("kept")))
    none = F.expr(f"cast(array() as {SPANS})")

    def step(acc: Column, m: Column) -> Column:
        s = acc["at"] + m["gap"]
        e = s + m["len"]
        one = F.array(F.struct(s.alias("start"), e.alias("end")))
        return F.struct(e.alias("at"), F.when(m["kept"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def starts(runs: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        length = lambda run: F.aggregate(run, F.lit(0), lambda n, m: n + m["gap"] + m["len"])
        return F.aggregate(runs, begin, lambda acc, run: F.struct((acc["at"] + length(run)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def spans(runs: Column) -> Column:
        return F.flatten(F.zip_with(runs, starts(runs), lambda run, at: F.aggregate(run, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])))

    found = _bound(parts, lambda p: _bound(_runs(p), spans))
    return F.when(text.rlike(pattern), found).otherwise(none)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger stored at ``path``; empty where there is none yet."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def scan_versions(versions: DataFrame, rules: tuple[Rule, ...] = RULES, *, ledger: str | None = None, path_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan the contents of all path versions that the ledger has not seen.

    ``versions``: any columns among which ``path_cols`` name a path (or path
    and version) and ``text_col`` holds its content.  ``ledger``: the folder of
    an append-only table of ``blob``, ``rule`` (``kind@version``) and ``spans``
    with one row per scanned pair; None starts a new one.  The call writes the
    pairs it scans there.

    Returns ``(findings, ledger)``: *findings* has one row per input row with
    the path columns, ``blob`` and ``spans`` (array of kind, start, end sorted
    by start, then kind in rule order); *ledger* is the whole table.

    Null contents are the empty blob.  Repeated rows keep one result row each;
    copies of a blob are reduced to one before it is shuffled and scanned.  A
    text of any length is scanned whole, an empty table scans nothing, and
    columns that are not named are not read.
    """
    spark = versions.sparkSession
    path = ledger or scratch_path(spark, "ledger")
    text = F.coalesce(F.col(text_col), F.lit(""))
    addressed = versions.select(*[F.col(c) for c in path_cols], text.alias("__text")).withColumn("blob", F.sha2(F.col("__text").cast("binary"), 256))
    blobs = addressed.groupBy("blob").agg(F.first("__text").alias("__text"))
    keys = [r.key for r in rules]
    none = F.expr("cast(array() as array<string>)")
    if ledger is None:
        unseen = blobs.withColumn("__done", none)
    else:
        done = read_ledger(spark, path).where(F.col("rule").isin(*keys)).groupBy("blob").agg(F.collect_set("rule").alias("__done"))
        unseen = blobs.join(done, "blob", "left").withColumn("__done", F.coalesce("__done", none)).where(F.size("__done") < len(keys))
    scans = [F.when(~F.array_contains("__done", r.key), F.struct(F.lit(r.key).alias("rule"), rule_spans(F.col("__text"), r).alias("spans"))) for r in rules]
    fresh = unseen.select("blob", F.explode(F.array_compact(F.array(*scans))).alias("pair")).select("blob", "pair.*")
    fresh.write.mode("append").parquet(path)
    whole = read_ledger(spark, path)

    order = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("rule")).cast("int")
    tagged = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("__order").alias("order"), s["end"].alias("end")))
    hits = whole.where(F.col("rule").isin(*keys) & (F.size("spans") > 0)).withColumn("__order", order)
    hits = hits.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(tagged))).alias("__every"))
    names = F.array(*[F.lit(r.kind) for r in rules])
    named = F.transform("__every", lambda s: F.struct(F.element_at(names, s["order"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    hits = hits.select("blob", named.alias("spans"), F.explode(F.sequence(F.lit(0), F.lit(PATH_SALTS - 1))).alias("__salt"))
    paths = addressed.drop("__text").withColumn("__salt", F.pmod(F.xxhash64(*path_cols), F.lit(PATH_SALTS)).cast("int"))
    no_spans = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    findings = paths.join(hits, ["blob", "__salt"], "left").select(*path_cols, "blob", F.coalesce("spans", no_spans).alias("spans"))
    return findings, whole


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span (sorted by start) replaced by ``mark``; overlapping
    spans give one mark.  The text is cut by runs of spans first, so that it is
    not copied for every span."""

    def within(segment: Column, base: Column, run: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            upto = F.substring(segment, acc["at"] - base + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
            out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], upto, F.lit(mark))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

        return F.aggregate(run, F.struct(base.alias("at"), F.lit("").alias("out")), step, lambda acc: acc["out"])

    def one(acc: Column, run: Column) -> Column:
        end = F.greatest(acc["at"], F.array_max(F.transform(run, lambda s: s["end"])))
        piece = _bound(F.substring(text, acc["at"] + 1, end - acc["at"]), lambda segment: within(segment, acc["at"], run))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    done = F.aggregate(_runs(spans), begin, one, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_documents(docs: DataFrame, *, text_col: str = "text", length_col: str = "n_chars", mark: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """``docs`` with every secret in its texts replaced by ``mark`` and
    ``length_col`` (if there is such a column) brought up to date.

    No row is dropped; texts without secrets, and nulls, stay as they are, and
    so do all other columns.  Rows none of whose rules can match pass without a
    shuffle; the others meet their blob's findings, a common blob in several
    tasks.
    """
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    may = F.lit(False)
    for rule in RULES:
        may = may | F.coalesce(F.col(text_col), F.lit("")).rlike(_pattern(rule))
    some = docs.where(may).withColumn("__blob", digest)
    findings, _ = scan_versions(some.select("__blob", text_col), path_cols=("__blob",), text_col=text_col, ledger=ledger)
    hits = findings.where(F.size("spans") > 0).groupBy("__blob").agg(F.first("spans").alias("__spans"))
    hits = hits.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(PATH_SALTS - 1))))
    found = some.withColumn("__salt", F.pmod(F.xxhash64(*docs.columns[:1]), F.lit(PATH_SALTS)).cast("int")).join(hits, ["__blob", "__salt"], "left")
    changed = found.withColumn("__clean", F.when(F.col("__spans").isNotNull(), redact(F.col(text_col), F.col("__spans"), mark)).otherwise(F.col(text_col)))
    cols = {text_col: F.col("__clean")}
    if length_col in docs.columns:
        cols[length_col] = F.when(F.col("__spans").isNotNull(), F.length("__clean").cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return docs.where(~may).unionByName(changed.select(*[cols.get(c, F.col(c)).alias(c) for c in docs.columns]))
