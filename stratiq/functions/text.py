"""Text functions: column expressions over labels, citations, ids and paragraphs.

Everything here is built from JVM-side functions.  White space means Unicode
white space (``(?U)\\s``), as plain ``trim`` only knows U+0020.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Id prefixes of the ledger's record families.
ID_PREFIXES = (
    "SEC", "PASSAGE", "MENTION", "SRC", "NAME", "TAXCONCEPT", "CLADE", "LINEAGE", "POP", "SPECIMEN", "SITE",
    "REGION", "OCC", "TRAIT", "TRAITOBS", "GENE", "ALLELE", "EVENT", "CLAIM", "EVID", "DATASET", "ANALYSIS",
    "RESULT", "HYP", "TAXVIEW", "PHYVIEW", "CAMP", "CHAPTER", "MECH", "GAME", "ISSUE", "TERM", "TIME",
    "TECH", "ECOSYS", "METHOD", "MOL", "RESEARCHER", "CONFLICT",
)
ID_PATTERN = r"\b(" + "|".join(ID_PREFIXES) + r")-[0-9]{6}\b"
LONG_ID_PATTERN = ID_PATTERN.replace("{6}", "{6,}")  # also of ids past the millionth, which are not well-formed but lead to their records

#: Accents, quotes and dashes that comparison ignores (NFKD without marks, for Latin script).
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüçñýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇÑÝ’‘“”–—−"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY''\"\"---"


def squeeze(text: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def folded(text: Column) -> Column:
    """Lower case with single spaces: labels that differ no further are the same."""
    return F.lower(squeeze(text))


def comparison_key(text: Column) -> Column:
    """Key under which spellings are compared: accents, emphasis marks, quote and
    dash variants, case and spacing are set aside."""
    bare = F.translate(text, "*_`", "")
    return folded(F.translate(bare, ACCENTED, PLAIN))


def measure_name(text: Column) -> Column:
    """Name of a measure in snake case without Spanish accents."""
    return F.translate(F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", "")), "- áéíóúñ", "__aeioun")


def core_and_qualifier(key: Column, qualifiers: str) -> tuple[Column, Column]:
    """The key without trailing qualifiers (a regular expression), and what was
    cut off; a key that is all qualifier is left alone."""
    core = squeeze(F.regexp_replace(key, rf"(?:\s*(?:{qualifiers}))+$", ""))
    kept = F.when(core == "", key).otherwise(core)
    return kept, F.when(core == "", F.lit(None).cast("string")).otherwise(F.nullif(squeeze(F.substr(key, F.length(core) + 1)), F.lit("")))


def blank(text: Column) -> Column:
    return text.isNull() | (squeeze(text) == "")


def carries_number(text: Column) -> Column:
    return F.coalesce(text.rlike("[0-9]"), F.lit(False))


def vague_measure(text: Column, recognised: tuple[str, ...], vague: tuple[str, ...]) -> Column:
    """A measure that is not recognised and whose name holds a vague word."""
    name = measure_name(text)
    return ~name.isin(*recognised) & F.exists(F.array(*[F.lit(v) for v in vague]), lambda t: F.contains(name, t))


def discard_reason(text: Column, gaps: tuple[str, ...] = ("-", "—", "–", "n/a", "?")) -> Column:
    """Why a cell is no label: empty, gap mark, local key or no letters; else null."""
    t = squeeze(F.coalesce(text, F.lit("")))
    return (
        F.when(t == "", "empty").when(F.lower(t).isin(*gaps), "gap").when(t.rlike(r"^[A-Z]{1,3}-?[0-9]+$"), "key").when(~t.rlike(r"\p{L}"), "no letters")
    )


def note_reason(text: Column, openers: tuple[str, ...], most: int = 5) -> Column:
    """Why a fragment is a note and not a name: too many words, or it opens with
    a closed-class word; else null."""
    words = F.split(folded(text), " ")
    return F.when(F.size(words) > most, "long").when(F.element_at(words, 1).isin(*openers), "opener")


def meaningfully_contained(short: Column, long: Column) -> Column:
    """``short`` stands in ``long`` as whole words, or (five letters or more) as a
    glued prefix followed by an upper-case letter."""
    whole = F.contains(F.concat(F.lit(" "), long, F.lit(" ")), F.concat(F.lit(" "), short, F.lit(" ")))
    glued = (F.length(short) >= 5) & F.startswith(long, short) & F.substr(long, F.length(short) + 1, F.lit(1)).rlike(r"\p{Lu}")
    return whole | glued


def extends_binomially(short: Column, long: Column) -> Column:
    """``long`` is ``short`` and lower-case epithets: a species under its genus."""
    rest = F.substr(long, F.length(short) + 2)
    return F.startswith(long, F.concat(short, F.lit(" "))) & F.forall(F.split(rest, " "), lambda w: w.rlike("^[a-z][a-z-]+$"))


def differ_in_digits_only(a: Column, b: Column) -> Column:
    masked = lambda c: F.regexp_replace(c, "[0-9]+", "#")
    return (a != b) & a.rlike("[0-9]") & b.rlike("[0-9]") & (masked(a) == masked(b))


def common_prefix_length(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    upto = F.least(F.length(a), F.length(b))
    same = F.filter(F.sequence(F.lit(0), upto), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i))
    return F.array_max(same)


def near(a: Column, b: Column, most: int) -> Column:
    """Edit distance at most ``most``."""
    return F.levenshtein(a, b, most).between(0, most)


def deletions(text: Column, most: int = 1) -> Column:
    """The text and all texts with up to ``most`` characters left out: strings
    within that edit distance share one of these."""
    def cuts(one: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(one), F.lit(1))), lambda i: F.concat(F.substr(one, F.lit(1), i - 1), F.substr(one, i + 1)))

    found = F.array(text)
    for _ in range(most):
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, cuts))))
    return found


def key_tokens(key: Column) -> Column:
    """Pieces of a snake-case key."""
    return F.filter(F.split(F.lower(key), "[^a-z0-9]+"), lambda t: t != "")


def ids_in(text: Column, pattern: str = ID_PATTERN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def id_prefix(ident: Column) -> Column:
    return F.substring_index(ident, "-", 1)


def well_formed_id(ident: Column) -> Column:
    return F.coalesce(ident.rlike("^(" + "|".join(ID_PREFIXES) + ")-[0-9]{6}$"), F.lit(False))


def citations(text: Column, letter: str = "C", most: int = 400) -> Column:
    """All citations ``C-n`` in a text, distinct.  A range ``C-a–C-b`` stands for
    what lies between, at the width of its first number; one that is reversed
    or longer than ``most`` stands for its ends only."""
    pattern = rf"\b{letter}-([0-9]+)(?:\s*[–-]\s*{letter}-([0-9]+))?"
    first = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    last = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))

    def label(n: Column, width: Column) -> Column:
        digits = n.cast("string")
        return F.concat(F.lit(f"{letter}-"), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, 12, "0").substr(F.lit(13) - width, width)))

    def expand(a: Column, b: Column) -> Column:
        lo, hi = a.cast("long"), F.when(b == "", a).otherwise(b).cast("long")
        ok = (hi >= lo) & (hi - lo <= most)
        full = F.transform(F.sequence(lo, F.when(ok, hi).otherwise(lo)), lambda n: label(n, F.length(a)))
        return F.when(ok, full).otherwise(F.array(F.concat(F.lit(f"{letter}-"), a), F.concat(F.lit(f"{letter}-"), b)))

    return F.array_distinct(F.flatten(F.zip_with(first, last, expand)))


def mask_citations(text: Column, letter: str = "C") -> Column:
    return F.regexp_replace(text, rf"\b{letter}-[0-9]+", f"{letter}-#")


def message_template(message: Column) -> Column:
    """A message with its ids and line numbers masked."""
    return F.regexp_replace(F.regexp_replace(message, r"\b[A-Z]+-[0-9]{6}\b", "<ID>"), r":[0-9]+", ":N")


def content_hash(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def paragraphs(text: Column, breaks: str = r"\n[ \t\r\f]*\n\s*") -> Column:
    """Paragraphs with their offsets in code points: array of (start, end, text).

    Separators are paired with the pieces between them, so offsets are those of
    the source whatever the separators' lengths.  Empty pieces are left out.
    """
    pieces = F.split(text, breaks, -1)
    gaps = F.concat(F.regexp_extract_all(text, F.lit(breaks), F.lit(0)), F.array(F.lit("")))
    kind = "array<struct<start:int,end:int,text:string>>"
    begin = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))
    both = F.zip_with(pieces, gaps, lambda p, g: F.struct(p.alias("p"), F.length(g).alias("g")))

    def step(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.length(x["p"])
        one = F.array(F.struct(acc["at"].alias("start"), end.alias("end"), x["p"].alias("text")))
        return F.struct((end + x["g"]).alias("at"), F.when(squeeze(x["p"]) == "", acc["out"]).otherwise(F.concat(acc["out"], one)).alias("out"))

    return F.aggregate(both, begin, step, lambda acc: acc["out"])


def mentions(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` with offsets: array of (start, end, text)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    kind = "array<struct<start:int,end:int,text:string>>"
    begin = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))
    both = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).alias("gap"), m.alias("m")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text")))).alias("out"))

    return F.aggregate(both, begin, step, lambda acc: acc["out"])


def locate(label: Column, passage: Column) -> Column:
    """Where a label stands in a passage: (start, end, note).  Exactly and as
    whole words; else without regard to case; else the whole passage."""
    quoted = F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.replace(label, F.lit("\\E"), F.lit("")), F.lit(r"\E(?!\w)"))
    exact = F.regexp_instr(passage, quoted)
    loose = F.regexp_instr(passage, F.concat(F.lit("(?iu)"), quoted))
    at = F.when(exact > 0, exact).when(loose > 0, loose)
    return F.struct(
        F.coalesce(at - 1, F.lit(0)).alias("start"),
        F.coalesce(at - 1 + F.length(label), F.length(passage)).alias("end"),
        F.when(exact > 0, F.lit(None).cast("string")).when(loose > 0, "case differs").otherwise("not found: whole passage").alias("note"),
    )


def short_citation(authors: Column, year: Column) -> Column:
    """"First et al. 2004", "A y B 2004" or "A 2004" from a list of "Surname, Name"."""
    surname = lambda i: F.split(F.element_at(authors, i), ",")[0]
    names = F.when(F.size(authors) > 2, F.concat(F.try_element_at(F.transform(authors, lambda a: F.split(a, ",")[0]), F.lit(1)), F.lit(" et al."))).when(F.size(authors) == 2, F.concat_ws(" y ", surname(1), surname(2))).when(F.size(authors) == 1, surname(1)).otherwise("s. a.")
    return F.concat_ws(" ", names, F.coalesce(year.cast("string"), F.lit("s. f.")))


def review_mark(line: Column) -> Column:
    """``- [x] D-0001 … ;; note`` as (mark, decision, note); null if it is no such line."""
    pattern = r"^\s*-\s*\[(.)\]\s*(D-[0-9]+)\b[^;]*(?:;;\s*(.*))?$"
    get = lambda i: F.regexp_extract(line, pattern, i)
    return F.when(line.rlike(pattern), F.struct(F.lower(get(1)).alias("mark"), get(2).alias("decision"), F.nullif(get(3), F.lit("")).alias("note")))


def next_version(previous: Column, changed: Column) -> Column:
    """SemVer with its minor number raised if the content changed; 1.0.0 at first."""
    parts = F.split(previous, r"\.")
    raised = F.concat_ws(".", parts[0], (parts[1].cast("int") + 1).cast("string"), F.lit("0"))
    return F.when(previous.isNull(), "1.0.0").when(changed, raised).otherwise(previous)


def version_order(version: Column) -> Column:
    """Sort key of a SemVer: its numbers."""
    return F.transform(F.split(version, r"\."), lambda p: F.try_to_number(p, F.lit("999999")).cast("int"))


def numeric_suffix(ident: Column) -> Column:
    """Number at the end of an id; null without one."""
    return F.regexp_extract(ident, r"([0-9]+)$", 1).try_cast("long")


def iso_date(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.lit(False)) & F.try_to_date(text, "yyyy-MM-dd").isNotNull()


def safe_embed(text: Column) -> Column:
    """Text that can stand in a script element."""
    return F.replace(text, F.lit("</"), F.lit("<\\/"))


def html_escape(text: Column) -> Column:
    out = text
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def clipped(text: Column, most: int) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substr(text, F.lit(1), F.lit(most - 1)), F.lit("…"))).otherwise(text)


def hypothesis_code(description: Column) -> Column:
    """The short code that a conversion leaves in a description; null if none."""
    return F.nullif(F.regexp_extract(description, r"\((H[0-9]+) del corredor\)", 1), F.lit(""))


@F.pandas_udf(StringType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def proposal_form(text: Column) -> Column:
    """Composed (NFC), trimmed, white space collapsed; case and accents stay.  Only
    texts that hold more than ASCII pass the composition."""
    return squeeze(F.when(text.rlike(r"[^\x00-\x7F]"), _composed(text)).otherwise(text))
