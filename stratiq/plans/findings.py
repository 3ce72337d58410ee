"""The findings contract and the registry of rules.

A rule is a function from a ledger (family name to DataFrame) to a DataFrame
with ``severity``, ``record_id`` and optionally ``file``, ``other_id``, ``detail``.
A run is the union of all rules; it is fine if no finding is an ERROR.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("severity", "family", "rule", "file", "record_id", "other_id", "detail")
Ledger = dict[str, DataFrame]


@dataclass(frozen=True)
class Rule:
    family: str
    name: str
    check: Callable[[Ledger], DataFrame]


RULES: dict[str, Rule] = {}
#: Families that are announced but not built yet: each gives one INFO finding.
PENDING: dict[str, str] = {}


def rule(family: str, name: str) -> Callable:
    """Registers a rule."""
    def add(check: Callable[[Ledger], DataFrame]) -> Callable:
        RULES[name] = Rule(family, name, check)
        return check

    return add


def shaped(df: DataFrame, family: str, name: str) -> DataFrame:
    have = set(df.columns)
    cols = {"family": F.lit(family), "rule": F.lit(name)}
    return df.select(*[(cols[c] if c in cols else F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in COLUMNS])


def found(df: DataFrame, when: Column, severity: str | Column, detail: str | Column = "", other: Column | None = None) -> DataFrame:
    """Findings on the rows of ``df`` (with ``id``) for which ``when`` holds."""
    sev = F.lit(severity) if isinstance(severity, str) else severity
    text = F.lit(detail) if isinstance(detail, str) else detail
    file = F.col("file") if "file" in df.columns else F.lit(None).cast("string")
    return df.where(F.coalesce(when, F.lit(False))).select(sev.alias("severity"), file.alias("file"), F.col("id").alias("record_id"), (other if other is not None else F.lit(None).cast("string")).alias("other_id"), text.alias("detail"))


def both(*parts: DataFrame) -> DataFrame:
    """Union of findings."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run(data: Ledger, families: tuple[str, ...] | None = None) -> DataFrame:
    """All findings of the given families (all by default)."""
    from stratiq.plans.rules import load

    load()
    out = None
    for r in RULES.values():
        if families is None or r.family in families:
            part = shaped(r.check(data), r.family, r.name)
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise KeyError(f"no rule in {families}")
    return out


def verdict(findings: DataFrame) -> bool:
    """True if nothing blocks."""
    return findings.where("severity = 'ERROR'").isEmpty()
