"""Validation rules by family.  Every rule yields findings of one shape."""

from importlib import import_module

#: Families in the order in which they run.
MODULES = ("basic", "identity", "time", "geography", "hypotheses", "evidence", "state", "separation")


def load() -> None:
    """Registers the rules of all families."""
    for name in MODULES:
        import_module(f"stratiq.plans.rules.{name}")
