"""Text forms used at the display edge, as SQL text."""

from __future__ import annotations


def joined(values: str, separator: str = ",") -> str:
    """A list as sorted, separated text; NULL stays NULL."""
    return f"array_join(array_sort({values}), '{separator}')"


def short_number(value: str) -> str:
    """``7.5`` and ``30`` rather than ``30.0``."""
    return f"regexp_replace(cast({value} AS string), '[.]0$', '')"
