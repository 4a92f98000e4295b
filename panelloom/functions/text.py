"""Symbols and labels."""

from pyspark.sql import functions as F

from panelloom.schema import SYMBOL_CHANGES


def clean_symbol(col):
    """Outer white space and inner blanks removed, dots to dashes; null stays null."""
    outer = F.regexp_replace(col, r"(?U)^\s+|\s+$", "")
    return F.translate(outer, ". ", "-")


def remap_symbol(col, changes=SYMBOL_CHANGES):
    """Old symbols to their successors, all others unchanged."""
    column = F.col(col) if isinstance(col, str) else col
    pairs = [F.lit(x) for pair in changes.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


def clean_label(col):
    """Dashes to blanks, one blank between words, capitalised words, a lone ``&`` to ``And``."""
    words = F.trim(F.regexp_replace(F.translate(col, "-", " "), r"(?U)\s+", " "))
    return F.regexp_replace(F.initcap(words), r"(?<![^ ])&(?![^ ])", "And")
