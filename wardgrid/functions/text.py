"""Text expressions, all JVM-side."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

from ..fixed_values import ACCENTED, HEADER_SYNONYMS, UNACCENTED

# Characters a Unicode-aware strip removes (SQL trim only removes spaces).
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(col(value), F.lit(WHITESPACE))


def drop_whitespace(value: Column | str) -> Column:
    return F.translate(col(value), WHITESPACE, "")


def normalize_text(value: Column | str) -> Column:
    """Fold accents, trim, upper-case and collapse inner whitespace."""
    folded = F.upper(F.trim(F.translate(col(value), ACCENTED, UNACCENTED)))
    return F.regexp_replace(folded, r"\s+", " ")


def filled_text(template: str, *values: Column) -> Column:
    """The template with each ``{}`` replaced by a value; null when a value is null."""
    pieces = [F.lit(t) for t in template.split("{}")]
    parts = [p for pair in zip(pieces, [*values, F.lit("")]) for p in pair]
    return F.concat(*parts)


def text_map(entries: dict[str, str]) -> Column:
    """Constant text-to-text map; one literal instead of one per key and value."""
    joined = "\x1e".join(f"{k}\x1f{v}" for k, v in entries.items())
    return F.str_to_map(F.lit(joined), F.lit("\x1e"), F.lit("\x1f"))


@cache
def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit and its ASCII counterpart, by Unicode rule."""
    found = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
    return "".join(found), "".join(str(unicodedata.digit(c)) for c in found)


def ascii_digits(value: Column | str) -> Column:
    """Rewrite digits of other scripts as 0-9; ASCII text is passed through untouched."""
    source, target = _decimal_digits()
    value = col(value)
    return F.when(value.rlike(r"[^\x00-\x7F]"), F.translate(value, source, target)).otherwise(value)


@cache
def _compatibility_letters() -> tuple[str, str, dict[str, str]]:
    """ASCII part of the compatibility decomposition of every non-ASCII character.

    Split into one-to-one foldings (for ``translate``) and longer expansions.
    """
    single_from, single_to, longer = [], [], {}
    for code in range(128, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 128)
        if len(plain) == 1:
            single_from.append(char)
            single_to.append(plain)
        elif plain:
            longer[char] = plain
    return "".join(single_from), "".join(single_to), longer


def to_ascii(value: Column | str) -> Column:
    """Compatibility-decompose and keep the ASCII part ('Atención' -> 'Atencion')."""
    source, target, longer = _compatibility_letters()
    value = col(value)
    folded = F.translate(value, source, target)
    expansions = text_map(longer)
    has_expansion = F.length(F.translate(value, "".join(longer), "")) < F.length(value)
    expanded = F.when(
        has_expansion,
        F.array_join(
            F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(expansions, c), c)), ""
        ),
    ).otherwise(folded)
    cleaned = F.regexp_replace(expanded, r"[^\x00-\x7F]", "")
    return F.when(value.rlike(r"[^\x00-\x7F]"), cleaned).otherwise(value)


def normalize_header(value: Column | str) -> Column:
    """'N° Atenciones ' -> 'n_atenciones'."""
    words = F.regexp_replace(F.lower(to_ascii(value)), "[^a-z0-9]+", "_")
    return F.btrim(words, F.lit("_"))


def canonical_header(value: Column | str, synonyms: dict[str, str] | None = None) -> Column:
    """Normalise a header and resolve it through the synonym dictionary."""
    lookup = text_map(HEADER_SYNONYMS if synonyms is None else synonyms)
    name = normalize_header(value)
    return F.coalesce(F.try_element_at(lookup, name), name)
