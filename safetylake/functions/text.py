"""Text normalisation as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as the characters themselves and as a regex class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}"
    r"\x{205F}\x{3000}]"
)


def strip(c: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_filled(c: Column) -> Column:
    """True for text that is neither NULL nor blank (never NULL itself)."""
    return c.isNotNull() & (strip(c) != "")


def term_key(c: Column) -> Column:
    """Term as the warehouse views compare it: trimmed and upper-cased."""
    return F.upper(strip(c))


def normalize_pt(c: Column) -> Column:
    """Upper-cased, trimmed, inner white space collapsed; NULL becomes ''."""
    return F.coalesce(
        F.regexp_replace(term_key(c), SPACE_CLASS + "+", " "), F.lit("")
    )


def normalize_sex(c: Column) -> Column:
    v = F.lower(strip(c))
    return (
        F.when(v.isin("m", "male"), F.lit("male"))
        .when(v.isin("f", "female"), F.lit("female"))
        .otherwise(F.lit("unknown"))
    )


def normalize_product(c: Column) -> Column:
    """Letters and digits of a product name, upper-cased, one blank between words."""
    words = F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")
    return F.coalesce(F.upper(F.btrim(words)), F.lit(""))


def phrase_key(c: Column) -> Column:
    """Words of a phrase, upper-cased, one blank between them (any script)."""
    return F.btrim(F.regexp_replace(F.upper(c), r"[^\p{L}\p{N}]+", " "))
