"""Column functions over text. All are built-in expressions, so they stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: null tokens, patterns and phrases that decide the results ---
# Every character that str.isspace() accepts, and the same set inside a (?U) character class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\s\x1c-\x1f"
NULL_TOKENS_NARRATIVE = ["nan", "None", ""]
NULL_TOKENS_TEXT = ["nan", "None", "NaN"]
NULL_TOKENS_FILTER = ["nan", "None"]
NULL_TOKENS_CSV = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# One class instead of an alternation of classes: same characters, no stack growth in the matcher.
URL = r"http[s]?://[!$-_a-z]+"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = rf"(\+?\d{{1,3}}[-.{WS}]?)?\(?\d{{3}}\)?[-.{WS}]?\d{{3}}[-.{WS}]?\d{{4}}"
BOILERPLATE = [
    "i am writing to file a complaint",
    "i am writing to complain",
    "this is a complaint",
    "i would like to file a complaint",
    "i want to file a complaint",
    "please note",
    "please be advised",
    "kindly note",
    "for your information",
    "fyi",
]
SPECIAL = rf"[^a-z0-9{WS}]+"
SPECIAL_KEEP_PUNCTUATION = rf"""[^a-z0-9{WS}.,!?;:'"-]+"""
# -------------------------------------------------------------------------------

# Each boilerplate phrase holds one of these. None has a letter with an irregular case partner
# (s, i, k), so a text without them has no phrase in any spelling and skips all ten replacements.
_BOILERPLATE_HINTS = ["compla", "note", "be adv", "for your", "fy"]


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it.

    Branches of a ``when`` are outside common subexpression elimination, so a chain of guarded
    replacements would compute its first step again for every guard.
    """
    return F.transform(F.array(value), use)[0]


def tokens_to_null(col: Column, tokens: list[str]) -> Column:
    """Null where the value is one of the given tokens."""
    return F.when(~col.isin(tokens), col)


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (plain ``trim`` removes spaces only)."""
    return F.trim(col, F.lit(WHITESPACE))


def collapse_spaces(col: Column) -> Column:
    """Every run of whitespace becomes one space."""
    return F.regexp_replace(col, f"(?U)[{WS}]+", " ")


def normalize_whitespace(col: Column) -> Column:
    """Collapse runs, then drop the at most one space left at each end."""
    return F.trim(collapse_spaces(col))


def is_blank(col: Column) -> Column:
    """True for text that is empty or whitespace only, null for null."""
    return ~col.rlike(f"(?U)[^{WS}]")


def has_text(col: Column) -> Column:
    """Presence in the wide sense: not null and not empty. Never null."""
    return col.isNotNull() & (col != "")


def has_real_text(col: Column) -> Column:
    """Presence in the strict sense: not null, not blank, not a written-out null. Never null."""
    return F.coalesce(~is_blank(col) & ~col.isin(NULL_TOKENS_FILTER), F.lit(False))


def clean_narrative(
    col: Column,
    remove_whitespace: bool = True,
    remove_extra_spaces: bool = True,
    min_length: int = 10,
) -> Column:
    """Null tokens to null, strip, collapse spaces, and null for text that is too short."""
    out = tokens_to_null(col, NULL_TOKENS_NARRATIVE)
    if remove_whitespace and remove_extra_spaces:
        out = normalize_whitespace(out)
    elif remove_whitespace:
        out = strip(out)
    elif remove_extra_spaces:
        out = collapse_spaces(out)
    if min_length > 0:
        out = once(out, lambda t: F.when(F.length(t) >= min_length, t))
    return out


def _replaced_where(col: Column, hint: str, pattern: str) -> Column:
    """Drop what the pattern matches; only texts that contain the hint can match and are searched."""
    return once(
        col, lambda t: F.when(t.contains(hint), F.regexp_replace(t, pattern, "")).otherwise(t)
    )


def remove_urls(col: Column) -> Column:
    return _replaced_where(col, "http", URL)


def remove_emails(col: Column) -> Column:
    return _replaced_where(col, "@", f"(?U){EMAIL}")


def remove_phones(col: Column) -> Column:
    return F.regexp_replace(col, f"(?U){PHONE}", "")


def remove_boilerplate(col: Column) -> Column:
    """Cut the phrases out in order, in any case, also inside words."""

    def cut(text: Column) -> Column:
        hinted = once(
            F.lower(text),
            lambda low: reduce(lambda a, b: a | b, [low.contains(h) for h in _BOILERPLATE_HINTS]),
        )
        shorter = reduce(lambda t, p: F.regexp_replace(t, f"(?iu){p}", ""), BOILERPLATE, text)
        return F.when(hinted, shorter).otherwise(text)

    return once(col, cut)


def remove_special(col: Column, preserve_punctuation: bool = False) -> Column:
    pattern = SPECIAL_KEEP_PUNCTUATION if preserve_punctuation else SPECIAL
    return F.regexp_replace(col, f"(?U){pattern}", "")


def clean_text(
    col: Column,
    lowercase: bool = True,
    special_chars: bool = True,
    boilerplate: bool = True,
    whitespace: bool = True,
    urls: bool = True,
    emails: bool = True,
    phone_numbers: bool = False,
    preserve_punctuation: bool = False,
) -> Column:
    """The full cleaning chain. Text that ends up blank becomes null."""
    out = tokens_to_null(col, NULL_TOKENS_TEXT)
    if lowercase:
        out = F.lower(out)
    if urls:
        out = remove_urls(out)
    if emails:
        out = remove_emails(out)
    if phone_numbers:
        out = remove_phones(out)
    if boilerplate:
        out = remove_boilerplate(out)
    if special_chars:
        out = remove_special(out, preserve_punctuation)
    if whitespace:
        return F.nullif(normalize_whitespace(out), F.lit(""))
    return once(out, lambda t: F.when(~is_blank(t), t))


def word_count(col: Column) -> Column:
    """Number of whitespace-separated words, 0 for null and empty text."""
    words = once(
        strip(col),
        lambda t: F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, f"(?U)[{WS}]+"))),
    )
    return F.when(col.isNotNull(), words).otherwise(F.lit(0))


def char_count(col: Column) -> Column:
    """Number of code points, 0 for null."""
    return F.coalesce(F.length(col), F.lit(0))


def round_even(col: Column, digits: int) -> Column:
    """Round as numpy does: scale, round half to even, scale back."""
    return F.rint(col * float(10**digits)) / float(10**digits)
