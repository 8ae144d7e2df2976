"""Pieces of DuckDB SQL that several oracles share."""

from narrata.functions.text import BOILERPLATE, EMAIL, URL

# The whitespace set written as ranges, which both regular expression engines read alike.
WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
PHONE = rf"(\+?\d{{1,3}}[-.{WS}]?)?\(?\d{{3}}\)?[-.{WS}]?\d{{3}}[-.{WS}]?\d{{4}}"
SPECIAL = rf"[^a-z0-9{WS}]"
SPECIAL_KEEP_PUNCTUATION = rf"""[^a-z0-9{WS}.,!?;:'"-]"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def replaced(x: str, pattern: str, by: str = "", flags: str = "g") -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(by)}, '{flags}')"


def stripped(x: str) -> str:
    return replaced(x, rf"^[{WS}]+|[{WS}]+\z")


def normalized(x: str) -> str:
    return f"trim({replaced(x, f'[{WS}]+', ' ')})"


def not_blank(x: str) -> str:
    return f"regexp_matches({x}, '[^{WS}]')"


def real_text(x: str) -> str:
    return f"({x} IS NOT NULL AND {not_blank(x)} AND {x} NOT IN ('nan', 'None'))"


def has_text(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '[{WS}]+'), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"CAST(CASE WHEN {has_text(x)} THEN len({words(x)}) ELSE 0 END AS INTEGER)"


def rounded(x: str, digits: int) -> str:
    """Halves to the even digit, as numpy rounds."""
    scale = 10**digits
    return f"(round_even(CAST({x} AS DOUBLE) * {scale}, 0) / {scale})"


def clean_narrative(x: str) -> str:
    body = normalized(f"CASE WHEN {x} NOT IN ('nan', 'None', '') THEN {x} END")
    return f"(CASE WHEN length({body}) >= 10 THEN {body} END)"


def without_boilerplate(x: str) -> str:
    for phrase in BOILERPLATE:
        x = replaced(x, phrase, "", "gi")
    return x


def clean_text(x: str) -> str:
    out = f"lower(CASE WHEN {x} NOT IN ('nan', 'None', 'NaN') THEN {x} END)"
    for pattern in (URL, EMAIL):
        out = replaced(out, pattern)
    out = replaced(without_boilerplate(out), SPECIAL)
    return f"nullif({normalized(out)}, '')"


def text_result(x: str, source: str, key: str = "doc_id") -> str:
    """A text column as hash and length, which keeps results small."""
    return (
        f"SELECT {key}, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS text_length "
        f"FROM (SELECT {key}, {x} AS t FROM {source})"
    )


__all__ = [
    "BOILERPLATE", "EMAIL", "PHONE", "SPECIAL", "SPECIAL_KEEP_PUNCTUATION", "URL", "WS", "quoted",
    "replaced", "stripped", "normalized", "not_blank", "real_text", "has_text", "words",
    "word_count", "rounded", "clean_narrative", "without_boilerplate", "clean_text", "text_result",
]
