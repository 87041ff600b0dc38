"""Text functions: word splitting, Java-style tokens, Unicode normal forms.

All splitting is a JVM regular expression inside the plan, and normal forms are
made in the JVM too, on *distinct* words that are not ASCII, never per token.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's tokenizer):
# the separator set is ASCII punctuation (Python's ``string.punctuation``)
# plus every character Python's ``re`` treats as ``\s`` in a str pattern.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def _class_body() -> str:
    """The separator set as a regex class body of code-point ranges (a short
    class is much faster in Java's engine than one entry per character)."""
    points = sorted({ord(ch) for ch in PUNCTUATION} | set(WHITESPACE_CODEPOINTS))
    ranges, start, prev = [], points[0], points[0]
    for cp in points[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        ranges.append((start, prev))
        if cp is not None:
            start = prev = cp
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}"
                   for a, b in ranges)


# One or more separators. Valid in Java regex (Spark) and RE2 (DuckDB).
WORD_SEPARATOR = "[" + _class_body() + "]+"


def split_raw(text: Column | str) -> Column:
    """Lower-case, then split on runs of punctuation or whitespace. A leading
    or trailing separator yields an empty string; exploding this and filtering
    ``<> ''`` afterwards keeps the whole step in generated code."""
    return F.split(F.lower(F.col(text) if isinstance(text, str) else text), WORD_SEPARATOR)


# Fixed values (the JVM's word-break rules, as observed on java.text.BreakIterator),
# written without look-around so that Java and RE2 read them alike: signs that
# join two letters, that join two digits, that lead a number (currency signs
# but the cent, # and .) and that end one; marks and format signs stay with
# the letter or digit before them.
_MARK = r"\p{Mn}\p{Me}\p{Cf}"
_MID_LETTER = r"[\p{Pd}\p{Pc}\"'.\x{ad}\x{2027}]"
_MID_NUMBER = r"[\"',.\x{66b}]"
_CURRENCY = "".join(f"\\x{{{c:x}}}" for c in range(0x110000)
                    if unicodedata.category(chr(c)) == "Sc" and c != 0xA2)
_PREFIX = f"[#.{_CURRENCY}]"
_SUFFIX = r"[%&\x{a2}\x{2030}\x{66a}]"


def _locale_token(keep: str) -> str:
    """One left-to-right alternation: a word with the numbers and words glued to
    it, the same led by a number, a number alone, a stray mark, any other sign.

    ``keep`` is ``"+"`` for possessive loops, which the JVM runs without
    recursion (a word may have any length), or ``""`` for the plain ones of RE2.
    No loop ever has to give back what it took: what may follow it cannot
    start with anything that the loop takes."""
    marks = f"[{_MARK}]*{keep}"
    letters = rf"[\p{{L}}\p{{Mc}}][\p{{L}}\p{{Mc}}{_MARK}]*{keep}"
    digits = rf"\p{{N}}[\p{{N}}{_MARK}]*{keep}"
    word = f"{letters}(?:{_MID_LETTER}{marks}{letters})*{keep}"
    number = f"{digits}(?:{_MID_NUMBER}{marks}{digits})*{keep}"
    return "|".join([
        f"{word}(?:{number}{word})*{keep}(?:{number}{_SUFFIX}?)?",
        f"{_PREFIX}?(?:{number}{word})+{keep}(?:{number}{_SUFFIX}?)?",
        f"{_PREFIX}?{number}{_SUFFIX}?",
        f"[{_MARK}]",
        rf"[^\s\p{{Z}}\x{{1c}}-\x{{1f}}\x{{85}}]{marks}",
    ])


LOCALE_TOKEN = _locale_token("+")
#: The same tokens for engines without possessive loops (DuckDB's RE2).
LOCALE_TOKEN_RE2 = _locale_token("")


def locale_tokens(text: Column | str, keep_punctuation: bool = True) -> Column:
    """Tokens by the JVM's word-break rules (English), case kept: words,
    numbers and, unless told otherwise, every other sign that is not space."""
    col = F.col(text) if isinstance(text, str) else text
    tokens = F.regexp_extract_all(col, F.lit(LOCALE_TOKEN), 0)
    return tokens if keep_punctuation else F.filter(tokens, lambda t: t.rlike(r"[\p{L}\p{N}]"))


def normal_form(col: Column, form: str = "NFD") -> Column:
    """Unicode normal form of a text, made in the JVM by the ICU library that
    Spark brings for its collations. (Grouping by ``COLLATE UNICODE`` would not
    do: it also takes words for equal that differ in ignorable signs.)"""
    if form not in ("NFC", "NFD", "NFKC", "NFKD"):
        raise ValueError(f"no normal form {form}")
    call = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose" if form.endswith("C") else "decompose"),
                     col, F.lit("K" in form))
    # ASCII is its own normal form, and nulls stay
    return F.when(col.isNull() | is_ascii(col), col).otherwise(call)


def is_ascii(col: Column) -> Column:
    """ASCII text, which every normal form leaves as it is."""
    return F.octet_length(col) == F.length(col)
