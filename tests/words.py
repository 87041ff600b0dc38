"""Expected words, built sign by sign (no regular expression)."""

import itertools
import unicodedata


def is_separator(sign: str) -> bool:
    ascii_mark = ord(sign) < 128 and not sign.isalnum() and sign.isprintable()
    return ascii_mark or sign.isspace()


def expected_words(text: str, form: str | None = None) -> list[str]:
    runs = itertools.groupby(text.lower(), key=is_separator)
    words = ["".join(run) for gap, run in runs if not gap]
    return [unicodedata.normalize(form, w) for w in words] if form else words
