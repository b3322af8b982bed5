"""Text functions with Python string semantics, as native column expressions."""

import string
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagelens.functions.stages import computed

# Derived by rule from the Unicode tables: what Python treats as blank or digit.
_CHARACTERS = [chr(code) for code in range(0x20000)]
BLANKS = "".join(c for c in _CHARACTERS if c.isspace())
DIGITS = "".join(c for c in _CHARACTERS if c.isdigit())

# The same blanks as a regular-expression class; those of one byte are listed for a table lookup.
BLANK_CLASS = r"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0\p{IsWhite_Space}]"


def strip(text: Column) -> Column:
    """Remove leading and trailing blanks of any kind."""
    return F.btrim(text, F.lit(BLANKS))


def collapse_blanks(text: Column) -> Column:
    """Every run of blanks becomes one space; no blanks at the ends."""
    return F.btrim(F.regexp_replace(text, BLANK_CLASS + "+", " "), F.lit(" "))


def _count_members(text: Column, members: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, members, ""))


def digit_count(text: Column) -> Column:
    return _count_members(text, DIGITS)


def punctuation_count(text: Column) -> Column:
    """Number of ASCII punctuation marks."""
    return _count_members(text, string.punctuation)


def words(text: Column) -> Column:
    """Blank-separated words, none of them empty."""
    return F.array_remove(F.split(text, BLANK_CLASS + "+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def average_word_length(text: Column) -> Column:
    """Mean word length, 0 without words. The letters of all words together are the text without blanks."""
    letters = F.char_length(F.translate(text, BLANKS, ""))
    return F.coalesce(F.try_divide(letters.cast("double"), word_count(text)), F.lit(0.0))


def model_text(url: Column, title: Column, sep: str = ":") -> Column:
    """Model input: URL and title in one text."""
    return F.concat(url, F.lit(sep), title)


def template_text(domain: Column, path: Column, title: Column) -> Column:
    """Model input with marked parts."""
    return F.format_string("[CLS][DOMAIN]%s[PATH]%s[TITLE]%s[SEP]", domain, path, title)


def split_first(text: Column, sep: str = ":") -> Column:
    """Array of the part before the first separator and the rest."""
    return F.split(text, "\\Q" + sep + "\\E", 2)


def tokens(text: Column, max_length: int | None = 512) -> Column:
    """Lower-case word and punctuation tokens, cut at ``max_length``."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"), F.lit(0))
    return found if max_length is None else F.slice(found, 1, max_length)


# ---------------------------------------------------------------- sanitising
# Readable stand-ins for characters outside ASCII.
WORD_STANDINS = {
    "€": "EUR", "£": "GBP", "¥": "JPY", "©": "(c)", "®": "(R)", "™": "(TM)",
    "…": "...", "«": "<<", "»": ">>", "°": " degrees ",
}
CHARACTER_STANDINS = {
    "•": "*", "—": "-", "–": "-", "‘": "'", "’": "'", "“": '"', "”": '"',
    "¿": "?", "¡": "!",
    "á": "a", "é": "e", "í": "i", "ó": "o", "ú": "u", "ü": "u", "ñ": "n", "ç": "c",
}
# Size limits in characters.
LONG_TEXT = 5000
LONG_TEXT_KEPT = 997


def _ascii_part(character: str) -> str:
    return unicodedata.normalize("NFKD", character).encode("ascii", "ignore").decode("ascii")


def _fold_tables():
    """Characters whose compatibility decomposition has one, or several, ASCII characters."""
    single, several = [], []
    for character in _CHARACTERS[0x80:]:
        if unicodedata.decomposition(character):
            part = _ascii_part(character)
            if len(part) == 1:
                single.append((character, part))
            elif part:
                several.append(ord(character))
    return single, several


def _class_covering(codes, gap=8):
    """Regular-expression class of ranges that covers the code points; small gaps are closed."""
    ranges = []
    for code in codes:
        if ranges and code - ranges[-1][1] <= gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    listed = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    return r"[\x{80}-\x{10FFFF}&&[" + listed + "]]"


_SINGLE, _SEVERAL = _fold_tables()
_SEVERAL_CLASS = _class_covering(_SEVERAL)


@F.pandas_udf(T.StringType())
def _fold_with_python(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFKD").str.replace(r"[^\x00-\x7f]+", "", regex=True)


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def map_characters(text: Column) -> Column:
    mapped = text
    for character, standin in WORD_STANDINS.items():
        mapped = F.replace(mapped, F.lit(character), F.lit(standin))
    mapped = F.translate(mapped, "".join(CHARACTER_STANDINS), "".join(CHARACTER_STANDINS.values()))
    return F.when(is_ascii(text), text).otherwise(mapped)


def line_breaks_to_blanks(text: Column) -> Column:
    return F.translate(text, "\n\r\t", "   ")


def fold_structures(text: Column) -> Column:
    """Dumped arrays and objects become short markers."""
    text = F.regexp_replace(text, r"Array\s*\([^)]*\)", "[array]")
    return F.regexp_replace(text, r"\{[^}]*\}", "[object]")


def fold_to_ascii(text: Column) -> Column:
    """NFKD, then ASCII only. Decompositions into one ASCII character are native; the few characters
    with longer ones go through an Arrow function, which sees NULL for all other rows."""
    native = F.regexp_replace(
        F.translate(text, "".join(c for c, _ in _SINGLE), "".join(p for _, p in _SINGLE)),
        r"[^\x00-\x7F]+", "")
    rare = ~is_ascii(text) & text.rlike(_SEVERAL_CLASS)
    return (F.when(is_ascii(text), text)
            .when(rare, _fold_with_python(F.when(rare, text)))
            .otherwise(native))


def drop_markup(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", " ")


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x1F]+", "")


def double_quotes(text: Column) -> Column:
    return F.replace(text, F.lit('"'), F.lit('""'))


def drop_all_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x1F\x7F]+", "")


def shorten_long(text: Column) -> Column:
    return F.when(F.char_length(text) > LONG_TEXT,
                  F.concat(F.substring(text, 1, LONG_TEXT_KEPT), F.lit("..."))).otherwise(text)


def with_sanitised(df: DataFrame, *names: str, csv_quotes: bool = True) -> DataFrame:
    """The whole cleaning chain for text columns; NULL and empty give an empty text.

    The chain is cut into stages where a step reads its input more than once, so that nothing is
    computed twice.
    """
    def stage(frame, step):
        return frame.withColumns({name: step(F.col(name)) for name in names})

    df = stage(df, lambda c: F.coalesce(c, F.lit("")))
    df = stage(df, lambda c: fold_structures(line_breaks_to_blanks(map_characters(c))))
    df = stage(df, fold_to_ascii)
    df = stage(df, lambda c: collapse_blanks(drop_controls(drop_markup(c))))
    df = stage(df, lambda c: drop_all_controls(double_quotes(c) if csv_quotes else c))
    return computed(stage(df, shorten_long), *names)
