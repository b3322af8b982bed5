"""HTTP payload and HTML functions as native column expressions.

Regular pages are handled by regular expressions inside code generation. Two kinds of rare row go
through an Arrow function that sees NULL for every other row: texts with entities outside the
common set, and pages whose hidden elements are nested in their own kind or not closed.
"""

import html as _html
from collections import Counter
from html.entities import name2codepoint
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pagelens.functions import text as tx
from pagelens.functions.stages import computed

# Elements whose whole content is invisible, and markers of XML bodies.
RAW_HIDDEN = ["script", "style"]
HIDDEN = ["nav", "footer", "header", "aside", "form"]
XML_STARTS = ["<?xml", "<rss"]

# Elements that never have content.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}

# Named entities decoded natively, and the numbers (160 to 54999) that stand for themselves.
# The map is searched from its start, so the frequent names come first.
_FREQUENT = ["amp", "nbsp", "quot", "lt", "gt", "copy", "rsquo", "lsquo", "ndash", "mdash", "middot", "raquo", "laquo"]
ENTITIES = {name: chr(name2codepoint[name]) for name in sorted(name2codepoint, key=lambda n: (n not in _FREQUENT, n))}
ENTITIES["apos"] = "'"
_NUMBER = r"#(?:1[6-9]\d|[2-9]\d\d|[1-9]\d{3}|[1-4]\d{4}|5[0-4]\d{3})"

_TAG = r"""</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[!?][^>]*>|</?[A-Za-z][^>]*>"""


# ------------------------------------------------------------------- payload
def decode(payload: Column) -> Column:
    """Bytes as UTF-8 text, bad sequences become U+FFFD."""
    return F.make_valid_utf8(payload.cast("string"))


def _header_end(content: Column) -> Column:
    return F.locate("\r\n\r\n", content)


def header_block(content: Column) -> Column:
    """Text before the first empty line, '' if there is none (or nothing before it)."""
    end = _header_end(content)
    return F.when(end > 1, F.substring(content, F.lit(1), end - 1)).otherwise("")


def body(content: Column) -> Column:
    end = _header_end(content)
    return F.when(end > 1, F.substring(content, end + 4, F.char_length(content))).otherwise(content)


def header(block: Column, name: str) -> Column:
    """Trimmed value of the last header line with this name, '' if there is none."""
    prefix = name.lower() + ":"
    lines = F.filter(F.split(block, "\r\n"), lambda line: F.startswith(F.lower(line), F.lit(prefix)))
    last = F.get(F.reverse(lines), F.lit(0))
    return F.coalesce(tx.strip(F.substring(last, len(prefix) + 1, 2**31 - 1)), F.lit(""))


def is_xml(page: Column) -> Column:
    start = F.ltrim(page, F.lit(tx.BLANKS))
    test = F.lit(False)
    for marker in XML_STARTS:
        test = test | F.startswith(start, F.lit(marker))
    return test


# ------------------------------------------------------------------ entities
@F.pandas_udf(T.StringType())
def _unescape_with_python(texts: pd.Series) -> pd.Series:
    return texts.map(_html.unescape, na_action="ignore")


# An ampersand that may start a reference, but none of those above.
_RARE_ENTITY = "&(?!(?:" + "|".join(ENTITIES) + "|" + _NUMBER + ");)[#A-Za-z]"


def _decoded_piece(piece: Column) -> Column:
    """What stands behind an ampersand, with the reference at its start replaced."""
    end = F.locate(";", piece)
    name = F.substring(piece, F.lit(1), end - 1)
    named = F.try_element_at(F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair]), name)
    code = F.hex(F.substring(name, 2, 6).try_cast("int"))
    numbered = F.when(name.rlike(f"^{_NUMBER}$"), F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32"))
    character = F.coalesce(named, numbered)
    return F.when(character.isNull(), F.concat(F.lit("&"), piece)).otherwise(
        F.concat(character, F.substring(piece, end + 1, F.char_length(piece))))


def decode_entities(text: Column) -> Column:
    """Character references to characters, each decoded once: the text is cut at its ampersands and
    each piece looked up. Texts with other references go through the Arrow function."""
    pieces = F.split(text, "&")
    native = F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(_decoded_piece(p))), "")
    rare = text.rlike(_RARE_ENTITY)
    return (F.when(~F.contains(text, F.lit("&")), text)
            .when(rare, _unescape_with_python(F.when(rare, text)))
            .otherwise(native))


# ------------------------------------------------------------------ elements
def raw_title(page: Column) -> Column:
    """Content of the first title element, '' if there is none."""
    return F.regexp_extract(page, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    groups = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.concat(*groups)


def raw_meta_description(page: Column) -> Column:
    """Content of the first meta tag named "description", else of the first one with the property
    "og:description"; '' if there is none."""
    tags = F.regexp_extract_all(page, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0))
    named = F.filter(tags, lambda t: _attribute(t, "name") == "description")
    shared = F.filter(tags, lambda t: _attribute(t, "property") == "og:description")
    chosen = F.coalesce(F.get(named, F.lit(0)), F.get(shared, F.lit(0)), F.lit(""))
    return _attribute(chosen, "content")


def drop_hidden(page: Column) -> Column:
    """Comments and elements that show no text are cut out of the page.

    The search for an end stops where an element of the same kind begins, so a page of unclosed elements
    is read once per kind; what is left of it goes to the parser.
    """
    raw = "|".join(RAW_HIDDEN)
    page = F.regexp_replace(page, rf"(?is)<!--.*?(?:-->|\z)|<({raw})\b[^>]*>.*?(?:</\1\s*>|\z)", " ")
    return F.regexp_replace(page, rf"(?is)<({'|'.join(HIDDEN)})\b[^>]*>(?:(?!<\1\b).)*?</\1\s*>", " ")


def has_irregular_hidden(rest: Column) -> Column:
    """After ``drop_hidden``: some hidden element was nested in its own kind or was not closed."""
    return rest.rlike(rf"(?i)</?(?:{'|'.join(HIDDEN)})\b")


def drop_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, "(?s)" + _TAG, " ")


class _VisibleText(HTMLParser):
    """Collects the text outside hidden elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.pieces = [], []
        self.skip = set(HIDDEN) | set(RAW_HIDDEN)
        self.n_open, self.n_skipped = Counter(), 0  # Open elements of each tag, and of those that show no text.

    def handle_starttag(self, tag, attrs):
        if tag not in _VOID:
            self.open.append(tag)
            self.n_open[tag] += 1
            self.n_skipped += tag in self.skip

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        last = None
        while last != tag and self.n_open[tag]:
            last = self.open.pop()
            self.n_open[last] -= 1
            self.n_skipped -= last in self.skip

    def handle_data(self, data):
        if not self.n_skipped:
            self.pieces.append(data)


def visible_text_with_python(page: str) -> str:
    parser = _VisibleText()
    parser.feed(page)
    parser.close()
    return " ".join(" ".join(parser.pieces).split())


@F.pandas_udf(T.StringType())
def _visible_text_udf(pages: pd.Series) -> pd.Series:
    return pages.map(visible_text_with_python, na_action="ignore")


def first_sentences(text: Column, n: int = 2) -> Column:
    """First ``n`` sentences; a sentence ends with '.', '!' or '?' before a blank."""
    parts = F.split(text, r"(?<=[.!?])" + tx.BLANK_CLASS + "+", n + 1)
    return F.array_join(F.slice(parts, 1, n), " ")


# The functions below work on a DataFrame: each stage is computed once and read several times by the next.
def with_title(df: DataFrame, page: str = "html", out: str = "title") -> DataFrame:
    df = df.withColumn(out, raw_title(F.col(page)))
    return computed(df.withColumn(out, tx.strip(decode_entities(F.col(out)))), out)


def with_meta_description(df: DataFrame, page: str = "html", out: str = "meta_description") -> DataFrame:
    df = df.withColumn(out, raw_meta_description(F.col(page)))
    return computed(df.withColumn(out, decode_entities(F.col(out))), out)


def with_visible_text(df: DataFrame, page: str = "html", out: str = "visible_text") -> DataFrame:
    """Visible text of a page; the title comes first."""
    df = df.withColumn(out, drop_hidden(F.col(page)))
    df = df.withColumn("_irregular", has_irregular_hidden(F.col(out)))
    df = df.withColumn(out, F.when(~F.col("_irregular"), drop_tags(F.col(out))))
    parsed = _visible_text_udf(F.when(F.col("_irregular"), F.col(page)))
    df = df.withColumn(out, F.when(F.col("_irregular"), parsed)
                       .otherwise(tx.collapse_blanks(decode_entities(F.col(out)))))
    return df.drop("_irregular")


def with_snippet(df: DataFrame, page: str = "html", out: str = "snippet", sentences: int = 2) -> DataFrame:
    df = with_visible_text(df, page, out)
    return computed(df.withColumn(out, first_sentences(F.col(out), sentences)), out)
