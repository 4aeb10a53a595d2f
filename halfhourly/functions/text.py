"""Text, number and HTML column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# HTML elements whose content is no page text, then one link or
# table part each.  The patterns hold for both Java and RE2 matching.
HIDDEN_HTML = r"(?is)<(?:!--.*?--|script\b.*?</script|style\b.*?</style)>"
ANCHOR = r"(?is)<a\s[^>]*>.*?</a>"
HREF = r"""(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
TABLE = r"(?is)<table\b.*?</table>"
NESTED_TABLE = r"(?is)<table\b(?:(?!</table).)*?<table\b"
TABLE_ROW = r"(?is)<tr\b.*?</tr>"
TABLE_CELL = r"(?is)<t[dh]\b.*?</t[dh]>"
TAG = r"(?s)<[^>]*>"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&amp;", "&"))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def squeeze_blanks(col: Column | str) -> Column:
    """Runs of blanks made single, outer blanks cut off."""
    return F.trim(F.regexp_replace(_c(col), " +", " "))


def base_name(path: Column | str) -> Column:
    """The part of a path after its last slash."""
    return F.substring_index(_c(path), "/", -1)


def decode_link(col: Column | str) -> Column:
    """A link with its coded slashes written as slashes."""
    return F.replace(_c(col), F.lit("%2F"), F.lit("/"))


def word(col: Column | str, position: int, separator: str = " ") -> Column:
    """The n-th part of a text, from the end when negative; null when there is none."""
    return F.try_element_at(F.split(_c(col), separator), F.lit(position))


def first_word(col: Column | str) -> Column:
    return F.substring_index(_c(col), " ", 1)


def last_word(col: Column | str) -> Column:
    return F.substring_index(_c(col), " ", -1)


def digit_runs(col: Column | str) -> Column:
    """Every run of digits in a text, as an array."""
    return F.regexp_extract_all(_c(col), F.lit(r"(\d+)"), F.lit(1))


def clean_number(col: Column | str) -> Column:
    """Number with thousands commas; empty and a lone dash are missing, the sign stays."""
    text = F.trim(F.replace(_c(col), F.lit(","), F.lit("")))
    return F.when((text != "") & (text != "-"), text.try_cast("double"))


def strip_unit(col: Column | str, letters: int = 2) -> Column:
    """Number without the unit of ``letters`` characters at its end; empty is missing."""
    text = _c(col)
    return F.when(F.length(text) > letters,
                  F.trim(F.left(text, F.length(text) - letters)).try_cast("double"))


def unescape_html(col: Column | str) -> Column:
    text = plain = _c(col)
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.when(plain.contains("&"), text).otherwise(plain)


def visible_html(col: Column | str) -> Column:
    """HTML without comments, scripts and styles.

    The pattern tries every character; a page without the letters that a match begins with is told faster.
    """
    html = _c(col)
    plain = ~(html.contains("<!--") | html.contains("<s") | html.contains("<S"))
    return F.when(plain, html).otherwise(F.regexp_replace(html, HIDDEN_HTML, ""))


def html_text(col: Column | str) -> Column:
    """The text of an HTML fragment: tags removed, entities resolved."""
    text = F.regexp_replace(_c(col), TAG, "")
    return unescape_html(text)


def spread(array: Column, *names: str) -> tuple[Column, Column]:
    """An array as numbered rows, and the filter that drops the row of an empty one.

    The inner form of the generator makes Spark test the array before it is spread,
    which works an expression such as a parsed page out twice.
    """
    return F.posexplode_outer(array).alias(*names), F.col(names[0]).isNotNull()


def anchors(html: Column | str) -> Column:
    """Array of the ``<a>`` elements of a page."""
    return F.regexp_extract_all(visible_html(html), F.lit(ANCHOR), F.lit(0))


def href_of(anchor: Column | str) -> Column:
    """Address of one ``<a>`` element, empty when it has none."""
    raw = F.regexp_extract(_c(anchor), HREF, 1)
    return unescape_html(F.regexp_replace(raw, r"""^["']|["']$""", ""))
