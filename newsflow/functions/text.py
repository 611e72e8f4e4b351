r"""HTML to text with JVM-side regular expressions.

Pages are rewritten as a whole string: tags become marker characters, references are decoded, then
white space around the markers is closed up. No page is split into per-row arrays and no parser
runs per row. Python is entered only by the rows whose character references are outside
``COMMON_REFERENCES`` (see ``decode_references``).

Patterns are written for speed: every alternative starts with one literal or one class test, so plain
text costs one test per character; runs of white space are entered at their start only (the
look-behind), and quantifiers over attributes are possessive, which keeps hostile input linear.
"""

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.constants import TOPIC_PHRASES, TOPIC_WORDS

# --- fixed values: Python's notion of white space and of line ends ---------------------------
_SPACE_SET = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)
SPACE = f"[{_SPACE_SET}]"
LINE_END = r"[\n\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029]"
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Unicode noncharacters: character references cannot decode to them.
MARK, PARAGRAPH = "\uffff", "\ufffe"

_COMMENT = r"!--.*?(?:-->|\z)"
_SCRIPT = r"(script|style)(?=[\s>/])[^>]*+>.*?(?:</\1\s*>|\z)"
_TAG = r"""[!/?]?[A-Za-z](?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)"""
INVISIBLE = rf"(?is)<(?:{_SCRIPT}|{_COMMENT})"
MARKUP = rf"(?is)<(?:{_SCRIPT}|{_COMMENT}|{_TAG})"
TAG = rf"(?is)<{_TAG}"
# the attributes of a tag up to its ">": quoted values may hold one; unbalanced quotes are taken as text
_ATTRIBUTES = r"""(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?=>)|[^>]*+)"""

# --- fixed values: references decoded without leaving the JVM; "&amp;" must stay last ---------
COMMON_REFERENCES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "\u00a9"),
    ("&middot;", "\u00b7"),
    ("&amp;", "&"),
)
_COMMON_NAMES = "|".join(re.escape(ref[1:]) for ref, _ in COMMON_REFERENCES)
_OTHER_REFERENCE = rf"&(?!{_COMMON_NAMES})(?:#|[A-Za-z])"


@F.pandas_udf(T.StringType())
def _decode_all(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(_html.unescape, na_action="ignore")


def decode_references(text: Column, source: Column | None = None) -> Column:
    """Decode HTML character references.

    Rows that hold only common references are decoded by native replaces. The others go through one
    Arrow batch function with the full list; rows that do not need it send it null. ``source`` is the
    column ``text`` was made from: testing that one instead lets each row compute ``text`` just once,
    on the side it takes.
    """
    native = text
    for reference, char in COMMON_REFERENCES:
        native = F.replace(native, F.lit(reference), F.lit(char))
    rare = (text if source is None else source).rlike(_OTHER_REFERENCE)
    return F.coalesce(_decode_all(F.when(rare, text)), native)


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def _join_pieces(text: Column) -> Column:
    """Pieces between marks, each trimmed, put together without a separator."""
    return F.array_join(F.transform(F.split(text, MARK), strip), "")


def is_topic(
    title: Column, words: tuple[str, ...] = TOPIC_WORDS, phrases: tuple[str, ...] = TOPIC_PHRASES
) -> Column:
    """True if one of ``words`` stands between white space or one of ``phrases`` occurs anywhere."""
    low = F.lower(title)
    tests = [low.contains(p) for p in phrases]
    if words:
        other = f"[^{_SPACE_SET}]"
        alone = [rf"{w}(?!{other})(?<!{other}{w})" for w in map(re.escape, words)]
        tests.append(low.rlike("|".join(alone)))
    hit = F.lit(False)
    for test in tests:
        hit = hit | test
    return F.coalesce(hit, F.lit(False))


def html_to_text(page: Column) -> Column:
    """Visible text: one line per text piece, no empty lines, double blanks also break lines."""
    text = decode_references(F.regexp_replace(page, MARKUP, "\n"), page)
    breaks = rf"(?={SPACE})(?<!{SPACE}){SPACE}*?(?:{LINE_END}|  ){SPACE}*+"
    return strip(F.regexp_replace(text, breaks, "\n"))


def strip_join(fragment: Column) -> Column:
    """Text pieces of a fragment, each trimmed, joined without a separator."""
    return _join_pieces(decode_references(F.regexp_replace(fragment, MARKUP, MARK), fragment))


def visible_markup(page: Column) -> Column:
    """The page with comments, scripts and styles blanked to a mark, so that selectors see live elements only.

    Tags are matched along, so that a comment inside a quoted value stays; pages without any are left as they are.
    """
    shown = F.regexp_replace(page, rf"(?is)<(?:{_SCRIPT}|{_COMMENT})|(<{_TAG})", "$2" + MARK)
    return F.when(page.rlike(r"(?i)<(?:!--|script|style)"), shown).otherwise(page)


def _open_tag(tag: str, css_class: str | None) -> str:
    """Opening tag without its ``>``. Names are looked for outside quoted values."""
    if css_class is None:
        return rf"<(?i:{tag})(?=[\s>/]){_ATTRIBUTES}"
    name = re.escape(css_class)
    value = (
        rf'"(?:[^"]*\s)?{name}(?:\s[^"]*)?"'
        rf"|'(?:[^']*\s)?{name}(?:\s[^']*)?'"
        rf"|{name}(?=[\s>])"
    )
    before = r"""(?:(?!(?<=\s)(?i:class)\s*=)(?:[^\s>"']++|\s|"[^"]*+"|'[^']*+'))*+"""
    return rf"<(?i:{tag})(?=\s{before}(?i:class)\s*=\s*(?:{value})){_ATTRIBUTES}"


def block_tail(page: Column, tag: str, css_class: str | None = None) -> Column:
    """The page from the end of the first such opening tag on (its ``>`` included), else empty."""
    return F.regexp_extract(page, rf"(?s){_open_tag(tag, css_class)}(>.*)", 1)


def flat_block(tail: Column, tag: str) -> Column:
    """Inner HTML up to the first closing tag, or to the end of the page if there is none."""
    return F.regexp_extract(tail, rf"(?s)\A>(.*?)(?:(?i:</{tag}\s*+>)|\z)", 1)


def nests(flat: Column, tag: str) -> Column:
    """Whether the flat block opens another element of the same name."""
    return flat.rlike(rf"(?i)<{tag}[\s>/]")


def nested_block(tail: Column, tag: str) -> Column:
    """Inner HTML up to the element's own closing tag, inner elements of the same name counted."""
    pieces = F.split(F.substr(tail, F.lit(2)), rf"(?i)(?=<{tag}[\s>/]|</{tag}\s*+>)")
    start = F.struct(F.lit(0).alias("i"), F.lit(1).alias("depth"), F.lit(0).alias("end"))

    def step(acc, piece):
        depth = (
            F.when(piece.rlike(rf"(?i)\A</{tag}\s*+>"), acc["depth"] - 1)
            .when(piece.rlike(rf"(?i)\A<{tag}[\s>/]"), acc["depth"] + 1)
            .otherwise(acc["depth"])
        )
        closed = (acc["end"] == 0) & (depth == 0)
        return F.struct(
            (acc["i"] + 1).alias("i"),
            depth.alias("depth"),
            F.when(closed, acc["i"]).otherwise(acc["end"]).alias("end"),
        )

    end = F.aggregate(pieces, start, step, lambda acc: F.when(acc["end"] > 0, acc["end"]))
    return F.array_join(F.slice(pieces, F.lit(1), F.coalesce(end, F.size(pieces))), "")


def paragraphs(block: Column) -> Column:
    """Paragraph texts joined by a blank line; a paragraph ends at ``</p>`` or at the next ``<p>``."""
    p_open = r"<[pP](?=[\s>/])"
    text = F.regexp_replace(block, INVISIBLE, MARK)
    text = F.regexp_replace(text, rf"(?s)(?:\A|</[pP]\s*+>).*?(?={p_open}|\z)", "")
    text = F.regexp_replace(text, rf"{p_open}{_ATTRIBUTES}>", MARK + PARAGRAPH + MARK)
    text = decode_references(F.regexp_replace(text, TAG, MARK), block)
    text = _join_pieces(text)
    return F.replace(F.substring(text, F.lit(2), F.length(text)), F.lit(PARAGRAPH), F.lit("\n\n"))


def meta_published(page: Column) -> Column:
    """Raw text of the published-time meta tag, empty when there is none."""
    tag = (
        r"""(?s)<(?i:meta)(?=\s[^>]*?(?<=[\s"'])(?i:property)\s*=\s*["']?article:published_time["'\s/>])"""
        r"""(?=\s[^>]*?(?<=[\s"'])(?i:content)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))"""
    )
    return F.regexp_replace(F.regexp_extract(page, tag, 1), r"""\A["']|["']\z""", "")
