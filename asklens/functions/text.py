"""Column functions for pages, URLs and delimited text.

All are compositions of built-in ``pyspark.sql.functions`` (JVM side, inside
whole-stage codegen); none needs a Python UDF.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The crawler's HTML-tag pattern.  Its class is: digits, word
# characters, whitespace and ; : ' " , . / ? ! @ # $ % ^ & * ( ) - _ = +
# (so tags holding [ ] { } | ~ survive).  The reference runs it under Python's
# Unicode classes; Java's \d \w \s are ASCII, so they are spelled out here:
# \w = letters, numbers, underscore; \s = Python's whitespace set.
PY_SPACE = r"\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}"
TAG_PATTERN = r"<[\p{L}\p{N}_" + PY_SPACE + r";:'\",./?!@#$%^&*()\-=+]+/*>"

# URL shapes the crawler routes on (host-agnostic paths).
PROFILE_URL = r"/people/.*/following$"
FOLLOW_API_URL = r"/members/.*/followees?"

# Delimiters of the crawler's text records.
FIELD_SEP = "---"
KV_SEP = ":::"

# Python's int(): optional blanks, optional sign, decimal digits of any script, single underscores between digits.
INT_TEXT = r"^\s*[+-]?[0-9]+(?:_[0-9]+)*\s*$"
_DIGITS = [c for c in map(chr, range(0x80, 0x20000)) if unicodedata.decimal(c, None) is not None]
ANY_DIGITS, ASCII_DIGITS = "".join(_DIGITS), "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_tags(col) -> Column:
    return F.regexp_replace(_c(col), TAG_PATTERN, "")


def drop_newlines(col) -> Column:
    return F.replace(_c(col).cast("string"), F.lit("\n"), F.lit(""))


def url_route(col) -> Column:
    """'profile' / 'follow_api' / 'other', first matching pattern wins."""
    u = _c(col)
    return (F.when(u.rlike(PROFILE_URL), "profile")
            .when(u.rlike(FOLLOW_API_URL), "follow_api")
            .otherwise("other"))


def url_token(col) -> Column:
    """User token of a profile URL (after /people/, before /following) or of a
    follow-API URL (after /members/, before /followees?); null otherwise (H15)."""
    u = _c(col)
    people = F.substring_index(F.substring_index(u, "/people/", -1), "/following", 1)
    members = F.substring_index(F.substring_index(u, "/members/", -1), "/followees?", 1)
    return (F.when(u.rlike(PROFILE_URL), people)
            .when(u.rlike(FOLLOW_API_URL), members))


def query_param(col, name: str) -> Column:
    """Value of a URL query parameter, null when absent or the URL is malformed."""
    return F.try_parse_url(_c(col), F.lit("QUERY"), F.lit(name))


def tolerant_int(col) -> Column:
    """Python ``int(text)`` or null: blanks, a sign, ``1_000`` and digits of other scripts allowed, '12.5' is not an
    int (B9).  A number beyond 64 bits is null too; ``too_large_int`` tells it apart."""
    c = _ascii_digits(col)
    return F.when(c.rlike(INT_TEXT), F.replace(F.trim(c), F.lit("_"), F.lit("")).try_cast("bigint"))


def too_large_int(col) -> Column:
    """True where Python's ``int(text)`` works but 64 bits do not hold it: rows for a reject table."""
    return F.coalesce(_ascii_digits(col).rlike(INT_TEXT) & tolerant_int(col).isNull(), F.lit(False))


def _ascii_digits(col) -> Column:
    return F.translate(_c(col).cast("string"), ANY_DIGITS, ASCII_DIGITS)


def org_token(col) -> Column:
    """Organisation URL -> token after the last '/org/'; other ids unchanged."""
    return F.element_at(F.split(_c(col), "/org/"), -1)


SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def site_root(url_col) -> Column:
    return F.regexp_extract(_c(url_col), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def _without_dots(path: Column, rooted: Column) -> Column:
    """A path without ``.`` and ``..`` segments and, unless the link was ``rooted``, doubled slashes, as ``urljoin`` does it."""
    parts = F.split(path, "/", -1)
    last = F.element_at(parts, -1)
    # the first and the last segment may be empty: a slash at either end
    inner = F.filter(parts, lambda x, i: rooted | (x != "") | (i == 0) | (i == F.size(parts) - 1))
    kept = F.aggregate(inner, F.array().cast("array<string>"), lambda out, x: F.when(
        x == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(x == ".", out).otherwise(F.concat(out, F.array(x))))
    joined = F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    # a ".." above the root takes the root's own empty segment with it
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def absolute_url(href_col, page_url_col) -> Column:
    """A link resolved against its page's URL, like a browser or ``urljoin`` (H20):
    absolute links stay, ``//host/x`` takes the page's scheme, ``/x`` its site,
    ``?q`` and ``#f`` its path, anything else its directory.  Dot segments (``../``)
    and, where the directory is taken, doubled slashes are removed."""
    href, url = _c(href_col), _c(page_url_col)
    no_frag = F.regexp_replace(url, "#.*$", "")
    no_query = F.regexp_replace(url, "[?#].*$", "")
    root = site_root(url)
    directory = F.regexp_replace(F.substring(no_query, F.length(root) + 1, F.length(no_query)), "[^/]*$", "")
    path = F.regexp_extract(href, "^([^?#]*)", 1)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    merged = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.when(directory == "", F.lit("/")).otherwise(directory), path))
    tidy = F.when(merged.rlike(r"//|(?:^|/)\.\.?(?:/|$)"), _without_dots(merged, path.startswith("/"))).otherwise(merged)
    return (F.when(href.rlike(SCHEME), href)
            .when(href.startswith("//"), F.concat(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
            .when(href == "", url)
            .when(href.startswith("?"), F.concat(no_query, href))
            .when(href.startswith("#"), F.concat(no_frag, href))
            .otherwise(F.concat(root, tidy, rest)))


# The HTML names of the characters U+00A0 to U+00FF, in order, and of some others.
LATIN_1 = (
    "nbsp iexcl cent pound curren yen brvbar sect uml copy ordf laquo not shy reg macr deg plusmn sup2 sup3 acute micro para "
    "middot cedil sup1 ordm raquo frac14 frac12 frac34 iquest Agrave Aacute Acirc Atilde Auml Aring AElig Ccedil Egrave Eacute "
    "Ecirc Euml Igrave Iacute Icirc Iuml ETH Ntilde Ograve Oacute Ocirc Otilde Ouml times Oslash Ugrave Uacute Ucirc Uuml "
    "Yacute THORN szlig agrave aacute acirc atilde auml aring aelig ccedil egrave eacute ecirc euml igrave iacute icirc iuml "
    "eth ntilde ograve oacute ocirc otilde ouml divide oslash ugrave uacute ucirc uuml yacute thorn yuml").split()
OTHER_NAMES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "AMP": "&", "LT": "<", "GT": ">", "QUOT": '"', "OElig": "Œ", "oelig": "œ",
    "Scaron": "Š", "scaron": "š", "Yuml": "Ÿ", "ensp": "\u2002", "emsp": "\u2003", "thinsp": "\u2009", "zwnj": "\u200c",
    "zwj": "\u200d", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "sbquo": "‚", "ldquo": "“", "rdquo": "”",
    "bdquo": "„", "bull": "•", "hellip": "…", "lsaquo": "‹", "rsaquo": "›", "euro": "€", "trade": "™"}
ENTITY = r"&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,7};|(?:amp|lt|gt|quot)(?![A-Za-z0-9]))"


def unescape(col) -> Column:
    """Character references decoded: decimal, hexadecimal, and the names of Latin-1 and of common marks; others stay."""
    c = _c(col)
    names = {name: chr(160 + i) for i, name in enumerate(LATIN_1)} | OTHER_NAMES
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])

    def one(e: Column) -> Column:
        body = F.regexp_replace(e, "[&;]", "")
        number = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 8), 16, 10)).when(
            body.startswith("#"), F.substring(body, 2, 8)).cast("int")
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        legal = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        return F.when(legal, char).when(number.isNotNull(), F.lit("\ufffd")).otherwise(F.coalesce(F.try_element_at(known, body), e))

    found = F.transform(F.regexp_extract_all(c, F.lit(ENTITY), F.lit(0)), one)
    return F.when(c.contains("&"), F.array_join(F.flatten(F.zip_with(
        F.split(c, ENTITY, -1), found, lambda text, char: F.array(text, F.coalesce(char, F.lit(""))))), "")).otherwise(c)


# What a page's parser does not look into: comments, scripts, styles.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s>/])[^>]*>.*?(?:</\1\s*>|\z)"
# A tag's attributes: a ">" between quotes does not end the tag.
ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# Anchor in any case, its href anywhere among the attributes and quoted either way or not; elements inside.
ANCHOR = rf"(?is)<a(?=[\s/>])({ATTRIBUTES})>(.*?)</a\s*>"
TAG = rf"(?is)</?[a-z](?:{ATTRIBUTES})>"
ATTRIBUTE = r"""(?is)[^\s"'<>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""


def anchors(html_col) -> Column:
    """array<struct<href, text>> of the anchors of a page that have an href, in page order; the text without its elements.

    Comments, scripts and styles are not read, a ``>`` in a quoted attribute ends nothing, character
    references are decoded in link and text.  The page is searched once; the parts come from each anchor alone."""
    h = _c(html_col)
    readable = F.when(h.rlike(r"(?i)<!--|<script|<style"), F.regexp_replace(h, UNREAD, "")).otherwise(h)

    def href(anchor: Column) -> Column:
        pairs = F.regexp_extract_all(F.regexp_extract(anchor, ANCHOR, 1), F.lit(ATTRIBUTE), F.lit(0))
        own = F.get(F.filter(pairs, lambda x: x.rlike(r"(?is)^href\s*=")), F.lit(0))
        return F.regexp_replace(F.regexp_replace(own, r"(?is)^href\s*=\s*", ""), r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2")

    found = F.transform(F.regexp_extract_all(readable, F.lit(ANCHOR), F.lit(0)), lambda a: F.struct(
        unescape(href(a)).alias("href"), unescape(F.regexp_replace(F.regexp_extract(a, ANCHOR, 2), TAG, "")).alias("text")))
    return F.filter(found, lambda x: x["href"].isNotNull())


def encode_record(*pairs: tuple[str, Column]) -> Column:
    """``k:::v---k:::v`` line of (key, column) pairs."""
    return F.concat_ws(FIELD_SEP, *[F.concat(F.lit(k + KV_SEP), v.cast("string")) for k, v in pairs])


def decode_record(col) -> Column:
    """map<string,string> of a ``k:::v---k:::v`` line; single '-' inside values survive."""
    return F.str_to_map(_c(col), F.lit(FIELD_SEP), F.lit(KV_SEP))


def ledger_id(col) -> Column:
    """Id of a ledger line ``id``, ``id:::n`` or ``id:::ERROR``."""
    return F.split(F.trim(_c(col)), KV_SEP).getItem(0)
