"""Links and card listings in a table of web pages (page_id, url, html)."""

from __future__ import annotations

import html as character_names
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradebinder.functions.text import strip

# Fixed value: the "name (CODE number)" text of a card link.
CARD_TEXT = r"^(.*?)\s*\(([A-Za-z0-9]+)\s+([^)]+)\)"

# The inside of a tag: quoted values may hold any character, also a closing bracket.
_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# Comments, elements whose content is no page text, and (kept, as group 2) every other tag.
HIDDEN = rf"(?is)<!--.*?(?:--!?>|\z)|<(script|style|textarea|title|template)\b{_INSIDE}>.*?(?:</\1\s*>|\z)|(</?[a-z]{_INSIDE}>)"
# An anchor's attributes and its content, which ends with the anchor, the next one or the page;
# other tags are matched, too, so that nothing inside them is taken for an anchor.
ANCHOR = rf"(?is)<(?!a[\s/>])/?[a-z]{_INSIDE}>|<a(?=[\s/>])({_INSIDE})>(.*?)(?=</a\s*>|<a[\s/>]|\z)"
BASE = rf"(?is)<base(?=[\s/>])({_INSIDE})>"
TAG = rf"(?is)</?[a-z]{_INSIDE}>|<[!?][^>]*>"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
# The first attribute of that name, after any others.
HREF = rf"(?is)^(?:[\s/]+(?!href[\s=])[^\s=/>]+(?:{_VALUE.replace('(', '(?:').replace('(?:?:', '(?:')})?+)*+[\s/]*href{_VALUE}"
# A character reference: hexadecimal, decimal or named.
REFERENCE = r"^(#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;?)"
# Names that also count without a semicolon have at most so many letters.
_SHORT_NAMES = sorted({len(n) for n in character_names.entities.html5 if not n.endswith(";")}, reverse=True)


def _table(values: dict) -> Column:
    """A constant map of characters, folded once."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _numbered(number: Column) -> Column:
    """The character of a code point; the forbidden ones are replaced as browsers do."""
    replaced = {str(n): c for n, c in character_names._invalid_charrefs.items()}
    lone = number.isNull() | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    one = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(lone, "\ufffd").otherwise(F.coalesce(F.try_element_at(_table(replaced), number.cast("string")), one))


def decoded(text: Column, attribute: bool = False) -> Column:
    """The text with all character references replaced, named and numeric ones, as a browser does.

    In attributes a name without semicolon counts only if no letter, digit or equals sign follows.
    """
    named = _table(dict(character_names.entities.html5))

    def one(piece: Column) -> Column:
        found = F.regexp_extract(piece, REFERENCE, 1)
        rest = F.substr(piece, F.length(found) + 1)
        digits = F.regexp_extract(found, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
        base16 = found.rlike("^#[xX]")
        # More than seven digits are beyond any character.
        number = F.when(F.length(digits) <= 7, F.conv(F.when(digits == "", "0").otherwise(digits), 16, 10)).cast("long")
        ten = F.when(F.length(digits) <= 8, F.when(digits == "", "0").otherwise(digits)).try_cast("long")
        numeric = F.concat(_numbered(F.when(base16, number).otherwise(ten)), rest)
        whole = F.concat(F.try_element_at(named, found), rest)
        open_end = F.lit(False) if not attribute else rest.startswith("=") & ~found.endswith(";")
        prefixes = [F.concat(F.try_element_at(named, F.left(found, F.lit(n))), F.substr(piece, F.lit(n + 1))) for n in _SHORT_NAMES]
        named_text = F.when(~open_end, F.coalesce(whole, *([] if attribute else prefixes)))
        as_written = F.concat(F.lit("&"), piece)
        return F.coalesce(F.when(found.startswith("#"), numeric).when(found != "", named_text), as_written)

    pieces = F.split(text, "&")
    joined = F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), one), ""))
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def _address(attributes: Column) -> Column:
    """The decoded address among the attributes of a tag; null without one."""
    value = F.concat(*[F.coalesce(F.regexp_extract(attributes, HREF, n), F.lit("")) for n in (1, 2, 3)])
    return F.when(attributes.rlike(HREF), decoded(value, attribute=True))


def page_links(pages: DataFrame) -> DataFrame:
    """Every link as (page_id, page_url, position, href, link_text) the way a browser shows it.

    Comments and scripts hold no links, tags inside a link count for nothing, references are
    decoded, blank runs in the text are collapsed.  page_url is what addresses are relative to:
    the page's own, or that of its base element.
    """
    shown = F.regexp_replace("html", HIDDEN, "$2")
    groups = [F.regexp_extract_all("shown", F.lit(ANCHOR), F.lit(n)).alias(name) for n, name in ((1, "attributes"), (2, "text"))]
    anchors = F.filter(F.arrays_zip(*groups), lambda a: a["attributes"].rlike(HREF))
    links = pages.select("page_id", "url", shown.alias("shown"))
    base = F.when(F.lower("shown").contains("<base"), _address(F.regexp_extract("shown", BASE, 1)))
    links = links.select("page_id", "url", base.alias("base"), F.posexplode(anchors).alias("position", "link"))
    return links.select(
        "page_id",
        F.when(F.col("base").isNull(), F.col("url")).otherwise(absolute_url(F.col("base"), F.col("url"))).alias("page_url"),
        "position",
        _address(F.col("link.attributes")).alias("href"),
        strip(F.regexp_replace(decoded(F.regexp_replace("link.text", TAG, "")), r"(?U)\s+", " ")).alias("link_text"),
    )


def _without_dots(path: Column) -> Column:
    """A path with "." and ".." resolved; one that ends in either ends in a slash."""
    parts = F.split(path, "/")

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 1, 1), step)
    closed = F.when(path.rlike(r"(?:^|/)\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.array_join(kept, "/"), closed)).otherwise(path)


def absolute_url(href, page_url):
    """The address a link leads to from a page: fragments, queries, roots, hosts and dot segments."""
    # Browsers drop blanks around an address and line breaks and tabs in it.
    href = F.regexp_replace(F.regexp_replace(href, r"[\t\n\r]", ""), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    page = F.regexp_extract(page_url, r"^([^#]*)", 1)
    scheme = F.regexp_extract(page, r"^([a-zA-Z]+:)", 1)
    origin = F.regexp_extract(page, r"^([a-zA-Z]+://[^/?]+)", 1)
    path = F.regexp_extract(page, r"^[a-zA-Z]+://[^/?]+([^?]*)", 1)
    path = F.when(path == "", "/").otherwise(path)
    target, behind = F.regexp_extract(href, r"^([^?#]*)", 1), F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    rooted = F.when(target.startswith("/"), target).otherwise(F.concat(F.regexp_extract(path, r"^(.*/)", 1), target))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href == "", page)
        .when(href.startswith("#"), F.concat(page, href))
        .when(href.startswith("?"), F.concat(origin, path, href))
        .when(href.startswith("//"), F.concat(scheme, href))
        .otherwise(F.concat(origin, _without_dots(rooted), behind))
    )


def resolved_links(pages: DataFrame) -> DataFrame:
    """page_links with the address each of them leads to (url)."""
    links = page_links(pages)
    return links.withColumn("url", absolute_url(F.col("href"), F.col("page_url")))


def distinct_links(links: DataFrame) -> DataFrame:
    """One row per (href, link_text): how often it occurs and where first and last.

    A navigation link may stand on every page; the aggregate is combined before the
    shuffle, so such a group never sits in one task.
    """
    return links.groupBy("href", "link_text").agg(
        F.count("*").alias("occurrences"),
        F.min("page_id").alias("first_page_id"),
        F.max("page_id").alias("last_page_id"),
    )


def card_links(pages: DataFrame, path_part: str, set_name: str) -> DataFrame:
    """Cards named in links below a path: text "name (CODE number)" is split, other links
    are dropped, and a card listed twice (same code, number and address) keeps its first
    place and its last text."""
    links = page_links(pages).filter(F.contains(F.col("href"), F.lit(path_part)))
    cards = links.select(
        F.struct("page_id", "position").alias("place"),
        F.trim(F.regexp_extract("link_text", CARD_TEXT, 1)).alias("card_name"),
        F.trim(F.regexp_extract("link_text", CARD_TEXT, 2)).alias("set_code"),
        F.trim(F.regexp_extract("link_text", CARD_TEXT, 3)).alias("card_number"),
        absolute_url(F.col("href"), F.col("page_url")).alias("url"),
    ).filter(F.col("set_code") != "")
    return (
        cards.groupBy("set_code", "card_number", "url")
        .agg(F.max_by("card_name", "place").alias("card_name"), F.min("place").alias("place"))
        .select(
            "card_name",
            F.lit(set_name).alias("set_name"),
            "set_code",
            "card_number",
            "url",
            "place",
        )
    )
