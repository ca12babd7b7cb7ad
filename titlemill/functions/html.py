"""Signals of an HTML page as column expressions."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column, functions as F

from titlemill.functions.text import let, nz, strip

MAX_BODY = 3000
MIN_PARAGRAPH = 40

# Elements whose start or end closes an open paragraph.
BLOCK_TAGS = [
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul",
]

# The kinds of page markup that name an organisation.
ORGANISATION_TYPES = ["NewsMediaOrganization", "Organization", "WebSite", "NewsArticle"]

_TAG = r"<[a-zA-Z/!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>?"
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
_BLOCK = r"(?i)(?=</?(?:" + "|".join(BLOCK_TAGS) + r")(?![a-z0-9-]))"
_ENTITY = r"&(?=(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);)"
# The HTML 4 names and one more that page parsers know.
_NAMED = json.dumps(
    {"apos": "'"} | {name: chr(code) for name, code in html.entities.name2codepoint.items()}
)


def _character(code: Column) -> Column:
    known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(F.lit(0xFFFD))), 8, "0"))
    return F.decode(utf32, "UTF-32")


def _entity(name: Column) -> Column:
    decimal = F.regexp_extract(name, r"\A#([0-9]+)\z", 1)
    hexadecimal = F.regexp_extract(name, r"\A#[xX]([0-9a-fA-F]+)\z", 1)
    return (
        F.when(decimal != "", _character(decimal.cast("bigint")))
        .when(hexadecimal != "", _character(F.conv(hexadecimal, 16, 10).cast("bigint")))
        .otherwise(
            F.coalesce(
                F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), name),
                F.concat(F.lit("&"), name, F.lit(";")),
            )
        )
    )


def unescape(text: Column) -> Column:
    """Decode character references in one pass, so `&amp;lt;` gives `&lt;`."""

    def piece(part: Column, position: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        rest = F.substr(part, F.length(name) + 2)
        return F.when(position == 0, part).otherwise(F.concat(_entity(name), rest))

    def decode(bound: Column) -> Column:
        return F.when(
            F.contains(bound, F.lit("&")),
            F.array_join(F.transform(F.split(bound, _ENTITY), piece), ""),
        ).otherwise(bound)

    return let(text, decode)


def _may_hold(page: Column, *tags: str) -> Column:
    """False where no tag of `page` begins like one of `tags`. Looks for bytes only, so that the
    patterns below are spared the pages they cannot match."""
    starts = sorted({f"<{c}" for tag in tags for c in (tag[0].lower(), tag[0].upper())})
    found = F.contains(page, F.lit(starts[0]))
    for start in starts[1:]:
        found = found | F.contains(page, F.lit(start))
    return found


def visible(page: Column) -> Column:
    """The page without comments, scripts and style sheets."""
    hidden = _may_hold(page, "!--", "script", "style")
    return F.when(hidden, F.regexp_replace(page, _HIDDEN, " ")).otherwise(page)


def _text_nodes(fragment: Column) -> Column:
    nodes = F.transform(F.split(fragment, _TAG), lambda t: strip(unescape(t)))
    return F.filter(nodes, lambda t: t != "")


def page_title(page: Column) -> Column:
    """Text of the first `<title>`; empty if there is none."""
    return let(visible(page), title_of)


def title_of(clean: Column) -> Column:
    """`page_title` of a page that `visible` has been applied to."""
    title = F.regexp_extract(clean, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    absent = ~_may_hold(clean, "title")
    return F.when(absent, "").otherwise(strip(unescape(title)))


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)[\s\"'/]{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"

    def unquoted(value: Column) -> Column:
        quoted = F.substring(value, 1, 1).isin('"', "'")
        return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)

    return let(F.regexp_extract(tag, pattern, 1), unquoted)


def meta_content(page: Column, attribute: str, value: str) -> Column:
    """`content` of the first `<meta>` whose `attribute` equals `value`; empty if missing."""
    return let(meta_tags(visible(page)), lambda tags: meta_of(tags, attribute, value))


def meta_tags(clean: Column) -> Column:
    """All `<meta>` tags of a page that `visible` has been applied to."""
    tags = F.regexp_extract_all(
        clean, F.lit(r"(?i)<meta\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"), F.lit(0)
    )
    absent = ~_may_hold(clean, "meta")
    return F.when(absent, F.array().cast("array<string>")).otherwise(tags)


def meta_of(tags: Column, attribute: str, value: str) -> Column:
    """`meta_content` from the tags of a page."""
    named = F.filter(tags, lambda t: unescape(_attribute(t, attribute)) == value)
    return F.coalesce(strip(unescape(_attribute(F.get(named, F.lit(0)), "content"))), F.lit(""))


def organisation_markup(page: Column) -> Column:
    """`name`, `description`, `url` of the first linked-data block about an organisation.

    NULL if no block qualifies; blocks that are not valid JSON are passed over, as are blocks
    inside comments.
    """
    blocks = F.regexp_extract_all(
        F.regexp_replace(page, r"(?is)(<script\b.*?</script\s*>)|<!--.*?-->", "$1"),
        F.lit(
            r"(?is)<script\b[^>]*\stype\s*=\s*[\"']?application/ld\+json[\"']?(?:\s[^>]*)?>"
            r"(.*?)</script\s*>"
        ),
        F.lit(1),
    )

    def read(block: Column) -> Column:
        return let(F.try_parse_json(block), describe)

    def describe(parsed: Column) -> Column:
        first = F.try_variant_get(parsed, "$[0]", "variant")
        return let(F.coalesce(first, parsed), fields)

    def fields(node: Column) -> Column:
        kinds = F.try_variant_get(node, "$['@type']", "array<string>")
        kind = F.try_variant_get(node, "$['@type']", "string")
        listed = F.exists(kinds, lambda k: k.isin(*ORGANISATION_TYPES))
        named = F.lit(False)
        for wanted in ORGANISATION_TYPES:
            named = named | F.contains(kind, F.lit(wanted))
        return F.struct(
            F.coalesce(F.when(kinds.isNotNull(), listed).otherwise(named), F.lit(False)).alias("hit"),
            F.try_variant_get(node, "$.name", "string").alias("name"),
            F.try_variant_get(node, "$.description", "string").alias("description"),
            F.try_variant_get(node, "$.url", "string").alias("url"),
        )

    first = F.get(F.filter(F.transform(blocks, read), lambda b: b["hit"]), F.lit(0))
    return F.when(_may_hold(page, "script"), first)


# The containers searched for paragraphs, best first. Each holds one bit of a segment's mask;
# paragraphs anywhere in the page are the last resort.
_CONTAINERS = [
    ("name", "main"),
    ("name", "article"),
    ("role", "main"),
    ("class", "content"),
    ("id", "content"),
    ("name", "section"),
]
_ANYWHERE = 1 << len(_CONTAINERS)


def _opened(tag: Column, name: Column) -> Column:
    """Bits of the containers this start tag opens."""
    mask = F.lit(0)
    for position, (kind, value) in enumerate(_CONTAINERS):
        if kind == "name":
            opens = name == value
        elif kind == "class":
            opens = F.array_contains(F.split(_attribute(tag, "class"), r"\s+"), value)
        else:
            opens = _attribute(tag, kind) == value
        if kind != "name":
            # Few tags mention the value at all; only those are taken apart.
            opens = F.contains(tag, F.lit(value)) & opens
        mask = mask + F.when(opens, F.lit(1 << position)).otherwise(F.lit(0))
    return mask


def _segment(part: Column) -> Column:
    is_end = F.startswith(part, F.lit("</"))

    def named(head: Column) -> Column:
        name = F.lower(F.regexp_extract(head, r"\A</?([a-zA-Z][a-zA-Z0-9]*)", 1))
        return let(name, lambda n: described(head, n))

    def described(head: Column, name: Column) -> Column:
        paragraph = F.when((name == "p") & ~is_end, let(_text_nodes(part), joined))
        return F.struct(
            name.alias("name"),
            is_end.alias("is_end"),
            F.when(is_end, F.lit(0)).otherwise(_opened(head, name)).alias("opened"),
            paragraph.alias("text"),
        )

    def joined(nodes: Column) -> Column:
        kept = F.length(F.array_join(nodes, "")) > MIN_PARAGRAPH
        return F.when(kept, F.array_join(nodes, " "))

    return let(F.regexp_extract(part, r"\A" + _TAG, 0), named)


def _telling(segments: Column) -> Column:
    """The segments a walk depends on: paragraphs, and the tags whose name opens a container."""
    names = F.transform(F.filter(segments, lambda s: s["opened"] > 0), lambda s: s["name"])

    def kept(opening: Column) -> Column:
        return F.filter(
            segments, lambda s: s["text"].isNotNull() | F.array_contains(opening, s["name"])
        )

    return let(F.array_distinct(names), kept)


def _walk(segments: Column) -> Column:
    """Joined paragraph texts, one per container in their order and last of all paragraphs.

    Each text is cut to what the result can hold, so a step costs the same however long the page.
    `open` lists the open containers, outermost first, with the elements of the same name inside
    them (needed to find which end tag closes a container). It stays a few entries long.
    """
    start = F.struct(
        F.from_json(F.lit("[]"), "array<struct<name:string,mask:int>>").alias("open"),
        F.array_repeat(F.lit(""), len(_CONTAINERS) + 1).alias("texts"),
    )
    bits = F.array(*[F.lit(1 << position) for position in range(len(_CONTAINERS) + 1)])

    def added(texts: Column, mask: Column, text: Column) -> Column:
        def grow(new: Column) -> Column:
            def grown(own: Column, bit: Column) -> Column:
                fits = (new["mask"].bitwiseAND(bit) != 0) & (F.length(own) < MAX_BODY)
                joined = F.when(own == "", new["text"]).otherwise(F.concat(own, F.lit(" "), new["text"]))
                return F.when(fits, joined).otherwise(own)

            return F.zip_with(texts, bits, grown)

        return let(F.struct(mask.alias("mask"), text.alias("text")), grow)

    def step(state: Column, segment: Column) -> Column:
        opened, texts = state["open"], state["texts"]
        tracked = F.exists(opened, lambda o: o["name"] == segment["name"])
        mask = F.aggregate(opened, F.lit(_ANYWHERE), lambda m, o: m.bitwiseOR(o["mask"]))
        depth = F.array_position(
            F.reverse(F.transform(opened, lambda o: o["name"])), segment["name"]
        ).cast("int")
        after = (
            F.when(
                segment["is_end"],
                F.when(tracked, F.slice(opened, F.lit(1), F.size(opened) - depth)).otherwise(opened),
            )
            .when(
                (segment["opened"] > 0) | tracked,
                F.array_append(
                    opened, F.struct(segment["name"].alias("name"), segment["opened"].alias("mask"))
                ),
            )
            .otherwise(opened)
        )
        return F.struct(
            after.alias("open"),
            F.when(
                segment["text"].isNotNull(),
                added(texts, mask, F.substring(segment["text"], 1, MAX_BODY)),
            )
            .otherwise(texts)
            .alias("texts"),
        )

    return F.aggregate(segments, start, step, lambda state: state["texts"])


def body_text(page: Column) -> Column:
    """Paragraphs longer than 40 characters of the best container, joined and cut to 3000.

    The page is cut at block tags only, so a paragraph's text lies in one segment; the walk over
    the segments keeps track of the containers.
    """
    return let(visible(page), body_text_of)


def body_text_of(clean: Column) -> Column:
    """`body_text` of a page that `visible` has been applied to."""

    def cascade(texts: Column) -> Column:
        best = [nz(F.get(texts, F.lit(position))) for position in range(len(_CONTAINERS) + 1)]
        return F.substring(F.coalesce(*best, F.lit("")), 1, MAX_BODY)

    segments = F.transform(F.split(clean, _BLOCK), _segment)
    texts = let(let(segments, _telling), _walk)
    return F.when(_may_hold(clean, "p"), let(texts, cascade)).otherwise("")
