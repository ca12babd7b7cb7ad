"""Categories of an RSS or Atom feed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from titlemill.functions.text import let, nz

MAX_CATEGORIES = 15


def looks_like_feed(body: Column) -> Column:
    """True if an XML declaration starts within the first 300 characters."""
    return F.contains(F.substring(body, 1, 300), F.lit("<?xml"))


# The document as XML: categories of items at the root (RSS 1.0) or in its channel (RSS 2.0), and
# of entries at the root (Atom). Text and attributes of a category both fit one struct.
_CATEGORY = "array<struct<_VALUE:string,_term:string>>"
_ITEMS = f"array<struct<category:{_CATEGORY}>>"
_SCHEMA = f"struct<item:{_ITEMS},channel:struct<item:{_ITEMS}>,entry:{_ITEMS},_corrupt_record:string>"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreSurroundingSpaces": "false"}
# Prolog: an XML declaration, comments, processing instructions and a doctype before the root.
_PROLOG = r"^\s*(?:<\?[^>]*\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>\s*)*"
_NAME = r"[A-Za-z_][A-Za-z0-9_:.\-]*"
_ATOM_ROOT = _PROLOG + r"<feed\s[^>]*?xmlns\s*=\s*[\"']http://www\.w3\.org/2005/Atom[\"']"


def _well_formed_end(body: Column) -> Column:
    """True where nothing but blanks follows the root element: its own end tag closes the text,
    or the root is one empty element. A parser of one row stops at the root's end and would not
    see what follows."""
    root = F.regexp_extract(body, _PROLOG + f"<({_NAME})", 1)
    quoted = F.regexp_replace(root, r"([.\-])", r"\\$1")
    closed = F.regexp_like(body, F.concat(F.lit("</"), quoted, F.lit(r"\s*>\s*$")))
    empty = F.regexp_like(body, F.concat(F.lit(_PROLOG + "<"), quoted, F.lit(r"(?:\s[^>]*)?/>\s*$")))
    return (root != "") & (closed | empty)


def _category_values(body: Column) -> Column:
    """Categories of a feed, before sorting; empty for malformed text.

    The parsed feed and its items' categories are bound, so a text is parsed once.
    """
    no_items, no_categories = F.array().cast(_ITEMS), F.array().cast(_CATEGORY)
    nothing = F.array().cast("array<string>")

    def categories(items: Column) -> Column:
        return F.flatten(F.transform(items, lambda i: F.coalesce(i["category"], no_categories)))

    def read(parsed: Column) -> Column:
        items = F.concat(F.coalesce(parsed["item"], no_items), F.coalesce(parsed["channel"]["item"], no_items))
        texts = F.transform(categories(items), lambda c: nz(c["_VALUE"]))
        rss = F.transform(F.array_compact(F.array_distinct(texts)), _trimmed)
        entries = F.coalesce(parsed["entry"], no_items)
        atom = F.transform(categories(entries), lambda c: F.coalesce(c["_term"], F.lit("")))
        found = let(rss, lambda r: F.when(F.size(r) > 0, r).when(body.rlike(_ATOM_ROOT), atom).otherwise(nothing))
        return F.when(parsed["_corrupt_record"].isNull(), found).otherwise(nothing)

    parsed = let(F.from_xml(body, _SCHEMA, _OPTIONS), read)
    return F.when(body.isNotNull(), F.when(_well_formed_end(body), parsed).otherwise(nothing))


# Every character that `\s` or the end of a line in a pattern may stand for.
_ENDS = " \t\n\x0b\f\r\x85\u2028\u2029"


def _trimmed(text: Column) -> Column:
    """`text` without blanks at its ends; the pattern runs only where there may be some."""
    bare = F.btrim(text, F.lit(_ENDS)) == text
    return F.when(bare, text).otherwise(F.regexp_replace(text, r"^\s+|\s+$", ""))


def feed_categories(body: Column) -> Column:
    """Distinct categories in order, at most 15; empty for malformed text, NULL for NULL.

    Parsed inside the JVM by `from_xml` on a fixed schema: items at the root or in its channel,
    Atom entries at the root of a feed whose default namespace is Atom (prefixed Atom names are
    not read). Malformed text is a corrupt record, or text after the root element's end.
    """
    return F.slice(F.array_sort(F.array_distinct(_category_values(body))), 1, MAX_CATEGORIES)
