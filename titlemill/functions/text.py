"""Text rules shared by every function: blanks, emptiness, binding, null keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters Unicode counts as blank, spelled for a bracket of a Java regex
# (its plain \s is ASCII only).
BLANKS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


# The same characters, one by one.
BLANK_CHARACTERS = "".join(
    chr(c)
    for first, last in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for c in range(first, last + 1)
)


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode blanks; only the ends of the text are looked at."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def nz(text: Column) -> Column:
    """NULL for the empty string, so that NULL and '' fall through `coalesce` alike."""
    return F.nullif(text, F.lit(""))


def has_items(array: Column) -> Column:
    """True for a non-empty array; false for NULL and for an empty one."""
    return F.coalesce(F.size(array) > 0, F.lit(False))


def is_one_of(value: Column, allowed: list[str]) -> Column:
    """Membership that is false, not NULL, for NULL."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an expensive expression once and use it several times in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def keep_words(words: Column, stop: list[str]) -> Column:
    """Words that are not stop words; repeats stay."""
    return F.filter(words, lambda w: ~F.lower(w).isin(*stop))


def strip_slashes(url: Column) -> Column:
    """Remove trailing slashes."""
    return F.regexp_replace(url, r"/+\z", "")


def spread_nulls(key: Column, by: Column) -> Column:
    """A join key that never matches where `key` is NULL, spread over partitions by `by`.

    A left join sends every NULL key to one partition. Keys that start with U+0000 match no
    snapshot key, and differ per row, so such rows spread evenly instead.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), by.cast("string")))
