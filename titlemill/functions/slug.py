"""Slugs and candidate addresses built from a title."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from titlemill.functions.text import BLANKS, keep_words, nz, strip

# Ukrainian letters written with one Latin letter, and with several.
ONE_LETTER = {
    "а": "a", "б": "b", "в": "v", "г": "h", "ґ": "g", "д": "d", "е": "e", "з": "z", "и": "y",
    "і": "i", "ї": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p",
    "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
}
MANY_LETTERS = {
    "є": "ie", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ю": "yu",
    "я": "ya",
}

# Words that carry no meaning in an address.
STOP_WORDS = [
    "the", "a", "an", "of", "and", "or", "in", "at", "by",
    "на", "для", "та", "і", "в", "з", "до",
]

# Endings that make a title look like an address.
TITLE_ENDINGS = [
    "com.ua", "org.ua", "net.ua", "in.ua", "com", "net", "org", "ua",
    "info", "media", "online", "news",
]

# Endings tried in this order, by each of the two candidate rules.
PROBE_ENDINGS = [".com.ua", ".ua", ".com", ".net", ".org", ".media", ".online"]
COMPACT_PROBE_ENDINGS = [".com", ".net", ".org", ".ua", ".info"]

_TITLE_WITH_ENDING = (
    r"(?is)\A(.*?)(\.(?:" + "|".join(e.replace(".", r"\.") for e in TITLE_ENDINGS) + r"))\n?\z"
)


def _transliterate(text: Column, singles: dict[str, str], blanks: str) -> Column:
    out = F.lower(text)
    for letter, latin in MANY_LETTERS.items():
        out = F.replace(out, F.lit(letter), F.lit(latin))
    return F.translate(out, "".join(singles) + blanks, "".join(singles.values()) + "-" * len(blanks))


def _tidy(slug: Column) -> Column:
    return F.btrim(F.regexp_replace(slug, "-{2,}", "-"), F.lit("-"))


def latin_slug(text: Column) -> Column:
    """Lower-case Latin slug of letters, digits, `-` and `_`; blanks become `-`."""
    latin = _transliterate(text, ONE_LETTER, " \t")
    return _tidy(F.regexp_replace(latin, "[^a-z0-9_-]+", ""))


def short_slug(text: Column) -> Column:
    """As `latin_slug`, without ґ, `_` and tab, cut to 40 characters after tidying."""
    singles = {k: v for k, v in ONE_LETTER.items() if k != "ґ"}
    latin = _transliterate(text, singles, " ")
    return F.substring(_tidy(F.regexp_replace(latin, "[^a-z0-9-]+", "")), 1, 40)


def url_in_title(title: Column) -> Column:
    """The address a title spells out, such as `Район.in.ua`; NULL if it spells none."""
    slug = nz(latin_slug(strip(F.regexp_extract(title, _TITLE_WITH_ENDING, 1))))
    return F.concat(F.lit("https://"), slug, F.regexp_extract(title, _TITLE_WITH_ENDING, 2))


def _addresses(base: Column, endings: list[str]) -> Column:
    return F.transform(
        F.array(*[F.lit(e) for e in endings]), lambda e: F.concat(F.lit("https://"), base, e)
    )


def slug_candidates(title: Column) -> Column:
    """Addresses guessed from the first three meaningful words, best first; empty if none."""
    bare = F.when(
        F.regexp_extract(title, _TITLE_WITH_ENDING, 2) != "",
        F.regexp_extract(title, _TITLE_WITH_ENDING, 1),
    ).otherwise(title)
    words = F.filter(F.split(strip(bare), rf"[{BLANKS}_-]+"), lambda w: w != "")
    base = latin_slug(F.array_join(F.slice(keep_words(words, STOP_WORDS), 1, 3), ""))
    return F.flatten(
        F.transform(
            F.filter(F.array(base), lambda b: b != ""), lambda b: _addresses(b, PROBE_ENDINGS)
        )
    )


def compact_candidates(title: Column) -> Column:
    """Second rule: five endings for the squeezed first three words, then for the short slug."""
    words = keep_words(F.split(F.lower(title), rf"[{BLANKS}]+"), STOP_WORDS)
    compact = F.regexp_replace(F.array_join(F.slice(words, 1, 3), ""), "[^a-z0-9]+", "")
    bases = F.array_distinct(F.filter(F.array(compact, short_slug(title)), lambda b: b != ""))
    return F.flatten(F.transform(bases, lambda b: _addresses(b, COMPACT_PROBE_ENDINGS)))


def first_compact_candidate(title: Column) -> Column:
    """The candidate taken when addresses are not probed; NULL if there is none."""
    return F.get(compact_candidates(title), F.lit(0))
