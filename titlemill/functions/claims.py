"""Claims of an entity document: official website and year of foundation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WEBSITE = "P856"
INCEPTION = "P571"


def _first(entity: Column, claim: str, kind: str, leaf: str) -> Column:
    value = f"$.claims.{claim}[0].mainsnak.datavalue"
    return F.when(
        F.get_json_object(entity, f"{value}.type") == kind,
        F.get_json_object(entity, f"{value}.value{leaf}"),
    )


def official_website(entity: Column) -> Column:
    """Website of the first statement, if that statement holds a string."""
    return _first(entity, WEBSITE, "string", "")


def founding_year(entity: Column) -> Column:
    """Year of the first inception statement, without its plus sign; a minus sign stays."""
    return F.ltrim(F.substring(_first(entity, INCEPTION, "time", ".time"), 1, 5), F.lit("+"))
