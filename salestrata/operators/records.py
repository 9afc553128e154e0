"""From JSON text to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strict JSON, where the reader is lenient by default.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Parsed along after the text, to see that the parser came to its end.
_END = "end of text"


def parse_text(texts: DataFrame, text: str = "value") -> DataFrame:
    """Replaces ``text`` by its parsed values, for ``records`` to look at.

    The text is parsed as the first of two array elements, the second being an
    end mark: a parse of the bare text would stop after the first value and lose
    the rest of two records run together on a line.  A top-level array is parsed
    straight into its elements, as the size of one variant would bound the array
    as a whole.
    """
    def enclosed(end: str) -> Column:
        return F.concat(F.lit("["), text, F.lit(f",{end}]"))

    is_array = F.rlike(text, F.lit(r"^\s*\["))
    elements = F.from_json(enclosed(f'["{_END}"]'), "array<array<variant>>", _STRICT)
    single = F.from_json(enclosed(f'"{_END}"'), "array<variant>", _STRICT)
    others = [c for c in texts.columns if c != text]
    return texts.select(*others, F.when(is_array, elements).alias("elements"),
                        F.when(~is_array, single).alias("single"))


def records() -> Column:
    """The records of a parsed text: the elements of a top-level array, else the
    value itself.  NULL unless the text is exactly one JSON value."""
    def first_of_two(values: str, end: Column) -> Column:
        return (F.size(values) == 2) & (F.try_variant_get(end, "$", "string") == _END)

    second = F.lit(1)
    return F.coalesce(
        F.when(first_of_two("elements", F.get(F.get("elements", second), F.lit(0))),
               F.get("elements", F.lit(0))),
        F.when(first_of_two("single", F.get("single", second)), F.slice("single", 1, 1)),
    )


def strip_outer_array(parsed: DataFrame, record: str = "raw") -> DataFrame:
    """One row per record of the parsed texts; a text that is no JSON gives none.

    The explode keeps later filters above it: pushed below, they would parse
    the text once per predicate.  It takes the expression, not a column of it,
    for else Spark adds such a filter by itself.
    """
    others = [c for c in parsed.columns if c not in ("elements", "single")]
    return parsed.select(*others, F.explode(records()).alias(record))
