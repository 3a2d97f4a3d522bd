"""Array-in-text codes, value maps and small text helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casting import to_integer


def array_to_braces(values: Column) -> Column:
    """``['a', 'b']`` -> ``{a,b}``; NULL -> ``{}``."""
    return F.concat(F.lit("{"), F.coalesce(F.array_join(values, ","), F.lit("")), F.lit("}"))


def delay_code_to_braces(json_text: Column) -> Column:
    """A code given as JSON null, scalar or array -> ``{}``, ``{93}``, ``{55,93}``."""
    as_array = F.when(json_text.startswith("["), F.from_json(json_text, "array<string>"))
    return F.coalesce(
        F.when(as_array.isNotNull(), array_to_braces(as_array)),
        F.concat(F.lit("{"), json_text, F.lit("}")),
        F.lit("{}"),
    )


def braces_to_value(c: Column, target: str = "int") -> Column:
    """``{55}`` -> 55. Braces at the ends are stripped, empty gives NULL.

    ``int`` and ``str`` convert the whole content, so ``{55,93}`` is NULL or ``'55,93'``; ``first`` takes
    the first element as text and ``array`` all of them.
    """
    content = F.nullif(F.btrim(c, F.lit("{}")), F.lit(""))
    if target == "int":
        return to_integer(content)
    if target == "str":
        return content
    if target == "first":
        return F.get(F.split(content, ","), F.lit(0))
    if target == "array":
        return F.split(content, ",")
    raise ValueError(f"unknown target {target!r}")


def last_element(values: Column) -> Column:
    """Last array element; NULL for an empty array instead of an error."""
    return F.try_element_at(values, F.lit(-1))


def map_value(c: Column, mapping: Mapping[str, str]) -> Column:
    """``mapping[c]``, or ``c`` itself when it is not a key."""
    if not mapping:
        return c
    chain = None
    for source, target in mapping.items():
        condition = c == source
        chain = F.when(condition, target) if chain is None else chain.when(condition, target)
    return chain.otherwise(c)


def normalised_code(c: Column) -> Column:
    """Codes as users type them: trimmed and upper case."""
    return F.upper(F.trim(c))
