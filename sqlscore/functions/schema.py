"""Schema location and execution keys (T13–T15) as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_schema(text) -> Column:
    """A text containing ``CREATE TABLE`` (any case) is the schema as is;
    otherwise the lines from the first one mentioning CREATE or INSERT to the
    end, joined by newlines ('' when no line does)."""
    t = _col(text)
    lines = F.split(t, "\n", -1)
    flags = F.transform(lines, lambda ln: F.upper(ln).contains("CREATE") | F.upper(ln).contains("INSERT"))
    first = F.array_position(flags, F.lit(True))
    tail = F.when(first > 0, F.array_join(F.slice(lines, first.cast("int"), F.size(lines)), "\n")).otherwise(F.lit(""))
    return F.when(F.upper(t).contains("CREATE TABLE"), t).otherwise(tail)


def resolve_schema(columns: list[str] | tuple[str, ...], schema_col: str = "schema",
                   context_col: str = "context", prompt_col: str = "prompt") -> Column:
    """Explicit schema → T13(context) → T13(prompt) if the prompt carries
    ``SCHEMA:`` (case-sensitive) or ``CREATE TABLE`` (any case) → NULL.

    Presence is decided by the DataFrame's columns (a present-but-empty
    context stops the search, as an explicit argument would).
    """
    cols = set(columns)
    if schema_col in cols:
        return F.col(schema_col)
    if context_col in cols:
        return extract_schema(F.coalesce(F.col(context_col), F.lit("")))
    if prompt_col in cols:
        p = F.coalesce(F.col(prompt_col), F.lit(""))
        return F.when(p.contains("SCHEMA:") | F.upper(p).contains("CREATE TABLE"), extract_schema(p))
    return F.lit(None).cast("string")


def has_schema(schema) -> Column:
    """A schema counts only when it is a non-empty string."""
    s = _col(schema)
    return s.isNotNull() & (F.length(s) > 0)


def execution_key(query, schema) -> Column:
    """md5 of ``query:schema`` — the key one execution is cached under."""
    return F.md5(F.concat(_col(query), F.lit(":"), F.coalesce(_col(schema), F.lit(""))))
