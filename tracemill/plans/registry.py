"""Queries and their SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: White space as the text functions know it, for DuckDB's regular expressions.
WS = r"[ \t\n\x0B\f\r]"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower(x: str) -> str:
    """SQL for ``x`` in lower case, letter by letter (the two letters that engines treat differently are replaced first)."""
    return f"lower(translate({x}, 'İΣ', 'iσ'))"


def strip(x: str) -> str:
    """SQL for ``x`` without white space at both ends."""
    return rf"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean(x: str) -> str:
    """SQL for a cleaned target."""
    bare = strip(f"regexp_replace({x}, '(?i)</?think>', '', 'g')")
    return rf"regexp_replace(regexp_replace(regexp_replace({bare}, '^[:：=\-{WS[1:-1]}]+', ''), '{WS}+', ' ', 'g'), '^[ \t\r\n.。]+|[ \t\r\n.。]+$', '', 'g')"


def canonical(x: str) -> str:
    """SQL for the key of a target."""
    return rf"regexp_replace(regexp_replace(regexp_replace({lower(clean(x))}, '\\(?:boxed|text|mathrm)\s*\{{([^{{}}]*)\}}', '\1', 'g'), '\\[a-zA-Z]+', '', 'g'), '[{WS[1:-1]}$`''\".,;:，。；：]+', '', 'g')"


def sentences(x: str) -> str:
    """SQL for the list of the sentences of a text."""
    return rf"list_filter(list_transform(string_split_regex(regexp_replace({strip(x)}, '([.!?。！？]){WS}+', '\1' || chr(10), 'g'), '\n+'), lambda s: {strip('s')}), lambda s: s <> '')"


def lines(x: str) -> str:
    """SQL for the list of the lines of a text, stripped, without blank ones."""
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda s: {strip('s')}), lambda s: s <> '')"
