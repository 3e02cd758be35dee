"""Named queries over the given tables, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.rules import PY_WS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query already registered: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


ROWS_A_TASK = 25_000


def spread(rows: DataFrame) -> DataFrame:
    """A table of short rows dealt out by their number, for queries that make long texts of them.

    Files of such rows are small, so reading by file size leaves a few tasks with
    all of the work. The count reads no column.
    """
    tasks = -(-rows.count() // ROWS_A_TASK)
    return rows.repartition(tasks) if tasks > max(1, rows.rdd.getNumPartitions()) else rows


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- oracle-side expressions ------------------------------------------------

WS_LIT = "'" + PY_WS + "'"


def d_strip(x: str) -> str:
    return f"trim({x}, {WS_LIT})"


def d_rstrip(x: str) -> str:
    return f"rtrim({x}, {WS_LIT})"


def d_lines(x: str) -> str:
    return f"string_split({x}, chr(10))"


def d_unlines(x: str) -> str:
    return f"coalesce(array_to_string({x}, chr(10)), '')"


def d_sub(x: str, pattern: str, repl: str = "", flags: str = "g") -> str:
    p, r = pattern.replace("'", "''"), repl.replace("'", "''")
    return f"regexp_replace({x}, '{p}', '{r}', '{flags}')"


def d_get(x: str, pattern: str, group: int = 0) -> str:
    p = pattern.replace("'", "''")
    return f"regexp_extract({x}, '{p}', {group})"


def d_has(x: str, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return f"regexp_matches({x}, '{p}')"


def d_collapse(x: str) -> str:
    return d_sub(x, r"\n{3,}", "\n\n")


def d_title(x: str) -> str:
    runs = f"regexp_extract_all({x}, '\\p{{L}}+|[^\\p{{L}}]+')"
    caps = f"list_transform({runs}, lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:]))"
    return f"coalesce(array_to_string({caps}, ''), '')"


def d_entities(x: str) -> str:
    steps = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"),
             ("&middot;", "·"), ("&nbsp;", "\xa0"), ("&#160;", "\xa0"), ("&#39;", "''"),
             ("&apos;", "''"), ("&amp;", "&"))
    for a, b in steps:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def d_nodes(x: str) -> str:
    for p in (r"(?s)<!--.*?-->", r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>",
              r"(?s)<[^>]*>"):
        x = d_sub(x, p, "\x01")
    parts = f"string_split({d_entities(x)}, chr(1))"
    stripped = f"list_transform({parts}, lambda n: {d_strip('n')})"
    return f"list_filter({stripped}, lambda n: n <> '')"


def d_text(x: str, sep: str = "''") -> str:
    return f"coalesce(array_to_string({d_nodes(x)}, {sep}), '')"


def d_drop_boilerplate(x: str) -> str:
    for t in ("script", "style", "nav", "footer", "header"):
        x = d_sub(x, rf"(?is)<{t}\b.*?</{t}\s*>", "")
    return x


def d_element(x: str, tag: str) -> str:
    return d_get(x, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
