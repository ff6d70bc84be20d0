"""Exports and appends.  No export has a secret column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECRET = ("password", "secret", "credential_hash", "soft_credential_hash")


def public(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in SECRET])


def to_csv(df: DataFrame, path: str) -> None:
    """Header, every value quoted, quotes doubled, nulls empty."""
    df = public(df)
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"', emptyValue="")


def csv_lines(df: DataFrame) -> DataFrame:
    df = public(df)
    cells = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in df.columns]
    return df.select(F.concat_ws(",", *cells).alias("line"))


def export_records(records: DataFrame, query: str, pattern: str, fields: Sequence[str], shown: Sequence[str], limit: int = 50_000, **how) -> DataFrame:
    """CSV lines of the records that a query and a pattern find, newest first, at most ``limit``.

    ``*`` in the query stands for anything; without one a word may stand anywhere in
    a field.  All conditions act before the limit.  A secret column is refused.
    """
    from siltstone.operators.search import matches_any, predicate

    if held := [c for c in shown if c in SECRET]:
        raise ValueError(f"no export has the columns {', '.join(held)}")
    wild = query.replace("*", "%")
    hits = records.filter(predicate(wild, whole="%" in wild, **how) & matches_any(pattern, fields))
    return csv_lines(hits.orderBy(F.desc("created_at"), F.desc("id")).limit(limit).select(*shown))


#: Rows of each result set in an export of several.
SET_LIMITS = {"channels": 500, "messages": 1_000, "attachments": 1_000, "records": 5_000, "systems": 1_000, "documents": 1_000, "items": 500}


def export_sets(sets: dict[str, DataFrame], orders: dict[str, Sequence[Column]], limits: dict[str, int] = SET_LIMITS) -> DataFrame:
    """(set_name, n, limit, line): several results as JSON, each in its order up to its limit, which is told with the rows found."""
    out = None
    for name, df in sets.items():
        df = public(df)
        found = df.agg(F.count(F.lit(1)).alias("found"))
        part = df.orderBy(*orders[name]).limit(limits[name])
        one = part.select(F.lit(name).alias("set_name"), found.scalar().alias("found"), F.lit(limits[name]).alias("row_limit"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))
        out = one if out is None else out.unionByName(one)
    return out


def to_json(df: DataFrame) -> DataFrame:
    """One JSON object a row, nulls kept."""
    df = public(df)
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))


def markdown_cell(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.regexp_replace(F.replace(text, F.lit("|"), F.lit("\\|")), "\r?\n", "<br>")


def markdown_lines(df: DataFrame) -> DataFrame:
    df = public(df)
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[markdown_cell(F.col(c)) for c in df.columns]), F.lit(" |")).alias("line"))


def markdown_table(title: str, columns: Sequence[str], lines: Sequence[str]) -> str:
    """A finished table from lines that fit the driver, such as one page."""
    if not lines:
        return f"## {title}\n\nNo rows matched.\n"
    return "\n".join([f"## {title}", "", "| " + " | ".join(columns) + " |", "| " + " | ".join(["---"] * len(columns)) + " |", *lines, ""])


def append_new(staged: DataFrame, path: str, key: str, order: Column) -> int:
    """Append the staged rows whose key the parquet table at ``path`` lacks; returns how many."""
    from siltstone.operators.dedup import new_rows
    from siltstone.session import hadoop_path, materialise

    fs, p = hadoop_path(staged.sparkSession, path)
    target = staged.sparkSession.read.parquet(path) if fs.exists(p) else staged.limit(0)
    fresh = materialise(new_rows(staged, target, key, order), "append")
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def to_xlsx(frames: dict[str, DataFrame], path: str, rows: int = 100_000) -> bool:
    """One sheet for each result, if a spreadsheet writer is installed; False otherwise.

    A sheet is a driver-side file, so a result of more than ``rows`` rows is
    refused instead of being collected.
    """
    import importlib.util

    if not importlib.util.find_spec("openpyxl"):
        return False
    import pandas as pd

    with pd.ExcelWriter(path) as writer:
        for name, df in frames.items():
            held = public(df).limit(rows + 1).toPandas()
            if len(held) > rows:
                raise ValueError(f"{name} has more than {rows} rows; export it as CSV")
            held.to_excel(writer, sheet_name=name[:31], index=False)
    return True
