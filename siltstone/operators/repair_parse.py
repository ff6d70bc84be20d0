"""Rows that fail to parse, told apart from valid rows by a minimum-cost parse.

A record is a walk through the automaton of the format: fields at delimiters,
each field free of quotes or wholly enclosed in them, a quote inside doubled.
Dynamic programming over the characters finds the cheapest way to make a text
such a record by inserting or deleting quotes and delimiters.  Cost nought and
valid types load; otherwise the edit operations, or the field that is not of
its type, are the reason for the rejection.

Runs of characters other than quote and delimiter act on the automaton as one
such character, so the program runs over a text's *shape* ("o,o,"o"o"), once
for each different shape that a worker meets.

Defined cases: a null text is rejected as "null text"; an empty text or one
with fewer fields is rejected with the delimiters it lacks; very long texts are
parsed whole; repeated rows come out as often as they came in; an empty table
gives an empty result; further columns of the input are passed through, those with
a name of the result's own ending in "_in".
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from siltstone.columns import make_room
from siltstone.functions.digests import digest_key, keyed
from siltstone.session import ship

FIELDS = ("url", "username", "password", "application", "profile", "extraction_job_id", "created_at")
START, BARE, QUOTED, ENDED = range(4)
_NAMES = {("i", "q"): "insert quote", ("d", "q"): "delete quote", ("i", "c"): "insert delimiter", ("d", "c"): "delete delimiter"}


def _step(field: int, mode: int, kind: str, last: int) -> tuple[int, int] | None:
    """Where the automaton goes on a quote, a delimiter or another character; None: nowhere."""
    if mode == QUOTED:
        return field, ENDED if kind == "q" else QUOTED
    if kind == "c":
        return (field + 1, START) if field < last else None
    if kind == "q":
        return (field, QUOTED) if mode in (START, ENDED) else None
    return (field, BARE) if mode in (START, BARE) else None


def shape_of(text: str) -> str:
    """The text with every other run of characters as one ``o``, quotes ``q``, delimiters ``c``."""
    return re.sub(r"[^\",]+", "o", text).replace('"', "q").replace(",", "c")


@lru_cache(maxsize=4)
def _moves(fields: int) -> dict[str, list[int]]:
    """For each symbol the state after each state, -1 for none; a state is 4 * field + mode."""
    last = fields - 1
    return {k: [(4 * t[0] + t[1] if (t := _step(s // 4, s % 4, k, last)) else -1) for s in range(4 * fields)] for k in "qco"}


_INF, _NO = 1 << 30, 255


def _relax(cost: list[int], move: dict[str, list[int]]) -> tuple[bytearray, bytearray]:
    """Insertions, moves that read nothing, cheapest first: (state before, symbol) of each state so reached."""
    came, kind = bytearray([_NO]) * len(cost), bytearray(len(cost))
    front = sorted(range(len(cost)), key=cost.__getitem__)
    while front:
        new = []
        for s in front:
            c = cost[s] + 1
            if c > _INF:
                break
            for code, k in enumerate("qc"):
                t = move[k][s]
                if t >= 0 and c < cost[t]:
                    cost[t], came[t], kind[t] = c, s, code
                    new.append(t)
        front = sorted(new, key=cost.__getitem__)
    return came, kind


def _cheapest(shape: str, fields: int) -> tuple[int, tuple[tuple[str, int], ...]]:
    move, states = _moves(fields), 4 * fields
    cost = [_INF] * states
    cost[0] = 0
    # four bytes for each state and symbol, however long the shape is
    read: list[tuple[bytearray, bytearray]] = []
    inserted = [_relax(cost, move)]
    for k in shape:
        new, came, deleted, to = [_INF] * states, bytearray([_NO]) * states, bytearray(states), move[k]
        for s, c in enumerate(cost):
            if c < _INF:
                t = to[s]
                if t >= 0 and c < new[t]:
                    new[t], came[t], deleted[t] = c, s, 0
                if k != "o" and c + 1 < new[s]:
                    new[s], came[s], deleted[s] = c + 1, s, 1
        read.append((came, deleted))
        cost = new
        inserted.append(_relax(cost, move))
    best = min((4 * (fields - 1) + m for m in (START, BARE, ENDED)), key=lambda s: cost[s])
    ops, s, at = [], best, len(shape)
    while True:
        came, kind = inserted[at]
        while came[s] != _NO:
            ops.append((_NAMES["i", "qc"[kind[s]]], at))
            s = came[s]
        if not at:
            break
        came, deleted = read[at - 1]
        if deleted[s]:
            ops.append((_NAMES["d", shape[at - 1]], at - 1))
        s = came[s]
        at -= 1
    return cost[best], tuple(reversed(ops))


_remembered = lru_cache(maxsize=20_000)(_cheapest)


def cheapest(shape: str, fields: int = len(FIELDS)) -> tuple[int, tuple[tuple[str, int], ...]]:
    """Least cost of a shape and its operations, each with the symbol it is done at, from 0.

    Of several ways of one cost the first found stays, which makes the answer
    definite.  Shapes of up to 500 symbols are remembered.
    """
    return _remembered(shape, fields) if len(shape) <= 500 else _cheapest(shape, fields)


_SYMBOL = re.compile(r'[^",]+|[",]')


def told(text: str, ops: tuple[tuple[str, int], ...]) -> str:
    """The operations in words, with the characters of the text they are done at, counted from 1."""
    places = [m.start() + 1 for m in _SYMBOL.finditer(text)] + [len(text) + 1]
    return "; ".join(f"{name} at {places[at]}" for name, at in ops)


_FIELD = re.compile(r'"((?:[^"]|"")*)"|([^",]*)')


def _split(text: str) -> list[str]:
    """The fields of a text whose cost is nought."""
    if '"' not in text:
        return text.split(",")
    out, at = [], 0
    while True:
        m = _FIELD.match(text, at)
        out.append(m[2] if m[1] is None else m[1].replace('""', '"'))
        at = m.end() + 1
        if at > len(text):
            return out


_RESULT = StructType([StructField("cost", IntegerType()), StructField("edits", StringType()), *[StructField(f, StringType()) for f in FIELDS]])


@F.pandas_udf(_RESULT)
def _parse(texts: pd.Series) -> pd.DataFrame:
    out = []
    for text in texts:
        if text is None:
            out.append((None,) * 9)
            continue
        cost, ops = cheapest(shape_of(text))
        out.append((cost, told(text, ops), *[None] * 7) if cost else (0, "", *_split(text)))
    return pd.DataFrame(out, columns=["cost", "edits", *FIELDS])


def _instant(c: Column) -> Column:
    """True where the text is a real instant YYYY-MM-DDTHH:MM:SSZ."""
    form = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]Z\z"
    return c.rlike(form) & F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd").isNotNull()


def parse_records(lines: DataFrame, text: str = "raw_text") -> DataFrame:
    """Every row of ``lines`` with ``status`` loaded or rejected, its ``reason``, and the fields.

    The password leaves the parse as a keyed digest only.
    """
    ship(lines.sparkSession)
    own = ("status", "reason", "cost", "password_digest", "_parsed", "_reason", *FIELDS)
    lines = make_room(lines, own, keep=(text,))
    rows = lines.withColumn("_parsed", _parse(F.col(text)))
    p = F.col("_parsed")
    bad = F.concat_ws(
        "; ",
        F.when(~p["url"].rlike(r"(?s)^https?://[^/]"), F.lit("url is not a web address")),
        F.when(~(p["extraction_job_id"].rlike(r"^[0-9]{1,18}\z") & ~p["extraction_job_id"].rlike(r"^0+\z")), F.lit("extraction_job_id is not a positive number of at most 18 digits")),
        F.when(~_instant(p["created_at"]), F.lit("created_at is not an instant")),
    )
    reason = F.when(F.col(text).isNull(), "null text").when(p["cost"] > 0, p["edits"]).when(bad != "", bad)
    keep = [c for c in lines.columns if c != text]
    values = {f: p[f] for f in FIELDS if f != "password"} | {"password_digest": keyed(p["password"], digest_key(lines.sparkSession))}
    named = [f if f != "password" else "password_digest" for f in FIELDS]
    return rows.withColumn("_reason", reason).select(
        *keep,
        F.when(F.col("_reason").isNull(), "loaded").otherwise("rejected").alias("status"),
        F.col("_reason").alias("reason"),
        p["cost"].alias("cost"),
        *[F.when(F.col("_reason").isNull(), values[f]).alias(f) for f in named],
    )
