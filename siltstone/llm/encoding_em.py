"""Text decoded with the wrong encoding: found and restored by expectation-maximisation.

Each run of non-ASCII characters in a value is either as it was written or came
through one of the CHAINS, one or more steps of being written in one encoding and
read in another.  Undoing a chain gives a candidate text.  The model has two parts, fitted together:

* for each source and field, how often each chain occurs (a latent choice for
  each run), smoothed by the frequency over all sources, so that the weak
  evidence of a few records is pooled;
* how clean text looks: transitions between classes of characters (case and
  script) and the frequency of each character in its class.

The expectation step weighs each run's candidates by chain frequency and
likelihood; the maximisation step re-estimates both from these weights over all
rows, until the chains' shares have settled.  Then each value is repaired by the best posterior.

The statistics that reach the driver are bounded whatever the data: classes
squared and one number for each code point of Unicode that occurs.  Chain
frequencies for each source stay a table.

Defined cases: null, empty and pure ASCII values are clean; U+FFFD says that a
wrong decoding destroyed a character, so such a value is garbled and restored
only as far as the rest can be; long values are handled run by run, whole; equal
values of one source and field get equal answers; an empty table gives no row.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.session import materialise

#: Encodings that a text in UTF-8 is read with by mistake.
READERS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "cp866", "koi8-r", "mac-roman")
#: Encodings without relation to Latin letters, whose texts are read as cp1252; and Cyrillic ones read as each other.
WESTERN = "cp1252"
FOREIGN = ("cp1251", "koi8-r", "cp866", "cp1253", "euc-jp", "shift_jis")
CYRILLIC = ("koi8-r", "cp1251")
Step = tuple[str, str]
#: A chain is one or more steps (written in, read as), the first applied first.
CHAINS: tuple[tuple[Step, ...], ...] = (
    *[(("utf-8", r),) for r in READERS],
    *[((w, WESTERN),) for w in FOREIGN],
    *[((a, b),) for a in CYRILLIC for b in CYRILLIC if a != b],
    *[(("utf-8", r), ("utf-8", r)) for r in (WESTERN,)],
)
#: Rounds go on until no chain's share moves by more than SETTLED, and at most ROUNDS times.
ROUNDS, SETTLED = 8, 0.002
SURE, PRIOR_CLEAN, POOLED = 0.5, 0.85, 20.0
RUN = re.compile(r"[^\x00-\x7f]+")
NON_ASCII = r"[^\x00-\x7F]"


@lru_cache(maxsize=4096)
def char_class(c: str) -> str:
    """Case and script of a character, from its code point."""
    o = ord(c)
    case = "u" if c.isupper() else "l"
    if o < 0x80:
        return "ascii"
    if o < 0xA0:
        return "control"
    if o == 0xFFFD:
        return "lost"
    if o < 0xC0 or o in (0xD7, 0xF7):
        return "mark"
    if o < 0x250:
        return "latin-" + case
    if 0x370 <= o < 0x400:
        return "greek-" + case
    if 0x400 <= o < 0x530:
        return "cyrillic-" + case if 0x410 <= o < 0x450 or o in (0x401, 0x451) else "cyrillic-other"
    if 0x3040 <= o < 0x30A0:
        return "hiragana"
    if 0x30A0 <= o < 0x3100:
        return "katakana"
    if 0xFF61 <= o < 0xFFA0:
        return "halfwidth"
    if 0x4E00 <= o < 0xA000:
        return "han"
    if 0x2500 <= o < 0x25A0:
        return "box"
    return "other"


@lru_cache(maxsize=64)
def _reader(encoding: str) -> dict[str, int]:
    """Character to byte in a single-byte encoding; undefined bytes as Latin-1 reads them."""
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


def _written(c: str) -> bool:
    """Whether a character is assigned and no control, so that a text may hold it."""
    return unicodedata.category(c) not in ("Cn", "Co", "Cs", "Cc")


def _undo_utf8(run: str, read: str) -> str | None:
    """Valid multi-byte sequences decoded where they stand; None if there is none."""
    table, out, i, any_ = _reader(read), [], 0, False
    data = [table.get(c, -1) for c in run]
    while i < len(run):
        b = data[i]
        n = 2 if 0xC2 <= b < 0xE0 else 3 if 0xE0 <= b < 0xF0 else 4 if 0xF0 <= b < 0xF5 else 0
        tail = data[i + 1 : i + n] if n else []
        if n and len(tail) == n - 1 and all(0x80 <= x < 0xC0 for x in tail):
            try:
                c = bytes([b, *tail]).decode("utf-8")
                if _written(c):
                    out.append(c)
                    i, any_ = i + n, True
                    continue
            except UnicodeDecodeError:
                pass
        out.append(run[i])
        i += 1
    return "".join(out) if any_ else None


def candidates(run: str) -> tuple[tuple[int, str], ...]:
    """(chain, text) for each chain that the run can be undone by; 0 is the clean one."""
    return _remembered(run) if len(run) <= 100 else _candidates(run)


def _undo(text: str, step: Step) -> str | None:
    """The text before one step; None if the step cannot have made it."""
    written, read = step
    if written == "utf-8":
        return _undo_utf8(text, read)
    table = _reader(read)
    try:
        out = bytes(table[c] for c in text).decode(written)
    except (KeyError, UnicodeDecodeError):
        return None
    return out if all(map(_written, out)) else None


def _candidates(run: str) -> tuple[tuple[int, str], ...]:
    out = [(0, run)]
    for k, chain in enumerate(CHAINS, 1):
        text = run
        for step in reversed(chain):
            text = _undo(text, step) if text else None
        if text is not None and text != run:
            out.append((k, text))
    return tuple(out)


_remembered = lru_cache(maxsize=200_000)(_candidates)


class CleanText:
    """The likelihood of a run under the statistics of clean text."""

    def __init__(self, moves: dict[tuple[str, str], float], chars: dict[str, float]):
        from_, of = defaultdict(float), defaultdict(float)
        for (a, _), n in moves.items():
            from_[a] += n
        for c, n in chars.items():
            of[char_class(c)] += n
        self.moves, self.chars, self.from_, self.of = moves, chars, from_, of

    def score(self, run: str) -> float:
        """Log likelihood of the run between ASCII characters, its end included."""
        total, before = 0.0, "ascii"
        for c in run:
            kind = char_class(c)
            total += math.log((self.moves.get((before, kind), 0.0) + 0.05) / (self.from_[before] + 1.0))
            if kind != "ascii":
                total += math.log((self.chars.get(c, 0.0) + 0.1) / (self.of[kind] + 20.0))
            before = kind
        return total + math.log((self.moves.get((before, "ascii"), 0.0) + 0.05) / (self.from_[before] + 1.0))


def _moves_of(run: str) -> Iterator[tuple[str, str]]:
    before = "ascii"
    for c in run:
        kind = char_class(c)
        yield before, kind
        before = kind
    yield before, "ascii"


def posterior(run: str, clean: CleanText, weights: list[float]) -> list[tuple[int, str, float]]:
    """(chain, text, probability) for each candidate of a run."""
    found = candidates(run)
    if len(found) == 1:
        return [(0, run, 1.0)]
    logs = [math.log(weights[k]) + clean.score(text) for k, text in found]
    top = max(logs)
    odds = [math.exp(x - top) for x in logs]
    return [(k, text, o / sum(odds)) for (k, text), o in zip(found, odds)]


def _start() -> list[float]:
    return [PRIOR_CLEAN] + [(1 - PRIOR_CLEAN) / len(CHAINS)] * len(CHAINS)


def _count(clean: CleanText | None):
    """Expected counts over rows (source, field, run, n, weights), summed for each batch."""

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            sums: dict[tuple, float] = defaultdict(float)
            for source, field, run, n, weights in zip(pdf["source"], pdf["field"], pdf["run"], pdf["n"], pdf["weights"]):
                if clean is None:
                    # to begin with, runs that no UTF-8 chain explains count as clean text
                    odd = any(k and CHAINS[k - 1][0][0] == "utf-8" for k, _ in candidates(run))
                    options = [] if odd else [(0, run, 1.0)]
                else:
                    options = posterior(run, clean, list(weights))
                for k, text, p in options:
                    w = p * n
                    sums["chain", source, field, str(k)] += w
                    for a, b in _moves_of(text):
                        sums["move", a, b, ""] += w
                    for c in text:
                        if c > "\x7f":
                            sums["char", c, "", ""] += w
            keys = list(sums)
            yield pd.DataFrame({"kind": [k[0] for k in keys], "a": [k[1] for k in keys], "b": [k[2] for k in keys], "c": [k[3] for k in keys], "w": list(sums.values())})

    return step


def _values(tables: list[tuple[DataFrame, str, tuple[str, ...], str]], id_column: str) -> DataFrame:
    """(record_table, record_id, field, source, value) of the values with a non-ASCII character."""
    out = None
    for df, name, fields, source in tables:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]))
        rows = df.select(F.lit(name).alias("record_table"), F.col(id_column).cast("long").alias("record_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), pairs.alias("p"))
        rows = rows.select("record_table", "record_id", F.concat_ws(":", F.lit(name), "p.field").alias("field"), "source", F.col("p.value").alias("value")).filter(F.col("value").rlike(NON_ASCII))
        out = rows if out is None else out.unionByName(rows)
    return out


def _collect_clean(counts: DataFrame) -> CleanText:
    """At most classes squared moves and one row for each code point."""
    rows = counts.filter("kind <> 'chain'").groupBy("kind", "a", "b").agg(F.sum("w").alias("w")).collect()
    return CleanText({(r["a"], r["b"]): r["w"] for r in rows if r["kind"] == "move"}, {r["a"]: r["w"] for r in rows if r["kind"] == "char"})


def _weights(counts: DataFrame) -> tuple[DataFrame, list[float]]:
    """(source, field, weights): chain frequencies, smoothed by those over all sources; and the latter."""
    by = counts.filter("kind = 'chain'").groupBy(F.col("a").alias("source"), F.col("b").alias("field"), F.col("c").cast("int").alias("k")).agg(F.sum("w").alias("w"))
    start = _start()
    # as many numbers as there are chains
    overall = {r["k"]: r["w"] for r in by.groupBy("k").agg(F.sum("w").alias("w")).collect()}
    whole = sum(overall.values()) + POOLED
    pooled = [(overall.get(k, 0.0) + POOLED * p) / whole for k, p in enumerate(start)]
    arrays = by.groupBy("source", "field").agg(F.map_from_entries(F.collect_list(F.struct("k", "w"))).alias("m"), F.sum("w").alias("t"))
    each = [(F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0.0)) + F.lit(POOLED * p)) / (F.col("t") + F.lit(POOLED)) for k, p in enumerate(pooled)]
    return arrays.select("source", "field", F.array(*each).alias("weights")), pooled


def fit(values: DataFrame, rounds: int = ROUNDS) -> tuple[CleanText, DataFrame]:
    """The clean-text statistics and the (source, field, weights) table once the chains' shares have settled."""
    start = F.array(*[F.lit(w) for w in _start()])
    runs = values.select("source", "field", F.explode(F.regexp_extract_all("value", F.lit("([^\\x00-\\x7F]+)"), 1)).alias("run")).groupBy("source", "field", "run").agg(F.count(F.lit(1)).alias("n"))
    runs = materialise(runs, "em-runs")
    ddl = "kind string, a string, b string, c string, w double"
    clean = _collect_clean(runs.withColumn("weights", start).mapInPandas(_count(None), ddl))
    weights, shares = None, _start()
    for _ in range(rounds):
        at = runs.withColumn("weights", start) if weights is None else runs.join(weights, ["source", "field"], "left").withColumn("weights", F.coalesce("weights", start))
        counts = at.mapInPandas(_count(clean), ddl)
        counts = materialise(counts.groupBy("kind", "a", "b", "c").agg(F.sum("w").alias("w")), "em-counts")
        clean, (weights, now) = _collect_clean(counts), _weights(counts)
        moved, shares = max(abs(a - b) for a, b in zip(shares, now)), now
        if moved <= SETTLED:
            break
    return clean, weights


def repair_value(value: str, clean: CleanText, weights: list[float], sure: float = SURE) -> tuple[bool, str]:
    """(garbled, restored) of one value."""
    garbled, out, end = "�" in value, [], 0
    for m in RUN.finditer(value):
        odds = posterior(m[0], clean, weights)
        kept = sum(p for k, _, p in odds if not k)
        if kept < 1 - sure:
            k, text, _ = max((x for x in odds if x[0]), key=lambda x: x[2])
            out += [value[end : m.start()], text]
            end, garbled = m.end(), True
    return garbled, "".join(out) + value[end:]


def garbled(tables: list[tuple[DataFrame, str, tuple[str, ...], str]], id_column: str = "id", rounds: int = ROUNDS) -> DataFrame:
    """(record_table, record_id, field, restored, complete) for each garbled value.

    ``tables`` lists (table, name, fields, source column).
    """
    values = materialise(_values(tables, id_column), "em-values")
    clean, weights = fit(values, rounds)
    start = F.array(*[F.lit(w) for w in _start()])
    rows = values.join(weights, ["source", "field"], "left").withColumn("weights", F.coalesce("weights", start))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            got = [repair_value(v, clean, list(w)) for v, w in zip(pdf["value"], pdf["weights"])]
            out = pdf[["record_table", "record_id"]].assign(field=pdf["field"].str.partition(":")[2], restored=[r for _, r in got], complete=["�" not in r for _, r in got])
            yield out[[g for g, _ in got]]

    return rows.mapInPandas(judge, "record_table string, record_id long, field string, restored string, complete boolean")
