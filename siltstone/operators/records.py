"""Records out of labelled text: delimited lines, labelled blocks and sheets.

A text is cut into blocks at blank lines, separator lines and lines that are a
record by themselves; all of it are expressions over the one row that holds the
text, so any partitioning of texts gives the same rows and nothing is shuffled.
The secret slot of a record leaves the parse as a keyed digest only.

Lines end at LF, CR LF or CR.  Defined cases: null and empty texts have no
record; a label given twice counts with its last value; an empty value takes the
next line, unless that is a comment or has a label itself; the bracketed
"[application=profile]" line precedes the labels of these names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.digests import digest_key, keyed

#: Field names of a sheet and the labels they go by.
SHEET_FIELDS = {
    "hostname": ("hostname", "computername", "computer name", "computer", "pcname", "pc name", "pc", "machine"),
    "username": ("username", "user name", "user", "account"),
    "ip_address": ("ip", "ip address", "ipaddress", "ip_address", "publicip", "public ip", "public_ip", "external ip"),
    "country": ("country", "location", "geo"),
    "hwid": ("hwid", "hardware id", "hardwareid", "hardware_id", "machine id", "machineid"),
    "os": ("os", "operating system", "operatingsystem", "os version", "windows version", "windows"),
    "cpu": ("cpu", "processor"),
    "gpu": ("gpu", "graphics", "videocard", "video card"),
    "ram": ("ram", "memory"),
    "timezone": ("timezone", "time zone", "time_zone", "tz"),
    "language": ("language", "lang", "locale"),
    "screen_size": ("screen", "screensize", "screen size", "resolution", "display"),
    "build": ("stealer", "malware", "build id", "build", "log type", "client"),
}
#: Labels of this project's own sheets beside the fixed ones.
OWN_LABELS = {"ip_address": ("address",), "country": ("region",)}
#: Labels of a record block.
BLOCK_FIELDS = {"url": ("url", "host", "hostname", "site"), "username": ("username", "user", "login", "email"), "secret": ("password", "pass", "pwd"), "application": ("application", "app", "browser", "soft"), "profile": ("profile",)}

_GAP = "[ \t]*"
SEPARATOR = r"(?:---+|===+|_{3,})\s*?"
LABEL = "[A-Za-z_]+"
HEAD = r'\["?([^"=\]\n]+)"?\s*=\s*"?([^"\]\n]+)"?\]'
#: What a line without a label must not begin with.
TAKEN = rf"{_GAP}(?:#|{HEAD}|{LABEL}{_GAP}[:=])"
_CUT = "\u0001"


def _triple(mark: str, group: str = "(") -> str:
    """The form of a URL-led line with two further fields after ``mark``; the last may hold it."""
    if mark == ":":
        # the address itself holds colons: the scheme's, and one before a port
        return rf"{group}https?://[^\s:]+(?::[0-9]+)?(?:/[^\s:]*)?):{group}[^:\n]+):{group}[^\n]+)"
    return rf"{group}https?://[^\s{mark}]+){_GAP}[{mark}]{_GAP}{group}[^{mark}\n]+?){_GAP}[{mark}]{group}[^\n]+)"


MARKS = ":|;"
#: In the order in which they are tried.
TRIPLES = tuple(_triple(m) for m in MARKS)
ALONE = "|".join(_triple(m, "(?:") for m in MARKS)


def _unix(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def _pieces(marked: Column) -> Column:
    trimmed = F.transform(F.split(marked, _CUT), lambda b: F.regexp_replace(b, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda b: b != "")


def _cut_at_separators(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?md)^(?:{_GAP}|{_GAP}{SEPARATOR})$", _CUT)


def blocks(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, block_no, block): the parts between blank and separator lines, in order."""
    parts = _pieces(_cut_at_separators(_unix(F.col(text))))
    return texts.select(key, F.posexplode(parts).alias("block_no", "block"))


def labelled(block: Column) -> Column:
    """A block's "label: value" or "label = value" lines as a map; the first of a label holds."""
    lines = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^\s*[^#:=\s][^:=]*[:=]\s*\S"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.regexp_extract(x, r"^(.+?)\s*[:=]", 1))).alias("k"), F.trim(F.regexp_extract(x, r"^.+?\s*[:=]\s*(.+)$", 1)).alias("v")))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.when(F.map_contains_key(m, p["k"]), m).otherwise(F.map_concat(m, F.create_map(p["k"], p["v"]))))


def sheets(texts: DataFrame, key: str, text: str, fields: dict[str, Sequence[str]] = SHEET_FIELDS, more: dict[str, Sequence[str]] = OWN_LABELS) -> DataFrame:
    """(key, block_no, field...): each block of a text as one sheet with the known fields."""
    parsed = blocks(texts, key, text).withColumn("m", labelled(F.col("block")))
    values = [F.coalesce(*[F.nullif(F.try_element_at("m", F.lit(n)), F.lit("")) for n in (*names, *more.get(f, ()))]).alias(f) for f, names in fields.items()]
    return parsed.filter(F.size("m") > 0).select(key, "block_no", *values)


def _part(line: Column, k: int) -> Column:
    """Field k of the first form that a whole line fits; null if none does."""
    found = [F.when(line.rlike(rf"^{form}$"), F.trim(F.regexp_extract(line, rf"^{form}$", k))) for form in TRIPLES]
    return F.coalesce(*found)


def delimited(lines: DataFrame, key: Sequence[str], line: str) -> DataFrame:
    """URL-led lines of three fields parted by ":", "|" or ";", tried in this order.

    The last field may hold the delimiter; it comes out as its length and keyed
    digest.  Spaces around "|" and ";" are not part of a field.
    """
    t, secret_key = F.trim(line), digest_key(lines.sparkSession)
    rows = lines.select(*key, _part(t, 1).alias("url"), _part(t, 2).alias("username"), _part(t, 3).alias("_last")).filter("url is not null")
    return rows.select(*key, "url", "username", F.length("_last").alias("last_length"), keyed(F.col("_last"), secret_key).alias("last_digest"))


def _of_block(block: Column) -> Column:
    """The record of one block: the fields of a record line, or the values of its labels."""
    # an empty value takes the next line in
    joined = F.regexp_replace(block, rf"(?md)^{_GAP}({LABEL}){_GAP}[:=]{_GAP}\n(?!{TAKEN}){_GAP}(\S.*)$", "$1=$4")

    def last(pattern: str, k: int) -> Column:
        return F.nullif(F.trim(F.try_element_at(F.regexp_extract_all(joined, F.lit(pattern), k), F.lit(-1))), F.lit(""))

    values = {f: F.coalesce(*[last(rf"(?mdi)^{_GAP}{n}{_GAP}[:=](.*)$", 1) for n in names]) for f, names in BLOCK_FIELDS.items()}
    bare = F.lit(None).cast("string")
    whole = _part(block, 1)
    return F.struct(
        F.coalesce(whole, F.when(values["url"].rlike("^https?://"), values["url"])).alias("url"),
        F.when(whole.isNotNull(), _part(block, 2)).otherwise(F.coalesce(values["username"], F.lit(""))).alias("username"),
        F.when(whole.isNotNull(), bare).otherwise(F.coalesce(last(rf"(?md)^{_GAP}{HEAD}", 1), values["application"])).alias("application"),
        F.when(whole.isNotNull(), bare).otherwise(F.coalesce(last(rf"(?md)^{_GAP}{HEAD}", 2), values["profile"])).alias("profile"),
        F.when(whole.isNotNull(), _part(block, 3)).otherwise(values["secret"]).alias("secret"),
    )


def parse_texts(texts: DataFrame, key: str, text: str, kept: Sequence[str] = ()) -> DataFrame:
    """(key, kept..., record_no, url, username, application, profile, digest): every record of each text, in order.

    A record needs a web address and a secret.
    """
    marked = F.regexp_replace(_unix(F.col(text)), rf"(?md)^{_GAP}({ALONE})$", f"{_CUT}$1{_CUT}")
    found = F.filter(F.transform(_pieces(_cut_at_separators(marked)), _of_block), lambda r: r["url"].isNotNull() & r["secret"].isNotNull())
    rows = texts.select(key, *kept, F.posexplode(found).alias("record_no", "r"))
    return rows.select(key, *kept, "record_no", "r.url", "r.username", "r.application", "r.profile", keyed(F.col("r.secret"), digest_key(texts.sparkSession)).alias("digest"))
