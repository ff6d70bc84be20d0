"""Scalar expressions over text: addresses, names, hints, clean-up, formatting.

All are built-in expressions and stay in generated code, except
:func:`group_key`, whose compatibility normalisation has no built-in and runs
as an Arrow-batched function.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def stripped(c: Column) -> Column:
    """Without white space at either end, that of Unicode included."""
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


# -- addresses -----------------------------------------------------------------
def url_domain(c: Column) -> Column:
    """What stands between the scheme and the first slash, as written, port included."""
    rest = F.when(c.rlike("^https?://"), F.regexp_replace(c, "^https?://", "")).otherwise(F.regexp_replace(c, "^.*?//", ""))
    return F.split_part(rest, F.lit("/"), F.lit(1))


def host(c: Column) -> Column:
    """The domain in lower case without user, port and query."""
    return F.lower(F.regexp_replace(F.regexp_replace(url_domain(c), "^[^@]*@", ""), "[:?#].*$", ""))


def email_domain(c: Column) -> Column:
    """The piece after the first @, in lower case; null without one."""
    return F.lower(F.try_element_at(F.split(c, "@"), F.lit(2)))


def valid_url(c: Column) -> Column:
    t = stripped(c)
    return F.when(t.rlike("^https?://"), t)


# -- fields ----------------------------------------------------------------------
def truncated(c: Column, n: int) -> Column:
    return F.substring(F.replace(c, F.lit("\x00"), F.lit("")), 1, n)


#: How adverts begin that stand behind a value, and those in brackets behind a name.
ADVERT = r"(?i)\s*(?:┃|\|)?\s*(?:https?://)?t\.me/[^\s]+.*$|\s*(?:you\s+can\s+buy|to\s+buy|dm\s+@)[^\r\n]*$"
BRACKET_ADVERT = r"(?i)\s*\[.*?(?:to\s+buy|buy|dm)\b.*$"


def cleaned(c: Column, name: bool = False) -> Column:
    """Trimmed, and cut where an advert begins; the costly patterns run only behind a cheap test."""
    t = stripped(F.replace(c, F.lit("\x00"), F.lit("")))
    if name:
        t = F.when(t.contains("["), stripped(F.regexp_replace(t, BRACKET_ADVERT, ""))).otherwise(t)
    low = F.lower(t)
    return F.when(low.contains("t.me") | low.contains("buy") | low.contains("dm @"), stripped(F.regexp_replace(t, ADVERT, ""))).otherwise(t)


#: Placeholders in place of a name, and of a secret.
NAME_PLACEHOLDERS = ("null", "undefined", "user", "username", "example", "sample", "test")
SECRET_PLACEHOLDERS = ("null", "undefined", "password", "pass")


def is_placeholder(c: Column, words: Sequence[str] = NAME_PLACEHOLDERS) -> Column:
    """Whole-value placeholders of at most 15 characters, or mark-up at any length."""
    return F.coalesce(((F.length(c) <= 15) & F.lower(c).isin(*words)) | c.contains("<br>") | c.contains("██"), F.lit(False))


def first_label(m: Column, names: Sequence[str]) -> Column:
    """The first non-empty value of a map under any of these names."""
    return F.coalesce(*[F.nullif(F.try_element_at(m, F.lit(n)), F.lit("")) for n in names])


def hash64(c: Column) -> Column:
    """The leading 16 hexadecimal digits as a signed number."""
    return F.conv(F.substring(c, 1, 16), 16, -10).cast("long")


def matched_fields(needle: str, columns: Sequence[str]) -> Column:
    """Names of the columns that contain the needle, whatever the case."""
    return F.array_compact(F.array(*[F.when(F.lower(c).contains(needle.lower()), F.lit(c)) for c in columns]))


# -- archive names -------------------------------------------------------------
#: Digits are written [0-9] here and below: \\d takes other scripts' digits in some engines and only these in others.
#: Forms of split-archive names, first match holds; the last column names the part's group.
SPLIT_FORMS = (
    (r"(?i)^(.+?)\.part([0-9]+)\.(?:zip|rar|7z)$", True),
    (r"(?i)^(.+?)\.r([0-9]{2,})$", True),
    (r"(?i)^(.+?)[-_]?([0-9]+)of[0-9]+\.(?:zip|rar|7z)$", True),
    (r"(?i)^(.+?)\.rar$", False),
    (r"(?i)^(.+?)\.7z\.([0-9]{3})$", True),
    (r"(?i)^(.+?)\.zip\.([0-9]{3})$", True),
    (r"(?i)^(.+?)\.z([0-9]{2})$", True),
    (r"^(.+?)\.([0-9]{3})$", True),
    (r"(?i)^(.+?)[-_]?(?:vol|volume)[-_]?([0-9]+)\.(?:zip|rar|7z)$", True),
)


def _first_form(c: Column, group: int) -> Column:
    out = None
    for form, numbered in SPLIT_FORMS:
        got = F.regexp_extract(c, form, 1) if group == 1 else (F.regexp_extract(c, form, 2) if numbered else F.lit(None).cast("string"))
        out = F.when(c.rlike(form), got) if out is None else out.when(c.rlike(form), got)
    return out


def split_base(c: Column) -> Column:
    return _first_form(c, 1)


def split_part_number(c: Column) -> Column:
    return _first_form(c, 2).try_cast("int")


def split_total(c: Column) -> Column:
    """The Y of an XofY anywhere in a name that has one of the forms."""
    total = F.nullif(F.regexp_extract(c, r"(?i)[0-9]+of([0-9]+)", 1), F.lit(""))
    return F.when(split_base(c).isNotNull(), total.try_cast("int"))


#: Ways to say "part X of Y".
PART_HINTS = (r"(?i)part\s*([0-9]+)\s*(?:of|/)\s*([0-9]+)", r"(?i)([0-9]+)\s*(?:of|/)\s*([0-9]+)\s*parts?", r"\[([0-9]+)/([0-9]+)\]", r"(?i)#([0-9]+)\s*(?:of|/)\s*([0-9]+)")


def part_hint(c: Column, group: int) -> Column:
    """Group 1: the part; group 2: the number of parts; of the first form that occurs."""
    out = None
    for form in PART_HINTS:
        got = F.regexp_extract(c, form, group).try_cast("int")
        out = F.when(c.rlike(form), got) if out is None else out.when(c.rlike(form), got)
    return out


# -- mentions ------------------------------------------------------------------
#: The form of a name, and of a link to one ("+" before an invitation).
HANDLE = r"[a-zA-Z][a-zA-Z0-9_]{3,30}[a-zA-Z0-9]"
INVITE_LINK = r"(?i)(?:t\.me|telegram\.me)/\+([a-zA-Z0-9_-]+)"
NAME_LINK = rf"(?i)(?:t\.me|telegram\.me)/({HANDLE})"
#: Names that are services or programs rather than channels.
NO_CHANNELS = ("everyone", "admin", "here", "gmail", "yahoo", "hotmail", "outlook", "icloud", "mail", "email", "android", "iphone", "windows", "linux", "macos", "chrome", "firefox", "safari", "edge", "opera", "brave")


def _lowered(found: Column, without: Column | None = None, deny: Sequence[str] = NO_CHANNELS) -> Column:
    out = F.array_except(F.transform(found, lambda x: F.lower(x)), F.array(*[F.lit(d) for d in deny]))
    return F.array_distinct(out if without is None else F.array_except(out, F.transform(without, lambda x: F.lower(x))))


def mentions(c: Column, deny: Sequence[str] = NO_CHANNELS) -> Column:
    """Distinct @names in lower case that are no mail host and not on the deny list."""
    text = F.coalesce(c, F.lit(""))
    hosts = F.regexp_extract_all(text, F.lit(rf"[A-Za-z0-9._%+-]@({HANDLE})"), 1)
    return _lowered(F.regexp_extract_all(text, F.lit(rf"@({HANDLE})"), 1), hosts, deny)


def linked_names(c: Column, deny: Sequence[str] = NO_CHANNELS) -> Column:
    """Distinct names that links lead to, in lower case."""
    return _lowered(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NAME_LINK), 1), None, deny)


def invitations(c: Column) -> Column:
    """Distinct invitation codes that links lead to, as written."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(INVITE_LINK), 1))


# -- keys for look-alike names --------------------------------------------------
#: Letters of other scripts and the Latin letters they look like.
LOOKALIKES_FROM = "АВСЕНКМОРТХУаеорсухіјкмнтвΑΒΕΖΗΙΚΜΝΟΡΤΥΧαβγικμνορτυχ"
LOOKALIKES_TO = "ABCEHKMOPTXYaeopcyxijkmhtbABEZHIKMNOPTYXabyikmvoptux"


def _fold(value: str | None) -> str | None:
    if value is None:
        return None
    table = str.maketrans(LOOKALIKES_FROM, LOOKALIKES_TO)
    return re.sub(r"[\s._-]+", " ", unicodedata.normalize("NFKC", value).translate(table).casefold()).strip()


def group_key(c: Column) -> Column:
    """Compatibility form, look-alikes as Latin, case folded, runs of separators as a space.

    Plain ASCII values, most of them, never leave the JVM.
    """

    def fold(s: pd.Series) -> pd.Series:
        return s.map(_fold)

    folded = F.pandas_udf(fold, StringType())
    plain = F.trim(F.regexp_replace(F.lower(c), r"[\s._-]+", " "))
    return F.when(c.rlike(r"^[\x00-\x7F]*$"), plain).otherwise(folded(F.when(~c.rlike(r"^[\x00-\x7F]*$"), c)))


# -- rendering -------------------------------------------------------------------
#: Marks that stand on both sides of a text, longer ones first.
EMPHASIS = ("`", "**", "__", "*", "_")
#: Entities and what they stand for; the ampersand last, so that nothing is resolved twice.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def _between(mark: str) -> str:
    """A text between two marks; a single star or line is none if it is one half of a double mark."""
    one, m = f"\\{mark[0]}", "".join(f"\\{x}" for x in mark)
    alone = mark in ("*", "_")
    return (f"(?<!{one})" if alone else "") + f"{m}([^{one}]+){m}" + (f"(?!{one})" if alone else "")


def without_markdown(c: Column) -> Column:
    """Links and pictures by their text, code and emphasis without marks, common entities resolved."""
    c = F.regexp_replace(c, r"!?\[([^\]]+)\]\([^)]+\)", "$1")
    for mark in EMPHASIS:
        c = F.regexp_replace(c, _between(mark), "$1")
    for entity, sign in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return c


def masked(c: Column) -> Column:
    """First and last character with bullets between and the length; short values all bullets."""
    n = F.length(c)
    return F.when(c.isNull() | (n == 0), "—").when(n <= 2, F.repeat(F.lit("•"), n)).otherwise(F.concat(F.substring(c, 1, 1), F.repeat(F.lit("•"), n - 2), F.right(c, F.lit(1)), F.lit(" ("), n.cast("string"), F.lit(" chars)")))


def grouped_digits(c: Column) -> Column:
    return F.coalesce(F.format_number(c, 0), F.lit("—"))


def duration(seconds: Column) -> Column:
    """Seconds as 5s, 2m 5s or 1h 2m."""
    s = seconds.cast("long")
    t = lambda x: F.floor(x).cast("string")
    return F.when(s.isNull(), "—").when(s < 60, F.concat(t(s), F.lit("s"))).when(s < 3600, F.concat(t(s / 60), F.lit("m "), t(s % 60), F.lit("s"))).otherwise(F.concat(t(s / 3600), F.lit("h "), t(s % 3600 / 60), F.lit("m")))


def rate(count: Column, seconds: Column) -> Column:
    """Whole units a second as 1,234/s; a dash without a time."""
    per = F.when(seconds > 0, count / seconds)
    return F.coalesce(F.concat(F.format_number(F.bround(per, 0), 0), F.lit("/s")), F.lit("—"))


def safe_filename(c: Column, n: int = 200) -> Column:
    return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_"), 1, n)


# -- scores ------------------------------------------------------------------------
def weighted_score(weight: Column, confidence: Column, won: Column, lost: Column) -> Column:
    """Weight times confidence times history, raised for any win, halved after three losses, in 0..1."""
    history = F.when(won + lost > 0, 0.5 + 0.5 * won / F.nullif(won + lost, F.lit(0))).otherwise(1.0)
    score = weight * confidence * history
    score = F.when(won > 0, F.least(F.lit(1.0), score * 1.2)).otherwise(score)
    score = F.when(lost > 2, score * 0.5).otherwise(score)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))


def explanation(origin: Column, won: Column, lost: Column, confidence: Column) -> Column:
    """The parts that apply, joined by semicolons."""
    level = F.when(confidence >= 0.9, "high confidence").when(confidence >= 0.7, "medium confidence").when(confidence < 0.5, "low confidence")
    times = lambda word, n: F.when(n > 0, F.concat(F.lit(word + " "), n.cast("string"), F.lit("x")))
    return F.concat_ws("; ", origin, times("succeeded", won), times("failed", lost), level)
