"""Texts from files of unknown encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.session import ship


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, length, modificationTime) of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).select("path", "length", "modificationTime")


def first_parts(listing: DataFrame) -> DataFrame:
    """Of split sets only the first part."""
    name = F.lower(F.regexp_extract("path", "[^/]+$", 0))
    part = F.regexp_extract(name, r"\.part0*([0-9]+)\.(?:zip|rar|7z)$|\.(?:7z|zip)\.0*([0-9]+)$", 1)
    other = F.regexp_extract(name, r"\.part0*([0-9]+)\.(?:zip|rar|7z)$|\.(?:7z|zip)\.0*([0-9]+)$", 2)
    number = F.coalesce(F.nullif(part, F.lit("")), F.nullif(other, F.lit("")))
    return listing.filter(number.isNull() | (number == "1"))


def is_binary(content: Column) -> Column:
    """Three zero bytes in a row among the first 8 KB, without a UTF-16 mark."""
    head = F.hex(F.substring(content, 1, 8192))
    return head.rlike("^(?:[0-9A-F]{2})*?000000") & ~head.rlike("^(FFFE|FEFF)")


#: What Windows-1252 has in place of Latin-1's control characters, where it has anything.
_SIGNED = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
_CONTROLS, _SIGNS = ("".join(x) for x in zip(*[pair for pair in _SIGNED if pair[1]]))


def decoded(content: Column) -> Column:
    """Text by byte-order mark, else UTF-16 if every other byte of its beginning is zero, else UTF-8 if valid.

    Of the single-byte encodings Windows-1252 is taken if a byte of 80 to 9F
    occurs, which Latin-1 has for control characters only.
    """
    head, start = F.hex(F.substring(content, 1, 3)), F.hex(F.substring(content, 1, 64))
    return (
        F.when(head.startswith("FFFE") | head.startswith("FEFF"), F.decode(content, "UTF-16"))
        .when(head == "EFBBBF", F.decode(F.substring(content, 4, 1 << 30), "UTF-8"))
        .when(start.rlike("^(?:(?!00)[0-9A-F]{2}00)+$"), F.decode(content, "UTF-16LE"))
        .when(start.rlike("^(?:00(?!00)[0-9A-F]{2})+$"), F.decode(content, "UTF-16BE"))
        .when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
        .when(F.hex(content).rlike("^(?:[0-9A-F]{2})*?[89]"), F.translate(F.decode(content, "ISO-8859-1"), _CONTROLS, _SIGNS))
        .otherwise(F.decode(content, "ISO-8859-1"))
    )


def read_texts(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """(path, text) of the text files below a folder; binary files are left out."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).select("path", "content")
    return raw.filter(~is_binary(F.col("content"))).select("path", decoded(F.col("content")).alias("text"))


def load_folder(spark: SparkSession, folder: str, target: str, glob: str = "*.txt") -> int:
    """Parse the text files below a folder and append the records that the table at ``target`` lacks; returns how many.

    A record is known by its address, name and keyed digest; of one that occurs
    several times the first file by name has it.  Loading a folder again adds nothing.
    """
    from siltstone.operators.records import parse_texts
    from siltstone.sources.sinks import append_new

    found = parse_texts(read_texts(spark, folder, glob), "path", "text")
    key = F.sha2(F.concat_ws("\u0001", "url", "username", "digest"), 256)
    return append_new(found.withColumn("record_key", key), target, "record_key", F.struct("path", "record_no"))


def line_chunks(texts: DataFrame, key: str, text: str, least: int = 100_000) -> DataFrame:
    """(key, chunk_no, chunk): texts cut into chunks of about ``least`` lines at blank or separator lines.

    A stretch without such a line is cut at four times as many lines.  Lines end at LF, CR LF or CR.
    """
    from collections.abc import Iterator

    import pandas as pd

    ship(texts.sparkSession)
    kind = texts.schema[key].dataType.simpleString()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for k, t in zip(pdf[key], pdf[text]):
                lines = (t or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")
                begin = n = 0
                for at, line in enumerate(lines, 1):
                    edge = set(line.strip()) in (set(), {"-"}, {"="}, {"_"})
                    if at == len(lines) or at - begin >= (least if edge else 4 * least):
                        rows.append((k, n, "\n".join(lines[begin:at])))
                        begin, n = at, n + 1
            yield pd.DataFrame(rows, columns=[key, "chunk_no", "chunk"])

    return texts.select(key, text).mapInPandas(cut, f"{key} {kind}, chunk_no int, chunk string")
