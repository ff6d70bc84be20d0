"""What a file's name, type and size say about it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File endings that are never archives or texts of interest.
REJECTED_ENDINGS = (
    "exe", "msi", "dll", "bat", "cmd", "com", "scr", "pif", "vbs", "vbe", "js", "jse", "wsf", "wsh", "ps1", "psm1", "apk", "app", "dmg", "pkg", "deb",
    "rpm", "bin", "run", "jpg", "jpeg", "png", "gif", "bmp", "ico", "svg", "webp", "tif", "tiff", "psd", "raw", "heif", "heic", "mp4", "avi", "mkv",
    "mov", "wmv", "flv", "webm", "m4v", "mpg", "mpeg", "3gp", "3g2", "mp3", "wav", "flac", "aac", "ogg", "wma", "m4a", "doc", "docx", "xls", "xlsx",
    "ppt", "pptx", "odt", "iso", "img", "vmdk", "vhd", "qcow2", "torrent", "nfo",
)
#: Media types that are rejected.
REJECTED_TYPES = (
    "application/x-msdownload", "application/x-executable", "application/x-dosexec", "application/vnd.android.package-archive", "image/jpeg",
    "image/png", "image/gif", "image/webp", "image/bmp", "image/svg+xml", "video/mp4", "video/x-msvideo", "video/x-matroska", "video/quicktime",
    "video/webm", "audio/mpeg", "audio/wav", "audio/flac", "audio/ogg",
)
#: Endings and media types of archives; the last type counts only with a likely size.
ARCHIVE_ENDINGS = ("zip", "7z", "rar", "tar", "gz", "tgz", "bz2", "xz", "lzma")
ARCHIVE_TYPES = (
    "application/zip", "application/x-zip-compressed", "application/x-7z-compressed", "application/x-rar-compressed", "application/vnd.rar", "application/x-tar",
    "application/gzip", "application/x-gzip", "application/x-bzip2", "application/x-xz", "application/x-lzma",
)
MEGABYTE = 1024 * 1024
TEXT_NAMES = r"(?i)(record|login|account|mirror|list)"
SPLIT = r"^(.+?)\.(part[0-9]+\.(zip|rar|7z)|r[0-9]{2,}|z[0-9]{2}|[0-9]{3})$"


def ending(name: Column) -> Column:
    return F.regexp_extract(F.lower(name), r"[^.]\.([^.]*)$", 1)


def attachment_class(name: Column, mime: Column, size: Column) -> Column:
    """One of rejected, split, archive, text, untyped or other, by the first rule that holds."""
    low, kind, end = F.lower(F.coalesce(name, F.lit(""))), F.coalesce(mime, F.lit("")), ending(F.coalesce(name, F.lit("")))
    return (
        F.when(end.isin(*REJECTED_ENDINGS), "rejected")
        .when(kind.isin(*REJECTED_TYPES), "rejected")
        .when(low.rlike(SPLIT), "split")
        .when(end.isin(*ARCHIVE_ENDINGS), "archive")
        .when((end == "txt") & low.rlike(TEXT_NAMES), "text")
        .when(kind.isin(*ARCHIVE_TYPES), "archive")
        .when((kind == "application/octet-stream") & (size > MEGABYTE) & (size < 500 * MEGABYTE), "untyped")
        .otherwise("other")
    )


def download_priority(name: Column) -> Column:
    """0 for archives in one file, 1 for parts, 2 for the rest."""
    low = F.lower(name)
    return F.when(low.rlike(SPLIT), 1).when(low.rlike(r"\.(zip|rar|7z)$"), 0).otherwise(2)


#: A generic rule table: label, pattern on file names, pattern on content; the first label that hits holds.
FAMILY_RULES = (("listing", r"listing", r"\.(rar|zip|7z)"), ("log", r"log|backlog", r"(INFO|WARN|ERROR) job="), ("sheet", r"sheet", r"(?m)^(Machine|Build) ="), ("note", r"note|appendix", r"(?i)reviewer|analyst"))


def family(name: Column, content: Column) -> Column:
    """Label by self-description ("type: x" in a line), else by name, else by content."""
    own = F.nullif(F.regexp_extract(content, r"(?im)^type\s*[:=]\s*([^\n]{1,50})$", 1), F.lit(""))
    by_name, by_content = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, in_name, in_content in reversed(FAMILY_RULES):
        by_name = F.when(F.lower(name).rlike(in_name), label).otherwise(by_name)
        by_content = F.when(content.rlike(in_content), label).otherwise(by_content)
    return F.coalesce(own, by_name, by_content)
