"""Transfer encodings and message bodies, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_HEX = "[0-9A-Fa-f]"

# ``=XX`` of a byte, as the percent form of the Latin-1 character with that number in UTF-8.
_BYTE_AS_PERCENT = [
    (rf"=([0-7]{_HEX})", "%$1"),
    (rf"=([89ABab]{_HEX})", "%C2%$1"),
    (rf"=[Cc]({_HEX})", "%C3%8$1"),
    (rf"=[Dd]({_HEX})", "%C3%9$1"),
    (rf"=[Ee]({_HEX})", "%C3%A$1"),
    (rf"=[Ff]({_HEX})", "%C3%B$1"),
]


def latin1(data: Column) -> Column:
    """Bytes as text with one character per byte."""
    return F.decode(data, "ISO-8859-1")


def unhex_equals(text: Column) -> Column:
    """Latin-1 text with ``=XX`` escapes -> bytes; anything that is no escape stays."""
    percent = F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B"))
    for pattern, form in _BYTE_AS_PERCENT:
        percent = F.regexp_replace(percent, pattern, form)
    return F.encode(F.url_decode(percent), "ISO-8859-1")


def quoted_printable(data: Column) -> Column:
    """Quoted-printable bytes -> bytes; line ends in the text are kept as they are."""
    text = F.regexp_replace(latin1(data), r"(?<![ \t])[ \t]++(?=\r?\n|\z)", "")
    text = F.replace(F.replace(text, F.lit("=\r\n"), F.lit("")), F.lit("=\n"), F.lit(""))
    return unhex_equals(text)


def base64_bytes(text: Column) -> Column:
    """Base64 text -> bytes; characters outside the alphabet are skipped, missing padding is allowed."""
    letters = F.regexp_replace(F.substring_index(text, "=", 1), "[^A-Za-z0-9+/]", "")
    usable = F.left(letters, F.length(letters) - F.when(F.length(letters) % 4 == 1, 1).otherwise(0))
    return F.coalesce(F.try_to_binary(text, F.lit("base64")), F.unbase64(usable))


def body_bytes(body: Column, transfer_encoding: Column) -> Column:
    """Body with its transfer encoding undone; a multipart body is passed through."""
    encoding = F.lower(F.trim(transfer_encoding))
    return (
        F.when(encoding == "base64", base64_bytes(latin1(body)))
        .when(encoding == "quoted-printable", quoted_printable(body))
        .otherwise(body)
    )


def charset_of(content_type: Column) -> Column:
    """Lower-case charset parameter of a Content-Type value, or null."""
    found = F.lower(F.regexp_extract(content_type, r"(?i);\s*+charset\s*+=\s*+\"?([^\s\";]++)", 1))
    return F.when(found != "", found)


def blank_lines(text: Column) -> list[Column]:
    """Where Latin-1 text has its first blank line: ``__top`` long at the start, ``__crlf``, ``__lf``."""
    top = F.when(F.startswith(text, F.lit("\r\n")), 2).when(F.startswith(text, F.lit("\n")), 1).otherwise(0)
    return [
        top.alias("__top"),
        F.locate("\n\r\n", text).alias("__crlf"),
        F.locate("\n\n", text).alias("__lf"),
    ]


def head_length(raw: Column) -> Column:
    """Number of bytes up to and including the blank line; all bytes when there is none."""
    top, crlf, lf = F.col("__top"), F.col("__crlf"), F.col("__lf")
    return (
        F.when(top > 0, top)
        .when((crlf > 0) & ((lf == 0) | (crlf < lf)), crlf + 2)
        .when(lf > 0, lf + 1)
        .otherwise(F.octet_length(raw))
    )


def only_part(body: Column) -> Column:
    """Bytes of the first part of a multipart body text, its own transfer encoding undone."""
    head = F.regexp_extract(body, r"(?s)^--[^\r\n]*+\r\n(.*?\r\n)\r\n", 1)
    content = F.regexp_extract(body, r"(?s)^--[^\r\n]*+\r\n.*?\r\n\r\n(.*)\r\n--[^\r\n]*+\r\n$", 1)
    is_base64 = F.regexp_like(head, F.lit(r"(?im)^content-transfer-encoding:\s*base64"))
    return F.when(is_base64, base64_bytes(content)).otherwise(F.encode(content, "UTF-8"))
