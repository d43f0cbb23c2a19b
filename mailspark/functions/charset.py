"""Bytes -> text in any charset, without failing on malformed input."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import Column, SparkSession, functions as F

from mailspark.session import settings

# Charset names read with the JVM's decoders, as mail headers spell them. UTF-8 and
# ASCII need none; text in a charset listed nowhere is read as UTF-8.
CHARSETS = (
    "iso-8859-1 iso-8859-2 iso-8859-3 iso-8859-4 iso-8859-5 iso-8859-6 iso-8859-7 iso-8859-8 iso-8859-9 "
    "iso-8859-13 iso-8859-15 latin1 "
    "windows-1250 windows-1251 windows-1252 windows-1253 windows-1254 windows-1255 windows-1256 "
    "windows-1257 windows-1258 cp1250 cp1251 cp1252 cp437 cp850 cp866 koi8-r koi8-u tis-620 "
    "gb2312 gbk gb18030 big5 big5-hkscs shift_jis euc-jp iso-2022-jp euc-kr iso-2022-kr "
    "utf-16 utf-16be utf-16le utf-32 utf-32be utf-32le"
).split()
UTF8_NAMES = ["utf-8", "utf8", "us-ascii", "ascii", "ansi_x3.4-1968"]


def java_charsets(spark: SparkSession) -> AbstractContextManager[None]:
    """Let ``decode`` take every JVM charset and replace malformed bytes.

    Both settings are fixed in an expression when the DataFrame holding it is made, so they need to
    hold only while decoding columns are added.
    """
    return settings(
        spark, {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"}
    )


def utf8_text(data: Column) -> Column:
    """Bytes as UTF-8; malformed ones become U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))


def text(data: Column, charset: Column) -> Column:
    """Bytes as text in a charset named by a lower-case column; use inside ``java_charsets``."""
    return F.when(charset.isin(CHARSETS), F.call_function("decode", data, charset)).otherwise(utf8_text(data))


def fixed_text(data: Column, charset: str) -> Column:
    """Bytes as text in one charset for all rows; use inside ``java_charsets``."""
    if charset.lower() in UTF8_NAMES:
        return utf8_text(data)
    return F.decode(data, charset)
