"""Encoded words (RFC 2047) in header text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from mailspark.functions import charset as C
from mailspark.functions import patterns as P
from mailspark.functions.body import base64_bytes, unhex_equals

# Characters per encoded word: at four bytes each, a word stays within 75 columns.
_CHARS_PER_WORD = 11


def decode_words(text: Column) -> Column:
    """Header text with its encoded words decoded; use inside ``java_charsets``.

    Blanks between two words go; a word in an unknown charset stays as it is.
    """
    joined = F.regexp_replace(text, P.BETWEEN_WORDS, "$1")
    pieces = F.regexp_extract_all(joined, F.lit(P.WORD_OR_TEXT), F.lit(0))
    return F.when(F.contains(text, F.lit("=?")), F.array_join(F.transform(pieces, _decode_piece), "")).otherwise(text)


def _decode_piece(piece: Column) -> Column:
    charset = F.lower(F.regexp_extract(piece, P.ENCODED_WORD, 1))
    encoding = F.lower(F.regexp_extract(piece, P.ENCODED_WORD, 2))
    payload = F.regexp_extract(piece, P.ENCODED_WORD, 3)
    data = F.when(encoding == "b", base64_bytes(payload)).otherwise(
        unhex_equals(F.replace(payload, F.lit("_"), F.lit(" ")))
    )
    known = charset.isin([*C.CHARSETS, *C.UTF8_NAMES])
    return F.when((encoding != "") & known, C.text(data, charset)).otherwise(piece)


def encode_words(text: Column) -> Column:
    """Text as base64 UTF-8 encoded words, one per line of a folded header."""
    chunks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_CHARS_PER_WORD}}}"), F.lit(0))

    def word(chunk: Column) -> Column:
        return F.concat(F.lit("=?UTF-8?B?"), F.base64(F.encode(chunk, "UTF-8")), F.lit("?="))

    return F.array_join(F.transform(chunks, word), "\r\n ")


def encode_text(text: Column) -> Column:
    """Header text as it is when printable, folded at blanks; as encoded words otherwise."""
    folded = F.regexp_replace(text, r"([^\r\n]{60,}?[^ ])(?= [^ ])", "$1\r\n")
    return F.when(F.regexp_like(text, F.lit(P.NEEDS_ENCODING)), encode_words(text)).otherwise(folded)
