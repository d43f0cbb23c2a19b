"""Header block -> header lines and values, as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

_BLANKS = " \t"


def head_text(head: Column) -> Column:
    """The header block as text, each line led by a newline: UTF-8 if it is valid, else Latin-1."""
    as_utf8 = head.cast("string")
    text = F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(head, "ISO-8859-1"))
    return F.concat(F.lit("\n"), text)


def unfold(text: Column) -> Column:
    """Join continuation lines; the line ends become a plain newline."""
    lf = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.replace(F.replace(lf, F.lit("\n "), F.lit(" ")), F.lit("\n\t"), F.lit("\t"))


def named_headers(head: Column, names: Iterable[str]) -> Column:
    """The named headers of a head as array of struct(key, value), keys in lower case, in order.

    One pass over a head of some kilobytes; all lookups then look at these few entries only.
    """
    wanted = "|".join(sorted(set(names)))
    pattern = rf"(?i)\n((?:{wanted})[ \t]*+:[^\r\n]*+(?:\r?\n[ \t][^\r\n]*+)*+)"

    def entry(line: Column) -> Column:
        colon = F.instr(line, ":")
        return F.struct(
            F.lower(F.rtrim(F.left(line, colon - 1), F.lit(_BLANKS))).alias("key"),
            F.ltrim(unfold(F.substr(line, colon + 1)), F.lit(_BLANKS)).alias("value"),
        )

    return F.transform(F.regexp_extract_all(head_text(head), F.lit(pattern), F.lit(1)), entry)


def header_value(headers: Column, name: str) -> Column:
    """First value of one header, or null."""
    return F.get(F.filter(headers, lambda h: h.getField("key") == name), F.lit(0)).getField("value")


def header_list(headers: Column, name: str) -> Column:
    """All values of one header as one comma-separated list, or null when absent."""
    found = F.filter(headers, lambda h: h.getField("key") == name)
    return F.when(F.size(found) > 0, F.array_join(found.getField("value"), ","))


def encode_header(line: Column) -> Column:
    """``Name: value`` -> struct(key, value)."""
    return F.struct(
        F.rtrim(F.substring_index(line, ":", 1)).alias("key"),
        F.regexp_replace(line, r"^[^:]*+:?[ \t]*+", "").alias("value"),
    )


def encode_headers(lines: Column) -> Column:
    """Header lines -> array of struct(key, value), order and duplicates kept."""
    return F.transform(lines, encode_header)


def all_headers(head: Column) -> Column:
    """Every header of the block, unfolded."""
    lines = F.split(unfold(head_text(head)), "\n")
    return encode_headers(F.filter(lines, lambda line: F.contains(line, F.lit(":"))))
