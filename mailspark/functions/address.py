"""Addresses as text, as parsed structs, and back, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mailspark.functions import patterns as P


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\r\n"))


def _non_empty(text: Column) -> Column:
    return F.when(text != "", text)


def _unquote(phrase: Column) -> Column:
    inner = F.regexp_extract(phrase, r'(?s)^"(.*)"$', 1)
    plain = F.regexp_replace(inner, r"(?s)\\(.)", "$1")
    return F.when(F.startswith(phrase, F.lit('"')) & F.endswith(phrase, F.lit('"')), plain).otherwise(phrase)


def _cut(text: Column) -> Column:
    """One list entry -> struct(name, address), the name still quoted."""
    is_group = F.regexp_like(text, F.lit(rf"^{P.GROUP}\s*$"))
    is_angle = F.regexp_like(text, F.lit(f"^{P.IN_ANGLE}"))
    in_angle = F.regexp_extract(text, f"^{P.IN_ANGLE}", 1)
    phrase = F.regexp_extract(text, f"^{P.PHRASE}", 1)
    comment = F.regexp_extract(text, P.COMMENT_TEXT, 1)
    without_comment = F.regexp_replace(text, P.COMMENT, "")
    return F.struct(
        _strip(F.when(is_group, F.lit(None)).when(is_angle, phrase).otherwise(comment)).alias("name"),
        _strip(F.when(is_group, text).when(is_angle, in_angle).otherwise(without_comment)).alias("address"),
    )


def _name(cut: Column) -> Column:
    return F.struct(
        _non_empty(_unquote(cut.getField("name"))).alias("name"),
        cut.getField("address").alias("address"),
    )


def parse_addresses(texts: Column) -> Column:
    """Array of list entries -> array of struct(name, address); the name is null when there is none."""
    return F.transform(F.transform(texts, _cut), _name)


def parse_address(text: Column) -> Column:
    """One list entry -> struct(name, address)."""
    return F.get(parse_addresses(F.array(text)), F.lit(0))


def quote_name(name: Column) -> Column:
    """Display name as it stands in a header, quoted when it has special characters."""
    escaped = F.regexp_replace(name, r'(["\\])', r"\\$1")
    quoted = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(F.regexp_like(name, F.lit(P.NEEDS_QUOTES)), quoted).otherwise(name)


def bracket_address(address: Column) -> Column:
    """A bare address; one with special characters is put in angle brackets, a group is not."""
    bare = ~F.regexp_like(address, F.lit(P.NOT_SIMPLE)) | F.regexp_like(address, F.lit(rf"^{P.GROUP}$"))
    return F.when(bare, address).otherwise(F.concat(F.lit("<"), address, F.lit(">")))


def encode_address(parsed: Column) -> Column:
    """struct(name, address) -> ``Name <a@b>`` or ``a@b``; null stays null."""
    name, address = parsed.getField("name"), parsed.getField("address")
    named = F.concat(quote_name(name), F.lit(" <"), address, F.lit(">"))
    return F.when(parsed.isNotNull(), F.when(name.isNotNull(), named).otherwise(bracket_address(address)))


def encode_addresses(parsed: Column) -> Column:
    """Array of struct(name, address) -> array of texts, order and length kept."""
    return F.transform(parsed, encode_address)


def first(texts: Column) -> Column:
    """First entry, null when the array is null or empty."""
    return F.get(texts, F.lit(0))


def encode_first_address(parsed: Column) -> Column:
    return encode_address(first(parsed))


def mailboxes(parsed: Column) -> Column:
    """Array of struct(name, address) -> array of bare addresses, groups replaced by their members."""

    def members(one: Column) -> Column:
        address = one.getField("address")
        listed = split_addresses(F.regexp_extract(address, P.GROUP_MEMBERS, 1))
        bare = F.transform(parse_addresses(listed), lambda m: m.getField("address"))
        return F.when(F.regexp_like(address, F.lit(rf"^{P.GROUP}$")), bare).otherwise(F.array(address))

    return F.flatten(F.transform(parsed, members))


def split_addresses(header: Column) -> Column:
    """Header text -> array of its entries, as written."""
    entries = F.transform(F.regexp_extract_all(header, F.lit(P.LIST_ENTRY), F.lit(0)), _strip)
    return F.filter(entries, lambda e: e != "")


def clean_list(header: Column) -> Column:
    """Header text without outer blanks and without quotes that a name does not need."""
    text = _strip(header)
    unquoted = F.regexp_replace(text, P.NEEDLESS_QUOTES, "$1$2")
    return F.when(F.contains(text, F.lit('"')), unquoted).otherwise(text)


def list_entries(text: Column) -> Column:
    """Clean header text -> array of address texts; null when there is none.

    A list of plain names is split as it is; others are parsed entry by entry.
    """
    entries = F.regexp_extract_all(text, F.lit(P.CANONICAL_ENTRY), F.lit(0))
    parsed = encode_addresses(parse_addresses(split_addresses(text)))
    return F.when(F.regexp_like(text, F.lit(P.CANONICAL_LIST)), entries).when(
        F.regexp_like(text, F.lit(r"[^\s,;]")), parsed
    )


def addresses(header: Column) -> Column:
    """Header text -> array of address texts; null when null or without any. Encoded words are kept."""
    return list_entries(clean_list(header))


def with_addresses(frame: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Replace columns of header text by arrays of address texts.

    All go through one array, so that the grammar stands in the plan once and not in one generated
    method that is too long to be compiled.
    """
    if not headers:
        return frame
    cleaned = F.transform(F.array(*headers), clean_list)
    frame = frame.withColumn("__addresses", F.transform(cleaned, list_entries))
    return frame.withColumns({h: F.get("__addresses", F.lit(i)) for i, h in enumerate(headers)})


def decode_address(text: Column, strict: bool = True) -> Column:
    """Address text -> struct(name, address); null stays null.

    Text that is not exactly one address fails the query, or gives null when not ``strict``.
    """
    return F.get(decode_addresses(F.array(text), strict), F.lit(0))


def decode_addresses(texts: Column, strict: bool = True) -> Column:
    """Array of address texts -> array of struct(name, address); null stays null, also inside."""

    def checked(text: Column) -> Column:
        valid = F.regexp_like(text, F.lit(P.VALID_ADDRESS)) & ~F.regexp_like(text, F.lit(P.LINE_BREAK))
        problem = F.raise_error(F.concat(F.lit("Illegal address: "), text)).cast("string")
        return F.when(text.isNull() | valid, text).otherwise(problem if strict else F.lit(None))

    def whole(text: Column, parsed: Column) -> Column:
        return F.when(text.isNotNull(), parsed)

    good = F.transform(texts, checked)
    return F.zip_with(good, parse_addresses(good), whole)
