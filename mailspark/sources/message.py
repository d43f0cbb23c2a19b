"""One fetched message -> one row, for tables declared on a live folder.

The same rules as the Column expressions in ``mailspark.functions``, over the same patterns; here a
task holds one page of a server's answer, and the server is what limits it.
"""

from __future__ import annotations

import base64
import json
import quopri
import re
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from typing import Any

from pyspark.sql import types as T

from mailspark import metadata as M
from mailspark.functions import patterns as P
from mailspark.functions.charset import CHARSETS, UTF8_NAMES
from mailspark.functions.date import ZONES
from mailspark.functions.formats import check_raw, split_options

Message = dict[str, Any]


# -- headers --------------------------------------------------------------------------------------


def head_text(head: bytes) -> str:
    try:
        text = head.decode("utf-8")
    except UnicodeDecodeError:
        text = head.decode("iso-8859-1")
    return "\n" + text.replace("\r\n", "\n").replace("\n ", " ").replace("\n\t", "\t")


def values(text: str, name: str) -> list[str]:
    return re.findall(rf"(?i)\n{name}[ \t]*+:[ \t]*+([^\r\n]*+)", text)


def value(text: str, name: str) -> str | None:
    return next(iter(values(text, name)), None)


def all_headers(text: str) -> list[tuple[str, str]]:
    lines = [line for line in text.split("\n") if ":" in line]
    return [(line.split(":", 1)[0].rstrip(" "), line.split(":", 1)[1].lstrip(" \t")) for line in lines]


# -- addresses ------------------------------------------------------------------------------------


def _matches(pattern: str, text: str) -> bool:
    return re.search(pattern, text) is not None


def parse_address(text: str) -> tuple[str | None, str]:
    """One list entry -> (name, address)."""
    if _matches(rf"^{P.GROUP}\s*$", text):
        return None, text.strip()
    angle = re.search(f"^{P.IN_ANGLE}", text)
    if angle:
        phrase = re.search(f"^{P.PHRASE}", text)[1].strip()
        quoted = re.fullmatch(r'(?s)"(.*)"', phrase)
        return (re.sub(r"(?s)\\(.)", r"\1", quoted[1]) if quoted else phrase) or None, angle[1].strip()
    comment = re.search(P.COMMENT_TEXT, text)
    return (comment[1].strip() if comment else "") or None, re.sub(P.COMMENT, "", text).strip()


def format_address(name: str | None, address: str) -> str:
    if name is not None:
        if _matches(P.NEEDS_QUOTES, name):
            escaped = re.sub(r'(["\\])', r"\\\1", name)
            name = f'"{escaped}"'
        return f"{name} <{address}>"
    bare = not _matches(P.NOT_SIMPLE, address) or _matches(rf"^{P.GROUP}$", address)
    return address if bare else f"<{address}>"


def mailboxes(address: str) -> list[str]:
    """A bare address, or the members of a group."""
    group = re.search(P.GROUP_MEMBERS, address)
    if not group:
        return [address]
    entries = [e.strip() for e in re.findall(P.LIST_ENTRY, group[1])]
    return [parse_address(e)[1] for e in entries if e]


def address_list(text: str, name: str) -> list[str] | None:
    joined = ",".join(values(text, name))
    if not _matches(r"[^\s,;]", joined):
        return None
    entries = [e.strip() for e in re.findall(P.LIST_ENTRY, joined)]
    return [format_address(*parse_address(e)) for e in entries if e]


# -- dates, words, bodies -------------------------------------------------------------------------


# Month names of RFC 5322.
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def parse_date(text: str | None) -> datetime | None:
    if text is None:
        return None
    clean = " ".join(re.sub(P.COMMENT, " ", text).split())
    clean = re.sub(r"^[A-Za-z]{2,} ?,? ?(?=\d)", "", clean)
    found = re.match(
        r"(\d{1,2})[ -]([A-Za-z]{3})[A-Za-z]*[ -](\d{4}|\d\d) (\d{1,2}):(\d\d)(?::(\d\d))?(?!:) ?([+-]\d{4}|[A-Za-z]+)?",
        clean,
    )
    if not found or found[2].lower() not in _MONTHS:
        return None
    year = int(found[3])
    if len(found[3]) == 2:
        year += 2000 if year < 50 else 1900
    zone = (found[7] or "").upper()
    zone = zone if re.fullmatch(r"[+-]\d{4}", zone) else ZONES.get(zone, "+0000")
    offset = timedelta(hours=int(zone[1:3]), minutes=int(zone[3:])) * (-1 if zone[0] == "-" else 1)
    try:
        return datetime(
            year, _MONTHS.index(found[2].lower()) + 1, int(found[1]), int(found[4]), int(found[5]),
            int(found[6] or 0), tzinfo=timezone(offset),
        ).astimezone(timezone.utc)
    except ValueError:
        return None


def decode_words(text: str | None) -> str | None:
    if text is None or "=?" not in text:
        return text
    joined = re.sub(P.BETWEEN_WORDS, r"\1", text)
    return "".join(_decode_piece(piece) for piece in re.findall(P.WORD_OR_TEXT, joined))


def _decode_piece(piece: str) -> str:
    word = re.fullmatch(P.ENCODED_WORD, piece)
    if not word or word[1].lower() not in [*CHARSETS, *UTF8_NAMES]:
        return piece
    if word[2] in "bB":
        data = base64_bytes(word[3])
    else:
        data = quopri.decodestring(word[3].replace("_", " ").encode("iso-8859-1", "replace"))
    return text_of(data, word[1].lower())


def base64_bytes(text: str) -> bytes:
    letters = re.sub("[^A-Za-z0-9+/]", "", text.split("=", 1)[0])
    letters = letters[:-1] if len(letters) % 4 == 1 else letters
    return base64.b64decode(letters + "=" * (-len(letters) % 4))


def text_of(data: bytes, charset: str | None) -> str:
    return data.decode(charset if charset in CHARSETS else "utf-8", "replace")


def body_bytes(body: bytes, transfer_encoding: str | None) -> bytes:
    encoding = (transfer_encoding or "").strip(" ").lower()
    if encoding == "base64":
        return base64_bytes(body.decode("iso-8859-1"))
    if encoding == "quoted-printable":
        return quopri.decodestring(re.sub(rb"(?<![ \t])[ \t]++(?=\r?\n|\Z)", b"", body))
    return body


# -- content formats ------------------------------------------------------------------------------


class _Number(str):
    """A JSON number as it is written."""


_INTEGERS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_CELL = re.compile(r'"((?:[^"\\]|\\.)*)(?:"(?=,|$)|$)|([^,]*)', re.S)


def _integer(text: str, to: T.DataType) -> int | None:
    """A whole number in the range of the type; null otherwise, as Spark reads it."""
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    limit = 1 << (_INTEGERS[type(to)] - 1)
    return int(text) if -limit <= int(text) < limit else None


def _float(text: str) -> float | None:
    return float(text) if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", text) else None


def _json_text(value: Any) -> str:
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_json_text(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_json_text, value)) + "]"
    if not isinstance(value, _Number):
        return json.dumps(value, ensure_ascii=False)
    return value if re.fullmatch(r"-?[0-9]+", value) else _double_text(float(value))


def _double_text(x: float) -> str:
    """A double as the JVM writes it."""
    if x == 0 or 1e-3 <= abs(x) < 1e7:
        return repr(x)
    sign, digits, exponent = Decimal(repr(x)).normalize().as_tuple()
    rest = "".join(map(str, digits[1:])) or "0"
    return f"{'-' * sign}{digits[0]}.{rest}E{len(digits) + exponent - 1}"


def from_json(value: Any, to: T.DataType) -> Any:
    """JSON value -> value of the declared type; null when it does not fit. Only numbers are read as numbers."""
    if value is None:
        return None
    if isinstance(to, T.StringType):
        return value if type(value) is str else _json_text(value)
    if isinstance(to, T.BooleanType):
        return value if isinstance(value, bool) else None
    if type(to) in _INTEGERS:
        return _integer(value, to) if isinstance(value, _Number) else None
    if isinstance(to, (T.FloatType, T.DoubleType)):
        return _float(value) if isinstance(value, _Number) else None
    if isinstance(to, T.ArrayType):
        return [from_json(v, to.elementType) for v in value] if isinstance(value, list) else None
    if isinstance(to, T.StructType):
        return tuple(from_json(value.get(f.name), f.dataType) for f in to) if isinstance(value, dict) else None
    raise ValueError(f"type {to.simpleString()} is not read from a declared table; use mailspark.read_folder")


def from_cell(cell: str | None, to: T.DataType) -> Any:
    """CSV cell -> value of the declared type; null when it does not fit."""
    if cell is None or isinstance(to, T.StringType):
        return cell
    if isinstance(to, T.BooleanType):
        return {"true": True, "false": False}.get(cell.lower())
    if type(to) in _INTEGERS:
        return _integer(cell, to)
    if isinstance(to, (T.FloatType, T.DoubleType)):
        return _float(cell)
    raise ValueError(f"type {to.simpleString()} is not read from a declared table; use mailspark.read_folder")


def csv_cells(line: str) -> list[str | None]:
    """Cells of one line; within quotes a backslash escapes a quote or itself. An empty cell is null."""
    cells, at = [], 0
    while at <= len(line):
        found = _CELL.match(line, at)
        cell = found[2] if found[1] is None else re.sub(r'\\(["\\])', r"\1", found[1])
        cells.append(cell or None)
        at = found.end() + 1
    return cells


def content_decoder(
    name: str, content: list[M.Column], options: dict[str, str]
) -> Callable[[bytes, str | None], tuple[Any, ...]]:
    """(body bytes, charset) -> values of the content columns."""
    mine, passed = split_options(name, options, ("charset",))
    if passed or name in ("xml", "avro"):
        raise ValueError(f"format '{name}' with these options is not read from a declared table; "
                         "use mailspark.read_folder")
    nothing = tuple(None for _ in content)

    def text(data: bytes, charset: str | None) -> str:
        return text_of(data, mine.get("charset", charset))

    if name == "raw":
        if isinstance(check_raw(content).type, T.BinaryType):
            return lambda data, charset: (data,)
        return lambda data, charset: (text(data, charset),)
    if name == "json":

        def decode_json(data: bytes, charset: str | None) -> tuple[Any, ...]:
            try:
                reader = json.JSONDecoder(parse_int=_Number, parse_float=_Number, parse_constant=_Number)
                parsed, _ = reader.raw_decode(text(data, charset).lstrip(" \t\r\n"))
            except (ValueError, RecursionError):
                return nothing
            if not isinstance(parsed, dict):
                return nothing
            return tuple(from_json(parsed.get(c.name), c.type) for c in content)

        return decode_json

    def decode_csv(data: bytes, charset: str | None) -> tuple[Any, ...]:
        line = re.split(r"[\r\n]", text(data, charset).rstrip("\r\n"), maxsplit=1)[0]
        cells = csv_cells(line) + [None] * len(content)
        return tuple(from_cell(cell, c.type) for cell, c in zip(cells, content))

    return decode_csv


# -- rows -----------------------------------------------------------------------------------------


def _utc(moment: Any) -> datetime | None:
    if moment is None:
        return None
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


_SCALARS: dict[str, Callable[[Message, str], Any]] = {
    "uid": lambda m, h: m["uid"],
    "subject": lambda m, h: decode_words(value(h, "subject")),
    "sent": lambda m, h: parse_date(value(h, "date")),
    "received": lambda m, h: _utc(m.get("internal_date")),
    "contentType": lambda m, h: value(h, "content-type") or "text/plain",
    "sizeInBytes": lambda m, h: m.get("size"),
    "seen": lambda m, h: M.FLAG_KEYS["seen"] in (m.get("flags") or ()),
    "draft": lambda m, h: M.FLAG_KEYS["draft"] in (m.get("flags") or ()),
    "answered": lambda m, h: M.FLAG_KEYS["answered"] in (m.get("flags") or ()),
    "from": lambda m, h: address_list(h, "from") or address_list(h, "sender"),
    "to": lambda m, h: address_list(h, "to"),
    "cc": lambda m, h: address_list(h, "cc"),
    "bcc": lambda m, h: address_list(h, "bcc"),
    "replyTo": lambda m, h: address_list(h, "reply-to") or _SCALARS["from"](m, h),
    "fromFirst": lambda m, h: next(iter(_SCALARS["from"](m, h) or ()), None),
    "toFirst": lambda m, h: next(iter(_SCALARS["to"](m, h) or ()), None),
    "recipients": lambda m, h: [a for n in ("to", "cc", "bcc") for a in address_list(h, n) or ()] or None,
    "headers": lambda m, h: all_headers(h),
}


def _cast(column: M.Column) -> Callable[[Any], Any]:
    """Native value -> declared type, for the casts a declared column may ask for."""
    native = M.readable(column.key)
    if column.type == native:
        return lambda v: v
    if isinstance(column.type, T.StringType) and isinstance(native, (T.LongType, T.IntegerType)):
        return lambda v: None if v is None else str(v)
    if isinstance(column.type, T.StringType) and isinstance(native, T.BooleanType):
        return lambda v: None if v is None else str(v).lower()
    if isinstance(column.type, (T.IntegerType, T.LongType)) and isinstance(native, (T.LongType, T.IntegerType)):
        return lambda v: v
    raise ValueError(
        f"metadata '{column.key}' cannot be declared as {column.type.simpleString()}, "
        f"it is {native.simpleString()}"
    )


def row_decoder(layout: M.Layout, name: str, options: dict[str, str]) -> Callable[[Message], tuple[Any, ...]]:
    """Message -> row of the declared columns; checks them all before any message is read."""
    decode = content_decoder(name, layout.content, options) if layout.content else None
    casts = [None if c.key is None else (_SCALARS[c.key], _cast(c)) for c in layout.columns]

    def row(message: Message) -> tuple[Any, ...]:
        text = head_text(message["head"]) if "head" in message else ""
        content = iter(())
        if decode:
            data = body_bytes(message["body"], value(text, "content-transfer-encoding"))
            found = re.search(r"(?i);\s*+charset\s*+=\s*+\"?([^\s\";]++)", value(text, "content-type") or "")
            content = iter(decode(data, found[1].lower() if found else None))
        return tuple(next(content) if c is None else c[1](c[0](message, text)) for c in casts)

    return row
