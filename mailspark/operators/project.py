"""Messages -> declared columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, TimestampType

from mailspark import metadata as M
from mailspark.functions import address as A
from mailspark.functions import body as B
from mailspark.functions import charset as C
from mailspark.functions import date as D
from mailspark.functions import formats
from mailspark.functions import header as H
from mailspark.functions import words

# The envelope: what the metadata columns and content decoding need from the head of a message.
ENVELOPE = StructType([
    StructField("subject", StringType()),
    StructField("sent", TimestampType()),
    StructField("type", StringType()),
    StructField("encoding", StringType()),
    StructField("from", ArrayType(StringType())),
    StructField("to", ArrayType(StringType())),
    StructField("cc", ArrayType(StringType())),
    StructField("bcc", ArrayType(StringType())),
    StructField("reply_to", ArrayType(StringType())),
])
_FIELDS_OF = {
    "subject": ["subject"],
    "sent": ["sent"],
    "contentType": ["type"],
    "from": ["from"],
    "fromFirst": ["from"],
    "to": ["to"],
    "toFirst": ["to"],
    "cc": ["cc"],
    "bcc": ["bcc"],
    "recipients": ["to", "cc", "bcc"],
    "replyTo": ["reply_to"],
}
_CONTENT_FIELDS = ["type", "encoding"]

# Headers each field is made from; the first one that has a value counts.
_SINGLE = {"subject": "subject", "sent": "date", "type": "content-type", "encoding": "content-transfer-encoding"}
_LISTS = {
    "from": ["from", "sender"],
    "to": ["to"],
    "cc": ["cc"],
    "bcc": ["bcc"],
    "reply_to": ["reply-to", "from", "sender"],
}

_HEADERS, _CONTENT, _DATA, _CHARSET = "__headers", "__content", "__data", "__charset"


def split_raw(mail: DataFrame) -> DataFrame:
    """Cut ``raw`` at its blank line into ``head`` and ``body``, and keep its ``size``."""
    if "raw" not in mail.columns:
        return mail
    others = [c for c in mail.columns if c != "raw"]
    text = mail.select(*others, "raw", B.latin1(F.col("raw")).alias("__text"))
    breaks = text.select(*others, "raw", *B.blank_lines(F.col("__text")))
    cut = breaks.select(*others, "raw", B.head_length(F.col("raw")).alias("__head_length"))
    return cut.select(
        *others,
        F.octet_length("raw").alias("size"),
        F.substring(F.col("raw"), F.lit(1), F.col("__head_length")).alias("head"),
        F.substring(F.col("raw"), F.col("__head_length") + 1, F.octet_length("raw")).alias("body"),
    )


def parse_envelope(mail: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Add envelope fields, parsed from ``head``, as columns ``__<field>``; use in ``java_charsets``.

    Each stage names what the next one uses more than once, so that it is computed once.
    """
    fields = set(fields)
    single = {f: _SINGLE[f] for f in _SINGLE if f in fields}
    headers = sorted({h for f in _LISTS if f in fields for h in _LISTS[f]})
    if not fields:
        return mail
    staged = mail.withColumn(_HEADERS, H.named_headers(F.col("head"), [*single.values(), *headers]))
    staged = staged.withColumns({
        **{f"__{f}": H.header_value(F.col(_HEADERS), h) for f, h in single.items()},
        **{f"__header_{h}": H.header_list(F.col(_HEADERS), h) for h in headers},
    })
    staged = A.with_addresses(staged, [f"__header_{h}" for h in headers])
    found = {
        f"__{f}": F.coalesce(*[F.col(f"__header_{h}") for h in _LISTS[f]]) for f in _LISTS if f in fields
    }
    if "subject" in fields:
        found["__subject"] = words.decode_words(F.col("__subject"))
    if "sent" in fields:
        found["__sent"] = D.parse_date(F.col("__sent"))
    return staged.withColumns(found) if found else staged


def with_envelope(mail: DataFrame) -> DataFrame:
    """Add the whole envelope as one struct, for storage next to the message."""
    with C.java_charsets(mail.sparkSession):
        staged = parse_envelope(mail, ENVELOPE.names)
        envelope = F.struct(*[F.col(f"__{f}").alias(f) for f in ENVELOPE.names])
        return staged.select(*mail.columns, envelope.alias("envelope"))


def metadata_column(key: str) -> Column:
    """Value of one readable key, over stored columns and envelope fields ``__<field>``."""
    M.readable(key)
    if key == "uid":
        return F.col("uid")
    if key == "received":
        return F.col("internal_date")
    if key == "sizeInBytes":
        return F.col("size").cast("int")
    if key in M.FLAG_KEYS:
        return F.coalesce(F.array_contains("flags", M.FLAG_KEYS[key]), F.lit(False))
    if key == "headers":
        return H.all_headers(F.col("head"))
    if key == "contentType":
        return F.coalesce("__type", F.lit("text/plain"))
    if key in ("fromFirst", "toFirst"):
        return A.first(F.col(f"__{key.removesuffix('First')}"))
    if key == "recipients":
        lists = [F.col("__to"), F.col("__cc"), F.col("__bcc")]
        none = F.array().cast("array<string>")
        joined = F.concat(*[F.coalesce(a, none) for a in lists])
        return F.when(F.coalesce(*lists).isNotNull(), joined)
    (field,) = _FIELDS_OF[key]
    return F.col(f"__{field}")


def envelope_fields(layout: M.Layout) -> list[str]:
    """Envelope fields that the declared columns need."""
    needed = {f for key in layout.keys & _FIELDS_OF.keys() for f in _FIELDS_OF[key]}
    if layout.content:
        needed.update(_CONTENT_FIELDS)
    return [f for f in ENVELOPE.names if f in needed]


def stored_columns(layout: M.Layout, has_envelope: bool = False) -> list[str]:
    """Columns of a message that the declared columns need; the body only for content.

    With a stored envelope the head is needed only for ``headers``.
    """
    needed = []
    if "uid" in layout.keys:
        needed.append("uid")
    if "received" in layout.keys:
        needed.append("internal_date")
    if "sizeInBytes" in layout.keys:
        needed.append("size")
    if layout.keys & M.FLAG_KEYS.keys():
        needed.append("flags")
    if "headers" in layout.keys or (envelope_fields(layout) and not has_envelope):
        needed.append("head")
    if layout.content:
        needed.append("body")
    return needed


def decode_mail(
    mail: DataFrame,
    schema: StructType | str | M.Layout,
    *,
    format: str = "raw",
    format_options: Mapping[str, str] | None = None,
    aliases: dict[str, str] | None = None,
    content_columns: list[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode messages into the declared columns, in declared order.

    Messages have the columns folder, uid, internal_date, flags and size, head, body (or raw), and
    maybe a stored envelope, which saves parsing the head. Only columns that a declared column needs
    are read. ``keep`` names columns of ``mail`` to carry along in front.
    """
    layout = schema if isinstance(schema, M.Layout) else M.Layout.of(schema, aliases, content_columns)
    if format == "raw" and layout.content:
        formats.check_raw(layout.content)
    mail = split_raw(mail)
    has_envelope = "envelope" in mail.columns
    fields = envelope_fields(layout)
    kept = [F.col(f"`{k}`").alias(f"__keep_{k}") for k in keep]
    stored = stored_columns(layout, has_envelope)
    with C.java_charsets(mail.sparkSession):
        if has_envelope:
            staged = mail.select(
                *kept, *stored, *[F.col("envelope").getField(f).alias(f"__{f}") for f in fields]
            )
        else:
            staged = parse_envelope(mail.select(*kept, *stored), fields)
        if layout.content:
            staged = staged.withColumns({
                _DATA: B.body_bytes(F.col("body"), F.col("__encoding")),
                _CHARSET: B.charset_of(F.col("__type")),
            })
            content = formats.decode_content(
                format, F.col(_DATA), F.col(_CHARSET), layout.content, format_options or {}
            )
            staged = staged.withColumn(_CONTENT, content)
        return staged.select(
            *[F.col(f"__keep_{k}").alias(k) for k in keep],
            *[_declared(column) for column in layout.columns],
        )


def _declared(column: M.Column) -> Column:
    if column.key is None:
        return F.col(_CONTENT).getField(column.name).alias(column.name)
    value = metadata_column(column.key)
    if column.type != M.readable(column.key):
        value = value.cast(column.type)
    return value.alias(column.name)


def physical_row(decoded: DataFrame, layout: M.Layout) -> DataFrame:
    """Content columns first, then metadata columns, each in declared order."""
    return decoded.select(*[F.col(f"`{c.name}`") for c in [*layout.content, *layout.metadata]])


def row_slice(rows: DataFrame, start: int, end: int) -> Column:
    """The columns [start, end) of each row as one struct."""
    if not 0 <= start <= end <= len(rows.columns):
        raise IndexError(f"slice [{start}, {end}) is outside a row of {len(rows.columns)} columns")
    return F.struct(*[F.col(f"`{c}`") for c in rows.columns[start:end]])
