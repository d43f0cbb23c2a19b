"""The metadata columns a mail table may declare, and how declared columns map to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    _parse_datatype_string,
)

_ADDRESSES = ArrayType(StringType())
_HEADERS = ArrayType(StructType([StructField("key", StringType()), StructField("value", StringType())]))

# Readable key -> type.
READABLE: dict[str, DataType] = {
    "uid": LongType(),
    "subject": StringType(),
    "sent": TimestampType(),
    "received": TimestampType(),
    "contentType": StringType(),
    "sizeInBytes": IntegerType(),
    "seen": BooleanType(),
    "draft": BooleanType(),
    "answered": BooleanType(),
    "from": _ADDRESSES,
    "fromFirst": StringType(),
    "to": _ADDRESSES,
    "toFirst": StringType(),
    "cc": _ADDRESSES,
    "bcc": _ADDRESSES,
    "recipients": _ADDRESSES,
    "replyTo": _ADDRESSES,
    "headers": _HEADERS,
}

# Writable key -> type.
WRITABLE: dict[str, DataType] = {
    "subject": StringType(),
    "from": _ADDRESSES,
    "to": _ADDRESSES,
    "cc": _ADDRESSES,
    "bcc": _ADDRESSES,
    "replyTo": _ADDRESSES,
}

# Columns of a folder table when none are declared.
DEFAULT_COLUMNS = ["uid", "subject", "sent", "received", "from", "to", "cc", "bcc"]

# Which stored or fetched item each key needs besides the uid.
HEAD_KEYS = frozenset(
    "subject sent contentType from fromFirst to toFirst cc bcc recipients replyTo headers".split()
)
FLAG_KEYS = {"seen": "\\Seen", "draft": "\\Draft", "answered": "\\Answered"}


def readable(key: str) -> DataType:
    """Native type of a readable key."""
    return _lookup(READABLE, key)


def writable(key: str) -> DataType:
    """Native type of a writable key."""
    return _lookup(WRITABLE, key)


def _lookup(registry: dict[str, DataType], key: str) -> DataType:
    if key not in registry:
        raise ValueError(f"No metadata is called '{key}'; there is {', '.join(registry)}")
    return registry[key]


def default_schema() -> StructType:
    return StructType([StructField(k, READABLE[k]) for k in DEFAULT_COLUMNS])


def as_schema(schema: StructType | str) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return _parse_datatype_string(schema)


@dataclass(frozen=True)
class Column:
    """One declared column; ``key`` is None for a content column."""

    name: str
    type: DataType
    key: str | None


@dataclass(frozen=True)
class Layout:
    """Declared columns split into message content and metadata."""

    columns: tuple[Column, ...]

    @property
    def content(self) -> list[Column]:
        return [c for c in self.columns if c.key is None]

    @property
    def metadata(self) -> list[Column]:
        return [c for c in self.columns if c.key is not None]

    @property
    def keys(self) -> set[str]:
        return {c.key for c in self.metadata}

    @classmethod
    def of(
        cls,
        schema: StructType | str,
        aliases: dict[str, str] | None = None,
        content_columns: list[str] | None = None,
        registry: dict[str, DataType] = READABLE,
    ) -> "Layout":
        """Bind declared columns by name.

        A column named like a key of the registry is that metadata; ``aliases`` binds other names to
        a key, ``content_columns`` keeps a column as content although its name is a key.
        """
        aliases = {k.lower(): v for k, v in (aliases or {}).items()}
        as_content = {c.lower() for c in (content_columns or [])}
        fields = as_schema(schema).fields
        names = {f.name.lower() for f in fields}
        for name in [*aliases, *as_content]:
            if name not in names:
                raise ValueError(f"Column '{name}' is bound by an option but not declared")
        columns = []
        for field in fields:
            lower = field.name.lower()
            key = None
            if lower in aliases:
                key = _match(registry, aliases[lower])
                _lookup(registry, key or aliases[lower])
            elif lower not in as_content:
                key = _match(registry, field.name)
            columns.append(Column(field.name, field.dataType, key))
        return cls(tuple(columns))


def _match(registry: dict[str, DataType], name: str) -> str | None:
    """Registry key equal to the name, ignoring case as Spark does for column names."""
    return next((k for k in registry if k.lower() == name.lower()), None)
