"""Content formats: message body <-> declared content columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from mailspark import metadata as M
from mailspark.functions import charset as C


def _struct(content: Sequence[M.Column]) -> StructType:
    return StructType([StructField(c.name, c.type) for c in content])


def check_raw(content: Sequence[M.Column]) -> M.Column:
    if len(content) != 1 or not isinstance(content[0].type, (StringType, BinaryType)):
        found = ", ".join(f"{c.name} {c.type.simpleString()}" for c in content)
        raise ValueError(f"format 'raw' needs exactly one STRING or BINARY content column, found: {found}")
    return content[0]


def split_options(name: str, options: Mapping[str, str], own: Sequence[str]) -> tuple[dict[str, str], dict[str, str]]:
    """The options this module reads, and those passed on to Spark's parser."""
    mine = {k: v for k, v in options.items() if k in own}
    if name == "raw" and len(mine) < len(options):
        raise ValueError(f"Unsupported options of format 'raw': {sorted(set(options) - set(mine))}")
    return mine, {k: v for k, v in options.items() if k not in own}


def decode_content(
    name: str,
    data: Column,
    charset: Column,
    content: Sequence[M.Column],
    options: Mapping[str, str],
) -> Column:
    """Body bytes -> one struct with the content columns; a body that does not parse gives nulls.

    Text is read in the message's own charset unless the option ``raw.charset`` names one.
    """
    mine, passed = split_options(name, options, ("charset", "schema"))
    text = C.fixed_text(data, mine["charset"]) if "charset" in mine else C.text(data, charset)
    fields = _struct(content)
    if name == "raw":
        column = check_raw(content)
        value = data if isinstance(column.type, BinaryType) else text
        return F.struct(value.alias(column.name))
    if name == "json":
        return F.from_json(text, fields, {"mode": "PERMISSIVE", **passed})
    if name == "csv":
        line = F.regexp_replace(text, r"(?<![\r\n])[\r\n]++$", "")
        return F.from_csv(line, fields.toDDL(), {"mode": "PERMISSIVE", **passed})
    if name == "xml":
        return F.from_xml(text, fields, {"mode": "PERMISSIVE", **passed})
    if name == "avro":
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(data, mine.get("schema") or avro_schema(content), {"mode": "PERMISSIVE", **passed})
        return F.struct(*[record.getField(c.name).cast(c.type).alias(c.name) for c in content])
    raise ValueError(f"Unknown format '{name}'")


def encode_content(name: str, content: Sequence[M.Column], options: Mapping[str, str]) -> Column:
    """Content columns of a row -> body text, or bytes for binary content."""
    mine, passed = split_options(name, options, ("charset", "schema"))
    if name == "raw":
        return F.col(f"`{check_raw(content).name}`")
    row = F.struct(*[F.col(f"`{c.name}`") for c in content])
    if name == "json":
        return F.to_json(row, {"ignoreNullFields": "false", **passed})
    if name == "csv":
        return F.to_csv(row, passed)
    if name == "xml":
        return F.to_xml(row, passed)
    if name == "avro":
        from pyspark.sql.avro.functions import to_avro

        return to_avro(row, mine.get("schema") or "")
    raise ValueError(f"Unknown format '{name}'")


# Spark type -> Avro type.
_AVRO = {"string": "string", "bigint": "long", "int": "int", "double": "double", "float": "float",
         "boolean": "boolean", "binary": "bytes"}


def avro_schema(content: Sequence[M.Column]) -> str:
    """Avro record of nullable fields for the plain types; others need the option ``avro.schema``."""
    fields = []
    for column in content:
        kind = column.type.simpleString()
        if kind not in _AVRO:
            raise ValueError(f"column '{column.name}' of type {kind} needs the option 'avro.schema'")
        fields.append(f'{{"name":"{column.name}","type":["null","{_AVRO[kind]}"]}}')
    return f'{{"type":"record","name":"row","fields":[{",".join(fields)}]}}'
