"""Tables over mail folders and outboxes, with their options.

Spark hands a Python data source the options of a query, not those of the table it reads. A table
therefore gets a data source of its own, which has the table's options as defaults; a query's options
override them. They live in the session, so no password is stored in a catalog; a new session binds
its tables again.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import StructType

from mailspark import metadata as M


def bound_source(source: type[DataSource], name: str, defaults: Mapping[str, str]) -> type[DataSource]:
    """A data source like ``source`` under another name, with default options."""
    lowered = {k.lower(): str(v) for k, v in defaults.items()}

    class Bound(source):
        def __init__(self, options: dict[str, str]):
            super().__init__({**lowered, **{k.lower(): v for k, v in options.items()}})

        @classmethod
        def name(cls) -> str:
            return name

    return Bound


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType | str,
    options: Mapping[str, str],
    source: str | type[DataSource] = "imap",
    replace: bool = False,
) -> None:
    """``CREATE TABLE name (schema) USING source`` with options, for ``imap`` and ``smtp``.

    Bad options are refused here. An existing table keeps its definition unless ``replace`` is set, and
    gets the options either way. Only a table made here is replaced, never one that holds data.
    """
    from mailspark.session import register, sources

    register(spark)
    base = sources()[source] if isinstance(source, str) else source
    provider = provider_of(base, name)
    bound = bound_source(base, provider, options)
    bound({})
    spark.dataSource.register(bound)
    null = {True: "", False: " NOT NULL"}
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}{null[f.nullable]}" for f in M.as_schema(schema))
    if replace and spark.catalog.tableExists(name):
        if not reads_from(spark, name, provider):
            raise ValueError(f"Table {name} exists and is no table of '{base.name()}'")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}")


def provider_of(source: type[DataSource], table: str) -> str:
    """Name of the data source of one table."""
    return f"{source.name()}_" + re.sub(r"\W", "_", table.replace("`", "").lower())


def reads_from(spark: SparkSession, table: str, provider: str) -> bool:
    """Whether a stored table is one over this data source; false when its source is unknown here."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    except AnalysisException:
        return False
    # Spark describes a table of a Python data source by the name of the source.
    return rows.where(F.col("col_name").isin("Name", "Provider") & (F.col("data_type") == provider)).count() > 0
