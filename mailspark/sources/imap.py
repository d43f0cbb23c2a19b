"""Spark data sources over mail folders: ``imap`` for messages, ``imap_folders`` for the folder list."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import Any

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from mailspark import metadata as M
from mailspark.operators.project import stored_columns
from mailspark.options import CATALOG_SPEC, IMAP_SPEC, MailOptions, check_mode
from mailspark.sources.archive import MESSAGES
from mailspark.sources.message import row_decoder
from mailspark.sources.search import search_keys
from mailspark.sources.transport import ArchiveTransport, ImapTransport, Split


def connect(options: MailOptions) -> Any:
    return ArchiveTransport(options) if options["archive"] else ImapTransport(options)


class Part(InputPartition):
    def __init__(self, split: Split):
        self.split = split


class _Scan:
    """What a batch and a streaming reader share: the row layout and the reading of one split."""

    def __init__(self, source: "ImapDataSource", schema: StructType):
        self.source = source
        self.options = source.mail
        self.folder = self.options["folder"]
        if self.options["layout"] == "archive" or schema == MESSAGES:
            self.columns = [f.name for f in schema]
            self.uid_columns = {"uid"}
            self.searched = {"internal_date": "received", "size": "sizeInBytes"}
            unknown = set(self.columns) - set(MESSAGES.names)
            if unknown:
                raise ValueError(f"Columns {sorted(unknown)} are not in the archive schema")
            self.decode = lambda m: tuple(self.folder if c == "folder" else m.get(c) for c in self.columns)
        else:
            layout = M.Layout.of(schema, self.options.aliases, self.options["content-columns"])
            self.columns = stored_columns(layout)
            self.uid_columns = {c.name for c in layout.columns if c.key == "uid"}
            self.searched = {c.name: c.key for c in layout.metadata if c.type == M.readable(c.key)}
            self.decode = row_decoder(layout, self.options["format"], self.options.format_options)

    def splits(self, server: Any, start: int, end: int, keys: str = "") -> list[Part]:
        return [Part(s) for s in server.splits(self.folder, start, end, self.columns, keys)]

    def read_split(self, split: Split) -> Iterator[tuple]:
        server = self.source.connect()
        try:
            stored = [c for c in self.columns if c != "folder"]
            for message in server.fetch(self.folder, split, stored):
                yield self.decode(message)
        finally:
            server.close()


class FolderReader(DataSourceReader):
    """Bounded read: uids from the offset to the frontier at planning, as parallel uid ranges."""

    def __init__(self, source: "ImapDataSource", schema: StructType):
        check_mode(source.mail, streaming=False)
        self.scan = _Scan(source, schema)
        self.start = source.mail["offset"] or 1
        self.end: int | None = None
        self.uid_columns = self.scan.uid_columns
        self.keys: list[str] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take over bounds on the uid; the server searches by what it can of the rest, and Spark checks that."""
        for f in filters:
            if not self._narrow(f):
                if self.scan.options["search"]:
                    self.keys.append(search_keys(f, self.scan.searched))
                yield f

    def _narrow(self, f: Filter) -> bool:
        bounds = (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        if not isinstance(f, bounds) or len(f.attribute) != 1 or f.attribute[0] not in self.uid_columns:
            return False
        if isinstance(f.value, bool) or not isinstance(f.value, int):
            return False
        low = {EqualTo: f.value, GreaterThanOrEqual: f.value, GreaterThan: f.value + 1}.get(type(f))
        high = {EqualTo: f.value + 1, LessThan: f.value, LessThanOrEqual: f.value + 1}.get(type(f))
        if low is not None:
            self.start = max(self.start, low)
        if high is not None:
            self.end = high if self.end is None else min(self.end, high)
        return True

    def partitions(self) -> Sequence[InputPartition]:
        server = self.scan.source.connect()
        try:
            _, frontier = server.status(self.scan.folder)
            end = frontier if self.end is None else min(self.end, frontier)
            return self.scan.splits(server, self.start, end, " ".join(filter(None, self.keys)))
        finally:
            server.close()

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        return iter(()) if partition is None else self.scan.read_split(partition.split)


class FolderStreamReader(DataSourceStreamReader):
    """Unbounded read; the offset is the uid validity and the last uid delivered."""

    def __init__(self, source: "ImapDataSource", schema: StructType):
        check_mode(source.mail, streaming=True)
        self.scan = _Scan(source, schema)

    def _status(self) -> tuple[int, int]:
        server = self.scan.source.connect()
        try:
            return server.status(self.scan.folder)
        finally:
            server.close()

    def initialOffset(self) -> dict:
        validity, frontier = self._status()
        if self.scan.options["mode"] == "new":
            return {"uidvalidity": validity, "uid": frontier - 1}
        return {"uidvalidity": validity, "uid": (self.scan.options["offset"] or 1) - 1}

    def latestOffset(self) -> dict:
        validity, frontier = self._status()
        return {"uidvalidity": validity, "uid": frontier - 1}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start["uidvalidity"] != end["uidvalidity"]:
            raise ValueError(
                f"uidvalidity of folder '{self.scan.folder}' changed from {start['uidvalidity']} to "
                f"{end['uidvalidity']}: the checkpoint's uid names another message now, start a new one"
            )
        server = self.scan.source.connect()
        try:
            # an offset may lie past the frontier, and so past the offsets committed so far
            first = max(start["uid"] + 1, self.scan.options["offset"] or 1)
            return self.scan.splits(server, first, end["uid"] + 1) or [Part(Split(0, 0))]
        finally:
            server.close()

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        split = partition.split
        return iter(()) if split.start >= split.end else self.scan.read_split(split)


class ImapDataSource(DataSource):
    """``imap``: one folder. Declared columns are decoded; without any the archive schema is read."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.mail = MailOptions.parse(options, IMAP_SPEC, substitute="archive")

    @classmethod
    def name(cls) -> str:
        return "imap"

    def connect(self) -> Any:
        return connect(self.mail)

    def schema(self) -> StructType:
        return MESSAGES

    def reader(self, schema: StructType) -> DataSourceReader:
        return FolderReader(self, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return FolderStreamReader(self, schema)


class FoldersReader(DataSourceReader):
    def __init__(self, source: "FoldersDataSource"):
        self.source = source

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        server = self.source.connect()
        try:
            yield from server.folders()
        finally:
            server.close()


class FoldersDataSource(DataSource):
    """``imap_folders``: all folders of an account, with whether they can hold messages."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.mail = MailOptions.parse(options, CATALOG_SPEC, substitute="archive")

    @classmethod
    def name(cls) -> str:
        return "imap_folders"

    def connect(self) -> Any:
        return connect(self.mail)

    def schema(self) -> str:
        return "name string, holds_messages boolean"

    def reader(self, schema: StructType) -> DataSourceReader:
        return FoldersReader(self)
