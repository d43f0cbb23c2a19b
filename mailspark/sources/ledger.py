"""What an archive has published: one file per version, created only if its number is still free.

Each version holds the whole state: its folders, and for each folder the parts its messages lie in, by ascending uid.
A part is a directory that one append or compaction wrote and that never changes; a directory that no version names
does not count. So a reader opens one file, the newest, and knows what to read. Two writers that saw the same version
cannot both create the next: one of them finds it taken and looks again.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import warnings
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

#: Older versions that stay for readers that have listed them already.
KEPT_VERSIONS = 50
_NAME = re.compile(r"(\d{20})\.json")
# Stores whose rename is one step that does not overwrite.
_ATOMIC = {"file", "hdfs", "viewfs", "webhdfs", "ofs", "o3fs", "abfs", "abfss"}


@dataclass
class FolderState:
    uidvalidity: int = 1
    uid_next: int = 1
    holds_messages: bool = True


@dataclass(frozen=True)
class Part:
    """Messages ``first`` <= uid <= ``last`` of a folder, all of them in the directory that ``append`` names."""

    append: str
    first: int
    last: int
    rows: int = 0
    bytes: int = 0


@dataclass
class State:
    """``version`` 0 is the state before the first.

    ``replaced``: (append, folder, time) of directories that a compaction has rewritten; they stay for a while for
    readers that know them. ``news``: uid ranges that the version added and streams may not have been told yet.
    ``batches``: the last batch that each numbered writer has published.
    """

    version: int = 0
    folders: dict[str, FolderState] = field(default_factory=dict)
    parts: dict[str, list[Part]] = field(default_factory=dict)
    replaced: list[tuple[str, str, int]] = field(default_factory=list)
    news: dict[str, list[Part]] = field(default_factory=dict)
    news_of: str = ""
    batches: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of(cls, text: str) -> State:
        value = json.loads(text)
        folders = {name: FolderState(**f) for name, f in value["folders"].items()}
        parts, news = ({f: [Part(**p) for p in found] for f, found in value[k].items()} for k in ("parts", "news"))
        replaced = [tuple(r) for r in value["replaced"]]
        return cls(value["version"], folders, parts, replaced, news, value["news_of"], value["batches"])

    def parts_of(self, folder: str, first: int = 1, last: int | None = None) -> list[Part]:
        """The parts of a folder that hold uids of a range, in order."""
        found = self.parts.get(folder, [])
        return [p for p in found if p.last >= first and (last is None or p.first <= last)]


def newest(names: list[str]) -> str | None:
    """The file of the last version among the names in the folder of versions."""
    return max((n for n in names if _NAME.fullmatch(n)), default=None)


class Taken(Exception):
    """Another writer has created this version."""


class Ledger:
    """The versions of an archive, by Spark's own access to files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._root = self._jvm.org.apache.hadoop.fs.Path(path)
        self.files = self._root.getFileSystem(self._conf)

    def place(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _names(self) -> list[str]:
        if not self.files.exists(self._root):
            return []
        return [s.getPath().getName() for s in self.files.listStatus(self._root)]

    def read(self) -> State:
        while True:
            name = newest(self._names())
            if name is None:
                return State()
            try:
                stream = self.files.open(self.place(name))
            except Exception:
                if name == newest(self._names()):
                    raise
                continue  # it was cleared away after many newer ones
            try:
                return State.of(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()

    def write(self, state: State) -> None:
        """Create the version that ``state`` names; ``Taken`` if it exists."""
        if not self.create(state.text(), self.place(f"{state.version:020d}.json")):
            raise Taken(str(state.version))
        for old in self._names():
            found = _NAME.fullmatch(old)
            if found and int(found[1]) < state.version - KEPT_VERSIONS:
                self.files.delete(self.place(old), False)

    def create(self, text: str, target) -> bool:
        """Write a file under a name of its own, then give it its name unless that is taken; false if it is."""
        draft = self.place(f".{uuid.uuid4().hex}.tmp")
        out = self.files.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            return self._name(draft, target)
        finally:
            self.files.delete(draft, False)

    def _name(self, draft, target) -> bool:
        scheme = self.files.getScheme()
        if scheme == "file":
            try:
                os.link(draft.toUri().getPath(), target.toUri().getPath())
            except FileExistsError:
                return False
            return True
        if scheme not in _ATOMIC:
            warnings.warn(f"Renames in {scheme} may overwrite: let only one writer at a time append to {self.path}", stacklevel=2)
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(target.toUri(), self._conf)
        kinds = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(draft, target, kinds)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True
