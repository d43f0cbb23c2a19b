"""Mail archive: Parquet files of messages, and a ledger that says which of them count.

Each append writes a directory of its own, ``messages/append=<id>/folder=<folder>``, ordered by uid, and then publishes
it: one new version of the ledger names the directory with the uids it holds of each folder. Nothing is moved. Readers
take their paths from the ledger, so they see an append whole or not at all; one that dies before its version leaves
files that nothing reads, and its uids are free. Two appends to one folder cannot both publish the same uids.
Compaction rewrites small neighbours into one directory and publishes the exchange the same way.

Head and body are separate columns, and the envelope is parsed once, on import, as a mail server does: a query on
metadata reads neither head nor body, and bounds on uid, dates or envelope fields reach the Parquet scan.

``news`` has one small file per published append, made after the version, with the uid ranges that it added: what a
stream follows. Whoever writes next, or starts a stream, makes the one that a writer died before.
"""

from __future__ import annotations

import json
import re
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from mailspark.operators.project import ENVELOPE, split_raw, with_envelope
from mailspark.session import settings
from mailspark.sources.ledger import FolderState, Ledger, Part, State, Taken

MESSAGES = StructType([
    StructField("folder", StringType()),
    StructField("uid", LongType()),
    StructField("internal_date", TimestampType()),
    StructField("flags", ArrayType(StringType())),
    StructField("size", IntegerType()),
    StructField("head", BinaryType()),
    StructField("body", BinaryType()),
])
STORED = StructType([*MESSAGES, StructField("envelope", ENVELOPE)])
FOLDERS = StructType([
    StructField("name", StringType()),
    StructField("uidvalidity", LongType()),
    StructField("uid_next", LongType()),
    StructField("holds_messages", BooleanType()),
])

# Uids of a folder that are laid out together: no folder is too large for a task, and a range of uids
# lies in few row groups.
UID_BUCKET = 100_000

# Bytes below which a part is small, and how many small neighbours make it worth to rewrite them.
SMALL_PART, NEIGHBOURS = 128 << 20, 8
# Bytes of messages that a stream reads in one go.
NEWS_BYTES = 64 << 20
# Seconds for which replaced and abandoned files stay.
GRACE = 86_400
# Tasks name their files in place: nothing reads the directory before it is published, and the driver renames nothing.
_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}

# Bytes of rows to spread that one task composes and decodes: the work is in the rows, not in their size.
SPREAD = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB"}


def directory_name(folder: str) -> str:
    """Folder name as Spark escapes it in the directory of a partition."""
    return re.sub(r'[\x00-\x1f"#%\'*/:=?\\\x7f{\[\]^]', lambda m: f"%{ord(m[0]):02X}", folder)


_MICROS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


class Archive:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.messages_path = f"{self.path}/messages"
        self.ledger = Ledger(spark, f"{self.path}/ledger")

    # -- folders ----------------------------------------------------------------------------------

    def create(self) -> "Archive":
        """Make an archive without folders, unless there is one."""
        files = self.ledger.files
        for place in (self._path("news"), self._path("messages")):
            files.mkdirs(place)
        if not files.exists(self._path("messages", "append=none")):  # has the columns, for views of an empty archive
            none = self.spark.createDataFrame([], STORED).drop("folder").coalesce(1)
            none.write.mode("overwrite").parquet(f"{self.messages_path}/append=none/folder=none")
        return self

    def _path(self, *parts: str):
        return self.ledger._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def exists(self) -> bool:
        return self.ledger.files.exists(self._path("messages"))

    def state(self) -> State:
        """What is published."""
        return self.ledger.read()

    def folders(self) -> DataFrame:
        """One row per folder: name, uidvalidity, uid_next, holds_messages. The listing of one account."""
        rows = [(n, f.uidvalidity, f.uid_next, f.holds_messages) for n, f in sorted(self.state().folders.items())]
        return self.spark.createDataFrame(rows, FOLDERS)

    def add_folder(self, name: str, uidvalidity: int = 1, holds_messages: bool = True) -> None:
        """Add an empty folder, unless there is one."""

        def change(state: State) -> None:
            state.folders.setdefault(name, FolderState(uidvalidity, 1, holds_messages))

        self._publish(change)

    def status(self, folder: str) -> tuple[int, int]:
        """(uidvalidity, uid_next) of a folder; an unknown folder is an error."""
        found = self._known(self.state(), folder)
        return found.uidvalidity, found.uid_next

    def _known(self, state: State, folder: str) -> FolderState:
        if folder not in state.folders:
            raise ValueError(f"Folder '{folder}' not found in {self.path}")
        return state.folders[folder]

    # -- reading ----------------------------------------------------------------------------------

    def messages(self, folder: str | None = None, offset: int = 1) -> DataFrame:
        """Bounded scan: existing messages from ``offset`` on, up to the frontier at this call.

        For one folder the frontier is a literal, so folder and uid range prune partitions and row
        groups. For all folders the frontiers are one row per folder, known here, so their join needs
        no shuffle of the messages while they are a small table.
        """
        state = self.state()
        if folder is None:
            rows = [(n, f.uid_next) for n, f in sorted(state.folders.items())]
            frontier = self.spark.createDataFrame(rows, "__folder string, uid_next bigint")
            visible = self._stored(self._places(state)).where(F.col("uid") >= offset)
            visible = visible.join(frontier, F.col("folder") == F.col("__folder"))
            return visible.where(F.col("uid") < F.col("uid_next")).select(*STORED.names)
        uid_next = self._known(state, folder).uid_next
        parts = state.parts_of(folder, offset)
        if not parts:
            return self.spark.createDataFrame([], STORED)
        in_range = (F.col("folder") == folder) & (F.col("uid") >= offset) & (F.col("uid") < uid_next)
        return self._stored([self._place(p.append, folder) for p in parts]).where(in_range).select(*STORED.names)

    def _place(self, append: str, folder: str | None = None) -> str:
        place = f"{self.messages_path}/append={append}"
        return place if folder is None else f"{place}/folder={directory_name(folder)}"

    def _places(self, state: State) -> list[str]:
        """The directories of all folders; whole appends where nothing of them has been replaced."""
        broken = {append for append, _, _ in state.replaced}
        found = [(p.append, f) for f, parts in state.parts.items() for p in parts]
        return list(dict.fromkeys(self._place(a, f if a in broken else None) for a, f in found))

    def _stored(self, places: list[str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).option("basePath", self.messages_path).parquet(*places)

    # -- writing ----------------------------------------------------------------------------------

    def append(
        self,
        mail: DataFrame,
        folder: str | None = None,
        uidvalidity: int | None = None,
        clustered: bool = False,
        batch: tuple[str, int] | None = None,
    ) -> None:
        """Add messages with columns folder, uid, internal_date, flags and raw (or size, head, body).

        ``folder`` puts all of them into one folder. Only then may ``uid`` be missing: the messages
        get the next numbers without gaps; and a uid validity may be given, which must agree with the
        one the folder has. Given uids must lie past the frontier of their folder. Rows are first
        brought together by folder and uid range, or without uids just spread, in partitions of even size;
        ``clustered`` says they already lie so and saves that shuffle. ``batch`` names a writer and the number of its batch:
        what it has published already is not added again. A message without a folder is refused.
        """
        if folder is None and uidvalidity is not None:
            raise ValueError("uidvalidity belongs to one folder: name it")
        if self._is_published(self.state(), batch):
            return
        if folder is not None:
            self._check_validity(self.state(), folder, uidvalidity)
            mail = mail.withColumn("folder", F.lit(folder))
        if "uid" in mail.columns:
            self._append(mail, folder, uidvalidity, clustered, batch)
            return
        if folder is None:
            raise ValueError("Messages of several folders need a uid")
        held = f"{self.path}/_staged/{uuid.uuid4().hex}"
        held_columns = [f.name for f in STORED if f.name not in ("folder", "uid")]
        decoded = with_envelope(split_raw(mail if clustered else mail.hint("rebalance"))).select(*held_columns)
        with settings(self.spark, _MICROS | SPREAD):
            decoded.write.options(**_COMMIT).parquet(held)  # numbering it, even again, is a copy
        try:
            while not self._append_numbered(held, folder, uidvalidity, batch):
                pass
        finally:
            self.ledger.files.delete(self.ledger._jvm.org.apache.hadoop.fs.Path(held), True)

    def _append_numbered(self, held: str, folder: str, uidvalidity: int | None, batch: tuple[str, int] | None) -> bool:
        """Number staged messages from the frontier on; false if another append took those numbers meanwhile."""
        state = self.state()
        if self._is_published(state, batch):
            return True
        first = state.folders.get(folder, FolderState()).uid_next
        rows = self.spark.read.parquet(held).withColumns(
            {"__file": F.col("_metadata.file_name"), "__row": F.col("_metadata.row_index")}
        )
        files = rows.groupBy("__file").agg(F.count("*").alias("__rows"))
        before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
        files = files.select("__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
        rows = rows.join(files, "__file")
        rows = rows.withColumn("uid", F.lit(first) + F.col("__before") + F.col("__row")).withColumn("folder", F.lit(folder))
        return self._append(rows.drop("__file", "__row", "__before"), folder, uidvalidity, True, batch, first)

    def _append(
        self,
        mail: DataFrame,
        folder: str | None,
        uidvalidity: int | None,
        clustered: bool,
        batch: tuple[str, int] | None,
        numbered_from: int | None = None,
    ) -> bool:
        """Write messages and publish them; false if their numbers were taken meanwhile."""
        append = f"a{uuid.uuid4().hex}"
        if "envelope" not in mail.columns:
            mail = with_envelope(split_raw(mail))
        mail = mail.select(*[F.col(f.name).cast(f.dataType) for f in STORED])
        if not clustered:
            mail = _together(mail)
        added = self._written(mail, append, folder)
        if any(f is None or p.first is None for f, p in added):
            raise ValueError("A message without folder or uid")

        def change(state: State) -> None:
            if self._is_published(state, batch):
                raise _Published
            if folder is not None:
                self._check_validity(state, folder, uidvalidity)
            for name, part in added:
                known = state.folders.setdefault(name, FolderState(uidvalidity or 1))
                if numbered_from not in (None, known.uid_next):
                    raise _Renumber
                if known.uid_next > 1 and part.first < known.uid_next:
                    raise ValueError(f"uid {part.first} of folder '{name}' is not past the frontier {known.uid_next}")
                known.uid_next, known.holds_messages = part.last + 1, True
                state.parts.setdefault(name, []).append(part)
                state.news[name] = [part]
            if batch is not None:
                state.batches[batch[0]] = batch[1]

        try:
            self._publish(change)
        except (_Renumber, _Published) as e:
            self._remove(append)
            return isinstance(e, _Published)
        return True

    def _written(self, mail: DataFrame, append: str, folder: str | None = None) -> list[tuple[str, Part]]:
        """Write the directory of an append; folder and uids of each part of it.

        Of one ``folder`` they are known as it is written; of several they are read back, from footers for the most part.
        """
        seen = Observation()
        uids = [F.min("uid").alias("first"), F.max("uid").alias("last"), F.count("*").alias("rows")]
        if folder is not None:
            mail = mail.observe(seen, *uids, F.count_if(F.col("uid").isNull()).alias("unnumbered"))
        # timestamps with row group statistics, so that a range of `received` is pushed down
        with settings(self.spark, _MICROS):
            if folder is None:
                mail.write.partitionBy("folder").options(**_COMMIT).parquet(self._place(append))
            else:  # a task writes as it reads: nothing is sorted by folder before
                mail.drop("folder").write.options(**_COMMIT).parquet(self._place(append, folder))
        if folder is not None:
            found = seen.get
            if found["unnumbered"]:
                raise ValueError("A message without folder or uid")
            if not found["rows"]:
                self._remove(append)
                return []
            size = self.ledger.files.getContentSummary(self.ledger._jvm.org.apache.hadoop.fs.Path(self._place(append, folder))).getLength()
            return [(folder, Part(append, found["first"], found["last"], found["rows"], size))]
        rows = self.spark.read.schema(STORED).parquet(self._place(append))
        rows = rows.select("folder", "uid", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        files = rows.groupBy("folder", "file", "size").agg(*uids)
        summed = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows"), F.sum("size").alias("size")]
        parts = files.groupBy("folder").agg(*summed).collect()
        return [(r.folder, Part(append, r.first, r.last, r.rows, r.size)) for r in parts]

    def _remove(self, append: str, folder: str | None = None) -> None:
        place = self._place(append, folder)
        self.ledger.files.delete(self.ledger._jvm.org.apache.hadoop.fs.Path(place), True)

    def _publish(self, change) -> None:
        """Apply a change to the newest state, again if another version got in between; then tell the news."""
        while True:
            state = self.ledger.read()
            self.tell_news(state)
            before = State.of(state.text())
            state.news = {}
            change(state)
            state.news_of = f"{state.version + 1:020d}"
            if _but_news(state) == _but_news(before):
                return
            state.version += 1
            try:
                self.ledger.write(state)
            except Taken:
                continue
            self.tell_news(state)
            return

    def tell_news(self, state: State | None = None) -> None:
        """Make the file of the newest version's news, if there are any and nobody has."""
        state = state or self.ledger.read()
        place = self._path("news", f"{state.news_of}.json")
        if state.news and not self.ledger.files.exists(place):
            lines = [json.dumps({"folder": f, **range}) for f, parts in state.news.items() for p in parts for range in _ranges(p)]
            self.ledger.create("\n".join(lines) + "\n", place)

    # -- compaction -------------------------------------------------------------------------------

    def compact(self, small: int = SMALL_PART, neighbours: int = NEIGHBOURS) -> int:
        """Rewrite small parts that follow each other as one part, in even files; returns how many parts it replaced.

        A run is rewritten if it has ``neighbours`` parts, or two that reach ``small`` bytes together: so a message is
        rewritten some log(parts) times, not at each call. All folders are rewritten in one job, one run of each,
        the longest; again until none is left. Scans and streams go on meanwhile: files stay until ``vacuum``, and each
        uid is in one part of any version. If another compaction was first, this one leaves things as they are.
        """
        replaced = 0
        while True:
            state = self.state()
            runs = {f: run for f, parts in state.parts.items() if (run := _run(parts, small, neighbours))}
            if not runs:
                return replaced
            append = f"c{uuid.uuid4().hex}"
            places = [self._place(p.append, f) for f, run in runs.items() for p in run]
            only = next(iter(runs)) if len(runs) == 1 else None
            added = dict(self._written(_together(self._stored(places).select(*STORED.names)), append, only))
            if not self._exchange(runs, added):
                self._remove(append)
                return replaced
            replaced += sum(map(len, runs.values()))

    def _exchange(self, runs: dict[str, list[Part]], added: dict[str, Part]) -> bool:
        def change(state: State) -> None:
            for folder, run in runs.items():
                parts = state.parts[folder]
                at = parts.index(run[0]) if run[0] in parts else -1
                if at < 0 or parts[at : at + len(run)] != run:
                    raise _Published
                if sum(p.rows for p in run) != added[folder].rows:
                    raise OSError(f"{added[folder].rows} rows instead of {sum(p.rows for p in run)} in folder '{folder}'")
                parts[at : at + len(run)] = [added[folder]]
                state.replaced += [(p.append, folder, int(time.time())) for p in run]

        try:
            self._publish(change)
        except _Published:
            return False
        return True

    def vacuum(self, grace: int = GRACE) -> int:
        """Delete what was replaced ``grace`` seconds ago, and directories of that age that no version names.

        Scans that were planned, and appends that began, longer ago than that lose their files.
        """
        before, removed = time.time() - grace, 0
        state = self.state()
        old = [r for r in state.replaced if r[2] <= before]
        for append, folder, _ in old:
            self._remove(append, folder)

        def change(state: State) -> None:
            state.replaced = [r for r in state.replaced if r not in old]

        self._publish(change)
        state = self.state()
        named = {p.append for parts in state.parts.values() for p in parts} | {r[0] for r in state.replaced}
        for found in self.ledger.files.listStatus(self._path("messages")):
            append = found.getPath().getName().removeprefix("append=")
            if append not in named | {"none"} and found.getModificationTime() <= before * 1000:
                self._remove(append)
                removed += append not in {r[0] for r in old}
        return len(old) + removed

    def _is_published(self, state: State, batch: tuple[str, int] | None) -> bool:
        return batch is not None and state.batches.get(batch[0], -1) >= batch[1]

    def _check_validity(self, state: State, folder: str, uidvalidity: int | None) -> None:
        known = state.folders.get(folder)
        if known is not None and uidvalidity not in (None, known.uidvalidity):
            raise ValueError(
                f"uidvalidity of folder '{folder}' changed from {known.uidvalidity} to {uidvalidity}: "
                "its uids name other messages now, import it into a new archive"
            )


def _together(mail: DataFrame) -> DataFrame:
    """Messages of a folder and uid range in one place, in partitions of even size, in order."""
    bucketed = mail.withColumn("__bucket", F.floor(F.col("uid") / UID_BUCKET))
    return bucketed.hint("rebalance", "folder", "__bucket").drop("__bucket").sortWithinPartitions("folder", "uid")


def _but_news(state: State) -> tuple:
    return state.folders, state.parts, state.replaced, state.batches


def _ranges(part: Part) -> list[dict[str, int]]:
    """A part in uid ranges of about ``NEWS_BYTES``."""
    pieces = max(1, min(-(-part.bytes // NEWS_BYTES), part.last - part.first + 1))
    edges = [part.first + (part.last + 1 - part.first) * i // pieces for i in range(pieces + 1)]
    return [{"first": a, "last": b - 1} for a, b in zip(edges, edges[1:])]


def _run(parts: list[Part], small: int, neighbours: int) -> list[Part]:
    """The longest run of small parts worth to be rewritten."""
    runs: list[list[Part]] = [[]]
    for p in parts:
        if p.bytes < small:
            runs[-1].append(p)
        else:
            runs.append([])
    worth = [r for r in runs if len(r) >= max(2, neighbours) or len(r) > 1 and sum(p.bytes for p in r) >= small]
    return max(worth, key=len, default=[])


class _Renumber(Exception):
    pass


class _Published(Exception):
    pass
