"""Folders as streams, outboxes as streaming sinks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from mailspark import metadata as M
from mailspark.operators import outbox
from mailspark.operators.project import decode_mail, stored_columns
from mailspark.options import IMAP_SPEC, SMTP_SPEC, MailOptions, check_mode
from mailspark.session import register
from mailspark.sources.archive import STORED, Archive


def follow(archive: Archive, options: Mapping[str, str], checkpoint: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Undecoded messages of an archive folder as a stream; ``columns`` of them, all by default.

    Mode ``all`` delivers existing mail from ``offset`` on, then new mail; ``new`` only mail past the
    frontier at the first start. That frontier and the uid validity are kept next to the checkpoint,
    so a restart goes on with the same bound; a changed uid validity is an error.

    What streams is the news of the archive, one small file per append with the uid ranges it added; ``max-files``
    bounds how many of them a micro-batch takes. Tasks read each range as Arrow batches from the parts that hold it
    when they run, so a compaction in between neither repeats nor loses a message.
    """
    parsed = MailOptions.parse({"archive": archive.path, **options}, IMAP_SPEC, substitute="archive")
    check_mode(parsed, streaming=True)
    folder = parsed["folder"]
    register(archive.spark)
    first = _first_uid(archive, parsed, folder, checkpoint)
    archive.tell_news()
    reader = archive.spark.readStream
    if parsed["max-files"]:
        reader = reader.option("maxFilesPerTrigger", parsed["max-files"])
    news = reader.text(f"{archive.path}/news")
    ranges = news.select(F.from_json("value", "folder string, first bigint, last bigint").alias("r")).select("r.*")
    ranges = ranges.where((F.col("folder") == folder) & (F.col("last") >= first)).repartition("first")
    wanted = [f for f in STORED if f.name in {"folder", "uid", *(columns or STORED.names)}]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted)
    messages = ranges.mapInArrow(_reader(parsed, [f.name for f in wanted]), types)
    return messages.where(F.col("uid") >= first)


def _reader(options: MailOptions, columns: list[str]) -> Any:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from mailspark.sources.transport import ArchiveTransport

        source = ArchiveTransport(options)
        for batch in batches:
            for r in batch.to_pylist():
                yield from source.read_range(r["folder"], r["first"], r["last"], columns)

    return run


def _first_uid(archive: Archive, options: MailOptions, folder: str, checkpoint: str) -> int:
    spark = archive.spark
    validity, frontier = archive.status(folder)
    path = f"{checkpoint.rstrip('/')}-frontier"
    schema = "uidvalidity bigint, uid bigint"
    kept = _kept(spark, path, schema)
    if kept is not None:
        if kept.uidvalidity != validity:
            raise ValueError(
                f"uidvalidity of folder '{folder}' changed from {kept.uidvalidity} to {validity}: "
                "start with a new checkpoint"
            )
        return kept.uid
    first = frontier if options["mode"] == "new" else options["offset"] or 1
    spark.createDataFrame([(validity, first)], schema).coalesce(1).write.mode("overwrite").parquet(path)
    return first


def _kept(spark: SparkSession, path: str, schema: str) -> Row | None:
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(context.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(schema).parquet(path).first()


def stream_folder(
    archive: Archive, schema: StructType | str, checkpoint: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Declared columns of an archive folder as a stream."""
    parsed = MailOptions.parse({"archive": archive.path, **(options or {})}, IMAP_SPEC, substitute="archive")
    layout = M.Layout.of(schema, parsed.aliases, parsed["content-columns"])
    return decode_mail(
        follow(archive, options or {}, checkpoint, [*stored_columns(layout, has_envelope=True), "envelope"]),
        layout,
        format=parsed["format"],
        format_options=parsed.format_options,
    )


def poll(options: Mapping[str, str] | None = None) -> dict[str, Any]:
    """Arguments for ``writeStream.trigger`` that look for new mail every ``interval``."""
    parsed = MailOptions.parse({"host": "", **(options or {})}, IMAP_SPEC)
    return {"processingTime": f"{int(parsed['interval'].total_seconds() * 1000)} milliseconds"}


def send_stream(
    rows: DataFrame, options: Mapping[str, str], checkpoint: str, trigger: Mapping[str, Any] | None = None
) -> StreamingQuery:
    """Send one mail per row of an unbounded query, or append it to the archive named by ``spool``."""
    parsed = MailOptions.parse(options, SMTP_SPEC, substitute="spool")
    if parsed["spool"] or parsed["journal"]:
        sink = rows.writeStream.foreachBatch(lambda batch, number: outbox.send(batch, options, (checkpoint, number)))
    else:
        messages = outbox.check_recipients(outbox.compose(rows, options))
        sink = messages.writeStream.format("smtp").options(**outbox.account_options(options))
    return sink.option("checkpointLocation", checkpoint).trigger(**(trigger or poll())).start()
