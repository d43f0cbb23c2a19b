"""One query per operator of the inventory, over mail made from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailspark import metadata as M
from mailspark.catalog import MailCatalog, read_folder
from mailspark.functions import address as A
from mailspark.functions import body as B
from mailspark.operators.outbox import compose, send
from mailspark.operators.project import decode_mail, physical_row, row_slice
from mailspark.plans import fixtures as X
from mailspark.session import new_path, register
from mailspark.sources.archive import Archive
from mailspark.streaming.mailbox import send_stream, stream_folder

Query = Callable[[SparkSession, str], DataFrame]


def _seconds(name: str) -> Column:
    """Epoch seconds, -1 for none."""
    return F.coalesce(F.unix_seconds(name), F.lit(-1)).alias(name)


def _micros(name: str) -> Column:
    return F.unix_micros(name).alias(name)


def _joined(name: str) -> Column:
    """A list as one text, ``-`` for none."""
    return F.coalesce(F.array_join(name, "|"), F.lit("-")).alias(name)


def _text(name: str) -> Column:
    return F.coalesce(name, F.lit("-")).alias(name)


# -- scans ----------------------------------------------------------------------------------------


def inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subject, first addresses and content of every message."""
    columns = "subject string, fromFirst string, toFirst string, content string"
    return decode_mail(X.event_mail(spark, sf_dir), columns)


def scan_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = X.archive_of(spark, sf_dir, "event_mail")
    return read_folder(spark, {"archive": archive.path, "mode": "current"}, "uid bigint, subject string")


def scan_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = X.archive_of(spark, sf_dir, "event_mail")
    return read_folder(spark, {"archive": archive.path, "offset": "501"}, "uid bigint, subject string")


def scan_batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with holes fetched in pages of several sizes: count and sums are the same for each."""
    register(spark)
    archive = X.archive_of(spark, sf_dir, "event_mail_holes")

    def read(size: int) -> DataFrame:
        reader = spark.read.format("imap").options(**{"archive": archive.path, "batch-size": str(size)})
        mail = reader.schema("uid bigint, subject string").load()
        return mail.agg(
            F.lit(size).alias("size"), F.count("*").alias("messages"), F.sum("uid").alias("uid_sum"),
            F.sum(F.length("subject")).alias("letters"),
        )

    return read(7).unionAll(read(50)).unionAll(read(100_000))


def scan_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and uid sum per page of 50 uids, in a folder with holes."""
    archive = X.archive_of(spark, sf_dir, "event_mail_holes")
    mail = read_folder(spark, {"archive": archive.path}, "uid bigint")
    page = F.floor((F.col("uid") - 1) / 50).cast("bigint")
    return mail.groupBy(page.alias("page")).agg(F.count("*").alias("messages"), F.sum("uid").alias("uid_sum"))


def scan_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = X.archive_of(spark, sf_dir, "conv_mail")
    return read_folder(spark, {"archive": archive.path, "folder": "user"}, "uid bigint, subject string, content string")


def scan_all_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and bytes per folder, over the whole archive."""
    archive = X.archive_of(spark, sf_dir, "conv_mail")
    mail = decode_mail(archive.messages(), "sizeInBytes bigint", keep=["folder"])
    return mail.groupBy("folder").agg(F.count("*").alias("messages"), F.sum("sizeInBytes").alias("bytes"))


# -- streams --------------------------------------------------------------------------------------


def _drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over what there is now, into a table."""
    sink = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    sink.trigger(availableNow=True).start(path).awaitTermination()


def stream_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = X.archive_of(spark, sf_dir, "event_mail")
    out = new_path(spark, "stream_all")
    checkpoint = f"{out}-checkpoint"
    _drain(stream_folder(archive, "uid bigint, subject string", checkpoint), out, checkpoint)
    return spark.read.schema("uid bigint, subject string").parquet(out)


def stream_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the mail is there at the first start; the other half arrives before a restart."""
    mail = X.event_mail(spark, sf_dir)
    half = mail.count() // 2
    archive = Archive(spark, new_path(spark, "stream_new")).create()
    archive.append(mail.where(F.col("uid") <= half), clustered=True)
    out = new_path(spark, "stream_new-out")
    checkpoint = f"{out}-checkpoint"

    def start() -> None:
        stream = stream_folder(archive, "uid bigint, subject string", checkpoint, {"mode": "new"})
        _drain(stream, out, checkpoint)

    start()
    archive.append(mail.where(F.col("uid") > half), clustered=True)
    start()
    return spark.read.schema("uid bigint, subject string").parquet(out)


def import_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An import in batches, one of which runs again: each message is there once."""
    mail = X.event_mail(spark, sf_dir)
    half = mail.count() // 2
    archive = Archive(spark, new_path(spark, "import_resume")).create()
    for number, part in ((0, F.col("uid") <= half), (0, F.col("uid") <= half), (1, F.col("uid") > half)):
        archive.append(mail.where(part), clustered=True, batch=("import", number))
    return read_folder(spark, {"archive": archive.path}, "uid bigint, subject string")


def compact_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail that comes in six appends, is compacted twice and streamed in between: scan and stream have each once."""
    mail = X.event_mail(spark, sf_dir)
    size = -(-mail.count() // 6)
    archive = Archive(spark, new_path(spark, "compact_resume")).create()
    out = new_path(spark, "compact_resume-out")
    for half in (0, 1):
        for part in range(3 * half, 3 * half + 3):
            archive.append(mail.where(F.ceil(F.col("uid") / size) - 1 == part), folder="INBOX", clustered=True)
        if half == 0:
            _drain(stream_folder(archive, "uid bigint", f"{out}-checkpoint"), out, f"{out}-checkpoint")
        archive.compact(neighbours=2)
    _drain(stream_folder(archive, "uid bigint", f"{out}-checkpoint"), out, f"{out}-checkpoint")
    streamed = spark.read.schema("uid bigint").parquet(out).withColumnRenamed("uid", "seen")
    scanned = read_folder(spark, {"archive": archive.path}, "uid bigint, subject string")
    return scanned.join(streamed, F.col("uid") == F.col("seen"), "full").select("uid", "subject")


# -- metadata columns -----------------------------------------------------------------------------


def meta_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = decode_mail(X.event_mail_bad(spark, sf_dir), "uid bigint, sent timestamp, received timestamp")
    return mail.select("uid", _seconds("sent"), _micros("received"))


def meta_bcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = decode_mail(X.event_mail_bad(spark, sf_dir), "uid bigint, bcc array<string>, recipients array<string>")
    return mail.select("uid", _joined("bcc"), _joined("recipients"))


def meta_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ["from", "to", "cc", "bcc", "recipients", "replyTo"]
    firsts = ["fromFirst", "toFirst"]
    schema = ", ".join(f"`{k}` {M.readable(k).simpleString()}" for k in ["uid", *lists, *firsts])
    mail = decode_mail(X.event_mail(spark, sf_dir), schema)
    return mail.select("uid", *[_joined(k) for k in lists], *[_text(k) for k in firsts])


def meta_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = decode_mail(X.event_mail(spark, sf_dir), "uid bigint, seen boolean, draft boolean, answered boolean")
    return mail.select("uid", *[F.col(k).cast("int").alias(k) for k in ("seen", "draft", "answered")])


def meta_size_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_mail(X.event_mail(spark, sf_dir), "uid bigint, sizeInBytes bigint, contentType string")


def meta_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = decode_mail(X.event_mail(spark, sf_dir), "uid bigint, headers array<struct<key:string,value:string>>")
    return mail.select(
        "uid",
        F.size("headers").alias("headers"),
        F.array_join(F.transform("headers", lambda h: h.getField("key")), ",").alias("keys"),
        F.element_at("headers", 2).getField("value").alias("second"),
        F.element_at("headers", 3).getField("value").alias("third"),
    )


def meta_alias_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uid as a string under another name."""
    return decode_mail(X.event_mail(spark, sf_dir), "id string, subject string", aliases={"id": "uid"})


def meta_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns declared with other types than their own."""
    mail = decode_mail(X.event_mail(spark, sf_dir), "uid string, sizeInBytes double, seen string, draft int, received bigint")
    return mail.select("uid", F.col("sizeInBytes").cast("bigint").alias("bytes"), "seen", "draft", "received")


def projection_no_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = X.archive_of(spark, sf_dir, "event_mail")
    return read_folder(spark, {"archive": archive.path}, "subject string, uid bigint, seen boolean").select(
        "uid", "subject", F.col("seen").cast("int").alias("seen")
    )


def row_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content columns first, then metadata; the slice of the content columns as one value."""
    layout = M.Layout.of("uid bigint, k int, subject string, k2 string", aliases=None)
    decoded = decode_mail(X.event_mail(spark, sf_dir), layout, format="json")
    row = physical_row(decoded, layout)
    first = len(layout.content)
    return row.select(
        F.lit(",".join(row.columns)).alias("layout"),
        F.to_json(row_slice(row, 0, first), {"ignoreNullFields": "false"}).alias("content"),
        F.to_json(row_slice(row, first, len(row.columns))).alias("metadata"),
    )


# -- content formats ------------------------------------------------------------------------------


def format_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_mail(X.conv_mail(spark, sf_dir), "uid bigint, content string", keep=["folder"])


def format_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_mail(X.event_mail(spark, sf_dir), "uid bigint, k bigint", format="json")


def format_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "uid bigint, o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    return decode_mail(X.order_mail(spark, sf_dir), schema, format="csv")


def format_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "uid bigint, o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    return decode_mail(X.order_xml_mail(spark, sf_dir), schema, format="xml", format_options={"rowTag": "order"})


def format_bad_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = decode_mail(X.event_mail_bad(spark, sf_dir), "uid bigint, subject string, k bigint", format="json")
    return mail.select("uid", "subject", F.coalesce("k", F.lit(-1)).alias("k"))


def content_base64_utf8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_mail(X.doc_mail(spark, sf_dir), "uid bigint, subject string, content string", keep=["folder"])


def content_quoted_printable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_mail(X.quoted_mail(spark, sf_dir), "uid bigint, content string", keep=["folder"])


# -- outbox ---------------------------------------------------------------------------------------


def _spooled(rows: DataFrame, schema: str, **options: str) -> DataFrame:
    """Send rows into a spool and read the mail back."""
    spark = rows.sparkSession
    path = new_path(spark, "spool")
    Archive(spark, path).create()
    send(rows, {"spool": path, "date-column": "ordered", **options})
    return read_folder(spark, {"archive": path, "folder": "OUTBOX"}, schema)


def outbox_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = ["from", "to", "cc", "bcc", "replyTo"]
    columns = ", ".join(f"`{k}` array<string>" for k in lists)
    mail = _spooled(X.order_outbox(spark, sf_dir), f"subject string, sent timestamp, {columns}, body string")
    content = B.only_part(F.col("body")).cast("string").alias("content")
    return mail.select("subject", _seconds("sent"), *[_joined(k) for k in lists], content)


def outbox_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two content columns as one JSON body, read back by name."""
    mail = _spooled(X.order_outbox(spark, sf_dir, "json"), "subject string, body string", format="json")
    content = F.from_json(B.only_part(F.col("body")).cast("string"), "o_orderkey bigint, o_custkey bigint")
    return mail.select("subject", content.alias("c")).select("subject", "c.*")


def outbox_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two content columns as one line of CSV, as it is sent."""
    mail = _spooled(X.order_outbox(spark, sf_dir, "json"), "subject string, body string", format="csv")
    return mail.select("subject", B.only_part(F.col("body")).cast("string").alias("content"))


def outbox_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two content columns as one XML body, read back by name."""
    mail = _spooled(X.order_outbox(spark, sf_dir, "json"), "subject string, body string", format="xml")
    content = F.from_xml(B.only_part(F.col("body")).cast("string"), "o_orderkey bigint, o_custkey bigint")
    return mail.select("subject", content.alias("c")).select("subject", "c.*")


def outbox_no_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.order_outbox(spark, sf_dir, "none")
    mail = _spooled(rows, "subject string, contentType string, body string")
    return mail.groupBy("contentType").agg(
        F.count("*").alias("messages"), F.sum(F.octet_length("body")).alias("body_bytes")
    )


def outbox_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of other names as subject and recipients; a column named like a key as content."""
    rows = X.order_outbox(spark, sf_dir, "none").select(F.col("subject").alias("title"), "from", F.col("to").alias("rcpt"), F.col("subject").alias("cc"), "ordered")
    mail = _spooled(rows, "subject string, `to` array<string>, cc array<string>, body string", **{"metadata.title": "subject", "metadata.rcpt": "to", "content-columns": "cc"})
    return mail.select("subject", _joined("to"), _joined("cc"), B.only_part(F.col("body")).cast("string").alias("content"))


def outbox_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sender and recipients as given to the server."""
    sent = compose(X.order_outbox(spark, sf_dir), {"date-column": "ordered"})
    return sent.groupBy("envelope_from", F.array_join("envelope_to", ",").alias("recipients")).agg(
        F.count("*").alias("messages"), F.count_distinct("message_id").alias("ids")
    )


def outbox_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event becomes a mail, from a stream of events."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rows = stream.select(
        F.concat(F.lit("Event "), F.col("event_id").cast("string")).alias("subject"),
        F.array(F.lit("monitor@mail.test")).alias("from"),
        F.array(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@mail.test"))).alias("to"),
        F.col("props").alias("content"),
    )
    path = new_path(spark, "outbox_stream")
    Archive(spark, path).create()
    send_stream(rows, {"spool": path}, f"{path}-checkpoint", {"availableNow": True}).awaitTermination()
    mail = read_folder(
        spark, {"archive": path, "folder": "OUTBOX"}, "subject string, toFirst string, body string"
    )
    return mail.select("subject", "toFirst", B.only_part(F.col("body")).cast("string").alias("content"))


def decode_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and address parts of three address texts per order."""
    rows = X.order_outbox(spark, sf_dir)
    texts = F.array(F.get("to", F.lit(0)), F.lit('"Doe, Jane" <ops@mail.test>'), F.get("cc", F.lit(0)))
    parsed = A.decode_addresses(texts)

    def part(field: str) -> Column:
        return F.array_join(F.transform("a", lambda a: F.coalesce(a.getField(field), F.lit("-"))), "|")

    return rows.select("subject", parsed.alias("a")).select("subject", part("name").alias("names"),
                                                            part("address").alias("addresses"))


# -- catalog --------------------------------------------------------------------------------------


def _catalog(spark: SparkSession, sf_dir: str, fixture: str, database: str) -> MailCatalog:
    return MailCatalog(spark, {"archive": X.archive_of(spark, sf_dir, fixture).path}, database)


def catalog_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The databases an account lists, with the folders in each."""
    catalog = _catalog(spark, sf_dir, "conv_mail", "conv_folders")
    (database,) = [d for d in catalog.list_databases() if catalog.database_exists(d)]
    return catalog.folders().select(F.lit(database).alias("database"), "name")


def catalog_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the folders of the conversations, and of names like them, exist."""
    catalog = _catalog(spark, sf_dir, "conv_mail", "conv_folders")
    role = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("role").distinct().where("role IS NOT NULL")
    names = role.select(F.explode(F.array("role", F.concat("role", F.lit("/Sent")), F.upper("role"))).alias("name"))
    return catalog.tables_exist(names)


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight default columns of a folder's table."""
    tables = _catalog(spark, sf_dir, "conv_mail", "conv_folders").sync()
    mail = spark.table(tables["user"])
    lists = [_joined(k) for k in ("from", "to", "cc", "bcc")]
    return mail.select("uid", "subject", _seconds("sent"), _micros("received"), *lists)


def catalog_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns of every folder, read by Spark's own Parquet scan."""
    archive = X.archive_of(spark, sf_dir, "conv_mail")
    mail = decode_mail(archive.messages(), M.default_schema(), keep=["folder"])
    lists = [_joined(k) for k in ("from", "to", "cc", "bcc")]
    return mail.select("folder", "uid", "subject", _seconds("sent"), _micros("received"), *lists)


def catalog_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An offset given in the query overrides the table's."""
    _catalog(spark, sf_dir, "event_mail", "event_folders").sync()
    return spark.sql("SELECT uid, subject FROM event_folders_inbox_from(501)")


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        inbox,
        scan_current, scan_offset, scan_batched, scan_batch_sizes, scan_folder, scan_all_folders,
        stream_all, stream_new, import_resume, compact_resume,
        meta_envelope, meta_addresses, meta_bcc, meta_flags, meta_size_type, meta_headers, meta_alias_cast, meta_casts,
        projection_no_content, row_layout,
        format_raw, format_json, format_csv, format_xml, format_bad_json, content_base64_utf8,
        content_quoted_printable,
        outbox_roundtrip, outbox_json, outbox_csv, outbox_xml, outbox_no_content, outbox_alias, outbox_envelope, outbox_stream,
        decode_addresses,
        catalog_folders, catalog_exists, catalog_table, catalog_view, catalog_hint,
    ]
}
