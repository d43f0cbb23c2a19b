"""Mail and outbox rows derived from the driver's tables; every value is a function of source columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailspark.functions.words import encode_words
from mailspark.operators.numbering import number_rows
from mailspark.session import new_path
from mailspark.sources.archive import Archive

_EOL = "\r\n"
_built: dict[tuple[str, str, str], Archive] = {}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table in the order of the first, spread over tasks by its ranges."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)
    return rows.repartitionByRange(columns[0]).sortWithinPartitions(columns[0])


def _line(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit(_EOL))


def _optional(condition: Column, line: Column) -> Column:
    return F.when(condition, line).otherwise("")


def _as_utc(ts: Column) -> Column:
    """Wall-clock time taken as UTC, whatever the session's time zone."""
    return F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")


def _event_mail(spark: SparkSession, sf_dir: str, bad: bool) -> DataFrame:
    events = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    uid = F.col("event_id") + 1
    user = F.col("user_id").cast("string")
    has_date = (F.col("event_id") % 11 != 0) if bad else F.lit(True)
    body = F.when(F.col("event_id") % 5 == 0, "not json").otherwise(F.col("props")) if bad else F.col("props")
    flags = [
        (F.col("user_id") % 2 == 0, "\\Seen"),
        (F.col("event_type") == "purchase", "\\Answered"),
        (F.col("event_id") % 10 == 0, "\\Draft"),
    ]
    date = F.date_format("ts", "EEE, d MMM yyyy HH:mm:ss")
    raw = F.concat(
        _optional(has_date, _line("Date: ", date, " +0000")),
        _line("From: User ", user, " <u", user, "@mail.test>"),
        _line(f'To: "Doe, Jane" <ops@mail.test>,{_EOL} audit@mail.test'),
        _optional(F.col("event_type") == "error", _line("Cc: oncall@mail.test")),
        *([_optional(F.col("user_id") % 3 == 0, _line("Bcc: Hidden <h", user, "@mail.test>"))] if bad else []),
        _line("Subject: ", F.col("event_type")),
        _line("MIME-Version: 1.0"),
        _line("Content-Type: application/json"),
        F.lit(_EOL),
        body,
    )
    return events.select(
        F.lit("INBOX").alias("folder"),
        uid.alias("uid"),
        _as_utc(F.col("ts")).alias("internal_date"),
        F.filter(F.array(*[F.when(c, F.lit(f)) for c, f in flags]), lambda f: f.isNotNull()).alias("flags"),
        raw.cast("binary").alias("raw"),
    )


def event_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_mail(spark, sf_dir, bad=False)


def event_mail_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth body is no JSON, every eleventh Date is missing, every third user has a Bcc."""
    return _event_mail(spark, sf_dir, bad=True)


def event_mail_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the expunged uids, every seventh."""
    return event_mail(spark, sf_dir).where(F.col("uid") % 7 != 0)


def conv_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per role; the uid is the place in the folder by conversation and turn."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    numbered = number_rows(rows, "role", ["conv_id", "turn"], new_path(spark, "numbered"))
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    raw = F.concat(
        _line("From: ", F.col("role"), "@mail.test"),
        _line("To: c", conv, "@mail.test"),
        _line("Reply-To: thread-", conv, "@mail.test"),
        _line("Subject: conv ", conv, " turn ", turn),
        _line("MIME-Version: 1.0"),
        _line("Content-Type: text/plain; charset=UTF-8"),
        _line("Content-Transfer-Encoding: 8bit"),
        F.lit(_EOL),
        F.col("text"),
    )
    return numbered.select(
        F.col("role").alias("folder"),
        "uid",
        F.timestamp_seconds(F.col("uid")).alias("internal_date"),
        F.array().cast("array<string>").alias("flags"),
        raw.cast("binary").alias("raw"),
    )


def doc_subject() -> Column:
    """A text beyond ASCII, too long for one encoded word."""
    number, size = F.col("doc_id").cast("string"), F.col("n_chars").cast("string")
    return F.concat(F.lit("Größe "), size, F.lit(" — très élevé — "), "source", F.lit(" №"), number, F.lit(" 日本語 "), "lang", F.lit("?="))


def doc_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base64 bodies, and subjects of several encoded words each."""
    subject = encode_words(doc_subject())
    raw = F.concat(
        _line("From: docs@mail.test"),
        _line("To: readers@mail.test"),
        _line("Subject: ", subject),
        _line("MIME-Version: 1.0"),
        _line("Content-Type: text/plain; charset=UTF-8"),
        _line("Content-Transfer-Encoding: base64"),
        F.lit(_EOL),
        F.base64(F.encode(F.col("text"), "UTF-8")),
    )
    return table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars").select(
        F.col("lang").alias("folder"),
        (F.col("doc_id") + 1).alias("uid"),
        F.timestamp_seconds(F.col("doc_id")).alias("internal_date"),
        F.array().cast("array<string>").alias("flags"),
        raw.cast("binary").alias("raw"),
    )


def order_outbox(spark: SparkSession, sf_dir: str, content: str = "raw") -> DataFrame:
    """Rows for the sink: one per order; ``content`` is raw (one column), json (two) or none."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate").join(
        table(spark, sf_dir, "customer", "c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")
    )
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    columns = [
        F.concat(F.lit("Order "), key, F.lit(" "), F.col("o_orderstatus")).alias("subject"),
        F.array(F.lit("orders@shop.test")).alias("from"),
        F.array(F.concat(F.col("c_name"), F.lit(" <c"), customer, F.lit("@mail.test>"))).alias("to"),
        F.when(F.startswith("o_orderpriority", F.lit("1")), F.array(F.lit("rush@shop.test"))).alias("cc"),
        F.array(F.lit("archive@shop.test")).alias("bcc"),
        F.array(F.lit("help@shop.test")).alias("replyTo"),
        _as_utc(F.col("o_orderdate")).alias("ordered"),
    ]
    if content == "raw":
        columns.append(F.concat_ws(",", key, customer, "o_orderpriority").alias("content"))
    elif content == "json":
        columns += [F.col("o_orderkey"), F.col("o_custkey")]
    return orders.select(*columns)


def order_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order fields as the CSV body of incoming mail."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    raw = F.concat(
        _line("From: orders@shop.test"),
        _line("Subject: Order ", F.col("o_orderkey").cast("string")),
        _line("Content-Type: text/csv"),
        F.lit(_EOL),
        _line(F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderpriority")),
    )
    return orders.select(
        F.lit("ORDERS").alias("folder"),
        (F.col("o_orderkey") + 1).alias("uid"),
        _as_utc(F.col("o_orderdate")).alias("internal_date"),
        F.array().cast("array<string>").alias("flags"),
        raw.cast("binary").alias("raw"),
    )


def order_xml_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order fields as the XML body of incoming mail."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    fields = ("o_orderkey", "o_custkey", "o_orderpriority")
    cells = [x for f in fields for x in (F.lit(f"<{f}>"), F.col(f).cast("string"), F.lit(f"</{f}>{_EOL}"))]
    raw = F.concat(
        _line("From: orders@shop.test"),
        _line("Content-Type: text/xml"),
        F.lit(_EOL),
        _line(F.concat(F.lit(f"<order>{_EOL}"), *cells, F.lit("</order>"))),
    )
    return orders.select(
        F.lit("ORDERS").alias("folder"),
        (F.col("o_orderkey") + 1).alias("uid"),
        _as_utc(F.col("o_orderdate")).alias("internal_date"),
        F.array().cast("array<string>").alias("flags"),
        raw.cast("binary").alias("raw"),
    )


def quoted_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as quoted-printable bodies, each byte quoted, in lines of 75 characters."""
    quoted = F.regexp_replace(F.hex(F.encode("text", "UTF-8")), "(..)", "=$1")
    lines = F.regexp_replace(quoted, "(.{75})(?=.)", f"$1={_EOL}")
    raw = F.concat(
        _line("From: docs@mail.test"),
        _line("Content-Type: text/plain; charset=UTF-8"),
        _line("Content-Transfer-Encoding: quoted-printable"),
        F.lit(_EOL),
        lines,
    )
    return table(spark, sf_dir, "documents", "doc_id", "text", "lang").select(
        F.col("lang").alias("folder"),
        (F.col("doc_id") + 1).alias("uid"),
        F.timestamp_seconds(F.col("doc_id")).alias("internal_date"),
        F.array().cast("array<string>").alias("flags"),
        raw.cast("binary").alias("raw"),
    )


_MAIL = {"event_mail": event_mail, "event_mail_holes": event_mail_holes, "conv_mail": conv_mail}

# ranges of event ids, in order, in one folder: their mail needs no shuffle on the way into the archive
_CLUSTERED = {"event_mail", "event_mail_holes"}


def archive_of(spark: SparkSession, sf_dir: str, fixture: str) -> Archive:
    """An archive of a mail fixture in the shared folder, imported once per application until it is released."""
    key = (spark.sparkContext.applicationId, sf_dir, fixture)
    if key not in _built or not _built[key].exists():
        archive = Archive(spark, new_path(spark, fixture)).create()
        alone = fixture in _CLUSTERED
        archive.append(_MAIL[fixture](spark, sf_dir), folder="INBOX" if alone else None, clustered=alone)
        _built[key] = archive
    return _built[key]
