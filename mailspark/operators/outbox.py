"""Rows -> outgoing messages, and their delivery."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType

from mailspark import metadata as M
from mailspark.functions import address as A
from mailspark.functions import formats
from mailspark.functions import patterns as P
from mailspark.functions import words
from mailspark.options import ACCOUNT_SPEC, SMTP_SPEC, MailOptions
from mailspark.sources.archive import Archive
from mailspark.sources.journal import NOTES

# Header name and order of the written address lists; bcc is never a header.
ADDRESS_HEADERS = {"from": "From", "to": "To", "cc": "Cc", "replyTo": "Reply-To"}
RECIPIENTS = ("to", "cc", "bcc")

_EOL = "\r\n"


def header_address(parsed: Column) -> Column:
    """struct(name, address) as header text; a name beyond ASCII becomes encoded words."""
    name, address = parsed.getField("name"), parsed.getField("address")
    encoded = F.concat(words.encode_words(name), F.lit(" <"), address, F.lit(">"))
    return F.when(F.regexp_like(name, F.lit(r"[^ -~]")), encoded).otherwise(A.encode_address(parsed))


def header_texts(parsed: Column) -> Column:
    """Array of struct(name, address) as header text, one address per folded line."""
    return F.nullif(F.array_join(F.transform(parsed, header_address), f",{_EOL} "), F.lit(""))


def with_envelopes(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """For each address list ``__x`` add its header text ``__x_text`` and bare addresses ``__x_boxes``.

    Lists of plain valid addresses are taken as they are. The grammar, which checks and parses the
    others, stands in the plan once, over an array of them.
    """
    if not names:
        return rows
    rows = rows.withColumns({f"__{k}_ready": ready_list(F.col(f"__{k}")) for k in names})
    hard = F.array(*[F.when(F.col(f"__{k}_ready").isNull(), F.col(f"__{k}")) for k in names])
    rows = rows.withColumn(
        "__parsed", F.transform(hard, lambda a: A.decode_addresses(F.filter(a, lambda one: one.isNotNull())))
    )
    rows = rows.withColumns({
        "__texts": F.transform("__parsed", header_texts),
        "__boxes": F.transform("__parsed", A.mailboxes),
    })
    columns = {}
    for i, k in enumerate(names):
        ready = F.col(f"__{k}_ready")
        text = F.replace(ready, F.lit(P.SEPARATOR), F.lit(f",{_EOL} "))
        boxes = F.regexp_extract_all(ready, F.lit(P.READY_SPEC), F.lit(1))
        columns[f"__{k}_text"] = F.coalesce(text, F.get("__texts", F.lit(i)))
        columns[f"__{k}_boxes"] = F.coalesce(boxes, F.get("__boxes", F.lit(i)))
    return rows.withColumns(columns)


def ready_list(texts: Column) -> Column:
    """Address texts joined by the separator when all are valid and plain, else null."""
    joined = F.array_join(texts, P.SEPARATOR)
    apart = ~F.contains(F.array_join(texts, ""), F.lit(P.SEPARATOR))
    return F.when(apart & F.regexp_like(joined, F.lit(P.READY_LIST)), joined)


def subject_header(subject: Column) -> Column:
    """Subject line, absent for null; a line break in the subject fails the query."""
    safe = F.when(
        F.regexp_like(subject, F.lit(P.LINE_BREAK)),
        F.raise_error(F.concat(F.lit("Line break in subject: "), subject)).cast("string"),
    ).otherwise(subject)
    return F.coalesce(F.concat(F.lit("Subject: "), words.encode_text(safe), F.lit(_EOL)), F.lit(""))


def base64_lines(data: Column) -> Column:
    """Bytes as base64 text in lines of 76."""
    letters = F.regexp_replace(F.base64(data), r"[\r\n]++", "")
    return F.regexp_replace(letters, r"(.{76})(?=.)", f"$1{_EOL}")


def body_part(content: Column, is_binary: bool) -> Column:
    """Header lines, blank line and text of the one text/plain part."""
    kind = f"Content-Type: text/plain; charset=UTF-8{_EOL}"
    as_base64 = f"{kind}Content-Transfer-Encoding: base64{_EOL}{_EOL}"
    if is_binary:
        return F.concat(F.lit(as_base64), base64_lines(F.coalesce(content, F.lit(b""))))
    text = F.coalesce(content, F.lit(""))
    encoded = F.concat(F.lit(as_base64), base64_lines(F.encode(text, "UTF-8")))
    plain = F.concat(F.lit(f"{kind}Content-Transfer-Encoding: 7bit{_EOL}{_EOL}"), text)
    return F.when(F.regexp_like(text, F.lit(P.NEEDS_BASE64)), encoded).otherwise(plain)


def outbox_layout(rows: DataFrame, options: MailOptions) -> M.Layout:
    layout = M.Layout.of(rows.schema, options.aliases, options["content-columns"], M.WRITABLE)
    apart = (options["message-key"], options["date-column"])
    return M.Layout(tuple(c for c in layout.columns if c.name not in apart or c.key is not None))


def date_line(sent: Column) -> Column:
    """Header with a time in UTC."""
    utc = F.to_utc_timestamp(sent, F.current_timezone())
    return F.concat(F.lit("Date: "), F.date_format(utc, "EEE, d MMM yyyy HH:mm:ss"), F.lit(f" +0000{_EOL}"))


def compose(rows: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """Build one message per row: raw, envelope_from, envelope_to, message_id.

    Columns named like a writable key are headers, the others are content for the format. The
    Message-ID is a hash of the message and, if named by ``message-key``, of a column: sending a
    row again gives the same id. The Date is no part of it: it is the time of sending, or that of the
    column named by ``date-column``.
    """
    parsed = _options(options)
    layout = outbox_layout(rows, parsed)
    by_key = {c.key: F.col(f"`{c.name}`") for c in layout.metadata}
    lists = {k: v for k, v in by_key.items() if k != "subject"}
    key, date = parsed["message-key"], parsed["date-column"]

    body = None
    is_binary = False
    if layout.content:
        body = formats.encode_content(parsed["format"], layout.content, parsed.format_options)
        raw_column = layout.content[0].type if parsed["format"] == "raw" else None
        is_binary = isinstance(raw_column, BinaryType) or parsed["format"] == "avro"

    names = [k for k in M.WRITABLE if k in lists]
    decoded = rows.select(
        *([body_part(body, is_binary).alias("__part")] if body is not None else []),
        subject_header(by_key["subject"] if "subject" in by_key else F.lit(None).cast("string")).alias("__subject"),
        *[lists[k].alias(f"__{k}") for k in names],
        (F.col(f"`{key}`").cast("string") if key else F.lit("")).alias("__key"),
        (F.coalesce(F.col(f"`{date}`").cast("timestamp"), F.current_timestamp()) if date else F.current_timestamp()).alias("__sent"),
    )
    decoded = with_envelopes(decoded, names)
    lines = [
        F.coalesce(F.concat(F.lit(f"{title}: "), f"__{k}_text", F.lit(_EOL)), F.lit(""))
        for k, title in ADDRESS_HEADERS.items()
        if k in names
    ]
    none = F.array().cast("array<string>")
    recipients = [F.coalesce(f"__{k}_boxes", none) for k in RECIPIENTS if k in names]
    headed = decoded.select(
        F.concat(*lines, "__subject").alias("__head"),
        *(["__part"] if body is not None else []),
        "__key",
        "__sent",
        (F.get("__from_boxes", F.lit(0)) if "from" in names else F.lit(None).cast("string")).alias("envelope_from"),
        (F.concat(*recipients) if recipients else none).alias("envelope_to"),
    )
    part = F.col("__part") if body is not None else F.lit("")
    bcc = F.array_join("envelope_to", ",")
    hashed = headed.withColumn(
        "__hash", F.sha2(F.concat_ws("\n", "__key", bcc, "__head", part), 256)
    )
    return hashed.select(
        _message(body is not None).cast("binary").alias("raw"),
        F.coalesce("envelope_from", F.lit(parsed["user"] or "")).alias("envelope_from"),
        "envelope_to",
        message_id().alias("message_id"),
    )


def message_id() -> Column:
    return F.concat(F.lit("<"), F.col("__hash"), F.lit("@mailspark.invalid>"))


def _message(has_content: bool) -> Column:
    head = [
        F.col("__head"),
        date_line(F.col("__sent")),
        F.lit("Message-ID: "), message_id(), F.lit(_EOL),
        F.lit(f"MIME-Version: 1.0{_EOL}"),
    ]
    if not has_content:
        return F.concat(*head, F.lit(f"Content-Type: text/plain; charset=us-ascii{_EOL}{_EOL}"))
    boundary = F.concat(F.lit("=_"), F.left(F.col("__hash"), F.lit(32)))
    return F.concat(
        *head,
        F.lit(f'Content-Type: multipart/mixed;{_EOL} boundary="'), boundary, F.lit(f'"{_EOL}{_EOL}'),
        F.lit("--"), boundary, F.lit(_EOL),
        F.col("__part"), F.lit(_EOL),
        F.lit("--"), boundary, F.lit(f"--{_EOL}"),
    )


def _options(options: Mapping[str, str] | None) -> MailOptions:
    given = dict(options or {})
    if not {"host", "spool"} & {k.lower() for k in given}:
        given["host"] = "localhost"
    return MailOptions.parse(given, SMTP_SPEC, substitute="spool")


def check_recipients(messages: DataFrame) -> DataFrame:
    """Fail the query on a message without recipients."""
    missing = F.raise_error(F.concat(F.lit("No recipient addresses: "), F.col("message_id"))).cast("array<string>")
    checked = F.when(F.size("envelope_to") == 0, missing).otherwise(F.col("envelope_to"))
    return messages.withColumn("envelope_to", checked)


def send(rows: DataFrame, options: Mapping[str, str], batch: tuple[str, int] | None = None) -> None:
    """Send one mail per row, or append it to a folder of the archive named by ``spool``.

    Sending is at least once: a task or batch that runs again sends again, under the same Message-ID. With an option
    ``journal``, a folder, only what is not noted there is sent again, and a refused recipient is a note instead of an
    error (``outcomes``); rows that share a Message-ID are then one mail, unless a ``message-key`` tells them apart.
    A spool gets each ``batch`` (its writer and number) once.
    """
    parsed = MailOptions.parse(options, SMTP_SPEC, substitute="spool")
    if parsed["spool"] is not None:  # spread before the work, whatever tasks the rows come in; a server gets them as they are
        rows = rows.hint("rebalance")
    messages = check_recipients(compose(rows, options))
    if parsed["spool"] is None:
        account = account_options(options)
        if parsed["journal"]:
            place = f"{parsed['journal'].rstrip('/')}/{_batch_name(batch)}"
            messages = _not_noted(messages, place)
            account |= {"journal": place, "journal-run": uuid.uuid4().hex}
        messages.write.format("smtp").options(**account).mode("append").save()
        return
    # The envelope must be part of the plan for its check to run; the spool does not store it.
    mail = messages.where(F.size("envelope_to") > 0).select(
        F.current_timestamp().alias("internal_date"),
        F.array().cast("array<string>").alias("flags"),
        "raw",
    )
    Archive(rows.sparkSession, parsed["spool"]).append(mail, folder=parsed["folder"], clustered=True, batch=batch)


def account_options(options: Mapping[str, str]) -> dict[str, str]:
    """The options that say how to reach the server."""
    return {k: v for k, v in options.items() if k.lower() in ACCOUNT_SPEC}


def _batch_name(batch: tuple[str, int] | None) -> str:
    return "all" if batch is None else f"{zlib.crc32(batch[0].encode()):08x}-{batch[1]}"


def _not_noted(messages: DataFrame, place: str) -> DataFrame:
    """Messages that no run has noted under a folder."""
    spark = messages.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return messages
    noted = spark.read.schema(NOTES).json(place).select(F.col("message_id").alias("__noted")).distinct()
    return messages.join(noted, F.col("message_id") == F.col("__noted"), "left_anti")


def outcomes(spark: SparkSession, journal: str) -> DataFrame:
    """``message_id``, ``recipient``, ``code``, ``reason``: what servers made of each mail; 250 for what they took."""
    return spark.read.schema(NOTES).option("recursiveFileLookup", "true").json(journal)
