"""Mail folders as Spark tables and streams, and rows as outgoing mail."""

from mailspark.catalog import MailCatalog, fetch_folder, import_folder, read_folder
from mailspark.operators.outbox import compose, outcomes, send
from mailspark.operators.project import decode_mail, physical_row, row_slice, split_raw
from mailspark.session import register, release
from mailspark.sources.archive import Archive
from mailspark.sources.bound import create_table
from mailspark.streaming.mailbox import follow, poll, send_stream, stream_folder

__all__ = [
    "Archive",
    "MailCatalog",
    "compose",
    "create_table",
    "decode_mail",
    "fetch_folder",
    "follow",
    "import_folder",
    "outcomes",
    "physical_row",
    "poll",
    "read_folder",
    "register",
    "release",
    "row_slice",
    "send",
    "send_stream",
    "split_raw",
    "stream_folder",
]
