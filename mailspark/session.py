"""Session set-up: data source registration and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

_registered: set[str] = set()
_local_dirs: dict[str, str] = {}
_settings_lock = threading.RLock()
_made: dict[str, list[str]] = {}


def sources() -> dict[str, type]:
    """Data sources by format name."""
    from mailspark.sources.imap import FoldersDataSource, ImapDataSource
    from mailspark.sources.smtp import SmtpDataSource

    return {source.name(): source for source in (ImapDataSource, FoldersDataSource, SmtpDataSource)}


def register(spark: SparkSession) -> None:
    """Make the formats ``imap``, ``imap_folders`` and ``smtp`` known to a session."""
    app = spark.sparkContext.applicationId
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    if app in _registered:
        return
    _ship_package(spark)
    for source in sources().values():
        spark.dataSource.register(source)
    _registered.add(app)


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, as ``--py-files`` would."""
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="mailspark-"), "mailspark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``; a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="mailspark-work-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; ``release`` removes what is there."""
    path = f"{shared_folder(spark)}/mailspark/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove the staged tables of this application; DataFrames that read them cannot be used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _made.pop(spark.sparkContext.applicationId, [])
    removed = 0
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        removed += place.getFileSystem(conf).delete(place, True)
    return removed


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Hold SQL settings for a block, then put back what was there; one block at a time, whatever the thread."""
    with _settings_lock:
        yield from _held(spark, values)


def _held(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
