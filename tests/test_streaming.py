"""Archive folders as streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_archive import archive, numbered  # noqa: F401

from mailspark import stream_folder


class Collector:
    def __init__(self, archive, tmp_path, **options):
        self.archive, self.place, self.options = archive, tmp_path, options

    def __call__(self) -> list[int]:
        stream = stream_folder(self.archive, "uid bigint, subject string", str(self.place / "cp"), self.options)
        sink = stream.writeStream.format("parquet").option("checkpointLocation", str(self.place / "cp"))
        sink.trigger(availableNow=True).start(str(self.place / "out")).awaitTermination()
        found = self.archive.spark.read.schema("uid bigint").parquet(str(self.place / "out")).collect()
        return sorted(r.uid for r in found)


def test_all_then_new(archive, mail, tmp_path):  # noqa: F811
    archive.append(numbered(mail, 1, 2, 5))
    collect = Collector(archive, tmp_path)
    assert collect() == [1, 2, 5]
    archive.append(numbered(mail, 6).unionByName(numbered(mail, 1, folder="other")))
    assert collect() == [1, 2, 5, 6]
    assert collect() == [1, 2, 5, 6]


def test_a_batch_is_bounded(archive, mail, tmp_path):  # noqa: F811
    for uid in range(1, 6):
        archive.append(numbered(mail, uid))
    stream = stream_folder(archive, "uid bigint", str(tmp_path / "cp"), {"max-files": "2"})
    sizes = []
    sink = stream.writeStream.foreachBatch(lambda rows, _: sizes.append(rows.count()))
    sink.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sizes == [2, 2, 1]


def test_a_lost_append_is_not_streamed(archive, mail, tmp_path, monkeypatch):  # noqa: F811
    archive.append(numbered(mail, 1))
    collect = Collector(archive, tmp_path)

    def dies(*_):
        raise OSError

    create = archive.ledger.create
    steps = {"_publish": (archive, dies), "create": (archive.ledger, lambda text, to: dies() if "/news/" in str(to) else create(text, to))}
    for name, (where, instead) in steps.items():
        with monkeypatch.context() as patch:
            patch.setattr(where, name, instead)
            with pytest.raises(OSError):
                archive.append(numbered(mail, 2))
        assert collect() == ([1] if name == "_publish" else [1, 2])
    assert collect() == [1, 2]


def test_only_needed_columns_are_read(archive, mail, tmp_path):  # noqa: F811
    archive.append(numbered(mail, 1))
    stream = stream_folder(archive, "uid bigint, seen boolean", str(tmp_path / "cp"))
    sink = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    sink.awaitTermination()
    plan = sink._jsq.explainInternal(False) if hasattr(sink, "_jsq") else ""
    assert "flags" in plan and "body" not in plan and "head" not in plan.replace("header", "")


def test_all_from_an_offset(archive, mail, tmp_path):  # noqa: F811
    archive.append(numbered(mail, 1, 2, 5))
    assert Collector(archive, tmp_path, offset="2")() == [2, 5]


def test_new_keeps_its_frontier_over_restarts(archive, mail, tmp_path):  # noqa: F811
    archive.append(numbered(mail, 1, 2))
    collect = Collector(archive, tmp_path, mode="new")
    assert collect() == []
    archive.append(numbered(mail, 3))
    assert collect() == [3]
    archive.append(numbered(mail, 4, 9))
    assert collect() == [3, 4, 9]


def test_new_in_an_empty_folder(archive, mail, tmp_path):  # noqa: F811
    archive.add_folder("INBOX")
    archive.append(numbered(mail, 1, folder="other"))
    collect = Collector(archive, tmp_path, mode="new")
    assert collect() == []
    archive.append(numbered(mail, 1, 2))
    assert collect() == [1, 2]


def test_modes(archive, mail, tmp_path):  # noqa: F811
    archive.append(numbered(mail, 1))
    with pytest.raises(ValueError, match="bounded read"):
        Collector(archive, tmp_path, mode="current")()
    with pytest.raises(ValueError, match="cannot be combined"):
        Collector(archive, tmp_path, mode="new", offset="3")()
    with pytest.raises(ValueError, match="'x' not found"):
        Collector(archive, tmp_path, folder="x")()


def test_restart_on_a_rebuilt_folder(archive, mail, tmp_path, spark):  # noqa: F811
    archive.append(numbered(mail, 1), folder="INBOX", uidvalidity=1)
    collect = Collector(archive, tmp_path)
    assert collect() == [1]
    rebuilt = type(archive)(spark, str(tmp_path / "rebuilt")).create()
    rebuilt.append(numbered(mail, 1), folder="INBOX", uidvalidity=2)
    collect.archive = rebuilt
    with pytest.raises(ValueError, match="changed from 1 to 2"):
        collect()


def test_windows_over_sent(archive, spark, mail, tmp_path):  # noqa: F811
    """A stream of mail takes part in watermarks and windows like any other."""
    from cases import message

    raws = [message(f"Date: Mon, 6 May 2024 07:{m:02}:00 +0000") for m in (1, 2, 11, 31)]
    archive.append(mail(*raws))
    stream = stream_folder(archive, "sent timestamp", str(tmp_path / "cp"))
    counts = stream.withWatermark("sent", "5 minutes").groupBy(F.window("sent", "10 minutes")).count()
    sink = counts.select(F.col("window.start").alias("start"), "count").writeStream.format("parquet")
    sink = sink.option("checkpointLocation", str(tmp_path / "cp"))
    sink.outputMode("append").trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.start.minute, r["count"]) for r in found) == [(0, 2), (10, 1)]
