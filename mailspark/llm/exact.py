"""Exact deduplication of batches against immutable snapshots, screened by static binary-fuse filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from mailspark.llm.common import mix, prepare, stage

#: Keys of one filter, in expectation: a filter is built and asked in one task's memory.
KEYS_PER_BUCKET = 50_000
_SEEDS = 64


def normalised(text: Column) -> Column:
    """A text with every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@dataclass(frozen=True)
class Fuse:
    """A static binary-fuse filter: three places and one byte-sized print per key, about 9 bits a key.

    It holds every key it was built from, and about one in 256 others.
    """

    seed: int
    segment: int
    count: int
    prints: np.ndarray

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys + np.uint64(self.seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        mask = np.uint64(self.segment - 1)
        start = ((h >> np.uint64(32)) * np.uint64(self.count * self.segment)) >> np.uint64(32)
        one = (start + np.uint64(self.segment)) ^ ((h >> np.uint64(18)) & mask)
        two = (start + np.uint64(2 * self.segment)) ^ (h & mask)
        return np.stack([start, one, two]).astype(np.int64), (mix(h) >> np.uint64(56)).astype(np.uint8)

    def __contains__(self, key: int) -> bool:
        return bool(self.holds(np.array([key], np.uint64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which of 64-bit keys may be in the set; never false for one that is."""
        if not len(self.prints):
            return np.zeros(len(keys), bool)
        at, own = self._places(keys)
        return (self.prints[at[0]] ^ self.prints[at[1]] ^ self.prints[at[2]]) == own

    @classmethod
    def build(cls, keys: np.ndarray) -> Fuse:
        """Peel keys that are alone in a place, round by round, and fill places in the opposite order."""
        keys = np.unique(keys)
        n = len(keys)
        if not n:
            return cls(0, 1, 1, np.zeros(0, np.uint8))
        segment = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        count = max(1, -(-int(n * factor) // segment) - 2)
        for seed in range(_SEEDS):
            out = cls(seed, segment, count, np.zeros((count + 2) * segment, np.uint8))
            at, own = out._places(keys)
            held = np.bincount(at.ravel(), minlength=len(out.prints))
            total = np.zeros(len(out.prints), np.int64)  # of the numbers of the keys in each place
            np.add.at(total, at.ravel(), np.tile(np.arange(n), 3))
            front, peeled, done = np.flatnonzero(held == 1), [], 0
            while len(front):
                which, first = np.unique(total[front], return_index=True)
                peeled.append((which, front[first]))
                done += len(which)
                places = at[:, which].ravel()
                np.subtract.at(held, places, 1)
                np.subtract.at(total, places, np.tile(which, 3))
                places = np.unique(places)
                front = places[held[places] == 1]
            if done == n:
                for which, place in reversed(peeled):
                    value = own[which]
                    for k in range(3):
                        value = value ^ np.where(at[k, which] == place, 0, out.prints[at[k, which]]).astype(np.uint8)
                    out.prints[place] = value
                return out
        raise ValueError(f"no filter for {n} keys with any of {_SEEDS} seeds")


@dataclass(frozen=True)
class Snapshot:
    """Digests of one batch (``digest``, ``bucket``, ``h``, ``first``, ``n``) and a filter per bucket; never changed."""

    keys: DataFrame
    filters: DataFrame
    buckets: int


def groups(rows: DataFrame) -> DataFrame:
    """Duplicates within one batch: per digest the smallest id and the number of rows."""
    return rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))


def snapshot(new: DataFrame, others: int = 0, keys_per_bucket: int = KEYS_PER_BUCKET) -> Snapshot:
    """Store the groups of a batch and build their filters, each bucket in a task.

    ``others``: how many digests will be asked for at once, so that their share of a bucket fits in a task too.
    """
    prepare(new.sparkSession)
    new = stage(new.withColumn("h", F.xxhash64("digest")), "digests")
    buckets = max(1, -(-max(new.count(), others) // keys_per_bucket))
    keys = new.withColumn("bucket", F.pmod("h", F.lit(buckets)))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        f = Fuse.build(rows["h"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "seed": [f.seed], "segment": [f.segment],
                             "count": [f.count], "prints": [f.prints.tobytes()]})

    filters = keys.select("bucket", "h").groupBy("bucket").applyInPandas(
        build, "bucket long, seed long, segment long, count long, prints binary"
    )
    return Snapshot(keys, stage(filters, "filters"), buckets)


def screen(batch: DataFrame, snap: Snapshot) -> DataFrame:
    """The groups of a batch with ``maybe``: whether the filter of their bucket holds their digest."""
    batch = batch.withColumn("h", F.xxhash64("digest")).withColumn("bucket", F.pmod("h", F.lit(snap.buckets)))
    columns = [c for c in batch.columns if c not in ("h", "bucket")]

    def ask(rows: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        out = rows[columns].copy()
        out["maybe"] = False
        for s in stored.itertuples():
            f = Fuse(s.seed, s.segment, s.count, np.frombuffer(s.prints, np.uint8))
            out["maybe"] |= f.holds(rows["h"].to_numpy(np.int64).view(np.uint64))
        return out

    types = ", ".join(f"`{c}` {batch.schema[c].dataType.simpleString()}" for c in columns)
    return batch.groupBy("bucket").cogroup(snap.filters.groupBy("bucket")).applyInPandas(ask, f"{types}, maybe boolean")


def deduplicate(
    documents: DataFrame, older: Column, key: str = "doc_id", text: str = "text",
    digest: Callable[[Column], Column] = sha256, keys_per_bucket: int = KEYS_PER_BUCKET,
) -> DataFrame:
    """One row per document: ``key``, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Rows for which ``older`` is true are the stored snapshot, all others the incoming batch. Duplicates within the
    batch are grouped first, so a text of any number of copies is one row from there on. The filters screen those
    rows; the ones they may hold join the snapshot's digests of the same bucket, the others are new. In the end the
    bytes of every duplicate are compared with those of the row that stays; texts of one digest but other bytes form
    groups of their own. A null text is empty. The smallest key stays; a null key only if its group has no other, and
    then every row of the group counts as kept. Rows that repeat a key and its text are listed each, and each of
    them counts as kept if its key does.
    """
    words = normalised(F.col(text))
    rows = documents.select(F.col(key).alias("id"), words.alias("norm"), F.coalesce(older, F.lit(False)).alias("older"))
    marked = rows.select("id", "older", digest(F.col("norm")).alias("digest"), F.xxhash64("norm").alias("check"))
    marked = stage(marked, "documents")
    batch = stage(groups(marked.where(~F.col("older"))), "batch")
    snap = snapshot(groups(marked.where("older")), batch.count(), keys_per_bucket)
    screened = stage(screen(batch, snap), "screened")
    keys = snap.keys.select("digest", F.col("first").alias("old_first"), F.col("n").alias("old_n"))
    hits = screened.where("maybe").join(keys, "digest")
    hits = stage(hits.select("digest", F.least("first", "old_first").alias("first"), (F.col("n") + F.col("old_n")).alias("n")), "hits")
    kept = screened.select("digest", "first", "n").union(keys).join(hits.select("digest"), "digest", "left_anti").union(hits)
    kept = stage(kept.toDF("digest", "first", "n"), "groups")

    twice = kept.where("n > 1").select("digest", "first")
    texts = rows.select("id", "norm", digest(F.col("norm")).alias("digest"))
    stays = texts.withColumnRenamed("digest", "own").join(twice, F.col("id") == F.col("first")).where("own = digest")
    # written, so that the join below stands alone in its stage and Spark can split the rows of a hot digest
    stays = stage(stays.groupBy("digest").agg(F.min("norm").alias("kept_norm")), "stays")
    other = texts.join(stays, "digest").where("norm <> kept_norm").select("id", "digest", "norm")
    other = stage(other, "other")  # of one digest, but other bytes
    apart = other.groupBy("digest", "norm").agg(F.min("id").alias("own_first"), F.count("*").alias("own_n"))
    apart = other.join(apart, ["digest", "norm"]).select(
        F.col("id").alias("own_id"), F.col("digest").alias("own_digest"), F.xxhash64("norm").alias("own_check"), "own_first", "own_n"
    ).distinct()
    fewer = other.groupBy("digest").agg(F.count("*").alias("less"))
    sized = kept.join(fewer, "digest", "left").select("digest", "first", (F.col("n") - F.coalesce("less", F.lit(0))).alias("n"))
    mine = (F.col("digest") == F.col("own_digest")) & (F.col("check") == F.col("own_check")) & F.col("id").eqNullSafe(F.col("own_id"))
    out = marked.select("id", "digest", "check").join(sized, "digest").join(apart, mine, "left")
    first = F.when(F.col("own_n").isNotNull(), F.col("own_first")).otherwise(F.col("first"))
    n = F.coalesce("own_n", "n")
    return out.select(
        F.col("id").alias(key), first.alias("keep_id"), n.alias("group_size"),
        F.col("id").eqNullSafe(first).alias("kept"), "digest",
    )


def keep_first(documents: DataFrame, older: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns; of rows that repeat key and text, one."""
    judged = deduplicate(documents, older, key, text).where("kept").groupBy("digest").agg(
        F.min(key).alias("__id"), F.count("*").alias("__n"))
    judged = judged.withColumnRenamed("digest", "__digest")
    rows = documents.withColumn("__own", sha256(normalised(F.col(text))))
    rows = rows.join(judged, (F.col("__own") == F.col("__digest")) & F.col(key).eqNullSafe(F.col("__id")))
    once = rows.where("__n > 1").dropDuplicates(["__own"])
    return rows.where("__n = 1").union(once).select(*documents.columns)


def older_half(documents: DataFrame, key: str = "doc_id") -> Column:
    """True for the lower half of the range of a numeric key: what a first load would have stored."""
    low, high = documents.agg(F.min(key), F.max(key)).first()
    return F.col(key) <= (low + (high - low) // 2) if low is not None else F.lit(False)
