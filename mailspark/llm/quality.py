"""Quality classifier: hashed word n-gram logistic regression trained by follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailspark.llm.common import fold, mix, prefix_hashes, prepare, slices, span_hashes, stage, sums, utf8

#: Class of each byte: 0 white space and controls, 1 letters, digits and all of multi-byte characters, 2 the rest.
_CLASS = np.full(256, 2, np.uint8)
_CLASS[:33] = 0
for _c in range(256):
    if chr(_c).isalnum() and _c < 128 or _c >= 128:
        _CLASS[_c] = 1

_TWICE = np.uint64(0x5851F42D4C957F2D)


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words and word pairs of every text, and the offsets of the texts among them.

    Words are runs of letters and digits or runs of other visible characters, so ``word!!`` is two words; case counts.
    A word that follows itself is one and the same pair, whatever the word.
    """
    data, offsets = utf8(column)
    kind = _CLASS[data]
    edge = np.ones(len(data), bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(data))
    words = kind[starts] != 0
    starts, ends = starts[words], ends[words]
    hashes = span_hashes(prefix_hashes(data), starts, ends)
    at = np.searchsorted(starts, offsets)  # of each text's first word
    pairs = mix(hashes[:-1] * np.uint64(31) + hashes[1:]) if len(hashes) else hashes
    pairs[hashes[:-1] == hashes[1:]] = _TWICE
    last = np.zeros(len(hashes), bool)
    last[at[1:][at[1:] > at[:-1]] - 1] = True
    slots = np.empty(2 * len(hashes), np.int64)
    slots[0::2] = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    slots[1:-1:2] = (pairs >> np.uint64(64 - bits)).astype(np.int64)
    keep = np.ones(len(slots), bool)
    keep[1::2] = ~last
    counts = np.zeros(len(slots) + 1, np.int64)
    np.cumsum(keep, out=counts[1:])
    return slots[keep], counts[2 * at]


@dataclass(frozen=True)
class Settings:
    """Of the hashing and of the updates; ``max_rows`` bounds the labelled rows that are learned from.

    A shard runs through its rows ``epochs`` times in each of the ``rounds``.
    """

    bits: int = 18
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.1
    l2: float = 0.1
    rounds: int = 2
    epochs: int = 3
    shards: int = 8
    max_rows: int = 8_000


def weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """The weights that follow from the sums of gradients ``z`` and of their squares ``n``."""
    return np.where(np.abs(z) <= s.l1, 0.0, -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def update(z: np.ndarray, n: np.ndarray, slots: np.ndarray, values: np.ndarray, label: float, s: Settings) -> None:
    """One follow-the-regularised-leader step on one row; ``slots`` are distinct."""
    w = weights(z[slots], n[slots], s)
    p = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35)))
    g = (p - label) * values
    before = n[slots]
    z[slots] += g - (np.sqrt(before + g * g) - np.sqrt(before)) / s.alpha * w
    n[slots] += g * g


def vectors(slots: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct slots and their values: count / sqrt(all), and a constant in the last slot + 1."""
    for a, b in zip(offsets[:-1], offsets[1:]):
        found, count = np.unique(slots[a:b], return_counts=True)
        yield np.append(found, 1 << bits), np.append(count / np.sqrt(max(b - a, 1)), 1.0)


def train(
    documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text",
    label: str = "quality",
) -> np.ndarray:
    """Weights of all slots, the constant last.

    Rows without key, label or text are not learned from; of several labels of a key the larger counts. A bounded
    sample (``max_rows``, by a hash of the key) is dealt to ``shards`` tasks. In each round every shard runs through
    its rows from the common state, and Spark averages what the shards add to it. The driver gets two numbers per slot.
    """
    spark = documents.sparkSession
    prepare(spark)
    s = settings
    wanted = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k"))
    wanted = wanted.agg(F.max((F.col(label) > 0).cast("double")).alias("y"))
    texts = documents.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    chosen = wanted.join(texts.select("k").distinct(), "k", "left_semi")
    chosen = chosen.orderBy(F.xxhash64(F.lit("quality"), F.col("k").cast("string")), "k").limit(s.max_rows)
    rows = texts.join(F.broadcast(chosen), "k")  # of max_rows rows

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            slots, offsets = features(batch.column("t"), s.bits)
            found = list(vectors(slots, offsets, s.bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("h"), batch.column("y"), pa.array([f for f, _ in found], pa.list_(pa.int32())),
                 pa.array([v for _, v in found], pa.list_(pa.float32()))], ["h", "y", "slots", "counts"])

    hashed = rows.select(F.xxhash64(F.lit("order"), F.col("k").cast("string"), "t").alias("h"), "y", "t")
    hashed = hashed.mapInArrow(to_slots, "h long, y double, slots array<int>, counts array<float>")
    hashed = stage(hashed.repartition(s.shards, F.pmod("h", F.lit(s.shards))).sortWithinPartitions("h"), "quality")
    hashed = hashed.withColumn("shard", F.pmod("h", F.lit(s.shards)).cast("int"))
    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)
    for _ in range(s.rounds):
        state = spark.sparkContext.broadcast((z, n))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            z0, n0 = state.value
            z, n = z0.copy(), n0.copy()
            rows = list(batches)  # of max_rows / shards rows
            for batch in rows * s.epochs:
                y = batch.column("y").to_numpy()
                slots, values = batch.column("slots"), batch.column("counts")
                at = slots.offsets.to_numpy()
                flat_s, flat_v = slots.values.to_numpy(), values.values.to_numpy().astype(np.float64)
                for i in range(len(y)):
                    update(z, n, flat_s[at[i] : at[i + 1]], flat_v[at[i] : at[i + 1]], y[i], s)
            moved = np.flatnonzero((z != z0) | (n != n0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(moved), pa.array((z - z0)[moved]), pa.array((n - n0)[moved])], ["slot", "z", "n"]
            )

        dealt = hashed.repartition(s.shards, "shard").sortWithinPartitions("shard", "h").select("y", "slots", "counts")
        steps = dealt.mapInArrow(learn, "slot long, z double, n double").groupBy("slot").agg(F.sum("z"), F.sum("n"))
        slot, dz, dn = (c.to_numpy() for c in steps.toArrow().columns)
        z[slot] += dz / s.shards
        n[slot] += dn / s.shards
        state.unpersist()
    return weights(z, n, s)


def score(documents: DataFrame, model: np.ndarray, settings: Settings, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score``, the probability of a good text: a sparse dot product per whole text.

    A null or empty text has no words and gets the score of the constant. Rows are neither dropped nor added.
    """
    spark = documents.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model.astype(np.float32))
    rows = documents.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in slices(batches, "__text"):
            slots, offsets = features(batch.column("__text"), settings.bits)
            dot = sums(w[slots].astype(np.float64), offsets) / np.sqrt(np.maximum(np.diff(offsets), 1)) + w[-1]
            p = 1.0 / (1.0 + np.exp(-np.clip(dot, -35, 35)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(p)], [*keep, "score"])

    return rows.mapInArrow(run, f"{types}, score double")


def classify(documents: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """Learn from labels outside the held-out fold of ``doc_id`` and score every document.

    ``predicted`` is 1 from ``threshold`` on. A null ``doc_id`` is held out.
    """
    settings = Settings()
    held = F.coalesce(fold("doc_id", folds) == 0, F.lit(True))
    model = train(documents.where(~held), labels, settings)
    marked = documents.select("doc_id", held.alias("held_out"), "text")
    scored = score(marked, model, settings, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
