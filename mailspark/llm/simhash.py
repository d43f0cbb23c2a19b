"""SimHash near-duplicates: positional bytes of 64-bit fingerprints as an inverted index with count filtering.

Fingerprints that differ in at most 4 bits differ in at most 4 of their 8 bytes, so a linked pair shares at least 4
bytes at the same positions. Postings of single bytes would hold a 256th of the corpus each. The postings here are
keyed by three positions and their bytes: of the 56 triples, 20 suffice for every four shared positions to include
one of them whole. Pairs in a posting are kept if they share at least 4 positional bytes, then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from mailspark.llm.common import prepare, slices, stage
from mailspark.llm.graph import components

SEED = 42
#: Positions 0 to 7 in three classes; a triple within a class, or two of a class and one of the next, meets every four.
_CLASSES = ((0, 1, 2), (3, 4, 5), (6, 7))


def triples() -> list[tuple[int, int, int]]:
    """Position triples of which every set of four positions contains at least one."""
    where = {p: i for i, own in enumerate(_CLASSES) for p in own}
    out = []
    for t in combinations(range(8), 3):
        count = [sum(where[p] == i for p in t) for i in range(3)]
        if 3 in count or any(count[i] == 2 and count[(i + 1) % 3] == 1 for i in range(3)):
            out.append(t)
    return out


def fingerprint(text: str | None, words: int = 4) -> list[int]:
    """Hashes of the shingles of a text, repeats included; of all its words if there are fewer."""
    found = (text or "").encode().lower().split()  # of bytes: A-Z only, and the six ASCII white spaces only
    if len(found) < words:
        return [xxh64_intdigest(b" ".join(found), SEED)] if found else []
    return [xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(found[k:] for k in range(words)))]


def fingerprints(documents: DataFrame, keep: list[str], text: str = "text", words: int = 4) -> DataFrame:
    """The columns ``keep`` with ``__fp``, the 64-bit fingerprint of each whole text as a signed long.

    A null, empty or blank text has fingerprint 0.
    """
    prepare(documents.sparkSession)
    rows = documents.select(*[F.col(c) for c in keep], F.col(text).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", 1 << 20):
            out = np.zeros(batch.num_rows, np.uint64)
            for i, t in enumerate(batch.column("__text")):
                if hashes := fingerprint(t.as_py(), words):
                    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
                    ones = bits.sum(axis=0, dtype=np.int64)
                    out[i] = np.packbits(2 * ones > len(hashes)).view(">u8")[0]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(out.view(np.int64))], [*keep, "__fp"])

    return rows.mapInArrow(run, f"{types}, __fp long")


def shared_bytes(differ: np.ndarray) -> np.ndarray:
    """How many of the 8 bytes are zero in each 64-bit number."""
    x = (differ | (differ >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)
    x = (x | (x >> np.uint64(2))) & np.uint64(0x0303030303030303)
    x = (x | (x >> np.uint64(1))) & np.uint64(0x0101010101010101)
    return 8 - np.bitwise_count(x)


def near(differ: np.ndarray, most: int) -> np.ndarray:
    """Pairs that share the positional bytes that ``most`` differing bits leave, and then differ in no more bits."""
    out = shared_bytes(differ) >= 8 - most
    out[out] = np.bitwise_count(differ[out]) <= most
    return out


def spanning(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the fingerprints of one posting as all its pairs would, at most one per fingerprint.

    Each fingerprint is compared once with those not yet reached, so a posting of near copies costs little.
    """
    left, a, b = fps, [], []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            reached = near(left ^ at, most)
            if reached.any():
                b.append(left[reached])
                a.append(np.full(len(b[-1]), at))
                front.extend(b[-1])
                left = left[~reached]
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def _flips(positions: tuple[int, ...], most: int) -> np.ndarray:
    """Masks of up to most / 2 bits outside the bytes at ``positions``; position 0 is the lowest byte."""
    free = [1 << (8 * p + i) for p in range(8) if p not in positions for i in range(8)]
    masks = [sum(c) for k in range(most // 2 + 1) for c in combinations(free, k)]
    return np.array(masks, np.uint64).view(np.int64)


def links(nodes: DataFrame, most: int = 4, posting: int = 8192) -> DataFrame:
    """``a``, ``b``: links between distinct fingerprints (column ``fp``) that join what pairs within ``most`` bits join.

    Postings are sorted runs in their partition and are read as a stream. A posting longer than ``posting`` takes
    another exact way, so that none has to fit in memory: two of its fingerprints are within ``most`` bits if and only
    if they meet after flipping up to most / 2 bits of each, and the meeting points are groups spread over all tasks.
    """
    if not 0 <= most <= 4 or most % 2:
        raise ValueError("most is 0, 2 or 4: 4 of 8 bytes must be shared, and half the bits flipped on either side")
    spots = triples()
    masks = [sum(0xFF << (8 * p) for p in t) for t in spots]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "v"))
    keyed = keyed.repartition("t", "v").sortWithinPartitions("t", "v", "fp")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, t):
            a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
            t = np.full(len(a), -1, np.int32) if t is None else np.asarray(t, np.int32)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(t)], ["a", "b", "t"])

        held = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        long_run = None  # the key of a posting that is passed on as it comes

        def finish(t, v, fp):
            """Links and passed-on rows of whole postings."""
            nonlocal long_run
            if len(fp) and (t[0], v[0]) == long_run:
                more = int(((t == t[0]) & (v == v[0])).sum())
                yield out(fp[:more], fp[:more], t[:more])
                t, v, fp = t[more:], v[more:], fp[more:]
            if not len(fp):
                return
            first = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (v[1:] != v[:-1])))
            size = np.diff(np.append(first, len(fp)))
            a, b = [], []
            pairs = first[size == 2]
            pairs = pairs[near((fp[pairs] ^ fp[pairs + 1]).view(np.uint64), most)]
            a.append(fp[pairs])
            b.append(fp[pairs + 1])
            for at, n in zip(first[size > 2], size[size > 2]):
                if n > posting:
                    yield out(fp[at : at + n], fp[at : at + n], t[at : at + n])
                else:
                    x, y = spanning(fp[at : at + n].view(np.uint64), most)
                    a.append(x.view(np.int64))
                    b.append(y.view(np.int64))
            yield out(np.concatenate(a), np.concatenate(b), None)

        for batch in batches:
            got = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("t", "v", "fp"))]
            t, v, fp = got
            if not len(fp):
                continue
            last = (t == t[-1]) & (v == v[-1])
            at = int(np.argmax(last))
            if len(fp) - at > posting or (t[-1], v[-1]) == long_run:  # pass the open posting on
                yield from finish(t[:at], v[:at], fp[:at])
                long_run = (t[-1], v[-1])
                yield out(fp[at:], fp[at:], t[at:])
                held = tuple(x[:0] for x in got)
            else:
                yield from finish(t[:at], v[:at], fp[:at])
                held = tuple(x[at:] for x in got)
        yield from finish(*held)

    found = stage(keyed.select("t", "v", "fp").mapInArrow(scan, "a long, b long, t int"), "links")
    flips = [_flips(t, most) for t in spots]

    def flip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, fp in zip(batch.column("t").to_numpy(), batch.column("a").to_numpy()):
                n = len(flips[t])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, t, np.int32)), pa.array(flips[t] ^ fp), pa.array(np.full(n, fp))], ["t", "v", "a"]
                )

    meet = found.where("t >= 0").mapInArrow(flip, "t int, v long, a long")
    meet = meet.select("a", F.min("a").over(Window.partitionBy("t", "v")).alias("b")).where("a <> b")
    return found.where("t < 0").select("a", "b").union(meet)


def group(documents: DataFrame, keep: list[str], key: str = "doc_id", most: int = 4) -> DataFrame:
    """The columns ``keep`` (with ``key``) and ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest ``key`` of the texts linked directly or through others, itself included. Equal
    fingerprints are one node, so copies are neither compared nor listed. Rows with a null key count as linked texts,
    but give no ``component_id``; it is null if the whole component has none.
    """
    marked = stage(fingerprints(documents, list(dict.fromkeys([*keep, key]))), "fingerprints")
    nodes = stage(marked.groupBy(F.col("__fp").alias("fp")).agg(F.min(key).alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), most))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(placed.join(least, "root").select(F.col("fp").alias("__of"), "component_id"), "named")
    out = marked.join(named, F.col("__fp") == F.col("__of"))
    return out.select(*keep, F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"), "component_id")
