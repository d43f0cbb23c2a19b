"""Repeated substrings: blockwise suffix sorting with a difference cover, one bucket of suffixes at a time.

A window is ``length`` bytes that start anywhere in a text. The smallest hash of a short string in a window names the
bucket of its suffix, so equal windows are in one bucket. Consecutive windows of one bucket form a run; a run whose
name occurs nowhere else holds no repeated window and goes no further. For the others the bytes of the run travel to
their bucket, and there the suffixes are sorted: by their first ``period`` bytes, and ties by ranks of cover samples,
which are computed once per bucket. Memory is that of one bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailspark.llm.common import mix, prefix_hashes, prepare, slices, span_hashes, stage, utf8

LENGTH = 400
#: A fifth of a window: ranks of samples reach over four fifths after two doublings, names over the rest.
PERIOD = LENGTH // 5
#: Length of the strings whose smallest hash names the bucket of a window.
SEED = 64
#: Bytes of runs that a bucket holds, in expectation, and runs of one name beyond which its windows go another way.
BUCKET_BYTES, HOT_RUNS = 3 << 20, 4_000
#: Windows of a run that travel as one piece.
PIECE = 2048
SPANS = "array<struct<start:bigint,end:bigint>>"


def difference_cover(period: int) -> np.ndarray:
    """Residues of which two differ by every number modulo ``period``; chosen greedily, each to add most differences."""
    cover, seen = [0], {0}
    while len(seen) < period:
        new = lambda x: {(x - c) % period for c in cover} | {(c - x) % period for c in cover}
        best = max((x for x in range(period) if x not in cover), key=lambda x: (len(new(x) - seen), -x))
        seen |= new(best)
        cover.append(best)
    return np.array(sorted(cover))


COVER = difference_cover(PERIOD)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start on, so many of them."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, first and last window, bucket name and weight of every run of windows.

    The weight is 2 if the name's string stands at two places of the run, else 1: two equal windows of one run need
    two such places.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    n = np.diff(offsets)
    if len(data) < LENGTH or not (n >= LENGTH).any():
        return none
    at = np.arange(len(data) - SEED + 1)
    low = h = span_hashes(prefix_hashes(data), at, at + SEED)
    width, want = 1, LENGTH - SEED + 1
    while 2 * width <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (want - width)], low[want - width :])
    long = np.flatnonzero(n >= LENGTH)
    window = _ragged(offsets[long], n[long] - LENGTH + 1)
    text = np.repeat(long, n[long] - LENGTH + 1)
    name = low[window]
    first = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (text[1:] != text[:-1])))
    last = np.append(first[1:], len(window)) - 1
    size = last - first + want
    places = np.add.reduceat(h[_ragged(window[first], size)] == np.repeat(name[first], size), np.cumsum(size) - size)
    own = text[first]
    return own, window[first] - offsets[own], window[last] - offsets[own], name[first], np.minimum(places, 2)


def names(data: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the ``size``-byte strings at every place: equal for equal strings, in no order of their own.

    Strings are sorted by a hash and then compared byte by byte with their neighbours; where a hash stands for
    different strings, they are sorted as bytes.
    """
    n = len(data) - size + 1
    at = np.arange(n)
    h = span_hashes(prefix_hashes(data), at, at + size)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    words = np.empty(len(data) - 7, np.uint64)
    for r in range(8):
        part = data[r : r + (len(data) - r) // 8 * 8].view(">u8")
        words[r::8] = part[: len(words[r::8])]
    a, b = order[1:][same], order[:-1][same]
    equal = np.ones(len(a), bool)
    for k in [*range(0, size - 8, 8), size - 8]:
        equal &= words[a + k] == words[b + k]
    if not equal.all():
        _, out = np.unique(np.lib.stride_tricks.sliding_window_view(data, size), axis=0, return_inverse=True)
        return out.ravel().astype(np.int64)
    out = np.empty(n, np.int64)
    out[order] = np.append(0, np.cumsum(~same))
    return out


def _number(*keys: np.ndarray) -> np.ndarray:
    """Dense numbers of pairs of numbers under 2^31."""
    _, out = np.unique((keys[0] << 32) | keys[1], return_inverse=True)
    return out.ravel()


def repeated(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which of the windows at ``starts`` equal the one at another of the starts.

    Suffixes are sorted by their first and last ``PERIOD`` bytes. Any two of them reach samples of the cover after the
    same number of bytes, fewer than a period, so ties are sorted by the ranks of the samples there, over the
    ``LENGTH - PERIOD`` bytes that follow.
    """
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    first = names(data, PERIOD)
    key = _number(first[starts], first[starts + LENGTH - PERIOD])
    tied = np.flatnonzero(np.bincount(key)[key] > 1)
    if not len(tied):
        return out
    place = np.full(len(data) + LENGTH, -1, np.int64)  # of each sample among the samples
    places = np.arange(len(first))
    samples = places[np.isin(places % PERIOD, COVER)]
    place[samples] = np.arange(len(samples))
    rank = first[samples]
    for step in (PERIOD, 2 * PERIOD):
        after = place[samples + step]
        rank = _number(rank, np.where(after >= 0, rank[after] + 1, 0))
    key = key[tied]
    for shift in range(PERIOD):
        if shift % 8 == 0:  # a tie is settled when all of it is found repeated
            open_ties = np.bincount(key, ~out[tied], len(first)) > 0
            tied, key = tied[open_ties[key]], key[open_ties[key]]
            at = starts[tied]
            order = np.argsort(at % PERIOD, kind="stable")
            cut = np.searchsorted((at % PERIOD)[order], np.arange(PERIOD + 1))
            if not len(tied):
                break
        meet = np.concatenate([order[cut[r] : cut[r + 1]] for r in (COVER - shift) % PERIOD])
        both = (key[meet] << 32) | rank[place[at[meet] + shift]]
        sort = np.argsort(both)
        same = both[sort[1:]] == both[sort[:-1]]
        out[tied[meet[sort[1:][same]]]] = True
        out[tied[meet[sort[:-1][same]]]] = True
    return out


def _list(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of every text, as arrays."""
    for batch in slices(batches, "t", 512 << 10):
        data, offsets = utf8(batch.column("t"))
        own, a, b, name, weight = runs(data, offsets)
        cut = np.append(0, np.cumsum(np.bincount(own, minlength=batch.num_rows)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("sha"), pa.array(np.diff(offsets)), _list(name.view(np.int64), cut),
             _list(a.astype(np.int32), cut), _list(b.astype(np.int32), cut), _list(weight.astype(np.int32), cut)],
            ["id", "sha", "bytes", "name", "a", "b", "w"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that are not hot, in pieces."""
    for batch in slices(batches, "t", 1 << 20):
        rows = []
        for tid, text, held in zip(*(batch.column(c).to_pylist() for c in ("tid", "t", "runs"))):
            text = text.encode()
            for r in held:
                if r["n"] <= HOT_RUNS:
                    for a in range(r["a"], r["b"] + 1, PIECE):
                        n = min(PIECE, r["b"] + 1 - a)
                        rows.append((r["bucket"], tid, a, n, text[a : a + n - 1 + LENGTH]))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "tid", "a", "n", "bytes"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a hot run as a 128-bit hash."""
    for batch in slices(batches, "t", 1 << 20):
        for tid, text, held in zip(*(batch.column(c).to_pylist() for c in ("tid", "t", "runs"))):
            if at := [np.arange(r["a"], r["b"] + 1) for r in held if r["n"] > HOT_RUNS]:
                at, data = np.concatenate(at), np.frombuffer(text.encode(), np.uint8)
                one = span_hashes(prefix_hashes(data), at, at + LENGTH)
                two = span_hashes(prefix_hashes(mix(data.astype(np.uint64)).astype(np.uint8)), at, at + LENGTH)
                for k in range(0, len(at), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[part]) for x in (one.view(np.int64), two.view(np.int64), np.full(len(at), tid), at.astype(np.int32))],
                        ["h", "g", "tid", "s"])


def _sort(table: pa.Table) -> pa.Table:
    """Repeated windows of one bucket, as stretches of consecutive ones."""
    table = table.combine_chunks()
    tid, a, n = (table.column(c).to_numpy() for c in ("tid", "a", "n"))
    _, once = np.unique(np.stack([tid, a]), axis=1, return_index=True)  # rows repeated in the input count once
    if len(once) < len(tid):
        table = table.take(pa.array(np.sort(once)))
        tid, a, n = (table.column(c).to_numpy() for c in ("tid", "a", "n"))
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    size = n.astype(np.int64)
    begin = np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1)
    flags = repeated(data, _ragged(begin, size))
    row = np.repeat(np.arange(len(size)), size)
    window = _ragged(a.astype(np.int64), size)
    found = np.flatnonzero(flags)
    new = np.append(True, (np.diff(found) != 1) | (row[found[1:]] != row[found[:-1]]))[: len(found)]
    first = found[new]
    last = found[np.append(np.flatnonzero(new)[1:], len(found)) - 1] if len(found) else found
    return pa.table({"tid": pa.array(tid[row[first]]), "a": pa.array(window[first].astype(np.int32)), "b": pa.array(window[last].astype(np.int32))})


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches that repeated windows cover, and what is left of texts without them."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches, "t", 4 << 20):
        spans, kept, digests = [], [], []
        for text, held in zip(batch.column("t").to_pylist(), batch.column("found").to_pylist()):
            text, out, at, cuts = text.encode(), [], 0, []
            for a, b in sorted((r["a"], r["b"] + LENGTH) for r in held):
                if not cuts or a > at:
                    out.append(text[at:a])
                    cuts.append({"start": a})
                at = cuts[-1]["end"] = max(at, b)
            out.append(text[at:])
            left = b"".join(out)
            spans.append(cuts)
            kept.append(left.decode(errors="replace"))
            digests.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("tid"), pa.array(spans, kind), pa.array(kept, pa.string()), pa.array(digests, pa.string())],
            ["tid", "spans", "kept", "kept_sha256"])


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` and ``text`` of every row.

    ``spans`` are the removed stretches, first byte and the byte after the last one, in order; ``text`` is what is left,
    under its old name. A cut may go through a character: the bytes left of it stand as U+FFFD in ``text``, while
    ``kept_sha256`` is of the bytes themselves. Without ``text`` among the columns in use, no whole text is shuffled for it.

    Every byte that a repeated window covers is removed, all places of it alike; windows do not cross texts. Null is an
    empty text. Equal texts have equal results and are looked at once: if there are two and they hold a window, nothing
    of them is left. A name with more than ``HOT_RUNS`` runs does not go to a bucket: its windows are counted by their
    128-bit hashes, summed before and after a shuffle, so that no passage, however common, is one task's work.
    """
    spark = documents.sparkSession
    prepare(spark)
    rows = documents.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("t")).withColumn("sha", F.sha2("t", 256))
    kind = rows.schema["id"].dataType.simpleString()
    lists = "bytes long, name array<long>, a array<int>, b array<int>, w array<int>"
    scanned = stage(rows.mapInArrow(_scan, f"id {kind}, sha string, {lists}"), "scanned")
    texts = scanned.groupBy("sha").agg(
        F.count("*").alias("copies"), F.min("id").alias("one"), *(F.first(c).alias(c) for c in ("bytes", "name", "a", "b", "w"))
    )
    texts = stage(texts.withColumn("tid", F.monotonically_increasing_id()), "texts")
    found = texts.select("tid", F.explode(F.arrays_zip("name", "a", "b", "w")).alias("r")).select("tid", "r.*")
    again = found.groupBy("name").agg(F.sum("w").alias("weight"), F.count("*").alias("n")).where("weight > 1").drop("weight")
    found = stage(found.drop("w").join(again, "name"), "runs")
    size = found.where(F.col("n") <= HOT_RUNS).agg(F.sum(F.col("b") - F.col("a") + LENGTH)).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    bucket = F.pmod(F.xxhash64("name"), F.lit(buckets))
    held = found.groupBy("tid").agg(F.collect_list(F.struct("a", "b", "n", bucket.alias("bucket"))).alias("runs"))
    held = held.join(texts.select("tid", "sha", "one"), "tid")
    held = held.select("tid", "runs", F.col("sha").alias("__sha"), F.col("one").alias("__one"))
    mine = rows.select("id", "sha", "t").where(F.octet_length("t") >= LENGTH)
    mine = mine.join(held, (F.col("sha") == F.col("__sha")) & F.col("id").eqNullSafe(F.col("__one")))
    mine = stage(mine.select("tid", "t", "runs"), "candidates")
    pieces = mine.mapInArrow(_cut, "bucket long, tid long, a int, n int, bytes binary")
    sorted_out = pieces.groupBy("bucket").applyInArrow(_sort, "tid long, a int, b int")
    hot = mine.where(F.exists("runs", lambda r: r["n"] > HOT_RUNS)).mapInArrow(_spread, "h long, g long, tid long, s int").distinct()
    twice = hot.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1")
    hot = hot.join(twice, ["h", "g"]).select("tid", F.col("s").alias("a"), F.col("s").alias("b"))
    stretches = sorted_out.union(hot).groupBy("tid").agg(F.collect_list(F.struct("a", "b")).alias("found"))
    cleaned = stretches.join(mine.select("tid", "t").dropDuplicates(["tid"]), "tid").select("tid", "t", "found")
    cleaned = stage(cleaned.mapInArrow(_remove, f"tid long, spans {SPANS}, kept string, kept_sha256 string"), "cleaned")
    judged = texts.select("tid", "sha", "bytes", "copies").join(cleaned, "tid", "left")
    whole = (F.col("copies") > 1) & (F.col("bytes") >= LENGTH)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("bytes").alias("end")))
    judged = judged.select(
        "sha",
        "bytes",
        F.when(whole, everything).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
    judged = scanned.select("id", "sha").distinct().join(judged, "sha")  # texts move by row, so copies do not meet in one task
    judged = judged.withColumnsRenamed({"id": "__id", "sha": "__sha"})
    out = rows.join(judged, (F.col("sha") == F.col("__sha")) & F.col("id").eqNullSafe(F.col("__id")))
    return out.select(
        F.col("id").alias(key),
        F.col("bytes").alias("n_bytes"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
        "spans",
        F.coalesce("kept", "t").alias(text),
    )
