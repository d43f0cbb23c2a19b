"""The largest inner products of a set of queries with all vectors, exact, without comparing what cannot be among them.

Components are integers, so scores have no rounding. Vectors are taken by descending length, in rounds of blocks. Each
query carries its k-th best score so far. A block whose lengths times the query's stay below it is left out with all
that follow. Within a block the leading coordinates in the basis of the largest singular values give a partial sum; that
and the Cauchy-Schwarz bound of the rest decide which vectors are multiplied in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailspark.llm.common import prepare, stage

#: Vectors and queries that meet in one group, on average; a group's blocks are what a task holds.
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 2048
#: Vectors compared at once within a group, by descending length.
CHUNK = 512
#: Share of the squared lengths that the leading coordinates hold.
LEADING = 0.7
#: Lengths of one level differ by less than the eighth root of two.
_LEVELS_AN_OCTAVE = 8
#: Doubles hold integers exactly below this.
_EXACT = float(1 << 53)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
#: What rounding may add to a bound, as a share of the product of both lengths.
_SLACK = 1e-6
_BEST = "row long, other long, id long, score long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as one matrix; shorter rows are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = np.zeros((len(column), width), np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(float) ** 2).sum(axis=1))


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products, exact; clipped to 64 bits where they pass them."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    largest = float(np.abs(queries.astype(float)).max()) * float(np.abs(vectors.astype(float)).max()) * queries.shape[1]
    if largest < _EXACT:
        return (queries.astype(float) @ vectors.T.astype(float)).astype(np.int64)
    whole = queries.astype(object) @ vectors.T.astype(object)
    return np.array([min(max(s, _LEAST), _MOST) for s in whole.ravel()], np.int64).reshape(whole.shape)


def quantised(column: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as a double; null for a vector that has a null or non-finite one."""
    x = F.transform(column, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.when(finite, F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))))


def _prepared(vectors: DataFrame, key: str, column: str, queries: Column, scale: int) -> DataFrame:
    rows = vectors.select(F.col(key).cast("long").alias("id"), quantised(F.col(column), scale).alias("x"), F.coalesce(queries, F.lit(False)).alias("query"))
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    level = F.when(square > 0, F.floor(F.log2(square) * (_LEVELS_AN_OCTAVE / 2))).otherwise(-1).cast("int")
    rows = rows.where("x IS NOT NULL").withColumn("level", level)
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), "id", "x", "level", "query"), "vectors")


def _rotation(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Right singular vectors of all vectors, the largest first, and how many of them lead.

    Each task adds up its products of components; what comes to the driver is a matrix as wide as a vector is long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("x"), width).astype(float)
            total += x.T @ x
        i, j = np.divmod(np.arange(width * width), width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "v"])

    summed = vectors.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    gram = np.zeros((width, width))
    gram[summed.i, summed.j] = summed.v
    values, basis = np.linalg.eigh(gram)
    held = np.cumsum(np.maximum(values[::-1], 0))
    lead = int(np.searchsorted(held, LEADING * held[-1]) + 1) if width else 0
    return basis[:, ::-1].copy(), min(lead, width)


class Best:
    """The k best scores of each query of a group; among equal ones the smaller id, a null id last, then the row."""

    def __init__(self, floor: np.ndarray, k: int):
        self.floor, self.k = floor, k
        self.q, self.score, self.id, self.null, self.other = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool, np.int64))

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray, other: np.ndarray) -> None:
        if not len(q):
            return
        new = (q, score, ids, null, other)
        merged = [np.concatenate(x) for x in zip((self.q, self.score, self.id, self.null, self.other), new)]
        q, score, ids, null, other = merged
        order = np.lexsort((other, ids, null, ~score, q))  # ~ reverses the order of integers without overflow
        q = q[order]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        last = (rank == self.k - 1).nonzero()[0]
        reached = score[order[last]].astype(float)
        reached[score[order[last]] == _LEAST] = -np.inf  # clipped: smaller ones may tie with it
        self.floor[q[last]] = np.maximum(self.floor[q[last]], reached)
        self.q, self.score, self.id, self.null, self.other = (x[order[rank < self.k]] for x in merged)


def _compare(queries: pa.Table, vectors: pa.Table, basis: np.ndarray, lead: int, k: int) -> pa.Table:
    width = len(basis)
    q, p = _matrix(queries["x"], width), _matrix(vectors["x"], width)
    lengths, own = _norms(p), _norms(q)
    order = np.argsort(-lengths, kind="stable")
    p, lengths = p[order], lengths[order]
    row, other, ids = queries["row"].to_numpy(), vectors["row"].to_numpy()[order], vectors["id"].combine_chunks()
    null = ids.is_null().to_numpy(zero_copy_only=False)[order]
    ids = ids.fill_null(0).to_numpy()[order]
    floor = queries["floor"].combine_chunks()
    best = Best(np.where(floor.is_null().to_numpy(zero_copy_only=False), -np.inf, floor.fill_null(0).to_numpy().astype(float)), k)
    head = q.astype(float) @ basis[:, :lead]
    rest = np.sqrt(np.maximum(own**2 - (head**2).sum(axis=1), 0))
    for at in range(0, len(p), CHUNK):
        to = min(at + CHUNK, len(p))
        alive = np.flatnonzero(own * lengths[at] * (1 + _SLACK) >= best.floor)
        if not len(alive):
            break  # the vectors that follow are no longer than these
        of = p[at:to].astype(float) @ basis[:, :lead]
        left = np.sqrt(np.maximum(lengths[at:to] ** 2 - (of**2).sum(axis=1), 0))
        bound = head[alive] @ of.T + rest[alive, None] * left + _SLACK * own[alive, None] * lengths[at:to]
        can = (bound >= best.floor[alive, None]) & (row[alive, None] != other[at:to])
        some, any_of = np.flatnonzero(can.any(axis=1)), np.flatnonzero(can.any(axis=0))
        scores = _products(q[alive[some]], p[at:to][any_of])
        can = can[np.ix_(some, any_of)] & (scores >= best.floor[alive[some], None])
        a, b = can.nonzero()
        best.add(alive[some][a], scores[a, b], ids[at:to][any_of][b], null[at:to][any_of][b], other[at:to][any_of][b])
    return pa.table({"row": row[best.q], "other": best.other, "id": pa.array(best.id, mask=best.null), "score": best.score})


def _round(queries: DataFrame, vectors: DataFrame, parts: int, upto: Column, blocks: tuple[int, int], rotation: tuple, k: int) -> DataFrame:
    """The best of each query among the vectors of some blocks; ``upto`` is the last block a query can gain from."""
    (from_block, to_block), (basis, lead) = blocks, rotation
    spread = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    left = queries.withColumn("part", spread).withColumn("last", F.least(upto, F.lit(to_block - 1)))
    left = left.where(F.col("last") >= from_block)
    again = [F.col(c).alias(c) for c in ("row", "x", "floor", "part")]  # both sides come from one table
    left = left.select(*again, F.explode(F.sequence(F.lit(from_block), F.col("last"))).alias("block"))
    right = vectors.where((F.col("block") >= from_block) & (F.col("block") < to_block))
    right = right.select("row", "id", "x", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("row", "other", "id", "score")})
        return _compare(queries, vectors, basis, lead, k)

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(run, _BEST)


def search(
    vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", column: str = "embedding", scale: int = 256,
    block: tuple[int, int] = (BLOCK_VECTORS, BLOCK_QUERIES),
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the ``k`` largest inner products of each query.

    A vector counts as floor(``scale`` * component), in doubles, clipped to 64 bits; scores are exact integers, clipped
    to 64 bits before they are ranked. Queries are the rows where ``queries`` holds (null: no); candidates all rows but
    the query's own row, so a row that repeats a query's key is a candidate of it and, if it is a query too, has rows of
    its own under the same ``query_id``. Equal scores go to the smaller key, a null key last. Vectors that are null, or
    hold a null or non-finite component, take no part; of vectors of unlike length the shorter is filled with zeros, an
    empty one scores 0. No row: no result. With fewer than ``k`` candidates all are returned.

    Lengths fall into levels (eight an octave, so at most some 600), a level is dealt by a hash into blocks of about
    ``block[0]`` vectors, and blocks are numbered by descending level: equal vectors, however many, spread over blocks.
    Rounds take 1, 4, 16, … blocks; a query goes only to blocks whose longest vector can still reach its k-th score. The
    driver sees one count per level and a square matrix as wide as a vector.
    """
    prepare(vectors.sparkSession)
    rows = _prepared(vectors, key, column, queries, scale)
    shape = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0)), F.coalesce(F.sum(F.col("query").cast("long")), F.lit(0))).first()
    width, asked = shape
    levels = [(r["level"], r["n"]) for r in rows.groupBy("level").agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()]
    firsts, sizes, total = {}, {}, 0
    for level, n in levels:
        firsts[level], sizes[level] = total, -(-n // block[0])
        total += sizes[level]
    lookup = lambda values: F.create_map(*(F.lit(x) for kv in values.items() for x in kv))
    placed = rows
    if levels:
        spread = F.pmod(F.xxhash64("row", F.lit("block")), lookup(sizes)[F.col("level")])
        placed = rows.withColumn("block", (lookup(firsts)[F.col("level")] + spread).cast("int"))
    rotation = _rotation(rows, width) if asked else (np.zeros((0, 0)), 0)
    own = rows.where("query").select("row", F.col("id").alias("query_id"), "x", "level")
    best, begin, step = None, 0, 1
    while begin < total and asked:
        end = min(begin + step, total)
        state = own.withColumn("floor", F.lit(None).cast("long"))
        upto = F.lit(total - 1)
        if best is not None:
            kth = best.where(F.col("rank") == k).select(F.col("row").alias("of"), F.col("score").alias("floor"))
            state = own.join(kth, F.col("row") == F.col("of"), "left").drop("of")
            upto = _last_block(levels, firsts, sizes, total)
        found = _round(state, placed, -(-asked // block[1]), upto, (begin, end), rotation, k)
        both = found if best is None else found.unionByName(best.drop("rank"))
        order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
        best = stage(both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        begin, step = end, step * 4
    if best is None:
        return rows.limit(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score"))
    named = own.select(F.col("row").alias("of"), "query_id")
    return best.join(named, F.col("row") == F.col("of")).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _last_block(levels: list[tuple[int, int]], firsts: dict[int, int], sizes: dict[int, int], total: int) -> Column:
    """The last block in which a vector can reach a query's floor: all that follow are too short for its length."""
    if not levels:
        return F.lit(-1)
    top = lambda level: 2.0 ** ((level + 1) / _LEVELS_AN_OCTAVE) if level >= 0 else 0.0
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    ends = F.array(*(F.struct(F.lit(top(level)).alias("most"), F.lit(firsts[level] + sizes[level] - 1).alias("end")) for level, _ in levels))
    reaching = F.filter(ends, lambda e: e["most"] * length * (1 + _SLACK) >= F.col("floor").cast("double"))
    last = F.coalesce(F.get(F.array_sort(F.transform(reaching, lambda e: -e["end"])), F.lit(0)) * -1, F.lit(-1))
    unbounded = F.col("floor").isNull() | (F.col("floor") <= F.lit(_LEAST))
    return F.when(unbounded, F.lit(total - 1)).otherwise(last)
