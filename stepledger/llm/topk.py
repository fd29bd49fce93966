"""Exact top-k inner products by distributed histogram selection.

Every task holds a part of the vectors and streams all queries past it, a
block at a time, from the shared folder. In each round it scores its vectors
against every query whose kth score is still open and counts the scores in
the bins of the query's present range. The histograms are summed up by query
and bin; the bin in which the count from above reaches k is the next range.
The kth value is known when this bin holds one score only or ends exactly at
the kth. What exceeds the kth value then is kept, of what equals it as many as
are wanted with the smallest ids, and the rest is a rank.

A task passes on bins from the top until they hold what is still wanted: the
kth score of all vectors is never below that of a part, so no bin that counts
is missing, and histograms stay at k rows for each query and part. Rounds
depend on the size of scores only, plans neither on queries nor on vectors.

Defined results: null vectors and vectors with null or non-finite components
take no part; rows that repeat a vec_id are queries and candidates each; a row
without vec_id is a candidate, of equal scores the last; vectors of another
length than the query's are no candidates for it; a query with fewer than k
candidates gets all of them; scores beyond 64 bits are the nearest 64-bit
number; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepledger.llm._shared import discard, materialise, open_folder

K, EVERY = 5, 50
#: Queries of a block, bits of a round's bins, bytes of the vectors that a task holds, scores held at once.
QUERIES, BIN_BITS, PART_BYTES, SCORES = 256, 14, 128 << 20, 4 << 20
EXACT, LONG, SIGN = 2**53, 2**63, np.uint64(1 << 63)


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(256 * x), as whole doubles."""
    return np.floor(256.0 * values)


def vectors(table: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id and v (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = table.where(F.col("embedding").isNotNull() & good)
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def inner(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whole inner products: floating where these are exact, else Python numbers cut to 64 bits."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(others).max(initial=0)) * max(1, queries.shape[1])
    if most < EXACT:
        return (queries @ others.T).astype(np.int64)
    big = np.array([[int(x) for x in r] for r in queries], dtype=object).reshape(queries.shape) @ np.array([[int(x) for x in r] for r in others], dtype=object).reshape(others.shape).T
    return np.clip(big, -LONG, LONG - 1).astype(np.int64)


class Part:
    """Rows with vectors of one length."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, v: np.ndarray, **more: np.ndarray):
        self.row, self.ids, self.v, self.more = row, ids, v, more


def by_length(batch: pa.RecordBatch) -> Iterator[Part]:
    """The rows of a batch (row, vec_id, v and whatever follows), by the length of their vectors."""
    row, v = batch.column(0).to_numpy(), batch.column(2)
    ids = batch.column(1).fill_null(LONG - 1).to_numpy()
    offsets = v.offsets.to_numpy()
    flat = scaled(v.values.to_numpy())
    length = np.diff(offsets)
    more = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names) if i > 2}
    for n in np.unique(length):
        own = np.flatnonzero(length == n)
        yield Part(row[own], ids[own], flat[offsets[:-1][own][:, None] + np.arange(n)].reshape(len(own), n), **{k: x[own] for k, x in more.items()})


def held_parts(batches, most: int = PART_BYTES) -> Iterator[Part]:
    """What a task gets, in parts of bounded size and vectors of one length each."""
    held: dict[int, list[Part]] = {}
    size = 0

    def close():
        for parts in held.values():
            yield Part(*[np.concatenate([getattr(p, name) for p in parts]) for name in ("row", "ids", "v")])
        held.clear()

    for batch in batches:
        for part in by_length(batch):
            held.setdefault(part.v.shape[1], []).append(part)
            size += part.v.nbytes + 16 * len(part.row)
        if size >= most:
            yield from close()
            size = 0
    yield from close()


def query_blocks(folder: str, length: int, block: int, still: bool = False) -> Iterator[Part]:
    """The written queries with vectors of this length, or only those that are open, some at a time."""
    system, base = open_folder(folder)
    for info in sorted(system.get_file_info(fs.FileSelector(base)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(block):
                    if still:
                        batch = batch.filter(pc.invert(batch.column("done")))
                    yield from (p for p in by_length(batch) if p.v.shape[1] == length)


def scores(queries: Part, part: Part) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(vectors, scores, whether the pair counts) of all queries with some of the vectors at a time."""
    order = np.argsort(part.row)
    step = max(1, SCORES // len(queries.row))
    at = np.minimum(np.searchsorted(part.row, queries.row, sorter=order), len(order) - 1)
    itself = np.where(part.row[order[at]] == queries.row, order[at], -1)
    for a in range(0, len(part.row), step):
        own = slice(a, a + step)
        counts = np.ones((len(queries.row), len(part.row[own])), dtype=bool)
        mine = np.flatnonzero((itself >= a) & (itself < a + step))
        counts[mine, itself[mine] - a] = False
        yield own, inner(queries.v, part.v[own]), counts


def bin_counts(queries: Part, part: Part, shift: int, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, bin, count) of the scores in each query's range, from the top until a query has what it needs."""
    total = np.zeros((len(queries.row), bins), dtype=np.int64)
    low = (queries.more["low"].view(np.uint64) ^ SIGN)[:, None]
    place = (np.arange(len(queries.row)) * bins)[:, None]
    for _, found, counts in scores(queries, part):
        level = found.view(np.uint64) ^ SIGN
        bin_ = (level - low) >> np.uint64(shift)
        inside = counts & (level >= low) & (bin_ < bins)
        total += np.bincount((bin_.astype(np.int64) + place)[inside], minlength=total.size).reshape(total.shape)
    above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total
    q, b = np.nonzero((total > 0) & (above < queries.more["need"][:, None]))
    return q, b, total[q, b]


def narrowed(vecs: DataFrame, state: DataFrame, shift: int, bins: int, block: int) -> DataFrame:
    """The state of all queries after a round over those that are open; bins are 2^shift wide."""
    folder = state._written_to

    def run(batches):
        for part in held_parts(batches):
            for queries in query_blocks(folder, part.v.shape[1], block, True):
                q, b, n = bin_counts(queries, part, shift, bins)
                if len(q):
                    yield pa.RecordBatch.from_arrays([pa.array(queries.row[q]), pa.array(b), pa.array(n)], names=["row", "bin", "n"])

    summed = vecs.select("row", "vec_id", "v").mapInArrow(run, "row long, bin long, n long").groupBy("row", "bin").agg(F.sum("n").alias("n"))
    summed = summed.join(state.select("row", "need"), "row")
    above = Window.partitionBy("row").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    reached = summed.withColumn("cum", F.sum("n").over(above)).where("cum >= need").groupBy("row").agg(F.max_by(F.struct("bin", "n", "cum"), "bin").alias("at"))
    joined = state.join(reached, "row", "left")
    at, open_ = F.col("at"), ~F.col("done")
    low = F.when(open_ & at.isNull(), F.lit(-LONG)).when(open_, (F.col("low").cast("decimal(20,0)") + at["bin"].cast("decimal(5,0)") * F.lit(Decimal(2**shift))).cast("long")).otherwise(F.col("low"))
    need = F.when(open_ & at.isNotNull(), F.col("need") - (at["cum"] - at["n"])).otherwise(F.col("need"))
    done = F.col("done") | at.isNull() | F.lit(shift == 0) | (at["cum"] == F.col("need"))
    out = materialise(joined.select("row", "vec_id", "v", low.alias("low"), need.alias("need"), done.alias("done")), "state")
    discard(state)
    return out


def best_of(queries: Part, part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) of all scores above a query's kth, and of equal ones those with the smallest ids."""
    held = [np.zeros(0, dtype=np.int64)] * 3
    least, need = queries.more["low"], queries.more["need"]
    for own, found, counts in scores(queries, part):
        q, v = np.nonzero(counts & (found >= least[:, None]))
        held = [np.r_[a, b] for a, b in zip(held, (q, v + own.start, found[q, v]), strict=True)]
        # equal ones, by query and id: as many as are wanted
        tied = held[2] == least[held[0]]
        order = np.lexsort((part.row[held[1]], part.ids[held[1]], ~tied, held[0]))
        held = [x[order] for x in held]
        tied = tied[order]
        first = np.flatnonzero(np.r_[True, np.diff(held[0]) > 0]) if len(order) else np.zeros(0, dtype=np.int64)
        place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
        keep = ~tied | (place < need[held[0]])
        held = [x[keep] for x in held]
    return held[0], held[1], held[2]


def search(table: DataFrame, k: int = K, every: int = EVERY, block_queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each query."""
    vecs = materialise(vectors(table), "vectors")
    largest = vecs.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + (F.abs(x) * 256 + 1) * (F.abs(x) * 256 + 1)))).first()[0] or 0.0
    bound = int(min(largest + 1, float(LONG)))
    low, reach = max(-bound, -LONG), min(2 * bound + 1, 2**64)
    bits = (reach - 1).bit_length()
    start = vecs.where(F.col("vec_id") % every == 0).select("*", F.lit(low).cast("long").alias("low"), F.lit(k).cast("long").alias("need"), F.lit(False).alias("done"))
    state = materialise(start, "state")
    while not state.where("NOT done").isEmpty():
        shift = max(0, bits - BIN_BITS)
        state = narrowed(vecs, state, shift, 1 << (bits - shift), block_queries)
        bits = shift
    folder = state._written_to

    def run(batches):
        for part in held_parts(batches):
            for queries in query_blocks(folder, part.v.shape[1], block_queries):
                q, v, found = best_of(queries, part)
                if len(q):
                    ids = part.ids[v]
                    yield pa.RecordBatch.from_arrays([pa.array(queries.row[q]), pa.array(queries.ids[q]), pa.array(part.row[v]), pa.array(ids, mask=ids == LONG - 1), pa.array(found)], names=["row", "query_id", "other", "vec_id", "score"])

    found = vecs.select("row", "vec_id", "v").mapInArrow(run, "row long, query_id long, other long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
WITH rows AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.rid AS other, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.rid <> c.rid AND len(q.v) = len(c.v)
  WHERE q.vec_id % {EVERY} = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id ASC NULLS LAST, other) AS rank FROM scored)
WHERE rank <= {K}
"""
