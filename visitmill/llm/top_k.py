"""Exact top-k by inner product, as tiled matrix products.

Vectors are packed into shards, queries into blocks of the same kind. Each (block, shard) pair is a tile:
one matrix product in integers that floating point holds exactly, and the best k per query of the tile.
Tops are then merged per query as a tree, so that no task sees more than a bounded number of lists of one
query. Tiles are keys of an ordinary equi-join, so neither side passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmill.llm.common import query, table
from visitmill.session import cut_lineage

# Vectors of a shard, queries of a block, lists that one step of the merge takes per query.
SHARD, BLOCK, FAN_IN = 8192, 2048, 64
# Scores that are held at a time within a tile.
CELLS = 2 * 1024 * 1024
EXACT = 1 << 53  # floating point holds all integers up to here


def integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if any is missing or not finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # Components beyond 2^62 are held there, so that each fits a long.
    bound = float(1 << 62)
    held = F.transform(wide, lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-bound)), F.lit(bound))).cast("long"))
    return F.when(vector.isNotNull() & ~bad, held)


def _pack(width: int, key: str) -> Callable:
    """Task function: the vectors of a part as one row of ids (ascending) and one matrix."""
    names = [key, "ids", "matrix", "most"]

    def run(keys: tuple, part: pa.Table) -> pa.Table:
        ids = part.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        lists = part.column("vector").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy(zero_copy_only=False)
        matrix = np.zeros((len(ids), width), np.int64)
        rows = np.repeat(np.arange(len(ids)), sizes)
        columns = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        matrix[rows, columns] = values
        matrix = matrix[order]
        # Magnitude as a Python integer: the least long has no positive counterpart.
        most = max(abs(int(matrix.max(initial=0))), abs(int(matrix.min(initial=0))))
        small = matrix.astype(np.int16) if most < 1 << 15 else matrix
        row = [[keys[0].as_py()], [ids[order].astype("<i8").tobytes()], [small.tobytes()], [most]]
        types = [pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

    return run


def _matrix(raw: bytes, rows: int, width: int, most: int) -> np.ndarray:
    return np.frombuffer(raw, np.int16 if most < 1 << 15 else np.int64).reshape(rows, width)


def best(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, bound: int) -> Iterator[tuple]:
    """(query id, vector id, score) of the ``k`` best of each query row; ids of vectors ascend.

    ``bound`` is at least every absolute score. Vectors of the query's own id are no candidates.
    """
    n = len(ids)
    # As many more as an id has rows here, since a query leaves those of its own out.
    keep = min(n, k + int(np.unique(ids, return_counts=True)[1].max()))
    exact = bound * n + n < EXACT
    right = vectors.astype(np.float64).T if exact else None
    step = max(1, CELLS // max(1, n))
    for at in range(0, len(query_ids), step):
        block, names = queries[at : at + step], query_ids[at : at + step]
        if exact:
            # Score and place in one number, so that no two are equal and ties go to the smaller id.
            cells = (block.astype(np.float64) @ right) * n
            cells -= np.arange(n)
            top = np.argpartition(cells, n - keep, axis=1)[:, n - keep :] if keep < n else np.tile(np.arange(n), (len(names), 1))
            found = np.take_along_axis(cells, top, axis=1)
            order = np.argsort(-found, axis=1)
            top, found = np.take_along_axis(top, order, axis=1), np.take_along_axis(found, order, axis=1)
            scores = np.rint((found + top) / n).astype(np.int64)
            rows = zip(names.tolist(), ids[top].tolist(), scores.tolist())
        else:
            limit = (1 << 63) - 1
            wide = vectors.astype(object)
            rows = []
            for name, row in zip(names.tolist(), block.astype(object)):
                full = [max(-limit, min(limit, int(s))) for s in wide @ row]
                order = sorted(range(n), key=lambda i: (-full[i], i))[:keep]
                rows.append((name, ids[order].tolist(), [full[i] for i in order]))
        for name, others, scores in rows:
            taken = 0
            for other, score in zip(others, scores):
                if other != name and taken < k:
                    taken += 1
                    yield name, other, score


def _tiles(width: int, k: int) -> Callable:
    schema = pa.schema([("query_id", pa.int64()), ("shard", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tile = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                ids, query_ids = np.frombuffer(tile["ids"], "<i8"), np.frombuffer(tile["query_ids"], "<i8")
                vectors = _matrix(tile["matrix"], len(ids), width, tile["most"])
                queries = _matrix(tile["query_matrix"], len(query_ids), width, tile["query_most"])
                bound = tile["most"] * tile["query_most"] * width
                found = list(best(queries, query_ids, vectors, ids, k, bound))
                columns = list(zip(*found)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array([tile["shard"]] * len(found), pa.int64()),
                     pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], schema=schema,
                )

    return run


def _merged(tops: DataFrame, lists: int, k: int) -> DataFrame:
    """Per query the best ``k`` of its lists, merged ``FAN_IN`` lists at a time."""
    by_score = [F.desc("score"), F.asc("vec_id")]
    while lists > FAN_IN:
        lists = -(-lists // FAN_IN)
        tops = tops.withColumn("shard", F.pmod("shard", F.lit(lists)))
        tops = tops.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "shard").orderBy(*by_score)))
        tops = tops.where(F.col("rank") <= k).drop("rank")
    ranked = tops.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*by_score)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    scale: int = 256,
    shard: int = SHARD,
    block: int = BLOCK,
    every_row: bool = False,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best others of each query row, ties to the smaller id.

    Components become floor(``scale`` * x); the score is the integer inner product. Rows whose id or
    vector is null, or whose vector holds a null or a number that is not finite, take no part. Of rows
    that repeat an id, the least vector counts; with ``every_row`` each of them takes part, but for those of the
    query's id, and the rows of a query's id share its ``k`` ranks. Shorter vectors are filled up with zeros. Scores that no
    long holds are held at its bounds. Fewer than ``k`` others: all of them; an empty table: no rows.
    ``is_query`` makes a condition of the id. Other columns are not read.
    """
    named = vectors.select(F.col(id_column).cast("long").alias("id"), integers(F.col(vector_column), scale).alias("vector"))
    usable = named.where(F.col("id").isNotNull() & F.col("vector").isNotNull())
    if every_row:
        # A written number deals the rows, so that those of a hot id are spread as well.
        rows = cut_lineage(usable.withColumn("row", F.monotonically_increasing_id()))
    else:
        rows = cut_lineage(usable.groupBy("id").agg(F.min("vector").alias("vector")).withColumn("row", F.col("id")))
    flagged = rows.withColumn("is_query", F.coalesce(is_query(F.col("id")), F.lit(False)))
    n, queries, width = flagged.agg(F.count("*"), F.count_if("is_query"), F.max(F.size("vector"))).first()
    if not queries or n < 2:
        empty = "query_id long, rank int, vec_id long, score long"
        return vectors.sparkSession.createDataFrame([], empty)
    width = max(1, width)
    shards, blocks = -(-n // shard), -(-queries // block)
    packed = (
        rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_pack(width, "shard"), "shard long, ids binary, matrix binary, most long")
    )
    asked = (
        flagged.where("is_query")
        .withColumn("block", F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(_pack(width, "block"), "block long, ids binary, matrix binary, most long")
        .select("block", F.col("ids").alias("query_ids"), F.col("matrix").alias("query_matrix"), F.col("most").alias("query_most"))
    )
    every = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long")))
    left = packed.withColumn("block", every(blocks))
    right = asked.withColumn("shard", every(shards))
    tiles = left.join(right, ["block", "shard"]).drop("block")
    tops = tiles.mapInArrow(_tiles(width, k), "query_id long, shard long, vec_id long, score long")
    return _merged(tops, shards, k)


@query(
    """
    WITH ok AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM ok q JOIN ok c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op6_top_k(spark, folder):
    """The five best of every query vector among all others."""
    return top_k(table(spark, folder, "embeddings"), lambda i: i % 50 == 0, every_row=True)
