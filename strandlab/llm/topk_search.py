"""Exact top-k inner-product search by a Voronoi join.

Vectors are assigned to their nearest pivot. The pivots are rows themselves, so a query's products with them are scores that
its k-th best candidate reaches for sure; and a cell's summary (its rows' largest distance from the pivot and largest
length) bounds the product of any query with any of its vectors. So each query can leave out the cells whose bound stays
below what it has for sure. Queries of near cells form groups of bounded size, and data of near cells blocks of bounded
size (a hot cell is many blocks); a block is copied only to the groups of which some query needs a cell of it. Each pair
of a group and a block is solved on its own, with cells passed over again query by query, and the partial results are
merged by rank.

Products are exact: in doubles where all partial sums are below 2**53, in whole numbers of any size elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column

#: Pivots: the square root of the number of vectors, within these bounds; they and their summaries are what the driver holds.
LEAST_PIVOTS, MOST_PIVOTS = 32, 4096
#: Rows of a data block and queries of a group; both sides of a task.
BLOCK_ROWS = 8192
GROUP_QUERIES = 2048
#: Queries whose products are held at once.
QUERY_STEP = 256
SCALE = 256
_LONG = np.iinfo(np.int64)


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v; rows with a null id or vector, or null or non-finite components, go."""
    v = F.col(f"`{vector_col}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(f"`{id_col}`").isNotNull() & v.isNotNull()).where(~bad)
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """floor(SCALE * x) of each component; missing components count as 0, which adds nothing to an inner product."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False).astype(float))
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows, as 64-bit whole numbers; those beyond them stand at their ends."""
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0**53:
        return np.rint(a @ b.T).astype(np.int64)
    whole = lambda x: np.array([[int(y) for y in row] for row in x], object)
    return np.clip(whole(a) @ whole(b).T, _LONG.min, _LONG.max).astype(np.int64)


class Cells:
    """Pivots (rows, with their ids), and each cell's summary, in an order in which near cells follow one another."""

    def __init__(self, ids: np.ndarray, pivots: np.ndarray):
        left, order = np.ones(len(ids), bool), []
        at = 0
        own = (pivots**2).sum(1)
        for _ in range(len(ids)):
            order.append(at)
            left[at] = False
            if left.any():
                distance = own - 2 * pivots @ pivots[at]
                at = int(np.flatnonzero(left)[np.argmin(distance[left])])
        self.ids, self.pivots = ids[order], pivots[order]
        self.own = (self.pivots**2).sum(1)
        self.radius = self.length = np.zeros(len(ids))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance from its pivot), rounded up so that bounds hold."""
        cell = (self.own[None] - 2 * x @ self.pivots.T).argmin(1) if len(x) else np.zeros(0, int)
        return cell, np.sqrt(((x - self.pivots[cell]) ** 2).sum(1)) * (1 + 1e-9)

    def bounds(self, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query a score that its k-th best candidate reaches, and for each cell one that none of its vectors passes."""
        product = q @ self.pivots.T
        length = np.sqrt((q**2).sum(1))[:, None]
        slack = 1e-9 * length * np.sqrt(self.own)[None] + 1e-6
        high = np.minimum(product + length * self.radius[None], length * self.length[None]) + slack
        known = np.where(self.ids[None] == ids[:, None], -np.inf, product - slack)
        sure = np.partition(known, len(self.ids) - k, axis=1)[:, len(self.ids) - k] if len(self.ids) >= k else np.full(len(q), -np.inf)
        return sure, high


def deal(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first part, number of parts) of each cell, in order: small cells share a part of at most ``size`` rows, larger ones are
    split into parts of about ``size``."""
    first, parts = np.zeros(len(counts), int), np.ones(len(counts), int)
    part, held = 0, 0
    for c, n in enumerate(counts.tolist()):
        if held and held + n > size:
            part, held = part + 1, 0
        first[c], parts[c] = part, max(1, -(-n // size))
        if n > size:
            part, held = part + int(parts[c]), 0
        else:
            held += n
    return first, parts


def solve(left: pa.Table, right: pa.Table, cells: Cells, width: int, k: int) -> pa.Table:
    """The k best rows of a block for each query of a group, where the block may hold any."""
    out: list[list[np.ndarray]] = [[], [], []]
    if left.num_rows and right.num_rows:
        # queries of near cells are solved together
        order = np.argsort(column(left, "q_cell").to_numpy(), kind="stable")
        q_ids, q = column(left, "q_vec_id").to_numpy()[order], matrix(column(left, "q_v"), width)[order]
        ids, cell, x = column(right, "vec_id").to_numpy(), column(right, "cell").to_numpy(), matrix(column(right, "v"), width)
        for i in range(0, len(q), QUERY_STEP):
            some, some_ids = q[i : i + QUERY_STEP], q_ids[i : i + QUERY_STEP]
            sure, high = cells.bounds(some_ids, some, k)
            needed = np.flatnonzero((~(high < sure[:, None])).any(0)[cell])
            if not len(needed):
                continue
            score = products(some, x[needed])
            own = ids[needed][None] == some_ids[:, None]
            least = np.where(own, _LONG.min, score)
            if score.shape[1] > k:
                sure = np.maximum(sure, np.partition(least, score.shape[1] - k, axis=1)[:, score.shape[1] - k].astype(float))
            row, col = np.nonzero(~own & (score >= np.floor(sure)[:, None]))
            score, found = score[row, col], ids[needed][col]
            by = np.lexsort((found, ~score, row))
            row, score, found = row[by], score[by], found[by]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = place < k
            for values, new in zip(out, (some_ids[row[keep]], found[keep], score[keep])):
                values.append(new)
    return pa.table({name: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for name, v in zip(("query_id", "vec_id", "score"), out)})


def _placed(rows: DataFrame, cells, width: int) -> DataFrame:
    """Adds cell, radius and length."""

    def assign(batches):
        for batch in batches:
            x = matrix(batch.column(1), width)
            cell, radius = cells.value.nearest(x)
            yield pa.record_batch([*batch.columns, pa.array(cell, pa.int32()), pa.array(radius), pa.array(np.sqrt((x**2).sum(1)) * (1 + 1e-9))], names=["vec_id", "v", "cell", "radius", "length"])

    return rows.mapInArrow(assign, f"vec_id long, v {rows.schema['v'].dataType.simpleString()}, cell int, radius double, length double")


def _needs(queries: DataFrame, cells, blocks, width: int, k: int) -> DataFrame:
    """(grp, block) of all blocks that hold a cell which some query of the group needs."""
    first, parts = blocks

    def run(batches):
        for batch in batches:
            ids, grp = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            pairs = [np.zeros((0, 2), np.int64)]
            for i in range(0, len(ids), QUERY_STEP):
                sure, high = cells.value.bounds(ids[i : i + QUERY_STEP], matrix(batch.column(1).slice(i, QUERY_STEP), width), k)
                row, cell = np.nonzero(~(high < sure[:, None]))
                pairs.append(np.unique(np.stack([grp[i + row], cell], 1), axis=0))
            pairs = np.unique(np.concatenate(pairs), axis=0)
            n = parts[pairs[:, 1]]
            block = np.repeat(first[pairs[:, 1]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            found = np.unique(np.stack([np.repeat(pairs[:, 0], n), block], 1), axis=0)
            yield pa.record_batch([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64())], names=["grp", "block"])

    return queries.select("vec_id", "v", "grp").mapInArrow(run, "grp long, block long").distinct()


def _dealt(rows: DataFrame, parts: tuple[np.ndarray, np.ndarray], name: str) -> DataFrame:
    """Adds the number of each row's part: its cell's first one and, where that has several, a hash of the row."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(c, int(a), int(b)) for c, (a, b) in enumerate(zip(*parts))], "cell int, _first long, _parts int")  # one row for each pivot
    return rows.join(F.broadcast(table), "cell").withColumn(name, F.col("_first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("_parts"))).drop("_first", "_parts")


def top_k(vectors: DataFrame, *, k: int = 5, query_modulus: int = 50, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows by integer inner product, ties to the smaller id.

    Queries are the rows whose id is divisible by ``query_modulus``. Vectors of different lengths are compared as if the
    shorter went on with zeros. Rows with the query's own id are no candidates. Ids are meant to be unique; equal repeated
    rows are one query, but each counts as a candidate of others. Scores beyond 64 bits stand at their ends. With fewer
    candidates than k all are given; an empty table gives no rows. Only the two named columns are read.
    """
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, id_col, vector_col)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not size.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, size.width)
    pivots = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, size.n**0.5)))
    # a bounded sample, of which copies of one vector are one pivot
    chosen = {tuple(r.v): r.vec_id for r in reversed(rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(2 * pivots).collect())}
    chosen = list(chosen.items())[-pivots:]
    cells = Cells(np.array([i for _, i in chosen], np.int64), matrix(pa.array([list(v) for v, _ in chosen], pa.list_(pa.float64())), width))
    placed = _placed(rows, spark.sparkContext.broadcast(cells), width)
    is_query = F.col("vec_id") % query_modulus == 0
    summary = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("radius"), F.max("length").alias("length"), F.count_if(is_query).alias("queries")).collect()  # a row for each pivot
    counts, queries_in = np.zeros(len(chosen), np.int64), np.zeros(len(chosen), np.int64)
    cells.radius, cells.length = np.full(len(chosen), -np.inf), np.zeros(len(chosen))
    for r in summary:
        counts[r.cell], queries_in[r.cell], cells.radius[r.cell], cells.length[r.cell] = r.n, r.queries, r.radius, r.length
    cells.radius[counts == 0] = 0.0
    shared = spark.sparkContext.broadcast(cells)
    blocks = deal(counts, BLOCK_ROWS)
    queries = _dealt(placed.where(is_query).drop("radius", "length").dropDuplicates(["vec_id", "v"]), deal(queries_in, GROUP_QUERIES), "grp")
    needs = _needs(queries, shared, blocks, width, k)
    left = queries.join(needs, "grp").select(*[F.col(c).alias(f"q_{c}") for c in ("vec_id", "v", "cell", "grp", "block")]).groupBy("q_grp", "q_block")
    right = _dealt(placed.drop("radius", "length"), blocks, "block").join(needs, "block").groupBy("grp", "block")
    partial = left.cogroup(right).applyInArrow(lambda a, b: solve(a, b, shared.value, width, k), "query_id long, vec_id long, score long")
    return _ranked(partial, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    # at most k rows for each query and block come here
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

