"""Exact nearest-vector search: one query, many queries, and query sets of any size.

No pair of rows is ever emitted as such. A task multiplies a block of queries with a block of
the corpus and lets only its k best per query out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrete.functions.vectors import l2_distance, list_matrix, squared_distance
from accrete.operators.feature import BATCH, FeatureDef
from accrete.session import BROADCAST_BYTES, staged

# Queries and corpus rows multiplied at once inside a task.
QUERY_BLOCK = 256
CORPUS_BLOCK = 4096
# Rows of a packed block of the large-by-large search, and parts a cell is cut into at most.
PACKED_ROWS = 1024
MOST_PARTS = 1024
# Corpus blocks a task may have to choose from.
MOST_BLOCKS = 200_000
# Pivots of the large-by-large search: at least, and bytes of them at most.
PIVOTS = 16
PIVOT_BYTES = 16 * 1024 * 1024
# Corpus blocks from which the visits of a query block are dealt to several runs, and runs at most.
VISITS = 64
SLICES = 4
# Groups that the query blocks are put into, to be sent a corpus block once for all of them, and vector bytes
# of the queries of a group at most.
CROWDS = 16
CROWD_BYTES = 64 * 1024 * 1024
# Rows that centres of stored cells are learned on.
CELL_SAMPLE = 20_000
# Tasks whose partial results meet in the first round of a merge.
MERGED = 64


def pick_row(df: DataFrame, position: int, key: str, columns: list[str]):
    """The row at a 0-based position in key order (a sorted prefix, not a scan to the driver)."""
    return df.select(*dict.fromkeys([key, *columns])).orderBy(key).offset(position).limit(1).first()


def nearest(
    corpus: DataFrame, query: list[float], vector: str, key: str, k: int = 5, columns: list[str] | None = None,
    squared: bool = False,
) -> DataFrame:
    """The k rows closest to one query vector, with `_distance` (Euclidean, computed in double)."""
    wanted = F.lit(np.asarray(query, np.float32).astype(float).tolist())
    distance: Column = (squared_distance if squared else l2_distance)(F.col(vector), wanted)
    kept = list(dict.fromkeys([key, *(columns or [])]))
    found = corpus.where(F.col(vector).isNotNull())
    return found.select(*kept, distance.alias("_distance")).orderBy("_distance", key).limit(k)


class BestK:
    """The k closest corpus rows seen so far for each query of a block."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries = queries
        self.norms = np.einsum("ij,ij->i", queries, queries)
        self.k = k
        self.limit = np.full(len(queries), np.inf)
        self.rows = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.gaps = np.empty(0)
        self.fresh = np.empty(0, bool)

    def add(self, vectors: np.ndarray, ids: np.ndarray) -> None:
        rough = self.norms[:, None] - 2.0 * (self.queries @ vectors.T)
        rough += np.einsum("ij,ij->i", vectors, vectors)[None, :]
        if len(ids) > self.k:
            kth = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1]
            limit = np.minimum(self.limit, kth)
        else:
            limit = self.limit
        # The product form can be off in the last digits: keep a margin, then measure the few left.
        margin = 1e-9 * (1.0 + self.norms + np.max(np.abs(rough), axis=1, initial=0.0))
        rows, cols = np.nonzero(rough <= (limit + margin)[:, None])
        gap = self.queries[rows] - vectors[cols]
        self._merge(rows, ids[cols], np.einsum("ij,ij->i", gap, gap))

    def _merge(self, rows: np.ndarray, ids: np.ndarray, gaps: np.ndarray, fresh: bool = True) -> None:
        fresh = np.concatenate([self.fresh, np.full(len(rows), fresh)])
        rows = np.concatenate([self.rows, rows])
        ids = np.concatenate([self.ids, ids])
        gaps = np.concatenate([self.gaps, gaps])
        order = np.lexsort((ids, gaps, rows))
        rows, ids, gaps = rows[order], ids[order], gaps[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        kept = place < self.k
        self.rows, self.ids, self.gaps, self.fresh = rows[kept], ids[kept], gaps[kept], fresh[order][kept]
        full = place[kept] == self.k - 1
        self.limit[self.rows[full]] = self.gaps[full]

    def resume(self, rows: np.ndarray, ids: np.ndarray, gaps: np.ndarray) -> None:
        """Go on from what an earlier run found."""
        self._merge(rows, ids, gaps, fresh=False)

    def changed(self) -> np.ndarray:
        """Which of the rows were not there when the run was resumed."""
        return self.fresh

    def last(self) -> np.ndarray:
        """The id of the k-th row of each query; the greatest there is where there are fewer than k."""
        last = np.full(len(self.queries), np.iinfo(np.int64).max)
        full = np.flatnonzero(np.bincount(self.rows, minlength=len(self.queries)) == self.k)
        ends = np.searchsorted(self.rows, full, side="right") - 1
        last[full] = self.ids[ends]
        return last


def _named(df: DataFrame, key: str, vector: str, names: tuple[str, str]) -> DataFrame:
    return df.where(F.col(vector).isNotNull()).select(
        F.col(key).cast("bigint").alias(names[0]), F.col(vector).alias(names[1])
    )


def _merged(partial: DataFrame, k: int) -> DataFrame:
    """The k best per query of each MERGED tasks or so: a first round of merging, so that no task gets the
    partial bests of all others for a query, however many tasks there are."""
    tasks = F.floor(F.spark_partition_id() / MERGED)
    best = F.row_number().over(Window.partitionBy("query_id", "_tasks").orderBy("gap", "neighbour_id"))
    return partial.withColumn("_tasks", tasks).withColumn("_best", best).where(F.col("_best") <= k).drop("_tasks", "_best")


def _final(partial: DataFrame, k: int, squared: bool) -> DataFrame:
    """Merge partial bests: k per task and query come in, k per query go out."""
    order = Window.partitionBy("query_id").orderBy("gap", "neighbour_id")
    distance = F.col("gap") if squared else F.sqrt("gap")
    return (
        partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "neighbour_id", distance.alias("_distance"))
    )


def nearest_each(
    queries: DataFrame, corpus: DataFrame, query_key: str, query_vector: str, key: str, vector: str, k: int = 5,
    squared: bool = False, limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The k closest corpus rows of every query: (query_id, rank, neighbour_id, _distance).

    Query sets below `limit_bytes` travel to the tasks and the corpus is read once, unshuffled;
    larger ones meet the corpus block by block in `nearest_blocks`. Keys must be integers.
    """
    asked = _named(queries, query_key, query_vector, ("query_id", "query_vec"))
    stored = _named(corpus, key, vector, ("neighbour_id", "vector"))
    count, longest = asked.agg(F.count(F.lit(1)), F.max(F.size("query_vec"))).first()
    if count * ((longest or 0) * 8 + 8) > limit_bytes:
        return nearest_blocks(asked, stored, k, squared)
    table = asked.toArrow()  # below limit_bytes by the check above
    matrix = list_matrix(table.column("query_vec").combine_chunks())
    names = table.column("query_id").to_numpy()
    shipped = corpus.sparkSession.sparkContext.broadcast((names, matrix))

    def run(batches):
        names, matrix = shipped.value
        blocks = [BestK(matrix[i : i + QUERY_BLOCK], k) for i in range(0, len(matrix), QUERY_BLOCK)]
        for batch in batches:
            for at in range(0, batch.num_rows, CORPUS_BLOCK):
                part = batch.slice(at, CORPUS_BLOCK)
                ids = part.column(0).to_numpy()
                vectors = list_matrix(part.column(1))
                for block in blocks:
                    block.add(vectors, ids)
        for i, block in enumerate(blocks):
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[block.rows + i * QUERY_BLOCK]), pa.array(block.ids), pa.array(block.gaps)],
                names=["query_id", "neighbour_id", "gap"],
            )

    return _final(_merged(stored.mapInArrow(run, "query_id bigint, neighbour_id bigint, gap double"), k), k, squared)


def _bytes_type(df: DataFrame, vector: str) -> str:
    return "float32" if df.schema[vector].dataType.simpleString() == "array<float>" else "float64"


def _pack(df: DataFrame, keys: list[str], row_id: str, vector: str, more: dict[str, Column] | None = None) -> DataFrame:
    """One row per block: its ids in ascending order, its vectors as bytes, and `more` aggregates. A block
    holds few rows by construction."""
    width = _bytes_type(df, vector)
    pieces = F.array_sort(F.collect_list(F.struct(F.col(row_id).alias("id"), F.col(vector).alias("v"))))
    packed = df.groupBy(*keys).agg(pieces.alias("rows"), *(c.alias(n) for n, c in (more or {}).items()))
    kept = [c for c in packed.columns if c != "rows"]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packed.select(*kept).schema)

    def run(batches):
        for batch in batches:
            rows = batch.column("rows")
            for i in range(batch.num_rows):
                block = rows[i].values
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [*[one.column(c) for c in kept], pa.array([block.field("id").to_pylist()], pa.list_(pa.int64())),
                     pa.array([list_matrix(block.field("v"), width).tobytes()], pa.binary())],
                    names=[*kept, "ids", "vectors"],
                )

    return packed.mapInArrow(run, f"{columns}, ids array<bigint>, vectors binary")


def _unpacked(packed: pa.Scalar, rows: int, width: str) -> np.ndarray:
    return np.frombuffer(packed.as_buffer(), width).reshape(rows, -1).astype(np.float64)


def _best_of(row: dict, k: int, kind: str) -> BestK:
    """A packed query block, with what an earlier run found for it, if there was one."""
    best = BestK(_unpacked(row["asks"], len(row["asked"]), kind), k)
    if "rows" in row and row["rows"].is_valid:
        best.resume(*(row[c].values.to_numpy() for c in ("rows", "found", "gaps")))
    return best


def _runs(laid: DataFrame, k: int, asks_type: str, vectors_type: str) -> DataFrame:
    """(query_id, neighbour_id, gap) of rows laid out in runs: the query blocks of a crowd in front, the corpus
    blocks that some of them meet after them by rising `floor`; `wants` has those members and the least distance
    each can be at. Each member carries its k best on; what an earlier run had found already is let out by
    slice 0 alone."""

    def take_in(batches):
        now, members = None, {}

        def out():
            for best, names, first in members.values():
                kept = np.ones(len(best.rows), bool) if first else best.changed()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[best.rows[kept]]), pa.array(best.ids[kept]), pa.array(best.gaps[kept])],
                    names=["query_id", "neighbour_id", "gap"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if row["asked"].is_valid:
                    run = row["crowd"].as_py(), row["slice"].as_py()
                    if run != now:
                        yield from out()
                        now, members = run, {}
                    members[row["member"].as_py()] = _best_of(row, k, asks_type), row["asked"].values.to_numpy(), run[1] == 0
                    continue
                wants = row["wants"].values
                ids = row["ids"].values.to_numpy()
                vectors = None
                for member, floor in zip(wants.field("member").to_pylist(), wants.field("floor").to_pylist()):
                    best = members[member][0]
                    if floor <= float(np.sqrt(best.limit.max())) * (1 + 1e-9) + 1e-12:
                        vectors = _unpacked(row["vectors"], len(ids), vectors_type) if vectors is None else vectors
                        best.add(vectors, ids)
        yield from out()

    return laid.mapInArrow(take_in, "query_id bigint, neighbour_id bigint, gap double")


class Pivots:
    """Points that rows are gathered around, in two levels: each fine one belongs to its nearest coarse one,
    and a row is compared with the fine ones around its nearest few coarse ones only."""

    NEAR = 4

    def __init__(self, points: np.ndarray):
        self.points = points
        self.coarse = points[: max(1, round(len(points) ** 0.5))]
        owner = self._rough(points, self.coarse).argmin(axis=1)
        self.members = [np.flatnonzero(owner == c) for c in range(len(self.coarse))]

    @staticmethod
    def _rough(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Squared distances but for a term of each row of a."""
        return np.einsum("ij,ij->i", b, b)[None, :] - 2.0 * (a @ b.T)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance): a close fine pivot of each vector and how far it is, measured exactly."""
        near = np.argsort(self._rough(vectors, self.coarse), axis=1)[:, : self.NEAR]
        cell, least = np.zeros(len(vectors), np.int64), np.full(len(vectors), np.inf)
        for c, members in enumerate(self.members):
            rows = np.flatnonzero((near == c).any(axis=1))
            if not len(rows) or not len(members):
                continue
            gaps = self._rough(vectors[rows], self.points[members])
            best = gaps.argmin(axis=1)
            value = gaps[np.arange(len(rows)), best]
            closer = value < least[rows]
            cell[rows[closer]], least[rows[closer]] = members[best[closer]], value[closer]
        gap = vectors - self.points[cell]
        return cell, np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances to the fine pivots, and how far off their computation may be."""
        own = np.einsum("ij,ij->i", vectors, vectors)[:, None]
        rough = self._rough(vectors, self.points) + own
        return np.sqrt(np.maximum(rough, 0.0)), np.sqrt(1e-9 * (1.0 + own + np.abs(rough)))


def _pivots(stored: DataFrame, k: int) -> Pivots:
    """About as many corpus rows as the square root of their number, or as there are full blocks if that is
    less, below PIVOT_BYTES."""
    rows, width = stored.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    # Not so many that blocks hold few rows: each query block is sent a copy of what it visits.
    near = min(int(rows**0.5), rows // PACKED_ROWS)
    wanted = min(max(near, k, PIVOTS), max(PIVOTS, PIVOT_BYTES // (8 * max(width or 1, 1))))
    drawn = stored.orderBy(F.xxhash64("neighbour_id"), "neighbour_id").limit(wanted).select("vector").distinct()
    return Pivots(list_matrix(drawn.toArrow().column("vector").combine_chunks()))


def _in_cells(df: DataFrame, shipped, row_id: str, vector: str) -> DataFrame:
    """(row_id, vector, cell, reach)."""
    kind = df.schema[vector].dataType.simpleString()

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                cell, reach = shipped.value.nearest(list_matrix(batch.column(vector)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(row_id), batch.column(vector), pa.array(cell.astype(np.int32)), pa.array(reach)],
                    names=[row_id, vector, "cell", "reach"])

    return df.select(row_id, vector).mapInArrow(assign, f"{row_id} bigint, {vector} {kind}, cell int, reach double")


def _in_blocks(placed: DataFrame, row_id: str) -> DataFrame:
    """Add `block`: rows of a cell by ascending id, about PACKED_ROWS in each, more where there would be over
    MOST_BLOCKS. Cells of more rows are cut at quantiles of their ids, and beyond MOST_PARTS by a hash, so that
    a third of all rows in one cell is still many small blocks."""
    sizes = placed.groupBy("cell").count().orderBy("cell").collect()  # a row per pivot
    rows = max(PACKED_ROWS, -(-sum(r["count"] for r in sizes) // MOST_BLOCKS))
    large = [r for r in sizes if r["count"] > rows]
    if not large:
        return placed.withColumn("block", F.lit(0))
    wanted = -(-max(r["count"] for r in large) // rows)
    parts = min(wanted, MOST_PARTS)
    steps = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = (
        placed.where(F.col("cell").isin([r["cell"] for r in large])).groupBy("cell")
        .agg(F.array_distinct(F.percentile_approx(row_id, steps, F.lit(10 * parts))).alias("cuts"))
    )
    cut = placed.join(F.broadcast(cuts) if len(large) * parts * 8 < BROADCAST_BYTES else cuts, "cell", "left")
    part = F.size(F.filter("cuts", lambda c: c < F.col(row_id))) * -(-wanted // parts)
    spread = F.pmod(F.xxhash64(row_id), F.lit(-(-wanted // parts))).cast("int")
    return cut.withColumn("block", F.when(F.col("cuts").isNull(), 0).otherwise(part + spread)).drop("cuts")


def _crowds(begun: DataFrame, pivots: Pivots, width: int) -> DataFrame:
    """`begun` with the crowd of each query block and its number there: about CROWDS groups of blocks around
    neighbouring pivots, so that the copies sent of a corpus block do not grow with the number of queries;
    more groups only where one would hold over CROWD_BYTES of vectors."""
    spark = begun.sparkSession
    place = np.empty(len(pivots.points), np.int64)
    place[np.concatenate(pivots.members)] = np.arange(len(place))
    # One row per query block.
    blocks = begun.select("asking.cell", "asking.block", F.octet_length("asks").alias("size")).toPandas()
    blocks = blocks.iloc[np.lexsort((blocks["block"], place[blocks["cell"]]))]
    most = min(-(-len(blocks) // CROWDS), max(1, CROWD_BYTES // int(blocks["size"].max() * 8 // width or 1)))
    at = np.arange(len(blocks))
    known = spark.createDataFrame(pa.table({
        "cell": pa.array(blocks["cell"].to_numpy(np.int32)), "block": pa.array(blocks["block"].to_numpy(np.int32)),
        "crowd": pa.array((at // most).astype(np.int32)), "member": pa.array((at % most).astype(np.int32))}))
    known = known.select(F.struct("cell", "block").alias("asking"), "crowd", "member")
    return begun.join(F.broadcast(known) if 64 * len(blocks) < BROADCAST_BYTES else known, "asking")


def nearest_blocks(asked: DataFrame, stored: DataFrame, k: int, squared: bool = False) -> DataFrame:
    """k nearest neighbours when neither side fits a task; exact, after the pivot-based kNN join
    of Lu et al. (VLDB 2012).

    Both sides are gathered around about sqrt(n) pivots and packed into blocks. A block of queries first
    meets the first corpus block of its own cell. The k-th gap it has then tells, by the triangle inequality,
    which other blocks can hold anything nearer; only their numbers are listed, and their vectors joined to
    the list, once for each crowd of neighbouring query blocks. One task takes in the blocks that a crowd
    needs, nearest first, carrying the gaps on and leaving out what they rule out by then. So k rows per query
    come out of each of at most SLICES runs, and a corpus block is sent about CROWDS times at most.
    """
    if asked.isEmpty() or stored.isEmpty():
        nothing = asked.sparkSession.createDataFrame([], "query_id bigint, neighbour_id bigint, gap double")
        return _final(nothing, k, squared)
    partial = nearest_partials(asked, stored, k)
    return _final(partial, k, squared)


def nearest_partials(asked: DataFrame, stored: DataFrame, k: int) -> DataFrame:
    """(query_id, neighbour_id, gap): at most SLICES * k rows per query, with its k nearest among them."""
    pivots = _pivots(stored, k)
    shipped = asked.sparkSession.sparkContext.broadcast(pivots)
    placed = staged(_in_cells(stored, shipped, "neighbour_id", "vector"), "placed")
    more = {"least": F.min("reach"), "most": F.max("reach"), "first_id": F.min("neighbour_id")}
    corpus = staged(_pack(_in_blocks(placed, "neighbour_id"), ["cell", "block"], "neighbour_id", "vector", more), "corpus")
    # One row per block: about MOST_BLOCKS and the pivots at most.
    known = corpus.select("cell", "block", "least", "most", "first_id").orderBy("cell", "block").toPandas()
    table = asked.sparkSession.sparkContext.broadcast({c: known[c].to_numpy() for c in known})

    in_cells = staged(_in_cells(asked, shipped, "query_id", "query_vec"), "asked")
    queries = _pack(_in_blocks(in_cells, "query_id"), ["cell", "block"], "query_id", "query_vec").select(
        F.struct("cell", "block").alias("asking"), "cell", F.col("ids").alias("asked"), F.col("vectors").alias("asks"))
    own = corpus.where("block = 0").select("cell", "ids", "vectors")
    asks_type, vectors_type = _bytes_type(asked, "query_vec"), _bytes_type(stored, "vector")

    def seed(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                best = _best_of(row, k, asks_type)
                if row["ids"].is_valid:
                    ids = row["ids"].values.to_numpy()
                    best.add(_unpacked(row["vectors"], len(ids), vectors_type), ids)
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [*[one.column(c) for c in ("asking", "asked", "asks")],
                     *[pa.array([x.tolist()], pa.list_(t)) for x, t in ((best.rows, pa.int64()), (best.ids, pa.int64()), (best.gaps, pa.float64()))]],
                    names=["asking", "asked", "asks", "rows", "found", "gaps"])

    head = "asking struct<cell: int, block: int>"
    begun = staged(
        queries.join(own, "cell", "left").mapInArrow(
            seed, f"{head}, asked array<bigint>, asks binary, rows array<bigint>, found array<bigint>, gaps array<double>"), "begun")

    crowds = _crowds(begun, pivots, np.dtype(asks_type).itemsize)

    def visit(batches):
        pivots, blocks = shipped.value, table.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                best = _best_of(row, k, asks_type)
                limit, last = best.limit.copy(), best.last()
                floor = np.full(len(blocks["cell"]), np.inf)
                for low in range(0, len(best.queries), QUERY_BLOCK):
                    part = slice(low, low + QUERY_BLOCK)
                    gap, off = pivots.distances(best.queries[part])
                    if len(pivots.points) >= k:
                        # Pivots are corpus rows: the k-th nearest of them bounds the k-th neighbour.
                        bound = np.partition(gap + off, k - 1, axis=1)[:, k - 1]
                        limit[part] = np.minimum(limit[part], bound * bound * (1 + 1e-9) + 1e-12)
                    gap, off = gap[:, blocks["cell"]], off[:, blocks["cell"]]
                    lower = np.maximum(np.maximum(gap - off - blocks["most"], blocks["least"] - gap - off), 0.0)
                    needed = lower <= (np.sqrt(limit[part]) * (1 + 1e-9) + 1e-12)[:, None]
                    # Where the k nearest are equal to the query, only smaller ids can come in.
                    needed &= ~((best.limit[part] == 0)[:, None] & (blocks["first_id"][None, :] > last[part][:, None]))
                    floor = np.minimum(floor, np.where(needed, lower, np.inf).min(axis=0))
                asking = row["asking"].as_py()
                floor[(blocks["cell"] == asking["cell"]) & (blocks["block"] == 0)] = np.inf
                order = np.argsort(floor, kind="stable")[: int(np.isfinite(floor).sum())]
                if not len(order):
                    continue
                whose = [pa.array(np.full(len(order), row[c].as_py(), np.int32)) for c in ("crowd", "member")]
                yield pa.RecordBatch.from_arrays(
                    [*whose, pa.array(floor[order]),
                     pa.array(blocks["cell"][order].astype(np.int32)), pa.array(blocks["block"][order].astype(np.int32))],
                    names=["crowd", "member", "floor", "cell", "block"])

    whole = Window.partitionBy("crowd")
    slices = F.least(F.lit(SLICES), F.ceil(F.count(F.lit(1)).over(whole) / VISITS))
    visits = staged(
        crowds.mapInArrow(visit, "crowd int, member int, floor double, cell int, block int").groupBy("crowd", "cell", "block")
        .agg(F.min("floor").alias("floor"), F.collect_list(F.struct("member", "floor")).alias("wants"))
        .withColumn("slice", F.pmod(F.row_number().over(whole.orderBy("floor", "cell", "block")) - 1, slices).cast("int")), "visits")
    brought = visits.join(corpus.select("cell", "block", "ids", "vectors"), ["cell", "block"]).select(
        "crowd", "slice", "floor", "wants", "ids", "vectors")
    # Every run has its query blocks in front; a crowd that visits nothing has one run.
    runs = visits.groupBy("crowd").agg(F.max("slice").alias("slice"))
    fronts = crowds.join(runs, "crowd", "left").select(
        "crowd", F.explode(F.sequence(F.lit(0), F.coalesce("slice", F.lit(0)))).alias("slice"), F.lit(-1.0).alias("floor"),
        "member", "asked", "asks", "rows", "found", "gaps")
    laid = (
        fronts.unionByName(brought, allowMissingColumns=True).repartition("crowd", "slice")
        .sortWithinPartitions("crowd", "slice", "floor")
    )

    return _runs(laid, k, asks_type, vectors_type)


# ---- approximate search on a stored column of cells --------------------------------------------


def learn_cells(df: DataFrame, key: str, vector: str, cells: int, rounds: int = 5, sample: int = CELL_SAMPLE) -> np.ndarray:
    """Centres of `cells` cells: the first rows by digest of the key, moved to the mean of the sampled rows
    nearest to them `rounds` times. The sample is the `sample` rows of smallest digest."""
    known = df.where(F.col(vector).isNotNull()).select(F.md5(F.col(key).cast("string")).alias("d"), F.col(key).alias("k"), F.col(vector).alias("v"))
    drawn = known.orderBy("d", "k").limit(max(sample, cells) if rounds else cells).orderBy("d", "k").select("v").toArrow()
    rows = list_matrix(drawn.column("v").combine_chunks())
    centres = rows[:cells].copy()
    for _ in range(rounds):
        cell = nearest_centres(rows, centres, 1)[:, 0]
        for c in np.unique(cell):
            centres[c] = rows[cell == c].mean(axis=0)
    return centres


def nearest_centres(vectors: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    """The `count` centres closest to each vector, nearest first, the earlier one of two as near."""
    gaps = np.empty((len(vectors), len(centres)))
    for c, centre in enumerate(centres):
        gap = vectors - centre
        gaps[:, c] = np.einsum("ij,ij->i", gap, gap)
    return np.argsort(gaps, axis=1, kind="stable")[:, :count]


def cell_feature(centres: np.ndarray, vector: str, name: str = "cell") -> FeatureDef:
    """A feature column with the cell of each row, null for a null vector; rows appended later get theirs
    by the next backfill, and other centres make a new version of it."""

    def code(batch):
        column = batch.column(vector)
        there = np.flatnonzero(np.asarray(column.is_valid()))
        cells = np.full(batch.num_rows, -1, np.int64)
        if len(there):
            cells[there] = nearest_centres(list_matrix(column.take(pa.array(there))), centres, 1)[:, 0]
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.int32(), mask=cells < 0)], names=[name])

    return FeatureDef(name, "int", (vector,), code, BATCH, 2)


def nearest_in_cells(
    queries: DataFrame, corpus: DataFrame, centres: np.ndarray, query_key: str, query_vector: str, key: str, vector: str,
    cell: str = "cell", k: int = 5, probes: int = 4, squared: bool = False, limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The k closest rows of every query among the rows of its `probes` nearest cells, by their original
    vectors: (query_id, rank, neighbour_id, _distance). `corpus` has the stored column `cell`.

    Rows of other cells are filtered out in the scan. Query sets below `limit_bytes` travel to the tasks;
    larger ones are packed by cell and meet its blocks one after the other.
    """
    asked = _named(queries, query_key, query_vector, ("query_id", "query_vec"))
    stored = corpus.where(F.col(vector).isNotNull() & F.col(cell).isNotNull()).select(
        F.col(key).cast("bigint").alias("neighbour_id"), F.col(vector).alias("vector"), F.col(cell).alias("cell"))
    count, longest = asked.agg(F.count(F.lit(1)), F.max(F.size("query_vec"))).first()
    if count * ((longest or 0) * 8 + 8) > limit_bytes:
        return _final(_cell_runs(asked, stored, centres, k, probes), k, squared)
    table = asked.toArrow()  # below limit_bytes by the check above
    names, matrix = table.column("query_id").to_numpy(), list_matrix(table.column("query_vec").combine_chunks())
    probed = nearest_centres(matrix, centres, probes) if len(names) else np.zeros((0, 1), np.int64)
    asking = {int(c): np.flatnonzero((probed == c).any(axis=1)) for c in np.unique(probed)}
    shipped = corpus.sparkSession.sparkContext.broadcast((names, matrix, asking))

    def run(batches):
        names, matrix, asking = shipped.value
        best: dict[int, list[BestK]] = {}
        for batch in batches:
            cells = batch.column(2).to_numpy()
            order = np.argsort(cells, kind="stable")
            cuts = np.flatnonzero(np.diff(cells[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                own = asking.get(int(cells[rows[0]]))
                if own is None:
                    continue
                blocks = best.setdefault(int(cells[rows[0]]), [
                    BestK(matrix[own[i : i + QUERY_BLOCK]], k) for i in range(0, len(own), QUERY_BLOCK)])
                part = batch.take(pa.array(rows))
                ids, vectors = part.column(0).to_numpy(), list_matrix(part.column(1))
                for block in blocks:
                    block.add(vectors, ids)
        for c, blocks in best.items():
            for i, block in enumerate(blocks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[asking[c][block.rows + i * QUERY_BLOCK]]), pa.array(block.ids), pa.array(block.gaps)],
                    names=["query_id", "neighbour_id", "gap"])

    near = stored.where(F.col("cell").isin([int(c) for c in asking])) if len(asking) < len(centres) else stored
    return _final(_merged(near.mapInArrow(run, "query_id bigint, neighbour_id bigint, gap double"), k), k, squared)


def _cell_runs(asked: DataFrame, stored: DataFrame, centres: np.ndarray, k: int, probes: int) -> DataFrame:
    """(query_id, neighbour_id, gap): k rows per query and probed cell."""
    shipped = asked.sparkSession.sparkContext.broadcast(centres)

    def probe(batches):
        for batch in batches:
            if batch.num_rows:
                cells = nearest_centres(list_matrix(batch.column("query_vec")), shipped.value, probes)
                rows = pa.array(np.repeat(np.arange(len(cells)), cells.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(cells.ravel().astype(np.int32))],
                    names=["query_id", "query_vec", "cell"])

    kind = asked.schema["query_vec"].dataType.simpleString()
    visits = staged(asked.mapInArrow(probe, f"query_id bigint, query_vec {kind}, cell int"), "probes")
    fronts = _pack(_in_blocks(visits, "query_id"), ["cell", "block"], "query_id", "query_vec").select(
        F.struct("cell", "block").alias("asking"), "cell", F.col("ids").alias("asked"), F.col("vectors").alias("asks"))
    fronts = staged(fronts, "fronts")
    corpus = _pack(_in_blocks(staged(stored, "stored"), "neighbour_id"), ["cell", "block"], "neighbour_id", "vector")
    brought = fronts.select("asking", "cell").join(corpus.select("cell", "ids", "vectors"), "cell")
    every = F.array(F.struct(F.lit(0).alias("member"), F.lit(0.0).alias("floor")))
    laid = (
        fronts.drop("cell").withColumn("floor", F.lit(-1.0)).withColumn("member", F.lit(0))
        .unionByName(brought.drop("cell").withColumn("floor", F.lit(0.0)).withColumn("wants", every), allowMissingColumns=True)
        .withColumn("slice", F.lit(0)).withColumnRenamed("asking", "crowd").repartition("crowd").sortWithinPartitions("crowd", "floor")
    )
    return _runs(laid, k, _bytes_type(asked, "query_vec"), _bytes_type(stored, "vector"))


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(wanted, recall): the rows of an exact answer, and the share of them that another answer has, too."""
    keys = ["query_id", "neighbour_id"]
    both = exact.select(*keys).join(found.select(*keys, F.lit(1).alias("hit")), keys, "left")
    return both.agg(F.count(F.lit(1)).alias("wanted"), (F.count("hit") / F.count(F.lit(1))).alias("recall"))
