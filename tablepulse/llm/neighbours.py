"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. A vector gets one more component that brings all of them
to the length of the longest, and a query is scaled to it, so that the nearest by inner
product are the nearest by distance, which p-stable hashes keep: ``K`` projections on
Gaussian directions, each cut into steps of a width, make a bucket; ``tables`` such
hashes are drawn.

A query visits its own bucket of each table and then buckets that differ by one step in
some projections. One list of such changes serves all queries: it is in the order of
the expected squared distance to the changed buckets, over projections ranked by how
near the query lies to the step's edge. Vectors of a visited bucket are compared by
their exact inner product in the task that holds the bucket; the best of each table are
merged.

Every vector is indexed. What is measured on bounded samples is the step width (on
``SAMPLE`` vectors) and the number of visits: ``SAMPLE`` queries are compared with all
vectors, and the first length of the list that finds ``recall`` of their true
neighbours is taken; if the longest is too short, hashes of fewer projections are.
Buckets hold about ``BUCKET`` vectors, so K grows with the logarithm of the table; a
table that fits one bucket is searched in full.

Equal vectors are one class: it is indexed and searched once and stands for its
``k + 1`` smallest ids, which is all that a result can name. Buckets of more than
``BLOCK`` vectors are dealt over several cells; queries go to each of them. There are
less than ``LARGE`` such buckets: in tables beyond ``BLOCK * LARGE`` rows more vectors
make a bucket large. A cell holds about ``CELL`` bytes; a task keeps one cell and a run
of queries. A query travels once for each cell that it visits.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor
do rows without an id and vectors whose length is not the most frequent (of several,
the greatest). Rows of equal id and vector count once; a query meets no row of its own
id. Ties go to the smaller id. Other columns are not read. An empty table, or one
without queries, gives no row.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.session import scratch_dir

from .arrays import bounded_batches, mix

NEAREST = 20
RECALL = 0.94
TABLES = 4
BUCKET = 64
WIDTH = 2.5  # steps, in standard deviations of a projection
VISITS = 2048
SAMPLE = 256
BLOCK = 4096
LARGE = 1 << 20
CELL = 1 << 23
RUN = 512
SEED = 20

_CLASS = ("c1", "c2")


class Hashes(NamedTuple):
    """Projections of all tables, the list of changes, and how many to visit."""

    directions: np.ndarray  # tables, K, dimensions + 1
    offsets: np.ndarray  # tables, K
    width: float
    longest: float  # length of the longest vector
    changes: np.ndarray  # visits, 2 K: which ranked edges are crossed

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0.0))
        return np.column_stack([vectors, rest])

    def scaled(self, queries: np.ndarray) -> np.ndarray:
        long = np.sqrt((queries**2).sum(axis=1, keepdims=True))
        return np.column_stack([queries / long * self.longest, np.zeros(len(queries))])

    def _places(self, points: np.ndarray, table: int) -> np.ndarray:
        return (points @ self.directions[table].T + self.offsets[table]) / self.width

    def buckets(self, points: np.ndarray, table: int) -> np.ndarray:
        return np.floor(self._places(points, table)).astype(np.int64)

    def visited(self, points: np.ndarray, table: int) -> np.ndarray:
        """The buckets that each point visits, in order: points, visits, K."""
        places = self._places(points, table)
        own = np.floor(places)
        k = places.shape[1]
        below = places - own
        edges = np.column_stack([below, 1.0 - below])  # down, then up
        ranked = np.argsort(edges, axis=1, kind="stable")
        steps = np.zeros((len(points), 2 * k, k), np.int64)
        row = np.arange(len(points))[:, None]
        steps[row, np.arange(2 * k)[None, :], ranked % k if k else ranked] = np.where(ranked < k, -1, 1)
        return own.astype(np.int64)[:, None, :] + np.matmul(self.changes, steps)

    def keys(self, buckets: np.ndarray, table: int) -> np.ndarray:
        """One 64-bit name for each bucket."""
        name = np.full(buckets.shape[:-1], table + 1, np.uint64)
        for at in range(buckets.shape[-1]):
            name = mix(name + buckets[..., at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        return name.view(np.int64)


def change_list(k: int, visits: int) -> np.ndarray:
    """The first sets of crossed edges by their expected squared distance.

    Edge j of 2 K ranked ones lies in the mean at a squared distance that depends on j
    alone. Sets grow from {1} by shifting their last edge or by adding the next one, so a
    heap gives them in order. The edges j and 2 K + 1 - j belong to one projection and do
    not go together.
    """
    places = np.arange(1, 2 * k + 1)
    near = places * (places + 1) / (4 * (k + 1) * (k + 2))
    far = 1 - (2 * k + 1 - places) / (k + 1) + (2 * k + 1 - places) * (2 * k + 2 - places) / (
        4 * (k + 1) * (k + 2)
    )
    cost = np.where(places <= k, near, far)
    rows = [np.zeros(2 * k, np.int64)]
    heap = [(cost[0], (0,))] if k else []
    while heap and len(rows) < visits:
        total, edges = heapq.heappop(heap)
        last = edges[-1]
        if not any(2 * k - 1 - edge in edges for edge in edges):
            rows.append(np.isin(np.arange(2 * k), edges).astype(np.int64))
        if last + 1 < 2 * k:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*edges[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*edges, last + 1)))
    return np.array(rows)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _classes(vectors: DataFrame, is_query: Column, k: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """One row a distinct vector with its least ids; and the ids of all queries."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = (
        vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .where("vec_id is not null and embedding is not null")
        .where(sound & F.exists("embedding", lambda x: x != 0))
    )
    sizes = known.groupBy(F.size("embedding").alias("n")).count()
    usual = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    known = known.where(F.size("embedding") == (usual["n"] if usual else 0)).select(
        F.xxhash64("embedding").alias("c1"), F.xxhash64(F.lit(1), "embedding").alias("c2"), "*"
    )
    queries = known.where("is_query").select(*_CLASS, "vec_id").distinct()
    # A class may hold a large share of all rows: each slice of it offers its least ids.
    sliced = Window.partitionBy(*_CLASS, F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    offered = known.withColumn("place", F.row_number().over(sliced)).where(F.col("place") <= k + 1)
    ordered = Window.partitionBy(*_CLASS).orderBy("vec_id")
    least = (
        offered.dropDuplicates([*_CLASS, "vec_id"])
        .withColumn("place", F.row_number().over(ordered))
        .where(F.col("place") <= k + 1)
    )
    classes = least.groupBy(*_CLASS).agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"),
        F.max(F.when(F.col("place") == 1, F.col("embedding"))).alias("embedding"),
    )
    asked = queries.select(*_CLASS).distinct().withColumn("asked", F.lit(True))
    classes = classes.join(asked, list(_CLASS), "left").withColumn("least", F.col("ids")[0])
    return _stored(classes, f"{folder}/classes"), _stored(queries, f"{folder}/queries")


def true_neighbours(classes: DataFrame, sample: np.ndarray, k: int) -> np.ndarray:
    """The vectors nearest to each sampled query, by comparing it with all: queries, k, dimensions."""

    def best(batches):
        top = np.full((len(sample), k), -np.inf)
        found = np.zeros((len(sample), k, sample.shape[1]))
        for batch in batches:
            vectors = _matrix(batch.column(0))
            scores = np.concatenate([top, sample @ vectors.T], axis=1)
            order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            top = np.take_along_axis(scores, order, axis=1)
            old = order < k
            kept = np.take_along_axis(found, np.where(old, order, 0)[:, :, None], axis=1)
            found = np.where(old[:, :, None], kept, vectors[np.where(old, 0, order - k)])
        for at in range(len(sample)):
            real = np.isfinite(top[at])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(real.sum(), at, np.int32)),
                    pa.array(top[at][real]),
                    pa.array(list(found[at][real]), pa.list_(pa.float64())),
                ],
                ["query", "score", "vector"],
            )

    each = classes.select("embedding").mapInArrow(best, "query int, score double, vector array<double>")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    rows = each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    result = np.full((len(sample), k, sample.shape[1]), np.nan)
    for row in rows.collect():  # SAMPLE times k rows
        result[row["query"], row["place"] - 1] = row["vector"]
    return result


def fit_hashes(
    classes: DataFrame, k: int = NEAREST, recall: float = RECALL, tables: int = TABLES
) -> Hashes | None:
    """Hashes whose list of visits reaches the recall on a sample of the queries."""
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, longest = classes.agg(F.count(F.lit(1)), F.sqrt(F.max(norm))).first()
    drawn = (
        classes.where("asked")
        .orderBy(F.xxhash64(F.lit(2), *_CLASS))
        .limit(SAMPLE)
        .select("embedding")
        .toArrow()
    )
    if not drawn.num_rows:
        return None
    sample = np.array(drawn["embedding"].to_pylist(), np.float64)
    drawn = classes.orderBy(F.xxhash64(F.lit(3), *_CLASS)).limit(SAMPLE).select("embedding").toArrow()
    some = np.array(drawn["embedding"].to_pylist(), np.float64)
    near = true_neighbours(classes, sample, k + 1)
    is_other = ~np.isnan(near[:, :, 0]) & (near != sample[:, None, :]).any(axis=2)
    generator = np.random.default_rng(SEED)
    longest *= 1 + 1e-12  # the root above is rounded
    start = max(int(np.ceil(np.log2(max(n, 1) / BUCKET))), 0)
    for number in range(start, -1, -1):
        directions = generator.normal(size=(tables if number else 1, number, sample.shape[1] + 1))
        hashes = Hashes(directions, np.zeros(directions.shape[:2]), 1.0, longest, change_list(number, VISITS))
        spread = [np.std(hashes.lifted(some) @ table.T) for table in directions] if number else [1.0]
        width = max(WIDTH * float(np.mean(spread)), 1e-9 * longest)
        offsets = generator.uniform(0, width, directions.shape[:2])
        hashes = hashes._replace(width=width, offsets=offsets)
        reached = np.sort(_reached(hashes, sample, near)[is_other])
        enough = reached[int(np.ceil(recall * len(reached))) - 1] if len(reached) else 0
        if np.isfinite(enough):
            return hashes._replace(changes=hashes.changes[: int(enough) + 1])
    raise AssertionError("one bucket holds every vector")


def _reached(hashes: Hashes, sample: np.ndarray, near: np.ndarray) -> np.ndarray:
    """After how many visits each true neighbour's bucket comes, in the luckiest table."""
    least = np.full(near.shape[:2], np.inf)
    points = hashes.scaled(sample)
    for at in range(len(sample)):
        lifted = hashes.lifted(np.nan_to_num(near[at]))
        for table in range(len(hashes.directions)):
            visits = hashes.keys(hashes.visited(points[at : at + 1], table)[0], table)
            own = hashes.keys(hashes.buckets(lifted, table), table)
            hit = own[:, None] == visits[None, :]
            place = np.where(hit.any(axis=1), hit.argmax(axis=1), np.inf)
            least[at] = np.minimum(least[at], place)
    return least


def _index(classes: DataFrame, hashes: Hashes) -> DataFrame:
    """A row for each table: its bucket, and the class."""
    shared = classes.sparkSession.sparkContext.broadcast(hashes)

    def bucket(batches):
        known = shared.value
        for batch in batches:
            lifted = known.lifted(_matrix(batch.column(3)))
            for table in range(len(known.directions)):
                keys = known.keys(known.buckets(lifted, table), table)
                tables = pa.array(np.full(len(keys), table, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [tables, pa.array(keys), *batch.columns],
                    ["table", "key", *_CLASS, "least", "embedding"],
                )

    rows = classes.select(*_CLASS, "least", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(
        bucket, "table int, key long, c1 long, c2 long, least long, embedding array<double>"
    )


class Cells(NamedTuple):
    """Where the vectors of a bucket lie: ``count`` cells a table, large buckets in several."""

    count: int
    keys: np.ndarray  # of large buckets, ascending
    blocks: np.ndarray  # in how many cells each of them lies

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every cell of each bucket: places in ``keys``, and cells."""
        own = keys % self.count
        blocks = np.ones(len(keys), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            large = self.keys[at] == keys
            blocks[large] = self.blocks[at[large]]
        place = np.repeat(np.arange(len(keys)), blocks)
        block = np.arange(len(place)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        return place, (own[place] + block) % self.count


def _large_buckets(index: DataFrame, cells: int, rows: int) -> DataFrame:
    """Buckets of more than ``BLOCK`` vectors, or more than the table has for ``LARGE`` buckets.

    So there are less than ``LARGE`` of them. A bucket lies in no more cells than there are.
    """
    most = max(BLOCK, rows // LARGE)
    sizes = index.groupBy(F.col("key").alias("large")).count().where(F.col("count") > most)
    blocks = F.least(F.ceil(F.col("count") / most), F.lit(cells)).cast("long")
    return sizes.select("large", blocks.alias("blocks"))


def _visits(classes: DataFrame, hashes: Hashes, cells: Cells) -> DataFrame:
    """The queries, once for each cell that holds buckets they visit, with these buckets."""
    shared = classes.sparkSession.sparkContext.broadcast((hashes, cells))

    def visit(batches):
        known, where = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                points = known.scaled(_matrix(part.column(2)))
                for table in range(len(known.directions)):
                    keys = known.keys(known.visited(points, table), table)
                    query = np.repeat(np.arange(len(keys)), keys.shape[1])
                    place, cell = where.of(keys.ravel())
                    order = np.lexsort((cell, query[place]))
                    place, cell = place[order], cell[order]
                    query, key = query[place], keys.ravel()[place]
                    new = (np.diff(query, prepend=-1) != 0) | (np.diff(cell, prepend=-1) != 0)
                    first = np.flatnonzero(new)
                    rows = part.take(pa.array(query[first]))
                    bounds = pa.array(np.append(first, len(key)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell[first] + table * where.count),
                            pa.ListArray.from_arrays(bounds, pa.array(key)),
                            *rows.columns,
                        ],
                        ["cell", "keys", *_CLASS, "embedding"],
                    )

    asked = classes.where("asked").select(
        *_CLASS, F.col("embedding").cast("array<double>").alias("embedding")
    )
    return asked.mapInArrow(
        visit, "cell long, keys array<long>, c1 long, c2 long, embedding array<double>"
    )


class _Cell:
    """The vectors of one cell by bucket; queries are compared with the buckets they visit."""

    def __init__(self, k: int):
        self.k, self.parts, self.ready = k, [], False

    def add(self, rows: pa.RecordBatch) -> None:
        self.parts.append(
            (
                rows["key"].to_numpy(),
                np.column_stack([rows[name].to_numpy() for name in (*_CLASS, "least")]),
                _matrix(rows["embedding"]),
            )
        )

    def _build(self) -> None:
        keys, self.names, self.vectors = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        self.names, self.vectors = self.names[order], self.vectors[order]
        self.keys, self.starts = np.unique(keys[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(keys))
        self.ready = True

    def search(self, queries: np.ndarray, visits: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """The best k + 1 for each query: query places, vector places, scores."""
        if not self.parts:
            return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.float64))
        if not self.ready:
            self._build()
        room = self.k + 9  # a few more, for scores that differ by rounding
        top = np.full((len(queries), room), -np.inf)
        who = np.zeros((len(queries), room), np.int64)
        asking = np.repeat(np.arange(len(queries)), [len(keys) for keys in visits])
        wanted = np.concatenate(visits)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        at, asking = at[hit], asking[hit]
        order = np.argsort(at, kind="stable")
        at, asking = at[order], asking[order]
        used, first = np.unique(at, return_index=True)
        for bucket, begin, end in zip(used, first, np.append(first[1:], len(at)), strict=True):
            rows = np.arange(self.starts[bucket], self.ends[bucket])
            mine = asking[begin:end]
            scores = np.concatenate([top[mine], queries[mine] @ self.vectors[rows].T], axis=1)
            found = np.concatenate([who[mine], np.broadcast_to(rows, (len(mine), len(rows)))], axis=1)
            best = np.argpartition(-scores, room - 1, axis=1)[:, :room]
            top[mine] = np.take_along_axis(scores, best, axis=1)
            who[mine] = np.take_along_axis(found, best, axis=1)
        query, column = np.nonzero(np.isfinite(top))
        row = who[query, column]
        # Summed in one order whatever the bucket, so that equal rows score alike.
        exact = (queries[query] * self.vectors[row]).sum(axis=1)
        order = np.lexsort((self.names[row, 2], -exact, query))
        query, row, exact = query[order], row[order], exact[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place <= self.k
        return query[kept], row[kept], exact[kept]


def _search_cells(rows: DataFrame, k: int) -> DataFrame:
    """Rows sorted by cell, vectors before queries, to the best of each query and cell."""

    def search(batches):
        cell, current = None, None
        for batch in batches:
            cells = batch.column(0).to_numpy()
            is_query = batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(cells) != 0) | (np.diff(is_query) != 0)) + 1
            for begin, end in zip([0, *edges], [*edges, len(cells)], strict=True):
                if begin == end:
                    continue
                if cells[begin] != current:
                    current, cell = cells[begin], _Cell(k)
                part = batch.slice(begin, end - begin)
                if not is_query[begin]:
                    cell.add(part)
                    continue
                for at in range(0, part.num_rows, RUN):
                    run = part.slice(at, RUN)
                    visits = [np.array(keys, np.int64) for keys in run["keys"].to_pylist()]
                    query, row, score = cell.search(_matrix(run["embedding"]), visits)
                    if not len(query):
                        continue
                    asked = [run[name].to_numpy()[query] for name in _CLASS]
                    found = [cell.names[row, at] for at in range(3)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (*asked, *found, score)],
                        ["q1", "q2", *_CLASS, "least", "score"],
                    )

    return rows.mapInArrow(search, "q1 long, q2 long, c1 long, c2 long, least long, score double")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = NEAREST,
    recall: float = RECALL,
    tables: int = TABLES,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the k nearest of each query."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    folder = scratch_dir(spark)
    classes, queries = _classes(vectors, is_query, k, folder)
    hashes = fit_hashes(classes, k, recall, tables)
    if hashes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    index = _stored(_index(classes, hashes), f"{folder}/index")
    dimensions = hashes.directions.shape[2] - 1
    rows = index.count()
    dimensions = hashes.directions.shape[2] - 1
    count = max(rows // len(hashes.directions) * dimensions * 8 // CELL, 1)
    large = _stored(_large_buckets(index, count, rows), f"{folder}/large")
    known = large.orderBy("large").toArrow()
    cells = Cells(count, known["large"].to_numpy(), known["blocks"].to_numpy())
    block = F.pmod(F.xxhash64(*_CLASS), F.coalesce("blocks", F.lit(1)))
    own = F.pmod("key", F.lit(count)) + block
    placed = index.join(large, F.col("key") == F.col("large"), "left").select(
        (F.col("table") * F.lit(count) + F.pmod(own, F.lit(count))).cast("long").alias("cell"),
        F.lit(False).alias("is_query"),
        "key",
        *_CLASS,
        "least",
        "embedding",
    )
    asked = _visits(classes, hashes, cells).withColumn("is_query", F.lit(True))
    both = placed.unionByName(asked, allowMissingColumns=True)
    dealt = both.repartition(min(2 * count * len(hashes.directions), 1 << 16), "cell")
    best = _search_cells(dealt.sortWithinPartitions("cell", "is_query"), k)

    once = best.groupBy("q1", "q2", *_CLASS, "least").agg(F.max("score").alias("score"))
    order = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "least")
    top = once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    named = top.join(classes.select(*_CLASS, "ids"), list(_CLASS)).select(
        "q1", "q2", F.explode("ids").alias("vec_id"), (-F.col("score")).alias("away")
    )
    # At most (k + 1) squared rows a query class, of which k + 1 stay.
    listed = named.groupBy("q1", "q2").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("away", "vec_id"))), 1, 2 * k + 2).alias("found")
    )
    per_query = queries.join(
        listed, (F.col("c1") == F.col("q1")) & (F.col("c2") == F.col("q2"))
    ).select(
        F.col("vec_id").alias("query_id"),
        F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("found"),
    )
    return per_query.select("query_id", F.posexplode("found").alias("place", "near")).select(
        F.col("query_id").cast("long").alias("query_id"),
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("near.vec_id").cast("long").alias("vec_id"),
        (-F.col("near.away")).alias("score"),
    )
