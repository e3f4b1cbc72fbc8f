"""Largest inner products by low-dimensional stable projections, a kd-tree and a chi-square stopping test.

Inner products become distances: vectors are scaled by the largest norm and given one
more coordinate that makes them unit, queries are scaled to unit with that coordinate 0;
then distance**2 = 2 - 2 * inner product. Normal (2-stable) projections to DIMS numbers
make projected distance**2 / distance**2 chi-square with DIMS degrees of freedom.

* The upper levels of a kd-tree over projections are fitted on about SAMPLE distinct
  vectors at most, drawn by their digests. Every vector is put into a cell; a cell of
  more than CELL_ROWS is dealt into parts, all of which are searched, so that memory is
  bounded at any size. Each part gets the lower levels, down to leaves of LEAF vectors.
* A query takes leaves in order of projected distance and verifies, on whole vectors,
  the projected neighbours within its stopping radius. It stops when the next leaf is so
  far that a vector nearer than the k-th found would lie there with a probability of less
  than 1 - CONFIDENCE. There is no other stop: no cap on candidates.
* First its own cell, which gives a k-th distance; then each cell whose box is within the
  stopping radius. Queries come to the cells in blocks, as rows of a shuffle; a cell that
  many queries come to is copied for each ASK_ROWS of them.

So a true neighbour is missed with a probability of at most 1 - CONFIDENCE; the order of
what is found is exact, on products of the original vectors summed in double precision
from the first component to the last.

Equal vectors are searched once; of each, the k + 1 smallest ids can be in a result, and
each query with that vector gets its own row. Vectors that are NULL, empty, zero or hold
NULL or non-finite components, and NULL ids, take no part. Only vectors of the query's
length are its candidates. A repeated row (id and vector) counts once; rows with the
query's own id are never its candidates. Fewer candidates than k are all returned. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstmile.llm import store

K, DIMS, CONFIDENCE, SEED = 20, 8, 0.98, 20240601
#: Distinct vectors that fit the upper levels, and the most cells.
SAMPLE, MOST_CELLS = 8192, 1024
#: Vectors of a cell's part, queries that meet one copy of it, vectors of a leaf, queries searched at once.
CELL_ROWS, ASK_ROWS, LEAF, TOGETHER = 16384, 2048, 256, 256


def chi_square(x: float, dims: int) -> float:
    """Distribution function of chi-square for an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for i in range(dims // 2):
        total, term = total + term, term * x / 2 / (i + 1)
    return 1 - math.exp(-x / 2) * total


def radius(dims: int, confidence: float) -> float:
    """The ratio of projected to true distance**2 at which the stopping test holds."""
    low, high = 0.0, 1e4
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < confidence else (low, mid)
    return high


class Space:
    """Scale, projections and upper kd-tree for vectors of one length. Its size is bounded by DIMS and MOST_CELLS."""

    def __init__(self, length: int, largest: float, sample: np.ndarray, levels: int, dims: int, seed: int):
        self.length, self.largest, self.levels = length, largest, levels
        self.matrix = np.random.default_rng([seed, length]).standard_normal((length + 1, dims))
        self.axis, self.cut = np.zeros(2**levels, np.int64), np.zeros(2**levels)
        held = {1: self.project(self.unit(sample))} if len(sample) else {}
        for node in range(1, 2**levels):
            points = held.pop(node, np.zeros((0, dims)))
            if len(points):
                self.axis[node] = int(np.argmax(np.ptp(points, axis=0)))
                self.cut[node] = float(np.median(points[:, self.axis[node]]))
                left = points[:, self.axis[node]] <= self.cut[node]
                held[2 * node], held[2 * node + 1] = points[left], points[~left]

    def unit(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.largest
        rest = np.sqrt(np.maximum(0, 1 - np.square(scaled).sum(1, keepdims=True)))
        return np.hstack([scaled, rest])

    @staticmethod
    def unit_query(vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / np.abs(vectors).max(1, keepdims=True)
        scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
        return np.hstack([scaled, np.zeros((len(vectors), 1))])

    def project(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.matrix

    def cells(self, projected: np.ndarray) -> np.ndarray:
        node = np.ones(len(projected), np.int64)
        for _ in range(self.levels):
            node = 2 * node + (projected[np.arange(len(node)), self.axis[node]] > self.cut[node])
        return node - 2**self.levels


def _norm(vectors: np.ndarray) -> np.ndarray:
    """Lengths that do not overflow on the way."""
    largest = np.abs(vectors).max(1)
    return largest * np.linalg.norm(vectors / largest[:, None], axis=1)


def vectors(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, key (digest), length, norm and vec (doubles as bytes) of each row that takes part."""
    held = embeddings.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vec")
    ).where("id IS NOT NULL AND size(vec) > 0")

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            lists = batch.column(1)
            starts = np.asarray(lists.offsets)
            flat = lists.values.to_numpy(zero_copy_only=False)  # NULL becomes NaN
            ids, good = batch.column(0).to_numpy(), []
            for i in range(batch.num_rows):
                v = flat[starts[i] : starts[i + 1]] + 0.0  # -0.0 is 0.0
                if np.isfinite(v).all() and v.any():
                    good.append((ids[i], v))
            if good:
                raw = [v.astype("<f8").tobytes() for _, v in good]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in good], pa.int64()),
                        pa.array([hashlib.blake2b(r, digest_size=16).digest() for r in raw], pa.binary()),
                        pa.array([len(v) for _, v in good], pa.int32()),
                        pa.array([float(_norm(v[None])[0]) for _, v in good], pa.float64()),
                        pa.array(raw, pa.binary()),
                    ],
                    names=["id", "key", "length", "norm", "vec"],
                )

    return held.mapInArrow(batches, "id long, key binary, length int, norm double, vec binary")


def _matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def _spaces(distinct: DataFrame, dims: int, cell_rows: int, seed: int) -> dict[int, Space]:
    """One space a vector length, from its count and largest norm and a bounded sample."""
    sizes = distinct.groupBy("length").agg(F.count("*").alias("n"), F.max("norm").alias("largest")).collect()
    sample: dict[int, list[bytes]] = {}
    # The digest is uniform, so the rows below a bound are a sample without a seed, of SAMPLE
    # rows give or take its square root. With long vectors it holds fewer.
    longest, rows = max([r["length"] for r in sizes], default=1), sum(r["n"] for r in sizes)
    share = min(1.0, max(64, min(SAMPLE, (1 << 22) // longest)) / max(1, rows))
    drawn = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long") < int(share * 2**32)
    for row in distinct.where(drawn).select("length", "vec").collect():
        sample.setdefault(row["length"], []).append(bytes(row["vec"]))
    found = {}
    for row in sizes:
        held = sample.get(row["length"], [])
        # Sixteen cells where there are vectors enough: work for as many tasks.
        wanted = min(MOST_CELLS, max(16, 2 * row["n"] // cell_rows), len(held) // 16, row["n"] // LEAF)
        levels = max(0, int(math.log2(wanted))) if wanted > 1 else 0
        points = _matrix(held) if held else np.zeros((0, row["length"]))
        found[row["length"]] = Space(row["length"], row["largest"], points, levels, dims, seed)
    return found


def _placed(distinct: DataFrame, spaces: dict[int, Space], dims: int) -> DataFrame:
    """Distinct vectors with their cell and projection."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            lengths = np.asarray(batch.column(1))
            cells, projected = np.zeros(batch.num_rows, np.int32), np.zeros((batch.num_rows, dims))
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                space = spaces[int(length)]
                made = space.project(space.unit(_matrix(batch.column(2).take(pa.array(rows)).to_pylist())))
                projected[rows], cells[rows] = made, space.cells(made)
            ends = pa.array(np.arange(0, (batch.num_rows + 1) * dims, dims), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.ListArray.from_arrays(ends, pa.array(projected.ravel()))],
                names=[*batch.schema.names, "cell", "at"],
            )

    schema = "key binary, length int, vec binary, ids array<long>, cell int, at array<double>"
    return distinct.select("key", "length", "vec", "ids").mapInArrow(batches, schema)


class Part:
    """The lower kd-tree of a cell's part: leaves of at most LEAF vectors and their boxes."""

    def __init__(self, space: Space, raw: list[bytes], ids: list, keep: int, ratio: float):
        self.original, self.ids, self.keep, self.ratio = _matrix(raw), ids, keep, ratio
        self.unit = space.unit(self.original)
        self.at = space.project(self.unit)
        self.leaves, open_ = [], [np.arange(len(raw))]
        while open_:
            rows = open_.pop()
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                continue
            axis = int(np.argmax(np.ptp(self.at[rows], axis=0)))
            order = rows[np.argsort(self.at[rows, axis], kind="stable")]
            open_ += [order[len(order) // 2 :], order[: len(order) // 2]]
        self.low = np.array([self.at[rows].min(0) for rows in self.leaves])
        self.high = np.array([self.at[rows].max(0) for rows in self.leaves])

    def search(self, queries: np.ndarray, floor: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
        """The rows and products of the best in this part for each query. floor: the k-th product that is known."""
        unit = space.unit_query(queries)
        at = space.project(unit)
        outside = np.maximum(0, np.maximum(self.low[None] - at[:, None], at[:, None] - self.high[None]))
        near = np.square(outside).sum(2)
        order = np.argsort(near, axis=1, kind="stable")
        best = np.full((len(queries), self.keep), -np.inf)
        rows = np.full((len(queries), self.keep), -1)
        reach = np.maximum(0, 2 - 2 * floor) * self.ratio
        for step in range(len(self.leaves)):
            leaf = order[:, step]
            # The stopping test. Leaves come nearest first and the reach only shrinks: who stops, stays.
            open_ = np.flatnonzero(near[np.arange(len(leaf)), leaf] <= reach)
            if not len(open_):
                break
            by_leaf = open_[np.argsort(leaf[open_], kind="stable")]
            for who in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
                points = self.leaves[leaf[who[0]]]
                far = np.square(at[who]).sum(1)[:, None] + np.square(self.at[points]).sum(1)[None] - 2 * at[who] @ self.at[points].T
                score = np.where(far <= reach[who][:, None], unit[who] @ self.unit[points].T, -np.inf)
                both = np.hstack([best[who], score])
                named = np.hstack([rows[who], np.broadcast_to(points, score.shape)])
                top = np.argpartition(-both, self.keep - 1, axis=1)[:, : self.keep]
                best[who], rows[who] = np.take_along_axis(both, top, 1), np.take_along_axis(named, top, 1)
            reach = np.maximum(0, 2 - 2 * np.maximum(floor, best.min(1))) * self.ratio
        # A little below the known k-th: rounding must not lose a tie.
        rows[(best < floor[:, None] - 1e-9) | ~np.isfinite(best)] = -1
        return rows, best


def _visit(points: DataFrame, asked: DataFrame, spaces: dict[int, Space], keep: int, ratio: float, cell_rows: int) -> DataFrame:
    """(key of the query, ids, product as scaled, product) of what each query finds in the cell of its row.

    asked: key, length, vec, cell, floor. Parts and copies of a cell follow from counted rows.
    """
    spark = points.sparkSession
    at = ["length", "cell"]
    sizes = points.groupBy(*at).agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("parts"))
    asks = asked.groupBy(*at).agg(F.ceil(F.count("*") / ASK_ROWS).cast("int").alias("copies"))
    dealt = F.broadcast(sizes.join(asks, at))  # a row a cell: at most MOST_CELLS a length
    here = points.join(dealt, at).select(
        *at, F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        F.lit(0).alias("kind"), "key", "vec", "ids", F.lit(None).cast("double").alias("floor"),
    )
    come = asked.join(dealt, at).select(
        *at, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("key"), "copies").cast("int").alias("copy"),
        F.lit(1).alias("kind"), "key", "vec", F.lit(None).cast("array<long>").alias("ids"), "floor",
    )
    group = [*at, "part", "copy"]
    met = here.union(come).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *group).sortWithinPartitions(*group, "kind", "key")

    def found(part: Part, space: Space, queries: pa.RecordBatch) -> pa.RecordBatch:
        originals = _matrix(queries.column(6).to_pylist())
        floor = np.nan_to_num(queries.column(8).to_numpy(zero_copy_only=False).astype(float), nan=-np.inf)
        rows, best = part.search(originals, floor, space)
        who, column = np.nonzero(rows >= 0)
        which = rows[who, column]
        # Summed from the first component to the last, whatever the batch: equal vectors tie exactly.
        with np.errstate(over="ignore", invalid="ignore"):
            exact = np.cumsum(originals[who] * part.original[which], axis=1)[:, -1] if len(who) else np.zeros(0)
        keys = queries.column(5).take(pa.array(who))
        ids = pa.array([part.ids[i] for i in which], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([keys, ids, pa.array(best[who, column]), pa.array(exact)], names=["key", "ids", "near", "score"])

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, raw, ids, part = None, [], [], None
        for batch in stream:
            columns = [np.asarray(batch.column(i)) for i in range(5)]
            marks = np.stack(columns, axis=1)
            borders = [0, *(np.flatnonzero((np.diff(marks, axis=0) != 0).any(1)) + 1).tolist(), batch.num_rows]
            for start, end in zip(borders, borders[1:], strict=False):
                *place, kind = marks[start].tolist()
                if place != now:
                    now, raw, ids, part = place, [], [], None
                if kind == 0:
                    raw += batch.column(6).slice(start, end - start).to_pylist()
                    ids += batch.column(7).slice(start, end - start).to_pylist()
                    continue
                if not raw:  # a part that no vector fell into
                    continue
                space = spaces[place[0]]
                part = part or Part(space, raw, ids, keep, ratio)
                for first in range(start, end, TOGETHER):
                    made = found(part, space, batch.slice(first, min(TOGETHER, end - first)))
                    if made.num_rows:
                        yield made

    return met.mapInArrow(batches, "key binary, ids array<long>, near double, score double")


def _other_cells(asked: DataFrame, boxes: DataFrame, spaces: dict[int, Space], ratio: float, dims: int) -> DataFrame:
    """The cells, but the query's own, whose box the stopping radius reaches."""
    held: dict[int, list] = {}
    for row in boxes.collect():  # a row a cell
        held.setdefault(row["length"], []).append((row["cell"], [row[f"l{i}"] for i in range(dims)], [row[f"h{i}"] for i in range(dims)]))
    all_boxes = {n: tuple(map(np.array, zip(*b, strict=True))) for n, b in held.items()}

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in stream:
            for first in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(first, TOGETHER)
                lengths, home = np.asarray(batch.column(1)), np.asarray(batch.column(3))
                floor = np.nan_to_num(batch.column(4).to_numpy(zero_copy_only=False).astype(float), nan=-np.inf)
                for length in np.unique(lengths):
                    rows, space, (cells, low, high) = np.flatnonzero(lengths == length), spaces[int(length)], all_boxes[int(length)]
                    at = space.project(space.unit_query(_matrix(batch.column(2).take(pa.array(rows)).to_pylist())))
                    outside = np.maximum(0, np.maximum(low[None] - at[:, None], at[:, None] - high[None]))
                    reached = np.square(outside).sum(2) <= (np.maximum(0, 2 - 2 * floor[rows]) * ratio)[:, None]
                    who, which = np.nonzero(reached & (cells[None] != home[rows][:, None]))
                    if len(who):
                        taken = batch.take(pa.array(rows[who]))
                        yield pa.RecordBatch.from_arrays(
                            [taken.column(0), taken.column(1), taken.column(2), pa.array(cells[which].astype(np.int32)), taken.column(4)],
                            names=["key", "length", "vec", "cell", "floor"],
                        )

    return asked.select("key", "length", "vec", "cell", "floor").mapInArrow(batches, "key binary, length int, vec binary, cell int, floor double")


def nearest(
    embeddings: DataFrame, every: int = 20, k: int = K, dims: int = DIMS, confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS, seed: int = SEED
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row whose id is divisible by `every`."""
    keep, ratio = k + 1, radius(dims, confidence)
    rows = store.land(vectors(embeddings), "vectors")
    ranked = rows.select("key", "id").distinct().withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("id")))
    ids = ranked.where(F.col("_n") <= keep).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    single = rows.groupBy("key").agg(F.first("length").alias("length"), F.first("norm").alias("norm"), F.first("vec").alias("vec"))
    distinct = store.land(single.join(ids, "key"), "distinct")
    spaces = _spaces(distinct, dims, cell_rows, seed)
    points = store.land(_placed(distinct, spaces, dims), "points")
    boxes = points.groupBy("length", "cell").agg(*(f(F.col("at")[i]).alias(f"{n}{i}") for i in range(dims) for n, f in (("l", F.min), ("h", F.max))))

    queries = rows.where(F.col("id") % every == 0).select("key", F.col("id").alias("query_id")).distinct()
    asked = points.join(queries.select("key").distinct(), "key").select("key", "length", "vec", "cell", F.lit(None).cast("double").alias("floor"))
    asked = store.land(asked, "asked")
    home = store.land(_visit(points, asked, spaces, keep, ratio, cell_rows), "home")
    best = Window.partitionBy("key").orderBy(F.desc("near"))
    floors = home.withColumn("_n", F.row_number().over(best)).where(F.col("_n") == keep).select("key", F.col("near").alias("_floor"))
    known = asked.drop("floor").join(floors, "key", "left").withColumnRenamed("_floor", "floor")
    further = store.land(_other_cells(known, boxes, spaces, ratio, dims), "further")
    found = store.land(home.union(_visit(points, further, spaces, keep, ratio, cell_rows)), "found")

    order = [F.desc("score"), F.col("vec_id")]
    each = found.select("key", "score", F.explode("ids").alias("vec_id"))
    top = each.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("_n") <= keep).drop("_n")
    answers = store.land(queries.join(store.land(top, "top"), "key").where(F.col("vec_id") != F.col("query_id")), "answers")
    rank = F.row_number().over(Window.partitionBy("query_id", "key").orderBy(*order))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
