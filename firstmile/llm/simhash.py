"""SimHash near-duplicates: fingerprints linked within a Hamming radius through BK-trees.

A fingerprint bit is set if most of a text's shingle hashes set it. Equal
fingerprints are one node from there on, so copies cost nothing. Nodes are dealt
to shards by two of four 16-bit blocks: two fingerprints at most two bits apart
agree in at least two blocks, so they meet in a shard. Each shard grows a BK-tree,
whose children are keyed by their Hamming distance to the parent, and a search
follows only the edges that the radius allows. A shard's tree lives in the task
that holds the shard, beside all fingerprints that can match it: a broadcast of
all trees would grow with the corpus.

Shards of more than `SHARD` fingerprints are dealt once more, by two of the four
bytes in which they may still differ; these hold 2**16 fingerprints at most, which
bounds a task's memory without dropping a link. A shard returns a spanning forest
of its links; components follow from those (`graph.components`).

The scheme holds for radii of 0 to 2. NULL text counts as empty; texts without
words have fingerprint zero and are linked like any other. Repeated rows are
returned as often as they come. A NULL doc_id takes part, but is no component id
unless nothing else is in the component. Other columns are not read by `link`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firstmile.llm import graph, store
from firstmile.llm.columns import raw, slices, unused

SHINGLE, RADIUS, SEED = 3, 2, 42
SHARD = 2048
#: Shingles hashed at a time, which bounds the memory of a very long text.
CHUNK = 65536


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of UTF-8 text; bytes.lower and bytes.split know ASCII letters and white space only."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, n) - 1).tolist()[: n - shingle + 1]
    ends = (ends - 1).tolist()[shingle - 1 :]
    digest, total, ones = xxhash.xxh64_intdigest, len(starts), np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        a, b = starts[at : at + CHUNK], ends[at : at + CHUNK]
        hashes = np.array([digest(joined[x:y], SEED) for x, y in zip(a, b, strict=True)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > total).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, into: str = "_fp") -> DataFrame:
    """docs with a long column `into`, the fingerprint's 64 bits as a signed number."""
    schema = docs.withColumn(into, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            found = [_signed(fingerprint(t or b"", shingle)) for t in raw(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, into])

    return docs.mapInArrow(run, schema)


class BkTree:
    """Node 0 is the root; children[i] maps a distance to the child of node i at that distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Nodes within the radius; by the triangle inequality only edges d-radius to d+radius can lead there."""
        todo = [0] if self.values else []
        while todo:
            i = todo.pop()
            d = (self.values[i] ^ value).bit_count()
            if d <= radius:
                yield i
            for edge, child in self.children[i].items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)

    def add(self, value: int) -> None:
        i = 0
        while i < len(self.values):
            d = (self.values[i] ^ value).bit_count()
            if d not in self.children[i]:
                self.children[i][d] = len(self.values)
                break
            i = self.children[i][d]
        self.values.append(value)
        self.children.append({})


def forest(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """For each value linked to a smaller one, its root in the shard. Values come distinct."""
    tree, parent = BkTree(), list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, value in enumerate(values):
        for j in tree.near(value, radius):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
        tree.add(value)
    for i, value in enumerate(values):
        if (j := root(i)) != i:
            yield value, values[j]


def _bits(value: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(value, shift).bitwiseAND((1 << width) - 1)


def _shards(nodes: DataFrame) -> DataFrame:
    """(which two blocks, their 32 bits, fingerprint), six rows a node."""
    fp = F.col("_fp")
    keys = [
        F.struct(F.lit(k).alias("pair"), (F.shiftleft(_bits(fp, 16 * a, 16), 16) + _bits(fp, 16 * b, 16)).alias("key"))
        for k, (a, b) in enumerate(combinations(range(4), 2))
    ]
    return nodes.select(F.explode(F.array(*keys)).alias("s"), "_fp").select("s.pair", "s.key", F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("subkey"), "_fp")


def _finer(rows: DataFrame) -> DataFrame:
    """Rows of large shards dealt again, by two of the four bytes outside the two blocks."""
    fp, out = F.col("_fp"), None
    for k, pair in enumerate(combinations(range(4), 2)):
        rest = [8 * (2 * block + half) for block in range(4) if block not in pair for half in (0, 1)]
        keys = [
            F.struct(F.lit(j).alias("sub"), (F.shiftleft(_bits(fp, rest[a], 8), 8) + _bits(fp, rest[b], 8)).alias("subkey"))
            for j, (a, b) in enumerate(combinations(range(4), 2))
        ]
        out = F.array(*keys) if out is None else F.when(F.col("pair") == k, F.array(*keys)).otherwise(out)
    return rows.select("pair", "key", F.explode(out).alias("s"), "_fp").select("pair", "key", "s.sub", "s.subkey", "_fp")


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): a spanning forest, shard by shard, of all pairs of distinct fingerprints within the radius."""
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"blocks that agree are certain for a radius of 0 to {RADIUS} only")
    shards = _shards(nodes)
    # Counts shuffle one row a task and key, and leave only keys that more than one fingerprint shares.
    counts = shards.groupBy("pair", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    shared = shards.join(counts, ["pair", "key"])
    small = shared.where(F.col("n") <= SHARD).drop("n")
    large = _finer(shared.where(F.col("n") > SHARD).drop("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        now, out = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                u, v = zip(*out, strict=True)
                yield pa.RecordBatch.from_pydict({"u": pa.array(map(_signed, u), pa.int64()), "v": pa.array(map(_signed, v), pa.int64())})
                out.clear()

        for batch in batches:
            pair, key, sub, subkey = (batch.column(i).to_numpy() for i in range(4))
            fps = batch.column(4).to_numpy().view(np.uint64).tolist()
            for shard, fp in zip(zip(pair.tolist(), key.tolist(), sub.tolist(), subkey.tolist(), strict=True), fps, strict=True):
                if shard != now:
                    if len(held) > 1:
                        out.extend(forest(held, radius))
                    now, held = shard, []
                held.append(fp)
            if len(out) > 10_000:
                yield from flush()
        if len(held) > 1:
            out.extend(forest(held, radius))
        yield from flush()

    columns = ("pair", "key", "sub", "subkey")
    dealt = small.unionByName(large).repartition(*columns).sortWithinPartitions(*columns, "_fp")
    return dealt.mapInArrow(run, "u long, v long")


def _rooted(docs: DataFrame, shingle: int, radius: int, *more: Column) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, _fp, more), and for each fingerprint its least doc_id and its component's root."""
    rows = store.land(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "_fp", *more), "fingerprints")
    least = rows.groupBy("_fp").agg(F.min("doc_id").alias("least"))
    roots = graph.components(links(least.select("_fp"), radius))
    return rows, least.join(roots, least["_fp"] == roots["node"], "left").select("_fp", "least", F.coalesce("root", "_fp").alias("root"))


def link(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, _fp, component_id (the smallest doc_id reachable) for every row of docs."""
    rows, rooted = _rooted(docs, shingle, radius)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = store.land(rooted.join(ids, "root").select("_fp", "component_id"), "components")
    return rows.join(by_fp, "_fp").select("doc_id", "_fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, in its own columns.

    Documents with an id go before those without; of several rows with that id the first
    by the hash of the text stays, and of rows equal in both the first in the table.
    Other columns may have any name and type.
    """
    rows, rooted = _rooted(docs, shingle, radius, F.xxhash64("text").alias("_text"))
    rooted = store.land(rooted.select("_fp", "root"), "roots")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text")
    # Copies are counted before the shuffle by component.
    copies = rows.groupBy("_fp", "doc_id", "_text").agg(F.count("*").alias("n"))
    best = copies.join(rooted, "_fp").groupBy("root").agg(F.min(order).alias("k"), F.min_by("n", order).alias("n"))
    own_id, own_text, own_n, place, nth = unused(docs, "_doc_id", "_text", "_n", "_place", "_nth")
    chosen = store.land(best.select(F.col("k.doc_id").alias(own_id), F.col("k._text").alias(own_text), F.col("n").alias(own_n)), "chosen")
    wanted = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_text))
    kept = docs.join(chosen, wanted, "left_semi")
    if not chosen.where(F.col(own_n) > 1).take(1):
        return kept
    # Repeated rows of a chosen document: one of them stays. All but a task's first go before the shuffle.
    single = docs.join(chosen.where(F.col(own_n) == 1), wanted, "left_semi")
    several = docs.withColumn(place, F.monotonically_increasing_id()).join(chosen.where(F.col(own_n) > 1), wanted, "left_semi")
    copy = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(place)
    first = several.withColumn(nth, F.row_number().over(copy)).where(F.col(nth) == 1)
    return single.unionByName(first.select(*(F.col(f"`{c}`") for c in docs.columns)))
