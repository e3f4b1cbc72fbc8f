"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. The rows' ids and sizes are written; a written partition has a fixed content.
2. Counts per partition come to the driver, one number a partition. It draws how
   many rows each partition sends to each shard: row by row of the matrix, a
   multivariate hypergeometric draw from what room the shards have left. Row sums
   are the partitions, column sums the shard sizes: exact.
3. Every partition permutes its rows by a keyed hash and deals them out by its row
   of the matrix; the exchange follows.
4. Every shard is permuted again by a second key: uniform sub-ranges of the key
   are the tasks, so a shard is never in one task, and slots count through them.

Law `rows`: shard sizes differ by one at most. A uniform shuffle keeps no groups
together, equal texts included. NULL text has no bytes (size 1, crc32 of the empty
text); repeated rows each get their own slot; NULL ids are rows like others; other
columns are not read. An empty table gives an empty result. The same table, seed
and partitioning give the same shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firstmile.llm import store

SHARDS, SEED = 16, 20240501
#: Population that numpy's own draw takes, and a sample that is drawn one by one.
NUMPY_LIMIT, HANDFUL = 10**9, 64
#: Rows that one task of the last permutation sorts.
TASK_ROWS = 10_000


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from partition p to shard s; every row sums to counts[p], columns differ by one at most."""
    draw, total = np.random.default_rng(seed), sum(counts)
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    matrix = np.zeros((len(counts), shards), np.int64)
    for p, n in enumerate(counts):
        left, asked = int(room.sum()), n
        for s in range(shards):
            # A draw for one shard against all later ones; the next is drawn from those.
            take = int(_hypergeometric(draw, int(room[s]), left - int(room[s]), asked))
            left -= int(room[s])
            asked -= take
            matrix[p, s] = take
        room -= matrix[p]
    return matrix


def _hypergeometric(draw: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of a uniform sample without replacement are good, at any size.

    numpy draws from populations below 10**9. Of a larger one every member is first
    taken with the sample's share: two binomial draws, good and bad. What is taken is
    then a uniform subset that is too large or too small by about the square root of the
    sample; the surplus is given back, or the lack filled, uniformly from what was or was
    not taken. That is a draw of the same kind for so much smaller a sample, so some five
    rounds reach a handful of members, which are drawn one by one. No step is approximate.
    """
    if sample == 0 or good == 0:
        return 0
    if bad == 0:
        return sample
    if good + bad < NUMPY_LIMIT:
        return int(draw.hypergeometric(good, bad, sample))
    if 2 * sample > good + bad:
        return good - _hypergeometric(draw, good, bad, good + bad - sample)
    if sample <= HANDFUL:
        taken = 0
        for _ in range(sample):
            hit = int(draw.integers(good + bad)) < good
            taken, good, bad = taken + hit, good - hit, bad - (not hit)
        return taken
    share = sample / (good + bad)
    some, others = int(draw.binomial(good, share)), int(draw.binomial(bad, share))
    surplus = some + others - sample
    if surplus >= 0:
        return some - _hypergeometric(draw, some, others, surplus)
    return some + _hypergeometric(draw, good - some, bad - others, -surplus)


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    staged = store.land(
        docs.select(
            "doc_id",
            (F.length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    counts = staged.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    total = sum(r["n"] for r in counts)
    matrix = communication_matrix([r["n"] for r in counts], shards, seed)
    upto = np.cumsum(matrix, axis=1)
    rows = [(r["part"], [int(x) for x in ends]) for r, ends in zip(counts, upto, strict=True)]
    sent = spark.createDataFrame(rows, "part int, upto array<long>")

    # Permute locally, deal out. The matrix has one row a partition.
    mixed = staged.withColumn("_at", F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "row"), "row")))
    dealt = mixed.join(sent, "part").withColumn("shard", F.size(F.filter("upto", lambda end: end < F.col("_at"))))

    # Permute again: sub-ranges of a second key, sorted each by itself, counted through.
    tasks = max(1, -(-total // (shards * TASK_ROWS)))
    keyed = dealt.withColumn("_key", F.xxhash64(F.lit(seed + 1), "row")).withColumn("_sub", F.pmod("_key", F.lit(tasks)))
    keyed = store.land(keyed.select("doc_id", "size", "text_crc32", "shard", "_sub", "_key", "row"), "dealt")
    sizes = keyed.groupBy("shard", "_sub").agg(F.count("*").alias("n"))
    before = sizes.withColumn("_before", F.sum("n").over(Window.partitionBy("shard").orderBy("_sub")) - F.col("n")).drop("n")
    within = Window.partitionBy("shard", "_sub").orderBy("_key", "row")
    placed = keyed.withColumn("_in", F.row_number().over(within) - 1).join(before, ["shard", "_sub"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), (F.col("_before") + F.col("_in")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
