"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent n-grams, 1 to 3 letters long,
from words in lower case with a space at either side. A document's own list is
compared to each profile by the out-of-place distance: for each of its n-grams,
how many ranks apart the two lists place it, or the longest distance if the
profile lacks it. The nearest profile wins; ties go to the smaller name.

Training counts n-grams of all training documents, combined per task; a profile
holds `PROFILE` n-grams, so what travels to the tasks grows with the number of
languages alone, at most `LANGUAGES`.

NULL text, or text without a letter, is `und` with score 0; so is everything if
there is nothing to learn from. Equal counts rank by n-gram. Repeated rows count as
often as they come. Texts are read whole, `CHUNK` characters at a time. A NULL
doc_id counts as empty text in the split. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firstmile.llm.columns import id_remainder, raw, slices, values

PROFILE, LANGUAGES = 300, 2000
ORDERS = 3
UNKNOWN = "und"
CHUNK = 1 << 20
WIDTH = 21  # bits of a code point
SALTS = 32


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space if it is no letter."""
    table = np.full(sys.maxunicode + 1, 32, np.int64)
    for c in range(sys.maxunicode + 1):
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def ngrams(text: bytes, table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct n-grams of a stretch of text and their counts, n-grams as packed code points.

    A stretch after the first starts with the two letters before it, so each
    n-gram of the text comes once.
    """
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    points = table[points]
    # Words stand apart by one space, and the text begins and ends with one.
    space = points == 32
    points = np.concatenate(([32], points[~(space & np.r_[True, space[:-1]])], [32]))
    if points[-2] == 32:
        points = points[:-1]
    for at in range(0, max(1, len(points) - 1), CHUNK):
        ahead = min(at, ORDERS - 1)
        part = points[at - ahead : at + CHUNK]
        found = []
        gram = part
        for n in range(1, ORDERS + 1):
            if n > 1:
                gram = (gram[:-1] << WIDTH) | part[n - 1 :]
            # Without n-grams of the stretch before, without the bare space, and without a space inside.
            own = gram[max(0, ahead - n + 1) :]
            middle = (own >> WIDTH) & ((1 << WIDTH) - 1) if n == ORDERS else own
            found.append(own[middle != 32])
        yield np.unique(np.concatenate(found), return_counts=True)


def counts_of(text: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = list(ngrams(text, table))
    if len(parts) == 1:
        return parts[0]
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def count(docs: DataFrame) -> DataFrame:
    """lang, gram and its count n, over all of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters()
        for batch in batches:
            held: dict[str, list] = {}
            for part in slices([batch], 500):
                for text, lang in zip(raw(part, "text"), values(part, "lang"), strict=True):
                    if text:
                        held.setdefault(lang, []).append(text)
                # Texts of a language are counted together: a line break parts their words.
                for lang, texts in held.items():
                    grams, n = counts_of(b"\n".join(texts), table)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "gram": pa.array(grams, pa.int64()), "n": pa.array(n, pa.int64())})
                held.clear()

    found = docs.select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profiles(docs: DataFrame) -> dict[str, np.ndarray]:
    """Each language's n-grams by falling frequency."""
    salted = count(docs).withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(SALTS)))
    order = (F.col("n").desc(), "gram")
    best = salted
    for keys in (("lang", "salt"), ("lang",)):  # the first pass bounds what a language brings to the second
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= PROFILE)
    rows = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("p")).limit(LANGUAGES + 1).collect()
    if len(rows) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    return {r["lang"]: np.array([x["gram"] for x in r["p"]], np.int64) for r in sorted(rows, key=lambda r: r["lang"])}


class Nearest:
    def __init__(self, learned: dict[str, np.ndarray]):
        self.names, self.table = list(learned), letters()
        grams = np.unique(np.concatenate([*learned.values(), np.empty(0, np.int64)]))
        # ranks[i, j]: the rank of gram i in profile j; PROFILE stands for "not there".
        self.grams, self.ranks = grams, np.full((len(grams) + 1, len(learned)), -1, np.int64)
        for j, profile in enumerate(learned.values()):
            self.ranks[np.searchsorted(grams, profile), j] = np.arange(len(profile))

    def __call__(self, text: bytes | None) -> tuple[str, float]:
        """The nearest language, and one less the share of the longest possible distance."""
        if not text or not self.names:
            return UNKNOWN, 0.0
        grams, n = counts_of(text, self.table)
        if not len(grams):
            return UNKNOWN, 0.0
        own = grams[np.argsort(-n, kind="stable")[:PROFILE]]
        at = np.searchsorted(self.grams, own)
        at = np.where((at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == own), at, len(self.grams))
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own))[:, None]))
        distance = apart.sum(axis=0)
        best = int(np.argmin(distance))
        return self.names[best], float(1 - distance[best] / (PROFILE * len(own)))


def predict(docs: DataFrame, learned: dict[str, np.ndarray], held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; only the text decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(learned)
        for batch in slices(batches, 1000):
            found = [nearest(t) for t in raw(batch, "text")]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0).cast(pa.int64()),
                    "held_out": batch.column(2),
                    "lang_pred": pa.array([x[0] for x in found], pa.string()),
                    "score": pa.array([x[1] for x in found], pa.float64()),
                }
            )

    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def train_and_predict(docs: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    held_out = id_remainder("doc_id", modulus) == held
    return predict(docs, profiles(docs.where(~held_out & F.col("lang").isNotNull())), held_out)
