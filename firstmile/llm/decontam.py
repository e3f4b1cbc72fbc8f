"""Benchmark decontamination: a BM25 inverted index of test items, queried by every training passage.

Items are the index, passages the queries. A posting holds a word's BM25 weight in
an item as a share of the item's own full score, so one threshold serves all items:
a passage that holds the whole item scores 1. Items fall into classes by length,
and passages of a class are windows twice as long as its longest item, one such
length apart, so that every stretch as long as an item lies whole in a window.

Each passage retrieves all items at or above the threshold with block-max WAND:
postings of a word are ordered by item and cut into blocks with their largest
weight; the pivot is the first item that the words' largest weights can lift to the
threshold, and a block that cannot is skipped whole. Before that, numpy adds up the
words' largest weights by block of items for a batch of passages at a time, and
passages that no block can lift to the threshold are done. Nothing is cut off: the
result is that of scoring every passage against every item.

A retrieved item counts if question and answer overlap with the words around the
passage: at least `OVERLAP` of the three-word shingles of either part; of a part of
at most `SHORT` words, more than half of its words, standing together. The answer is
what follows `Answer:` or the last question mark; an item that marks none is all
question.

The index travels to the tasks in parts of about `PART_WORDS` words of items, one
pass over the documents a part, so its size is bounded for any benchmark; document
frequencies are those of all items.

NULL and empty texts match nothing, in documents and items. Repeated rows of a
document or an item give one match. Words are compared in lower case without ASCII
punctuation, so case, layout and markup do not hide a leak. Texts are read whole.
Other columns are not read.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firstmile.llm.columns import map_rows, slices, values

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, SHINGLE = 0.5, 0.5, 3
#: Of so many words, one edit can change more than half of the shingles.
SHORT = 7
BLOCK = 32
PART_WORDS = 1_000_000
#: Numbers in a class's matrix of bounds.
MATRIX = 1 << 22
SHORTEST = 16

_BLANK = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_ANSWER = re.compile(r"\banswer\s*:", re.IGNORECASE)


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANK).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    text = text.strip()
    if found := list(_ANSWER.finditer(text)):
        cut, end = found[-1].span()
    elif "?" in text[:-1]:
        cut = end = text.rindex("?", 0, len(text) - 1) + 1
    else:
        return words(text), []
    question, answer = words(text[:cut]), words(text[end:])
    return (question, answer) if question else (answer, [])


def shingles(part: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(SHINGLE, len(part))
    return {tuple(part[i : i + n]) for i in range(len(part) - n + 1)} if n else set()


def _nearby(part: list[bytes], around: list[bytes]) -> float:
    """Largest share of the part's words that stand together, one word more allowed; up to half do so by chance and count as none."""
    left, width, held, best = Counter(part), len(part) + 1, 0, 0
    for i, w in enumerate(around):
        held += left[w] > 0
        left[w] -= 1
        if i >= width:
            old = around[i - width]
            left[old] += 1
            held -= left[old] > 0
        best = max(best, held)
    return best / len(part) if 2 * best > len(part) else 0.0


def overlap(part: list[bytes], around: list[bytes]) -> float:
    """Share of the part's shingles, or of a short part's words, that the words around hold; 1 for an empty part."""
    if not part:
        return 1.0
    if len(part) <= SHORT:
        return _nearby(part, around)
    wanted = shingles(part)
    n = len(next(iter(wanted)))
    there = {tuple(around[i : i + n]) for i in range(len(around) - n + 1)}
    return len(wanted & there) / len(wanted)


@dataclass
class Class:
    """Postings of the items of one class of lengths."""

    longest: int
    items: list[int]
    postings: dict[int, tuple[list[int], list[float], list[float]]]  # word: items, weights, largest weight by block
    most: np.ndarray  # by word: its largest weight
    bounds: np.ndarray  # by word and block of items: the largest weight


class Index:
    def __init__(self, items: list[tuple[int, str]], frequency: dict[bytes, int], n_items: int, mean_length: float):
        self.items = [(i, text, words(text)) for i, text in items]
        self.word: dict[bytes, int] = {}
        for _, _, ws in self.items:
            for w in ws:
                self.word.setdefault(w, len(self.word))
        idf = {w: math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) for w in self.word}
        self.parts = [question_and_answer(text) for _, text, _ in self.items]
        by_class: dict[int, list[int]] = {}
        for k, (_, _, ws) in enumerate(self.items):
            if ws:
                by_class.setdefault(max(SHORTEST, 1 << (len(ws) - 1).bit_length()), []).append(k)
        self.classes = []
        for longest, members in sorted(by_class.items()):
            lists: dict[int, list[tuple[int, float]]] = {}
            for k in members:
                ws = self.items[k][2]
                norm = K1 * (1 - B + B * len(ws) / mean_length)
                weights = {self.word[w]: idf[w] * tf * (K1 + 1) / (tf + norm) for w, tf in Counter(ws).items()}
                total = sum(weights.values())
                for w, x in weights.items():
                    lists.setdefault(w, []).append((k, x / total))
            most = np.zeros(len(self.word) + 1)
            postings = {}
            # As many blocks of neighbouring items as the bounds' memory allows, down to one item a block.
            n_blocks = max(1, min(len(members), MATRIX // (len(self.word) + 1)))
            block_of = {k: i * n_blocks // len(members) for i, k in enumerate(members)}
            bounds = np.zeros((len(self.word) + 1, n_blocks), np.float32)
            for w, found in lists.items():
                ks, xs = zip(*found, strict=True)
                most[w] = max(xs)
                np.maximum.at(bounds[w], [block_of[k] for k in ks], xs)
                postings[w] = (list(ks), list(xs), [max(xs[i : i + BLOCK]) for i in range(0, len(xs), BLOCK)])
            self.classes.append(Class(longest, members, postings, most, bounds))

    def ids(self, texts: list[list[bytes]]) -> np.ndarray:
        """Word numbers of the texts end to end; the number after the last stands for words of no item."""
        get, none = self.word.get, len(self.word)
        return np.fromiter((get(w, none) for t in texts for w in t), np.int64, sum(map(len, texts)))


END = 1 << 60


def wand(cls: Class, query: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
    """Items whose weights over the query's distinct words reach the threshold, by block-max WAND."""
    slack = threshold - 1e-9
    cursors = []  # [current item, place, items, weights, block maxima, largest weight]
    for w in query:
        if w in cls.postings:
            ks, xs, blocks = cls.postings[w]
            cursors.append([ks[0], 0, ks, xs, blocks, cls.most[w]])
    out = []
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, -1
        for i, c in enumerate(cursors):
            bound += c[5]
            if bound >= slack:
                pivot = i
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        # What the blocks that hold the pivot can add at most, and where the first of them ends.
        local, upto = 0.0, END
        for c in cursors[: pivot + 1]:
            ks, place = c[2], c[1]
            block = place // BLOCK
            while block + 1 < len(c[4]) and ks[(block + 1) * BLOCK - 1] < item:
                block += 1
            local += c[4][block]
            last = ks[min((block + 1) * BLOCK, len(ks)) - 1]
            upto = min(upto, last + 1 if last >= item else END)
        if local < slack:
            # Nothing before the end of these blocks, or before the next word's item, can reach the threshold.
            target = max(item + 1, min(upto, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else END))
            moved = cursors[: pivot + 1]
        elif cursors[0][0] == item:
            score = sum(c[3][c[1]] for c in cursors[: pivot + 1])
            if score >= slack:
                out.append((item, score))
            target, moved = item + 1, cursors[: pivot + 1]
        else:
            target, moved = item, [c for c in cursors[:pivot] if c[0] < item]
        for c in moved:
            ks, place, n = c[2], c[1], len(c[2])
            while place < n and ks[place] < target:
                # Whole blocks that end before the target are stepped over.
                end = place - place % BLOCK + BLOCK
                place = end if end <= n and ks[end - 1] < target else place + 1
            c[1], c[0] = place, ks[place] if place < n else END
        cursors = [c for c in cursors if c[0] < END]
    return out


def passages(cls: Class, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, int, list[int]]]:
    """(text, begin, end, distinct words) of the windows whose words can reach the threshold together."""
    none, stride = len(cls.most) - 1, cls.longest
    most = cls.most[ids]
    sums = np.concatenate(([0.0], np.cumsum(most)))
    # A window starts at every multiple of the stride, but for one that the window before it covers.
    n = np.maximum(1, -(-(ends - starts) // stride) - 1)
    text = np.repeat(np.arange(len(starts)), n)
    begin = starts[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * stride
    end = np.minimum(begin + 2 * stride, ends[text])
    able = np.flatnonzero(sums[end] - sums[begin] >= threshold - 1e-9)
    for at in range(0, len(able), 512):
        some = able[at : at + 512]
        size = end[some] - begin[some]
        window = np.repeat(np.arange(len(some)), size)
        place = np.arange(len(window)) + np.repeat(begin[some] - np.cumsum(size) + size, size)
        known = most[place] > 0
        pairs = window[known] * (none + 1) + ids[place[known]]
        pairs.sort()
        pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
        window, word = pairs // (none + 1), pairs % (none + 1)
        cuts = np.searchsorted(window, np.arange(len(some) + 1))
        # Every window has a word of weight, so no cut is empty.
        bound = np.add.reduceat(cls.bounds[word], cuts[:-1], axis=0).max(axis=1)
        for k in np.flatnonzero(bound >= threshold - 1e-4):
            yield int(text[some[k]]), int(begin[some[k]]), int(end[some[k]]), word[cuts[k] : cuts[k + 1]].tolist()


MATCH = "doc_id long, item_id long, passage_start long, score double, question_overlap double, answer_overlap double"


def _indexes(items: DataFrame) -> Iterator[Index]:
    """The index, in parts of bounded size. Frequencies are counted over all items."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [sorted(set(words(t))) for t in values(batch, "text")]
            lengths = [len(words(t)) for t in values(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(each, pa.list_(pa.binary())), pa.array(lengths, pa.int64())], ["item_id", "text", "words", "n"])

    counted = items.mapInArrow(run, "item_id long, text string, words array<binary>, n long").where("n > 0")
    size = counted.agg(F.count("*").alias("items"), F.sum("n").alias("words")).first()
    if not size["items"]:
        return
    parts = -(-size["words"] // PART_WORDS)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    frequency = counted.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("f"))
    for p in range(parts):
        mine = counted.where(part == p)
        rows = mine.select("item_id", "text").collect()
        own = mine.select(F.explode("words").alias("w")).distinct().join(frequency, "w").collect()
        if rows:
            pairs = sorted((r["item_id"] if r["item_id"] is not None else -1, r["text"]) for r in rows)
            yield Index(pairs, {bytes(r["w"]): r["f"] for r in own}, size["items"], size["words"] / size["items"])


def _find(index: Index, texts: list[list[bytes]]) -> dict[tuple[int, int], tuple[float, int, float, float]]:
    """(text, item): best score, its passage's first word, overlap of question and answer; verified ones only."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    ids = index.ids(texts)
    out: dict[tuple[int, int], tuple[float, int, float, float]] = {}
    for cls in index.classes:
        for text, begin, end, query in passages(cls, ids, starts, ends):
            for k, score in wand(cls, query):
                item, _, ws = index.items[k]
                first = begin - int(starts[text])
                around = texts[text][max(0, first - len(ws)) : end - int(starts[text]) + len(ws)]
                question, answer = (overlap(p, around) for p in index.parts[k])
                if question >= OVERLAP and answer >= OVERLAP:
                    new = (min(score, 1.0), first, question, answer)
                    key = (text, item)
                    if key not in out or (-new[0], new[1]) < (-out[key][0], out[key][1]):
                        out[key] = new
    return out


def _sent(spark: SparkSession, index: Index) -> Broadcast:
    """A part of the index for the tasks, as plain values."""
    return spark.sparkContext.broadcast(vars(index) | {"classes": [vars(c) for c in index.classes]})


def _received(sent: Broadcast) -> Index:
    index = Index.__new__(Index)
    index.__dict__ |= sent.value | {"classes": [Class(**c) for c in sent.value["classes"]]}
    return index


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document and test item found in it."""
    spark, out = docs.sparkSession, None
    for index in _indexes(items):
        sent = _sent(spark, index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _received(sent)
            for batch in slices(batches, 256):
                ids = batch.column(0).cast(pa.int64()).to_pylist()
                found = _find(index, [words(t) for t in values(batch, "text")])
                rows = [(ids[t], item, first, score, q, a) for (t, item), (score, first, q, a) in found.items()]
                if rows:
                    names = [c.split()[0] for c in MATCH.split(", ")]
                    kinds = [pa.int64()] * 3 + [pa.float64()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        found = docs.select("doc_id", "text").mapInArrow(run, MATCH)
        out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], MATCH)
    best = F.max_by(F.struct("passage_start", "question_overlap", "answer_overlap"), F.struct("score", -F.col("passage_start")))
    one = out.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), best.alias("b"))
    return one.select("doc_id", "item_id", "b.passage_start", "score", "b.question_overlap", "b.answer_overlap")


def remove_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that hold a test item, in their own columns. Each row decides for itself: nothing is shuffled."""
    for index in _indexes(items):
        sent = _sent(docs.sparkSession, index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _received(sent)
            for batch in slices(batches, 256):
                leaked = {t for t, _ in _find(index, [words(t) for t in values(batch, "text")])}
                yield batch.filter(pa.array([t not in leaked for t in range(batch.num_rows)]))

        docs = map_rows(docs, run)
    return docs
