"""Log-bilinear language model, trained in numpy with noise-contrastive estimation.

Words are counted over all training documents, with a combine per task. The `SINGLES`
most frequent tokens are classes of their own; the next, down to words seen `SEEN` times
and to `FREQUENT` words in all, fall into at most `GROUPS` classes by their counts; one
class stands for all others. The probability of a word is that of its class times that
of the word in its class.

* Class: context vectors of the `CONTEXT` words before the token, weighted by position,
  add up to a vector whose product with a class vector, plus a bias, is the class's
  score. Words that are no class of their own are one context.
* Word in a group: the product of the word's vector with the vector, in this group, of
  the nearest of the `TRIGGERS` - 1 most frequent words before it in the text, plus a bias.
* Word outside: its share among the words without a vector.

So all probabilities of one position, one unseen word included, sum to one.

Training of classes: a round sends the model to every task; each goes once through all
of its training documents in minibatches, against noise drawn from the unigram
distribution, and returns its parameters; their mean, weighted by tokens, is the next
model. The first round also counts words of groups by trigger; a group's counts meet in
one task, which fits the group's vectors by noise-contrastive estimation over all its
pairs at once, the noise being the group's unigram distribution. Means and counts are
taken in two steps, the first salted, so the driver sees one model a round. Normalisers
are exact, from matrix products: over all classes for each distinct context, and over a
group's words for each trigger.

What grows with the corpus is never broadcast: at most FREQUENT words of at most
`WORD_BYTES` bytes, with a vector of `GROUP_WIDTH` numbers each, travel with the tasks;
counts of all other words come by a join.

Tokens: words between ASCII white space in lower-case ASCII, then one end. NULL
text counts as empty: its end alone. Repeated rows are trained on and returned as
often as they come; a NULL doc_id counts as empty text in the split. Without
training documents every probability is that of one unseen word, 1. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.llm import store
from firstmile.llm.columns import id_remainder, raw, slices, values

END = b""  # no word is empty
SINGLES, GROUPS, CONTEXT, WIDTH = 767, 256, 2, 32
FREQUENT, SEEN, WORD_BYTES = 262_144, 3, 64
TRIGGERS, GROUP_WIDTH, STEPS, GROUP_RATE, PRIOR = 128, 16, 20, 0.5, 4.0
SALTS, PAIRS = 16, 4_000_000
NOISE, SHARED, BATCH, HEAVIEST, RATE, ROUNDS = 16, 64, 512, 8, 0.1, 1
DISTINCT = 300_000  # words that a task counts before it hands them on


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def count(docs: DataFrame) -> DataFrame:
    """word (binary, the end is empty) and its count c in docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return out

        for batch in slices(batches, 500):
            texts = raw(batch, "text")
            held[END] += len(texts)
            for text in texts:
                held.update(words(text))
            if len(held) > DISTINCT:
                yield flush()
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Model:
    """Context vectors (the last row pads a text's start), class vectors, biases, position weights."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    position: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.bias, self.position]

    def scores(self, before: np.ndarray) -> np.ndarray:
        """Unnormalised scores of all classes after each row of `before` (contexts, nearest first)."""
        return self.predicted(before) @ self.target.T + self.bias

    def predicted(self, before: np.ndarray) -> np.ndarray:
        return sum(self.context[before[:, i]] * self.position[i] for i in range(before.shape[1]))


def initial(counts: np.ndarray, contexts: int, seed: int = 7) -> Model:
    """Small random vectors; biases are unigram log probabilities, so the start is the unigram model."""
    draw, k = np.random.default_rng(seed), len(counts)
    small = lambda n: draw.normal(0, 0.1, (n, WIDTH)).astype(np.float32)
    share = (counts + 1.0) / (counts + 1.0).sum()
    return Model(small(contexts), small(k), np.log(share).astype(np.float32), np.ones((CONTEXT, WIDTH), np.float32))


def _summed(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows that share an index."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return at[first], np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    """Minibatch NCE with AdaGrad steps."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int):
        self.model, self.noise, self.draw = model, noise, np.random.default_rng(seed)
        self.log_noise = np.log(NOISE * noise).astype(np.float32)
        self.cumulative = np.cumsum(noise)
        self.squares = [np.full_like(p, 0.1) for p in model.parts()]

    def _step(self, part: int, at, gradient: np.ndarray) -> None:
        squares, values = self.squares[part], self.model.parts()[part]
        squares[at] += gradient * gradient
        values[at] -= RATE * gradient / np.sqrt(squares[at])

    def learn(self, before: np.ndarray, after: np.ndarray, weight: np.ndarray) -> None:
        """One step on `weight` occurrences of class `after` in context `before`, row by row."""
        m = self.model
        noise = np.minimum(np.searchsorted(self.cumulative, self.draw.random(SHARED) * self.cumulative[-1]), len(self.noise) - 1)
        hidden, wanted, unwanted = m.predicted(before), m.target[after], m.target[noise]
        own = np.einsum("nd,nd->n", hidden, wanted) + (m.bias - self.log_noise)[after]
        other = hidden @ unwanted.T
        other += (m.bias - self.log_noise)[noise]
        with np.errstate(over="ignore"):  # a score far out has a gradient of 0 or 1
            g_own = -weight / (1 + np.exp(own))  # of -log sigmoid(own)
            np.exp(np.negative(other, out=other), out=other)  # of -log(1 - sigmoid(other))
        other += 1
        np.divide((weight * np.float32(NOISE / SHARED))[:, None], other, out=other)
        g_hidden = g_own[:, None] * wanted + other @ unwanted
        scale = np.float32(1 / np.sqrt(weight.sum()))  # between a sum and a mean: rare classes move, frequent ones stay calm
        rows = np.concatenate([g_own[:, None] * hidden, other.T @ hidden])
        at, g_target = _summed(np.c_[rows, np.r_[g_own, other.sum(axis=0)]], np.r_[after, noise].astype(np.uint16))
        shift = [_summed(g_hidden * m.position[i], before[:, i].astype(np.uint16)) for i in range(CONTEXT)]
        g_position = np.stack([np.einsum("nd,nd->d", g_hidden, m.context[before[:, i]]) for i in range(CONTEXT)])
        self._step(1, at, g_target[:, :-1] * scale)
        self._step(2, at, g_target[:, -1] * scale)
        for rows_at, g in shift:
            self._step(0, rows_at, g * scale)
        self._step(3, slice(None), g_position * (scale / weight.sum()))

    def pass_over(self, before: np.ndarray, after: np.ndarray) -> None:
        """All tokens once, in random order; repeats of a class in a context are one row of that weight, up to HEAVIEST."""
        width = len(self.model.context)
        code = after
        for i in range(CONTEXT):
            code = code * width + before[:, i]
        code, n = np.unique(code, return_counts=True)
        times = -(-n // HEAVIEST)
        rows = self.draw.permutation(np.repeat(np.arange(len(code)), times))
        weights = (n / times).astype(np.float32)
        for at in range(0, len(rows), BATCH):
            part = rows[at : at + BATCH]
            own = code[part]
            columns = []
            for _ in range(CONTEXT):
                columns.append(own % width)
                own = own // width
            self.learn(np.stack(columns[::-1], axis=1), own, weights[part])


def contexts(ids: np.ndarray, first: np.ndarray, pad: int) -> np.ndarray:
    """The CONTEXT classes before each token, nearest first. `first`: index of the text's first token."""
    place, out = np.arange(len(ids)), np.empty((len(ids), CONTEXT), ids.dtype)
    for i in range(CONTEXT):
        at = place - i - 1
        out[:, i] = np.where(at >= first, ids[np.maximum(at, 0)], pad)
    return out


class _OrRest(dict):
    rest = 0

    def __missing__(self, word: bytes) -> int:
        return self.rest


class Classes:
    """Numbers of frequent words by falling count, and their classes; the last number, and the last class, are the rest."""

    def __init__(self, frequent: list[bytes]):
        self.of = _OrRest((w, i) for i, w in enumerate(frequent))
        self.none = self.of.rest = len(frequent)
        self.singles = min(SINGLES, len(frequent))
        grouped = len(frequent) - self.singles
        self.groups = min(GROUPS, grouped)
        group = np.arange(grouped) * self.groups // max(1, grouped)
        #: Where each group's words start and end, counted from the first word in a group.
        self.borders = np.searchsorted(group, np.arange(self.groups + 1))
        self.rest = self.singles + self.groups
        #: As contexts, all words but single ones are one, and one more stands before a text.
        self.other, self.pad = self.singles, self.singles + 1
        self.class_of = np.concatenate([np.arange(self.singles), self.singles + group, [self.rest]]).astype(np.int64)

    def numbers(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """Numbers of all tokens end to end, each token's text start, the words of each text with its end."""
        tokens = [[*words(t), END] for t in texts]
        sizes = np.array([len(t) for t in tokens], np.int64)
        ids = np.fromiter(map(self.of.__getitem__, chain.from_iterable(tokens)), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        return ids, np.repeat(starts, sizes), tokens

    def grouped(self, numbers: np.ndarray, classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens that are in a group: their places, their words counted from the first in a group, and their triggers."""
        at = np.flatnonzero((classes >= self.singles) & (classes < self.rest))
        place = np.where(classes < min(TRIGGERS - 1, self.singles), np.arange(len(classes)), -1)
        last = np.concatenate(([-1], np.maximum.accumulate(place)))[at]
        trigger = np.where(last >= first[at], classes[last], TRIGGERS - 1)
        return at, numbers[at] - self.singles, trigger


class Pairs:
    """Counts of (word in a group, trigger), kept as sorted codes."""

    def __init__(self) -> None:
        self.codes, self.counts, self.held = [], [], 0

    def add(self, word: np.ndarray, trigger: np.ndarray) -> None:
        codes, counts = np.unique(word * TRIGGERS + trigger, return_counts=True)
        self.codes.append(codes)
        self.counts.append(counts)
        self.held += len(codes)
        if self.held > PAIRS:
            self.summed()

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        codes, where = np.unique(np.concatenate([*self.codes, np.empty(0, np.int64)]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([*self.counts, np.empty(0, np.int64)]), len(codes)).astype(np.int64)
        self.codes, self.counts, self.held = [codes], [counts], 0
        return codes, counts


#: A row is a parameter block of the class model (0 to 3), or the pairs of a group (GROUP + its number).
GROUP = 16
ROW = "block int, weight double, data binary"


def _row(block: int, weight: float, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "weight": pa.array([weight], pa.float64()), "data": pa.array([data], pa.binary())})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one block, which come together, as one: weighted sums of parameters, sums of pairs."""
    now, total, weight, pairs = None, None, 0.0, Pairs()

    def done() -> Iterator[pa.RecordBatch]:
        if now is not None:
            yield _row(now, weight, total.tobytes() if now < GROUP else np.stack(pairs.summed()).astype("<i8").tobytes())

    for batch in batches:
        for block, w, data in zip(*(values(batch, c) for c in ("block", "weight", "data")), strict=True):
            if block != now:
                yield from done()
                now, total, weight, pairs = block, None, 0.0, Pairs()
            if block < GROUP:
                part = np.frombuffer(data, "<f8")
                total = part if total is None else total + part
            else:
                codes, counts = np.frombuffer(data, "<i8").reshape(2, -1)
                pairs.codes.append(codes)
                pairs.counts.append(counts)
                pairs.held += len(codes)
                if pairs.held > PAIRS:
                    pairs.summed()
            weight += w
    yield from done()


def _train_round(docs: DataFrame, frequent: list[bytes], noise: np.ndarray, model: Model, round_: int) -> tuple[Model, DataFrame]:
    """One pass of every task over its documents: the mean of what they return, and, of the first round, pairs by group."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((frequent, noise, model.parts()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, noise, parts = sent.value
        classes = Classes(frequent)
        trainer, seen, pairs = Trainer(Model(*(p.copy() for p in parts)), noise, 1000 + round_), 0, Pairs()
        for batch in slices(batches, 500):
            numbers, first, _ = classes.numbers(raw(batch, "text"))
            ids = classes.class_of[numbers]
            trainer.pass_over(contexts(np.minimum(ids, classes.other), first, classes.pad), ids)
            seen += len(ids)
            if round_ == 0 and classes.groups:
                pairs.add(*classes.grouped(numbers, ids, first)[1:])
        if seen:
            for block, part in enumerate(trainer.model.parts()):
                yield _row(block, float(seen), (part.astype("<f8") * seen).tobytes())
            codes, counts = pairs.summed()
            ends = np.searchsorted(codes, classes.borders * TRIGGERS)
            for g, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                if a < b:
                    yield _row(GROUP + g, 0.0, np.stack([codes[a:b] - classes.borders[g] * TRIGGERS, counts[a:b]]).astype("<i8").tobytes())

    trained = docs.select("text").mapInArrow(run, ROW).withColumn("salt", F.pmod(F.xxhash64("data"), F.lit(SALTS)))
    some = trained.repartition("block", "salt").sortWithinPartitions("block", "salt").select("block", "weight", "data")
    summed = store.land(some.mapInArrow(_added, ROW), "round")
    parts = summed.where(F.col("block") < GROUP)
    rows = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_added, ROW).collect()
    sent.unpersist()
    found = {r["block"]: np.frombuffer(bytes(r["data"]), "<f8") / r["weight"] for r in rows}
    mean = (found[i].reshape(p.shape).astype(np.float32) if i in found else p for i, p in enumerate(model.parts()))
    return Model(*mean), summed.where(F.col("block") >= GROUP)


class Group:
    """Vectors of a group's words and of the triggers, biases, and the logarithms of the normalisers by trigger."""

    def __init__(self, counts: np.ndarray):
        self.words = np.zeros((len(counts), GROUP_WIDTH), np.float32)
        self.triggers = np.zeros((TRIGGERS, GROUP_WIDTH), np.float32)
        share = (counts + 1.0) / (counts + 1.0).sum()
        self.bias = np.log(share).astype(np.float32)
        self.normalise()

    def parts(self) -> list[np.ndarray]:
        return [self.words, self.triggers, self.bias, self.norm]

    def scores(self) -> np.ndarray:
        return self.words @ self.triggers.T + self.bias[:, None]

    def normalise(self) -> None:
        scores = self.scores()
        top = scores.max(axis=0)
        self.norm = (top + np.log(np.exp(scores - top).sum(axis=0))).astype(np.float32)

    def learn(self, pairs: np.ndarray) -> None:
        """Noise-contrastive estimation over all pairs (words by triggers), with a prior that keeps rare words' vectors small."""
        draw = np.random.default_rng(len(pairs))
        self.words = draw.normal(0, 0.1, self.words.shape).astype(np.float32)
        self.triggers = draw.normal(0, 0.1, self.triggers.shape).astype(np.float32)
        share = np.exp(self.bias)
        pairs = pairs.astype(np.float32)
        expected = NOISE * share[:, None] * pairs.sum(axis=0)[None]
        log_noise = np.log(NOISE * share)[:, None].astype(np.float32)
        squares = [np.full_like(x, 1e-6) for x in (self.words, self.triggers, self.bias)]
        for _ in range(STEPS):
            odds = 1 / (1 + np.exp(log_noise - self.scores()))
            gradient = (expected + pairs) * odds - pairs
            steps = gradient @ self.triggers + PRIOR * self.words, gradient.T @ self.words + PRIOR * self.triggers, gradient.sum(axis=1)
            for value, square, step in zip((self.words, self.triggers, self.bias), squares, steps, strict=True):
                square += step * step
                value -= GROUP_RATE * step / np.sqrt(square)
        self.normalise()


def _fit_groups(pairs: DataFrame, frequent: dict[bytes, int]) -> list[Group]:
    """Every group, fitted on its pairs where there are any."""
    classes, counts = Classes(list(frequent)), np.array([*frequent.values()], np.float64)
    counts = counts[classes.singles :]
    borders = classes.borders

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _added(batches):
            g = values(batch, "block")[0] - GROUP
            own = Group(counts[borders[g] : borders[g + 1]])
            matrix = np.zeros(len(own.words) * TRIGGERS, np.int64)
            codes, found = np.frombuffer(values(batch, "data")[0], "<i8").reshape(2, -1)
            matrix[codes] = found
            own.learn(matrix.reshape(-1, TRIGGERS))
            yield _row(g, 0.0, b"".join(p.astype("<f4").tobytes() for p in own.parts()))

    groups = [Group(counts[a:b]) for a, b in zip(borders, borders[1:], strict=False)]
    for row in pairs.repartition(GROUPS // 4, "block").sortWithinPartitions("block").mapInArrow(run, ROW).collect() if groups else []:
        own, data, at = groups[row["block"]], np.frombuffer(bytes(row["data"]), "<f4"), 0
        made = []
        for part in own.parts():
            made.append(data[at : at + part.size].reshape(part.shape))
            at += part.size
        own.words, own.triggers, own.bias, own.norm = made
    return groups


@dataclass
class Fitted:
    vocabulary: DataFrame
    tokens: int
    distinct: int
    frequent: dict[bytes, int]
    rest_mass: float
    model: Model
    groups: list[Group]


def _frequent(vocabulary: DataFrame) -> dict[bytes, int]:
    """The words that get a number: seen SEEN times, FREQUENT of them at most, by falling count."""
    short = vocabulary.where((F.col("c") >= SEEN) & (F.length("word") <= WORD_BYTES))
    # How many words there are for each count, from the top; a count has few digits' worth of values.
    step = F.when(F.col("c") < 1000, F.col("c")).otherwise(F.floor(F.log10("c") * 1000) + 1_000_000)
    sizes = short.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    least, held = None, 0
    for row in sorted(sizes, key=lambda r: -r["least"]):
        held += row["n"]
        if held > FREQUENT:
            break
        least = row["least"]
    found = {bytes(r["word"]): r["c"] for r in short.where(F.col("c") >= least).collect()} if least else {}
    return dict(sorted(found.items(), key=lambda wc: (-wc[1], wc[0])))


def fit(train: DataFrame, rounds: int = ROUNDS) -> Fitted:
    """Counts of all words of train, and the model trained on all of it."""
    vocabulary = store.land(count(train), "vocabulary")
    row = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = row["n"], row["v"]
    frequent = _frequent(vocabulary)
    classes, counts = Classes(list(frequent)), np.array([*frequent.values()], np.float64)
    counted = int(counts.sum())
    # The rest class holds the other seen words, each with one count added, and one unseen word.
    rest_mass = float(tokens - counted + distinct - len(frequent) + 1)
    shares = np.bincount(classes.class_of, np.append(counts, tokens - counted), classes.rest + 1)
    model = initial(shares, classes.pad + 1)
    noise = ((shares + 1) / (shares + 1).sum()).astype(np.float64)
    pairs = None
    for i in range(rounds if tokens else 0):
        model, found = _train_round(train, list(frequent), noise, model, i)
        pairs = pairs or found
    groups = _fit_groups(pairs, frequent) if pairs is not None else [Group(counts[classes.singles :][a:b]) for a, b in zip(classes.borders, classes.borders[1:], strict=False)]
    return Fitted(vocabulary, tokens, distinct, frequent, rest_mass, model, groups)


class GroupScorer:
    """log10 probabilities of words in their group, by trigger."""

    def __init__(self, classes: Classes, groups: list[list[np.ndarray]]):
        parts = [np.concatenate(p) for p in zip(*groups, strict=True)] if groups else [np.zeros((0, GROUP_WIDTH), np.float32)] * 2 + [np.zeros(0, np.float32)] * 2
        self.words, self.triggers, self.bias, self.norm = parts
        self.group = classes.class_of[classes.singles : classes.none] - classes.singles

    def __call__(self, word: np.ndarray, trigger: np.ndarray) -> np.ndarray:
        out = np.empty(len(word), np.float64)
        for at in range(0, len(word), 16384):
            w = word[at : at + 16384]
            context = self.group[w] * TRIGGERS + trigger[at : at + 16384]
            out[at : at + 16384] = np.einsum("nd,nd->n", self.words[w], self.triggers[context]) + self.bias[w] - self.norm[context]
        return out / np.log(10)


class Scorer:
    """log10 probabilities of classes; normalisers by context, from batched matrix products, are kept once known."""

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.context)
        self.known = np.full(self.width**CONTEXT, np.nan, np.float32)

    def __call__(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        code = before[:, 0]
        for i in range(1, CONTEXT):
            code = code * self.width + before[:, i]
        lacking = np.unique(code[np.isnan(self.known[code])])
        for at in range(0, len(lacking), 2048):
            part = lacking[at : at + 2048]
            rows = np.stack([part // self.width ** (CONTEXT - 1 - i) % self.width for i in range(CONTEXT)], axis=1)
            scores = self.model.scores(rows)
            top = scores.max(axis=1)
            self.known[part] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        out = np.empty(len(after), np.float64)
        for at in range(0, len(after), 16384):  # stays in the processor's cache
            a, b = before[at : at + 16384], after[at : at + 16384]
            hidden = self.model.predicted(a)
            out[at : at + 16384] = np.einsum("nd,nd->n", hidden, self.model.target[b]) + self.model.bias[b]
        return (out - self.known[code]) / np.log(10)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_frequent long, log_frequent double, log_class double, n_rest long, rare array<struct<word:binary,tf:int>>"


def score(docs: DataFrame, fitted: Fitted, held_out: Column) -> DataFrame:
    """One row a document: tokens, known tokens, log10 probability under the unigram base and under the model."""
    spark = docs.sparkSession
    # Frequent words by falling count.
    counts = np.array([*fitted.frequent.values()], np.float64)
    sent = spark.sparkContext.broadcast((list(fitted.frequent), counts, fitted.model.parts(), [g.parts() for g in fitted.groups]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts, parts, groups = sent.value
        classes, scorer = Classes(frequent), Scorer(Model(*parts))
        in_group = GroupScorer(classes, groups)
        logs = np.append(np.log10(counts + 1), 0.0)
        for batch in slices(batches, 200):
            found, first, tokens = classes.numbers(raw(batch, "text"))
            ids = classes.class_of[found]
            scores = scorer(contexts(np.minimum(ids, classes.other), first, classes.pad), ids)
            at, word, trigger = classes.grouped(found, ids, first)
            scores[at] += in_group(word, trigger)
            sizes = np.array([len(t) for t in tokens], np.int64)
            starts = np.cumsum(sizes) - sizes
            rare, rare_tf, ends = [], [], [0]
            lacking = found == classes.none
            at = np.cumsum(lacking)
            flat = list(compress(chain.from_iterable(tokens), lacking.tolist()))
            for low, high in zip((at[starts] - lacking[starts]).tolist(), at[starts + sizes - 1].tolist(), strict=True):
                tf = Counter(flat[low:high])
                rare.extend(tf)
                rare_tf.extend(tf.values())
                ends.append(len(rare))
            pairs = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(rare_tf, pa.int32())], ["word", "tf"])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0).cast(pa.int64()),
                    "held_out": batch.column(2),
                    "n_tokens": pa.array(sizes),
                    "n_frequent": pa.array(sizes - np.add.reduceat(lacking.astype(np.int64), starts)),
                    "log_frequent": pa.array(np.add.reduceat(logs[found], starts)),
                    "log_class": pa.array(np.add.reduceat(scores, starts)),
                    "n_rest": pa.array(np.add.reduceat(lacking.astype(np.int64), starts)),
                    "rare": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                }
            )

    first = docs.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(run, SCORED)
    staged = store.land(first.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = staged.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.tf")
    found = rare.join(fitted.vocabulary, "word").groupBy("row").agg(
        F.sum("tf").alias("n_rare"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("log_rare")
    )
    joined = staged.drop("rare").join(found, "row", "left").fillna(0, ["n_rare", "log_rare"])
    n, mass = F.col("n_tokens"), float(np.log10(fitted.tokens + fitted.distinct + 1))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_frequent") + F.col("n_rare")).alias("n_known"),
        F.lit(fitted.tokens).cast("long").alias("train_tokens"),
        (F.col("log_frequent") + F.col("log_rare") - n * mass).alias("base_score"),
        (F.col("log_class") + F.col("log_rare") - F.col("n_rest") * float(np.log10(fitted.rest_mass))).alias("score"),
    )


def train_and_score(docs: DataFrame, modulus: int = 7, held: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """Learn from documents whose remainder is not `held`, score all."""
    held_out = id_remainder("doc_id", modulus) == held
    fitted = fit(docs.where(~held_out).select("doc_id", "text"), rounds)
    return score(docs, fitted, held_out)
