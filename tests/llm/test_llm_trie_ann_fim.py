"""Prefix trie, nearest neighbours and fill-in-middle against plain versions, and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from firstmile.llm import ann, fim, trie

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_nodes(rows):
    """The trie as a dictionary from sequences of turns to members."""
    given = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            given[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [t[-1] for t in sorted(found)] for c, found in given.items()}
    rebuilt = {}
    for c, turns in own.items():
        lent = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - int(math.fmod(c, 20)), [])[:lent] + turns[lent:]
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(c)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, held in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += children[path] == 0
            saved[path[:depth]] += (len(held) - 1) * len(WORD.findall(path[-1][1])) if path else 0
    out = []
    for path, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(rebuilt[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(held), len(path), parent, len(held), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def odd_turns():
    draw = random.Random(3)
    rows = [
        (c, turn, draw.choice(["u", "a", None]), draw.choice(["x", "y z", None, "", "p q r"]))
        for c in range(-45, 90)
        for turn in draw.choices([None, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11], k=draw.randint(1, 14))
    ]
    copies = [(c, t, "u", f"same {t}") for c in range(200, 320) for t in range(9)]
    return rows + copies + [(None, 1, "u", "x"), (500, 1, "u", "long " * 50_000)]


CASES = {
    "odd": odd_turns(),
    "a turnless conversation": [(7, 1, "u", "a b"), (7, 2, "a", "c"), (21, 1, "u", "q")],
    "repeated rows": [(5, 0, "u", "x y")] * 9,
    "a long conversation": [(40, t, "u", f"w{t % 7}") for t in range(700)] + [(41, t, "u", f"w{t % 7}") for t in range(350)],
}


@pytest.mark.parametrize("name", list(CASES))
def test_trie_against_a_dictionary(spark, name):
    rows = CASES[name]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.withColumns({c: F.lit("x") for c in ("conv", "depth", "t", "k", "turns", "x", "_range", "place")})
    assert sorted(map(tuple, trie.nodes(df).collect()), key=str) == plain_nodes(rows)


@pytest.mark.parametrize("block", [1, 3, 16])
def test_blocks_of_any_length_give_the_same_trie(spark, block):
    rows = odd_turns()[:600]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, trie.nodes(df, block).collect()), key=str) == plain_nodes(rows)


def test_ids_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 40)
    rows = CASES["odd"]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, trie.nodes(df).collect()), key=str) == plain_nodes(rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie.nodes(df).collect() == []
    assert trie.nodes(spark.createDataFrame([(None, 1, "u", "x")], df.schema)).collect() == []


def product(v, w):
    """Added one by one: `sum` corrects its rounding."""
    total = 0.0
    for x, y in zip(v, w, strict=True):
        total += x * y
    return total


def plain_nearest(rows, k=20):
    """Every product of each query, sorted. No libraries of the operator."""
    fit = lambda v: bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows if i is not None and v is not None and fit(v)))
    out = []
    for i, v in rows:
        if i % 20 == 0:
            found = sorted((-product(v, w), j) for j, w in rows if j != i and len(w) == len(v))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(found[:k], start=1)]
    return sorted(out)


def points(n, length, seed, spread=1.0):
    draw = np.random.default_rng(seed)
    return [(int(i), v.tolist()) for i, v in enumerate(draw.standard_normal((n, length)) * draw.uniform(1 / spread, spread, (n, 1)))]


def recall(found, wanted):
    return len({r[:3:2] for r in found} & {r[:3:2] for r in wanted}) / max(1, len(wanted))


def test_chi_square():
    assert ann.chi_square(ann.radius(8, 0.98), 8) == pytest.approx(0.98)
    assert ann.radius(2, 0.95) == pytest.approx(-2 * math.log(0.05))
    draws = np.square(np.random.default_rng(0).standard_normal((20_000, 8))).sum(1)
    assert np.mean(draws <= ann.radius(8, 0.9)) == pytest.approx(0.9, abs=0.01)


@pytest.mark.parametrize("spread", [1.0, 3.0])
def test_recall_of_the_stopping_test(spark, spread):
    rows = points(3000, 24, 5, spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    wanted = plain_nearest(rows)
    found = [tuple(r) for r in ann.nearest(df, cell_rows=300).collect()]
    assert len(found) == len(wanted) and recall(found, wanted) >= 0.95
    assert {(r[0], r[1]) for r in found} == {(r[0], r[1]) for r in wanted}
    scores = {(i, j): s for i, _, j, s in wanted}
    assert all(scores[i, j] == s for i, _, j, s in found if (i, j) in scores)


def test_a_certain_stopping_test_finds_all(spark):
    rows = points(1500, 12, 6, 2.0)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ann.nearest(df, cell_rows=200, confidence=1 - 1e-12).collect())) == plain_nearest(rows)


def test_odd_vectors(spark):
    rows = [(i, [float((i * 7) % 11), float(i % 5), 1.0]) for i in range(200)]
    rows += [(1000 + i, [1.0, 2.0]) for i in range(100)] + [(2000 + i, [3.0, 3.0, 3.0]) for i in range(60)]
    rows += [(0, [0.0, 0.0, 1.0])] * 3 + [(20, None), (None, [1.0, 2.0]), (40, []), (60, [0.0, -0.0]), (80, [1.0, None])]
    rows += [(81, [1.0, math.nan]), (100, [math.inf, 1.0]), (-20, [-0.0, 9.0, 3.0]), (6000, [1.0] * 5), (6001, [2.0] * 5), (6020, [2.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.withColumns({c: F.lit("x") for c in ("key", "id", "vec", "cell", "length", "ids")})
    found = sorted(map(tuple, ann.nearest(df, confidence=1 - 1e-12).collect()))
    assert found == plain_nearest(rows)
    assert [r for r in found if r[0] == 6000] == [(6000, 1, 6001, 10.0)] and not [r for r in found if r[0] == 6020]


def test_huge_and_tiny_vectors(spark):
    rows = [(i, [1e-200 * (i + 1), 1e-210, 0.0]) for i in range(50)] + [(100 + i, [1e200, 1e190 * i, 1.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [tuple(r) for r in ann.nearest(df).collect()]
    assert collections.Counter(r[0] for r in found) == {i: 20 for i, _ in rows if i % 20 == 0}


def test_nearest_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df).collect() == []
    assert ann.nearest(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")).collect() == []


def plain_fim(doc_id, text, rate=100):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    drawn = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    drawn = [int(drawn[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or drawn[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    if drawn[3] % 100 < 50:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


TEXTS = ["a\nb", None, "", "x<P>y", "\n\n", "no break", "no break", "é\n\n漢\n😀 x\n", "a<\n<S\nb>\n<\nM>\nq", "<M\n>\n<M", "line\n" * 60_000, "\r\n\x0b\n"]


@pytest.mark.parametrize("rate", [100, 30])
def test_fill_in_middle_against_a_plain_version(spark, rate, monkeypatch):
    monkeypatch.setattr(fim, "PORTION", 1000)
    rows = [(i * 12 + k, t) for i in range(12) for k, t in enumerate(TEXTS)] + [(None, "a\nb\nc"), (3, "x\ny")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("n", "w", "h0", "c0", "form", "extra")})
    found = fim.fill_in_middle(df, rate=rate)
    assert found.columns == ["doc_id", "text", "w", "h0", "c0", "extra", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored().alias("back"), "text").collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((plain_fim(i, t, rate) for i, t in rows), key=str)
    assert all(r["back"] == (r["text"] or "") for r in got)


def test_fill_in_middle_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digest(df).collect() == [] and fim.digest(df).columns[-1] == "restored_sha256"
