"""Each query on whole small tables against a plain version of its definition."""

import hashlib
import html as entities
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
import public_tokenizers
import xxhash
from compare import differences, duck
from conftest import SMALL
from tokenizers import Tokenizer

import __spark_entry__ as entry
from firstmile.llm import bpe, decontam, lm, pii, queries, shard, simhash

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def result(spark, name, key="doc_id"):
    return {r[key]: r for r in queries.queries()[name](spark, SMALL).collect()}


def remainder(i, n):
    return zlib.crc32(str(i).encode()) % n


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


def test_quality_rules_match_sql(spark):
    name = "op4_quality_rules"
    assert differences(queries.queries()[name](spark, SMALL), duck(SMALL), queries.oracle_sql()[name]) == []


def test_lm_base_and_gain(spark, docs):
    tokens = {i: [*WHITE.findall(lowered(r["text"])), None] for i, r in docs.items()}
    counts = Counter(t for i, ts in tokens.items() if remainder(i, 7) != 2 for t in ts)
    n, v = sum(counts.values()), len(counts)
    found = result(spark, "op1_lm_scoring")
    assert set(found) == set(docs)
    for i, r in found.items():
        assert (r["n_tokens"], r["train_tokens"]) == (len(tokens[i]), n)
        assert r["held_out"] == (remainder(i, 7) == 2)
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens[i])
        assert r["base_score"] == pytest.approx(sum(log10((counts[t] + 1) / (n + v + 1)) for t in tokens[i]))
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_probabilities_sum_to_one(spark, docs):
    train = spark.createDataFrame([(i, r["text"]) for i, r in docs.items()], "doc_id long, text string").limit(60)
    fitted = lm.fit(train, rounds=1)
    classes = lm.Classes(list(fitted.frequent))
    assert classes.singles == lm.SINGLES and classes.groups == lm.GROUPS
    k, other, pad = classes.rest, classes.other, classes.pad
    before = np.array([[pad, pad], [0, pad], [other, 3], [5, other]])
    scorer = lm.Scorer(fitted.model)
    total = sum(10 ** scorer(before, np.full(4, c)) for c in range(k + 1))
    assert total == pytest.approx(np.ones(4), abs=1e-4)
    # A group shares itself out over its words, whatever the trigger.
    in_group = lm.GroupScorer(classes, [g.parts() for g in fitted.groups])
    for g, trigger in ((0, 3), (7, lm.TRIGGERS - 1), (lm.GROUPS - 1, 0)):
        words = np.arange(classes.borders[g], classes.borders[g + 1])
        assert len(words) and (10 ** in_group(words, np.full(len(words), trigger))).sum() == pytest.approx(1, abs=1e-4)
    # The rest class shares itself out over its words and one unseen word.
    rest = fitted.vocabulary.where(~fitted.vocabulary["word"].isin([bytearray(w) for w in fitted.frequent])).collect()
    assert sum(r["c"] + 1 for r in rest) + 1 == fitted.rest_mass
    assert all(r["c"] < lm.SEEN or len(r["word"]) > lm.WORD_BYTES for r in rest)


def test_lm_classes_and_triggers():
    frequent = [b"", *(f"w{i}".encode() for i in range(1, 2000))]
    classes = lm.Classes(frequent)
    assert classes.class_of[0] == 0 and classes.class_of[-1] == classes.rest and len(classes.class_of) == 2001
    sizes = np.bincount(classes.class_of)[classes.singles : classes.rest]
    assert sizes.sum() == 2000 - lm.SINGLES and sizes.max() - sizes.min() <= 1 and (np.diff(classes.borders) == sizes).all()
    texts = [b"w900 w3 x w901 w200 w1999", b"w1500", None, b"w5 w900 unseen"]
    numbers, first, _ = classes.numbers(texts)
    at, word, trigger = classes.grouped(numbers, classes.class_of[numbers], first)
    none = lm.TRIGGERS - 1
    assert [(int(w) + lm.SINGLES, int(t)) for w, t in zip(word, trigger)] == [(900, none), (901, 3), (1999, 3), (1500, none), (900, 5)]
    assert numbers[at].tolist() == [900, 901, 1999, 1500, 900]
    few = lm.Classes([b"", b"a"])
    assert (few.singles, few.groups, few.rest) == (2, 0, 2) and lm.GroupScorer(few, [])(np.array([], int), np.array([], int)).size == 0


def test_lm_groups_learn_which_words_follow_a_trigger():
    draw = np.random.default_rng(4)
    likes = draw.integers(0, 4, 200)
    pairs = draw.poisson(np.where(likes[:, None] == np.arange(lm.TRIGGERS)[None] % 4, 3.0, 0.1))
    group = lm.Group(pairs.sum(axis=1).astype(float))
    plain = -group.norm
    before = (pairs * (group.scores() + plain)).sum() / pairs.sum()
    group.learn(pairs)
    after = (pairs * (group.scores() - group.norm)).sum() / pairs.sum()
    assert np.exp(group.scores() - group.norm).sum(axis=0) == pytest.approx(np.ones(lm.TRIGGERS), abs=1e-3)
    assert after - before > 0.8  # of log(4) = 1.39 at most


def test_lm_words_with_vectors(spark, docs):
    """All but few tokens have a vector; more of them than FREQUENT are cut by their counts."""
    train = spark.createDataFrame([(i, r["text"]) for i, r in docs.items()], "doc_id long, text string")
    vocabulary = lm.count(train).cache()
    counts = {bytes(r["word"]): r["c"] for r in vocabulary.collect()}
    found = lm._frequent(vocabulary)
    assert found == {w: c for w, c in counts.items() if c >= lm.SEEN and len(w) <= lm.WORD_BYTES}
    assert list(found.values()) == sorted(found.values(), reverse=True)


def test_lm_words_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 5)
    rows = [(w.encode(), c) for w, c in (("a", 90_000), ("b", 5000), ("c", 40), ("d", 40), ("e", 7), ("f", 7), ("g", 3), ("h", 2))]
    found = lm._frequent(spark.createDataFrame(rows, "word binary, c long"))
    assert found == {b"a": 90_000, b"b": 5000, b"c": 40, b"d": 40}
    assert lm._frequent(spark.createDataFrame(rows[-1:], "word binary, c long")) == {}


def test_language_is_found_in_held_out_texts(spark, docs):
    found = result(spark, "op2_language_id")
    held = [i for i, r in found.items() if r["held_out"]]
    assert set(held) == {i for i in docs if remainder(i, 3) == 1}
    assert all(0 <= r["score"] <= 1 for r in found.values())
    assert sum(found[i]["lang_pred"] == docs[i]["lang"] for i in held) / len(held) > 0.95


def plain_fingerprint(text):
    words = WHITE.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    items = sorted(fps.items())
    for k, (i, a) in enumerate(items):
        for j, b in items[:k]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def test_simhash(spark, docs):
    fps = {i: plain_fingerprint(r["text"]) for i, r in docs.items()}
    found = result(spark, "op3_simhash")
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(fps, 2)


@pytest.mark.parametrize("limit", [simhash.SHARD, 8])
def test_links_of_crowded_fingerprints(spark, monkeypatch, limit):
    """A ball of near fingerprints, so that many share their blocks; with a low limit they are dealt twice."""
    monkeypatch.setattr(simhash, "SHARD", limit)
    draw = np.random.default_rng(1)
    fps = {0}
    for _ in range(400):
        base = int(draw.choice(list(fps))) if draw.random() < 0.7 else int(draw.integers(1 << 62))
        for b in draw.choice(64, int(draw.integers(1, 4)), replace=False):
            base ^= 1 << int(b)
        fps.add(base & ((1 << 63) - 1))
    nodes = spark.createDataFrame([(f,) for f in fps], "_fp long")
    expected = plain_components({f: f for f in fps}, 2)
    pairs = [(r["u"], r["v"]) for r in simhash.links(nodes).collect()]
    assert all((u ^ v).bit_count() <= 64 and u != v for u, v in pairs)
    root = {f: f for f in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in pairs:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    assert {f: find(f) for f in fps} == expected


def test_token_files(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found, start = result(spark, "op5_token_output"), 0
    for i in sorted(docs):
        ids = np.array([*library.encode(docs[i]["text"], add_special_tokens=False).ids, 0], "<u4")
        r = found[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_bpe(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = result(spark, "op8_bpe")
    for i, r in docs.items():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize("text", ["", " a\x1cb\x85c ", "ΑΣ Σ's İ'LL", "x<|endoftext|>y <|startoftext|>", "中文９½² !!a1b2", "naïve café", "a" * 300])
def test_bpe_on_odd_texts(text):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own = bpe.Bpe(queries.tokenizer_file("word_bpe_49k.json"))
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def plain_base(text):
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.ORDER[s[2]]))


def test_pii(spark, docs):
    found = result(spark, "op6_pii")
    for i, r in docs.items():
        base = plain_base(r["text"])
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert found[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [found[i][f"n_{k}"] for k in pii.BASE] == [sum(s[2] == k for s in base) for k in pii.BASE]
        assert set(filter(None, text.split(","))) <= set(found[i]["spans"].split(","))


def test_decontamination(spark, docs):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    words = {k: decontam.words(t) for k, t in items.items()}
    df = Counter(w for ws in words.values() for w in set(ws))
    mean = sum(map(len, words.values())) / len(words)
    weight = {}
    for k, ws in words.items():
        norm = decontam.K1 * (1 - decontam.B + decontam.B * len(ws) / mean)
        w = {t: np.log(1 + (len(items) - df[t] + 0.5) / (df[t] + 0.5)) * n * (decontam.K1 + 1) / (n + norm) for t, n in Counter(ws).items()}
        weight[k] = {t: x / sum(w.values()) for t, x in w.items()}
    expected = set()
    for i, r in docs.items():
        own = decontam.words(r["text"])
        for k, w in weight.items():
            longest = max(decontam.SHORTEST, 1 << (len(words[k]) - 1).bit_length())
            for at in range(0, max(1, len(own) - longest), longest):
                if sum(w.get(t, 0) for t in set(own[at : at + 2 * longest])) >= decontam.THRESHOLD - 1e-9:
                    around = own[max(0, at - len(words[k])) : min(len(own), at + 2 * longest) + len(words[k])]
                    parts = decontam.question_and_answer(items[k])
                    if all(decontam.overlap(p, around) >= decontam.OVERLAP for p in parts):
                        expected.add((i, k))
    found = queries.op7_decontamination(spark, SMALL).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == expected
    assert len(found) == len(expected)
    assert {(i, k) for i, r in docs.items() for k, t in items.items() if t in r["text"]} <= expected


def test_wand_equals_full_scoring():
    draw = np.random.default_rng(3)
    items = [(k, " ".join(f"w{x}" for x in draw.zipf(1.3, int(draw.integers(3, 60))) % 200)) for k in range(300)]
    df = Counter(w for _, t in items for w in set(decontam.words(t)))
    index = decontam.Index(items, df, len(items), 30.0)
    for _ in range(200):
        query = sorted({index.word[w] for w in (b"w%d" % x for x in draw.integers(0, 200, 40)) if w in index.word})
        for cls in index.classes:
            scores = Counter()
            for w in query:
                for k, x in zip(*cls.postings.get(w, ([], [], []))[:2], strict=True):
                    scores[k] += x
            found = dict(decontam.wand(cls, query, 0.3))
            assert set(found) == {k for k, x in scores.items() if x >= 0.3 - 1e-9}
            assert all(found[k] == pytest.approx(scores[k]) for k in found)


def test_html(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = result(spark, "op9_html", "page_id")
    assert set(found) == set(pages)
    for i, r in pages.items():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.DOTALL)[1]
        blocks = (" ".join(entities.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        text = "\n".join(b for b in blocks if b)
        assert (found[i]["text"], found[i]["n_chars"], found[i]["url"]) == (text, len(text), r["url"])


def test_shards(spark, docs):
    found = result(spark, "op10_sharding")
    assert set(found) == set(docs)
    by_shard = {}
    for i, r in found.items():
        text = docs[i]["text"].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by_shard.get(s, [])) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_communication_matrix_is_exact_and_uniform():
    counts = [0, 7, 100, 3, 50]
    total = np.zeros((5, 4))
    for seed in range(400):
        m = shard.communication_matrix(counts, 4, seed)
        assert m.sum(axis=1).tolist() == counts
        assert m.sum(axis=0).tolist() == [40, 40, 40, 40]
        total += m
    assert total / 400 == pytest.approx(np.array(counts)[:, None] / 4 * np.ones((5, 4)), abs=0.6)
