"""Plain versions that share no code with the operators: language profiles, decontamination, the whole pipeline."""

import re
import zlib
from collections import Counter, defaultdict
from math import log

import public_tokenizers
import pytest
import xxhash
from conftest import SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from firstmile.llm import pii, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = re.compile(r"[\x20\x09-\x0D]+")
PUNCTUATION = re.compile("[!-/:-@\\[-`{-~]")


@pytest.fixture(scope="module")
def docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def items(spark):
    return {(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if r["text"]}


# --- language profiles -----------------------------------------------------------------


def grams(text):
    """Counts of n-grams of 1 to 3 letters, words in lower case between spaces."""
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    found = Counter()
    for word in letters.split():
        spaced = f" {word} "
        found.update(word)
        found.update(spaced[i : i + 2] for i in range(len(spaced) - 1))
        found.update(spaced[i : i + 3] for i in range(len(spaced) - 2))
    return found


def ranked(found):
    """The 300 most frequent, of equal ones the shorter, then the smaller by code points."""
    order = sorted(found, key=lambda g: (-found[g], len(g), [ord(c) for c in g]))
    return {g: i for i, g in enumerate(order[:300])}


def test_language_profiles(spark, docs):
    counts = defaultdict(Counter)
    for r in docs:
        if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["lang"] is not None:
            counts[r["lang"]].update(grams(r["text"] or ""))
    profiles = {lang: ranked(c) for lang, c in sorted(counts.items()) if c}
    found = {r["doc_id"]: r for r in queries.op2_language_id(spark, SMALL).collect()}
    assert len(found) == len(docs)
    for r in docs:
        own = ranked(grams(r["text"] or ""))
        got = found[r["doc_id"]]
        if not own:
            assert (got["lang_pred"], got["score"]) == ("und", 0.0)
            continue
        distance = {lang: sum(abs(i - p[g]) if g in p else 300 for g, i in own.items()) for lang, p in profiles.items()}
        best = min(distance, key=lambda lang: (distance[lang], lang))
        assert got["lang_pred"] == best
        assert got["score"] == pytest.approx(1 - distance[best] / (300 * len(own)), abs=1e-12)


# --- decontamination -------------------------------------------------------------------


def plain_words(text):
    return PUNCTUATION.sub(" ", (text or "").lower()).encode().split()


def question_answer(text):
    """What stands before and after the last `Answer:`, else the last question mark that something follows."""
    text = text.strip()
    marks = [(m.start(), m.end()) for m in re.finditer(r"(?i)\banswer\s*:", text)]
    if not marks:
        marks = [(m.end(), m.end()) for m in re.finditer(r"\?(?=.)", text, re.DOTALL)]
    if not marks:
        return [plain_words(text)]
    parts = [plain_words(text[: marks[-1][0]]), plain_words(text[marks[-1][1] :])]
    return [p for p in parts if p]


def held(part, around):
    """Whether half of a part's shingles are there, or of a short part more than half its words in a stretch one word longer."""
    if len(part) > 7:
        three = lambda ws: {tuple(ws[i : i + 3]) for i in range(len(ws) - 2)}
        return 2 * len(three(part) & three(around)) >= len(three(part))
    width = len(part) + 1
    stretches = [around[i : i + width] for i in range(max(1, len(around) - width + 1))]
    return any(2 * sum((Counter(part) & Counter(s)).values()) > len(part) for s in stretches)


def leaks(texts, items):
    """(key, item) of every text that a window retrieves by BM25 and the overlap confirms."""
    known = {k: plain_words(k[1]) for k in items}
    known = {k: ws for k, ws in known.items() if ws}
    frequency = Counter(w for ws in known.values() for w in set(ws))
    mean = sum(map(len, known.values())) / max(1, len(known))
    weights = {}
    for k, ws in known.items():
        own = {}
        for w, n in Counter(ws).items():
            rarity = log(1 + (len(known) - frequency[w] + 0.5) / (frequency[w] + 0.5))
            own[w] = rarity * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean))
        weights[k] = {w: x / sum(own.values()) for w, x in own.items()}
    out = set()
    for key, text in texts:
        own = plain_words(text)
        for k, ws in known.items():
            stride = 16
            while stride < len(ws):
                stride *= 2
            for at in range(0, max(1, len(own) - stride), stride):
                if sum(weights[k].get(w, 0) for w in set(own[at : at + 2 * stride])) < 0.5 - 1e-9:
                    continue
                around = own[max(0, at - len(ws)) : min(len(own), at + 2 * stride) + len(ws)]
                if all(held(p, around) for p in question_answer(k[1])):
                    out.add((key, k[0]))
    return out


def test_decontamination(spark, docs, items):
    found = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, SMALL).collect()}
    assert found == leaks([(r["doc_id"], r["text"]) for r in docs], items)
    assert found


# --- the pipeline ----------------------------------------------------------------------

STOP = set(
    "the of and to a in is it for on with that this are was be by at from or as an not have you "
    "der die das und ist ein eine mit von zu im den für auf nicht sich des dem auch als "
    "le la les de du et en un une que qui est dans pour sur par pas avec des au "
    "el los las y una por con para no se lo al como del su es".split()
)


def good(text):
    words = WORD.findall(text or "")
    n = len(words)
    three = [tuple(words[i : i + 3]) for i in range(n - 2)]
    often = Counter(three)
    repeated = {i + k for i, t in enumerate(three) if often[t] > 1 for k in range(3)}
    if n < 50 or 100 * len(repeated) > 50 * n:
        return False
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    stop = sum(w.lower().rstrip(".,;:!?") in STOP for w in words)
    copies = len(lines) - len(set(lines))
    return 2 <= sum(map(len, words)) / n <= 14 and symbols / n <= 0.25 and stop / n >= 0.06 and copies / len(lines) <= 0.4


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    bits = Counter(b for s in shingles for b, on in enumerate(format(xxhash.xxh64_intdigest(s.encode(), 42), "064b")[::-1]) if on == "1")
    return sum(1 << b for b, n in bits.items() if 2 * n > len(shingles))


def one_of_each(rows):
    """The row with the smallest id of each component of fingerprints at most two bits apart."""
    prints = [fingerprint(r["text"]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r)
    return [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]


def test_the_whole_pipeline(spark, docs, items):
    kept = [r for r in docs if good(r["text"])]
    assert 0 < len(kept) < len(docs)
    single = one_of_each(kept)
    leaked = {i for i, _ in leaks([(r["doc_id"], r["text"]) for r in single], items)}
    clean = [(r["doc_id"], pii.redact_text(r["text"])) for r in single if r["doc_id"] not in leaked]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = sorted((i, library.encode(t, add_special_tokens=False).ids) for i, t in clean)
    found = sorted((r["doc_id"], list(r["ids"]), r["n_tokens"]) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert [(i, ids) for i, ids, _ in found] == expected and all(len(ids) == n for _, ids, n in found)
    # What each stage takes out, from its own input.
    stage = dict(corpus_pipeline.STAGES)
    whole = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(r["doc_id"] for r in stage["quality"](spark, whole, SMALL).collect()) == sorted(r["doc_id"] for r in kept)
    assert sorted(r["doc_id"] for r in stage["near_duplicates"](spark, whole, SMALL).collect()) == sorted(r["doc_id"] for r in one_of_each(docs))
