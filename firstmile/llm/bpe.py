"""BPE encoding and decoding: a priority queue of merge ranks over a doubly linked symbol list.

`merge` is the algorithm: symbols of a word in a linked list, every neighbouring
pair with a merge rank in a heap, the lowest rank first (the leftmost of equals).
An entry whose two symbols have changed since is stale and skipped. A word's ids
do not depend on its neighbours, so a bounded cache holds those of frequent words.

The text passes the steps that the vocabulary file names: added tokens are cut
out, then NFC, white space, lower case, splitting, bytes to symbols. The file's
content travels with the job; executors need no copy of it.

Decoding concatenates vocabulary strings, joined by one space as the library does
for a file without a decoder. NULL text counts as empty: no ids. Rows are
independent; repeated rows give equal rows, other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from firstmile.llm.columns import portions, values

CACHE = 600_000
#: Bytes of text whose distinct words a task holds at a time.
PORTION = 8 << 20
#: The same where the ids themselves come out.
IDS_PORTION = 4 << 20
#: What `normal` does: NFC, runs of white space as one space, lower case.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: White space, so no word starts with it.
MARK = "\n"
#: White space of the Unicode standard. str.split() also splits at the separators U+001C to U+001F.
WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
NOT_WHITE = re.compile(r"[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where printable, else one counted up from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


class Bpe:
    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"] or ""
        steps = (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]])
        if [s and s["type"] for s in steps] != NORMALIZERS:
            raise ValueError(f"{[s and s['type'] for s in steps]}: the normalizers known are {NORMALIZERS}")
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.mark = os.path.commonprefix(list(self.added))
        self.names = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.added.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        symbols = byte_symbols()
        self.inner = [self.vocab.get(c) for c in symbols]
        self.final = [self.vocab.get(c + self.suffix) for c in symbols]
        # By rank: the two symbols of a merge and what they become. A pair of symbols is one number.
        self.left, self.right = [self.vocab[a] for a, _ in merges], [self.vocab[b] for _, b in merges]
        self.becomes = [self.vocab[a + b] for a, b in merges]
        self.rank = {a << 32 | b: i for i, (a, b) in enumerate(zip(self.left, self.right, strict=True))}
        self.cache: dict[str, tuple[str, int, str]] = {}

    def merge(self, word: str) -> list[int]:
        """Ids of one word. A queue entry is rank * n + place: the lowest rank first, then the leftmost place."""
        data = word.encode()
        n, rank = len(data), self.rank.get
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        if n == 1:
            return ids
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [r * n + i for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            r, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if j < 0 or ids[i] != self.left[r] or ids[j] != self.right[r]:
                continue  # stale: one of the two has been merged since
            ids[i], ids[j] = self.becomes[r], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(queue, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(queue, r * n + h)
        return [x for x in ids if x >= 0]

    def normal(self, text: str) -> list[str]:
        """Lower-case words between white space, as NFC."""
        if not text.isascii():
            # Lower case goes letter by letter: a capital sigma has one small form, wherever it stands.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return [w for w in WHITE.split(text) if w] if NOT_WHITE.search(text) else text.split()

    def _piece(self, piece: str) -> tuple[str, int, str]:
        found = self.cache.get(piece)
        if found is None:
            ids = self.merge(piece)
            found = " ".join(map(str, ids)), len(ids), " ".join(map(self.names.__getitem__, ids))
            if len(piece) <= 64:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[piece] = found
        return found

    def word(self, word: str) -> tuple[str, int, str]:
        """A word's ids in decimal, how many, and the text decoded from them."""
        pieces = self.pattern.findall(word)
        if len(pieces) == 1:
            return self._piece(pieces[0])
        if not pieces:
            return "", 0, ""
        ids, n, names = zip(*map(self._piece, pieces), strict=True)
        return " ".join(ids), sum(n), " ".join(names)

    def words(self, text: str) -> list[str]:
        """Normal words of a text, added tokens as they stand between them."""
        if not (self.cut and self.mark in text):
            return self.normal(text)
        out = []
        for k, piece in enumerate(self.cut.split(text)):
            # An added token's mark keeps it apart from a word that reads the same.
            out += [MARK + piece] if k % 2 else self.normal(piece)
        return out

    def parts(self, texts: list[list[str]]) -> list[list[tuple[str, int, str]]]:
        """For each text the parts of its words. A word of several texts is encoded once."""
        table = {}
        for w in set(chain.from_iterable(texts)):
            table[w] = (str(self.added[w[1:]]), 1, w[1:]) if w[0] == MARK else self.word(w)
        return [[p for p in map(table.__getitem__, t) if p[1]] for t in texts]

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self.parts([self.words(text)])[0] for i in p[0].split(" ")]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.names[i] for i in ids)


def digest(docs: DataFrame, definition: str) -> DataFrame:
    """Per document: number of ids, hash of the ids in decimal, hash of the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(definition)
        for batch in portions(batches, "text", PORTION):
            counts, ids, decoded = [], [], []
            for parts in bpe.parts([bpe.words(t or "") for t in values(batch, "text")]):
                a, n, b = zip(*parts, strict=True) if parts else ((), (), ())
                counts.append(sum(n))
                ids.append(hashlib.sha256(" ".join(a).encode()).hexdigest())
                decoded.append(hashlib.sha256(" ".join(b).encode()).hexdigest())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0).cast(pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokenize(docs: DataFrame, definition: str) -> DataFrame:
    """doc_id, n_tokens, the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(definition)
        for batch in portions(batches, "text", IDS_PORTION):
            ids = [
                np.fromstring(" ".join([p[0] for p in parts]), np.int32, sep=" ")
                for parts in bpe.parts([bpe.words(t or "") for t in values(batch, "text")])
            ]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0).cast(pa.int64()), "n_tokens": pa.array(map(len, ids), pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32()))}
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")
