"""Token ids as binary blocks: a shared zstandard dictionary, one frame a document, an offset index.

Documents are encoded, compressed one by one with a dictionary trained on
serialized id arrays, dealt by ranges of doc_id and written as blocks. A block
is one row of a Parquet table: a payload of frames end to end, and beside it the
index (doc_id, offset, number of ids) and the hash of the dictionary. The table is
written by Spark, so it works on every store that Spark reaches, and a lost
executor's files never come into the result. The dictionary is the one row of a
second table. `read_document` opens one document: Parquet statistics find its
block, the index its frame.

Every document ends with id 0. The dictionary is fitted on a bounded sample
(`SAMPLE` documents, the smallest by hash of the id, `SAMPLE_IDS` ids of each);
every document is written whole.

NULL text counts as empty (one id, the end). Repeated rows are written once each, rows
of one id by number of ids and frame, or, where the id is hot, first by the digest of
their text. NULL ids come first. Other columns are not read. An empty table gives no block and no row.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firstmile.llm import store
from firstmile.llm.columns import portions, slices, values, whole_text

SAMPLE, SAMPLE_IDS, DICTIONARY_BYTES = 4000, 4096, 65536
BLOCK_BYTES = 4 << 20
#: Bytes of text that a task encodes at a time.
PORTION = 14 << 20
#: Punctuation that never starts or continues a contraction.
TAIL = ".,;:!?#*$%&"
#: Words whose ids an encoder keeps from one portion to the next, and the bytes of their ids.
KNOWN, KNOWN_BYTES = 600_000, 32 << 20
LEVEL = 3
END = 0
#: Documents of one range; a range is one task and at least one block.
RANGE_ROWS = 50_000


def _gather(ids: np.ndarray, begin: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ids[begin[k] : begin[k] + sizes[k]] for k in `at`, end to end, and where each ends."""
    each = sizes[at]
    ends = np.cumsum(each)
    return ids[np.repeat(begin[at] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)], ends


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, through the tokenizers library.

    Byte-level BPE never joins across a space that a visible character follows, a
    line break between visible characters, or the end of a run of letters before
    punctuation. The texts of a portion fall into words there, whose ids do not
    depend on their neighbours; each distinct word is encoded once, and numpy puts
    the texts together again. Texts with two spaces or breaks in a row are encoded
    in one go.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        names = self.tokenizer.get_vocab()
        # Byte-level vocabularies write a space and a line break as these letters.
        self.opens = {}
        for opener, letter in ((" ", "\u0120"), ("\n", "\u010a")):
            self.opens[opener] = np.zeros(max(names.values(), default=0) + 1, bool)
            self.opens[opener][[i for name, i in names.items() if name.startswith(letter)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.known_ids, self.known_sizes = pa.array([], pa.string()), np.empty(0, "<u4"), np.empty(0, np.int64)

    def _encode_known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As _encode_words after a space; words of earlier portions are looked up."""
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(pc.is_null(at))
        ids, sizes = self._encode_words(new, " ")
        place = pc.fill_null(at, -1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, new])
        self.known_ids, self.known_sizes = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_sizes, sizes])
        found, _ = _gather(self.known_ids, np.cumsum(self.known_sizes) - self.known_sizes, self.known_sizes, place)
        sizes = self.known_sizes[place]
        if len(self.known) > KNOWN or self.known_ids.nbytes > KNOWN_BYTES:
            self._forget()
        return found, sizes

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and each one's number of ids."""
        out, sizes = [np.empty(0, "<u4")], []
        for at in range(0, len(texts), 4096):  # the library's own results are large
            for x in self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False):
                out.append(np.array(x.ids, "<u4"))
                sizes.append(len(out[-1]))
        return np.concatenate(out), np.array(sizes, np.int64)

    def _encode_words(self, words: pa.Array, opener: str) -> tuple[np.ndarray, np.ndarray]:
        """As _encode for words of letters, each after the opener, as one text: a word begins at each id that starts with it."""
        out, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for at in range(0, len(words), 16384):
            some = words[at : at + 16384]
            text = opener + pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), opener)[0].as_py()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.opens[opener][ids])
            if len(cuts) == len(some):
                size = np.diff(np.append(cuts, len(ids)))
            else:  # a vocabulary that does not keep words apart
                ids, size = self._encode([opener + w for w in some.to_pylist()])
            out.append(ids)
            sizes.append(size)
        return np.concatenate(out), np.concatenate(sizes)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As _encode for distinct words, each after one space but for those that start with a line break."""
        stems = pc.utf8_rtrim(words, TAIL)
        # Only where a letter stands before it does punctuation stand by itself.
        apart = pc.utf8_is_alpha(pc.utf8_slice_codeunits(stems, -1))
        stems = pc.if_else(apart, stems, words)
        # Tails are of one byte a character, so their length tells where they start.
        tailed = pc.binary_length(words).to_numpy() - pc.binary_length(stems).to_numpy()
        _, ends, text = words.buffers()
        ends = np.frombuffer(ends, np.int32)[words.offset + 1 : words.offset + len(words) + 1].astype(np.int64)
        some, upto = _gather(np.frombuffer(text or b"", np.uint8), ends - tailed, tailed.astype(np.int64), np.arange(len(words)))
        places = np.concatenate(([0], upto)).astype(np.int32)
        tails = pa.Array.from_buffers(pa.string(), len(words), [None, pa.py_buffer(places), pa.py_buffer(some.tobytes())])
        stem, tail = stems.dictionary_encode(), tails.dictionary_encode()
        # Words of letters after a space, such words after a line break, other stems, and tails, in this order.
        all_stems = stem.dictionary
        broken = pc.starts_with(all_stems, "\n")
        bare = pc.if_else(broken, pc.utf8_slice_codeunits(all_stems, 1), all_stems)
        letters = pc.utf8_is_alpha(bare)
        kind = np.where(letters, np.where(broken, 1, 0), 2)
        parts = [
            self._encode_known(bare.filter(pa.array(kind == 0))),
            self._encode_words(bare.filter(pa.array(kind == 1)), "\n"),
            self._encode([w if w.startswith("\n") else " " + w for w in all_stems.filter(pa.array(kind == 2)).to_pylist()]),
            self._encode(tail.dictionary.to_pylist()),
        ]
        place = np.empty(len(kind), np.int64)
        place[np.argsort(kind, kind="stable")] = np.arange(len(kind))
        ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        both = np.empty(2 * len(words), np.int64)
        both[0::2] = place[stem.indices.to_numpy()]
        both[1::2] = len(kind) + tail.indices.to_numpy()
        joined, ends = _gather(ids, np.cumsum(sizes) - sizes, sizes, both)
        return joined, np.diff(np.concatenate(([0], ends[1::2])))

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text of a string array."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, r"[ \n][ \n]")
        cut = pc.split_pattern(pc.replace_substring(pc.if_else(whole, "", texts), "\n", " \n"), " ")
        offsets, flat = cut.offsets.to_numpy(), cut.values
        coded = flat.dictionary_encode()
        ids, sizes = self._words(coded.dictionary)
        # A text's first word has no space before it.
        first, first_sizes = self._encode(flat.take(pa.array(offsets[:-1])).to_pylist())
        piece = coded.indices.to_numpy().astype(np.int64)
        piece[offsets[:-1]] = len(sizes) + np.arange(len(texts))
        ids, sizes = np.concatenate([ids, first]), np.concatenate([sizes, first_sizes])
        joined, ends = _gather(ids, np.cumsum(sizes) - sizes, sizes, piece)
        data, cuts = joined.tobytes(), (4 * np.concatenate(([0], ends))[offsets]).tolist()
        out = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._encode([texts[i].as_py()])[0].tobytes()
        return out


@dataclass(frozen=True)
class TokenFile:
    blocks: str
    dictionary: str


def _sample(docs: DataFrame) -> DataFrame:
    """The texts of the SAMPLE documents with the smallest hash of the id, ties by content."""
    chosen = docs.select("doc_id", F.xxhash64("doc_id").alias("_h")).orderBy("_h", "doc_id").limit(SAMPLE)
    return docs.join(F.broadcast(chosen.select("doc_id").distinct()), docs["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")


def train_dictionary(docs: DataFrame, definition: str) -> bytes:
    """A zstandard dictionary over the sample's serialized ids; empty if the sample is too small for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(definition)
        for batch in portions(batches, "text", PORTION):
            yield pa.RecordBatch.from_pydict({"ids": pa.array([ids[: 4 * SAMPLE_IDS] for ids in encode(batch.column(0))], pa.binary())})

    # A third of all rows may share one id: the sample is cut again by content.
    rows = _sample(docs).select("text").orderBy(F.xxhash64("text"), "text").limit(SAMPLE)
    samples = [r["ids"] for r in rows.mapInArrow(run, "ids binary").orderBy("ids").collect() if r["ids"]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes, compress: bool = False) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    found = zstandard.ZstdCompressionDict(data)
    if compress:  # digested once, not for each frame
        found.precompute_compress(level=LEVEL)
    return found


def encode(docs: DataFrame, definition: str, dictionary: bytes) -> DataFrame:
    """range, doc_id, number of ids with the end, and the document's own compressed frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, squeeze = Encoder(definition), zstandard.ZstdCompressor(LEVEL, dict_data=_dictionary(dictionary, compress=True))
        end = np.array([END], "<u4").tobytes()
        for batch in portions(batches, "text", PORTION):
            ids = [x + end for x in ids_of(batch.column(2))]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": batch.column(0),
                    "doc_id": batch.column(1).cast(pa.int64()),
                    "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "frame": pa.array(map(squeeze.compress, ids), pa.binary()),
                }
            )

    return docs.select("range", "doc_id", "text").mapInArrow(run, "range int, doc_id long, n_tokens long, frame binary")


BLOCK = "range int, block int, first_id long, last_id long, doc_ids array<long>, offsets array<long>, n_tokens array<long>, dictionary_sha256 string, payload binary"


def _ranges(docs: DataFrame) -> tuple[Column, int]:
    """The range of a row of docs (doc_id, text), and how many ranges there are.

    Cut points come from the ids alone. An id that holds a good part of a range (all NULL
    ids are one) shows as a cut point that repeats. If it holds more, its rows are cut again by the digest
    of their text, and equal texts of it, which are interchangeable, by a salt. So no
    range is larger than its share for one id's or one text's sake.
    """
    spark, counted = docs.sparkSession, docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("known")).first()
    n, unknown = counted["n"], counted["n"] - counted["known"]
    parts = max(1, -(-n // RANGE_ROWS))
    least = spark.conf.get("spark.sql.shuffle.partitions", "200")
    parts = max(parts, min(int(least), -(-n // 1000))) if n else 1
    if parts == 1:
        return F.lit(0), 1
    # Quarters of a range tell which ids hold a good part of one.
    at = [i / (4 * parts) for i in range(1, 4 * parts)]
    fine = docs.select(F.percentile_approx("doc_id", at, 40 * parts).alias("c")).first()["c"] or []
    cuts, pieces, quarters = [], {}, 0
    for c in sorted(set(fine)):
        quarters += 1
        if (often := fine.count(c)) > 1:
            # Alone between two cut points, and cut itself.
            pieces[c], quarters = -(-(often + 1) // 4), 0
            cuts += [c, min(c + 1, 2**63 - 1)]
        elif quarters >= 4:
            quarters = 0
            cuts.append(c)
    if unknown * 4 * parts > n:
        pieces[None] = -(-unknown * parts // n)
    cuts, pieces = sorted(set(cuts)), {i: k for i, k in pieces.items() if k > 1}
    below = F.size(F.filter(F.lit(cuts).cast("array<bigint>"), lambda c: c <= F.col("doc_id")))
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(below + 1)
    if not pieces:
        return place, len(cuts) + 2
    tie = F.xxhash64("text")
    hot = F.coalesce(F.col("doc_id").isin([c for c in pieces if c is not None]), F.lit(None in pieces))
    same = docs.where(hot).groupBy("doc_id", tie.alias("tie")).agg(F.count("*").alias("n"))
    # At most `parts` texts hold a range's rows each.
    large = same.where(F.col("n") > n / parts).collect()
    widths = dict.fromkeys(range(len(cuts) + 1), 1)
    inner: list[tuple[int, list[int], list[int]]] = []
    for i, k in pieces.items():
        where = 0 if i is None else sum(c <= i for c in cuts) + 1
        copies = {r["tie"]: -(-r["n"] * parts // n) for r in large if r["doc_id"] == i}
        borders = sorted({-(2**63) + (2**64 * j) // k for j in range(1, k)} | {b for v in copies for b in (v, v + 1) if -(2**63) < b < 2**63})
        wide = [1] * (len(borders) + 1)
        for v, c in copies.items():
            wide[sum(b <= v for b in borders)] = c
        inner.append((where, borders, wide))
        widths[where] = sum(wide)
    starts = [0, *np.cumsum([widths.get(i, 1) for i in range(len(cuts) + 2)]).tolist()]
    found = F.element_at(F.lit(starts), place + 1)
    for where, borders, wide in inner:
        piece = F.size(F.filter(F.lit(borders).cast("array<bigint>"), lambda b: b <= tie)) + 1
        ends = [0, *np.cumsum(wide).tolist()]
        salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.element_at(F.lit(wide), piece))
        found = F.when(place == where, starts[where] + F.element_at(F.lit(ends), piece) + salt).otherwise(found)
    return found, starts[-1]


def write(docs: DataFrame, definition: str, folder: str) -> TokenFile:
    """Write docs (doc_id, text) as blocks in ascending doc_id order below folder."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", whole_text())
    dictionary = train_dictionary(docs, definition)
    digest = hashlib.sha256(dictionary).hexdigest()
    made = TokenFile(f"{folder}/blocks", f"{folder}/dictionary")
    spark.createDataFrame([(digest, bytearray(dictionary))], "sha256 string, data binary").coalesce(1).write.parquet(made.dictionary)
    of, n = _ranges(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, now, block = 0, None, 0

        def flush() -> pa.RecordBatch:
            ids, counts, frames = zip(*held, strict=True)
            ends = np.cumsum([len(f) for f in frames]).tolist()
            known = [i for i in ids if i is not None]
            row = (now, block, min(known, default=None), max(known, default=None), ids, [0, *ends[:-1]], counts, digest, b"".join(frames))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string(), pa.binary())
            names = [x.split()[0] for x in BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for part, i, n, frame in zip(*(values(batch, c) for c in ("range", "doc_id", "n_tokens", "frame")), strict=True):
                if held and (part != now or size + len(frame) > BLOCK_BYTES):
                    yield flush()
                    held.clear()
                    size, block = 0, block + 1 if part == now else 0
                now = part
                held.append((i, n, frame))
                size += len(frame)
        if held:
            yield flush()

    # One range a task, by its number.
    dealt = encode(docs.withColumn("range", of.cast("int")), definition, dictionary).repartitionById(n, "range")
    ordered = dealt.sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "n_tokens", "frame")
    ordered.select("range", "doc_id", "n_tokens", "frame").mapInArrow(run, BLOCK).write.option("compression", "none").parquet(made.blocks)
    return made


def _load(spark: SparkSession, made: TokenFile) -> tuple[str, bytes]:
    row = spark.read.parquet(made.dictionary).first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError("the dictionary does not match its hash")
    return row["sha256"], data


PLACE = "range int, block int, place int, doc_id long"


def _open(spark: SparkSession, made: TokenFile, more: str, of: Callable[[list[bytes]], dict[str, pa.Array]]) -> DataFrame:
    """range, block, place in the block, doc_id and `more` of every document written; `of` makes those of a block's ids."""
    digest, dictionary = _load(spark, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            if row["dictionary_sha256"] != digest:
                raise ValueError("block written with another dictionary")
            data, offsets = row["payload"], [*row["offsets"], len(row["payload"])]
            n = len(row["doc_ids"])
            for at in range(0, n, 256):
                ids = [open_.decompress(data[a:b]) for a, b in zip(offsets[at : at + 256], offsets[at + 1 : at + 257], strict=False)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "range": pa.array([row["range"]] * len(ids), pa.int32()),
                        "block": pa.array([row["block"]] * len(ids), pa.int32()),
                        "place": pa.array(range(at, at + len(ids)), pa.int32()),
                        "doc_id": pa.array(row["doc_ids"][at : at + 256], pa.int64()),
                    }
                    | of(ids)
                )

    columns = ("range", "block", "dictionary_sha256", "doc_ids", "offsets", "payload")
    return spark.read.parquet(made.blocks).select(*columns).mapInArrow(run, f"{PLACE}, {more}")


def read(spark: SparkSession, made: TokenFile) -> DataFrame:
    """Place, doc_id and ids (little-endian unsigned 32-bit) of every document written."""
    return _open(spark, made, "ids binary", lambda ids: {"ids": pa.array(ids, pa.binary())})


def read_document(spark: SparkSession, made: TokenFile, doc_id: int) -> list[list[int]]:
    """The ids of one document (of each row with that id): only its block is read, only its frames are opened."""
    digest, dictionary = _load(spark, made)
    open_ = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    near = spark.read.parquet(made.blocks).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id))
    each = near.select("range", "block", "payload", F.explode(F.arrays_zip("doc_ids", "offsets", F.sequence(F.lit(0), F.size("doc_ids") - 1).alias("k"))).alias("d"), "offsets")
    found = each.where(F.col("d.doc_ids") == doc_id).select(
        "range",
        "block",
        F.col("d.offsets").alias("at"),
        F.expr("substring(payload, int(d.offsets) + 1, int(coalesce(get(offsets, int(d.k) + 1), length(payload)) - d.offsets))").alias("frame"),
    )
    return [np.frombuffer(open_.decompress(bytes(r["frame"])), "<u4").tolist() for r in found.orderBy("range", "block", "at").collect()]


def starts(spark: SparkSession, made: TokenFile) -> DataFrame:
    """The ids before each range and block: a running sum over blocks, of which there is one for some MB of ids."""
    blocks = spark.read.parquet(made.blocks).select("range", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    per_range = blocks.groupBy("range").agg(F.sum("n").alias("n"))
    before = per_range.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("_range_start"))
    inner = F.sum("n").over(Window.partitionBy("range").orderBy("block")) - F.col("n")
    return blocks.withColumn("_in", inner).join(before, "range").select("range", "block", (F.col("_range_start") + F.col("_in")).alias("_start"))


def round_trip(docs: DataFrame, definition: str) -> DataFrame:
    """Write docs, read the files back, and return for each document where its ids start, how many and their crc32."""
    spark = docs.sparkSession
    made = write(docs, definition, store.new_path(spark, "tokens"))

    def of(ids: list[bytes]) -> dict[str, pa.Array]:
        return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_crc32": pa.array(map(zlib.crc32, ids), pa.int64())}

    each = _open(spark, made, "n_tokens long, ids_crc32 long", of)
    # Documents of one block stand side by side: their running sum needs a block at a time.
    at = Window.partitionBy("range", "block").orderBy("place")
    placed = each.withColumn("_before", F.sum("n_tokens").over(at) - F.col("n_tokens"))
    return placed.join(starts(spark, made), ["range", "block"]).select("doc_id", (F.col("_start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")
