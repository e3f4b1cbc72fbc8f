"""Fill-in-middle texts, cut at line borders, as a pyarrow.compute pipeline over batches.

A batch of texts is split into list arrays of lines, flattened with the index of the
text each line comes from, numbered within it, and filtered by role: a line before the
first cut is prefix, before the second middle, else suffix. Each role's lines are put
back into one list a text and joined, and the pieces are joined with their markers by
binary_join_element_wise. No value becomes a Python object on the way. A batch's texts
are worked in portions of bounded bytes; only one long text comes alone.

The cuts, the form and the order are drawn from the sha256 of `seed:id`, so that they
do not depend on partitions or retries.

NULL text is empty. An empty text, and one that holds a marker, stays plain: its output
is the text itself. A NULL id is drawn as empty text. Repeated rows give equal rows;
other columns pass through, whatever their names: result columns take the place of
equally named ones. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firstmile.llm import columns

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Per cent of texts that are transformed, and of those the part written suffix first.
RATE, SPM_RATE = 100, 50
#: Bytes of text that are taken apart at once.
PORTION = 4 << 20

RESULT = [
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
]


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the sha256 of `seed:id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _marked(text: pa.Array) -> pa.Array:
    found = [pc.match_substring(text, marker) for marker in (PREFIX, SUFFIX, MIDDLE)]
    return pc.or_(pc.or_(found[0], found[1]), found[2])


def _units(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Flat lines of all texts, each with its text's index and its ordinal there, and the number of lines a text."""
    pieces = pc.split_pattern(text, pattern="\n")
    lengths = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = pc.list_flatten(pieces)
    parent = pc.list_parent_indices(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    ordinal = np.arange(len(flat), dtype=np.int64) - starts[parent]
    # Every piece but a text's last one was ended by a line break; an empty last piece is no line.
    last = ordinal == lengths[parent] - 1
    ended = pc.binary_join_element_wise(flat, pa.scalar("\n", flat.type), pa.scalar("", flat.type))
    lines = pc.if_else(pa.array(last), flat, ended)
    real = ~last | (pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0)
    keep = pa.array(real)
    parent = parent[real]
    return lines.filter(keep), parent, ordinal[real], np.bincount(parent, minlength=len(text))


def _pieces(lines: pa.Array, parent: np.ndarray, role: np.ndarray, texts: int) -> pa.Array:
    """The lines of a role, put back into one list a text and joined."""
    held = lines.filter(pa.array(role))
    ends = np.concatenate(([0], np.cumsum(np.bincount(parent[role], minlength=texts))))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), held), pa.scalar("", held.type))


def _join(*parts: pa.Array | str) -> pa.Array:
    kind = next(p.type for p in parts if not isinstance(p, str))
    return pc.binary_join_element_wise(*(pa.scalar(p, kind) if isinstance(p, str) else p for p in parts), pa.scalar("", kind))


def rearrange(text: pa.Array, draws: list[np.ndarray], rate: int = RATE, spm_rate: int = SPM_RATE) -> dict[str, pa.Array]:
    """The columns of RESULT for an array of texts without nulls and four drawn numbers each."""
    text = text.cast(pa.large_string())
    lines, parent, ordinal, n = _units(text)
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    first, second = np.minimum(one, two)[parent], np.maximum(one, two)[parent]
    prefix, middle, suffix = (
        _pieces(lines, parent, role, len(text))
        for role in (ordinal < first, (ordinal >= first) & (ordinal < second), ordinal >= second)
    )
    plain = pc.or_(_marked(text), pa.array((n == 0) | (draws[2] % 100 >= rate)))
    spm = pa.array(draws[3] % 100 < spm_rate)
    moved = pc.if_else(spm, _join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle), _join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    none = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n, pa.int64()),
        "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
        "middle_chars": pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())),
        "output": pc.if_else(plain, text, moved).cast(pa.string()),
    }


def fill_in_middle(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE
) -> DataFrame:
    """docs with n (lines), form (plain, psm, spm), prefix_chars, middle_chars and output, the rearranged text."""
    results = {f.name for f in RESULT}
    kept = [c for c in docs.columns if c not in results]
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("w")
    draws = [d.alias(f"h{i}") for i, d in enumerate(_draws(F.col(f"`{id_column}`"), seed))]
    held = docs.select(*others, text, *draws)
    passed = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.portions(found, "w", PORTION):
            at = batch.schema.get_field_index
            drawn = [batch.column(at(f"h{i}")).to_numpy(zero_copy_only=False) for i in range(4)]
            made = rearrange(batch.column(at("w")), drawn, rate, spm_rate)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(f.name)) for f in passed), *made.values()], names=[*(f.name for f in passed), *made]
            )

    moved = held.mapInArrow(batches, T.StructType([*passed, *RESULT]))
    return moved.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), *(f.name for f in RESULT))


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The original text, rebuilt from a fill-in-middle output and its form alone.

    A transformed text holds no marker of its own, and no marker overlaps itself or
    another one, so each marker's first occurrence is the one that was put there.
    """
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    before, middle = F.split_part(output, F.lit(MIDDLE), F.lit(1)), F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = [F.split_part(before, F.lit(SUFFIX), F.lit(i)) for i in (1, 2)]
    spm = [F.split_part(before, F.lit(PREFIX), F.lit(i)) for i in (1, 2)]
    after = len(PREFIX) + 1
    return (
        F.when(form == "psm", F.concat(F.substr(psm[0], F.lit(after)), middle, psm[1]))
        .when(form == "spm", F.concat(spm[1], middle, F.substr(spm[0], F.lit(after))))
        .otherwise(output)
    )


def digest(docs: DataFrame) -> DataFrame:
    """Per document the form, the sizes, and digests of the output and of the text rebuilt from it."""
    moved = fill_in_middle(docs.select("doc_id", "text"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return moved.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256")
    )
