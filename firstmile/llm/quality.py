"""Quality rules: a threshold table compiled into one projection, without user functions.

Every rule is a row of `RULES`: a measure and the range in which a document is
kept. `measures` computes the counts behind them with built-in expressions on
arrays of the row, so nothing is shuffled and a document never meets another.

NULL and empty texts count as texts without words: they fail the base rule.
Equal rows give equal results, row for row. Only `text` is read; other columns
pass through. The measures live in one struct column, whose name is a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firstmile.llm.columns import unused

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to a in is it for on with that this are was be by at from or as an not have you "
    "der die das und ist ein eine mit von zu im den für auf nicht sich des dem auch als "
    "le la les de du et en un une que qui est dans pour sur par pas avec des au "
    "el los las y una por con para no se lo al como del su es"
).split()


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")


@dataclass(frozen=True)
class Bound:
    """Kept if low <= measure <= high; None leaves that side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Bound("short_words", "mean_word_length", low=2.0),
    Bound("long_words", "mean_word_length", high=14.0),
    Bound("symbols", "symbols_per_word", high=0.25),
    Bound("stop_words", "stop_word_share", low=0.06),
    Bound("duplicate_lines", "duplicate_line_share", high=0.4),
)


def _words(text: Column) -> Column:
    spaced = F.translate(text, WHITE, " " * len(WHITE))
    return F.filter(F.split(spaced, " ", -1), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first occurrence included.

    Windows are sorted with their positions, so equal ones are neighbours and the
    work stays n log n in a text of any length. Texts without a repeated window,
    most of them, stop at the distinct count.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)),
    )

    def marked(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def positions(placed: Column) -> Column:
            same = F.filter(
                placed,
                lambda x, k: (x["w"] == F.get(placed, k - 1)["w"]) | (x["w"] == F.get(placed, k + 1)["w"]),
            )
            starts = F.transform(same, lambda x: x["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

        return _with(placed, positions)

    return F.when(F.size(words) < 3, 0).otherwise(
        _with(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(marked(w)))
    )


def _with(value: Column, use) -> Column:
    """use(value) with value computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measures(text: Column) -> Column:
    """The counts of a text as one struct."""

    def of(row: Column) -> Column:
        text, words = row["text"], row["words"]
        n = F.size(words)
        lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, WHITE, "") != "")
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")).isin(STOP_WORDS)))
            .cast("long")
            .alias("n_stop_words"),
        )

    text = F.coalesce(text, F.lit(""))
    return _with(F.struct(text.alias("text"), _words(text).alias("words")), of)


def _ratios(m: Column) -> dict[str, Column]:
    words, lines = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["n_lines"], F.lit(1))
    return {
        "mean_word_length": m["word_chars"] / words,
        "symbols_per_word": m["n_symbols"] / words,
        "stop_word_share": m["n_stop_words"] / words,
        "duplicate_line_share": m["n_dup_lines"] / lines,
    }


def verdicts(m: Column, rules: tuple[Bound, ...] = RULES) -> dict[str, Column]:
    """One boolean column a rule: true if the document breaks it."""
    ratios, out = _ratios(m), {}
    for rule in rules:
        value = ratios.get(rule.measure)
        value = m[rule.measure] if value is None else value
        low = F.lit(False) if rule.low is None else value < rule.low
        high = F.lit(False) if rule.high is None else value > rule.high
        out[rule.name] = low | high
    return out


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def _judged(m: Column, rules: tuple[Bound, ...]) -> Column:
    broken = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in verdicts(m, rules).items())))
    found = {"base_failed": base_failed(m), "broken": broken, "kept": ~base_failed(m) & (F.size(broken) == 0)}
    return F.struct(*(m[c].alias(c) for c in COUNTS), *(value.alias(name) for name, value in found.items()))


def assess(docs: DataFrame, rules: tuple[Bound, ...] = RULES, into: str = "_quality") -> DataFrame:
    """docs with one more column `into`: a struct of the counts, base_failed, broken (rule names) and kept.

    It is one expression, so a filter on it that moves below the projection counts a text once.
    """
    return docs.withColumn(into, _with(measures(F.col("text")), lambda m: _judged(m, rules)))


def keep_good(docs: DataFrame, rules: tuple[Bound, ...] = RULES) -> DataFrame:
    """The documents that pass, in their own columns, whatever their names."""
    (own,) = unused(docs, "_quality")
    return assess(docs, rules, own).where(F.col(f"{own}.kept")).select(*(F.col(f"`{c}`") for c in docs.columns))
