"""Hot ids, clashing columns, large draws, texts without hints: results that must not depend on size or names."""

import collections
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from firstmile.llm import bpe, pii, queries, shard, simhash, tokenfile
from firstmile.llm.columns import unused


def test_secrets_of_letters_only_are_found():
    bare = "the token is sk-abcdefghijklmnopqrstuv ok"
    assert [s[:3] for s in pii.spans(bare)] == [s[:3] for s in pii.spans(bare + " 7")] == [(13, 38, "secret")]
    assert [k for *_, k, _ in pii.spans("api key: " + "abcdef" * 6)] == ["secret"]


def test_draws_of_any_size_are_exact():
    start = time.time()
    counts = [10**9] * 8 + [10**7] * 200 + [0, 1]
    matrix = shard.communication_matrix(counts, 16, 3)
    assert time.time() - start < 1
    assert matrix.sum(axis=1).tolist() == counts and matrix.min() >= 0
    assert matrix.sum(axis=0).max() - matrix.sum(axis=0).min() <= 1


@pytest.mark.parametrize("good, bad, sample", [(300, 700, 200), (5, 995, 400), (500, 500, 900), (2000, 30, 25)])
def test_large_draws_have_the_right_distribution(monkeypatch, good, bad, sample):
    want = np.random.default_rng(1).hypergeometric(good, bad, sample, 30_000)
    monkeypatch.setattr(shard, "NUMPY_LIMIT", 60)
    monkeypatch.setattr(shard, "HANDFUL", 2)
    draw = np.random.default_rng(2)
    got = np.array([shard._hypergeometric(draw, good, bad, sample) for _ in range(30_000)])
    assert got.min() >= max(0, sample - bad) and got.max() <= min(good, sample)
    assert got.mean() == pytest.approx(want.mean(), abs=5 * want.std() / 170 + 1e-9)
    assert got.std() == pytest.approx(want.std(), rel=0.03)
    share = lambda x: np.bincount(x, minlength=good + 1) / len(x)
    assert np.abs(np.cumsum(share(got)) - np.cumsum(share(want))).max() < 0.02


def test_places_after_the_shuffle_are_uniform(spark):
    """Shard and place in the shard say nothing about where a row stood."""
    n = 8000
    rows = spark.range(0, n, 1, 5).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard.assign(rows, shards=8, seed=11).collect()}
    assert collections.Counter(s for s, _ in found.values()) == {s: n // 8 for s in range(8)}
    order = np.array([found[i][0] * (n // 8) + found[i][1] for i in range(n)])
    assert abs(np.corrcoef(np.arange(n), order)[0, 1]) < 0.05
    cells = np.histogram2d(np.arange(n), order, bins=10)[0]
    assert ((cells - n / 100) ** 2 / (n / 100)).sum() < 81 + 5 * np.sqrt(2 * 81)
    assert np.mean(np.abs(np.diff(order)) == 1) < 0.01


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "_a int, _A_ int, b int")
    assert unused(df, "_a", "b", "c", "c") == ["_a__", "b_", "c", "c_"]


@pytest.fixture
def four_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


#: doc_id and text of row `id`, in SQL.
HOT = {
    "one id": ("if(id % 3 = 0, 77, id)", "concat('text ', id)"),
    "no id": ("if(id % 3 = 0, null, id)", "concat('text ', id)"),
    "one row": ("if(id % 3 = 0, 5, id)", "if(id % 3 = 0, 'same', string(id))"),
    "two rows of an id": ("if(id % 3 <> 1, 9000, id)", "if(id % 2 = 0, 'same', 'other')"),
    "the largest id": ("if(id % 3 = 0, 9223372036854775807, id - 9223372036854775807)", "string(id)"),
}


@pytest.mark.parametrize("name", list(HOT))
def test_ranges_of_token_files_are_even(spark, four_partitions, name):
    n = 8000
    doc_id, text = HOT[name]
    docs = spark.range(n).selectExpr(f"bigint({doc_id}) AS doc_id", f"{text} AS text")
    of, ranges = tokenfile._ranges(docs)
    sizes = {r["r"]: r["count"] for r in docs.groupBy(of.alias("r")).count().collect()}
    assert set(sizes) <= set(range(ranges)) and max(sizes.values()) <= 2 * n / 4
    found = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in tokenfile.round_trip(docs, queries.tokenizer_file("byte_bpe_50k.json")).collect())
    assert len(found) == n and found[0][0] == 0
    assert all(a + k == b for (a, k, _), (b, _, _) in zip(found, found[1:]))
    ids = [i for *_, i in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def awkward(spark):
    text = " ".join(f"the word{i} of and to in{i}" for i in range(30))
    other = " ".join(f"a thing{i} is with that{i} on" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (3, other), (None, other + " x"), (4, None), (5, ""), (6, "short")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    extra = {c: F.lit("mine") for c in ("_quality", "_doc_id", "_text", "_n", "_fp", "_place", "_nth", "root", "least", "_item", "a.b")}
    return df.withColumns(extra).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("_QUALITY_", F.struct(F.lit(1).alias("kept")))


def test_stages_keep_extra_columns_of_any_name_and_type(spark, tmp_path):
    item = "What is the colour of the zebra in the old town hall? It is striped black and white all over."
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = awkward(spark)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, str(tmp_path))
        assert now.schema == before.schema or [(f.name, f.dataType) for f in now.schema] == [(f.name, f.dataType) for f in before.schema]
        rows = now.collect()
        kept[name] = sorted(str(r["doc_id"]) for r in rows)
        assert all(r["_quality"] == r["_doc_id"] == r["_text"] == r["a.b"] == "mine" and r["m"] == {"k": r["doc_id"]} for r in rows)
    assert kept["quality"] == ["1", "1", "2", "3", "None"]
    assert kept["near_duplicates"] == kept["pii"] and kept["near_duplicates"].count("1") == 1 and "2" not in kept["near_duplicates"]
    assert "3" in kept["near_duplicates"]


def test_one_of_repeated_rows_with_maps(spark):
    df = awkward(spark).where("doc_id = 1")
    assert df.count() == 2 and simhash.keep_one(df).count() == 1


def test_token_ids_of_a_batch_of_long_texts(spark):
    definition = queries.tokenizer_file("word_bpe_49k.json")
    plain = bpe.Bpe(definition)
    rows = [(i, f"Word{i} naïve <|endoftext|> " * (1 + 5000 * (i % 3 == 0))) for i in range(12)] + [(20, None), (21, "")]
    found = {r["doc_id"]: r for r in bpe.tokenize(spark.createDataFrame(rows, "doc_id long, text string"), definition).collect()}
    for i, text in rows:
        assert found[i]["ids"] == plain.encode(text or "") and found[i]["n_tokens"] == len(found[i]["ids"])


def test_other_normalizers_are_refused():
    definition = queries.tokenizer_file("word_bpe_49k.json").replace('"NFC"', '"NFKC"')
    with pytest.raises(ValueError, match="NFKC"):
        bpe.Bpe(definition)
