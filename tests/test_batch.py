"""The whole batch, from CSV files to served tables."""

import pytest
from compare import differences, duck
from conftest import SMALL
from helpers import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from firstmile import Rules, schemas
from firstmile.catalog.inputs import METRIC_RULES, Inputs
from firstmile.plans import batch
from firstmile.plans.explore import explore
from firstmile.plans.publish import verify
from firstmile.sources import keyed_table, parquet_table, read_parquet, versioned_table


@pytest.fixture(scope="module")
def extracts(spark, tmp_path_factory):
    """The derived extracts as CSV files, with an index column and stray rows."""
    folder = tmp_path_factory.mktemp("csv")
    t = Inputs(spark, SMALL)
    transactions = t.transactions.select(
        F.col("event_id").alias("_c0"),
        "user_id",
        F.date_format("transaction_dt", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("transaction_dt"),
        "type",
        F.lit(1).alias("segment"),
    )
    strays = transactions.limit(3).withColumn("type", F.lit(11))
    onboarding = t.onboarding_raw.drop("seq")
    moments = [c for c in onboarding.columns if c.endswith("_dt")]
    onboarding = onboarding.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in moments}
    )
    out = {
        "users": t.users_raw.withColumn("type", F.coalesce("type", F.lit(""))),
        "transactions": transactions.unionAll(strays),
        "onboarding": onboarding,
    }
    for name, df in out.items():
        df.write.option("header", True).option("escape", '"').csv(str(folder / name))
    return batch.read_extracts(spark, *[str(folder / n) for n in out])


@pytest.fixture(scope="module")
def done(spark, extracts, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("batch"))
    ledger, published, problems = batch.run(extracts, METRIC_RULES, folder)
    assert problems == []
    return folder, ledger, published


def test_ledger_accounts_for_every_row(extracts, done):
    ledger = rows(done[1])
    assert ledger == [
        ("onboarding", 1, "id_prefix", 156, 0, 156),
        ("onboarding", 2, "time_present", 156, 0, 156),
        ("onboarding", 3, "date_range", 156, 0, 156),
        ("transactions", 1, "id_prefix", 1003, 0, 1003),
        ("transactions", 2, "type_domain", 1003, 3, 1000),
        ("transactions", 3, "segment_domain", 1000, 0, 1000),
        ("transactions", 4, "time_present", 1000, 0, 1000),
        ("transactions", 5, "date_range", 1000, 0, 1000),
        ("users", 1, "id_prefix", 150, 13, 137),
        ("users", 2, "id_present", 137, 0, 137),
        ("users", 3, "id_format", 137, 12, 125),
    ]


def test_served_tables_match_their_sql(spark, done):
    folder, _, published = done
    con, sql = duck(SMALL), entry.oracle_sql()
    assert {p.table for p in published} == set(schemas.CONTRACTS)
    assert {p.status for p in published} == {"written"}
    for p in published:
        sink = versioned_table(f"{folder}/served/{p.table}")
        assert verify(spark, p, schemas.CONTRACTS[p.table], sink) == []
        name = p.table if p.table == "transaction_summary" else f"contract_{p.table}"
        name = "transaction_summary_daily" if p.table == "transaction_summary" else name
        served = read_parquet(spark, f"{folder}/served/{p.table}")
        assert differences(served, con, sql[name]) == [], p.table


def test_consistency_is_landed(spark, done):
    found = read_parquet(spark, f"{done[0]}/consistency").first().asDict()
    clean = batch.read_clean(spark, done[0])
    users, transactions, onboarding = (
        {r[0] for r in df.select("user_id").collect()}
        for df in (clean.users, clean.transactions, clean.onboarding)
    )
    assert found["users_count"] == len(users) == 125
    assert found["users_onboarding_overlap"] == len(users & onboarding)
    assert found["all_three_overlap"] == len(users & transactions & onboarding)


def test_clean_tables_have_declared_types(spark, done):
    clean = batch.read_clean(spark, done[0])
    assert schemas.schema_problems(clean.users, schemas.CLEAN_USERS) == []
    assert schemas.schema_problems(clean.transactions, schemas.CLEAN_TRANSACTIONS) == []
    assert schemas.schema_problems(clean.onboarding, schemas.CLEAN_ONBOARDING) == []


def test_stage_alone_with_absent_connector(spark, done):
    folder = done[0]
    published = batch.serve(spark, folder, lambda t: keyed_table(t, "ks", format="no.such.connector"))
    assert {p.status for p in published} == {"fallback"}
    assert all("no.such.connector" in p.error for p in published)
    assert batch.check(spark, folder, published, None) == []


def test_adapted_contracts_are_served_and_checked(spark, done, tmp_path):
    folder = done[0]

    def sink_of(table):
        return parquet_table(str(tmp_path / table))

    def adapt(contract):
        return contract.with_instants().with_wide_counts()

    published = batch.serve(spark, folder, sink_of, with_week=True, adapt=adapt)
    assert batch.check(spark, folder, published, sink_of, adapt) == []
    # The plain contracts no longer fit, and the check says so.
    problems = batch.check(spark, folder, published, sink_of)
    assert any("user_metrics.first_login_dt: timestamp, not timestamp_ntz" in p for p in problems)
    funnel = spark.read.parquet(str(tmp_path / "funnel_analysis"))
    assert funnel.filter("dimension_type = 'week'").count() == 6


def test_exploration_reports(spark, extracts):
    reports = {name: df.collect() for name, df in explore(extracts, Rules()).items()}
    assert {r["dataset"]: r["row_count"] for r in reports["row_counts"]} == {
        "users": 150,
        "transactions": 1003,
        "onboarding": 156,
    }
    assert {r["rule"]: r["invalid_rows"] for r in reports["invalid_counts"]}["type_domain"] == 3
    assert all(len(r) > 0 for r in reports.values())


def test_landed_raw_extracts_are_unchanged(extracts, tmp_path):
    landed = batch.land_raw(extracts, str(tmp_path))
    for name in ("users", "transactions", "onboarding"):
        before, after = getattr(extracts, name), getattr(landed, name)
        assert after.schema == before.schema
        assert rows(after) == rows(before)


def test_extra_columns_change_nothing(spark, extracts, done, tmp_path):
    """Undeclared columns end at cleaning, so they cannot break ties later."""
    wider = batch.Extracts(
        *[
            df.withColumn("Flag", F.col("user_id").substr(4, 2)).withColumn("consigna", F.lit("x"))
            for df in (extracts.users, extracts.transactions, extracts.onboarding)
        ]
    )
    folder = str(tmp_path / "wider")
    batch.clean_and_compare(wider, METRIC_RULES, folder)
    clean, plain = batch.read_clean(spark, folder), batch.read_clean(spark, done[0])
    for ours, theirs in zip((clean.users, clean.transactions, clean.onboarding), (plain.users, plain.transactions, plain.onboarding), strict=True):
        assert ours.columns == theirs.columns
        assert rows(ours) == rows(theirs)


def test_light_loader(spark, extracts):
    from firstmile.operators.cleaning import prefix_only

    light = prefix_only(extracts.transactions, Rules())
    assert "_c0" not in light.columns
    assert light.count() == 1003


def test_records_of_another_width_reach_ledger_and_rejects(spark, tmp_path):
    (tmp_path / "users.csv").write_text('user_id,type,rubro,address\nMLB1,1,2,"a\nb"\nMLB2,1\nMLA3,1,2,c\nMLB4,1,2,d,e\n')
    (tmp_path / "tx.csv").write_text(
        "user_id,transaction_dt,type,segment\nMLB1,2022-02-01 10:00:00,1,1\nMLB1,2022-02-01 10:00:00,1\nMLB1,x,1,1\n"
    )
    (tmp_path / "on.csv").write_text(
        "user_id,first_login_dt,week_year,habito,habito_dt,activacion,activacion_dt,setup,setup_dt,return,return_dt\n"
        "MLB1,2022-01-05 09:00:00,1,0,,0,,0,,0,\nMLB9\n"
    )
    raw = batch.read_extracts(spark, *[str(tmp_path / f"{n}.csv") for n in ("users", "tx", "on")], parallel=True, malformed=True)
    ledger = rows(batch.preprocess(raw, Rules(), str(tmp_path / "out"), rejects=True), "dataset", "rule", "rows_before", "rows_removed")
    assert [x for x in ledger if x[1] == "row_width"] == [
        ("onboarding", "row_width", 2, 1), ("transactions", "row_width", 3, 1), ("users", "row_width", 4, 2),
    ]
    found = rows(read_parquet(spark, str(tmp_path / "out" / "rejects")), "dataset", "rule", "user_id", "record")
    assert [f[:3] for f in found] == [
        ("onboarding", "row_width", "MLB9"), ("transactions", "row_width", "MLB1"), ("transactions", "time_present", "MLB1"),
        ("users", "id_prefix", "MLA3"), ("users", "row_width", "MLB2"), ("users", "row_width", "MLB4"),
    ]
    assert {f[3] for f in found} == {
        "MLB9", "MLB1,2022-02-01 10:00:00,1", '{"user_id":"MLB1","transaction_dt":"x","type":"1","segment":"1"}',
        '{"user_id":"MLA3","type":"1","rubro":"2","address":"c"}', "MLB2,1", "MLB4,1,2,d,e",
    }
    assert sum(x[3] for x in ledger) == len(found)
    assert batch.read_clean(spark, str(tmp_path / "out")).users.collect()[0]["address"] == "a b"
