"""Model versions and their pointer; backfills that stop and go on."""

import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import functions as F

from tenorlake.plans import registry, scoring, training
from tenorlake.sources import snapshots

def last():
    return F.lit("2024-06-15").cast("date")



def fixed(spark, model_id="model_1", weight=1.0, **metrics):
    stages = [
        SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-{weight}D * coalesce(x, 0D))) AS p1 FROM __THIS__"),
        SQLTransformer(statement="SELECT *, 1 - p1 AS p0, IF(p1 > 0.5, 1D, 0D) AS prediction FROM __THIS__"),
        VectorAssembler(inputCols=["p0", "p1"], outputCol="probability"),
        SQLTransformer(statement="SELECT * EXCEPT (p0, p1) FROM __THIS__"),
    ]
    given = {"train_roc_auc": 0.84, "val_roc_auc": 0.83, "test_roc_auc": 0.83, "oot_roc_auc": 0.82} | metrics
    record = spark.createDataFrame([(model_id, ["x"], *given.values())], f"model_id string, features array<string>, {', '.join(f'{m} double' for m in given)}")
    weights = spark.createDataFrame([("x", weight)], "feature string, weight double")
    return training.Trained(model_id, PipelineModel(stages), None, None, weights, record)


def test_versions_are_promoted_by_the_check_and_rolled_back(spark, tmp_path):
    root = str(tmp_path)
    assert registry.current(spark, root, "model_1") is None
    with pytest.raises(LookupError):
        registry.load(spark, root, "model_1")
    for oot in (0.82, 0.821, 0.85):
        registry.register(spark, fixed(spark, weight=oot, oot_roc_auc=oot, test_roc_auc=oot), root, {"features": "2024-06-01"})
    assert registry.promote(spark, root, "model_1", 1)
    assert not registry.promote(spark, root, "model_1", 2)  # gains less than 2 % on the one in use
    assert registry.promote(spark, root, "model_1", 3)
    assert registry.promote(spark, root, "model_1", 3)  # already in use: no move
    assert registry.current(spark, root, "model_1") == 3
    assert registry.roll_back(spark, root, "model_1") == 1
    with pytest.raises(LookupError):
        registry.roll_back(spark, root, "model_1")
    moves = registry.history(spark, root, "model_1").orderBy("move").collect()
    assert [(m.action, m.version) for m in moves] == [("promoted", 1), ("promoted", 3), ("rolled_back", 1)]
    assert registry.load(spark, root, "model_1").record.first().oot_roc_auc == 0.82
    found = registry.records(spark, root, "model_1").orderBy("version").collect()
    assert [(r.version, r.oot_roc_auc, r.inputs["features"]) for r in found] == [(1, 0.82, "2024-06-01"), (2, 0.821, "2024-06-01"), (3, 0.85, "2024-06-01")]


def test_a_save_that_stops_is_no_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    with monkeypatch.context() as patch:
        patch.setattr(training, "save_at", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            registry.register(spark, fixed(spark), root)
    assert registry.versions(spark, root, "model_1").count() == 0
    with pytest.raises(LookupError):
        registry.load(spark, root, "model_1", 1)
    assert registry.register(spark, fixed(spark), root) == 2


@pytest.fixture()
def features(spark):
    day = F.expr("date_add(date'2024-01-01', cast(id * 7 % 180 as int))")
    return spark.range(400).select(F.format_string("L%d", "id").alias("loan_id"), F.lit("c").alias("Customer_ID"), day.alias("snapshot_date"), (F.col("id") % 5 - 2.0).alias("x"))


def states(spark, root, version="v1"):
    rows = scoring.backfill_ledger(spark, root, ["model_1", "model_2"], last(), version, 3).orderBy("model_id", "month").collect()
    return [(r.state, r.run) for r in rows]


def scored_rows(spark, root):
    got = snapshots.read_snapshots(spark, root).groupBy("model_id", "month").agg(F.count("loan_id").alias("n"), F.count_distinct("loan_id").alias("d")).collect()
    return {(r.model_id, str(r.month)): (r.n, r.d) for r in got}


def test_a_backfill_that_stops_goes_on_without_scoring_twice(spark, tmp_path, features, monkeypatch):
    models = {m: (fixed(spark, m).model, ["x"]) for m in ("model_1", "model_2")}
    root = f"{tmp_path}/scores"
    n = {str(r.m): r["count"] for r in features.groupBy(F.trunc("snapshot_date", "MM").alias("m")).count().collect()}
    want = {(m, d): (n[d], n[d]) for m in models for d in ("2024-04-01", "2024-05-01", "2024-06-01")}

    def run(name, **options):
        return scoring.resume_backfill(models, features, root, last(), name, options.pop("version", "v1"), 3, **options)

    assert run("a", at_most=1) == [("model_1", dt.date(2024, 4, 1))]
    with monkeypatch.context() as patch:  # the second task stops before its commit
        patch.setattr(snapshots, "commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            run("a")
    with monkeypatch.context() as patch:  # and another time right after it
        patch.setattr(snapshots, "finish", lambda *_: None)
        run("a", at_most=1)
    assert states(spark, root)[:3] == [("finished", "a"), ("finished", "a"), ("open", None)]
    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            run("a")
    assert states(spark, root)[2] == ("claimed", "a")
    assert len(run("b")) == 3  # the claimed task is left to its run
    assert run("b") == []
    assert scoring.release(spark, root, "a") == 1
    assert run("b") == [("model_1", dt.date(2024, 6, 1))]
    assert scored_rows(spark, root) == want
    assert [s for s, _ in states(spark, root)] == ["finished"] * 6
    # new features open every month again and replace its scores
    assert len(run("c", version="v2")) == 6
    assert scored_rows(spark, root) == want


def test_a_month_without_rows_is_finished_too(spark, tmp_path, features):
    models = {"model_1": (fixed(spark).model, ["x"])}
    then = F.lit("2025-01-01").cast("date")
    root = f"{tmp_path}/scores"
    assert len(scoring.resume_backfill(models, features, root, then, "a", "v1", 2)) == 2
    assert scoring.resume_backfill(models, features, root, then, "a", "v1", 2) == []
