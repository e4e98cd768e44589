"""Jobs that run again and again: rolling windows, catch-up, versions of a model, backfills that stop."""

import dataclasses

from pyspark.sql import functions as F

from querybook.base import day, query, rounded, scratch
from querybook.history import TRAILING
from querybook.learning import fixed_model
from querybook.monitoring import with_day
from tenorlake.operators import ranking
from tenorlake.plans import bronze, registry, rolling, scoring
from tenorlake.sources import lineage, snapshots
from tenorlake.streaming import catchup


@query(TRAILING)
def trailing_incremental(t):
    """Trailing means from daily sums that came in month by month, the last month twice with other facts before."""
    root = scratch(t.spark) + "/sums"
    columns = ["fe_1", "fe_2"]
    last = t.click_facts.select(F.trunc(F.max("snapshot_date"), "MM")).scalar()
    month = F.trunc("snapshot_date", "MM")
    other = t.click_facts.withColumn("fe_1", F.when(month == last, F.col("fe_1") + 1).otherwise(F.col("fe_1")))
    rolling.update(other, root, "user_id", columns)
    newest = t.click_facts.select(F.trunc(F.max("snapshot_date"), "MM").cast("string")).first()[0]
    rolling.update(t.click_facts, root, "user_id", columns, month=newest)
    out = rolling.trailing_features(t.click_spine, root, "user_id", columns, 7)
    return rounded(out.withColumn("snapshot_date", day("snapshot_date")), 6, "avg_fe_1_last_6m", "avg_fe_2_last_6m")


@query(
    """SELECT CAST(CAST(date_trunc('month', snapshot_date) AS DATE) AS VARCHAR) AS snapshot_date, count(*) AS n,
        count(*) FILTER (installment_num % 2 = 0) AS n_batch FROM v_loan GROUP BY 1""",
    "v_loan",
)
def catch_up_shared_root(t):
    """A table written as a batch, then caught up by the stream, whose batch comes a second time."""
    root = scratch(t.spark)
    rows = t.loan.select("loan_id", "installment_num", day(F.trunc("snapshot_date", "MM")).alias("snapshot_date"))
    even = F.col("installment_num") % 2 == 0
    rows.where(even).write.option("header", True).csv(f"{root}/first")
    rows.where(~even).write.option("header", True).csv(f"{root}/later")
    bronze.ingest(t.spark, f"{root}/first", f"{root}/bronze")
    names = ["loan_id", "installment_num", "snapshot_date"]
    run = catchup.ingest_new_files(t.spark, f"{root}/later", names, f"{root}/bronze", f"{root}/progress")
    run.awaitTermination()
    again = bronze.snapshot_rows(snapshots.read_csv(t.spark, f"{root}/later"))
    snapshots.append_snapshots(again, f"{root}/bronze", catchup.token(f"{root}/progress", 0))
    back = snapshots.read_snapshots(t.spark, f"{root}/bronze")
    batch = F.count_if(F.col("installment_num").cast("int") % 2 == 0).alias("n_batch")
    return with_day(back.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), batch))


# how far the customer number shifts the scores of each version: the less, the better they order the labels
BLUR = {1: 5000, 2: 4950, 3: 0}
SPLITS = {"train": "o_orderdate < DATE '1996-01-01'", "val": "year(o_orderdate) = 1996", "test": "year(o_orderdate) = 1997", "oot": "o_orderdate >= DATE '1998-01-01'"}
SPLIT = "CASE " + " ".join(f"WHEN {c} THEN '{s}'" for s, c in SPLITS.items()) + " END"
ALLOWED = "coalesce(oot >= 0.80 AND abs(oot - test) / test <= 0.03 AND train - val < 0.05, false)"


@query(
    f"""WITH s AS (SELECT version, {SPLIT} AS split, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS label, o_totalprice + blur * (o_custkey % 97) AS score
            FROM orders, (VALUES {", ".join(map(str, BLUR.items()))}) AS v(version, blur)),
        r AS (SELECT version, split, label, rank() OVER w + (count(*) OVER (PARTITION BY version, split, score) - 1) / 2.0 AS place
            FROM s WINDOW w AS (PARTITION BY version, split ORDER BY score)),
        a AS (SELECT version, split, (sum(place) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * sum(1 - label)) AS auc FROM r GROUP BY ALL),
        e AS (SELECT version, {", ".join(f"max(auc) FILTER (split = '{s}') AS {s}" for s in SPLITS)} FROM a GROUP BY 1),
        b AS (SELECT *, {ALLOWED} AS ok FROM e),
        p1 AS (SELECT ok AS p, CASE WHEN ok THEN oot END AS used FROM b WHERE version = 1),
        p2 AS (SELECT ok AND (used IS NULL OR (oot - used) / used >= 0.02) AS p, CASE WHEN ok AND (used IS NULL OR (oot - used) / used >= 0.02) THEN oot ELSE used END AS used
            FROM b, p1 WHERE version = 2),
        p3 AS (SELECT ok AND (used IS NULL OR (oot - used) / used >= 0.02) AS p FROM b, p2 WHERE version = 3),
        done AS (SELECT list_filter([CASE WHEN p1.p THEN 1 END, CASE WHEN p2.p THEN 2 END, CASE WHEN p3.p THEN 3 END], lambda x: x IS NOT NULL) AS used FROM p1, p2, p3)
        SELECT version, round(oot, 6) AS oot_roc_auc, list_contains(used, version) AS promoted,
            coalesce(version = CASE WHEN len(used) > 1 THEN used[-2] ELSE used[-1] END, false) AS in_use
        FROM e, done"""
)
def promote_and_roll_back(t):
    """Three versions with AUC from the orders, promoted in turn where the check lets them; the last promotion is taken back."""
    split = F.expr(SPLIT)
    versions = F.explode(F.array(*[F.struct(F.lit(v).alias("version"), F.lit(b).alias("blur")) for v, b in BLUR.items()]))
    rows = t.table("orders").select("o_totalprice", "o_custkey", split.alias("split"), versions.alias("v"))
    score = F.col("o_totalprice") + F.col("v.blur") * (F.col("o_custkey") % 97)
    label = F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).alias("label")
    auc = ranking.roc_auc(rows.select("v.version", "split", label, score.cast("double").alias("prediction_proba")), ["version", "split"])
    found = [F.max(F.when(F.col("split") == s, F.col("roc_auc"))).alias(f"{s}_roc_auc") for s in SPLITS]
    names = F.array(*[F.lit(f) for f in ("quantity", "tax")]).alias("features")
    by_version = lineage.settled(auc.groupBy("version").agg(*found), "versions")
    root, model = scratch(t.spark), fixed_model(t)
    for v in BLUR:
        record = by_version.where(F.col("version") == v).drop("version").select(F.lit("model_1").alias("model_id"), names, "*")
        number = registry.register(t.spark, dataclasses.replace(model, record=record), root, {"orders": "all"})
        registry.promote(t.spark, root, "model_1", number)
    moves = registry.history(t.spark, root, "model_1")
    used = registry.current(t.spark, root, "model_1")
    if moves.count() > 1:
        used = registry.roll_back(t.spark, root, "model_1")
    promoted = moves.where("action = 'promoted'").select("version", F.lit(True).alias("promoted"))
    out = registry.records(t.spark, root, "model_1").join(promoted, "version", "left")
    return rounded(
        out.select("version", "oot_roc_auc", F.coalesce("promoted", F.lit(False)).alias("promoted"), (F.col("version") == F.lit(used or 0)).alias("in_use")), 6, "oot_roc_auc"
    )


@query(
    """WITH c AS (SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS m, count(*) AS n,
            sum(1 / (1 + exp(-(-0.3 + 0.02 * coalesce(quantity, 10) - 4.0 * coalesce(tax, 0.05))))) AS s FROM v_feat GROUP BY 1),
        k AS (SELECT model_id, CAST(d AS DATE) AS m, row_number() OVER (ORDER BY model_id, d) AS k
            FROM (VALUES ('model_1'), ('model_2')) AS v(model_id), (SELECT unnest(generate_series(max(m) - to_months(3), max(m), to_months(1))) AS d FROM c))
        SELECT model_id, CAST(m AS VARCHAR) AS month, 'finished' AS state, CASE WHEN k <= 3 THEN 'first' ELSE 'second' END AS run,
            coalesce(n, 0) AS n, round(s, 4) AS total FROM k LEFT JOIN c USING (m)""",
    "v_feat",
)
def backfill_resumed(t):
    """A backfill that ends after three months and is taken up by another run: who scored what, how many rows and their sum."""
    root = scratch(t.spark) + "/scores"
    saved = fixed_model(t)
    models = {m: (saved.model, ["quantity", "tax"]) for m in ("model_1", "model_2")}
    last = F.lit(t.feat.select(F.trunc(F.max("snapshot_date"), "MM")).first()[0])
    scoring.resume_backfill(models, t.feat, root, last, "first", "v1", 4, at_most=3)
    for _ in range(2):
        scoring.resume_backfill(models, t.feat, root, last, "second", "v1", 4)
    ledger = scoring.backfill_ledger(t.spark, root, list(models), last, "v1", 4)
    scores = snapshots.read_snapshots(t.spark, root).groupBy("model_id", "month").agg(F.count("prediction_proba").alias("n"), F.sum("prediction_proba").alias("total"))
    out = ledger.join(scores, ["model_id", "month"], "left")
    return rounded(out.select("model_id", day("month").alias("month"), "state", "run", F.coalesce("n", F.lit(0)).alias("n"), "total"), 4, "total")
