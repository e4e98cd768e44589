"""Point-in-time, trailing-window, lagged and membership joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.functions import dates, text
from tenorlake.operators.schema import without_overlap

PAIR_KEYS = ("loan_id", "Customer_ID")
LABEL_COLUMNS = ("loan_id", "Customer_ID", "label", "label_def")


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that keeps the left copy of every column both sides have."""
    return left.join(without_overlap(right, left, keys), list(keys), "left")


def history_join(
    spine: DataFrame, history: DataFrame, key: str, spine_date: str = "snapshot_date", history_date: str = "snapshot_date"
) -> DataFrame:
    """Every earlier or same-day history row of the key, left rows without one kept.

    The result itself holds all these rows, so a key with n spine and m history
    rows yields up to n * m of them; ``latest_join`` returns one per spine row.
    The join is a sort-merge join with a residual date test, whose left side
    adaptive execution may split when a key is hot.
    """
    kept = [c for c in history.columns if c not in spine.columns]
    right = history.select(
        F.col(key).alias("_key"), F.col(history_date).cast("date").alias("_valid_from"), *kept
    )
    match = (F.col(key) == F.col("_key")) & (F.col("_valid_from") <= F.col(spine_date))
    return spine.join(right, match, "left").drop("_key", "_valid_from")


def latest_join(
    spine: DataFrame, history: DataFrame, key: str, spine_date: str = "snapshot_date",
    history_date: str = "snapshot_date", tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest history row on or before the spine date, one row per spine row.

    Both sides shrink to one row per (key, day) before the ordered window, so the
    window sees at most the calendar days of a key, not its rows. Of several
    history rows on one day the greatest by ``tie_break`` (then all columns) wins.
    """
    kept = [c for c in history.columns if c not in spine.columns]
    order = [*tie_break, *[c for c in kept if c not in tie_break]]
    value = F.struct(*order)
    # the guard column tells a found row from none, also when all its values are null
    daily = (
        history.where(F.col(key).isNotNull() & F.col(history_date).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(history_date).cast("date").alias("_day"))
        .agg(F.max(value).alias("_value"))
        .withColumn("_asked", F.lit(False))
    )
    asked = _asked_days(spine, key, spine_date)
    window = (
        Window.partitionBy("_key").orderBy("_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        asked.unionByName(daily, allowMissingColumns=True)
        .withColumn("_value", F.last("_value", ignorenulls=True).over(window))
        .where("_asked")
        .select("_key", "_day", "_value")
    )
    return _attach(spine, found, key, spine_date, [F.col(f"_value.{c}").alias(c) for c in kept])


def trailing_features(
    spine: DataFrame, facts: DataFrame, key: str, columns: Sequence[str], days: int = 180,
    spine_date: str = "snapshot_date", fact_date: str = "snapshot_date", name: str = "avg_{}_last_6m",
    count_name: str = "clickstream_snapshot_count", collapse_duplicates: bool = True,
) -> DataFrame:
    """Mean of fact columns and number of facts in [spine date - days, spine date].

    Equal to joining every fact of the window and averaging, but no pair is
    formed: facts are summed per (key, day), the window slides over days, and the
    means go back to the spine by (key, day). ``collapse_duplicates`` turns
    identical spine rows into one whose number of facts covers all of them, as
    grouping by all spine columns does.
    """
    daily = daily_sums(facts, key, columns, fact_date)
    return trailing_from_sums(spine, daily, key, columns, days, spine_date, name, count_name, collapse_duplicates)


def daily_sums(facts: DataFrame, key: str, columns: Sequence[str], fact_date: str = "snapshot_date") -> DataFrame:
    """Facts added up per (key, day): sum and number of values of each column, and number of facts."""
    partials = {f"_s_{c}": F.sum(c) for c in columns} | {f"_c_{c}": F.count(c) for c in columns}
    return (
        facts.where(F.col(key).isNotNull() & F.col(fact_date).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(fact_date).cast("date").alias("_day"))
        .agg(F.count(F.lit(1)).alias("_facts"), *[agg.alias(n) for n, agg in partials.items()])
    )


def trailing_from_sums(
    spine: DataFrame, daily: DataFrame, key: str, columns: Sequence[str], days: int = 180, spine_date: str = "snapshot_date",
    name: str = "avg_{}_last_6m", count_name: str = "clickstream_snapshot_count", collapse_duplicates: bool = True,
) -> DataFrame:
    """``trailing_features`` from facts that are added up already, as :func:`daily_sums` returns them."""
    daily = daily.withColumn("_asked", F.lit(False))
    asked = _asked_days(spine, key, spine_date)
    window = Window.partitionBy("_key").orderBy(F.unix_date("_day")).rangeBetween(-days, Window.currentRow)
    means = {
        name.format(c): F.sum(f"_s_{c}").over(window) / F.nullif(F.sum(f"_c_{c}").over(window), F.lit(0))
        for c in columns
    }
    found = (
        asked.unionByName(daily, allowMissingColumns=True)
        .withColumns(means | {count_name: F.sum("_facts").over(window)})
        .where("_asked")
        .select("_key", "_day", *means, count_name)
    )
    rows, copies = (counted(spine), F.col("_copies")) if collapse_duplicates else (spine, F.lit(1))
    count = F.coalesce(F.col(count_name) * copies, F.lit(0)).cast("bigint").alias(count_name)
    return _attach(rows, found, key, spine_date, [*means, count]).drop("_copies")


def counted(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies in ``_copies``."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))


def merge_counted(df: DataFrame, count_name: str, given: Sequence[str] = ()) -> DataFrame:
    """Rows alike in all but the count become one with the sum of their counts.

    ``given`` names columns that follow from the others and need not be compared. The rows are
    spread by a hash of the rest first. Left to itself, Spark would keep the partitioning of the
    join before and with it the rows of a hot key in one task.
    """
    keys = [c for c in df.columns if c != count_name and c not in given]
    spread = df.withColumn("_spread", F.xxhash64(*keys)).repartition("_spread")
    merged = spread.groupBy("_spread", *keys).agg(F.sum(count_name).alias(count_name), *[F.first(c).alias(c) for c in given])
    return merged.select(*df.columns)


def _asked_days(spine: DataFrame, key: str, day: str) -> DataFrame:
    days = spine.select(F.col(key).alias("_key"), F.col(day).cast("date").alias("_day"))
    return days.where("_key is not null and _day is not null").distinct().withColumn("_asked", F.lit(True))


def _attach(spine: DataFrame, found: DataFrame, key: str, day: str, columns: Sequence[Column | str]) -> DataFrame:
    match = (F.col(key) == F.col("_key")) & (F.col(day).cast("date") == F.col("_day"))
    return spine.join(found, match, "left").select(*[spine[c] for c in spine.columns], *columns)


def labelled(left: DataFrame, labels: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """Rows with their label; the label side brings only label columns."""
    bring = [c for c in LABEL_COLUMNS if c in labels.columns and (c in keys or c not in left.columns)]
    return left.join(labels.select(bring), list(keys), "inner")


def match_report(left: DataFrame, right: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """Rows per side and matches as one row; ``matched`` 0 is the empty-join error."""
    sides = _key_sides(left, right, keys)
    return sides.agg(
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.col("left_rows") * F.col("right_rows")), F.lit(0)).alias("matched"),
    )


def _key_sides(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    def marked(df: DataFrame, is_left: int) -> DataFrame:
        return df.select(*keys, F.lit(is_left).alias("_l"), F.lit(1 - is_left).alias("_r"))

    both = marked(left, 1).unionByName(marked(right, 0))
    return both.groupBy(*keys).agg(F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"))


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """Keys found on one side only, with the side and the start date in the id."""
    one_side = _key_sides(left, right, keys).where("left_rows = 0 or right_rows = 0")
    side = F.when(F.col("right_rows") == 0, "left").otherwise("right").alias("side")
    return one_side.select(*keys, side, text.id_date_suffix(F.col(keys[0])).alias("start_date"))


def unmatched_summary(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = PAIR_KEYS, samples: int = 5
) -> DataFrame:
    """Per side: keys without a partner, their first and last start date, the first sample ids."""
    missing = unmatched(left, right, keys)
    totals = missing.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.min("start_date").alias("first_start"),
        F.max("start_date").alias("last_start"),
        F.count_distinct("start_date").alias("n_starts"),
    )
    # top rows per side are merged task by task, never sorted as one group
    picks = [
        missing.where(F.col("side") == s).select("side", keys[0]).distinct().orderBy(keys[0]).limit(samples)
        for s in ("left", "right")
    ]
    shown = picks[0].unionByName(picks[1]).groupBy("side")
    return totals.join(shown.agg(F.sort_array(F.collect_list(keys[0])).alias("sample_ids")), "side", "left")


def start_dates(df: DataFrame, id_column: str = "loan_id") -> DataFrame:
    """Distinct dates found at the end of ids, ascending."""
    found = df.select(text.id_date_suffix(F.col(id_column)).alias("loan_start_date"))
    return found.where(F.col("loan_start_date") != "").distinct().orderBy("loan_start_date")


def lagged(
    labels: DataFrame, predictions: DataFrame, keys: Sequence[str] = PAIR_KEYS, lag_months: int = 6,
    label_date: str = "snapshot_date", prediction_date: str = "inference_date",
) -> DataFrame:
    """Labels at month T with the predictions of the same loans at T - lag."""
    bring = [c for c in LABEL_COLUMNS if c in labels.columns]
    due = F.add_months(F.col(label_date), -lag_months).alias(prediction_date)
    shifted = labels.select(*bring, F.col(label_date).alias("label_date"), due)
    return predictions.join(shifted, [*keys, prediction_date], "inner")


def aligned_snapshots(
    labels: DataFrame, available: DataFrame, lag_months: int = 6, strict_priority: bool = False,
    id_column: str = "loan_id", label_date: str = "snapshot_date", prediction_date: str = "inference_date",
) -> DataFrame:
    """For each label snapshot, the prediction snapshot to pair it with.

    Candidates in order: T - lag unless it also occurs among the start dates in
    the label ids, those start dates ascending, T itself. The first one with
    predictions wins; null if none has. ``strict_priority`` puts T - lag first in
    any case.
    """
    snapshot = F.col(label_date).alias("label_date")
    from_ids = (
        labels.select(snapshot, text.id_date_suffix(F.col(id_column)).alias("_suffix"))
        .distinct()
        .select("label_date", F.try_to_date("_suffix", "yyyy_MM_dd").alias("candidate"))
        .where(F.col("candidate").isNotNull())
        .withColumn("_rank", F.lit(1))
    )
    days = labels.select(snapshot).distinct()
    offset = F.struct(F.add_months("label_date", -lag_months).alias("candidate"), F.lit(0).alias("_rank"))
    same = F.struct(F.col("label_date").alias("candidate"), F.lit(2).alias("_rank"))
    fixed = days.select("label_date", F.inline(F.array(offset, same)))
    in_ids = F.max(F.col("_rank") == 1)
    lowest = F.min("_rank")
    rank = lowest if strict_priority else F.when(in_ids, 1).otherwise(lowest)
    candidates = from_ids.unionByName(fixed).groupBy("label_date", "candidate").agg(rank.alias("_rank"))
    there = available.select(F.col(prediction_date).alias("candidate")).distinct().withColumn("_there", F.lit(True))
    ranked = candidates.join(there, "candidate", "left")
    choice = F.when(F.col("_there"), F.struct("_rank", "candidate"))
    best = F.min(choice)
    kind = F.when(best["_rank"] == 0, "offset").when(best["_rank"] == 1, "id_date").when(best["_rank"] == 2, "same_day")
    return ranked.groupBy("label_date").agg(best["candidate"].alias("prediction_date"), kind.alias("source"))


def assign_splits(df: DataFrame, date_column: str, windows: Iterable[Mapping[str, str]]) -> DataFrame:
    """One row per (row, window that contains its date); both window ends inclusive.

    The windows are literals inside one expression, so there is no join and no
    shuffle. A row in several windows repeats, a row in none disappears.
    """
    day = F.col(date_column).cast("date")
    names = [
        F.when(day.between(F.lit(w["start_date"]).cast("date"), F.lit(w["end_date"]).cast("date")), F.lit(w["split"]))
        for w in windows
    ]
    return df.withColumn("split", F.explode(F.array_compact(F.array(*names))))


def assign_split_table(df: DataFrame, column: str, windows: DataFrame) -> DataFrame:
    """:func:`assign_splits` with windows from a table (split, start_date, end_date), however many there are.

    A window has a row per month it touches, so rows and windows meet by month, in a join Spark can shuffle and split, and
    the days are compared afterwards. A row in several windows comes out once for each; null bounds hold no row.
    """
    bounds = windows.select("split", F.col("start_date").cast("date").alias("_start"), F.col("end_date").cast("date").alias("_end"))
    months = F.sequence(F.trunc("_start", "MM"), F.trunc("_end", "MM"), F.expr("interval 1 month"))
    bounds = bounds.where(F.col("_start") <= F.col("_end")).withColumn("_month", F.explode(months))
    rows = df.drop("split").join(bounds, F.trunc(F.col(column), "MM") == F.col("_month"))
    return rows.where(F.col(column).between(F.col("_start"), F.col("_end"))).drop("_start", "_end", "_month")


def required_outputs(models: DataFrame, snapshot: Column, months: int) -> DataFrame:
    """Every (model, month) that should have scores: month starts up to the snapshot."""
    return models.select("model_id", F.explode(dates.month_starts(snapshot, months)).alias("month"))


def missing_outputs(required: DataFrame, existing: DataFrame) -> DataFrame:
    """Required (model, month) pairs without output."""
    return required.join(existing.select("model_id", "month").distinct(), ["model_id", "month"], "left_anti")


def availability(features: DataFrame, labels: DataFrame, keys: Sequence[str] = PAIR_KEYS, month: str = "snapshot_date") -> DataFrame:
    """Feature, label and joined row counts per snapshot month.

    Labels are few, so they alone are counted by key. Features meet these counts in a hash join, pass through it
    one by one and are added up by month; no task sorts them or holds their keys.
    """
    held = [f"_{k}" for k in keys]
    by_key = labels.groupBy(F.col(month).alias("_month"), *[F.col(k).alias(h) for k, h in zip(keys, held, strict=True)]).agg(
        F.count(F.lit(1)).alias("_l")
    )
    match = F.col(month).eqNullSafe(F.col("_month"))
    for key, other in zip(keys, held, strict=True):
        match = match & F.col(key).eqNullSafe(F.col(other))
    met = features.select(month, *keys).join(by_key.hint("shuffle_hash"), match, "left")
    none = F.lit(0).cast("bigint")
    asked = met.groupBy(month).agg(F.count(F.lit(1)).alias("n_features"), F.coalesce(F.sum("_l"), none).alias("n_joined"))
    given = by_key.groupBy(F.col("_month").alias(month)).agg(F.sum("_l").alias("n_labels"))
    sides = asked.withColumn("n_labels", none).unionByName(given.withColumns({"n_features": none, "n_joined": none}))
    return sides.groupBy(month).agg(*[F.sum(n).alias(n) for n in ("n_features", "n_labels", "n_joined")])
