"""Gold: label store and feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorlake.functions import encode, text
from tenorlake.operators import joins
from tenorlake.plans.specs import CLICK_FEATURES

LABEL_STORE = ("loan_id", "Customer_ID", "label", "label_def", "snapshot_date")
SPINE = ("loan_id", "Customer_ID", "snapshot_date", "mob")

FACT_COUNT = "clickstream_snapshot_count"

# Columns that never reach the feature store.
NON_PREDICTIVE = (
    "SSN", "valid_ssn", "Name", "Occupation", "Payment_of_Min_Amount", "valid_payment_of_min_amount",
    "Credit_Mix", "valid_credit_mix", "Credit_History_Age", "valid_credit_history_age", "Type_of_Loan",
    "valid_type_of_loan", "valid_Num_Fin_Pdts", "valid_Loans_per_Credit_Item", "valid_Debt_to_Salary",
    "valid_EMI_to_Salary", "valid_Repayment_Ability", "valid_Loan_Extent",
)

# Output name and category of the one-hot columns.
MINIMUM_LEVELS = {"payment_min_yes": "YES", "payment_min_nm": "NM"}
MIX_LEVELS = {"credit_mix_good": "GOOD", "credit_mix_standard": "STANDARD", "credit_mix_bad": "BAD"}
SPENDING_LEVELS = {"HIGH_SPENT": 1}
VALUE_SIZES = {"LARGE_VALUE": 2, "MEDIUM_VALUE": 1}


def labels(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Loans at the observation age with label 1 for ``dpd`` days past due or more."""
    return (
        loans.where(F.col("mob") == mob)
        .withColumns({"label": encode.threshold_label(F.col("dpd"), dpd), "label_def": encode.label_definition(dpd, mob)})
        .select(*LABEL_STORE)
    )


def spine(loans: DataFrame, mob: int = 0) -> DataFrame:
    """Loans at application time; nothing later may reach the features."""
    return loans.where(F.col("mob") == mob).select(*SPINE)


def dimension(df: DataFrame, encode_before_drop: bool = True) -> DataFrame:
    """A customer table ready to join: categories encoded, raw columns dropped.

    ``encode_before_drop`` False keeps to the columns that survive when the raw
    categories are dropped first: only the occupation flag is made.
    """
    made = {}
    if "Occupation" in df.columns:
        made["is_PMET"] = encode.membership(F.col("Occupation"))
    if encode_before_drop:
        if "Payment_of_Min_Amount" in df.columns:
            made |= encode.one_hot(F.col("Payment_of_Min_Amount"), MINIMUM_LEVELS)
        if "Credit_Mix" in df.columns:
            made |= encode.one_hot(F.col("Credit_Mix"), MIX_LEVELS)
    behaviours = ("Payment_Behavior", "Payment_Behaviour") if encode_before_drop else ("Payment_Behavior",)
    for column in behaviours:
        if column in df.columns:
            made["spending_level"] = text.contains_level(F.col(column), SPENDING_LEVELS)
            made["value_size"] = text.contains_level(F.col(column), VALUE_SIZES)
    return (df.withColumns(made) if made else df).drop(*NON_PREDICTIVE)


def features(
    loans: DataFrame, attributes: DataFrame | None = None, financials: DataFrame | None = None,
    clickstream: DataFrame | None = None, latest_only: bool = False, encode_before_drop: bool = True,
    days: int = 180, key: str = "Customer_ID", click_columns: list[str] | None = None,
) -> DataFrame:
    """One wide row per application (and, unless ``latest_only``, per earlier customer row).

    Absent side tables are skipped. All snapshots of ``loans`` go through at once.
    With clickstream, rows alike in every column are one row whose number of facts
    covers all its copies. The trailing means depend on customer and date only, so
    they are added while the rows are still narrow and few; copies are counted
    before the joins instead of being multiplied by them.
    """
    rows = spine(loans)
    collapse = clickstream is not None
    if collapse:
        columns = click_columns or [c for c in CLICK_FEATURES if c in clickstream.columns]
        rows = joins.trailing_features(rows, clickstream, key, columns, days, count_name=FACT_COUNT)
    clicks = [c for c in rows.columns if c not in SPINE]
    merge = False
    for side in (attributes, financials):
        if side is None:
            continue
        side = dimension(side, encode_before_drop)
        dated = "snapshot_date" in side.columns
        if dated and latest_only:
            rows = joins.latest_join(rows, side, key)
            continue
        if collapse:
            # without a dropped column no two rows of a distinct side come out alike
            side, merge = joins.counted(side), merge or dated or not set(side.columns).isdisjoint({*rows.columns} - {key})
        rows = joins.history_join(rows, side, key) if dated else joins.enrich(rows, side, [key])
        if collapse:
            copies = F.coalesce(F.col("_copies"), F.lit(1))
            rows = rows.withColumn(FACT_COUNT, F.col(FACT_COUNT) * copies).drop("_copies")
    if merge:
        # the means follow from customer and date
        rows = joins.merge_counted(rows, FACT_COUNT, [c for c in clicks if c != FACT_COUNT])
    order = [*SPINE, *[c for c in rows.columns if c not in SPINE and c not in clicks], *clicks]
    return rows.select(*order, F.date_format("snapshot_date", "yyyy-MM-dd").alias("feature_snapshot_date"))
