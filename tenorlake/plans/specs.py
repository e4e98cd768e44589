"""What the silver layer knows about each source table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenorlake.functions import dates, numeric, text
from tenorlake.operators import rules
from tenorlake.operators.rules import Rule, Strategy

Derivation = tuple[str, Sequence[str], Callable[[], Column]]


@dataclass(frozen=True)
class TableSpec:
    """Declared types, rules and derived columns of a table.

    ``derived`` holds stages of (name, needed columns, expression); a later stage
    may use columns of an earlier one. A derivation is skipped if a needed column
    is absent.
    """

    name: str
    types: dict[str, str]
    rules: Callable[[str], list[Rule]]
    derived: Sequence[Sequence[Derivation]] = ()
    derived_rules: Sequence[Rule] = ()
    token_column: str | None = None
    token_part: str | None = None


def _keys(as_of: str, key_strategy: Strategy, date_strategy: Strategy) -> list[Rule]:
    return [rules.customer_id(strategy=key_strategy), rules.date_range("snapshot_date", as_of, date_strategy)]


def _loan_rules(as_of: str) -> list[Rule]:
    amounts = ("due_amt", "paid_amt", "overdue_amt", "balance")
    return [
        *_keys(as_of, Strategy.DROP_ROW, Strategy.DROP_ROW),
        rules.positive("loan_amt", Strategy.FLAG_ONLY),
        *[rules.non_negative(a, Strategy.FLAG_ONLY) for a in amounts],
    ]


LOAN_STAGES = (
    (
        ("mob", ("installment_num",), lambda: F.col("installment_num").cast("int")),
        (
            "installments_missed",
            ("overdue_amt", "due_amt"),
            lambda: numeric.instalments_missed(F.col("overdue_amt"), F.col("due_amt")),
        ),
    ),
    (
        (
            "first_missed_date",
            ("snapshot_date", "installments_missed"),
            lambda: dates.first_missed_date(F.col("snapshot_date"), F.col("installments_missed")),
        ),
    ),
    (
        (
            "dpd",
            ("snapshot_date", "first_missed_date", "overdue_amt"),
            lambda: dates.days_past_due(F.col("snapshot_date"), F.col("first_missed_date"), F.col("overdue_amt")),
        ),
    ),
)

# Fixed values, here and below: column names and types of the source tables, and the bounds of their rules.
LOAN_DAILY = TableSpec(
    "loan_daily",
    {
        "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
        "installment_num": "int", "loan_amt": "float", "due_amt": "float", "paid_amt": "float",
        "overdue_amt": "float", "balance": "float", "snapshot_date": "date",
    },
    _loan_rules,
    LOAN_STAGES,
)

CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]

CLICKSTREAM = TableSpec(
    "clickstream",
    {"Customer_ID": "string", "snapshot_date": "date"} | {c: "int" for c in CLICK_FEATURES},
    lambda as_of: [
        *_keys(as_of, Strategy.FLAG_ONLY, Strategy.NULL_VALUE),
        *[rules.non_negative(c, Strategy.DEFAULT_VALUE, 0) for c in CLICK_FEATURES],
    ],
)

ATTRIBUTES = TableSpec(
    "attributes",
    {
        "Customer_ID": "string", "Name": "string", "Age": "int", "SSN": "string",
        "Occupation": "string", "snapshot_date": "date",
    },
    lambda as_of: [
        *_keys(as_of, Strategy.FLAG_ONLY, Strategy.NULL_VALUE),
        rules.between("Age", 18, 100, "valid_age"),
        rules.pattern("SSN", text.SSN_PATTERN, "valid_ssn"),
    ],
    (
        (
            ("Age_capped", ("Age",), lambda: numeric.cap_age(F.col("Age"))),
            ("Occupation", ("Occupation",), lambda: text.standardise(F.col("Occupation"))),
        ),
    ),
)

# Accepted categories, compared without regard to case.
PAYMENT_BEHAVIOURS = (
    "High_spent_Medium_value_payments",
    "High_spent_Small_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Small_value_payments",
    "High_spent_Large_value_payments",
    "Low_spent_Large_value_payments",
)
PAYMENT_MINIMUMS = ("Yes", "No")
CREDIT_MIXES = ("Bad", "Good", "Standard")


def _financial_rules(as_of: str) -> list[Rule]:
    # Bounds of amounts, shares and rates.
    return [
        *_keys(as_of, Strategy.DROP_ROW, Strategy.DROP_ROW),
        rules.extreme_outlier("Annual_Income", 1_000, 10_000_000),
        rules.between("Annual_Income", 10_000, 10_000_000, "valid_annual_income"),
        rules.extreme_outlier("Monthly_Inhand_Salary", 100, 1_000_000),
        rules.between("Monthly_Inhand_Salary", 1_000, 100_000, "valid_monthly_salary"),
        rules.between("Credit_Utilization_Ratio", 0, 1, "valid_credit_utilization"),
        rules.between("Interest_Rate", 0, 100, "valid_interest_rate"),
        rules.non_negative("Outstanding_Debt", Strategy.FLAG_ONLY),
        rules.non_negative("Monthly_Balance", Strategy.FLAG_ONLY),
        rules.non_negative("Total_EMI_per_month", Strategy.DEFAULT_VALUE, 0.0),
        rules.non_negative("Amount_invested_monthly", Strategy.DEFAULT_VALUE, 0.0),
        rules.categorical("Payment_Behaviour", PAYMENT_BEHAVIOURS),
        rules.categorical("Payment_of_Min_Amount", PAYMENT_MINIMUMS),
        rules.categorical("Credit_Mix", CREDIT_MIXES, nulls=("_",)),
        rules.useful_text("Type_of_Loan"),
    ]


def _ratio(numerator: str, denominator: str) -> Callable[[], Column]:
    return lambda: numeric.guarded_ratio(F.col(numerator), F.col(denominator))


def _loans_per_item() -> Column:
    items = F.coalesce(F.col("Num_Bank_Accounts"), F.lit(0)) + F.coalesce(F.col("Num_Credit_Card"), F.lit(0))
    return numeric.guarded_ratio(F.col("Num_of_Loan"), items)


_COUNTS = ("Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan")

FINANCIALS = TableSpec(
    "financials",
    {
        "Customer_ID": "string", "Annual_Income": "float", "Monthly_Inhand_Salary": "float",
        "Num_Bank_Accounts": "int", "Num_Credit_Card": "int", "Interest_Rate": "float", "Num_of_Loan": "int",
        "Type_of_Loan": "string", "Delay_from_due_date": "int", "Num_of_Delayed_Payment": "int",
        "Changed_Credit_Limit": "float", "Num_Credit_Inquiries": "float", "Credit_Mix": "string",
        "Outstanding_Debt": "float", "Credit_Utilization_Ratio": "float", "Credit_History_Age": "string",
        "Payment_of_Min_Amount": "string", "Total_EMI_per_month": "float", "Amount_invested_monthly": "float",
        "Payment_Behaviour": "string", "Monthly_Balance": "float", "snapshot_date": "date",
    },
    _financial_rules,
    (
        (
            ("Num_Fin_Pdts", _COUNTS, lambda: numeric.null_aware_sum(*map(F.col, _COUNTS)).cast("int")),
            ("Loans_per_Credit_Item", _COUNTS, _loans_per_item),
            ("Debt_to_Salary", ("Outstanding_Debt", "Monthly_Inhand_Salary"), _ratio("Outstanding_Debt", "Monthly_Inhand_Salary")),
            ("EMI_to_Salary", ("Total_EMI_per_month", "Monthly_Inhand_Salary"), _ratio("Total_EMI_per_month", "Monthly_Inhand_Salary")),
            (
                "Repayment_Ability",
                ("Monthly_Inhand_Salary", "Total_EMI_per_month"),
                lambda: (F.col("Monthly_Inhand_Salary") - F.col("Total_EMI_per_month")).cast("float"),
            ),
            (
                "Loan_Extent",
                ("Delay_from_due_date", "Num_of_Loan"),
                lambda: F.try_multiply(F.col("Delay_from_due_date"), F.col("Num_of_Loan")),
            ),
            ("Credit_History_Age_Months", ("Credit_History_Age",), lambda: text.duration_months(F.col("Credit_History_Age"))),
        ),
    ),
    (
        *[rules.non_negative(c, Strategy.FLAG_ONLY) for c in ("Num_Fin_Pdts", "Loans_per_Credit_Item", "Debt_to_Salary", "EMI_to_Salary")],
        rules.present("Repayment_Ability"),
        rules.present("Loan_Extent"),
        rules.between("Credit_History_Age_Months", 0, 600, "valid_credit_history_age"),
    ),
    token_column="Type_of_Loan",
    token_part="Loan",
)

SPECS = {s.name: s for s in (LOAN_DAILY, CLICKSTREAM, ATTRIBUTES, FINANCIALS)}


def get(name: str) -> TableSpec:
    if name not in SPECS:
        raise ValueError(f"no table spec named {name}; known: {sorted(SPECS)}")
    return SPECS[name]


__all__ = ["ATTRIBUTES", "CLICKSTREAM", "FINANCIALS", "LOAN_DAILY", "SPECS", "TableSpec", "get"]
