"""Quality rules as a ledger of bits.

:func:`ledger` measures every text once and stores the measurements and one bit for
every rule that fails. Policies are bit masks with a version: :func:`decide` applies one, :func:`ablate`
counts what a policy without one of its rules would keep, both without the texts.

Words found in repeated three-word windows are found inside the row: the hash of each
window and its position are packed into one long, sorted, and equal neighbours marked,
so a text of n words costs n log n and nothing is shuffled.

Defined results: null and empty texts have no words, no lines, fail ``short`` and aren't
kept; repeated rows are judged each; an empty table gives no rows; other columns are
dropped by :func:`ledger`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenorlake.llm.common import WORD, found

SYMBOLS = "#*$%&|<>"



#: Name, and when a text fails. The place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("short", "n_words < 50"),
    ("repeated", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("same_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


#: Version of a policy: the rules that reject.
POLICIES = {
    "base-1": mask("short", "repeated"),
    "full-1": mask("short", "repeated", "symbols", "same_lines", "short_words", "long_words"),
}
BASE, POLICY = "base-1", "full-1"


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the measurements of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("w", found(F.col("text"), WORD))
    rows = rows.select(
        "doc_id", "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    bits = F.length(F.bin("n_words"))
    windows = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int"))).otherwise(F.array().cast("array<int>"))
    at = lambda i, k: F.get(F.col("w"), i + k)
    packed = F.transform(windows, lambda i: F.call_function("shiftleft", F.xxhash64(at(i, 0), at(i, 1), at(i, 2)), bits).bitwiseOR(i.cast("long")))
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        bits.alias("bits"),
        F.sort_array(packed).alias("s"),
    )
    key = lambda x: F.call_function("shiftright", x, F.col("bits"))
    near = lambda x, i: (key(x) == key(F.get(F.col("s"), i - 1))) | (key(x) == key(F.get(F.col("s"), i + 1)))
    place = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1
    twice = F.filter("s", lambda x, i: F.coalesce(near(x, i), F.lit(False)))
    rows = rows.withColumn("p", F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(place))))
    steps = F.transform("p", lambda x, i: F.coalesce(F.least(F.lit(3).cast("long"), F.get(F.col("p"), i + 1) - x), F.lit(3).cast("long")))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", covered).drop("bits", "s", "p")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """doc_id, measurements, and fail_bits: bit i is set where rule i fails."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits)


def fails(policy: str, policies=POLICIES) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policies[policy])) != 0


def decide(entries: DataFrame, policy: str = POLICY, policies=POLICIES) -> DataFrame:
    """The ledger with policy and kept."""
    return entries.withColumn("policy", F.lit(policy)).withColumn("kept", ~fails(policy, policies))


def ablate(entries: DataFrame, policy: str = POLICY, policies=POLICIES, rules=RULES) -> DataFrame:
    """For each rule of a policy: rows it fails, rows it alone fails, and rows kept without it."""
    chosen = policies[policy]
    patterns = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(chosen)).alias("bits")).agg(F.count("*").alias("n"))
    own = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, (name, _) in enumerate(rules) if chosen >> i & 1]))
    rows = patterns.select("bits", "n", own.alias("r")).select("bits", "n", "r.*")
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0)).alias
    without = F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    return rows.groupBy("rule").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0)("failed"),
        count(F.col("bits") == F.col("bit"))("failed_alone"),
        count(without == 0)("kept_without"),
    )
