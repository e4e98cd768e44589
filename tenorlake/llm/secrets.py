"""Secret scans over a ledger of blobs.

A path is any row that holds a text: a file of a commit, a document, a version of one. Texts are
addressed by their SHA-256, so a text that occurs under many paths or in many versions
is one blob. The ledger lists the (blob, rule, version) pairs already scanned; a scan
reads only pairs not in it, and findings are joined back to every path of their blob.
A rule that changes gets a new version and is scanned again, alone.

Matches are leftmost and don't overlap within a rule. Their places come from the
lengths of the matches and of the texts between them, summed per blob and rule.

Defined results: a null text is the empty text; repeated rows are separate paths of one
blob; null ids are kept; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenorlake.llm.common import found
from tenorlake.sources import lineage, snapshots


@dataclass(frozen=True)
class Rule:
    """``group`` of a match has ``least`` characters or more; with ``core`` only that end of the match counts."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    version: int = 1
    core: str | None = None


#: The kinds and patterns that every scan reports. Runs too short to count are left to the
#: pattern where that comes to the same; nearly every text has a letter from a to f.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: A line end, as itself or as an escape in a string, with the quotes, commas or comment signs around it.
_TURN = r"""[\x20\t"'+,;]*(?:\r?\n|\r|(?:\\r)?\\n)[\x20\t>#*"'+|]*"""
#: A PEM block: to its END line, before which no other five dashes stand; without one, header fields and lines of
#: base64, of which the last may be short. Groups are repeated possessively: each repetition is
#: a step of a loop and not of a recursion, however many there are.
_PEM = (
    r"-----BEGIN (?:[A-Z ]*? )?PRIVATE KEY-----"
    r"(?:(?:[^-]++|-(?!----))*+-{5,}+END (?:[A-Z ]*? )?PRIVATE KEY-----"
    rf"|(?:{_TURN}[A-Za-z-]+:\x20[^\r\n\\]*+)*+(?:{_TURN})?"
    rf"(?:(?:{_TURN}|[\x20\t]*)[A-Za-z0-9+/]{{32,}}={{0,2}})++(?:{_TURN}[A-Za-z0-9+/]{{1,31}}={{0,2}}(?:\r?\n|(?![\s\S])))?|)"
)
#: Public formats of keys and tokens. The last two are looked for once per run of their letters, from its first letter on, and
#: ``core`` is where the match begins in the run: a search that starts anew at every letter takes the square of a long run.
MORE_RULES = (
    Rule("private_key", _PEM, version=3),
    Rule("code_host", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{13,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", core=r"eyJ[A-Za-z0-9_-]{10,}+\.[\s\S]*", version=2),
    Rule("url_login", r"(?<![a-z0-9+.-])[a-z0-9+.-]++://[^\x20\x09-\x0D/:@]++:[^\x20\x09-\x0D/@]++@", core=r"[a-z][\s\S]*", version=2),
)
RULES = BASE_RULES + MORE_RULES


def rule_id(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def addressed(paths: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``blob``, the address of their text."""
    return paths.withColumn("blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def unseen(versions: DataFrame, rules=RULES, ledger: DataFrame | None = None) -> DataFrame:
    """(blob, text, todo): each text once, with the rules it has not been scanned by."""
    blobs = versions.groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*[F.lit(rule_id(r)) for r in rules])
    if ledger is None:
        return blobs.withColumn("todo", wanted)
    done = ledger.groupBy("blob").agg(F.collect_set("rule").alias("done"))
    todo = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)


def _matches(rule: Rule) -> Column:
    """Pairs of the text before a match and the match, or null."""
    text, wanted = F.col("text"), F.array_contains("todo", rule_id(rule))
    pairs = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), found(text, rule.pattern).alias("hit"))
    return F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule_id(rule)).alias("rule"), F.when(wanted & text.rlike(rule.pattern), pairs).alias("pairs"))


def findings(todo: DataFrame, rules=RULES) -> DataFrame:
    """(blob, kind, rule, start, end) of unseen pairs; code points, end exclusive."""
    rows = todo.select("blob", F.explode(F.array(*[_matches(r) for r in rules])).alias("m")).where("m.pairs is not null")
    rows = rows.select("blob", "m.kind", "m.rule", F.posexplode("m.pairs").alias("i", "pair")).where("pair.hit is not null")
    rows = rows.select("blob", "kind", "rule", "i", "pair.hit", F.length("pair.gap").alias("gap"), F.length("pair.hit").alias("n"))
    upto = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto))
    long_enough, size = F.lit(True), F.col("n")
    for r in rules:
        mine = F.col("rule") == rule_id(r)
        if r.core:
            size = F.when(mine, F.length(F.regexp_extract("hit", r.core, 0))).otherwise(size)
        if r.least > 1:
            part = F.length(F.regexp_extract("hit", r.pattern, r.group)) if r.group else F.col("n")
            long_enough = F.when(mine, part >= r.least).otherwise(long_enough)
    rows = rows.withColumn("size", size).withColumn("start", F.col("end") - F.col("size"))
    return rows.where(long_enough & (F.col("size") > 0)).select("blob", "kind", "rule", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


def scanned(todo: DataFrame) -> DataFrame:
    """Ledger rows of what :func:`findings` has scanned."""
    return todo.select("blob", F.explode("todo").alias("rule"))


def by_blob(hits: DataFrame, rules=RULES) -> DataFrame:
    """One row per blob with findings: spans in order of start, then of the rules; counts per kind."""
    place = F.coalesce(*[F.when(F.col("kind") == r.kind, F.lit(i)) for i, r in enumerate(rules)])
    span = F.struct("start", place.alias("place"), "end", "kind")
    counts = [F.count_if(F.col("kind") == r.kind).alias(f"n_{r.kind}") for r in rules]
    return hits.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans"), *counts)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def recorded(versions: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """Findings of the blobs, after a scan of the (blob, rule, version) pairs the ledger lacks.

    The ledger is a folder with the pairs scanned and their findings; both only grow. Findings are written before their
    pairs, so a run that ends between leaves pairs that the next run scans again, and rows found twice count once.
    """
    spark = versions.sparkSession
    todo = lineage.settled(unseen(versions, rules, snapshots.read_optional(spark, f"{ledger}/scanned")), "unseen")
    findings(todo, rules).write.mode("append").parquet(f"{ledger}/findings")
    scanned(todo).write.mode("append").parquet(f"{ledger}/scanned")
    known = spark.read.parquet(f"{ledger}/findings").where(F.col("rule").isin([rule_id(r) for r in rules]))
    return known.distinct()


def scan(paths: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, ledger: str | None = None) -> DataFrame:
    """Every path with its blob, the number of findings per kind, base_sha256 and spans.

    With ``ledger``, the folder of :func:`recorded`, only pairs unseen by earlier runs are scanned, and what those
    found is joined to the paths as well.
    """
    versions = paths.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    versions = addressed(versions)
    found = findings(unseen(versions, rules), rules) if ledger is None else recorded(versions, ledger, rules)
    # Written as findings of the ledger are; a join with a table of its own also lets Spark split a blob with many paths.
    hits = lineage.settled(by_blob(found, rules), "findings")
    rows = versions.select("doc_id", "blob").join(hits, "blob", "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>"))
    base = F.filter(spans, lambda s: s["place"] < len(BASE_RULES))
    counts = [F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")).alias(f"n_{r.kind}") for r in rules]
    return rows.select("doc_id", "blob", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))


def masked(paths: DataFrame, text_col: str = "text", rules=RULES, mark: str = "[secret]", ledger: str | None = None) -> DataFrame:
    """The rows with every span, or run of overlapping spans, replaced by a mark.

    Rows in which no rule's pattern occurs stay where they are; only the others meet the ledger.
    """
    may = F.lit(False)
    for r in rules:
        may = may | F.coalesce(F.col(text_col), F.lit("")).rlike(r.pattern)
    suspects = lineage.settled(paths.where(may), "suspects")
    return paths.where(~may).unionByName(_masked(suspects, text_col, rules, mark, ledger))


#: Code points of the blocks a text is cut into: a place in it is found within its block.
BLOCK = 4096


def _masked(paths: DataFrame, text_col: str, rules, mark: str, ledger: str | None) -> DataFrame:
    others = [c for c in paths.columns if c != text_col]
    versions = paths.select(F.struct(*others, F.lit(1).alias("_")).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    versions = addressed(versions)
    own = versions.select("blob", "text")
    hits = findings(unseen(own, rules), rules) if ledger is None else recorded(own, ledger, rules)
    earlier = Window.partitionBy("blob").orderBy("start", "end", "rule").rowsBetween(Window.unboundedPreceding, -1)
    hits = hits.withColumn("covered", F.coalesce(F.max("end").over(earlier), F.lit(0).cast("long")))
    # A run of overlapping spans begins where no earlier span reaches.
    runs = hits.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.when(F.col("start") >= F.col("covered"), F.struct("start", "covered")))).alias("runs"), F.max("end").alias("last")
    )
    blocks = found(F.col("text"), f"(?s).{{1,{BLOCK}}}+").alias("blocks")
    rows = versions.select("blob", "row", blocks).join(lineage.settled(runs, "runs"), "blob", "left")

    def piece(a: Column, z: Column) -> Column:
        first, last = (a / BLOCK).cast("int"), (z / BLOCK).cast("int")
        at, to = (a % BLOCK).cast("int"), (z % BLOCK).cast("int")
        begin, end = F.coalesce(F.get("blocks", first), F.lit("")), F.coalesce(F.get("blocks", last), F.lit(""))
        between = F.array_join(F.slice("blocks", first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        return F.when(first == last, F.substring(begin, at + 1, to - at)).otherwise(F.concat(F.substring(begin, at + 1, F.lit(BLOCK)), between, F.substring(end, F.lit(1), to)))

    whole = F.array_join("blocks", "")
    parts = F.transform("runs", lambda s: F.concat(piece(s["covered"], s["start"]), F.lit(mark)))
    rest = piece(F.col("last"), (F.size("blocks") * F.lit(BLOCK)).cast("long"))
    clean = F.when(F.col("runs").isNull(), whole).otherwise(F.concat(F.array_join(parts, ""), rest))
    return rows.select(*[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in paths.columns])
