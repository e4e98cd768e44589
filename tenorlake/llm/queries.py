"""The numbered operators on the test tables, with SQL that states their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenorlake.llm import langid, licenses, linededup, mainhtml, mixing, neardup, packing, quality, repair, secrets, spotsigs, suffixes, vectorcodes
from tenorlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return register


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(sha256('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS weight, 3 * source_size AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM w WINDOW r AS (ORDER BY cap::DOUBLE / weight, source IS NULL, encode(source))),
t AS (SELECT source, source_size, least(cap::DOUBLE, weight * max(level) OVER ()) AS target FROM l),
q AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
o AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.whole, round(q.target - q.whole * q.source_size)::BIGINT AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size, d.text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, quota - before)))::BIGINT AS taken FROM o
"""


@query(MIX_SQL)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM w),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n FROM g),
c AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM h WHERE n > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (r)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (100 * n_symbols > 25 * n_words)::BIGINT
            + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 15 * n_words)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits,
       fail_bits & 3 <> 0 AS base_failed, fail_bits & 63 = 0 AS kept
FROM b
"""


@query(QUALITY_SQL)
def op5_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(table(spark, sf_dir, "documents"))
    return quality.decide(entries).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fail_bits",
        quality.fails(quality.BASE).alias("base_failed"), "kept",
    )  # fmt: skip


def _spans_sql(kind: str, pattern: str, least: str) -> str:
    """Matches of one kind with their places, from the texts between them."""
    return f"""SELECT r, '{kind}' AS kind, (s + e - len(hit))::BIGINT AS start, (s + e)::BIGINT AS "end", hit FROM (
      SELECT r, hit, coalesce(sum(len(hit)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s,
             len(hit) + sum(len(gap)) OVER (PARTITION BY r ORDER BY i) AS e
      FROM (SELECT r, unnest(regexp_extract_all(text, $${pattern}$$)) AS hit, unnest(regexp_split_to_array(text, $${pattern}$$)) AS gap,
                   generate_subscripts(regexp_split_to_array(text, $${pattern}$$), 1) AS i FROM d)
      WHERE hit IS NOT NULL) WHERE {least}"""


def _secrets_sql() -> str:
    def plain(pattern: str) -> str:
        both = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)  # noqa: E731
        return pattern.replace("(?i:password|passwd|secret|token|api_?key)", "(?:" + "|".join(map(both, ("password", "passwd", "secret", "token", "api_?key"))) + ")")

    parts = []
    turn = r"""[\x20\t"'+,;]*(?:\r?\n|\r|(?:\\r)?\\n)[\x20\t>#*"'+|]*"""
    line = r"-----{} (?:[A-Z ]*? )?PRIVATE KEY-----"
    body = rf"(?:{turn}[A-Za-z-]+:\x20[^\r\n\\]*)*(?:{turn})?(?:(?:{turn}|[\x20\t]*)[A-Za-z0-9+/]{{32,}}={{0,2}})+(?:{turn}[A-Za-z0-9+/]{{1,31}}={{0,2}}(?:\r?\n|\z))?"
    stated = {  # as they are defined
        "access": ("AKIA[A-Z0-9]+", 20),
        "hex": ("[0-9a-f]+", 24),
        "private_key": (rf"{line.format('BEGIN')}(?:(?:[^-]|-{{1,4}}[^-])*-*{line.format('END')}|{body}|)", 1),
        "jwt": (r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 1),
        "url_login": (r"[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@", 1),
    }
    for r in secrets.RULES:
        pattern, size = stated.get(r.kind, (plain(r.pattern), r.least))
        parts.append(_spans_sql(r.kind, pattern, f"len(regexp_extract(hit, $${pattern}$$, {r.group})) >= {size}"))
    kinds = ", ".join(f"'{r.kind}'" for r in secrets.RULES)
    text = "string_agg(kind || ':' || start || ':' || \"end\", ',' ORDER BY start, place)"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    f AS (SELECT *, list_position([{kinds}], kind) AS place FROM ({" UNION ALL ".join(parts)})),
    g AS (SELECT r, count_if(kind = 'assign') AS a, count_if(kind = 'access') AS b, count_if(kind = 'hex') AS c,
                 {text} FILTER (WHERE place <= 3) AS base, {text} AS spans FROM f GROUP BY r)
    SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (r)"""


@query(_secrets_sql())
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def _licenses_sql() -> str:
    notices = ", ".join(f"('{k}', $${v}$$)" for k, v in licenses.TEMPLATES.items())
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    phrases = " UNION ALL ".join(
        f"SELECT r, i - 1 AS i, '{label}' AS label FROM p WHERE " + " AND ".join(f"w[i + {k}] = '{t}'" for k, t in enumerate(phrase))
        for phrase, label in licenses.PHRASES.items()
    )
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {low.format("coalesce(text, '')")} AS text FROM documents),
    w AS (SELECT r, {words.format("text")} AS w FROM d),
    p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM w WHERE list_contains(w, 'license')),
    b AS ({phrases}),
    bs AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM b GROUP BY r),
    t AS (SELECT label, list_distinct({words.format(low.format("notice"))}) AS w FROM (VALUES {notices}) AS x(label, notice)),
    l AS (SELECT DISTINCT r, list_distinct({words.format("line")}) AS w FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
    m AS (SELECT r, label, max(len(list_intersect(l.w, t.w)) / len(t.w)) AS share FROM l, t
          WHERE len(list_intersect(l.w, t.w)) >= ceil({licenses.THRESHOLD} * len(t.w) - 1e-9) GROUP BY r, label),
    ms AS (SELECT r, list(label) AS labels, max(share) AS share FROM m GROUP BY r)
    SELECT doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
           array_to_string(list_sort(coalesce(bs.labels, [])), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.labels, []), coalesce(ms.labels, [])))), ',') AS labels,
           (CASE WHEN n_base > 0 THEN 1 ELSE coalesce(ms.share, 0) END)::DOUBLE AS score
    FROM d JOIN w USING (r) LEFT JOIN bs USING (r) LEFT JOIN ms USING (r)"""


@query(_licenses_sql())
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_likeness(table(spark, sf_dir, "documents"))


NEAR_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, md5_number(unnest(g)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
c(id, reach) AS (SELECT doc_id, doc_id FROM s UNION SELECT c.id, l.b FROM c JOIN l ON l.a = c.reach),
m AS (SELECT id, min(reach) AS component_id FROM c GROUP BY id)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m ON m.id = s.doc_id
"""


@query(NEAR_SQL)
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op7_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fitted(docs))


@query()
def op6_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.extract(table(spark, sf_dir, "pages"))


@query()
def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats(table(spark, sf_dir, "documents"))


def _codes_sql() -> str:
    """Rounds one after another; products of numbers this small are exact as doubles."""
    ctes = [
        """k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, len(embedding) // 4 AS w,
             list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "p AS MATERIALIZED (SELECT r, part, x, list_dot_product(x, x) AS xx FROM (SELECT r, part, v[part * w + 1:part * w + w] AS x FROM k, range(4) AS q(part)))",
        "c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c, xx AS cc FROM p WHERE r <= 256)",
    ]
    for i in range(5):
        ctes.append(
            f"""a{i} AS MATERIALIZED (SELECT r, part, any_value(x) AS x, min(e)[1]::BIGINT AS error, min(e)[2]::BIGINT AS entry FROM
            (SELECT r, part, x, [xx - 2 * list_dot_product(x, c) + cc, entry] AS e FROM p JOIN c{i} USING (part)) GROUP BY r, part)"""
        )
        if i < 4:
            ctes.append(
                f"""s{i} AS (SELECT part, entry, list(((t - ((t % n) + n) % n) // n)::DOUBLE ORDER BY j) AS c FROM
                (SELECT part, entry, j, sum(x[j])::BIGINT AS t, count(*)::BIGINT AS n FROM a{i}, range(1, len(x) + 1) AS q(j) GROUP BY part, entry, j) GROUP BY part, entry)"""
            )
            ctes.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT part, entry, c, list_dot_product(c, c) AS cc FROM
                (SELECT part, entry, coalesce(s{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN s{i} USING (part, entry)))"""
            )
    return f"""
    WITH {", ".join(ctes)},
    b AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c4),
    e AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(error)::BIGINT AS error FROM a4 GROUP BY r)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM k JOIN e USING (r), b"""


@query(_codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = vectorcodes.compressed(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


REPAIR_SQL = r"""
WITH RECURSIVE g(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) AS q(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM g WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM g WHERE k = 8),
r AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key FROM conversations),
f AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(key, lambda x: ascii(x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault FROM r, crc),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM f WHERE fault <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM d),
w AS MATERIALIZED (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 't' ELSE '' END AS fault FROM o),
nx(q, letter, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(q, q2, cost, x) AS (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'), (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
m AS MATERIALIZED (
  SELECT conv_id, i, q, q AS q2, 3 AS cost, 'D' AS x FROM w, range(4) AS s(q)
  UNION ALL SELECT conv_id, i, q, q2, (fault = 't')::INT, 'K' FROM w JOIN nx ON letter = initial WHERE fault NOT IN ('b', 'd')
  UNION ALL SELECT conv_id, i, q, q2, 2 + (fault = 't')::INT, 'R' FROM w, nx WHERE letter <> 's' AND fault NOT IN ('b', 'd')),
lab(conv_id, i, q, cost, audit) AS (
  SELECT conv_id, 0, q2, cost, x FROM (SELECT DISTINCT conv_id FROM conversations), ins WHERE q = 0
  UNION ALL
  SELECT conv_id, i, q, cost, audit FROM (
    SELECT lab.conv_id, m.i, ins.q2 AS q, lab.cost + m.cost + ins.cost AS cost, lab.audit || m.x || ins.x AS audit
    FROM lab JOIN m ON m.conv_id IS NOT DISTINCT FROM lab.conv_id AND m.i = lab.i + 1 AND m.q = lab.q JOIN ins ON ins.q = m.q2)
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
n AS (SELECT conv_id, count(w.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate,
             count_if(fault = 't') AS truncated, count_if(before || initial NOT IN ('su', 'ua', 'au')) AS illegal
      FROM (SELECT DISTINCT conv_id AS id FROM conversations) LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM id GROUP BY id, conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
b AS (SELECT ids.conv_id, min([lpad(cost::VARCHAR, 9, '0'), audit]) AS best FROM ids LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM ids.conv_id
      JOIN lab ON lab.conv_id IS NOT DISTINCT FROM ids.conv_id AND lab.i = coalesce(n.n, 0) AND lab.q IN (0, 3) GROUP BY ids.conv_id),
c AS (SELECT conv_id, k, audit[k] AS x, count_if(audit[k] <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
             count_if(audit[k] <> 'D') OVER (PARTITION BY conv_id ORDER BY k) + count_if(audit[k] <> 'D') OVER (PARTITION BY conv_id) AS place
      FROM (SELECT conv_id, best[2] AS audit, unnest(range(1, len(best[2]) + 1)) AS k FROM b)),
h AS (SELECT c.conv_id, string_agg(CASE WHEN x = 'K' THEN role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS lines
      FROM c LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.i WHERE x <> 'D' GROUP BY c.conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, best[1]::BIGINT AS cost, best[2] AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM b LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM b.conv_id
"""


@query(REPAIR_SQL)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.audited(turns, F.col("gone"))


LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, i, lines[i] AS line, translate(regexp_replace(lines[i], '^[ 	-]+|[ 	-]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
k AS (SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT r, doc_id, key FROM l WHERE length(key) >= 20) GROUP BY key HAVING count(*) >= 3),
m AS (SELECT l.*, k.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM l LEFT JOIN k ON k.key = l.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""


@query(LINES_SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linededup.deduplicated(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
