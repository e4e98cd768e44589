"""A gradient-boosted fit in SQL, tree by tree and level by level, to hold the Spark fit against."""

from querybook.base import WINDOWS
from tenorlake.plans import boosting, training

#: What the queries that name single trees fit: whole rows, so that SQL sees the same ones. Production takes more trees and bins.
OPTIONS = {"max_iter": 4, "subsample": 1.0, "max_bins": 16}
#: The job's own trees and bins. Every tree sees all rows, as the draw of a share hangs on how rows lie in files, which SQL can't see.
WHOLE = {"max_iter": training.BOOSTING_PARAMS["max_iter"], "subsample": 1.0, "max_bins": boosting.MAX_BINS}
DEPTH, MIN_SPLIT, MIN_LEAF, STEP = 3, 50, 20, 0.05


def rows_ctes(features: list[str], max_bins: int) -> list[str]:
    """``lab`` has a row per labelled row and split it falls into, ``filled`` its filled features as a list ``x``, ``cut`` the cuts of each feature, ``m0`` the margin before any tree."""
    train = WINDOWS[0]
    n = len(features)
    cuts = ", ".join(f"{i}.0 / {max_bins}" for i in range(1, max_bins))
    return [
        "lab AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM v_pair)",
        f"tr AS (SELECT * FROM lab WHERE snapshot_date BETWEEN DATE '{train['start_date']}' AND DATE '{train['end_date']}')",
        f"med AS (SELECT [{', '.join(f'median({f})' for f in features)}] AS md FROM tr)",
        f"filled AS MATERIALIZED (SELECT id, label, snapshot_date, [{', '.join(f'coalesce({f}, md[{i + 1}])::DOUBLE' for i, f in enumerate(features))}] AS x FROM lab, med)",
        "cut AS MATERIALIZED (" + " UNION ALL ".join(
            f"SELECT {i} AS f, row_number() OVER (ORDER BY c) AS k, c FROM (SELECT DISTINCT unnest(quantile_cont(x[{i}], [{cuts}])) AS c FROM filled WHERE id IN (SELECT id FROM tr))"
            for i in range(1, n + 1)) + ")",
        "cs AS (SELECT list(own ORDER BY f) AS cs FROM (SELECT f, list(c ORDER BY k) AS own FROM cut GROUP BY f))",
        f"""m0 AS MATERIALIZED (SELECT id, label, list_transform(range(1, {n + 1}), lambda i: len(list_filter(cs[i], lambda c: c <= x[i]))) AS bins,
              id IN (SELECT id FROM tr) AS fits, (SELECT ln(sum(label) / (count(*) - sum(label))) FROM tr) AS m FROM filled, cs)""",
    ]


def fit_sql(features: list[str], result: str) -> str:
    """Common tables and ``result``, which reads them.

    ``m<t>`` has the margin before tree t; ``b<t>_<level>`` the splits of a level; ``leaf<t>`` the leaves.
    """
    n = len(features)
    ctes = rows_ctes(features, OPTIONS["max_bins"])
    for t in range(OPTIONS["max_iter"]):
        ctes.append(f"n{t}_0 AS MATERIALIZED (SELECT id, label, bins, fits, m, 1 / (1 + exp(-m)) AS p, 1 AS node FROM m{t})")
        for d in range(DEPTH):
            ctes += [
                f"""h{t}_{d} AS MATERIALIZED (SELECT node, f, bins[f] AS b, sum(label - p) AS r, count(*) AS n FROM n{t}_{d}, range(1, {n + 1}) AS q(f) WHERE fits GROUP BY ALL)""",
                f"""b{t}_{d} AS MATERIALIZED (
                  SELECT node, f, k, c, rows, gain FROM (
                    SELECT *, round(nl * (rows - nl) / rows * (rl / nl - (total - rl) / (rows - nl)) ** 2, 6) AS gain FROM (
                      SELECT node, f, k, c, sum(n) AS rows, sum(r) AS total, coalesce(sum(n) FILTER (b < k), 0)::DOUBLE AS nl, coalesce(sum(r) FILTER (b < k), 0) AS rl
                      FROM h{t}_{d} JOIN cut USING (f) GROUP BY ALL)
                    WHERE rows >= {MIN_SPLIT} AND nl >= {MIN_LEAF} AND rows - nl >= {MIN_LEAF})
                  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, k) = 1)""",
                f"""n{t}_{d + 1} AS MATERIALIZED (SELECT id, label, bins, fits, m, p, CASE WHEN k IS NULL THEN node WHEN bins[f] < k THEN 2 * node ELSE 2 * node + 1 END AS node
                  FROM n{t}_{d} LEFT JOIN b{t}_{d} USING (node))""",
            ]
        ctes += [
            f"leaf{t} AS MATERIALIZED (SELECT node, count(*) AS n, sum(label - p) / sum(p * (1 - p)) AS value FROM n{t}_{DEPTH} WHERE fits GROUP BY node)",
            f"m{t + 1} AS MATERIALIZED (SELECT id, label, bins, fits, m + {STEP} * value AS m FROM n{t}_{DEPTH} JOIN leaf{t} USING (node))",
        ]
    return f"WITH {', '.join(ctes)} {result}"


def splits_sql() -> str:
    """All splits: tree, node, feature number, cut, rows and gain."""
    return " UNION ALL ".join(f"SELECT {t} AS tree, * FROM b{t}_{d}" for t in range(OPTIONS["max_iter"]) for d in range(DEPTH))


def leaves_sql() -> str:
    return " UNION ALL ".join(f"SELECT {t} AS tree, * FROM leaf{t}" for t in range(OPTIONS["max_iter"]))


def whole_fit_sql(features: list[str], result: str) -> str:
    """The fit of ``WHOLE``: as in ``fit_sql``, with one step of a recursion per tree, as texts of so many trees can't be planned; ``margin`` has the margins after the last."""
    n = len(features)
    levels = []
    for d in range(DEPTH):
        levels += [
            f"h{d} AS MATERIALIZED (SELECT node, f, bins[f] AS b, sum(label - p) AS r, count(*) AS n FROM n{d}, range(1, {n + 1}) AS q(f) WHERE fits GROUP BY ALL)",
            f"""b{d} AS MATERIALIZED (
              SELECT node, f, k FROM (
                SELECT *, round(nl * (rows - nl) / rows * (rl / nl - (total - rl) / (rows - nl)) ** 2, 6) AS gain FROM (
                  SELECT node, f, k, sum(n) AS rows, sum(r) AS total, coalesce(sum(n) FILTER (b < k), 0)::DOUBLE AS nl, coalesce(sum(r) FILTER (b < k), 0) AS rl
                  FROM h{d} JOIN cut USING (f) GROUP BY ALL)
                WHERE rows >= {MIN_SPLIT} AND nl >= {MIN_LEAF} AND rows - nl >= {MIN_LEAF})
              WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, k) = 1)""",
            f"""n{d + 1} AS MATERIALIZED (SELECT id, tree, label, bins, fits, m, p, CASE WHEN k IS NULL THEN node WHEN bins[f] < k THEN 2 * node ELSE 2 * node + 1 END AS node
              FROM n{d} LEFT JOIN b{d} USING (node))""",
        ]
    trees = f"""grown(id, tree, m) AS (SELECT id, 0, m FROM m0 UNION ALL (
        WITH n0 AS MATERIALIZED (SELECT id, tree, label, bins, fits, grown.m, 1 / (1 + exp(-grown.m)) AS p, 1 AS node FROM grown JOIN m0 USING (id) WHERE tree < {WHOLE["max_iter"]}),
        {", ".join(levels)},
        leaf AS MATERIALIZED (SELECT node, sum(label - p) / sum(p * (1 - p)) AS value FROM n{DEPTH} WHERE fits GROUP BY node)
        SELECT id, tree + 1, m + {STEP} * value FROM n{DEPTH} JOIN leaf USING (node)))"""
    last = f"margin AS (SELECT id, label, grown.m FROM grown JOIN m0 USING (id) WHERE tree = {WHOLE['max_iter']})"
    return f"SELECT * FROM (WITH RECURSIVE {', '.join([*rows_ctes(features, WHOLE['max_bins']), trees, last])} {result})"


def evaluation_sql(margins: str | None = None) -> str:
    """Split, rows, accuracy and AUC; AUC from the mean ranks of tied scores. ``margins`` names the table of margins, that after the last tree of ``OPTIONS`` if not given."""
    margins = margins or f"m{OPTIONS['max_iter']}"
    return f"""
    SELECT w.split, count(id) AS n, avg(CASE WHEN id IS NOT NULL THEN (label = (s > 0.5)::INT)::INT END) AS accuracy,
           (sum(rank) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
             / nullif(count(*) FILTER (label = 1) * count(*) FILTER (label = 0), 0) AS roc_auc
    FROM v_windows w LEFT JOIN (
      SELECT split, id, label, s, rank() OVER (PARTITION BY split ORDER BY s) + (count(*) OVER (PARTITION BY split, s) - 1) / 2 AS rank
      FROM (SELECT split, m.id, m.label, round(1 / (1 + exp(-m.m)), 12) AS s FROM {margins} m JOIN filled USING (id) JOIN v_windows ON snapshot_date BETWEEN start_date AND end_date)) USING (split)
    GROUP BY w.split"""
