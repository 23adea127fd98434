"""SQL twins of the model detectors: the same draws, cuts, sums and centres, level by level."""

from __future__ import annotations

import math

from ..operators import clusters, forest

_HEX = "CAST('0x' || substr({text}, {at}, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


def _unit(*parts: str) -> str:
    return _HEX.format(text="md5(" + " || ':' || ".join(parts) + ")", at=1)


def forest_sql(rows: str, columns: list[str], features: list[str], trees: int = 100, sample: int = 256,
               contamination: float = 0.1, seed: int = 42) -> tuple[str, str]:
    """CTEs and a query over table ``rows`` with key ``id``; for tables of ``sample`` complete rows or more."""
    depth, width = forest.depth_of(sample), range(1, len(features) + 1)
    strides = [i for i in range(1, trees + 1) if math.gcd(i, trees) == 1]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in features)
    path = (f"CASE WHEN n <= 1 THEN 0.0 WHEN n = 2 THEN 1.0 ELSE 2 * (ln(CAST(n - 1 AS DOUBLE)) + {forest._EULER!r}::DOUBLE) "
            "- 2 * CAST(n - 1 AS DOUBLE) / n END")
    parts = [
        f"drawn_from AS MATERIALIZED (SELECT id, [{', '.join(f'CAST({c} AS DOUBLE)' for c in features)}] AS x FROM {rows} WHERE {complete})",
        f"share_of AS (SELECT {trees} * least(1.0::DOUBLE, {forest._OVERSAMPLE}::DOUBLE * {sample} / count(*)) AS share FROM drawn_from)",
        f"""lots AS (SELECT id, x, CAST(floor(share) AS INTEGER) + CAST({_unit(f"'{seed}'", "id")} < share - floor(share) AS INTEGER) AS number,
  CAST(floor({_unit(f"'{seed + 1}'", "id")} * {trees}) AS INTEGER) AS first,
  {strides}[1 + CAST(floor({_unit(f"'{seed + 3}'", "id")} * {len(strides)}) AS INTEGER)] AS stride FROM drawn_from, share_of)""",
        "turns AS (SELECT id, x, first, stride, unnest(range(0, number)) AS turn FROM lots)",
        f"dealt AS (SELECT (first + turn * stride) % {trees} AS tree, id, x FROM turns)",
        f"""p0 AS MATERIALIZED (SELECT tree, 1 AS node, x FROM dealt
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY md5('{seed + 2}:' || tree || ':' || id), id) <= {sample})""",
    ]
    for d in range(depth + 1):
        lows, highs = (", ".join(f"{f}(x[{i}])" for i in width) for f in ("min", "max"))
        able = f"list_filter({list(width)}, lambda i: lo[i] < hi[i])" if d < depth else "[]::INTEGER[]"
        pick = _HEX.format(text="h", at=1)
        parts += [
            f"s{d} AS (SELECT tree, node, count(*) AS n, [{lows}] AS lo, [{highs}] AS hi, md5('{seed}:' || tree || ':' || node) AS h FROM p{d} GROUP BY tree, node)",
            f"a{d} AS (SELECT *, {able} AS able FROM s{d})",
            f"f{d} AS (SELECT *, CASE WHEN len(able) > 0 THEN able[1 + CAST(floor({pick} * len(able)) AS INTEGER)] ELSE 0 END AS f, "
            f"{_HEX.format(text='h', at=9)} AS place FROM a{d})",
            f"""n{d} AS MATERIALIZED (SELECT tree, node, n, f, CASE WHEN lo[f] + (hi[f] - lo[f]) * place >= lo[f] AND lo[f] + (hi[f] - lo[f]) * place < hi[f]
  THEN lo[f] + (hi[f] - lo[f]) * place ELSE lo[f] END AS cut, {d * forest.UNIT} + CAST(round(({path}) * {forest.UNIT}) AS BIGINT) AS length FROM f{d})""",
        ]
        if d < depth:
            parts.append(f"p{d + 1} AS MATERIALIZED (SELECT tree, 2 * node + CAST(x[f] > cut AS INTEGER) AS node, x FROM p{d} JOIN n{d} USING (tree, node) WHERE f > 0)")
    parts.append("forest AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM n{d}" for d in range(depth + 1)) + ")")
    parts.append("w0 AS (SELECT id, x, tree, 1 AS node FROM drawn_from, (SELECT DISTINCT tree FROM p0))")
    for d in range(depth):
        parts.append(f"w{d + 1} AS (SELECT id, x, tree, CASE WHEN f = 0 THEN node ELSE 2 * node + CAST(x[f] > cut AS INTEGER) END AS node "
                     f"FROM w{d} JOIN forest USING (tree, node))")
    scale = float(forest.average_path(sample))
    parts += [
        f"scored AS MATERIALIZED (SELECT id, -pow(2.0::DOUBLE, -((CAST(sum(length) AS DOUBLE) / ({forest.UNIT} * count(*))) / {scale!r}::DOUBLE)) AS score "
        f"FROM w{depth} JOIN forest USING (tree, node) GROUP BY id)",
        f"border AS (SELECT quantile_cont(score, {contamination}) AS cut FROM scored)",
    ]
    return ",\n".join(parts), f"""
SELECT {', '.join(f'{rows}.{c}' for c in columns)}, coalesce(score < border.cut, false) AS isolation_forest_anomaly,
       coalesce(round(score - border.cut, 9), 0.0) AS anomaly_score
FROM {rows} LEFT JOIN scored USING (id), border"""


def kmeans_sql(rows: str, columns: list[str], features: list[str], k: int = 5, contamination: float = 0.1, seed: int = 42) -> tuple[str, str]:
    """The same for k-means; features of table ``rows`` with key ``id``, none of them constant."""
    names = [f"x{i}" for i in range(len(features))]
    listed = ", ".join(names)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in features)
    moments = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS s{i}" for i, c in enumerate(features))
    grid = ", ".join(f"CAST(round((CAST({c} AS DOUBLE) - m{i}) / s{i} * {clusters.GRID}) AS BIGINT) AS x{i}" for i, c in enumerate(features))

    def square(a: str, b: str) -> str:
        return " + ".join(f"CAST({a}.{n} - {b}.{n} AS DOUBLE) * CAST({a}.{n} - {b}.{n} AS DOUBLE)" for n in names)

    parts = [f"m AS (SELECT {moments} FROM {rows} WHERE {complete})",
             f"p AS MATERIALIZED (SELECT id, CAST(id AS VARCHAR) AS key, {grid} FROM {rows}, m WHERE {complete})"]
    for i in range(k):
        chance = f"least({', '.join(square('p', f'c{j}') for j in range(i))})" if i else "1.0::DOUBLE"
        drawn = f"-ln({_unit(repr(str(seed)), repr(str(i)), 'key')} + 1.0::DOUBLE / 4294967296)"
        others = "".join(f", c{j}" for j in range(i))
        parts.append(f"c{i} AS MATERIALIZED (SELECT {', '.join(f'p.{n}' for n in names)} FROM p{others} WHERE {chance} > 0 "
                     f"ORDER BY ({drawn}) / ({chance}), key LIMIT 1)")
    every = " UNION ALL ".join(f"SELECT {listed} FROM c{i}" for i in range(k))
    parts.append(f"k0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {listed}) - 1 AS c, {listed}, false AS done FROM ({every}))")
    for r in range(clusters.ROUNDS):
        moved = ", ".join(f"CASE WHEN o.done OR g.n IS NULL THEN o.{n} ELSE CAST(round(CAST(g.{n} AS DOUBLE) / g.n) AS BIGINT) END AS {n}" for n in names)
        parts += [
            f"a{r} AS (SELECT p.id, arg_min(o.c, ({square('p', 'o')}, o.c)) AS c FROM p, k{r} o GROUP BY p.id)",
            f"g{r} AS (SELECT c, count(*) AS n, {', '.join(f'sum({n}) AS {n}' for n in names)} FROM p JOIN a{r} USING (id) GROUP BY c)",
            f"v{r} AS (SELECT o.c, {moved}, o.done FROM k{r} o LEFT JOIN g{r} g USING (c))",
            f"k{r + 1} AS MATERIALIZED (SELECT v.c, {', '.join(f'v.{n}' for n in names)}, v.done OR "
            f"(SELECT max(sqrt({square('v', 'o')})) FROM v{r} v JOIN k{r} o USING (c)) <= {clusters.TOLERANCE * clusters.GRID} AS done FROM v{r} v)",
        ]
    parts += [
        f"l AS (SELECT row_number() OVER (ORDER BY {listed}) - 1 AS c, {listed} FROM k{clusters.ROUNDS})",
        f"y AS MATERIALIZED (SELECT p.id, arg_min(l.c, ({square('p', 'l')}, l.c)) AS cluster, sqrt(min({square('p', 'l')})) / {clusters.GRID} AS far "
        "FROM p, l GROUP BY p.id)",
        f"o AS (SELECT quantile_cont(far, {1.0 - contamination}) AS cut FROM y)",
    ]
    return ",\n".join(parts), f"""
SELECT {', '.join(f'{rows}.{c}' for c in columns)}, CAST(cluster AS INTEGER) AS cluster, round(far, 6) AS centroid_distance,
       coalesce(far > o.cut, false) AS kmeans_anomaly
FROM {rows} LEFT JOIN y USING (id), o"""


def chain_sql(rows: str) -> str:
    """CTEs that end in ``tally``: how many rows of table ``rows`` (sales with ``id``) each detector of the chain flags."""
    features = ["money", "hour_of_day", '"Weekdaysort"', '"Monthsort"']
    grown, scored = forest_sql(rows, ["id"], features)
    return f"""quartiles AS (SELECT quantile_cont(money, 0.25) AS m1, quantile_cont(money, 0.75) AS m3,
             quantile_cont(hour_of_day, 0.25) AS h1, quantile_cont(hour_of_day, 0.75) AS h3 FROM {rows}),
{grown},
isolated AS ({scored}),
seen AS (SELECT id, money < m1 - 1.5 * (m3 - m1) OR money > m3 + 1.5 * (m3 - m1) AS money_outlier,
        hour_of_day < h1 - 1.5 * (h3 - h1) OR hour_of_day > h3 + 1.5 * (h3 - h1) AS hour_of_day_outlier,
        count(*) OVER by_day = 7 AND min(money) OVER by_day < max(money) OVER by_day
          AND abs(money - avg(money) OVER by_day) > 2 * stddev_samp(money) OVER by_day AS temporal_anomaly,
        min(money) OVER by_product < max(money) OVER by_product
          AND abs(money - avg(money) OVER by_product) > 2 * stddev_samp(money) OVER by_product AS pattern_anomaly
      FROM {rows}, quartiles
      WINDOW by_day AS (ORDER BY "Date", id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), by_product AS (PARTITION BY coffee_name)),
flags AS (SELECT seen.*, money_outlier OR hour_of_day_outlier AS is_outlier, isolation_forest_anomaly FROM seen JOIN isolated USING (id)),
counts AS (SELECT count(*) AS total, count(*) FILTER (money_outlier) AS n1, count(*) FILTER (hour_of_day_outlier) AS n2,
        count(*) FILTER (is_outlier) AS n3, count(*) FILTER (isolation_forest_anomaly) AS n4, count(*) FILTER (temporal_anomaly) AS n5,
        count(*) FILTER (pattern_anomaly) AS n6,
        count(*) FILTER (is_outlier OR isolation_forest_anomaly OR temporal_anomaly OR pattern_anomaly) AS n7 FROM flags),
tally AS (SELECT flag, "count", total FROM counts, LATERAL (VALUES
  ('money_outlier', n1), ('hour_of_day_outlier', n2), ('is_outlier', n3), ('isolation_forest_anomaly', n4),
  ('temporal_anomaly', n5), ('pattern_anomaly', n6), ('combined_anomalies', n7)) AS t(flag, "count"))"""
