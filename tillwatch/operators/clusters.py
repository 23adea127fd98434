"""Distance-to-centroid anomalies by Lloyd's k-means as grouped aggregates.

Standardised coordinates are whole multiples of ``1 / GRID``: sums are exact bigints, so
centres do not depend on how the rows are partitioned.  Only ``k`` rows a pass come to
the driver, the first centres included: each of those is drawn by a race over all rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import unit
from ..schema import q, require_columns, require_list
from ..session import materialize
from .features import standardize
from .quantiles import exact_quantiles

ROUNDS = 12
TOLERANCE = 1e-3  # of a centre's move, in standard deviations
GRID = 1 << 20


def _squares(names: list[str], centers: list[tuple[int, ...]]) -> list[Column]:
    """Squared distances in units of 1 / GRID, as double."""
    def one(name: str, at: int) -> Column:
        apart = (F.col(q(name)) - F.lit(at)).cast("double")
        return apart * apart

    return [sum((one(n, x) for n, x in zip(names[1:], center[1:])), one(names[0], center[0])) for center in centers]


def _nearest(squares: list[Column]) -> Column:
    return F.least(*squares) if len(squares) > 1 else squares[0]


def first_centers(points: DataFrame, names: list[str], k: int, seed: int) -> list[tuple[int, ...]]:
    """k-means++ over all rows: one pass for each centre.

    A row's chance is its squared distance to the centres so far.  With an exponential
    number for each row, the least quotient of number and chance wins with exactly that
    probability; the number comes from the row's key, so any partitioning has one winner.
    """
    centers: list[tuple[int, ...]] = []
    while len(centers) < k:
        chance = _nearest(_squares(names, centers)) if centers else F.lit(1.0)
        drawn = -F.ln(unit(F.lit(seed), F.lit(len(centers)), F.col("__key")) + 1.0 / (1 << 32))
        race = points.select(*[q(n) for n in names], "__key", chance.alias("__chance"), drawn.alias("__drawn"))
        best = race.filter(F.col("__chance") > 0).agg(F.min(F.struct(
            (F.col("__drawn") / F.col("__chance")).alias("t"), "__key", *[F.col(q(n)).alias(f"x{i}") for i, n in enumerate(names)]))).first()[0]
        if best is None:  # fewer different rows than centres
            break
        centers.append(tuple(best[f"x{i}"] for i in range(len(names))))
    return sorted(centers)


def kmeans_anomaly(
    df: DataFrame, feature_columns: list[str], k: int = 5, contamination: float = 0.1, seed: int = 42,
    id_columns: list[str] | None = None, rounds: int = ROUNDS, tolerance: float = TOLERANCE,
) -> DataFrame:
    """Add ``cluster``, ``centroid_distance`` and ``kmeans_anomaly``.

    Features are standardised; rows beyond the ``1 - contamination`` quantile of
    the distance to their nearest centroid are flagged.  Rows missing a feature
    get null, null and false.  Centroids are ``k`` literals, so assignment is a
    plain expression without Python workers; they are refined until none moves by more than
    ``tolerance`` deviations, ``rounds`` times at most.

    The first centres come from ``id_columns`` (the features without them), so that the
    answer does not depend on how the rows are partitioned.
    """
    features = require_list(feature_columns, "feature_columns")
    ids = require_list(id_columns or [], "id_columns")
    require_columns(df, [*features, *ids])
    scaled = standardize(df, features, "__z")
    names = [f"{c}__z" for c in features]
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(q(n)).isNotNull()
    grid = {n: F.round(F.col(q(n)) * GRID).cast("bigint") for n in names}
    key = F.concat_ws(":", *[F.col(q(c)).cast("string") for c in (ids or features)])
    # only the features are written
    points = materialize(scaled.filter(complete).select(*[c.alias(n) for n, c in grid.items()], key.alias("__key")), "features")
    centers = first_centers(points, names, k, seed)
    if not centers:
        return df
    for _ in range(rounds):
        squares = _squares(names, centers)
        assigned = points.select(*[q(n) for n in names], (F.array_position(F.array(*squares), _nearest(squares)).cast("int") - 1).alias("__c"))
        sums = assigned.groupBy("__c").agg(F.count(F.lit(1)).alias("n"), *[
            F.sum(F.col(q(n))).alias(f"s{i}") for i, n in enumerate(names)]).collect()
        moved = list(centers)
        for r in sums:  # a row for each centre
            moved[r["__c"]] = tuple(_rounded(r[f"s{i}"] / r["n"]) for i in range(len(names)))
        far = max(math.dist(a, b) for a, b in zip(centers, moved))
        centers = moved
        if far <= tolerance * GRID:
            break
    centers = sorted(centers)
    squares = _squares(names, centers)
    nearest = _nearest(squares)
    placed = scaled.withColumns(grid).withColumns({
        "cluster": F.when(complete, F.array_position(F.array(*squares), nearest).cast("int") - 1),
        "centroid_distance": F.when(complete, F.sqrt(nearest) / GRID),
    }).drop(*names)
    own = points.select((F.sqrt(nearest) / GRID).alias("centroid_distance"))
    cut = exact_quantiles(own, ["centroid_distance"], [1.0 - contamination])["centroid_distance"][0]
    flag = F.coalesce(F.col("centroid_distance") > F.lit(cut), F.lit(False))
    return placed.withColumn("kmeans_anomaly", flag)


def _rounded(x: float) -> int:
    """To the nearest whole number, halves away from zero."""
    return int(math.copysign(math.floor(abs(x) + 0.5), x))
