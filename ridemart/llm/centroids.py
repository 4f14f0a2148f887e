"""Centroid clustering of integer vectors, in expressions that Spark runs in the JVM.

Vectors become integers once and are set down. In every round the centroids are literal arrays: zip_with and
aggregate give a vector's squared distance to each, array_min of (distance, number) structs chooses, and plain
sums of the components by cluster, added up in every task before they meet, move the centroids. What reaches
the driver is one row per centroid and round. All arithmetic is exact, so the result does not depend on the
order or the layout of the rows.
"""

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from ridemart.llm.common import stored

SCALE = 256
# Components beyond this (in integers) count as this, so that a squared distance of 64 of them fits a bigint.
MOST = 1 << 27


def _is_whole(vector: Column, dims: int) -> Column:
    """The vector has the right length and only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) == dims) & finite


def to_integers(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int = SCALE) -> DataFrame:
    """The vectors that are kept, as (_id, _v): each component x becomes floor(scale * x), x as double."""
    vector = F.col(vec_col).cast("array<double>")
    most = float(MOST)

    def whole(x: Column) -> Column:
        return F.floor(F.least(F.greatest(x * F.lit(float(scale)), F.lit(-most)), F.lit(most)))

    kept = vectors.select(F.col(id_col).alias("_id"), vector.alias("_x")).filter(_is_whole(F.col("_x"), dims))
    return kept.select("_id", F.transform("_x", whole).alias("_v"))


def _literals(centroids: list[list[int]]) -> Column:
    """The centroids as one literal: an array of structs of number and components."""
    rows = (f"struct({k} AS cluster, array({', '.join(f'{x}L' for x in c)}) AS at)" for k, c in enumerate(centroids))
    return F.expr(f"array({', '.join(rows)})")


def squared_distance(vector: Column, centroid: Column) -> Column:
    apart = F.zip_with(vector, centroid, lambda x, y: x - y)
    return F.aggregate(apart, F.lit(0).cast("bigint"), lambda total, d: total + d * d)


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """Struct of distance and cluster: the smallest distance, then the smallest number."""
    return F.array_min(F.transform(_literals(centroids), lambda centroid: F.struct(
        squared_distance(vector, centroid["at"]).alias("distance"), centroid["cluster"].alias("cluster"),
    )))


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors whose ids have the smallest hex SHA-256 of "seed:id"; equal ones by the vector. A NULL id is empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    ordered = kept.select(F.sha2(name.cast("binary"), 256).alias("_rank"), "_v").orderBy("_rank", "_v")
    return [list(row["_v"]) for row in ordered.limit(k).collect()]


def moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floors of the members' means; a centroid without members stays."""
    assigned = kept.select(nearest(F.col("_v"), centroids)["cluster"].alias("cluster"), "_v")
    sums = [F.expr(f"sum(get(_v, {d}))") for d in range(len(centroids[0]))]
    out = list(centroids)
    for cluster, n, *totals in assigned.groupBy("cluster").agg(F.count(F.lit(1)), *sums).collect():
        out[cluster] = [total // n for total in totals]
    return out


def cluster_vectors(
    vectors: DataFrame, dims: int = 64, k: int = 40, rounds: int = 5, seed: int = 2,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """One row per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none NULL, NaN or infinite; a NULL vector is not kept.
    Each round moves the ``k`` centroids, then vectors are assigned once more: ``distance`` is the squared distance
    to the final centroid, whose components, joined by commas, ``centroid_sha256`` digests. The inertias are
    the sums of distances over the cluster and over all.

    With fewer vectors than ``k`` each of them starts a cluster. Equal distances go to the smaller number. A
    NULL id is kept as such, rows that repeat an id or a vector are vectors each. Integers beyond MOST (some
    500,000 times the unit) count as MOST; an inertia beyond a bigint is NULL. Other columns are ignored, so their names do not matter. An empty
    table gives an empty result.
    """
    kept = stored(to_integers(vectors, id_col, vec_col, dims), "integer-vectors")
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(kept, centroids)
    if not centroids:
        return kept.select(
            F.col("_id").alias(id_col), *[F.lit(None).cast(kind).alias(name) for name, kind in (
                ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
                ("centroid_sha256", "string"),
            )],
        )
    best = nearest(F.col("_v"), centroids)
    assigned = stored(kept.select("_id", best.alias("_best")).select("_id", "_best.*"), "assigned-vectors")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {row["cluster"]: int(row["total"]) for row in assigned.groupBy("cluster").agg(total).collect()}
    digests = [hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest() for centroid in centroids]

    def by_cluster(values: list, kind: str) -> Column:
        every = ", ".join("NULL" if value is None else repr(value) for value in values)
        return F.element_at(F.expr(f"cast(array({every}) AS array<{kind}>)"), F.col("cluster") + 1)

    def fitting(number: int) -> int | None:
        return number if number < 1 << 63 else None

    return assigned.select(
        F.col("_id").alias(id_col), "cluster", "distance",
        by_cluster([fitting(sums.get(c, 0)) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(fitting(sum(sums.values()))).cast("bigint").alias("inertia"), by_cluster(digests, "string").alias("centroid_sha256"),
    )
