"""Centroid clustering (Lloyd rounds) in whole numbers, with JVM expressions only.

Components become integers ``floor(scale * x)``, so distances, sums and means
are exact and the result depends neither on partitions nor on the order of
additions.  In each round the centroids are literal arrays of the plan:

1. ``zip_with`` and ``aggregate`` give the squared distance to each of them;
2. ``array_min`` of structs (distance, number) chooses the nearest, the smaller
   number on a tie;
3. one aggregate with a sum for each component (partial sums in every task, so
   a cluster that holds most vectors is no hot key) gives the new centroids:
   ``k`` rows of ``dim`` sums, all that reaches the driver.

No vector is shuffled, and none is written between rounds: a round reads the
table again and repeats nothing but a projection, so a lost executor costs the
tasks it ran.  A round that changes no centroid is the last one, as all later
ones would repeat it.

Defined results: vectors that are null, of another length, or with a null or
non-finite component are left out.  Fewer vectors than ``k`` give fewer
centroids, an empty table gives no rows.  Starting vectors are those of the
smallest digests; equal digests (one id on several rows) are ordered by the
vector, a null id comes last.  Repeated rows each get a row.  A component
beyond ``LARGEST`` after scaling stops the job with an error that says so, as
its squared distance might not fit 64 bits.  Columns other than the id and the
vector are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

SCALE = 1024
#: 64 components 2 * 2^27 apart give a squared distance of 2^62.
LARGEST = 1 << 27


def scaled(vectors: DataFrame, id_col: str, vector: str, dim: int, scale: int = SCALE) -> DataFrame:
    """(id, v): the usable vectors as arrays of integers."""
    def whole(e: Column) -> Column:
        product = e.cast("double") * float(scale)
        return F.when(F.abs(product) <= LARGEST, F.floor(product)).otherwise(
            F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}")).cast("bigint"))
    finite = F.forall("x", lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    return (vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("x"))
            .where((F.size("x") == dim) & finite).select("id", F.transform("x", whole).alias("v")))


def start(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the ``k`` smallest SHA-256 digests of ``seed:id``, in their order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.select(digest.alias("digest"), "v").orderBy(F.asc_nulls_last("digest"), "v").limit(k)
    return [list(r["v"]) for r in first.collect()]


def _literal(values: list) -> Column:
    """An array of 64-bit integers as one literal (built as text: one call instead of one for each value)."""
    return F.expr(f"cast(split('{','.join(map(str, values))}', ',') as array<bigint>)")


def _distance(centroid: list[int]) -> Column:
    apart = F.zip_with("v", _literal(centroid), lambda a, b: (a - b) * (a - b))
    return F.aggregate(apart, F.lit(0).cast("bigint"), lambda total, d: total + d)


def nearest(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``rows`` with the number of the nearest centroid and the squared distance to it."""
    each = [F.struct(_distance(c).alias("distance"), F.lit(number).alias("cluster")) for number, c in enumerate(centroids)]
    return rows.withColumn("near", F.array_min(F.array(*each))).select(*rows.columns, "near.cluster", "near.distance")


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floor of the mean of each component; one without a vector stays."""
    sums = [F.expr(f"sum(v[{i}]) as s{i}") for i in range(len(centroids[0]))]
    out = list(centroids)
    for r in nearest(rows, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(len(centroids[0]))]
    return out


def fit(rows: DataFrame, k: int, rounds: int, seed: int) -> list[list[int]]:
    """The centroids after ``rounds`` rounds."""
    centroids = start(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        before, centroids = centroids, moved(rows, centroids)
        if centroids == before:
            break
    return centroids


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, id_col: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """Per usable vector: id, cluster, squared distance, inertia of its cluster and of all, digest of its centroid."""
    rows = scaled(vectors, id_col, vector, dim)
    centroids = fit(rows, k, rounds, seed)
    if not centroids:
        kind = vectors.select(id_col).schema[0].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"`{id_col}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    found = nearest(rows, centroids)
    held = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = _literal([held.get(number, 0) for number in range(len(centroids))])
    return found.select(F.col("id").alias(id_col), "cluster", "distance",
                        F.get(inertia, F.col("cluster")).alias("cluster_inertia"),
                        F.lit(sum(held.values())).cast("bigint").alias("inertia"),
                        F.get(F.lit(digests), F.col("cluster")).alias("centroid_sha256"))


def sql(k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, table: str = "embeddings") -> str:
    """DuckDB SQL for ``cluster``: one group of common table expressions for each round."""
    floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    parts = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM {table} WHERE len(embedding) = {dim}
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", f"""
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS INTEGER) AS c, v AS m FROM v
  QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min((d, c)) AS near FROM (
    SELECT v.r, c{i}.c, CAST(list_sum(list_transform(list_zip(v.v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v, c{i}) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(moved.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
    SELECT c, list({floor} ORDER BY i) AS m FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT near[2] AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v JOIN a{i} USING (r)) GROUP BY c, i)
    GROUP BY c) moved USING (c))""")
    return f"""WITH {','.join(parts)},
f AS (SELECT vec_id, near[2] AS cluster, near[1] AS distance FROM v JOIN a{rounds} USING (r))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM f JOIN c{rounds} ON cluster = c"""
