"""Clustering of integer vectors around centroids, in Spark expressions only.

A vector is an array of integers, ``floor(scale * x)`` of every component. In each round the
centroids are literal arrays: ``zip_with`` and ``aggregate`` give the squared distance to each,
``array_min`` over structs of (distance, number) the nearest with ties to the smaller number.
The next centroids are sums of the columns per cluster, combined before the shuffle, so that a
round moves one row per cluster and task. The vectors are written once as integers; only the
centroids, ``clusters`` times ``size`` numbers, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eocube.llm.tables import written

Centroids = list[list[int]]
#: Components up to this size keep every squared distance and its terms within 64 bits (for up to 64 components).
LARGEST = 2**26


def integer_vectors(table: DataFrame, *, size: int = 64, scale: int = 1024) -> DataFrame:
    """``(vec_id, v, norm)`` of the rows of ``(vec_id, embedding)`` with ``size`` finite components.

    ``norm`` is the sum of the squares of ``v``.
    Null vectors, other lengths, null, infinite and NaN components drop the row. A component
    whose integer is beyond ``LARGEST`` is an error, as distances could pass 64 bits.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    small = F.forall("x", lambda c: F.abs(scale * c) < LARGEST)
    kept = table.select("vec_id", x.alias("x")).where((F.size("x") == size) & F.coalesce(finite, F.lit(False)))
    whole = F.transform("x", lambda c: F.floor(c * scale).cast("bigint"))
    vectors = kept.select("vec_id", F.when(small, whole).otherwise(F.raise_error("a component is too large")).alias("v"))
    return vectors.withColumn("norm", F.aggregate("v", F.lit(0).cast("bigint"), lambda s, a: s + a * a))


def starting_centroids(vectors: DataFrame, clusters: int, seed: int) -> Centroids:
    """The vectors with the smallest sha256 of ``seed:vec_id``; null ids last, equal ids by their vector."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = vectors.orderBy(digest.asc_nulls_last(), "v").limit(clusters).collect()
    return [list(r["v"]) for r in chosen]


def squared_distance(centroid: Sequence[int]) -> str:
    """SQL text of ``|v|**2 + |c|**2 - 2 v c``; one literal per component would cost a call to the JVM each."""
    target = ", ".join(f"{-2 * x}L" for x in centroid)
    products = f"zip_with(v, array({target}), (a, b) -> a * b)"
    return f"norm + aggregate({products}, {sum(x * x for x in centroid)}L, (s, p) -> s + p)"


def nearest(centroids: Centroids) -> Column:
    """Struct of the squared distance of ``v`` (and its ``norm``) to the nearest centroid and its number."""
    each = (f"struct({squared_distance(c)} as distance, {k} as cluster)" for k, c in enumerate(centroids))
    return F.expr(f"array_min(array({', '.join(each)}))")


def moved(vectors: DataFrame, centroids: Centroids, exact: bool) -> Centroids:
    """One round: every centroid with vectors becomes the floor of their mean."""
    size = len(centroids[0])
    # 64-bit sums where they provably hold every vector, decimals beyond
    kind = "bigint" if exact else "decimal(38,0)"
    placed = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = placed.groupBy("cluster").agg(
        F.count("*").alias("n"), *(F.expr(f"sum(cast(v[{i}] as {kind})) as s{i}") for i in range(size))
    )
    out = list(centroids)
    for r in sums.collect():
        out[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(size)]
    return out


def cluster_vectors(
    table: DataFrame, *, clusters: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3
) -> DataFrame:
    """Cluster the vectors of ``(vec_id, embedding)`` in a fixed number of rounds.

    Returns ``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per kept
    row: squared distances in integers, their sums over the cluster and over all, and the hash
    of the final centroid's components as decimals joined by commas. Rows that
    :func:`integer_vectors` drops are not returned. Repeated rows count as often as they occur;
    a null ``vec_id`` is clustered like any other. With fewer vectors than ``clusters`` there
    are as many centroids as vectors, without any the result is empty; other columns are ignored.
    """
    vectors = written(integer_vectors(table, size=size, scale=scale), "vectors")
    centroids = starting_centroids(vectors, clusters, seed)
    if not centroids:
        return vectors.selectExpr(
            "vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256"
        )
    n, largest = vectors.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs)))).first()
    for _ in range(rounds):
        centroids = moved(vectors, centroids, exact=n * (largest + 1) < 2**62)
    near = nearest(centroids)
    placed = written(vectors.select("vec_id", near.alias("near")).select("vec_id", "near.*"), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    number = F.col("cluster")
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        F.lit([inertia.get(k, 0) for k in range(len(centroids))]).cast("array<bigint>")[number].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        F.lit(names)[number].alias("centroid_sha256"),
    )


def _round_sql(k: int) -> str:
    """Assignment to the centroids of round ``k`` and the centroids after it, as common table expressions."""
    return f"""
, d{k} as (select r, k, sum((x - c) * (x - c))::bigint as d from v join c{k} using (i) group by r, k)
, a{k} as (select r, k, d from d{k} qualify row_number() over (partition by r order by d, k) = 1)
, s{k} as (select k, i, sum(x)::bigint as s, count(*)::bigint as n from v join a{k} using (r) group by k, i)
, c{k + 1} as (select c{k}.k, c{k}.i, coalesce((s - ((s % n) + n) % n) // n, c)::bigint as c from c{k} left join s{k} using (k, i))"""


#: The clustering of ``embeddings`` in SQL, for 64 components, 8 clusters and 10 rounds.
CLUSTER_SQL = (
    """
with kept as materialized (
  select vec_id, embedding, row_number() over () as r from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), v as materialized (
  select r, i, floor(1024 * embedding[i]::double)::bigint as x from kept, range(1, 65) t(i)
), c0 as (
  select k, i, x as c from v join (
    select r, row_number() over (order by sha256('3:' || vec_id)) - 1 as k from kept qualify k < 8
  ) using (r)
)"""
    + "".join(_round_sql(k) for k in range(11))
    + """
, name as (select k, sha256(string_agg(c::varchar, ',' order by i)) as centroid_sha256 from c10 group by k)
, inertia as (select k, sum(d)::bigint as cluster_inertia from a10 group by k)
select vec_id, k::int as cluster, d as distance, cluster_inertia, (select sum(d)::bigint from a10) as inertia, centroid_sha256
from kept join a10 using (r) join name using (k) join inertia using (k)
"""
)
