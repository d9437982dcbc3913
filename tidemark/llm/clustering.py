"""Operator 13, centroid clustering: exact k-means in integers by shallot search.

Each vector remembers its centroid, the second nearest of its last search, an
upper bound of its distance to the first and a lower bound of that to all
others. A round loosens the bounds by how far centroids moved; where the upper
one is still below the lower one, or below half the way to the next centroid,
nothing is computed but, at most, the distance to the vector's own centroid.
The others search: the two remembered centroids are measured, the search starts
from the closer one and goes through that one's neighbours in order of their
distance from it, inside a ball of the sum of the vector's distances to the
start and to the second best so far, which shrinks as better ones are found.
What survives is compared in whole numbers, ties to the smaller number; bounds
are kept apart by SLACK, so that rounding never decides.

Vectors stay where they are; a round is one pass that writes vectors and bounds,
and one aggregate of sums with a row for each centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents

CENTROIDS, ROUNDS, DIMENSIONS, SCALE = 40, 5, 64, 256
#: Relative distance that bounds keep from each other.
SLACK = 1e-9
#: Rows searched at a time.
ROWS = 8192


def largest(dimensions: int) -> int:
    """Size below which the components of two vectors have a squared distance that fits 64 bits."""
    return int((2**62 / (4 * dimensions)) ** 0.5)


class Search:
    """One round's centroids, with what their search needs: neighbours in order, half the way to the next, and how far each and any other moved."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None):
        self.centroids, k = centroids, len(centroids)
        apart = np.sqrt(((centroids[:, None].astype(float) - centroids[None].astype(float)) ** 2).sum(axis=2))
        np.fill_diagonal(apart, -1)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.away = np.take_along_axis(apart, self.order, axis=1)
        self.half = self.away[:, 1] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else np.sqrt(((centroids.astype(float) - before.astype(float)) ** 2).sum(axis=1))
        top = np.argsort(moved)
        self.moved, self.others = moved, np.full(k, moved[top[-1]])
        self.others[top[-1]] = moved[top[-2]] if k > 1 else 0.0

    def _squares(self, v: np.ndarray, c: np.ndarray) -> np.ndarray:
        d = v - self.centroids[c]
        return np.einsum("ij,ij->i", d, d)

    def run(self, v: np.ndarray, one: np.ndarray, two: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Updates centroid, second, upper and lower bound of each row of v in place; returns which rows searched."""
        upper += self.moved[one]
        lower -= self.others[one]
        bound = np.maximum(lower, self.half[one]) * (1 - SLACK)
        todo = np.flatnonzero(upper >= bound)
        upper[todo] = np.sqrt(self._squares(v[todo], one[todo])) * (1 + SLACK)
        todo = todo[upper[todo] >= bound[todo]]
        if not len(todo) or len(self.centroids) == 1:
            return todo
        x, a, b = v[todo], one[todo].copy(), two[todo].copy()
        da, db = self._squares(x, a), self._squares(x, b)
        swap = (db < da) | (db == da) & (b < a)
        a[swap], b[swap], da[swap], db[swap] = b[swap], a[swap], db[swap], da[swap]
        start, reach = a.copy(), np.sqrt(da)
        first, second = a.copy(), b.copy()
        live = np.arange(len(todo))
        for step in range(1, len(self.centroids)):
            ball = (reach[live] + np.sqrt(db[live])) * (1 + SLACK)
            live = live[self.away[start[live], step] <= ball]
            if not len(live):
                break
            c = self.order[start[live], step]
            new = (c != first[live]) & (c != second[live]) & (c != a[live]) & (c != b[live])
            at, c = live[new], c[new]
            d = self._squares(x[at], c)
            better = (d < da[at]) | (d == da[at]) & (c < a[at])
            nearer = ~better & ((d < db[at]) | (d == db[at]) & (c < b[at]))
            i, j = at[better], at[nearer]
            b[i], db[i], a[i], da[i] = a[i], da[i], c[better], d[better]
            b[j], db[j] = c[nearer], d[nearer]
        one[todo], two[todo] = a, b
        upper[todo], lower[todo] = np.sqrt(da) * (1 + SLACK), np.sqrt(db) * (1 - SLACK)
        return todo


_STATE = "one int, two int, upper double, lower double"


def _assign(search: Search, dimensions: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                b = whole.slice(begin, ROWS)
                v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)
                one, two, upper, lower = (b.column(c).to_numpy(zero_copy_only=False).copy() for c in ("one", "two", "upper", "lower"))
                search.run(v, one, two, upper, lower)
                distance = search._squares(v, one)
                state = [pa.array(one, pa.int32()), pa.array(two, pa.int32()), pa.array(upper), pa.array(lower), pa.array(distance, pa.int64())]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], b.column("v"), *state], names=[*names, "v", "one", "two", "upper", "lower", "distance"])

    return run


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vectors(embedding, ...) of exactly dimensions components, none null or not finite, with v, the whole numbers floor(scale * component)."""
    limit = largest(dimensions)
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = (F.size("embedding") == dimensions) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    small = F.when(F.forall(x, lambda c: F.abs(F.floor(c * scale).cast("double")) < limit), x).otherwise(F.raise_error(F.lit(f"a component times {scale} is {limit} or more: its distances would not fit 64 bits")))
    return vectors.filter(F.coalesce(good, F.lit(False))).withColumn("v", F.transform(small, lambda c: F.floor(c * scale).cast("int")))


def cluster_vectors(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, salt: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """vectors(vec_id, embedding, ...) that are whole, with cluster and distance (squared, in whole numbers), and the centroids.

    The first centroids are the k vectors whose ids hash least (a null id as an
    empty one, then by components). Vectors of another length and those with null
    or non-finite components are left out; fewer vectors than k make fewer
    centroids, equal centroids leave the later ones empty and those stay. Repeated
    rows count each. An empty table gives an empty result. Columns called cluster
    or distance are replaced. Components of more than about 2^27 after scaling are
    an error, as a squared distance would leave 64 bits.
    """
    vectors = vectors.drop("cluster", "distance")
    names = {c: f"in{i}" for i, c in enumerate(vectors.columns)}
    kept = kept_vectors(vectors, dimensions, scale)
    own = kept.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], "v")
    own = cut(own.withColumns({"one": F.lit(0), "two": F.lit(0), "upper": F.lit(float("inf")), "lower": F.lit(float("-inf")), "distance": F.lit(0).cast("bigint")}))
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(names["vec_id"]).cast("string"), F.lit(""))), 256)
    first = own.select(hashed.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r.v for r in first], np.int64).reshape(-1, dimensions)
    now, before = own.withColumn("two", F.lit(1 if len(first) > 1 else 0)), None
    if len(first):
        kinds = ", ".join([*[f"{names[c]} {t}" for c, t in vectors.dtypes], "v array<int>", _STATE, "distance bigint"])
        for turn in range(rounds + 1):
            now = cut(now.mapInArrow(_assign(Search(centroids, before), dimensions, list(names.values())), kinds))
            if turn < rounds:
                sums = now.groupBy("one").agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i].cast("bigint")).alias(f"s{i}") for i in range(dimensions)])
                before, centroids = centroids, centroids.copy()
                for r in sums.collect():
                    centroids[r.one] = [r[f"s{i}"] // r.n for i in range(dimensions)]
    return now.select(*[F.col(n).alias(c) for c, n in names.items()], F.col("one").alias("cluster"), "distance"), centroids


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each vector's cluster; the sums by cluster and the hashes are a row for each centroid, so that they are sent."""
    made, centroids = cluster_vectors(documents(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    hashes = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    sums = made.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    each = sums.crossJoin(F.broadcast(total)).join(F.broadcast(spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")), "cluster")
    return made.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The same by all distances in each round."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {CENTROIDS}))"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT i, min(d) AS d, arg_min(c, d * {CENTROIDS} + c) AS c FROM (
    SELECT i, c, list_sum(list_transform(range(1, {DIMENSIONS + 1}), lambda j: (k.v[j] - c.v[j]) * (k.v[j] - c.v[j])))::BIGINT AS d FROM kept AS k CROSS JOIN c{r} AS c) GROUP BY i)""")
        if r < ROUNDS:
            steps.append(f"""m{r} AS MATERIALIZED (
  SELECT c, list(m ORDER BY j) AS v FROM (
    SELECT c, j, s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END AS m FROM (
      SELECT c, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM (SELECT c, v, unnest(range(1, {DIMENSIONS + 1})) AS j FROM a{r} JOIN kept USING (i)) GROUP BY c, j)) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))""")
    last = ROUNDS
    return f"""WITH {", ".join(steps)}
SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256
FROM a{last} JOIN kept USING (i) JOIN c{last} USING (c)"""


OP13_SQL = _sql()
