"""The registered queries on ``embeddings``, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.llm import codebooks, negatives, neighbours
from flowlens.plans.registry import Registry

VECTORS = Registry()

FINITE = ("vec_id IS NOT NULL AND len(embedding) > 0 AND "
          "list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))")


def table(spark, sf: str):
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def compression_sql(rounds: int = 4) -> str:
    """Lloyd rounds written out; every round is one assignment and one division."""

    def nearest(book: str) -> str:
        return (f"SELECT r, p, x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),"
                f" 'e': e}}) AS best FROM points JOIN {book} USING (p) GROUP BY r, p, x")

    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({nearest(f'b{i}')})")
        steps.append(
            f"m{i} AS MATERIALIZED (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS mean FROM ("
            f"SELECT p, best.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, len(x) + 1)) AS i"
            f" FROM (SELECT x FROM points LIMIT 1)) GROUP BY ALL) GROUP BY p, e)")
        steps.append(f"b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean, c) AS c FROM b{i} LEFT JOIN m{i} USING (p, e))")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE {FINITE}),
points AS MATERIALIZED (
  SELECT r, p, v[1 + p * (len(v) // 4): (p + 1) * (len(v) // 4)] AS x FROM kept, (SELECT unnest(range(4)) AS p)),
b0 AS MATERIALIZED (SELECT p, r AS e, x AS c FROM points WHERE r < 256),
{",".join(steps)},
last AS MATERIALIZED ({nearest(f'b{rounds}')}),
coded AS MATERIALIZED (
  SELECT r, string_agg(lower(lpad(to_hex(best.e), 2, '0')), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM last GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest"""


@VECTORS.add("op11_vector_codes", compression_sql())
def op11(spark, sf):
    return codebooks.compress(table(spark, sf)).drop("label")


@VECTORS.add("op12_hard_negatives", f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND {FINITE}),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS MATERIALIZED (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5""")
def op12(spark, sf):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf).select("vec_id", relabelled.alias("label"), "embedding")
    return negatives.hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))


@VECTORS.add("op13_nearest", f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE {FINITE} AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10""")
def op13(spark, sf):
    vectors = table(spark, sf)
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"))
