"""The stored vector index against all products."""

import numpy as np
import pytest

from chunkwright.operators import retrieve, vectors


def hits(df):
    return sorted((r["query_id"], r["row_id"], r["rank"], r["score"]) for r in df.collect())


def table(spark, x, ids=None, name="row_id"):
    return spark.createDataFrame([(int(i), [float(v) for v in row] if row is not None else None) for i, row in zip(ids if ids is not None else range(len(x)), x, strict=True)], f"{name} long, embedding array<float>")


@pytest.mark.parametrize("k", [1, 5, 40])
def test_clustered(spark, tmp_path, k):
    r = np.random.default_rng(k)
    centres = r.normal(size=(12, 16)) * 3
    x = np.concatenate([centres[i % 12] + r.normal(size=(1, 16)) * 0.2 for i in range(1500)]).astype(np.float32)
    x[700:760] = x[3]  # ties
    v, q = table(spark, [*x, None]), table(spark, [*(centres[:6] + 0.1), x[3], None], name="query_id")
    folder = str(tmp_path / "v")
    vectors.store_vectors(v, folder, block=64)
    got = hits(vectors.search_vectors(q, folder, "query_id", k=k))
    assert got == hits(retrieve.dense_topk(q.where("embedding IS NOT NULL"), v.where("embedding IS NOT NULL"), "query_id", "row_id", k=k)) and len(got) == 7 * k
    used = vectors.search_vectors(q, folder, "query_id", k=k, report=True).first()
    assert used["pairs"] == 7 * 1500 and used["products"] < 0.5 * used["pairs"]


def test_one_part_and_fewer_rows_than_k(spark, tmp_path):
    v = table(spark, [[1, 0], [0, 1], [1, 1]])
    folder = str(tmp_path / "v")
    vectors.store_vectors(v, folder)
    q = table(spark, [[1, 0], [-1, 0]], name="query_id")
    assert hits(vectors.search_vectors(q, folder, "query_id")) == [(0, 0, 0, 1.0), (0, 1, 2, 0.0), (0, 2, 1, 1.0), (1, 0, 1, -1.0), (1, 1, 0, 0.0), (1, 2, 2, -1.0)]
    vectors.store_vectors(v.limit(0), folder)
    assert vectors.search_vectors(q, folder, "query_id").count() == 0 == vectors.search_vectors(q.limit(0), folder, "query_id").count()
