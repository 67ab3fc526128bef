"""The fitted encoder against a plain decomposition, and against hashing alone where words differ but mean the same."""

import random

import numpy as np

from chunkwright.functions.encode import HashEncoder
from chunkwright.operators import lsa


def corpus(seed, n):
    """Topics with two vocabularies each; texts of a topic mix both, the queries use one."""
    r = random.Random(seed)
    topics = [([f"t{t}a{i}" for i in range(12)], [f"t{t}b{i}" for i in range(12)]) for t in range(8)]
    common = [f"common{i}" for i in range(30)]
    texts = [" ".join([r.choice(r.choice(topics[i % 8])) for _ in range(25)] + [r.choice(common) for _ in range(25)]) for i in range(n)]
    asked = [" ".join([r.choice(topics[i % 8][0]) for _ in range(4)] + [r.choice(common) for _ in range(6)]) for i in range(80)]
    found = [" ".join([r.choice(topics[i % 8][1]) for _ in range(4)] + [r.choice(common) for _ in range(6)]) for i in range(80)]
    return texts, asked, found


def test_decomposition(spark, tmp_path):
    texts, asked, found = corpus(1, 240)
    df = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string").repartition(3)
    model = lsa.fit(df, dim=8)
    assert np.allclose(model.basis.T @ model.basis, np.eye(8), atol=1e-8)
    row, col, val = lsa.sparse([t.split() for t in texts], model.idf)
    a = np.zeros((len(texts), lsa.SLOTS))
    a[row, col] = val
    want = np.linalg.svd(a, compute_uv=False)[:8]
    assert np.allclose(model.values, want, rtol=1e-3)
    left = np.linalg.norm(a - (a @ model.basis) @ model.basis.T)
    assert left <= 1.002 * np.sqrt((a * a).sum() - (want**2).sum())
    again = lsa.load_encoder(spark, lsa.store_encoder(spark, model, str(tmp_path)))
    assert again.name == model.name and np.array_equal(again.encode(asked), model.encode(asked)) and not model.encode(["", "?"]).any()

    def hits(encoder):
        s = encoder.encode(asked) @ encoder.encode(found).T
        return np.mean([j % 8 == i % 8 for i, j in enumerate(s.argmax(1))])

    assert hits(model) > 0.8 > hits(HashEncoder()) + 0.3


def test_empty(spark):
    assert not lsa.fit(spark.createDataFrame([], "text string"), dim=4).values.any()


def test_a_distinct_token_is_hashed_once(monkeypatch):
    seen, slot = [], lsa.slot
    monkeypatch.setattr(lsa, "slot", lambda t: seen.append(t) or slot(t))
    row, col, val = lsa.sparse([["ab", "cd", "ab"], None, [], ["cd", "ab"]], np.ones(lsa.SLOTS))
    assert sorted(seen) == ["ab", "cd"] and row.tolist() == [0, 0, 3, 3]
    assert np.allclose(np.bincount(row, val**2, 4), [1, 0, 0, 1]) and np.isclose(val[row == 0].max() / val[row == 0].min(), 1 + np.log(2))
