"""Findings of round 4 on the training-data operators."""

import random

import numpy as np

from panelforge.llm import hnsw
from panelforge.llm.lm_scoring import lm_scores


def test_every_round_learns_from_all_windows(spark):
    """More windows than `least` were dealt out to the rounds, so that each was learned from once and not in every round."""
    r = random.Random(11)
    docs = spark.createDataFrame([(i, " ".join(r.choice(("ab", "cd", "efg", "hi")) for _ in range(200))) for i in range(60)], "doc_id long, text string")
    score = lambda **o: {x["doc_id"]: x["score"] for x in lm_scores(docs, **o).collect()}
    many, few = score(least=1), score()
    assert many.keys() == few.keys()
    assert max(abs(many[k] - few[k]) for k in few) < 1e-9


def test_graphs_and_queries_travel_in_small_rows(spark, monkeypatch):
    """A shard's graph was one cell, copied to every block of queries."""
    sizes, kept = [], hnsw.staged

    def staged(df, label):
        out = kept(df, label)
        if label in ("vector-graphs", "vector-queries"):
            sizes.extend(max(len(c) for c in r if isinstance(c, bytes | bytearray)) for r in out.collect())
        return out

    monkeypatch.setattr(hnsw, "staged", staged)
    x = np.random.default_rng(5).normal(size=(2000, 256))
    x[300:600] = x[:300] + 0.1 * x[600:900]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000 + i, v[:3].tolist()) for i, v in enumerate(x[:60])]
    got = {r["vec_id"]: r["n_links"] for r in hnsw.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block_rows=500).collect()}
    for part, first in ((x, 0), (x[:60, :3], 2000)):
        u = part / np.linalg.norm(part, axis=1, keepdims=True)
        want = (u @ u.T >= 0.95).sum(axis=1) - 1
        assert [got[first + i] for i in range(len(part))] == want.tolist()
    assert sizes and max(sizes) <= 1 << 19
