"""Graph search for the largest inner products against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridflow.llm import annsearch


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, id long, query string, code int, rank string"
    return spark.createDataFrame([(i, x, 1, 2, "q", 3, "r") for i, x in rows], schema).repartition(3)


def brute_force(rows, asks, k):
    """{(query, vector): [(vec_id, score)]}, best first."""
    good = {(i, tuple(x)) for i, x in rows if i is not None and x and None not in x and np.all(np.isfinite(x)) and np.any(x)}
    out = {}
    for query, x in good:
        if asks(query):
            others = [(-float(np.dot(x, y)), i) for i, y in good if i != query and len(x) == len(y)]
            out[query, x] = [(i, -s) for s, i in sorted(others)[:k]]
    return out


def clusters(seed, count, dim=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(20, dim)) + 0.5
    x = centers[rng.integers(0, 20, count)] + rng.normal(size=(count, dim)) * 0.5
    x *= rng.choice([0.5, 1, 2], size=(count, 1))
    return [(i, [float(v) for v in row]) for i, row in enumerate(x.astype(np.float32))]


def check(found, wanted, recall):
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    shares = []
    for (query, _), best in wanted.items():
        own = sorted(got.get(query, []))
        assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
        scores = {i: s for i, s in best}
        shares.append(sum(i in scores for _, i, _ in own) / max(1, len(best)))
        assert all(abs(s - scores[i]) < 1e-9 for _, i, s in own if i in scores)
        assert own == sorted(own, key=lambda r: (-r[2], r[1]))
    assert got.keys() == {q for (q, _), best in wanted.items() if best} and np.mean(shares) >= recall


@pytest.mark.parametrize("bucket, beam, least", [(256, 240, 0.9), (16, 40, 0.9), (256, 240, 2.0)])
def test_nearest(spark, bucket, beam, least, monkeypatch):
    """With large and small buckets and beams, and by the comparison of all where no recall is enough."""
    monkeypatch.setattr(annsearch, "BUCKET", bucket)
    monkeypatch.setattr(annsearch, "BEAM", beam)
    monkeypatch.setattr(annsearch, "EXPANDED", beam // 4)
    if least > 1:
        monkeypatch.setattr(annsearch, "LEAST_RECALL", least)
        monkeypatch.setattr(annsearch, "WIDENINGS", 1)
        monkeypatch.setattr(annsearch, "BLOCK", 300)
    rows = clusters(bucket + beam, 1200)
    found, recall = annsearch.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20)
    assert recall >= 0.9
    check(found.collect(), brute_force(rows, lambda i: i % 20 == 0, 20), 1 if least > 1 else 0.9)


def test_nearest_of_odd_tables(spark):
    rows = clusters(3, 40, 4)
    odd = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0]]
    rows += [(100 + 20 * i, x) for i, x in enumerate(odd)] + [(None, rows[0][1]), (None, [9.0] * 4)]
    rows += [(300 + i, rows[20][1]) for i in range(60)] + [rows[20], rows[20]]
    rows += [(400, [1.0, 2.0]), (401, [2.0, 1.0]), (420, [5.0] * 5), (440, rows[1][1]), (440, rows[2][1])]
    rows += [(460, [2.0 ** 100, 0.0, 0.0, 1.0]), (461, [2.0 ** -100, 0.0, 0.0, 0.0])]
    found, _ = annsearch.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 5)
    found = [r for r in found.collect() if r.query_id not in (440, 460)]
    wanted = {k: v for k, v in brute_force(rows, lambda i: i % 20 == 0, 5).items() if k[0] not in (440, 460)}
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.vec_id, pytest.approx(r.score, rel=1e-12)))
    assert {q: sorted(v, key=str) for q, v in got.items()} == {q: sorted(v, key=str) for (q, _), v in wanted.items() if v}
    assert annsearch.nearest(frame(spark, rows).limit(0), F.col("vec_id") % 20 == 0, 5)[0].isEmpty()


def test_search_for_vectors_outside(spark):
    from gridflow.llm.common import Scratch, ready

    rows = clusters(8, 600)
    ready(spark)
    scratch = Scratch(spark, "t")
    index = annsearch.build(frame(spark, rows), scratch)
    asked = [(i, x) for i, x in clusters(9, 40)]
    queries = spark.createDataFrame(asked, "query_id long, embedding array<float>")
    found, recall = annsearch.search(index, queries, 7, scratch)
    x, y = (np.array([v for _, v in r]) for r in (rows, asked))
    best = np.argsort(-(y @ x.T), axis=1)[:, :7]
    got = {}
    for r in found.collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert recall >= 0.9 and np.mean([len(got[i] & set(best[i].tolist())) / 7 for i in range(40)]) >= 0.9


def test_shards_and_steps_make_no_jobs(spark, monkeypatch):
    """A table of several shards is walked whole, and however many steps the walks take, they are the same few jobs."""
    rows, jobs = clusters(11, 1500), []
    monkeypatch.setattr(annsearch, "SHARD", 400, raising=False)
    monkeypatch.setattr(annsearch, "LEAST_RECALL", 0.0)
    for beam in (64, 960):
        monkeypatch.setattr(annsearch, "BEAM", beam)
        spark.sparkContext.setJobGroup(f"beam-{beam}", "")
        try:
            found, recall = annsearch.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, 20)
            found = found.collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"beam-{beam}")))
        assert recall >= 0.9
        check(found, brute_force(rows, lambda i: i % 20 == 0, 20), 0.9)
    assert 0 < jobs[1] <= jobs[0] + 3


def test_lists_of_hubs_are_cut_and_offers_are_the_best():
    rng = np.random.default_rng(2)
    keys = np.array([5] * 130 + [7] * 3 + [9] * 64)
    places, bounds = annsearch.cut(keys, 64, rng)
    assert sorted(places.tolist()) == list(range(len(keys))) and max(np.diff(bounds)) <= 64
    lists = [places[a:b] for a, b in zip(bounds, bounds[1:])]
    assert all(len(set(keys[own].tolist())) == 1 for own in lists) and len(lists) == 5
    x, scale = rng.integers(-127, 128, (200, 8)).astype(np.float32), rng.uniform(0.5, 2, 200)
    graph = annsearch.Graph(x, scale)
    graph.take(np.arange(200), np.array([0, 90, 91, 200]))
    sims = (x @ x.T) * np.outer(scale, scale)
    for own in (range(90), range(91, 200)):
        for i in own:
            best = sorted((j for j in own if j != i), key=lambda j: -sims[i, j])[:annsearch.OFFERS]
            assert graph.near[i].tolist() == best + [-1] * (annsearch.NEIGHBOURS - len(best))
    assert graph.near[90].tolist() == [-1] * annsearch.NEIGHBOURS
