"""Packing: every token in one container, none over capacity, boundaries against brute force."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from loomwright.llm import packing as P


def padding(counts, ends):
    return sum(n * (min(e for e in ends if e >= length) - length) for length, n in enumerate(counts) if n and length)


def test_boundaries_are_optimal():
    r = random.Random(2)
    for _ in range(30):
        counts = np.array([0] + [r.choice([0, 1, 5, 20]) for _ in range(11)])
        lengths = [i for i, n in enumerate(counts) if n]
        if not lengths:
            assert P.boundaries(counts) == []
            continue
        for k in (1, 2, 3):
            best = min(padding(counts, (*c, lengths[-1])) for m in range(k) for c in itertools.combinations(lengths[:-1], m))
            assert padding(counts, P.boundaries(counts, k)) == best


def test_plan_places_every_text_once():
    counts = np.zeros(101, np.int64)
    for n, k in ((100, 3), (60, 7), (41, 5), (40, 9), (7, 1000), (1, 50)):
        counts[n] = k
    _, batches = P.plan(counts, 100, 3)
    for length in np.flatnonzero(counts):
        of = batches[batches.length == length].sort_values("rank_from")
        assert of.rank_from.tolist() == [0, *of.rank_to.tolist()[:-1]] and of.rank_to.max() == counts[length]


def placed(batches):
    return sorted(map(tuple, batches[["length", "rank_from", "rank_to", "each", "container"]].to_numpy().tolist()))


def unused(batches, capacity):
    first = batches.drop_duplicates("container")
    containers = ((first.rank_to - first.rank_from) // first.each).sum()
    return 1 - ((batches.rank_to - batches.rank_from) * batches.length).sum() / (containers * capacity)


def test_boundaries_steer_the_batches():
    r = np.random.default_rng(4)
    counts = np.bincount(np.clip(r.lognormal(3.5, 1, 20_000).astype(int), 1, 256), minlength=257)
    one, many, alone = P.plan(counts, 256, 1)[1], P.plan(counts, 256, 8)[1], P.plan(counts, 256, 8, shared=False)
    assert placed(one) != placed(many)
    # the first pass alone keeps to its bucket, the second fills what it left
    ends, alone = alone
    low = np.array([0, *ends])[alone.bucket]
    assert ((alone.length > low) & (alone.length <= np.array(ends)[alone.bucket])).all()
    assert unused(many, 256) < 0.01 < unused(alone, 256)


def test_fill_is_the_fullest():
    r = random.Random(5)
    for _ in range(200):
        lengths = sorted(r.sample(range(1, 20), 4))
        left = np.zeros(20, np.int64)
        for n in lengths:
            left[n] = r.randint(1, 3)
        free = r.randint(1, 40)
        sums = {sum(n * k for n, k in zip(lengths, ks)) for ks in itertools.product(*[range(left[n] + 1) for n in lengths])}
        got = P.Bucket(list(lengths), left).fill(free, False)
        assert sum(n * k for n, k in got.items()) == max(x for x in sums if x <= free)
        assert all(k <= left[n] for n, k in got.items())


def test_pack(spark):
    r = random.Random(3)
    data = [(i, r.choice([0, 1, 3, 3, 3, 9, 15, 16, 17, 40, 200])) for i in range(3000)] + [(7, 3), (7, 3)]
    got = P.pack(spark.createDataFrame(data, "doc_id bigint, n_tokens bigint"), capacity=16, buckets=4)
    used = got.groupBy("container").agg(F.sum("n_tokens").alias("n")).collect()
    total = sum(n for _, n in data)
    assert max(x["n"] for x in used) <= 16 and sum(x["n"] for x in used) == total
    assert total / (16 * len(used)) > 0.97
    whole = got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("piece").alias("p")).filter("doc_id <> 7").collect()
    want = dict(data)
    assert all(x["n"] == want[x["doc_id"]] and (x["p"] == 0) == (x["n"] <= 16) for x in whole)
    parted = P.pack(spark.createDataFrame(data, "doc_id bigint, n_tokens bigint"), capacity=16, buckets=4, ranked=100)
    assert parted.groupBy("container").agg(F.sum("n_tokens").alias("n")).filter("n > 16").count() == 0 and parted.count() == got.count()
    assert P.pack(spark.createDataFrame([], "doc_id bigint, n_tokens bigint")).count() == 0


def test_sizes(spark):
    frame = spark.createDataFrame([(1, "two words", 5), (2, "", 5), (3, None, 5)], "doc_id bigint, text string, n_tokens int")
    assert dict(map(tuple, P.sizes(frame).collect())) == {1: 2, 2: 0, 3: 0}
