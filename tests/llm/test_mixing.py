import numpy as np

from vaunu.llm.mixing import mix, shares, split

SIZED = "doc_id long, source string, n_tokens int"
TARGETS = "source string, target_share double, max_repeats int"


def test_split_keeps_quotas():
    out = split(np.array([100, 0, 7]), 5, np.random.default_rng(1))
    assert out.shape == (5, 3) and out.sum(axis=0).tolist() == [100, 0, 7] and (out >= 0).all()
    assert max(out.sum(axis=1)) - min(out.sum(axis=1)) <= 2


def test_mix(spark):
    rows = [(i, "big", 10) for i in range(4000)] + [(10_000 + i, "small", 7) for i in range(300)] + [(20_000, "big", None), (20_001, None, 9)]
    rows += [(20_002, "other", 9), (20_003, "small", 0)]
    df = spark.createDataFrame(rows, SIZED)
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("none", 0.0, 1), (None, 0.3, 1)], TARGETS)
    out = mix(df, targets, shards=4).collect()
    got = {r.source: r for r in shares(mix(df, targets, shards=4), targets).collect() if r.source}
    assert abs(got["small"].actual_share - 0.4) < 0.01 and got["small"].most_repeats == 3 and got["big"].most_repeats == 1
    assert len({(r.doc_id, r.repeat) for r in out}) == len(out) and {r.doc_id for r in out} <= set(range(20_000))
    for s in range(4):
        assert sorted(r.position for r in out if r.shard == s) == list(range(1, sum(r.shard == s for r in out) + 1))
    assert {tuple(r) for r in mix(df.repartition(7), targets, shards=4).collect()} == {tuple(r) for r in out}


def test_empty(spark):
    empty = spark.createDataFrame([], SIZED)
    targets = spark.createDataFrame([("a", 1.0, 2)], TARGETS)
    assert mix(empty, targets).collect() == []
    assert [r.n_tokens for r in shares(mix(empty, targets), targets).collect()] == [0]


def test_every_token_is_accounted_for(spark):
    """Actual shares meet their targets to a record, each draw is distinct, no source is repeated too often, whatever the number of shards."""
    rng = np.random.default_rng(3)
    rows = [(i, "abc"[int(rng.choice(3, p=[0.7, 0.2, 0.1]))], int(rng.integers(1, 90))) for i in range(6000)]
    targets = {"a": (0.2, 1), "b": (0.5, 2), "c": (0.3, 4)}
    df = spark.createDataFrame(rows, SIZED)
    wanted = spark.createDataFrame([(s, *t) for s, t in targets.items()], TARGETS)
    for shards in (1, 300):
        out = mix(df, wanted, shards=shards, block_rows=8).collect()
        have = {s: sum(n for _, t, n in rows if t == s) for s in targets}
        total = min(have[s] * r / share for s, (share, r) in targets.items())
        for source, (share, repeats) in targets.items():
            drawn = [r for r in out if r.source == source]
            assert abs(sum(r.n_tokens for r in drawn) - total * share) <= 90 and max(r.repeat for r in drawn) < repeats
        assert len({(r.doc_id, r.repeat) for r in out}) == len(out)
        by_shard = {}
        for r in out:
            by_shard.setdefault(r.shard, []).append(r.position)
        assert all(sorted(p) == list(range(1, len(p) + 1)) for p in by_shard.values()) and max(by_shard) < shards
