import random
import re

import pytest
from pyspark.sql import functions as F

from threadcorpus.operators import joins
from threadcorpus.operators import threads as T
from threadcorpus.operators.joins import checked_join
from threadcorpus.operators.ordering import keep_first, rank_by_histogram, rank_in_group


def test_rank_in_group_matches_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 2 == 0 else f"g{rnd.randint(0, 40)}"
        rows.append((g, rnd.randint(0, 500), f"id{i}"))
    df = spark.createDataFrame(rows, "g string, t int, id string")
    got = {(r.g, r.id): r.pos for r in rank_in_group(df, ["g"], ["t", "id"], partitions=8).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        for pos, r in enumerate(members, start=1):
            want[(g, r[2])] = pos
    assert got == want


def hot_rows():
    """A hot group with a second of a third of its rows, groups of a few rows, null keys and null times."""
    rnd = random.Random(8)
    rows = [("hot", 77 if i % 3 == 0 else rnd.randint(0, 120), f"id{i}") for i in range(2400)]
    rows += [(rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2, 3]), f"x{i}") for i in range(300)]
    rows += [("hot", None, f"n{i}") for i in range(40)] + [(f"g{i}", i, f"y{i}") for i in range(50)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("max_rows", [joins.BROADCAST_MAX_ROWS, 0])
@pytest.mark.parametrize("bucket_rows", [50, 900, 10_000])
def test_rank_by_histogram_equals_brute_force(spark, monkeypatch, max_rows, bucket_rows):
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", max_rows)
    rows = hot_rows()
    df = spark.createDataFrame(rows, "g string, t int, id string").repartition(6)
    got = {(r.g, r.id): r.pos for r in rank_by_histogram(df, ["g"], ["t", "id"], bucket_rows=bucket_rows).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        some = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want.update({(g, r[2]): pos for pos, r in enumerate(some, start=1)})
    assert got == want and len(got) == len(rows)
    empty = rank_by_histogram(df.limit(0), ["g"], ["t", "id"])
    assert empty.count() == 0 and empty.columns == ["g", "t", "id", "pos"]


def test_rank_by_histogram_moves_rows_once(spark):
    """No range is sampled; buckets of a hot group are dealt apart, and only the counts are joined to the rows."""
    rows = [("hot", i % 700, f"id{i}") for i in range(3000)] + [(f"g{i}", i, f"y{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "g string, t int, id string").repartition(6)
    plan = rank_by_histogram(df, ["g"], ["t", "id"], bucket_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(g", plan)) == 1 and "Exchange rangepartitioning" not in plan
    assert re.search(r"Exchange hashpartitioning\(g#\d+, _bucket", plan) and "BroadcastHashJoin" in plan


def test_first_times_are_those_of_the_kept_posts(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), rnd.choice(["comment", "submission"]), str(rnd.randint(0, 30)), rnd.choice([None, 1, 2, 3]), str(i))
            for i in range(300)]
    posts = spark.createDataFrame(rows, "link_id string, kind string, id string, created_utc bigint, body string")
    for strict in (False, True):
        kept = T.dedup_thread(posts, strict=strict)
        times = sorted((r.link_id, r.created_utc or 0) for r in T.first_times(posts, strict=strict).collect())
        assert times == sorted((r.link_id, r.created_utc or 0) for r in kept.collect())


def test_keep_first_collapses_copies(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("a", 1, "y"), ("b", 2, "z")],
                               "k string, t int, v string")
    got = sorted((r.k, r.t, r.v) for r in keep_first(df, ["k"], ["t", "v"]).collect())
    assert got == [("a", 1, "y"), ("b", 2, "z")]


def test_shuffle_join_equals_broadcast_join(spark):
    big = spark.createDataFrame([("hot", i) for i in range(200)] + [("k1", 1), ("zz", 2)], "w string, n int")
    small = spark.createDataFrame([("hot", 1), ("k1", 2)], "w string, f int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = sorted(map(tuple, checked_join(big, small, "w", how).collect()))
        b = sorted(map(tuple, checked_join(big, small, "w", how, max_rows=0).collect()))
        assert a == b, how


def test_shuffle_join_splits_a_hot_key(spark):
    """A key of a third of the rows is read by several tasks, with a later step grouping by the same key."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 60_000
        key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500)
        big = spark.range(n).repartition(8).select(key.alias("w"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        small = spark.range(-1, 500).select(F.col("id").alias("w"), (F.col("id") * 2).alias("f"))
        joined = checked_join(big, small, "w", max_rows=0).groupBy("w", "f").agg(F.count("*").alias("n"), F.max("v"))
        rows = {r.w: (r.f, r.n) for r in joined.collect()}
        assert rows[-1] == (-2, n // 3) and sum(c for _, c in rows.values()) == n
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_scratch_deletes_its_tables(spark):
    import os
    from threadcorpus.session import materialize, scratch
    before = materialize(spark.range(3))
    with scratch(spark):
        inner = materialize(spark.range(5))
        assert inner.count() == 5
        paths = [f.removeprefix("file://") for f in inner.inputFiles()]
    assert paths and not any(os.path.exists(p) for p in paths)
    assert before.count() == 3


def test_broadcast_bound_counts_bytes(spark):
    from threadcorpus.operators.joins import ROW_BYTES, broadcast_rows
    assert broadcast_rows(spark.createDataFrame([("a", 1)] * 3, "w string, n int")) == 3
    assert broadcast_rows(spark.createDataFrame([("a" * 1000 * ROW_BYTES, 1)], "w string, n int")) > 1000
    assert broadcast_rows(spark.createDataFrame([], "w string")) == 0
    big = spark.createDataFrame([("a" * 50 * ROW_BYTES, 1), ("b", 2)], "w string, n int")
    small = spark.createDataFrame([("a" * 50 * ROW_BYTES, "x")], "w string, v string")
    wide = checked_join(big, small, "w", "left", max_rows=40)
    assert "BroadcastHashJoin" not in wide._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.v or "" for r in wide.collect()) == ["", "x"]


def test_a_hot_thread_is_gathered_in_bounded_chunks(spark, tmp_dir):
    from threadcorpus.operators import gather as G
    from threadcorpus.sources import readers, sinks
    rows = [("hot", "comment", f"{i:05d}", i // 7, "x" * (i % 90)) for i in range(3000)] + [("t", "submission", "a", 1, None), ("t", "comment", "b", 1, "y")]
    posts = spark.createDataFrame(rows, "link_id string, kind string, id string, created_utc bigint, body string").repartition(5)
    chunks = G.gather_threads(posts, ["id", "body"], chunk_bytes=1000)
    sinks.write_threads(chunks, tmp_dir + "/t")
    back = readers.read_gathered(spark, tmp_dir + "/t", chunks.schema)
    assert max(sum(len(p.body or "") for p in r.posts) for r in back.collect()) < 1000 + 90
    assert back.where("link_id = 'hot'").count() > 100
    got = sorted((r.link_id, r.pos, r.id, r.body) for r in G.thread_posts(back).collect())
    want = sorted((t, k == "submission", i, u, b) for t, k, i, u, b in rows)
    hot = [(i, b) for _, _, i, u, b in sorted(want, key=lambda r: (r[0], r[3], r[1], r[2])) if _ is not None and i != "a" and i != "b"]
    assert [(i, b) for t, _, i, b in got if t == "hot"] == hot
    assert [(p, i, b) for t, p, i, b in got if t == "t"] == [(1, "b", "y"), (2, "a", None)]
