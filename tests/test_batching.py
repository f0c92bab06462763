"""Positions, chunks, shards, batches (B0–B8, O6) and their partition properties."""

import pytest
from pyspark.sql import functions as F

from latentforge.operators import batching as bt
from latentforge.operators.positions import cumulative, with_position
from latentforge.operators.sampling import epoch_shuffle


def ids(spark, n):
    return spark.range(n).select(F.col("id"))


def sizes(df, col):
    return [r[1] for r in sorted(df.groupBy(col).count().collect())]


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_positions_do_not_depend_on_partitioning(spark, parts):
    df = ids(spark, 1000).repartition(parts)
    got = with_position(df, ["id"], num_buckets=16, size_col="n").collect()
    assert sorted((r.id, r.pos) for r in got) == [(i, i) for i in range(1000)]
    assert {r.n for r in got} == {1000}


def test_positions_within_groups_with_hot_group(spark):
    # one group holds most rows: it is split over many buckets, result exact
    df = spark.range(3000).select("id", F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id") % 5).alias("g"))
    got = with_position(df, ["id"], partition_by=["g"], num_buckets=32, size_col="n").collect()
    by_g = {}
    for r in got:
        by_g.setdefault(r.g, []).append((r.id, r.pos, r.n))
    for g, rs in by_g.items():
        rs.sort()
        assert [p for _, p, _ in rs] == list(range(len(rs)))
        assert {n for _, _, n in rs} == {len(rs)}


def test_null_partition_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 1)], "id long, g long")
    got = sorted((r.id, r.pos) for r in with_position(df, ["id"], partition_by=["g"], num_buckets=4).collect())
    assert got == [(1, 0), (2, 1), (3, 0)]


def test_running_sum(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("double").alias("v"))
    got = sorted((r.id, r.c) for r in cumulative(df, ["id"], {"c": F.col("v")}, num_buckets=8).collect())
    acc, want = 0.0, []
    for i in range(100):
        acc += i % 3
        want.append((i, acc))
    assert got == want


def test_chunks_floor(spark):
    assert sizes(bt.chunks_floor(ids(spark, 10), 4), "chunk") == [2, 2, 2, 2, 2]
    assert sizes(bt.chunks_floor(ids(spark, 3), 4), "chunk") == [3]


def test_chunks_floor_min1(spark):
    assert sizes(bt.chunks_floor_min1(ids(spark, 3), 4), "chunk") == [1, 1, 1]
    assert sizes(bt.chunks_floor_min1(ids(spark, 10), 4), "chunk") == [2] * 5


def test_chunks_ceil(spark):
    assert sizes(bt.chunks_ceil(ids(spark, 10), 4), "chunk") == [3, 3, 3, 1]
    assert sizes(bt.chunks_ceil(ids(spark, 9), 4), "chunk") == [3, 3, 3]


def test_round_robin(spark):
    got = sorted({(r.batch, r.worker) for r in bt.round_robin(ids(spark, 20), 8, 2).collect()})
    assert got == [(0, 0), (1, 1), (2, 0)]


def test_rank_shards(spark):
    assert sizes(bt.rank_shards(ids(spark, 10), 4), "rank") == [2, 2, 2, 4]
    assert sizes(bt.rank_shards(ids(spark, 3), 4), "rank") == [3]
    assert [r.rank for r in bt.rank_shards(ids(spark, 3), 4).collect()] == [3, 3, 3]


def test_epoch_sampler_drop_last(spark):
    s = bt.epoch_sampler(ids(spark, 10), "id", world=4, epoch=0)
    assert s.count() == 8
    assert sizes(s, "rank") == [2, 2, 2, 2]
    assert s.select("id").distinct().count() == 8


def test_epoch_sampler_new_permutation_per_epoch(spark):
    a = [r.id for r in epoch_shuffle(ids(spark, 50), "id", 0).orderBy("pos").collect()]
    b = [r.id for r in epoch_shuffle(ids(spark, 50), "id", 1).orderBy("pos").collect()]
    assert sorted(a) == sorted(b) == list(range(50)) and a != b


def test_loader_batches(spark):
    df = ids(spark, 70).select("id", F.lit(0).alias("rank"), F.col("id").alias("local"))
    b = bt.loader_batches(df, 32)
    assert b.count() == 64 and sizes(b, "batch") == [32, 32]


def test_shard_then_sampler_trap(spark):
    """Rank slicing *and* a distributed sampler: each rank sees n/W² rows."""
    n, w = 16, 4
    shards = bt.rank_shards(ids(spark, n), w)
    seen = 0
    for r in range(w):
        mine = shards.where(F.col("rank") == r).select("id")
        seen += bt.epoch_sampler(mine, "id", world=w, epoch=0).where(F.col("rank") == r).count()
    assert seen == n // w        # 4 of 16 rows per epoch
    assert bt.epoch_sampler(ids(spark, n), "id", world=w, epoch=0).count() == n


def test_batches_partition_the_rows(spark):
    b = bt.batches(ids(spark, 97), 10)
    assert b.count() == 97 and b.select("id").distinct().count() == 97
    assert sizes(b, "batch") == [10] * 9 + [7]


def test_empty_and_tiny_inputs(spark):
    empty = spark.range(0).select(F.col("id"))
    assert with_position(empty, ["id"], num_buckets=4).count() == 0
    assert bt.batches(empty, 8).count() == 0
    assert bt.chunks_ceil(empty, 4).count() == 0
    assert bt.epoch_sampler(empty, "id", 4, 0).count() == 0
    # fewer rows than workers
    assert sizes(bt.chunks_ceil(ids(spark, 3), 4), "chunk") == [1, 1, 1]
    assert sorted(r.rank for r in bt.rank_shards(ids(spark, 2), 4).collect()) == [3, 3]
    assert bt.epoch_sampler(ids(spark, 3), "id", 4, 0).count() == 0      # 3 div 4 = 0 per rank


def test_epoch_sampler_without_drop_last_pads(spark):
    s = bt.epoch_sampler(ids(spark, 10), "id", world=4, epoch=0, drop_last=False)
    assert s.count() == 12 and sizes(s, "rank") == [3, 3, 3, 3]
    assert s.select("id").distinct().count() == 10


def test_take_prefix_large_uses_positions(spark):
    from latentforge.operators import filters as flt
    got = flt.take_prefix(ids(spark, 30000).repartition(5), 20001, ["id"])
    assert got.count() == 20001 and got.agg(F.max("id")).collect()[0][0] == 20000
    assert flt.take_prefix(ids(spark, 10), 0, ["id"]).count() == 10     # 0 means all


def test_positions_with_null_and_nan_keys(spark):
    vals = [(1, 0.5), (2, None), (3, float("nan")), (4, -2.0), (5, 7.0), (6, None)]
    df = spark.createDataFrame(vals, "id long, k double")
    got = {r.id: r.pos for r in with_position(df, ["k", "id"], num_buckets=3).collect()}
    want = {r.id: i for i, r in enumerate(df.orderBy("k", "id").collect())}   # NULL first, NaN last
    assert got == want


def test_spread_decisions(spark, sf):
    from latentforge.operators.parallel import spread
    from latentforge.sources import views as vw

    def shuffles(df):
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue().count("RoundRobinPartitioning")

    scan = vw.dataset(spark, sf)                       # one file, one row group
    assert shuffles(spread(scan)) == 1
    agg = scan.groupBy("id").count()                   # already shuffled: untouched
    assert shuffles(spread(agg)) == 0
    many = spark.range(0, 1000, numPartitions=64)      # plenty of partitions: untouched
    assert shuffles(spread(many)) == 0
    limited = scan.orderBy("id").limit(5)              # top-k: untouched
    assert shuffles(spread(limited)) == 0


def test_hot_group_is_split_over_ranges(spark):
    from latentforge.operators import positions as ps
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("g"))
    b = ps.ranked(df, ["id"], ["g"], 48).withColumn("r", ps._range())
    hot = b.where("g = 0").groupBy("r").count().collect()
    assert len(hot) >= 12                                  # about a third of the ranges
    assert max(r["count"] for r in hot) < 10000 / 4


def test_hot_first_key_is_split_by_the_later_ones(spark):
    from latentforge.operators import positions as ps
    df = spark.range(20000).select("id", F.when(F.col("id") % 10 != 0, F.lit("x")).alias("k")).repartition(7)
    order = [F.col("k").desc(), F.col("id").desc()]
    b = ps.ranked(df, order, num_buckets=16).withColumn("r", ps._range())
    assert max(r["count"] for r in b.groupBy("r").count().collect()) < 20000 / 8
    got = {r.id: r.pos for r in with_position(df, order, num_buckets=16).collect()}
    assert got == {r.id: i for i, r in enumerate(df.orderBy(*order).collect())}


def test_positions_read_the_input_no_more_than_the_sort_does(spark):
    """The stored rows are numbered: the plan scans one file table, twice."""
    import contextlib
    import io
    df = with_position(ids(spark, 100), ["id"], size_col="n")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert "Range (" not in plan and plan.count("FileScan parquet") == 2
    assert "ReadSchema: struct<_lf_at:bigint>" in plan                    # counting reads one column


def test_position_columns_that_exist_are_replaced(spark):
    df = ids(spark, 10).withColumns({"pos": F.lit(-1), "n": F.lit(-1)})
    got = with_position(df, ["id"], size_col="n")
    assert sorted(got.columns) == ["id", "n", "pos"]
    assert sorted(map(tuple, got.select("id", "pos", "n").collect())) == [(k, k, 10) for k in range(10)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97, 576, 577, 5000])
def test_permutations_are_exact(spark, n):
    from latentforge.functions.rand import with_permuted
    df = spark.range(n)
    seen = set()
    for seed in range(3):
        p = [r[0] for r in with_permuted(df.withColumn("n", F.lit(n).cast("long")), "id", "n", seed, "p").select("p").collect()]
        assert sorted(p) == list(range(n))
        seen.add(tuple(p))
    assert n < 5 or len(seen) == 3


def test_permutations_mix(spark):
    """Neighbours are parted, and the permuted places are spread evenly."""
    from latentforge.functions.rand import with_permuted
    n = 40_000
    p = [r[0] for r in with_permuted(
        spark.range(n, numPartitions=1).withColumn("n", F.lit(n).cast("long")), "id", "n", 11, "p").select("p").collect()]
    close = sum(abs(a - b) <= 20 for a, b in zip(p, p[1:]))
    assert close < 3 * n * 40 / n + 40
    first = [x for x in p[:n // 10] if x < n // 10]
    assert abs(len(first) - n / 100) < 5 * (n / 100) ** 0.5
    rising = sum(a < b for a, b in zip(p, p[1:]))
    assert abs(rising - n / 2) < 5 * (n / 12) ** 0.5


def test_large_numbers_are_permuted_within_range(spark):
    from latentforge.functions.rand import with_permuted
    n = 10 ** 15 + 37
    got = [r[0] for r in with_permuted(spark.range(n - 2000, n).withColumn("n", F.lit(n)), "id", "n", "x", "p")
           .select("p").collect()]
    assert len(set(got)) == 2000 and 0 <= min(got) and max(got) < n
    assert abs(sum(got) / 2000 / n - 0.5) < 0.05


def test_epochs_of_numbered_rows_sort_nothing(spark):
    import contextlib
    import io
    rows = with_position(ids(spark, 300), ["id"], pos_col="index", size_col="n").checkpoint()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        epoch_shuffle(rows, "id", 5).explain()
    assert "Exchange" not in buf.getvalue() and "Sort" not in buf.getvalue()
    again = {r.id: r.pos for r in epoch_shuffle(ids(spark, 300).repartition(3), "id", 5).collect()}
    assert {r.id: r.pos for r in epoch_shuffle(rows, "id", 5).collect()} == again


def test_samples_are_the_rows_with_the_smallest_hashes(spark):
    from latentforge.functions.rand import hash_hex
    from latentforge.operators.sampling import sample_n
    df = ids(spark, 3000).repartition(6)
    want = [r.id for r in df.orderBy(hash_hex(4, F.col("id")), "id").collect()]
    for n in (0, 1, 7, 1500, 2999, 3000, 4000):
        assert sorted(r.id for r in sample_n(df, n, "id", 4).collect()) == sorted(want[:n])
    with pytest.raises(ValueError):
        sample_n(df, 3001, "id", 4, strict=True)
    assert sample_n(df, 3000, "id", 4, strict=True).count() == 3000
    same = spark.createDataFrame([(1, k) for k in range(50)] + [(2, 0), (None, 1)], "id long, x int")
    assert sample_n(same, 20, "id").count() == 20 and sample_n(same, 60, "id").count() == 52
    assert sample_n(df.where("false"), 5, "id").count() == 0


@pytest.mark.parametrize("order", [["id"], ["s", "id"], ["d", "id"]])
def test_both_ways_to_take_a_prefix_agree(spark, monkeypatch, order):
    from latentforge.operators import filters as flt
    df = spark.range(500).select("id", F.when(F.col("id") % 9 != 0, F.md5(F.col("id").cast("string"))).alias("s"),
                                 F.when(F.col("id") % 11 == 0, F.lit(float("nan"))).otherwise(-F.col("id") % 7 / 2)
                                 .alias("d")).repartition(4)
    for keys in (order, [F.col(c).desc() for c in order], [F.col(order[0]).desc_nulls_first(), *order[1:]]):
        small = sorted(r.id for r in flt.take_prefix(df, 123, keys).collect())
        with monkeypatch.context() as m:
            m.setattr(flt, "TOPK_ROWS", 0)
            assert sorted(r.id for r in flt.take_prefix(df, 123, keys).collect()) == small
