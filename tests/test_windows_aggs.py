"""Windows and aggregates with hand rows."""

import math

from pyspark.sql import functions as F

from latentforge.operators import aggregates as agg
from latentforge.operators import joins as jn
from latentforge.operators import windows as win
from latentforge.plans import scaling


def test_ema_closed_form(spark):
    rows = [(1, 0, 1.0), (1, 1, 2.0), (1, 2, 3.0)]
    for n, want in [(1, 1.0), (2, 1.5), (3, 2.25)]:
        df = spark.createDataFrame(rows[:n], "k long, t long, v double")
        assert win.ema(df, "k", ["t"], "v", 0.5).collect()[0].ema == want


def test_log_windows(spark):
    df = spark.createDataFrame([(0, 0, 3.0), (0, 1, 3.0), (0, 2, 3.0), (0, 3, 3.0), (0, 4, 6.0), (1, 0, 9.0)],
                               "epoch int, batch_idx long, loss double")
    got = sorted((r.epoch, r.batch_idx, r.logged_loss) for r in win.log_windows(df, 3).collect())
    assert got == [(0, 0, 1.0), (0, 3, 3.0), (1, 0, 5.0)]


def test_checkpoint_loss(spark):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(5)], "epoch int, batch_idx long, loss double")
    r = agg.checkpoint_loss(df, log_interval=3, save_interval=1).collect()[0]
    assert r.checkpoint_loss == (4.0) / 5          # batch 4 after the log at 3


def test_eval_loss(spark):
    empty = spark.createDataFrame([], "batch long, loss double")
    assert math.isinf(agg.eval_loss(empty).collect()[0].eval_loss)
    two = spark.createDataFrame([(0, 1.0), (1, 3.0)], "batch long, loss double")
    assert agg.eval_loss(two).collect()[0].eval_loss == 2.0


def test_scaling_table_from_baseline(spark):
    t = {(r.method, r.workers): r for r in win.scaling_table(scaling.baseline_runs(spark)).collect()}
    assert t[("image-multiprocessing", 2)].speedup == 0.93
    assert t[("image-multiprocessing", 8)].efficiency_pct == 10.47
    assert t[("image-joblib", 1)].speedup == 1.0


def test_compare_methods(spark):
    side = jn.compare_methods(win.scaling_table(scaling.baseline_runs(spark)),
                              ["image-multiprocessing", "image-joblib"]).collect()
    assert len(side) == 4 and "image-joblib_speedup" in side[0].asDict()


def test_progress_eta(spark):
    df = spark.createDataFrame([(i, "success" if i % 4 else "error", 1.0) for i in range(10)],
                               "pos long, status string, value double")
    p = sorted(win.progress(df, ["pos"], 4).collect())
    assert [r.processed for r in p] == [4, 8, 10]
    assert [r.remaining for r in p] == [6, 2, 0]
    assert p[0].eta == "0:00:06" and p[-1].eta == "0:00:00"
    s = sorted(win.running_success_rate(df, ["pos"], 4).collect())
    assert [r.success_rate_pct for r in s] == [75.0, 75.0, 70.0]


def test_processing_summary(spark):
    df = spark.createDataFrame([("success",), ("error",), ("success",)], "status string")
    r = agg.processing_summary(df, 10.0).collect()[0]
    assert (r.successful, r.failed, r.avg_seconds_per_item, r.items_per_second) == (2, 1, 5.0, 0.2)
    none = spark.createDataFrame([("error",)], "status string")
    g = agg.processing_summary(none, 10.0, only_if_success=True).collect()[0]
    assert g.avg_seconds_per_item is None and g.items_per_second is None


def test_collate_bounded_batches(spark):
    df = spark.createDataFrame([(0, 2, "c"), (0, 1, "b"), (1, 3, "d")], "batch long, pos long, caption string")
    got = {r.batch: r.caption for r in agg.collate(df, ["batch"], "pos", ["caption"]).collect()}
    assert got == {0: ["b", "c"], 1: ["d"]}


def test_mse(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 0.0]), ([0.0], [1.0])], "p array<double>, t array<double>")
    assert agg.mse(df, "p", "t").collect()[0].mse == (4.0 + 1.0) / 3


def test_time_saved(spark):
    df = spark.createDataFrame([("std", 4, 2661.98), ("mixed", 4, 2367.94)], "method string, workers int, seconds double")
    r = agg.time_saved(df, "std", "mixed").collect()[0]
    assert r.saved_seconds == 294.04 and r.saved_pct == 11.05


def test_profile_counts_all_rows(spark):
    df = spark.createDataFrame([([1.0], 1), (None, 2), ([1.0, 2.0], None)], "e array<double>, k int")
    p = {r.column_name: r for r in agg.profile(df).collect()}
    assert p["e"].nulls == 1 and (p["e"].min_size, p["e"].max_size) == (1, 2) and p["k"].n_rows == 3


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_key_reductions_aggregate_partially(spark):
    from latentforge.operators import sampling as smp
    # one image holds a third of all captions
    caps = spark.range(30000).select(F.when(F.col("id") < 10000, F.lit(0)).otherwise(F.col("id")).alias("image_id"),
                                     F.col("id").alias("ann_id"), F.lit("a man").alias("caption"))
    pick = smp.pick_one(caps, "image_id", "caption", "ann_id")
    assert "partial_min_by" in _plan(pick)
    assert pick.where("image_id = 0").count() == 1
    events = caps.select(F.col("image_id").alias("k"), F.col("ann_id").alias("t"), F.lit(1.0).alias("v"))
    e = win.ema(events, "k", ["t"], "v", 0.5)
    assert "partial_sum" in _plan(e)
    hot = e.where("k = 0").collect()[0]
    assert hot.updates == 10000 and abs(hot.ema - 1.0) < 1e-12
    assert "partial_count" in _plan(agg.demographics(caps.select("caption")))


def test_ema_equals_a_recursive_query(spark, sf):
    """The merged pairs give what the recurrence gives, update by update."""
    import duckdb
    ev = spark.read.parquet(f"{sf}/events.parquet")
    con = duckdb.connect()
    want = con.sql(f"""
        WITH RECURSIVE x AS (
          SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i
          FROM '{sf}/events.parquet'),
        s(user_id, i, shadow) AS (
          SELECT user_id, i, value FROM x WHERE i = 1
          UNION ALL
          SELECT x.user_id, x.i, CAST(0.3 AS DOUBLE) * x.value + CAST(0.7 AS DOUBLE) * s.shadow
          FROM s JOIN x ON x.user_id = s.user_id AND x.i = s.i + 1)
        SELECT user_id, arg_max(shadow, i), max(i) FROM s GROUP BY user_id""").fetchall()
    want = {u: (s, n) for u, s, n in want}
    for bucket in (None, F.lit(0), F.date_trunc("day", "ts"), F.col("ts")):
        got = {r.user_id: (r.ema, r.updates) for r in win.ema(ev, "user_id", ["ts", "event_id"], "value", 0.7,
                                                              bucket).collect()}
        assert got.keys() == want.keys()
        for u, (s, n) in want.items():
            assert got[u][1] == n and math.isclose(got[u][0], s, rel_tol=1e-9)


def test_ema_of_other_keys_and_odd_rows(spark):
    for kind, keys in (("string", ["aa1", "aa2", "b"]), ("long", [-70000, 3, 900000]), ("double", [0.5, 1.5, 1e9])):
        df = spark.createDataFrame([(1, k, v) for k, v in zip(keys, (1.0, 2.0, 3.0))], f"k long, t {kind}, v double")
        assert win.ema(df, "k", ["t"], "v", 0.5).collect()[0].ema == 2.25
    df = spark.createDataFrame([(1, None, 4.0), (1, 2, None), (None, 1, 5.0)], "k long, t long, v double")
    assert {(r.k, r.ema, r.updates) for r in win.ema(df, "k", ["t"], "v", 0.5).collect()} == {(1, 2.0, 2), (None, 5.0, 1)}
    assert win.ema(df.where("false"), "k", ["t"], "v").count() == 0


def test_log_windows_with_gaps_and_long_tails(spark):
    """Windows run on over epochs without a log point and over missing batches."""
    import random
    rng = random.Random(3)
    rows = [(e, b, float(rng.randrange(9))) for e in (0, 1, 4, 5, 9) for b in range(rng.randrange(1, 30))
            if rng.random() < 0.8]
    rows += [(2, 1, 1.0), (2, 2, 2.0)]                       # an epoch without any log point
    want, total, n = [], 0.0, 0
    for e, b, x in sorted(rows):
        total, n = total + x, n + 1
        if b % 7 == 0:
            want.append((e, b, round(total / 7, 6), round(total / n, 6)))
            total, n = 0.0, 0
    df = spark.createDataFrame(rows, "epoch int, batch_idx long, loss double").repartition(5)
    assert sorted(map(tuple, win.log_windows(df, 7).collect())) == want


def test_progress_of_many_batches(spark):
    df = spark.range(5000).select(F.col("id").alias("pos"), F.when(F.col("id") % 7 == 0, F.lit("error"))
                                  .otherwise(F.lit("success")).alias("status"), F.lit(0.5).alias("value")).repartition(9)
    p = sorted(win.progress(df, ["pos"], 3).collect())
    assert [(r.batch, r.processed, r.elapsed, r.remaining) for r in p] == [
        (k, min(3 * k + 3, 5000), min(3 * k + 3, 5000) * 0.5, 5000 - min(3 * k + 3, 5000)) for k in range(1667)]
    s = sorted(win.running_success_rate(df, ["pos"], 3).collect())
    assert [r.received for r in s] == [r.processed for r in p]
    assert s[-1].success_rate_pct == round(100.0 * (5000 - 715) / 5000, 1)
