"""Diffusion operators (D1–D14) and image operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentforge.functions import rand
from latentforge.operators import diffusion as dd
from latentforge.operators import image as im
from latentforge.operators import joins as jn


def test_schedule_values(spark):
    s = {r.t: r.alpha_cumprod for r in dd.noise_schedule(spark).collect()}
    assert len(s) == 1000
    assert s[0] == pytest.approx(0.9999, abs=1e-12)
    assert s[1] == pytest.approx(0.9997800921, abs=1e-10)
    assert s[500] == pytest.approx(0.0777966584, abs=1e-9)
    assert s[999] == pytest.approx(4.03583e-5, rel=1e-5)
    np.testing.assert_allclose(dd.schedule_array()[[0, 1, 500, 999]], [s[0], s[1], s[500], s[999]], rtol=1e-12)


def test_timestep_grid():
    assert dd.timestep_grid(2) == [999, 0]
    assert dd.timestep_grid(1) == [999]
    assert dd.timestep_grid(4) == [999, 666, 333, 0]


def test_uniform_matches_reference_value(spark):
    v = spark.range(1).select(rand.hash_u32(42, F.lit(1), F.lit(0)).alias("u")).collect()[0].u
    assert v == 1292796161


def test_remove_noise_inverts_add_noise(spark):
    lat = spark.createDataFrame([(i, [float(i) * 0.1 + j for j in range(8)]) for i in range(20)],
                                "id long, x array<double>")
    p = dd.training_pairs(lat, dd.noise_schedule(spark), "id", "x", seed=3)
    j = jn.lookup_schedule(p, dd.noise_schedule(spark).select("t", "sqrt_alpha_cumprod", "sqrt_one_minus"),
                           "t", 1000).join(lat, "id")
    back = j.select("x", dd.remove_noise("noisy", "target", "sqrt_alpha_cumprod", "sqrt_one_minus").alias("y"))
    for r in back.collect():
        np.testing.assert_allclose(r.y, r.x, rtol=1e-9, atol=1e-9)


def test_noise_is_standard_normal(spark):
    df = spark.range(200).select("id", rand.normal_array(7, F.col("id"), 50).alias("n"))
    v = np.concatenate([np.array(r.n) for r in df.collect()])
    assert abs(v.mean()) < 0.05 and abs(v.std() - 1) < 0.05


def test_ddim_step_at_t0_uses_abar_prev_1(spark):
    df = spark.createDataFrame([([0.5, -20.0], [0.1, 0.2])], "x array<double>, e array<double>")
    at = 0.9999
    r = df.select(dd.ddim_step("x", "e", F.lit(at), F.lit(1.0)).alias("y")).collect()[0].y
    x0 = np.clip((np.array([0.5, -20.0]) - np.sqrt(1 - at) * np.array([0.1, 0.2])) / np.sqrt(at), -10, 10)
    np.testing.assert_allclose(r, x0)


def test_clamp_keeps_nan(spark):
    df = spark.createDataFrame([([float("nan"), 20.0, -20.0, 1.0],)], "x array<double>")
    r = df.select(dd.clamp("x", -10, 10).alias("y")).collect()[0].y
    assert np.isnan(r[0]) and r[1:] == [10.0, -10.0, 1.0]


def test_denoise_paths_agree(spark):
    lat = spark.range(6).select("id")
    a = {r.id: r.sample for r in dd.denoise_linear(lat, "id", 5, 16, steps=4).collect()}
    b = {r.id: r.sample for r in dd.denoise_numpy(lat, "id", 5, 16, lambda x, t: (0.1 * x, 0.2 * x), steps=4).collect()}
    for k in a:
        np.testing.assert_allclose(a[k], b[k], rtol=1e-12, atol=1e-12)


def test_sinusoidal_embedding(spark):
    r = spark.range(1).select(dd.sinusoidal_embedding(F.lit(10), 8).alias("e")).collect()[0].e
    half = 4
    f = np.exp(-np.arange(half) * np.log(10000) / (half - 1))
    np.testing.assert_allclose(r, np.concatenate([np.sin(10 * f), np.cos(10 * f)]))


def test_letterbox_geometry(spark):
    df = spark.createDataFrame([(640, 480), (480, 640), (1, 2000)], "w int, h int")
    g = [r.g for r in df.select(im.letterbox_geometry("w", "h").alias("g")).collect()]
    assert (g[0].scale, g[0].new_w, g[0].new_h, g[0].off_x, g[0].off_y, g[0].ok) == (0.8, 512, 384, 0, 64, True)
    assert (g[1].new_w, g[1].new_h, g[1].off_x, g[1].off_y) == (384, 512, 64, 0)
    assert g[2].new_w == 0 and g[2].ok is False


def test_denormalize_pixels(spark):
    df = spark.createDataFrame([([-1.0, 0.0, 1.0, 2.0],)], "x array<double>")
    assert df.select(im.denormalize_pixels("x", 1, 2, 2).alias("p")).collect()[0].p == [0, 128, 255, 255]


def test_hwc_chw_bijection(spark):
    df = spark.createDataFrame([(list(range(24)),)], "x array<int>")
    r = df.select(im.chw_to_hwc(im.hwc_to_chw("x", 2, 4, 3), 3, 2, 4).alias("y"),
                  im.hwc_to_chw("x", 2, 4, 3).alias("c")).collect()[0]
    assert r.y == list(range(24))
    assert r.c == list(np.arange(24).reshape(2, 4, 3).transpose(2, 0, 1).reshape(-1))


def test_prepare_numpy_equals_columns(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(0, 256, h * w * 3).tolist(), h, w, 3) for i, (h, w) in
            enumerate([(5, 7), (9, 4), (6, 6), (1, 3000)])]
    df = spark.createDataFrame(rows, "id long, px array<int>, h int, w int, c int")
    a = {r.id: (r.status, r.tensor) for r in im.prepare_images_columns(df, "px", "h", "w", "c", 16, 12).collect()}
    b = {r.id: (r.status, r.tensor) for r in im.prepare_images(df, "id", "px", "h", "w", "c", 16, 12,
                                                               dtype="double").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0]
        if a[k][0] == "success":
            np.testing.assert_allclose(a[k][1], b[k][1])
    assert b[3][0] == "error"      # 1×3000 letterboxes to width 0


def test_to_rgb_and_black(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6, 7, 8],), (None,)], "x array<int>")
    r = df.select(im.to_rgb("x", "RGBA").alias("a"), im.image_or_black("x", 3).alias("b")).collect()
    assert r[0].a == [1, 2, 3, 5, 6, 7] and r[1].b == [0, 0, 0]
    g = spark.createDataFrame([([9, 8],)], "x array<int>").select(im.to_rgb("x").alias("g")).collect()[0].g
    assert g == [9, 9, 9, 8, 8, 8]


def test_train_transform_ignores_aspect(spark):
    df = spark.createDataFrame([([0, 255] * 3 * 2,)], "x array<int>")   # 2x2 RGB
    r = df.select(im.train_transform("x", 2, 2, 3, 4).alias("t")).collect()[0].t
    assert len(r) == 4 * 4 * 3 and min(r) == -1.0 and max(r) == 1.0


def test_prepare_and_encode_matches_unfused_and_isolates_errors(spark):
    from latentforge.operators import inference as inf
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(0, 256, h * w * 3).tolist(), h, w, 3) for i, (h, w) in
            enumerate([(5, 7), (9, 4), (6, 6), (1, 3000)])]
    df = spark.createDataFrame(rows, "id long, px array<int>, h int, w int, c int")
    fused = {r.id: r for r in im.prepare_and_encode(df, "id", "px", "h", "w", "c", 16, 12, factor=2,
                                                    batch_size=3).collect()}
    prep = im.prepare_images(df, "id", "px", "h", "w", "c", 16, 12, dtype="double").where("status = 'success'")
    plain = {r.id: r for r in inf.embed_images(prep, "id", "tensor", (3, 12, 16)).collect()}
    assert fused[3].status == "error" and fused[3].mean is None
    for k, r in plain.items():
        assert fused[k].status == "success"
        np.testing.assert_allclose(fused[k].mean, r.mean, rtol=1e-6)


def _direct_lanczos(img, nh, nw):
    """The filter as a direct sum over all source places of an axis."""
    def kernel(x):
        return 0.0 if abs(x) >= 3 else float(np.sinc(x) * np.sinc(x / 3))

    def axis(line, n_out):
        n, out = len(line), []
        stretch = max(n / n_out, 1.0)
        for o in range(n_out):
            c = (o + 0.5) * n / n_out
            lo, hi = max(int(c - 3 * stretch + 0.5), 0), min(int(c + 3 * stretch + 0.5), n)
            w = [kernel((k + 0.5 - c) / stretch) for k in range(lo, hi)]
            out.append(min(max(math.floor(sum(a * line[lo + j] for j, a in enumerate(w)) / sum(w) + 0.5), 0), 255))
        return out
    h, w, ch = img.shape
    mid = np.array([[axis(img[y, :, k], nw) for k in range(ch)] for y in range(h)]).transpose(0, 2, 1)
    return np.array([[axis(mid[:, x, k], nh) for k in range(ch)] for x in range(nw)]).transpose(2, 0, 1)


def test_lanczos_equals_a_direct_sum():
    from latentforge.operators import image as im
    rng = np.random.default_rng(1)
    for h, w, nh, nw in ((8, 8, 10, 10), (30, 17, 5, 4), (5, 7, 5, 7), (1, 9, 3, 2), (13, 1, 40, 2)):
        img = rng.integers(0, 256, (h, w, 3)).astype(float)
        got, want = im.lanczos(img, nh, nw), _direct_lanczos(img, nh, nw)
        assert got.shape == (nh, nw, 3) and np.abs(got - want).max() <= 1 and (got != want).mean() < 0.01
    flat = np.full((20, 30, 3), 77.0)
    assert (im.lanczos(flat, 7, 50) == 77).all()
