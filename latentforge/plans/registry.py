"""Registered queries: one per operator of the inventory, over whole tables.

Each entry is ``name -> (spark, sf_dir) -> DataFrame``.  Floating results
are rounded (6 digits) so that the DuckDB twins in ``checks/oracle.py``
compare value by value; array results are flattened or summarised to
scalar columns for the same reason.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import durations as du
from ..functions import lexicon as lx
from ..functions import rand
from ..functions import text as tx
from ..operators import aggregates as agg
from ..operators import batching as bt
from ..operators import filters as flt
from ..operators import joins as jn
from ..operators import sampling as smp
from ..operators import setops as so
from ..operators import windows as win
from ..sources import tables as tb
from ..sources import views as vw

T = lx.TEST
METHODS = ("click", "error", "purchase", "signup", "view")
GAZETTEER = ("Is", "Du", "Le")


def _people(s, d, lexicon=lx.DEFAULT):
    return flt.keyword_filter(vw.dataset(s, d), "caption", lexicon.people)


def _dur_text(s, d):
    ev = tb.read_table(s, d, "events", ["event_id", "ts", "value"])
    hms = F.concat_ws(":", F.hour("ts").cast("string"), F.lpad(F.minute("ts").cast("string"), 2, "0"),
                      F.lpad(F.second("ts").cast("string"), 2, "0"))
    ms = F.concat_ws(":", F.lpad(F.minute("ts").cast("string"), 2, "0"), F.second("ts").cast("string"))
    odd = F.concat_ws(":", F.col("value").cast("int").cast("string"), F.lpad(F.second("ts").cast("string"), 2, "0"))
    txt = F.when(F.col("event_id") % 3 == 0, hms).when(F.col("event_id") % 3 == 1, ms).otherwise(odd)
    return ev.select("event_id", txt.alias("text"))


def _collate(s, d):
    b = bt.batches(vw.latents(s, d), 4, ["id"])
    c = agg.collate(b, ["batch"], "id", ["id"])
    return c.select("batch", F.col("batch_len").cast("long").alias("batch_len"),
                    F.col("id")[0].alias("first_id"), F.element_at("id", -1).alias("last_id"),
                    F.array_join(F.transform("id", lambda v: v.cast("string")), ",").alias("ids"))


def _mse(s, d):
    lt = vw.latents(s, d).withColumn("target", F.transform("x", lambda v: v * F.lit(0.5)))
    return agg.mse(lt, "x", "target", ["label"]).select("label", F.round("mse", 9).alias("mse"))


def _union_records(s, d):
    r = vw.results(s, d)
    ok = r.where("status = 'success'").select("pos", F.round("value", 6).alias("value"))
    err = r.where("status = 'error'").select(
        "pos", F.concat(F.lit("failed at value "), F.col("value").cast("string")).alias("error_message"))
    return so.union_records(ok, err)


def _schedule_lookup(s, d):
    from ..operators import diffusion as df_

    r = vw.results(s, d).select("pos", rand.randint(3, F.col("pos"), 1000).alias("t"))
    j = jn.lookup_schedule(r, df_.noise_schedule(s), "t", schedule_rows=1000)
    return j.select("pos", "t", F.round("alpha_cumprod", 10).alias("alpha_cumprod"),
                    F.round("sqrt_one_minus", 10).alias("sqrt_one_minus"))


def _b7(s, d):
    return bt.epoch_sampler(vw.dataset(s, d).select("id"), "id", world=4, epoch=1, seed=0)


QUERIES = {
    # ---- F: filters
    "keyword_filter": lambda s, d: _people(s, d).select("id"),
    "keyword_filter_testlex": lambda s, d: _people(s, d, T).select("id"),
    "keyword_filter_part": lambda s, d: flt.keyword_filter(
        tb.read_table(s, d, "part", ["p_partkey", "p_name"]), "p_name", ["old"]).select("p_partkey"),
    "keyword_filter_part_token": lambda s, d: flt.keyword_filter(
        tb.read_table(s, d, "part", ["p_partkey", "p_name"]), "p_name", ["old"], match="token")
    .select("p_partkey"),
    "fallback_predicate": lambda s, d: flt.fallback_predicate(
        vw.dataset(s, d), tx.any_substring(tx.lower_text("caption"), T.people),
        flt.gazetteer_person(GAZETTEER), "caption").select("id"),
    "drop_failed": lambda s, d: flt.drop_failed(
        vw.latents(s, d).withColumn("x", F.when(F.col("id") % 7 != 3, F.col("x"))), "x").select("id"),
    "take_prefix": lambda s, d: flt.take_prefix(vw.dataset(s, d), 100, ["id"]).select("id"),
    "take_prefix_large": lambda s, d: flt.take_prefix(
        tb.read_table(s, d, "lineitem", ["l_orderkey", "l_linenumber"]), 20_000, ["l_orderkey", "l_linenumber"]),
    "take_prefix_large_desc": lambda s, d: flt.take_prefix(
        tb.read_table(s, d, "lineitem", ["l_orderkey", "l_linenumber"]), 20_000,
        [F.col("l_orderkey").desc(), F.col("l_linenumber")]),
    "take_prefix_string": lambda s, d: flt.take_prefix(vw.dataset(s, d), 100, ["caption", "id"]).select("id"),
    "take_prefix_large_string": lambda s, d: flt.take_prefix(
        tb.read_table(s, d, "lineitem", ["l_orderkey", "l_linenumber"])
        .select(F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("name")), 20_000, [F.col("name").desc()]),
    "batches_by_string": lambda s, d: bt.batches(vw.dataset(s, d), 32, ["caption", "id"]).select("id", "batch"),
    "status_filter": lambda s, d: flt.status_filter(vw.results(s, d), "error").select("pos", "value"),
    "every_n": lambda s, d: flt.every_n(vw.losses(s, d), "batch_idx", 10),
    "eval_cap": lambda s, d: flt.eval_cap(vw.losses(s, d), "batch_idx", 32, 100),
    # ---- X: scalar functions
    "image_path": lambda s, d: vw.images(s, d).select(
        "id", tx.image_path("/data/coco", "train2014", "file_name").alias("image_path")),
    "default_text": lambda s, d: vw.captions(s, d).select(
        "image_id", "ann_id", tx.default_text("caption", "Unknown").alias("caption")),
    "parse_duration": lambda s, d: _dur_text(s, d).select(
        "event_id", "text", du.parse_duration("text").alias("seconds")),
    "format_duration": lambda s, d: vw.results(s, d).select(
        "pos", du.format_duration(F.col("value") * 1000).alias("duration")),
    "space_term_match": lambda s, d: vw.dataset(s, d).select(
        "id", *[tx.space_term_match(tx.lower_text("caption"), t).alias(g) for g, t in T.gender.items()]),
    "age_flags": lambda s, d: vw.dataset(s, d).select(
        "id", *[f.alias(g) for g, f in tx.age_flags(tx.lower_text("caption"), T).items()]),
    "age_flags_part": lambda s, d: tb.read_table(s, d, "part", ["p_partkey", "p_name"]).select(
        "p_partkey", *[f.alias(g) for g, f in tx.age_flags(tx.lower_text("p_name")).items()]),
    "group_size_class": lambda s, d: vw.dataset(s, d).select(
        "id", tx.group_size_class(tx.lower_text("caption"), T).alias("grp")),
    "find_terms": lambda s, d: vw.dataset(s, d).select(
        "id", F.array_join(tx.find_terms(tx.lower_text("caption"), T.activities), ",").alias("hits")),
    # ---- A: aggregates
    "captions_per_image": lambda s, d: agg.captions_per_image(vw.captions(s, d)).select(
        "image_id", "ann_id", "pos", "n_captions"),
    "gender_counts": lambda s, d: agg.gender_counts(vw.dataset(s, d)),
    "gender_counts_testlex": lambda s, d: agg.gender_counts(vw.dataset(s, d), lexicon=T),
    "age_counts_testlex": lambda s, d: agg.age_counts(vw.dataset(s, d), lexicon=T),
    "group_size_counts": lambda s, d: agg.group_size_counts(vw.dataset(s, d)),
    "group_size_counts_testlex": lambda s, d: agg.group_size_counts(vw.dataset(s, d), lexicon=T),
    "activity_counts_testlex": lambda s, d: agg.activity_counts(vw.dataset(s, d), lexicon=T),
    "processing_summary": lambda s, d: agg.processing_summary(vw.results(s, d), F.sum("value")),
    "processing_summary_gpu": lambda s, d: agg.processing_summary(
        vw.results(s, d), F.sum("value"), only_if_success=True),
    "mse": _mse,
    "eval_loss": lambda s, d: agg.eval_loss(
        flt.eval_cap(vw.losses(s, d), "batch_idx", 32, 100), group_by=["epoch"]).select(
        "epoch", F.round("eval_loss", 6).alias("eval_loss")),
    "eval_loss_empty": lambda s, d: agg.eval_loss(
        flt.eval_cap(vw.losses(s, d), "batch_idx", 32, 0)),
    "profile": lambda s, d: agg.profile(tb.read_table(s, d, "embeddings")),
    "bundle_shapes": lambda s, d: agg.bundle_shapes(tb.read_table(s, d, "embeddings"), ["embedding"]),
    "collate": _collate,
    "per_item_time": lambda s, d: vw.results(s, d).agg(
        agg.per_item_time(F.sum("value"), F.count(F.lit(1))).alias("seconds_per_item")),
    "time_saved": lambda s, d: agg.time_saved(vw.runs(s, d), "view", "click"),
    "checkpoint_loss": lambda s, d: agg.checkpoint_loss(vw.losses(s, d), 10, 5).select(
        "epoch", "last_batch", F.round("checkpoint_loss", 6).alias("checkpoint_loss")),
    # ---- W: windows
    "scaling_table": lambda s, d: win.scaling_table(vw.runs(s, d)),
    "progress": lambda s, d: win.progress(vw.results(s, d), ["pos"], 8),
    "running_success_rate": lambda s, d: win.running_success_rate(vw.results(s, d), ["pos"], 8),
    "ema": lambda s, d: win.ema(tb.read_table(s, d, "events", ["event_id", "ts", "user_id", "value"]),
                                "user_id", ["ts", "event_id"], "value", 0.9).select(
        "user_id", F.round("ema", 6).alias("ema"), F.col("updates").cast("long").alias("updates")),
    "log_windows": lambda s, d: win.log_windows(vw.losses(s, d), 10),
    # ---- J: joins
    "attach_captions_person": lambda s, d: jn.attach_captions(
        vw.images(s, d), vw.captions(s, d), T.people, seed=7, root="/data/coco",
        person=flt.gazetteer_person(GAZETTEER)),
    "attach_captions": lambda s, d: jn.attach_captions(
        vw.images(s, d), vw.captions(s, d), T.people, seed=7, root="/data/coco").select(
        "id", "file_name", "image_path", "n_captions", "caption"),
    "has_caption": lambda s, d: jn.has_caption(vw.images(s, d), vw.captions(s, d)).select("id"),
    "zip_join": lambda s, d: jn.zip_join(
        vw.latents(s, d).select(F.col("id").alias("latent_id")),
        vw.dataset(s, d).select(F.col("id").alias("doc_id")), ["latent_id"], ["doc_id"]),
    "lookup_schedule": _schedule_lookup,
    "compare_methods": lambda s, d: jn.compare_methods(win.scaling_table(vw.runs(s, d)), METHODS),
    # ---- O: order and sampling
    "top_k": lambda s, d: smp.top_k(agg.activity_counts(vw.dataset(s, d), lexicon=T), 3),
    "image_order": lambda s, d: smp.image_order(
        jn.has_caption(vw.images(s, d), vw.captions(s, d)), "id").select("id"),
    "pick_one": lambda s, d: smp.pick_one(vw.captions(s, d), "image_id", "caption", "ann_id", seed=5),
    "sample_n": lambda s, d: smp.sample_n(vw.dataset(s, d), 50, "id", seed=3).select("id"),
    "sample_by_hash": lambda s, d: smp.sample_by_hash(vw.results(s, d), 0.1, "pos", seed=5).select("pos"),
    "epoch_shuffle": lambda s, d: smp.epoch_shuffle(vw.dataset(s, d).select("id"), "id", epoch=2, seed=11),
    # ---- B: chunks, shards, batches
    "chunks_floor": lambda s, d: bt.chunks_floor(vw.dataset(s, d).select("id"), 7).select("id", "chunk"),
    "chunks_floor_min1": lambda s, d: bt.chunks_floor_min1(vw.dataset(s, d).select("id"), 7)
    .select("id", "chunk"),
    "chunks_ceil": lambda s, d: bt.chunks_ceil(vw.dataset(s, d).select("id"), 7).select("id", "chunk", "worker"),
    "batches": lambda s, d: bt.batches(vw.dataset(s, d).select("id"), 32).select("id", "batch"),
    "round_robin": lambda s, d: bt.round_robin(vw.dataset(s, d).select("id"), 8, 3)
    .select("id", "batch", "worker"),
    "rank_shards": lambda s, d: bt.rank_shards(vw.dataset(s, d).select("id"), 4).select("id", "rank"),
    "epoch_sampler": lambda s, d: _b7(s, d).select("id", "perm", "rank", "local"),
    "loader_batches": lambda s, d: bt.loader_batches(_b7(s, d), 32).select("id", "rank", "batch"),
    # ---- U: set operations
    "concat_results": lambda s, d: so.concat_results([
        flt.status_filter(vw.results(s, d), "success").select("pos", "status"),
        flt.status_filter(vw.results(s, d), "error").select("pos", "status")]),
    "union_records": _union_records,
}


# ---- D: diffusion data (latents are 64-float vectors; flattened to rows)
def _flat(df, key, arr_cols, digits=6):
    """(key, i, one rounded column per array) rows."""
    first = arr_cols[0]
    z = df.select(key, F.posexplode(F.arrays_zip(*[F.col(c) for c in arr_cols])).alias("i", "_z"))
    return z.select(key, F.col("i").cast("int").alias("i"),
                    *[F.round(F.col("_z")[c].cast("double"), digits).alias(c) for c in arr_cols])


def _sched(s):
    from ..operators import diffusion as dd
    return dd.noise_schedule(s)


def _latent_sample(s, d):
    from ..operators import diffusion as dd
    lt = vw.latents(s, d).withColumn("logvar", F.transform("x", lambda v: v - F.lit(2.0)))
    return _flat(lt.select("id", dd.latent_sample("x", "logvar", F.col("id"), 21).alias("z")), "id", ["z"])


def _scale(s, d):
    from ..operators import diffusion as dd
    lt = vw.latents(s, d).select("id", dd.scale_latents("x").alias("scaled"))
    return _flat(lt.select("id", "scaled", dd.unscale_latents("scaled").alias("unscaled")), "id",
                 ["scaled", "unscaled"])


def _pairs(s, d):
    from ..operators import diffusion as dd
    p = dd.training_pairs(vw.latents(s, d), _sched(s), "id", "x", seed=42)
    return _flat(p, "id", ["noisy", "target"]).join(p.select("id", "t"), "id")


def _roundtrip(s, d):
    from ..operators import diffusion as dd
    p = dd.training_pairs(vw.latents(s, d), _sched(s), "id", "x", seed=42)
    j = jn.lookup_schedule(p, _sched(s).select("t", "sqrt_alpha_cumprod", "sqrt_one_minus"), "t", 1000)
    back = j.select("id", dd.remove_noise("noisy", "target", "sqrt_alpha_cumprod", "sqrt_one_minus").alias("x0"))
    return _flat(back, "id", ["x0"])


def _guidance(s, d):
    from ..operators import diffusion as dd
    lt = vw.latents(s, d).select("id", "x", dd.noise_like("x", F.col("id"), 8).alias("text"))
    return _flat(lt.select("id", dd.guidance("x", "text", 2.0).alias("g")), "id", ["g"])


def _ddim(s, d):
    from ..operators import diffusion as dd
    lt = vw.latents(s, d).select("id", "x", dd.noise_like("x", F.col("id"), 9).alias("noise"),
                                 dd.draw_timesteps(F.col("id"), 1000, 9).alias("t"))
    sc = _sched(s).select("t", "alpha_cumprod")
    prev = sc.select((F.col("t") + 1).alias("t"), F.col("alpha_cumprod").alias("abar_prev"))
    j = jn.lookup_schedule(lt, sc, "t", 1000)
    j = j.join(prev, "t", "left").withColumn(
        "abar_prev", F.coalesce(F.col("abar_prev"), F.lit(1.0)))
    return _flat(j.select("id", dd.ddim_step("noise", "x", "alpha_cumprod", "abar_prev").alias("x_prev")),
                 "id", ["x_prev"])


def _linear_predictor(x, t):
    return 0.1 * x, 0.2 * x


def _context_predictor(x, t, context):
    """The text branch is shifted by the mean of the prompt's features."""
    shift = np.array([[m.sum() / len(m)] for m in context])
    return 0.1 * x, 0.2 * x + shift


def _denoise(s, d):
    from ..operators import diffusion as dd
    return _flat(dd.denoise_linear(vw.latents(s, d), "id", seed=5, dim=64, steps=3), "id", ["sample"])


def _denoise_context(s, d):
    from ..operators import diffusion as dd
    from ..operators import inference as inf
    prompts = vw.dataset(s, d).select("id", inf.tokenize_pad("caption", 77)["tokens"].alias("tokens"))
    hidden = inf.prompt_embedding(prompts, "id", "tokens", dim=16)
    return _flat(dd.denoise_numpy(hidden, "id", seed=5, dim=16, predictor=_context_predictor, steps=3,
                                  context="hidden"), "id", ["sample"])


def _two_encoders(s, d):
    """E5 with two settings in one plan: each row shape has its own model."""
    from ..operators import inference as inf
    lat = vw.latents(s, d)

    def means(shape):
        e = inf.embed_images(lat, "id", "x", shape)
        return e.select("id", F.lit("x".join(map(str, shape))).alias("shape"), "status",
                        F.posexplode("mean").alias("i", "mean"))
    z = means((1, 8, 8)).unionByName(means((4, 4, 4)))
    return z.select("id", "shape", "status", F.col("i").cast("int").alias("i"), F.round("mean", 6).alias("mean"))


def _bundle_rows(s, d):
    """S6 with image embeddings, all four columns by value."""
    from ..plans import embedding as emb
    path = _scratch(s, "bundle-rows")
    results = vw.dataset(s, d).join(vw.latents(s, d).select("id", "x"), "id").withColumn("status", F.lit("success"))
    emb.embed_captions_job(results, "id", "caption", embedding="x", out_path=path, dim=64)
    b = tb.read_records(s, path)

    def total(c):
        return F.round(F.aggregate(F.transform(c, lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0),
                                   lambda a, v: a + v), 5)
    return b.select("caption", total("image_embedding").alias("image_sum"),
                    total("text_embedding").alias("text_sum"),
                    F.aggregate("attention_mask", F.lit(0), lambda a, v: a + v).alias("mask_sum"))


def _denoise_numpy(s, d):
    from ..operators import diffusion as dd
    out = dd.denoise_numpy(vw.latents(s, d).select("id"), "id", seed=5, dim=64,
                           predictor=_linear_predictor, steps=3)
    return _flat(out, "id", ["sample"])


def _sinusoidal(s, d):
    from ..operators import diffusion as dd
    lt = vw.latents(s, d).select("id", dd.draw_timesteps(F.col("id"), 1000, 4).alias("t"))
    return _flat(lt.select("id", dd.sinusoidal_embedding("t", 16).alias("emb")), "id", ["emb"])


QUERIES.update({
    "latent_sample": _latent_sample,
    "scale_latents": _scale,
    "training_pairs": _pairs,
    "remove_noise": _roundtrip,
    "guidance": _guidance,
    "ddim_step": _ddim,
    "denoise": _denoise,
    "denoise_numpy": _denoise_numpy,
    "denoise_context": _denoise_context,
    "sinusoidal_embedding": _sinusoidal,
})


# ---- P: image geometry and pixels (latents as small images)
def _flat_int(df, key, col):
    z = df.select(key, F.posexplode(col).alias("i", "_v"))
    return z.select(key, F.col("i").cast("int").alias("i"), F.col("_v").cast("int").alias(col))


def _grey(s, d):
    from ..operators import image as im
    return vw.latents(s, d).select("id", "label", "x", im.denormalize_pixels("x", 1, 8, 8).alias("px"))


def _letterbox(s, d):
    from ..operators import image as im
    g = vw.sizes(s, d).withColumn("g", im.letterbox_geometry("w", "h"))
    return g.select("w", "h", "n", F.round("g.scale", 9).alias("scale"), "g.new_w", "g.new_h",
                    "g.off_x", "g.off_y", "g.ok")


def _prepare(s, d):
    from ..operators import image as im
    grey = im.Img.from_chw("x", 1, 8, 8).map(im._to_uint8)
    t = im.prepare_images_columns(vw.latents(s, d).select("id", "x"), grey, 8, 8, 1, tw=12, th=10, grey=True)
    return _flat(t.select("id", "tensor"), "id", ["tensor"])


def _prepare_numpy(s, d):
    from ..operators import image as im
    rgb = _grey(s, d).select("id", im.to_rgb("px").alias("rgb"), F.lit(8).alias("h"), F.lit(8).alias("w"),
                             F.lit(3).alias("c"))
    t = im.prepare_images(rgb, "id", "rgb", "h", "w", "c", tw=12, th=10, dtype="double")
    return _flat(t.select("id", "tensor"), "id", ["tensor"])


def _prepare_lanczos(s, d):
    """P2 with the original's filter inside P7."""
    from ..operators import image as im
    rgb = _grey(s, d).select("id", im.to_rgb("px").alias("rgb"), F.lit(8).alias("h"), F.lit(8).alias("w"),
                             F.lit(3).alias("c"))
    t = im.prepare_images(rgb, "id", "rgb", "h", "w", "c", tw=12, th=10, resampler=im.lanczos, dtype="double")
    return _flat(t.select("id", "tensor"), "id", ["tensor"])


def _train_transform(s, d):
    from ..operators import image as im
    rgb = _grey(s, d).select("id", im.to_rgb("px").alias("rgb"))
    return _flat(rgb.select("id", im.train_transform("rgb", 8, 8, 3, 5).alias("img")), "id", ["img"])


def _denorm(s, d):
    from ..operators import image as im
    return _flat_int(vw.latents(s, d).select("id", im.denormalize_pixels("x", 4, 4, 4).alias("px")), "id", "px")


def _hwc_chw(s, d):
    from ..operators import image as im
    hwc = vw.latents(s, d).select("id", im.denormalize_pixels("x", 4, 4, 4).alias("hwc"))
    return _flat_int(hwc.select("id", im.hwc_to_chw("hwc", 4, 4, 4).alias("px")), "id", "px")


def _black(s, d):
    from ..operators import image as im
    g = _grey(s, d)
    return _flat_int(g.select("id", im.image_or_black(F.when(F.col("label") != 3, F.col("px")), 64).alias("px")),
                     "id", "px")


def _rgba(s, d):
    from ..operators import image as im
    return _flat_int(_grey(s, d).select("id", im.to_rgb("px", "RGBA").alias("px")), "id", "px")


# ---- E: tokenise, encoders, error isolation
def _tokenize(s, d):
    from ..operators import inference as inf
    from ..operators.parallel import spread
    t = spread(vw.dataset(s, d)).select("id", inf.tokenize_pad("caption", 77).alias("t"))
    z = t.select("id", F.posexplode(F.arrays_zip("t.tokens", "t.attention_mask")).alias("j", "z"))
    return z.select("id", F.col("j").cast("int").alias("j"), F.col("z.tokens").alias("token"),
                    F.col("z.attention_mask").alias("mask"))


def _hash_embed(s, d):
    from ..operators import inference as inf
    return inf.hash_embed(vw.dataset(s, d), "id", "caption", 64).select(
        "id", "bucket", F.round("value", 6).alias("value"))


def _embed_text(s, d):
    from ..operators import inference as inf
    e = inf.embed_text(vw.dataset(s, d), "caption", "emb", dim=64)
    z = e.select("id", F.posexplode("emb").alias("bucket", "value")).where(F.col("value") != 0)
    return z.select("id", F.col("bucket").cast("int").alias("bucket"), F.round("value", 6).alias("value"))


def _embed_images(s, d):
    from ..operators import inference as inf
    e = inf.embed_images(vw.latents(s, d), "id", "x", (1, 8, 8))
    z = e.select("id", "status", F.posexplode("mean").alias("i", "mean"))
    return z.select("id", "status", F.col("i").cast("int").alias("i"), F.round("mean", 6).alias("mean"))


def _prompt_embedding(s, d):
    from ..operators import inference as inf
    t = vw.dataset(s, d).select("id", inf.tokenize_pad("caption", 77)["tokens"].alias("tokens"))
    h = inf.prompt_embedding(t, "id", "tokens", dim=16)
    rows = h.select("id", F.posexplode("hidden").alias("j", "row"))
    cells = rows.select("id", "j", F.posexplode("row").alias("bucket", "value")).where(F.col("value") != 0)
    return cells.select("id", F.col("j").cast("int").alias("j"), F.col("bucket").cast("int").alias("bucket"),
                        "value")


def double_or_fail(values):
    """Test function for E8: fails for values above 40."""
    out = []
    for v in values:
        if v > 40:
            raise ValueError("value above limit")
        out.append(float(v) * 2.0)
    return out


def _safe_map(s, d):
    from pyspark.sql import types as Ty

    from ..operators import inference as inf
    return inf.safe_map(vw.results(s, d), double_or_fail, ["pos"], "value", Ty.DoubleType(), batch_size=8)


# ---- S: sources and sinks (round trips through the shared scratch folder)
def _scratch(s, name):
    from ..session import scratch_dir
    return scratch_dir(s, name)


def _annotations(s, d, which):
    from ..sources import annotations as an
    path = _scratch(s, "annotations")
    an.write_annotations(vw.captions(s, d), vw.images(s, d), path)
    ann, img = an.read_annotations(s, path)
    return ann if which == "annotations" else img


def _annotation_document(s, d, which):
    """S1 in the classic format: one document, read in byte ranges."""
    from ..sources import annotations as an
    path = _scratch(s, "annotation-document")
    an.write_annotation_document(vw.captions(s, d), vw.images(s, d), path)
    ann, img = an.read_annotations(s, path, multi_line=True, range_bytes=1 << 18)
    return ann if which == "annotations" else img


def _records(s, d):
    from ..sources import sinks
    path = _scratch(s, "records")
    sinks.write_records(vw.results(s, d), path)
    return tb.read_records(s, path)


def _bundle(s, d):
    from ..plans import embedding as emb
    path = _scratch(s, "bundle")
    emb.embed_captions_job(vw.dataset(s, d), "id", "caption", out_path=path, dim=64)
    b = tb.read_records(s, path)
    return agg.bundle_shapes(b, ["text_embedding", "attention_mask"], "caption",
                             null_counts=["image_embedding"])


def _stats(s, d):
    from ..sources import sinks
    prefix = _scratch(s, "caption_stats")
    path = sinks.write_stats(agg.demographics(vw.dataset(s, d), lexicon=T), prefix, "20240101_000000")
    return sinks.read_stats(s, path)


def _read_images(s, d):
    from ..sources import images as io
    out = _scratch(s, "images")
    g = _grey(s, d).select("id", "px", F.lit(8).alias("h"), F.lit(8).alias("w"), F.lit(1).alias("c"))
    io.write_image_files(g, "id", "px", "h", "w", "c", out)
    r = io.read_images(s, out, glob="*.raw")
    key = F.regexp_extract("path", r"/(\d+)\.raw$", 1).cast("long")
    byte_sum = F.aggregate(F.transform(F.sequence(F.lit(1), F.length("pixels")),
                                       lambda i: F.conv(F.hex(F.substring("pixels", i, 1)), 16, 10).cast("long")),
                           F.lit(0).cast("long"), lambda a, v: a + v)
    return r.select(key.alias("id"), "h", "w", "c", F.length("pixels").alias("n_bytes"),
                    byte_sum.alias("pixel_sum"), "status")


def _load_images(s, d):
    from ..sources import images as io
    out = _scratch(s, "images-by-path")
    g = _grey(s, d).select("id", "px", F.lit(8).alias("h"), F.lit(8).alias("w"), F.lit(1).alias("c"))
    io.write_image_files(g, "id", "px", "h", "w", "c", out)
    paths = vw.latents(s, d).select("id", F.concat(F.lit(out + "/"), F.col("id").cast("string"),
                                                   F.lit(".raw")).alias("path"))
    r = io.load_images(paths, "path")
    byte_sum = F.aggregate(F.transform(F.sequence(F.lit(1), F.length("pixels")),
                                       lambda i: F.conv(F.hex(F.substring("pixels", i, 1)), 16, 10).cast("long")),
                           F.lit(0).cast("long"), lambda a, v: a + v)
    return r.select("id", "h", "w", "c", F.length("pixels").alias("n_bytes"), byte_sum.alias("pixel_sum"), "status")


def _resolve(s, d):
    from ..sources import sinks
    r = sinks.resolve_embeddings(tb.read_table(s, d, "embeddings"), "image_embeddings")
    return r.select("vec_id", F.size("image_embeddings").alias("dim"))


# ---- T: streaming encode queue
def _stream_src(s, d):
    src = _scratch(s, "stream-src")
    vw.results(s, d).repartitionByRange(8, "pos").write.mode("overwrite").parquet(src)
    return src


def _encode_stream(s, d):
    from pyspark.sql import types as Ty

    from ..streaming import encode_stream as es
    src = _stream_src(s, d)
    sink, ckpt = _scratch(s, "stream-sink"), _scratch(s, "stream-ckpt")
    schema = s.read.parquet(src).schema
    es.encode_stream(s, src, schema, double_or_fail, ["pos"], "value", Ty.DoubleType(), sink, ckpt,
                     files_per_batch=2)
    return s.read.parquet(sink)


def _stream_progress(s, d):
    from pyspark.sql import types as Ty

    from ..streaming import encode_stream as es
    src = _stream_src(s, d)
    prog, ckpt = _scratch(s, "stream-progress"), _scratch(s, "stream-progress-ckpt")
    schema = s.read.parquet(src).schema
    es.stream_progress(s, src, schema, double_or_fail, ["pos"], "value", Ty.DoubleType(), prog, ckpt,
                       files_per_batch=3)
    return es.latest_progress(s, prog)


def _resume_partial(s, d):
    """T4: a run that is interrupted after three micro-batches and taken up again."""
    from ..streaming import encode_stream as es
    src = _stream_src(s, d)
    out, ckpt = _scratch(s, "resume"), _scratch(s, "resume-ckpt")
    schema = s.read.parquet(src).schema
    for stop in (3, None):
        es.resume_progress(s, src, schema, double_or_fail, ["pos"], "value", out, ckpt, stop_after=stop)
    return es.last_progress(s, out).select("status", "n", F.round("total", 3).alias("total"))


def _lazy_model(s, d):
    """Rows, and the most models that one worker built for them."""
    import os
    import socket
    import uuid

    from ..operators import inference as inf
    name = inf.model_key("row-count", object)

    def use(batches):
        for batch in batches:
            loaded = inf.lazy_model(name, lambda: uuid.uuid4().hex)
            yield batch.assign(worker=f"{socket.gethostname()}:{os.getpid()}", load=loaded)[["worker", "load"]]
    used = vw.results(s, d).select("pos").repartition(16).mapInPandas(use, "worker string, load string")
    per_worker = used.groupBy("worker").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("load").alias("loads"))
    return per_worker.agg(F.sum("n").alias("n_rows"), F.max("loads").alias("loads_per_worker"))


# ---- L: end-to-end plans
def _curate(s, d):
    from ..plans import curation
    ds = curation.curate(vw.images(s, d), vw.captions(s, d), T, seed=7, root="/data/coco")
    return ds.select("id", "image_path", "n_captions", "caption")


def _curate_document(s, d):
    """L1 as the original runs it: one annotation document, person fallback,
    images opened by path and dropped where they can't be."""
    from ..plans import curation
    from ..sources import annotations as an
    from ..sources import images as io
    doc, root = _scratch(s, "curate-document"), _scratch(s, "curate-images")
    g = _grey(s, d).select("id", "px", F.lit(8).alias("h"), F.lit(8).alias("w"), F.lit(1).alias("c"))
    io.write_image_files(g.where("id % 5 != 0"), "id", "px", "h", "w", "c", f"{root}/train2014/train2014")
    an.write_annotation_document(vw.captions(s, d), g.select("id", F.format_string("%d.raw", "id").alias("file_name")), doc)
    ds, _ = curation.curate_and_analyze(s, doc, T, seed=7, root=root, person=flt.gazetteer_person(GAZETTEER),
                                        multi_line=True)
    byte_sum = F.aggregate(F.transform(F.sequence(F.lit(1), F.length("pixels")),
                                       lambda i: F.conv(F.hex(F.substring("pixels", i, 1)), 16, 10).cast("long")),
                           F.lit(0).cast("long"), lambda a, v: a + v)
    return ds.select("id", "n_captions", "caption", "h", "w", "c", byte_sum.alias("pixel_sum"))


def _training_input(s, d):
    from ..operators import diffusion as dd
    from ..plans import training
    ti = training.training_input(vw.latents(s, d).select("id", "x"), dd.noise_schedule(s), "id", "x",
                                 world=4, epoch=1, batch_size=32, seed=0)
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, v: a + v), 6)
    return ti.select("id", "epoch", "rank", "batch", "t", total("noisy").alias("noisy_sum"),
                     total("target").alias("target_sum"))


def _generate(s, d):
    from ..plans import generation
    g = generation.generate(vw.dataset(s, d), "id", "caption", _context_predictor, steps=3, scale=2.0,
                            seed=5, latent_shape=(1, 4, 4))
    return _flat_int(g.select("id", "pixels"), "id", "pixels")


def _generate_files(s, d):
    """L4 to its end: images written as files and read back."""
    from ..plans import generation
    from ..sources import images as io
    out = _scratch(s, "generated")
    generation.generate_files(vw.dataset(s, d), "id", "caption", _context_predictor, out, steps=3, scale=2.0,
                              seed=5, latent_shape=(1, 4, 4))
    r = io.read_images(s, out, glob="*.raw")
    values = F.transform(F.sequence(F.lit(1), F.length("pixels")),
                         lambda i: F.conv(F.hex(F.substring("pixels", i, 1)), 16, 10).cast("int"))
    return _flat_int(r.select(F.regexp_extract("path", r"/(\d+)\.raw$", 1).cast("long").alias("id"),
                              values.alias("pixels")), "id", "pixels")


def _prepare_encode(s, d):
    from ..operators import image as im
    rgb = _grey(s, d).select("id", im.to_rgb("px").alias("rgb"), F.lit(8).alias("h"), F.lit(8).alias("w"),
                             F.lit(3).alias("c"))
    e = im.prepare_and_encode(rgb, "id", "rgb", "h", "w", "c", tw=16, th=12, factor=2)
    z = e.select("id", "status", F.posexplode("mean").alias("i", "mean"))
    return z.select("id", "status", F.col("i").cast("int").alias("i"),
                    F.round(F.col("mean").cast("double"), 6).alias("mean"))


def _denoise_grid(s, d):
    from ..operators import diffusion as dd
    return _flat(dd.denoise_linear(vw.latents(s, d), "id", seed=5, dim=64, steps=4, prev="grid"), "id", ["sample"])


QUERIES.update({
    "epoch_sampler_padded": lambda s, d: bt.epoch_sampler(
        vw.dataset(s, d).select("id"), "id", world=3, epoch=2, seed=1, drop_last=False)
    .select("id", "perm", "rank", "local"),
    "denoise_prev_grid": _denoise_grid,
    "ema_default_decay": lambda s, d: win.ema(
        tb.read_table(s, d, "events", ["event_id", "ts", "user_id", "value"]), "user_id", ["ts", "event_id"],
        "value").select("user_id", F.round("ema", 6).alias("ema"), F.col("updates").cast("long").alias("updates")),
    "prepare_and_encode": _prepare_encode,
    "letterbox_geometry": _letterbox,
    "denormalize_pixels": _denorm,
    "hwc_to_chw": _hwc_chw,
    "prepare_images": _prepare,
    "prepare_images_numpy": _prepare_numpy,
    "prepare_images_lanczos": _prepare_lanczos,
    "train_transform": _train_transform,
    "image_or_black": _black,
    "to_rgb_rgba": _rgba,
    "tokenize_pad": _tokenize,
    "hash_embed": _hash_embed,
    "embed_text": _embed_text,
    "embed_images": _embed_images,
    "embed_images_two_settings": _two_encoders,
    "prompt_embedding": _prompt_embedding,
    "safe_map": _safe_map,
    "read_annotations": lambda s, d: _annotations(s, d, "annotations"),
    "read_annotations_document": lambda s, d: _annotation_document(s, d, "annotations"),
    "read_annotations_document_images": lambda s, d: _annotation_document(s, d, "images"),
    "lazy_model": _lazy_model,
    "resume_partial": _resume_partial,
    "generate_files": _generate_files,
    "read_annotations_images": lambda s, d: _annotations(s, d, "images"),
    "write_records": _records,
    "write_bundle": _bundle,
    "write_bundle_rows": _bundle_rows,
    "write_stats": _stats,
    "read_images": _read_images,
    "load_images": _load_images,
    "resolve_embeddings": _resolve,
    "encode_stream": _encode_stream,
    "stream_progress": _stream_progress,
    "curate": _curate,
    "curate_document": _curate_document,
    "training_input": _training_input,
    "generate": _generate,
})
