"""DuckDB SQL for every registered query (same names as the registry)."""

from __future__ import annotations

from latentforge.functions import lexicon as lx
from latentforge.operators.diffusion import schedule_params

from . import duck as D

T = lx.TEST
V = D.with_views
METHODS = ("click", "error", "purchase", "signup", "view")
LC = "lower(caption)"
TK = D.toks("lower(caption)")


def fmt_duration(x: str) -> str:
    """SQL twin of durations.format_duration for a numeric expression."""
    t = f"CAST(trunc({x}) AS BIGINT)"
    days = f"CAST(floor({t} / 86400) AS BIGINT)"
    rest = f"({t} - {days} * 86400)"
    clock = (f"printf('%d:%02d:%02d', CAST(floor({rest} / 3600) AS BIGINT), "
             f"CAST(floor(({rest} % 3600) / 60) AS BIGINT), CAST({rest} % 60 AS BIGINT))")
    prefix = (f"CASE WHEN {days} = 0 THEN '' ELSE CAST({days} AS VARCHAR) || "
              f"CASE WHEN abs({days}) = 1 THEN ' day, ' ELSE ' days, ' END END")
    return f"({prefix} || {clock})"


def schedule_cte(T_: int = 1000) -> str:
    b0, step = schedule_params(T_)
    beta = f"(CAST({b0!r} AS DOUBLE) + t * CAST({step!r} AS DOUBLE))"
    return (f"SELECT t, ac AS alpha_cumprod, sqrt(ac) AS sqrt_alpha_cumprod, sqrt(1.0 - ac) AS sqrt_one_minus "
            f"FROM (SELECT t, product(1.0 - {beta}) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND CURRENT ROW) AS ac FROM (SELECT CAST(range AS INTEGER) AS t FROM range({T_})))")


DUR_PATTERN = r"^(?:([01]?\d|2[0-3]):)?([0-5]?\d):([0-5]?\d)$"


def _dur_part(i):
    return f"coalesce(CAST(NULLIF(regexp_extract(text, '{DUR_PATTERN}', {i}), '') AS INTEGER), 0)"


DUR_TEXT = (
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN concat_ws(':', CAST(hour(ts) AS VARCHAR), "
    "lpad(CAST(minute(ts) AS VARCHAR), 2, '0'), lpad(CAST(second(ts) AS VARCHAR), 2, '0')) "
    "WHEN event_id % 3 = 1 THEN concat_ws(':', lpad(CAST(minute(ts) AS VARCHAR), 2, '0'), CAST(second(ts) AS VARCHAR)) "
    "ELSE concat_ws(':', CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR), lpad(CAST(second(ts) AS VARCHAR), 2, '0')) "
    "END AS text FROM events")

POS = "row_number() OVER (ORDER BY id) - 1 AS pos, count(*) OVER () AS n"


def scaling_sql():
    return ("SELECT method, workers, round(seconds, 6) AS seconds, round(b / seconds, 2) AS speedup, "
            "round(100.0 * (b / seconds) / workers, 2) AS efficiency_pct FROM (SELECT *, first_value(seconds) "
            "OVER (PARTITION BY method ORDER BY workers) AS b FROM runs)")


def batch_totals(batch: int):
    return (f"p AS (SELECT (row_number() OVER (ORDER BY pos) - 1) // {batch} AS batch, status, value FROM results), "
            "b AS (SELECT batch, count(*) AS items, count_if(status = 'success') AS ok, sum(value) AS secs "
            "FROM p GROUP BY batch), "
            "c AS (SELECT batch, sum(items) OVER (ORDER BY batch) AS processed, sum(ok) OVER (ORDER BY batch) AS okc, "
            "round(sum(secs) OVER (ORDER BY batch), 6) AS elapsed, sum(items) OVER () AS total FROM b) ")


def sampler_sql():
    return ("WITH d AS (" + D.VIEWS["dataset"] + "), "
            f"p AS ({D.shuffled('d', 1)}), "
            "s AS (SELECT id, perm, CAST(perm % 4 AS INTEGER) AS rank, perm // 4 AS local FROM p "
            "WHERE perm < (n // 4) * 4) ")


def flat(src: str, exprs: dict, key: str = "id", keep=()) -> str:
    """(key, i, rounded expressions) over the 64 elements of latents.x; the
    expressions may use ``v`` (element as double), ``i`` (0-based index)."""
    cols = ", ".join([f"round({e}, 6) AS {n}" for n, e in exprs.items()] + list(keep))
    return (f"SELECT {key}, CAST(i AS INTEGER) AS i, {cols} FROM (SELECT *, generate_subscripts(x, 1) - 1 AS i, "
            f"CAST(unnest(x) AS DOUBLE) AS v FROM {src})")


def clampv(e: str, b: float = 10.0) -> str:
    return f"(CASE WHEN isnan({e}) THEN {e} ELSE least(greatest({e}, -{b}), {b}) END)"


def denoise_sql(steps=3, seed=5, cu=0.1, ct=0.2, s=2.0,
                base="SELECT id, generate_subscripts(x, 1) - 1 AS i, 0.0 AS m FROM latents", prev="t-1"):
    """One CTE per sampler step over (id, i, m, x) rows; m is added to the text
    branch.  Time steps and schedule come from SQL, not from the library."""
    ctes = {"sched": schedule_cte(),
            "grid": (f"SELECT CAST(range AS INTEGER) AS k, CAST(trunc(999 - range * 999.0 / {max(steps - 1, 1)}) AS INTEGER) "
                     f"AS t FROM range({steps})"),
            "s0": ("SELECT id, CAST(i AS INTEGER) AS i, CAST(m AS DOUBLE) AS m, "
                   + clampv(D.normal(seed, "id", "i")) + f" AS x FROM ({base})")}
    for k in range(1, steps + 1):
        at_ = f"(SELECT alpha_cumprod FROM sched JOIN grid USING (t) WHERE k = {k - 1})"
        before = (f"(SELECT t - 1 FROM grid WHERE k = {k - 1})" if prev == "t-1"
                  else f"(SELECT coalesce(max(t), -1) FROM grid WHERE k = {k})")
        ap_ = f"(SELECT coalesce(max(alpha_cumprod), CAST(1.0 AS DOUBLE)) FROM sched WHERE t = {before})"
        x = clampv("x")
        uv = (f"SELECT id, i, m, x, {at_} AS abt, {ap_} AS abp, {clampv(f'{x} * {cu!r}')} AS u, "
              f"{clampv(f'({x} * {ct!r} + m)')} AS tt FROM s{k - 1}")
        ev = f"SELECT id, i, m, x, abt, abp, {clampv(f'u + {s!r} * (tt - u)')} AS eps FROM ({uv})"
        xv = f"SELECT id, i, m, abt, abp, eps, {clampv('(x - sqrt(1.0 - abt) * eps) / sqrt(abt)')} AS x0 FROM ({ev})"
        ctes[f"s{k}"] = f"SELECT id, i, m, {clampv('sqrt(abp) * x0 + sqrt(1.0 - abp) * eps')} AS x FROM ({xv})"
    final = f"SELECT id, i, round({clampv('x')} / CAST(0.18215 AS DOUBLE), 6) AS sample FROM s{steps}"
    return ctes, final


def prompt_shift() -> dict:
    """CTEs with m, the mean over the tokens of a prompt's signed features."""
    return {"t": tokens_cte(),
            "shift": ("SELECT id, sum(CASE WHEN CAST(('0x' || substr(md5(token), 9, 2)) AS INTEGER) % 2 = 0 THEN 1.0 "
                      "ELSE -1.0 END) / 77 AS m FROM (SELECT id, unnest(list_resize(tk, 77, '<pad>')) AS token FROM t) "
                      "GROUP BY id")}


def oracle() -> dict:
    sched = {"sched": schedule_cte()}
    out = {
        # ---- F
        "keyword_filter": V(f"SELECT id FROM dataset WHERE {D.any_contains(LC, lx.PEOPLE_KEYWORDS)}", "dataset"),
        "keyword_filter_testlex": V(f"SELECT id FROM dataset WHERE {D.any_contains(LC, T.people)}", "dataset"),
        "keyword_filter_part": "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'old')",
        "keyword_filter_part_token": f"SELECT p_partkey FROM part WHERE list_contains({D.toks('lower(p_name)')}, 'old')",
        "fallback_predicate": V(
            f"SELECT id FROM dataset WHERE {D.any_contains(LC, T.people)} OR list_has_any("
            f"string_split_regex(caption, '{D.NON_WORD}'), ['Is', 'Du', 'Le'])", "dataset"),
        "drop_failed": V("SELECT id FROM latents WHERE id % 7 <> 3", "latents"),
        "take_prefix": V("SELECT id FROM dataset ORDER BY id LIMIT 100", "dataset"),
        "take_prefix_large": "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY 1, 2 LIMIT 20000",
        "take_prefix_large_desc": "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY 1 DESC, 2 LIMIT 20000",
        "take_prefix_string": V("SELECT id FROM dataset ORDER BY caption, id LIMIT 100", "dataset"),
        "take_prefix_large_string": ("SELECT md5(concat_ws('-', l_orderkey, l_linenumber)) AS name FROM lineitem "
                                     "ORDER BY 1 DESC LIMIT 20000"),
        "batches_by_string": V("SELECT id, (row_number() OVER (ORDER BY caption, id) - 1) // 32 AS batch FROM dataset",
                               "dataset"),
        "status_filter": V("SELECT pos, value FROM results WHERE status = 'error'", "results"),
        "every_n": V("SELECT epoch, batch_idx, loss FROM losses WHERE batch_idx % 10 = 0", "losses"),
        "eval_cap": V("SELECT epoch, batch_idx, loss FROM losses WHERE batch_idx * 32 < 100", "losses"),
        # ---- X
        "image_path": V("SELECT id, concat_ws('/', '/data/coco', 'train2014', 'train2014', file_name) AS image_path "
                        "FROM images", "images"),
        "default_text": V("SELECT image_id, ann_id, coalesce(caption, 'Unknown') AS caption FROM captions", "captions"),
        "parse_duration": V(
            f"SELECT event_id, text, CAST(CASE WHEN regexp_matches(text, '{DUR_PATTERN}') THEN "
            f"{_dur_part(1)} * 3600 + {_dur_part(2)} * 60 + {_dur_part(3)} ELSE 0 END AS INTEGER) AS seconds "
            "FROM d", extra={"d": DUR_TEXT}),
        "format_duration": V(f"SELECT pos, {fmt_duration('value * 1000')} AS duration FROM results", "results"),
        "space_term_match": V("SELECT id, " + ", ".join(
            f"{D.space_match(LC, t)} AS {g}" for g, t in T.gender.items()) + " FROM dataset", "dataset"),
        "age_flags": V("SELECT id, " + ", ".join(
            f"{D.age_sql('lc', 'tk', s_)} AS {g}" for g, s_ in T.age.items())
            + f" FROM (SELECT id, {LC} AS lc, {TK} AS tk FROM dataset)", "dataset"),
        "age_flags_part": "SELECT p_partkey, " + ", ".join(
            f"{D.age_sql('lc', 'tk', s_)} AS {g}" for g, s_ in lx.AGE_GROUPS.items())
        + f" FROM (SELECT p_partkey, lower(p_name) AS lc, {D.toks('lower(p_name)')} AS tk FROM part)",
        "group_size_class": V(f"SELECT id, {D.group_sql(LC, T)} AS grp FROM dataset", "dataset"),
        "find_terms": V("SELECT id, array_to_string(list_filter(" + TK + ", lambda t: t IN ("
                        + ", ".join(D.q(t) for t in T.activities) + ")), ',') AS hits FROM dataset", "dataset"),
        # ---- A
        "captions_per_image": V(
            "SELECT image_id, ann_id, row_number() OVER (PARTITION BY image_id ORDER BY ann_id) - 1 AS pos, "
            "count(*) OVER (PARTITION BY image_id) AS n_captions FROM captions", "captions"),
        "gender_counts": f"SELECT category, n FROM ({D.demographics_sql(lx.DEFAULT, dims=('gender_distribution',))})",
        "gender_counts_testlex": f"SELECT category, n FROM ({D.demographics_sql(T, dims=('gender_distribution',))})",
        "age_counts_testlex": f"SELECT category, n FROM ({D.demographics_sql(T, dims=('age_groups',))})",
        "group_size_counts": V(f"SELECT {D.group_sql(LC, lx.DEFAULT)} AS category, count(*) AS n FROM dataset GROUP BY 1",
                               "dataset"),
        "group_size_counts_testlex": V(f"SELECT {D.group_sql(LC, T)} AS category, count(*) AS n FROM dataset GROUP BY 1",
                                       "dataset"),
        "activity_counts_testlex": V(
            "SELECT category, count(*) AS n FROM (SELECT unnest(list_filter(" + TK + ", lambda t: t IN ("
            + ", ".join(D.q(t) for t in T.activities) + "))) AS category FROM dataset) GROUP BY 1", "dataset"),
        "processing_summary": V(
            "SELECT CAST(successful AS BIGINT) AS successful, CAST(failed AS BIGINT) AS failed, " + fmt_duration("secs") + " AS total_time, "
            "round(secs / greatest(successful, 1), 3) AS avg_seconds_per_item, "
            "round(successful / secs, 2) AS items_per_second FROM (SELECT count_if(status = 'success') AS successful, "
            "count_if(status = 'error') AS failed, sum(value) AS secs FROM results)", "results"),
        "processing_summary_gpu": V(
            "SELECT CAST(successful AS BIGINT) AS successful, CAST(failed AS BIGINT) AS failed, " + fmt_duration("secs") + " AS total_time, "
            "CASE WHEN successful > 0 THEN round(secs / successful, 3) END AS avg_seconds_per_item, "
            "CASE WHEN successful > 0 THEN round(successful / secs, 2) END AS items_per_second FROM ("
            "SELECT count_if(status = 'success') AS successful, count_if(status = 'error') AS failed, "
            "sum(value) AS secs FROM results)", "results"),
        "mse": V("SELECT label, round(sum(sq) / sum(len), 9) AS mse FROM (SELECT label, list_sum(list_transform(x, "
                 "lambda v: (CAST(v AS DOUBLE) - CAST(v AS DOUBLE) * 0.5) * (CAST(v AS DOUBLE) - CAST(v AS DOUBLE) * 0.5))) "
                 "AS sq, len(x) AS len FROM latents) GROUP BY label", "latents"),
        "eval_loss": V("SELECT epoch, round(coalesce(avg(loss), 'Infinity'::DOUBLE), 6) AS eval_loss FROM losses "
                       "WHERE batch_idx * 32 < 100 GROUP BY epoch", "losses"),
        "eval_loss_empty": V("SELECT coalesce(avg(loss), 'Infinity'::DOUBLE) AS eval_loss FROM losses "
                             "WHERE batch_idx * 32 < 0", "losses"),
        "profile": " UNION ALL ".join(
            f"SELECT count(*) AS n_rows, '{c}' AS column_name, '{t}' AS column_type, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
            + (f"CAST(min(len({c})) AS INTEGER) AS min_size, CAST(max(len({c})) AS INTEGER) AS max_size"
               if t.startswith("array") else "CAST(NULL AS INTEGER) AS min_size, CAST(NULL AS INTEGER) AS max_size")
            + " FROM embeddings"
            for c, t in (("vec_id", "bigint"), ("embedding", "array<float>"), ("label", "int"))),
        "bundle_shapes": ("SELECT count(*) AS n, CAST(min(len(embedding)) AS INTEGER) AS embedding_min_len, "
                          "CAST(max(len(embedding)) AS INTEGER) AS embedding_max_len FROM embeddings"),
        "collate": V("SELECT batch, count(*) AS batch_len, min(id) AS first_id, max(id) AS last_id, "
                     "string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM (SELECT id, "
                     "(row_number() OVER (ORDER BY id) - 1) // 4 AS batch FROM latents) GROUP BY batch", "latents"),
        "per_item_time": V("SELECT CASE WHEN count(*) <> 0 THEN round(sum(value) / count(*), 3) END AS seconds_per_item "
                           "FROM results", "results"),
        "time_saved": V(
            "SELECT workers, round(a, 6) AS a_seconds, round(b, 6) AS b_seconds, round(a - b, 6) AS saved_seconds, "
            "CASE WHEN a <> 0 THEN round(100.0 * (a - b) / a, 2) END AS saved_pct FROM (SELECT workers, "
            "max(CASE WHEN method = 'view' THEN seconds END) AS a, max(CASE WHEN method = 'click' THEN seconds END) AS b "
            "FROM runs GROUP BY workers)", "runs"),
        "checkpoint_loss": V(
            "SELECT l.epoch, l.last AS last_batch, round(coalesce(t.tail, 0.0) / (l.last + 1), 6) AS checkpoint_loss "
            "FROM l LEFT JOIN t ON l.epoch = t.epoch", "losses", extra={
                "s": "SELECT * FROM losses WHERE (epoch + 1) % 5 = 0",
                "l": "SELECT epoch, max(batch_idx) AS last FROM s GROUP BY epoch",
                "t": "SELECT s.epoch, sum(loss) AS tail FROM s JOIN l ON s.epoch = l.epoch "
                     "WHERE batch_idx > floor(last / 10) * 10 GROUP BY s.epoch"}),
        # ---- W
        "scaling_table": V(scaling_sql(), "runs"),
        "progress": V(
            "SELECT batch, CAST(processed AS BIGINT) AS processed, round(elapsed, 6) AS elapsed, "
            "round(sp, 2) AS items_per_second, CAST(total - processed AS BIGINT) AS remaining, "
            + fmt_duration("CASE WHEN sp > 0 THEN (total - processed) / sp ELSE 0.0 END") + " AS eta FROM ("
            "SELECT *, CASE WHEN elapsed > 0 THEN processed / elapsed ELSE 0.0 END AS sp FROM c)",
            "results", extra={"_": "SELECT 1"}).replace("_ AS (SELECT 1)", batch_totals(8)[:-1]),
        "running_success_rate": V(
            "SELECT batch, CAST(processed AS BIGINT) AS received, round(100.0 * okc / processed, 1) AS success_rate_pct "
            "FROM c", "results", extra={"_": "SELECT 1"}).replace("_ AS (SELECT 1)", batch_totals(8)[:-1]),
        "ema": ("SELECT user_id, round(sum(CASE WHEN i = 0 THEN pow(CAST(0.9 AS DOUBLE), n - 1) ELSE "
                "CAST(0.09999999999999998 AS DOUBLE) * pow(CAST(0.9 AS DOUBLE), n - 1 - i) END * value), 6) AS ema, "
                "max(n) AS updates FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, "
                "event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) GROUP BY user_id"),
        "log_windows": V(
            "SELECT arg_max(epoch, k) AS epoch, arg_max(batch_idx, k) AS batch_idx, round(sum(loss) / 10, 6) AS logged_loss, "
            "round(sum(loss) / count(*), 6) AS true_mean FROM (SELECT *, epoch * 4294967296 + batch_idx AS k, "
            "coalesce(sum(flag) OVER (ORDER BY epoch, batch_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
            "AS island FROM (SELECT *, CASE WHEN batch_idx % 10 = 0 THEN 1 ELSE 0 END AS flag FROM losses)) "
            "GROUP BY island HAVING sum(flag) = 1", "losses"),
        # ---- J
        "attach_captions": V(
            "SELECT i.id, i.file_name, concat_ws('/', '/data/coco', 'train2014', 'train2014', i.file_name) AS image_path, "
            "p.n_captions, p.caption FROM images i JOIN p ON i.id = p.image_id", "images", "captions", extra={
                "p": f"SELECT image_id, count(*) AS n_captions, arg_min(caption, {D.md5_of(7, 'image_id', 'ann_id')}) "
                     f"AS caption FROM captions WHERE {D.any_contains(LC, T.people)} GROUP BY image_id"}),
        "attach_captions_person": V(
            "SELECT i.id, i.file_name, concat_ws('/', '/data/coco', 'train2014', 'train2014', i.file_name) AS image_path, "
            "p.n_captions, p.caption FROM images i JOIN p ON i.id = p.image_id", "images", "captions", extra={
                "p": f"SELECT image_id, count(*) AS n_captions, arg_min(caption, {D.md5_of(7, 'image_id', 'ann_id')}) "
                     f"AS caption FROM captions WHERE {D.any_contains(LC, T.people)} OR list_has_any("
                     f"string_split_regex(caption, '{D.NON_WORD}'), ['Is', 'Du', 'Le']) GROUP BY image_id"}),
        "has_caption": V("SELECT id FROM images WHERE id IN (SELECT image_id FROM captions)", "images", "captions"),
        "zip_join": V("SELECT pos, latent_id, doc_id FROM (SELECT id AS latent_id, row_number() OVER (ORDER BY id) - 1 "
                      "AS pos FROM latents) JOIN (SELECT id AS doc_id, row_number() OVER (ORDER BY id) - 1 AS pos "
                      "FROM dataset) USING (pos)", "latents", "dataset"),
        "lookup_schedule": V(
            f"SELECT r.pos, r.t, round(s.alpha_cumprod, 10) AS alpha_cumprod, round(s.sqrt_one_minus, 10) AS "
            f"sqrt_one_minus FROM (SELECT pos, {D.randint(3, 'pos', 1000)} AS t FROM results) r JOIN sched s ON r.t = s.t",
            "results", extra=sched),
        "compare_methods": V(
            "SELECT workers, " + ", ".join(
                f"max(CASE WHEN method = '{m}' THEN speedup END) AS {m}_speedup, "
                f"max(CASE WHEN method = '{m}' THEN efficiency_pct END) AS {m}_efficiency_pct" for m in METHODS)
            + " FROM w GROUP BY workers", "runs", extra={"w": scaling_sql()}),
        # ---- O
        "top_k": V("SELECT category, count(*) AS n FROM (SELECT unnest(list_filter(" + TK + ", lambda t: t IN ("
                   + ", ".join(D.q(t) for t in T.activities) + "))) AS category FROM dataset) GROUP BY 1 "
                   "ORDER BY n DESC, category LIMIT 3", "dataset"),
        "image_order": V("SELECT id FROM images WHERE id IN (SELECT image_id FROM captions) ORDER BY id",
                         "images", "captions"),
        "pick_one": V(f"SELECT image_id, arg_min(caption, {D.md5_of(5, 'image_id', 'ann_id')}) AS caption "
                      "FROM captions GROUP BY image_id", "captions"),
        "sample_n": V(f"SELECT id FROM dataset ORDER BY {D.md5_of(3, 'id')}, id LIMIT 50", "dataset"),
        "sample_by_hash": V(f"SELECT pos FROM results WHERE {D.uniform(5, 'pos')} < 0.1", "results"),
        "epoch_shuffle": V(f"SELECT id, pos FROM ({D.shuffled('dataset', 13, out='pos')})",
                           "dataset"),
        # ---- B
        "chunks_floor": V(f"SELECT id, CAST(pos // CASE WHEN n // 7 = 0 THEN n ELSE n // 7 END AS BIGINT) AS chunk "
                          f"FROM (SELECT id, {POS} FROM dataset)", "dataset"),
        "chunks_floor_min1": V(f"SELECT id, CAST(pos // greatest(1, n // 7) AS BIGINT) AS chunk "
                               f"FROM (SELECT id, {POS} FROM dataset)", "dataset"),
        "chunks_ceil": V(f"SELECT id, chunk, chunk % ((n + size - 1) // size) AS worker FROM (SELECT id, n, size, "
                         f"pos // size AS chunk FROM (SELECT id, pos, n, (n + 6) // 7 AS size FROM (SELECT id, {POS} "
                         f"FROM dataset)))", "dataset"),
        "batches": V(f"SELECT id, pos // 32 AS batch FROM (SELECT id, {POS} FROM dataset)", "dataset"),
        "round_robin": V(f"SELECT id, pos // 8 AS batch, CAST((pos // 8) % 3 AS INTEGER) AS worker "
                         f"FROM (SELECT id, {POS} FROM dataset)", "dataset"),
        "rank_shards": V(f"SELECT id, CAST(CASE WHEN n // 4 = 0 THEN 3 ELSE least(pos // (n // 4), 3) END AS INTEGER) "
                         f"AS rank FROM (SELECT id, {POS} FROM dataset)", "dataset"),
        "epoch_sampler": sampler_sql() + "SELECT id, perm, rank, local FROM s",
        "loader_batches": sampler_sql() + ", r AS (SELECT rank, count(*) AS rn FROM s GROUP BY rank) "
        "SELECT id, s.rank, local // 32 AS batch FROM s JOIN r ON s.rank = r.rank WHERE local < (rn // 32) * 32",
        # ---- U
        "concat_results": V("SELECT pos, status FROM results WHERE status = 'success' UNION ALL "
                            "SELECT pos, status FROM results WHERE status = 'error'", "results"),
        "union_records": V("SELECT pos, round(value, 6) AS value, CAST(NULL AS VARCHAR) AS error_message FROM results "
                           "WHERE status = 'success' UNION ALL SELECT pos, CAST(NULL AS DOUBLE) AS value, "
                           "'failed at value ' || CAST(value AS VARCHAR) AS error_message FROM results "
                           "WHERE status = 'error'", "results"),
    }
    # ---- D (latents flattened to (id, i, ...))
    nz = lambda seed: D.normal(seed, "id", "i")
    out.update({
        "latent_sample": V(flat("latents", {"z": f"v + exp((v - 2.0) * 0.5) * {nz(21)}"}), "latents"),
        "scale_latents": V(flat("latents", {"scaled": "v * CAST(0.18215 AS DOUBLE)",
                                            "unscaled": "(v * CAST(0.18215 AS DOUBLE)) / CAST(0.18215 AS DOUBLE)"}),
                           "latents"),
        "training_pairs": V(
            "SELECT e.id, e.i, e.noisy, e.target, e.t FROM ("
            + flat("lt", {"noisy": f"sa * v + so * {nz(42)}", "target": nz(42)}, keep=("t",))
            + ") e", "latents", extra={**sched, "lt": f"SELECT l.*, s.t, s.sqrt_alpha_cumprod AS sa, s.sqrt_one_minus AS so "
                                                      f"FROM latents l JOIN sched s ON {D.randint(42, 'l.id', 1000)} = s.t"}),
        "remove_noise": V(flat("lt", {"x0": f"((sa * v + so * {nz(42)}) - so * {nz(42)}) / sa"}), "latents", extra={
            **sched, "lt": f"SELECT l.*, s.sqrt_alpha_cumprod AS sa, s.sqrt_one_minus AS so "
                           f"FROM latents l JOIN sched s ON {D.randint(42, 'l.id', 1000)} = s.t"}),
        "guidance": V(flat("latents", {"g": clampv(f"v + 2.0 * ({nz(8)} - v)")}), "latents"),
        "ddim_step": V(
            "SELECT id, CAST(i AS INTEGER) AS i, round(" + clampv("sqrt(abp) * x0 + sqrt(1.0 - abp) * v") + ", 6) AS x_prev "
            "FROM z", "latents", extra={**sched, "lt": (
                f"SELECT l.*, s.alpha_cumprod AS abt, coalesce(p.alpha_cumprod, 1.0) AS abp FROM latents l "
                f"JOIN sched s ON {D.randint(9, 'l.id', 1000)} = s.t LEFT JOIN sched p ON p.t + 1 = s.t"),
                "e": "SELECT id, abt, abp, generate_subscripts(x, 1) - 1 AS i, CAST(unnest(x) AS DOUBLE) AS v FROM lt",
                "n": f"SELECT *, {nz(9)} AS nv FROM e",
                "z": "SELECT *, " + clampv("(nv - sqrt(1.0 - abt) * v) / sqrt(abt)") + " AS x0 FROM n"}),
        "denoise": V(denoise_sql()[1], "latents", extra=denoise_sql()[0]),
        "sinusoidal_embedding": V(
            "SELECT id, CAST(j AS INTEGER) AS i, round(CASE WHEN j < 8 THEN sin(t * exp(CAST(j AS DOUBLE) * -c)) "
            "ELSE cos(t * exp(CAST(j - 8 AS DOUBLE) * -c)) END, 6) AS emb FROM (SELECT id, CAST("
            + D.randint(4, "id", 1000) + " AS DOUBLE) AS t, CAST(" + repr(__import__("math").log(10000) / 7)
            + " AS DOUBLE) AS c FROM latents), range(16) r(j)", "latents"),
    })
    out["denoise_numpy"] = out["denoise"]
    out.update(oracle_more())
    return out


# ------------------------------------------------- images, inference, I/O --

def p10(j: str, arr: str = "x") -> str:
    """P10 value of element j (0-based) of a latent array."""
    return (f"CAST(round_even(least(greatest((CAST({arr}[CAST({j} AS BIGINT) + 1] AS DOUBLE) + 1.0) * 127.5, 0.0), 255.0), 0) "
            "AS INTEGER)")


def grid(n: int) -> str:
    return f"latents, range({n}) r(k)"


def safe_map_sql() -> str:
    return ("SELECT pos, CASE WHEN value > 40 THEN 'error' ELSE 'success' END AS status, "
            "CASE WHEN value > 40 THEN 'ValueError: value above limit' END AS error_message, "
            "CASE WHEN value <= 40 THEN value * 2.0 END AS result FROM results")


def tokens_cte() -> str:
    return ("SELECT id, list_concat(list_concat(['<s>'], tk[1:75]), ['</s>']) AS tk FROM "
            f"(SELECT id, {TK} AS tk FROM dataset)")


def hash_embed_sql(dim: int = 64, words: str | None = None) -> str:
    return V(
        "SELECT s.id, s.bucket, round(s.s / n.norm, 6) AS value FROM s JOIN n ON s.id = n.id", "dataset", extra={
            "w": f"SELECT id, unnest({words or TK}) AS w FROM dataset",
            "b": (f"SELECT id, CAST(CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % {dim} AS INTEGER) AS bucket, "
                  "CASE WHEN CAST(('0x' || substr(md5(w), 9, 2)) AS INTEGER) % 2 = 0 THEN CAST(1.0 AS DOUBLE) "
                  "ELSE CAST(-1.0 AS DOUBLE) END AS s FROM w"),
            "s": "SELECT id, bucket, sum(s) AS s FROM b GROUP BY id, bucket HAVING sum(s) <> 0",
            "n": "SELECT id, sqrt(sum(s * s)) AS norm FROM s GROUP BY id"})


def oracle_more() -> dict:
    nz = lambda seed, key="id": D.normal(seed, key, "i")
    prep = ("CASE WHEN y >= 0 AND y < 10 AND xx >= 1 AND xx < 11 THEN "
            + p10("least(floor(((y - 0) + 0.5) * 8 / 10), 7) * 8 + least(floor(((xx - 1) + 0.5) * 8 / 10), 7)")
            + " / 127.5 - 1.0 ELSE 0 / 127.5 - 1.0 END")
    out = {
        "letterbox_geometry": V(
            "SELECT w, h, n, round(scale, 9) AS scale, new_w, new_h, CAST(floor((512 - new_w) / 2) AS INTEGER) AS off_x, "
            "CAST(floor((512 - new_h) / 2) AS INTEGER) AS off_y, (w > 0 AND h > 0 AND new_w > 0 AND new_h > 0) AS ok "
            "FROM (SELECT *, CAST(trunc(w * scale) AS INTEGER) AS new_w, CAST(trunc(h * scale) AS INTEGER) AS new_h "
            "FROM (SELECT *, CASE WHEN w > 0 AND h > 0 THEN least(CAST(512 AS DOUBLE) / w, CAST(512 AS DOUBLE) / h) END "
            "AS scale FROM sizes))", "sizes"),
        "denormalize_pixels": V(f"SELECT id, CAST(k AS INTEGER) AS i, {p10('(k % 4) * 16 + (k // 16) * 4 + (k // 4) % 4')} "
                                f"AS px FROM {grid(64)}", "latents"),
        "hwc_to_chw": V(f"SELECT id, CAST(k AS INTEGER) AS i, {p10('k')} AS px FROM {grid(64)}", "latents"),
        "prepare_images": V(f"SELECT id, CAST(k AS INTEGER) AS i, round({prep}, 6) AS tensor FROM (SELECT id, x, k, "
                            f"(k // 12) % 10 AS y, k % 12 AS xx FROM {grid(360)})", "latents"),
        "train_transform": V(
            "SELECT id, CAST(k AS INTEGER) AS i, round((" + p10("least(floor((k // 15 + 0.5) * 8 / 5), 7) * 8 + "
                                                                "least(floor(((k // 3) % 5 + 0.5) * 8 / 5), 7)")
            + " / 255.0 - 0.5) / 0.5, 6) AS img FROM " + grid(75), "latents"),
        "image_or_black": V(f"SELECT id, CAST(k AS INTEGER) AS i, CASE WHEN label <> 3 THEN {p10('k')} ELSE 0 END AS px "
                            f"FROM {grid(64)}", "latents"),
        "to_rgb_rgba": V(f"SELECT id, CAST(k AS INTEGER) AS i, {p10('(k // 3) * 4 + k % 3')} AS px FROM {grid(48)}",
                         "latents"),
        "tokenize_pad": V(
            "SELECT id, CAST(j AS INTEGER) AS j, token, mask FROM (SELECT id, generate_subscripts(f, 1) - 1 AS j, "
            "unnest(f) AS token, unnest(m) AS mask FROM (SELECT id, list_resize(tk, 77, '<pad>') AS f, "
            "list_resize(list_transform(tk, lambda t: 1), 77, 0) AS m FROM t))", "dataset", extra={"t": tokens_cte()}),
        "hash_embed": hash_embed_sql(),
        "embed_text": hash_embed_sql(words=f"({TK})[1:75]"),
        "embed_images": V(
            "SELECT id, 'success' AS status, CAST(k AS INTEGER) AS i, round((CAST(x[(2 * (k // 4)) * 8 + 2 * (k % 4) + 1] "
            "AS DOUBLE) + CAST(x[(2 * (k // 4)) * 8 + 2 * (k % 4) + 2] AS DOUBLE) + CAST(x[(2 * (k // 4) + 1) * 8 + "
            "2 * (k % 4) + 1] AS DOUBLE) + CAST(x[(2 * (k // 4) + 1) * 8 + 2 * (k % 4) + 2] AS DOUBLE)) / 4, 6) AS mean "
            "FROM " + grid(16), "latents"),
        "embed_images_two_settings": V(
            "SELECT id, shape, 'success' AS status, i, round(avg(v), 6) AS mean FROM ("
            "SELECT id, '1x8x8' AS shape, CAST((k // 16) * 4 + (k % 8) // 2 AS INTEGER) AS i, CAST(x[k + 1] AS DOUBLE) AS v "
            f"FROM {grid(64)} UNION ALL "
            "SELECT id, '4x4x4', CAST((k // 16) * 4 + ((k % 16) // 8) * 2 + (k % 4) // 2 AS INTEGER), CAST(x[k + 1] AS DOUBLE) "
            f"FROM {grid(64)}) GROUP BY id, shape, i", "latents"),
        "write_bundle_rows": V(
            "SELECT d.caption, round(im.s, 5) AS image_sum, round(coalesce(tx.s, 0.0), 5) AS text_sum, "
            "CAST(least(len(t.tk), 77) AS INTEGER) AS mask_sum FROM dataset d JOIN t ON t.id = d.id "
            "JOIN im ON im.id = d.id LEFT JOIN tx ON tx.id = d.id", "dataset", "latents", extra={
                "t": tokens_cte(),
                "im": ("SELECT id, sum(CAST(v AS DOUBLE) * i) AS s FROM (SELECT id, unnest(x) AS v, "
                       "generate_subscripts(x, 1) AS i FROM latents) GROUP BY id"),
                "w": f"SELECT id, unnest(({TK})[1:75]) AS w FROM dataset",
                "b": ("SELECT id, CAST(('0x' || substr(md5(w), 1, 8)) AS BIGINT) % 64 AS bucket, "
                      "sum(CASE WHEN CAST(('0x' || substr(md5(w), 9, 2)) AS INTEGER) % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0 END) "
                      "AS s FROM w GROUP BY 1, 2"),
                "tx": ("SELECT id, sum(s * (bucket + 1)) / sqrt(sum(s * s)) AS s FROM b GROUP BY id HAVING sum(s * s) > 0")}),
        "prompt_embedding": V(
            "SELECT id, CAST(j AS INTEGER) AS j, CAST(CAST(('0x' || substr(md5(token), 1, 8)) AS BIGINT) % 16 AS INTEGER) "
            "AS bucket, CASE WHEN CAST(('0x' || substr(md5(token), 9, 2)) AS INTEGER) % 2 = 0 THEN CAST(1.0 AS DOUBLE) "
            "ELSE CAST(-1.0 AS DOUBLE) END AS value FROM (SELECT id, generate_subscripts(f, 1) - 1 AS j, unnest(f) AS token "
            "FROM (SELECT id, list_resize(tk, 77, '<pad>') AS f FROM t))", "dataset", extra={"t": tokens_cte()}),
        "safe_map": V(safe_map_sql(), "results"),
        "read_annotations": V("SELECT image_id, ann_id, caption FROM captions", "captions"),
        "read_annotations_images": V("SELECT id, file_name FROM images", "images"),
        "write_records": V("SELECT pos, status, value FROM results", "results"),
        "write_bundle": ("SELECT count(*) AS n, 64 AS text_embedding_min_len, 64 AS text_embedding_max_len, "
                         "77 AS attention_mask_min_len, 77 AS attention_mask_max_len, count(text) AS caption_count, "
                         "count(*) AS image_embedding_nulls FROM documents"),
        "write_stats": D.demographics_sql(T),
        "read_images": V(f"SELECT id, 8 AS h, 8 AS w, 1 AS c, 64 AS n_bytes, CAST(sum({p10('k')}) AS BIGINT) AS pixel_sum, "
                         f"'success' AS status FROM {grid(64)} GROUP BY id", "latents"),
        "resolve_embeddings": "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings",
        "encode_stream": V(safe_map_sql(), "results"),
        "stream_progress": V("SELECT status, n, round(100.0 * n / sum(n) OVER (), 1) AS pct FROM (SELECT CASE WHEN "
                             "value > 40 THEN 'error' ELSE 'success' END AS status, count(*) AS n FROM results "
                             "GROUP BY 1)", "results"),
        "curate": V(
            "SELECT i.id, concat_ws('/', '/data/coco', 'train2014', 'train2014', i.file_name) AS image_path, "
            "p.n_captions, p.caption FROM images i JOIN p ON i.id = p.image_id", "images", "captions", extra={
                "p": f"SELECT image_id, count(*) AS n_captions, arg_min(caption, {D.md5_of(7, 'image_id', 'ann_id')}) "
                     f"AS caption FROM captions WHERE {D.any_contains(LC, T.people)} GROUP BY image_id"}),
    }
    # L3: sampler over latents, loader batches, then noised latents (seed '0e1')
    out["training_input"] = V(
        "SELECT b.id, 1 AS epoch, b.rank, b.batch, b.t, round(sum(sa * CAST(e.v AS DOUBLE) + so * "
        + D.normal("0e1", "b.id", "e.i") + "), 6) AS noisy_sum, round(sum(" + D.normal("0e1", "b.id", "e.i")
        + "), 6) AS target_sum FROM b JOIN e ON b.id = e.id GROUP BY b.id, b.rank, b.batch, b.t",
        "latents", extra={**{"sched": schedule_cte()},
                          "p": D.shuffled("latents", 1),
                          "s": ("SELECT id, CAST(perm % 4 AS INTEGER) AS rank, perm // 4 AS local FROM p "
                                "WHERE perm < (n // 4) * 4"),
                          "r": "SELECT rank, count(*) AS rn FROM s GROUP BY rank",
                          "b0": ("SELECT s.id, s.rank, local // 32 AS batch FROM s JOIN r ON s.rank = r.rank "
                                 "WHERE local < (rn // 32) * 32"),
                          "b": (f"SELECT b0.*, sc.t, sc.sqrt_alpha_cumprod AS sa, sc.sqrt_one_minus AS so FROM b0 "
                                f"JOIN sched sc ON {D.randint('0e1', 'b0.id', 1000)} = sc.t"),
                          "e": "SELECT id, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS v FROM latents"})
    # L4: 3-step sampler over 16 elements per prompt, then pixels
    with_prompt = "SELECT id, CAST(range AS BIGINT) AS i, m FROM shift, range(16)"
    ctes, final = denoise_sql(base=with_prompt)
    ctes = {**prompt_shift(), **ctes}
    out["denoise_context"] = V(final, "dataset", extra=ctes)
    out["generate"] = V(
        "SELECT id, CAST(i AS INTEGER) AS i, CAST(round_even(least(greatest((((" + clampv("x")
        + ") / CAST(0.18215 AS DOUBLE)) * CAST(0.18215 AS DOUBLE) + 1.0) * 127.5, 0.0), 255.0), 0) AS INTEGER) "
        "AS pixels FROM s3", "dataset", extra=ctes)
    out["prepare_images_numpy"] = out["prepare_images"]
    # windowed sinc from 8 to 10 places (centres 0.8 apart), columns then rows, each rounded to 8 bits
    sinc = "CASE WHEN x = 0 THEN 1.0 ELSE 3 * sin(pi() * x) * sin(pi() * x / 3) / (pi() * x * pi() * x) END"
    out["prepare_images_lanczos"] = V(
        "SELECT id, CAST(k AS INTEGER) AS i, round(CASE WHEN k % 12 BETWEEN 1 AND 10 THEN v / 127.5 - 1.0 ELSE -1.0 END, 6) "
        f"AS tensor FROM (SELECT id, k FROM {grid(360)}) g LEFT JOIN (SELECT id AS vid, p, o, v FROM rows_) r ON r.vid = g.id "
        "AND r.p = (g.k // 12) % 10 AND r.o = g.k % 12 - 1", "latents", extra={
            "w0": "SELECT o, k, (k + 0.5) - (o + 0.5) * CAST(0.8 AS DOUBLE) AS x FROM range(10) a(o), range(8) b(k)",
            "w1": f"SELECT o, k, {sinc} AS w FROM w0 WHERE abs(x) < 3",
            "w": "SELECT o, k, w / sum(w) OVER (PARTITION BY o) AS w FROM w1",
            "px": f"SELECT id, j // 8 AS y, j % 8 AS k, {p10('j')} AS v FROM (SELECT id, x, k AS j FROM {grid(64)})",
            "cols_": "SELECT id, y, o, least(greatest(floor(sum(w * v) + 0.5), 0), 255) AS v FROM px JOIN w USING (k) "
                     "GROUP BY id, y, o",
            "rows_": "SELECT id, w.o AS p, c.o AS o, least(greatest(floor(sum(w * v) + 0.5), 0), 255) AS v FROM cols_ c "
                     "JOIN w ON w.k = c.y GROUP BY id, w.o, c.o"})
    out["load_images"] = out["read_images"]
    out["generate_files"] = out["generate"]
    out["curate_document"] = V(
        "SELECT p.image_id AS id, p.n_captions, p.caption, 8 AS h, 8 AS w, 1 AS c, s.pixel_sum FROM p JOIN s ON "
        "p.image_id = s.id WHERE p.image_id % 5 <> 0", "latents", "captions", extra={
            "s": f"SELECT id, CAST(sum({p10('k')}) AS BIGINT) AS pixel_sum FROM {grid(64)} GROUP BY id",
            "p": f"SELECT image_id, count(*) AS n_captions, arg_min(caption, {D.md5_of(7, 'image_id', 'ann_id')}) "
                 f"AS caption FROM captions WHERE {D.any_contains(LC, T.people)} OR list_has_any("
                 f"string_split_regex(caption, '{D.NON_WORD}'), ['Is', 'Du', 'Le']) GROUP BY image_id"})
    out["read_annotations_document"] = out["read_annotations"]
    out["read_annotations_document_images"] = out["read_annotations_images"]
    out["lazy_model"] = V("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS loads_per_worker FROM results",
                          "results")
    out["resume_partial"] = V(
        "SELECT status, count(*) AS n, round(coalesce(sum(result), 0.0), 3) AS total FROM (SELECT CASE WHEN value > 40 "
        "THEN 'error' ELSE 'success' END AS status, CASE WHEN value <= 40 THEN value * 2.0 END AS result FROM results) "
        "GROUP BY status", "results")
    g_ctes, g_final = denoise_sql(steps=4, prev="grid")
    out["denoise_prev_grid"] = V(g_final, "latents", extra=g_ctes)
    out["ema_default_decay"] = (
        "SELECT user_id, round(sum(CASE WHEN i = 0 THEN pow(CAST(0.9999 AS DOUBLE), n - 1) ELSE "
        f"CAST({1.0 - 0.9999!r} AS DOUBLE) * pow(CAST(0.9999 AS DOUBLE), n - 1 - i) END * value), 6) AS ema, "
        "max(n) AS updates FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, "
        "event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) GROUP BY user_id")
    out["epoch_sampler_padded"] = (
        "WITH d AS (" + D.VIEWS["dataset"] + "), "
        f"p AS ({D.shuffled('d', 3)}), "
        "a AS (SELECT id, perm FROM p UNION ALL SELECT id, perm + n AS perm FROM p "
        "WHERE perm < CAST(ceil(n / 3) AS BIGINT) * 3 - n) "
        "SELECT id, perm, CAST(perm % 3 AS INTEGER) AS rank, perm // 3 AS local FROM a")

    def canvas(y: str, x: str) -> str:   # 8x8 grey -> 12x12 at offset (0, 2) on a 12x16 canvas
        src = (f"least(floor((({y}) + 0.5) * 8 / 12), 7) * 8 + least(floor(((({x}) - 2) + 0.5) * 8 / 12), 7)")
        return f"(CASE WHEN ({x}) >= 2 AND ({x}) < 14 THEN {p10(src)} / 127.5 - 1.0 ELSE 0 / 127.5 - 1.0 END)"

    by, bx = "((k // 8) % 6)", "(k % 8)"
    pts = [canvas(f"2 * {by} + {dy}", f"2 * {bx} + {dx}") for dy in (0, 1) for dx in (0, 1)]
    out["prepare_and_encode"] = V(
        "SELECT id, 'success' AS status, CAST(k AS INTEGER) AS i, round(CAST(CAST((" + " + ".join(pts)
        + ") / 4 AS FLOAT) AS DOUBLE), 6) AS mean FROM " + grid(144), "latents")
    return out
