"""DuckDB twins of the registered queries (the correctness oracle).

Every SQL text here runs on DuckDB over the driver's base tables; the
stand-in views of FIXTURES.md are inlined as CTEs.  Word-boundary regexes
are replaced by token rules because DuckDB's RE2 treats ``\\b`` as ASCII
while Spark (``(?U)``) and the original (Python) use Unicode.
"""

from __future__ import annotations

from latentforge.functions import lexicon as lx

VIEWS = {
    "dataset": "SELECT doc_id AS id, text AS caption FROM documents",
    "captions": "SELECT conv_id AS image_id, turn AS ann_id, text AS caption FROM conversations",
    "images": "SELECT doc_id AS id, source AS file_name FROM documents",
    "latents": "SELECT vec_id AS id, embedding AS x, label FROM embeddings",
    "sizes": ("SELECT l_partkey % 1999 + 1 AS w, l_orderkey % 1499 + 1 AS h, count(*) AS n "
              "FROM lineitem GROUP BY 1, 2"),
    "results": ("SELECT event_id AS pos, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END "
                "AS status, value FROM events"),
    "losses": ("SELECT CAST(day(ts) AS INTEGER) AS epoch, row_number() OVER (PARTITION BY day(ts) "
               "ORDER BY ts, event_id) - 1 AS batch_idx, value AS loss FROM events"),
    "runs": ("SELECT event_type AS method, CAST(power(2, user_id % 4) AS INTEGER) AS workers, "
             "sum(value) AS seconds FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL "
             "GROUP BY 1, 2"),
}

NON_WORD = r"[^\p{L}\p{N}_]+"


def with_views(sql: str, *names: str, extra: dict | None = None) -> str:
    ctes = [f"{n} AS ({VIEWS[n]})" for n in names]
    ctes += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + sql) if ctes else sql


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def toks(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '{NON_WORD}'), lambda t: t <> '')"


def any_contains(expr: str, terms) -> str:
    return "(" + " OR ".join(f"contains({expr}, {q(t)})" for t in terms) + ")" if terms else "FALSE"


def space_match(lc: str, terms) -> str:
    return any_contains(f"(' ' || {lc} || ' ')", [f" {t} " for t in terms])


def age_sql(lc: str, tk: str, spec: dict, suffixes=lx.ELDERLY_SUFFIXES) -> str:
    """Token form of the age regexes."""
    if "prefixes" in spec:
        plain = [p for p in spec["prefixes"] if p.isalnum()]
        conds = [f"len(list_filter({tk}, lambda t: "
                 + " OR ".join(f"starts_with(t, {q(p)})" for p in plain) + ")) > 0"] if plain else []
        if r"grown[-\s]?up" in spec["prefixes"]:
            conds.append(f"len(list_filter({tk}, lambda t: starts_with(t, 'grownup'))) > 0")
            conds.append(f"regexp_matches({lc}, '(^|[^\\p{{L}}\\p{{N}}_])grown[-\\s]up')")
        return "(" + " OR ".join(conds) + ")"
    words = list(spec["words"])
    allw = words + [w + s for w in words for s in suffixes]
    return f"list_has_any({tk}, [{', '.join(q(w) for w in allw)}])"


def group_sql(lc: str, lexicon) -> str:
    parts = [f"WHEN {any_contains(lc, terms)} THEN {q(name)}" for name, terms in lexicon.group_sizes]
    return f"CASE {' '.join(parts)} ELSE {q(lexicon.group_default)} END"


def count_tok(tk: str, term: str) -> str:
    return f"len(list_filter({tk}, lambda t: t = {q(term)}))"


def demographics_sql(lexicon=lx.DEFAULT, source: str = "dataset", with_total=False,
                     dims=None, source_ctes: dict | None = None, pct=False) -> str:
    g = list(lexicon.gender.items())
    a = list(lexicon.age.items())
    classes = [n for n, _ in lexicon.group_sizes] + [lexicon.group_default]
    flag_cols = (
        [f"{space_match('lc', t)} AS g_{i}" for i, (_, t) in enumerate(g)]
        + [f"{age_sql('lc', 'tk', s, lexicon.elderly_suffixes)} AS a_{i}" for i, (_, s) in enumerate(a)]
        + [f"{group_sql('lc', lexicon)} AS grp"]
        + [f"{count_tok('tk', t)} AS t_{i}" for i, t in enumerate(lexicon.activities)])
    sums = (["count(*) AS total"]
            + [f"count_if(g_{i}) AS g_{i}" for i in range(len(g))]
            + [f"count_if(a_{i}) AS a_{i}" for i in range(len(a))]
            + [f"count_if(grp = {q(c)}) AS s_{i}" for i, c in enumerate(classes)]
            + [f"CAST(coalesce(sum(t_{i}), 0) AS BIGINT) AS t_{i}" for i in range(len(lexicon.activities))])
    rows = ([("gender_distribution", n, f"g_{i}") for i, (n, _) in enumerate(g)]
            + [("age_groups", n, f"a_{i}") for i, (n, _) in enumerate(a)]
            + [("group_sizes", c, f"s_{i}") for i, c in enumerate(classes)]
            + [("activities", t, f"t_{i}") for i, t in enumerate(lexicon.activities)])
    if dims:
        rows = [r for r in rows if r[0] in dims]
    tot = ", total" if with_total or pct else ""
    if pct:
        tot += ", CASE WHEN total <> 0 THEN round(100.0 * {v} / total, 2) END AS pct"
    union = "\nUNION ALL ".join(
        f"SELECT {q(d)} AS dimension, {q(c)} AS category, CAST({v} AS BIGINT) AS n{tot.format(v=v)} FROM s"
        + ("" if d == "gender_distribution" else f" WHERE {v} > 0") for d, c, v in rows)
    ctes = dict(source_ctes or {})
    ctes["b"] = f"SELECT lower(caption) AS lc, {toks('lower(caption)')} AS tk FROM {source}"
    ctes["f"] = f"SELECT lc, tk, {', '.join(flag_cols)} FROM b"
    ctes["s"] = f"SELECT {', '.join(sums)} FROM f"
    views = [source] if source in VIEWS else []
    return with_views(union, *views, extra=ctes)


def md5_of(seed, *parts: str) -> str:
    """md5 of 'seed|part|…' — parts are SQL expressions (cast to text)."""
    items = [q(str(seed))] + [f"CAST({p} AS VARCHAR)" for p in parts]
    return f"md5(concat_ws('|', {', '.join(items)}))"


def u32(seed, *parts: str) -> str:
    return f"CAST(('0x' || substr({md5_of(seed, *parts)}, 1, 8)) AS BIGINT)"


def uniform(seed, *parts: str) -> str:
    return f"((CAST({u32(seed, *parts)} AS DOUBLE) + 0.5) / 4294967296.0)"


def normal(seed, key: str, i: str) -> str:
    """Number i mod 4 of the four normals in the digest of (seed, key, i div 4)."""
    digest = md5_of(seed, key, f"CAST(({i}) // 4 AS BIGINT)")
    pair = f"(16 * ((({i}) % 4) // 2))"

    def draw(at: str) -> str:
        return f"((CAST(('0x' || substr({digest}, CAST({pair} + {at} AS BIGINT), 8)) AS BIGINT) + 0.5) / 4294967296.0)"
    angle = f"(CAST({2.0 * 3.141592653589793!r} AS DOUBLE) * {draw('9')})"
    return (f"(sqrt(-2.0 * ln({draw('1')})) * CASE WHEN ({i}) % 2 = 0 THEN cos({angle}) ELSE sin({angle}) END)")


def randint(seed, key: str, upper: int) -> str:
    return f"CAST(floor({uniform(seed, key)} * {upper}) AS INTEGER)"


def permuted(pos: str, n: str, seed) -> str:
    """Twin of ``rand.with_permuted``: a Feistel network over an a x b rectangle,
    walked until the result is below n."""
    from latentforge.functions.rand import PRIME, WALK, round_keys

    a = f"CAST(ceil(sqrt(CAST({n} AS DOUBLE))) AS BIGINT)"
    b = f"(({n} + {a} - 1) // {a})"
    keys = f"CAST({round_keys(seed)} AS BIGINT[][])"

    def mixed(x: str, k: int) -> str:
        one, two = (f"(({x} * k[{k + 2 * j}] + k[{k + 2 * j + 1}]) % {PRIME})" for j in (0, 1))
        return f"({one} * {two} % {PRIME})"

    def once(y: str) -> str:
        left = f"((s[1] + {mixed('s[2]', 1)}) % {a})"
        turn = f"[{left}, (s[2] + {mixed(left, 5)}) % {b}]"
        return (f"list_transform([list_reduce(list_prepend([{y} // {b}, {y} % {b}], {keys}), lambda s, k: {turn})], "
                f"lambda r: r[1] * {b} + r[2])[1]")
    return (f"list_reduce(list_prepend({once(pos)}, CAST({[0] * WALK} AS BIGINT[])), "
            f"lambda y, z: CASE WHEN y < {n} THEN y ELSE {once('y')} END)")


def shuffled(src: str, seed, key: str = "id", out: str = "perm") -> str:
    """(key, out, n): the permuted position of each row of ``src``."""
    return (f"SELECT {key}, {permuted('idx', 'n', seed)} AS {out}, n FROM (SELECT {key}, row_number() OVER "
            f"(ORDER BY {key}) - 1 AS idx, count(*) OVER () AS n FROM {src})")
