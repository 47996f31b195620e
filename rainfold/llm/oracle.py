"""DuckDB text of the queries that SQL can express, in its plainest form:
seat by seat, block by block, window by window, pair by pair."""

from __future__ import annotations

from . import mixing, quality_rules as rules

WORD = r"[^\x20\x09-\x0D]+"


def hash60(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 12))::BIGINT"


def mixing_sql(block: int = mixing.BLOCK, shard_words: int = mixing.SHARD_WORDS, seed: int = mixing.SEED) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS th FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss FROM d GROUP BY source),
w AS (SELECT source, ss, 3.0::DOUBLE * ss AS cap, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
l AS (
  SELECT *, ((SELECT sum(ss) FROM w) - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
v AS (SELECT level FROM l WHERE level * w <= cap ORDER BY cap / w, level LIMIT 1),
t AS (SELECT source, ss, w, least(cap, level * w) AS target FROM w, v),
seat AS (
  SELECT source, row_number() OVER (ORDER BY w / (2 * k + 1) DESC, source NULLS FIRST) AS rn
  FROM (SELECT source, w, unnest(generate_series(0, (3 * ceil(ss / {block}) - 1)::BIGINT)) AS k FROM t)),
q AS (
  SELECT t.source, ss, target, greatest(ceil(ss / {shard_words}), 1)::BIGINT AS n_shards,
    (SELECT count(*) FROM seat WHERE seat.source IS NOT DISTINCT FROM t.source AND rn <= (SELECT round(sum(ss) / {block}) FROM t)) AS q
  FROM t),
p AS (
  SELECT d.doc_id, d.size, q.*, {hash60(f"'{seed}'", "coalesce(d.doc_id::VARCHAR, '')", "d.th")} AS h
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
sh AS (SELECT source, h % n_shards AS shard, q, sum(size)::BIGINT AS w, ceil(sum(size) / {block})::BIGINT AS n FROM p GROUP BY ALL),
shard_seat AS (
  SELECT source, shard, q, row_number() OVER (PARTITION BY source ORDER BY w / (2 * k + 1) DESC, shard) AS rn
  FROM (SELECT *, unnest(generate_series(0, 3 * n - 1)) AS k FROM sh)),
quota AS (
  SELECT sh.source, sh.shard, sh.n, {hash60(f"'{seed}'", "coalesce(sh.source, '')", "sh.shard::VARCHAR")} % greatest(sh.n, 1) AS u, count(rn) AS quota
  FROM sh LEFT JOIN shard_seat x ON x.source IS NOT DISTINCT FROM sh.source AND x.shard = sh.shard AND rn <= sh.q GROUP BY ALL),
laid AS (
  SELECT p.*, h % n_shards AS shard, coalesce(sum(size) OVER (PARTITION BY source, h % n_shards ORDER BY h, doc_id NULLS FIRST, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place FROM p),
part AS (
  SELECT doc_id, place, size, ss, target, quota, n, u, unnest(generate_series(place // {block}, greatest(place + size - 1, place) // {block})) AS j
  FROM laid JOIN quota ON laid.source IS NOT DISTINCT FROM quota.source AND laid.shard = quota.shard)
SELECT doc_id, any_value(size) AS size, any_value(ss) AS source_size, round(any_value(target), 6) AS target,
  coalesce(sum(CASE WHEN size > 0 THEN (least(place + size, (j + 1) * {block}) - greatest(place, j * {block}))
    * (quota // n + CASE WHEN (j - u + n) % n < quota % n THEN 1 ELSE 0 END) END), 0)::BIGINT AS taken
FROM part GROUP BY doc_id, place, source, size""".replace("GROUP BY doc_id, place, source, size", "GROUP BY doc_id, place, ss, target, size")


def rules_sql() -> str:
    k = rules.WINDOW_WORDS
    shares = {
        "symbol_share": "n_symbols / greatest(word_chars, 1)", "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
        "repeat_share": "n_repeat_words / greatest(n_words, 1)", "upper_share": "upper_chars / greatest(word_chars, 1)",
        "mean_word": "word_chars / greatest(n_words, 1)",
    }
    some = lambda m: f" FILTER (WHERE {m} > 0)" if m in rules.SPARSE else ""
    quart = ", ".join(f"quantile_disc({m}, [0.25, 0.5, 0.75]){some(m)} AS {m}, count(*){some(m)} AS {m}_n" for m in shares)

    def level(m, part):
        of = {"mid": "{}[2]", "up": "({0}[3] - {0}[2])", "down": "({0}[2] - {0}[1])"}[part]
        value = of.format(f"a.{m}")
        for t in "lg":
            value = f"coalesce(({t}.{m}_n * {of.format(f'{t}.{m}')} + {rules.PRIOR} * {value}) / ({t}.{m}_n + {rules.PRIOR}), {value})"
        return value

    bad = []
    for m, (high, low) in rules.MEASURES.items():
        bad.append(f"CASE WHEN x.{m} > {level(m, 'mid')} + {rules.FENCE}::DOUBLE * greatest({level(m, 'up')}, {high}::DOUBLE) THEN '{m}_high' END")
        if low is not None:
            bad.append(f"CASE WHEN x.{m} < {level(m, 'mid')} - {rules.FENCE}::DOUBLE * greatest({level(m, 'down')}, {low}::DOUBLE) THEN '{m}_low' END")
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '{WORD}') AS w FROM t),
win AS (SELECT r, i, array_to_string(w[i:i + {k - 1}], ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - {k - 2})) AS i FROM w)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, sum(least({k}, coalesce(next - i, {k})))::BIGINT AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM dup) GROUP BY r),
m AS (
  SELECT t.doc_id, t.lang, t.source, len(w.w)::BIGINT AS n_words, list_sum([0] || [length(x) FOR x IN w.w])::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(text, '\\p{{Lu}}'))::BIGINT AS upper_chars,
    [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{WORD}')] AS lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM t JOIN w USING (r) LEFT JOIN cov USING (r)),
n AS (SELECT *, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM m),
x AS (SELECT *, {', '.join(f'{e} AS {c}' for c, e in shares.items())} FROM n),
g AS (SELECT lang, source, {quart} FROM x GROUP BY lang, source),
l AS (SELECT lang, {quart} FROM x GROUP BY lang),
a AS (SELECT {quart} FROM x),
j AS (
  SELECT x.*, (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed, concat_ws(',', {', '.join(bad)}) AS failed
  FROM x JOIN g ON x.lang IS NOT DISTINCT FROM g.lang AND x.source IS NOT DISTINCT FROM g.source JOIN l ON x.lang IS NOT DISTINCT FROM l.lang, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed = '' AS kept, failed FROM j"""


def top_k_sql(k: int = 5, scale: int = 256) -> str:
    fine = "embedding IS NOT NULL AND vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"
    return f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings WHERE {fine}),
s AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id, list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
  FROM e q JOIN e c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text: a list of its bytes and eight shifts for each."""
    steps = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ord({text}[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    mixed = "(CASE WHEN x > 0 THEN xor(a, x) ELSE a END)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, x: CASE WHEN {mixed} % 2 = 1 "
            f"THEN xor({mixed} // 2, 3988292384::BIGINT) ELSE {mixed} // 2 END), 4294967295::BIGINT)")


def _climb_sql(name: str, group: str, levels: int) -> str:
    """Node tables ``name_k(grp, pos, n, d)`` for k up to ``levels`` and, for every
    leaf of ``name_0``, the siblings left and right of its path at each level."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_{k + 1} AS (
  SELECT grp, pos // 8 AS pos, count(*) OVER (PARTITION BY grp) AS n, sha256(all_d) AS d FROM (
    SELECT grp, pos // 8 * 8 AS pos, string_agg(d, '' ORDER BY pos) AS all_d FROM {name}_{k} WHERE n > 1 GROUP BY grp, pos // 8)
)""")
        out.append(f"""{name}_side_{k} AS (
  SELECT a.grp, a.pos, string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos) AS l, string_agg(b.d, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos) AS r
  FROM {name}_{k} a JOIN {name}_{k} b ON a.grp = b.grp AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.grp, a.pos
)""")
    return ",\n".join(out)


def merkle_sql(levels: int = 6, lang_levels: int = 3) -> str:
    """The manifest for up to 8^levels rows a language and 8^lang_levels languages."""
    def part(c):
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    fields = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    folds = []
    for name, many, key, start in (("t", levels, "grp", "base"), ("u", lang_levels, "'u'", f"fold_t_{levels - 1}")):
        for k in range(many):
            at = f"b.{'pos' if name == 't' else 'lpos'} // {8 ** k}"
            folds.append(f"""fold_{name}_{k} AS (
  SELECT b.* REPLACE (b.proof || coalesce(s.l, '') || coalesce(s.r, '') AS proof,
    CASE WHEN s.pos IS NULL THEN b.acc ELSE sha256(coalesce(s.l, '') || b.acc || coalesce(s.r, '')) END AS acc)
  FROM {start} b LEFT JOIN {name}_side_{k} s ON s.grp = {'b.grp' if name == 't' else key} AND s.pos = {at}
)""")
            start = f"fold_{name}_{k}"
    tops = " UNION ALL ".join(f"SELECT grp, d FROM t_{k} WHERE n = 1" for k in range(levels + 1))
    roots = " UNION ALL ".join(f"SELECT d FROM u_{k} WHERE n = 1" for k in range(lang_levels + 1))
    return f"""WITH rows AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, sha256({fields} || {part('text')}) AS leaf, sha256({fields} || {part(low)}) AS low,
         {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 AS hit FROM documents
),
placed AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM rows WINDOW w AS (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf)),
t_0 AS (SELECT grp, pos, n, leaf AS d FROM placed),
{_climb_sql('t', 'grp', levels)},
tops AS ({tops}),
u_0 AS (SELECT 'u' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, d, grp AS lang FROM tops),
{_climb_sql('u', 'grp', lang_levels)},
root AS ({roots}),
base AS (SELECT p.*, u.pos AS lpos, u.d AS subroot, '' AS proof, CASE WHEN hit THEN low ELSE leaf END AS acc FROM placed p JOIN u_0 u ON u.lang = p.grp),
{(','+chr(10)).join(folds)}
SELECT doc_id, leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root.d AS verified
FROM fold_u_{lang_levels - 1}, root"""


def line_dedup_sql() -> str:
    return """WITH lines AS (
  SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
),
keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM lines
),
often AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT a.*, o.last IS NOT NULL AND a.doc_id <> o.last AS lost FROM keyed a LEFT JOIN often o ON a.k = o.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def collocations_sql() -> str:
    return r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (SELECT lang, unnest(list_transform(range(1, len(ws) + 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS g FROM words),
f1 AS (SELECT lang, g[1] AS a, count(*) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, g[1] AS a, g[2] AS b, count(*) AS f FROM grams WHERE g[2] IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, g[1] AS a, g[2] AS b, g[3] AS c, count(*) AS f FROM grams WHERE g[3] IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
cuts AS (
  SELECT p.lang, p.a || ' ' || p.b AS phrase, p.f, 1 AS k, x.f AS l, y.f AS r FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.a = p.a JOIN f1 y ON y.lang = p.lang AND y.a = p.b
  WHERE p.f >= 10 AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.a = p.a AND t.b = p.b AND 100 * t.f >= 50 * p.f)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.b = p.a AND t.c = p.b AND 100 * t.f >= 50 * p.f)
  UNION ALL SELECT p.lang, p.a || ' ' || p.b || ' ' || p.c, p.f, 1, x.f, y.f FROM f3 p JOIN f1 x ON x.lang = p.lang AND x.a = p.a JOIN f2 y ON y.lang = p.lang AND y.a = p.b AND y.b = p.c
  UNION ALL SELECT p.lang, p.a || ' ' || p.b || ' ' || p.c, p.f, 2, x.f, y.f FROM f3 p JOIN f2 x ON x.lang = p.lang AND x.a = p.a AND x.b = p.b JOIN f1 y ON y.lang = p.lang AND y.a = p.c
),
scored AS (SELECT *, CAST((1000000 * CAST(f AS HUGEINT) * f) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM lowest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, f AS a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
