"""Registered queries of the operators and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.sources.tables import read_table

from . import bpe, chat, clusters, exact_dedup, langid, licenses, minhash, packing, pii, quality, repair, rules, urls

#: Rules of the registered url query: (action, host and path).
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))


#: Rank file of the registered token queries; the split pattern comes with it.
RANK_FILE = "byte_bpe_50k.tiktoken"
#: The same vocabulary as a tokenizers file, which has the added tokens.
JSON_FILE = "byte_bpe_50k.json"


def _vocabulary(name: str = RANK_FILE) -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = _vocabulary()
    ids = bpe.encode(read_table(spark, sf_dir, "documents"), ranks, pattern)
    ids = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                     F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids")
    return bpe.decode(ids, ranks, pattern).select("doc_id", "n_tokens", "ids_sha256",
                                                  F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(read_table(spark, sf_dir, "documents"))
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(F.col("k_id").alias("doc_id"), *counts, F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("k_id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("sha")).alias("text_sha256"))


def op4_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select(F.col("k_id").alias("doc_id"), "host", "path", "p_doc", "p_host", "p_path", "quality", "kept")


def op5_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents"))
    words = F.transform("places", lambda p: p["word"])
    names = lambda *lists: F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), ",")
    base, other = F.transform("places", lambda p: p["label"]), F.transform("matches", lambda m: m["label"])
    share = F.array_max(F.transform("matches", lambda m: m["literal"] / m["words"]))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
                        F.array_max(words).alias("last_word"), names(base).alias("base_labels"), names(base, other).alias("labels"),
                        F.coalesce(share, F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    added = packing.read_added_tokens(public_tokenizers.path(JSON_FILE))
    return packing.pack(read_table(spark, sf_dir, "documents"), *_vocabulary(), added=added)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = ", ".join(f"('{action}', '{rule}')" for action, rule in URL_RULES)
    return urls.url_verdicts(read_table(spark, sf_dir, "pages"),
                             spark.sql(f"SELECT * FROM VALUES {table} AS rules(action, rule)"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("k_id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(langid.language_counts(docs, ~langid.held_out()))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(langid.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.host_rules(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("k_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "soft_failed")


#: The further conversation of the chat query: its texts are made of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    further = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{CONTROL_TEXT}'), (-1L, 1L, 'assistant', '{CONTROL_TEXT}') "
                        "AS t(conv_id, turn, role, text)")
    formatted = chat.format_turns(turns.union(further), *_vocabulary())
    return chat.conversation_digests(chat.read_turns(formatted, *_vocabulary()))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(read_table(spark, sf_dir, "conversations"))


def op13_hilbert_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_pii_crf": op2_pii_crf,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality_bayes": op4_quality_bayes,
    "op5_license_templates": op5_license_templates,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_url_filters": op7_url_filters,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_language_codes": op9_language_codes,
    "op10_host_rules": op10_host_rules,
    "op11_chat_format": op11_chat_format,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hilbert_clusters": op13_hilbert_clusters,
}

_OP3 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

_OP7 = f"""
WITH rules(action, rule) AS (VALUES {", ".join(f"('{a}', '{r}')" for a, r in URL_RULES)}),
parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
urls AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
fits AS (
  SELECT u.*, r.rule, r.action, row_number() OVER (
    PARTITION BY page_id, host, path ORDER BY length(r.rule) DESC, r.action = 'block' DESC) AS place
  FROM (SELECT DISTINCT * FROM urls) u JOIN rules r
    ON (u.host = split_part(r.rule, '/', 1) OR ends_with(u.host, '.' || split_part(r.rule, '/', 1)))
   AND starts_with(u.path, substr(r.rule, strpos(r.rule, '/'))))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM urls u LEFT JOIN (SELECT * FROM fits WHERE place = 1) f
  ON u.page_id IS NOT DISTINCT FROM f.page_id AND u.host = f.host AND u.path = f.path
"""


def _op10() -> str:
    """Counts, then per host and soft rule the shrunk rate, all in SQL."""
    soft = list(rules.SOFT_RULES)
    space = r"[\x20\x09-\x0D]"
    windows = "list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(9) || w[i + 1] || chr(9) || w[i + 2])"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(t, '{space}+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
places AS (
  SELECT row_no, unnest({windows}) AS word3, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) > 2),
hits AS (SELECT row_no, i FROM (SELECT *, count(*) OVER (PARTITION BY row_no, word3) AS c FROM places) WHERE c > 1),
covered AS (
  SELECT row_no, count(DISTINCT i + step) AS n FROM hits, (SELECT unnest([0, 1, 2]) AS step) GROUP BY row_no),
counts AS (
  SELECT s.row_no, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c USING (row_no)),
judged AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PCT} * n_words AS base_failed,
         {", ".join(f"({rules.SOFT_RULES[r]}) AS fail_{r}" for r in soft)} FROM counts),
hosts AS (
  SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER (fail_{r}) AS k_{r}" for r in soft)}
  FROM judged GROUP BY source),
total AS (
  SELECT sum(n) AS n, count(*) AS h, {", ".join(f"sum(k_{r}) / sum(n) AS m_{r}" for r in soft)} FROM hosts),
spread AS (
  SELECT {", ".join(f"sum(hosts.n * (k_{r} / hosts.n - m_{r}) ** 2) / any_value(total.n) - "
                    f"any_value(m_{r} * (1 - m_{r}) * total.h / total.n) AS v_{r}" for r in soft)} FROM hosts, total),
prior AS (
  SELECT total.*, {", ".join(f"CASE WHEN v_{r} <= 0 THEN 1e6 ELSE least(1e6, greatest(2.0, "
                             f"m_{r} * (1 - m_{r}) / v_{r} - 1)) END AS s_{r}" for r in soft)} FROM total, spread),
verdicts AS (
  SELECT source, {", ".join(f"rate_{r} * (1 - m_{r}) > {rules.HOST_ODDS} * m_{r} * (1 - rate_{r}) AS strict_{r}" for r in soft)}
  FROM (SELECT hosts.source, prior.*, {", ".join(f"(k_{r} + m_{r} * s_{r}) / (hosts.n + s_{r}) AS rate_{r}" for r in soft)} FROM hosts, prior))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({" OR ".join(f"(fail_{r} AND strict_{r})" for r in soft)}) AS kept,
       ({" OR ".join(f"(fail_{r} AND strict_{r})" for r in soft)}) AS soft_failed
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""


_CONTROL_HEADS = (r"(<)(\\*/s>)", r"(\[)(\\*/?(?:INST|SYS|ROLE)\])")
_ESCAPED = "regexp_replace(regexp_replace({0}, '" + _CONTROL_HEADS[0] + "', '\\1\\\\\\2', 'g'), '" + _CONTROL_HEADS[1] + "', '\\1\\\\\\2', 'g')"
_OP11 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
marked AS (
  SELECT *, length({_ESCAPED.format('t')}) + CASE role WHEN 'user' THEN length('[INST][/INST]') WHEN 'system' THEN length('[SYS][/SYS]')
         WHEN 'assistant' THEN length('</s>') ELSE length({_ESCAPED.format('role')}) + length('[ROLE][/ROLE]</s>') END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


def _op12() -> str:
    """Damage by crc32 bit by bit, then the cheapest edits turn by turn: per state one string of cost
    (nine digits) and letters, so the least string is the cheapest, then the least in ASCII."""
    def more(x: str, cost: str, letter: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN NULL ELSE printf('%09d', {x}[1:9]::INTEGER + {cost}) || {x}[10:] || '{letter}' END"

    insert = lambda x: more(x, str(repair.INSERT), "I")
    delete = lambda x: more(x, str(repair.DELETE), "D")
    when = lambda test, then: f"CASE WHEN {test} THEN {then} END"
    rerole = f"x.p + {repair.REROLE}"
    user = f"least(acc.u, {insert('acc.n')}, {insert('acc.s')}, {insert('acc.a')})"
    closed = f"list_transform([{{n: acc.n, s: acc.s, u: {user}, a: acc.a}}], lambda c: {{n: c.n, s: c.s, u: c.u, a: least(c.a, {insert('c.u')}), m: least(c.n, c.s, c.a, {insert('c.u')})}})"
    step = f"""{{n: {delete('c.n')}, s: least({delete('c.s')}, {when("x.i = 's' AND NOT x.f", more('c.n', 'x.p', 'K'))}),
    u: least({delete('c.u')}, {when("x.i = 'u' AND NOT x.f", more('c.m', 'x.p', 'K'))}, {when('NOT x.f', more('c.m', rerole, 'R'))}),
    a: least({delete('c.a')}, {when("x.i = 'a' AND NOT x.f", more('c.u', 'x.p', 'K'))}, {when('NOT x.f', more('c.u', rerole, 'R'))})}}"""
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS t,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT) AS k
  FROM conversations),
kinds AS (
  SELECT *, xor(list_reduce(k, lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
           lambda x, o: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS t, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || t), copy) AS pos,
         left(role, 1) AS i, rtrim(t, {spaces}) AS shown FROM damaged),
faulty AS (
  SELECT *, shown = '' AS blank, shown <> '' AND row_number() OVER (PARTITION BY conv_id, role, t ORDER BY pos) > 1 AS again,
         lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
told AS (
  SELECT *, NOT blank AND NOT again AND right(shown, 1) NOT IN ('.', '!', '?') AS cut FROM faulty),
convs AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND (before || i) NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{i: i, f: blank OR again, p: CASE WHEN cut THEN {repair.TRUNCATED} ELSE 0 END, role: role, t: t}} ORDER BY pos) AS turns
  FROM told GROUP BY conv_id),
ends AS (
  SELECT *, list_transform([list_reduce(turns, lambda acc, x: list_transform({closed}, lambda c: {step})[1],
    {{n: '000000000', s: NULL::VARCHAR, u: NULL::VARCHAR, a: NULL::VARCHAR}})], lambda acc: least(acc.n, list_transform({closed}, lambda c: c.a)[1]))[1] AS best FROM convs),
repaired AS (
  SELECT *, list_reduce(string_split(best[10:], ''), lambda acc, e: CASE e
    WHEN 'D' THEN {{k: acc.k + 1, s: acc.s, o: acc.o}}
    WHEN 'I' THEN {{k: acc.k, s: CASE acc.s WHEN 'u' THEN 'a' ELSE 'u' END, o: list_append(acc.o, CASE acc.s WHEN 'u' THEN 'assistant:' ELSE 'user:' END)}}
    WHEN 'K' THEN {{k: acc.k + 1, s: turns[acc.k].i, o: list_append(acc.o, turns[acc.k].role || ':' || turns[acc.k].t)}}
    WHEN 'R' THEN {{k: acc.k + 1, s: CASE acc.s WHEN 'u' THEN 'a' ELSE 'u' END,
                    o: list_append(acc.o, CASE acc.s WHEN 'u' THEN 'assistant:' ELSE 'user:' END || turns[acc.k].t)}}
    ELSE acc END, {{k: 1::BIGINT, s: '', o: []::VARCHAR[]}}).o AS lines FROM ends)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best[1:9]::BIGINT, 0) AS cost,
       coalesce(best[10:], '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def _op13(k: int = 16, rounds: int = 3) -> str:
    """All vectors against all centroids, round by round."""
    nearest = """
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min(d) AS d, arg_min(c, d * 1000 + c) AS c
  FROM (SELECT q.*, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS d FROM q, c{i}) GROUP BY rid"""
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS ({nearest.format(i=i)})")
        steps.append(f"""s{i} AS (
  SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY c, i)""")
        steps.append(f"""c{i + 1} AS (
  SELECT c{i}.c, coalesce(f.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{i} GROUP BY c) f USING (c))""")
    return f"""
WITH q AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v AS m FROM q QUALIFY c < {k}),
{", ".join(steps)},
last AS ({nearest.format(i=rounds)})
SELECT vec_id, last.c::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY last.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM last JOIN c{rounds} ON last.c = c{rounds}.c
"""


ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": _OP3,
    "op7_url_filters": _OP7,
    "op10_host_rules": _op10(),
    "op11_chat_format": _OP11,
    "op12_conversation_repair": _op12(),
    "op13_hilbert_clusters": _op13(),
}
