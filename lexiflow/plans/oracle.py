"""DuckDB SQL computing the same results as the registered Spark queries (``catalog.py``),
used as the correctness oracle on the same parquet tables. Every statement reads the
pre-registered views (documents, labels, embeddings, benchmark) and nothing else."""

from __future__ import annotations

from ..functions.text import CONTRACTION_SPLITS, DEFAULT_STOP_WORDS, lower_stop_set
from . import catalog as C


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(_lit(x) for x in xs) + "]"


STOPS = _list(DEFAULT_STOP_WORDS)
STOPSET = _list(lower_stop_set(DEFAULT_STOP_WORDS))
STOPSET_EXTRA = _list(lower_stop_set(DEFAULT_STOP_WORDS, C.EXTRA_STOP_WORDS))
LETTERS = r"'\p{L}+'"


def _bound(v, n: str) -> str:
    return f"CAST({v} AS DOUBLE)" if isinstance(v, int) else f"{float(v)!r} * {n}"


def _contraction_case(x: str) -> str:
    whens = " ".join(f"WHEN {_lit(w)} THEN {_list(p)}" for w, p in CONTRACTION_SPLITS.items())
    return f"CASE {x} {whens} ELSE [{x}] END"


def docs_cte(class_col: str = C.CLASS_COL, source: str = "documents", id_col: str = "doc_id") -> str:
    return f"d AS (SELECT {id_col} AS doc_id, text, {class_col} AS class FROM {source})"


def token_ctes(prefix: str = "", src: str = "d") -> str:
    return f"""{prefix}kw AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), ' '),
        lambda w: NOT list_contains({STOPS}, w) AND regexp_full_match(w, {LETTERS})) AS words FROM {src}),
{prefix}tok AS (SELECT doc_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos, unnest(words) AS token FROM {prefix}kw)"""


def vocab_ctes(prefix: str = "", stopset: str = STOPSET) -> str:
    return f"""{prefix}parts AS (SELECT doc_id, pos, CAST(generate_subscripts(pl, 1) - 1 AS INTEGER) AS part, unnest(pl) AS term
        FROM (SELECT doc_id, pos, {_contraction_case('lower(token)')} AS pl FROM {prefix}tok)),
{prefix}sw AS (SELECT doc_id, pos, part, term FROM {prefix}parts WHERE term <> '' AND NOT list_contains({stopset}, lower(term))),
{prefix}vocab AS (SELECT DISTINCT term FROM {prefix}sw)"""


def tfidf_ctes(min_df=C.MIN_DF, max_df=C.MAX_DF) -> str:
    n = "(SELECT n FROM nd)"
    return f"""inv AS (SELECT doc_id, pos, token AS term FROM tok WHERE token IN (SELECT term FROM vocab)),
tc AS (SELECT doc_id, term, count(*) AS n FROM inv GROUP BY doc_id, term),
tot AS (SELECT d.doc_id, CAST(coalesce(sum(tc.n), 0) AS BIGINT) AS term_count FROM d LEFT JOIN tc ON tc.doc_id = d.doc_id GROUP BY d.doc_id),
cf AS (SELECT lower(token) AS term, count(*) AS cf FROM tok WHERE lower(token) IN (SELECT term FROM vocab) GROUP BY 1),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM d),
kept AS (SELECT term, cf FROM cf WHERE CAST(cf AS DOUBLE) >= {_bound(min_df, n)} AND CAST(cf AS DOUBLE) <= {_bound(max_df, n)}),
idf AS (SELECT term, cf, log10({n} / CAST(cf + 1 AS DOUBLE)) AS idf FROM kept),
tfidf AS (SELECT tc.doc_id, tc.term, tc.n, tot.term_count,
        CAST(tc.n AS DOUBLE) / CAST(tot.term_count AS DOUBLE) AS tf,
        CAST(round((CAST(tc.n AS DOUBLE) / CAST(tot.term_count AS DOUBLE)) * idf.idf * 1000000.0) AS BIGINT) AS w
    FROM tc JOIN idf ON idf.term = tc.term JOIN tot ON tot.doc_id = tc.doc_id WHERE tot.term_count > 0)"""


def folds_ctes(src: str = "d", k: int = C.N_FOLDS, seed: int = C.SEED) -> str:
    return f"""fh AS (SELECT doc_id, class, md5(CAST(doc_id AS VARCHAR) || ':{seed}') AS h FROM {src}),
ct AS (SELECT class, count(*) AS cnt, min(doc_id) AS first_id FROM {src} GROUP BY class),
co AS (SELECT class, coalesce(sum(cnt) OVER (ORDER BY first_id, class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM ct),
folds AS (SELECT fh.doc_id, fh.class,
        CAST((co.off + row_number() OVER (PARTITION BY fh.class ORDER BY fh.h, fh.doc_id) - 1) % {k} AS INTEGER) AS fold
    FROM fh JOIN co ON co.class = fh.class)"""


def pairs_ctes() -> str:
    return """post AS (SELECT t.doc_id, t.term, t.w, f.fold FROM tfidf t JOIN folds f ON f.doc_id = t.doc_id WHERE t.w <> 0),
nrm AS (SELECT doc_id, CAST(sum(w * w) AS BIGINT) AS nsq FROM post GROUP BY doc_id),
pdot AS (SELECT a.doc_id AS lo, b.doc_id AS hi, CAST(sum(a.w * b.w) AS BIGINT) AS dot
    FROM post a JOIN post b ON a.term = b.term AND a.doc_id < b.doc_id AND a.fold <> b.fold GROUP BY 1, 2),
psim AS (SELECT lo, hi, dot,
        round(CAST(dot AS DOUBLE) / (sqrt(CAST(n1.nsq AS DOUBLE)) * sqrt(CAST(n2.nsq AS DOUBLE))), 6) AS sim
    FROM pdot JOIN nrm n1 ON n1.doc_id = pdot.lo JOIN nrm n2 ON n2.doc_id = pdot.hi)"""


def knn_ctes(src: str = "d", sim_table: str = "psim") -> str:
    return f"""kk AS (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) AS k FROM {src}),
sims AS (SELECT lo AS q, hi AS t, sim FROM {sim_table} WHERE sim <> 0 UNION ALL SELECT hi AS q, lo AS t, sim FROM {sim_table} WHERE sim <> 0),
cand AS (SELECT a.doc_id AS q, b.doc_id AS t, b.fold AS fold_t, coalesce(s.sim, 0.0) AS sim
    FROM folds a JOIN folds b ON a.fold <> b.fold LEFT JOIN sims s ON s.q = a.doc_id AND s.t = b.doc_id),
nb AS (SELECT q, t, fold_t, sim, CAST(row_number() OVER (PARTITION BY q ORDER BY sim DESC, fold_t, t) AS INTEGER) AS rank
    FROM cand QUALIFY rank <= (SELECT k FROM kk)),
votes AS (SELECT nb.q, x.class AS t_class, count(*) AS votes FROM nb JOIN {src} x ON x.doc_id = nb.t GROUP BY 1, 2),
pred AS (SELECT q, t_class AS predicted FROM votes QUALIFY row_number() OVER (PARTITION BY q ORDER BY votes DESC, t_class) = 1),
preds AS (SELECT f.doc_id, f.fold, f.class AS actual, pred.predicted FROM folds f LEFT JOIN pred ON pred.q = f.doc_id)"""


def metric_ctes(src: str = "d") -> str:
    return f"""cm AS (SELECT actual, predicted, count(*) AS n FROM preds GROUP BY 1, 2),
cls AS (SELECT DISTINCT class FROM {src}),
cmet AS (SELECT c.class, CAST(coalesce(a.tp, 0) AS BIGINT) AS tp,
        CAST(coalesce(b.pn, 0) - coalesce(a.tp, 0) AS BIGINT) AS fp,
        CAST(coalesce(s.sup, 0) - coalesce(a.tp, 0) AS BIGINT) AS fn,
        CAST(coalesce(s.sup, 0) AS BIGINT) AS support
    FROM cls c
    LEFT JOIN (SELECT actual AS class, sum(n) AS tp FROM cm WHERE actual = predicted GROUP BY 1) a ON a.class = c.class
    LEFT JOIN (SELECT predicted AS class, sum(n) AS pn FROM cm GROUP BY 1) b ON b.class = c.class
    LEFT JOIN (SELECT actual AS class, sum(n) AS sup FROM cm GROUP BY 1) s ON s.class = c.class),
prf AS (SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision,
        CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall FROM cmet),
prf1 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM prf)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (docs_cte(), token_ctes())
MODEL = (*BASE, vocab_ctes(), tfidf_ctes())
KNN = (*MODEL, folds_ctes(), pairs_ctes(), knn_ctes())
METRICS = (*KNN, metric_ctes())

LABELLED_DOCS = ("d AS (SELECT x.doc_id, x.text, CAST(l.quality AS VARCHAR) AS class "
                 "FROM documents x JOIN labels l ON l.doc_id = x.doc_id)")
R9 = "round({0}, 9) AS {0}"


def _r9(*cols: str) -> str:
    return ", ".join(R9.format(c) for c in cols)


def _smooth(min_df=1, max_df=1.0, max_features=None) -> str:
    return _with(*BASE, _smooth_ctes(min_df, max_df, max_features)) + \
        "SELECT v.doc_id, v.term, v.count, round(v.v / vn.norm, 9) AS weight FROM v JOIN vn ON vn.doc_id = v.doc_id"


def _smooth_ctes(min_df=1, max_df=1.0, max_features=None) -> str:
    n = "(SELECT n FROM nd)"
    limit = f"ORDER BY total DESC, term LIMIT {int(max_features)}" if max_features else ""
    return (f"""clean AS (SELECT doc_id, array_to_string(words, ' ') || CASE WHEN len(words) > 0 THEN ' ' ELSE '' END AS clean_text FROM kw),
st AS (SELECT doc_id, unnest(regexp_extract_all(lower(clean_text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM clean),
sc AS (SELECT doc_id, term, count(*) AS count FROM st GROUP BY 1, 2),
nd AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM d),
stats AS (SELECT term, count(*) AS df, sum(count) AS total FROM sc GROUP BY term),
kept AS (SELECT * FROM stats WHERE CAST(df AS DOUBLE) >= {_bound(min_df, n)} AND CAST(df AS DOUBLE) <= {_bound(max_df, n)} {limit}),
sidf AS (SELECT term, ln((1.0 + {n}) / (1.0 + CAST(df AS DOUBLE))) + 1.0 AS idf FROM kept),
v AS (SELECT sc.doc_id, sc.term, sc.count, CAST(sc.count AS DOUBLE) * sidf.idf AS v FROM sc JOIN sidf ON sidf.term = sc.term),
vn AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM v GROUP BY doc_id)""")


WORDS = ("wt AS (SELECT lower(token) AS word, count(*) AS freq FROM tok WHERE lower(token) <> '' GROUP BY 1)",
         f"sy AS (SELECT word, freq, list_append(regexp_extract_all(word, '.'), {_lit(C.EOW)}) AS syms FROM wt)")



def bpe_ctes(mode: str) -> tuple[str, ...]:
    """The merge steps, one after another: pairs p, best pair b, words w."""
    first = """init AS (SELECT DISTINCT symbol FROM (SELECT unnest(regexp_extract_all(array_to_string(syms, ''), '.')) AS symbol FROM sy)
    WHERE symbol <> '' AND symbol <> ' ')"""
    seen = ("seen AS (SELECT lower(token) AS word, min([doc_id, pos]) AS first FROM tok GROUP BY 1)")
    if mode == "substring":
        start = "w0 AS MATERIALIZED (SELECT sy.word, freq, first, array_to_string(syms, ' ') AS seg FROM sy JOIN seen USING (word))"
        symbols, tie = "string_split(seg, ' ')", "first"
        after = "replace(seg, (SELECT a || ' ' || b FROM b{i}), (SELECT a || b FROM b{i})) AS seg FROM w{i}"
    else:
        start = "w0 AS MATERIALIZED (SELECT sy.word, freq, first, syms AS seg FROM sy JOIN seen USING (word))"
        symbols, tie = "seg", "a, b"
        after = """list_reduce(list_transform(seg, lambda x: [x]), lambda done, x: CASE WHEN done[-1] = a AND x[1] = b
        THEN list_concat(done[:-2], [a || b]) ELSE list_concat(done, x) END) AS seg FROM w{i}, b{i}"""
    steps = []
    for i in range(C.BPE_MERGES):
        steps.append(f"""p{i} AS MATERIALIZED (SELECT s[j] AS a, s[j + 1] AS b, CAST(sum(freq) AS BIGINT) AS cnt, min(list_append(first, j)) AS first
    FROM (SELECT *, unnest(range(1, len(s))) AS j FROM (SELECT freq, first, {symbols} AS s FROM w{i})) GROUP BY 1, 2)""")
        steps.append(f"b{i} AS MATERIALIZED (SELECT a, b, cnt FROM p{i} ORDER BY cnt DESC, {tie} LIMIT 1)")
        steps.append(f"w{i + 1} AS MATERIALIZED (SELECT word, freq, first, {after.format(i=i)})")
    return (*WORDS, first, seen, start, *steps)


def bpe_whole_ctes() -> tuple[str, ...]:
    """All merges of the substring rule, or the reference's number of them: a step of the recursion is one merge. ``tr`` has
    every word under the place of its first occurrence; the rows of the last step name how many merges were made."""
    return (*WORDS, "seen AS (SELECT lower(token) AS word, min([doc_id, pos]) AS first FROM tok GROUP BY 1)",
            """w0 AS MATERIALIZED (SELECT sy.word, freq, array_to_string(syms, ' ') AS start, row_number() OVER (ORDER BY first, sy.word) * 1000000000 AS place
    FROM sy JOIN seen USING (word))""",
            f"""tr(place, n, seg, merges) USING KEY (place) AS (
    SELECT place, freq, start, 0 FROM w0
    UNION
    SELECT place, n, replace(seg, a || ' ' || b, a || b), done + 1 FROM recurring.tr,
        (SELECT s[j] AS a, s[j + 1] AS b, sum(n) AS cnt, min(place + j) AS seen
        FROM (SELECT n, place, s, unnest(range(1, len(s))) AS j FROM (SELECT n, place, string_split(seg, ' ') AS s FROM recurring.tr WHERE contains(seg, ' ')))
        GROUP BY 1, 2 ORDER BY cnt DESC, seen LIMIT 1), (SELECT max(merges) AS done FROM tr)
    WHERE done < {C.BPE_FULL_MERGES} AND contains(seg, a || ' ' || b))""",
            "whole AS MATERIALIZED (SELECT word, freq, seg FROM w0 JOIN tr USING (place))")


EMB = ("e AS (SELECT vec_id, embedding, label FROM embeddings)",
       f"qv AS (SELECT embedding AS qe, vec_id AS q FROM e WHERE vec_id % {C.QUERY_EVERY} = 0)",
       """ev AS (SELECT e.vec_id, e.label, e.embedding, qv.q,
        list_reduce(list_transform(range(1, least(len(e.embedding), len(qv.qe)) + 1),
            lambda i: CAST(e.embedding[i] AS DOUBLE) * CAST(qv.qe[i] AS DOUBLE)), lambda x, y: x + y) AS dot,
        sqrt(list_reduce(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda x, y: x + y)) AS ne,
        sqrt(list_reduce(list_transform(qv.qe, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)), lambda x, y: x + y)) AS nq
    FROM e, qv WHERE e.vec_id <> qv.q)""",
       "ek AS (SELECT CAST(floor(sqrt(count(*) - 1)) AS BIGINT) AS k FROM e)",
       "es AS (SELECT *, CASE WHEN ne * nq = 0 THEN 0.0 ELSE dot / (ne * nq) END AS cos FROM ev)")


def _nearest(value: str) -> str:
    return f"""top AS (SELECT q, vec_id, label, round(ne, 6) AS norm, {value} AS sim,
        CAST(row_number() OVER (PARTITION BY q ORDER BY {value} DESC, vec_id) AS INTEGER) AS rank FROM es QUALIFY rank <= (SELECT k FROM ek))"""


BENCH_MODEL = ("bd AS (SELECT item_id AS doc_id, text FROM benchmark)", token_ctes("b", "bd"))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["sanitize_text"] = _with("d AS (SELECT doc_id, text FROM documents)", token_ctes()) + \
        "SELECT doc_id, array_to_string(words, ' ') || CASE WHEN len(words) > 0 THEN ' ' ELSE '' END AS clean_text FROM kw"
    q["sanitize_tokens"] = _with(*BASE) + "SELECT doc_id, pos, token FROM tok"
    single = sorted({s for s in DEFAULT_STOP_WORDS if len(s) == 1})
    pat = r"[^\p{L}]" + ("|[" + "".join(single) + "]" if single else "")
    q["sanitize_chars"] = ("SELECT doc_id, array_to_string(list_transform(string_split(coalesce(text, ''), ' '), "
                           f"lambda w: regexp_replace(w, '{pat}', '', 'g') || ' '), '') AS clean_chars FROM documents")
    q["stopword_anti_join"] = _with(*BASE, vocab_ctes(stopset=STOPSET_EXTRA)) + "SELECT doc_id, pos, part, term FROM sw"
    q["vocabulary"] = _with(*BASE, vocab_ctes()) + "SELECT term FROM vocab"
    q["in_vocab_tokens"] = _with(*MODEL) + "SELECT term, doc_id, pos FROM inv"
    q["term_counts"] = _with(*MODEL) + "SELECT doc_id, term, n FROM tc"
    q["doc_term_totals"] = _with(*MODEL) + "SELECT doc_id, term_count FROM tot"
    q["document_frequency"] = _with(*MODEL) + "SELECT term, count(*) AS df FROM tc GROUP BY term"
    q["collection_frequency"] = _with(*MODEL) + "SELECT term, cf FROM cf"
    q["vocab_min_max_df"] = _with(*MODEL) + "SELECT term, cf FROM kept"
    q["idf"] = _with(*MODEL) + "SELECT term, cf, round(idf, 9) AS idf FROM idf"
    q["tfidf"] = _with(*MODEL) + "SELECT doc_id, term, n, term_count, tf, w, w / 1000000.0 AS tfidf FROM tfidf"
    q["tfidf_smooth_l2"] = _smooth()
    q["tfidf_smooth_max_features"] = _smooth(C.LIB_MIN_DF, C.LIB_MAX_DF, C.LIB_MAX_FEATURES)
    q["vocab_union"] = _with(*BASE, vocab_ctes(), *BENCH_MODEL, vocab_ctes("b")) + \
        "SELECT term FROM vocab UNION SELECT term FROM bvocab"
    q["word_count"] = _with(*BASE, *WORDS) + "SELECT word, freq FROM wt"
    q["bpe_symbols"] = _with(*BASE, *WORDS) + "SELECT word, freq, array_to_string(syms, ' ') AS symbols FROM sy"
    q["bpe_initial_vocab"] = _with(*BASE, *WORDS) + \
        "SELECT DISTINCT symbol FROM (SELECT unnest(regexp_extract_all(array_to_string(syms, ''), '.')) AS symbol FROM sy) WHERE symbol <> '' AND symbol <> ' '"
    q["bpe_pair_counts"] = _with(*BASE, *WORDS) + \
        ("SELECT syms[i] AS a, syms[i + 1] AS b, CAST(sum(freq) AS BIGINT) AS cnt "
         "FROM (SELECT syms, freq, unnest(range(1, len(syms))) AS i FROM sy) GROUP BY 1, 2")
    q["vector_norms"] = _with(*MODEL) + \
        "SELECT doc_id, CAST(sum(w * w) AS BIGINT) AS norm_sq, sqrt(CAST(sum(w * w) AS DOUBLE)) AS norm FROM tfidf WHERE w <> 0 GROUP BY doc_id"
    q["all_pairs_similarity"] = _with(*MODEL, folds_ctes(), pairs_ctes()) + "SELECT lo, hi, dot, sim FROM psim WHERE sim <> 0"
    q["query_similarity"] = _with(*MODEL, *BENCH_MODEL, """binv AS (SELECT doc_id, token AS term FROM btok WHERE token IN (SELECT term FROM vocab)),
btc AS (SELECT doc_id, term, count(*) AS n FROM binv GROUP BY 1, 2),
btot AS (SELECT doc_id, sum(n) AS term_count FROM btc GROUP BY 1),
bw AS (SELECT btc.doc_id, btc.term,
        CAST(round((CAST(btc.n AS DOUBLE) / CAST(btot.term_count AS DOUBLE)) * idf.idf * 1000000.0) AS BIGINT) AS w
    FROM btc JOIN idf ON idf.term = btc.term JOIN btot ON btot.doc_id = btc.doc_id),
qp AS (SELECT * FROM bw WHERE w <> 0),
tp AS (SELECT * FROM tfidf WHERE w <> 0),
qd AS (SELECT a.doc_id AS q, b.doc_id AS t, CAST(sum(a.w * b.w) AS BIGINT) AS dot FROM qp a JOIN tp b ON a.term = b.term GROUP BY 1, 2),
nq AS (SELECT doc_id, CAST(sum(w * w) AS BIGINT) AS nsq FROM qp GROUP BY 1),
nt AS (SELECT doc_id, CAST(sum(w * w) AS BIGINT) AS nsq FROM tp GROUP BY 1),
qs AS (SELECT q, t, dot, round(CAST(dot AS DOUBLE) / (sqrt(CAST(nq.nsq AS DOUBLE)) * sqrt(CAST(nt.nsq AS DOUBLE))), 6) AS sim
    FROM qd JOIN nq ON nq.doc_id = qd.q JOIN nt ON nt.doc_id = qd.t)""") + "SELECT q, t, dot, sim FROM qs WHERE sim <> 0"
    q["knn_neighbours"] = _with(*KNN) + "SELECT q, rank, t, sim FROM nb"
    q["knn_library"] = _with(*BASE, _smooth_ctes(C.LIB_MIN_DF, C.LIB_MAX_DF, C.LIB_MAX_FEATURES), folds_ctes(), """lw AS (SELECT v.doc_id, v.term, v.v / vn.norm AS w FROM v JOIN vn ON vn.doc_id = v.doc_id),
lpost AS (SELECT lw.doc_id, lw.term, lw.w, f.fold FROM lw JOIN folds f ON f.doc_id = lw.doc_id WHERE lw.w <> 0),
ldot AS (SELECT a.doc_id AS lo, b.doc_id AS hi, sum(a.w * b.w) AS dot
    FROM lpost a JOIN lpost b ON a.term = b.term AND a.doc_id < b.doc_id AND a.fold <> b.fold GROUP BY 1, 2),
lsim AS (SELECT lo, hi, round(dot, 9) AS sim FROM ldot)""", knn_ctes(sim_table="lsim")) + \
        "SELECT doc_id, fold, actual, predicted FROM preds"
    cols = ", ".join(f"coalesce(sum(CASE WHEN top.place = {i} THEN t.w / 1000000.0 END), 0.0) AS t{i}" for i in range(1, C.WIDE_TERMS + 1))
    q["tfidf_wide_top_terms"] = _with(*MODEL, f"top AS (SELECT term, row_number() OVER (ORDER BY cf DESC, term) AS place FROM idf QUALIFY place <= {C.WIDE_TERMS})",
                                      f"wide AS (SELECT t.doc_id, {cols} FROM tfidf t JOIN top ON top.term = t.term GROUP BY 1)") + \
        f"SELECT d.doc_id, d.class, {', '.join(f'coalesce(t{i}, 0.0) AS t{i}' for i in range(1, C.WIDE_TERMS + 1))} FROM d LEFT JOIN wide USING (doc_id)"
    q["stem_vocab"] = _with(*BASE, vocab_ctes()) + \
        f"SELECT DISTINCT CASE WHEN length(term) > {C.STEM_LENGTH} THEN substr(term, 1, {C.STEM_LENGTH}) ELSE term END AS term FROM vocab"
    sub = _with(*BASE, *bpe_ctes("substring"))
    merges = " UNION ALL ".join(f"SELECT {i} AS rank, a, b, cnt FROM b{i}" for i in range(C.BPE_MERGES))
    last = f"w{C.BPE_MERGES}"
    q["bpe_train"] = sub + merges
    q["bpe_train_symbol"] = _with(*BASE, *bpe_ctes("symbol")) + merges
    whole = _with(*BASE, *bpe_whole_ctes()).replace("WITH ", "WITH RECURSIVE ", 1)
    q["bpe_segmented"] = whole + "SELECT word, freq, seg FROM whole"
    q["bpe_segmented_corpus"] = whole + "SELECT t.doc_id, t.pos, w.seg FROM tok t JOIN whole w ON w.word = lower(t.token)"
    full = f"""SELECT DISTINCT term FROM (SELECT CASE WHEN ends_with(seg, '{C.EOW}') THEN seg[:-{len(C.EOW) + 1}] ELSE seg END AS term
    FROM {{words}} WHERE NOT contains(seg, ' ')) WHERE term <> ''"""
    q["bpe_full_words"] = sub + full.format(words=last)
    q["bpe_vocab"] = sub + f"""SELECT row_number() OVER (ORDER BY new, rank, token) - 1 AS position, token FROM (
    SELECT 0 AS new, 0 AS rank, symbol AS token FROM init UNION ALL
    SELECT 1, min(rank), a || b FROM ({merges}) WHERE a || b NOT IN (SELECT symbol FROM init) GROUP BY 3)"""
    q["tfidf_bpe_vocab"] = _with(*BASE, *bpe_whole_ctes(), f"vocab AS ({full.format(words='whole')})", tfidf_ctes()).replace("WITH ", "WITH RECURSIVE ", 1) + \
        "SELECT doc_id, term, n, term_count, w FROM tfidf"
    q["knn_predict"] = _with(*KNN) + "SELECT doc_id, fold, actual, predicted FROM preds"
    macro = ("SELECT class, {r} FROM prf1 UNION ALL "
             "SELECT 'Average' AS class, round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9) FROM prf1").format(
        r=_r9("precision", "recall", "f1"))
    q["knn_cross_validate"] = _with(*METRICS) + macro
    q["macro_metrics"] = _with(LABELLED_DOCS, token_ctes(), vocab_ctes(), tfidf_ctes(), folds_ctes(), pairs_ctes(),
                               knn_ctes(), metric_ctes()) + macro
    conv = "d AS (SELECT conv_id * 4294967296 + turn AS doc_id, text, role AS class FROM conversations)"
    q["knn_conversations"] = _with(conv, token_ctes(), vocab_ctes(), tfidf_ctes(), folds_ctes(), pairs_ctes(),
                                   knn_ctes(), metric_ctes()) + macro
    q["confusion_matrix"] = _with(*METRICS) + "SELECT actual, predicted, n FROM cm"
    q["class_metrics"] = _with(*METRICS) + f"SELECT class, tp, fp, fn, support, {_r9('precision', 'recall', 'f1')} FROM prf1"
    q["weighted_metrics"] = _with(*METRICS) + """, wl AS (SELECT actual AS class FROM preds UNION SELECT predicted FROM preds WHERE predicted IS NOT NULL),
wm AS (SELECT wl.class, coalesce(p.tp, 0) AS tp, coalesce(p.support, 0) AS support,
        coalesce(p.precision, 0.0) AS precision, coalesce(p.recall, 0.0) AS recall, coalesce(p.f1, 0.0) AS f1
    FROM wl LEFT JOIN prf1 p ON p.class = wl.class)
SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), 9) AS accuracy,
    round(sum(precision * support) / sum(support), 9) AS precision,
    round(sum(recall * support) / sum(support), 9) AS recall,
    round(sum(f1 * support) / sum(support), 9) AS f1 FROM wm""".replace("WITH ", "", 0)
    q["argmax_scores"] = _with(*KNN, "codes AS (SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT class FROM d))") + \
        ("SELECT q AS doc_id, code, t_class AS predicted FROM votes JOIN codes ON codes.class = votes.t_class "
         "QUALIFY row_number() OVER (PARTITION BY q ORDER BY votes DESC, code) = 1")
    q["batch_score"] = _with(*KNN, "codes AS (SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT class FROM d))",
                             f"""sizes AS (SELECT g.range AS fold, c.code, count(*) AS n FROM folds f JOIN codes c ON c.class = f.class, range({C.N_FOLDS}) g
    WHERE g.range <> f.fold AND g.range <> {C.SKIPPED_FOLD} GROUP BY 1, 2)""",
                             """vc AS (SELECT v.q, f.fold, c.code, v.t_class, CAST(v.votes AS DOUBLE) / s.n AS score
    FROM votes v JOIN codes c ON c.class = v.t_class JOIN folds f ON f.doc_id = v.q JOIN sizes s ON s.fold = f.fold AND s.code = c.code)""") + \
        ("SELECT q AS doc_id, fold, code, t_class AS predicted, round(score / sum(score) OVER (PARTITION BY q), 9) AS confidence "
         "FROM vc QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, code) = 1")
    q["batch_score_function"] = q["batch_score"]
    q["knn_weighted_jaccard"] = _with(*MODEL, folds_ctes(), """post AS (SELECT t.doc_id, t.term, t.w, f.fold FROM tfidf t JOIN folds f ON f.doc_id = t.doc_id WHERE t.w <> 0),
tot1 AS (SELECT doc_id, CAST(sum(w) AS BIGINT) AS s FROM post GROUP BY doc_id),
least2 AS (SELECT a.doc_id AS lo, b.doc_id AS hi, CAST(sum(least(a.w, b.w)) AS BIGINT) AS m
    FROM post a JOIN post b ON a.term = b.term AND a.doc_id < b.doc_id AND a.fold <> b.fold GROUP BY 1, 2),
jsim AS (SELECT lo, hi, round(CAST(m AS DOUBLE) / CAST(x.s + y.s - m AS DOUBLE), 6) AS sim
    FROM least2 JOIN tot1 x ON x.doc_id = lo JOIN tot1 y ON y.doc_id = hi)""", knn_ctes(sim_table="jsim")) + \
        "SELECT doc_id, fold, actual, predicted FROM preds"
    q["knn_query_predict"] = _with(*MODEL, *BENCH_MODEL, """binv AS (SELECT doc_id, token AS term FROM btok WHERE token IN (SELECT term FROM vocab)),
btc AS (SELECT doc_id, term, count(*) AS n FROM binv GROUP BY 1, 2),
btot AS (SELECT doc_id, sum(n) AS term_count FROM btc GROUP BY 1),
bw AS (SELECT btc.doc_id, btc.term,
        CAST(round((CAST(btc.n AS DOUBLE) / CAST(btot.term_count AS DOUBLE)) * idf.idf * 1000000.0) AS BIGINT) AS w
    FROM btc JOIN idf ON idf.term = btc.term JOIN btot ON btot.doc_id = btc.doc_id),
qp AS (SELECT * FROM bw WHERE w <> 0),
tp AS (SELECT * FROM tfidf WHERE w <> 0),
qd AS (SELECT a.doc_id AS q, b.doc_id AS t, CAST(sum(a.w * b.w) AS BIGINT) AS dot FROM qp a JOIN tp b ON a.term = b.term GROUP BY 1, 2),
nq AS (SELECT doc_id, CAST(sum(w * w) AS BIGINT) AS nsq FROM qp GROUP BY 1),
nt AS (SELECT doc_id, CAST(sum(w * w) AS BIGINT) AS nsq FROM tp GROUP BY 1),
qs AS (SELECT q, t, round(CAST(dot AS DOUBLE) / (sqrt(CAST(nq.nsq AS DOUBLE)) * sqrt(CAST(nt.nsq AS DOUBLE))), 6) AS sim
    FROM qd JOIN nq ON nq.doc_id = qd.q JOIN nt ON nt.doc_id = qd.t),
kq AS (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) AS k FROM d),
qc AS (SELECT b.doc_id AS q, x.doc_id AS t, coalesce(qs.sim, 0.0) AS sim FROM bd b CROSS JOIN d x LEFT JOIN qs ON qs.q = b.doc_id AND qs.t = x.doc_id),
qnb AS (SELECT q, t, sim, CAST(row_number() OVER (PARTITION BY q ORDER BY sim DESC, t) AS INTEGER) AS rank FROM qc QUALIFY rank <= (SELECT k FROM kq)),
qv AS (SELECT qnb.q, x.class AS t_class, count(*) AS votes FROM qnb JOIN d x ON x.doc_id = qnb.t GROUP BY 1, 2),
qp2 AS (SELECT q, t_class AS predicted FROM qv QUALIFY row_number() OVER (PARTITION BY q ORDER BY votes DESC, t_class) = 1)""") + \
        "SELECT qnb.q AS doc_id, qnb.rank, qnb.t, qnb.sim, qp2.predicted FROM qnb JOIN qp2 ON qp2.q = qnb.q"
    q["knn_fit_predict"] = f"SELECT DISTINCT doc_id, predicted FROM ({q['knn_query_predict']})"
    custom = """csim AS (SELECT lo, hi, round(CAST(dot AS DOUBLE) / (CAST(n1.nsq AS DOUBLE) + CAST(n2.nsq AS DOUBLE) - CAST(dot AS DOUBLE)), 6) AS sim
    FROM pdot JOIN nrm n1 ON n1.doc_id = pdot.lo JOIN nrm n2 ON n2.doc_id = pdot.hi)"""
    q["knn_custom_similarity"] = _with(*MODEL, folds_ctes(), pairs_ctes(), custom, knn_ctes(sim_table="csim")) + \
        "SELECT doc_id, fold, actual, predicted FROM preds"
    nine = """nsim AS (SELECT lo, hi, round(CAST(dot AS DOUBLE) / (sqrt(CAST(n1.nsq AS DOUBLE)) * sqrt(CAST(n2.nsq AS DOUBLE))), 9) AS sim
    FROM pdot JOIN nrm n1 ON n1.doc_id = pdot.lo JOIN nrm n2 ON n2.doc_id = pdot.hi)"""
    q["knn_library_stored"] = _with(*MODEL, folds_ctes(), pairs_ctes(), nine, knn_ctes(sim_table="nsim")) + \
        "SELECT doc_id, fold, actual, predicted FROM preds"
    q["dot_product_arrays"] = _with(*EMB, _nearest("round(dot, 6)")) + "SELECT q, rank, vec_id, sim AS dot FROM top"
    q["cosine_embeddings"] = _with(*EMB, _nearest("round(cos, 6)")) + "SELECT q, rank, vec_id, norm, sim FROM top"
    q["knn_embeddings"] = _with(*EMB, _nearest("round(cos, 9)"), """votes AS (SELECT q, label AS predicted FROM top GROUP BY q, label
    QUALIFY row_number() OVER (PARTITION BY q ORDER BY count(*) DESC, label) = 1)""") + \
        "SELECT q, rank, vec_id, label, sim, predicted FROM top JOIN votes USING (q)"
    q["knn_one_embedding"] = _with(EMB[0], "qv AS (SELECT embedding AS qe, vec_id AS q FROM e WHERE vec_id = (SELECT min(vec_id) FROM e))", *EMB[2:],
                                   _nearest("round(cos, 9)"), "best AS (SELECT label FROM top GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)") + \
        "SELECT rank, vec_id, label, sim, (SELECT label FROM best) AS predicted FROM top"
    q["similarity_join"] = _with(*MODEL, folds_ctes(), pairs_ctes()) + \
        f"SELECT lo, hi, dot, sim FROM psim WHERE abs(sim) >= {C.JOIN_MIN_SIM}"
    q["nearest_documents"] = _with(*MODEL, folds_ctes(), pairs_ctes(), f"""met AS (SELECT lo AS q, hi AS t, sim FROM psim UNION ALL SELECT hi AS q, lo AS t, sim FROM psim),
near AS (SELECT met.q, met.t, met.sim, CAST(row_number() OVER (PARTITION BY met.q ORDER BY met.sim DESC, f.fold, met.t) AS INTEGER) AS rank
    FROM met JOIN folds f ON f.doc_id = met.t WHERE met.q % {C.QUERY_EVERY} = 0 AND met.sim > 0 QUALIFY rank <= {C.NEAREST_K})""") + \
        "SELECT q, rank, t, sim FROM near"
    q["stratified_folds"] = _with(docs_cte(), folds_ctes()) + "SELECT doc_id, class, fold FROM folds"
    q["class_counts"] = _with(docs_cte()) + "SELECT class, count(*) AS cnt FROM d GROUP BY class"
    pct = "round_even((CAST(count(*) AS DOUBLE) * 100.0) / (SELECT CAST(count(*) AS DOUBLE) FROM d), 4)"
    q["class_percentages"] = _with(docs_cte()) + f"SELECT class, count(*) AS cnt, {pct} AS pct FROM d GROUP BY class"
    quotas = (f"qt AS (SELECT class, count(*) AS cnt, {pct} AS pct, "
              f"(SELECT CAST(count(*) AS DOUBLE) FROM d) / {float(C.N_FOLDS)!r} AS rows_per_fold FROM d GROUP BY class)",
              "quotas AS (SELECT class, cnt, pct, rows_per_fold, CAST(round_even((rows_per_fold * pct) / 100.0, 0) AS INTEGER) AS quota FROM qt)")
    q["fold_quotas"] = _with(docs_cte(), *quotas) + "SELECT class, cnt, pct, rows_per_fold, quota FROM quotas"
    k = C.N_FOLDS
    q["quota_folds"] = _with(docs_cte(), *quotas, f"""qf AS (SELECT d.doc_id, d.class, md5(CAST(d.doc_id AS VARCHAR) || ':{C.SEED}') AS h, quotas.quota,
        row_number() OVER (PARTITION BY d.class ORDER BY md5(CAST(d.doc_id AS VARCHAR) || ':{C.SEED}'), d.doc_id) - 1 AS rn
    FROM d JOIN quotas ON quotas.class = d.class)""") + f"""SELECT doc_id, class, CAST(rn // quota AS INTEGER) AS fold FROM qf WHERE quota > 0 AND rn < quota * {k}
UNION ALL
SELECT doc_id, class, CAST((row_number() OVER (ORDER BY h, doc_id) - 1) % {k} AS INTEGER) AS fold FROM qf WHERE NOT (quota > 0 AND rn < quota * {k})"""
    q["fold_train_test_split"] = _with(docs_cte(), folds_ctes()) + \
        (f"SELECT CAST(g.range AS INTEGER) AS fold, CASE WHEN g.range = f.fold THEN 'test' ELSE 'train' END AS split, "
         f"f.doc_id, f.class FROM folds f, range({k}) g")
    q["drop_first_n_per_class"] = _with(docs_cte()) + \
        f"SELECT doc_id, class FROM d QUALIFY row_number() OVER (PARTITION BY class ORDER BY doc_id) > {C.DROP_FIRST_N}"
    q["label_encode"] = _with(docs_cte()) + \
        "SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT class FROM d WHERE class IS NOT NULL)"
    L = C.PAD_MAX_LENGTH
    q["encode_pad_mask"] = _with(*MODEL, f"""ids AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 + 4 AS INTEGER) AS id FROM vocab),
body AS (SELECT tok.doc_id, tok.pos + 1 AS pos, coalesce(ids.id, 1) AS input_id, 1 AS attention_mask
    FROM tok LEFT JOIN ids ON ids.term = lower(tok.token) WHERE tok.pos < {L - 2}),
lens AS (SELECT d.doc_id, least(coalesce(c.n, 0), {L - 2}) + 2 AS len FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM tok GROUP BY 1) c ON c.doc_id = d.doc_id),
longest AS (SELECT max(len) AS m FROM lens),
pads AS (SELECT doc_id, unnest(range(len, (SELECT m FROM longest))) AS pos, 0 AS input_id, 0 AS attention_mask FROM lens)""") + \
        """SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(input_id AS INTEGER) AS input_id, CAST(attention_mask AS INTEGER) AS attention_mask FROM (
    SELECT * FROM body UNION ALL SELECT doc_id, 0, 2, 1 FROM lens UNION ALL SELECT doc_id, len - 1, 3, 1 FROM lens UNION ALL SELECT * FROM pads)"""
    q["padded_batches"] = _with(*MODEL, f"""ids AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 + 4 AS INTEGER) AS id FROM vocab),
body AS (SELECT tok.doc_id, tok.pos + 1 AS pos, coalesce(ids.id, 1) AS input_id, 1 AS attention_mask
    FROM tok LEFT JOIN ids ON ids.term = lower(tok.token) WHERE tok.pos < {L - 2}),
lens AS (SELECT d.doc_id, least(coalesce(c.n, 0), {L - 2}) + 2 AS len FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM tok GROUP BY 1) c ON c.doc_id = d.doc_id),
buckets AS (SELECT doc_id, len, CAST(ceil(len / 16.0) AS INTEGER) AS bucket FROM lens),
dealt AS (SELECT *, (row_number() OVER (PARTITION BY bucket ORDER BY md5(CAST(doc_id AS VARCHAR) || ':{C.SEED}'), doc_id) - 1) // 16 AS batch FROM buckets),
full_ AS (SELECT doc_id, len, bucket || '-' || batch AS batch_id, max(len) OVER (PARTITION BY bucket, batch) AS longest FROM dealt),
pads AS (SELECT doc_id, unnest(range(len, longest)) AS pos, 0 AS input_id, 0 AS attention_mask FROM full_)""") + \
        """SELECT batch_id, doc_id, CAST(pos AS INTEGER) AS pos, CAST(input_id AS INTEGER) AS input_id, CAST(attention_mask AS INTEGER) AS attention_mask FROM (
    SELECT * FROM body UNION ALL SELECT doc_id, 0, 2, 1 FROM lens UNION ALL SELECT doc_id, len - 1, 3, 1 FROM lens UNION ALL SELECT * FROM pads) JOIN full_ USING (doc_id)"""
    q["tfidf_matrix"] = _with(*MODEL, """cols AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS c FROM idf),
widths AS (SELECT c // 4096 AS column_block, count(*) AS n_columns FROM cols GROUP BY 1),
filled AS (SELECT t.doc_id, c // 4096 AS column_block, count(*) AS n, sum(t.w * (c % 4096 + 1)) AS s FROM tfidf t JOIN cols USING (term) WHERE t.w <> 0 GROUP BY 1, 2)""") + \
        """SELECT d.doc_id, d.class, w.column_block, w.n_columns, w.n_columns - coalesce(f.n, 0) AS n_zeros, CAST(coalesce(f.s, 0) AS BIGINT) AS by_place
FROM d CROSS JOIN widths w LEFT JOIN filled f ON f.doc_id = d.doc_id AND f.column_block = w.column_block"""
    q["tfidf_table_round_trip"] = q["tfidf"]
    q["folds_file_round_trip"] = _with(docs_cte(), folds_ctes()) + "SELECT f.doc_id, d.text, f.class, f.fold FROM folds f JOIN d ON d.doc_id = f.doc_id"
    q["folds_json_round_trip"] = q["folds_file_round_trip"]
    q["fold_snapshot_round_trip"] = q["stratified_folds"]
    q["fold_csv_round_trip"] = q["fold_train_test_split"]
    q["vocabulary_file_round_trip"] = q["vocab_union"]
    q["metrics_csv_round_trip"] = q["knn_cross_validate"]
    return q
