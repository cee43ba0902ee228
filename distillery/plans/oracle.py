"""DuckDB SQL oracles, written independently of the Spark expressions (rank-range
self-joins instead of window frames, direct formulas instead of operators).

``fix9(x)`` / ``fix6(x)`` are spelled out as ``floor(x * 1e9 + 0.5) / 1e9``: the same
IEEE arithmetic in both engines, unlike ``round()`` on exact half-way values.
"""

from __future__ import annotations

from distillery.functions.text import (
    ASSISTANT_SUFFIX, DEFAULT_INSTRUCTION, DEFAULT_MAX_TOKENS, RERANK_SYSTEM_PROMPT, TURN_END, TURN_START,
    suffix_token_ids,
)
from distillery.sources.fixtures import (
    CANDIDATE_WINDOW, IN_DOMAIN_MAX_LABEL, LOGPROB_SCALE, TOP_LOGPROB_MIN,
)


def _fix(expr: str, d: int = 9) -> str:
    s = f"1e{d}"
    return f"(floor(({expr}) * {s} + 0.5) / {s})"


def _cos(a: str, b: str, suffix: str = "") -> str:
    return (f"list_dot_product({a}.v{suffix}, {b}.v{suffix}) / "
            f"(greatest({a}.n{suffix}, 1e-8) * greatest({b}.n{suffix}, 1e-8))")


JV_CTE = f"""
ev AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
eq AS (SELECT vec_id, label, v,
              list_transform(v, lambda x: floor(x * 10 + 0.5) / 10) AS v1,
              list_transform(v, lambda x: floor(x * 100 + 0.5) / 100) AS v2 FROM ev),
en AS (SELECT *, sqrt(list_dot_product(v, v)) AS n, sqrt(list_dot_product(v1, v1)) AS n1,
              sqrt(list_dot_product(v2, v2)) AS n2 FROM eq),
pairs AS MATERIALIZED (
  SELECT q.vec_id AS qid, p.vec_id AS pid,
         CAST(q.label = p.label AS INTEGER) AS rel,
         CASE WHEN q.label = p.label THEN 'positive' ELSE 'negative' END AS side,
         CASE WHEN q.label <= {IN_DOMAIN_MAX_LABEL} THEN 'in' ELSE 'out' END AS domain,
         q.label AS qlabel, p.vec_id AS seq,
         {_fix(_cos('q', 'p'))} AS teacher,
         {_fix(_cos('q', 'p', '1'))} AS "before",
         {_fix(_cos('q', 'p', '2'))} AS "after"
  FROM (SELECT *, unnest(range(1, {CANDIDATE_WINDOW} + 1)) AS off FROM en) q JOIN en p ON p.vec_id = q.vec_id + q.off)
"""


def with_jv(body: str) -> str:
    return f"WITH {JV_CTE}{body}"


ORACLES: dict[str, str] = {}

ORACLES["pair_cosine"] = with_jv(
    'SELECT qid, pid, rel, side, domain, teacher, "before", "after" FROM pairs'
)

def _q(text: str) -> str:
    """SQL string literal (newlines via chr(10))."""
    parts = text.replace("'", "''").split("\n")
    return " || chr(10) || ".join(f"'{p}'" for p in parts)


# rank-range self-join: positive at rank r, negatives at ranks r+1 .. r+4
HARD_CTE = f"""
, r AS (SELECT qid, pid, domain, teacher, "before", "after", seq,
               row_number() OVER (PARTITION BY qid ORDER BY teacher DESC, seq) AS rk FROM pairs),
ht AS (
  SELECT a.qid, a.domain, a.pid AS positive, b.pid AS negative, a.rk AS pos_rank, b.rk AS neg_rank,
         {_fix('a.teacher - b.teacher')} AS score,
         a."before" AS before_pos, b."before" AS before_neg, a."after" AS after_pos, b."after" AS after_neg
  FROM r a JOIN r b ON a.qid = b.qid AND b.rk > a.rk AND b.rk <= a.rk + 4
  WHERE a.rk <= 8 AND a.pid <> b.pid AND a.teacher - b.teacher > 0)
"""

ORACLES["hard_negative_triplets"] = with_jv(
    HARD_CTE + "SELECT qid, positive, negative, pos_rank, neg_rank, score FROM ht"
)

ORACLES["hard_negative_first_seen"] = with_jv(
    HARD_CTE + """, fs AS (SELECT qid, min(seq) AS first_seen FROM pairs GROUP BY qid)
SELECT ht.qid, positive, negative, pos_rank, neg_rank, score, first_seen
FROM ht JOIN fs ON ht.qid = fs.qid ORDER BY first_seen, pos_rank, neg_rank"""
)

ORACLES["random_negative_triplets"] = with_jv(f"""
, r AS (SELECT qid, pid, teacher, seq,
               row_number() OVER (PARTITION BY qid ORDER BY teacher DESC, seq) AS rk FROM pairs),
pool AS (
  SELECT a.qid, a.pid AS positive, b.pid AS negative, a.rk AS pos_rank, b.seq AS neg_seq,
         a.teacher - b.teacher AS m,
         row_number() OVER (PARTITION BY a.qid, a.rk ORDER BY
             md5(concat_ws('|', '42', CAST(a.qid AS VARCHAR), CAST(a.rk AS VARCHAR), CAST(b.seq AS VARCHAR))),
             b.seq) AS d
  FROM r a JOIN r b ON a.qid = b.qid AND b.rk > a.rk WHERE a.rk <= 8)
SELECT qid, positive, negative, pos_rank, neg_seq, {_fix('m')} AS score
FROM pool WHERE d <= 4 AND positive <> negative AND m > 0
""")

ORACLES["training_export"] = with_jv(
    HARD_CTE + "SELECT qid, positive, negative, CAST(score AS FLOAT) AS score FROM ht"
)

ORACLES["training_preview"] = with_jv(
    HARD_CTE + "SELECT qid, positive, negative, pos_rank, neg_rank, score FROM ht "
    "ORDER BY qid, pos_rank, neg_rank LIMIT 1"
)

ORACLES["triplet_counts"] = with_jv(
    HARD_CTE + "SELECT domain, count(*) AS n_triplets FROM ht GROUP BY ROLLUP (domain)"
)

ORACLES["soft_label_triplets"] = with_jv("""
SELECT a.qid, a.pid AS positive, b.pid AS negative, a.teacher AS label_pos, b.teacher AS label_neg
FROM pairs a JOIN pairs b ON a.qid = b.qid WHERE a.rel = 1 AND b.rel = 0
""")

_z = f"({LOGPROB_SCALE} * teacher)"
ORACLES["yes_no_logit"] = with_jv(f"""
, lp AS (SELECT qid, pid, -ln(1 + exp(-{_z})) AS lp_yes, -ln(1 + exp({_z})) AS lp_no FROM pairs)
SELECT qid, pid,
       CAST((lp_yes >= {TOP_LOGPROB_MIN})::INTEGER + (lp_no >= {TOP_LOGPROB_MIN})::INTEGER AS BIGINT) AS n_tokens,
       {_fix(f"CASE WHEN lp_yes >= {TOP_LOGPROB_MIN} THEN lp_yes ELSE -10.0 END - "
             f"CASE WHEN lp_no >= {TOP_LOGPROB_MIN} THEN lp_no ELSE -10.0 END")} AS logit
FROM lp
""")

ORACLES["score_pairs_pandas"] = with_jv("SELECT qid, pid, teacher FROM pairs")


def _metrics_cte(models: list[str], by_domain: bool) -> str:
    dom = "domain, " if by_domain else ""
    union = "\n  UNION ALL ".join(
        f"SELECT qid, domain, rel, seq, '{m}' AS model, \"{m}\" AS score FROM pairs" for m in models
    )
    part = f"{dom}model, qid"
    cum = f"PARTITION BY {part} ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return f"""
, lg AS ({union}),
a AS (SELECT {dom}model, qid, rel, score,
        row_number() OVER (PARTITION BY {part} ORDER BY score DESC, seq) AS rn,
        sum(rel) OVER ({cum}) AS cr,
        count(*) OVER ({cum}) AS cn,
        avg(rel) OVER (PARTITION BY {part}, score) AS g,
        row_number() OVER (PARTITION BY {part} ORDER BY rel DESC, seq) AS irn
      FROM lg),
pq AS (SELECT {dom}model, qid, count(*) AS n_cand, sum(rel) AS n_rel,
         sum(CASE WHEN rel = 1 THEN CAST(cr AS DOUBLE) / cn ELSE 0 END) / nullif(CAST(sum(rel) AS DOUBLE), 0) AS ap,
         coalesce(max(CASE WHEN rel = 1 AND rn <= 10 THEN CAST(1 AS DOUBLE) / rn END), 0) AS rr,
         sum(CASE WHEN rn <= 10 THEN g / (ln(rn + 1) / ln(2)) ELSE 0 END)
           / nullif(sum(CASE WHEN irn <= 10 THEN rel / (ln(irn + 1) / ln(2)) ELSE 0 END), 0) AS ndcg
       FROM a GROUP BY {dom}model, qid)
"""


_ALL = ["teacher", "before", "after"]
ORACLES["average_precision"] = with_jv(
    _metrics_cte(_ALL, False) + f"SELECT model, qid, {_fix('coalesce(ap, 0)', 6)} AS ap FROM pq"
)
ORACLES["rr_at_10"] = with_jv(
    _metrics_cte(_ALL, False) + f"SELECT model, qid, {_fix('rr', 6)} AS rr_at_10 FROM pq"
)
ORACLES["ndcg_at_10"] = with_jv(
    _metrics_cte(_ALL, False) + f"SELECT model, qid, {_fix('coalesce(ndcg, 0)', 6)} AS ndcg_at_10 FROM pq"
)

REPORT_CTE = _metrics_cte(["before", "after"], True) + f"""
, agg AS (SELECT domain, model, avg(ap) AS m_map, avg(rr) AS m_mrr, avg(ndcg) AS m_ndcg
          FROM pq WHERE n_rel > 0 AND n_rel < n_cand GROUP BY domain, model),
rep AS (SELECT domain, model, 'map' AS metric, {_fix('m_map', 6)} AS value FROM agg
        UNION ALL SELECT domain, model, 'mrr@10', {_fix('m_mrr', 6)} FROM agg
        UNION ALL SELECT domain, model, 'ndcg@10', {_fix('m_ndcg', 6)} FROM agg)
"""
ORACLES["rerank_report"] = with_jv(REPORT_CTE + "SELECT domain, model, metric, value FROM rep")

ORACLES["compare_runs"] = with_jv(REPORT_CTE + f"""
, w AS (SELECT domain, metric, max(CASE WHEN model = 'before' THEN value END) AS "before",
               max(CASE WHEN model = 'after' THEN value END) AS "after"
        FROM rep GROUP BY domain, metric),
c AS (SELECT *, "after" - "before" AS d,
             CASE WHEN "before" = 0 THEN CAST('inf' AS DOUBLE) ELSE ("after" - "before") / "before" * 100 END AS rc
      FROM w)
SELECT domain, metric, "before", "after", {_fix('d', 6)} AS abs_change, {_fix('rc', 6)} AS rel_change,
       CASE WHEN d >= 0 THEN '↑' ELSE '↓' END AS direction,
       upper(metric) AS metric_label,
       printf('%.6f', {_fix('"before"', 6)}) AS before_text,
       printf('%.6f', {_fix('"after"', 6)}) AS after_text,
       printf('%+.6f', {_fix('d', 6)}) AS abs_text,
       printf('%+.2f%%', {_fix('rc', 2)}) AS rel_text
FROM c
""")

ORACLES["margin_mse"] = with_jv(HARD_CTE + f"""
SELECT 'before' AS model, {_fix('avg(((before_pos - before_neg) - score) * ((before_pos - before_neg) - score))', 6)} AS loss,
       count(*) AS n FROM ht
UNION ALL
SELECT 'after', {_fix('avg(((after_pos - after_neg) - score) * ((after_pos - after_neg) - score))', 6)}, count(*) FROM ht
""")


def _kl(tp: str, tn: str, sp: str, sn: str, t: float) -> str:
    def ls(x, y, which):
        m = f"(greatest({x}, {y}) / {t})"
        lse = f"ln(exp({x} / {t} - {m}) + exp({y} / {t} - {m}))"
        v = x if which == 0 else y
        return f"({v} / {t} - {m} - {lse})"
    terms = []
    for i in (0, 1):
        lt, lsv = ls(tp, tn, i), ls(sp, sn, i)
        terms.append(f"CASE WHEN exp({lt}) > 0 THEN exp({lt}) * ({lt} - {lsv}) ELSE 0 END")
    return f"(({terms[0]}) + ({terms[1]})) * {t * t}"


_kl_parts = []
for _m in ("before", "after"):
    for _t in (1.0, 2.0):
        _kl_parts.append(
            f"SELECT '{_m}' AS model, CAST({_t} AS DOUBLE) AS temperature, "
            f"{_fix('avg(' + _kl('tp', 'tn', _m + '_p', _m + '_n', _t) + ')', 6)} AS loss, count(*) AS n FROM st"
        )
ORACLES["distill_kl"] = with_jv("""
, st AS (SELECT a.teacher AS tp, b.teacher AS tn, a."before" AS before_p, b."before" AS before_n,
                a."after" AS after_p, b."after" AS after_n
         FROM pairs a JOIN pairs b ON a.qid = b.qid WHERE a.rel = 1 AND b.rel = 0)
""" + "\nUNION ALL\n".join(_kl_parts))

# ---- text samples from conversations ---------------------------------------------------

TEXT_CTE = """
WITH u AS (SELECT conv_id, turn, text AS query FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn, text AS reply FROM conversations WHERE role = 'assistant'),
s AS (SELECT u.conv_id, u.turn, u.query, a.reply, nx.reply AS n_reply, pv.reply AS p_reply
      FROM u JOIN a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
      LEFT JOIN a nx ON nx.conv_id = u.conv_id + 1 AND nx.turn = u.turn + 1
      LEFT JOIN a pv ON pv.conv_id = u.conv_id - 1 AND pv.turn = u.turn + 1),
tp AS (SELECT conv_id, turn, query, 'positive' AS side, 0 AS pos, 1 AS rel, reply AS passage FROM s
         WHERE reply IS NOT NULL
       UNION ALL SELECT conv_id, turn, query, 'negative', 0, 0, n_reply FROM s WHERE n_reply IS NOT NULL
       UNION ALL SELECT conv_id, turn, query, 'negative', CASE WHEN n_reply IS NULL THEN 0 ELSE 1 END, 0, p_reply
         FROM s WHERE p_reply IS NOT NULL),
truthy AS (SELECT * FROM s WHERE length(query) > 0 AND (n_reply IS NOT NULL OR p_reply IS NOT NULL))
"""

ORACLES["samples_to_pairs"] = TEXT_CTE + """
SELECT conv_id, turn, side, pos, rel, md5(query) AS query_md5, md5(passage) AS passage_md5,
       length(passage) AS passage_chars FROM tp
"""

ORACLES["truthy_samples"] = TEXT_CTE + """
SELECT conv_id, turn, md5(query) AS query_md5, CAST(1 AS BIGINT) AS n_positive,
       CAST((n_reply IS NOT NULL)::INTEGER + (p_reply IS NOT NULL)::INTEGER AS BIGINT) AS n_negative
FROM truthy
"""

ORACLES["distinct_texts"] = TEXT_CTE + """
, tx AS (SELECT query AS text FROM truthy UNION ALL SELECT reply FROM truthy
         UNION ALL SELECT n_reply FROM truthy UNION ALL SELECT p_reply FROM truthy)
SELECT md5(text) AS text_md5, length(text) AS n_chars, count(*) AS occurrences
FROM tx WHERE text IS NOT NULL GROUP BY text
"""

ORACLES["dataset_stats"] = TEXT_CTE + """
, c AS (SELECT query, (n_reply IS NOT NULL)::INTEGER + (p_reply IS NOT NULL)::INTEGER AS nn FROM s)
SELECT count(*) AS n_samples, count(DISTINCT query) AS n_queries, CAST(sum(1 + nn) AS BIGINT) AS n_pairs,
       CAST(count(*) AS BIGINT) AS n_positive, CAST(sum(nn) AS BIGINT) AS n_negative FROM c
"""

_content = (f"{_q('<Instruct>: ' + DEFAULT_INSTRUCTION + chr(10) + '<Query>: ')} || query || "
            f"{_q(chr(10) + '<Document>: ')} || passage")

ORACLES["prompt_messages"] = TEXT_CTE + f"""
SELECT conv_id, turn, side, pos, CAST(2 AS BIGINT) AS n_messages, md5({_q(RERANK_SYSTEM_PROMPT)}) AS system_md5,
       'user' AS user_role, md5({_content}) AS user_md5, length({_content}) AS user_chars
FROM tp
"""

ORACLES["text_vector_table"] = """
SELECT md5(text) AS text_md5, min(vec_id) AS vec_id, count(*) AS n_rows
FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id GROUP BY text
"""

ORACLES["missing_vector_report"] = """
WITH tv AS (SELECT DISTINCT text FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id)
SELECT doc_id, md5(text) AS text_md5, length(text) AS n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM tv WHERE tv.text = d.text)
"""

# ---- documents: samples from neighbouring documents, text -> vector by exact text --------

DOC_CTE = f"""
WITH d AS (SELECT doc_id, text FROM documents),
smp AS (SELECT q.doc_id, q.text AS query, p.text AS p1, n1.text AS n1, n2.text AS n2
        FROM d q JOIN d p ON p.doc_id = q.doc_id + 1
        LEFT JOIN d n1 ON n1.doc_id = q.doc_id + 2
        LEFT JOIN d n2 ON n2.doc_id = q.doc_id + 3),
dp AS (SELECT doc_id, query, 'positive' AS side, 0 AS pos, p1 AS passage FROM smp WHERE p1 IS NOT NULL
       UNION ALL SELECT doc_id, query, 'negative', 0, n1 FROM smp WHERE n1 IS NOT NULL
       UNION ALL SELECT doc_id, query, 'negative', CASE WHEN n1 IS NULL THEN 0 ELSE 1 END, n2
         FROM smp WHERE n2 IS NOT NULL),
tv AS (SELECT text, arg_min(CAST(embedding AS DOUBLE[]), vec_id) AS v
       FROM documents JOIN embeddings ON doc_id = vec_id GROUP BY text),
tvn AS (SELECT text, v, sqrt(list_dot_product(v, v)) AS n FROM tv),
sp AS (SELECT dp.*, {_fix('list_dot_product(a.v, b.v) / (greatest(a.n, 1e-8) * greatest(b.n, 1e-8))')} AS score
       FROM dp LEFT JOIN tvn a ON a.text = dp.query LEFT JOIN tvn b ON b.text = dp.passage),
tri AS (SELECT a.doc_id, a.pos AS pos_index, b.pos AS neg_index, b.passage AS negative,
               a.score AS label_pos, b.score AS label_neg
        FROM sp a JOIN sp b ON a.doc_id = b.doc_id WHERE a.side = 'positive' AND b.side = 'negative')
"""

ORACLES["document_soft_label_triplets"] = DOC_CTE + """
SELECT doc_id, pos_index, neg_index, md5(negative) AS negative_md5, label_pos, label_neg FROM tri
WHERE label_pos IS NOT NULL AND label_neg IS NOT NULL
"""

ORACLES["document_missing_triplets"] = DOC_CTE + """
SELECT doc_id, pos_index, neg_index, md5(negative) AS negative_md5 FROM tri
WHERE label_pos IS NULL OR label_neg IS NULL
"""

ORACLES["document_hard_negatives"] = DOC_CTE + f"""
, r AS (SELECT query, passage, score,
               row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id,
                                  CASE WHEN side = 'positive' THEN 0 ELSE 1 END, pos) AS rk
        FROM sp WHERE score IS NOT NULL AND NOT isnan(score))
SELECT md5(a.query) AS query_md5, md5(a.passage) AS positive_md5, md5(b.passage) AS negative_md5,
       a.rk AS pos_rank, b.rk AS neg_rank, {_fix('a.score - b.score')} AS score
FROM r a JOIN r b ON a.query = b.query AND b.rk > a.rk AND b.rk <= a.rk + 4
WHERE a.rk <= 8 AND a.passage <> b.passage AND a.score - b.score > 0
"""

_suffix = "[" + ", ".join(str(i) for i in suffix_token_ids(ASSISTANT_SUFFIX)) + "]"
def _template(instruction: str) -> str:
    """The chat template of a pair ``query, passage``."""
    head = (f"{TURN_START}system\n{RERANK_SYSTEM_PROMPT}{TURN_END}{TURN_START}user\n<Instruct>: {instruction}\n<Query>: ")
    return f"{_q(head)} || query || {_q(chr(10) + '<Document>: ')} || passage || {_q(TURN_END)}"


ORACLES["truncate_suffix"] = DOC_CTE + f"""
, whole AS (SELECT doc_id, side, pos, {_template(DEFAULT_INSTRUCTION)} AS prompt FROM dp),
ids AS (SELECT doc_id, side, pos, length(prompt) AS n_prompt,
               list_transform(string_split(left(prompt, {DEFAULT_MAX_TOKENS}), ''), lambda ch: unicode(ch)) AS ids FROM whole),
tr AS (SELECT doc_id, side, pos, n_prompt, list_concat(ids, {_suffix}) AS t FROM ids),
tn AS (SELECT *, len(t) AS n_ids, greatest(len(t) - {len(suffix_token_ids(ASSISTANT_SUFFIX)) + 3}, 1) AS seam FROM tr)
SELECT doc_id, side, pos, n_prompt, n_ids,
       md5(array_to_string(t, ',')) AS ids_md5,
       array_to_string(t[1:8], ',') AS head_ids,
       array_to_string(t[seam:seam + 7], ',') AS seam_ids,
       array_to_string(t[n_ids - 3:n_ids], ',') AS tail_ids
FROM tn
"""

# a log-probability below -9 isn't told and counts as -10
_lp = {"yes": "-(total % 1201) / CAST(100 AS DOUBLE)", "no": "-(total % 997) / CAST(80 AS DOUBLE)"}
_told = {k: f"CASE WHEN {v} >= -9.0 THEN {v} ELSE -10.0 END" for k, v in _lp.items()}


def teacher_logits_sql(instruction: str, max_length: int) -> str:
    return TEXT_CTE + f"""
, p AS (SELECT conv_id, turn, side, pos, list_concat(list_transform(string_split(left({_template(instruction)}, {max_length}), ''),
               lambda ch: unicode(ch)), {_suffix}) AS ids FROM tp),
t AS (SELECT conv_id, turn, side, pos, len(ids) AS n_ids, list_sum(ids)::BIGINT AS total FROM p)
SELECT conv_id, turn, side, pos, n_ids, {_fix(f"{_told['yes']} - {_told['no']}")} AS logit FROM t
"""


ORACLES["teacher_logits"] = teacher_logits_sql("Given a user turn, retrieve the reply that answers it", 400)

# n-grams of the text between two spaces, numbered by code points to base 31
EMBED_CTE = """
codes AS (SELECT text, list_transform(string_split(' ' || text || ' ', ''), lambda ch: unicode(ch)::BIGINT) AS c FROM told),
padded AS (SELECT text, CASE WHEN len(c) < 3 THEN list_append(c, 0) ELSE c END AS c FROM codes),
grams AS (SELECT text, unnest(list_transform(range(1, len(c) - 1), lambda i: (c[i] * 31 + c[i + 1]) * 31 + c[i + 2])) AS h FROM padded),
entries AS (SELECT text, h % 64 AS place, sum(1 - 2 * ((h // 64) % 2))::DOUBLE AS v FROM grams GROUP BY ALL),
norms AS (SELECT text, greatest(sqrt(sum(v * v)), 1e-8) AS n FROM entries GROUP BY text),
places AS (SELECT text, n, unnest(range(64)) AS place FROM norms),
vectors AS (SELECT places.text, string_agg(CAST(floor(CAST(CAST(coalesce(v, 0) / n AS FLOAT) AS DOUBLE) * 1000000 + 0.5) AS BIGINT), ','
                                           ORDER BY places.place) AS said
            FROM places LEFT JOIN entries ON entries.text = places.text AND entries.place = places.place GROUP BY places.text)
"""
_TRUTHY_TEXTS = """
, tx AS (SELECT query AS text FROM truthy UNION ALL SELECT reply FROM truthy
         UNION ALL SELECT n_reply FROM truthy UNION ALL SELECT p_reply FROM truthy),
told AS (SELECT DISTINCT text FROM tx WHERE text IS NOT NULL),
"""
ORACLES["embed_texts_pandas"] = TEXT_CTE + _TRUTHY_TEXTS + EMBED_CTE + """
SELECT md5(text) AS text_md5, CAST(64 AS BIGINT) AS dim, md5(said) AS vector_md5 FROM vectors
"""

ORACLES["hot_query_metrics"] = with_jv(f"""
, h AS (SELECT CASE WHEN qlabel <= 2 THEN -1 ELSE qid END AS query, rel, teacher AS score, qid, pid FROM pairs),
w AS (SELECT query, rel, row_number() OVER (PARTITION BY query ORDER BY score DESC, qid, pid) AS rn,
             sum(rel) OVER c AS cr, count(*) OVER c AS cn, avg(rel) OVER (PARTITION BY query, score) AS g,
             row_number() OVER (PARTITION BY query ORDER BY rel DESC) AS irn
      FROM h WINDOW c AS (PARTITION BY query ORDER BY score DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT query, count(*) AS n_cand, sum(rel)::BIGINT AS n_rel,
             sum(CASE WHEN rel = 1 THEN CAST(cr AS DOUBLE) / cn ELSE 0 END) / nullif(CAST(sum(rel) AS DOUBLE), 0) AS ap,
             coalesce(max(CASE WHEN rel = 1 AND rn <= 10 THEN CAST(1 AS DOUBLE) / rn END), 0) AS rr,
             sum(CASE WHEN rn <= 10 THEN g / (ln(rn + 1) / ln(2)) ELSE 0 END)
               / nullif(sum(CASE WHEN irn <= 10 THEN rel / (ln(irn + 1) / ln(2)) ELSE 0 END), 0) AS ndcg FROM w GROUP BY query)
SELECT query, n_cand, n_rel, {_fix('coalesce(ap, 0)', 6)} AS ap, {_fix('rr', 6)} AS rr, {_fix('coalesce(ndcg, 0)', 6)} AS ndcg FROM m
""")

# ---- file stages: the same rows without files --------------------------------------------

LINES_CTE = TEXT_CTE + """
, ln AS (SELECT CASE WHEN conv_id % 2 = 0 THEN 'a' ELSE 'b' END AS input, query, passage, length(passage) AS size, conv_id, turn,
                CASE WHEN side = 'positive' THEN 0 ELSE 1 END AS side_rank, pos FROM tp),
tagged AS (SELECT *, row_number() OVER (PARTITION BY input ORDER BY conv_id, turn, side_rank, pos) - 1 AS line,
                  CASE WHEN size % 11 = 3 THEN 'malformed' WHEN size % 13 = 5 THEN 'missing' WHEN size % 17 = 7 THEN 'nan' END AS reason,
                  (size % 97) / CAST(8 AS DOUBLE) AS score FROM ln),
good AS (SELECT * FROM tagged WHERE reason IS NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY input, query ORDER BY score DESC, line) AS rk,
             min(line) OVER (PARTITION BY input, query) AS seen FROM good),
hard AS (SELECT a.input || '__train_margin_sampled.jsonl' AS output, a.query, a.passage AS positive, b.passage AS negative,
                a.score - b.score AS score, a.seen, a.rk AS pos_rank, b.rk AS neg_rank
         FROM r a JOIN r b ON a.input = b.input AND a.query = b.query AND b.rk > a.rk AND b.rk <= a.rk + 4
         WHERE a.rk <= 8 AND a.passage <> b.passage AND a.score > b.score)
"""
_MD5S = "md5(query) AS query_md5, md5(positive) AS positive_md5, md5(negative) AS negative_md5"
ORACLES["file_margin_triplets"] = LINES_CTE + f"SELECT output, {_MD5S}, {_fix('score', 6)} AS score FROM hard"

ORACLES["file_triplet_order"] = LINES_CTE + f"""
SELECT output, row_number() OVER (PARTITION BY output ORDER BY seen, pos_rank, neg_rank) - 1 AS line, {_MD5S} FROM hard
"""

ORACLES["file_random_triplets"] = LINES_CTE + f"""
, pool AS (SELECT a.input || '__train_margin_sampled.jsonl' AS output, a.query, a.passage AS positive, b.passage AS negative,
                  a.score - b.score AS score,
                  row_number() OVER (PARTITION BY a.input, a.query, a.rk ORDER BY md5(concat_ws('|', '7',
                      CASE WHEN a.input = 'a' THEN '0' ELSE '1' END || chr(1) || a.query, a.rk::VARCHAR, b.line::VARCHAR)), b.line) AS d
           FROM r a JOIN r b ON a.input = b.input AND a.query = b.query AND b.rk > a.rk WHERE a.rk <= 8)
SELECT output, {_MD5S}, {_fix('score', 6)} AS score FROM pool WHERE d <= 4 AND positive <> negative AND score > 0
"""

ORACLES["file_triplet_counts"] = LINES_CTE + """
, read AS (SELECT input || '__train_margin_sampled.jsonl' AS output, count(*) AS n_lines, count(*) FILTER (reason = 'malformed') AS n_malformed,
                  count(*) FILTER (reason = 'missing') AS n_missing, count(*) FILTER (reason = 'nan') AS n_nan FROM tagged GROUP BY input),
inputs AS (SELECT unnest(['a__train_margin_sampled.jsonl', 'b__train_margin_sampled.jsonl']) AS output),
out AS (SELECT output, count(*) AS n_triplets FROM hard GROUP BY output),
each AS (SELECT output, coalesce(n_triplets, 0) AS n_triplets, coalesce(n_lines, 0) AS n_lines, coalesce(n_malformed, 0) AS n_malformed,
                coalesce(n_missing, 0) AS n_missing, coalesce(n_nan, 0) AS n_nan
         FROM inputs LEFT JOIN read USING (output) LEFT JOIN out USING (output))
FROM each UNION ALL SELECT NULL, sum(n_triplets)::BIGINT, sum(n_lines)::BIGINT, sum(n_malformed)::BIGINT, sum(n_missing)::BIGINT,
                           sum(n_nan)::BIGINT FROM each
"""

ORACLES["file_soft_label_counts"] = TEXT_CTE + """
, t AS (SELECT *, CASE WHEN conv_id % 2 = 0 THEN 'a' ELSE 'b' END || '__test_soft_labels.jsonl' AS output,
               (n_reply IS NOT NULL)::INTEGER + (p_reply IS NOT NULL)::INTEGER AS n FROM truthy),
x AS (SELECT output, query AS text FROM t UNION SELECT output, reply FROM t UNION SELECT output, n_reply FROM t
      UNION SELECT output, p_reply FROM t),
each AS (SELECT output, coalesce(sum(n), 0)::BIGINT AS n_triplets,
                (SELECT count(*) FROM x WHERE x.output = i.output AND text IS NOT NULL) AS n_texts
         FROM (SELECT unnest(['a__test_soft_labels.jsonl', 'b__test_soft_labels.jsonl']) AS output) i LEFT JOIN t USING (output) GROUP BY output)
SELECT output, n_triplets, n_texts, 0::BIGINT AS n_missing FROM each
UNION ALL SELECT NULL, sum(n_triplets)::BIGINT, sum(n_texts)::BIGINT, 0 FROM each
"""

ORACLES["file_sample_lines"] = TEXT_CTE + """
SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS line, md5(query) AS query_md5, CAST(1 AS BIGINT) AS n_positive,
       CAST((n_reply IS NOT NULL)::INTEGER + (p_reply IS NOT NULL)::INTEGER AS BIGINT) AS n_negative FROM s
"""

ORACLES["training_shards"] = with_jv(HARD_CTE + """
, n AS (SELECT qid, (row_number() OVER (ORDER BY qid, pos_rank, neg_rank) - 1) // 512 AS shard FROM ht)
SELECT shard, count(*) AS n_rows, min(qid) AS first_qid, max(qid) AS last_qid FROM n GROUP BY shard
""")

ORACLES["output_names"] = r"""
SELECT page_id, CASE WHEN regexp_matches(url, '[^/]\.[^./]*$') THEN regexp_replace(url, '([^/])(\.[^./]*)$', '\1_scored\2')
                     ELSE url || '_scored' END AS output,
       string_split(url, '_')[-1] AS metric FROM pages
"""

ORACLES["embedded_once"] = TEXT_CTE + """
, tx AS (SELECT query AS text FROM s UNION ALL SELECT reply FROM s UNION ALL SELECT n_reply FROM s UNION ALL SELECT p_reply FROM s),
told AS (SELECT DISTINCT text FROM tx WHERE text IS NOT NULL),
""" + EMBED_CTE + "SELECT sha256(text) AS digest, md5(said) AS vector_md5 FROM vectors"

ORACLES["score_distribution"] = with_jv(f"""
, e AS (SELECT qid, pid, exp(teacher / 0.5 - max(teacher / 0.5) OVER (PARTITION BY qid)) AS x FROM pairs)
SELECT qid, count(*) OVER (PARTITION BY qid) AS n, row_number() OVER (PARTITION BY qid ORDER BY pid) - 1 AS place,
       {_fix('x / sum(x) OVER (PARTITION BY qid)', 6)} AS p FROM e
""")
