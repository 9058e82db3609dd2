"""DuckDB SQL twins of the registered queries (same column names).

Patterns and parameters come from the same modules the Spark side uses, so
the two can only differ in engine semantics. Doubles are rounded to 6
decimals on both sides in the output; ranking uses the raw score.
"""

from __future__ import annotations

from curatio.functions import text as TX
from curatio.plans import scenario as S

TRUE_CLASS_WS = TX.WS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(expr: str) -> str:
    x = f"lower({expr})"
    for pat, rep in ((TX.URL_RE, ""), (TX.TAG_RE, ""), (TX.NON_WORD_RE, ""),
                     (TX.DIGITS_RE, ""), (TX.WS_RUN_RE, " ")):
        x = f"regexp_replace({x}, {_q(pat)}, {_q(rep)}, 'g')"
    return f"trim({x})"


def ustrip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, {_q(TX.STRIP_RE)}, '', 'g')"


def _lex_values(mapping) -> str:
    rows = []
    for d_ord, (dept, kws) in enumerate(mapping.items()):
        for k_ord, kw in enumerate(kws):
            rows.append(f"({_q(dept)}, {d_ord}, {k_ord}, {_q(kw)})")
    return ", ".join(rows)


def _cat_values(mapping) -> str:
    return ", ".join(f"({_q(d)}, {i})" for i, d in enumerate(mapping))


def _markers(col: str) -> str:
    return " OR ".join(f"contains({col}, {_q(m)})" for m in S.TEST_MARKERS)


CONV_QA = """
  SELECT u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'"""

DOC_QA = """
  SELECT doc_id,
    CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS question,
    CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS answer
  FROM documents"""


def base_ctes(mapping=None, vectors: bool = True, sim_w: float = 0.7, kw_w: float = 0.3,
              qa_sql: str = CONV_QA, keys=("conv_id", "turn"), vec_key: str = "conv_id") -> str:
    """CTE chain: qa, texts, lex, cats, hits, rel, kw, [qv, ex, cp,] sim,
    blend, ranked, adj, top, labels, classified."""
    mapping = mapping or S.TEST_LEXICON
    K = ", ".join(keys)
    tk = ", ".join(f"t.{k}" for k in keys)
    hk = ", ".join(f"h.{k}" for k in keys)
    rk = " AND ".join(f"r.{k} = t.{k}" for k in keys)
    rules = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in S.TEST_EXCLUSIONS)
    parts = [f"""
qa AS ({qa_sql}),
texts AS (
  SELECT {K},
    {clean_sql("coalesce(question,'') || ' ' || coalesce(question,'') || ' ' || substr(coalesce(answer,''), 1, 200)")} AS ctext
  FROM qa),
lex AS (
  SELECT dept, dept_ord, kw_ord, keyword,
    1.0::DOUBLE * (CASE WHEN length(keyword) > 2 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END)
      * (CASE WHEN {_markers('keyword')} THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END) AS weight
  FROM (VALUES {_lex_values(mapping)}) v(dept, dept_ord, kw_ord, keyword)),
cats AS (SELECT * FROM (VALUES {_cat_values(mapping)}) v(dept, dept_ord)),
rules AS (SELECT * FROM (VALUES {rules}) v(x_winner, x_excluded)),
hits0 AS (
  SELECT {tk}, l.dept, l.dept_ord, l.kw_ord, l.keyword, l.weight, t.ctext,
    (length(t.ctext) - length(replace(t.ctext, l.keyword, ''))) // length(l.keyword) AS cnt,
    instr(t.ctext, l.keyword) - 1 AS pos,
    CASE WHEN instr(t.ctext, '?') > 0 THEN instr(t.ctext, '?') - 1
         ELSE length(t.ctext) // 2 END AS qend
  FROM texts t JOIN lex l ON contains(t.ctext, l.keyword)),
hits AS (
  SELECT *, pos < qend AS early,
    substr(ctext, greatest(pos - 10, 0) + 1,
           least(length(ctext), pos + length(keyword) + 10) - greatest(pos - 10, 0)) AS context,
    cnt * weight * (CASE WHEN pos < qend THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END) AS base0
  FROM hits0),
rel AS (
  SELECT {hk}, h.dept, h.dept_ord, h.kw_ord, h.keyword,
    any_value(h.base0) AS base0, count(r.keyword) AS n_related
  FROM hits h LEFT JOIN lex r
    ON r.dept = h.dept AND r.keyword <> h.keyword AND contains(h.context, r.keyword)
  GROUP BY {hk}, h.dept, h.dept_ord, h.kw_ord, h.keyword),
rel2 AS (SELECT *, base0 * power(1.2::DOUBLE, n_related) AS base FROM rel),
kw AS (
  SELECT {tk}, c.dept, c.dept_ord,
    coalesce((SELECT sum(r.base ORDER BY r.kw_ord) FROM rel2 r
              WHERE {rk} AND r.dept = c.dept), 0.0::DOUBLE) AS kw_score
  FROM texts t CROSS JOIN cats c)"""]
    if vectors:
        qk = ", ".join(f"q.{k}" for k in keys)
        vk = ", ".join(f"v.{k}" for k in keys)
        parts.append(f"""
qv AS (
  SELECT {qk}, e.embedding FROM qa q
  LEFT JOIN embeddings e ON e.vec_id = q.{vec_key} % (SELECT count(*) FROM embeddings)),
ex AS (SELECT label, arg_min(embedding, vec_id) AS proto FROM embeddings GROUP BY label),
cp AS (SELECT c.dept, c.dept_ord, ex.proto FROM cats c LEFT JOIN ex ON ex.label = c.dept_ord),
sim AS (
  SELECT {vk}, cp.dept,
    coalesce(list_cosine_similarity(v.embedding::DOUBLE[], cp.proto::DOUBLE[]), 0.0::DOUBLE) AS similarity
  FROM qv v CROSS JOIN cp)""")
    else:
        parts.append(f"""
sim AS (SELECT {tk}, c.dept, 0.0::DOUBLE AS similarity FROM texts t CROSS JOIN cats c)""")
    kk = ", ".join(f"k.{k}" for k in keys)
    parts.append(f"""
blend AS (
  SELECT {kk}, k.dept, k.dept_ord, s.similarity, k.kw_score,
    {sim_w}::DOUBLE * s.similarity + {kw_w}::DOUBLE * k.kw_score AS score
  FROM kw k JOIN sim s USING ({K}, dept)),
ranked AS (
  SELECT *, first_value(dept) OVER (PARTITION BY {K}
            ORDER BY score DESC, dept_ord) AS winner
  FROM blend),
adj AS (
  SELECT r.*, x.x_winner IS NOT NULL AS excluded,
    CASE WHEN x.x_winner IS NOT NULL THEN score * 0.5::DOUBLE ELSE score END AS adj_score
  FROM ranked r LEFT JOIN rules x ON x.x_winner = r.winner AND x.x_excluded = r.dept),
top AS (
  SELECT {K}, dept, adj_score AS best,
    row_number() OVER (PARTITION BY {K} ORDER BY adj_score DESC, dept_ord) AS rn
  FROM adj),
labels AS (
  SELECT {K}, CASE WHEN best > 0 THEN dept ELSE {_q(S.TEST_FALLBACK)} END AS label,
    round(best, 6) AS best_score
  FROM top WHERE rn = 1),
classified AS (
  SELECT q.*, l.label, l.best_score
  FROM qa q JOIN labels l USING ({K}))""")
    return "WITH " + ",".join(parts)


def _reject_sql(col: str) -> str:
    return "(" + " OR ".join(f"contains({col}, {_q(t)})" for t in S.TEST_REJECT_TERMS) + ")"


def _valid_sql(q: str, a: str) -> str:
    return (f"coalesce(length({ustrip_sql(q)}) >= 1 AND length({ustrip_sql(a)}) >= 10 "
            f"AND NOT {_reject_sql(a)}, false)")


def _final_ctes() -> str:
    return base_ctes() + f""",
valid AS (SELECT * FROM classified WHERE {_valid_sql('question', 'answer')}),
capped AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY label
        ORDER BY md5('{S.TEST_SEED}|' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)),
                 CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)) AS rn
    FROM valid) WHERE rn <= {S.TEST_CAP}),
grank AS (
  SELECT label, row_number() OVER (ORDER BY min(struct_pack(conv_id := conv_id, turn := turn))) - 1 AS group_rank
  FROM capped GROUP BY label),
final AS (
  SELECT c.*, g.group_rank,
    c.label || '_' || CAST(row_number() OVER (ORDER BY g.group_rank, c.conv_id, c.turn) - 1 AS VARCHAR) AS id
  FROM capped c JOIN grank g USING (label))"""


def _dist(src: str, col: str) -> str:
    return f"""
SELECT {col}, count, round(count * 100.0 / sum(count) OVER (), 6) AS percentage,
  row_number() OVER (ORDER BY count DESC, {col}) AS rank,
  row_number() OVER (ORDER BY count DESC, {col}) <= 5 AS is_top
FROM (SELECT {col}, count(*) AS count FROM {src} GROUP BY {col})"""


def oracle() -> dict[str, str]:
    q = {}
    q["page_links"] = f"""
WITH a AS (
  SELECT page_id, url,
    regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)"', 1) AS hrefs
  FROM pages),
e AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(range(0, len(hrefs))) AS pos FROM a),
l AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, href,
        regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || href AS link FROM e)
SELECT * FROM l WHERE contains(link, {_q(S.PAGE_LINK_SUBSTRING)})"""
    q["page_anchors"] = q["page_links"].replace(
        f"SELECT * FROM l WHERE contains(link, {_q(S.PAGE_LINK_SUBSTRING)})", "SELECT * FROM l")
    def node_text(pattern: str) -> str:
        inner = f"regexp_extract(html, {_q(pattern)}, 1)"
        stripped = f"trim(regexp_replace({inner}, '\\s*<[^>]+>\\s*', '', 'g'))"
        return f"regexp_replace(replace({stripped}, '&quot;', '\"'), '&amp;?', '&', 'g')"
    q["page_qa"] = f"""
WITH r AS (
  SELECT page_id, {node_text('(?s)<article>.*?<h1>(.*?)</h1>')} AS question,
    {node_text('(?s)<article>(.*?)</article>')} AS answer, url
  FROM pages)
SELECT page_id, question, answer, url FROM r
WHERE length(question) >= 2 AND length(answer) >= 11"""
    q["latest_capture"] = """
WITH c AS (
  SELECT user_id AS url, event_id,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS try_no
  FROM events),
b AS (SELECT url, min(try_no) AS try_no FROM c WHERE try_no <= 3 AND status = 200 GROUP BY url)
SELECT c.url, c.event_id, CAST(c.try_no - 1 AS BIGINT) AS attempt FROM c JOIN b USING (url, try_no)"""
    q["bad_rows_split"] = """
WITH l AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN props || [' trailing', ']', '] junk', ']]', '],[1'][event_id % 5 + 1] WHEN 'error' THEN '[' || props || ']'
    WHEN 'purchase' THEN substr(props, 1, length(props) - 1)
    WHEN 'signup' THEN replace(props, '"k"', '"j"') ELSE props END AS line
  FROM events),
b AS (SELECT event_id, line, coalesce(CASE WHEN json_valid(line) THEN json_type(line) <> 'OBJECT'
        OR NOT list_contains(json_keys(line), 'k') ELSE true END, true) AS bad FROM l)
SELECT event_id, CASE WHEN bad THEN NULL ELSE TRY_CAST(json_extract(line, '$.k') AS BIGINT) END AS k, bad AS is_bad
FROM b"""
    q["unseen_questions"] = """
WITH m AS (SELECT max(doc_id) // 2 AS half FROM documents)
SELECT doc_id, lang FROM documents l, m WHERE doc_id > half AND NOT EXISTS (
  SELECT 1 FROM documents e WHERE e.doc_id <= half AND e.text IS NOT DISTINCT FROM l.text)"""
    q["unseen_by_index"] = q["unseen_questions"]
    q["quarantine"] = """
SELECT u.conv_id, u.turn, u.text IS NULL OR a.text IS NULL AS is_bad
FROM conversations u LEFT JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
WHERE u.role = 'user'"""
    q["decoded_pages"] = "SELECT page_id, html FROM pages"
    q["dedup_first_seen"] = """
SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1"""
    q["clean_text"] = f"""
SELECT page_id, {clean_sql("concat_ws(' ', url, html)")} AS cleaned,
  CAST(length({ustrip_sql('html')}) AS BIGINT) AS stripped_len
FROM pages"""
    comp = "coalesce(question,'') || ' ' || coalesce(question,'') || ' ' || substr(coalesce(answer,''), 1, 200)"
    q["composite_text"] = base_ctes(vectors=False) + f"""
SELECT conv_id, turn, {comp} AS composite, {clean_sql(comp)} AS ctext FROM qa"""
    q["keyword_hits"] = base_ctes(vectors=False) + """
SELECT conv_id, turn, dept, keyword, CAST(cnt AS BIGINT) AS cnt, CAST(pos AS BIGINT) AS pos,
  early, round(base0, 6) AS base0 FROM hits"""
    q["keyword_context"] = base_ctes(vectors=False) + """
SELECT conv_id, turn, dept, keyword, CAST(n_related AS BIGINT) AS n_related,
  round(base, 6) AS base FROM rel2"""
    q["keyword_scores"] = base_ctes(vectors=False) + """
SELECT conv_id, turn, dept, round(kw_score, 6) AS kw_score FROM kw"""
    q["keyword_sweep"] = base_ctes(vectors=False) + """
SELECT h.conv_id, h.turn, h.dept, h.keyword, CAST(h.cnt AS BIGINT) AS cnt, CAST(h.pos AS BIGINT) AS pos, h.early,
  CAST(r.n_related AS BIGINT) AS n_related, round(r.base, 6) AS base
FROM hits h JOIN rel2 r USING (conv_id, turn, dept, keyword)"""
    q["keyword_sweep_scores"] = q["keyword_scores"]
    q["cosine_pairs"] = """
SELECT a.vec_id AS a_id, b.vec_id AS b_id,
  round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""
    q["prototype_scores"] = """
WITH ex AS (SELECT label, arg_min(embedding, vec_id) AS proto FROM embeddings GROUP BY label)
SELECT e.vec_id, ex.label AS proto_label,
  round(list_cosine_similarity(e.embedding::DOUBLE[], ex.proto::DOUBLE[]), 6) AS similarity
FROM embeddings e CROSS JOIN ex"""
    letters = "aeio"
    vec = lambda c: "[" + ", ".join(
        f"(length({c}) - length(replace({c}, '{x}', '')))::DOUBLE" for x in letters) + "]"
    dot = lambda a, b: " + ".join(f"{a}[{k + 1}] * {b}[{k + 1}]" for k in range(len(letters)))
    q["keyword_prototype_scores"] = base_ctes(vectors=False) + f""",
p AS (SELECT c.dept, coalesce(string_agg(l.keyword, ' ' ORDER BY l.kw_ord), '') AS t
      FROM cats c LEFT JOIN lex l USING (dept) GROUP BY c.dept),
v AS (SELECT qa.conv_id, qa.turn, p.dept, {vec("coalesce(qa.question, '')")} AS x, {vec("p.t")} AS y FROM qa CROSS JOIN p)
SELECT conv_id, turn, dept, round(({dot("x", "y")}) / (greatest(sqrt({dot("x", "x")}), 1e-8)
  * greatest(sqrt({dot("y", "y")}), 1e-8)), 6) AS similarity FROM v"""
    q["blend_scores"] = base_ctes() + """
SELECT conv_id, turn, dept, round(similarity, 6) AS similarity, round(kw_score, 6) AS kw_score,
  round(adj_score, 6) AS score, excluded FROM adj"""
    q["classify"] = base_ctes() + "\nSELECT conv_id, turn, label, best_score FROM labels"
    q["classify_similarity"] = base_ctes(kw_w=0.0) + "\nSELECT conv_id, turn, label, best_score FROM labels"
    q["classify_sparse"] = (base_ctes(S.SPARSE_LEXICON, vectors=False)
                            + "\nSELECT conv_id, turn, label, best_score FROM labels")
    q["quality_filter"] = base_ctes(vectors=False) + f"""
SELECT conv_id, turn, CAST(length({ustrip_sql('question')}) AS BIGINT) AS q_len,
  CAST(length({ustrip_sql('answer')}) AS BIGINT) AS a_len,
  coalesce({_reject_sql('answer')}, false) AS rejected,
  {_valid_sql('question', 'answer')} AS valid
FROM qa"""
    q["cap_per_group"] = f"""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang
      ORDER BY md5('{S.TEST_SEED}|' || CAST(doc_id AS VARCHAR)), doc_id) AS rn
  FROM documents) WHERE rn <= {S.TEST_CAP}"""
    q["running_ids"] = _final_ctes() + "\nSELECT conv_id, turn, label, id FROM final"
    q["conversations_out"] = _final_ctes() + """
SELECT id, to_json([{'from': 'user', 'value': question}, {'from': 'assistant', 'value': answer}])::VARCHAR
  AS conversations FROM final"""
    prompts = " ".join(f"WHEN {_q(g)} THEN {_q(p)}" for g, p in S.TEST_PROMPTS)
    q["prompted_conversations"] = _final_ctes() + f"""
SELECT id, to_json(CASE WHEN label IN ({", ".join(_q(g) for g, _ in S.TEST_PROMPTS)})
    THEN [{{'from': 'system', 'value': CASE label {prompts} END}}] ELSE [] END
  || [{{'from': 'user', 'value': question}}, {{'from': 'assistant', 'value': answer}}])::VARCHAR AS conversations
FROM final"""
    q["conversion_stats"] = base_ctes() + f""",
per AS (
  SELECT label, count(*) AS original,
    count(*) FILTER (WHERE {_valid_sql('question', 'answer')}) AS filtered
  FROM classified GROUP BY label)
SELECT label, false AS is_total, original, filtered, least(filtered, {S.TEST_CAP}) AS final FROM per
UNION ALL
SELECT NULL, true, coalesce(sum(original), 0)::BIGINT, coalesce(sum(filtered), 0)::BIGINT,
  coalesce(sum(least(filtered, {S.TEST_CAP})), 0)::BIGINT FROM per"""
    q["distribution"] = base_ctes() + _dist("classified", "label")
    q["lang_distribution"] = _dist("documents", "lang")
    # documents are read whole: the answer without its prefix
    q["classify_documents"] = (base_ctes(qa_sql=DOC_QA, keys=("doc_id",), vec_key="doc_id")
                               .replace("substr(coalesce(answer,''), 1, 200)", "coalesce(answer,'')")
                               + "\nSELECT doc_id, label, best_score FROM labels")
    q["classification_stats"] = base_ctes() + """
SELECT label || ': ' || CAST(count(*) AS VARCHAR) || '条' AS value FROM classified GROUP BY label"""
    q["group_rows"] = base_ctes() + """,
g AS (SELECT label, row_number() OVER (ORDER BY min(struct_pack(conv_id := conv_id, turn := turn))) - 1 AS group_rank
      FROM classified GROUP BY label)
SELECT c.label, CAST(g.group_rank AS BIGINT) AS group_rank, c.conv_id, c.turn
FROM classified c JOIN g USING (label)"""
    return q
