"""DuckDB SQL oracles, one per query binding (same output column names).

Text classes mirror ``textloom.functions.text`` (RE2 and Java agree on them).
Binding parameters are imported from ``bindings`` so both sides use one list.
"""

from __future__ import annotations

from textloom import defaults as D
from textloom.operators import projection as P
from textloom.plans import bindings as B

WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"\p{L}\p{N}_"
TOKEN = rf"[{WORD}]{{2,}}"


def _sq(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def squeeze_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def clean_sql(x: str) -> str:
    inner = f"regexp_replace(coalesce({x}, ''), '[^{WORD}{WS}-]', ' ', 'g')"
    return f"lower(trim(regexp_replace({inner}, '[{WS}]+', ' ', 'g')))"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def _grams(t: str) -> str:
    """SQL list of 1..3-word n-grams of the token list expression ``t``."""
    bi = f"list_transform(range(0, len({t}) - 1), lambda i: {t}[i + 1] || ' ' || {t}[i + 2])"
    tri = (f"list_transform(range(0, len({t}) - 2), lambda i: {t}[i + 1] || ' ' || {t}[i + 2]"
           f" || ' ' || {t}[i + 3])")
    return f"list_concat({t}, {bi}, {tri})"


def _tfidf_ctes() -> str:
    """CTEs doc_tf, idf, doc_w (L2-normalised document weights)."""
    return f"""
doc_tok AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN}') AS t FROM documents),
doc_tf AS (SELECT doc_id, term, count(*) AS tf
           FROM (SELECT doc_id, unnest({_grams('t')}) AS term FROM doc_tok) GROUP BY ALL),
idf AS (SELECT term, count(*) AS df,
               ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
        FROM doc_tf GROUP BY term),
doc_w AS (SELECT doc_id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS w
          FROM doc_tf JOIN idf USING (term))"""


def _query_w(src: str) -> str:
    """CTEs q_tf, q_w for a query source with columns conv_id, turn, text."""
    return f"""
q_src AS ({src}),
q_tok AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '{TOKEN}') AS t FROM q_src),
q_tf AS (SELECT conv_id, turn, term, count(*) AS tf
         FROM (SELECT conv_id, turn, unnest({_grams('t')}) AS term FROM q_tok) GROUP BY ALL),
q_w AS (SELECT conv_id, turn, term,
               tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY conv_id, turn)) AS w
        FROM q_tf JOIN idf USING (term))"""


USER_TURNS = "SELECT conv_id, turn, text FROM conversations WHERE role = 'user'"

TFIDF_TOPK = f"""
WITH {_tfidf_ctes()},
{_query_w(USER_TURNS)},
scores AS (SELECT conv_id, turn, doc_id, sum(q_w.w * doc_w.w) AS score
           FROM q_w JOIN doc_w USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn
                                        ORDER BY round(score, 9) DESC, doc_id) AS rank
           FROM scores)
SELECT conv_id, turn, CAST(rank AS BIGINT) AS rank, doc_id, round(score, 6) AS score
FROM ranked WHERE rank <= 3
"""

TFIDF_TRANSFORM = (f"WITH {_tfidf_ctes()}, {_query_w(USER_TURNS)} "
                   f"SELECT conv_id, turn, term, round(w, 6) AS weight FROM q_w")


# --- expansion --------------------------------------------------------------

def _augment(templates, phrases) -> str:
    desc = f"regexp_replace({squeeze_sql('description')}, '<.*?>', '', 'g')"
    src = (f"(SELECT p_partkey, p_type AS command, rtrim(lower({desc}), '.') AS slot "
           f"FROM (SELECT p_partkey, p_type, concat_ws(' ', p_name, p_brand) AS description FROM part))")
    parts = []
    for i, t in enumerate(templates):
        head, tail = t.split("{}")
        parts.append(f"SELECT p_partkey, {i} AS pos, {_sq(head)} || slot || {_sq(tail)} AS query "
                     f"FROM {src}")
    rows = []
    for aliases, plist in phrases:
        for j, ph in enumerate(plist):
            for a in aliases:
                rows.append(f"({_sq(a)}, {len(templates) + j}, {_sq(ph)})")
    parts.append(f"SELECT p_partkey, ph.pos, ph.phrase FROM {src} JOIN (VALUES {', '.join(rows)}) "
                 f"ph(alias, pos, phrase) ON lower(command) = ph.alias")
    return f"SELECT p_partkey, CAST(pos AS BIGINT) AS pos, query FROM ({' UNION ALL '.join(parts)})"


_SLOT = "rtrim(lower(text), '.')"
PAIR_RULES = f"""
WITH c AS (
  SELECT doc_id, 0 AS idx, 'How do I ' || {_SLOT} || '?' AS query, source AS command FROM documents
  UNION ALL SELECT doc_id, 1, 'Show me ' || {_SLOT}, source FROM documents
            WHERE contains(lower(text), 'the')
  UNION ALL SELECT doc_id, 2, 'I want to see ' || {_SLOT}, source FROM documents
            WHERE contains(lower(text), 'ing')
  UNION ALL SELECT doc_id, 3, 'List all files in the current directory', 'dir' FROM documents
            WHERE lower(lang) = 'en')
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS BIGINT) AS pos,
       query, command FROM c"""

PROMPT_FANOUT = (
    "SELECT conv_id, turn, CAST(p.v AS BIGINT) AS variant, p.prefix || text AS input_text "
    "FROM conversations, (VALUES "
    + ", ".join(f"({i}, {_sq(x)})" for i, x in enumerate(D.PROMPT_PREFIXES))
    + ") p(v, prefix) WHERE role = 'user'")

LM_RECORDS = """
SELECT u.conv_id, u.turn,
       'Query: ' || u.text || chr(10) || 'Command: ' || a.text || chr(10) || 'Explanation: '
       || d.text || chr(10) || chr(10) AS text
FROM conversations u
JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
JOIN documents d ON d.doc_id = u.conv_id
WHERE u.role = 'user'"""

COMBINED_TEXT = (
    "SELECT c.conv_id, c.turn, "
    + clean_sql("concat_ws(' ', " + ", ".join([
        clean_sql("c.text"), clean_sql("d.lang"), clean_sql("d.text"), clean_sql("d.source"),
        "array_to_string(list_transform(string_split(c.text, chr(10)), lambda x: "
        + clean_sql("x") + "), ' ')"]) + ")")
    + " AS combined_text FROM conversations c "
    "LEFT JOIN documents d ON c.conv_id = d.doc_id")


# --- keyed, scored ------------------------------------------------------------

_kw_case = " ".join(f"WHEN contains(lower(text), {_sq(k)}) THEN {_sq(c)}"
                    for k, c in B.DOC_KEYWORDS)
_kw_any = " OR ".join(f"contains(lower(text), {_sq(k)})" for k, _ in B.DOC_KEYWORDS)
FALLBACK_CMD = f"CASE {_kw_case} ELSE {_sq(D.FALLBACK_NONE)} END"
FALLBACK_SCORE = f"CASE WHEN {_kw_any} THEN 0.5 ELSE 0.0 END"

LINE_SCORES = ("SELECT l_orderkey, l_linenumber AS label, max(l_extendedprice) AS score, "
               "max(l_quantity) AS q FROM lineitem GROUP BY l_orderkey, l_linenumber")
RANKED_LINES = (f"SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, label) "
                f"AS rn FROM ({LINE_SCORES})")

LABEL_DICT = """SELECT source AS label,
       CAST(row_number() OVER (ORDER BY min(doc_id), source) - 1 AS BIGINT) AS label_id
FROM documents GROUP BY source"""


def _nn() -> str:
    """CTEs: 1-nearest other vector, predictions, confusion, per-label metrics."""
    return """
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id AS q, b.vec_id AS i, list_inner_product(a.v, b.v) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
nn AS (SELECT q, i FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, i) rn
                         FROM s) WHERE rn = 1),
p AS (SELECT ea.label AS y_true, eb.label AS y_pred FROM nn JOIN e ea ON ea.vec_id = nn.q
      JOIN e eb ON eb.vec_id = nn.i),
conf AS (SELECT y_true, y_pred, count(*) AS n FROM p GROUP BY ALL),
lab AS (SELECT label, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted FROM (
          SELECT y_true AS label, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp, n AS support,
                 0 AS predicted FROM conf
          UNION ALL SELECT y_pred, 0, 0, n FROM conf) GROUP BY label),
pl AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM lab),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0.0 END AS f1 FROM pl)"""


CLASS_REPORT = f"""WITH {_nn()}
SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                 CAST(sum(support) AS BIGINT) FROM pf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                 CAST(sum(support) AS BIGINT) FROM pf"""

WEIGHTED = f"""WITH {_nn()}
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(precision * support) / sum(support), 6) AS precision,
       round(sum(recall * support) / sum(support), 6) AS recall,
       round(sum(f1 * support) / sum(support), 6) AS f1 FROM pf"""


# --- splits -------------------------------------------------------------------

def _h(key: str) -> str:
    return f"md5(concat_ws('|', '{D.SPLIT_SEED}', CAST({key} AS VARCHAR)))"


_F = f"CAST({D.TEST_FRACTION} AS DOUBLE)"

SPLIT_EXACT = f"""
SELECT doc_id, CASE WHEN rk < ceil({_F} * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY {_h('doc_id')}, doc_id) - 1 AS rk,
             count(*) OVER () AS n FROM documents)"""

SPLIT_STRATIFIED = f"""
WITH c AS (SELECT lang, count(*) AS nl FROM documents GROUP BY lang),
t AS (SELECT sum(nl) AS n, CAST(ceil({_F} * sum(nl)) AS BIGINT) AS nt FROM c),
b AS (SELECT lang, nl, (nl * (n - nt)) // n AS base, (nl * (n - nt)) % n AS rem, n - nt AS ntrain
      FROM c, t),
q AS (SELECT lang, nl - base - CASE WHEN row_number() OVER (ORDER BY rem DESC, lang)
                                       <= (SELECT max(ntrain) - sum(base) FROM b) THEN 1 ELSE 0 END AS ntest
      FROM b),
r AS (SELECT doc_id, lang,
             row_number() OVER (PARTITION BY lang ORDER BY {_h('doc_id')}, doc_id) - 1 AS rk
      FROM documents)
SELECT doc_id, lang, CASE WHEN rk < ntest THEN 'test' ELSE 'train' END AS split FROM r JOIN q USING (lang)"""

SPLIT_STRATIFIED_GROUPED = f"""
WITH c AS (SELECT l_returnflag, count(*) AS nl FROM lineitem GROUP BY l_returnflag),
t AS (SELECT sum(nl) AS n, CAST(ceil({_F} * sum(nl)) AS BIGINT) AS nt FROM c),
b AS (SELECT l_returnflag, nl, (nl * (n - nt)) // n AS base, (nl * (n - nt)) % n AS rem, n - nt AS ntrain FROM c, t)
SELECT l_returnflag, nl AS n_label, CAST(nl - base - CASE WHEN row_number() OVER (ORDER BY rem DESC, l_returnflag)
           <= (SELECT max(ntrain) - sum(base) FROM b) THEN 1 ELSE 0 END AS BIGINT) AS n_test,
       CAST(0 AS BIGINT) AS n_split_groups, true AS within FROM b"""

SPLIT_GROUPED = f"""
WITH u AS (SELECT conv_id, row_number() OVER (ORDER BY {_h('conv_id')}, conv_id) - 1 AS rk,
                  count(*) OVER () AS n FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT conv_id, turn, CASE WHEN rk < ceil({_F} * n) THEN 'test' ELSE 'train' END AS split
FROM conversations JOIN u USING (conv_id)"""

_H2 = f"md5(concat_ws('|', '{D.SPLIT_SEED}', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)))"
SPLIT_TENTH = f"""
SELECT conv_id, turn, CASE WHEN rk < ceil(CAST(0.1 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY {_H2}, conv_id, turn) - 1 AS rk,
             count(*) OVER () AS n FROM conversations WHERE role = 'user')"""


# --- encoding -----------------------------------------------------------------

def _encode(text: str, max_len: int) -> str:
    return f"""
WITH tok AS (SELECT doc_id, regexp_extract_all(lower({text}), '{TOKEN}') AS t FROM documents),
vocab AS (SELECT term, 1 + row_number() OVER (ORDER BY df DESC, term) AS token_id
          FROM (SELECT term, count(DISTINCT doc_id) AS df
                FROM (SELECT doc_id, unnest(t) AS term FROM tok) GROUP BY term)),
pos AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS term FROM tok),
grid AS (SELECT doc_id, CAST(r.range AS BIGINT) AS pos FROM documents, range(0, {max_len}) r),
enc AS (SELECT g.doc_id, g.pos,
               CAST(CASE WHEN p.term IS NULL THEN 0 ELSE coalesce(v.token_id, 1) END AS INTEGER) AS token_id,
               CAST(CASE WHEN p.term IS NULL THEN 0 ELSE 1 END AS INTEGER) AS attention_mask
        FROM grid g LEFT JOIN pos p ON p.doc_id = g.doc_id AND p.pos = g.pos
        LEFT JOIN vocab v ON v.term = p.term)"""


# --- pages --------------------------------------------------------------------

# fixed values: the named entities that occur in the pages, decoded; '&amp;' last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _decode(x: str) -> str:
    for ent, ch in ENTITIES:
        x = f"replace({x}, {_sq(ent)}, {_sq(ch)})"
    return x


_H1 = "regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')"
PAGE_HEADING = (f"SELECT page_id, CASE WHEN regexp_matches(html, '<h1>') THEN {strip_sql(_decode(_H1))} "
                f"ELSE {_sq(D.NO_SYNTAX)} END AS text FROM pages")

PAGE_LINKS = """
WITH l AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages)
SELECT page_id, CAST(unnest(range(len(hs))) AS BIGINT) AS pos,
       unnest(list_transform(hs, lambda h: regexp_extract(url, '^(https?://[^/?#]+)', 1) || h)) AS href
FROM l"""


def _hashed(name: str, src: str) -> str:
    return f"""{name}1 AS (SELECT k, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term FROM {src}),
        {name}2 AS (SELECT k, ('0x' || substr(md5(term), 1, 8))::BIGINT % {B.HASH_DIMS} AS b, count(*)::DOUBLE AS c FROM {name}1 GROUP BY ALL),
        {name} AS (SELECT k, b, c / sqrt(sum(c * c) OVER (PARTITION BY k)) AS w FROM {name}2)"""


_EX = "array_to_string(list_transform(string_split(d.text, chr(10)), lambda x: " + clean_sql("x") + "), ' ')"
_REC = [clean_sql("c.text"), clean_sql("string_split(d.text, chr(10))[1]"), clean_sql("d.text"), clean_sql("d.lang")]
ENRICHED = (
    "SELECT c.conv_id, c.turn, c.conv_id AS command, "
    + ", ".join(f"{x} AS {n}" for x, n in zip(_REC, ("query", "description", "description_detailed", "syntax"), strict=True))
    + f", {_EX} AS examples, d.source AS url, " + clean_sql("concat_ws(' ', " + ", ".join([*_REC, _EX]) + ")")
    + " AS combined_text FROM conversations c JOIN documents d ON c.conv_id = d.doc_id WHERE c.role = 'user'")


ORACLES = {
    "tfidf_topk": TFIDF_TOPK,
    "squeeze_strip_tags": (f"SELECT page_id, regexp_replace({squeeze_sql('html')}, '<.*?>', '', 'g') "
                           f"AS text FROM pages"),
    "clean_text": f"SELECT doc_id, {clean_sql('text')} AS text FROM documents",
    "lower_strip_dots": f"SELECT doc_id, rtrim(lower({squeeze_sql('text')}), '.') AS text FROM documents",
    "blank_query_filter": (f"SELECT conv_id, turn FROM conversations WHERE {strip_sql('text')} <> '' "
                           f"AND lower({strip_sql('text')}) NOT IN ('exit', 'quit', 'q')"),
    "combined_text": COMBINED_TEXT,
    "label_suffix": """
        SELECT n_nationkey, CAST(regexp_extract(n_name, '([^_]*)$', 1) AS INTEGER) AS label_id, r_name
        FROM nation JOIN region ON r_regionkey = CAST(regexp_extract(n_name, '([^_]*)$', 1) AS INTEGER) % 5""",
    "augment4": _augment(D.TEMPLATES_4, B.PART_PHRASES_4),
    "augment10": _augment(D.TEMPLATES_10, B.PART_PHRASES_10),
    "pair_rules": PAIR_RULES,
    "prompt_fanout": PROMPT_FANOUT,
    "lm_records": LM_RECORDS,
    "retrieval_text": """
        SELECT p_name, p_name || ': ' || t || '. Examples: ' || array_to_string(string_split(b, '#'), ' ') AS text
        FROM (SELECT p_name, arg_max(p_type, p_partkey) AS t, arg_max(p_brand, p_partkey) AS b
              FROM part GROUP BY p_name)""",
    "union_phrases": """SELECT count(*) AS n_rows, count(DISTINCT text) AS n_distinct
        FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)""",
    "catalog_merge": """
        WITH d AS (SELECT o_custkey,
            arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_totalprice IS NOT NULL) AS balance,
            arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_orderpriority IS NOT NULL) AS o_orderpriority,
            arg_max(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus IS NOT NULL) AS o_orderstatus
          FROM orders GROUP BY o_custkey)
        SELECT c_custkey, c_name, c_mktsegment, coalesce(d.balance, c_acctbal) AS balance,
               o_orderpriority, o_orderstatus
        FROM customer LEFT JOIN d ON d.o_custkey = c_custkey""",
    "enrich_pairs": (f"SELECT doc_id, quality, toxic, {clean_sql('text')} AS text "
                     f"FROM documents JOIN labels USING (doc_id)"),
    "unknown_keys": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "valid_label_semi": f"""SELECT p_partkey FROM part WHERE (p_brand, p_type) IN
        (SELECT (p_brand, p_type) FROM part GROUP BY p_brand, p_type HAVING count(*) >= {B.VALID_LABEL_MIN})""",
    "detail_lookup": """
        SELECT e.event_id, c.c_mktsegment AS description, nullif(c.c_name, '') AS syntax,
               CASE WHEN len(string_split(c.c_name, '#')) > 0 THEN string_split(c.c_name, '#')[1] END AS example
        FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""",
    "label_dictionary": LABEL_DICT,
    "encode_labels": f"""WITH l AS ({LABEL_DICT})
        SELECT doc_id, label_id FROM documents JOIN l ON l.label = documents.source""",
    "dedup_last": """SELECT o_custkey, max(o_orderkey) AS o_orderkey,
        arg_max(o_totalprice, o_orderkey) AS o_totalprice, min(o_orderkey) AS first_pos
        FROM orders GROUP BY o_custkey""",
    "keyword_fallback": f"SELECT doc_id, {FALLBACK_CMD} AS command, {FALLBACK_SCORE} AS score FROM documents",
    "label_counts": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "dataset_stats": "SELECT count(*) AS n_rows, count(DISTINCT source) AS n_keys FROM documents",
    "distinct_candidates": "SELECT DISTINCT user_id, event_type AS candidate FROM events",
    "candidate_mode": """SELECT user_id, candidate, n FROM (
        SELECT user_id, event_type AS candidate, count(*) AS n,
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
        FROM events GROUP BY user_id, event_type) WHERE rn = 1""",
    "resolve_candidates": f"""
        WITH m AS (SELECT doc_id, candidate FROM (
            SELECT user_id AS doc_id, event_type AS candidate,
                   row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
            FROM events WHERE event_type <> 'error' GROUP BY user_id, event_type) WHERE rn = 1)
        SELECT d.doc_id, coalesce(m.candidate, {FALLBACK_CMD}) AS command,
               CASE WHEN m.candidate IS NOT NULL THEN 1.0 ELSE {FALLBACK_SCORE} END AS score
        FROM documents d LEFT JOIN m USING (doc_id)""",
    "argmax_confidence": f"SELECT l_orderkey, label, score AS confidence FROM ({RANKED_LINES}) WHERE rn = 1",
    "topk_labels": (f"SELECT l_orderkey, CAST(rn AS BIGINT) AS rank, label, score "
                    f"FROM ({RANKED_LINES}) WHERE rn <= 3"),
    "softmax_scores": f"""SELECT l_orderkey, label, round(ex / sum(ex) OVER (PARTITION BY l_orderkey), 6) AS score
        FROM (SELECT l_orderkey, label, exp(q / 10 - max(q / 10) OVER (PARTITION BY l_orderkey)) AS ex
              FROM ({LINE_SCORES}))""",
    "answer_cards": f"""SELECT l_orderkey, label, score AS confidence, o_orderstatus, o_orderpriority
        FROM ({RANKED_LINES}) b LEFT JOIN orders o ON o.o_orderkey = b.l_orderkey WHERE rn = 1""",
    "confusion": f"WITH {_nn()} SELECT y_true, y_pred, n FROM conf",
    "class_report": CLASS_REPORT,
    "weighted_metrics": WEIGHTED,
    "split_exact": SPLIT_EXACT,
    "split_stratified": SPLIT_STRATIFIED,
    "split_grouped": SPLIT_GROUPED,
    "split_stratified_grouped": SPLIT_STRATIFIED_GROUPED,
    "split_tenth": SPLIT_TENTH,
    "rare_label_report": f"""SELECT count(*) AS n_excluded FROM (SELECT p_brand, p_type FROM part
        GROUP BY p_brand, p_type HAVING count(*) < {B.VALID_LABEL_MIN})""",
    "ngrams": f"WITH {_tfidf_ctes()} SELECT doc_id, term, tf FROM doc_tf",
    "vocabulary": f"WITH {_tfidf_ctes()} SELECT term, df FROM idf",
    "tfidf": f"WITH {_tfidf_ctes()} SELECT doc_id, term, round(w, 6) AS weight FROM doc_w",
    "tfidf_transform": TFIDF_TRANSFORM,
    "hash_embed": f"""
        WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term FROM documents),
        c AS (SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {B.HASH_DIMS} AS bucket,
                     CAST(count(*) AS DOUBLE) AS c FROM t GROUP BY ALL)
        SELECT doc_id, bucket, round(c / sqrt(sum(c * c) OVER (PARTITION BY doc_id)), 6) AS weight FROM c""",
    "vector_normalize": """
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM e)
        SELECT vec_id, CAST(unnest(range(len(v))) AS BIGINT) AS pos,
               round(unnest(list_transform(v, lambda x: CASE WHEN nrm > 0 THEN x / nrm ELSE x END)), 6) AS x
        FROM n""",
    "vector_topk": """
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        s AS (SELECT a.vec_id AS q, b.vec_id, list_inner_product(a.v, b.v) AS score
              FROM e a JOIN e b ON a.vec_id <> b.vec_id)
        SELECT q, CAST(rn AS BIGINT) AS rank, vec_id, round(score, 6) AS score FROM (
          SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(score, 9) DESC, vec_id) AS rn FROM s)
        WHERE rn <= 3""",
    "encode_fixed": _encode("text", 256)
    + " SELECT doc_id, pos, token_id, attention_mask FROM enc",
    "encode_targets": _encode("source", 64)
    + " SELECT doc_id, pos, CASE WHEN token_id = 0 THEN -100 ELSE token_id END AS target FROM enc",
    "encode_lm": _encode("text", 512)
    + " SELECT doc_id, pos, CASE WHEN token_id = 0 THEN -100 ELSE token_id END AS label FROM enc",
    "page_links": PAGE_LINKS,
    "page_heading": PAGE_HEADING,
    "page_table_rows": """SELECT page_id, CAST(0 AS BIGINT) AS pos, 'page ' || page_id AS command, url AS description,
        regexp_extract(url, '^(https?://[^/]*)', 1) || CASE WHEN len(string_split(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/')) > 3
          THEN '/' || array_to_string(list_slice(string_split(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/'), 2,
               len(string_split(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/')) - 2), '/') ELSE '' END
          || '/p/' || page_id AS url FROM pages""",
    "part_page_details": f"""SELECT p_partkey, p_name,
        CASE WHEN p_size % 2 = 0 THEN p_type || ' /S' ELSE {_sq(D.NO_SYNTAX)} END AS syntax,
        CASE WHEN p_size % 2 = 0 THEN p_name || ' /1' ELSE '' END AS examples,
        CASE WHEN p_size % 2 = 0 THEN p_brand || ' ' || p_type ELSE '' END AS description_detailed,
        CAST(NULL AS VARCHAR) AS error FROM part""",
    "enriched_records": ENRICHED,
    "decoded_top3": """
        WITH s AS (SELECT l_orderkey, l_suppkey % 5 AS id, max(l_extendedprice) AS score FROM lineitem GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, 'LABEL_' || id) AS rank FROM s)
        SELECT l_orderkey, rank, r_name, score FROM r JOIN region ON r_regionkey = id WHERE rank <= 3""",
    "find_command": f"""
        WITH l AS (SELECT p_type, arg_max(p_name, p_partkey) AS p_name, arg_max(p_brand, p_partkey) AS p_brand FROM part GROUP BY p_type),
        d0 AS (SELECT p_type AS k, p_type || ' ' || p_name || ' ' || p_brand AS text FROM l),
        q0 AS (SELECT p_partkey AS k, p_name || ' ' || p_type AS text FROM part),
        {_hashed('d', 'd0')}, {_hashed('q', 'q0')},
        s AS (SELECT q.k AS p_partkey, d.k AS command, sum(q.w * d.w) AS score FROM q JOIN d USING (b) GROUP BY ALL)
        SELECT p_partkey, command, round(score, 6) AS score FROM s
        QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY round(score, 9) DESC, command) = 1""",
    "json_array_read": "SELECT * FROM orders",
    "suffix_dispatch": "SELECT customer.*, f.format FROM customer, (VALUES ('csv'), ('json'), ('parquet')) f(format)",
    "text_forest_report": f"""
        WITH d AS (SELECT doc_id, quality, row_number() OVER (ORDER BY {_h('doc_id')}, doc_id) - 1 AS rk, count(*) OVER () AS n
          FROM documents JOIN labels USING (doc_id))
        SELECT CAST(quality AS VARCHAR) AS label, count(*) AS support FROM d WHERE rk < ceil({_F} * n) GROUP BY quality""",
    "scored_batch": """
        WITH e AS (SELECT vec_id, label, unnest(range(len(embedding))) AS pos,
                          CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
        c AS (SELECT label, pos, avg(x) AS cx FROM e GROUP BY label, pos)
        SELECT e.vec_id, c.label, round(sum(e.x * c.cx), 6) AS score
        FROM e JOIN c ON c.pos = e.pos GROUP BY e.vec_id, c.label""",
    "csv_json_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "label_map_roundtrip": LABEL_DICT,
    "model_roundtrip": TFIDF_TRANSFORM,
    "stream_scoring": f"SELECT t.* FROM ({TFIDF_TOPK}) t JOIN conversations c USING (conv_id, turn) WHERE {strip_sql('c.text')} <> '' AND lower({strip_sql('c.text')}) NOT IN ('exit', 'quit', 'q')",
}
ORACLES["vector_topk_clusters"] = ORACLES["vector_topk"]
ORACLES["forest_tables"] = f"""
WITH r AS (SELECT vec_id, row_number() OVER (ORDER BY {_h('vec_id')}, vec_id) - 1 AS rk, count(*) OVER () AS n FROM embeddings)
SELECT vec_id, c AS class, true AS agrees FROM r, (SELECT unnest(range((SELECT max(label) + 1 FROM embeddings))) AS c)
WHERE rk < ceil({_F} * n)"""
ORACLES["stream_errors"] = f"""
WITH u AS (SELECT conv_id, turn FROM conversations WHERE role = 'user' AND {strip_sql('text')} <> ''
           AND lower({strip_sql('text')}) NOT IN ('exit', 'quit', 'q')),
r AS (SELECT conv_id, turn, count(*) AS n FROM ({TFIDF_TOPK}) GROUP BY ALL)
SELECT conv_id, turn, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN {_sq(B.NO_TERM)} END AS error
FROM u LEFT JOIN r USING (conv_id, turn)"""
ORACLES["dataset_stats_merged"] = "SELECT count(*) AS n_rows, true AS within FROM lineitem"
ORACLES["csv_split_read"] = "SELECT doc_id, source, lang, text FROM documents"
ORACLES["keyword_table"] = f"""
WITH k AS (SELECT lower(regexp_extract(text, '^[^ ]+ [^ ]+')) AS kw, role || '-' || conv_id || '-' || turn AS command, conv_id, turn
           FROM conversations),
m AS (SELECT d.doc_id, arg_min(command, (conv_id, turn)) AS command
      FROM documents d JOIN k ON k.kw <> '' AND contains(lower(d.text), k.kw) GROUP BY d.doc_id)
SELECT doc_id, coalesce(command, {_sq(D.FALLBACK_NONE)}) AS command, CASE WHEN command IS NULL THEN 0.0 ELSE {D.FALLBACK_HIT_SCORE} END AS score
FROM documents LEFT JOIN m USING (doc_id)"""


def _hex(digits: str) -> str:
    return f"('0x' || {digits})::BIGINT"


# The signed parts of each word, per text; vectors of words that cancel out stay zero.
_PROJECTED = f"""
x AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'q', conv_id, text FROM conversations WHERE turn = 0),
w AS (SELECT kind, id, md5(unnest(regexp_extract_all(lower(text), '{TOKEN}'))) AS h FROM x),
b AS (SELECT *, {_hex('substr(h, 1, 4)')} AS bucket FROM w),
f AS (SELECT bucket, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(DISTINCT id))) + 1 AS idf FROM b WHERE kind = 'd' GROUP BY bucket),
p AS (SELECT kind, id, {_hex('substr(h, 5 + 7 * r, 7)')} AS v, coalesce(idf, ln(1.0 + (SELECT count(*) FROM documents)) + 1) AS idf
      FROM b LEFT JOIN f USING (bucket), range({P.PARTS}) g(r)),
s AS (SELECT kind, id, (v >> 1) % {B.PROJECTED_DIMS} AS pos, sum(CASE WHEN v % 2 = 1 THEN -idf ELSE idf END) AS y FROM p GROUP BY ALL),
n AS (SELECT kind, id, sqrt(sum(y * y)) AS nrm FROM s GROUP BY ALL),
c AS (SELECT x.kind, x.id, g.pos, coalesce(y / nullif(nrm, 0), 0.0) AS x FROM x CROSS JOIN range({B.PROJECTED_DIMS}) g(pos)
      LEFT JOIN s ON s.kind = x.kind AND s.id = x.id AND s.pos = g.pos LEFT JOIN n ON n.kind = x.kind AND n.id = x.id)"""
ORACLES["projected_embed"] = f"WITH {_PROJECTED} SELECT id AS doc_id, pos, round(x, 6) AS x FROM c WHERE kind = 'd'"
ORACLES["projected_topk"] = f"""
WITH {_PROJECTED},
t AS (SELECT q.id AS conv_id, d.id AS doc_id, sum(q.x * d.x) AS score FROM c q JOIN c d ON q.kind = 'q' AND d.kind = 'd' AND q.pos = d.pos GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM t)
SELECT conv_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 3"""
