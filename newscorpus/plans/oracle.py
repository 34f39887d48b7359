"""The catalog's queries in the SQL of a second engine.

Shared definitions are CTEs put in front of each statement.  Queries with
stemming have no entry; tests check those by brute force on small fixtures.
"""

from __future__ import annotations

from newscorpus import lexicons
from newscorpus.operators import summarize
from newscorpus.operators.extract import ENTITIES, NO_TEXT
from newscorpus.operators.rules import SITE_RULES, Rule
from newscorpus.plans import bindings, catalog


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_quote(i) for i in items) + "]"


def _in(items) -> str:
    return "(" + ", ".join(_quote(i) for i in items) + ")"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_quote(str(x)) for x in r) + ")" for r in rows)


# --- expressions -----------------------------------------------------------


def _nonempty(expr: str) -> str:
    return f"list_filter({expr}, lambda x: x <> '')"


def words(text: str) -> str:
    return _nonempty(rf"string_split_regex({text}, '\s+')")


def terms(text: str) -> str:
    return _nonempty(rf"string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}]+')")


def ascii_terms(text: str) -> str:
    return _nonempty(f"string_split_regex(lower({text}), '[^a-z0-9]+')")


def sentences(text: str) -> str:
    return _nonempty(
        rf"list_transform(string_split_regex({text}, '[.!?\n]+'), lambda s: trim(s))"
    )


def lead(text: str, n: int) -> str:
    return f"array_to_string(list_slice({words(text)}, 1, {n}), ' ')"


def grams(tokens: str, n: int) -> str:
    """Adjacent runs as text; ``tokens`` must be a column."""
    run = " || ' ' || ".join(f"{tokens}[i + {k}]" for k in range(n))
    return f"list_transform(range(1, len({tokens}) - {n} + 2), lambda i: {run})"


def flat_paragraphs(html: str) -> str:
    body = rf"regexp_extract({html}, '(?is)<article(?:\s[^>]*)?>(.*?)</article>', 1)"
    body = f"regexp_replace({body}, {_quote(NO_TEXT)}, '', 'g')"
    text = "regexp_replace(regexp_replace(p, '(?is)</p>.*', ''), '<[^>]*>', '', 'g')"
    for entity, char in ENTITIES:
        text = f"regexp_replace({text}, {_quote(entity)}, {_quote(char)}, 'g')"
    pieces = rf"(string_split_regex({body}, '(?i)<p(?:\s[^>]*)?>'))[2:]"
    return _nonempty(rf"list_transform({pieces}, lambda p: trim({text}, E' \n\t\r'))")


def site_text(rule: Rule) -> str:
    """What a site's rule finds on the page that ``bindings.site_markup`` writes for it."""
    ps = "ps[1:len(ps) - 1]" if rule.drop_last else "ps"
    if not rule.path and rule.kind == "html":
        ps = "list_concat(list_concat(['ad'], ps), ['foot'])"
    elif len(rule.children) > 1:
        ps = "list_prepend('Head', ps)"
    if rule.block == "each":
        return r"array_to_string(ps[:1], ' ') || E'\n' || array_to_string(ps[2:], ' ')"
    return f"array_to_string({ps}, '{'' if not rule.children and not rule.node_join else ' '}')"


def not_missing(col: str) -> str:
    return f"CASE WHEN {col} NOT IN {_in(lexicons.MISSING)} THEN {col} END"


def language(text: str) -> str:
    """Scores in tie order, then the first language that reaches the maximum."""
    scores = ", ".join(
        f"len(list_filter(w, lambda x: list_contains({_list(ws)}, x)))"
        for ws in lexicons.STOPWORDS.values()
    )
    langs = list(lexicons.STOPWORDS)
    return rf"""(SELECT CASE WHEN list_max(s) > 0
        THEN {_list(langs)}[list_position(s, list_max(s))] END
        FROM (SELECT [{scores}] AS s
              FROM (SELECT string_split_regex(lower({text}), '[\s.,]+') AS w)))"""


def single(expr: str) -> str:
    """Single precision: two engines agree on it where the last bits differ."""
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


# --- shared tables ---------------------------------------------------------

ARTICLES = """articles AS (
  SELECT doc_id AS article_id, 'id-' || source AS source_id, source AS source_name,
         CASE WHEN doc_id % 7 <> 0 THEN 'author' || CAST(doc_id % 50 AS VARCHAR) END AS author,
         CASE WHEN doc_id % 11 <> 0 THEN substr(text, 1, 60) END AS title,
         substr(text, 1, 120) AS description,
         CASE WHEN doc_id % 13 <> 0
              THEN 'https://news.example/' || CAST(doc_id - doc_id % 2 AS VARCHAR) END AS url,
         CASE WHEN doc_id % 5 <> 0
              THEN 'https://img.example/' || CAST(doc_id AS VARCHAR) END AS url_to_image,
         strftime(DATE '2024-01-01' + CAST((doc_id // 2) % 30 AS INTEGER), '%Y-%m-%d')
           AS published_date,
         strftime(DATE '2024-01-01' + CAST((doc_id // 2) % 30 AS INTEGER), '%Y-%m-%d')
           || 'T00:00:00Z' AS published_at,
         text AS content,
         'q' || CAST(doc_id % 5 AS VARCHAR) AS category,
         CASE WHEN doc_id % 17 <> 0
              THEN doc_id % (SELECT count(*) FROM pages) END AS page_key
  FROM documents)"""

SUMMARIES = r"""summaries AS (
  SELECT doc_id AS article_id, source, text AS article,
         split_part(text, chr(10), 1) AS highlights
  FROM documents)"""

PAIRS = """pairs AS (
  SELECT u.conv_id * 1000 + u.turn AS pair_id, u.turn, u.text AS reference, a.text AS prediction
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

SCALARS = f"""scalars AS (
  SELECT run, tag, row_number() OVER (PARTITION BY run, tag ORDER BY ts, seq) AS step, seq, value
  FROM (SELECT 'run' || CAST(user_id % 12 AS VARCHAR) AS run, t.tag, ts, event_id AS seq, value
        FROM events JOIN (VALUES {_values(bindings.TAGS.items())}) AS t(kind, tag)
          ON t.kind = event_type))"""

VOCAB = f"""tokens AS (
  SELECT unnest(list_concat({words("article")}, {words("highlights")})) AS word FROM summaries),
vocab AS (
  SELECT word, n, row_number() OVER (ORDER BY n DESC, word) + 2 AS id
  FROM (SELECT word, count(*) AS n FROM tokens GROUP BY word
        ORDER BY n DESC, word LIMIT {catalog.VOCAB_SIZE}))"""


def _encoded_side(col: str, max_len: int) -> str:
    return f"""SELECT article_id,
       list_append(list(id ORDER BY pos) FILTER (WHERE pos IS NOT NULL), 1) AS ids
     FROM (SELECT s.article_id, u.pos, coalesce(v.id, 2) AS id
           FROM summaries s
           LEFT JOIN (SELECT article_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
                      FROM (SELECT article_id,
                              list_slice({words(col)}, 1, {max_len - 1}) AS w FROM summaries)) u
             ON u.article_id = s.article_id
           LEFT JOIN vocab v ON v.word = u.word)
     GROUP BY article_id"""


ENCODED = f"""{VOCAB},
enc_in AS ({_encoded_side("article", catalog.MAX_INPUT)}),
enc_out AS ({_encoded_side("highlights", catalog.MAX_TARGET)}),
encoded AS (
  SELECT i.article_id, coalesce(i.ids, [1]) AS input_ids, coalesce(o.ids, [1]) AS labels
  FROM enc_in i JOIN enc_out o ON o.article_id = i.article_id)"""


def _join_ids(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


def _padded(col: str, n: str) -> str:
    return (
        f"list_concat({col}, list_transform(range(CAST({n} AS BIGINT) - len({col})), lambda i: 0))"
    )


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


# --- ROUGE -----------------------------------------------------------------


def _rouge_ctes(n: int, source: str = "pairs", key: str = "pair_id") -> str:
    """Per pair: matched n-grams and the sizes of both sides, as ``rouge{n}``."""
    return f"""tok{n} AS (
  SELECT {key}, {ascii_terms("prediction")} AS p, {ascii_terms("reference")} AS r FROM {source}),
gram{n} AS (
  SELECT {key}, g, sum(s) AS np, count(*) - sum(s) AS nr
  FROM (SELECT {key}, unnest({grams("p", n)}) AS g, 1 AS s FROM tok{n}
        UNION ALL
        SELECT {key}, unnest({grams("r", n)}) AS g, 0 AS s FROM tok{n})
  GROUP BY {key}, g),
hit{n} AS (
  SELECT {key}, sum(least(np, nr)) AS m, sum(np) AS np, sum(nr) AS nr FROM gram{n} GROUP BY {key}),
rouge{n} AS (
  SELECT t.{key},
         CASE WHEN coalesce(np, 0) > 0 THEN CAST(m AS DOUBLE) / np ELSE 0.0 END AS precision,
         CASE WHEN coalesce(nr, 0) > 0 THEN CAST(m AS DOUBLE) / nr ELSE 0.0 END AS recall,
         CASE WHEN coalesce(m, 0) > 0 THEN 2.0 * CAST(m AS DOUBLE) / (np + nr) ELSE 0.0 END AS f1
  FROM tok{n} t LEFT JOIN hit{n} h ON h.{key} = t.{key})"""


def _rouge_pairs(n: int) -> str:
    return (
        _with(PAIRS, _rouge_ctes(n))
        + f"""SELECT pair_id, {single("precision")} AS precision, {single("recall")} AS recall,
       {single("f1")} AS f1 FROM rouge{n}"""
    )


ROUGE_BOTH = f"""{PAIRS},
{_rouge_ctes(1)},
{_rouge_ctes(2)},
scored AS (
  SELECT p.pair_id, p.turn, a.f1 AS rouge1, b.f1 AS rouge2
  FROM pairs p JOIN rouge1 a ON a.pair_id = p.pair_id JOIN rouge2 b ON b.pair_id = p.pair_id)"""

def _lcs_row() -> str:
    """The next row of the LCS table from ``row``, for prediction token ``j + 1``."""
    return """list_reduce(
           list_transform(range(1, len(r) + 1), lambda i: [
             CASE WHEN r[i] = p[j + 1] THEN row[i] + 1 ELSE row[i + 1] END]),
           lambda acc, x: list_append(acc, greatest(acc[len(acc)], x[1])),
           [0])"""


# Longest common subsequence by a recursion over prediction tokens; the state is
# the whole row of the classic table.
ROUGE_L = (
    "WITH RECURSIVE "
    + PAIRS
    + f""",
tok AS (SELECT pair_id, {ascii_terms("prediction")} AS p, {ascii_terms("reference")} AS r FROM pairs),
lcs AS (
  SELECT pair_id, p, r, 0 AS j, list_transform(range(len(r) + 1), lambda i: 0) AS row FROM tok
  UNION ALL
  SELECT pair_id, p, r, j + 1,
         {_lcs_row()}
  FROM lcs WHERE j < len(p)),
done AS (SELECT pair_id, len(p) AS np, len(r) AS nr, row[len(row)] AS m FROM lcs WHERE j = len(p))
SELECT pair_id,
       {single("CASE WHEN np > 0 THEN CAST(m AS DOUBLE) / np ELSE 0.0 END")} AS precision,
       {single("CASE WHEN nr > 0 THEN CAST(m AS DOUBLE) / nr ELSE 0.0 END")} AS recall,
       {single("CASE WHEN m > 0 THEN 2.0 * CAST(m AS DOUBLE) / (np + nr) ELSE 0.0 END")} AS f1
FROM done"""
)


# Union LCS: the table of every sentence pair, then a walk back through it that
# steps back in the reference on equal choices; hits are clipped per token.
ROUGE_LSUM = (
    "WITH RECURSIVE "
    + PAIRS
    + f""",
ref AS (SELECT pair_id, generate_subscripts(s, 1) AS ri, unnest(s) AS t
        FROM (SELECT pair_id, {_nonempty("string_split(reference, chr(10))")} AS s FROM pairs)),
pred AS (SELECT pair_id, generate_subscripts(s, 1) AS pi, unnest(s) AS t
         FROM (SELECT pair_id, {_nonempty("string_split(prediction, chr(10))")} AS s FROM pairs)),
rtok AS (SELECT pair_id, ri, {ascii_terms("t")} AS r FROM ref),
ptok AS (SELECT pair_id, pi, {ascii_terms("t")} AS p FROM pred),
lcs AS (
  SELECT pair_id, ri, pi, r, p, 0 AS j, list_transform(range(len(r) + 1), lambda i: 0) AS row
  FROM rtok JOIN ptok USING (pair_id)
  UNION ALL
  SELECT pair_id, ri, pi, r, p, j + 1, {_lcs_row()} FROM lcs WHERE j < len(p)),
tab AS (
  SELECT pair_id, ri, pi, any_value(r) AS r, any_value(p) AS p, list(row ORDER BY j) AS t
  FROM lcs GROUP BY pair_id, ri, pi),
walk AS (
  SELECT pair_id, ri, pi, len(r) AS i, len(p) AS j, CAST(NULL AS VARCHAR) AS w, 0 AS hit FROM tab
  UNION ALL
  SELECT k.pair_id, k.ri, k.pi,
         CASE WHEN r[i] = p[j] THEN i - 1 WHEN t[j][i + 1] > t[j + 1][i] THEN i ELSE i - 1 END,
         CASE WHEN r[i] = p[j] THEN j - 1 WHEN t[j][i + 1] > t[j + 1][i] THEN j - 1 ELSE j END,
         CASE WHEN r[i] = p[j] THEN r[i] END, i
  FROM walk k JOIN tab USING (pair_id, ri, pi) WHERE i > 0 AND j > 0),
hits AS (
  SELECT pair_id, w, count(*) AS n
  FROM (SELECT DISTINCT pair_id, ri, w, hit FROM walk WHERE w IS NOT NULL) GROUP BY pair_id, w),
counts AS (
  SELECT pair_id, w, count(*) AS n FROM (SELECT pair_id, unnest(p) AS w FROM ptok)
  GROUP BY pair_id, w),
m AS (
  SELECT h.pair_id, sum(least(h.n, c.n)) AS m
  FROM hits h JOIN counts c ON c.pair_id = h.pair_id AND c.w = h.w GROUP BY h.pair_id),
sizes AS (
  SELECT q.pair_id, coalesce(m.m, 0) AS m,
         (SELECT coalesce(sum(len(p)), 0) FROM ptok WHERE ptok.pair_id = q.pair_id) AS np,
         (SELECT coalesce(sum(len(r)), 0) FROM rtok WHERE rtok.pair_id = q.pair_id) AS nr
  FROM pairs q LEFT JOIN m ON m.pair_id = q.pair_id)
SELECT pair_id,
       {single("CASE WHEN np > 0 THEN CAST(m AS DOUBLE) / np ELSE 0.0 END")} AS precision,
       {single("CASE WHEN nr > 0 THEN CAST(m AS DOUBLE) / nr ELSE 0.0 END")} AS recall,
       {single("CASE WHEN m > 0 THEN 2.0 * CAST(m AS DOUBLE) / (np + nr) ELSE 0.0 END")} AS f1
FROM sizes"""
)


def _bootstrap(reps: int) -> str:
    # cumulative Poisson(1) probabilities in 32 bits, worked out by this engine
    table = """(SELECT list(t) FROM (
  SELECT CAST(floor(4294967296 * sum(exp(-1) / factorial(CAST(k AS INTEGER))) OVER (ORDER BY k)) AS UBIGINT) AS t
  FROM range(13) AS p(k)))"""
    weight = f"len(list_filter({table}, lambda t: u >= t))"
    return (
        _with(ROUGE_BOTH)
        + f"""SELECT metric, {single("quantile_cont(mean, 0.025)")} AS low,
       {single("quantile_cont(mean, 0.5)")} AS mid, {single("quantile_cont(mean, 0.975)")} AS high
FROM (
  SELECT rep, unnest(['rouge1', 'rouge2']) AS metric,
         unnest([sum(rouge1 * w) / sum(w), sum(rouge2 * w) / sum(w)]) AS mean
  FROM (SELECT rep, rouge1, rouge2, {weight} AS w
        FROM (SELECT s.*, r.rep,
                CAST('0x' || substr(md5(CAST(pair_id AS VARCHAR) || ':' || CAST(r.rep // 4 AS VARCHAR)),
                                    CAST(8 * (r.rep % 4) + 1 AS INTEGER), 8) AS UBIGINT) AS u
              FROM scored s, range({reps}) AS r(rep)))
  GROUP BY rep)
GROUP BY metric"""
    )


# --- sentences -------------------------------------------------------------

SENTENCES = f"""sents AS (
  SELECT article_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos
  FROM (SELECT article_id, {sentences("article")} AS s FROM summaries))"""

SCORES = f"""occ AS (
  SELECT article_id, pos, unnest({terms("sentence")}) AS word FROM sents),
idf AS (
  SELECT word, ln(CAST((SELECT count(*) FROM summaries) AS DOUBLE) / count(DISTINCT article_id))
    AS idf
  FROM occ GROUP BY word),
scores AS (
  SELECT o.article_id, o.pos, round(avg(i.idf), 6) AS score
  FROM occ o JOIN idf i ON i.word = o.word
  GROUP BY o.article_id, o.pos)"""


def _picked(source: str, k: int = 3) -> str:
    return f"""SELECT s.article_id, coalesce(p.summary, '') AS summary
FROM summaries s LEFT JOIN (
  SELECT article_id, string_agg(sentence, '. ' ORDER BY pos) AS summary
  FROM (SELECT r.article_id, r.pos, t.sentence,
               row_number() OVER (PARTITION BY r.article_id ORDER BY r.score DESC, r.pos) AS rn
        FROM {source} r JOIN sents t ON t.article_id = r.article_id AND t.pos = r.pos)
  WHERE rn <= {k} GROUP BY article_id) p ON p.article_id = s.article_id"""


def _trigrams(source: str, rank: str) -> str:
    """Sentences of ``source`` without a 3-gram of a better-ranked one that is kept, as ``kept``."""
    return f"""tri AS (
  SELECT article_id, rk, list_distinct({grams("t", 3)}) AS g,
         row_number() OVER (PARTITION BY article_id ORDER BY rk) AS k
  FROM (SELECT article_id, {rank} AS rk, {terms("sentence")} AS t FROM {source})),
fold AS (
  SELECT article_id, rk, k, g AS seen, true AS keeps FROM tri WHERE k = 1
  UNION ALL
  SELECT t.article_id, t.rk, t.k,
         CASE WHEN list_has_any(f.seen, t.g) THEN f.seen ELSE list_concat(f.seen, t.g) END,
         NOT list_has_any(f.seen, t.g)
  FROM fold f JOIN tri t ON t.article_id = f.article_id AND t.k = f.k + 1),
kept AS (
  SELECT s.* FROM {source} s JOIN fold f ON f.article_id = s.article_id AND f.rk = s.{rank} WHERE f.keeps)"""


LEADS = [
    (model, lead("article", 10 * (i + 1)))
    for i, (model, _) in enumerate(summarize.model_variants())
]
COMPARED = "compared AS (" + " UNION ALL ".join(
    f"SELECT article_id, {_quote(m)} AS model, {e} AS summary, highlights FROM summaries"
    for m, e in LEADS
) + ")"

# --- curation chain --------------------------------------------------------

CURATED = f"""{ARTICLES},
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY published_date, url ORDER BY article_id) AS rn
    FROM articles WHERE {not_missing("url")} IS NOT NULL) WHERE rn = 1),
judged AS (SELECT *, {language("content")} AS detected FROM firsts),
bodies AS (
  SELECT j.*, nullif(array_to_string({flat_paragraphs("p.html")}, ' '), '') AS full_content
  FROM judged j LEFT JOIN pages p ON p.page_id = j.page_key WHERE j.detected = 'en'),
curated AS (
  SELECT article_id, published_date, source_name, author, title, url, content, full_content
  FROM bodies
  WHERE {not_missing("author")} IS NOT NULL AND {not_missing("url")} IS NOT NULL
    AND {not_missing("title")} IS NOT NULL AND {not_missing("full_content")} IS NOT NULL)"""


LANDED = f"""{ARTICLES},
landed AS (
  SELECT *, md5(coalesce(url, '') || chr(10) || category || chr(10) || position) AS key
  FROM (SELECT *, row_number() OVER (PARTITION BY category, article_id // 500 ORDER BY article_id) - 1 AS position
        FROM articles)
  WHERE (article_id % 5 + article_id // 500) % 7 <> 3)"""


def _days(rows: str) -> str:
    """The curated days of the landed articles that ``rows`` selects."""
    return f"""day_firsts AS (
  SELECT *, article_id - article_id % 2 AS base FROM (
    SELECT *, row_number() OVER (PARTITION BY published_date, url ORDER BY position, key) AS rn
    FROM landed WHERE ({rows}) AND {not_missing("url")} IS NOT NULL) WHERE rn = 1),
day_bodies AS (
  SELECT j.*, nullif(array_to_string({flat_paragraphs("p.html")}, ' '), '') AS full_content
  FROM day_firsts j JOIN pages p ON p.page_id = j.base % (SELECT count(*) FROM pages) AND j.base % 17 <> 0
  WHERE {language("content")} = 'en')
SELECT key AS article_id, published_date, source_name, author, title, url, content, full_content
FROM day_bodies
WHERE {not_missing("author")} IS NOT NULL AND {not_missing("title")} IS NOT NULL
  AND {not_missing("full_content")} IS NOT NULL"""


def _length_columns() -> str:
    return "max(n) AS max_words, " + ", ".join(
        f"count(*) FILTER (WHERE n > {t}) AS over_{t}" for t in (4000, 2000, 1000, 700, 500)
    )


FIELD_LENGTHS = f"""lens AS (
  SELECT 'article' AS field, len({words("article")}) AS n FROM summaries
  UNION ALL SELECT 'highlights', len({words("highlights")}) FROM summaries)"""

CONTENT_TERMS = f"""content AS (
  SELECT doc_id, list_filter({terms("text")},
           lambda x: NOT list_contains({_list(lexicons.all_stopwords())}, x)) AS t
  FROM documents)"""

FLAT_COLUMNS = (
    "source_id, source_name, author, title, description, url, url_to_image, published_at, "
    "content, category"
)

FIRST_SECONDS = (
    "min_by(value, (step, seq)) FILTER (WHERE tag = 'total_training_time_seconds')"
)
RUN_SUMMARY = f"""run_list AS (SELECT 'run' || CAST(i AS VARCHAR) AS run FROM range(13) AS t(i)),
summary AS (
  SELECT r.run,
    max_by(value, (step, seq)) FILTER (WHERE tag = 'eval/rouge1') AS rouge1,
    max_by(value, (step, seq)) FILTER (WHERE tag = 'eval/rouge2') AS rouge2,
    max_by(value, (step, seq)) FILTER (WHERE tag = 'eval/rougeL') AS "rougeL",
    avg(value) FILTER (WHERE tag = 'gpu_memory_gb') AS gpu_avg,
    nullif({FIRST_SECONDS}, 0) / 60 AS train_time_min
  FROM run_list r LEFT JOIN scalars s ON s.run = r.run GROUP BY r.run)"""

WIDE = (
    "wide AS (SELECT run, step, "
    + ", ".join(
        f"max_by(value, seq) FILTER (WHERE tag = {_quote(t)}) AS \"{t}\""
        for t in bindings.TAGS.values()
    )
    + " FROM scalars GROUP BY run, step)"
)

EVALS = """evals AS (
  SELECT run, step, seq, value, row_number() OVER (PARTITION BY run ORDER BY step, seq) AS n,
         min(value) OVER (PARTITION BY run ORDER BY step, seq
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
  FROM scalars WHERE tag = 'eval/loss')"""


SQL: dict[str, str] = {
    "pending_queries": r"""
WITH q AS (SELECT DISTINCT trim(' ' || lang || ' ' || source) AS value FROM documents)
SELECT value FROM q WHERE NOT regexp_matches(value, '[02468]$')""",
    "page_plan": _with(ARTICLES)
    + """SELECT category, total, page FROM (
  SELECT category, total, unnest(range(1, least(total // 100, 5) + 1)) AS page
  FROM (SELECT category, count(*) AS total FROM articles GROUP BY category))""",
    "flatten_articles": _with(ARTICLES)
    + f"""SELECT {FLAT_COLUMNS} FROM articles
WHERE (article_id % 5 + article_id // 500) % 7 <> 3""",
    "append_read_articles": _with(ARTICLES)
    + f"SELECT article_id, {FLAT_COLUMNS}, published_date FROM articles",
    "csv_round_trip": _with(ARTICLES) + f"SELECT {FLAT_COLUMNS} FROM articles",
    "day_slice": _with(ARTICLES)
    + f"""SELECT article_id, url, published_at, content FROM articles
WHERE starts_with(published_at, '{catalog.DAY}')""",
    "drop_missing": _with(ARTICLES)
    + f"""SELECT article_id, author, url, title FROM articles
WHERE {not_missing("author")} IS NOT NULL AND {not_missing("url")} IS NOT NULL
  AND {not_missing("title")} IS NOT NULL""",
    "dedupe_keep_first": _with(ARTICLES)
    + """SELECT min(article_id) AS article_id, url FROM articles
WHERE url IS NOT NULL GROUP BY published_date, url""",
    "dedupe_by_text": """
SELECT doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)
WHERE rn = 1""",
    "detect_language": f"SELECT doc_id, {language('text')} AS detected FROM documents",
    "filter_language": _with(ARTICLES)
    + f"SELECT article_id, content FROM articles WHERE {language('content')} = 'en'",
    "language_report": f"""
SELECT lang, count(*) AS n, count(detected) AS covered,
       count(*) FILTER (WHERE detected = lang) AS correct
FROM (SELECT lang, {language("text")} AS detected FROM documents) GROUP BY lang""",
    "extract_body_flat": f"""
SELECT page_id, nullif(array_to_string({flat_paragraphs("html")}, ' '), '') AS full_content
FROM pages""",
    "extract_body_rules": rf"""
WITH body AS (
  SELECT page_id, page_id % 7 AS k, {flat_paragraphs("html")} AS ps,
         trim(regexp_replace(regexp_replace(
              regexp_extract(html, '<article>.*?<h1>(.*?)</h1>', 1),
              '&quot;?', '"', 'g'), '&amp;?', '&', 'g')) AS h1
  FROM pages)
SELECT page_id, 'site' || CAST(k AS VARCHAR) AS source_name,
  nullif(CASE k
    WHEN 0 THEN array_to_string(list_slice(ps, 1, len(ps) - 1), ' ')
    WHEN 1 THEN trim(split_part(array_to_string(ps, ' '), ' the ', 1))
    WHEN 2 THEN array_to_string(ps, ' ')
    WHEN 3 THEN h1
    WHEN 5 THEN array_to_string(ps, ' ') END, '') AS full_content
FROM body""",
    "extract_body_sites": f"""
SELECT page_id, source_name, nullif(CASE k {
        " ".join(f"WHEN {k} THEN {site_text(rule)}" for k, rule in enumerate(SITE_RULES))
    } END, '') AS full_content
FROM (SELECT page_id, page_id % {len(SITE_RULES) + 1} AS k, {flat_paragraphs("html")} AS ps,
        coalesce({_list(r.source_name for r in SITE_RULES)}[k + 1], 'elsewhere') AS source_name
      FROM pages)""",
    "daily_curation": _with(CURATED) + "SELECT * FROM curated",
    "incremental_curation": _with(CURATED) + "SELECT * FROM curated",
    "run_day_round_trip": _with(LANDED).rstrip() + ", " + _days(f"published_date IN {_in(catalog.DAYS[:2])}"),
    "rerun_day": _with(LANDED).rstrip()
    + ", "
    + _days(
        f"published_date = '{catalog.DAYS[2]}' OR (published_date = '{catalog.DAYS[1]}' AND position % 2 = 0)"
    ),
    "reject_report": """
WITH articles AS (
  SELECT CASE WHEN doc_id % 9 = 4 THEN 'broken' WHEN doc_id % 11 = 5 THEN 'error'
              WHEN doc_id % 13 = 6 THEN 'no articles' ELSE '' END AS reason FROM documents),
lines AS (SELECT CASE WHEN doc_id % 10 = 3 OR doc_id % 14 = 9 THEN 'broken' ELSE '' END AS reason FROM documents)
SELECT 'articles' AS landed, reason, count(*) AS n FROM articles GROUP BY reason
UNION ALL SELECT 'documents', reason, count(*) FROM lines GROUP BY reason""",
    "curated_length_report": _with(CURATED)
    + f"""SELECT source_name, field, {_length_columns()} FROM (
  SELECT source_name, 'content' AS field, len({words("content")}) AS n FROM curated
  UNION ALL SELECT source_name, 'full_content', len({words("full_content")}) FROM curated)
GROUP BY source_name, field""",
    "head_sample": _with(SUMMARIES)
    + f"""SELECT article_id, highlights FROM summaries ORDER BY article_id LIMIT {catalog.HEAD_SIZE}""",
    "nested_samples": _with(SUMMARIES)
    + f"""SELECT article_id, rank, sample FROM (
  SELECT article_id, row_number() OVER (ORDER BY article_id) AS rank FROM summaries) r
JOIN (VALUES {", ".join(f"('{k}', {v})" for k, v in catalog.SAMPLE_SIZES.items())}) AS z(sample, size)
  ON rank <= size""",
    "split_train_val": """
SELECT doc_id AS article_id, CASE WHEN
  CAST('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8) AS UBIGINT) % 100 < 20
  THEN 'val' ELSE 'train' END AS split FROM documents""",
    "split_by_modulus": """
SELECT doc_id AS article_id, CASE WHEN doc_id % 5 = 0 THEN 'val' ELSE 'train' END AS split
FROM documents""",
    "select_pair_columns": _with(SUMMARIES) + "SELECT article_id, article, highlights FROM summaries",
    "add_task_prefix": _with(SUMMARIES)
    + """SELECT article_id,
  CASE WHEN article_id % 2 = 0 THEN 'T5 Base' ELSE 'Pegasus CNN' END AS family,
  CASE WHEN article_id % 2 = 0 THEN 'summarize: ' || article ELSE article END AS article
FROM summaries""",
    "build_vocab": _with(SUMMARIES, VOCAB) + "SELECT word, n, id FROM vocab",
    "encode_pairs": _with(SUMMARIES, ENCODED)
    + f"""SELECT article_id, {_join_ids("input_ids")} AS input_ids,
  {_join_ids("list_transform(input_ids, lambda i: 1)")} AS attention_mask,
  {_join_ids("labels")} AS labels FROM encoded""",
    "pad_fixed": _with(SUMMARIES, ENCODED)
    + f"""SELECT article_id, {_join_ids(_padded("input_ids", str(catalog.MAX_INPUT)))} AS input_ids,
  {_join_ids(_padded("list_transform(input_ids, lambda i: 1)", str(catalog.MAX_INPUT)))}
    AS attention_mask,
  {_join_ids(_padded("labels", str(catalog.MAX_TARGET)))} AS labels FROM encoded""",
    "pad_longest": _with(
        SUMMARIES,
        ENCODED,
        "m AS (SELECT max(len(input_ids)) AS a, max(len(labels)) AS b FROM encoded)",
    )
    + f"""SELECT article_id, {_join_ids(_padded("input_ids", "(SELECT a FROM m)"))} AS input_ids,
  {_join_ids(_padded("labels", "(SELECT b FROM m)"))} AS labels FROM encoded""",
    "decode_ids": _with(SUMMARIES, VOCAB)
    + f"""SELECT s.article_id, coalesce(d.decoded, '') AS decoded FROM summaries s LEFT JOIN (
  SELECT article_id, string_agg(u.word, ' ' ORDER BY pos) AS decoded
  FROM (SELECT article_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
        FROM (SELECT article_id, list_slice({words("highlights")}, 1, {catalog.MAX_TARGET - 1}) AS w
              FROM summaries)) u
  JOIN vocab v ON v.word = u.word GROUP BY article_id) d ON d.article_id = s.article_id""",
    "chunk_text": f"""
SELECT doc_id, i AS chunk_no, array_to_string(list_slice(w, i * 512 + 1, (i + 1) * 512), ' ') AS chunk
FROM (SELECT doc_id, w, unnest(range((len(w) + 511) // 512)) AS i
      FROM (SELECT doc_id, {words("text")} AS w FROM documents))""",
    "text_lengths": f"""
SELECT doc_id, length(text) AS char_len, len({words("text")}) AS word_len FROM documents""",
    "length_report": _with(SUMMARIES, FIELD_LENGTHS)
    + f"SELECT field, {_length_columns()} FROM lens GROUP BY field",
    "avg_length": _with(SUMMARIES, FIELD_LENGTHS)
    + f"SELECT field, {single('avg(n)')} AS avg_words FROM lens GROUP BY field",
    "length_histogram": f"""
WITH lens AS (SELECT len({words("text")}) AS w FROM documents),
e AS (SELECT min(w) AS lo, max(w) AS hi FROM lens)
SELECT bin, min(w) AS min_words, max(w) AS max_words, count(*) AS n
FROM (SELECT w, least((w - lo) * 40 // (hi - lo), 39) AS bin FROM lens, e) GROUP BY bin""",
    "top_words": _with(CONTENT_TERMS)
    + """SELECT word, count(*) AS n FROM (SELECT unnest(t) AS word FROM content)
GROUP BY word ORDER BY n DESC, word LIMIT 30""",
    "top_bigrams": _with(CONTENT_TERMS)
    + f"""SELECT bigram, count(*) AS n FROM (SELECT unnest({grams("t", 2)}) AS bigram FROM content)
GROUP BY bigram ORDER BY n DESC, bigram LIMIT 20""",
    "term_weights": _with(CONTENT_TERMS)
    + f"""SELECT word, n, {single("n / max(n) OVER ()")} AS weight FROM (
  SELECT word, count(*) AS n FROM (SELECT unnest(t) AS word FROM content)
  GROUP BY word ORDER BY n DESC, word LIMIT 200)""",
    "category_counts": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "event_type_counts": f"""
WITH trig AS (SELECT * FROM (VALUES {_values(bindings.EVENT_TRIGGERS)}) AS t(word, kind)),
hits AS (
  SELECT doc_id, arg_min(kind, pos) AS kind
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
        FROM (SELECT doc_id, {terms("text")} AS w FROM documents)) u JOIN trig ON trig.word = u.word
  GROUP BY doc_id)
SELECT coalesce(kind, 'unknown') AS event_type, count(*) AS n
FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY 1""",
    "extract_entities": rf"""
WITH s AS (SELECT unnest({sentences("text")}) AS sentence FROM documents),
w AS (SELECT ({words("sentence")})[2:] AS w FROM s),
m AS (SELECT array_to_string(list_transform(w, lambda x: CASE
        WHEN regexp_matches(x, '^\p{{Lu}}[\p{{L}}\p{{M}}]+$') THEN x
        WHEN regexp_matches(x, '^\p{{Lu}}[\p{{L}}\p{{M}}]+[,;:]$') THEN regexp_replace(x, '[,;:]$', '') || ' |'
        ELSE '|' END), ' ') AS marked FROM w)
SELECT entity, count(*) AS n
FROM (SELECT trim(unnest(string_split(marked, '|'))) AS entity FROM m)
WHERE entity <> '' GROUP BY entity""",
    "rouge_tokens": f"SELECT doc_id, array_to_string({ascii_terms('text')}, ' ') AS tokens FROM documents",
    "rouge_1": _rouge_pairs(1),
    "rouge_2": _rouge_pairs(2),
    "rouge_l": ROUGE_L,
    "rouge_lsum": ROUGE_LSUM,
    "rouge_corpus": _with(ROUGE_BOTH)
    + """SELECT round(avg(rouge1), 4) AS rouge1, round(avg(rouge2), 4) AS rouge2,
  count(*) AS n_pairs FROM scored""",
    "rouge_corpus_by_turn": _with(ROUGE_BOTH)
    + """SELECT turn, round(avg(rouge1), 4) AS rouge1, round(avg(rouge2), 4) AS rouge2,
  count(*) AS n_pairs FROM scored GROUP BY turn""",
    "rouge_corpus_lcs": f"""
SELECT round(avg(l.f1), 4) AS "rougeL", round(avg(s.f1), 4) AS "rougeLsum", count(*) AS n_pairs
FROM ({ROUGE_L}) l JOIN ({ROUGE_LSUM}) s ON s.pair_id = l.pair_id""",
    "rouge_bootstrap": _bootstrap(200),
    "gen_len": _with(SUMMARIES)
    + f"""SELECT {single(f"avg(least(len({words('highlights')}), {catalog.MAX_TARGET - 1}) + 1)")}
  AS gen_len FROM summaries""",
    "write_eval_metrics": _with(ROUGE_BOTH)
    + """SELECT 'eval/' || metric AS tag, value, 'run0' AS run, turn AS step FROM (
  SELECT turn, unnest(['rouge1', 'rouge2']) AS metric,
         unnest([round(avg(rouge1), 4), round(avg(rouge2), 4)]) AS value
  FROM scored GROUP BY turn)""",
    "lead_summary": _with(SUMMARIES)
    + f"SELECT article_id, {lead('article', 128)} AS summary FROM summaries",
    "sentence_scores": _with(SUMMARIES, SENTENCES, SCORES)
    + "SELECT article_id, pos, score FROM scores",
    "extractive_summary": _with(SUMMARIES, SENTENCES, SCORES) + _picked("scores"),
    "extractive_summary_blocked": _with(
        SUMMARIES,
        SENTENCES,
        SCORES,
        """ranked AS (
  SELECT r.*, t.sentence,
         row_number() OVER (PARTITION BY r.article_id ORDER BY r.score DESC, r.pos) AS rank
  FROM scores r JOIN sents t ON t.article_id = r.article_id AND t.pos = r.pos)""",
        _trigrams("ranked", "rank"),
    )
    + _picked("kept"),
    "block_repeats": _with(SUMMARIES, SENTENCES, _trigrams("sents", "pos"))
    + "SELECT article_id, pos, sentence FROM kept",
    "compare_models": _with(SUMMARIES, COMPARED) + "SELECT article_id, model, summary FROM compared",
    "compare_models_wide": _with(SUMMARIES)
    + "SELECT article_id, "
    + ", ".join(f'{e} AS "{m}"' for m, e in LEADS)
    + " FROM summaries",
    "score_models": _with(
        SUMMARIES,
        COMPARED,
        """keyed AS (SELECT article_id || model AS k, model, summary AS prediction,
  highlights AS reference FROM compared)""",
        _rouge_ctes(1, "keyed", "k"),
        _rouge_ctes(2, "keyed", "k"),
    )
    + """SELECT model, round(avg(a.f1), 4) AS rouge1, round(avg(b.f1), 4) AS rouge2,
  count(*) AS n_pairs
FROM keyed q JOIN rouge1 a ON a.k = q.k JOIN rouge2 b ON b.k = q.k GROUP BY model""",
    "load_scalars": _with(SCALARS) + "SELECT run, tag, step, seq, value FROM scalars",
    "load_scalars_wide": _with(SCALARS) + "SELECT run, tag, step, value FROM scalars",
    "load_scalars_report": _with(SCALARS)
    + """SELECT run, count(*) + count(*) FILTER (WHERE step = 1) AS n_lines,
  count(*) FILTER (WHERE step = 1) AS n_rejected, 'ok' AS status FROM scalars GROUP BY run
UNION ALL SELECT 'run12', 0, 0, 'missing'""",
    "scalars_to_wide": _with(SCALARS, WIDE) + "SELECT * FROM wide",
    "scalars_to_long": _with(SCALARS) + "SELECT run, step, tag, value FROM scalars",
    "loss_curves": _with(SCALARS)
    + """SELECT run, CASE WHEN tag = 'train/loss' THEN 'train' ELSE 'validation' END AS curve,
  step, seq, value AS loss FROM scalars WHERE tag IN ('train/loss', 'eval/loss')
ORDER BY run, curve, step, seq""",
    "last_metric": _with(SCALARS)
    + """SELECT run, tag, max_by(value, (step, seq)) AS value FROM scalars
WHERE tag IN ('eval/rouge1', 'eval/rouge2', 'eval/rougeL') GROUP BY run, tag""",
    "gpu_mean": _with(SCALARS)
    + f"""SELECT run, {single("avg(value) FILTER (WHERE tag = 'gpu_memory_gb')")} AS gpu_avg
FROM scalars GROUP BY run""",
    "train_minutes": _with(SCALARS)
    + f"""SELECT run, {single(f"nullif({FIRST_SECONDS}, 0) / 60")} AS train_time_min
FROM scalars GROUP BY run""",
    "run_summary": _with(SCALARS, RUN_SUMMARY)
    + f"""SELECT run, rouge1, rouge2, "rougeL", {single("gpu_avg")} AS gpu_avg,
  {single("train_time_min")} AS train_time_min FROM summary""",
    "ema": _with(SCALARS)
    + f"""SELECT run, tag, step, {single("ema")} AS ema FROM (
  SELECT run, tag, unnest(range(1, len(v) + 1)) AS step,
         unnest(list_reduce(v[2:], lambda acc, x: list_append(acc, 0.3 * x[1] + 0.7 * acc[len(acc)]),
                            v[1])) AS ema
  FROM (SELECT run, tag, list([value] ORDER BY step) AS v FROM scalars GROUP BY run, tag))""",
    "valid_runs": _with(SCALARS)
    + """SELECT run, count(*) FILTER (WHERE tag = 'train/loss') AS n_train,
  count(*) FILTER (WHERE tag = 'eval/loss') AS n_eval
FROM scalars GROUP BY run HAVING n_train > 0 AND n_eval > 0""",
    "label_runs": _with(SCALARS, RUN_SUMMARY)
    + rf"""SELECT s.run, s.rouge1, l.data_size,
  CAST(nullif(regexp_extract(l.data_size, '(\d+)k$', 1), '') AS BIGINT) * 1000 AS size_rows,
  CASE WHEN starts_with(l.data_size, 't5') THEN 'teacher_forced'
       WHEN l.data_size IS NOT NULL THEN 'generated' END AS pred_kind
FROM summary s LEFT JOIN (VALUES {_values(bindings.RUN_LABELS)}) AS l(run, data_size)
  ON l.run = s.run""",
    "rouge_by_run": _with(SCALARS, RUN_SUMMARY)
    + """SELECT run, unnest(['rouge1', 'rouge2', 'rougeL']) AS metric,
  unnest([rouge1, rouge2, "rougeL"]) AS score FROM summary""",
    "best_checkpoint": _with(SCALARS)
    + """SELECT run, step AS best_step, value AS best_value FROM (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY value, step) AS rn
  FROM scalars WHERE tag = 'eval/loss') WHERE rn = 1""",
    "best_checkpoint_rouge": _with(SCALARS)
    + """SELECT run, step AS best_step, value AS best_value FROM (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY value DESC, step) AS rn
  FROM scalars WHERE tag = 'eval/rouge1') WHERE rn = 1""",
    "early_stop_step": _with(SCALARS, EVALS)
    + """SELECT run, min(step) FILTER (WHERE n - last >= 3) AS stop_step FROM (
  SELECT *, max(CASE WHEN best IS NULL OR value < best THEN n END)
    OVER (PARTITION BY run ORDER BY n) AS last FROM evals) GROUP BY run""",
    "keep_last_checkpoints": _with(SCALARS)
    + """SELECT run, step FROM (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS a,
         row_number() OVER (PARTITION BY run ORDER BY value, step) AS z
  FROM scalars WHERE tag = 'eval/loss') WHERE a <= 10 OR z = 1""",
    "sql_chunk_text": f"""
SELECT doc_id, i AS chunk_no, array_to_string(list_slice(w, i * 256 + 1, (i + 1) * 256), ' ') AS chunk
FROM (SELECT doc_id, w, unnest(range((len(w) + 255) // 256)) AS i
      FROM (SELECT doc_id, {words("text")} AS w FROM documents))""",
    "sql_functions": f"""
SELECT doc_id, len({words("text")}) AS n_words,
  array_to_string({ascii_terms("text")}, ' ') AS tokens,
  round(0.3e0 * length(source) + 0.7e0 * (0.3e0 * doc_id + 0.7e0 * n_chars), 4) AS smoothed
FROM documents""",
}
SQL["extract_body_nested"] = SQL["extract_body_flat"]
SQL["encode_pairs_joined"] = SQL["encode_pairs"]
SQL["decode_ids_joined"] = SQL["decode_ids"]
SQL["summarize_corpus"] = SQL["write_results_json"] = (
    _with(SUMMARIES)
    + f"""SELECT article_id, article AS original_text, {lead("article", 128)} AS summary,
  highlights AS original_summary FROM summaries"""
)
