"""The same results in SQL for another engine (DuckDB), one statement per query.

Written against the raw tables, apart from the tokeniser's rule table, which both sides
apply as a chain of replacements.
"""

from __future__ import annotations

from feedloom.functions.text import TOKEN_RULES
from feedloom.sources import standins as st

# The patterns are written out here again, on purpose: a wrong one in the library must show.
NOISE = r"@[^ ]+|http[^ ]+|www[^\n][^ ]+|#[^ ]+|[0-9]"
NOISE_AND_NEGATION = r"@[^ ]+|http[^ ]+|www[^\n][^ ]+|#[^ ]+|[0-9]|n't"
WORD = r"[\p{L}\p{N}_]{2,}"
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
OWN_HOSTS = ("twitter.com", "api.twitter.com")
SHORT_HOSTS = ("bit.ly", "buff.ly", "t.co")
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = r"https?://[A-Za-z0-9$%&'/.+\-]+"
KEEPS_PERIOD = (
    r"^(?:\.+|(?:\p{L}\.)+|(?i:mr|mrs|ms|dr|prof|rev|hon|gen|col|capt|lt|sgt|sen|rep|gov|pres|st|jr|sr|jan|feb|mar|apr|jun|jul|aug|sep|sept|"
    r"oct|nov|dec|inc|corp|co|ltd|bros|vs|etc|al|ed|vol|approx|dept|univ|ave|blvd)\.)\z"
)

ORACLES: dict[str, str] = {}


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(quote(v) for v in values)


def delete(expr: str, patterns) -> str:
    for pattern in patterns:
        expr = f"regexp_replace({expr}, {quote(pattern)}, '', 'g')"
    return expr


# --- table views -----------------------------------------------------------------------

MINUTES = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes"
POSTS = f"""posts AS (
  SELECT doc_id AS id, TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) AS "user", text AS full_text,
         {MINUTES}(n_chars) AS created_at, lang, CASE WHEN n_chars < 400 THEN doc_id END AS retweeted_status,
         n_chars AS favorite_count
  FROM documents)"""
LINKED = """linked AS (
  SELECT p.* REPLACE (CASE WHEN g.url IS NULL THEN p.full_text ELSE p.full_text || ' ' || g.url END AS full_text)
  FROM posts p LEFT JOIN pages g ON g.page_id = p.id)"""
PAGE_TEXT = "url || ' ' || html || ' https://www.google.com/amp/s/' || regexp_replace(url, '^https?://', '')"
PAGE_POSTS = f"""page_posts AS (
  SELECT page_id AS id, TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS "user", {PAGE_TEXT} AS full_text,
         CASE WHEN contains(url, 'utm_source') THEN page_id END AS retweeted_status,
         CASE WHEN contains(url, '#top') THEN page_id - 2 END AS quoted_status,
         CASE WHEN contains(url, '?page=2') THEN page_id - 1 END AS in_reply_to_status_id
  FROM pages)"""
TURNS = """turns AS (
  SELECT conv_id * 100 + turn AS id, conv_id, turn, role, text AS full_text,
         CASE WHEN role = 'system' THEN conv_id * 100 + turn END AS retweeted_status,
         CASE WHEN turn > 1 THEN conv_id * 100 END AS quoted_status,
         CASE WHEN turn > 0 THEN conv_id * 100 + turn - 1 END AS in_reply_to_status_id
  FROM conversations)"""
LIKES = "likes AS (SELECT event_id AS post_id, user_id FROM events WHERE event_type = 'view')"
REJECTED = "rejected AS (SELECT event_id AS id FROM events WHERE event_type = 'error')"
MUTED = f"muted AS (SELECT c_custkey AS id FROM customer WHERE c_mktsegment IN ({listed(st.MUTED_LISTS)}))"
FRIENDS = f"""friends AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS friend_id
  FROM events WHERE event_type = 'click' AND user_id = {st.OWNER})"""


def byte_score(key: str, position: int = 1) -> str:
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), {position}, 2) AS BIGINT) / 256::DOUBLE)"


SCORES = f"scores AS (SELECT doc_id AS id, {byte_score('doc_id')} AS predicted FROM labels)"
LOG = """seen_once AS (
  SELECT doc_id AS post_id, CASE WHEN quality = 1 THEN 'no_errors' ELSE 'not_found' END AS err_reason
  FROM labels WHERE toxic = 1),
log AS (SELECT * FROM seen_once UNION ALL SELECT * FROM seen_once)"""
POSITIVE = """positive AS (
  SELECT id FROM turns WHERE role <> 'assistant' AND (quoted_status IS NULL OR retweeted_status IS NULL)
  UNION SELECT post_id FROM likes)"""


def muted_words(text: str) -> str:
    folded = [f"contains(lower({text}), {quote(w.lower())})" for w in st.MUTE_WORDS]
    exact = [f"contains({text}, {quote(w)})" for w in st.MUTE_WORDS_CS]
    return "(" + " OR ".join(folded + exact) + ")"


def links_to(hosts) -> list[str]:
    return [f"{scheme}://{host.replace('.', chr(92) + '.')}/[^{SPACE}]+" for host in hosts for scheme in ("https", "http")]


WRAPPER = r"www\.google[^\n]com/amp/s/"


def short_links(text: str, hosts) -> str:
    return delete(text, [*links_to(hosts), WRAPPER])


def domain(url: str) -> str:
    host = f"replace(regexp_extract({url}, {quote(AUTHORITY)}, 1), 'www.', '')"
    parts = f"string_split({host}, '.')"
    return f"CASE WHEN len({parts}) > 2 AND {parts}[-1] = 'com' THEN array_to_string({parts}[2:], '.') ELSE {host} END"


def urls(text: str) -> str:
    return f"regexp_extract_all({text}, {quote(URL)})"


def domains(text: str) -> str:
    stripped = short_links(short_links(delete(text, links_to(OWN_HOSTS)), SHORT_HOSTS), SHORT_HOSTS)
    return f"list_filter(list_transform({urls(stripped)}, lambda u: {domain('u')}), lambda d: d <> '')"


def is_news(text: str) -> str:
    return f"list_has_any({domains(text)}, [{listed(st.NEWS_DOMAINS)}])"


def tokens(text: str) -> str:
    chain = f"' ' || {text} || ' '"
    for pattern, replacement in TOKEN_RULES:
        for group in "0123":
            replacement = replacement.replace(f"${group}", f"\\{group}")
        chain = f"regexp_replace({chain}, {quote(pattern)}, {quote(replacement)}, 'g')"
    parts = f"list_filter(string_split({chain}, ' '), lambda t: t <> '')"
    ends = f"t[-1] = '.' AND NOT regexp_matches(t, {quote(KEEPS_PERIOD)})"
    return f"flatten(list_transform({parts}, lambda t: CASE WHEN {ends} THEN [t[:-2], '.'] ELSE [t] END))"


def cleaned(text: str, noise: str = NOISE_AND_NEGATION, lead: bool = True) -> str:
    body = delete(f"lower({text})", [noise])
    if lead:
        body = f"regexp_replace({body}, '^[^a-zA-Z]*', '')"
    return f"array_to_string(list_filter({tokens(body)}, lambda t: length(t) > 1), ' ')"


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {quote(WORD)})"


BRIEF = 'id, "user", lang, favorite_count'


def posts_where(condition: str, *views: str) -> str:
    return f"WITH {', '.join([POSTS, *views])} SELECT {BRIEF} FROM posts p WHERE {condition}"


def post_ids(condition: str, *views: str) -> str:
    return f"WITH {', '.join([POSTS, *views])} SELECT id FROM posts p WHERE {condition}"


# --- scans, sources, sinks -------------------------------------------------------------

ORACLES["scan_posts"] = f"""WITH {POSTS}
SELECT id, "user", created_at, lang, retweeted_status, favorite_count FROM posts
WHERE created_at < TIMESTAMP '2024-01-02'"""
ORACLES["scan_likes"] = "SELECT event_id AS id, user_id FROM events WHERE event_type = 'view'"
ORACLES["reject_overflow"] = f"WITH {REJECTED} SELECT id FROM rejected WHERE (SELECT count(*) FROM rejected) > 180"
ORACLES["list_members"] = """SELECT c_mktsegment AS list_name, c_custkey AS id, c_name AS screen_name, c_mktsegment AS name
FROM customer"""
ORACLES["collection_ids"] = "SELECT event_id AS id FROM events WHERE event_type <> 'view'"
ORACLES["table_fingerprint"] = """WITH h AS (
  SELECT md5(concat_ws(chr(31), CAST(doc_id AS VARCHAR), text, lang, source, CAST(n_chars AS VARCHAR))) AS d FROM documents)
SELECT count(*) AS rows, bit_xor(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS content_xor,
       CAST(sum(CAST('0x' || substr(d, 17, 8) AS BIGINT)) AS VARCHAR) AS content_sum
FROM h"""

CELLS = "md5(concat_ws(chr(31), CAST(id AS VARCHAR), CAST(predicted AS VARCHAR)))"
ORACLES["version_diff"] = f"""WITH {SCORES}, placed AS (
  SELECT predicted, CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 256 AS bucket FROM scores)
SELECT CAST(bucket AS INTEGER) AS bucket, count(*) FILTER (predicted < 0.9) AS rows_before, count(*) AS rows_after
FROM placed GROUP BY 1 HAVING count(*) FILTER (predicted >= 0.9) > 0"""
ORACLES["version_root"] = f"""WITH {SCORES}, h AS (SELECT {CELLS} AS d FROM scores)
SELECT count(*) AS rows, bit_xor(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS content_xor,
       CAST(sum(CAST('0x' || substr(d, 17, 8) AS BIGINT)) AS VARCHAR) AS content_sum
FROM h"""

# --- filters ---------------------------------------------------------------------------

ORACLES["age_older"] = "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-08'"
ORACLES["age_newer"] = "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-08'"
ORACLES["no_reposts"] = posts_where("retweeted_status IS NULL")
ORACLES["lang_filter"] = posts_where("lang = 'en'")
ORACLES["likes_gt"] = posts_where("favorite_count > 1475")
ORACLES["likes_lt"] = posts_where("favorite_count < 1475")
ORACLES["mute_drop"] = post_ids(
    "NOT (" + " OR ".join(f"contains(lower(full_text), {quote(w.lower())})" for w in st.MUTE_WORDS) + ")"
)
ORACLES["mute_drop_cs"] = post_ids("NOT (" + " OR ".join(f"contains(full_text, {quote(w)})" for w in st.MUTE_WORDS_CS) + ")")
ORACLES["mute_any"] = post_ids(f"NOT {muted_words('full_text')}")
ORACLES["mute_matches"] = f"""WITH {POSTS}
SELECT p.id, w.word, false AS case_sensitive FROM posts p JOIN (SELECT unnest([{listed(st.MUTE_WORDS)}]) AS word) w
  ON contains(lower(p.full_text), lower(w.word))
UNION ALL
SELECT p.id, w.word, true FROM posts p JOIN (SELECT unnest([{listed(st.MUTE_WORDS_CS)}]) AS word) w
  ON contains(p.full_text, w.word)"""
LONG_WORDS = f"""words AS (
  SELECT c_name AS word FROM customer UNION SELECT split_part({domain('url')}, '.', 1) FROM pages)"""
ORACLES["mute_drop_long"] = f"""WITH {POSTS}, {LONG_WORDS}
SELECT id FROM posts p WHERE NOT EXISTS (SELECT 1 FROM words w WHERE contains(lower(p.full_text), lower(w.word)))"""
ORACLES["mute_matches_long"] = f"""WITH {POSTS}, {LONG_WORDS}
SELECT p.id, w.word FROM posts p JOIN words w ON contains(lower(p.full_text), lower(w.word))"""
ORACLES["news_filter"] = f"WITH {PAGE_POSTS} SELECT id FROM page_posts WHERE NOT {is_news('full_text')}"
ORACLES["author_exclude"] = posts_where('"user" NOT IN (3, 7, 11)')
ORACLES["author_include"] = posts_where('"user" IN (3, 7, 11)')
ORACLES["muted_author_ids"] = post_ids('EXISTS (SELECT 1 FROM muted m WHERE m.id = p."user")', MUTED)
ORACLES["friends_only"] = posts_where('EXISTS (SELECT 1 FROM friends f WHERE f.friend_id = p."user")', FRIENDS)
ORACLES["non_friends"] = posts_where('NOT EXISTS (SELECT 1 FROM friends f WHERE f.friend_id = p."user")', FRIENDS)
ORACLES["list_only"] = posts_where("""EXISTS (SELECT 1 FROM customer c WHERE c.c_mktsegment = 'BUILDING' AND c.c_custkey = p."user")""")
ORACLES["anti_liked"] = post_ids("NOT EXISTS (SELECT 1 FROM likes l WHERE l.post_id = p.id)", LIKES)
ORACLES["unscored"] = post_ids("NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = p.id)")

# --- joins, lookups, dedup -------------------------------------------------------------

ORACLES["anti_seen"] = post_ids("NOT EXISTS (SELECT 1 FROM log l WHERE l.post_id = p.id)", LOG)
ORACLES["score_join"] = f"""WITH {SCORES}
SELECT d.doc_id AS id, coalesce(s.predicted, 0.0::DOUBLE) AS preds FROM documents d LEFT JOIN scores s ON s.id = d.doc_id"""
ORACLES["score_join_dup_reset"] = f"""WITH {SCORES}, {LOG}, both_ AS (
  SELECT id, predicted FROM scores UNION ALL SELECT post_id, 0.5::DOUBLE FROM log),
dup AS (SELECT max(n) > 1 AS any_dup FROM (SELECT count(*) AS n FROM both_ GROUP BY id)),
one AS (SELECT id, max(predicted) AS predicted FROM both_ GROUP BY id)
SELECT d.doc_id AS id, CASE WHEN (SELECT any_dup FROM dup) THEN 0.0::DOUBLE ELSE coalesce(o.predicted, 0.0::DOUBLE) END AS preds
FROM documents d LEFT JOIN one o ON o.id = d.doc_id"""
ORACLES["score_upsert"] = f"""WITH fresh AS (
  SELECT doc_id AS id, {byte_score('doc_id', 3)} AS predicted FROM labels WHERE toxic = 1 OR quality = 0)
SELECT id, predicted FROM fresh
UNION ALL
SELECT doc_id, {byte_score('doc_id')} FROM labels WHERE quality = 1 AND doc_id NOT IN (SELECT id FROM fresh)"""
ORACLES["score_upsert_buckets"] = f"""SELECT doc_id AS id, CASE WHEN toxic = 1 THEN {byte_score('doc_id', 5)}
  WHEN quality = 0 THEN {byte_score('doc_id', 3)} ELSE {byte_score('doc_id')} END AS predicted
FROM labels WHERE quality IN (0, 1) OR toxic = 1"""
ORACLES["score_overwrite"] = f"""WITH {POSTS}, {LOG}
SELECT id, {byte_score('id', 5)} AS predicted FROM posts p
WHERE lang = 'en' AND retweeted_status IS NULL AND NOT EXISTS (SELECT 1 FROM log l WHERE l.post_id = p.id)"""
ORACLES["thread_text"] = f"""WITH {TURNS}
SELECT t.id, t.full_text || ' ' || coalesce(r.full_text, '') || ' ' || coalesce(q.full_text, '') AS full_text
FROM turns t LEFT JOIN turns r ON r.id = t.in_reply_to_status_id LEFT JOIN turns q ON q.id = t.quoted_status"""
ORACLES["seen_distinct"] = f"WITH {LOG} SELECT DISTINCT post_id, err_reason FROM log"

# --- id sets ---------------------------------------------------------------------------

NEWS_IDS = f"""news AS (
  SELECT t.id FROM page_posts t
  LEFT JOIN page_posts r ON r.id = t.in_reply_to_status_id LEFT JOIN page_posts q ON q.id = t.quoted_status
  WHERE t.retweeted_status IS NULL
    AND {is_news("(t.full_text || ' ' || coalesce(r.full_text, '') || ' ' || coalesce(q.full_text, ''))")})"""
ORACLES["news_ids"] = f"WITH {PAGE_POSTS}, {NEWS_IDS} SELECT id FROM news"
ORACLES["neg_ids"] = f"""WITH {PAGE_POSTS}, {NEWS_IDS}, {MUTED}, {REJECTED}
SELECT id, 'muted_word' AS reason FROM page_posts WHERE {muted_words('full_text')}
UNION SELECT id, 'muted_author' FROM page_posts p WHERE EXISTS (SELECT 1 FROM muted m WHERE m.id = p."user")
UNION SELECT id, 'news' FROM news
UNION SELECT id, 'rejected' FROM rejected"""
ORACLES["pos_ids"] = f"WITH {TURNS}, {LIKES}, {POSITIVE} SELECT id FROM positive"
ORACLES["pos_ids_intended"] = f"""WITH {TURNS}, {LIKES}
SELECT quoted_status AS id FROM turns WHERE role <> 'assistant' AND quoted_status IS NOT NULL
UNION SELECT retweeted_status FROM turns WHERE role <> 'assistant' AND retweeted_status IS NOT NULL
UNION SELECT post_id FROM likes"""
ORACLES["muted_members"] = f"WITH {MUTED} SELECT id FROM muted"
ORACLES["missing_ids"] = "SELECT doc_id AS id FROM documents EXCEPT SELECT doc_id FROM labels"
ORACLES["release_unseen"] = f"""WITH {SCORES}, {LOG}, batch AS (
  SELECT id AS post_id, position FROM (
    SELECT d.doc_id AS id, row_number() OVER (ORDER BY coalesce(s.predicted, 0) DESC, d.doc_id) AS position
    FROM documents d LEFT JOIN scores s ON s.id = d.doc_id) WHERE position <= 30),
all_ AS (SELECT post_id, err_reason FROM log UNION ALL SELECT post_id, 'no_errors' FROM batch)
SELECT post_id, err_reason FROM all_ a
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.position > 12 AND b.post_id = a.post_id)"""
ORACLES["label_set"] = f"""WITH {POSTS}, {PAGE_POSTS}, {NEWS_IDS}, {TURNS}, {LIKES}, {POSITIVE}, {MUTED}, {REJECTED}, negative AS (
  SELECT id FROM posts WHERE {muted_words('full_text')}
  UNION SELECT p.id FROM posts p JOIN muted m ON m.id = p."user"
  UNION SELECT id FROM news
  UNION SELECT id FROM rejected)
SELECT p.id, CASE WHEN p.id IN (SELECT id FROM positive) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS labels
FROM posts p
WHERE p.lang = 'en' AND (p.id IN (SELECT id FROM positive) OR p.id IN (SELECT id FROM negative))"""

# --- aggregations ----------------------------------------------------------------------

UNIT = "(CAST('0x' || substr(md5('1234:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296::DOUBLE)"
SPLIT = f"CASE WHEN {UNIT} < 0.7 THEN 'train' WHEN {UNIT} < 0.7::DOUBLE + (1.0::DOUBLE - 0.7::DOUBLE) / 2 THEN 'val' ELSE 'test' END"
ORACLES["delivery_outcomes"] = """SELECT CASE o_orderstatus WHEN 'O' THEN 'no_errors' WHEN 'F' THEN 'not_found' ELSE 'duplicate' END AS err_reason,
       count(*) AS n
FROM orders GROUP BY 1"""
ORACLES["lang_counts"] = "SELECT lang, count(*) AS n FROM documents GROUP BY lang"
ORACLES["label_counts"] = "SELECT quality AS label, count(*) AS n FROM labels GROUP BY quality"
ORACLES["class_balance"] = f"""SELECT {SPLIT} AS split, count(*) FILTER (quality = 0) AS n0, count(*) FILTER (quality = 1) AS n1,
       round(count(*) FILTER (quality = 1) / count(*), 6) AS ratio
FROM labels GROUP BY 1"""
ORACLES["positive_share"] = "SELECT round(avg(quality::DOUBLE), 6) AS positive_share FROM labels"
ORACLES["class_weights"] = """SELECT quality AS label, count(*) AS n,
       round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight
FROM labels GROUP BY quality"""
ORACLES["weight_grid"] = """WITH b AS (SELECT count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1) AS balanced FROM labels),
g AS (SELECT step, balanced - 5 + step * (20::DOUBLE / 59) AS ratio FROM b, (SELECT unnest(range(60)) AS step))
SELECT step, round(ratio, 6) AS ratio, round(1 / ratio, 6) AS weight_0, 1.0::DOUBLE AS weight_1 FROM g WHERE ratio > 0"""
ORACLES["collection_sizes"] = "SELECT user_id AS collection, count(*) AS n, count(*) >= 100 AS over FROM events GROUP BY user_id"

CLEAN_DOCS = f"""clean AS (
  SELECT l.doc_id AS id, l.quality AS label, {cleaned('d.text')} AS text
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""
WORDS = f"""words AS (
  SELECT id, label, list_filter({words('text')}, lambda w: w NOT IN ({listed(st.STOP_WORDS)})) AS w FROM clean)"""
GRAMS = "grams AS (" + " UNION ALL ".join(
    f"SELECT id, label, array_to_string(w[i:i + {n - 1}], ' ') AS term FROM (SELECT id, label, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM words)"
    for n in (1, 2, 3)
) + ")"
RANKED = "SELECT label, term, value, row_number() OVER (PARTITION BY label ORDER BY value DESC, term) AS rank FROM valued"
ORACLES["top_words"] = f"""WITH {CLEAN_DOCS}, valued AS (
  SELECT label, term, count(*) AS value
  FROM (SELECT label, unnest(string_split(text, ' ')) AS term FROM clean) WHERE term <> '' GROUP BY label, term)
SELECT * FROM ({RANKED}) WHERE rank <= 10"""
ORACLES["top_ngrams"] = f"""WITH {CLEAN_DOCS}, {WORDS}, {GRAMS}, valued AS (
  SELECT label, term, count(*) AS value FROM grams GROUP BY label, term)
SELECT * FROM ({RANKED}) WHERE rank <= 20"""
ORACLES["top_tfidf"] = f"""WITH {CLEAN_DOCS}, {WORDS}, {GRAMS},
tf AS (SELECT id, label, term, count(*) AS tf FROM grams GROUP BY id, label, term),
n AS (SELECT label, count(*) AS docs FROM words GROUP BY label),
df AS (SELECT label, term, count(*) AS df FROM tf GROUP BY label, term),
w AS (SELECT tf.id, tf.label, tf.term, tf.tf * (ln((1 + n.docs) / (1 + df.df)) + 1) AS w
      FROM tf JOIN df ON df.label = tf.label AND df.term = tf.term JOIN n ON n.label = tf.label),
norm AS (SELECT id, label, sqrt(sum(w * w)) AS len FROM w GROUP BY id, label),
valued AS (SELECT w.label, w.term, round(sum(w.w / norm.len), 6) AS value FROM w JOIN norm ON norm.id = w.id AND norm.label = w.label GROUP BY w.label, w.term)
SELECT * FROM ({RANKED}) WHERE rank <= 20"""
ORACLES["ngram_counts"] = f"""WITH {CLEAN_DOCS}, {WORDS}, {GRAMS}
SELECT id, term, count(*) AS n FROM grams GROUP BY id, term"""

JUDGED = f"judged AS (SELECT quality AS label, CAST({byte_score('doc_id')} >= 0.5 AS INTEGER) AS prediction FROM labels)"


def report(source: str, keys: str = "") -> str:
    """Per-class metrics of ``source(keys, label, prediction)``, as view ``report``."""
    lead = f"{keys}, " if keys else ""
    return f"""sides AS (
  SELECT {lead}label AS class, 1 AS support, 0 AS predicted, CASE WHEN label = prediction THEN 1 ELSE 0 END AS hits FROM {source}
  UNION ALL SELECT {lead}prediction, 0, 1, 0 FROM {source}),
sums AS (SELECT {lead}class, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM sides GROUP BY {lead}class),
rates AS (SELECT {lead}class, CAST(support AS BIGINT) AS support,
    CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall FROM sums),
report AS (SELECT {lead}class, precision, recall,
    CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1, support FROM rates)"""


CLASS_COLUMNS = "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report"
ORACLES["confusion"] = f"WITH {JUDGED} SELECT label, prediction, count(*) AS n FROM judged GROUP BY label, prediction"
ORACLES["class_report"] = f"WITH {JUDGED}, {report('judged')} {CLASS_COLUMNS}"
ORACLES["majority_baseline"] = f"""WITH top AS (
  SELECT quality AS prediction FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1),
judged AS (SELECT quality AS label, (SELECT prediction FROM top) AS prediction FROM labels), {report('judged')} {CLASS_COLUMNS}"""
ORACLES["split_hash"] = f"SELECT doc_id AS id, {SPLIT} AS split FROM documents"
ORACLES["fold_hash"] = """SELECT doc_id AS id, quality AS label, CAST((row_number() OVER (
    PARTITION BY quality ORDER BY md5('1234:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS INTEGER) AS fold
FROM labels"""

# --- runs ------------------------------------------------------------------------------

RUN_JUDGED = "run_judged AS (" + " UNION ALL ".join(
    f"SELECT {e}::BIGINT AS experiment_seq, 'exp{e}-{i}' AS run_id, quality AS label, "
    f"CAST({byte_score('doc_id', 2 * e + 1)} >= {t} AS INTEGER) AS prediction FROM labels"
    for e in range(3)
    for i, t in enumerate(st.THRESHOLDS)
) + ")"
RUNS = f"""{RUN_JUDGED}, {report('run_judged', 'experiment_seq, run_id')},
runs AS (SELECT experiment_seq, run_id,
    sum(precision * support) / sum(support) AS precision, sum(recall * support) / sum(support) AS recall,
    sum(f1 * support) / sum(support) AS f1,
    coalesce(max(precision) FILTER (class = 1), 0) AS precision_class1,
    coalesce(max(recall) FILTER (class = 1), 0) AS recall_class1,
    coalesce(max(f1) FILTER (class = 1), 0) AS f1_class1
  FROM report GROUP BY experiment_seq, run_id)"""
RUN_F1 = "SELECT run_id, round(f1_class1, 6) AS f1_class1 FROM runs"
ORACLES["runs_by_tag"] = f"WITH {RUNS} {RUN_F1} WHERE experiment_seq < 2"
POSITIONS = f"""WITH {SCORES}, scored AS (
  SELECT d.doc_id AS id, coalesce(s.predicted, 0.0::DOUBLE) AS preds FROM documents d LEFT JOIN scores s ON s.id = d.doc_id)
SELECT id, preds, row_number() OVER (ORDER BY preds DESC, id) AS position FROM scored"""
ORACLES["feed_positions"] = POSITIONS
ORACLES["feed_page"] = f"SELECT * FROM ({POSITIONS}) WHERE position BETWEEN 101 AND 150"
ORACLES["best_run"] = f"WITH {RUNS} {RUN_F1} WHERE experiment_seq = 1 ORDER BY runs.f1_class1 DESC, run_id LIMIT 1"
ORACLES["retrain_due"] = f"WITH {RUNS} {RUN_F1} WHERE runs.f1_class1 < 0.78"
ORACLES["runs_ordered"] = f"""WITH {RUNS} SELECT experiment_seq, run_id, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, round(precision_class1, 6) AS precision_class1, round(recall_class1, 6) AS recall_class1,
  round(f1_class1, 6) AS f1_class1 FROM runs ORDER BY experiment_seq, runs.f1_class1, run_id"""

# --- feed ------------------------------------------------------------------------------

BATCH = f"""batch AS (
  SELECT p.id, p."user", p.full_text, coalesce(s.predicted, 0.0::DOUBLE) AS preds
  FROM linked p LEFT JOIN scores s ON s.id = p.id
  WHERE p.retweeted_status IS NULL AND p.lang = 'en' AND p.favorite_count > 500
    AND NOT EXISTS (SELECT 1 FROM log l WHERE l.post_id = p.id)
    AND NOT {muted_words('p.full_text')} AND NOT {is_news('p.full_text')})"""
FEED = f"{POSTS}, {LINKED}, {SCORES}, {LOG}, {BATCH}"
ORACLES["feed_batch"] = f'WITH {FEED} SELECT id, "user", full_text, preds FROM batch'
ORACLES["top3_scores"] = f"""WITH {FEED}
SELECT preds, row_number() OVER (ORDER BY preds DESC, id) AS position FROM batch ORDER BY position LIMIT 3"""
ORACLES["feed_top_n"] = f"""WITH {FEED}, {MUTED}, {FRIENDS}, {LIKES}
SELECT id, "user", preds, row_number() OVER (ORDER BY preds DESC, id) AS position FROM batch b
WHERE "user" <> 17
  AND NOT EXISTS (SELECT 1 FROM muted m WHERE m.id = b."user")
  AND NOT EXISTS (SELECT 1 FROM friends f WHERE f.friend_id = b."user")
  AND NOT EXISTS (SELECT 1 FROM likes l WHERE l.post_id = b.id)
ORDER BY position LIMIT 30"""

# --- strings, arrays, values -----------------------------------------------------------

TEXTS = f"texts AS (SELECT page_id, url, {PAGE_TEXT} AS text FROM pages)"
ORACLES["extract_urls"] = f"WITH {TEXTS} SELECT page_id, unnest({urls('text')}) AS url FROM texts"
ORACLES["url_positions"] = f"""WITH {TEXTS}, found AS (SELECT page_id, {urls('text')} AS u FROM texts)
SELECT page_id, u[i] AS url, i AS position FROM (SELECT page_id, u, unnest(range(1, len(u) + 1)) AS i FROM found)"""
ORACLES["url_domains"] = f"WITH {TEXTS} SELECT page_id, unnest({domains('text')}) AS domain FROM texts"
ORACLES["url_stats"] = f"""WITH {TEXTS}, sized AS (SELECT len({domains('text')}) AS n FROM texts)
SELECT max(n) AS most, CAST(sum(n) AS BIGINT) AS total, count(*) FILTER (n > 0) AS posts_with_links FROM sized"""
ORACLES["clean_urls"] = """SELECT page_id,
  split_part(replace(replace(replace(replace('"' || url || ',)!"’s page', ',', ''), ')', ''), '"', ''), '!', ''), '’', 1) AS url
FROM pages"""
HOSTS = ("therha.example.com", "ththre.example.com", "spam-farm.example.org")
ORACLES["strip_host_urls"] = f"WITH {TEXTS} SELECT page_id, {delete('text', links_to(HOSTS))} AS text FROM texts"
ORACLES["strip_short_links"] = f"WITH {TEXTS} SELECT page_id, {short_links(short_links('text', HOSTS), HOSTS)} AS text FROM texts"
ORACLES["url_domain"] = f"SELECT page_id, {domain('url')} AS domain FROM pages"
ORACLES["drop_empty"] = """SELECT page_id, array_to_string(list_filter(string_split(url, '/'), lambda p: p <> ''), '|') AS parts
FROM pages"""
ORACLES["news_flag"] = f"WITH {TEXTS} SELECT page_id, CAST({is_news('text')} AS INTEGER) AS contains_news FROM texts"
ORACLES["news_flag_long"] = f"""WITH {TEXTS},
campaign AS (SELECT DISTINCT {domain('url')} AS domain FROM pages WHERE contains(url, 'utm_source')),
found AS (SELECT page_id, unnest({domains('text')}) AS domain FROM texts)
SELECT page_id, CAST(page_id IN (SELECT page_id FROM found JOIN campaign USING (domain)) AS INTEGER) AS contains_news FROM texts"""
ORACLES["clean_text"] = f"SELECT doc_id AS id, {cleaned('text')} AS text FROM documents"
ORACLES["clean_text_neg"] = f"""SELECT doc_id AS id, replace({cleaned('text', NOISE, lead=False)}, 'n''t', 'not') AS text
FROM documents"""
ORACLES["treebank_tokens"] = f"SELECT doc_id AS id, array_to_string({tokens('text')}, ' ') AS tokens FROM documents"
ORACLES["word_tokens"] = f"SELECT doc_id AS id, array_to_string({words('text')}, ' ') AS text FROM documents"
ORACLES["ids_csv"] = """SELECT conv_id, turn // 100 AS batch, string_agg(CAST(conv_id * 100 + turn AS VARCHAR), ',' ORDER BY turn) AS ids
FROM conversations GROUP BY conv_id, turn // 100"""
ORACLES["null_sentinel"] = f"""WITH {TURNS}
SELECT id, coalesce(CAST(in_reply_to_status_id AS VARCHAR), 'N/A') AS reply_text, coalesce(in_reply_to_status_id, 0) AS reply_id
FROM turns"""

# --- data quality ----------------------------------------------------------------------

ORACLES["dq_checks"] = f"""WITH {SCORES}, {LOG}, checked AS (
  SELECT id, predicted FROM scores UNION ALL SELECT post_id, 1.5::DOUBLE FROM log),
r AS (
  SELECT 'row_count_between' AS "check", '*' AS "column",
         CAST(CASE WHEN count(*) BETWEEN 29285 AND 99999 THEN 0 ELSE 1 END AS BIGINT) AS unexpected FROM checked
  UNION ALL SELECT 'values_between', 'predicted', count(*) FILTER (NOT predicted BETWEEN 0 AND 1) FROM checked
  UNION ALL SELECT 'values_unique', 'id', CAST(coalesce(sum(n), 0) AS BIGINT)
    FROM (SELECT count(*) AS n FROM checked GROUP BY id HAVING count(*) > 1))
SELECT "check", "column", unexpected = 0 AS success, unexpected FROM r"""
ORACLES["dq_schema"] = """SELECT 'column_exists' AS "check", c AS "column", c <> 'labels' AS success,
  CAST(CASE WHEN c = 'labels' THEN 1 ELSE 0 END AS BIGINT) AS unexpected, (SELECT count(*) FROM labels) AS rows_checked
FROM (SELECT unnest(['id', 'predicted', 'labels']) AS c)"""

# --- streaming -------------------------------------------------------------------------

ORACLES["stream_ingest"] = "SELECT event_id, ts, user_id, event_type FROM events"
ORACLES["stream_ingest_watermark"] = ORACLES["stream_ingest"]
ORACLES["stream_feed"] = f"""WITH {POSTS}, {LOG}
SELECT id AS post_id, 'no_errors' AS err_reason FROM posts p
WHERE lang = 'en' AND retweeted_status IS NULL AND NOT EXISTS (SELECT 1 FROM log l WHERE l.post_id = p.id)"""

ORACLES["stream_score"] = ORACLES["score_overwrite"]
ORACLES["stream_ingest_files"] = ORACLES["stream_ingest"]
ORACLES["stream_score_files"] = ORACLES["score_overwrite"]
ORACLES["stream_feed_files"] = ORACLES["stream_feed"]

# --- written and read back -------------------------------------------------------------

ORACLES["csv_log"] = f"WITH {LOG} SELECT post_id, err_reason FROM log"
ORACLES["csv_scores"] = f"WITH {SCORES} SELECT id, predicted FROM scores"
ORACLES["json_words"] = "SELECT DISTINCT c_name AS word FROM customer"
ORACLES["label_export_array"] = f"""WITH {POSTS}
SELECT id, full_text, created_at, CAST(quality AS DOUBLE) AS labels FROM posts JOIN labels ON doc_id = id"""
ORACLES["label_export_lines"] = ORACLES["label_export_array"]
ORACLES["member_dump"] = ORACLES["muted_members"]
ORACLES["log_append"] = f"""WITH {LOG}
SELECT post_id, err_reason, CAST(CASE WHEN err_reason = 'no_errors' THEN 0 ELSE 1 END AS BIGINT) AS batch_id FROM log"""
ORACLES["version_backup"] = f"""WITH {SCORES}
SELECT id, predicted, CAST(2 AS BIGINT) AS version FROM scores
UNION ALL SELECT id, predicted, 1 FROM scores WHERE predicted < 0.5"""
ORACLES["deliver_batch"] = f"""WITH {POSTS}, {SCORES}, ranked AS (
  SELECT p.id, row_number() OVER (ORDER BY coalesce(s.predicted, 0) DESC, p.id) - 1 AS place
  FROM posts p LEFT JOIN scores s ON s.id = p.id
  WHERE p.lang = 'en' AND p.retweeted_status IS NULL AND p."user" IS DISTINCT FROM 17 AND p.created_at < TIMESTAMP '2024-01-02 00:00:00')
SELECT id AS post_id, 'no_errors' AS err_reason, CAST(place // 10 AS BIGINT) AS batch_id FROM ranked WHERE place < 30"""

# --- learning: what is exact, and that each fit is optimal -------------------------------

TRAINED = f"trained AS (SELECT l.* FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE {SPLIT.replace('doc_id', 'l.doc_id')} = 'train')"
ORACLES["grid_certificate"] = f"""WITH {TRAINED},
b AS (SELECT count(*) AS rows, count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1) AS balanced FROM trained),
g AS (SELECT rows, balanced - 5 + step * (20::DOUBLE / 59) AS ratio FROM b, (SELECT unnest(range(60)) AS step))
SELECT round(ratio, 6) AS ratio, rows, true AS optimal FROM g WHERE ratio > 0"""
ORACLES["cv_certificate"] = f"""WITH {TRAINED}, numbered AS (
  SELECT quality, (row_number() OVER (PARTITION BY quality ORDER BY md5('1234:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS fold FROM trained),
w AS (SELECT step * (0.99 / 199) AS weight_0 FROM (SELECT unnest(range(200)) AS step)),
f AS (SELECT unnest(range(5)) AS fold)
SELECT round(weight_0, 6) AS weight_0, count(DISTINCT f.fold) AS fits, count(*) AS rows, true AS optimal
FROM w, f JOIN numbered n ON n.fold <> f.fold WHERE weight_0 > 0 OR quality = 1 GROUP BY 1"""
