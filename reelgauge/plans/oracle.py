"""The catalogue's queries as DuckDB SQL over the driver tables."""

from __future__ import annotations

import re

from reelgauge.functions.fixed import STOP_WORDS, WATCH_URL
from reelgauge.operators.entities import PATTERNS
from reelgauge.plans.catalog import (
    AS_OF,
    BRANDS,
    GAZETTEER,
    MERGE_CAP,
    NEGATIVE,
    NEW_START,
    NEWEST_CAP,
    OLD_END,
    PAGE,
    PAGE_VIDEO,
    PHRASE_POLARITY,
    PHRASES,
    POSITIVE,
    PRIORITY_PHRASES,
)


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "(" + ", ".join(_quoted(v) for v in values) + ")"


ISO = "%Y-%m-%dT%H:%M:%S.%fZ"
SPACE = r"[\s\x0b\x85\p{Z}]"

LEXICON = "lexicon(term, polarity) AS (VALUES {})".format(
    ", ".join([f"({_quoted(w)}, -1)" for w in NEGATIVE] + [f"({_quoted(w)}, 1)" for w in POSITIVE])
)


def _labelled(source: str) -> str:
    """CTEs ending in ``labelled`` for comments (video_key, arrival_seq, text)."""
    return f"""{LEXICON},
comments AS ({source}),
spoken AS (
  SELECT video_key, arrival_seq, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS term
  FROM comments),
scores AS (
  SELECT video_key, arrival_seq, sum(polarity) AS score FROM spoken JOIN lexicon USING (term)
  GROUP BY ALL),
labelled AS (
  SELECT c.video_key, c.arrival_seq, c.text,
    CASE WHEN c.text IS NULL OR c.text = '' THEN NULL WHEN coalesce(score, 0) > 0 THEN 'positive'
         WHEN coalesce(score, 0) < 0 THEN 'negative' ELSE 'neutral' END AS sentiment
  FROM comments c LEFT JOIN scores s
    ON c.video_key = s.video_key AND c.arrival_seq = s.arrival_seq)"""


DOCUMENTS = "SELECT source AS video_key, doc_id AS arrival_seq, text FROM documents"
CONVERSATIONS = (
    "SELECT conv_id::VARCHAR AS video_key, turn AS arrival_seq, text FROM conversations"
)

DISTRIBUTION = """SELECT video_key,
  sum(count(*)) OVER (PARTITION BY video_key)::BIGINT AS total_comments,
  sum(count(*)) OVER (PARTITION BY video_key)::BIGINT AS total_analyzed,
  sentiment, count(*) AS count,
  (count(*) / sum(count(*)) OVER (PARTITION BY video_key)) * 100 AS percentage,
  1.0::DOUBLE AS average_confidence
FROM labelled GROUP BY video_key, sentiment"""

EVENTS = f"""SELECT user_id::VARCHAR AS video_key, event_id AS arrival_seq, event_type AS author,
  props AS text, floor(value)::INTEGER AS like_count, strftime(ts, '{ISO}') AS published_at,
  strftime(ts, '%Y%m%d') AS snapshot FROM events"""

MERGED = "video_key, arrival_seq, author, published_at, like_count"

MERGE_CTES = f"""e AS ({EVENTS}),
listed AS (SELECT DISTINCT video_key FROM e WHERE like_count >= 200),
old_rows AS (SELECT * FROM e WHERE published_at < '{OLD_END}'),
new_rows AS (SELECT * FROM e WHERE published_at >= '{NEW_START}'),
marks AS (SELECT video_key, max(published_at) AS mark FROM old_rows GROUP BY 1),
fresh AS (
  SELECT n.*, row_number() OVER (
    PARTITION BY n.video_key ORDER BY n.published_at DESC, n.arrival_seq) AS r
  FROM new_rows n LEFT JOIN marks m USING (video_key)
  WHERE m.mark IS NULL OR n.published_at > m.mark)"""


def _merged(old: str, new: str) -> str:
    """History, then the new rows numbered on from each video's last arrival number."""
    return f"""old_part AS ({old}), new_part AS ({new}),
ends AS (SELECT video_key, max(arrival_seq) AS last_seq FROM old_part GROUP BY 1),
merged AS (
  SELECT {MERGED}, false AS is_new FROM old_part UNION ALL
  SELECT video_key, coalesce(last_seq + 1, 0) + row_number() OVER (
      PARTITION BY video_key ORDER BY arrival_seq) - 1,
    author, published_at, like_count, true
  FROM new_part LEFT JOIN ends USING (video_key))"""


def _tokens(source: str) -> str:
    return f"""comments AS ({source}),
tokens AS (
  SELECT video_key, arrival_seq, list_filter(
    string_split_regex(regexp_replace(text, '[^\\p{{L}}+\\s\\x0b\\x85\\p{{Z}}]+', '', 'g'),
      '{SPACE}+'),
    lambda t: t <> '' AND NOT list_contains([{", ".join(_quoted(w) for w in STOP_WORDS)}],
      lower(t))) AS tokens
  FROM comments)"""


TOKENS = _tokens(DOCUMENTS)


def _vocabulary(key: str) -> str:
    part = f"PARTITION BY {key}" if key else ""
    group = f"{key}, " if key else ""
    return f"""WITH {TOKENS},
flat AS (SELECT video_key, arrival_seq, unnest(tokens) AS term FROM tokens),
counted AS (
  SELECT {group}term, count(*) AS frequency,
    count(DISTINCT (video_key, arrival_seq)) AS documents FROM flat GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER ({part} ORDER BY frequency DESC, term) AS rank FROM counted
  WHERE documents >= 5)
SELECT {group}term, frequency, documents, rank::INTEGER AS rank FROM ranked WHERE rank <= 500"""


EITHER = "|".join(f"(?:{p})" for p in PATTERNS.values())
KIND = " ".join(f"WHEN regexp_full_match(hit, {_quoted(p)}) THEN '{n}'" for n, p in PATTERNS.items())
PATTERN_MENTIONS = f"""hits AS (
  SELECT source AS video_key, doc_id AS arrival_seq,
    regexp_extract_all(text, {_quoted(EITHER)}) AS found FROM documents),
numbered AS (
  SELECT video_key, arrival_seq, unnest(found) AS hit,
    unnest(range(len(found))) AS pos FROM hits),
mentions AS (
  SELECT video_key, arrival_seq, pos, lower(hit) AS text, CASE {KIND} END AS type
  FROM numbered)"""

GAZETTEER_MENTIONS = """gazetteer(term, type) AS (VALUES {}),
split_text AS (
  SELECT source AS video_key, doc_id AS arrival_seq, list_filter(string_split_regex(
    regexp_replace(text, '[^\\p{{L}}\\p{{N}}\\s\\x0b\\x85\\p{{Z}}]+', ' ', 'g'), '{}+'),
    lambda t: t <> '') AS t FROM documents),
numbered AS (
  SELECT video_key, arrival_seq, unnest(t) AS token, unnest(range(len(t))) AS pos FROM split_text),
mentions AS (
  SELECT video_key, arrival_seq, pos, lower(token) AS text, type
  FROM numbered JOIN gazetteer ON token = term)""".format(
    ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in GAZETTEER.items()), SPACE
)


def _longest(tokens: str, terms: dict[str, object]) -> str:
    """CTEs ending in ``chain``: the longest terms from left to right in ``words``, given by
    ``tokens`` (video_key, arrival_seq, t)."""
    rows = ", ".join(f"({_quoted(' '.join(re.findall(r'[^_0-9\W]+', k.lower())))}, {_quoted(str(v))})" for k, v in terms.items())
    return f"""words AS ({tokens}),
terms AS (SELECT term, value, len(string_split(term, ' ')) AS k FROM (VALUES {rows}) AS v(term, value)),
sizes AS (SELECT DISTINCT k FROM terms),
grams AS (
  SELECT video_key, arrival_seq, k, unnest(range(1, len(t) - k + 2)) AS spot, t FROM words, sizes
  WHERE len(t) >= k),
named AS (SELECT *, array_to_string(t[spot:spot + k - 1], ' ') AS term FROM grams),
hits AS (
  SELECT video_key, arrival_seq, spot, max(n.k) AS k, arg_max(value, n.k) AS value
  FROM named n JOIN terms x ON n.term = x.term GROUP BY ALL),
nexts AS (
  SELECT h.*, n.spot AS next FROM hits h ASOF LEFT JOIN hits n
    ON h.video_key = n.video_key AND h.arrival_seq = n.arrival_seq AND h.spot + h.k <= n.spot),
chain AS (
  SELECT n.* FROM nexts n JOIN (
    SELECT video_key, arrival_seq, min(spot) AS spot FROM hits GROUP BY ALL) f USING (video_key, arrival_seq, spot)
  UNION ALL
  SELECT n.* FROM chain c JOIN nexts n
    ON n.video_key = c.video_key AND n.arrival_seq = c.arrival_seq AND n.spot = c.next)"""


ENTITY_COUNTS = """counts AS (
  SELECT video_key, text, count(*) AS count, arg_max(type, (arrival_seq, pos)) AS type,
    min((arrival_seq, pos)) AS first_seen
  FROM mentions GROUP BY video_key, text)"""

TOP = """top_rows AS (
  SELECT video_key, row_number() OVER (
    PARTITION BY video_key ORDER BY count DESC, first_seen)::INTEGER AS rank, text, type, count
  FROM counts QUALIFY rank <= 10)"""

PARTS = """parts AS (
  SELECT p_partkey::VARCHAR AS video_id, p_name AS title, floor(p_retailprice)::BIGINT AS view_count,
    p_size::BIGINT AS like_count, p_brand AS channel_title, p_partkey AS arrival_seq,
    trim(split_part(lower(p_name), 'ring', 1)) AS movie_key
  FROM part)"""

BEST = """best AS (
  SELECT *, min(arrival_seq) OVER (PARTITION BY movie_key) AS first_seen,
    row_number() OVER (PARTITION BY movie_key ORDER BY view_count DESC, arrival_seq) AS r
  FROM {})"""

ORDERS = f"""o AS (
  SELECT o_orderkey::VARCHAR AS video_id, o_orderpriority AS title, o_orderkey AS arrival_seq,
    strftime(o_orderdate, '{ISO}') AS published_at, floor(o_totalprice)::BIGINT AS view_count
  FROM orders),
phrases(phrase) AS (VALUES {", ".join(f"({_quoted(p)})" for p in PRIORITY_PHRASES)})"""

SEARCHED = """SELECT p_partkey::VARCHAR AS video_id, lower(p_name) AS title,
  p_brand AS channel_title, floor(p_retailprice)::BIGINT AS view_count,
  CASE WHEN p_size > 10 THEN p_size ELSE 0 END::BIGINT AS like_count"""

LETTERS = """CASE WHEN contains(text, '!') THEN 'neutral'
  WHEN length(replace(text, 'e', '')) > length(replace(text, 'a', '')) THEN 'positive'
  ELSE 'negative' END"""

DAYS = f"""SELECT event_type AS author, props AS text, floor(value)::INTEGER AS like_count,
  strftime(ts, '{ISO}') AS published_at, strftime(ts, '%Y%m%d') AS video_key,
  '20240201_000000' AS snapshot"""

ORACLE: dict[str, str] = {
    "sentiment_labels": f"""WITH {_labelled(DOCUMENTS)}
SELECT video_key, arrival_seq, sentiment, 1.0::DOUBLE AS confidence FROM labelled""",
    "sentiment_distribution": f"WITH {_labelled(DOCUMENTS)}\n{DISTRIBUTION}",
    "sentiment_totals": f"""WITH {_labelled(DOCUMENTS)}
SELECT video_key, count(*) AS total_comments, count(sentiment) AS total_analyzed,
  1.0::DOUBLE AS average_confidence FROM labelled GROUP BY video_key""",
    "sentiment_summary": f"""WITH {_labelled(DOCUMENTS)}, d AS ({DISTRIBUTION})
SELECT video_key, sentiment,
  format('{{:,}}', count) || ' (' || printf('%.1f', percentage) || '%)' AS summary FROM d""",
    "sentiment_examples": f"""WITH {_labelled(DOCUMENTS)}
SELECT video_key, arg_min(text, arrival_seq) FILTER (sentiment = 'positive') AS positive,
  arg_min(text, arrival_seq) FILTER (sentiment = 'negative') AS negative,
  arg_min(text, arrival_seq) FILTER (sentiment = 'neutral') AS neutral
FROM labelled GROUP BY video_key""",
    "sentiment_by_conversation": f"WITH {_labelled(CONVERSATIONS)}\n{DISTRIBUTION}",
    "sentiment_vs_labels": f"""WITH {_labelled(DOCUMENTS)}
SELECT sentiment, toxic, count(*) AS comments
FROM labelled JOIN labels ON arrival_seq = doc_id GROUP BY sentiment, toxic""",
    "sentiment_hook": f"""SELECT source AS video_key, doc_id AS arrival_seq,
  CASE WHEN text <> '' THEN {LETTERS} END AS sentiment,
  CASE WHEN text <> '' THEN 1.0::DOUBLE END AS confidence FROM documents""",
    "sentiment_vector_hook": f"""WITH labelled AS (
  SELECT label::VARCHAR AS video_key, CASE WHEN embedding[1] > 0 THEN 'positive'
    WHEN embedding[2] > 0 THEN 'negative' ELSE 'neutral' END AS sentiment FROM embeddings)
{DISTRIBUTION}""",
    "videos_allowlist": f"""WITH {PARTS}
SELECT * EXCLUDE (movie_key) FROM parts WHERE channel_title IN {_list(BRANDS)}""",
    "videos_movie_key": f"WITH {PARTS} SELECT video_id, title, movie_key FROM parts",
    "videos_dedupe": f"""WITH {PARTS}, {BEST.format("parts")}
SELECT * EXCLUDE (r) FROM best WHERE r = 1""",
    "videos_top_n": f"""WITH {PARTS},
allowed AS (SELECT * FROM parts WHERE channel_title IN {_list(BRANDS)}), {BEST.format("allowed")}
SELECT * EXCLUDE (r) FROM best WHERE r = 1 ORDER BY view_count DESC, first_seen LIMIT 20""",
    "videos_recent_keyword": f"""WITH {ORDERS}
SELECT video_id, phrase, published_at, view_count FROM o JOIN phrases
  ON contains(lower(title), phrase)
WHERE published_at > strftime(TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY, '{ISO}')""",
    "videos_most_viewed_per_phrase": f"""WITH {ORDERS}
SELECT phrase, row_number() OVER (
  PARTITION BY phrase ORDER BY view_count DESC, arrival_seq)::INTEGER AS rank, video_id, view_count
FROM o JOIN phrases ON contains(lower(title), phrase) QUALIFY rank <= 50""",
    "video_key_sanitise": f"""SELECT page_id::VARCHAR AS video_id,
  replace(regexp_replace(url, '[^\\p{{L}}\\p{{N}}\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]', '', 'g'), ' ', '_')
    || '_' || page_id AS video_key, '{WATCH_URL}' || page_id AS video_url
FROM pages WHERE url <> ''""",
    "flatten_props": """SELECT event_id,
  coalesce((props->>'$.k')::BIGINT, 0) AS k, coalesce((props->>'$.missing')::BIGINT, 0) AS missing,
  '' AS missing_text, '{"k":' || (props->>'$.k') || '}' AS json FROM events""",
    "flatten_video_response": f"""{SEARCHED}, '' AS published_at, 0::BIGINT AS comment_count,
  '{WATCH_URL}' || p_partkey AS video_url FROM part""",
    "search_then_details": f"""{SEARCHED} FROM part
WHERE contains(lower(p_name), 'ring') OR contains(lower(p_name), 'hot')""",
    "flatten_thread_response": """WITH c AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id, turn // 5) AS n FROM conversations)
SELECT conv_id::VARCHAR AS video_id, role AS author, text, length(text)::INTEGER AS like_count,
  lpad(turn::VARCHAR, 6, '0') AS published_at FROM c WHERE n > 1""",
    "raw_thread_pages": """WITH c AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id, turn // 5) AS n FROM conversations)
SELECT conv_id::VARCHAR AS video_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS row_index,
  role AS author, text, lpad(turn::VARCHAR, 6, '0') AS published_at FROM c WHERE n > 1""",
    "failed_fetches": """SELECT DISTINCT conv_id::VARCHAR AS video_id FROM (
  SELECT conv_id, turn // 5, count(*) AS n FROM conversations GROUP BY ALL) WHERE n <= 1""",
    "high_water_mark": f"WITH {MERGE_CTES} SELECT * FROM marks",
    "incremental_merge": f"""WITH {MERGE_CTES},
{_merged("SELECT * FROM old_rows", f"SELECT * FROM fresh WHERE r <= {MERGE_CAP}")}
SELECT * FROM merged""",
    "merge_counts": f"""WITH {MERGE_CTES}, m AS (
  SELECT video_key, 0 AS is_new FROM old_rows UNION ALL
  SELECT video_key, 1 FROM fresh WHERE r <= {MERGE_CAP})
SELECT video_key, count(*) AS total_comments, sum(is_new)::BIGINT AS new_comments
FROM m GROUP BY video_key""",
    "merge_current_only": f"""WITH {MERGE_CTES},
{_merged("SELECT * FROM old_rows SEMI JOIN listed USING (video_key)",
         "SELECT * FROM fresh SEMI JOIN listed USING (video_key)")}
SELECT * FROM merged""",
    "merge_dropped": f"""WITH {MERGE_CTES}
SELECT {MERGED} FROM old_rows ANTI JOIN listed USING (video_key)""",
    "merge_failed_dropped": f"""WITH {MERGE_CTES},
carried AS (SELECT * FROM old_rows ANTI JOIN listed USING (video_key)),
carried_marks AS (SELECT video_key, max(published_at) AS mark FROM carried GROUP BY 1),
{_merged("SELECT * FROM carried",
         "SELECT * FROM new_rows LEFT JOIN carried_marks USING (video_key) "
         "WHERE mark IS NULL OR published_at > mark")}
SELECT * FROM merged""",
    "newest_cap": f"""WITH e AS ({EVENTS})
SELECT {MERGED} FROM e QUALIFY row_number() OVER (
  PARTITION BY video_key ORDER BY published_at DESC, arrival_seq) <= {NEWEST_CAP}""",
    "newest_comments": f"""WITH e AS ({EVENTS})
SELECT {MERGED} FROM e ORDER BY published_at DESC, arrival_seq LIMIT 100""",
    "row_index": f"""WITH e AS ({EVENTS})
SELECT video_key, arrival_seq,
  row_number() OVER (PARTITION BY video_key ORDER BY arrival_seq) - 1 AS row_index FROM e""",
    "index_page_lookup": f"""SELECT source AS video_key, doc_id AS arrival_seq, length(text)::INTEGER AS like_count,
  row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents WHERE source = '{PAGE_VIDEO}'
QUALIFY row_index >= {PAGE[0]} AND row_index < {sum(PAGE)}""",
    "comment_folders": """SELECT (conv_id % 16)::VARCHAR AS video_key, count(*) AS total_comments, count(*) AS numbers,
  sum(length(text))::BIGINT AS likes FROM conversations GROUP BY 1""",
    "video_metadata": f"""SELECT p_partkey::VARCHAR AS video_id, p_name AS title, floor(p_retailprice)::BIGINT AS view_count,
  p_size::BIGINT AS like_count, '{WATCH_URL}' || p_partkey AS video_url, p_brand AS channel_title
FROM part WHERE p_size >= 25""",
    "collected_videos": f"""WITH p AS (
  SELECT p_partkey::VARCHAR AS video_id, lower(p_name) AS title, p_brand AS channel_title,
    floor(p_retailprice)::BIGINT AS view_count, p_partkey,
    min(p_partkey) OVER (PARTITION BY lower(p_name)) AS first_seen,
    row_number() OVER (PARTITION BY lower(p_name) ORDER BY floor(p_retailprice) DESC, p_partkey) AS r
  FROM part WHERE p_brand IN {_list(BRANDS)} AND p_partkey % 4 <> 0
    AND (contains(lower(p_name), 'ring') OR contains(lower(p_name), 'hot')))
SELECT video_id, title, channel_title, view_count FROM p WHERE r = 1 ORDER BY view_count DESC, first_seen LIMIT 20""",
    "report_totals": """SELECT '2024-02-01 10:00:00' AS analysis_timestamp,
  count(DISTINCT source) AS total_videos_analyzed, 100::INTEGER AS batch_size FROM documents""",
    "empty_texts": """WITH t AS (
  SELECT source AS video_key, CASE WHEN length(text) >= 400 THEN text WHEN length(text) % 3 = 0 THEN NULL
    WHEN length(text) % 3 = 1 THEN '' ELSE '  ' END AS text FROM documents)
SELECT video_key, count(*) AS with_text, count_if(text = '  ')::BIGINT AS blank FROM t WHERE text <> '' GROUP BY 1""",
    "topic_coherence": f"""WITH v AS ({_vocabulary("video_key")}),
w AS (SELECT video_key, ((rank - 1) // 5)::INTEGER AS topic, term FROM v WHERE rank <= 10),
{_tokens(DOCUMENTS)},
d AS (SELECT video_key, arrival_seq, list_distinct(tokens) AS t FROM tokens WHERE len(tokens) > 0),
n AS (SELECT video_key, count(*) AS n FROM d GROUP BY 1),
flat AS (SELECT video_key, arrival_seq, unnest(t) AS term FROM d),
held AS (SELECT * FROM flat SEMI JOIN w USING (video_key, term)),
one AS (SELECT video_key, term, count(*) AS n FROM held GROUP BY ALL),
two AS (
  SELECT x.video_key, x.term AS a, y.term AS b, count(*) AS n FROM held x JOIN held y
    ON x.video_key = y.video_key AND x.arrival_seq = y.arrival_seq AND x.term < y.term GROUP BY ALL),
pairs AS (
  SELECT x.video_key, x.topic, x.term AS a, y.term AS b FROM w x JOIN w y
    ON x.video_key = y.video_key AND x.topic = y.topic AND x.term < y.term),
rated AS (
  SELECT p.video_key, p.topic, CASE WHEN two.n IS NULL THEN -1.0::DOUBLE WHEN two.n = n.n THEN 1.0::DOUBLE
    ELSE ln((two.n * n.n)::DOUBLE / (x.n * y.n)) / -ln(two.n::DOUBLE / n.n) END AS npmi
  FROM pairs p JOIN n USING (video_key) JOIN one x ON x.video_key = p.video_key AND x.term = p.a
    JOIN one y ON y.video_key = p.video_key AND y.term = p.b
    LEFT JOIN two ON two.video_key = p.video_key AND two.a = p.a AND two.b = p.b)
SELECT video_key, topic, round(avg(npmi), 6) AS coherence, count(*) AS pairs FROM rated GROUP BY ALL""",
    "row_index_page": f"""WITH e AS ({EVENTS})
SELECT video_key, arrival_seq,
  row_number() OVER (PARTITION BY video_key ORDER BY arrival_seq) - 1 AS row_index FROM e
QUALIFY row_index >= 10 AND row_index < 30""",
    "latest_snapshot": f"""WITH e AS ({EVENTS})
SELECT snapshot, {MERGED} FROM e WHERE snapshot = (SELECT max(snapshot) FROM e)""",
    "pinned_snapshot": f"""WITH e AS ({EVENTS})
SELECT snapshot, {MERGED} FROM e WHERE snapshot = '20240108'""",
    "keep_latest": f"""WITH e AS ({EVENTS})
SELECT snapshot, {MERGED} FROM e
WHERE snapshot IN (SELECT DISTINCT snapshot FROM e ORDER BY 1 DESC LIMIT 3)""",
    "clean_tokens": f"""WITH {TOKENS}
SELECT video_key, arrival_seq, len(tokens) AS tokens, array_to_string(tokens, ' ') AS joined
FROM tokens WHERE len(tokens) > 0""",
    "shrunk_text": f"""SELECT doc_id AS arrival_seq,
  trim(regexp_replace(text, '{SPACE}+', ' ', 'g')) AS text FROM documents""",
    "vocabulary": _vocabulary(""),
    "vocabulary_by_video": _vocabulary("video_key"),
    "vocabulary_size": f"""WITH v AS ({_vocabulary("video_key")})
SELECT video_key, count(*) AS vocabulary_size FROM v GROUP BY video_key""",
    "entity_pattern": f"WITH {PATTERN_MENTIONS} SELECT * FROM mentions",
    "entity_gazetteer": f"WITH {GAZETTEER_MENTIONS} SELECT * FROM mentions",
    "entity_phrases": f"""WITH RECURSIVE {_longest(f"""SELECT source AS video_key, doc_id AS arrival_seq,
    list_filter(string_split_regex(lower(regexp_replace(
      text, '[^\\p{{L}}\\p{{N}}\\s\\x0b\\x85\\p{{Z}}]+', ' ', 'g')), '{SPACE}+'), lambda t: t <> '') AS t
  FROM documents""", PHRASES)},
flat AS (SELECT video_key, arrival_seq, spot, value, unnest(range(k)) AS i FROM chain)
SELECT video_key, arrival_seq, spot - 1 + i AS pos, t[spot + i] AS text, value AS type
FROM flat JOIN words USING (video_key, arrival_seq)""",
    "sentence_embedding_shape": f"""SELECT source AS video_key, doc_id AS arrival_seq, 32 AS width,
  len(list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}]+'),
    lambda t: t <> '' AND NOT list_contains([{", ".join(_quoted(w) for w in STOP_WORDS)}], t))) = 0 AS is_zero
FROM documents""",
    "sentiment_phrases": f"""WITH RECURSIVE {_longest("""SELECT source AS video_key, doc_id AS arrival_seq,
    list_filter(string_split_regex(lower(text), '[^\\p{L}]+'), lambda t: t <> '') AS t FROM documents""", PHRASE_POLARITY)},
scores AS (SELECT video_key, arrival_seq, sum(value::INT) AS score FROM chain GROUP BY ALL)
SELECT d.source AS video_key, d.doc_id AS arrival_seq,
  CASE WHEN d.text IS NULL OR d.text = '' THEN NULL WHEN coalesce(score, 0) > 0 THEN 'positive'
       WHEN coalesce(score, 0) < 0 THEN 'negative' ELSE 'neutral' END AS sentiment, 1.0::DOUBLE AS confidence
FROM documents d LEFT JOIN scores s ON s.video_key = d.source AND s.arrival_seq = d.doc_id""",
    "bio_flatten": f"""WITH s AS (
  SELECT source AS video_key, doc_id AS arrival_seq, list_filter(string_split_regex(
    text, '{SPACE}+'), lambda t: t <> '') AS t FROM documents),
n AS (
  SELECT video_key, arrival_seq, len(t) AS size, unnest(t) AS token, unnest(range(len(t))) AS pos
  FROM s),
tagged AS (
  SELECT *, CASE WHEN regexp_matches(token, '[0-9]') THEN 'NUM'
    WHEN regexp_matches(token, '^\\p{{Lu}}') THEN 'CAP'
    WHEN suffix(token, '.') THEN 'END' END AS type FROM n WHERE pos < size - 1)
SELECT video_key, arrival_seq, pos, lower(token) AS text, type FROM tagged
WHERE type IS NOT NULL""",
    "entity_frequency": f"""WITH {GAZETTEER_MENTIONS}, {ENTITY_COUNTS}
SELECT video_key, text, type, count FROM counts""",
    "top_entities": f"""WITH {GAZETTEER_MENTIONS}, {ENTITY_COUNTS}, {TOP}
SELECT * FROM top_rows""",
    "entities_by_type": f"""WITH {GAZETTEER_MENTIONS}, {ENTITY_COUNTS}, {TOP}
SELECT video_key, type,
  (row_number() OVER (PARTITION BY video_key, type ORDER BY rank) - 1)::INTEGER AS place, text, count
FROM top_rows""",
    "entity_totals": f"""WITH {PATTERN_MENTIONS},
m AS (SELECT video_key, count(*) AS n FROM mentions GROUP BY 1)
SELECT source AS video_key, count(*) AS total_comments, count(*) AS processed_comments,
  coalesce(any_value(n), 0)::BIGINT AS total_entities
FROM documents LEFT JOIN m ON source = m.video_key GROUP BY source""",
    "entity_hook": """WITH s AS (
  SELECT source AS video_key, doc_id AS arrival_seq,
    regexp_split_to_array(text, '[ \\t\\n\\r]+') AS t FROM documents WHERE text <> ''),
n AS (
  SELECT video_key, arrival_seq, unnest(t) AS text, unnest(range(len(t))) AS pos FROM s)
SELECT video_key, arrival_seq, pos, text, 'NUM' AS type FROM n
WHERE regexp_full_match(text, '[0-9]+')""",
    "topics_skipped": f"""WITH {_tokens(CONVERSATIONS)},
flat AS (SELECT video_key, arrival_seq, unnest(tokens) AS term FROM tokens),
frequent AS (
  SELECT video_key, term FROM flat GROUP BY ALL HAVING count(DISTINCT arrival_seq) >= 5),
sizes AS (SELECT video_key, count_if(len(tokens) > 0) AS n FROM tokens GROUP BY 1)
SELECT video_key, CASE WHEN n = 0 THEN 'no tokens' ELSE 'no frequent term' END AS reason
FROM sizes ANTI JOIN frequent USING (video_key)""",
    "single_video": """SELECT source AS video_key, doc_id, lang, n_chars FROM documents
WHERE source = 'src7'""",
    "report_json": f"""WITH {_labelled(DOCUMENTS)}, d AS ({DISTRIBUTION}),
shares AS (
  SELECT video_key, any_value(total_comments) AS total,
    MAP(list(sentiment ORDER BY sentiment),
        list({{'count': count, 'percentage': percentage}} ORDER BY sentiment)) AS m
  FROM d GROUP BY video_key),
examples AS (
  SELECT video_key, arg_min(text, arrival_seq) FILTER (sentiment = 'positive') AS positive,
    arg_min(text, arrival_seq) FILTER (sentiment = 'negative') AS negative,
    arg_min(text, arrival_seq) FILTER (sentiment = 'neutral') AS neutral
  FROM labelled GROUP BY video_key)
SELECT video_key, to_json({{'total_comments': total, 'sentiment_stats': {{
    'total_analyzed': total, 'sentiment_distribution': m, 'average_confidence': 1.0::DOUBLE}},
  'sentiment_examples': {{
    'positive': positive, 'negative': negative, 'neutral': neutral}}}})::VARCHAR AS report
FROM shares JOIN examples USING (video_key)""",
    "entity_report_json": f"""WITH {GAZETTEER_MENTIONS}, {ENTITY_COUNTS}, {TOP},
per_type AS (
  SELECT video_key, type, list({{'text': text, 'count': count}} ORDER BY rank) AS items
  FROM top_rows GROUP BY ALL),
typed AS (
  SELECT video_key, MAP(list(type ORDER BY type), list(items ORDER BY type)) AS m
  FROM per_type GROUP BY 1),
listed AS (
  SELECT video_key, list({{'text': text, 'type': type, 'count': count}} ORDER BY rank) AS l
  FROM top_rows GROUP BY 1),
totals AS (SELECT video_key, sum(count)::BIGINT AS n FROM counts GROUP BY 1),
sizes AS (SELECT source AS video_key, count(*) AS total FROM documents GROUP BY 1)
SELECT video_key, to_json({{'total_comments': total, 'processed_comments': total,
  'total_entities': n, 'top_entities': l, 'entities_by_type': m}})::VARCHAR AS report
FROM sizes JOIN totals USING (video_key) JOIN typed USING (video_key)
JOIN listed USING (video_key)""",
    "leaderboard": f"""WITH {_labelled(DOCUMENTS)},
counts AS (SELECT video_key, sentiment, count(*) AS n FROM labelled GROUP BY ALL),
dominant AS (
  SELECT video_key, sentiment FROM counts
  QUALIFY row_number() OVER (PARTITION BY video_key ORDER BY n DESC, sentiment) = 1),
{PARTS}
SELECT 'src' || video_id AS video_key, title, format('{{:,}}', view_count) AS views,
  format('{{:,}}', like_count) AS likes, sentiment, view_count, like_count
FROM parts LEFT JOIN dominant ON video_key = 'src' || video_id""",
    "leaderboard_search": f"""WITH {PARTS}
SELECT video_id, title, like_count FROM parts WHERE contains(lower(title), 'hot r')""",
    "video_totals": """SELECT count(*) AS total_comments, count(DISTINCT source) AS total_videos
FROM documents""",
    "time_labels": f"""SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS run_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS report_time,
  strftime(ts - INTERVAL 90 DAY, '{ISO}') AS since FROM events""",
    "json_roundtrip": f"{DAYS} FROM events",
    "merge_at_mark": f"""WITH e AS (
  SELECT * REPLACE (published_at[1:13] || ':00:00Z' AS published_at) FROM ({EVENTS})),
old_rows AS (
  SELECT * FROM e WHERE published_at < '{OLD_END}' AND (arrival_seq % 5 <> 0 OR published_at < '{NEW_START}')),
new_rows AS (SELECT * FROM e WHERE published_at >= '{NEW_START}'),
marks AS (SELECT video_key, max(published_at) AS mark FROM old_rows GROUP BY 1),
held AS (
  SELECT video_key, author, text, count(*) AS n FROM old_rows JOIN marks USING (video_key)
  WHERE published_at = mark GROUP BY ALL),
equal AS (
  SELECT n.*, row_number() OVER (PARTITION BY video_key, author, text ORDER BY arrival_seq) AS nth
  FROM new_rows n JOIN marks USING (video_key) WHERE published_at = mark),
fresh AS (
  SELECT n.* FROM new_rows n LEFT JOIN marks USING (video_key) WHERE mark IS NULL OR published_at > mark
  UNION ALL
  SELECT * EXCLUDE (nth, n) FROM equal LEFT JOIN (SELECT video_key, author, text, n FROM held)
    USING (video_key, author, text) WHERE nth > coalesce(n, 0)),
{_merged("SELECT * FROM old_rows", "SELECT * FROM fresh")}
SELECT * REPLACE (false AS is_new) FROM merged""",
    "snapshot_parts": f"""WITH e AS ({EVENTS})
SELECT '20240103_000000' AS snapshot, {MERGED} FROM e
WHERE published_at >= '{NEW_START}' OR video_key NOT IN (SELECT video_key FROM e WHERE like_count >= 200)""",
    "ingest_then_read": DAYS.replace("'20240201_000000'", "'current'") + " FROM events",
    "ingest_in_two_runs": f"""{DAYS},
  (strftime(ts, '%Y%m%d') >= '20240116')::BIGINT AS batch_id FROM events""",
}
