"""The same queries in plain SQL, for comparison on a second engine."""

from __future__ import annotations

from faqspark import fixtures as fx
from faqspark.functions import privacy as P, verdicts as V
from faqspark.functions.text import WHITE

FIRST, SECOND = fx.FIRST_FETCH, fx.SECOND_FETCH
RUN_AT = "2024-08-16T02:00:00Z"
AS_OF = "2024-08-13 06:00:00"
DAY = "course_id, year, month, day"
THREAD = "course_id, channel_id, thread_key"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- expressions ---------------------------------------------------------------------------


def mask(expr: str) -> str:
    out = f"regexp_replace({expr}, {lit(P.FILE_URL)}, '', 'g')"
    for pattern, label in P.MASKS:
        out = f"regexp_replace({out}, {lit(pattern)}, {lit(label)}, 'g')"
    return out


def scrub(expr: str) -> str:
    parts = f"string_split({expr}, '```')"
    return (
        f"array_to_string(list_transform({parts}, lambda part, i: "
        f"CASE WHEN i % 2 = 1 OR i = len({parts}) THEN {mask('part')} ELSE part END), '```')"
    )


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {lit(f'^[{WHITE}]+|[{WHITE}]+$')}, '', 'g')"


def words(expr: str) -> str:
    spaced = rf"regexp_replace(lower({expr}), '([\p{{Han}}\p{{Hiragana}}\p{{Katakana}}])', ' \1 ', 'g')"
    return rf"list_filter(string_split_regex({spaced}, '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda w: w <> '')"


def title(expr: str) -> str:
    parts = f"list_filter(string_split_regex({expr}, '[ \\t\\r\\n]+'), lambda w: w <> '')"
    return f"array_to_string({parts}[1:{V.TITLE_WORDS}], ' ')"


def found(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {lit(pattern)})"


def kind(low: str) -> str:
    cases = " ".join(f"WHEN {found(low, cue)} THEN {lit(name)}" for name, cue in V.TYPE_CUES)
    return f"CASE {cases} ELSE 'other' END"


def rule(text: str, role: str | None) -> str:
    low = f"lower({text})"
    bot = f"WHEN {role} = 'system' THEN 1 " if role else ""
    return (
        f"CASE {bot}WHEN contains({text}, '?') AND {found(low, V.ASK_START)} THEN 2 "
        f"WHEN contains({text}, '?') THEN 3 WHEN {found(low, V.SMALL_TALK)} THEN 4 "
        f"WHEN {found(low, V.ASK_START)} THEN 5 WHEN {found(low, V.IMPLICIT)} THEN 6 ELSE 0 END"
    )


def verdicts(source: str, text: str = "text", role: str | None = "role") -> str:
    """All columns of ``source`` plus the verdict columns of the rule model."""
    number = {i: r for i, r in enumerate(V.RULES)}
    pick = [
        "CASE rule " + " ".join(f"WHEN {i} THEN {show(r)}" for i, r in number.items()) + " END"
        for show in (
            lambda r: str(r[0]).lower(), lambda r: f"{r[1]}::DOUBLE", lambda r: lit(r[2])
        )
    ]
    return f"""SELECT * EXCLUDE (rule, asks), asks AS is_question,
        CASE WHEN asks THEN {kind(f'lower({text})')} ELSE 'other' END AS question_type,
        {pick[1]} AS confidence, CASE WHEN asks THEN {title(text)} END AS title, {pick[2]} AS reason,
        {lit(V.MODEL)} AS llm_model, 0 AS latency_ms
      FROM (SELECT *, {pick[0]} AS asks FROM (SELECT *, {rule(text, role)} AS rule FROM {source}))"""


CODE = "('0x' || substr(md5(w), 1, 9))::BIGINT"


def dense(source: str, key: str) -> str:
    """Long form of the unit vectors of ``source`` (key, text): key, bucket, value (float)."""
    return f"""SELECT {key}, bucket, (n / sqrt(sum(n * n) OVER (PARTITION BY {key})))::FLOAT AS value
      FROM (SELECT {key}, (c >> 4) & 63 AS bucket, sum(1 - 2 * (c & 1))::DOUBLE AS n
            FROM (SELECT {key}, {CODE} AS c FROM (SELECT {key}, unnest({words('text')}) AS w FROM {source}))
            GROUP BY ALL HAVING sum(1 - 2 * (c & 1)) <> 0)"""


def packed(source: str, key: str) -> str:
    """The same vectors as one list of 64 numbers per key; needs the table ``{source}_d``."""
    return f"""SELECT {key}, list(coalesce(value, 0)::DOUBLE ORDER BY b) AS v
      FROM (SELECT {key}, b FROM {source}, range(64) r(b)) LEFT JOIN
        (SELECT {key}, bucket AS b, value FROM {source}_d) USING ({key}, b) GROUP BY {key}"""


def sparse(source: str, key: str) -> str:
    """Long form of the term weights ``ln(1 + tf)`` of ``source`` (key, text): key, idx, tfw."""
    return f"""SELECT {key}, (({CODE}) >> 4) & 1048575 AS idx, ln(1 + count(*)::DOUBLE) AS tfw
      FROM (SELECT {key}, unnest({words('text')}) AS w FROM {source}) GROUP BY ALL"""


def idf(points: str, key: str = "id") -> str:
    """Needs the term table ``{points}_s`` and the point table ``points``."""
    return f"""SELECT idx, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf
      FROM (SELECT idx, count(*)::DOUBLE AS df FROM {points}_s GROUP BY idx),
           (SELECT count(*)::DOUBLE AS n FROM {points})"""


# --- shared tables -------------------------------------------------------------------------

TABLES = {
    "m": f"""SELECT concat('C', cast(100 + conv_id % 5 AS VARCHAR)) AS channel_id,
        CASE WHEN conv_id % 50 = 49 AND turn = 1 THEN 'bad'
             ELSE concat(cast({fx.EPOCH} + conv_id * 900 + turn * 4000 AS VARCHAR), '.',
                         lpad(cast(turn AS VARCHAR), 6, '0')) END AS ts,
        CASE WHEN conv_id % 7 = 6 AND turn = 0 THEN NULL
             ELSE concat(cast({fx.EPOCH} + conv_id * 900 AS VARCHAR), '.000000') END AS thread_ts,
        concat('U', lpad(cast((conv_id * 7 + turn) % 50 AS VARCHAR), 4, '0')) AS user_id, role,
        concat(text, CASE (conv_id * 8 + turn) % 6
            WHEN 0 THEN ' <@U0001>' WHEN 1 THEN ' <#C42|general>'
            WHEN 2 THEN ' https://x.example.com/a?b=1' WHEN 3 THEN ' me.7@mail.example.com'
            WHEN 4 THEN ' +1 (555) 555-0100' ELSE ' ```a@b.co```' END,
          CASE WHEN (conv_id + turn) % 3 = 0 THEN ' How do I fix it?' ELSE '' END) AS text,
        fetched_at
      FROM conversations
      JOIN (VALUES ({lit(FIRST)}, 1), ({lit(SECOND)}, 10)) f(fetched_at, k) ON conv_id % f.k = 0""",
    "courses": """SELECT * FROM (VALUES ('course-0', 'C100'), ('course-1', 'C101'), ('course-2', 'C102'),
        ('course-3', 'C103'), ('course-4', 'C104'), ('course-4', 'C199')) c(course_id, channel_id)""",
    "parsed": """SELECT *, strftime(event_ts, '%Y') AS year, strftime(event_ts, '%m') AS month,
        strftime(event_ts, '%d') AS day
      FROM (SELECT m.*, course_id,
              make_timestamp(cast(try_cast(ts AS DECIMAL(20,6)) * 1000000 AS BIGINT)) AS event_ts
            FROM m JOIN courses USING (channel_id))""",
    "enriched": "SELECT * FROM parsed WHERE event_ts IS NOT NULL",
    "stored": """SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (
        PARTITION BY channel_id, ts ORDER BY fetched_at DESC) AS n FROM enriched) WHERE n = 1""",
    "threaded": """SELECT *, coalesce(thread_ts, ts) AS thread_key, coalesce(thread_ts, ts) = ts AS is_head
      FROM stored""",
    "masked": f"SELECT * REPLACE ({scrub('text')} AS text) FROM stored",
    "verdicted": verdicts("masked"),
    "heads": f"SELECT * REPLACE ({scrub('text')} AS text), sha256(text) AS original FROM threaded WHERE is_head",
    "judged_heads": verdicts("heads"),
    "replies": "SELECT * FROM threaded WHERE NOT is_head",
    "same_day": f"""SELECT r.* FROM replies r JOIN (SELECT {THREAD}, event_ts AS head_ts FROM threaded WHERE is_head) h
        USING ({THREAD}) WHERE r.event_ts::DATE = head_ts::DATE""",
    "courses_faq": """SELECT 'faq-' || i AS google_doc_id, 'course-' || i AS course_id, 'Course ' || i AS course_name,
        'faq_c' || i AS collection FROM range(4) t(i)""",
    "blocks": f"""SELECT doc_id, pos, {strip('line')} AS text,
        CASE WHEN pos % 12 IN (4, 10) THEN 'HEADING_1' WHEN pos % 4 = 1 THEN 'HEADING_2'
             WHEN pos % 4 = 3 THEN 'HEADING_3' ELSE 'NORMAL_TEXT' END AS style
      FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
              unnest(string_split(text, chr(10))) AS line FROM documents)""",
    "running": """SELECT *,
        last_value(CASE WHEN style = 'HEADING_1' THEN text END IGNORE NULLS) OVER w AS section,
        sum(CASE WHEN style = 'HEADING_2' THEN 1 ELSE 0 END) OVER w AS chunk_no
      FROM blocks WHERE text <> ''
      WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "raw_chunks": """SELECT doc_id, chunk_no::BIGINT AS chunk_no,
        coalesce(max(section) FILTER (WHERE style = 'HEADING_2'), '') AS section,
        max(text) FILTER (WHERE style = 'HEADING_2') AS question,
        string_agg(text, chr(10) ORDER BY pos) FILTER (WHERE style NOT IN ('HEADING_1', 'HEADING_2')) AS answer
      FROM running WHERE chunk_no > 0 GROUP BY doc_id, chunk_no""",
    "chunks": """SELECT c.*, course_id, course_name, collection
      FROM raw_chunks c JOIN courses_faq f ON f.google_doc_id = 'faq-' || (c.doc_id % 4)
      WHERE answer <> ''""",
    "keyed": """SELECT *, course_id || '_' || substr(sha256(text), 1, 8) AS id
      FROM (SELECT *, question || chr(10) || answer AS text FROM chunks)""",
    "points": """SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (
        PARTITION BY id ORDER BY doc_id DESC, chunk_no DESC) AS n FROM keyed) WHERE n = 1""",
    "points_s": sparse("points", "id"),
    "points_d": dense("points", "id"),
    "points_v": packed("points", "id"),
    "points_idf": idf("points"),
    "x": "SELECT doc_id::VARCHAR AS id, 'faq_c' || (doc_id % 4) AS collection, text FROM documents",
    "x_s": sparse("x", "id"),
    "x_idf": idf("x"),
    "q": "SELECT item_id::VARCHAR AS query_id, text FROM benchmark",
    "q_s": sparse("q", "query_id"),
    "q_d": dense("q", "query_id"),
    "q_v": packed("q", "query_id"),
}


def table_names(text: str) -> list[str]:
    """Shared tables a text reads, in the order they must be defined."""
    import re

    used: list[str] = []

    def visit(body: str) -> None:
        for name in re.findall(r"[a-z_]+", body):
            if name in TABLES and name not in used and re.search(rf"(FROM|JOIN|,)\s*\(?\s*{name}\b", body):
                visit(TABLES[name])
                if name not in used:
                    used.append(name)

    visit(text)
    return used


def sql(body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """Put the shared tables a query needs in front of it."""
    extra = extra or {}
    needed = {n: TABLES[n] for n in table_names(" ".join([*extra.values(), body])) if n not in extra}
    ctes = ",\n".join(f"{n} AS ({t})" for n, t in {**needed, **extra}.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}" if ctes else body


def sparse_scores(points: str) -> str:
    return f"""SELECT query_id, id, round(sum(q_s.tfw * idf * {points}_s.tfw * idf), 6) AS score
      FROM q_s JOIN {points}_s USING (idx) JOIN {points}_idf USING (idx) GROUP BY ALL"""


ALL_DENSE = """SELECT query_id, id, round(coalesce(list_dot_product(q_v.v, points_v.v)
    / nullif(sqrt(list_dot_product(q_v.v, q_v.v) * list_dot_product(points_v.v, points_v.v)), 0), 0), 6) AS score
  FROM q_v, points_v"""


def hybrid(final: str, limit: int, where: str = "true", scoped: bool = False, more: dict | None = None) -> str:
    depth = 2 * limit
    query = "scope || '|' || query_id" if scoped else "query_id"
    part = "scope, query_id" if scoped else "query_id"

    def ranked(name: str) -> str:
        return f"""SELECT * FROM (SELECT {query} AS query_id, id, row_number() OVER (
            PARTITION BY {part} ORDER BY score DESC, id) AS rank
          FROM (SELECT s.*, collection AS scope FROM {name} s JOIN points USING (id) WHERE {where}))
          WHERE rank <= {depth}"""

    extra = {
        **(more or {}),
        "dense_all": ALL_DENSE,
        "sparse_all": sparse_scores("points"),
        "fused": f"""SELECT query_id, id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score
          FROM ({ranked('dense_all')} UNION ALL {ranked('sparse_all')}) GROUP BY ALL""",
        "hits": f"""SELECT * FROM (SELECT query_id, id, score,
            row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM fused)
          WHERE rank <= {limit}""",
    }
    return sql(final, extra)


HITS = """SELECT query_id, rank, id, score, course_name AS course, section, question
  FROM hits JOIN points USING (id)"""


def pages(source: str, key: str, page: int, answer: str = "text") -> str:
    """Reply texts of each thread in pages, as ``part, reply_count, answer_compact``."""
    return f"""SELECT {key}, floor((n - 1) / {page})::INTEGER AS part, max(total) AS reply_count,
        string_agg({answer}, chr(10) ORDER BY n) AS answer_compact
      FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_ts, ts) AS n,
              count(*) OVER (PARTITION BY {key}) AS total FROM {source})
      GROUP BY ALL"""


VERDICT_COLUMNS = (
    "channel_id, ts, is_question, question_type, confidence, title, reason, llm_model, latency_ms"
)
MANIFEST_LINE = "concat_ws(chr(9), " + ", ".join(
    f"coalesce('=' || {c}, '~')" for c in ("channel_id", "ts", "thread_ts", "user_id", "role", "text", "fetched_at")
) + ")"
WORD_SUMS = ", ':', ".join(
    f"cast(sum(('0x' || substr(h, {8 * i + 1}, 8))::BIGINT) AS VARCHAR)" for i in range(8)
)
LANGUAGE_TEST = " OR ".join(
    f"(lang = {lit(code)} AND {found(f'lower({strip(chr(116) + chr(101) + chr(120) + chr(116))})', cue)})"
    for code, cue in V.LANGUAGE_CUES
)


CONFIDENCE_MAP = {
    "clean": f"SELECT * REPLACE ({scrub('text')} AS text) FROM documents",
    "steps": f"""SELECT *, row_number() OVER (ORDER BY confidence) AS k FROM (SELECT round(confidence, 3) AS confidence, count(*) AS n,
          avg((is_question = (quality = 1))::INTEGER) AS rate
        FROM ({verdicts('clean', role=None)}) JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1)""",
    "means": """SELECT i.k AS i, j.k AS j, sum(m.n * m.rate) / sum(m.n) AS mean
        FROM steps i JOIN steps j ON i.k <= j.k JOIN steps m ON m.k BETWEEN i.k AND j.k GROUP BY ALL""",
    "least": "SELECT k, i, min(mean) AS low FROM steps JOIN means ON k BETWEEN i AND j GROUP BY ALL",
    "confidences": "SELECT confidence, n, rate, max(low) AS calibrated FROM steps JOIN least USING (k) GROUP BY ALL",
}


def second_opinion(unsure: str = "confidence BETWEEN 0.5 AND 0.75") -> str:
    low = "lower(text)"
    cues = f"len(regexp_extract_all({low}, {lit(V.ASK_ANYWHERE)})) >= 2"

    def choose(yes: str, no: str, old: str) -> str:
        return f"CASE WHEN {unsure} THEN CASE WHEN {cues} THEN {yes} ELSE {no} END ELSE {old} END AS {old}"

    return f"""SELECT channel_id, ts, {choose('true', 'false', 'is_question')},
        {choose(kind(low), "'other'", 'question_type')}, {choose('0.8::DOUBLE', '0.75::DOUBLE', 'confidence')},
        {choose(title('text'), 'NULL', 'title')},
        {choose("'Several question words.'", "'Fewer than two question words.'", 'reason')},
        CASE WHEN {unsure} THEN {lit(V.SECOND_MODEL)} ELSE llm_model END AS llm_model, latency_ms
      FROM verdicted"""


DENSE_TOPK = sql("""SELECT * FROM (SELECT query_id,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM scores)
  WHERE rank <= 20""", {
    "dims": """SELECT vec_id, label, generate_subscripts(embedding, 1) AS pos, unnest(embedding)::DOUBLE AS x
      FROM embeddings""",
    "means": "SELECT label, list(x ORDER BY pos) AS q FROM (SELECT label, pos, avg(x) AS x FROM dims GROUP BY 1, 2) GROUP BY 1",
    "scores": """SELECT m.label::VARCHAR AS query_id, vec_id::VARCHAR AS id,
        round(list_cosine_similarity(q, embedding::DOUBLE[]), 6) AS score FROM means m, embeddings""",
})

ORACLES: dict[str, str] = {
    # sources and sinks
    "scan_messages": sql(
        "SELECT course_id, channel_id, ts, thread_ts, user_id, role, text, fetched_at FROM stored"
    ),
    "broken_exports": sql("""SELECT course_id, channel_id, ts, NULL AS line, 'read' AS reason FROM stored WHERE user_id <> 'U0007'
      UNION ALL SELECT course_id, NULL, NULL, '{"ts": "' || ts || '"', 'bad json' FROM stored WHERE user_id = 'U0007'"""),
    "scan_window": sql(f"""SELECT 'day' AS span, {DAY}, channel_id, ts FROM stored
        WHERE event_ts::DATE BETWEEN DATE '2024-08-12' AND DATE '2024-08-13'
      UNION ALL SELECT 'hours', {DAY}, channel_id, ts FROM stored
        WHERE event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR AND event_ts < TIMESTAMP '{AS_OF}'"""),
    "roundtrip_partitions": sql(f"SELECT {DAY}, channel_id, ts, thread_ts, user_id, text FROM stored"),
    "merge_days": sql(f"SELECT {DAY}, channel_id, ts, fetched_at, text FROM stored"),
    "partition_manifest": sql(f"""SELECT {DAY}, count(*) AS n,
        sha256(concat(cast(count(*) AS VARCHAR), ':', {WORD_SUMS})) AS digest
      FROM (SELECT {DAY}, sha256({MANIFEST_LINE}) AS h FROM stored) GROUP BY {DAY}"""),
    "faq_jsonl_roundtrip": sql("""SELECT section, question, answer, course_id, course_name,
        doc_id::VARCHAR AS doc_id, collection FROM chunks"""),
    "doc_blocks": sql("SELECT doc_id, pos, style, text FROM blocks"),
    "upsert_points": sql("""SELECT collection, id, question,
        CASE WHEN collection IN ('faq_c1', 'faq_c3') THEN 2 ELSE 1 END AS version FROM points
      UNION ALL SELECT collection, 'new_' || id, question, 2 FROM points"""),
    "collection_info": sql("""SELECT r.collection,
        CASE WHEN n IS NULL THEN 'missing' WHEN lo = 64 AND hi = 64 THEN 'green'
             ELSE 'dimension mismatch' END AS status,
        coalesce(n, 0) AS points_count, coalesce(hi, 0) AS dense_dim, round(coalesce(terms, 0), 6) AS avg_terms
      FROM (VALUES ('faq_c0'), ('faq_c1'), ('faq_c2'), ('faq_c3'), ('faq_c9')) r(collection)
      LEFT JOIN (SELECT collection, count(*) AS n, 64 AS lo, 64 AS hi,
                   avg(coalesce(t, 0)) AS terms
                 FROM x LEFT JOIN (SELECT id, count(*) AS t FROM x_s GROUP BY id) USING (id)
                 GROUP BY collection) s USING (collection)"""),
    "quarantine": sql("""SELECT course_id, channel_id, ts, thread_ts, user_id,
        CASE WHEN coalesce(ts, '') = '' THEN 'missing ts' ELSE 'bad ts' END AS reason
      FROM parsed WHERE event_ts IS NULL AND channel_id <> 'C104'
      UNION ALL SELECT NULL, channel_id, ts, thread_ts, user_id, 'unknown channel' FROM m WHERE channel_id = 'C104'"""),
    "unreadable_lines": sql("""SELECT channel_id, ts, fetched_at, NULL AS line, 'read' AS reason FROM m WHERE user_id <> 'U0007'
      UNION ALL SELECT NULL, NULL, NULL, substr('{"channel_id":"', 1, 12), 'bad json' FROM m WHERE user_id = 'U0007'"""),
    "replace_documents": sql("""SELECT doc_id, chunk_no, question FROM (
        SELECT *, min(chunk_no) OVER (PARTITION BY doc_id) AS first FROM chunks) WHERE doc_id % 4 <> 1 OR chunk_no = first"""),
    "model_embed": """SELECT doc_id, length(text)::DOUBLE AS x, (length(text) - length(replace(text, '?', '')))::DOUBLE AS y
      FROM documents""",
    # projections and filters
    "parse_event_time": sql("""SELECT channel_id, ts, fetched_at, user_id,
        strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
        strftime(try_strptime(fetched_at, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S.%f') AS fetch_time
      FROM parsed"""),
    "ymd_parts": sql("SELECT channel_id, ts, fetched_at, user_id, year, month, day FROM parsed"),
    "enrich_messages": sql(f"""SELECT course_id, channel_id, {lit(RUN_AT)} AS fetched_at, ts, thread_ts, user_id,
        role, text, year, month, day FROM enriched"""),
    "window_filter": sql(f"""SELECT course_id, channel_id, ts FROM stored
      WHERE event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND event_ts < TIMESTAMP '{AS_OF}'"""),
    "select_courses": sql("""SELECT doc_id, course_id, CASE WHEN course_id = 'course-2' THEN 1 ELSE 0 END AS selected
      FROM documents JOIN courses_faq ON google_doc_id = 'faq-' || (doc_id % 4)"""),
    "hybrid_by_course": hybrid(HITS, 10, "course_name = 'Course 1'"),
    "hybrid_by_section": hybrid(HITS, 10, """section = (SELECT section FROM points WHERE section <> ''
        GROUP BY section ORDER BY count(*) DESC, section LIMIT 1)"""),
    "format_hits": hybrid("""SELECT query_id, rank, round(score, 4) AS score, course_name AS course, section, question,
        substr(answer, 1, 200) || '...' AS answer FROM hits JOIN points USING (id)""", 5),
    # joins
    "course_channel_join": sql("SELECT course_id, channel_id, ts, user_id, fetched_at FROM parsed"),
    "chunk_metadata_join": sql("SELECT doc_id, chunk_no, course_id, course_name, collection FROM chunks"),
    "thread_messages": sql(f"""SELECT {THREAD}, CASE WHEN is_head THEN 0 ELSE 1 END AS place, ts, user_id, text
      FROM threaded t WHERE is_head OR EXISTS (SELECT 1 FROM threaded h WHERE h.is_head
        AND h.course_id = t.course_id AND h.channel_id = t.channel_id AND h.thread_key = t.thread_key)"""),
    "same_day_replies": sql(f"""SELECT {THREAD}, r.ts AS reply_ts, r.role AS reply_role
      FROM (SELECT {THREAD}, event_ts::DATE AS d FROM threaded WHERE is_head) h
      LEFT JOIN (SELECT *, event_ts::DATE AS d FROM replies) r USING ({THREAD}, d)"""),
    "question_threads": sql(f"SELECT {THREAD}, ts, user_id FROM judged_heads WHERE is_question"),
    "memoized_verdicts": sql(f"""SELECT doc_id, sha256(text) || ':' || {lit(V.MODEL)} AS text_key, is_question,
        question_type, confidence, title FROM ({verdicts('clean', role=None)})""",
        {"clean": f"SELECT * REPLACE ({scrub('text')} AS text) FROM documents"}),
    "stale_embeddings": """SELECT vec_id::VARCHAR AS id, CASE WHEN label % 3 = 1 THEN 'v0' END AS embed_version
      FROM embeddings WHERE label % 3 <> 0""",
    "golden_eval": sql(f"""SELECT *, round((tp + tn) / n, 6) AS accuracy,
        CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 6) END AS precision,
        CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 6) END AS recall
      FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_question AND quality = 1) AS tp,
          count(*) FILTER (WHERE is_question AND quality <> 1) AS fp, count(*) FILTER (WHERE NOT is_question AND quality = 1) AS fn,
          count(*) FILTER (WHERE NOT is_question AND quality <> 1) AS tn
        FROM ({verdicts('clean', role=None)}) JOIN labels USING (doc_id))""",
        {"clean": f"SELECT * REPLACE ({scrub('text')} AS text) FROM documents"}),
    "confidence_map": sql("SELECT confidence, n, round(rate, 6) AS rate, round(calibrated, 6) AS calibrated FROM confidences", CONFIDENCE_MAP),
    # aggregations
    "course_day_groups": sql(f"""SELECT {DAY}, floor((n - 1) / 20)::INTEGER AS page, count(*) AS n,
        string_agg(concat_ws('|', channel_id, ts, user_id), ',' ORDER BY s.n) AS messages
      FROM (SELECT *, row_number() OVER (PARTITION BY {DAY} ORDER BY event_ts, channel_id, ts) AS n FROM stored) s
      GROUP BY {DAY}, floor((s.n - 1) / 20)::INTEGER"""),
    "ingest_counters": sql("""SELECT course_id, channels, coalesce(messages, 0) AS messages,
        coalesce(dropped, 0) AS dropped, coalesce(files, 0) AS files
      FROM (SELECT course_id, count(*) AS channels FROM courses GROUP BY 1)
      LEFT JOIN (SELECT course_id, count(*) AS messages, count(*) FILTER (WHERE event_ts IS NULL) AS dropped,
          count(DISTINCT event_ts::DATE) AS files FROM parsed GROUP BY 1) USING (course_id)"""),
    "faq_counts": sql("SELECT course_id, count(*) AS n FROM chunks GROUP BY ROLLUP (course_id)"),
    "compact_threads": sql(pages("same_day", THREAD, 2, scrub("text"))),
    "preferred_answer": sql(f"""SELECT {THREAD}, 0 AS part,
        arg_min({scrub("text")}, (event_ts, ts)) AS answer FROM replies WHERE role = 'assistant' GROUP BY ALL
      UNION ALL SELECT {THREAD}, part, answer_compact FROM ({pages('rest', THREAD, 1000, scrub("text"))})""",
        {"rest": f"""SELECT * FROM replies r WHERE NOT EXISTS (SELECT 1 FROM replies a WHERE a.role = 'assistant'
          AND a.course_id = r.course_id AND a.channel_id = r.channel_id AND a.thread_key = r.thread_key)"""}),
    "verdict_metrics": sql(f"""SELECT course_id,
        CASE WHEN user_id = 'U0007' THEN 'error:{V.MODEL}' ELSE llm_model END AS llm_model,
        count(*) AS total, count(*) FILTER (WHERE user_id <> 'U0007') AS success,
        count(*) FILTER (WHERE user_id IN ('U0007', 'U0008')) AS retried, count(*) FILTER (WHERE user_id = 'U0007') AS failed,
        count(*) FILTER (WHERE is_question AND user_id <> 'U0007') AS questions, 0.0::DOUBLE AS avg_latency_ms,
        round(avg(CASE WHEN user_id = 'U0007' THEN 0 ELSE confidence END), 6) AS avg_confidence
      FROM verdicted GROUP BY 1, 2"""),
    # windows
    "faq_chunks": sql("SELECT doc_id, chunk_no, section, question, answer FROM raw_chunks WHERE answer <> ''"),
    "dedupe_messages": sql("""SELECT channel_id, ts, fetched_at, text FROM (SELECT *, row_number() OVER (
        PARTITION BY channel_id, ts ORDER BY fetched_at DESC, text DESC, user_id DESC) AS n FROM m) WHERE n = 1"""),
    "dedupe_by_digest": sql("SELECT sha256(text) AS digest, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1"),
    "thread_heads": sql("SELECT course_id, channel_id, ts, thread_key, is_head FROM threaded"),
    "infer_batches": sql("""SELECT course_id, channel_id, ts, floor((n - 1) / 16)::INTEGER AS batch,
        ((n - 1) % 16)::INTEGER AS place
      FROM (SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY event_ts, channel_id, ts) AS n FROM stored)"""),
    # retrieval
    "dense_topk": DENSE_TOPK,
    "dense_topk_cells": DENSE_TOPK,
    "sparse_topk": sql(f"""SELECT * FROM (SELECT query_id,
        row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score
        FROM ({sparse_scores('x')})) WHERE rank <= 20"""),
    "hybrid_search": hybrid(HITS, 10),
    "preview_hits": hybrid("""SELECT query_id, rank, round(score, 3) AS score, course_name AS course, section,
        substr(question, 1, 60) || '...' AS question FROM hits JOIN points USING (id)""", 2),
    "batch_hybrid": hybrid(HITS, 2, scoped=True),
    "top_titles": sql("""SELECT title, count(*) AS n FROM verdicted WHERE is_question GROUP BY title
      ORDER BY n DESC, title LIMIT 10"""),
    "rag_context": hybrid("""SELECT query_id, context,
        concat('Context:', chr(10), context, chr(10), chr(10), 'Question: ', text, chr(10), 'Answer:') AS prompt
      FROM (SELECT query_id, string_agg(answer, chr(10) ORDER BY rank) AS context
            FROM hits JOIN points USING (id) GROUP BY query_id) JOIN q USING (query_id)""", 3),
    # scalar functions
    "flatten_paragraphs": sql("SELECT doc_id, pos, text FROM blocks"),
    "embed_text": sql("SELECT doc_id, chunk_no, text FROM keyed"),
    "point_ids": sql("SELECT doc_id, chunk_no, id FROM keyed"),
    "scrub_pii": sql(f"SELECT channel_id, ts, user_id, fetched_at, {scrub('text')} AS text FROM m"),
    "scrub_documents": sql(f"SELECT doc_id, {scrub('text')} AS text FROM documents"),
    "strip_file_urls": sql("SELECT channel_id, ts, user_id, fetched_at, concat(text, '  ', text) AS text FROM m"),
    "question_prefilter": sql(f"SELECT channel_id, ts, user_id FROM masked WHERE {found('lower(text)', V.PREFILTER)}"),
    "normalize_verdicts": sql(f"""SELECT doc_id,
        CASE WHEN missing THEN false ELSE doc_id % 2 = 0 END AS is_question,
        CASE WHEN missing OR doc_id % 8 > 5 THEN 'other'
             ELSE ({[*V.QUESTION_TYPES]})[(doc_id % 8 + 1)::INTEGER] END AS question_type,
        CASE WHEN missing THEN 0.0 ELSE least(greatest(n_chars / 2000, 0.0), 1.0) END::DOUBLE AS confidence,
        CASE WHEN NOT missing AND doc_id % 2 = 0 THEN {title("string_split(text, chr(10))[1]")} END AS title,
        CASE WHEN missing THEN 'llm_error' ELSE 'model answer' END AS reason,
        CASE WHEN missing THEN 'error:m1' ELSE 'm1' END AS llm_model,
        CASE WHEN missing THEN 0 ELSE 5 END AS latency_ms
      FROM (SELECT *, doc_id % 10 = 9 AS missing FROM documents)"""),
    # models
    "dense_embed": sql(f"SELECT doc_id, bucket::INTEGER AS bucket, round(value::DOUBLE, 6) AS value FROM ({dense('documents', 'doc_id')})"),
    "sparse_embed": sql("""SELECT doc_id, idx::INTEGER AS idx, round(tfw * idf, 6) AS weight
      FROM docs_s JOIN docs_idf USING (idx)""", {
        "docs": "SELECT * FROM documents", "docs_s": sparse("documents", "doc_id"), "docs_idf": idf("docs"),
    }),
    "classify_questions": sql(f"SELECT {VERDICT_COLUMNS} FROM verdicted"),
    "two_stage_verdicts": sql(second_opinion()),
    "calibrated_verdicts": sql(second_opinion("""(SELECT coalesce(arg_max(calibrated, c.confidence) FILTER (c.confidence <= round(v.confidence, 3)),
        min(calibrated)) FROM confidences c) < 0.5""").replace("FROM verdicted", "FROM verdicted v"), CONFIDENCE_MAP),
    "semantic_groups": """WITH RECURSIVE heads AS (SELECT embedding::DOUBLE[] AS v, min(vec_id) AS id FROM embeddings
        WHERE list_min(embedding) <> 0 OR list_max(embedding) <> 0 GROUP BY 1),
      near AS (SELECT * FROM (SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS score
          FROM heads a JOIN heads b ON a.id <> b.id) WHERE score >= 0.9
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b::VARCHAR) <= 10),
      mutual AS (SELECT x.a, x.b FROM near x JOIN near y ON x.a = y.b AND x.b = y.a),
      reach(id, head) AS (SELECT id, id FROM heads UNION SELECT m.b, r.head FROM reach r JOIN mutual m ON m.a = r.id),
      labels AS (SELECT id, min(head) AS canonical FROM reach GROUP BY id),
      grouped AS (SELECT e.vec_id AS id, coalesce(l.canonical, e.vec_id) AS canonical FROM embeddings e
        LEFT JOIN heads h ON h.v = e.embedding::DOUBLE[] LEFT JOIN labels l ON l.id = h.id)
      SELECT id, canonical, count(*) OVER (PARTITION BY canonical) AS group_size FROM grouped""",
    "questions_by_lang": sql(f"""SELECT lang, count(*) AS total,
        count(*) FILTER (WHERE contains(text, '?') OR {LANGUAGE_TEST}) AS questions FROM documents GROUP BY lang"""),
    "found_languages": r"""WITH texts AS (SELECT doc_id, lang, substr(md5(doc_id::VARCHAR), 1, 1) < '4' AS held_out,
        ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}]+', ' ', 'g')) || ' ' AS t FROM documents),
      chars AS (SELECT doc_id, unnest(string_split(t, '')) AS c, unnest(range(len(t))) AS pos FROM texts),
      coded AS (SELECT doc_id, unicode(c) AS a, unicode(lead(c) OVER w) AS b, unicode(lead(c, 2) OVER w) AS d
        FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
      threes AS (SELECT doc_id, (1000003 * a::BIGINT + 10007 * b + d) % 65536 AS cell, count(*) AS times FROM coded WHERE d IS NOT NULL GROUP BY ALL),
      counts AS (SELECT lang, cell, sum(times) AS n FROM threes JOIN texts USING (doc_id) WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL),
      langs AS (SELECT lang, sum(n) + 65536 AS total FROM counts GROUP BY lang),
      scores AS (SELECT doc_id, l.lang AS name, sum(times * floor(1000 * ln((coalesce(c.n, 0) + 1) / total))) AS score,
          sum(times) FILTER (c.n IS NOT NULL) AS known, sum(times) AS size
        FROM threes t CROSS JOIN langs l LEFT JOIN counts c ON c.lang = l.lang AND c.cell = t.cell GROUP BY ALL),
      ranked AS (SELECT *, lead(score) OVER (PARTITION BY doc_id ORDER BY score DESC, name) AS second FROM scores
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name) = 1)
      SELECT doc_id, lang, held_out, CASE WHEN size >= 3 AND known >= 0.5 * size AND (second IS NULL OR score - second >= 20 * size)
        THEN name END AS found_lang FROM texts LEFT JOIN ranked USING (doc_id)""",
    # streaming and incremental
    "stream_ingest": sql(f"SELECT {DAY}, channel_id, ts, user_id, fetched_at, text FROM enriched"),
    "stream_dedupe": sql("SELECT course_id, channel_id, ts, min(fetched_at) AS fetched_at FROM enriched GROUP BY ALL"),
    "tumbling_day": """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS start, event_type,
        count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL""",
    "rolling_24h": """SELECT strftime(start, '%Y-%m-%d %H:%M:%S.%f') AS start, event_type, count(*) AS n,
        sum(value::DECIMAL(18,2))::DOUBLE AS total
      FROM (SELECT *, unnest(generate_series(date_trunc('hour', ts) - INTERVAL 23 HOUR, date_trunc('hour', ts),
              INTERVAL 1 HOUR)) AS start FROM events) GROUP BY ALL""",
    "stream_thread_upsert": sql(f"""SELECT course_id || ':' || thread_key AS id, channel_id, part, reply_count,
        answer_compact, created_at, updated_at
      FROM ({pages('replies', THREAD, 1000, scrub("text"))}) JOIN (SELECT course_id, channel_id, coalesce(thread_ts, ts) AS thread_key,
          min(fetched_at) AS created_at, max(fetched_at) AS updated_at FROM enriched GROUP BY ALL) USING ({THREAD})"""),
    "reconcile_threads": sql(pages("replies", THREAD, 1000, scrub("text"))),
    "upsert_faq_items": sql(f"""SELECT {THREAD}, part, reply_count, answer_compact, created_at, updated_at
      FROM ({pages('replies', THREAD, 2, scrub("text"))}) JOIN (SELECT course_id, channel_id,
          coalesce(thread_ts, ts) AS thread_key, min(fetched_at) AS created_at, max(fetched_at) AS updated_at
        FROM enriched WHERE coalesce(thread_ts, ts) <> ts GROUP BY ALL) USING ({THREAD})"""),
    "model_verdicts": sql("""SELECT course_id, CASE WHEN failed THEN 'error:stub' ELSE 'stub' END AS llm_model,
        count(*) AS total, count(*) FILTER (WHERE NOT failed) AS success, count(*) FILTER (WHERE tries > 1) AS retried,
        count(*) FILTER (WHERE failed) AS failed, count(*) FILTER (WHERE asks AND NOT failed) AS questions
      FROM (SELECT *, tries = 4 OR n % 7 = 0 AS failed FROM (
        SELECT course_id, length(text) AS n, contains(text, '?') AS asks,
          CASE WHEN length(text) % 7 = 0 THEN 3 WHEN length(text) % 3 = 0 THEN 3 WHEN length(text) % 5 = 0 THEN 2 ELSE 1 END AS tries
        FROM (SELECT text, min(course_id) AS course_id FROM masked GROUP BY text)))
      GROUP BY ALL"""),
    "faq_items": sql(f"""SELECT course_id || ':' || thread_key AS id, coalesce(part, 0) AS answer_part, course_id,
        thread_key AS thread_ts, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, text AS question_text_redacted,
        original AS original_question_sha256, is_question, confidence AS llm_confidence, llm_model,
        title AS question_title, question_type, reason AS question_reason, coalesce(reply_count, 0) AS reply_count,
        coalesce(answers, '') AS answers_redacted, coalesce(answer_compact, '') AS answer_compact_redacted,
        user_hash, {lit(RUN_AT)} AS created_at, {lit(RUN_AT)} AS updated_at, 'token-hash' AS embed_model,
        64 AS embed_dim, 'v1' AS embed_version, shown AS dense
      FROM judged_heads JOIN (SELECT original, array_to_string(list_transform(v, lambda x: round(x * 1000)::INTEGER), ' ') AS shown
          FROM head_v) USING (original) JOIN hashes USING (user_id) LEFT JOIN (
          SELECT {THREAD}, floor((n - 1) / 1000)::INTEGER AS part, max(total) AS reply_count,
            string_agg(answer, chr(10) ORDER BY n) AS answer_compact, string_agg(answer, '␞' ORDER BY n) AS answers
          FROM (SELECT *, {scrub('text')} AS answer,
                  row_number() OVER (PARTITION BY {THREAD} ORDER BY event_ts, ts) AS n,
                  count(*) OVER (PARTITION BY {THREAD}) AS total FROM same_day) GROUP BY ALL) USING ({THREAD})
      WHERE is_question""", {
          "hashes": "SELECT * FROM user_hashes",
          "head": "SELECT DISTINCT original, text FROM judged_heads",
          "head_d": dense("head", "original"),
          "head_v": packed("head", "original"),
      }),
}


def hmac_sql(user: str) -> str:
    """HMAC-SHA256 spelled out for a salt of at most 64 bytes."""
    key = fx.SALT.encode().ljust(64, b"\0")

    def blob(mask_byte: int) -> str:
        return "'" + "".join(f"\\x{b ^ mask_byte:02X}" for b in key) + "'::BLOB"

    return f"'u:' || sha256({blob(0x5C)} || unhex(sha256({blob(0x36)} || encode({user}))))"


ORACLES["hash_users"] = sql(f"""SELECT channel_id, ts, fetched_at, user_id,
    CASE WHEN role <> 'system' THEN {hmac_sql('user_id')} END AS user_hash FROM m""")
ORACLES["faq_items"] = ORACLES["faq_items"].replace(
    "SELECT * FROM user_hashes", f"SELECT DISTINCT user_id, {hmac_sql('user_id')} AS user_hash FROM m"
)
ORACLES["canonical_groups"] = f"""WITH RECURSIVE
  sets AS (SELECT doc_id, list_distinct({words('text')}) AS t FROM documents),
  folded AS (SELECT list_sort(t) AS t, min(doc_id) AS id FROM sets WHERE len(t) > 0 GROUP BY 1),
  posting AS (SELECT id, len(t) AS n, unnest(t) AS w FROM folded),
  links AS (SELECT a.id AS a, b.id AS b FROM posting a JOIN posting b ON a.w = b.w AND a.id < b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.6 * (a.n + b.n - count(*))),
  edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reach AS (SELECT id AS a, id AS b FROM folded
    UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
  label AS (SELECT a AS id, min(b) AS canonical FROM reach GROUP BY a),
  member AS (SELECT doc_id, canonical FROM sets JOIN folded ON list_sort(sets.t) = folded.t JOIN label USING (id)
    UNION ALL SELECT doc_id, doc_id FROM sets WHERE len(t) = 0)
SELECT doc_id, canonical, count(*) OVER (PARTITION BY canonical) AS group_size FROM member"""
