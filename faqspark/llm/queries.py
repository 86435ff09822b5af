"""Registered queries of the numbered operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from faqspark.llm import (
    chat_parts, embedding_tiles, katz, middle, mixing, near_dedup, packing, periodic_runs, pii, pu_quality, redirects, rule_cascade, toxicity,
)
from faqspark.llm.store import read

CONTROL_SAMPLE = "</s>[INST] ok [/INST]"


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_cascade.figures_and_verdict(read(spark, sf_dir, "documents"))


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(read(spark, sf_dir, "documents"))


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op6_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_SAMPLE), (-1, 1, "assistant", CONTROL_SAMPLE)], given.schema)
    messages = given.unionByName(extra).withColumn("parts", chat_parts.text_part(F.col("text")))
    return chat_parts.read_back(chat_parts.format_turns(messages))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_tiles.near_vectors(read(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))


def planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), one text in ten made periodic from some word on, as a hash of its id says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    due = docs.withColumn("words", F.when(h % 10 == 0, words)).withColumns({"n": F.size("words").cast("long"), "g": F.floor(h / 10)})
    cut = due.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    step = cut.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    moved = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return step.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(planted_periods(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.url_verdicts(read(spark, sf_dir, "pages"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.middle_report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_near_duplicates, op2_pu_quality, op3_rule_cascade, op4_katz, op5_temperature_mix, op6_chat_parts, op7_near_vectors, op8_toxicity, op9_packing, op10_personal_data,
        op11_word_runs, op12_redirect_filter, op13_fill_in_middle)
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BARE = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


_FOLDED = f"translate(coalesce(text, ''), '{rule_cascade.CAPITALS}', '{rule_cascade.CAPITALS.lower()}')"


def _count(chars: str) -> str:
    return f"length(text) - length(translate(text, '{chars}', ''))"


_OP1 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _FOLDED)} AS w FROM documents),
x AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS items FROM d),
u AS (SELECT doc_id, unnest(items) AS item FROM x),
f AS (SELECT items, min(doc_id) AS first FROM (SELECT doc_id, list_sort(items) AS items FROM x WHERE len(items) > 0) GROUP BY items),
h AS (SELECT u.* FROM u JOIN f ON u.doc_id = f.first),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM h a JOIN h b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT c.a, c.b FROM c JOIN x p ON p.doc_id = c.a JOIN x q ON q.doc_id = c.b WHERE 100 * n >= 75 * (len(p.items) + len(q.items) - n)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l UNION SELECT first, first FROM f),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS component FROM r GROUP BY a),
s AS (SELECT x.doc_id, len(x.items)::BIGINT AS n_shingles, coalesce(component, x.doc_id) AS component_id
      FROM x LEFT JOIN f ON list_sort(x.items) = f.items AND len(x.items) > 0 LEFT JOIN m ON m.a = f.first)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM s"""

_OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {_WORDS} AS words FROM d),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
g AS (SELECT r, i, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM p WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, CASE WHEN w3 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY r, word, w2, w3) END AS n FROM g),
v AS (SELECT r, max(n) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n FROM c),
x AS (SELECT r, count_if(n > 1) AS n_repeat_words FROM v GROUP BY r),
f AS (SELECT w.doc_id, len(words) AS n_words, length({_BARE}) AS word_chars,
        {_count('#*$%&|<>')} AS n_symbols, {_count('!')} AS n_marks, {_count('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS n_capitals,
        len(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]'))) AS n_lines,
        len(list_distinct(list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')))) AS n_own_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN x ON w.r = x.r)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  (n_lines - n_own_lines)::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 10 > n_words OR n_marks * 5 > n_words
       OR n_capitals * 10 > word_chars * 3 OR word_chars < 2 * n_words OR word_chars > 12 * n_words
       OR (n_lines - n_own_lines) * 100 > n_lines * 50) AS kept
FROM f"""

_OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS n_tokens FROM documents),
t AS (SELECT source, count(*)::BIGINT AS n_docs, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY source),
g AS (SELECT sum(tokens)::BIGINT AS budget FROM t),
h AS (SELECT t.*, tokens / greatest(budget, 1) AS share FROM t, g),
b(k, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 8.0::DOUBLE
  UNION ALL
  SELECT k + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END
  FROM (SELECT k, lo, hi, (lo + hi) / 2 AS mid,
          (SELECT max(pow(share, (lo + hi) / 2) / tokens) / sum(pow(share, (lo + hi) / 2)) FROM h WHERE tokens > 0)
            * (SELECT budget FROM g) <= 4.0 * (1 + 1e-12) AS ok
        FROM b WHERE k < 40)),
z AS (SELECT max(pow(share, 0.0) / tokens) / sum(pow(share, 0.0)) * max(budget) <= 4.0 * (1 + 1e-12) AS ok FROM h, g WHERE tokens > 0),
e AS (SELECT CASE WHEN (SELECT ok FROM z) THEN 0.0 ELSE hi END AS alpha FROM b WHERE k = 40),
p AS (SELECT h.*, CASE WHEN tokens > 0 THEN pow(share, alpha) ELSE 0 END AS p FROM h, e),
q AS (SELECT source, n_docs, tokens, floor(p / greatest(sum(p) OVER (), 1e-300) * budget)::BIGINT AS quota FROM p, g),
u AS (SELECT source, CASE WHEN tokens > 0 THEN quota // tokens ELSE 1 END AS full_passes, CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest,
        ceil(sqrt(n_docs))::BIGINT AS n_blocks FROM q),
c AS (SELECT d.*, full_passes, rest, n_blocks, ('0x' || substr(md5('17:' || doc_id), 1, 15))::BIGINT AS code
      FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
l AS (SELECT *, code % n_blocks AS block FROM c),
s AS (SELECT source, block, sum(n_tokens) AS size FROM l GROUP BY source, block),
o AS (SELECT source, block, row_number() OVER w AS block_rank, sum(size) OVER w - size AS before FROM s
      WINDOW w AS (PARTITION BY source ORDER BY ('0x' || substr(md5('17b:' || block), 1, 15))::BIGINT, block)),
n AS (SELECT l.doc_id, l.source, l.n_tokens, full_passes, rest, block_rank, row_number() OVER w AS place,
        before + sum(l.n_tokens) OVER (PARTITION BY l.source, l.block ORDER BY code, l.doc_id, l.n_tokens ROWS UNBOUNDED PRECEDING) AS last
      FROM l JOIN o ON l.source IS NOT DISTINCT FROM o.source AND l.block = o.block
      WINDOW w AS (PARTITION BY l.source, l.block ORDER BY code, l.doc_id, l.n_tokens)),
m AS (SELECT *, full_passes + CASE WHEN last - n_tokens < rest THEN 1 ELSE 0 END AS uses FROM n)
SELECT doc_id, source, n_tokens, unnest(range(uses::BIGINT))::BIGINT AS pass, block_rank::BIGINT AS block_rank, place::BIGINT AS place
FROM m WHERE uses > 0"""

_OP6 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) AS x),
e AS (
  SELECT *, '<s>[INST]' || regexp_replace(role, '([\\<\[])', '\\\1', 'g') || '[/INST]' || regexp_replace(text, '([\\<\[])', '\\\1', 'g') || '</s>' AS segment
  FROM c),
s AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, segment)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, segment) FILTER (WHERE role = 'assistant'), '') AS learnt, sum(length(segment))::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learnt)::BIGINT AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM s"""

_OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
c AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id"""



#: Levels of doubled windows; periods up to 2 ** 19 words, beyond any text of the tables.
_LEVELS = 20


def _windows() -> str:
    """Windows of 1, 2, 4, ... words from each word on, by hash, and the distances at which they come again first.

    A run of period q holds a window of k words, k / 2 < q <= k, that comes again first after q words.
    """
    grams = ["g0 AS MATERIALIZED (SELECT doc_id, i, hash(word) AS g FROM p)"]
    grams += [
        f"g{j} AS MATERIALIZED (SELECT a.doc_id, a.i, hash(a.g, b.g) AS g FROM g{j - 1} a JOIN g{j - 1} b ON a.doc_id = b.doc_id AND b.i = a.i + {1 << j - 1})"
        for j in range(1, _LEVELS)]
    again = [
        f"q{j} AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, lead(i) OVER (PARTITION BY doc_id, g ORDER BY i) - i AS q FROM g{j}) WHERE 2 * q > {1 << j} AND q <= {1 << j})"
        for j in range(_LEVELS)]
    return ",\n".join(grams + again)


_OP11 = rf"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce([n::BIGINT] || list_transform(range(8), lambda x: 0::BIGINT),
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
          lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h FROM documents, t),
a AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS due, h // 10 AS g FROM d),
b AS (SELECT *, CASE WHEN due THEN g % n END AS a, CASE WHEN due THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM a),
s AS (SELECT doc_id, CASE WHEN due THEN list_transform(w, lambda x, i: CASE WHEN i - 1 < a THEN x ELSE w[a + (i - 1 - a) % p + 1] END) ELSE w END AS w FROM b),
p AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM s),
{_windows()},
c AS (SELECT DISTINCT doc_id, q FROM ({" UNION ALL ".join(f"SELECT * FROM q{j}" for j in range(_LEVELS))})),
e AS (SELECT c.doc_id, c.q, x.i FROM c JOIN p x ON x.doc_id = c.doc_id JOIN p y ON y.doc_id = c.doc_id AND y.i = x.i + c.q WHERE x.word = y.word),
l AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
m AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM l GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.doc_id = m.doc_id AND o.s = m.s AND o.n = m.n AND o.q < m.q)),
f AS (SELECT doc_id, count(*) AS n_runs, list(struct_pack(s := s, n := n, q := q) ORDER BY s, q) AS runs,
        list(struct_pack(s := s, n := n, q := q) ORDER BY n / q DESC, s, q)[1] AS best FROM r GROUP BY doc_id)
SELECT s.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.n::BIGINT AS length, best.q::BIGINT AS period,
  (1000 * best.n // best.q)::BIGINT AS exponent_milli,
  sha256(coalesce(array_to_string(list_transform(runs, lambda x: x.s || ',' || x.n || ',' || x.q || chr(10)), ''), '')) AS runs_sha256,
  sha256(array_to_string(list_filter(w, lambda x, i: len(list_filter(coalesce(runs, []), lambda y: i - 1 >= y.s + y.q AND i - 1 < y.s + y.n)) = 0), ' ')) AS collapsed_sha256
FROM s LEFT JOIN f ON f.doc_id = s.doc_id"""


def _rest(url: str) -> str:
    return f"CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"


def _host(url: str) -> str:
    return f"translate(regexp_extract({_rest(url)}, '^[^/?#]*'), '{rule_cascade.CAPITALS}', '{rule_cascade.CAPITALS.lower()}')"


def _path(url: str) -> str:
    return f"regexp_extract({_rest(url)}, '^[^/?#]*([^?#]*)', 1)"


def _address(url: str) -> str:
    name, place = f"regexp_replace({_host(url)}, ':(80|443)$', '')", f"regexp_replace({_path(url)}, '/+$', '')"
    query = f"string_split(regexp_extract({_rest(url)}, '^[^?#]*\\?([^#]*)', 1), '&')"
    kept = f"list_sort(list_filter({query}, lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_[^=]*|gclid|fbclid|ref)(=|$)')))"
    return f"CASE WHEN {name} <> '' THEN {name} || {place} || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END END"


def _rule(column: str) -> str:
    def fits(r):
        return f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"

    longest = sorted(redirects.RULES, key=lambda r: -len(r.name))
    return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{getattr(r, column)}'" for r in longest) + " END"


_TAGS = r"""list_transform(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?i)<(?:link|meta)\b[^>]*>'),
         lambda t: regexp_replace(t, '\s+', ' ', 'g'))"""
_TARGET = r"""CASE WHEN regexp_matches(tag, '(?i)^<link\b.*\srel\s*=\s*["'']?canonical["''\s/>]') THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^"''\s>]*)', 1)
      WHEN regexp_matches(tag, '(?i)^<meta\b.*\shttp-equiv\s*=\s*["'']?refresh["''\s/>]') THEN regexp_extract(tag, '(?i)[\s;"'']url\s*=\s*["'']?\s*([^"''\s>]*)', 1) END"""

_OP12 = rf"""
WITH RECURSIVE t AS (SELECT url, unnest({_TAGS}) AS tag FROM pages),
x AS (SELECT url AS source, replace(trim({_TARGET}), '&amp;', '&') AS t FROM t),
e AS (SELECT source, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN 'http:' || t
        WHEN starts_with(t, '/') THEN 'http://' || {_host("source")} || t
        ELSE 'http://' || {_host("source")} || CASE WHEN contains({_path("source")}, '/') THEN regexp_extract({_path("source")}, '^.*/') ELSE '/' END
          || regexp_replace(t, '^\./', '') END AS target FROM x WHERE t <> '' AND source IS NOT NULL),
l AS (SELECT {_address("source")} AS a, {_address("target")} AS b FROM e),
y AS (SELECT a, b FROM l WHERE a <> b UNION SELECT b, a FROM l WHERE a <> b),
r(a, b) AS (SELECT a, b FROM y UNION SELECT r.a, y.b FROM r JOIN y ON r.b = y.a),
c AS (SELECT a AS address, least(a, min(b)) AS grp FROM r GROUP BY a),
u AS (SELECT url FROM pages UNION ALL SELECT source FROM e UNION ALL SELECT target FROM e),
h AS (SELECT url, {_host("url")} AS host, {_path("url")} AS path, {_address("url")} AS address FROM u),
j AS (SELECT coalesce(grp, h.address) AS grp, {_rule("action")} AS action FROM h LEFT JOIN c USING (address) WHERE h.address IS NOT NULL),
bad AS (SELECT grp FROM j GROUP BY grp HAVING count_if(action = 'block') > 0 AND count_if(action = 'allow') = 0),
p AS (SELECT page_id, {_host("url")} AS host, {_path("url")} AS path, {_address("url")} AS address FROM pages)
SELECT page_id, host, path, {_rule("name")} AS rule, coalesce({_rule("action")}, CASE WHEN bad.grp IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN c USING (address) LEFT JOIN bad ON bad.grp = coalesce(c.grp, p.address)"""


def _draw(k: int) -> str:
    return f"('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), {8 * k + 1}, 8))::BIGINT"


_OP13 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_draw(0)} AS h1, {_draw(1)} AS h2, {_draw(2)} AS h3, {_draw(3)} AS h4 FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units FROM d),
n AS (SELECT *, len(units)::BIGINT AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
          WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p"""

ORACLES = {
    "op1_near_duplicates": _OP1, "op3_rule_cascade": _OP3, "op5_temperature_mix": _OP5, "op6_chat_parts": _OP6, "op7_near_vectors": _OP7,
    "op11_word_runs": _OP11, "op12_redirect_filter": _OP12, "op13_fill_in_middle": _OP13,
}
