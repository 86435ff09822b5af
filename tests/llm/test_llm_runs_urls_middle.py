"""Periodic runs, redirect equivalence and fill-in-the-middle, against brute force and by their round trips."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from llm_cases import docs, empty, rows
from pyspark.sql import functions as F

from faqspark.llm import middle, periodic_runs, redirects
from faqspark.llm.queries import QUERIES, planted_periods
from faqspark.llm.redirects import ALLOW, BLOCK, UrlRule

WORD = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def all_runs(words, least=24, power=3):
    """Every period by itself, every stretch that keeps it as far as it goes."""
    out = []
    for q in range(1, len(words) // power + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if j > i and length >= max(least, power * q) and not any(
                    all(words[k] == words[k - p] for k in range(start + p, j)) for p in range(1, q)):
                out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out)


def planted(doc_id, text):
    words = re.findall(WORD, text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def report(words):
    runs = all_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-(r[1] / r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


FIELDS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@given(st.lists(st.integers(0, 2), max_size=60), st.sampled_from([(24, 3), (2, 2), (7, 2), (9, 4)]))
@settings(max_examples=300, deadline=None)
def test_runs_of_short_alphabets(words, kind):
    assert periodic_runs.runs_of(words, *kind) == all_runs(words, *kind)


@given(st.lists(st.integers(0, 4), min_size=1, max_size=14), st.integers(1, 70), st.lists(st.integers(0, 4), max_size=20), st.integers(0, 5))
@settings(max_examples=200, deadline=None)
def test_runs_of_repeated_blocks(block, size, around, at):
    words = around + (block * 70)[:size] + around[at:] + (block * 30)[: size // 2]
    assert periodic_runs.runs_of(words) == all_runs(words)


@pytest.mark.parametrize("kind", [(24, 3), (24, 4), (10, 3), (6, 2), (5, 5)])
def test_windows_inside_a_run_recur(kind):
    """The cut loses nothing: it is checked on the shortest runs of every period."""
    width = periodic_runs.window(*kind)
    for q in range(1, 40):
        words = (list(range(q)) * 60)[: max(kind[0], kind[1] * q)]
        windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
        assert all(windows.count(w) > 1 for w in windows)


def periodic_table(seed=5):
    rng = random.Random(seed)
    out = list(rows())
    extra = []
    for k in range(200, 260):
        block = [f"w{rng.randrange(4)}" for _ in range(rng.randrange(1, 12))]
        lead = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(40))]
        extra.append((k, " ".join(lead + block * rng.randrange(1, 20) + lead[::-1] + block * 5)))
    return [(r[0], r[1]) for r in out if r[0] != 11] + extra


def test_report_equals_brute_force(spark):
    table = periodic_table()
    frame = spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)
    got = sorted(((r.doc_id or -1), *(r[f] for f in FIELDS)) for r in periodic_runs.run_report(planted_periods(frame)).collect())
    want = sorted(((i or -1), *report(planted(i, t))) for i, t in table)
    assert [str(r) for r in got] == [str(r) for r in want]
    assert sum(r[1] > 0 for r in got) > 40


def test_query_equals_brute_force_on_shorter_texts(spark, sf):
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_word_runs"](spark, sf).collect()}
    assert got.keys() == table.keys()
    periodic = 0
    for doc_id, text in table.items():
        words = planted(doc_id, text)
        if len(words) <= 600:
            assert tuple(got[doc_id][f] for f in FIELDS) == report(words), doc_id
            periodic += got[doc_id].n_runs > 0
    assert periodic > 3


def test_long_periodic_text_stays_cheap(spark):
    words = [f"w{k}" for k in range(9000)] * 4
    text = " ".join(words)
    got = periodic_runs.run_report(spark.createDataFrame([(1, text), (2, "same " * 50_000)], "doc_id bigint, text string")).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == [(1, 0, 36_000, 9000), (1, 0, 50_000, 1)]
    assert got[0].collapsed_sha256 == sha(" ".join(words[:9000])) and got[1].collapsed_sha256 == sha("same")


def test_without_repeats_keeps_columns(spark):
    line = "a b c\n" * 10
    table = docs(spark).withColumn("text", F.when(F.col("doc_id") == 14, line).otherwise(F.col("text"))).withColumn("found0", F.lit(1)).withColumn("Words", F.lit(2))
    out = periodic_runs.without_repeats(table)
    assert out.columns == table.columns and out.schema == table.schema
    before, after = ({(r.doc_id, r.n_chars if r.doc_id is None else 0): r for r in t.collect()} for t in (table, out))
    assert before.keys() == after.keys()
    assert after[14, 0].text == "a b c" and after[14, 0].n_chars == 5
    assert all(after[k] == before[k] for k in before if k[0] not in (14, 15, 16))
    assert periodic_runs.without_repeats(empty(spark)).count() == 0 and periodic_runs.run_report(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.run_columns(F.col("text"), 24, 1)


PAGES = [
    (1, "http://a.net/x", '<LINK href="https://b.com/de/1" rel=canonical>'), (2, "https://b.com/de/1", None),
    (3, "http://a.net/x/?utm_source=f&ref=1#t", '<!-- <link rel="canonical" href="http://q.org/"> -->'),
    (4, "http://c.net/", '<meta http-equiv="refresh" content="0; url=/y">'), (5, "http://c.net/y", '<link rel="canonical"\n href="//d.com/de/2"/>'),
    (6, "http://e.net/", "<link rel=canonical href=http://d.com/de/2>"), (7, "http://e.net", '<link rel="canonical" href="http://ok.org/z">'),
    (8, None, "<link rel=canonical href=http://d.com/de/2>"), (9, "nohost", None), (10, "http://q.net/l", None), (11, "http://EXAMPLE.org/es/x", None),
    (12, "http://a.example.org/en/12", None), (13, "http://a.org", ""), (14, "http://xorg/", None), (15, "http://q.net/l?page=2", None),
    (None, "http://q.net/l", None), (1, "http://a.net/x", None), (16, "s://h/p?q://x", "<link rel=stylesheet href=http://d.com/de/2>"),
]


def chain(spark, n):
    """A long chain of redirects that ends at a blocked url, and a hot target."""
    long = [(f"http://n{k}.net/", f"http://n{k + 1}.net/") for k in range(n)] + [(f"http://n{n}.net/", "http://w.com/de/")]
    hot = [(f"http://h{k}.net/", "http://hub.net/") for k in range(300)] + [("http://hub.net", "http://v.com/de/")]
    return spark.createDataFrame(long + hot, "source string, target string")


def test_blocks_spread_to_aliases_and_allow_wins(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    more = spark.createDataFrame([("http://q.net/l", "http://mid.net/"), ("https://mid.net", "http://www.z.com/de/"), (None, "http://x.com/de/"), ("http://x.net", None)],
                                 "source string, target string")
    got = redirects.url_verdicts(pages, redirects=more).collect()
    assert len(got) == len(PAGES)
    blocked = sorted(r.page_id or -1 for r in got if r.verdict == BLOCK)
    # Pages 4 to 7 are one group with the allowed ok.org; 15 has a query of its own.
    assert blocked == [-1, 1, 1, 2, 3, 10, 11, 12]
    by_id = {r.page_id: r for r in got}
    assert (by_id[11].host, by_id[11].path, by_id[11].rule) == ("example.org", "/es/x", "example.org/es/")
    assert by_id[12].rule == "example.org/en/1" and by_id[13].rule is None and by_id[14].rule is None
    assert (by_id[16].host, by_id[16].path, by_id[8].host, by_id[9].path) == ("h", "/p", "", "")
    alone = {r.page_id: r.verdict for r in redirects.url_verdicts(pages.where("page_id = 10")).collect()}
    assert alone == {10: ALLOW}


def test_long_chains_and_hot_targets(spark):
    pages = spark.createDataFrame([(k, f"https://n{k}.net", None) for k in range(60)] + [(100 + k, f"http://h{k}.net/#x", None) for k in range(300)],
                                  "page_id bigint, url string, html string")
    got = redirects.url_verdicts(pages, redirects=chain(spark, 60)).collect()
    assert len(got) == 360 and all(r.verdict == BLOCK and r.rule is None for r in got)


def test_longest_rule_wins_and_unknown_actions_fail(spark):
    pages = spark.createDataFrame([(1, "http://a.b.com/x/y", ""), (2, "http://b.com/x", ""), (3, "http://bb.com/x/y", "")], "page_id bigint, url string, html string")
    rules = [UrlRule(BLOCK, "B.com", "/x"), UrlRule(ALLOW, "b.com", "/x/y"), UrlRule(BLOCK, "com", "/x/yy")]
    assert [r.verdict for r in redirects.url_verdicts(pages, rules).orderBy("page_id").collect()] == [ALLOW, BLOCK, ALLOW]
    with pytest.raises(ValueError):
        UrlRule("maybe", "a.com")


def test_without_blocked_keeps_clashing_columns(spark):
    names = ["url", "html", "page_id", "bad", "address", "rule", "action", "host", "path", "C0", "verdict"]
    table = spark.createDataFrame([("http://a.com/de/", None, 1, 1, "x", "r", "a", "h", "p", 0, "v"), ("http://a.com/en/", None, 1, 1, "x", "r", "a", "h", "p", 0, "v")],
                                  ", ".join(f"{n} {'int' if n in ('page_id', 'bad', 'C0') else 'string'}" for n in names))
    out = redirects.without_blocked(table)
    assert out.columns == names and [r.url for r in out.collect()] == ["http://a.com/en/"]
    assert redirects.without_blocked(table.limit(0)).count() == 0 and redirects.url_verdicts(table.limit(0)).count() == 0


def test_url_filter_runs_without_python_workers(spark, sf):
    plan = QUERIES["op12_redirect_filter"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "CartesianProduct" not in plan


FIM = [(k, t) for k, t in enumerate([
    None, "", "a<P>b", "\n" * 20_000, "😀a\n" * 5000, "😀a" * 30_000, "x" * 300_000, "a\r\nb c\x85d\n$1\\", "<", "<\nP><\n", "<\nS>\nM>\n<" * 3, "one\n", "one", "\\1\n$2\n{3}\n"])]


def expected(doc_id, text, unit=r"[^\n]*\n|[^\n]+"):
    text = text or ""
    units = re.findall(unit, text)
    h = [int(sha(f"7:{'' if doc_id is None else doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in middle.SENTINELS):
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 50 else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), "spm" if h[3] % 100 < 50 else "psm", len(p), len(m), sha(out), sha(text)


@pytest.mark.parametrize("unit, plain", [
    (middle.LINE, r"[^\n]*\n|[^\n]+"), (middle.CHARACTER, r"(?s:.)"), (middle.WORD, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+")])
def test_middles_equal_plain_cutting(spark, unit, plain):
    table = FIM + [(100 + k, "<\nP>\nS>\n<S\n><M\n é ü\n") for k in range(30)] + [(None, "a\nb\n"), (None, None), (11, "one\n")]
    got = middle.middle_report(spark.createDataFrame(table, "doc_id bigint, text string").repartition(3), unit=unit).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(i, t, plain)) for i, t in table)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_keeps_columns_and_restores(spark):
    table = docs(spark).withColumn("fim0", F.lit(1)).withColumn("FIM1", F.lit(2)).withColumn("units", F.lit(3))
    out = middle.fill_in_middle(table)
    assert out.columns == table.columns
    texts = {(r.doc_id, r.text) for r in table.collect()}
    for r in out.collect():
        form = "plain" if not r.text or not r.text.startswith("<") else "spm" if r.text.startswith("<S>") else "psm"
        back = r.text if form == "plain" else "".join(re.fullmatch(
            r"(?s)<P>(?P<p>.*)<S>(?P<s>.*)<M>(?P<m>.*)" if form == "psm" else r"(?s)<S>(?P<s>.*)<P>(?P<p>.*)<M>(?P<m>.*)", r.text).group("p", "m", "s"))
        assert (r.doc_id, back) in texts
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert middle.fill_in_middle(empty(spark)).count() == 0 and middle.middle_report(empty(spark)).count() == 0


def test_rates_and_sentinels(spark):
    table = spark.createDataFrame([(k, "a\nb\nc\n") for k in range(400)], "doc_id bigint, text string")
    forms = [r.form for r in middle.middle_report(table, percent=30, spm_percent=0).collect()]
    assert 80 < len(forms) - forms.count("plain") < 160 and "spm" not in forms
    marks = ("$p", "|s\\", "[m]")
    got = middle.middle_report(table, sentinels=marks).collect()
    assert all(r.restored_sha256 == sha("a\nb\nc\n") and r.form != "plain" for r in got)
    for wrong in (("<P>", "<P>", "<M>"), ("aba", "c", "d"), ("ab", "bc", "d"), ("abc", "b", "d"), ("a", "b", "")):
        with pytest.raises(ValueError):
            middle.middle_report(table, sentinels=wrong)
