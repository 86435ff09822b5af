"""Column functions against plain Python, on hand-written cases."""

import hashlib
import hmac
import math
import re
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from faqspark.functions import privacy, text, times, vectors, verdicts
from faqspark.operators import classify


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", T._parse_datatype_string(kind))]))


def apply(spark, values, fn, kind="string"):
    rows = column(spark, list(enumerate(values)), f"struct<i:int,v:{kind}>")
    out = rows.select(F.col("x.i").alias("i"), fn(F.col("x.v")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in out]


@pytest.mark.parametrize("raw, expected", [
    ("1723556195.123456", "2024-08-13 13:36:35.123456"),
    ("20240813", "1970-08-23 06:26:53.000000"),
    ("0", "1970-01-01 00:00:00.000000"),
    ("2024-08-13T14:36:35", "2024-08-13 14:36:35.000000"),
    ("2024-08-13T14:36:35+02:00", "2024-08-13 12:36:35.000000"),
    ("2024-08-13", "2024-08-13 00:00:00.000000"),
    ("99999999999999999", None), ("nan", None), ("bad", None), ("", None), (None, None),
])
def test_event_time(spark, raw, expected):
    assert apply(spark, [raw], lambda c: times.stamp(times.event_time(c))) == [expected]


def test_event_time_equals_python(spark):
    raw = [f"{1_700_000_000 + 86_399 * i}.{i:06d}" for i in range(50)]
    got = apply(spark, raw, lambda c: times.stamp(times.event_time(c)))
    want = [
        datetime.fromtimestamp(int(r.split(".")[0]), timezone.utc).strftime("%Y-%m-%d %H:%M:%S.") + r.split(".")[1]
        for r in raw
    ]
    assert got == want


def test_calendar_parts_are_padded_and_null_safe(spark):
    rows = column(spark, ["1709251200", None]).select(*times.calendar_parts(times.event_time(F.col("x"))).values())
    assert [tuple(r) for r in rows.collect()] == [("2024", "03", "01"), (None, None, None)]


def test_strip_removes_all_white_space(spark):
    raw = ["\t a b \n", "  x　", "\x0b\x1cy\x85", "", "   "]
    assert apply(spark, raw, text.strip) == [r.strip() for r in raw]


def test_white_space_is_pythons():
    assert set(text.WHITE) == {c for c in map(chr, range(0x110000)) if c.isspace()}


def test_flatten_paragraph_skips_other_elements(spark):
    element = "struct<textRun:struct<content:string>>"
    rows = spark.createDataFrame(
        [([(("  How ",),), (None,), ((None,),), (("to?\n",),)],), ([],), (None,)], f"e array<{element}>"
    )
    assert [r[0] for r in rows.select(text.flatten_paragraph(F.col("e"))).collect()] == ["How to?", "", ""]


SCRUB = [
    ("mail a.b@c.io now", "mail [EMAIL] now"),
    ("<mailto:a@b.co|a@b.co>", "[EMAIL]"),
    ("hi <@U123|bob> in <#C9|x>", "hi [USER] in [CHANNEL]"),
    ("see <https://x.org/a?b=1>, ok", "see [URL], ok"),
    ("file <https://files.x.org/p.png> gone", "file  gone"),
    ("call +1 (555) 555-0100", "call [PHONE]"),
    ("card 4111111111111111", "card 4111111111111111"),
    ("a@b.co ```a@b.co``` a@b.co", "[EMAIL] ```a@b.co``` [EMAIL]"),
    ("x ```a@b.co", "x ```[EMAIL]"),
    ("```a@b.co``` ```c@d.co```", "```a@b.co``` ```c@d.co```"),
    ("", ""), (None, None),
]


def test_scrub(spark):
    assert apply(spark, [s for s, _ in SCRUB], privacy.scrub_pii) == [e for _, e in SCRUB]


def test_scrub_is_a_fixed_point(spark):
    once = apply(spark, [s for s, _ in SCRUB], privacy.scrub_pii)
    assert apply(spark, once, privacy.scrub_pii) == once


def test_scrub_code_on_request(spark):
    got = apply(spark, ["```a@b.co```"], lambda c: privacy.scrub_pii(c, scrub_code=True))
    assert got == ["```[EMAIL]```"]


@pytest.mark.parametrize("salt", ["", "s", "pepper-é", "x" * 64, "x" * 65, "é" * 100])
def test_user_hash_is_hmac(spark, salt):
    users = ["U1", "Ü2", "", None]
    want = [
        None if u is None else "u:" + hmac.new(salt.encode(), u.encode(), hashlib.sha256).hexdigest()
        for u in users
    ]
    assert apply(spark, users, lambda c: privacy.user_hash(c, salt)) == want



TEXTS = ["Hello hello WORLD 42, été!", "a a a b", "", "???", None, " ".join(f"w{i % 700}" for i in range(5000))]


def plain_codes(value):
    words = re.findall(r"[^\W_]+", (value or "").lower())
    return [int(hashlib.md5(w.encode()).hexdigest()[:9], 16) for w in words]


def test_sparse_vector(spark):
    got = apply(spark, TEXTS, lambda c: vectors.sparse_vector(text.token_codes(c)))
    for value, vector in zip(TEXTS, got):
        counts = Counter((c >> 4) & 0xFFFFF for c in plain_codes(value))
        assert dict(zip(vector["indices"], vector["values"])) == pytest.approx(
            {k: math.log(1 + n) for k, n in counts.items()}
        )
        assert vector["indices"] == sorted(counts)


@pytest.mark.parametrize("dim", [8, 64])
def test_dense_vector(spark, dim):
    texts = [t for t in TEXTS if t is not None]
    got = apply(spark, texts, lambda c: vectors.dense_vector(text.token_codes(c), dim))
    for value, vector in zip(texts, got):
        raw = [0.0] * dim
        for c in plain_codes(value):
            raw[(c >> 4) % dim] += -1 if c & 1 else 1
        norm = math.sqrt(sum(x * x for x in raw)) or 1.0
        assert vector == pytest.approx([x / norm for x in raw], abs=1e-6)


def test_dense_vector_needs_a_power_of_two():
    with pytest.raises(ValueError):
        vectors.dense_vector(F.lit(None), 100)


@pytest.mark.parametrize("words, role, asks, confidence, kind", [
    ("How do I run it?", "user", True, 0.95, "how-to"),
    ("It broke?", "user", True, 0.9, "other"),
    ("Thanks a lot", "user", False, 0.85, "other"),
    ("Thanks. Where is the video?", "user", True, 0.95, "resource"),
    ("I get an error. why does it stop", "user", True, 0.7, "debug"),
    ("I am stuck on lesson two", "user", True, 0.6, "debug"),
    ("Uploaded the homework", "user", False, 0.55, "other"),
    ("How do I run it?", "system", False, 0.99, "other"),
    ("Island shores", "user", False, 0.55, "other"),
])
def test_rules(spark, words, role, asks, confidence, kind):
    row = classify.classify(spark.createDataFrame([(words, role)], "text string, role string"), "text", "role").first()
    v = row["verdict"]
    assert (v["is_question"], v["confidence"], v["question_type"]) == (asks, confidence, kind)
    assert (v["title"] is not None) == asks


def test_titles_have_at_most_twelve_words(spark):
    long = " ".join(f"w{i}" for i in range(30))
    assert apply(spark, [long], verdicts.short_title) == [" ".join(f"w{i}" for i in range(12))]


def test_normalize_verdicts(spark):
    schema = (
        "id int, verdict struct<is_question:boolean,question_type:string,confidence:double,title:string,"
        "reason:string,llm_model:string,latency_ms:int,request_id:string>"
    )
    rows = [
        (1, (True, "debug", 1.7, "a b", "r", "m", 3, "q")),
        (2, (False, "chat", -0.2, "kept?", "r", "m", 3, None)),
        (3, (True, None, None, None, "r", "m", 3, None)),
        (4, None),
    ]
    got = classify.normalize(spark.createDataFrame(rows, schema), "verdict", "m").orderBy("id").collect()
    picked = [tuple(r["verdict"])[:4] for r in got]
    assert picked == [
        (True, "debug", 1.0, "a b"), (False, "other", 0.0, None), (True, "other", 0.0, None),
        (False, "other", 0.0, None),
    ]
    assert got[3]["verdict"]["reason"] == "llm_error" and got[3]["verdict"]["llm_model"] == "error:m"


def test_model_verdicts_are_batched_retried_and_normalized(spark):
    def stub_model():
        """Fails for good on one text, for one call on another; answers out of range on purpose."""
        seen = []

        def predict(batch):
            assert len(batch) <= 16
            if any("boom" in t for t in batch):
                raise RuntimeError("down")
            if any("flaky" in t for t in batch) and not seen:
                seen.append(1)
                raise TimeoutError
            return [{"is_question": "?" in t, "question_type": "nonsense", "confidence": 2.0, "title": t} for t in batch]

        return predict

    texts = ["a?", "b", "boom"] + [f"t{i}?" for i in range(40)] + ["flaky?"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").coalesce(1)
    score = classify.model_classifier(stub_model, "m", batch=1, waits=(0.0, 0.0))
    rows = {r["id"]: r["verdict"] for r in score(df, "text").collect()}
    assert len(rows) == len(texts)
    assert (rows[2]["reason"], rows[2]["llm_model"], rows[2]["is_question"]) == ("llm_error", "error:m", False)
    assert (rows[0]["is_question"], rows[0]["confidence"], rows[0]["question_type"]) == (True, 1.0, "other")
    assert rows[1]["title"] is None and rows[43]["is_question"] and rows[43]["llm_model"] == "m"
    whole = classify.model_classifier(stub_model, "m", waits=())
    assert [r["verdict"]["title"] for r in whole(df.where("id > 2 AND id < 43"), "text").orderBy("id").collect()] == texts[3:43]


def test_memoized_scores_each_text_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def predict(batch):
            calls.add(len(batch))
            return [{"is_question": True, "confidence": 0.5, "title": t} for t in batch]

        return predict

    score = classify.model_classifier(load, "m")
    df = spark.createDataFrame([(i, f"text {i % 3}") for i in range(90)], "id int, text string")
    first = classify.memoized(df, "text", score, "m")
    assert {r["verdict"]["title"] for r in first.collect()} == {"text 0", "text 1", "text 2"}
    assert calls.value == 3
    known = first.where("text != 'text 2'").select("text_key", "verdict").distinct()
    again = classify.memoized(df, "text", score, "m", known)
    assert again.where("verdict IS NULL").count() == 0 and again.count() == 90


def test_second_model_only_sees_the_band(spark):
    df = spark.createDataFrame([("How do I?",), ("Uploaded it",)], "text string")

    def second(rows, text):
        return rows.withColumn("verdict", verdicts.cue_count_verdict(F.lit("why is it and how")))

    got = {r["text"]: r["verdict"]["llm_model"] for r in classify.two_stage(df, second=second).collect()}
    assert got == {"How do I?": verdicts.MODEL, "Uploaded it": verdicts.SECOND_MODEL}


def test_embedding_model_seam(spark):
    from faqspark.operators.embedding import model_udf

    encode = model_udf(lambda: lambda texts: [[len(t), 1.0] for t in texts])
    assert apply(spark, ["ab", "abc"], encode) == [[2.0, 1.0], [3.0, 1.0]]


@pytest.mark.parametrize("text, want", [
    ("Größe, naïve; ÉCOLE 42", ["größe", "naïve", "école", "42"]), ("Привет, как дела?", ["привет", "как", "дела"]),
    ("如何安装 Spark", ["如", "何", "安", "装", "spark"]), ("ひらカタ", ["ひ", "ら", "カ", "タ"]), ("cafe\u0301 x", ["cafe\u0301", "x"]), ("…!", []),
])
def test_tokens_of_all_scripts(spark, text, want):
    from faqspark.functions.text import tokens

    assert apply(spark, [text], tokens) == [want]


@pytest.mark.parametrize("lang, text, asks", [
    ("es", "Cómo se hace", 1), ("es", "¿Por qué no va", 1), ("es", "Cuándo es eso", 1), ("es", "Comoé es", 0), ("fr", "Où est le lien", 1),
    ("de", "Wie geht das", 1), ("de", "Wieé geht", 0),
])
def test_accented_cues(spark, lang, text, asks):
    rows = classify.questions_by_language(spark.createDataFrame([(lang, text)], "lang string, text string")).collect()
    assert [r["questions"] for r in rows] == [asks]


def test_short_answer_lists_are_failures(spark):
    """A model that returns fewer answers than texts must not shift rows."""
    score = classify.model_classifier(lambda: lambda texts: [], "m", waits=(0.0, 0.0))
    rows = score(spark.createDataFrame([("a",), ("b",)], "text string"), "text").collect()
    assert [(r["attempts"], r["verdict"]["reason"]) for r in rows] == [(3, "llm_error")] * 2
