"""Question rules and the verdict record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from faqspark.schemas import VERDICT

# Question types in matching order, and the shape of a verdict.
QUESTION_TYPES = ["how-to", "debug", "concept", "setup", "resource", "other"]
TITLE_WORDS = 12
MODEL = "rules-v1"
SECOND_MODEL = "rules-v2"

# Cue patterns, matched against lower-case text.
ASK_WORDS = (
    "how|what|why|when|where|which|who|whose|can|could|does|do|did|is|are|should|would|will|has|have"
)
ASK_START = rf"(^|[.!?\n] *)({ASK_WORDS})[^a-z]"
ASK_ANYWHERE = rf"(^|[^a-z])({ASK_WORDS})[^a-z]"
IMPLICIT = r"stuck on|how to|need help|any idea"
SMALL_TALK = r"^ *(hi|hello|hey|thanks|thank you|fyi|update)([^a-z]|$)"
PREFILTER = r"[?]|(^|[^a-z])(who|what|when|where|why|which|how)([^a-z]|$)"
TYPE_CUES = [
    ("how-to", r"how (do|to|can|should)"),
    ("debug", r"error|fail|exception|traceback|fix|bug|stuck"),
    ("concept", r"what is|what are|why|difference|explain|meaning"),
    ("setup", r"install|setup|set up|configur|environment"),
    ("resource", r"link|video|slides|docs|notebook|where can"),
]
LANGUAGE_CUES = [
    ("en", r"(^|[.!?\n] *)(how|what|why|when|where|which|who)[^\p{L}]"),
    ("de", r"(^|[.!?\n] *)(wie|was|warum|wann|wo|welche|wer)[^\p{L}]"),
    ("fr", r"(^|[.!?\n] *)(comment|quoi|pourquoi|quand|quel|quelle|qui|que|où)[^\p{L}]"),
    ("es", r"(^|[.!?\n] *)¿? *(c[oó]mo|por qu[eé]|cu[aá]ndo|d[oó]nde|cu[aá]l|qui[eé]n|qu[eé])[^\p{L}]"),
]

VERDICT_FIELDS = VERDICT.names


def looks_like_question(text: Column) -> Column:
    """Cheap pre-filter: a question mark or a WH-word anywhere."""
    return F.lower(text).rlike(PREFILTER)


def short_title(text: Column, words: int = TITLE_WORDS) -> Column:
    parts = F.filter(F.split(text, r"[ \t\r\n]+"), lambda w: w != "")
    return F.array_join(F.slice(parts, 1, words), " ")


def question_type(low: Column) -> Column:
    out = F.lit(QUESTION_TYPES[-1])
    for name, cue in reversed(TYPE_CUES):
        out = F.when(low.rlike(cue), F.lit(name)).otherwise(out)
    return out


def _verdict(
    is_question: Column, kind: Column, confidence: Column, title: Column, reason: Column, model: str
) -> Column:
    return F.struct(
        is_question.alias("is_question"),
        kind.alias("question_type"),
        confidence.alias("confidence"),
        title.alias("title"),
        reason.alias("reason"),
        F.lit(model).alias("llm_model"),
        F.lit(0).alias("latency_ms"),
        F.lit(None).cast("string").alias("request_id"),
    )


# Outcome of each rule as (is a question, confidence, reason); rule 0 is "none matched".
RULES = [
    (False, 0.55, "No sign of a question."),
    (False, 0.99, "Automated message."),
    (True, 0.95, "Question mark and question word."),
    (True, 0.9, "Question mark."),
    (False, 0.85, "Greeting, thanks or notice."),
    (True, 0.7, "Sentence starts with a question word."),
    (True, 0.6, "Implicit request for help."),
]


def rule_number(text: Column, role: Column | None = None) -> Column:
    """Number of the first rule that matches, so each pattern runs at most once per row."""
    low = F.lower(text)
    bot = F.lit(False) if role is None else F.coalesce(role == "system", F.lit(False))
    return (
        F.when(bot, 1)
        .when(text.contains("?"), F.when(low.rlike(ASK_START), 2).otherwise(3))
        .when(low.rlike(SMALL_TALK), 4)
        .when(low.rlike(ASK_START), 5)
        .when(low.rlike(IMPLICIT), 6)
        .otherwise(0)
    )


def rule_verdict(rule: Column, text: Column) -> Column:
    """Verdict for a rule number; title and type are worked out for questions only."""
    asks, sure, why = (F.array(*[F.lit(r[i]) for r in RULES]) for i in range(3))
    is_question = F.get(asks, rule)
    return _verdict(
        is_question,
        F.when(is_question, question_type(F.lower(text))).otherwise(F.lit("other")),
        F.get(sure, rule),
        F.when(is_question, short_title(text)),
        F.get(why, rule),
        MODEL,
    )


def cue_count_verdict(text: Column) -> Column:
    """Second opinion: at least two question words anywhere."""
    low = F.lower(text)
    cues = F.regexp_count(low, F.lit(ASK_ANYWHERE))
    is_question = cues >= 2
    return _verdict(
        is_question,
        F.when(is_question, question_type(low)).otherwise(F.lit("other")),
        F.when(is_question, F.lit(0.8)).otherwise(F.lit(0.75)),
        F.when(is_question, short_title(text)),
        F.when(is_question, F.lit("Several question words.")).otherwise(
            F.lit("Fewer than two question words.")
        ),
        SECOND_MODEL,
    )


def failed_verdict(model: str) -> Column:
    """Stands in for a call that failed for good; the row is kept."""
    return _verdict(
        F.lit(False), F.lit("other"), F.lit(0.0), F.lit(None).cast("string"),
        F.lit("llm_error"), f"error:{model}",
    )


def normalized_verdict(verdict: Column, model: str) -> Column:
    """Force a model's answer into the contract; a missing answer becomes the failure record."""
    asks = F.coalesce(verdict["is_question"], F.lit(False))
    clean = F.struct(
        asks.alias("is_question"),
        F.when(verdict["question_type"].isin(QUESTION_TYPES), verdict["question_type"])
        .otherwise(F.lit("other")).alias("question_type"),
        F.least(
            F.greatest(F.coalesce(verdict["confidence"], F.lit(0.0)), F.lit(0.0)), F.lit(1.0)
        ).alias("confidence"),
        F.when(asks, short_title(verdict["title"])).alias("title"),
        verdict["reason"].alias("reason"),
        verdict["llm_model"].alias("llm_model"),
        verdict["latency_ms"].alias("latency_ms"),
        verdict["request_id"].alias("request_id"),
    )
    return F.when(verdict.isNotNull(), clean).otherwise(failed_verdict(model))


def verdict_columns(verdict: Column) -> list[Column]:
    """Names under which a verdict enters an FAQ item."""
    return [
        verdict["is_question"].alias("is_question"),
        verdict["confidence"].alias("llm_confidence"),
        verdict["llm_model"].alias("llm_model"),
        verdict["title"].alias("question_title"),
        verdict["question_type"].alias("question_type"),
        verdict["reason"].alias("question_reason"),
    ]
