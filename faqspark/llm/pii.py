"""Personal data: generators propose spans, boosted trees decide by format and context.

Well-formed emails, ip addresses, cards and phones are always spans. Beyond them, generators of high recall
propose disguised ones ("name at host dot com", numbers without plus sign, odd separators), which may
overlap. The trees learn from the corpus itself: positives are its well-formed spans rewritten into such
disguises in their own context, negatives are its other candidates and rewritten spans with spoilt digits.
All rows are searched for documents to learn from, so a rare kind is learnt too. Thresholds are set per kind
from score histograms over all documents of a fold that the trees have not seen.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from faqspark.llm.boosting import Trees, fit
from faqspark.llm.folds import first_by_hash, held_out
from faqspark.llm.store import Saved
from faqspark.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
#: Documents that the trees learn from, at most, a fifth of them for each kind; characters of context on either side.
MAX_TRAIN, CONTEXT = 4_000, 40
#: One document of so many is kept from the trees; bins of their log odds from even upwards, and bins per unit.
FOLDS, BINS, PER_UNIT = 4, 1024, 64
#: Share of right decisions that a kind's threshold must reach on unseen documents, and spans needed to learn at all.
PRECISION, LEAST_SPANS = 0.99, 40

Span = tuple[str, int, int]

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[Span]:
    at = 0
    while found := _HOST.search(text, at):
        start = found.start()
        while start > at and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            yield "email", start, found.end()
            at = found.end()
        else:
            at = found.start() + 1


def base_spans(text: str) -> list[Span]:
    """Well-formed spans, leftmost and non-overlapping within each kind; by kind, then start.

    Time is linear in the text, also for long runs of letters or digits.
    """
    spans: list[Span] = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    if "." in text:
        spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _octets(m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return spans


# Longest name and label of an address, most labels after the first, most digits: longer candidates are no address or number.
_AT, _DOT = r"(?: ?@ ?| at | ?\(at\) ?| ?\[at\] ?)", r"(?:\.| dot | ?\(dot\) ?| ?\[dot\] ?)"
_LOOSE_EMAIL = re.compile(rf"(?<![\w.%+-])[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}", re.IGNORECASE)
_LOOSE_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?: ?\. ?| dot |\[\.\]|\(\.\))[0-9]{1,3}){3}(?![\w])")
_LOOSE_NUMBER = re.compile(r"(?<![\w+])\(?[0-9](?:[ ()./_-]{0,2}[0-9]){6,24}(?!\w)")


def proposals(text: str) -> list[Span]:
    """Candidate spans of high recall, overlapping ones included."""
    found: list[Span] = []
    lowered = text.lower()
    if any(s in lowered for s in (" at ", "(at)", "[at]", "@")):
        if "dot" in lowered or "@" in text:
            found += [("email", m.start(), m.end()) for m in _LOOSE_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        found += [("ip", m.start(), m.end()) for m in _LOOSE_IP.finditer(text)]
        for m in _LOOSE_NUMBER.finditer(text):
            n = len(_digits(m.group()))
            found += [("card", m.start(), m.end())] * (13 <= n <= 19) + [("phone", m.start(), m.end())] * (7 <= n <= 15)
    return found


_HINTS = {
    "email": re.compile(r"mail|contact|write|reach", re.IGNORECASE), "ip": re.compile(r"\bip\b|address|host|server|login", re.IGNORECASE),
    "card": re.compile(r"card|visa|credit|payment|account", re.IGNORECASE), "phone": re.compile(r"phone|\btel|call|mobile|fax|dial", re.IGNORECASE),
}
_CODE = re.compile(r"=|token|key|\bid\b|version|isbn|http", re.IGNORECASE)


def describe(text: str, span: Span) -> list[float]:
    """Format and context figures of a candidate."""
    kind, start, end = span
    own, before, after = text[start:end], text[max(start - CONTEXT, 0) : start], text[end : end + CONTEXT]
    digits = _digits(own)
    groups = [len(g) for g in re.findall(r"[0-9]+", own)]
    count = lambda chars: float(sum(own.count(c) for c in chars))
    return [
        float(KINDS.index(kind)), float(len(own)), float(len(digits)), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(groups[-1] if groups else 0), float(groups[0] if groups else 0), count("()"), count("."), count("-"), count(" "), count("/_"), count("@"),
        float(bool(re.search(r"\bat\b", own, re.IGNORECASE))), float(bool(re.search(r"\bdot\b", own, re.IGNORECASE))),
        float(bool(digits) and len(digits) <= 19 and luhn(digits)), float(len(groups) == 4 and _octets(re.findall(r"[0-9]+", own))),
        len(re.findall(r"[A-Za-z]", own)) / max(len(own), 1),
        *(float(bool(hint.search(before))) for hint in _HINTS.values()), float(bool(_CODE.search(before))),
        float(before[-1:].isspace() or not before), float(after[:1].isspace() or not after), float(after[:1] in ".,;:!?" and bool(after)),
    ]


def _disguises(kind: str, own: str, pick: int) -> tuple[str, str | None]:
    """A disguised form of a well-formed span, and one that looks like it but is none."""
    if kind == "email":
        at, dot = ((" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("(at)", "."), (" @ ", "."))[pick % 5]
        local, host = own.split("@", 1)
        return local + at + host.replace(".", dot), f"{local.split('.')[-1]} at {host.split('.')[0]}.{host.split('.')[-1]}"
    if kind == "ip":
        sep = (" . ", " dot ", "[.]", "(.)")[pick % 4]
        parts = own.split(".")
        return sep.join(parts), sep.join([*parts[:3], str(256 + pick % 700)])
    digits = _digits(own)
    if kind == "card":
        sep = (".", "/", "  ", "_", " - "[:2])[pick % 5]
        shown = lambda d: sep.join(d[i : i + 4] for i in range(0, len(d), 4))
        return shown(digits), shown(digits[:-1] + str((int(digits[-1]) + 1 + pick % 9) % 10))
    body = own[1:].strip()
    forms = (body, f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}", f"00{body}")
    return forms[pick % 4] if len(digits) >= 10 else body, None


_PLAIN_DISGUISE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+(?: at [A-Za-z0-9-]+(?: dot [A-Za-z0-9-]+)+|\(at\)[A-Za-z0-9-]+(?:(?:\(dot\)[A-Za-z0-9-]+)+|(?:\.[A-Za-z0-9-]+)+)"
                        r"| \[at\] [A-Za-z0-9-]+(?: \[dot\] [A-Za-z0-9-]+)+| @ [A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"),
    "ip": re.compile(r"[0-9]+( \. | dot |\[\.\]|\(\.\))[0-9]+(?:\1[0-9]+){2}"),
    "card": re.compile(r"[0-9]{4}([./_]|  | -)[0-9]{4}\1[0-9]{4}(?:\1[0-9]{4})?(?:\1[0-9]{1,3})?"),
    "phone": re.compile(r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}"),
}


def disguised(kind: str, own: str) -> bool:
    """Whether a candidate equals a disguise of a valid span, so that nobody knows it for a wrong one.

    Bare digits equal a disguised phone as well, but most are other numbers; they are not meant here.
    """
    if not _PLAIN_DISGUISE[kind].fullmatch(own):
        return False
    if kind == "ip":
        return _octets(re.findall(r"[0-9]+", own))
    return kind != "card" or (13 <= len(d := _digits(own)) <= 19 and luhn(d))


def lessons(key: int | None, text: str | None) -> Iterator[tuple[int, list[float]]]:
    """Labels and figures of a text's candidates and of its rewritten spans."""
    text = text or ""
    base = base_spans(text)
    for kind, start, end in base:
        pick = start + 7 * end + (key or 0)
        for label, shape in zip((1, 0), _disguises(kind, text[start:end], pick)):
            if shape:
                head, tail = text[max(start - CONTEXT, 0) : start], text[end : end + CONTEXT]
                whole = head + shape + tail
                for other in [s for s in proposals(whole) if s[1] < len(head) + len(shape) and len(head) < s[2]]:
                    same = other[0] == kind and other[1] == len(head) and other[2] == len(head) + len(shape)
                    yield int(label == 1 and same), describe(whole, other)
    for span in proposals(text):
        if not any(span[1] < e and s < span[2] for _, s, e in base) and not disguised(span[0], text[span[1] : span[2]]):
            yield 0, describe(text, span)


def _lessons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training rows (label, figures) of each text's spans."""
    for batch in slices(batches):
        rows = [(label, np.array(x, np.float32).tobytes()) for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist())
                for label, x in lessons(key, text)]
        label, x = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(x, pa.binary())], names=["label", "x"])


#: Bit beside those of the kinds: the text has candidates.
_CANDIDATES = 1 << len(KINDS)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, holds) of texts with spans or candidates: a bit for each kind of well-formed span, and one for candidates."""
    for batch in slices(batches):
        holds = []
        for text in batch.column("text").to_pylist():
            bits = {1 << KINDS.index(kind) for kind, _, _ in base_spans(text or "")}
            holds.append(sum(bits) | _CANDIDATES * bool(proposals(text or "")))
        keep = np.flatnonzero(holds)
        yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep)), pa.array(np.array(holds, np.int32)[keep], pa.int32())], names=["id", "holds"])


@dataclass(frozen=True)
class Model:
    trees: Trees
    least: dict[str, float]

    def added(self, text: str, base: list[Span], found: list[Span]) -> list[Span]:
        """Proposals over their kind's threshold that touch no well-formed span, the best of overlapping ones."""
        free = [s for s in found if not any(s[1] < e and b < s[2] for _, b, e in base)]
        if not free:
            return []
        scores = self.trees.score(np.array([describe(text, s) for s in free]))
        taken: list[Span] = []
        for score, span in sorted(zip(scores, free), key=lambda p: (-p[0], p[1][1], p[1][2], p[1][0])):
            if score >= self.least[span[0]] and not any(span[1] < e and s < span[2] for _, s, e in taken):
                taken.append(span)
        return taken


def thresholds(counts: np.ndarray) -> dict[str, float]:
    """Per kind the smallest score, not under one half, from which on PRECISION is reached; none (2.0) if no score does.

    ``counts`` has kind, label and bin of the log odds.
    """
    least = {}
    for kind, (wrong, right) in zip(KINDS, counts[:, :, ::-1].cumsum(axis=2)):
        fine = np.flatnonzero((right >= PRECISION * (right + wrong)) & (right >= LEAST_SPANS / 4))
        least[kind] = float(1 / (1 + np.exp(-(BINS - 1 - fine[-1]) / PER_UNIT))) if len(fine) else 2.0
    return least


def bins(scores: np.ndarray) -> np.ndarray:
    """Bin of each score's log odds, -1 under one half."""
    inner = np.clip(scores, 1e-12, 1 - 1e-12)
    return np.clip(np.floor(np.log(inner / (1 - inner)) * PER_UNIT + 1e-6), -1, BINS - 1).astype(np.int64)


def histograms(docs: DataFrame, trees: Trees) -> np.ndarray:
    """Lessons of all rows (id, text) by kind, label and bin of their score; one row per cell reaches the driver."""
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * len(KINDS) * BINS, np.int64)
        for batch in slices(batches):
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                found = list(lessons(key, text))
                if found:
                    label, x = np.array([y for y, _ in found]), np.array([f for _, f in found], np.float32).astype(float)
                    at = bins(sent.value.score(x))
                    cell = (x[:, 0].astype(np.int64) * 2 + label) * BINS + at
                    np.add.at(total, cell[at >= 0], 1)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(total[cell], pa.int64())], names=["cell", "n"])

    counts = np.zeros(2 * len(KINDS) * BINS, np.int64)
    for cell, n in docs.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        counts[cell] = n
    return counts.reshape(len(KINDS), 2, BINS)


def sample(docs: DataFrame, most: int) -> DataFrame:
    """Ids of at most ``most`` rows (id, text), by hash: a fifth each among those that hold a kind, and among those with candidates."""
    held = Saved(docs.mapInArrow(_held, "id bigint, holds int").groupBy("id").agg(F.bit_or("holds").alias("holds")), "pii-held").df
    parts = [first_by_hash(held.where(F.col("holds").bitwiseAND(1 << k) != 0).select("id"), most // (len(KINDS) + 1)) for k in range(len(KINDS) + 1)]
    ids = parts[0]
    for part in parts[1:]:
        ids = ids.unionByName(part)
    return ids.distinct()


def train(docs: DataFrame, *, max_train: int = MAX_TRAIN) -> Model | None:
    """Trees from at most ``max_train`` documents, thresholds from all of an unseen fold; None if there are too few spans.

    The documents to learn from are sought among all rows, for each kind of well-formed span by itself.
    """
    known = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), "text")
    unseen = held_out(F.col("id"), FOLDS)
    ids = sample(known.where(~unseen), max_train).withColumnRenamed("id", "chosen")
    got = known.join(F.broadcast(ids), F.col("id") == F.col("chosen")).select("id", "text").mapInArrow(_lessons, "label int, x binary").toArrow()
    label = got.column("label").to_numpy()
    if label.sum() < LEAST_SPANS or label.all():
        return None
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(len(label), -1).astype(float)
    order = np.lexsort([*x.T, label])
    trees = fit(x[order], label[order].astype(float))
    return Model(trees, thresholds(histograms(known.where(unseen), trees)))


def spans_of(text: str | None, model: Model | None) -> tuple[list[Span], list[Span]]:
    """Well-formed spans and all spans of a text, each by kind and start."""
    text = text or ""
    base = base_spans(text)
    extra = model.added(text, base, proposals(text)) if model else []
    order = lambda s: (KINDS.index(s[0]), s[1], s[2])
    return sorted(base, key=order), sorted(base + extra, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


RESULT = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs``.

    Counts and digest are of the well-formed spans, ``spans`` lists all; offsets are code points. Null and empty texts have
    none. Repeated rows get equal results; rows without doc_id are searched too but not learnt from. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            both = [spans_of(text, sent.value) for text in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in both], pa.int64()) for kind in KINDS]
            digests = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in both], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, digests, pa.array([joined(every) for _, every in both], pa.string())],
                names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(search, RESULT)


def redact(text: str | None, model: Model | None) -> str | None:
    """``text`` with every span replaced by its kind in brackets; overlapping spans are replaced as one, named after the first."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans_of(text, model)[1], key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``n_chars`` counted anew where there is such a column.

    Null and empty texts stay as they are, repeated rows change alike, rows without doc_id are searched but not learnt
    from; an empty table stays empty. All other columns pass through, whatever their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(train(docs))

    @arrow_udf("string")
    def clean(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array([redact(text, sent.value) for text in part.to_pylist()], pa.string())

    changed = docs.withColumn("text", clean(F.col("text")))
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed
