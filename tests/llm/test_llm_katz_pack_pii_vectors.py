"""Katz model, packing, personal data and vectors against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_cases import docs, empty, rows
from tokenizers import Tokenizer

from faqspark.llm import boosting, embedding_tiles, katz, packing, pii

FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return (text or "").encode().translate(FOLD).split() + [None]


class BruteKatz:
    def __init__(self, table):
        learnt = [tokens(t) for k, t in table if k is not None and zlib.crc32(str(k).encode()) % 7 != 2]
        self.one, self.two = Counter(), Counter()
        for w in learnt:
            self.one.update(w)
            self.two.update(zip([0] + w[:-1], w))
        self.n, self.v, self.d = sum(self.one.values()), len(self.one), len(learnt)
        def numbers(c):
            return np.bincount(np.minimum(list(c.values()) or [0], 7), minlength=8)[1:7]

        self.n1, self.f1, self.f2 = numbers(self.one), katz.discounts(numbers(self.one)), katz.discounts(numbers(self.two))
        self.rest, self.known = Counter(), Counter()
        for (a, w), c in self.two.items():
            self.rest[a] += c * (1 - self.factor(self.f2, c))
            self.known[a] += self.alone(w)

    @staticmethod
    def factor(f, c):
        return f[c - 1] if c <= 5 else 1

    def alone(self, w):
        if c := self.one.get(w, 0):
            return self.factor(self.f1, c) * c / (self.n + 1)
        return (1 + sum(r * self.n1[r - 1] * (1 - self.f1[r - 1]) for r in range(1, 6))) / (self.n + 1)

    def chance(self, a, w):
        h = self.d if a == 0 else self.one.get(a, 0)
        if c := self.two.get((a, w), 0):
            return self.factor(self.f2, c) * c / (h + 1)
        return (1 + self.rest.get(a, 0)) / (h + 1) / (1 - self.known.get(a, 0)) * self.alone(w)

    def row(self, key, text):
        w = tokens(text)
        return (key, len(w), sum(x in self.one for x in w), self.n, sum(math.log10((self.one.get(x, 0) + 1) / (self.n + self.v + 1)) for x in w),
                sum(math.log10(self.chance(a, x)) for a, x in zip([0] + w[:-1], w)))


def same_scores(df, table):
    brute = BruteKatz(table)
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = sorted((brute.row(k, t) for k, t in table), key=order)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()), key=order)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=0, atol=1e-6)
    return brute


@pytest.mark.parametrize("bucket_tokens", [katz.BUCKET_TOKENS, 2000])
def test_katz_against_brute_force(spark, bucket_tokens):
    """With few tokens per bucket, frequent words and pairs are spread over several."""
    rng = random.Random(4)
    table = [r[:2] for r in rows()] + [(1000 + k, "the of " + " ".join(f"v{int(rng.paretovariate(0.8))}" for _ in range(80))) for k in range(150)]
    frame = spark.createDataFrame(table, "doc_id bigint, text string").repartition(4)
    brute = same_scores(katz.katz_scores(frame, bucket_tokens=bucket_tokens), table)
    for history in (0, b"the", b"v1"):
        total = sum(brute.chance(history, w) for w in brute.one) + brute.chance(history, b"never seen")
        assert total == pytest.approx(1)


def test_katz_without_training_rows(spark):
    same_scores(katz.katz_scores(spark.createDataFrame([(None, "a b"), (None, None)], "doc_id bigint, text string")), [(None, "a b"), (None, None)])
    assert katz.katz_scores(empty(spark)).count() == 0


def test_discounts_stay_between_zero_and_one():
    for counts in ([0] * 6, [5, 0, 0, 0, 0, 0], [10, 6, 4, 3, 2, 1], [1, 9, 9, 9, 9, 9]):
        assert ((katz.discounts(np.array(counts)) > 0) & (katz.discounts(np.array(counts)) <= 1)).all()


ODD_TEXTS = [(30, "Á ét ́x <|endoftext|> it's <|STARTOFTEXT|>don't x y 　 \U0001f600\U0001f600 ΑΣ Σας İstanbul ﬁ ǅ\x1c\x85 z"), (31, "12345 we'll 'S ''s")]


def test_packing_round_trip(spark):
    table = [r[:2] for r in rows() if r[0] != 20] + ODD_TEXTS
    pieces = packing.packed(spark.createDataFrame(table, "doc_id bigint, text string").repartition(3)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
    for key, text in table:
        if key is None:
            continue
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p in sorted(by_doc[key], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and 0 < p.length <= 4096
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert no_gaps(pieces)
    assert packing.packed(empty(spark)).count() == 0


def no_gaps(pieces, longest=4096):
    end = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        if p.offset != end[p.sequence_id]:
            return False
        end[p.sequence_id] += p.length
    return max(end.values()) <= longest and sorted(end) == list(range(len(end)))


def test_repeated_rows_are_packed_each(spark):
    pieces = packing.packed(docs(spark)).collect()
    assert sum(p.doc_id == 20 for p in pieces) == 2 and sum(p.doc_id is None for p in pieces) >= 2


@pytest.mark.parametrize("seed", range(4))
def test_placements_fill_sequences(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randrange(1, 300) for n in rng.sample(range(1, 4097), 200)} | {4096: 5, 15: 5000 * (seed % 2)}
    spans = {}
    for length, rank, count, first, offset in packing.placements(histogram).tolist():
        spans.setdefault(length, []).append((rank, count))
        for k in range(count):
            spans.setdefault("used", []).append((first + k, offset, length))
    for length, count in histogram.items():
        at = 0
        for rank, n in sorted(spans.get(length, [])):
            assert rank == at
            at += n
        assert at == count
    end = Counter()
    for sequence, offset, length in sorted(spans["used"]):
        assert end[sequence] == offset
        end[sequence] += length
    assert max(end.values()) <= 4096
    assert sum(end.values()) / (4096 * len(end)) > 0.9


PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    found = []
    for kind, pattern in zip(pii.KINDS, PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                    "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                found.append((kind, m.start(), m.end()))
    return found


def test_base_spans_equal_plain_patterns():
    rng = random.Random(2)
    pieces = ["a@b.c", "@", "@x.y", "..@-.-", "4111 1111 1111 1111", "4111-1111-11111111", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.4", "+1 (555) 123-4567",
              "++49 30 1234", "+1", " ", "é", "7", "-", ".", "x@y.z@w.v", "%+-@a-b.c-d"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text
    for text in ("9" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+" * 50_000, "@a" * 50_000):
        pii.base_spans(text)
        pii.proposals(text)


def corpus(spark, n=1500):
    rng = random.Random(9)
    table = []
    for k in range(n):
        card = [rng.randrange(10) for _ in range(15)]
        card = next("".join(map(str, card + [d])) for d in range(10) if pii.luhn("".join(map(str, card + [d]))))
        own = (f"mail to u{k}@mail{k % 7}.example.com now", f"host {rng.randrange(256)}.{k % 256}.3.{rng.randrange(256)} is up", f"card {card} was used",
               f"call +1 ({200 + k % 700}) 555-{1000 + k} today", f"number {rng.randrange(10**6)} of {rng.randrange(10**9)} things", f"order {rng.randrange(10**13)} shipped")[k % 6]
        table.append((k, " ".join(f"w{rng.randrange(500)}" for _ in range(20)) + " " + own + " and so on"))
    return table


def test_trees_find_disguised_spans_and_leave_others(spark):
    table = corpus(spark)
    model = pii.train(spark.createDataFrame(table, "doc_id bigint, text string"))
    hidden = ["write to jim at mail3.example.com", "mail to ann.lee at mail3 dot example dot com now", "mail me: bob(at)mail1(dot)example(dot)com today"]
    assert sum(any(k == "email" for k, _, _ in pii.spans_of(t, model)[1]) for t in hidden) >= 2
    assert pii.spans_of("chapter 12 of 3456 pages, we met at ten dot", model)[1] == []


def test_personal_data_awkward_rows(spark):
    table = corpus(spark, 300) + [(None, "x a@b.co y"), (5000, None), (5001, ""), (5002, "a@b.co " * 3), (5002, "a@b.co " * 3)]
    frame = spark.createDataFrame([(*r, "t") for r in table], "doc_id bigint, text string, spans string")
    got = pii.personal_data(frame).collect()
    want = Counter((k, hashlib.sha256(pii.joined(plain_spans(t)).encode()).hexdigest()) for k, t in table)
    assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    assert pii.personal_data(empty(spark)).count() == 0
    clean = pii.redacted(frame)
    assert clean.columns == frame.columns
    assert clean.where("doc_id = 5002").first().text == "[EMAIL] [EMAIL] [EMAIL] "
    assert clean.where("doc_id = 5000").first().text is None
    assert not any(plain_spans(r.text) for r in clean.collect())


def test_a_rare_kind_is_learnt_where_most_documents_have_digits(spark):
    """One document in forty holds a card; all have digits, and the sample is a fifteenth of them."""
    rng = random.Random(4)
    table = []
    for k in range(6000):
        card = [rng.randrange(10) for _ in range(15)]
        card = next("".join(map(str, card + [d])) for d in range(10) if pii.luhn("".join(map(str, card + [d]))))
        own = f"paid by card {card} then" if k % 40 == 0 else f"we saw {100 + k} of {rng.randrange(10**4)} things"
        table.append((4 * k, " ".join(f"w{rng.randrange(500)}" for _ in range(8)) + " " + own + " and so on"))
    model = pii.train(spark.createDataFrame(table, "doc_id bigint, text string"), max_train=400)
    assert model is not None and model.least["card"] <= 1
    assert [s[0] for s in pii.spans_of("w1 w2 w3 paid by card 4111/1111/1111/1111 then and so on", model)[1]] == ["card"]
    assert pii.spans_of("w1 w2 we saw 4111 of 1111 things and so on", model)[1] == []


def test_disguises_of_valid_spans_are_no_negatives():
    for kind, own in (("card", "4111/1111/1111/1111"), ("ip", "1 dot 2 dot 3 dot 4"), ("email", "ann.lee at mail3 dot example dot com"), ("phone", "(555) 123-4567")):
        assert pii.disguised(kind, own) and not any(label == 0 and x[0] == pii.KINDS.index(kind) for label, x in pii.lessons(1, f"so {own} it"))
    for kind, own in (("card", "4111/1111/1111/1112"), ("ip", "1 dot 2 dot 3 dot 256"), ("email", "jim at mail3.example"), ("phone", "5551234567")):
        assert not pii.disguised(kind, own)


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit(x[:1500], y[:1500])
    assert ((trees.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def brute_vectors(table, threshold=0.93):
    def fine(x):
        return x is not None and len(x) and all(v is not None and math.isfinite(v) for v in x) and any(x)

    keys = [(k, np.array(x, np.float32).astype(float), l) for k, x, l in table if k is not None and l is not None and fine(x)]
    links, root = Counter(), {k: k for k, _, _ in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (k, x, l) in enumerate(keys):
        for m, y, n in keys[:i]:
            if l == n and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[k] += 1
                links[m] += 1
                a, b = find(k), find(m)
                root[max(a, b)] = min(a, b)
    return {k: (links[k], find(k) if k in root else k) for k, _, _ in table if k is not None}


@pytest.mark.parametrize("block_numbers", [embedding_tiles.BLOCK_NUMBERS, 256])
def test_vectors_against_brute_force(spark, block_numbers):
    """With small blocks, large labels get pivots and far blocks are left out."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16))
    table = [(k, (centres[k % 12] + 0.22 * rng.normal(size=16)).astype(np.float32).tolist(), int(k % 24 // 12)) for k in range(500)]
    table += [(1000 + k, table[0][1], 0) for k in range(30)] + [(1100, [2 * x for x in table[0][1]], 0), (1101, table[0][1], 1)]
    table += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [None] + [1.0] * 15, 0), (2003, [float("nan")] * 16, 0), (2004, [float("inf")] + [1.0] * 15, 0),
              (2005, table[0][1], None), (2006, [1.0, 2.0], 0), (2007, [1.0, 2.0], 0), (2008, [], 0), (2009, [1e30] * 16, 0), (2010, [1e-30] * 16, 0)]
    frame = spark.createDataFrame([(*r, 1) for r in table] + [(None, table[0][1], 0, 1)], "vec_id bigint, embedding array<float>, label int, id int").repartition(3)
    got = embedding_tiles.near_vectors(frame, block_numbers=block_numbers).collect()
    want = brute_vectors(table)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert embedding_tiles.near_vectors(frame.limit(0)).count() == 0


def test_int8_bound_holds():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, scale, error = embedding_tiles.quantised(x)
    size = np.linalg.norm(q * scale[:, None], axis=1)
    bound = (q.astype(float) @ q.T.astype(float)) * np.outer(scale, scale) + np.outer(size, error) + error[:, None] * (size + error)[None, :]
    assert (bound >= x @ x.T - 1e-12).all()


def test_vectors_of_doubles_are_compared_in_doubles(spark):
    import math

    def at(cosine):
        return [cosine, math.sqrt(1 - cosine * cosine)]

    rows, k = [], 0
    for gap in (1e-9, 2e-9, 5e-10, -1e-9, -5e-10):
        rows += [(k, [1.0, 0.0], k // 2), (k + 1, at(0.93 + gap), k // 2)]
        k += 2
    for scale in (1e300, 1e-300, 1e200):
        rows += [(k, [scale, 0.0], k // 2), (k + 1, [scale * 0.95, scale * 0.2], k // 2)]
        k += 2
    got = {r.vec_id: r.n_links for r in embedding_tiles.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert [got[i] for i in range(0, k, 2)] == [1, 1, 1, 0, 0, 1, 1, 1]


@pytest.mark.parametrize("text", ["Jane.Doe At example Dot com", "write to jane.doe AT example DOT com", "jane (At) example (Dot) org"])
def test_spelt_out_addresses_are_proposed_in_any_case(text):
    assert any(kind == "email" for kind, _, _ in pii.proposals(text))
