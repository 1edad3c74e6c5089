import hashlib
import math
import re
import time

import public_tokenizers
import pytest
from llm.helpers import SF_DIR, documents, read

from tidemark.llm import secrets
from tidemark.llm.registry import QUERIES

PATTERNS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def base(text):
    return [[(m.start(), m.end()) for m in p.finditer(text or "") if len(m[g]) >= least] for _, p, g, least in PATTERNS]


def digest(found):
    ordered = sorted((a, k, b) for k, spans in enumerate(found) for a, b in spans)
    return hashlib.sha256(",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in ordered).encode()).hexdigest()


TEXTS = [
    None, "", "é password = hunter22 and TOKEN:'abc' secret=" + "0f" * 12, "api_key: AKIA" + "A1" * 9 + "x" + "ab" * 12,
    "toKen=abcdefgh paſsword=abcdefgh", "https://me:v9$Kq2!mLp7#w@host/x pwd: Tr0ub4dor&3xQ", "pass: 12345678 password is fine", "token=" + "a" * 100_000,
]


def test_base_spans_and_counts(spark):
    rows = secrets.scan_secrets(documents(spark, TEXTS).selectExpr("*", "1 AS secret_spans")).orderBy("doc_id").collect()
    for row, text in zip(rows, TEXTS):
        found = base(text)
        assert [[(s.start, s.end) for s in row.secret_spans if s.kind == k] for k, *_ in PATTERNS] == found
    extra = [s for s in rows[5].secret_spans if s.kind == "guess"]
    assert [TEXTS[5][s.start : s.end] for s in extra] == ["v9$Kq2!mLp7#w", "Tr0ub4dor&3xQ"]
    assert not rows[6].secret_spans


@pytest.mark.parametrize(("weak", "strong"), [("password123", "x9$Kq2!vLp7#"), ("qwertyuiop", "qmzertyxuvio"), ("2024-01-01", "8271-93-40xk"), ("aaaaaaaaaaaaaaaa", "ajwqzkfmbeov")])
def test_cheap_values_cost_less(weak, strong):
    assert secrets.guess_bits(weak) < 24 < 36 < secrets.guess_bits(strong)


def test_cost_is_the_least_over_segmentations():
    assert secrets.guess_bits("") == 0
    assert secrets.guess_bits("12") <= 2 * 3.33 + 1
    value = "password" * 40
    assert secrets.guess_bits(value, 30) >= 30 and secrets.guess_bits(value) >= secrets.guess_bits(value, 30)
    assert secrets.guess_bits("passwordpassword") <= 2 * secrets.guess_bits("password")


def test_words_of_the_vocabulary(spark):
    path = public_tokenizers.path(secrets.VOCABULARY)
    words = secrets.vocabulary_words(path)
    assert words.rank["password"] == 1 and 1000 < len(words.rank) <= secrets.MOST_WORDS
    for weak in ("configuration", "recovery2", "Dragon"):
        assert secrets.guess_bits(weak, words=words) < 36, weak
    for strong in ("xkqzvwjpfmbt", "v9$Kq2!mLp7#w", "correctzebrahorsebatterystaple"):
        assert secrets.guess_bits(strong, words=words) > 36, strong
    docs = documents(spark, ["credentials: configuration, password recovery2 and pwd: v9$Kq2!mLp7#w"])
    assert [len(r.secret_spans) for r in secrets.scan_secrets(docs, vocabulary=path).collect()] == [1]


def _least(value, words, memo):
    """guess_bits of plain letters by trying every way, with the segment before as state."""

    def go(i, brute):
        if i == len(value):
            return 0.0
        if (i, brute) not in memo:
            ways = [secrets._alphabet(value[i]) + (not brute) + go(i + 1, True)]
            for end in range(i + 3, len(value) + 1):
                part = value[i:end]
                if part in words.rank:
                    ways.append(1 + math.log2(words.rank[part] + 1) + go(end, False))
            memo[i, brute] = min(ways)
        return memo[i, brute]

    return go(0, False)


@pytest.mark.parametrize("value", ["xmasterx", "zqdragonvpw", "kevmonkeyq", "secretmaster", "pxb"])
def test_cost_equals_brute_force(value):
    # the walks and repeats of these values are no cheaper than their words and letters
    assert secrets.guess_bits(value) == pytest.approx(_least(value, secrets.COMMON, {}))


def test_long_repeats_are_cheap():
    for size in (64, 65, 300, 5000):
        assert secrets.guess_bits("a" * size, 36) < 36
        assert secrets.guess_bits("a" * size + "v9$Kq2!m", 36) >= 36
    assert secrets.find_spans("pwd: " + "z" * 500) == []


def test_guesses_inside_base_spans_and_long_schemes():
    text = "token=abcdef1 " * 3 + "x" * 60 + "://me:v9$Kq2!mLp7#w@host"
    found = secrets.find_spans(text)
    assert [k for *_, k in found] == ["assign"] * 3 + ["guess"]
    assert text[found[-1][0] : found[-1][1]] == "v9$Kq2!mLp7#w"


@pytest.mark.parametrize("piece", ["token=abcdef1 ", "pwd: x9$Kq2!vLp7# ", "a://b:", "password ", "pass"])
def test_time_is_linear(piece):
    def seconds(n):
        text, begin = piece * n, time.process_time()
        secrets.find_spans(text)
        return time.process_time() - begin

    assert seconds(32_000) < 0.5 + 20 * seconds(4_000)


def test_redaction(spark):
    docs = documents(spark, ["a token=abcdef1 b", None, "", "none"])
    assert [r.text for r in secrets.redact_secrets(docs).orderBy("doc_id").collect()] == ["a [SECRET] b", None, "", "none"]
    assert secrets.redact_secrets(docs).columns == docs.columns
    assert secrets.redact_secrets(documents(spark, [])).count() == 0
    spans = [{"start": 0, "end": 3}, {"start": 2, "end": 5}, {"start": 6, "end": 7}]
    assert secrets.redact("abcdefgh", spans, "*") == "*f*h"


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op7_secret_scan"](spark, SF_DIR).collect()}
    rows = read("documents", "doc_id, text")
    for doc_id, text in rows:
        found, r = base(text), got[doc_id]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (*map(len, found), digest(found))
    assert len(got) == len(rows)


def test_redaction_is_one_pass(spark):
    plan = secrets.redact_secrets(documents(spark, ["a password=abcdef1 b"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
