"""Personal data and quality rules against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ruleweave.llm import pii, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    total = 0
    for i, ch in enumerate(reversed(s)):
        x = int(ch) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def plain_spans(text):
    text = text or ""
    found = {
        "email": [m for m in EMAIL.finditer(text)],
        "ip": [m for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))],
        "phone": [m for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15],
    }
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, ms in found.items() for m in ms)


def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


@pytest.fixture(scope="module")
def mixed(spark):
    parts = ["a", "b.", "@", ".", "1", "2", "55", "255", "256", "+", "-", " ", "(", ")", "x.com", "4111111111111111", "\n"]
    parts += ["é", "_", "%", "5500 0000 0000 0004", "🙂", "the ", "cat ", "# ", "\x85", "\xa0", "\x1c", "\x0b"]
    pick = random.Random(5)
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 50))) for _ in range(600)]
    texts += ["1" * 4000, "a" * 20_000 + "@", "a@" + "b." * 4000 + "c", "+" + "1" * 3000, "1 " * 6000, "1." * 4000, "a@b.c " * 900]
    texts += ["one two three " * 40, "a b\na b\n\n \na b", None, ""]
    return list(enumerate(texts)), spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").cache()


def test_base_spans_match_plain_patterns(mixed):
    texts, df = mixed
    rows = pii.find_spans(df).select("row.doc_id", pii.span_list(pii.BASE_KINDS).alias("s")).collect()
    assert {r.doc_id: r.s for r in rows} == {i: plain_spans(t) for i, t in texts}


def test_measures_match_plain_counts(mixed):
    texts, df = mixed
    rows = quality.measure(df).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert got == {i: plain_quality(t) for i, t in texts}


def test_checksums_and_context(spark):
    texts = [
        "iban DE89 3704 0044 0532 0130 00 ok",
        "iban DE88 3704 0044 0532 0130 00 no",
        "my SSN is 123-45-6789 there",
        "part 123-45-6789 there",
        "call me: phone 0221 4567 890",
        "route 0221 4567 890",
        'token = "b44e15e09fd311c3cf3163b66d5a9f3e4d2c1b0a"',
        "4111 1111 1111 1111 and 4111 1111 1111 1112",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find_spans(df).select(
        "row.doc_id", pii.span_list(pii.BASE_KINDS + pii.MORE_KINDS).alias("s"), pii.mask(F.col("text")).alias("m")
    )
    got = {r.doc_id: (r.s, r.m) for r in rows.collect()}
    assert got[0] == ("iban:5:32", "iban <IBAN> ok")
    assert got[2] == ("ssn:10:21", "my SSN is <SSN> there")
    assert got[4] == ("local_phone:15:28", "call me: phone <LOCAL_PHONE>")
    assert got[6][1] == 'token = "<SECRET>"'
    assert got[7] == ("card:0:19", "<CARD> and 4111 1111 1111 1112")
    assert [got[i][0] for i in (1, 3, 5)] == ["", "", ""]


def test_overlapping_spans_are_masked_once(spark):
    df = spark.createDataFrame([(0, "x +1.2.3.4.567.8901 y 1.2.3.4@b.co z")], "doc_id long, text string")
    (row,) = pii.find_spans(df).select(pii.mask(F.col("text")).alias("m")).collect()
    assert row.m == "x <PHONE> y <EMAIL> z"


def test_running_sums_over_several_blocks(spark):
    df = spark.range(1).select(pii.running_sums(F.sequence(F.lit(1), F.lit(700))).alias("s"))
    assert df.first().s == [n * (n + 1) // 2 for n in range(1, 701)]


def test_edge_rows(edge, empty):
    found = pii.find_spans(edge).select("row.*", pii.mask(F.col("text")).alias("m"))
    assert found.count() == edge.count() and "m" in found.columns
    judged = quality.judge(quality.measure(edge))
    assert judged.count() == edge.count()
    assert all(r.base_failed and not r.kept for r in judged.collect() if r.n_words < 50)
    assert pii.find_spans(empty).count() == 0 and quality.judge(quality.measure(empty)).count() == 0


def test_rules_name_what_fails(spark):
    good = " ".join(f"the word{i} of a text{i} in this line{i}" for i in range(12))
    df = spark.createDataFrame([(1, good), (2, good.upper()), (3, good.replace("the", "###"))], "doc_id long, text string")
    got = {r.doc_id: (r.kept, r.failed_rules) for r in quality.judge(quality.measure(df)).collect()}
    assert got[1] == (True, "") and got[2] == (False, "upper_case_share") and "symbols_per_word" in got[3][1]


def test_native_plans(edge, capfd):
    pii.find_spans(edge).select("spans").explain()
    quality.judge(quality.measure(edge)).explain()
    plan = capfd.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
