"""Runs against all periods and places tried in turn."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ruleweave.llm import catalog, periods

ROWS = 200_000


def plain_runs(words):
    """(start, period, length) of every run, by trying each period at each place."""
    n, seen, found = len(words), set(), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(6, 4 * q) and (start, length) not in seen:
                seen.add((start, length))
                found.append((start, q, length))
    return sorted(found)


def plain_collapse(words, runs):
    gone = {i for s, q, length in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    crc = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    rest, n = crc // 10, len(words)
    if crc % 10 == 0 and n:
        a = rest % n
        p = 1 + (n - a) // (3 + rest % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    listed = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    longest = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *longest, sha(listed), sha(plain_collapse(words, runs)))


def periodic_text(draw, n):
    """Words of a small alphabet with repeats of repeats in it."""
    words = []
    while len(words) < n:
        unit = [f"w{draw.randrange(3)}" for _ in range(draw.choice([1, 1, 2, 3, 5, 8, 13]))]
        words += unit * draw.choice([1, 2, 4, 5, 9])
        if draw.random() < 0.3:
            words += words[-draw.randrange(1, len(words) + 1) :] * draw.randrange(5)
        if draw.random() < 0.5:
            words.append(f"x{draw.randrange(50)}")
    return words[:n]


@pytest.mark.parametrize("seed", range(12))
def test_sections_find_all_runs(seed):
    draw = random.Random(seed)
    words = [w.encode() for w in periodic_text(draw, draw.choice([1, 5, 40, 200, 700]))]
    numbers = periods.word_numbers(words)
    for section in (32, 64, 4096):
        stretches = {}
        for first, last, begin, size in periods.sections(len(words), section):
            origin, cut = periods._cut(numbers, last, begin, size)
            for q, lo, hi in periods.fragments(cut, first, last, origin, begin, size):
                stretches.setdefault(q, []).append((lo, hi))
        found = {}
        for q, pieces in sorted(stretches.items()):
            joined = []
            for lo, hi in sorted(pieces):
                if joined and lo <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], hi)
                else:
                    joined.append([lo, hi])
            for lo, hi in joined:
                if periods.long_enough(q, hi - lo + q):
                    found.setdefault((lo, hi - lo + q), q)
        assert sorted((s, q, n) for (s, n), q in found.items()) == plain_runs(words)


def test_z_function():
    draw = random.Random(3)
    for _ in range(200):
        s = [draw.randrange(2) for _ in range(draw.randrange(30))]
        z = periods.prefix_lengths(s, len(s))
        for i, k in enumerate(z):
            assert s[i : i + k] == s[:k] and (i + k == len(s) or s[i + k] != s[k])


@pytest.mark.parametrize("section", [32, 16_384])
def test_documents_match_plain_search(spark, section):
    draw = random.Random(8)
    rows = [(i, " ".join(periodic_text(draw, draw.choice([0, 3, 6, 30, 150, 400])))) for i in range(60)]
    rows += [(7, rows[7][1]), (None, "a b a b a b a b a b"), (None, None), (99, ""), (100, "z " * 500), (101, " \t\n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = periods.find_runs(docs, keep=["doc_id", "text"], section=section).collect()
    assert len(out) == len(rows)
    for r in out:
        words = [w.decode() for w in (r["text"] or "").encode().split()]
        runs = plain_runs(words)
        assert [tuple(x) for x in r["runs"]] == runs and r["n_words"] == len(words)
        assert r["collapsed"] == plain_collapse(words, runs)


def test_long_document_is_dealt_out(spark):
    """One text of many sections, whose run spans them all; another that repeats one word throughout."""
    unit = " ".join(f"u{i}" for i in range(700))
    texts = ["start " + " ".join([unit] * 60) + " end", "same " * 40_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in periods.find_runs(docs, keep=["doc_id"], collapsed="text", section=4096).collect()}
    assert [tuple(x) for x in out[0]["runs"]] == [(1, 700, 42_000)]
    assert out[0]["collapsed"] == f"start {unit} end"
    assert [tuple(x) for x in out[1]["runs"]] == [(0, 1, 40_000)] and out[1]["collapsed"] == "same"


def test_query_matches_plain_version(spark, edge, monkeypatch):
    draw = random.Random(21)
    extra = [(1000 + i, " ".join(periodic_text(draw, 60))) for i in range(80)]
    docs = edge.filter("doc_id is null or doc_id != 5").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    monkeypatch.setattr(catalog, "documents", lambda *_: docs)
    got = sorted(map(tuple, catalog.op13_periodic_runs(spark, "").collect()), key=str)
    assert got == sorted((plain_row(*r) for r in docs.collect()), key=str)


def test_edge_rows_and_clashing_columns(spark, edge, empty):
    out = periods.find_runs(edge, keep=edge.columns, collapsed="sha256")
    assert out.count() == edge.count() and out.columns == [*edge.columns, "n_words", "runs", "collapsed"]
    assert periods.find_runs(empty, keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(edge.withColumn("runs", F.lit(1)), keep=["runs"])


def test_a_third_of_rows_alike(spark):
    docs = spark.range(300).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("a b " * 9).alias("text"))
    out = periods.find_runs(docs, keep=["doc_id"])
    assert out.count() == 300 and out.filter("collapsed = 'a b' and size(runs) = 1").count() == 300
