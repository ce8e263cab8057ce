"""Packing and mixing: round trips and exact bookkeeping."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ruleweave.llm import mixing, packing

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = {"ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def test_chunked_ids_equal_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    parts = ["a", "word", "Wörter", " ", "  ", "\n", "\n ", " \n", "\t", "it's", "1234", "!?", "\xa0", "🙂", "<|endoftext|>", "\r\n"]
    pick = random.Random(2)
    bpe = packing.ByteBpe(**BPE)
    for _ in range(400):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 25)))
        assert np.frombuffer(bpe.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_are_found_as_the_tokenizer_finds_them():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, added = Tokenizer.from_file(path), packing.added_tokens(path)
    assert dict(added)["<|endoftext|>"] == plain.token_to_id("<|endoftext|>")
    parts = ["a", " word", "Wörter", " ", "  ", "\n", "<|endoftext|>", "<|endoftext|", "|>", "<", "🙂"]
    pick, bpe = random.Random(3), packing.ByteBpe(**BPE, added=added)
    for _ in range(400):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 12)))
        assert np.frombuffer(bpe.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def plain_best_fit(counts, capacity):
    """Sequences of one-by-one best fit, largest first."""
    gaps = [0] * (capacity + 1)
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            gap = next((g for g in range(size, capacity + 1) if gaps[g]), None)
            if gap is None:
                gap = capacity
            else:
                gaps[gap] -= 1
            gaps[gap - size] += 1
    return sum(gaps)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_rank_once_within_capacity(seed):
    pick = random.Random(seed)
    capacity = pick.choice([16, 100, 1024])
    counts = {s: pick.randint(0, 50) for s in range(1, capacity + 1) if pick.random() < 0.6}
    plan, used = packing.plan_runs(counts, capacity)
    ranks, filled = defaultdict(list), defaultdict(list)
    for size, first, n, sequence, offset in plan.tolist():
        ranks[size] += range(first, first + n)
        for i in range(n):
            filled[sequence + i].append((offset, size))
    assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in counts.items() if n}
    for pieces in filled.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= capacity
    assert len(filled) == used <= plain_best_fit(counts, capacity) + 1


def test_many_small_pieces_fill_sequences():
    plan, used = packing.plan_runs({5: 10_000, 1: 3}, 1024)
    assert used == -(-50_003 // 1020) and plan[:, 2].sum() == 10_003


def test_edge_rows_pack_without_loss(edge, empty, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 3)
    pieces = packing.token_pieces(edge, **BPE, capacity=64)
    packed = packing.best_fit_pack(pieces, capacity=64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == Counter(map(tuple, pieces.collect()))
    by = defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert {r.length for r in packed if r.doc_id in (3, 4)} == {1}
    assert packing.best_fit_pack(packing.token_pieces(empty, **BPE)).count() == 0


def test_pieces_cover_the_ids(spark):
    text = " ".join(f"word{i}" for i in range(700))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ids = packing.ByteBpe(**BPE).ids(text) + np.array([2], "<u4").tobytes()
    rows = sorted(map(tuple, packing.token_pieces(df, **BPE, capacity=256).collect()), key=lambda r: r[1])
    assert [r[3] for r in rows][1:] == [256] * (len(rows) - 1) and sum(r[3] for r in rows) == len(ids) // 4
    for _, _, start, length, crc in rows:
        assert crc == zlib.crc32(ids[4 * start : 4 * (start + length)])


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        left = total - sum(stopped.values())
        shares = {s: left * w[s] / sum(w[o] for o in open_) for s in open_}
        over = [s for s in open_ if shares[s] > most * sizes[s]]
        if not over:
            return {**stopped, **shares}
        stopped |= {s: most * sizes[s] for s in over}


def test_targets_match_repeated_sharing(spark):
    pick = random.Random(1)
    for _ in range(4):
        sizes = {s: pick.choice([0, 3, 50, 900, 20_000]) for s in [None, "b", "é", "Z", "a", "c", "d"]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def mixed_rows(df):
    return mixing.mix_sources(df, mixing.document_keys()).select("row.doc_id", "source", "size", "source_size", "target", "copies")


@pytest.mark.parametrize("bucket_rows", [3, 20_000])
def test_taken_words_come_near_their_targets(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    pick = random.Random(3)
    rows = [(i, " ".join(["w"] * pick.randint(0, 40)), pick.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixed_rows(df).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    targets, taken = plain_targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source]) and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - targets[s]) <= 40 for s in sizes)
    # Complete epochs come first: within a source, copies differ by one at most.
    for s in sizes:
        assert len({r.copies for r in got if r.source == s and r.size}) <= 2
    assert sorted(map(repr, got)) == sorted(map(repr, mixed_rows(df.repartition(7)).collect()))


def test_better_texts_are_taken_first(spark):
    rows = [(i, ("w " * 20) if i % 2 else ("1#2 " * 20), "a") for i in range(400)] + [(1000 + i, "w " * 400, "b") for i in range(3)]
    got = mixed_rows(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = Counter((r.doc_id % 2, r.copies) for r in got if r.source == "a")
    most = max(c for _, c in taken)
    assert taken[1, most] > 1.5 * taken[0, most]


def test_edge_rows_mix(edge, empty):
    got = mixed_rows(edge).collect()
    assert len(got) == edge.count() and all(r.copies <= 3 for r in got)
    words = {r.doc_id: r.size for r in got}
    assert words[3] == words[4] == words[6] == 0
    assert mixed_rows(empty).count() == 0


def test_mixing_is_native(edge, capfd):
    mixed_rows(edge).explain()
    plan = capfd.readouterr().out
    assert not re.search("Python|Arrow|CartesianProduct|NestedLoop", plan)
