"""Language model and toxicity: exact counts, probabilities that add up, held-out accuracy."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ruleweave.llm import maxent, toxicity
from ruleweave.llm.common import crc_fold

SMALL = maxent.Model(word_classes=2, width=4, ending_classes=4, rows=1 << 10, head=64, counted=50)


def sentences(n, seed=1):
    pick = random.Random(seed)
    words = {"a": ["ana", "alo", "axi", "ato"], "b": ["bob", "bil", "bux", "bee"]}
    out = []
    for i in range(n):
        kind = pick.choice("ab")
        out.append((i, " ".join(pick.choice(words[kind]) + pick.choice(["", "", str(pick.randint(0, 60))]) for _ in range(pick.randint(0, 30)))))
    return out


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_base_scores_are_exact_and_the_model_beats_them(spark):
    rows = sentences(600)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in maxent.score_texts(df, crc_fold("doc_id", 7) == 2, SMALL).collect()}
    counts = Counter(w for i, t in rows if not held(i) for w in maxent.tokens(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in rows:
        words = maxent.tokens(t)
        assert (got[i].n_tokens, got[i].n_known) == (len(words), sum(w in counts for w in words))
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words))
        assert got[i].train_tokens == n and got[i].held_out == held(i)
    fresh = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)


def test_probabilities_add_up(spark):
    rows = sentences(200)
    texts = spark.createDataFrame(rows, "doc_id long, text string").select("text")
    counts = maxent.word_counts(texts, SMALL)
    vocabulary = maxent.Vocabulary.read(counts, SMALL)
    weights = maxent.train(texts, F.pmod(F.xxhash64("text"), F.lit(2)), vocabulary, SMALL)
    tables, encoder = maxent.Tables(SMALL, *weights), maxent.Encoder(vocabulary, SMALL)
    every = {bytes(r.word): r.c for r in counts.collect()}
    for history in (b"", b"ana bob", b"bil bil unseen"):
        total = 0.0
        for word in [*every, None]:
            words = [*history.split(), word or b"zzz"]
            number, kinds, hashed = encoder.encode(words)
            if word is None:
                continue
            features = maxent.Tables.features(hashed, np.array([0]))
            slots = np.maximum(number, 0) % SMALL.width
            log_p = tables.log_probabilities(kinds, slots, features)[-1]
            if number[-1] < 0 or number[-1] >= SMALL.top:
                e = kinds[-1] - SMALL.word_classes
                log_p += math.log((every[word] + 1) / (vocabulary.class_totals[e] + vocabulary.class_words[e] + 1))
            total += math.exp(log_p)
        # What is left is one unknown word per ending class.
        assert 0.8 < total <= 1 + 1e-6


def test_context_tells_all_words_of_the_head_apart(spark):
    """Words of equal count behind the word classes: each follows one word, and all probabilities add up to one."""
    m = maxent.Model(word_classes=1, width=4, ending_classes=2, head_classes=2, rows=1 << 12, head=200, rate=0.5, batch=256)
    pick = random.Random(3)
    pairs = [(f"p{i}x", f"q{i}x") for i in range(40)]
    rows = [(i, " ".join(w for _ in range(20) for w in pick.choice(pairs))) for i in range(600)]
    follows = [(1000 + i, f"{p} {q}") for i, (p, q) in enumerate(pairs)]
    crossed = [(2000 + i, f"{p} {pairs[(i + 1) % 40][1]}") for i, (p, _) in enumerate(pairs)]
    df = spark.createDataFrame(rows + follows + crossed, "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.score for r in maxent.score_texts(df, F.col("doc_id") >= 1000, m).collect()}
    assert all(got[1000 + i] > got[2000 + i] + 0.5 for i in range(40))

    texts = df.filter("doc_id < 1000").select("text")
    vocabulary = maxent.Vocabulary.read(maxent.word_counts(texts, m), m)
    weights = maxent.train(texts, F.pmod(F.xxhash64("text"), F.lit(2)), vocabulary, m)
    tables, encoder = maxent.Tables(m, *weights, vocabulary.bounds), maxent.Encoder(vocabulary, m)
    assert len(vocabulary.words) == 81 and vocabulary.class_words.sum() == 0
    _, _, hashed = encoder.encode([b"p3x", b"q3x"])
    features = maxent.Tables.features(hashed, np.array([0]))[:, -1:]
    log_p = [tables.log_probabilities(encoder.classes[[i]], encoder.slots[[i]], features)[0] for i in range(81)]
    raised, total = tables._exponentials(tables._scores(tables.by_class, tables._class_rows(features)))
    endings = raised[0, 1:3].sum() / total[0]
    assert sum(map(math.exp, log_p)) + endings == pytest.approx(1, abs=1e-4)


def test_long_texts_do_not_depend_on_their_neighbours(spark):
    m = maxent.Model(word_classes=2, width=4, ending_classes=4, rows=1 << 10, head=64, batch=16)
    df = spark.createDataFrame(sentences(60), "doc_id long, text string")
    one = {r.doc_id: r.score for r in maxent.score_texts(df.coalesce(1), F.lit(False), m).collect()}
    assert len(one) == 60 and all(math.isfinite(s) for s in one.values())


def test_edge_rows_score(edge, empty):
    rows = maxent.score_texts(edge, crc_fold("doc_id", 7) == 2, SMALL).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in edge.select("doc_id").collect())
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 6)} == {1}
    twins = [r for r in rows if r.doc_id == 1]
    assert twins[0] == twins[1]
    assert maxent.score_texts(empty, F.lit(False), SMALL).count() == 0
    nothing = maxent.score_texts(edge, F.lit(True), SMALL).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in nothing)


TOXIC = toxicity.Settings(per_class=400, epochs=6, buckets=1 << 12)


def fitted(labelled):
    return toxicity.fit_model(labelled.select("_id", "text"), labelled.select("_id", "label"), TOXIC)


def comments(n, seed):
    """Label 1 if a word with one of two stems occurs; the endings differ, so most such words are unseen."""
    pick = random.Random(seed)
    syllables = ["la", "mo", "ri", "ten", "us", "ka", "pel", "do"]
    word = lambda k: "".join(pick.choice(syllables) for _ in range(k))
    out = []
    for i in range(n):
        words = [word(pick.randint(1, 3)) for _ in range(pick.randint(5, 120))]
        label = int(pick.random() < 0.3)
        if label:
            for _ in range(pick.randint(1, 3)):
                words[pick.randrange(len(words))] = pick.choice(["grumf", "snark"]) + word(2)
        out.append((i, " ".join(words), label))
    return out


def test_unseen_misspellings_are_found(spark):
    train, test = comments(500, 1), comments(300, 2)
    labelled = spark.createDataFrame([(i, t, y) for i, t, y in train], "_id long, text string, label int")
    model = fitted(labelled)
    df = spark.createDataFrame(test, "doc_id long, text string, label int")
    got = {r.doc_id: r for r in toxicity.score_texts(df, model, TOXIC, keep=["doc_id"]).collect()}
    hit = sum(got[i].predicted == y for i, _, y in test)
    assert hit >= 0.95 * len(test)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())


def test_toxic_words_inside_long_runs_are_found(spark):
    pick = random.Random(5)
    labelled = spark.createDataFrame(comments(500, 1), "_id long, text string, label int")
    model = fitted(labelled)
    syllables = ["la", "mo", "ri", "ten", "us", "ka", "pel", "do"]
    word = lambda k: "".join(pick.choice(syllables) for _ in range(k))
    rows = []
    for mark in (".", "_", "\u200b", ""):
        for _ in range(10):
            clean = [word(3) for _ in range(30)]
            bad = [*clean[:15], "grumf" + word(2), *clean[15:]]
            assert len(mark.join(clean).encode()) > 150
            rows += [(0, mark.join(clean)), (1, mark.join(bad))]
    df = spark.createDataFrame(rows, "toxic int, text string")
    got = toxicity.score_texts(df, model, TOXIC, keep=["toxic"]).collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.95 * len(rows)


def test_every_gram_of_a_long_run_is_in_a_piece():
    s = toxicity.Settings()
    for n in (45, 46, 47, 48, 49, 200, 1001):
        run = "".join(random.Random(n).choice("abcdé€🙂") for _ in range(n))
        words = toxicity.text_words(f"a {run} b", s)
        marked = f"<{run}>".encode()
        pieces = [w if isinstance(w, bytes) else f"<{w}>".encode() for w in words[1:-1]]
        for k in range(s.shortest, s.longest + 1):
            assert {marked[i : i + k] for i in range(len(marked) - k + 1)} == {p[i : i + k] for p in pieces for i in range(len(p) - k + 1)}


def test_sample_is_bounded_and_repeatable(spark):
    labelled = spark.createDataFrame(comments(80, 3), "_id long, text string, label int")
    s = toxicity.Settings(per_class=7)
    pick = lambda df: sorted(map(tuple, toxicity.sample_rows(df.drop("label"), df.drop("text"), s).collect()))
    assert len(pick(labelled)) == 14 and pick(labelled) == pick(labelled.repartition(5))


def test_toxicity_of_edge_rows(spark, edge, empty):
    labelled = spark.createDataFrame(comments(60, 4) + [(None, None, None), (1, "x", 2)], "_id long, text string, label int")
    model = fitted(labelled)
    rows = toxicity.score_texts(edge.drop("score"), model, TOXIC, keep=["doc_id", "row"]).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 6)}) == 1
    assert toxicity.score_texts(empty, model, TOXIC, keep=["doc_id"]).count() == 0
    none = fitted(labelled.filter("false"))
    assert {r.score for r in toxicity.score_texts(edge, none, TOXIC, keep=["doc_id"]).collect()} == {0.5}
    one = fitted(labelled.filter("label = 0"))
    assert {r.predicted for r in toxicity.score_texts(edge, one, TOXIC, keep=["doc_id"]).collect()} == {0}


def _steps(rows=1 << 12, n=20_000):
    m = maxent.Model(word_classes=8, ending_classes=8, head_classes=8, rows=rows, batch=n)
    draw = np.random.default_rng(5)
    bounds = m.top + np.array([0, 5, 21, 40, 80, 160, 320, 640, 1300])
    kinds = draw.integers(0, m.classes, n)
    sizes = np.append(np.full(m.word_classes, m.width), np.append(np.ones(m.ending_classes, int), np.diff(bounds)))
    slots = draw.integers(0, sizes[kinds])
    return m, bounds, kinds, slots, maxent.Tables.features(draw.integers(0, 3_000, n).astype(np.uint64), np.arange(0, n, 500))


def test_pieces_of_a_batch_give_the_same_model(monkeypatch):
    m, bounds, kinds, slots, features = _steps()
    found = []
    for piece in (97, 1 << 16):
        monkeypatch.setattr(maxent, "_PIECE", piece)
        tables = maxent.Tables(m, bounds=bounds)
        for _ in range(2):
            tables.learn(kinds, slots, features)
        found.append((tables.by_class, tables.by_word, *tables.used, tables.log_probabilities(kinds, slots, features)))
    assert all(np.array_equal(a, b) for a, b in zip(*found)) and found[0][0].any()


def test_scores_of_a_batch_are_not_held_whole():
    m, bounds, kinds, slots, features = _steps()
    tables = maxent.Tables(m, bounds=bounds)
    # As large as the class weights of a batch; one feature's beside their sum are twice that.
    whole = len(kinds) * m.classes * 4
    tracemalloc.start()
    tables.log_probabilities(kinds, slots, features)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * whole, (peak, whole)


ODD = ["", " ", "A b\tC\n\x0bd\x0ce\rf  ", "\x1c\x1d a\x1e\x1fb\x85c\xa0d \u2003 É é", "x " * 700 + "long", "\x00 \x00a", "a", " a", "b "] * 3


def test_words_are_taken_as_columns(monkeypatch):
    """Counts come without a Python object for each word, whatever the runs of texts that are split together."""
    batch = lambda texts: pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    plain = Counter(w for t in ODD for w in maxent.tokens(t))
    each = [maxent.tokens(t)[:-1] for t in ODD]
    words, lengths = maxent.split_words(pa.array(ODD, pa.string()))
    assert words.to_pylist() == [w for t in each for w in t] and lengths.tolist() == list(map(len, each))
    monkeypatch.setattr(maxent, "tokens", None)
    for chunk, counted in ((1, 1), (50, 3), (1 << 22, 300_000)):
        monkeypatch.setattr(maxent, "_CHUNK", chunk)
        got = Counter()
        for found in maxent._count(iter([batch(ODD[:10]), batch([]), batch(ODD[10:])]), maxent.Model(counted=counted)):
            for word, c in zip(*(found.column(i).to_pylist() for i in range(2))):
                got[word] += c
        assert got == plain
    assert not list(maxent._count(iter([batch([])]), maxent.Model()))


def test_batches_of_tokens_do_not_depend_on_how_texts_are_read(monkeypatch):
    head = [b"a", b"x", maxent.END, b"long"]
    vocabulary = maxent.Vocabulary(head, np.array([4, 3, 2, 1]), 10, 6, np.zeros(4), np.zeros(4))
    encoder = maxent.Encoder(vocabulary, maxent.Model(word_classes=1, width=2, ending_classes=4))
    plain, now = [], []
    for t in ODD:
        now.append(maxent.tokens(t))
        if sum(map(len, now)) >= 20:
            plain, now = [*plain, now], []
    plain += [now] if now else []
    for chunk, cut in ((1, 5), (60, 11), (1 << 22, 27)):
        monkeypatch.setattr(maxent, "_CHUNK", chunk)
        columns = (pa.array(part, pa.string()) for part in (ODD[:cut], [], ODD[cut:]))
        found = list(maxent._token_batches(columns, encoder, 20))
        assert len(found) == len(plain)
        for texts, (rare, starts, number, kinds, _, _) in zip(plain, found):
            words = [w for t in texts for w in t]
            assert number.tolist() == [head.index(w) if w in head else -1 for w in words]
            assert list(rare) == [w for w in words if w not in head]
            assert starts.tolist() == [sum(map(len, texts[:i])) for i in range(len(texts))]
            assert all(np.array_equal(a, b) for a, b in zip(encoder.encode(words), (number, kinds)))


def test_steps_add_up_the_errors_of_a_row(monkeypatch):
    """Rows met once, a few times and often, against a plain sum row by row."""
    m, bounds, kinds, slots, features = _steps()
    tables, plain = maxent.Tables(m, bounds=bounds), maxent.Tables(m, bounds=bounds)
    seen = set()

    def step(which, rows, target, outcomes=None):
        if not len(rows[-1]):
            return
        pieces = [(e / t[:, None]).copy() for _, e, t in plain._pieces(which, rows, outcomes)]
        error = np.concatenate(pieces)
        error[np.arange(len(target)), target] -= 1
        for k in rows:
            sums = error.sum(axis=0, keepdims=True)
            for row in k if len(k) == 1 else np.unique(k):
                met = np.flatnonzero(k == row)
                if len(k) > 1:
                    seen.add(min(len(met), 6))
                    sums = error[met[:1]].copy()
                    for i in met[1:]:
                        sums[0] += error[i]
                plain._update(which, np.array([row]), sums, len(target) if len(k) == 1 else len(met))

    monkeypatch.setattr(plain, "_step", step)
    part = slice(0, 400)
    for t in (tables, plain):
        t.learn(kinds[part], slots[part], features[:, part])
    assert seen == {1, 2, 3, 4, 5, 6}
    assert np.allclose(tables.by_class, plain.by_class, atol=1e-6) and np.allclose(tables.by_word, plain.by_word, atol=1e-6)
    assert all(np.array_equal(a, b) for a, b in zip(tables.used, plain.used))


def test_checksums_of_words_are_taken_as_columns(monkeypatch):
    """Words outside the head get class and hash without a call for each of them; long ones and slices have zlib's checksum too."""
    pick = random.Random(9)
    words = [bytes(pick.randrange(256) for _ in range(k)) for k in [*range(130), 0, 1, 2, 3, 63, 64, 64, 65, 70_000] for _ in range(2)]
    pick.shuffle(words)
    for part in (pa.array(words, pa.binary()), pa.array(words, pa.binary()).slice(7, 150), pa.array([b"", b""]), pa.array([], pa.binary())):
        plain = part.to_pylist()
        assert maxent.crc32_words(part).tolist() == [zlib.crc32(w) for w in plain]
        for last in (1, 3, 80):
            assert maxent.crc32_words(part, last).tolist() == [zlib.crc32(w[-last:]) for w in plain]

    vocabulary = maxent.Vocabulary([b"a", maxent.END], np.array([4, 3]), 10, 6, np.zeros(4), np.zeros(4))
    encoder = maxent.Encoder(vocabulary, maxent.Model(word_classes=1, width=2, ending_classes=4))
    each = [w for t in ODD for w in maxent.tokens(t)]
    hashes, endings = [zlib.crc32(w) for w in each], [0 if w in vocabulary.words else encoder.ending(w) for w in each]
    monkeypatch.setattr(maxent.Encoder, "ending", None)
    _, _, kinds, hashed, _ = encoder.encode_texts(pa.array(ODD, pa.string()))
    assert hashed.tolist() == hashes and kinds.tolist() == endings


def test_rare_words_are_counted_by_text():
    texts = [[], [b"a", b"b", b"a"], [], [b"b"], [b"\x00", b"", b"a", b""], []]
    words = np.array([w for t in texts for w in t], object)
    of = np.repeat(np.arange(len(texts)), list(map(len, texts)))
    lists, times = maxent._counted_by_text(words, of, len(texts))
    assert [dict(zip(*pair)) for pair in zip(lists.to_pylist(), times.to_pylist())] == [dict(Counter(t)) for t in texts]
    lists, times = maxent._counted_by_text(words[:0], of[:0], 2)
    assert lists.to_pylist() == times.to_pylist() == [[], []] and lists.type == pa.list_(pa.binary())


def test_rows_met_often_are_changed_together(monkeypatch):
    """A feature of few rows takes one change for all of them, however many tokens a batch has."""
    m, bounds, _, _, features = _steps()
    n = len(features[0])
    kinds, slots = np.arange(n) % m.word_classes, np.arange(n) % m.width
    calls = Counter()
    tables = maxent.Tables(m, bounds=bounds)
    update = tables._update

    def counted(which, touched, change, times):
        calls[which] += 1
        update(which, touched, change, times)

    monkeypatch.setattr(tables, "_update", counted)
    # Five words in turn: the features other than none have a few rows each.
    tables.learn(kinds, slots, maxent.Tables.features(np.arange(n).astype(np.uint64) % np.uint64(5), np.array([0])))
    assert n > 4 * maxent._PIECE and calls[0] <= 2 * maxent.FEATURES and calls[1] <= 2 * maxent.FEATURES
