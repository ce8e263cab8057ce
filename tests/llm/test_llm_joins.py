"""Near duplicates, repeated passages and components against brute force."""

import hashlib
import random
import re
from collections import Counter
from functools import partial

import numpy as np
import pytest
from helpers import ancestors
from pyspark.sql import functions as F

from ruleweave.llm import chosen_path, jaccard, minhash, repeats
from ruleweave.llm.components import connected
from ruleweave.operators.stages import materialize


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def root_of(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def plain_classes(texts, least=0.8):
    """Class (least row) and number of links of every row, all pairs compared."""
    sets = [shingles(t) for t in texts]
    parent, links = list(range(len(texts))), [0] * len(texts)
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            both = len(sets[a] & sets[b])
            if both >= least * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = root_of(parent, a), root_of(parent, b)
                parent[max(x, y)] = min(x, y)
    return [(root_of(parent, i), links[i]) for i in range(len(texts))]


def near_texts(seed, n_groups=12):
    """Groups of near copies with few or many edits, exact copies, and texts that share a long passage only."""
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(pick.randint(1, 6)))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(n_groups):
        base = [word() for _ in range(pick.randint(3, 160))]
        for _ in range(pick.choice([1, 2, 3, 12])):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 4, 8])):
                copy[pick.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [word() for _ in range(40)]) for _ in range(15)]
    texts += ["", None, "One Two", "one two", "one"]
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize("small, part", [(64, 1024), (2, 4)])
def test_chosen_paths_find_all_links(spark, monkeypatch, small, part):
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard.parts_of, "__defaults__", (part,))
    texts = near_texts(1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.jaccard_classes(df, chosen_path.Paths(small=small)).collect()}
    assert got == dict(enumerate(plain_classes(texts)))


def test_bands_find_all_links(spark):
    texts = near_texts(2, 6)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in minhash.near_duplicates(df).collect()}
    assert got == dict(enumerate(plain_classes(texts)))


def test_classes_of_edge_rows(edge, empty):
    rows = chosen_path.jaccard_classes(edge).collect()
    assert len(rows) == edge.count()
    by = Counter((r.doc_id, r.class_id, r.n_links) for r in rows)
    assert by[1, 1, 2] == 2 and by[2, 1, 2] == 1 and by[2, 2, 0] == 1
    assert {(r.class_id, r.n_links) for r in rows if r.doc_id in (3, 4, 6)} == {(3, 3)}
    assert sum(r.doc_id is None and r.class_id == 3 for r in rows) == 1
    assert sum(r.doc_id is None and r.class_id is None for r in rows) == 1
    assert chosen_path.jaccard_classes(empty).count() == 0


def test_sets_survive_packing():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 1000, np.uint64))
    assert (jaccard.unpack(jaccard.pack(values)) == values).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    pick = random.Random(seed)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(pick.choice([0, 150, 250]))]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(5, None), (None, 3)]
    parent = {x: x for e in edges for x in e if x is not None}
    for a, b in edges:
        if a is not None and b is not None:
            x, y = root_of(parent, a), root_of(parent, b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root_of(parent, x) for x in parent if root_of(parent, x) != x}


def plain_fingerprint_facts(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for k, (i, text) in enumerate(order):
        after, cut = order[(k + 1) % len(order)][1], len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = shingles(text), shingles(edited), shingles(after)
        same = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), same(a, b), same(a, c)))
    return out


def test_fingerprints_follow_the_next_document(spark):
    pick = random.Random(8)
    words = ["alpha", "béta", "x", "🙂", "\n", "  ", "Gamma"]
    rows = [(i * 3, " ".join(pick.choice(words) + str(pick.randint(0, 99)) for _ in range(pick.randint(0, 300)))) for i in range(80)]
    rows += [(1, ""), (2, "one"), (4, rows[0][1])]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in minhash.fingerprint_documents(df).collect()}
    assert len(got) == len(rows)
    for i, n, sha, edited, after in plain_fingerprint_facts(rows):
        assert (got[i].n_chars, got[i].edited_sha256) == (n, sha)
        assert abs(got[i].near_edited - edited) < 0.3 and abs(got[i].near_next - after) < 0.3
    assert got[0].fingerprint == got[4].fingerprint


def test_fingerprints_of_edge_rows(edge, empty):
    rows = minhash.fingerprint_documents(edge).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in edge.select("doc_id").collect())
    twins = [r for r in rows if r.doc_id == 1]
    assert len({r.fingerprint for r in twins}) == 1 and max(r.near_next for r in twins) == 1.0
    blank = {r.fingerprint for r in rows if r.doc_id in (3, 4, 6)}
    assert len(blank) == 1
    assert minhash.fingerprint_documents(empty).count() == 0
    one = minhash.fingerprint_documents(edge.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def plain_removal(rows, length):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[p : p + length] for p in range(len(data) - length + 1))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if seen[data[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        rest = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def passages():
    pick = random.Random(3)
    pool = ["".join(pick.choice("ab c") for _ in range(pick.randint(150, 420))) for _ in range(6)] + ["x" * 260, "ab" * 150]
    rows = []
    for i in range(90):
        parts = []
        for _ in range(pick.randint(0, 6)):
            if pick.random() < 0.5:
                parts.append(pick.choice(pool)[pick.choice([0, 0, 7, 60]) : pick.choice([999, 230, 300])])
            else:
                parts.append("".join(pick.choice("abcdefgh") for _ in range(pick.randint(0, 90))))
        rows.append((i, "".join(parts)))
    return rows + [(7, "same" * 80), (7, "same" * 80), (None, "y" * 500), (900, None), (901, ""), (902, "é" * 120)]


@pytest.mark.parametrize("group", [40_000, 3])
def test_repeats_are_removed_to_the_byte(spark, passages, group):
    df = spark.createDataFrame(passages, "doc_id long, text string")
    got = repeats.remove_repeats(df, repeats.Repeats(group=group)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_removal(passages, 200)


def test_repeats_of_edge_rows(edge, empty):
    got = repeats.remove_repeats(edge).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in edge.select("doc_id").collect())
    assert all(r.n_removed == 0 for r in got if r.doc_id in (1, 3, 4, 6))
    assert repeats.remove_repeats(empty).count() == 0


def test_chunks_do_not_change_anchors(passages, monkeypatch):
    whole = {i: repeats.anchors(np.frombuffer((t or "").encode(), np.uint8), repeats.Repeats()) for i, (_, t) in enumerate(passages)}
    monkeypatch.setattr(repeats, "_CHUNK", 256)
    repeats._powers.cache_clear()
    for i, (_, t) in enumerate(passages):
        cut = repeats.anchors(np.frombuffer((t or "").encode(), np.uint8), repeats.Repeats())
        assert all((a == b).all() for a, b in zip(whole[i], cut))
    repeats._powers.cache_clear()


def test_interval_tree_has_every_group():
    texts = sorted(["abab", "abac", "abad", "b", "ba", "abab"])
    found = set(repeats.prefix_intervals(repeats.common_prefixes(texts)))
    assert found == {(3, 0, 3), (4, 0, 1), (1, 4, 5)}
    groups = list(repeats.repeat_groups([b"xxq", b"yxq", b"zzz"], [b"abcd", b"abcd", b"abcd"], 6))
    assert groups == [(4, [0, 1], [2, 2])] or groups == [(4, [1, 0], [2, 2])]


def test_near_members_keep_every_link():
    """Pairs at the threshold or above stay, sets that share a passage only go."""
    p, pick = chosen_path.Paths(), random.Random(5)
    new = lambda n: np.array(pick.sample(range(1 << 48), n), np.uint64)
    lost = kept = 0
    for _ in range(400):
        n = pick.choice([3, 20, 127, 128, 130, 300, 2_000])
        common = new(-(-n * 8 // 9) if pick.random() < 0.7 else n)
        sets = [np.unique(np.concatenate((common, new(max(0, n - len(common)))))) for _ in range(2)]
        both = len(np.intersect1d(*sets))
        linked = both >= 0.8 * (len(sets[0]) + len(sets[1]) - both) - 1e-9
        sketches = np.stack([chosen_path.sketch_of(x, p) for x in sets])
        lost += linked and not chosen_path.near_members(np.array([len(x) for x in sets]), sketches, p).all()
    assert lost == 0
    for _ in range(300):
        passage = new(60)
        sets = [np.unique(np.concatenate((passage, new(pick.choice([200, 210, 400]))))) for _ in range(5)]
        sketches = np.stack([chosen_path.sketch_of(x, p) for x in sets])
        kept += chosen_path.near_members(np.array([len(x) for x in sets]), sketches, p).sum()
    assert kept < 15


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold in the midst of texts that share passages: found are 0.99 at least."""
    pick = random.Random(9)
    word = lambda: "".join(pick.choice("abcdefghijkl") for _ in range(6))
    passages = [[word() for _ in range(40)] for _ in range(5)]
    texts = []
    for _ in range(400):
        base = [word() for _ in range(300)] + pick.choice(passages)
        other = list(base)
        for at in range(15, 330, 55):
            other[at] = word()
        texts += [" ".join(base), " ".join(other)]
    sets = [shingles(t) for t in texts]
    alike = [i for i in range(0, len(texts), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])]
    assert len(alike) > 350
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in chosen_path.jaccard_classes(df, chosen_path.Paths(small=8), count_links=False).collect()}
    assert sum(got[i + 1] == i for i in alike) >= 0.99 * len(alike)


def test_rounds_are_repeated_until_the_recall(spark, caplog):
    """With few picks one round misses links; the target brings further rounds, and all of them."""
    pick = random.Random(11)
    texts = []
    for _ in range(150):
        base = ["".join(pick.choice("abcdefgh") for _ in range(6)) for _ in range(80)]
        texts += [" ".join(base), " ".join(base[:-2] + ["x", "y"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def found(recall):
        caplog.clear()
        p = chosen_path.Paths(picks=0.5, recall=recall)
        with caplog.at_level("INFO", logger="ruleweave.llm.chosen_path"):
            rows = chosen_path.jaccard_classes(df, p).collect()
        pairs = sum(r.doc_id == r.class_id + 1 for r in rows)
        assert sum(r.n_links for r in rows) == 2 * pairs
        return len(caplog.records), pairs

    rounds, pairs = found(0.0)
    assert rounds == 1 and pairs < 150
    rounds, pairs = found(0.99)
    assert rounds > 1 and pairs >= 149


def test_links_are_added_to_roots(spark):
    links = lambda rows: spark.createDataFrame(rows, "u long, v long")
    roots, missed = chosen_path.add_links(None, links([(1, 2), (2, 3), (7, 8), (5, 6)]))
    assert missed == 1.0
    roots, missed = chosen_path.add_links(roots, links([(3, 1), (8, 6), (9, 3), (1, 3)]))
    assert missed == 2 / 4
    assert {tuple(r) for r in roots.collect()} == {(2, 1), (3, 1), (9, 1), (6, 5), (7, 5), (8, 5)}
    assert chosen_path.add_links(roots, links([]))[1] == 0.0


def test_a_third_of_ids_missing(spark):
    rows = [(None if i % 3 == 0 else i, f"text of number {i // 2} with words {i // 2} and more of them {i // 2}") for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = chosen_path.jaccard_classes(df).collect()
    assert len(got) == 240 and all(r.n_links == 1 for r in got)


def test_joins_leave_the_sets_where_they_are(spark, fixed_plans):
    """The sketches and shingles of all sets lie in buckets of the key; only units move to them."""
    texts = [t for t in near_texts(5) if t]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = jaccard.stored_sets(scanned_sets(df), ["size", "paths", "sketch"])
    units = chosen_path.candidate_units(sets, chosen_path.Paths())
    near = materialize(chosen_path.near_units(units, sets, chosen_path.Paths()))
    members = jaccard.stored_members(df, near, sets, id_col="doc_id", text_col="text")
    for made in (chosen_path.near_units(units, sets, chosen_path.Paths()), jaccard.linked_edges(near, members)):
        above = ancestors(made, "Bucketed: true")
        assert above and not [line for lines in above for line in lines if "Exchange" in line]
    assert members.count() == near.select("key").distinct().count()


def test_paths_of_one_set_alone_are_not_kept(spark, monkeypatch):
    """Stored rows of the first level are those that share their path."""
    stored = []
    monkeypatch.setattr(chosen_path, "materialize", lambda df: stored.append(materialize(df)) or stored[-1])
    monkeypatch.setattr(chosen_path, "discard", lambda df: None)
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(50)] + ["a b c d e f g h", "a b c d e f g h i"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chosen_path.candidate_units(jaccard.stored_sets(scanned_sets(df), ["size", "paths", "sketch"]), chosen_path.Paths(picks=8.0))
    first = next(x for x in stored if x.columns == ["bucket", "key"])
    counts = Counter(r.bucket for r in first.collect())
    assert counts and min(counts.values()) > 1


def scanned_sets(df):
    schema = "doc_id long, text_hash long, key long, size long, paths array<long>, sketch binary"
    texts = df.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return texts.mapInArrow(partial(chosen_path._scan, p=chosen_path.Paths(picks=8.0), number=0), schema)
