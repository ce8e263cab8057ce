"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from ruleweave.llm import catalog, manifest, oracle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    """(before, after) at each level, from the leaf up."""
    path = []
    for nodes in levels[:-1]:
        first = at - at % 16
        path.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 16])))
        at //= 16
    return path


def plain_manifest(rows):
    """One row per (doc_id, source, lang, n_chars, text)."""
    by_source = {}
    for r in rows:
        leaf = sha(*map(field, r))
        tampered = leaf
        if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0 and r[4] is not None:
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            tampered = sha(*map(field, r[:4]), field(lowered))
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf, tampered))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels_of([x[2] for x in sorted(by_source[s])]) for s in names]
    over = levels_of([t[-1][0] for t in trees])
    root, out = over[-1][0] if names else None, []
    for s, name in enumerate(names):
        for at, (known, doc_id, leaf, tampered) in enumerate(sorted(by_source[name])):
            path = siblings(trees[s], at) + siblings(over, s)
            folded = tampered
            for before, after in path:
                folded = sha(before, folded, after)
            proof = sha(*[b + a for b, a in path])
            out.append((doc_id if known else None, leaf, trees[s][-1][0], root, proof, folded, folded == root))
    return out


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def run(spark, monkeypatch, docs):
    monkeypatch.setattr(catalog, "documents", lambda *_: docs)
    return sorted(map(tuple, catalog.op12_merkle_manifest(spark, "").collect()), key=str)


@pytest.mark.parametrize("count, sources", [(1, 1), (16, 1), (17, 2), (300, 20), (600, 2), (40, 40)])
def test_matches_plain_tree(spark, monkeypatch, count, sources):
    rows = [(i * 7 % 1009, f"s{i % sources}", "en", i, f"Text Number {i} É") for i in range(count)]
    docs = spark.createDataFrame(rows, FIELDS).repartition(5)
    assert run(spark, monkeypatch, docs) == sorted(plain_manifest(rows), key=str)


def test_edge_rows(spark, edge, empty, monkeypatch):
    fields = [f.split()[0] for f in FIELDS.split(", ")]
    rows = [tuple(r) for r in edge.select(*fields).collect()]
    assert run(spark, monkeypatch, edge) == sorted(plain_manifest(rows), key=str)
    assert run(spark, monkeypatch, empty) == []


def test_equal_rows_share_records(spark, monkeypatch):
    """A third of all rows are one row; their runs are one record."""
    rows = [(1, "hot", "en", 1, "Same")] * 700 + [(i, "cold", None, None, None) for i in range(60)]
    docs = spark.createDataFrame(rows, FIELDS).repartition(7)
    assert run(spark, monkeypatch, docs) == sorted(plain_manifest(rows), key=str)
    leaves = catalog.manifest_leaves(docs)
    built = manifest.build(leaves, order=["doc_id"])
    # 43 whole runs of equal leaves and a shorter one; 3 whole runs and a shorter one.
    assert built.trees.records[0].count() == 2 + 4


def test_requests_get_the_proofs_that_all_get(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"text {i}") for i in range(500)]
    built = manifest.build(catalog.manifest_leaves(spark.createDataFrame(rows, FIELDS)), order=["doc_id"])
    every = {(r["tree"], r["rank"]): r for r in manifest.proofs(built).collect()}
    wanted = spark.createDataFrame([(0, 0), (1, 77), (2, 165), (2, 9_999)], "tree long, rank long")
    some = manifest.proofs(built, wanted).collect()
    assert sorted((r["tree"], r["rank"]) for r in some) == [(0, 0), (1, 77), (2, 165)]
    assert all(r.asDict() == every[r["tree"], r["rank"]].asDict() for r in some)
    folded = manifest.proofs(built, wanted).select(manifest.fold(F.col("leaf")).alias("f")).distinct().collect()
    assert [r["f"] for r in folded] == [built.root]


def test_large_records_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", 0)
    rows = [(i % 50, f"s{i % 4}", "en", 1, "Same") for i in range(400)]
    docs = spark.createDataFrame(rows, FIELDS)
    assert run(spark, monkeypatch, docs) == sorted(plain_manifest(rows), key=str)


def test_clashing_columns_are_refused(edge):
    with pytest.raises(ValueError):
        manifest.build(catalog.manifest_leaves(edge).withColumn("rank", F.lit(1)), order=["doc_id"])


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 101).alias("a"), F.col("id").alias("b")).repartition(6)
    rows = manifest.numbered(df, ["a", "b"]).collect()
    assert [r["_number"] for r in sorted(rows, key=lambda r: (r["a"], r["b"]))] == list(range(1000))


def test_sql_agrees(spark, edge, monkeypatch, tmp_path):
    fields = [f.split()[0] for f in FIELDS.split(", ")]
    rows = [tuple(r) for r in edge.select(*fields).collect()]
    rows += [(1000 + i, f"s{i % 2}", "en", i, f"Text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, FIELDS)
    docs.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}).to_parquet(tmp_path / "d.parquet")
    db = duckdb.connect()
    db.sql(f"create view documents as from '{tmp_path}/d.parquet'")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = db.sql(f"select {', '.join(names)} from ({oracle.MANIFEST})").fetchall()
    assert run(spark, monkeypatch, docs) == sorted(want, key=str)
