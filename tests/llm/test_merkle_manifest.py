"""Merkle manifest against a plain tree built in memory, and its SQL."""

import hashlib
import random
import zlib

import pytest

from compare import oracle_connection, oracle_rows, spark_rows
from conftest import TESTDATA
from parcelmart.llm import merkle_manifest as m
from parcelmart.llm import oracle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, rank string, leaf string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = (row[0], row[1], row[2], row[3], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def lower(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """Top digest of a list, and for each place its siblings as (left, right) per level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = place // 16 * 16
            paths[k].append((nodes[run:place], nodes[place + 1 : run + 16]))
            at[k] = place // 16
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute_force(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        mine = sorted(sources[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[source] = (mine, *climb([leaf(r, r[4]) for r in mine]))
    root, upper = climb([trees[s][1] for s in order])
    out = []
    for source, above in zip(order, upper, strict=True):
        mine, subroot, paths = trees[source]
        for row, path in zip(mine, paths, strict=True):
            own = leaf(row, row[4])
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, lower(row[4])) if changed else own
            for left, right in path + above:
                folded = digest(*left, folded, *right)
            proof = digest(*(d for left, right in path + above for d in left + right))
            out.append((row[0], own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in m.verified(docs).select(*columns).collect()), key=str)


def rows_of(sizes, seed=1):
    draw, rows = random.Random(seed), []
    for source, size in sizes.items():
        for _ in range(size):
            text = draw.choice([None, "", "Abc Ä", "lower", "x" * draw.randint(1, 300)])
            rows.append((len(rows) - 3, source, draw.choice([None, "", "en"]), draw.choice([None, 0, 7]), text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {"a": 1, None: 1}, {"a": 16, "": 17, None: 3}, {"hot": 300, "b": 256, "ä": 1, "Z": 2}, {f"s{i}": 1 + i % 4 for i in range(40)}],
)
def test_equals_a_tree_in_memory(spark, sizes):
    rows = rows_of(sizes)
    assert found(spark, rows) == brute_force(rows)


def test_repeated_rows_null_ids_long_texts(spark):
    rows = [(None, "a", None, None, "no id")] * 2 + [(5, "a", "en", 3, "Same")] * 40 + [(5, "a", "en", 3, "Other")] * 3
    rows += [(9, None, None, None, None), (10, None, "", 0, ""), (15, "b", "x", 1, "Word " * 200_000)]
    assert found(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_some_requests_and_records(spark):
    rows = rows_of({"hot": 600, "b": 30, None: 1})
    manifest = m.build(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    asked = m.proofs(manifest, manifest.leaves.where("doc_id % 50 = 0")).withColumn("root", m.folded(m.F.col("leaf"), "path"))
    assert asked.count() > 5 and {r.root for r in asked.collect()} == {manifest.root}
    records = {r.digest: r.children for r in manifest.records.collect()}
    assert all(digest(children) == key for key, children in records.items())
    assert len(records[manifest.root]) == 3 * 64


def test_query_equals_its_sql(spark):
    sf_dir = TESTDATA / "sf0.01"
    found = spark_rows(queries.op11_merkle_manifest(spark, str(sf_dir)))
    assert found == oracle_rows(oracle_connection(sf_dir), oracle.ORACLE["op11_merkle_manifest"])
    verdicts = [row[found[0].index("verified")] for row in found[1]]
    assert 0.75 < sum(verdicts) / len(verdicts) < 0.85
