"""The registered queries and the pipeline, stage by stage, against brute force on its own input."""

from __future__ import annotations

import pytest
from oracle import engine, same_rows

from pagewright.llm import queries, simhash


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, small, name):
    same_rows(queries.QUERIES[name](spark, small), engine(small), queries.ORACLE_SQL[name])


def test_one_query_per_operator():
    found = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert found == list(range(1, 11))


def test_stages(spark, small, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, tables = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        docs.write.parquet(str(tmp_path / name))
        docs = tables[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
    everything = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    known = {r["doc_id"] for r in tables["language_id"].collect()}
    assert known == set(everything)  # all of them are in the four languages
    lower = {c: c + 32 for c in range(65, 91)}
    last = {}
    for i in sorted(known):
        last[everything[i]["text"].translate(lower)] = i
    exact = {r["doc_id"] for r in tables["exact_dedup"].collect()}
    assert exact == set(last.values())
    fps = {i: simhash.fingerprint(everything[i]["text"].encode()) for i in sorted(exact)}
    label = {i: i for i in fps}
    for i in fps:
        for j in fps:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= 4 and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if x == old else x for k, x in label.items()}
    near = {r["doc_id"] for r in tables["simhash"].collect()}
    assert near == set(label.values())
    mixed = [r["doc_id"] for r in tables["mixing"].collect()]
    assert set(mixed) <= near and max(mixed.count(i) for i in set(mixed)) <= 3
    pieces = tables["packing"].collect()
    assert {r["doc_id"] for r in pieces} == set(mixed) and corpus_pipeline.run(spark, small).count() == len(pieces)
