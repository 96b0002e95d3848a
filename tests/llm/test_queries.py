import duckdb
import pytest

import corpus_pipeline
from tidemark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == sorted(df.columns)
    want = [tuple(dict(zip(rel.columns, r))[c] for c in df.columns) for r in rel.fetchall()]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


def test_contract_columns(spark, sf):
    types = {c: t for c, t in QUERIES["op6_packing"](spark, sf).dtypes}
    assert types == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                     "sequence_id": "bigint", "offset": "bigint"}
    assert dict(QUERIES["op9_language_id"](spark, sf).dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}


def test_pipeline_stages_match_brute_force(spark, sf):
    from tidemark.llm.common import staged
    from .test_decontaminate import plain as plain_overlaps
    from .test_simhash import plain_components
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(900_001, None), (900_002, ""), (900_003, "12 34"), (900_004, docs.first().text), (900_005, docs.first().text)]
    from pyspark.sql import functions as F
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True) \
        .withColumn("n_chars", F.length("text").cast("long"))
    docs = staged(docs.unionByName(docs.where("doc_id = 900005")), "pipeline_in")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    rows = {r.doc_id: r.text for r in docs.collect()}
    steps = []
    for name, f in corpus_pipeline.STAGES:
        out = staged(f(spark, docs, sf), name)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        steps.append((docs, out))
        docs = out
    (d0, d1), (_, d2), (_, d3), (_, d4), (_, last) = steps
    assert set(ids(d0)) - set(ids(d1)) == {900_001, 900_002, 900_003}
    groups = {}
    for i in set(ids(d1)):
        t = "".join(c.lower() if c.isascii() else c for c in rows[i])
        groups[t] = max(groups.get(t, i), i)
    assert ids(d2) == sorted(groups.values())
    kept = [(i, rows[i]) for i in ids(d2)]
    assert ids(d3) == sorted(d for d, _, c in plain_components(kept, 2) if d == c)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bad = {i for i, _ in plain_overlaps([(i, rows[i]) for i in ids(d3)], items)}
    assert bad and ids(d4) == sorted(set(ids(d3)) - bad)
    assert set(ids(last)) == set(ids(d4))
