"""The pipeline: its stages on their own inputs, against brute force, and on odd rows."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from check import TABLES, rows_of
from odd_rows import ODD, SF_DIR, extra
from postfeed.llm import packing, quality
from postfeed.llm.oracles import llm_oracles
from postfeed.llm.queries import llm_queries
from test_texts import brute_near, passages

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = [r.asDict() for r in docs.collect()]
    return kept


def test_columns_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "minhash", "substring", "packing"]


def test_each_stage_does_its_work(spark, stages):
    given = {r.doc_id: r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for name in ("quality", "exact_dedup", "minhash"):
        assert all(set(r) == set(corpus_pipeline.COLUMNS) and r == given[r["doc_id"]] for r in stages[name])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    left = {r["doc_id"] for r in stages["quality"]}
    good = [d for d, q in labels.items() if q == 1 and d in given]
    assert sum(d in left for d in good) >= 0.97 * len(good)
    best = {}
    for r in stages["quality"]:
        key = r["text"].encode().lower()
        best[key] = max(best.get(key, -1), r["doc_id"])
    assert sorted(best.values()) == sorted(r["doc_id"] for r in stages["exact_dedup"])
    _, roots = brute_near([(r["doc_id"], r["text"]) for r in stages["exact_dedup"]])
    assert sorted(set(roots.values())) == sorted(r["doc_id"] for r in stages["minhash"])
    assert [r["doc_id"] for r in sorted(stages["substring"], key=lambda r: r["doc_id"])] == sorted(r["doc_id"] for r in stages["minhash"])
    seen = {}
    for r in stages["substring"]:
        assert not any(seen.setdefault(p, r["doc_id"]) != r["doc_id"] for p in passages(r["text"]))
    assert {r["doc_id"] for r in stages["packing"]} == {r["doc_id"] for r in stages["substring"]}
    assert all(r["offset"] + r["length"] <= packing.SEQUENCE for r in stages["packing"])


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(key(r.asDict()) for r in got) == sorted(map(key, stages["packing"]))


def test_odd_rows_and_empty_tables(spark, monkeypatch):
    rows = [(d, t, None if t else "xx", s, None if t is None else len(t)) for d, t, s in ODD]
    docs = extra(spark.createDataFrame(rows, DOCUMENTS).drop("lang")).repartition(3)
    model = quality.Model(*[None] * 8, 0.0, prior=0.5)
    monkeypatch.setattr(corpus_pipeline, "train", lambda *_: model)
    for source in (docs, docs.limit(0)):
        out = source
        counts = []
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, SF_DIR)
            counts.append(out.count())
        # Of the equal texts one stays each, null and empty texts among them, then one of the near copies.
        assert counts[:4] == ([14, 7, 7, 7] if source is docs else [0, 0, 0, 0])
        assert (counts[4] > 0) == (source is docs)


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = con.execute(llm_oracles()[name])
    columns = [d[0] for d in cursor.description]
    df = llm_queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cursor.fetchall())


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{i}" for i in range(1, 14)]
