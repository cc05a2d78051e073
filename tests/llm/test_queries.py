"""Registered queries against SQL, and the pipeline against its parts done one by one."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.test_jaccard import brute
from tests.llm.test_lines_and_passages import brute_hits
from tripwright.llm import quality
from tripwright.llm.queries import ORACLE_SQL, REGISTRY
from tripwright.llm.rangecoder import decode
from tripwright.llm.tables import table
from tripwright.llm.tokenids import tokens_of

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))
FOLDER, SMALL = str(TESTDATA / "sf0.01"), str(TESTDATA / "sf0.001")


def plain(rows):
    return sorted(tuple("" if v is None else str(float(v)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    got = REGISTRY[name](spark, FOLDER)
    with duckdb.connect() as connection:
        for t in ("documents", "benchmark", "embeddings"):
            connection.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
        want = connection.sql(f"select {', '.join(got.columns)} from ({ORACLE_SQL[name]})")
        assert plain(got.collect()) == plain(want.fetchall())


def test_all_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in REGISTRY}
    assert set(REGISTRY) | {"pipeline"} <= set(entry_points.queries())


def test_the_pipeline_is_its_stages(spark):
    docs = table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    scored = quality.score_quality(docs, quality.train(docs, table(spark, SMALL, "labels"))).collect()
    kept = {r.doc_id for r in scored if r.predicted}
    groups = brute([(d, texts[d]) for d in sorted(kept)])
    kept = {d for d in kept if groups[d][1] == d}
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    hits = brute_hits([(d, texts[d]) for d in kept], items, 10)
    kept = {d for d in kept if not hits[d][1]}
    rows = corpus_pipeline.run(spark, SMALL).orderBy("shard", "segment").collect()
    assert sorted(i for r in rows for i in r.doc_ids) == sorted(kept)
    import public_tokenizers

    tokens = tokens_of(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows:
        want = [np.append(tokens.encode([texts[d]])[0], 0) for d in r.doc_ids]
        assert [len(w) for w in want] == r.lengths and (decode(r.data) == np.concatenate(want)).all()


def test_stages_take_empty_tables_and_odd_columns(spark, make_docs):
    for rows in ([], [(1, None), (1, None), (None, ""), (2, "some words")]):
        docs = make_docs(rows, extra={"row": 1, "label": 2, "mix_slot": 3, "place": 4, "at": 5})
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SMALL)
            assert after.columns == docs.columns
            docs = after
        assert sum(len(r.doc_ids) for r in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()) <= len(rows)


def test_the_rest_stands_without_the_subpackage():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('tripwright.llm') or name == 'corpus_pipeline': raise ImportError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and 'trips_enriched' in e.queries() and len(e.oracle_sql()) == len(e.queries())\n"
    )
    root = Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120)
