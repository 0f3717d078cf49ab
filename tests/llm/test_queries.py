"""The registered queries against their SQL, the pipeline against a brute-force version, native plans."""

import base64
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from demandcast.llm import mixing, quality, queries
from demandcast.llm.common import drop_tables, read_table, ship_package, written_tables
from tests.conftest import SF_SMALL
from tests.llm.test_table_operators import brute_components


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck_small, name):
    got = queries.queries()[name](spark, SF_SMALL)
    rel = duck_small.execute(queries.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(rel.fetchall())
    assert sorted(tuple(r) for r in got.select(*names).collect()) == want


def test_entry_registers_the_queries():
    found = E.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in found) == 1
    assert "pipeline" in found
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "encode"]


def test_sharding_plan_has_no_python(spark):
    plan = queries.op1_kd_sharding(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline_equals_its_stages_by_brute_force(spark):
    ship_package(spark)
    before = set(written_tables())
    got = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert set(written_tables()) == before                     # stages leave no tables behind
    docs = read_table(spark, SF_SMALL, "documents")
    model = quality.train(docs, read_table(spark, SF_SMALL, "labels"))
    rows = [r for r in docs.collect() if model.score(np.array([quality.features(r.text)]))[0] >= 0.5]
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        if key not in best or (-len(r.text), r.doc_id) < (-len(best[key].text), best[key].doc_id):
            best[key] = r
    rows = list(best.values())
    firsts = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in rows], 5)}
    rows = [r for r in rows if r.doc_id in firsts]
    kept = spark.createDataFrame(rows, docs.schema)
    copies = {r.doc_id: (r.taken // r.size if r.size else 1) for r in mixing.mix(kept).collect()}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b)
        for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))})
    want = sorted((r.doc_id, len(library.encode_ordinary(r.text))) for r in rows for _ in range(copies[r.doc_id]))
    assert got == want


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS
        assert 0 < out.count()
    good = {r.doc_id for r in read_table(spark, SF_SMALL, "labels").where("quality = 1").collect()}
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, SF_SMALL).collect()}
    assert len(good & kept) >= 0.99 * len(good)


def test_written_tables_can_be_dropped(spark):
    from demandcast.llm.common import materialize
    table = materialize(spark.range(5).toDF("a"), "t")
    assert table.count() == 5
    drop_tables(spark, [written_tables()[-1]])
    with pytest.raises(Exception):
        table.count()
