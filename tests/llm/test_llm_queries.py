"""The opN_ queries against their SQL twins, and the pipeline against a stage-by-stage check."""

from collections import Counter

import duckdb
import pytest
from oracle import compare
from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_operators import brute_groups, brute_lines, corpus
from tillweave.llm import jaccard, line_crf, queries
from tillweave.llm.shared import settled


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_twin(spark, sf_dir, name):
    compare(spark, sf_dir, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, sizes, kept = docs.columns, [docs.count()], [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
        assert docs.columns == columns
        sizes.append(docs.count())
        kept.append(docs)
    model = line_crf.train(kept[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert sizes[1] == line_crf.scores(kept[0], model).filter(F.col("score") >= line_crf.ACCEPT).count()
    assert sizes[2] == sizes[1]
    assert sizes[3] == jaccard.linked(kept[2]).select("component_id").distinct().count()
    once = kept[4].groupBy("doc_id").count()
    assert once.filter("count > 3").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[4], sf_dir)
    got = packed.groupBy("doc_id").agg((F.sum("length") / F.first("doc_tokens")).alias("times"))
    assert got.join(once, "doc_id").filter("times != count").count() == 0 and got.count() == once.count()


def test_stages_against_brute_force(spark, tmp_path):
    """Line dedup, near duplicates and mixing on a small corpus, by plain Python and by the mixing query's SQL."""
    rows = [(r[0], r[1], r[2], r[3], len(r[1] or "")) for r in corpus(50, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    deduped = settled(corpus_pipeline.dedup_lines(spark, docs, ""))
    want = sorted((r[0], kept, len(kept)) for r, (_, _, kept) in zip(rows, brute_lines(rows), strict=True))
    got = [tuple(r) for r in deduped.collect()]
    assert sorted((r[0], r[1] or "", r[4]) for r in got) == want
    single = settled(corpus_pipeline.near_duplicates(spark, deduped, ""))
    top = {r[0]: c for r, (_, c) in zip(got, brute_groups(got), strict=True)}
    texts = {(r[0], r[1] or "") for r in got if top[r[0]] == r[0]}
    assert sorted((r.doc_id, r.text or "") for r in single.collect()) == sorted(texts)
    single.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    taken = {d: (n // s if s else None) for d, s, n in con.sql(f"select doc_id, size, taken from ({queries.ORACLE_SQL['op7_mixing']})").fetchall()}
    times = Counter(r.doc_id for r in corpus_pipeline.mixture(spark, single, "").collect())
    assert {d: times[d] for d, n in taken.items() if n is not None} == {d: n for d, n in taken.items() if n is not None}


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_tables(spark, sf_dir, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 30, None, "s", 150), (2, "word " * 30, None, "s", 150), (3, "tail\n\n", "en", "s", None)]
    f = corpus_pipeline.STAGES[stage][1]
    assert f(spark, spark.createDataFrame([], schema), sf_dir).count() == 0
    got = f(spark, spark.createDataFrame(rows, schema), sf_dir).collect()
    ids = [r.doc_id for r in got]
    if stage == 1:
        assert sorted(map(str, ids)) == sorted(str(r[0]) for r in rows) and all(r.n_chars == len(r.text or "") for r in got if r.n_chars)
    if stage == 2:
        assert sorted(map(str, ids)) == ["1", "2", "3", "None"]
    if stage == 3:
        assert max(Counter(ids).values()) <= 6 and set(ids) <= {None, 1, 2, 3}
    if stage == 4:
        assert Counter({d: sum(r.doc_tokens for r in got if r.doc_id == d and r.start == 0) for d in set(ids)}) == Counter({d: sum(r.length for r in got if r.doc_id == d) for d in set(ids)})
