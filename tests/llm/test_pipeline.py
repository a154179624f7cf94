import random

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The documents before and after each stage."""
    from stayrate.llm.common import stored, table

    docs = table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), name))
    return out


def test_stages_keep_the_columns_of_documents(stages):
    for docs in stages[:-1]:
        assert docs.columns == stages[0].columns and docs.schema == stages[0].schema
    assert stages[-1].columns == [*stages[0].columns, "token_ids", "decoded", "n_tokens"]


def test_quality_drops_what_is_labelled_low(spark, stages, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    low = [i for i, q in labels.items() if q == 0]
    high = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in low) <= 0.2 * len(low) and sum(i in kept for i in high) >= 0.97 * len(high)


def test_one_of_each_group_stays(stages):
    from test_jaccard import brute_force

    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert {r.doc_id for r in stages[2].collect()} == {c for _, _, c in brute_force(before)}


def test_repeats_are_cut_and_nothing_else(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[2:4])
    assert set(before) == set(after)
    runs = {}
    for i, r in sorted(after.items()):
        w = r.text.split()
        for k in range(len(w) - 60):
            runs.setdefault(tuple(w[k : k + 61]), set()).add(i)
        assert r.n_chars == len(r.text) and len(r.text) <= len(before[i].text)
    assert not [v for v in runs.values() if len(v) > 1]


def test_no_benchmark_item_is_left(spark, stages, sf_dir):
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for r in stages[4].collect():
        told = " ".join(r.text.split())
        assert not any(i in told for i in items)


def test_tokens_decode_to_the_text(stages):
    assert stages[5].count() == stages[4].count()
    assert stages[5].where("not (decoded <=> text) or n_tokens <> size(token_ids)").count() == 0


def test_run_equals_the_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(got.select("doc_id", "n_tokens").collect()) == sorted(stages[-1].select("doc_id", "n_tokens").collect())


def test_odd_rows_pass_every_stage(spark, documents, odd_rows, tmp_path):
    draw = random.Random(6)
    text = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))
    rows = [*odd_rows, *((k, text(80)) for k in range(100, 130)), (130, "long " * 50_000)]
    docs = documents(rows).withColumn("component_id", F.lit("clash")).withColumn("score", F.lit(1))
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, k % 2, 0) for k in range(100, 120)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, text(30)), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    from stayrate.llm.common import stored

    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, str(tmp_path)), name)
        assert set(docs.columns) <= set(now.columns)


def _prose(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))


def test_rows_that_share_an_id_are_told_apart(spark, documents, sf_dir):
    draw = random.Random(11)
    one, two, three, four = (_prose(draw, 60) for _ in range(4))
    near = " ".join(["changed", *one.split()[1:]])
    rows = [(3, one), (3, two), (None, three), (None, four), (5, near), (None, three), (9, four), (3, two)]
    kept = corpus_pipeline.keep_one_of_similar(spark, documents(rows), sf_dir).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(3, one), (3, two), (None, three), (9, four)], key=str)


def test_only_the_row_with_a_leak_goes(spark, documents, tmp_path):
    draw = random.Random(12)
    item, clean, other = _prose(draw, 25), _prose(draw, 60), _prose(draw, 60)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    held = f"{_prose(draw, 20)} {item} {_prose(draw, 20)}"
    rows = [(None, held), (None, clean), (4, held), (4, other), (5, None), (6, "")]
    kept = corpus_pipeline.drop_leaks(spark, documents(rows), str(tmp_path)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(None, clean), (4, other), (5, None), (6, "")], key=str)


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
