"""The pipeline, stage by stage, on a small table."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as p

from .conftest import document_rows
from .test_groups import plain_components
from .test_texts import plain_line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_in_order(spark, docs):
    columns, stages = docs.columns, dict(p.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "mixing", "best_fit_packing"]
    good = stages["quality_rules"](spark, docs, "").cache()
    assert good.columns == columns and {1, 4, 19} <= {r.doc_id for r in good.collect()} and good.where("doc_id = 15").count() == 0

    thin = stages["line_dedup"](spark, good, "").cache()
    texts = {r.doc_id: r.text for r in good.collect() if r.doc_id is not None}
    want = {k: v for k, v in plain_line_dedup(sorted(texts.items()), True).items() if WORD.search(v)}
    assert thin.columns == columns and {r.doc_id: r.text for r in thin.collect() if r.doc_id is not None} == want

    one = stages["near_dedup"](spark, thin, "").cache()
    group = plain_components(sorted(want.items()))
    assert one.columns == columns and {r.doc_id for r in one.collect()} - {None} == {d for d in want if group[d][1] == d}

    mixed = stages["mixing"](spark, one, "").cache()
    left = {r.doc_id: r.text for r in one.collect()}
    assert mixed.columns == columns
    taken = Counter()
    for r in mixed.collect():
        assert r.text.strip() in left[r.doc_id] and r.n_chars == len(r.text)
        taken[r.doc_id] += len(WORD.findall(r.text))
    rows = Counter(r.doc_id for r in one.collect())  # a repeated row is a row of its own
    assert all(n <= 3 * rows[d] * len(WORD.findall(left[d])) for d, n in taken.items())

    packed = stages["best_fit_packing"](spark, mixed, "")
    words = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert words == dict(taken)


def test_run_over_documents(spark, tmp_path):
    spark.createDataFrame([r[:5] for r in document_rows()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    out = p.run(spark, str(tmp_path))
    assert out.count() > 0 and {"doc_id", "bin_id", "n_words"} <= set(out.columns)


def test_columns_with_clashing_names_pass(spark, docs):
    names = ["rid", "lead", "block", "key", "row_no", "line", "at", "first", "component", "shard", "words", "doc", "__removed", "removed", "__gone", "gone_id", "__rid", "segments", "part", "c0", "c1", "unit", "times"]
    wide = docs.withColumns({n: F.lit(n) for n in names})
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, wide, "")
        assert out.columns == wide.columns
        assert {tuple(r) for r in out.select(*names).distinct().collect()} == {tuple(names)}, name
    assert p.STAGES[-1][1](spark, wide, "").count() > 0


def test_columns_that_differ_by_case_pass(spark, docs):
    """Such a table can't be written as Parquet, but a stage takes and returns it."""
    wide = docs.toDF(*docs.columns[:5], "TEXT", "Doc_Id", "N_CHARS")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, wide, "")
        assert out.columns == wide.columns and len(out.collect()) > 0, name
    assert p.STAGES[-1][1](spark, wide, "").count() > 0
