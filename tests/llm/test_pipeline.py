"""The stages one by one against brute force on their own input, and run() against the chain of them."""

import pytest

import corpus_pipeline
from tests.conftest import SF
from tests.llm import test_decontaminate, test_jaccard, test_quality
from tidemark.llm import toxicity
from tidemark.llm.tables import table


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "ngram_jaccard_join", "decontamination", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns
        before = {r.doc_id: r for r in docs.collect()}
        rows = out.collect()
        kept[name] = {r.doc_id for r in rows}
        assert len(rows) == len(kept[name]) and all(before[r.doc_id] == r for r in rows)
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.toxicity(docs, table(spark, SF, "labels")).where("predicted = 1").collect()}
            assert kept[name] == set(before) - bad
        elif name == "quality_rules":
            assert kept[name] <= {d for d, r in before.items() if not test_quality.base(r.text)[-1]}
        elif name == "ngram_jaccard_join":
            groups = test_jaccard.brute([(d, r.text) for d, r in before.items()], 5, 80)
            assert kept[name] == {d for d, (_, c) in groups.items() if c == d}
        else:
            items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
            assert kept[name] == {r[0] for r in test_decontaminate.brute([(d, r.text) for d, r in before.items()], items) if not r[-1]}
        docs = spark.createDataFrame(rows, out.schema)
    final = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in final.collect()} == kept["decontamination"]


def test_one_row_of_each_near_duplicate_group_stays(spark):
    prose = " ".join(f"word{i}" for i in range(120))
    other = " ".join(f"other{i}" for i in range(90))
    third = " ".join(f"third{i}" for i in range(90))
    rows = [(None, prose), (7, prose + " tail"), (7, prose), (9, prose), (9, "a text of its own"), (None, prose),
            (None, other), (None, other), (None, other + " end"), (3, third), (3, third), (4, None), (None, ""), (None, " ")]
    out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    left = [(r.doc_id, r.text) for r in out]
    assert len(left) == 7 and all(r in rows for r in left)
    assert sum((t or "").startswith("word") for _, t in left) == 1 and 7 in {d for d, t in left if (t or "").startswith("word")}
    assert (9, "a text of its own") in left
    assert [d for d, t in left if (t or "").startswith("other")] == [None]
    assert left.count((3, third)) == 1
    assert {r for r in left if not (r[1] or "").strip()} == {(4, None), (None, ""), (None, " ")}


def test_odd_rows_pass_all_stages(spark, tmp_path):
    prose = " ".join(f"word{i}" for i in range(120))
    rows = [(1, prose, None, None, None), (1, prose, None, None, None), (None, prose + " tail", "en", "s", 1), (2, None, "en", "s", 0), (3, "", None, "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, kind in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    n = len(Tokenizer.from_file(path).encode(prose, add_special_tokens=False).ids) + 1
    assert [(r.doc_id, r.n_tokens) for r in out] == [(1, n)]  # the copies are one group: the row with the smallest id stays, once
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).write.parquet(str(tmp_path / "none" / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
