from __future__ import annotations

import corpus_pipeline
import pytest

from tidewatch.llm.packing import best_fit_packing
from tidewatch.llm.private_data import base_spans
from tidewatch.llm.quality_rules import quality_rules
from tidewatch.llm.simhash import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    sf_dir, folder = "/root/testdata/sf0.001", tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], sf_dir).write.parquet(str(folder / str(number)))
        frames.append(spark.read.parquet(str(folder / str(number))))
    return frames


def test_stages_in_their_order(staged):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash", "private_data", "mixing", "packing",
    ]
    assert all(frame.columns == COLUMNS for frame in staged[:-1])


def test_each_stage_does_its_work_on_what_was_kept(staged):
    docs, kept, single, clean, mixture, packed = staged
    judged = {r["doc_id"]: r["quality_metrics"]["kept"] for r in quality_rules(docs).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, good in judged.items() if good}
    groups = {r["component_id"] for r in near_duplicates(kept).collect()}
    assert {r["doc_id"] for r in single.collect()} == groups and single.count() == len(groups)
    rows = clean.collect()
    assert {r["doc_id"] for r in rows} == groups
    assert all(not base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in rows)
    texts = {r["doc_id"]: r["text"] for r in rows}
    assert all(texts[r["doc_id"]] == r["text"] for r in mixture.collect())
    assert packed.count() == best_fit_packing(mixture).count()


def test_run_gives_the_last_stage(spark, staged):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.columns == staged[-1].columns and found.count() == staged[-1].count()


@pytest.mark.parametrize("odd", ["odd_docs", "no_docs"])
def test_odd_documents_pass_every_stage(spark, odd, request, tmp_path):
    docs = request.getfixturevalue(odd)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
    assert (docs.count() > 0) == (odd == "odd_docs")
