"""One text of 5 MB, and one of 5 MB without a space, through the operators and stages: longer than what a step holds at once."""

import random

import pytest

import corpus_pipeline
from topicloom.llm import queries
from topicloom.llm.common import SLICE_BYTES


@pytest.fixture(scope="module")
def huge(spark, sf_dir, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("huge"))
    docs, rng = spark.read.parquet(f"{sf_dir}/documents.parquet"), random.Random(1)
    texts, long = [r["text"] for r in docs.where("text is not null").collect()], []
    while sum(map(len, long)) < 5 << 20:
        long.append(rng.choice(texts))
    rows = [(10**6, "\n".join(long), "en", "s", 0), (10**6 + 1, "".join(rng.choices("abcdefghij日本語é0123", k=5 << 20)), "en", "s", 0)]
    assert all(len(r[1].encode()) > SLICE_BYTES for r in rows)
    docs.limit(40).unionByName(spark.createDataFrame(rows, docs.schema)).repartition(3).write.parquet(f"{place}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{place}/{name}.parquet")
    return place


@pytest.mark.parametrize("name", ["op1_temperature_mix", "op2_token_records", "op3_license_diagonals", "op4_line_labels", "op5_relative_parse", "op6_decontaminate", "op7_secret_models", "op8_simhash", "op11_disclosure", "op13_infill"])
def test_operators(spark, huge, name):
    ids = [r["doc_id"] for r in queries.queries()[name](spark, huge).select("doc_id").collect()]
    assert {10**6, 10**6 + 1} <= set(ids) and len(set(ids)) == 42


def test_search_finds_the_long_text(spark, huge):
    found = queries.op12_inverted_treaps(spark, huge).collect()
    assert any(r["doc_id"] == 10**6 for r in found)


@pytest.mark.parametrize("name", ["near_dedup", "decontamination", "mixing"])
def test_stages(spark, huge, name):
    docs = spark.read.parquet(f"{huge}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, huge)
    assert out.columns == docs.columns and {10**6 + 1} <= {r["doc_id"] for r in out.select("doc_id").collect()}
