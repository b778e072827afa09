"""The pipeline's stages, each against brute force on its own input."""

import importlib.util

import brute
import pytest
import tiktoken
from edge_rows import SF0001, edge  # noqa: F401

import __spark_entry__ as E
import corpus_pipeline as P
from stayflow.llm import bpe, quality


def test_registered():
    names = [n for n in E.queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and "pipeline" in E.queries()
    assert importlib.util.find_spec("stayflow.llm")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    found = [docs]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, found[-1], SF0001).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def test_columns_pass_through(steps):
    assert all(d.dtypes == steps[0].dtypes for d in steps[:-1])


def test_quality_stage(spark, steps):
    model = quality.train(steps[0], spark.read.parquet(f"{SF0001}/labels.parquet"))
    want = {r.doc_id for r in quality.judge(steps[0], model).collect() if r.kept}
    assert {r.doc_id for r in steps[1].collect()} == want


def test_dedup_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    want = sorted(d for d, _, c in brute.near_duplicates(rows) if d == c)
    assert sorted(r.doc_id for r in steps[2].collect()) == want


def test_decontamination_stage(spark, steps):
    items = [r.text for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in steps[2].collect() if any(i in r.text for i in items)}
    assert {r.doc_id for r in steps[3].collect()} == {r.doc_id for r in steps[2].collect()} - leaky and leaky


def test_secret_stage(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    assert set(before) == set(after)
    for d, t in before.items():
        assert not brute.secret_base(after[d].text) and after[d].n_chars == len(after[d].text)
        if not brute.secret_base(t):
            assert after[d].text == t


def test_token_stage(steps):
    ranks = bpe.Encoder(bpe.read_ranks(bpe_path()), P.public_tokenizers.PATTERN).ranks
    exact = tiktoken.Encoding("own", pat_str=P.public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r.doc_id: r.text for r in steps[4].collect()}
    for r in steps[5].collect():
        assert r.ids == exact.encode_ordinary(text[r.doc_id]) and r.decoded_sha256 == brute.sha(text[r.doc_id].encode())


def bpe_path():
    return P.public_tokenizers.path(P.VOCABULARY)


def test_run_equals_the_stages(spark, steps):
    assert sorted(tuple(r) for r in P.run(spark, SF0001).collect()) == sorted(tuple(r) for r in steps[5].collect())


def test_stages_on_edge_rows(spark, edge):
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in edge],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        d = docs.limit(0) if empty else docs
        for _, stage in P.STAGES:
            d = stage(spark, d, SF0001)
        assert (d.count() == 0) == empty
