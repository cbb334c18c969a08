"""The pipeline stage by stage, each against brute force on its own input."""

import collections
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from riskloom.llm.decontaminate import plain_words
from riskloom.llm.queries import QUERIES, STATEMENTS
from riskloom.llm.token_orc import default_tokenizer

from .test_dedup import near_by_hand
from .test_filters import WORD, plain_encoding, targets_by_hand


@pytest.fixture(scope="module")
def kept(spark, testdata, tmp_path_factory):
    """What every stage returns, written and read again."""
    docs, out = spark.read.parquet(f"{testdata}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, testdata).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return out


def test_stage_names_and_columns(kept):
    assert [name for name, *_ in kept] == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    for _, before, after in kept[:-1]:
        assert after.columns == before.columns


def test_quality_stage(spark, testdata, kept):
    _, before, after = kept[0]
    labels = dict(spark.read.parquet(f"{testdata}/labels.parquet").select("doc_id", "quality").collect())
    left = {r.doc_id for r in after.collect()}
    good, bad = ([i for i, q in labels.items() if q == v] for v in (1, 0))
    assert sum(i in left for i in good) >= 0.98 * len(good) and sum(i in left for i in bad) <= 0.05 * len(bad)


def test_near_dedup_stage(kept):
    _, before, after = kept[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = {i for i, (_, _, stays) in near_by_hand(rows, 5, 80).items() if stays}
    assert {r.doc_id for r in after.collect()} == want


def test_decontaminate_stage(spark, testdata, kept):
    _, before, after = kept[2]
    items = [f" {' '.join(plain_words(r.text))} " for r in spark.read.parquet(f"{testdata}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in before.collect() if not any(i in f" {' '.join(plain_words(r.text))} " for i in items)}
    assert {r.doc_id for r in after.collect()} == clean and len(clean) < before.count()


def test_mix_stage(kept):
    _, before, after = kept[3]
    size = {r.doc_id: len(WORD.findall(r.text)) for r in before.collect()}
    source = {r.doc_id: r.source for r in before.collect()}
    sizes, taken = collections.Counter(), collections.Counter()
    for i, n in size.items():
        sizes[source[i]] += n
    copies = collections.Counter(r.doc_id for r in after.collect())
    for i, n in copies.items():
        taken[source[i]] += n * size[i]
    assert max(copies.values()) <= 2
    for s, target in targets_by_hand(sizes, 1.5, (5, 2, 1)).items():
        assert taken[s] == pytest.approx(target, rel=0.02)


def test_token_stage(kept):
    _, before, after = kept[4]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    got = sorted(tuple(r) for r in after.collect())
    start = 0
    for (i, _), ids, row in zip(rows, plain_encoding([t for _, t in rows]), got, strict=True):
        assert row == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_run_goes_through_all_stages(spark, kept):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_registered():
    assert [q for q in QUERIES if q != "pipeline"] and all(re.match(r"op\d+_|pipeline$", q) for q in QUERIES)
    assert set(STATEMENTS) <= set(QUERIES) and default_tokenizer().endswith(".json")


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_statements(spark, testdata, name):
    import check
    assert check.compare(spark, check.duck(testdata), name, testdata)[0]
