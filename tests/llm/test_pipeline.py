"""Each stage of the pipeline against brute force over what its predecessor kept."""

from collections import Counter

import corpus_pipeline
import pytest
from test_decontaminate import slow_matches
from test_huffman_ids import expected as slow_ids
from test_simhash_dedup import slow_components, slow_fingerprint

from conftest import TESTDATA
from parcelmart.llm import curriculum, gam_quality
from parcelmart.llm.common import stage, table, written_place

SF = str(TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def outputs(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        kept.append(stage(step(spark, kept[-1], SF), f"test-pipeline-{k}"))
    return kept


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_columns_stay(outputs):
    for df in outputs[1:5]:
        assert df.columns == outputs[0].columns
        assert not set(rows(df, *df.columns)) - set(rows(outputs[0], *df.columns))


def test_quality_stage(spark, outputs):
    model = gam_quality.train(outputs[0], table(spark, SF, "labels"))
    docs = rows(outputs[0], "doc_id", "text")
    scores = model.score(gam_quality.np.array([gam_quality.features(text) for _, text in docs]))
    assert sorted(rows(outputs[1], "doc_id", "text")) == sorted(d for d, s in zip(docs, scores, strict=True) if s >= 0.5)


def test_dedup_stage(outputs):
    docs = rows(outputs[1], "doc_id", "text")
    groups = slow_components([(d, slow_fingerprint(t)) for d, t in docs])
    assert sorted(r[0] for r in rows(outputs[2], "doc_id")) == sorted({component for _, _, component in groups})


def test_decontamination_stage(spark, outputs):
    docs = rows(outputs[2], "doc_id", "text")
    bad = {d for d, _ in slow_matches(docs, rows(table(spark, SF, "benchmark"), "item_id", "text"))}
    assert bad
    assert sorted(r[0] for r in rows(outputs[3], "doc_id")) == sorted(d for d, _ in docs if d not in bad)


def test_mixing_stage(outputs):
    plan = {r.doc_id: r.copies for r in curriculum.mix(outputs[3]).select("doc_id", "copies").collect()}
    assert Counter(r[0] for r in rows(outputs[4], "doc_id")) == Counter({d: n for d, n in plan.items() if n})


def test_output_stage(outputs):
    wanted = Counter((d, n, c) for d, _, n, c in slow_ids(rows(outputs[4], "doc_id", "text")))
    assert Counter(rows(outputs[5], "doc_id", "n_tokens", "ids_crc32")) == wanted
    places = sorted(rows(outputs[5], "start", "n_tokens"))
    assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))


def test_token_files_follow_the_training_order(outputs):
    placed = rows(curriculum.training_order(curriculum.mix(outputs[3])), "mix_position", "source", "doc_id")
    assert [d for _, d in sorted(rows(outputs[5], "start", "doc_id"))] == [d for _, _, d in sorted(placed)]


def test_the_written_order_is_found_again(spark):
    """Also from files of different sizes, which readers open in another order."""
    ids = spark.range(20_000).selectExpr("id", "repeat(uuid(), int(id % 7000 / 100)) text")
    read = stage(ids.repartitionByRange(30, -ids.id).sortWithinPartitions(-ids.id), "test-order")
    assert [r.id for r in read.orderBy(written_place(read)).collect()] == list(range(20_000))[::-1]
    assert [r.id for r in read.collect()] != list(range(20_000))[::-1]


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), "test-pipeline")
    assert docs.count() == 0
