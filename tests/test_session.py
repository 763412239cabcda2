"""Stage tables of an application lie in one folder that goes with the run."""

import os

import pytest

from locuswave.llm import near_dedup
from locuswave.session import checkpoint_root, discard, release, stage, tasks_for


def test_release_removes_the_stages_of_the_application(spark):
    kept = os.path.join(checkpoint_root(spark), "another-run")
    os.makedirs(kept, exist_ok=True)
    made = stage(spark.range(5), "numbers")
    folder = os.path.join(checkpoint_root(spark), f"stages-{spark.sparkContext.applicationId}")
    assert made.count() == 5 and os.listdir(folder)
    release(spark)
    assert not os.path.exists(folder) and os.path.isdir(kept)
    release(spark)
    assert stage(spark.range(3), "numbers").count() == 3


def test_tasks_for_rows(spark):
    staged = stage(spark.range(101), "numbers")
    assert [tasks_for(staged, n) for n in (1, 50, 51, 101, 1000)] == [101, 3, 2, 1, 1]
    assert tasks_for(stage(spark.range(0), "numbers"), 10) == 1


def test_discard_removes_stage_tables_only(spark, tmp_path):
    gone, kept = stage(spark.range(7), "gone"), stage(spark.range(5), "kept")
    folder = os.path.dirname(gone.inputFiles()[0].removeprefix("file://"))
    discard(gone.filter("id > 2"))
    assert not os.path.exists(folder) and kept.count() == 5
    spark.range(3).write.parquet(str(tmp_path / "given"))
    given = spark.read.parquet(str(tmp_path / "given"))
    with pytest.raises(ValueError, match="not a stage table"):
        discard(given)
    assert given.count() == 3


def test_near_duplicates_keep_two_stage_tables(spark):
    release(spark)
    texts = ["the quick brown fox jumps over the lazy dog by the river", "another text with words of its own to be kept"]
    docs = spark.createDataFrame([(k, texts[k % 3 % 2] + " again" * (k % 2)) for k in range(12)], "doc_id long, text string")
    found = near_dedup.near_duplicates(docs)
    folder = os.path.join(checkpoint_root(spark), f"stages-{spark.sparkContext.applicationId}")
    left = {name.rsplit("-", 1)[0] for name in os.listdir(folder)}
    assert len(os.listdir(folder)) == 2 and "signatures" in left
    assert found.count() == 12
