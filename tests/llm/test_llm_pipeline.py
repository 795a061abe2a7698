"""The stages of the corpus pipeline, one by one and in a row."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from salescope.llm import decontamination, mixing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in for is on that by this with from at are as be it or an river stone winter garden".split()


def prose(seed, n=120):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def rows(*texts):
    return [(n, t, "en", f"s{n % 3}", None if t is None else len(t)) for n, t in enumerate(texts)]


def awkward():
    out = rows(None, "", " \n ", "one", prose(1), "a\n\nb", "\n".join([prose(2, 12)] * 9), "é ü " * 40)
    return out + [out[4], out[4], (None, None, None, None, None), (None, prose(3), None, None, None), (None, prose(3), None, None, None)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    """A benchmark of one passage, and the labels and documents of the small tables."""
    path = tmp_path_factory.mktemp("tables")
    for name in ("documents", "labels"):
        pq.write_table(pq.read_table(f"/root/testdata/sf0.001/{name}.parquet"), path / f"{name}.parquet")
    spark.createDataFrame([(1, prose("passage", 60))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def test_quality_stage_keeps_what_is_predicted_good(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = pipeline.keep_quality(spark, docs, folder)
    judged = quality.classify(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r.row.doc_id for r in judged.filter("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good and 0 < len(good) < docs.count()
    assert kept.schema.simpleString() == docs.schema.simpleString()


def test_line_stage_removes_later_runs(spark, folder):
    run = "\n".join(prose(f"run{n}", 15) for n in range(4))
    docs = frame(spark, rows(f"first\n{run}\nend", prose(9), f"second\n{run}\ntail"))
    found = {r.doc_id: r for r in pipeline.drop_repeated_lines(spark, docs, folder).collect()}
    assert found[0].text == f"first\n{run}\nend" and found[1].text == prose(9)
    assert found[2].text == "second\ntail" and found[2].n_chars == len("second\ntail")
    assert found[0].n_chars == len(found[0].text)


def test_near_duplicate_stage_keeps_the_first(spark, folder):
    text = prose(5, 900)
    edited = text.replace(text.split()[450], "changed", 1)
    docs = frame(spark, rows(prose(6, 900), text, prose(7, 900), edited, text))
    assert sorted(r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, folder).collect()) == [0, 1, 2]


def test_contaminated_documents_go(spark, folder):
    passage = prose("passage", 60)
    docs = frame(spark, rows(prose(1), f"{prose(2)} {passage} {prose(3)}", " ".join(passage.split()[:12]), prose(4, 5000) + " " + " ".join(passage.split()[:20])))
    # The third holds less than a window, the fourth too little of one in its 5,020 words.
    assert sorted(r.doc_id for r in pipeline.drop_contaminated(spark, docs, folder).collect()) == [0, 2, 3]


def test_mix_gives_every_row_its_share(spark, folder):
    data = rows(*[prose(n, 30 + 7 * n) for n in range(12)])
    data += [data[5]] * 3 + [data[6]]
    docs = frame(spark, data)
    found = pipeline.mix_sources(spark, docs, folder)
    assert found.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    got = found.collect()
    shares = [r.taken for r in mixing.mixture(docs).collect()]
    assert sorted(r.taken for r in got) == sorted(t for t in shares if t)
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
        assert all(r.size == len(r.text.split()) and r.taken <= 3 * r.size for r in own)
    clash = docs.withColumn("taken", F.lit("x")).withColumn("key", F.lit("y"))
    again = pipeline.mix_sources(spark, clash, folder)
    assert again.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "size", "source_size", "target", "taken"]
    assert sorted(r.taken for r in again.collect()) == sorted(r.taken for r in got)


def test_null_source_and_text_are_told_apart(spark, folder):
    docs = spark.createDataFrame([(1, None, "en", "one two", None), (1, "one two", "en", None, 7)], SCHEMA)
    found = pipeline.mix_sources(spark, docs, folder).collect()
    assert [(r.text, r["size"]) for r in found] == [("one two", 2)]


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stages_on_awkward_rows_and_on_none(spark, folder, name, stage):
    docs = frame(spark, awkward())
    found = stage(spark, docs, folder)
    assert found.columns[:5] == docs.columns
    ids = [r.doc_id for r in docs.collect()]
    assert all(r.doc_id in ids for r in found.collect())
    assert stage(spark, docs.limit(0), folder).count() == 0


def test_run_is_its_stages_in_a_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = pipeline.run(spark, folder)
    kept = found.select(*docs.columns)
    assert 0 < found.count() < docs.count()
    assert pipeline.drop_near_duplicates(spark, kept, folder).count() == kept.count()
    assert decontamination.decontaminate(kept, benchmark).filter("contaminated").isEmpty()
    assert found.filter("taken <= 0 OR taken > 3 * size").isEmpty()
