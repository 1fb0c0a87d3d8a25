"""Each stage of the pipeline on its own input, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortlens.llm.secrets import ACCESS, HEX
from test_decontamination import _plain as plain_contamination
from test_near_duplicates import _plain as plain_duplicates
from test_near_duplicates import _set

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, folder).cache()
        assert df.columns[:5] == COLUMNS
        out.append((name, df.collect()))
        docs = df
    return dict(out)


def test_order_of_stages():
    names = ["toxicity", "jaccard_join", "decontamination", "secret_scan", "source_mix"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names


def test_toxic_go(spark, folder, steps):
    from cohortlens.llm.toxicity import rate

    rated = rate(*(spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")))
    left = {r.doc_id for r in rated.where("predicted = 0").collect()}
    assert {r.doc_id for r in steps["toxicity"]} == left


def test_one_of_each_stays(steps):
    before = [(r.doc_id, r.text) for r in steps["toxicity"]]
    want = sorted({c for _, c, _, _ in plain_duplicates([r for r in before if _set(r[1])])})
    assert sorted(r.doc_id for r in steps["jaccard_join"]) == want
    texts = dict(before)
    assert all(r.text == texts[r.doc_id] for r in steps["jaccard_join"])


def test_contaminated_go(spark, folder, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in steps["jaccard_join"] if not plain_contamination(r.text, items)[3]}
    assert {r.doc_id for r in steps["decontamination"]} == clean


def test_secrets_masked(steps):
    import re

    before = {r.doc_id: r for r in steps["decontamination"]}
    assert {r.doc_id for r in steps["secret_scan"]} == set(before)
    for r in steps["secret_scan"]:
        assert not re.search(ACCESS, r.text) and not re.search(HEX, r.text)
        assert r.n_chars == (before[r.doc_id].n_chars if r.text == before[r.doc_id].text else len(r.text))


def test_mixture_is_whole_and_ordered(steps):
    rows = steps["source_mix"]
    assert sorted(r[:5] for r in rows) == sorted(tuple(r) for r in steps["secret_scan"])
    assert [r.mix_slot for r in rows] == sorted(r.mix_slot for r in rows)


def test_run(spark, folder, steps):
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, steps["source_mix"]))


def test_names_of_the_stages_own_columns(spark, folder):
    """Columns named like any that a stage uses inside come back as they were."""
    names = """_document _row row rid id hash one nth first worded class_id n_links n_copies set_id bad_id
    bad_hash text_hash words n_words pos len window items copies contaminated spans hits copy owner base opaque
    live block slot size _p _stretch _key _text_key _range _name _nameless _run _offset _carry mix_block mix_slot
    mix_slot_2 score predicted held_out toxic _stay_id _stay_hash _stay_nth _bad_id _bad_hash""".split()
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    docs = docs.select("*", *(F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        assert len(set(out.columns)) == len(out.columns) and out.count() > 0
        for r in out.collect():
            assert all(r[n] == f"{n} {r.doc_id}" for n in names), name
    assert out.columns[-2:] == ["mix_block_2", "mix_slot_3"]


def test_odd_rows(spark, tmp_path):
    rng = random.Random(0)
    words = lambda n: " ".join("w%d" % rng.randint(0, 999) for _ in range(n))
    rows = [(i, words(50), None, "s", 1, 7, "x") for i in range(20)]
    rows += [(None, None, None, None, None, None, None), (1, "", None, None, 0, 1, None), rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, block int, spans string"
    docs = spark.createDataFrame(rows, schema)
    tables = {
        "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, None)], "item_id long, text string"),
    }
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        folder = str(tmp_path / str(empty))
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, folder)
            assert now.columns[:7] == docs.columns
        assert now.count() == (0 if empty else 22)
        assert now.where(F.col("mix_slot").isNull()).count() == 0
