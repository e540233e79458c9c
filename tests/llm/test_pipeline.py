"""The pipeline's stages against what each should keep, on a small corpus."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rollbook.llm.shared import keyed, land, scratch
from rollbook.session import BATCH_BYTES, BATCH_SETTING


def test_stages(spark, documents, frame, tmp_path):
    text = " ".join(f"the word{i} of" for i in range(40)) + "."
    near = text.replace("word39", "other")
    leak = " ".join(f"benchmark{i}" for i in range(25))
    rows = [(i, f"the a{i} house b{i} of c{i} the king d{i} and e{i} the sea f{i}.", "en", "s") for i in range(10, 22)]
    rows += [(1, text, "en", "s"), (2, text + " ", "en", "s"), (3, near, "en", "t"), (4, f"the {leak} of", "en", "t"), (5, "123 !!", "en", "t"), (6, None, None, None)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    frame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    everything = {r[0] for r in rows}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        kept.append({r["doc_id"] for r in docs.collect()})
    # The longer of two equal texts stays, then the smaller id of two alike.
    assert kept == [everything - {5, 6}, everything - {1, 5, 6}, everything - {1, 3, 5, 6}, everything - {1, 3, 4, 5, 6}]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in pieces.collect()} == kept[-1]
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(repr, run.drop("sequence_id", "offset").collect())) == sorted(map(repr, pieces.drop("sequence_id", "offset").collect()))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact dedup", "near dedup", "decontamination", "packing"]


def test_stages_judge_rows_not_ids(spark, documents, frame, tmp_path):
    text = " ".join(f"the word{i} of" for i in range(40)) + "."
    other = " ".join(f"a house{i} and" for i in range(40)) + "."
    leak = " ".join(f"benchmark{i}" for i in range(25))
    clean = [f"the a{i} house b{i} of c{i} the king d{i} and e{i} the sea f{i}." for i in range(14)]
    rows = [(i, clean[i], "en", "s") for i in range(10)] + [(None, t, "en", "s") for t in clean[10:13]] + [(0, clean[13], "en", "s")]
    rows += [(None, None, "en", "s"), (1, "123 !!", "en", "s")]  # no letters
    rows += [(None, clean[2], "en", "s"), (None, text, "en", "s"), (None, text, "en", "t"), (3, clean[3], "en", "s")]  # copies
    rows += [(None, other, "en", "s"), (7, other.replace("house39", "lot"), "en", "s"), (7, other.replace("house39", "sea"), "en", "s")]  # near
    rows += [(None, f"the {leak} of", "en", "s"), (4, f"and {leak} by", "en", "s")]
    docs = documents(rows)
    frame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    got = [(r["doc_id"], r["text"]) for r in docs.collect()]
    near = [g for g in got if "house0" in g[1]]
    assert len(near) == 1 and near[0][0] == 7
    want = [(i, clean[i]) for i in range(10)] + [(None, t) for t in clean[10:13]] + [(0, clean[13]), (None, text), *near]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_stages_on_empty_tables_and_long_texts(spark, documents, frame, tmp_path):
    frame([], "item_id long, text string").select("item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = ["doc_id", "text", "lang", "source"]
    docs = documents([]).select(*columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0

    long = " ".join(f"the word{i} of the house by the sea" for i in range(30_000))
    rows = [(i, f"the a{i} house b{i} of c{i} the king d{i} and e{i} the sea f{i}.", "en", "s") for i in range(8)]
    rows += [(8, long, "en", "s"), (9, long + " end", "en", None), (10, long.upper(), None, "s"), (None, None, None, None)]
    docs = documents(rows).select(*columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    # Of the three long texts, which are near-duplicates, one stays.
    assert {r["doc_id"] for r in docs.collect()} == {*range(8), 8}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).where("doc_id = 8").collect()
    assert sum(r["length"] for r in pieces) == pieces[0]["doc_tokens"] > 200_000 and max(r["length"] for r in pieces) <= 1024


def test_scratch_is_emptied(spark):
    held = []
    with scratch(spark):
        held.append(land(spark.range(9), "test"))
        assert held[0].count() == 9
    (path,) = {f.rsplit("/", 1)[0] for f in held[0].inputFiles()}
    assert spark.read.schema("id long").parquet(path).count() == 0
    kept = land(spark.range(9), "test")
    with scratch(spark):
        pass
    assert kept.count() == 9


def test_rows_of_files_have_names_of_their_own(spark, tmp_path):
    for i in range(3):
        spark.range(50, numPartitions=4).selectExpr("id div 10 AS doc_id").write.mode("append").parquet(f"{tmp_path}/t")
    for table in (spark.read.parquet(f"{tmp_path}/t"), spark.range(150).selectExpr("id div 10 AS doc_id")):
        rows, key = keyed(table)
        first, again = ({r[key]: r["doc_id"] for r in rows.collect()} for _ in range(2))
        assert len(first) == 150 and first == again
    # What does not come row by row from files is landed.
    exploded, key = keyed(spark.read.parquet(f"{tmp_path}/t").selectExpr("explode(array(1, 2)) AS doc_id"))
    assert len({r[key] for r in exploded.collect()}) == 300


@pytest.mark.parametrize("name", ["language", "near dedup", "decontamination", "packing"])
def test_python_gets_small_batches(spark, documents, frame, tmp_path, name):
    frame([(1, "an item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    long = spark.range(24, numPartitions=1).select(F.repeat(F.col("id").cast("string"), 1 << 20).alias("text"))
    held = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    try:
        dict(corpus_pipeline.STAGES)[name](spark, documents([(1, "the house by the sea.", "en", "s")]), str(tmp_path))
        found = [r["n"] for r in long.mapInArrow(sizes, "n long").collect()]
        # A batch ends with the row that fills it.
        assert len(found) > 4 and max(found) < BATCH_BYTES + (3 << 20)
        # A caller's own size stays.
        spark.conf.set(BATCH_SETTING, "32m")
        dict(corpus_pipeline.STAGES)[name](spark, documents([(1, "the house by the sea.", "en", "s")]), str(tmp_path))
        assert spark.conf.get(BATCH_SETTING) == "32m"
    finally:
        spark.conf.unset(BATCH_SETTING) if held is None else spark.conf.set(BATCH_SETTING, held)
