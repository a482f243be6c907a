"""Every operator and pipeline stage on awkward tables: nulls, empty and long texts, ties, repeats, clashing columns, no rows."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegate.llm import exact_dedup, html, line_dedup, outliers, packing, quality, sharding, simhash, substring_dedup, transducer

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CLASHING = ("id", "fp", "rank", "digest", "row", "size", "key", "range", "n", "k", "t", "label", "score", "draw", "stratum", "start", "h", "a", "b", "best", "chunk", "bin", "held_out", "kept", "n_removed", "n_bytes")

LONG = "lorem ipsum dolor sit amet " * 6000
ROWS = [
    (1, "one two three four five", "en", "s0"),
    (1, "one two three four five", "en", "s0"),
    (2, "one two three four five", None, None),
    (None, "one two three four five", "en", "s0"),
    (3, None, "de", "s1"),
    (4, "", None, "s1"),
    (5, " \t\n\n ", "fr", None),
    (6, LONG, "en", "s0"),
    (7, LONG + "x", "en", "s0"),
    (9_007_199_254_740_993, "große Straße, 漢字 🙂 <|endoftext|> ▁", "de", "s1"),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return plain.select("*", F.length("text").cast("long").alias("n_chars"), *(F.lit(f"own {c}").alias(c) for c in CLASHING))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (None, 1, 1), (6, 1, None), (7, None, 0)], "doc_id long, quality int, toxic int")


def operators(labels):
    return {
        "packing": lambda d: packing.pack(d, WORDS),
        "simhash": simhash.near_dedup,
        "quality": lambda d: quality.classify(d, labels),
        "exact": exact_dedup.exact_dedup,
        "html": lambda d: html.extract(d.withColumnRenamed("text", "html").withColumn("url", F.col("lang")), "doc_id"),
        "transducer": lambda d: transducer.encode(d, PIECES),
        "sharding": sharding.shard,
        "substring": substring_dedup.substring_dedup,
        "outliers": outliers.quality_rules,
        "lines": line_dedup.line_dedup,
    }


NAMES = ["packing", "simhash", "quality", "exact", "html", "transducer", "sharding", "substring", "outliers", "lines"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows_give_a_row_each(docs, labels, name):
    out = operators(labels)[name](docs).collect()
    if name == "packing":
        assert sorted({(r.doc_id is None, r.doc_id or 0) for r in out}) == sorted({(r[0] is None, r[0] or 0) for r in ROWS})
    else:
        assert sorted((r.doc_id or 0) for r in out) == sorted((r[0] or 0) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table_gives_no_rows(docs, labels, name):
    assert operators(labels)[name](docs.filter("false")).collect() == []


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_the_columns_of_documents(spark, docs, labels, stage, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    step = dict(corpus_pipeline.STAGES)[stage]
    for rows in (docs, docs.filter("false")):
        out = step(spark, rows, str(tmp_path))
        if stage != corpus_pipeline.STAGES[-1][0]:
            assert out.schema.names == rows.schema.names
            assert [f.dataType for f in out.schema] == [f.dataType for f in rows.schema]
        out.collect()


def test_defined_results_of_the_awkward_rows(docs, labels):
    exact = {(r.doc_id, r.text_sha256, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    same = [x for x in exact_dedup.exact_dedup(docs).collect() if x.group_size == 4]
    assert len(same) == 4 and {r.keep_id for r in same} == {2} and [r.doc_id for r in same if r.kept] == [2]
    assert len(exact) == 10  # the repeated row has the same result twice
    near = simhash.near_dedup(docs).collect()
    assert {r.component_id for r in near if r.fingerprint == "0" * 16} == {3}
    gone = {(r.doc_id, r.n_bytes): (r.n_removed, r.text) for r in substring_dedup.substring_dedup(docs).collect()}
    assert gone[7, len(LONG) + 1] == (len(LONG), "x") and gone[6, len(LONG)] == (0, LONG)
    kept = line_dedup.line_dedup(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept if r.text and r.text.startswith("one")) == [(1, "one two three four five")] * 2
    assert [r.text for r in kept if r.doc_id == 5] == [" \t\n\n "] and [r.text for r in kept if r.doc_id == 3] == [None]
    assert {r.kept for r in outliers.quality_rules(docs).collect()} == {False}


def test_batches_of_the_stages_are_bounded_in_bytes(spark, monkeypatch):
    """4,000 texts of 3,000 bytes in one partition come in several batches."""

    def sizes(docs, _):
        return docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")

    monkeypatch.setattr(corpus_pipeline, "pack", sizes)
    texts = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 3000).alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        got = [r.n for r in dict(corpus_pipeline.STAGES)["packing"](spark, texts, "").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert sum(got) >= 12_000_000 and max(got) < 5_000_000
