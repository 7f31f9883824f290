"""The pipeline's stages against brute force on what each of them gets."""

from collections import Counter

import pyarrow.parquet as pq
from test_llm_operators import RANKS, expected_bpe, expected_lines, expected_near, sha

import corpus_pipeline
from sidewise.llm import toxicity
from sidewise.llm.common import stored, table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF), "test-stage")
        kept[name] = before, docs
        if name != "byte_bpe":
            assert docs.columns == columns
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    rows = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]

    before, after = kept["toxicity"]
    scores = toxicity.classify(before, table(spark, SF, "labels")).collect()
    assert ids(after) == {r["doc_id"] for r in scores if not r["predicted"]}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    gone = ids(before) - ids(after)
    assert gone and sum(labels.get(i, 1) for i in gone) >= 0.95 * len(gone)

    before, after = kept["line_dedup"]
    # What loses its lines and is left without a word goes; op7 says what each document keeps.
    blank = {sha(t) for t in ("", *("\n" * n for n in range(1, 2000)))}
    expected = Counter((i, text) for i, _, dropped, text in expected_lines(rows(before)) if not (dropped and text in blank))
    assert expected == Counter((i, sha(t)) for i, t in rows(after))
    assert len(ids(before)) > len(ids(after)) and not any(not t.strip() for _, t in rows(after))
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = kept["near_dedup"]
    assert ids(after) == {i for i, _, _, keep in expected_near(rows(before), 5, 80) if keep}

    before, after = kept["decontamination"]
    assert 0 < len(ids(before) - ids(after)) < 60

    before, after = kept["byte_bpe"]
    got = after.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(map(tuple, got)) == expected_bpe(rows(before))
    assert RANKS


def test_copies_that_line_dedup_empties_are_dropped_and_blank_input_stays(spark):
    line = "a line of some length that two documents share"
    rows = [(1, f"{line}\nand one more line of its own"), (2, line), (3, f"{line}\n{line}\n \n"), (4, " \n"), (5, None), (6, f"{line}\nshort")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, docs, SF).collect()}
    assert kept == {1: rows[0][1], 4: " \n", 5: None, 6: "short"}


def test_run_and_awkward_rows(spark, tmp_path):
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert run.count() > 100
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, gone_id string, lines string"
    rows = [(None, None, None, None, None, "a", "b", "c"), (1, "", "en", "s", 0, None, None, None), (1, "x " * 4000, "en", "s", 1, None, None, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        names = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, "/root/testdata/sf0.001"), "test-stage")
            assert docs.columns == names
        assert stage is not None and corpus_pipeline.encode(spark, docs, "").count() == docs.count()
