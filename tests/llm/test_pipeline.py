"""Each stage of the pipeline on what the stage before kept, against brute force."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline
from ferrylog.llm import language, quality
from tests.llm import test_minhash, test_packing, test_quality, test_repeats


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    """``documents``, some odd rows among them, and the rows after each stage."""
    root = tmp_path_factory.mktemp("steps")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("n_words", F.lit("mine"))
    some = docs.where("doc_id % 10 = 3")
    docs = docs.union(some.withColumn("doc_id", F.col("doc_id") + 5000)).union(some.withColumns(
        {"doc_id": F.col("doc_id") + 7000, "text": F.when(F.col("doc_id") % 20 == 3, F.lit(None).cast("string")).otherwise(F.lit("12 34 !!"))}))
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(str(root / str(i)))
        out.append(spark.read.parquet(str(root / str(i))))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality rules", "MinHash near-dedup", "substring dedup", "best-fit packing"]
    assert all(df.columns == steps[0].columns for df in steps[1:-1])


def test_language_stage(steps):
    given, kept = by_id(steps[0]), by_id(steps[1])
    assert set(given) - set(kept) == {i for i, r in given.items() if i >= 7000}
    assert all(kept[i] == given[i] for i in kept)


def test_quality_stage(steps):
    given, kept = by_id(steps[1]), by_id(steps[2])
    said = {r.doc_id: r.kept for r in quality.quality_report(steps[1]).collect()}
    assert set(kept) == {i for i, k in said.items() if k} and all(kept[i] == given[i] for i in kept)
    for i, r in given.items():
        n, _, _, _, repeated = test_quality.slow(r.text)
        assert not (i in kept and (n < 50 or 100 * repeated > 50 * n))


def test_near_dedup_stage(steps):
    given, kept = by_id(steps[2]), by_id(steps[3])
    want = {i for _, i, _, root, keep in test_minhash.brute_force([(i, r.text) for i, r in given.items()]) if keep}
    assert set(kept) == want and all(kept[i] == given[i] for i in kept) and len(kept) < len(given)


def test_substring_stage(steps):
    given, kept = by_id(steps[3]), by_id(steps[4])
    for i, _, removed, text in test_repeats.brute_force([(i, r.text) for i, r in given.items()]):
        want = text if removed else given[i].text
        assert kept[i].text == want and kept[i].n_chars == (len(want) if removed else given[i].n_chars)
        assert kept[i].n_words == "mine"
    assert set(given) == set(kept)


def test_packing_stage(steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, pieces = steps[5].collect(), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    given = by_id(steps[4])
    assert set(pieces) == set(given)
    assert all(sorted(pieces[i]) == test_packing.pieces_of(library, given[i].text) for i in given)
    least = -(-sum(r.length for r in rows) // 2048)
    assert test_packing.check_sequences(rows) <= least * 1.03 + 1


def test_run_is_the_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0 and language.MOST_BITS > 0


def test_columns_of_any_name(spark):
    """Extra columns keep their values whatever their names and case."""
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(1, passage, "en", 7, 8, "x", 9), (2, "own words " + passage + " and more", "en", 17, 18, "y", 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, N_Words int, __bucket long, Kept_Text string, n_chars long")
    out = corpus_pipeline.substring_dedup(spark, docs, None)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [rows[0], (2, "own words and more", "en", 17, 18, "y", 18)]
    clash = docs.withColumn("__letter", F.lit("q")).withColumn("__LETTER_", F.lit("r"))
    assert language.predict(clash, language.train(clash)).columns[:9] == clash.columns


def test_a_text_goes_to_python_once(spark):
    """The stages that only drop rows send each text once, inside its row, and get rows back, nothing beside them."""
    rows = [(i, f"word{i} and some more words " * 20, "en", "q") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, Text string, lang string, row string")
    for stage in (corpus_pipeline.language_id, corpus_pipeline.quality_rules):
        kept = stage(spark, docs, None)
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"MapInArrow [^\n]*, \[row#\d+\]", plan) and not re.search(r" AS row#\d+, Text#\d+", plan, re.I)
        assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= set(rows)
