"""The corpus pipeline: documents through five operators of ``ferrylog.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``. All but
the last return the columns of ``docs``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ferrylog.llm import language, minhash, packing, quality, repeats
from ferrylog.session import scratch_path


def language_id(spark, docs, sf_dir):
    """Keep the documents in a learned language."""
    return language.known_language(docs)


def quality_rules(spark, docs, sf_dir):
    """Keep the documents that pass the quality rules."""
    return quality.good_documents(docs)


def near_dedup(spark, docs, sf_dir):
    """Keep one document of each group of near duplicates: the one with the smallest id.

    Rows that share that id stay together.
    """
    groups = minhash.near_duplicates(docs.select("doc_id", "text"))
    copies = groups.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark, docs, sf_dir):
    """Cut passages that a document with a smaller id holds too.

    Documents without such a passage keep their text as it is; in the others the words
    left are joined by one blank. ``n_chars`` follows the text.
    """
    # Other columns travel in one that no name can clash with.
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "text")]
    held = docs.select("doc_id", "text", F.struct(*others).alias("others")) if others else docs.select("doc_id", "text")
    done = repeats.remove_repeats(held)
    changed = {"doc_id": F.col("doc_id"), "text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    for c in others:
        own = F.col("others").getField(c)
        if c.lower() == "n_chars":
            own = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(own.cast("long"))
        changed[c] = own
    return done.select(*[changed.get(c, changed.get(c.lower())).alias(c) for c in docs.columns])


def best_fit_packing(spark, docs, sf_dir):
    """Cut the documents into pieces and pack these into sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language_id), ("quality rules", quality_rules), ("MinHash near-dedup", near_dedup),
          ("substring dedup", substring_dedup), ("best-fit packing", best_fit_packing)]

#: The stages rest on trained statistics and greedy packing, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
