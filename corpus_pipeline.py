"""Filter and encode ``documents``: quality, toxicity, near-duplicates, benchmark passages, tokens.

Every stage works on all that its predecessor kept, written as Parquet and read again. Rows are told apart by their
place in that table, so null and repeated doc_ids are handled like any other. Extra columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from chainmart.llm import bpe, decontaminate, quality, simhash, toxicity
from chainmart.llm.common import numbered_rows, own_columns, read_table, stored


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules keep."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def toxic_documents(spark, docs, sf_dir):
    """Documents that are not predicted to be toxic."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """The first document of each group of near-duplicates."""
    # written once: another scan may be cut otherwise, and would number the rows otherwise
    rows = stored(numbered_rows(docs), "numbered")
    found = simhash.near_duplicates(rows.select("row", "own.text"), "row", "text", shingle=4, distance=4)
    first = stored(found.where("row = component_id").select("row"), "first-of-group")
    return own_columns(rows.join(first, "row", "left_semi"), docs)


def benchmark_passages(spark, docs, sf_dir):
    """Documents in which no benchmark window occurs."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_ids(spark, docs, sf_dir):
    """``doc_id, n_tokens, ids, decoded`` of every document left."""
    out = bpe.encode_decode(docs)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", quality_rules),
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_passages),
    ("tokens", token_ids),
]
#: exact binomial bounds, compression lengths and fingerprints are beyond SQL: tested against brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, each over what its predecessor kept."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
