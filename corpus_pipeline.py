"""The corpus pipeline: quality classifier, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes (session, documents, table folder) and returns a DataFrame. All but the last return the columns of
documents: rejected, near-duplicate and contaminated documents go, repeated lines go, and the last stage returns where
every piece of what stays is packed.
"""

from riskloom.llm.common import stored, table
from riskloom.llm.decontaminate import drop_contaminated
from riskloom.llm.line_dedup import dedup_lines
from riskloom.llm.packing import pack_documents
from riskloom.llm.quality import keep_accepted
from riskloom.llm.simhash import drop_near_duplicates


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier accepts."""
    return keep_accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark, docs, sf_dir):
    """All documents, without the lines that a document of a smaller id holds."""
    return dedup_lines(docs)


def simhash_near_dedup(spark, docs, sf_dir):
    """Of each component of fingerprints (three-word shingles, at most two differing bits) the document with the smallest id."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold no window of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark, docs, sf_dir):
    """Where each piece of each document is packed."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no trained classifier, no XXH64 and no tokenizer; tests/llm/test_pipeline.py checks the stages one by one.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
