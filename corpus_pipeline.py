"""A corpus through five of the operators: one function per stage, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.
Between stages the rows are written to the shared folder and read again; then the tables that the stage before
made on its way are deleted.
"""

from __future__ import annotations

from functools import wraps

from panelkit.llm import near_text, packing, quality_model, repeats, secrets
from panelkit.llm.common import scope, sweep, table, written


def stage(k):
    """The k-th stage.  When it begins, the result of the one before has been stored, so that one's tables can go."""
    def mark(f):
        @wraps(f)
        def run_stage(spark, docs, sf_dir):
            sweep(spark, *[f"pipeline stage {i}" for i in range(1, k)])
            with scope(f"pipeline stage {k}"):
                return f(spark, docs, sf_dir)
        return run_stage
    return mark


@stage(1)
def keep_quality(spark, docs, sf_dir):
    """Operator 4: documents that the classifier scores below a half go; it learns from the labels of these documents."""
    feats = written(quality_model.features(docs), "quality-features")
    return quality_model.keep_good(docs, quality_model.fit(feats, table(spark, sf_dir, "labels")))


@stage(2)
def drop_near_duplicates(spark, docs, sf_dir):
    """Operator 2: of each class of near-duplicates, the document of least doc_id stays."""
    return near_text.deduplicate(docs)


@stage(3)
def cut_repeats(spark, docs, sf_dir):
    """Operator 6: bytes covered by a 100-byte string that starts earlier are cut out."""
    return repeats.remove_repeats(docs)


@stage(4)
def redact_secrets(spark, docs, sf_dir):
    """Operator 9: each secret, also an encoded one, becomes a mark."""
    return secrets.redact(docs)


@stage(5)
def pack(spark, docs, sf_dir):
    """Operator 8: token sequences; one row per piece."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # hashing, suffix order and tokenizers are beyond SQL; tests hold every stage against brute force


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k + 1}")
    return docs
