"""corpusmill: build deduplicated source-code datasets as Spark jobs.

Subpackages
-----------
sources     readers and writers for code files, token documents, splits,
            tasks, sequences, clusters and predictions
functions   column expressions (string, array and similarity scalars)
operators   DataFrame operators: tokenisation, bags, near-duplicate join,
            components, dedup, splits, tasks, sequences, evaluation, logs
plans       composed jobs and the stand-ins that map the driver tables to
            the reference's inputs
streaming   incremental ingestion of token documents with Structured Streaming
"""

from corpusmill.session import checkpoint_dir, get_spark, reliable_checkpoint

__all__ = ["checkpoint_dir", "get_spark", "reliable_checkpoint"]
