"""Operators of a training-data pipeline: tokenizers, deduplication, chat
formatting, decontamination and classifiers, all over DataFrames.

Nothing outside this subpackage imports it. Each operator module has its own
general interface; :mod:`hazeline.llm.queries` holds the thin registered queries
over the given tables. Operators marked native in the README use DataFrame and
SQL functions only; the others run numpy over Arrow batches inside tasks, with
Spark doing the partitioning, grouping and joins.
"""
