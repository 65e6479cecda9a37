"""quarry: Spark-native analytics jobs.

Every operator is a ``DataFrame -> DataFrame`` transformation built from
built-in Spark SQL expressions, so rows stay inside the JVM (whole-stage
codegen, no Python workers) and Catalyst/AQE choose the physical plan.

Layout:
    functions/  column expressions (tokenizer, log parser, exact money sums)
    sources/    table loading, delimited/text scans, SQL on files, stream readers
    sinks/      TSV / JSON / Parquet / row-text writers and their readers
    operators/  joins, aggregations, top-k, filters
    plans/      the user-facing jobs wired onto concrete tables, the query
                registry with its DuckDB oracle SQL, and file-in/file-out
                batch applications (``python -m quarry.plans.apps``)
    streaming/  Structured Streaming versions of the jobs, the batch-folder
                table sink, compaction and long-running applications
"""

__version__ = "0.1.0"
