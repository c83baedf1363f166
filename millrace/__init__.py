"""millrace: curation of instruction corpora on Spark.

Sub-packages: ``functions`` (Column expressions), ``operators`` (DataFrame ->
DataFrame), ``sources`` (readers and writers), ``plans`` (whole pipelines and
the query catalogue), ``streaming`` (incremental ingest).  The optional
sub-package ``llm`` builds on these; nothing here imports it.
"""
