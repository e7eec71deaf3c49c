"""recolake: a PySpark movie-recommendation lakehouse.

functions/  schemas and native column expressions (vectors, tokenizer)
operators/  DataFrame -> DataFrame operators (ods, dim, dws, similarity,
            positions, online, content, als, kv, blocks)
sources/    lakehouse tables, JDBC, event streams, test-table views
streaming/  AvailableNow ingest and the stateful online recommender
plans/      daily jobs and the registry of checked queries
cli.py      command line for the jobs
"""
