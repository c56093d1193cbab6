"""Document-to-knowledge-graph analytics expressed as PySpark DataFrame pipelines."""
