"""goldleaf — a gated bronze → silver → gold retail warehouse built as Spark DataFrame jobs.

Layers
------
* ``goldleaf.sources``   — readers and writers: JDBC increments, lake tables, versioned snapshots.
* ``goldleaf.functions`` — column expressions shared by the operators (date parsing, default keys).
* ``goldleaf.operators`` — high-water marks, keyed upsert, denormalisation, star schema, marts,
  data-quality checks.
* ``goldleaf.plans``     — the three stages (bronze ingest, silver build, gold build) wired together.
* ``goldleaf.streaming`` — the bronze ingest as a Structured Streaming query over a landing folder.
"""

from goldleaf.spec import SOURCE_TABLES, TABLE_SPECS, TableSpec  # noqa: F401

__all__ = ["SOURCE_TABLES", "TABLE_SPECS", "TableSpec"]
