"""carlot — classified-listing analytics as Spark DataFrame jobs.

Sub-packages:

* ``functions``  column → column helpers (slugs, prices, years, URLs, fuel codes …)
* ``sources``    readers for catalogues, JSON dumps, captured pages, store tables; sinks
* ``operators``  the relational work: resolution cascade, card extraction, ingest,
                 dedup / upsert / insert-if-absent, expiry lifecycle, quality reports
* ``plans``      bindings of the operators to the benchmark tables + DuckDB oracle SQL
* ``streaming``  the same load as a Structured Streaming ``foreachBatch`` job

Every operator takes DataFrames and returns DataFrames; nothing is collected to the
driver except bounded catalogue facts (sizes, a ≤ 3-row role mapping).
"""

from carlot.session import get_session, shared_scratch_dir  # noqa: F401
