"""bibliospark: bibliographic ETL and warehouse analytics as Spark DataFrame operators.

Sub-packages:

* ``sources``   -- readers / writers (index-keyed JSON, JSONL, CSV, tables)
* ``functions`` -- column expressions (tokens, array ends, RFC-1123 dates)
* ``operators`` -- DataFrame -> DataFrame operators (dedupe, ids, joins,
  first-match substring join, aggregates, global ranking, audits, graph)
* ``plans``     -- the four composed pipelines, the warehouse questions and
  the driver queries over the shared test tables
* ``streaming`` -- incremental (file-stream) form of the row-local cleaning steps
"""

from bibliospark.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
