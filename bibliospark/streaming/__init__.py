"""Incremental form of the row-local cleaning steps.

The reference runs its pipelines as whole-file batches; nothing in it is a
stream.  What can run incrementally without changing results is the
row-local part of P1 (field drop, title length, first / last version) and
of P2 (``'None'`` -> null, records without doi dropped, DOI metadata by a
stream-static lookup join): each record's output depends on that record
(and the static lookup) alone.  Removing *every* copy of a duplicate group needs the whole
set, so ``pipelines.clean_publications`` stays a batch job over the sink.
"""

from bibliospark.streaming.ingest import clean_stream, enrich_stream, start_clean_stream

__all__ = ["clean_stream", "enrich_stream", "start_clean_stream"]
