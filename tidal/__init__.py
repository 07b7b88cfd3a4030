"""tidal: user/action event enrichment and rule gating on Spark.

Batch tables and Structured Streaming share one data model (``tidal.schemas``):

* ``tidal.operators``  -- DataFrame operators: SQL join, keyed pairing, latest-rule filter,
  projections and views.
* ``tidal.functions``  -- column expressions: strict JSON decode/encode, null-safe membership.
* ``tidal.sources``    -- topic (Kafka or file) readers/writers and adapters over the test tables.
* ``tidal.streaming``  -- stateful streaming forms (``transformWithState``) and query runners.
* ``tidal.plans``      -- end-to-end topologies: source -> decode -> operator -> encode -> sink.
"""

from tidal.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
