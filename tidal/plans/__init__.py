from tidal.plans.topologies import enrich_topology, rule_gate_topology, table_join_topology

__all__ = ["enrich_topology", "rule_gate_topology", "table_join_topology"]
