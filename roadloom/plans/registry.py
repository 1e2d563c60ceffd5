"""All core queries by name, with the SQL of those that SQL can express."""

from __future__ import annotations

from roadloom.plans import data_queries, extra_queries, map_queries, more_queries, plan_queries

_GROUPS = (data_queries, map_queries, more_queries, plan_queries, extra_queries)
FLAGSHIP = "check_vm_01_24"
QUERIES = {k: v for g in _GROUPS for k, v in g.QUERIES.items()}
SQL = {k: v for g in _GROUPS for k, v in g.SQL.items()}
# The histogram of all map checks is told by the checks' own SQL.
SQL["a18_result_counts"] = "select req_id, " + ", ".join(f"count(*) filter (status = '{s}') as {s.lower()}" for s in ("PASS", "FAIL", "SKIP")) + " from (" + " union all ".join(f"select * from ({SQL[q]})" for q in map_queries.QUERIES if q.startswith("check_vm")) + ") group by req_id"
