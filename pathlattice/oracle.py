"""DuckDB SQL twins of the registered queries (the correctness gate runs both and compares).

The iterative search is written the direct way: every round re-derives all extensions of the whole
previous state (``UNION`` removes copies) and keeps the best ``k`` per node, unrolled once per round.
That is the plain definition; the Spark plan evaluates it semi-naively, so this also checks the rewrite.
"""

from __future__ import annotations

from collections.abc import Sequence

# FIXTURES §2 graphs over the test tables.
TRIPS_PART = """trips_part AS (
  SELECT * FROM (
    SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS src,
           lead(l_partkey) OVER (PARTITION BY l_orderkey
                                 ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS dst,
           CAST(l_quantity AS BIGINT) AS weight, l_suppkey AS sk, l_quantity AS qty
    FROM lineitem) t
  WHERE dst IS NOT NULL)"""

EDGES_PART = """edges_part AS (
  SELECT src, dst, min(weight) AS weight FROM trips_part GROUP BY src, dst)"""

TRIPS_EVENT = """trips_event AS (
  SELECT * FROM (
    SELECT event_id AS seq, user_id AS src,
           lead(user_id) OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS dst,
           CAST(floor(value) AS BIGINT) + 1 AS weight, ts, event_type AS kind
    FROM events) t
  WHERE dst IS NOT NULL)"""

EDGES_EVENT = """edges_event AS (
  SELECT src, dst, arg_max(weight, seq) AS weight FROM trips_event GROUP BY src, dst)"""

COORDS = """coords AS (
  SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS lat, p_retailprice AS lon FROM part)"""


def part_graph() -> list[str]:
    return [TRIPS_PART, EDGES_PART]


def event_graph() -> list[str]:
    return [TRIPS_EVENT, EDGES_EVENT]


def with_(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def seeds_cte(queries: Sequence[tuple[int, Sequence[int], Sequence[int]]], edges: str) -> list[str]:
    """Requested ids per query and side, then only ids that are nodes of the graph."""
    rows = []
    for q, starts, ends in queries:
        rows += [f"({int(q)}, 'start', {int(n)})" for n in starts]
        rows += [f"({int(q)}, 'end', {int(n)})" for n in ends]
    wanted = ("q_seeds AS (SELECT CAST(q AS BIGINT) AS query_id, side, CAST(n AS BIGINT) AS node "
              f"FROM (VALUES {', '.join(rows)}) v(q, side, n))")
    nodes = f"graph_nodes AS (SELECT src AS id FROM {edges} UNION SELECT dst FROM {edges})"
    seeds = ("seeds AS (SELECT DISTINCT query_id, side, node FROM q_seeds "
             "WHERE node IN (SELECT id FROM graph_nodes))")
    return [wanted, nodes, seeds]


def seeds_from(q_seeds_sql: str, edges: str) -> list[str]:
    """Like ``seeds_cte`` for requested ids given as SQL ``(query_id, side, node)``."""
    nodes = f"graph_nodes AS (SELECT src AS id FROM {edges} UNION SELECT dst FROM {edges})"
    seeds = ("seeds AS (SELECT DISTINCT query_id, side, node FROM q_seeds "
             "WHERE node IN (SELECT id FROM graph_nodes))")
    return [f"q_seeds AS ({q_seeds_sql})", nodes, seeds]


def search_ctes(edges: str, steps: int, k: int, prefix: str = "s") -> tuple[list[str], str]:
    """``{prefix}0 … {prefix}{steps}``: the state after each round; returns (ctes, last name)."""
    ctes = [f"{prefix}0 AS MATERIALIZED (SELECT query_id, side, node, CAST(0 AS BIGINT) AS cost, "
            "CAST('' AS VARCHAR) AS path FROM seeds)"]
    for i in range(1, steps + 1):
        p = f"{prefix}{i - 1}"
        ctes.append(f"""{prefix}{i} AS MATERIALIZED (
  SELECT query_id, side, node, cost, path FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id, side, node ORDER BY cost, path) AS rn FROM (
      SELECT query_id, side, node, cost, path FROM {p}
      UNION
      SELECT s.query_id, s.side, e.dst, s.cost + e.weight,
             s.path || CAST(e.src AS VARCHAR) || ' ' || CAST(e.weight AS VARCHAR) || ' '
      FROM {p} s JOIN {edges} e ON s.node = e.src WHERE s.side = 'start'
      UNION
      SELECT s.query_id, s.side, e.src, s.cost + e.weight,
             ' ' || CAST(e.weight AS VARCHAR) || ' ' || CAST(e.dst AS VARCHAR) || s.path
      FROM {p} s JOIN {edges} e ON s.node = e.dst WHERE s.side = 'end') u) r
  WHERE rn <= {int(k)})""")
    return ctes, f"{prefix}{steps}"


def meet_cte(state: str) -> str:
    return f"""half_s AS MATERIALIZED (SELECT query_id, node, cost, path FROM {state} WHERE side = 'start'),
half_e AS MATERIALIZED (SELECT query_id, node, cost, path FROM {state} WHERE side = 'end'),
meet AS MATERIALIZED (
  SELECT a.query_id, a.node, a.cost + b.cost AS total,
         CAST(a.cost + b.cost AS VARCHAR) || ' ' || a.path || CAST(a.node AS VARCHAR) || b.path AS line
  FROM half_s a JOIN half_e b ON a.query_id = b.query_id AND a.node = b.node)"""


RESULT_CTE = "result AS (SELECT DISTINCT query_id, total, line FROM meet)"
HOPS = "CAST((len(string_split(line, ' ')) - 2) // 2 AS BIGINT)"


def ksp_ctes(graph: list[str], edges: str, queries, steps: int = 5, k: int = 3) -> list[str]:
    """All CTEs up to ``result(query_id, total, line)``."""
    rounds, last = search_ctes(edges, steps, k)
    return graph + seeds_cte(queries, edges) + rounds + [meet_cte(last), RESULT_CTE]


def ksp_sql(graph: list[str], edges: str, queries, steps: int = 5, k: int = 3) -> str:
    return with_(ksp_ctes(graph, edges, queries, steps, k),
                 f"SELECT query_id, total, {HOPS} AS hops, line FROM result")
