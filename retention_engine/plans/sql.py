"""SQL building blocks for the oracle statements (DuckDB dialect, ANSI where possible).

Each CTE mirrors one adapter of ``sources.adapters``; ``ctes(...)`` emits them in dependency order.
"""
from __future__ import annotations

THRESHOLD_LIST = "[" + ", ".join(f"{i / 100:.2f}::DOUBLE" for i in range(1, 100)) + "]"


def u(expr: str, salt: str) -> str:
    """Portable hash-uniform: first 8 hex digits of md5(text|salt) / 2^32."""
    return f"(('0x' || substr(md5(CAST({expr} AS VARCHAR) || '|{salt}'), 1, 8))::UBIGINT)::DOUBLE / 4294967296.0"


CTE = {
    "snap_orders": """
        SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, CAST(o_orderdate AS DATE) AS d
        FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-30 00:00:00'""",
    "snap_hist": """
        SELECT o_custkey,
               min(d) FILTER (WHERE d < DATE '1999-07-01') AS first_d,
               max(d) FILTER (WHERE d < DATE '1999-07-01') AS last_d,
               avg(o_totalprice) FILTER (WHERE d < DATE '1999-07-01') AS avg_price,
               sum(o_totalprice) FILTER (WHERE d < DATE '1999-07-01') AS sum_price,
               count(*) FILTER (WHERE d >= DATE '1999-07-01' AND d < DATE '2000-06-30') AS n_future
        FROM snap_orders GROUP BY o_custkey""",
    "snap_last": """
        SELECT o_custkey, o_orderpriority AS last_priority FROM (
          SELECT o_custkey, o_orderpriority,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, o_orderkey DESC) AS rn
          FROM snap_orders WHERE d < DATE '1999-07-01') t WHERE rn = 1""",
    "snap_base": """
        SELECT c.c_custkey AS customer_id, c.c_mktsegment AS segment, r.r_name AS region,
               CASE WHEN c.c_acctbal < 0 THEN 'neg' ELSE 'pos' END AS balance_sign,
               l.last_priority,
               CAST(coalesce(date_diff('day', h.first_d, DATE '1999-07-01'), 0) AS DOUBLE) AS tenure_days,
               round(h.avg_price, 6) AS monthly_charges,
               round(h.sum_price, 6) AS total_charges,
               CAST(date_diff('day', h.last_d, DATE '1999-07-01') AS DOUBLE) AS recency_days,
               greatest(c.c_acctbal, 0.0) AS value,
               CASE WHEN coalesce(h.n_future, 0) = 0 THEN 1 ELSE 0 END AS y,
               CASE WHEN h.last_d IS NULL THEN 1.0
                    ELSE round(date_diff('day', h.last_d, DATE '1999-07-01')
                               / (date_diff('day', h.last_d, DATE '1999-07-01') + 240.0), 6) END AS score
        FROM customer c
        LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN snap_hist h ON c.c_custkey = h.o_custkey
        LEFT JOIN snap_last l ON c.c_custkey = l.o_custkey""",
    "snapshot": f"""
        SELECT *, CASE WHEN {u('customer_id', 's')} < 0.05 + 0.6 * score THEN 1 ELSE 0 END AS y_signal
        FROM snap_base""",
    "ilog": """
        SELECT event_id AS request_id, ts, user_id, event_type AS route,
               CASE WHEN event_type = 'error' THEN 500
                    WHEN event_type = 'signup' AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 THEN 422
                    ELSE 200 END AS status_code,
               value AS latency_ms,
               CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'A' ELSE 'B' END AS artifact,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "inference_log": """
        SELECT request_id, ts, user_id, route, status_code, latency_ms, artifact,
               CASE WHEN status_code = 200 THEN round(latency_ms / (latency_ms + 50.0), 6) END AS score,
               CASE WHEN status_code = 200 THEN 1 + k % 5 END AS n_rows
        FROM ilog""",
    "drift_pair": """
        SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
               l_linestatus,
               CASE WHEN l_shipdate < TIMESTAMP '1998-07-01 00:00:00' THEN 'baseline' ELSE 'window' END AS period
        FROM lineitem""",
    "quality_labels": """
        SELECT d.doc_id, d.lang, d.source, d.n_chars, 1 - l.quality AS y,
               round(1500.0 / (1500.0 + d.n_chars), 6) AS score
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}

DEPS = {
    "snap_hist": ["snap_orders"], "snap_last": ["snap_orders"],
    "snap_base": ["snap_hist", "snap_last"], "snapshot": ["snap_base"],
    "inference_log": ["ilog"],
}


def ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the named CTEs (dependencies first) and then ``extra`` (name, body)."""
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTE[n]})" for n in order]
    parts += [f"{n} AS ({body})" for n, body in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
