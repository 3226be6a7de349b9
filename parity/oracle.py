"""The jobs of ``queries`` as SQL for DuckDB, over the same tables.

Dialect notes: sums of integers are HUGEINT and cast back; ``//`` divides
integers; ``||`` keeps NULL; ``arg_max_null`` returns a NULL value.
"""

from __future__ import annotations

from . import standins as S


def _in_pairs(columns: str, pairs: list[tuple]) -> str:
    def literal(value) -> str:
        return f"'{value}'" if isinstance(value, str) else str(value)

    rows = ", ".join("(" + ", ".join(literal(v) for v in pair) + ")" for pair in pairs)
    return f"({columns}) IN ({rows})"


def _values(position: int) -> str:
    return ", ".join(str(v) for v in sorted({pair[position] for pair in S.LINE_PAIRS}))


def _texts(pairs: list[tuple], position: int) -> str:
    return ", ".join(f"'{v}'" for v in sorted({pair[position] for pair in pairs}))


STAGES = """
    SELECT event_id, user_id, ts,
           CASE WHEN event_type IN ('click', 'view') THEN 'Audit' ELSE event_type END AS stage
    FROM events
"""

FLOW = "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)"
ITERATION = "row_number() OVER (PARTITION BY user_id, stage ORDER BY ts, event_id)"
LATEST = """CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
                 THEN 'Yes' ELSE 'Other' END"""

QUANTITIES = """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, l_linestatus,
           CAST(l_quantity AS BIGINT) AS quantity
    FROM lineitem
"""

ORDER_CELLS = f"""
    SELECT l_orderkey, lower(l_returnflag) AS label,
           CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS lines
    FROM ({QUANTITIES}) WHERE l_returnflag <> 'R' GROUP BY ALL
"""

ORDER_SHARES = f"""
    SELECT *, CAST(sum(quantity) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total,
           round(quantity / CAST(sum(quantity) OVER (PARTITION BY l_orderkey) AS DOUBLE), 2) AS share
    FROM ({ORDER_CELLS})
"""


def _minutes(label: str) -> str:
    one = f"FILTER (WHERE label = '{label}')"
    return f"round(max(total) * max(share) {one} / max(lines) {one} / 60, 1) AS {label}_tpo"


def _tenant(org: str, orgs: int, project: str) -> str:
    return f"'org-' || ({org} % {orgs}) AS organization_id, 'prj-' || {project} AS project_id"


def _issue_daily() -> str:
    # lines with a fourth number have no codes
    carried = {"flag_a": "l_returnflag = 'A'", "flag_n": "l_returnflag = 'N'",
               "flag_r": "l_returnflag = 'R'"}
    carried |= {f"line_{n}": f"l_linenumber = {n}" for n in range(1, 8)}
    carried |= {"status_f": "l_linestatus = 'F'", "status_o": "l_linestatus = 'O'"}
    carried |= {"absent": "false"}
    conditions = {
        "open_issues": "l_returnflag = 'A' AND l_linenumber <> 5",
        "resolved_issues": "l_returnflag = 'R' AND l_linenumber <> 5",
        "deleted_issues": "l_linenumber = 7",
    } | {name: f"l_linenumber <> 4 AND {c}" for name, c in carried.items()}
    counts = ",\n".join(
        f"count(DISTINCT l_suppkey) FILTER (WHERE {c}) AS {name}"
        for name, c in conditions.items()
    )
    return f"""
        SELECT CASE WHEN l_linenumber = 6 AND l_orderkey % 7 = 0 THEN NULL
                    ELSE CAST(l_shipdate + to_seconds(l_orderkey * 5 + 19500) AS DATE) END AS updatedat_date,
               {_tenant('l_orderkey', 3, 'l_linestatus')},
               'lt-1' AS labeltaskid, count(DISTINCT l_suppkey) AS total_issues, {counts}
        FROM lineitem
        WHERE CAST(year(l_shipdate) AS VARCHAR) >= '{S.FIRST_YEAR_LINES}'
          AND {_in_pairs("'org-' || (l_orderkey % 3), 'prj-' || l_linestatus", S.ISSUE_PAIRS)}
        GROUP BY 1, 2, 3, 4
    """


STAGE_HISTORY = f"""
    WITH versions AS (
        SELECT *, json_extract_string(props, '$.k') AS doc, CAST(user_id AS VARCHAR) AS task,
               CASE WHEN event_id % 13 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS sec,
               CASE WHEN event_id % 17 <> 0 THEN event_type END AS named,
               'name ' || event_type || ' ' || user_id AS title,
               {_tenant('user_id', 3, 'left(CAST(user_id AS VARCHAR), 1)')}
        FROM events
        WHERE CAST(year(ts) - CASE WHEN hour(ts) < 6 THEN 1 ELSE 0 END AS VARCHAR) >= '{S.FIRST_YEAR_EVENTS}'
    ), newest AS (
        SELECT *
        FROM versions
        WHERE organization_id IN ({_texts(S.EVENT_PAIRS, 0)}) AND project_id IN ({_texts(S.EVENT_PAIRS, 1)})
        QUALIFY row_number() OVER (
            PARTITION BY task, doc
            ORDER BY sec DESC NULLS LAST, title DESC, event_type DESC, named DESC NULLS LAST,
                     value > 50 DESC, value > 20 DESC, value < 1 DESC, event_id DESC) = 1
    ), names AS (
        SELECT project_id, arg_max(title, {{'sec': sec, 'title': title}}) FILTER (WHERE sec IS NOT NULL) AS projectname
        FROM newest GROUP BY project_id
    ), stages AS (
        SELECT organization_id, project_id, projectname,
               'b-' || event_type AS batch_name, task AS labeltaskid, doc AS document_id,
               's-' || event_type AS stage,
               CASE WHEN named IN ('click', 'view') THEN 'Audit' ELSE named END AS stagename,
               'manual' AS stage_type, value > 50 AS rework, value > 20 AS iscompleted,
               value < 1 AS isskipped, 'w' || task AS updatedby,
               CAST(make_timestamp((sec + 19500) * 1000000) AS TIMESTAMP) AS updatedat_date,
               CAST(round(CAST(event_id * 37 AS DECIMAL(21, 3)) * 0.001, 1) AS DECIMAL(21, 1)) AS duration_sec,
               CAST(round(CAST(event_id * 3 AS DECIMAL(21, 3)) * 0.001, 1) AS DECIMAL(21, 1)) AS idleduration_sec,
               CAST(round(CAST(event_id * 50 AS DECIMAL(21, 3)) * 0.001, 1) AS DECIMAL(21, 1)) AS blurduration_sec,
               CAST(length(event_type) AS INTEGER) AS number_of_pages
        FROM newest JOIN names USING (project_id)
    )
    SELECT *,
           row_number() OVER (PARTITION BY project_id, labeltaskid
                              ORDER BY updatedat_date NULLS LAST, document_id) AS stage_flow,
           row_number() OVER (PARTITION BY project_id, labeltaskid, stagename
                              ORDER BY updatedat_date NULLS LAST, document_id) AS node_iteration,
           CASE WHEN row_number() OVER (PARTITION BY project_id, labeltaskid
                                        ORDER BY updatedat_date DESC NULLS LAST, document_id DESC) = 1
                THEN 'Yes' ELSE 'Other' END AS is_latest
    FROM stages
"""

LATEST_ATTRIBUTE = """
    SELECT event_id, user_id, newest.event_type, ts
    FROM events JOIN (
        SELECT user_id, arg_max_null(event_type, ts) AS event_type FROM events GROUP BY user_id
    ) AS newest USING (user_id)
"""

SCOPED = "SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity FROM lineitem WHERE"

TIME_PER_OBJECT = f"""
    WITH cells AS (
        SELECT CAST(l_orderkey AS VARCHAR) AS doc, l_linestatus AS kind,
               CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' THEN ''
                    ELSE 'type_' || lower(l_returnflag) END AS class,
               CAST(sum(CAST(l_quantity AS BIGINT) * 1000 + l_linenumber * 10) AS BIGINT) AS ms,
               count(DISTINCT (l_suppkey, l_linenumber)) AS objects
        FROM lineitem
        WHERE {_in_pairs("'org-' || (l_orderkey % 3), 'prj-' || (l_orderkey % 2)", S.TIME_PAIRS)}
        GROUP BY ALL
    ), durations AS (
        SELECT doc, CAST(round(CAST(CAST(sum(ms) AS BIGINT) AS DECIMAL(21, 3)) * 0.001, 1)
                         AS DECIMAL(21, 1)) AS duration_sec
        FROM cells GROUP BY doc
    ), class_rows AS (
        SELECT doc, kind, class, objects,
               round(ms / CAST(sum(ms) OVER (PARTITION BY doc) AS DOUBLE), 2) AS share
        FROM cells WHERE class <> ''
    ), class_pick AS (
        SELECT doc, class, arg_min(share, kind) AS share, arg_min(objects, kind) AS objects
        FROM class_rows GROUP BY doc, class
    ), class_maps AS (
        SELECT doc,
               '{{' || string_agg('"' || class || '":' || CAST(share AS VARCHAR), ',' ORDER BY class) || '}}' AS class_wise_tpo,
               '{{' || string_agg('"' || class || '":' || CAST(objects AS VARCHAR), ',' ORDER BY class) || '}}' AS class_object_count,
               max(share) FILTER (WHERE class = 'type_a') AS share_a,
               max(objects) FILTER (WHERE class = 'type_a') AS objects_a,
               max(share) FILTER (WHERE class = 'type_n') AS share_n,
               max(objects) FILTER (WHERE class = 'type_n') AS objects_n
        FROM class_pick GROUP BY doc
    ), kinds AS (
        SELECT doc, kind, CAST(sum(objects) AS BIGINT) AS objects,
               round(CAST(sum(ms) AS DOUBLE) / CAST(sum(sum(ms)) OVER (PARTITION BY doc) AS DOUBLE), 2) AS share
        FROM cells WHERE class <> '' GROUP BY doc, kind
    ), kind_maps AS (
        SELECT doc,
               '{{' || string_agg('"' || kind || '":' || CAST(share AS VARCHAR), ',' ORDER BY kind) || '}}' AS object_type_tpo,
               '{{' || string_agg('"' || kind || '":' || CAST(objects AS VARCHAR), ',' ORDER BY kind) || '}}' AS object_type_object_count,
               max(share) FILTER (WHERE kind = 'O') AS share_o,
               max(objects) FILTER (WHERE kind = 'O') AS objects_o,
               max(share) FILTER (WHERE kind = 'F') AS share_f,
               max(objects) FILTER (WHERE kind = 'F') AS objects_f
        FROM kinds GROUP BY doc
    )
    SELECT {_tenant('CAST(doc AS BIGINT)', 3, '(CAST(doc AS BIGINT) % 2)')}, doc AS labeltaskid,
           doc AS document_id, object_type_tpo, object_type_object_count, class_wise_tpo,
           class_object_count, duration_sec,
           round(CAST(duration_sec AS DOUBLE) * share_a / objects_a / 60, 1) AS type_a_tpo,
           round(CAST(duration_sec AS DOUBLE) * share_n / objects_n / 60, 1) AS type_n_tpo,
           round(CAST(duration_sec AS DOUBLE) * share_o / objects_o / 60, 1) AS "O_tpo",
           round(CAST(duration_sec AS DOUBLE) * share_f / objects_f / 60, 1) AS "F_tpo"
    FROM class_maps JOIN kind_maps USING (doc) JOIN durations USING (doc)
"""

DISTINCT_WHERE = """
        SELECT l_suppkey, count(DISTINCT l_orderkey) AS total,
               count(DISTINCT l_orderkey) FILTER (WHERE l_linestatus = 'O') AS status_o,
               count(DISTINCT l_orderkey) FILTER (WHERE l_returnflag = 'R') AS flag_r,
               count(DISTINCT l_orderkey) FILTER (
                   WHERE l_returnflag = 'A' AND l_shipdate >= DATE '2000-01-01') AS late_a
        FROM lineitem GROUP BY l_suppkey
    """

ORACLE: dict[str, str] = {
    "scope_pairs": f"{SCOPED} {_in_pairs('l_suppkey, l_linenumber', S.LINE_PAIRS)}",
    "scope_independent": f"""
        {SCOPED} l_suppkey IN ({_values(0)}) AND l_linenumber IN ({_values(1)})
    """,
    "scope_table": f"""
        {SCOPED} (l_suppkey, l_linenumber) IN (
            SELECT (s_suppkey, s_nationkey % 7 + 1) FROM supplier WHERE s_acctbal > 0)
    """,
    "scope_table_independent": f"""
        {SCOPED} l_suppkey IN (
            SELECT s_suppkey FROM supplier WHERE s_acctbal > 0 AND s_nationkey % 7 + 1 > 3)
        AND l_linenumber IN (
            SELECT s_nationkey % 7 + 1 FROM supplier WHERE s_acctbal > 0 AND s_nationkey % 7 + 1 > 3)
    """,
    "min_partition": """
        SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) AS year
        FROM orders WHERE CAST(year(o_orderdate) AS VARCHAR) >= '1998'
    """,
    "classification_extract": f"""
        SELECT {_tenant('user_id', 2, '(event_id % 3)')},
               CAST(user_id AS VARCHAR) AS labeltaskid, CAST(event_id AS VARCHAR) AS document_id,
               'o' || event_id AS objectid, event_type AS title, props AS answer, 'box' AS tool,
               'w' || user_id AS updatedby,
               CASE WHEN event_id % 11 <> 0 THEN
                   make_timestamp((CAST(floor(epoch(ts)) AS BIGINT) + 19500) * 1000000) END AS updatedat_date_ist
        FROM events
        WHERE {_in_pairs("'org-' || (user_id % 2), 'prj-' || (event_id % 3)", S.ANSWER_PAIRS)}
    """,
    "json_key_list": """
        SELECT event_id,
               array_to_string(list_sort(list_distinct(
                   [json_extract_string(props, '$.k'), json_extract_string(props, '$.k'), event_type]
               )), '|') AS keys
        FROM events
    """,
    "json_scalar": """
        SELECT event_id, json_extract_string('[' || props || ']', '$[0].k') AS k,
               'no scalar' AS whole,
               coalesce(json_extract_string('[' || props || ']', '$[1].k'), 'missing') AS beyond
        FROM events
    """,
    "distinct_where": DISTINCT_WHERE,
    "distinct_counts": DISTINCT_WHERE,
    "distinct_by_tag": """
        SELECT l_suppkey, count(DISTINCT l_orderkey) AS total,
               count(DISTINCT CASE WHEN list_contains([l_returnflag, l_linestatus], 'A') THEN l_orderkey END) AS flag_a,
               count(DISTINCT CASE WHEN list_contains([l_returnflag, l_linestatus], 'N') THEN l_orderkey END) AS flag_n,
               count(DISTINCT CASE WHEN list_contains([l_returnflag, l_linestatus], 'R') THEN l_orderkey END) AS flag_r,
               count(DISTINCT CASE WHEN list_contains([l_returnflag, l_linestatus], 'O') THEN l_orderkey END) AS status_o,
               count(DISTINCT CASE WHEN list_contains([l_returnflag, l_linestatus], 'X') THEN l_orderkey END) AS absent
        FROM lineitem GROUP BY l_suppkey
    """,
    "issue_daily": _issue_daily(),
    "latest_version": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """,
    "latest_attribute": LATEST_ATTRIBUTE,
    "latest_attribute_split": """
        SELECT event_id, newest.user_id, event_type, ts
        FROM events JOIN (
            SELECT event_type, arg_max(user_id, {'ts': ts, 'user_id': user_id}) AS user_id
            FROM events GROUP BY event_type
        ) AS newest USING (event_type)
    """,
    "latest_attribute_table": """
        SELECT user_id, arg_max_null(event_type, ts) AS event_type FROM events GROUP BY user_id
    """,
    "remap_values": f"SELECT stage AS label, count(*) AS n FROM ({STAGES}) GROUP BY stage",
    "ms_to_seconds": """
        SELECT o_orderkey,
               CAST(round(CAST(price AS DECIMAL(21, 3)) * 0.001, 1) AS DECIMAL(21, 1)) AS seconds,
               price / 1000.0::DOUBLE AS exact
        FROM (SELECT o_orderkey,
                     CAST(round(CAST(o_totalprice AS DECIMAL(18, 2)), 0) AS BIGINT) AS price
              FROM orders)
    """,
    "stage_sequence": f"SELECT *, {FLOW} AS stage_flow FROM ({STAGES})",
    "stage_iteration": f"SELECT *, {ITERATION} AS node_iteration FROM ({STAGES})",
    "latest_flag": f"SELECT *, {LATEST} AS is_latest FROM ({STAGES})",
    "stage_numbers_split": f"""
        SELECT *, {FLOW} AS stage_flow, {ITERATION} AS node_iteration, {LATEST} AS is_latest
        FROM ({STAGES})
    """,
    "stage_history": STAGE_HISTORY,
    "stage_history_split": STAGE_HISTORY,
    "epoch_ms": """
        SELECT event_id, make_timestamp(((ms + 19500) // 1000) * 1000000) AS as_reported,
               make_timestamp(((ms + 19500000) // 1000) * 1000000) AS in_report_zone,
               CAST(make_timestamp(((ms + 19500000) // 1000) * 1000000) AS DATE) AS local_day
        FROM (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
    """,
    "task_rollup": f"""
        SELECT {_tenant('l_suppkey', 3, '(l_orderkey % 2)')}, l_orderkey || '-x' AS labeltaskid,
               l_returnflag AS document_id, 'w' || l_suppkey AS updatedby,
               min(make_timestamp(((day_ms + l_linenumber * 777 + 19500) // 1000) * 1000000))
                   FILTER (WHERE l_linenumber <> 6) AS start_time,
               max(make_timestamp(((day_ms + l_linenumber * 77777 + 19500) // 1000) * 1000000)) AS end_time,
               CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_linenumber <> 5) AS BIGINT) AS duration_sec,
               max(CAST(CAST(l_linenumber AS VARCHAR) AS INTEGER)) AS total_frames
        FROM (SELECT *, epoch_us(l_shipdate) // 1000 AS day_ms FROM lineitem)
        WHERE {_in_pairs("'org-' || (l_suppkey % 3), 'prj-' || (l_orderkey % 2)", S.TIME_PAIRS)}
        GROUP BY ALL
    """,
    "normalize_label": """
        SELECT lower(replace(replace('BC- ' || p_name || ' BC-' || p_type, 'BC-', ''), ' ', '_')) AS label,
               count(*) AS n
        FROM part GROUP BY label
    """,
    "coalesce_variants": """
        SELECT l_orderkey, l_linenumber, l_suppkey,
               CAST(CASE WHEN l_linenumber <= 2 THEN l_quantity + 1
                         WHEN l_linenumber <= 6 THEN l_quantity END AS INTEGER) AS active
        FROM lineitem
    """,
    "distinct_composite": """
        SELECT l_orderkey,
               count(DISTINCT nullif(l_returnflag, 'R') || '_' || l_linenumber) AS objects
        FROM lineitem GROUP BY l_orderkey
    """,
    "regroup": f"""
        SELECT l_orderkey, CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS lines,
               count(DISTINCT (l_suppkey, l_returnflag, l_linestatus)) AS parts
        FROM ({QUANTITIES}) GROUP BY l_orderkey
    """,
    "share_of_total": f"""
        SELECT *, round(share, 2) AS share_2
        FROM (SELECT *, quantity / CAST(sum(quantity) OVER (PARTITION BY l_orderkey) AS DOUBLE) AS share
              FROM ({QUANTITIES}))
    """,
    "share_of_total_split": f"""
        SELECT *, round(share, 4) AS share_4
        FROM (SELECT *, quantity / CAST(sum(quantity) OVER (PARTITION BY l_suppkey) AS DOUBLE) AS share
              FROM ({QUANTITIES}))
    """,
    "share_of_type": f"""
        SELECT l_orderkey, l_linestatus, CAST(sum(quantity) AS BIGINT) AS quantity,
               round(CAST(sum(quantity) AS DOUBLE)
                     / CAST(sum(sum(quantity)) OVER (PARTITION BY l_orderkey) AS DOUBLE), 2) AS share
        FROM ({QUANTITIES}) GROUP BY l_orderkey, l_linestatus
    """,
    "map_json": f"""
        SELECT l_orderkey,
               '{{' || string_agg('"' || label || '":' || CAST(share AS VARCHAR), ',' ORDER BY label) || '}}' AS shares,
               '{{' || string_agg('"' || label || '":' || CAST(lines AS VARCHAR), ',' ORDER BY label) || '}}' AS counts
        FROM ({ORDER_SHARES}) GROUP BY l_orderkey
    """,
    "per_object_minutes": f"""
        SELECT l_orderkey, {_minutes('a')}, {_minutes('n')}, count(*) FILTER (WHERE label = 'x') = 0 AS x_tpo
        FROM ({ORDER_SHARES}) GROUP BY l_orderkey
    """,
    "time_per_object": TIME_PER_OBJECT,
}
