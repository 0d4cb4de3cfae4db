"""DuckDB twins of the test-table adapters (see `molarflow.sources.testdata`).

Oracle queries are `with_views([...], body)`: the adapter views become CTEs
over the driver's pre-registered tables, then the body is plain SQL.
"""

from __future__ import annotations

from molarflow.sources.testdata import CREATOR_NAMES, FIRST_NAMES, LEAD_EPOCH


def sql_str(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def fold_sql(x: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({x})), '\\s+', ' ', 'g'))"


def pick_sql(key: str, values, mod: int) -> str:
    whens = " ".join(f"WHEN {i} THEN {sql_str(v)}" for i, v in enumerate(values))
    return f"(CASE ({key}) % {mod} {whens} END)"


def phone_sql(key: str, shift: int) -> str:
    ddd = f"CAST(11 + ({key}) % 89 AS VARCHAR)"
    num8 = f"lpad(CAST((({key}) * 7919 + 1000003) % 100000000 AS VARCHAR), 8, '0')"
    fmt = f"((({key}) + {shift}) % 4)"
    return (f"(CASE WHEN ({key}) % 37 = 0 THEN NULL WHEN ({key}) % 41 = 0 THEN '123' ELSE "
            f"CASE {fmt} WHEN 0 THEN '(' || {ddd} || ') 9' || substr({num8}, 1, 4) || '-' || substr({num8}, 5, 4) "
            f"WHEN 1 THEN '+55 ' || {ddd} || ' 9' || {num8} "
            f"WHEN 2 THEN {ddd} || {num8} "
            f"ELSE '55' || {ddd} || {num8} END END)")


def digits_sql(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def phone_key_sql(x: str) -> str:
    d = digits_sql(x)
    no_cc = f"(CASE WHEN length({d}) IN (12, 13) AND starts_with({d}, '55') THEN substr({d}, 3) ELSE {d} END)"
    no_nine = (f"(CASE WHEN length({no_cc}) = 11 AND substr({no_cc}, 3, 1) = '9' "
               f"THEN substr({no_cc}, 1, 2) || substr({no_cc}, 4) ELSE {no_cc} END)")
    return f"nullif({no_nine}, '')"


LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

_PATIENT_NAME = f"({pick_sql('c_custkey', FIRST_NAMES, 8)} || ' ' || c_name)"
_CREATOR = pick_sql("o_orderkey", CREATOR_NAMES, 7)
_APPT_PHONE = phone_sql("c_custkey", 0)

VIEWS: dict[str, str] = {
    "units": """
        SELECT CAST(n_nationkey AS VARCHAR) AS clinic_id, n_name AS name,
               CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE r_name END AS regional,
               CAST(n_nationkey AS BIGINT) AS account_id
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "appointments": f"""
        SELECT o_orderkey AS id, o_custkey AS patient_id, {_PATIENT_NAME} AS patient_name,
               CAST(c_nationkey AS VARCHAR) AS clinic_id, 'Dr ' || CAST(o_orderkey % 17 AS VARCHAR) AS doctor_name,
               o_orderdate AS start_time,
               o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS scheduled_start_time,
               o_orderdate - to_days(CAST(o_orderkey % 10 AS INTEGER)) AS created_at,
               CAST(CASE WHEN o_orderstatus = 'F' THEN 7 + o_orderkey % 2
                    WHEN o_orderstatus = 'P' THEN (CASE o_orderkey % 3 WHEN 0 THEN 4 WHEN 1 THEN 3 ELSE 1 END)
                    ELSE (CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 11 END) END AS INTEGER) AS status,
               CASE WHEN o_orderkey % 2 = 0 THEN 'eval' ELSE 'sp' || CAST(o_orderkey % 5 AS VARCHAR) END AS speciality_id,
               CASE WHEN o_orderkey % 5 = 0 THEN 'mc_channel' ELSE 'front_desk' END AS channel_id,
               CASE WHEN o_orderkey % 5 = 0 THEN 'Agent' ELSE 'Front desk' END AS channel_name,
               CASE WHEN o_orderkey % 7 = 0 THEN 'mc' ELSE 'op' || CAST(o_orderkey % 13 AS VARCHAR) END AS created_by_id,
               {_CREATOR} AS created_by_name,
               {_APPT_PHONE} AS phone,
               CASE WHEN o_orderkey % 4 = 0 THEN 'return' ELSE 'first' END AS type,
               CASE WHEN o_orderkey % 3 = 0 THEN 'cmp' || CAST(o_orderkey % 4 AS VARCHAR) END AS campaign_token,
               CASE c_custkey % 3 WHEN 0 THEN 'Instagram' WHEN 1 THEN 'Google' ELSE 'Indicação' END AS patient_channel_name,
               CASE c_custkey % 4 WHEN 0 THEN 'Ads' WHEN 1 THEN 'Organic' WHEN 2 THEN 'Friend' END AS patient_subchannel_name,
               {fold_sql(_CREATOR)} AS created_by_name_norm,
               {fold_sql(_PATIENT_NAME)} AS patient_name_norm,
               {digits_sql(_APPT_PHONE)} AS phone_norm
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "appointment_logs": f"""
        SELECT {LINE_ID} AS id, l_orderkey AS appointment_id,
               CASE WHEN l_suppkey % 4 = 0 THEN 'mc' WHEN l_suppkey % 17 = 1 THEN NULL
                    ELSE 'op' || CAST(l_suppkey AS VARCHAR) END AS user_id,
               1 AS from_status,
               CAST(CASE l_linenumber WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 7 WHEN 5 THEN 8
                    WHEN 6 THEN 5 ELSE 1 END AS INTEGER) AS to_status,
               CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'N' THEN FALSE END AS is_reschedule,
               l_shipdate AS change_date
        FROM lineitem""",
    "payments": f"""
        SELECT {LINE_ID} AS id, o_custkey AS patient_id, CAST(c_nationkey AS VARCHAR) AS clinic_id,
               l_shipdate AS date,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS amount,
               l_linestatus = 'F' AS is_confirmed,
               CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS deleted_at,
               CASE WHEN p_type = 'PROMO' THEN 'eval' ELSE lower(p_type) END AS specialty_id,
               CASE WHEN p_type = 'PROMO' THEN 'Avaliação Inicial' ELSE p_type END AS specialty_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN part ON l_partkey = p_partkey""",
    "leads": f"""
        SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS account_id,
               CAST(c_nationkey AS VARCHAR) AS erp_clinic_id, c_name AS name,
               'c' || CAST(c_custkey AS VARCHAR) || '@example.org' AS email,
               {phone_sql('c_custkey', 1)} AS phone_raw, CAST(NULL AS VARCHAR) AS identifier,
               ['campanha'] AS labels,
               TIMESTAMP '{LEAD_EPOCH}' + to_days(CAST(c_custkey % 1500 AS INTEGER)) AS created_at_cw,
               TIMESTAMP '{LEAD_EPOCH}' + to_days(CAST(c_custkey % 1500 AS INTEGER))
                   + to_hours(CAST(c_custkey % 97 AS INTEGER)) AS last_activity_at,
               [CAST(c_nationkey AS INTEGER)] AS inbox_ids
        FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 7 = 1""",
    "crm_contacts": f"""
        SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS account_id, c_name AS name,
               CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@example.org' END AS email,
               {phone_sql('c_custkey', 2)} AS phone_number, CAST(NULL AS VARCHAR) AS identifier,
               CAST(c_nationkey AS INTEGER) AS inbox_id,
               CAST(epoch(TIMESTAMP '{LEAD_EPOCH}') AS BIGINT) + (c_custkey % 1500) * 86400 AS created_at,
               CASE WHEN c_custkey % 11 = 0 THEN NULL
                    ELSE CAST(epoch(TIMESTAMP '{LEAD_EPOCH}') AS BIGINT) + (c_custkey % 1500) * 86400
                         + (c_custkey % 97) * 3600 END AS last_activity_at,
               CASE WHEN c_custkey % 2 = 0 THEN ['campanha'] ELSE ['other'] END AS labels,
               CASE WHEN c_custkey % 3 = 0 THEN 'ad' || CAST(c_custkey % 7 AS VARCHAR)
                    WHEN c_custkey % 5 = 0 THEN ' ' END AS ad_origin
        FROM customer""",
    "crm_conversations": f"""
        SELECT event_id AS id, CAST(user_id % 25 AS BIGINT) AS account_id,
               CASE WHEN event_id % 2 = 0 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS created_at,
               CAST(floor(epoch(ts)) AS BIGINT) AS created_secs,
               CASE WHEN event_id % 9 = 0 THEN NULL
                    ELSE CAST(floor(epoch(ts)) AS BIGINT) + (event_id % 120) * 60 END AS last_activity_at,
               user_id AS contact_id, CAST(user_id % 25 AS INTEGER) AS inbox_id,
               CASE WHEN event_type IN ('purchase', 'signup') THEN ['campanha', event_type] ELSE [event_type] END AS labels,
               CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS sender_id,
               CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'Sender ' || CAST(user_id AS VARCHAR) END AS sender_name,
               CAST(NULL AS VARCHAR) AS sender_email,
               CASE WHEN event_id % 10 = 0 THEN NULL ELSE {phone_sql('user_id', 3)} END AS sender_phone,
               CAST(NULL AS VARCHAR) AS sender_identifier
        FROM events""",
    "users": """
        SELECT 'u' || CAST(s_suppkey AS VARCHAR) AS id, s_suppkey % 13 <> 0 AS active,
               CASE WHEN s_suppkey % 50 = 0 THEN 'admin' ELSE 'leader' END AS role,
               CASE WHEN s_suppkey % 10 = 2 THEN r_name END AS regional,
               s_suppkey % 50 = 0 AS unrestricted,
               CASE WHEN s_suppkey % 10 = 1 THEN [CAST(s_nationkey AS VARCHAR), CAST((s_nationkey + 1) % 25 AS VARCHAR), '']
                    WHEN s_suppkey % 10 = 3 THEN [''] END AS allowed_clinic_ids,
               CASE WHEN s_suppkey % 10 = 4 THEN []
                    ELSE [{'id': CAST(s_nationkey AS BIGINT), 'role': 'administrator',
                           'status': CASE WHEN s_suppkey % 7 = 0 THEN 'inactive' ELSE 'active' END},
                          {'id': CAST((s_nationkey + 5) % 25 AS BIGINT),
                           'role': CASE WHEN s_suppkey % 9 = 0 THEN 'agent' ELSE 'administrator' END,
                           'status': 'active'}] END AS accounts
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
}


def with_views(names, body: str, extra: dict[str, str] | None = None) -> str:
    """`WITH <adapter views...>, <extra CTEs...> <body>`."""
    parts = [f"{n} AS ({VIEWS[n]})" for n in names]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
