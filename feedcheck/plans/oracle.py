"""The same results in plain SQL over the given tables."""

from __future__ import annotations

from . import feeds

# Parts of an event line, one row per event.
_EV = """
ev0 AS (
  SELECT event_id, ts, event_type, 'events_' || strftime(ts, '%Y%m%d') || '.unl' AS file_key, day(ts) AS dom,
         CAST(user_id AS VARCHAR) AS u, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS f4
  FROM events),
ev AS (
  SELECT event_id, ts, file_key, dom, event_type AS f3, f4,
         u || CASE WHEN dom % 5 = 1 AND event_id % 97 = 0 THEN 'a' ELSE '' END AS f2,
         CASE WHEN NOT (dom % 5 = 2 AND event_id % 89 = 0) THEN
           strftime(ts, '%Y') || CASE WHEN dom % 5 = 4 AND event_id % 79 = 0 THEN '13' ELSE strftime(ts, '%m') END
           || strftime(ts, '%d%H%M%S') END AS f5,
         CASE WHEN dom % 5 = 3 AND event_id % 83 = 0 THEN 'x' END AS extra
  FROM ev0),
dat AS (
  SELECT event_id, file_key, dom, f2, f3, f4, f5, extra,
         concat_ws('|', CAST(event_id AS VARCHAR), f2, f3, f4, f5, extra) AS line,
         row_number() OVER (PARTITION BY file_key ORDER BY event_id) AS rid,
         NOT regexp_full_match(f2, '[+-]?[0-9]+') AS bad_user, f5 IS NULL AS no_time, extra IS NOT NULL AS has_extra,
         f5 IS NOT NULL AND try_strptime(f5, '%Y%m%d%H%M%S') IS NULL AS bad_date
  FROM ev),
per AS (
  SELECT file_key, dom, count(*) AS n, count(*) + CASE WHEN dom % 7 = 0 THEN 1 ELSE 0 END AS claim,
         bool_or(bad_user) AS bad_user, bool_or(no_time) AS no_time, bool_or(has_extra) AS has_extra, bool_or(bad_date) AS bad_date
  FROM dat GROUP BY file_key, dom),
verdict AS (
  SELECT *, CASE WHEN bad_date THEN '325335' WHEN claim <> n THEN '325306'
                 WHEN bad_user OR no_time OR has_extra THEN '325308' ELSE '225304' END AS code
  FROM per)
"""

_ERRORS = """
errs AS (
  SELECT file_key, rid + 1 AS line_no, rid AS record_id, 'INVALID_FIELD' AS error_type, 'user_id' AS field FROM dat WHERE bad_user
  UNION ALL SELECT file_key, rid + 1, rid, 'MISSING_FIELD', 'event_time' FROM dat WHERE no_time
  UNION ALL SELECT file_key, rid + 1, rid, 'EXTRA_FIELD', 'unknown_field_index_5' FROM dat WHERE has_extra)
"""

_ALL_LINES = """
lin AS (
  SELECT file_key, rid + 1 AS line_no, line, 'data' AS section, rid AS record_id FROM dat
  UNION ALL SELECT file_key, 1, 'HDR|' || claim, 'header', NULL FROM per
  UNION ALL SELECT file_key, n + 2, CAST(claim AS VARCHAR), 'footer', NULL FROM per)
"""

_MANIFEST = """
m AS (
  SELECT o_orderkey, o_custkey, o_orderdate, 'orders_' || strftime(o_orderdate, '%Y%m') || '.ctrl' AS file_key,
         strftime(o_orderdate, '%Y%m') AS ym, month(o_orderdate) AS mon FROM orders),
mf AS (
  SELECT file_key, ym, mon, count(*) AS n, count(*) + CASE WHEN mon = 5 THEN 1 ELSE 0 END AS claim FROM m GROUP BY file_key, ym, mon)
"""

_PAGES = """
p0 AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS directory, regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1) AS rest, html FROM pages),
pg AS (
  SELECT page_id, directory, 'h1' AS localhost, split_part(rest, '/', 1) AS relative, regexp_replace(rest, '^[^/]*/', '') AS file_name,
         length(html) AS size, 1700000000000 + page_id * 60000 AS modified_ms FROM p0)
"""

_RULES = ", ".join(f"('{k}', {i}, '{r}')" for k, rs in feeds.PAGE_REGEXES.items() for i, r in enumerate(rs))
_CONF = f"""
rules(letter, i, file_regex) AS (VALUES {_RULES}),
dirs AS (SELECT DISTINCT directory, right(split_part(directory, '.', 1), 1) AS letter FROM pg),
conf AS (
  SELECT d.directory, 'h1, h2' AS hostname, '22' AS port, r.file_regex, 'user' || coalesce(r.i, 0) AS username,
         CASE WHEN r.i = 1 THEN '/keys/b' END AS private_key_path, '/quarantine/' || d.directory AS quarantine_directory,
         'team' || coalesce(r.i, 0) || '@x.org' AS team,
         CASE WHEN length(d.directory) % 2 = 0 THEN 'even' ELSE 'odd' END AS project
  FROM dirs d LEFT JOIN rules r ON r.letter = d.letter),
roll AS (
  SELECT directory, hostname, port, string_agg(file_regex, ' ' ORDER BY file_regex) AS regexes, min(username) AS username,
         coalesce(min(private_key_path), '') AS private_key_path, min(quarantine_directory) AS quarantine_directory,
         'ops@x.org,' || string_agg(team, ',' ORDER BY team) AS support_email_list, min(project) AS project
  FROM conf GROUP BY directory, hostname, port),
hit AS (
  SELECT g.page_id, g.directory, g.file_name, c.file_regex FROM pg g JOIN conf c ON c.directory = g.directory
  WHERE c.file_regex IS NOT NULL AND regexp_full_match(g.file_name, c.file_regex)),
miss AS (
  SELECT g.page_id, g.directory, g.file_name FROM pg g
  WHERE EXISTS (SELECT 1 FROM conf c WHERE c.directory = g.directory AND c.file_regex IS NOT NULL)
    AND NOT EXISTS (SELECT 1 FROM hit h WHERE h.page_id = g.page_id))
"""

_TIMINGS = """
tm AS (
  SELECT event_id, '/data/u' || user_id AS directory, 'f' || (event_id % 10) AS filename, upper(event_type) AS operation,
         CAST(round(value * 10) AS INTEGER) AS duration_ms, ts AS created_at FROM events)
"""

_META = """
hd AS (
  SELECT file_key, dom, n, claim, dom % 10 AS dg, CASE WHEN dom % 9 = 0 THEN claim + 5 ELSE claim END AS meta_claim,
         CASE WHEN dom % 10 = 3 THEN '325325' WHEN dom % 10 = 5 THEN '325324' WHEN dom % 10 = 1 THEN '325326' END AS line_code
  FROM per)
"""


def _quoted(c: str) -> str:
    return f"""'"' || replace({c}, '"', '""') || '"'"""


def _minimal(c: str) -> str:
    return (
        f"CASE WHEN contains({c}, '|') OR contains({c}, '\"') OR contains({c}, chr(10)) OR contains({c}, chr(13)) "
        f"THEN {_quoted(c)} ELSE {c} END"
    )


def _escaped(c: str) -> str:
    out = f"replace({c}, chr(92), chr(92) || chr(92))"
    for a, b in (("'|'", "'|'"), ("chr(10)", "'n'"), ("chr(13)", "'r'"), ("'\"'", "'\"'")):
        out = f"replace({out}, {a}, chr(92) || {b})"
    return out


_META_ATTRS = {
    "file_name": "file_key",
    "sequence_number": "CAST(dom AS VARCHAR)",
    "file_size": "CAST(n * 10 AS VARCHAR)",
    "record_count": "CAST(meta_claim AS VARCHAR)",
    "number_of_fields": "'5'",
    "start_date": "substr(file_key, 8, 8) || '000000'",
    "end_date": "''",
    "Date_of_file_generation": "''",
}

ORACLE: dict[str, str] = {
    "feed_verdicts": f"""WITH {_EV}
      SELECT file_key, CASE WHEN code = '225304' THEN 'success' ELSE 'failure' END AS status, code, n AS actual_record_count,
             claim AS claimed_count, CASE WHEN claim = n THEN 'matched' ELSE 'mismatched' END AS count_status,
             CASE WHEN no_time THEN 'event_time' ELSE '' END AS missing_fields,
             CASE WHEN has_extra THEN 'unknown_field_index_5' ELSE '' END AS extra_fields,
             CASE WHEN bad_user THEN 'user_id' ELSE '' END AS invalid_fields
      FROM verdict""",
    "attribute_verdicts": f"""WITH {_EV}, v AS (
      SELECT file_key, n, CASE WHEN dom = 30 THEN '325218' WHEN dom IN (10, 20) THEN '325205' WHEN bad_date THEN '325224'
             WHEN bad_user OR no_time OR has_extra THEN '325208' ELSE '225204' END AS code FROM per)
      SELECT file_key, CASE WHEN code = '225204' THEN 'success' ELSE 'failure' END AS status, code,
             CASE WHEN code NOT IN ('325218', '325205') THEN n END AS actual_record_count, n AS claimed_count FROM v""",
    "passing_lines": f"""WITH {_EV}
      SELECT d.file_key, rid AS record_id,
             '|' || rid || '|' || f3 || '|' || event_id || '||' || substr(d.file_key, 8, 8) || '|' || f2 || '|' || f4 || '|'
             || epoch_ms(strptime(f5, '%Y%m%d%H%M%S')) AS line
      FROM dat d JOIN verdict v ON v.file_key = d.file_key WHERE v.code = '225304'""",
    "failing_lines": f"""WITH {_EV}, {_ALL_LINES}
      SELECT l.file_key, line_no, line FROM lin l JOIN verdict v ON v.file_key = l.file_key WHERE v.code <> '225304'""",
    "passing_records": f"""WITH {_EV}
      SELECT d.file_key, rid AS record_id, event_id, CAST(f2 AS BIGINT) AS user_id, f3 AS event_type, CAST(f4 AS BIGINT) AS cents,
             epoch_ms(strptime(f5, '%Y%m%d%H%M%S')) AS event_time
      FROM dat d JOIN verdict v ON v.file_key = d.file_key WHERE v.code = '225304'""",
    "record_errors": f"WITH {_EV}, {_ERRORS} SELECT * FROM errs",
    "error_rollup": f"""WITH {_EV}, {_ERRORS}, e AS (SELECT DISTINCT file_key, error_type, field FROM errs),
      g AS (SELECT file_key,
              count(*) FILTER (error_type = 'MISSING_FIELD') AS nm, string_agg(field, ', ' ORDER BY field) FILTER (error_type = 'MISSING_FIELD') AS m,
              count(*) FILTER (error_type = 'EXTRA_FIELD') AS nx, string_agg(field, ', ' ORDER BY field) FILTER (error_type = 'EXTRA_FIELD') AS x,
              count(*) FILTER (error_type = 'INVALID_FIELD') AS ni, string_agg(field, ', ' ORDER BY field) FILTER (error_type = 'INVALID_FIELD') AS i
            FROM e GROUP BY file_key)
      SELECT file_key, 'Records in this FlowFile were invalid for the following reasons: '
        || CASE WHEN nm > 0 THEN 'The following ' || nm || ' fields were missing: [' || m || ']' ELSE '' END
        || CASE WHEN nx > 0 THEN '; The following ' || nx || ' fields were present in the Record but not in the schema: [' || x || ']' ELSE '' END
        || CASE WHEN ni > 0 THEN '; The following ' || ni || ' fields had values whose type did not match the schema: [' || i || ']' ELSE '' END AS message
      FROM g""",
    "audit_summary": f"""WITH {_EV}, a AS (
      SELECT '125302' AS log_type_id FROM verdict UNION ALL SELECT '125303' FROM verdict WHERE claim = n UNION ALL SELECT code FROM verdict)
      SELECT log_type_id, count(*) AS n, CASE substr(log_type_id, 1, 1) WHEN '1' THEN 'DEBUG' WHEN '2' THEN 'INFO' ELSE 'ERROR' END AS level
      FROM a GROUP BY log_type_id""",
    "header_metadata": f"""WITH {_EV}, {_META}, v AS (
      SELECT *, coalesce(line_code, CASE WHEN meta_claim <> n THEN '325306' ELSE '225304' END) AS code FROM hd)
      SELECT file_key, code, meta_claim AS claimed_count,
             {", ".join(f"CASE WHEN code = '225304' THEN {e} END AS metadata_{k}" for k, e in _META_ATTRS.items())} FROM v""",
    "metadata_and_footer": f"""WITH {_EV}, {_META}
      SELECT file_key, coalesce(line_code, CASE WHEN meta_claim <> claim THEN '325329' WHEN claim <> n THEN '325306' ELSE '225304' END) AS code,
             claim AS claimed_count, n AS actual_record_count,
             CASE WHEN meta_claim <> claim THEN 'unparsed' WHEN claim <> n THEN 'mismatched' ELSE 'matched' END AS count_status
      FROM hd""",
    "manifest_verdicts": f"""WITH {_MANIFEST}
      SELECT file_key, CASE WHEN claim = n THEN '225104' ELSE '325106' END AS code, n AS actual_record_count,
             CASE WHEN claim = n THEN CAST(claim AS VARCHAR) END AS metadata_record_count FROM mf""",
    "manifest_rows": f"""WITH {_MANIFEST}, r AS (
      SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY o_orderkey) AS rid FROM m)
      SELECT r.file_key, rid AS record_id, r.file_key AS file_name, r.ym AS file_uuid, '7' AS conf_id,
             '.dat.gz' AS datafile_extension, 'order_' || o_orderkey || '.dat.gz' AS data_file_name,
             CAST(o_orderkey AS VARCHAR) AS data_sequence_number, '' AS data_file_size, CAST(o_orderkey % 7 + 1 AS VARCHAR) AS data_record_count,
             '' AS data_number_of_fields, strftime(o_orderdate, '%Y%m%d') || '000000' AS data_start_date, '' AS data_end_date,
             strftime(o_orderdate, '%Y%m%d') AS "data_Date_of_file_generation"
      FROM r JOIN mf ON mf.file_key = r.file_key WHERE mf.claim = mf.n""",
    "scanned_files": f"""WITH {_EV}
      SELECT substr(file_key, 8, 8) AS day, count(*) AS n_lines, count(*) FILTER (bad_user OR no_time OR has_extra) AS n_bad,
             count(*) FILTER (bad_date) AS n_stopped, true AS numbered FROM dat GROUP BY 1""",
    "framed_records": f"""WITH {_EV}, {_ALL_LINES}
      SELECT l.file_key, line_no, n + 2 AS total_lines, section, record_id, line FROM lin l JOIN per p ON p.file_key = l.file_key""",
    "section_texts": f"WITH {_EV} SELECT file_key, 'HDR|' || claim || '|' AS header_text, claim || '|' AS footer_text FROM per",
    "claimed_counts": f"""WITH {_EV}
      SELECT file_key, regexp_matches('HDR|' || claim || '|', '(\\d*)') AS header_found, regexp_extract('HDR|' || claim || '|', '(\\d*)', 0) AS header_match,
             'unparsed' AS header_status, 'usable' AS footer_status, CAST(regexp_extract(claim || '|', '(\\d+)', 0) AS BIGINT) AS footer_count
      FROM per""",
    "reconcile_files": """WITH c AS (
      SELECT c_custkey AS file_key, CASE WHEN c_custkey % 11 = 0 THEN 'n/a' WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 20 AS VARCHAR) END AS t,
             c_mktsegment FROM customer),
      o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
      j AS (SELECT file_key, t, c_mktsegment, coalesce(n, 0) AS actual_count,
                   CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN try_cast(t AS BIGINT) END AS claimed_count
            FROM c LEFT JOIN o ON o.o_custkey = c.file_key)
      SELECT file_key, claimed_count, actual_count,
             CASE WHEN c_mktsegment = 'MACHINERY' THEN 'skipped' WHEN t IS NULL THEN 'not_found' WHEN claimed_count IS NULL THEN 'unparsed'
                  WHEN claimed_count = actual_count THEN 'matched' ELSE 'mismatched' END AS status FROM j""",
    "reconcile_orders": """WITH l AS (SELECT l_orderkey AS order_key, count(*) AS actual_count FROM lineitem GROUP BY l_orderkey)
      SELECT coalesce(o.o_orderkey, l.order_key) AS order_key, o.o_orderkey % 7 + 1 AS claimed_count, actual_count,
             CASE WHEN o.o_orderkey IS NULL THEN 'unexpected' WHEN actual_count IS NULL THEN 'absent'
                  WHEN o.o_orderkey % 7 + 1 = actual_count THEN 'matched' ELSE 'mismatched' END AS status
      FROM orders o FULL OUTER JOIN l ON l.order_key = o.o_orderkey""",
    "config_checks": """WITH c AS (
      SELECT c_custkey AS k, c_custkey % 5 = 0 AS bad_h, c_custkey % 7 = 0 OR c_custkey % 4 = 0 AS bad_f,
             CASE WHEN c_custkey % 17 <> 0 THEN CASE c_custkey % 5 WHEN 0 THEN 'header' WHEN 1 THEN 'footer' WHEN 2 THEN 'filename' WHEN 3 THEN 'none' ELSE 'bottom' END END AS loc,
             c_custkey % 6 = 0 AS blank, c_custkey % 3 = 2 AS bad_id,
             c_custkey % 2 <> 0 AS bad_choice FROM customer),
      e AS (SELECT *, concat_ws(',', CASE WHEN bad_h THEN '325316' END, CASE WHEN bad_f THEN '325316' END, CASE WHEN loc = 'bottom' THEN '325314' END,
              CASE WHEN loc IN ('header', 'footer', 'filename') AND blank THEN '325331' END, CASE WHEN bad_id THEN '325315' END,
              CASE WHEN bad_choice THEN '325314' END) AS failed FROM c)
      SELECT k AS file_key, CASE WHEN NOT bad_h THEN CAST(k % 3 AS INTEGER) END AS header_n, CASE WHEN NOT bad_f THEN CAST(k % 4 - 1 AS INTEGER) END AS footer_n,
             CASE WHEN loc IS NULL THEN '325333' WHEN failed <> '' THEN '325305' END AS config_code, failed AS failed_checks FROM e""",
    "dates_to_epoch": f"""WITH {_EV}
      SELECT event_id, epoch_ms(try_strptime(f5, '%Y%m%d%H%M%S')) AS event_time, bad_date AS event_time_failed FROM dat""",
    "lenient_dates": f"""WITH {_EV}
      SELECT event_id, strftime(strptime(substr(f5, 1, 4), '%Y') + to_months(CAST(substr(f5, 5, 2) AS INTEGER) - 1)
               + to_days(CAST(substr(f5, 7, 2) AS INTEGER) - 1) + to_hours(CAST(substr(f5, 9, 2) AS INTEGER))
               + to_minutes(CAST(substr(f5, 11, 2) AS INTEGER)) + to_seconds(CAST(substr(f5, 13, 2) AS INTEGER)), '%Y%m%d%H%M%S') AS rolled
      FROM dat""",
    "lenient_text_dates": """WITH t AS (SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) AS d FROM orders)
      SELECT k AS o_orderkey, (day(d) + CASE WHEN k % 5 = 0 THEN 31 ELSE 0 END) || '-' || CASE WHEN k % 11 = 0 THEN 'XXX' WHEN k % 2 = 0 THEN upper(strftime(d, '%b')) ELSE strftime(d, '%B') END
               || '-' || year(d) || ' ' || lpad(CAST(k % 14 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k % 90 AS VARCHAR), 2, '0') || CASE WHEN k % 4 < 2 THEN ' am ' ELSE ' PM ' END
               || CASE k % 3 WHEN 0 THEN '+01:00' WHEN 1 THEN 'Z' ELSE '-05:30' END AS source_text,
             CASE WHEN k % 11 <> 0 THEN epoch_ms(date_trunc('day', d)) + 60000 * (CASE WHEN k % 5 = 0 THEN 31 * 1440 ELSE 0 END
               + 60 * ((CASE WHEN k % 14 = 12 THEN 0 ELSE k % 14 END) + CASE WHEN k % 4 < 2 THEN 0 ELSE 12 END) + k % 90
               - CASE k % 3 WHEN 0 THEN 60 WHEN 1 THEN 0 ELSE -330 END) END AS epoch_ms FROM t""",
    "manifest_dates": """WITH t AS (
      SELECT o_orderkey, o_orderdate, o_orderkey % 10 = 0 AS bad FROM orders)
      SELECT o_orderkey, CASE WHEN bad THEN '[31-XXX-20],[00:00:00]' ELSE '[' || strftime(o_orderdate, '%d-%b-%y') || '],[21:07:56]' END AS source_text,
             CASE WHEN NOT bad THEN '20' || strftime(o_orderdate, '%y%m%d') || '210756' END AS normal_text FROM t""",
    "partition_paths": """WITH e AS (
      SELECT event_id, event_type, strftime(ts, '%Y') AS y, strftime(ts, '%m') AS m, strftime(ts, '%Y%m%d%H') || lpad(CAST(minute(ts) // 15 * 15 AS VARCHAR), 2, '0') AS l,
             lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0') AS s, event_type <> 'error' AS ok FROM events)
      SELECT event_id, CASE WHEN ok THEN y || '/month=' || m || '/event_type=' || event_type || '/load_date=' || l || '/' || s END AS raw_partition,
             CASE WHEN ok THEN y || ',' || m || ',' || event_type || ',' || l || ',' || s END AS hive_partition,
             CASE WHEN ok THEN '226005' ELSE '326017' END AS partition_code FROM e""",
    "partitioned_write": """SELECT CAST(day(ts) AS INTEGER) AS week_day, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum
      FROM events GROUP BY 1, 2""",
    "feed_hosts": f"""WITH {_PAGES}, {_CONF}
      SELECT DISTINCT directory, port, h AS localhost FROM conf CROSS JOIN (VALUES ('h1'), ('h2')) AS hosts(h) WHERE project = 'even'""",
    "directory_rollup": f"""WITH {_PAGES}, {_CONF}
      SELECT directory, hostname, port, coalesce(regexes, '') AS regexes, username, private_key_path, quarantine_directory, support_email_list, project
      FROM roll WHERE project = 'odd'""",
    "unclaimed_files": f"""WITH {_PAGES}, {_CONF}
      SELECT page_id, miss.directory, file_name, support_email_list FROM miss JOIN roll ON roll.directory = miss.directory""",
    "claimed_files": f"WITH {_PAGES}, {_CONF} SELECT page_id, directory, file_name, file_regex FROM hit",
    "unclaimed_report": f"""WITH {_PAGES}, {_CONF}
      SELECT 'h1' AS localhost, file_name, support_email_list, quarantine_directory, project, roll.directory, port, username, private_key_path,
             '231001' AS log_type_id FROM miss JOIN roll ON roll.directory = miss.directory
      UNION ALL
      SELECT 'h2', 'null', support_email_list, quarantine_directory, project, directory, port, username, private_key_path, '331004' FROM roll""",
    "unclaimed_many": """WITH f AS (
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '/in/open' ELSE '/in/orders' END AS directory, c_custkey AS k,
             'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey || '.csv' AS file_name,
             month(o_orderdate) = 1 AS january FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
      SELECT o_orderkey, directory, file_name FROM f
      WHERE CASE WHEN directory = '/in/open' THEN coalesce(k % 8 <> 0, true)
            ELSE NOT january AND (k IS NULL OR k % 4 = 3 OR (k % 4 = 2 AND o_orderkey % 2 = 1)) END""",
    "conf_lookup": """WITH c AS (SELECT c_custkey, c_nationkey + c_custkey % 2 * 20 AS conf_id FROM customer)
      SELECT c_custkey, conf_id, n_name, n_regionkey, CASE WHEN n_nationkey IS NULL THEN '323008' END AS conf_error
      FROM c LEFT JOIN nation ON n_nationkey = conf_id""",
    "listing_filter": f"""WITH {_PAGES}
      SELECT page_id, relative, file_name, size FROM pg
      WHERE size BETWEEN 1500 AND 9000 AND 60000 * 5000 - page_id * 60000 BETWEEN 600000 AND 60000 * 4900
        AND relative IN ('', 'en', 'fr') AND regexp_full_match(file_name, '[0-9]+.*')""",
    "new_files": """WITH p AS (SELECT page_id, page_id // 5 * 1000 AS modified_ms FROM pages),
      t AS (SELECT max(modified_ms) AS top FROM p), held AS (SELECT max(modified_ms) AS top FROM p WHERE modified_ms <= 20000)
      SELECT 1 AS cycle, page_id, modified_ms FROM p WHERE modified_ms <= 20000 AND modified_ms < (SELECT top FROM held)
      UNION ALL SELECT 2, page_id, modified_ms FROM p WHERE modified_ms >= (SELECT top FROM held)
        AND (modified_ms < (SELECT top FROM t) OR (SELECT top FROM t) = (SELECT top FROM held))""",
    "listing_cycles": f"""WITH {_PAGES},
      p AS (SELECT page_id, page_id // 5 * 1000 AS modified_ms, size, max(page_id // 5 * 1000) OVER () AS top FROM pg WHERE file_name <> '' AND file_name NOT LIKE '.%'),
      held AS (SELECT max(modified_ms) AS first FROM p WHERE modified_ms <= 20000), big AS (SELECT *, max(modified_ms) OVER () AS top_big FROM p WHERE size >= 3000)
      SELECT 1 AS cycle, 1 AS version, page_id, modified_ms FROM p, held WHERE modified_ms < first
      UNION ALL SELECT 2, 2, page_id, modified_ms FROM p, held WHERE modified_ms >= first AND modified_ms < top
      UNION ALL SELECT 3, 3, page_id, modified_ms FROM p WHERE modified_ms = top
      UNION ALL SELECT 4, 4, page_id, modified_ms FROM big WHERE modified_ms < top_big""",
    "listing_attributes": f"""WITH {_PAGES}
      SELECT CASE WHEN page_id % 4 = 0 THEN './' ELSE relative || '/' END AS path, file_name AS filename,
             '/landing/' || CASE WHEN page_id % 4 = 0 THEN '' ELSE relative || '/' END AS absolute_path, CAST(size AS VARCHAR) AS file_size,
             strftime(make_timestamp(modified_ms * 1000), '%Y-%m-%dT%H:%M:%S') AS file_last_modified_time FROM pg""",
    "run_entries": f"""WITH {_PAGES}
      SELECT '2024-01-01 00:00:00.000' AS run_dt, 'reg-1' AS registry_id, replace(file_name, '/', '_') AS file_name, '/landing/' || relative AS file_path,
             CAST(size AS VARCHAR) AS file_size, 0 AS is_fetched, 0 AS is_locked, 0 AS is_success
      FROM pg WHERE page_id % 6 <> 0 AND regexp_full_match(replace(file_name, '/', '_'), '[^\\.].*')""",
    "listing_entries": f"""WITH {_PAGES}
      SELECT strftime(make_timestamp(modified_ms * 1000), '%Y-%m-%d %H:%M:%S') AS listing_timestamp, 'conf-7' AS conf_id, file_name,
             '/in' AS directory, size AS actual_file_size, 'h1' AS localhost FROM pg WHERE regexp_full_match(file_name, '[0-9]+(\\.html|/)?')""",
    "operation_stats": f"""WITH {_TIMINGS}
      SELECT operation, count(*) AS n, min(duration_ms) AS min_ms, max(duration_ms) AS max_ms, round(avg(duration_ms), 6) AS mean_ms,
             round(stddev_pop(duration_ms), 6) AS std_ms FROM tm GROUP BY operation""",
    "operation_outliers": f"""WITH {_TIMINGS}, s AS (SELECT operation, avg(duration_ms) + 2 * stddev_pop(duration_ms) AS cutoff FROM tm GROUP BY operation)
      SELECT tm.operation, directory || '/' || filename AS full_path, duration_ms FROM tm JOIN s ON s.operation = tm.operation
      WHERE duration_ms > 2 AND duration_ms > cutoff""",
    "slow_operations": f"""WITH {_TIMINGS}
      SELECT event_id, CASE operation WHEN 'VIEW' THEN 'LISTING' ELSE operation END AS operation, duration_ms FROM tm
      WHERE duration_ms > CASE operation WHEN 'VIEW' THEN 3000 ELSE 2000 END""",
    "retain_timings": f"""WITH {_TIMINGS}, f AS (
      SELECT directory, filename, min(created_at) AS first_at FROM tm GROUP BY directory, filename
      HAVING min(created_at) >= TIMESTAMP '2024-01-02 00:00:00' ORDER BY first_at DESC, directory, filename LIMIT 300),
      r AS (SELECT tm.*, row_number() OVER (PARTITION BY directory, filename, operation ORDER BY created_at DESC, duration_ms DESC) AS k FROM tm)
      SELECT r.directory, r.filename, operation, duration_ms, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at
      FROM r JOIN f ON f.directory = r.directory AND f.filename = r.filename WHERE k = 1""",
    "streamed_retention": f"""WITH {_TIMINGS}, f AS (
      SELECT directory, filename, min(created_at) AS first_at FROM tm GROUP BY directory, filename
      HAVING min(created_at) >= (SELECT date_trunc('milliseconds', max(created_at)) - INTERVAL 1 HOUR - INTERVAL 20 DAY FROM tm)),
      r AS (SELECT tm.*, row_number() OVER (PARTITION BY directory, filename, operation ORDER BY created_at DESC, duration_ms DESC) AS k FROM tm)
      SELECT r.directory, r.filename, operation, duration_ms, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(first_at, '%Y-%m-%d %H:%M:%S') AS first_at
      FROM r JOIN f ON f.directory = r.directory AND f.filename = r.filename WHERE k = 1""",
    "cells_to_lines": """WITH p AS (
      SELECT p_partkey, p_brand, replace(p_name, ' ', '|') AS nm, p_size, p_type,
             strftime(make_timestamp((1600000000 + p_partkey * 3600) * 1000000), '%Y%m%d%H%M%S') AS dt FROM part WHERE p_brand <> 'Brand#3')
      SELECT p_brand AS file, CAST(p_partkey % 2 AS INTEGER) AS sheet, CAST(p_partkey AS INTEGER) AS "row",
             CASE WHEN contains(nm, '|') THEN '"' || nm || '"' ELSE nm END || '|' || p_size || '|||' || dt || '|' || p_type || '|' || p_brand AS line FROM p""",
    "render_lines": f"""SELECT doc_id,
      md5('"' || doc_id || '"|' || {_quoted("source")} || '|' || {_quoted("text")}) AS "all",
      md5(doc_id || '|' || {_minimal("source")} || '|' || {_minimal("text")}) AS minimal,
      md5(doc_id || '|' || {_quoted("source")} || '|' || {_quoted("text")}) AS non_numeric,
      md5(doc_id || '|' || {_escaped("source")} || '|' || {_escaped("text")} || '|') AS none FROM documents""",
    "split_lines": "SELECT doc_id, 3 AS n, md5(text) AS text_md5, lang FROM documents",
    "multiline_records": "SELECT doc_id, 3 AS n, md5(text) AS text_md5, lang FROM documents",
    "malformed_lines": """WITH d AS (SELECT source AS file_key, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS line_no FROM documents)
      SELECT file_key, doc_id, line_no FROM d WHERE doc_id % 50 = 0""",
    "typed_feed": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "project_to_target": """SELECT 'c_mktsegment,region,c_custkey,c_name,c_nationkey' AS column_order, c_mktsegment, CAST(NULL AS VARCHAR) AS region,
      c_custkey, c_name, c_nationkey FROM customer""",
    "content_roundtrip": "SELECT doc_id, 'pass-' || source AS passphrase, md5(text) AS text_md5 FROM documents",
    "relaxed_verdicts": f"""WITH {_EV}
      SELECT file_key, CASE WHEN claim <> n THEN '325306' WHEN bad_user OR no_time THEN '325308' ELSE '225304' END AS code,
             CASE WHEN no_time THEN 'event_time' ELSE '' END AS missing_fields, '' AS extra_fields,
             CASE WHEN bad_user THEN 'user_id' ELSE '' END AS invalid_fields FROM per""",
    "coerced_values": """SELECT event_id, CAST(NULL AS BIGINT) AS strict_value, CAST(trunc(value) AS BIGINT) AS coerced_value FROM events""",
    "dialect_feeds": """WITH c AS (SELECT *, CASE c_nationkey % 4 WHEN 0 THEN 124 WHEN 1 THEN 9 WHEN 2 THEN 1 ELSE 44 END AS separator,
             CASE WHEN c_nationkey % 4 IN (0, 3) THEN chr(39) ELSE chr(34) END AS q, CASE c_nationkey % 4 WHEN 1 THEN '^' ELSE chr(92) END AS e FROM customer)
      SELECT 'nation_' || c_nationkey AS file_key, separator, c_custkey, c_name || chr(separator) || q || e || chr(10) || c_mktsegment AS label, c_mktsegment || chr(separator) || 'x' AS segment FROM c""",
    "mixed_dialect_verdicts": """WITH n AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1),
      v AS (SELECT *, CASE WHEN k % 3 = 0 THEN '325206' WHEN k % 5 = 0 THEN '325208' ELSE '225204' END AS code FROM n)
      SELECT 'nation_' || k AS file_key, CASE WHEN code = '225204' THEN 'success' ELSE 'failure' END AS status, code, n AS actual_record_count,
             n + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS claimed_count, CASE WHEN k % 5 = 0 THEN 'c_custkey' ELSE '' END AS invalid_fields FROM v""",
    "inferred_schema": """WITH o AS (
      SELECT 'orders_' || strftime(o_orderdate, '%Y%m') AS file_key, o_orderkey AS key, year(o_orderdate) * 12 + month(o_orderdate) AS m, o_orderpriority FROM orders),
      c AS (
        SELECT file_key, 0 AS position, 'key' AS field_name, CAST(key + CASE WHEN m % 4 = 0 THEN 3000000000 ELSE 0 END AS VARCHAR) AS v, false AS iso FROM o
        UNION ALL SELECT file_key, 1, 'price', CASE WHEN m % 6 = 1 AND key % 7 = 0 THEN 'none' WHEN m % 3 = 0 THEN CAST(key AS VARCHAR) ELSE key || '.25' END, false FROM o
        UNION ALL SELECT file_key, 2, 'day', 'd', (m % 2 = 0) <> (m % 7 = 0 AND key % 3 = 0) FROM o
        UNION ALL SELECT file_key, 3, 'mark', CASE WHEN m % 5 = 0 AND key % 4 = 0 THEN 'yes' ELSE 'true' END, false FROM o
        UNION ALL SELECT file_key, 4, 'note', CASE WHEN m % 3 = 0 OR (m % 3 = 2 AND key % 5 <> 0) THEN o_orderpriority END, false FROM o),
      g AS (SELECT file_key, position, field_name, count(v) AS n_values, count(*) AS n,
              CASE WHEN position = 2 AND bool_and(iso) THEN 'yyyy-MM-dd' WHEN position = 2 AND NOT bool_or(iso) THEN 'dd/MM/yyyy' END AS pattern,
              bool_and(TRY_CAST(v AS INTEGER) IS NOT NULL AND v NOT LIKE '%.%') AS i, bool_and(TRY_CAST(v AS BIGINT) IS NOT NULL AND v NOT LIKE '%.%') AS l,
              bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) AS d, bool_and(v = 'true') AS b FROM c GROUP BY file_key, position, field_name)
      SELECT file_key, CAST(position AS INTEGER) AS position, field_name, pattern, n_values, n_values < n AS nullable, CASE WHEN pattern IS NOT NULL THEN 'date' END AS logical,
             CASE WHEN n_values = 0 THEN 'string' WHEN i THEN 'int' WHEN l THEN 'long' WHEN d THEN 'double' WHEN b THEN 'boolean'
                  WHEN pattern IS NOT NULL THEN 'long' ELSE 'string' END AS type FROM g""",
    "inferred_verdicts": """SELECT 'orders_' || strftime(o_orderdate, '%Y%m') AS file_key, 'success' AS status, '225304' AS code, count(*) AS actual_record_count,
             '' AS missing_fields, '' AS invalid_fields, count(*) AS n_lines FROM orders GROUP BY 1""",
    "many_schemas": """WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderkey % 4 = 0 AS bare,
        o_orderkey || '|' || CASE WHEN o_custkey % 3 = 0 THEN CAST(CAST(o_orderkey AS DOUBLE) + 0.25 AS VARCHAR) ELSE o_orderkey || '.25' END || '|'
          || epoch_ms(date_trunc('day', o_orderdate)) || '|' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END AS line FROM orders),
      f AS (SELECT c, count(*) AS n, bool_or(bare) AND c % 5 = 0 AS no_note, min(line) AS first_line FROM o GROUP BY c),
      v AS (SELECT *, CASE WHEN c % 13 = 0 THEN '325311' WHEN c % 11 = 0 THEN '325335' WHEN no_note OR c % 3 = 1 THEN '325308' ELSE '225304' END AS code FROM f)
      SELECT 'c_' || c AS file_key, CASE WHEN code = '225304' THEN 'success' ELSE 'failure' END AS status, code,
        CASE WHEN c % 13 <> 0 THEN n END AS actual_record_count,
        CASE WHEN c % 13 <> 0 AND no_note THEN 'note_' || c ELSE '' END AS missing_fields,
        CASE WHEN c % 13 <> 0 AND c % 3 = 1 THEN 'price_' || c ELSE '' END AS invalid_fields,
        CASE WHEN code = '225304' THEN n END AS n_lines, CASE WHEN code = '225304' THEN first_line END AS first_line FROM v""",
    "routed_files": """WITH n AS (SELECT c_nationkey AS nation, count(*) AS n, c_nationkey % 6 AS kind FROM customer GROUP BY 1)
      SELECT nation, FALSE AS gone, CASE WHEN kind IN (0, 1, 5) THEN 'success' ELSE 'failure' END AS status, CASE WHEN kind IN (0, 1, 5) THEN '225304' ELSE '325305' END AS code,
             CASE kind WHEN 0 THEN n WHEN 1 THEN n WHEN 5 THEN 0 END AS actual_record_count, CASE WHEN kind IN (0, 1, 5) THEN 'success' ELSE 'failure' END AS route, n AS n_lines FROM n
      UNION ALL SELECT nation, TRUE, 'failure', '325312', NULL, NULL, 0 FROM n WHERE kind = 3""",
    "written_feeds": """WITH t AS (SELECT md5(c_custkey || '|' || c_name || '|"' || chr(10) || c_mktsegment || chr(92) || '|' || c_nationkey) AS h FROM customer),
      d AS (SELECT count(*) AS n, CAST(sum(CAST('0x' || h[1:8] AS BIGINT)) AS BIGINT) AS digest FROM t)
      SELECT quote_mode, header, ends_in_separator, n, header AS has_header, CASE WHEN ends_in_separator THEN 4 ELSE 3 END AS n_fields, digest
      FROM d, (VALUES ('ALL'), ('MINIMAL'), ('NON_NUMERIC'), ('NONE')) m(quote_mode), (VALUES (TRUE), (FALSE)) h(header), (VALUES (TRUE), (FALSE)) t(ends_in_separator)""",
    "typed_values": """WITH o AS (SELECT o_orderkey, CAST(trunc(CAST(o_totalprice AS DECIMAL(15,2))) AS BIGINT) AS w FROM orders)
      SELECT o_orderkey, kind, CASE kind WHEN 0 THEN w WHEN 1 THEN w WHEN 2 THEN -w WHEN 3 THEN 0 WHEN 4 THEN o_orderkey END AS whole, CASE kind WHEN 4 THEN o_orderkey END AS exact
      FROM o, (VALUES (0), (1), (2), (3), (4), (5)) k(kind)""",
    "passphrase_spellings": "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, TRUE AS changed FROM documents",
    "named_feed": "SELECT c_custkey, c_name, c_acctbal, 'int,string,double' AS types FROM customer",
    "landed_files": """SELECT 'nation_' || c_nationkey AS file_key, CAST(sum(length(CAST(c_custkey AS VARCHAR)) + length(c_name) + 2) AS BIGINT) AS bytes
      FROM customer GROUP BY 1""",
    "walked_files": """SELECT CASE c_nationkey % 3 WHEN 0 THEN 'seen' ELSE '.kept/_old' END AS place, 'nation_' || c_nationkey AS file_key,
             CAST(sum(length(CAST(c_custkey AS VARCHAR)) + length(c_name) + 2) AS BIGINT) AS bytes
      FROM customer WHERE c_nationkey % 3 <> 2 GROUP BY 1, 2""",
    "content_blocks": """WITH t AS (SELECT doc_id AS k, coalesce(text, '') AS x, strlen(coalesce(text, '')) AS b FROM documents),
      n AS (SELECT *, greatest((b + 255) // 256, 1) AS n FROM t),
      lost AS (SELECT k FROM n WHERE k % 17 = 0 AND (k % 11 <> 0 OR n > 1))
      SELECT k AS doc_id, n AS n_blocks, b AS n_bytes, CASE WHEN n = 1 THEN md5(x) END AS text_md5 FROM n
      WHERE k % 10 <> 0 AND k % 11 <> 0 AND k % 13 <> 0 AND k % 17 <> 0 AND k % 19 <> 0 AND k - 1 NOT IN (SELECT k FROM lost)""",
    "conf_rows": f"""WITH {_PAGES}, {_CONF}
      SELECT directory, file_regex, username, 'ops@x.org,' || team AS support_email_list FROM conf WHERE project = 'odd'""",
    "extracted_metadata": """SELECT o_orderkey, 'f' || o_orderkey AS file_name, CAST(NULL AS BIGINT) AS sequence_number, CAST(NULL AS BIGINT) AS file_size,
      o_custkey AS record_count, CAST(NULL AS BIGINT) AS num_of_fields, CAST(NULL AS VARCHAR) AS data_start_date,
      strftime(o_orderdate, '%Y%m%d') || '000000' AS data_end_date, CAST(NULL AS VARCHAR) AS date_of_file_generation FROM orders""",
    "metadata_settings": """SELECT c_custkey,
      CASE c_custkey % 6 WHEN 0 THEN ' ' WHEN 1 THEN '2' WHEN 2 THEN 'Header_Metadata' WHEN 3 THEN 'header_metadata_and_footer' WHEN 4 THEN 'first' END AS metadata_header_record,
      CASE c_custkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 5 THEN 0 END AS metadata_line,
      CASE c_custkey % 6 WHEN 2 THEN '325323' WHEN 3 THEN '325323' WHEN 4 THEN '325334' END AS metadata_setting_code FROM customer""",
    "audit_events": f"""WITH {_EV}
      SELECT CAST(dom % 3 AS VARCHAR) AS conf_id, 'node-' || substr(file_key, 8, 8) AS file_uuid, file_key AS file_name, code AS log_type_id FROM verdict""",
    "debug_audit": f"""WITH {_EV}, {_MANIFEST},
      e AS (SELECT file_key, dom, rid, concat_ws('; ', CASE WHEN no_time THEN 'MISSING_FIELD event_time' END, CASE WHEN bad_user THEN 'INVALID_FIELD user_id' END,
              CASE WHEN has_extra THEN 'EXTRA_FIELD unknown_field_index_5' END) AS why FROM dat WHERE bad_user OR no_time OR has_extra),
      r AS (SELECT *, row_number() OVER (PARTITION BY file_key ORDER BY o_orderkey) AS rid FROM m)
      SELECT CAST(dom % 3 AS VARCHAR) AS conf_id, 'node-' || substr(file_key, 8, 8) AS file_uuid, file_key AS file_name, '325313' AS log_type_id,
             'record ' || rid || ' is invalid: ' || why AS log_message FROM e
      UNION ALL SELECT '7', ym, file_key, '125000', 'record ' || rid || ': field customer is not known, its value is ' || o_custkey FROM r""",
    "streamed_files": f"""WITH {_EV}
      SELECT substr(file_key, 8, 8) AS day, count(*) AS n_records, count(*) AS n_routed FROM dat GROUP BY 1""",
    "paired_arrivals": """WITH e AS (SELECT o_orderkey AS k, o_orderkey % 100 AS claimed_count FROM orders WHERE o_orderkey % 11 <> 0),
      a AS (SELECT o_orderkey AS k, o_orderkey % 100 + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS actual_count FROM orders WHERE o_orderkey % 7 <> 0)
      SELECT 'f' || coalesce(e.k, a.k) AS file_name, claimed_count, actual_count,
        CASE WHEN a.k IS NULL THEN 'absent' WHEN e.k IS NULL THEN 'unexpected' WHEN claimed_count = actual_count THEN 'matched' ELSE 'mismatched' END AS status
      FROM e FULL JOIN a ON a.k = e.k AND e.k % 13 <> 0""",
    "windowed_timings": f"""WITH {_TIMINGS}
      SELECT strftime(time_bucket(INTERVAL 15 MINUTE, created_at), '%Y-%m-%d %H:%M:%S') AS window_start, operation, count(*) AS n, min(duration_ms) AS min_ms,
             max(duration_ms) AS max_ms, round(avg(duration_ms), 6) AS mean_ms FROM tm GROUP BY 1, 2""",
}
