"""DuckDB text of the test views and of the shared steps the oracle queries build on."""

from __future__ import annotations

import re

from safetylake.plans.oracle_cases import CASE_VIEWS

SPACES = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACES}+|{SPACES}+$', '', 'g')"


def sql_term(c: str) -> str:
    return f"upper({sql_strip(c)})"


def sql_ratio(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / ({den}) END)"


def sql_date(c: str) -> str:
    return f"CAST(try_strptime({c}, '%m%d%Y') AS DATE)"


def any_of(flags: list[str]) -> str:
    return " OR ".join(f"{f} = 'Y'" for f in flags)


FLAGS = ["died", "l_threat", "hospital", "disable", "birth_defect"]
NO_OR_BLANK = "CASE WHEN o_orderkey % 3 = 0 THEN 'N' END"
ONSET = "(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER))"

VIEWS: dict[str, str] = {
    "fx_lines": """
        SELECT li.*, pa.p_name, pa.p_brand, pa.p_type, pa.p_type || ' (' || pa.p_brand || ')' AS product
        FROM lineitem li JOIN part pa ON pa.p_partkey = li.l_partkey""",
    "fx_cases": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS vaers_id,
               strftime(o_orderdate, '%m%d%Y') AS recvdate,
               n_name AS state,
               CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey % 100 AS DOUBLE) END AS age_yrs,
               CASE WHEN o_custkey % 5 < 2 THEN 'M' WHEN o_custkey % 5 < 4 THEN 'F' END AS sex,
               text AS symptom_text,
               CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'Y' ELSE {NO_OR_BLANK} END AS died,
               CASE WHEN o_orderkey % 17 = 0 THEN 'Y' ELSE {NO_OR_BLANK} END AS l_threat,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' WHEN o_orderpriority = '2-HIGH' THEN 'N'
                    ELSE {NO_OR_BLANK} END AS hospital,
               CASE WHEN o_orderkey % 29 = 0 THEN 'Y' ELSE 'N' END AS disable,
               CASE WHEN o_orderkey % 4 = 0 THEN 'Y' WHEN o_orderkey % 4 = 1 THEN 'N' END AS recovd,
               strftime(o_orderdate, '%m%d%Y') AS vax_date,
               CASE WHEN o_orderkey % 13 = 0 THEN '02302024' ELSE strftime({ONSET}, '%m%d%Y') END AS onset_date,
               CAST(o_orderkey % 30 AS DOUBLE) AS numdays,
               CASE WHEN o_orderkey % 101 = 0 THEN 'Y' ELSE {NO_OR_BLANK} END AS birth_defect
        FROM orders
        LEFT JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN documents ON doc_id = o_orderkey""",
    "fx_vax": """
        SELECT CAST(l_orderkey AS VARCHAR) AS vaers_id, p_type AS vax_type, p_brand AS vax_manu,
               CAST(l_suppkey AS VARCHAR) AS vax_lot, CAST(l_linenumber AS VARCHAR) AS vax_dose_series,
               product AS vax_name
        FROM fx_lines""",
    "fx_symptoms": "SELECT CAST(l_orderkey AS VARCHAR) AS vaers_id, "
    + ", ".join(
        f"max(CASE WHEN l_linenumber % 5 = {i - 1} THEN p_name END) AS symptom{i}, "
        f"max(CASE WHEN l_linenumber % 5 = {i - 1} THEN CAST(24 + l_suppkey % 3 AS DOUBLE) END) AS symptomversion{i}"
        for i in range(1, 6)
    )
    + " FROM fx_lines GROUP BY l_orderkey, l_suppkey % 2",
    "fx_listed": """
        SELECT l_orderkey, v, pt, count(*) AS n
        FROM (SELECT l_orderkey, l_returnflag, v,
                     CASE WHEN p_type = 'PROMO' AND l_orderkey % 97 = 0 THEN 'rare promo event'
                          WHEN l_tax >= 0.07 AND (p_type = 'PROMO' OR l_orderkey % 50 = 0) THEN 'promo reaction'
                          WHEN l_tax >= 0.07 THEN lower(p_type) || ' reaction'
                          WHEN l_linenumber = 7 AND l_discount = 0 THEN ' '
                          ELSE ' ' || p_name END AS pt
              FROM fx_lines, (VALUES (1), (2)) runs(v))
        WHERE (v = 1 AND l_returnflag <> 'R') OR (v = 2 AND l_returnflag <> 'A')
        GROUP BY l_orderkey, v, pt""",
    "fx_output": """
        SELECT CAST(o_orderkey AS VARCHAR) || '-r' || runs.v AS run_id,
               CAST(o_orderkey AS VARCHAR) AS vaers_id,
               'pipeline@0.' || runs.v AS pipeline_version,
               coalesce(terms, []) AS coded_pts,
               '{"serious":' || CASE WHEN o_orderkey % 10 = 0 OR o_orderpriority = '1-URGENT' THEN 'true' ELSE 'false' END
                   || ',"criteria_met":[]}' AS seriousness,
               '{"method":"WHO-UMC","category":"' ||
                   (['certain','probable','possible','unlikely','conditional','unassessable'])[o_orderkey % 6 + 1]
                   || '"}' AS causality,
               'Run ' || runs.v || ' of case ' || o_orderkey AS narrative,
               CAST(50 + o_orderkey % 50 AS DOUBLE) / 100 AS overall_confidence,
               o_orderkey % 50 < 25 AS hitl_required,
               o_orderdate + to_days(runs.v) AS created_at
        FROM orders CROSS JOIN (VALUES (1), (2)) runs(v)
        LEFT JOIN (SELECT l_orderkey, v, list(pt ORDER BY pt) AS terms
                   FROM (SELECT l_orderkey, v, pt FROM fx_listed
                         UNION ALL SELECT l_orderkey, v, pt FROM fx_listed WHERE n > 1)
                   GROUP BY l_orderkey, v) t
               ON t.l_orderkey = o_orderkey AND t.v = runs.v""",
    "fx_extracted": f"""
        SELECT CAST(o_orderkey AS VARCHAR) || '-r1' AS run_id, CAST(o_orderkey AS VARCHAR) AS vaers_id,
               '{{"patient":{{"age_years":' ||
               CASE WHEN o_orderkey % 9 = 0 THEN 'null' ELSE CAST(o_custkey % 100 + o_orderkey % 3 AS VARCHAR) END ||
               ',"sex":"' ||
               CASE WHEN o_orderkey % 8 = 0 THEN 'unknown' WHEN o_custkey % 5 < 2 THEN 'male'
                    WHEN o_custkey % 5 < 4 THEN 'female' ELSE 'unknown' END ||
               '"}},"onset_date":' ||
               CASE WHEN o_orderkey % 13 = 0 THEN 'null' ELSE '"' || strftime({ONSET}, '%Y-%m-%d') || '"' END ||
               ',"events":[' || coalesce(items, '') || ']}}' AS extracted
        FROM orders
        LEFT JOIN (SELECT l_orderkey, array_to_string(
                          list_transform(range(1, count(DISTINCT l_linenumber) + 1),
                                         lambda i: '{{"verbatim":"e' || i || '"}}'), ',') AS items
                   FROM lineitem GROUP BY l_orderkey) e ON e.l_orderkey = o_orderkey""",
    "fx_reviews": """
        SELECT 'rev-' || o_orderkey AS review_id, o_orderkey || '-r2' AS run_id,
               CAST(o_orderkey AS VARCHAR) AS vaers_id, 'reviewer-' || (o_orderkey % 5) AS reviewer_id,
               CASE WHEN o_orderkey % 7 = 0 THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'approve' ELSE 'reject' END)
                    WHEN o_orderkey % 2 = 0 THEN 'edit' ELSE 'escalate' END AS action,
               o_orderdate + to_days(5) AS reviewed_at
        FROM orders""",
    "fx_steps": """
        SELECT 'evt-' || event_id AS event_id, 'run-' || user_id AS run_id, CAST(user_id AS VARCHAR) AS vaers_id,
               CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
                               WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS seq,
               CASE event_type WHEN 'signup' THEN 'triage' WHEN 'view' THEN 'extraction' WHEN 'click' THEN 'coding'
                               WHEN 'purchase' THEN 'assessment' WHEN 'error' THEN 'narrative_qc' END AS agent_name,
               CAST(event_id % 101 AS DOUBLE) / 100 AS confidence, props AS output, ts AS created_at
        FROM events""",
    "fx_narratives": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS vaers_id, strftime(o_orderdate, '%m%d%Y') AS received_date,
               'A ' || CASE WHEN o_custkey % 11 = 0 THEN '' ELSE (o_custkey % 100) || '-year-old ' END
               || CASE WHEN o_custkey % 5 < 2 THEN 'male' WHEN o_custkey % 5 < 4 THEN 'female' ELSE 'adult' END
               || ' received ' || coalesce(product, 'an unknown product')
               || ' on ' || strftime(o_orderdate, '%Y-%m-%d') || '. '
               || CASE WHEN o_orderkey % 13 = 0 THEN ''
                       WHEN o_orderkey % 53 = 0 THEN 'Onset ' || strftime(CAST(o_orderdate AS DATE) - 3, '%Y-%m-%d') || '. '
                       ELSE 'Onset ' || strftime({ONSET}, '%Y-%m-%d') || '. ' END
               || CASE WHEN o_orderkey % 19 = 0 THEN 'Symptoms began '
                       || (o_orderkey % 30 + CASE WHEN o_orderkey % 38 = 0 THEN 1 ELSE 0 END)
                       || ' days after the dose. ' ELSE '' END
               || 'Events: ' || coalesce(names, 'none stated') || '.'
               || CASE o_orderkey % 5 WHEN 0 THEN ' Reported by a nurse.' WHEN 1 THEN ' Reported by a Physician.'
                       WHEN 2 THEN ' The patient called.' ELSE '' END
               || CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN ' The outcome was fatal.' ELSE '' END
               || CASE WHEN o_orderpriority = '1-URGENT' THEN ' Was hospitalized.' ELSE '' END
               || CASE WHEN o_orderkey % 17 = 0 THEN ' Life-threatening reaction.' ELSE '' END
               || CASE WHEN o_orderkey % 29 = 0 THEN ' Left disabled.' ELSE '' END
               || CASE WHEN o_orderkey % 101 = 0 THEN ' Congenital anomaly noted.' ELSE '' END
               || CASE WHEN o_orderkey % 23 = 0 THEN ' Was not admitted, no birth defect.' ELSE '' END
               || CASE WHEN o_orderkey % 21 = 0 THEN ' Denied hot anvil but felt hot gear.' ELSE '' END
               || CASE WHEN o_orderkey % 25 = 0 THEN ' Has not recovered from hot plate.' ELSE '' END
               || CASE WHEN o_orderkey % 9 = 0 THEN ' Then got ' || coalesce(last, 'the same') || ' as second dose intramuscularly on '
                       || strftime(CAST(o_orderdate AS DATE) + 40, '%Y-%m-%d') || ' and felt hot gear from '
                       || strftime(CAST(o_orderdate AS DATE) + 41, '%-m/%-d/%Y') || ', hot bolt resolved while hot plate is ongoing.' ELSE '' END
               || CASE WHEN o_orderkey % 6 = 0 THEN ' History: asthma; diabetes.' ELSE '' END
               || CASE WHEN o_orderkey % 8 = 0 THEN ' Allergies: penicillin.' ELSE '' END
               || CASE WHEN o_orderkey % 10 = 0 THEN ' Concomitant medications: aspirin; metformin.' ELSE '' END
               AS narrative
        FROM orders
        LEFT JOIN (SELECT l_orderkey, min(product) AS product, max(product) AS last, string_agg(DISTINCT p_name, '; ' ORDER BY p_name) AS names
                   FROM fx_lines GROUP BY l_orderkey) f ON f.l_orderkey = o_orderkey""",
    "scope": """
        SELECT 'PROMO family' AS scope_label, vax_type, vax_name, min(vax_manu) AS vax_manu, TRUE AS in_scope,
               'auto-derived' AS notes
        FROM fx_vax WHERE vax_type = 'PROMO' GROUP BY vax_type, vax_name""",
    "scope_cases": """
        SELECT DISTINCT vaers_id FROM fx_vax WHERE vax_name IN (SELECT vax_name FROM scope WHERE in_scope)""",
    "long_terms": " UNION ALL ".join(
        f"SELECT vaers_id, symptom{i} AS pt_term, symptomversion{i} AS meddra_version FROM fx_symptoms "
        f"WHERE {sql_strip(f'symptom{i}')} <> ''"
        for i in range(1, 6)
    ),
    "human_terms": f"SELECT DISTINCT vaers_id, {sql_term('pt_term')} AS pt_term, meddra_version FROM long_terms",
    "dictionary": """
        SELECT pt_term, CAST(min(meddra_version) AS VARCHAR) AS meddra_version, count(*) AS occurrence_count,
               FALSE AS indexed_in_vector_search
        FROM long_terms WHERE vaers_id IN (FROM scope_cases) GROUP BY pt_term""",
    "sliced": """
        SELECT vaers_id, symptom_text, recvdate FROM fx_cases
        WHERE length(symptom_text) >= 200 AND vaers_id IN (FROM scope_cases)""",
    "truth": f"""
        SELECT vaers_id, age_yrs, sex, state, {sql_date('vax_date')} AS vax_date, {sql_date('onset_date')} AS onset_date,
               numdays AS days_to_onset, {sql_date('recvdate')} AS received_date,
               died = 'Y' AS died, l_threat = 'Y' AS life_threatening, hospital = 'Y' AS hospitalized,
               disable = 'Y' AS disabled, birth_defect = 'Y' AS birth_defect, ({any_of(FLAGS)}) AS serious,
               recovd AS recovered,
               coalesce((SELECT count(*) FROM fx_vax x WHERE x.vaers_id = r.vaers_id), 0) AS n_products,
               coalesce((SELECT count(*) FROM human_terms h WHERE h.vaers_id = r.vaers_id), 0) AS n_coded_pts
        FROM fx_cases r""",
    "run_terms": f"""
        SELECT run_id, vaers_id, pipeline_version, json_extract_string(seriousness, '$.serious') = 'true' AS agent_serious,
               list_transform(list_filter(coded_pts, lambda t: t IS NOT NULL), lambda t: {sql_term('t')}) AS mine
        FROM fx_output""",
    "scored_lists": """
        SELECT r.*, theirs,
               CAST(len(list_filter(mine, lambda t: list_contains(theirs, t))) AS BIGINT) AS tp,
               CAST(len(list_filter(mine, lambda t: NOT list_contains(theirs, t))) AS BIGINT) AS fp,
               CAST(len(list_filter(theirs, lambda t: NOT list_contains(mine, t))) AS BIGINT) AS fn
        FROM run_terms r
        JOIN (SELECT vaers_id, list(DISTINCT pt_term) AS theirs FROM human_terms GROUP BY vaers_id) h
          ON h.vaers_id = r.vaers_id""",
    "evaluated": f"""
        SELECT s.run_id, s.vaers_id, s.pipeline_version, tp, fp, fn,
               {sql_ratio('tp', 'tp + fp')} AS precision, {sql_ratio('tp', 'tp + fn')} AS recall,
               {sql_ratio('2 * tp', '2 * tp + fp + fn')} AS f1,
               agent_serious = t.serious AS seriousness_match, agent_serious, t.serious AS gt_serious
        FROM scored_lists s JOIN truth t ON t.vaers_id = s.vaers_id""",
    "dashboard": """
        SELECT pipeline_version, count(*) AS n_cases, round(avg(precision), 4) AS mean_precision,
               round(avg(recall), 4) AS mean_recall, round(avg(f1), 4) AS mean_coding_f1,
               round(avg(CASE WHEN seriousness_match THEN 1.0 ELSE 0.0 END), 4) AS seriousness_accuracy
        FROM evaluated GROUP BY pipeline_version""",
    "compared": """
        SELECT x.run_id, x.vaers_id, lower(json_extract_string(extracted, '$.patient.sex')) AS x_sex,
               TRY_CAST(json_extract_string(extracted, '$.patient.age_years') AS DOUBLE) AS x_age,
               json_extract_string(extracted, '$.onset_date') AS x_onset,
               CAST(json_array_length(extracted, '$.events') AS BIGINT) AS x_n_events,
               CASE t.sex WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' ELSE 'unknown' END AS gt_sex,
               t.age_yrs AS gt_age, strftime(t.onset_date, '%Y-%m-%d') AS gt_onset, t.n_coded_pts AS gt_n_pts
        FROM fx_extracted x JOIN truth t ON t.vaers_id = x.vaers_id""",
    "compared_flags": """
        SELECT *, x_sex = gt_sex AS sex_match, coalesce(abs(x_age - gt_age) <= 1, FALSE) AS age_match,
               x_onset IS NOT NULL AND x_onset = gt_onset AS onset_match
        FROM compared""",
    "exposure": """
        SELECT DISTINCT vaers_id, vaers_id IN (FROM scope_cases) AS is_scope_drug FROM fx_output""",
    "case_events": f"""
        SELECT DISTINCT vaers_id, {sql_term('term')} AS event_pt
        FROM (SELECT vaers_id, unnest(coded_pts) AS term FROM fx_output)
        WHERE {sql_strip('term')} <> ''""",
    "cells": """
        SELECT event_pt, a, (SELECT count(*) FILTER (is_scope_drug) FROM exposure) - a AS b,
               c, (SELECT count(*) FILTER (NOT is_scope_drug) FROM exposure) - c AS d,
               (SELECT count(*) FROM exposure) AS n_total
        FROM (SELECT event_pt, count(*) FILTER (is_scope_drug) AS a, count(*) FILTER (NOT is_scope_drug) AS c
              FROM case_events JOIN exposure USING (vaers_id) GROUP BY event_pt)""",
    "metrics": f"""
        SELECT event_pt, a, b, c, d, n_total, round(raw_prr, 3) AS prr,
               round({sql_ratio('CAST(a AS DOUBLE) * d', 'CAST(b AS DOUBLE) * c')}, 3) AS ror,
               raw_prr >= 2 AND a >= 3 AS signal_flag
        FROM (SELECT *, {sql_ratio(sql_ratio('a', 'a + b'), sql_ratio('c', 'c + d'))} AS raw_prr FROM cells)""",
    "scope_metrics": f"""
        SELECT product_scope, event_pt, a, b, c, d, n_total, round(raw_prr, 3) AS prr,
               round({sql_ratio('CAST(a AS DOUBLE) * d', 'CAST(b AS DOUBLE) * c')}, 3) AS ror,
               raw_prr >= 2 AND a >= 3 AS signal_flag
        FROM (SELECT *, {sql_ratio(sql_ratio('a', 'a + b'), sql_ratio('c', 'c + d'))} AS raw_prr
              FROM (SELECT vax_type AS product_scope, event_pt, count(DISTINCT e.vaers_id) AS a,
                           (SELECT count(DISTINCT v2.vaers_id) FROM fx_vax v2 JOIN fx_output o2 USING (vaers_id) WHERE v2.vax_type = v.vax_type)
                             - count(DISTINCT e.vaers_id) AS b,
                           (SELECT count(*) FROM case_events e2 WHERE e2.event_pt = e.event_pt) - count(DISTINCT e.vaers_id) AS c,
                           (SELECT count(DISTINCT vaers_id) FROM fx_output)
                             - (SELECT count(DISTINCT v2.vaers_id) FROM fx_vax v2 JOIN fx_output o2 USING (vaers_id) WHERE v2.vax_type = v.vax_type)
                             - (SELECT count(*) FROM case_events e2 WHERE e2.event_pt = e.event_pt) + count(DISTINCT e.vaers_id) AS d,
                           (SELECT count(DISTINCT vaers_id) FROM fx_output) AS n_total
                    FROM case_events e JOIN fx_vax v USING (vaers_id) GROUP BY v.vax_type, e.event_pt))""",
    "latest": """
        SELECT * FROM fx_output
        QUALIFY row_number() OVER (PARTITION BY vaers_id ORDER BY created_at DESC, run_id DESC) = 1""",
}


VIEWS.update(CASE_VIEWS)


def with_views(body: str, **replaced: str) -> str:
    """Prefix ``body`` with the views it needs, directly or through other views.

    ``replaced`` gives other text for some views.
    """
    texts = {**VIEWS, **replaced}
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in texts:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(texts[name])
                ordered.append(name)

    visit(body)
    chosen = [f"{name} AS ({texts[name]})" for name in ordered]
    return f"WITH {', '.join(chosen)} {body}" if chosen else body
