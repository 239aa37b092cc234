"""DuckDB SQL with the same meaning as each named query."""

from __future__ import annotations

from safetylake.schemas import CASE_FILE_COLUMNS, CASE_FILE_NUMERIC
from safetylake.plans.oracle_cases import CASE_BODIES, FULL
from safetylake.plans.oracle_views import SPACES, sql_ratio, sql_term, with_views

V = "pipeline@0.2"

SQL_NORMAL_PT = f"regexp_replace({sql_term('term')}, '{SPACES}+', ' ', 'g')"
SQL_PRODUCT = "upper(trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')))"
SQL_SEX = (
    "CASE WHEN lower({0}) IN ('m', 'male') THEN 'male' WHEN lower({0}) IN ('f', 'female') THEN 'female' "
    "ELSE 'unknown' END"
)
DEMOGRAPHICS = f"""
    SELECT x.vaers_id, {SQL_SEX.format("json_extract_string(extracted, '$.patient.sex')")} AS x_sex,
           {SQL_SEX.format('c.sex')} AS gt_sex,
           TRY_CAST(json_extract_string(extracted, '$.patient.age_years') AS DOUBLE) AS x_age, c.age_yrs AS gt_age
    FROM fx_extracted x JOIN fx_cases c ON c.vaers_id = x.vaers_id"""

STATUS = """CASE agent_name WHEN 'triage' THEN 'extracting' WHEN 'extraction' THEN 'coding'
    WHEN 'coding' THEN 'assessing' WHEN 'assessment' THEN 'drafting' WHEN 'narrative_qc' THEN 'in_review'
    ELSE 'received' END"""
STATUS_LOG = f"""
    SELECT vaers_id, created_at AS updated_at, event_id AS event_key, {STATUS} AS current_status,
           run_id AS current_run_id, confidence AS overall_confidence, CAST(NULL AS VARCHAR) AS assigned_reviewer
    FROM fx_steps"""
REVIEW_LOG = """
    SELECT vaers_id, reviewed_at, review_id,
           CASE action WHEN 'approve' THEN 'finalized' WHEN 'reject' THEN 'failed' ELSE 'in_review' END,
           run_id, NULL, reviewer_id
    FROM fx_reviews"""


def status_fold(log: str) -> str:
    return f"""
    SELECT vaers_id, arg_max(current_status, row(updated_at, event_key)) AS current_status,
           arg_max(current_run_id, row(updated_at, event_key)) AS current_run_id,
           arg_max(overall_confidence, row(updated_at, event_key)) FILTER (overall_confidence IS NOT NULL) AS overall_confidence,
           arg_max(assigned_reviewer, row(updated_at, event_key)) FILTER (assigned_reviewer IS NOT NULL) AS assigned_reviewer,
           max(updated_at) AS updated_at,
           (arg_max(overall_confidence, row(updated_at, event_key)) FILTER (overall_confidence IS NOT NULL)) < 0.75 AS hitl_required
    FROM ({log}) GROUP BY vaers_id"""


BODIES: dict[str, str] = {
    "product_scope": "SELECT * FROM scope",
    "in_scope_cases": "SELECT * FROM scope_cases",
    "pt_dictionary": "SELECT * FROM dictionary",
    "demo_slice": "SELECT * FROM sliced",
    "foundation_counts": """
        SELECT (SELECT count(*) FROM scope WHERE in_scope) AS in_scope_products,
               (SELECT count(*) FROM dictionary) AS meddra_pts, (SELECT count(*) FROM sliced) AS demo_slice_cases""",
    "pt_list": "SELECT pt_term, occurrence_count FROM dictionary ORDER BY occurrence_count DESC, pt_term",
    "case_pick": "SELECT * FROM sliced ORDER BY vaers_id LIMIT 200",
    "symptoms_long": "SELECT * FROM long_terms",
    "gt_pt": "SELECT * FROM human_terms",
    "gt_case": "SELECT * FROM truth",
    "gt_seriousness": """
        SELECT vaers_id, serious, array_to_string(list_filter([
                   CASE WHEN died THEN 'death' END, CASE WHEN life_threatening THEN 'life_threatening' END,
                   CASE WHEN hospitalized THEN 'hospitalization' END, CASE WHEN disabled THEN 'disability' END,
                   CASE WHEN birth_defect THEN 'congenital_anomaly' END], lambda c: c IS NOT NULL), ',') AS criteria_met
        FROM truth""",
    "eval_case": "SELECT * FROM evaluated",
    "eval_dashboard": "SELECT * FROM dashboard",
    "eval_extraction": "SELECT * FROM compared_flags",
    "extraction_scorecard": """
        SELECT count(*) AS n_cases, round(avg(CASE WHEN sex_match THEN 1.0 ELSE 0.0 END), 4) AS sex_accuracy,
               round(avg(CASE WHEN age_match THEN 1.0 ELSE 0.0 END), 4) AS age_accuracy,
               round(avg(CASE WHEN onset_match THEN 1.0 ELSE 0.0 END), 4) AS onset_accuracy,
               round(corr(x_n_events, gt_n_pts), 4) AS event_count_corr
        FROM compared_flags""",
    "coding_scorecard": f"""
        SELECT pipeline_version, n_cases, mean_precision, mean_recall, mean_coding_f1
        FROM dashboard WHERE pipeline_version = '{V}'""",
    "worst_cases": f"""
        SELECT vaers_id, tp, fp, fn, round(f1, 3) AS f1 FROM evaluated WHERE pipeline_version = '{V}'
        ORDER BY evaluated.f1 ASC NULLS FIRST, vaers_id, run_id LIMIT 20""",
    "full_scorecard": f"""
        SELECT pipeline_version, n_cases, mean_coding_f1, seriousness_accuracy
        FROM dashboard WHERE pipeline_version = '{V}'""",
    "causality_distribution": f"""
        SELECT json_extract_string(causality, '$.category') AS category, count(*) AS n
        FROM fx_output WHERE pipeline_version = '{V}' AND causality IS NOT NULL GROUP BY 1""",
    "coding_prf": f"""
        SELECT run, tp, fp, fn, {sql_ratio('tp', 'tp + fp')} AS precision, {sql_ratio('tp', 'tp + fn')} AS recall,
               {sql_ratio('2 * tp', '2 * tp + fp + fn')} AS f1
        FROM (SELECT run, count(*) FILTER (p AND g) AS tp, count(*) FILTER (p AND NOT g) AS fp,
                     count(*) FILTER (g AND NOT p) AS fn
              FROM (SELECT run, {SQL_NORMAL_PT} AS normal, bool_or(side = 'p') AS p, bool_or(side = 'g') AS g
                    FROM (SELECT vaers_id || '|' || run_id AS run, unnest(coded_pts) AS term, 'p' AS side FROM fx_output
                          UNION ALL
                          SELECT run, pt_term, 'g' FROM (SELECT DISTINCT vaers_id, vaers_id || '|' || run_id AS run FROM fx_output)
                          JOIN long_terms USING (vaers_id))
                    GROUP BY run, normal)
              GROUP BY run)""",
    "normalize_pt": f"""
        SELECT term, {SQL_NORMAL_PT} AS normal, count(*) AS n
        FROM (SELECT unnest(coded_pts) AS term FROM fx_output) GROUP BY 1, 2""",
    "sex_match": f"SELECT vaers_id, x_sex, gt_sex, x_sex = gt_sex AS sex_match FROM ({DEMOGRAPHICS})",
    "age_match": f"SELECT vaers_id, x_age, gt_age, abs(x_age - gt_age) <= 1 AS age_match FROM ({DEMOGRAPHICS})",
    "normalize_product": f"""
        SELECT vax_name, {SQL_PRODUCT.format('vax_name')} AS normal, count(*) AS n FROM fx_vax GROUP BY 1, 2""",
    "product_recall": f"""
        SELECT w.vaers_id, CAST(count(*) AS BIGINT) AS n_products,
               CAST(count(*) FILTER (len(list_filter(coalesce(names, []),
                   lambda e: contains(e, w.normal) OR contains(w.normal, e))) > 0) AS BIGINT) AS n_found,
               CAST(count(*) FILTER (len(list_filter(coalesce(names, []),
                   lambda e: contains(e, w.normal) OR contains(w.normal, e))) > 0) AS DOUBLE) / count(*) AS recall
        FROM (SELECT vaers_id, {SQL_PRODUCT.format('vax_name')} AS normal FROM fx_vax) w
        LEFT JOIN (SELECT vaers_id, list(DISTINCT CASE WHEN vax_dose_series = '1' THEN 'NOT NAMED'
                                 WHEN CAST(vaers_id AS BIGINT) % 3 = 0 THEN vax_type
                                 ELSE {SQL_PRODUCT.format('vax_name')} END) AS names
                   FROM fx_vax GROUP BY vaers_id) x
          ON x.vaers_id = w.vaers_id
        GROUP BY w.vaers_id""",
    "case_exposure": "SELECT * FROM exposure",
    "case_event": "SELECT * FROM case_events",
    "signal_cells": "SELECT * FROM cells",
    "signal_metrics": "SELECT * FROM metrics",
    "signal_query": """
        SELECT * FROM metrics WHERE a >= 100 AND contains(event_pt, 'G')
        ORDER BY ror DESC NULLS LAST, event_pt LIMIT 40""",
    "signal_by_scope": "SELECT * FROM scope_metrics",
    "signal_scope_query": """
        SELECT event_pt, a, b, c, d, n_total, prr, ror, signal_flag FROM scope_metrics WHERE product_scope = 'PROMO' AND a >= 2
        ORDER BY a DESC, event_pt LIMIT 40""",
    "signal_rows": """
        SELECT event_pt, a, CAST(0 AS BIGINT) AS b, CAST(0 AS BIGINT) AS c, CAST(0 AS BIGINT) AS d,
               CAST(0 AS BIGINT) AS n_total, prr, CAST(NULL AS DOUBLE) AS ror, coalesce(signal_flag, FALSE) AS signal_flag
        FROM metrics""",
    "screen_requests": """
        SELECT *, reason = 'ok' AS ok, CASE WHEN reason = 'ok' THEN
                   CASE WHEN row_limit IS NULL OR row_limit < 1 THEN 100 ELSE row_limit END END AS safe_limit
        FROM (SELECT *, CASE WHEN n_statements <> 1 THEN 'one statement per request'
                             WHEN lower(operation) <> 'select' THEN 'only a read is allowed'
                             WHEN lower(trim(source)) <> 'signal_metrics' THEN 'source is not on the allowed list'
                             WHEN metric NOT IN ('prr', 'ror', 'a', 'c', 'n_total') THEN 'unknown metric'
                             ELSE 'ok' END AS reason
              FROM (SELECT event_id AS request_id,
                           (['signal_metrics', ' Signal_Metrics ', 'case_output', 'signal_metrics', 'signal_metrics'])[event_id % 5 + 1] AS source,
                           (['select', 'SELECT', 'delete', 'select', 'drop', 'select', 'insert'])[event_id % 7 + 1] AS operation,
                           (['prr', 'ror', 'a', 'speed', 'c', 'n_total'])[event_id % 6 + 1] AS metric,
                           CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END AS n_statements,
                           CASE WHEN event_id % 4 <> 0 THEN event_id % 250 - 5 END AS row_limit
                    FROM events))""",
    "latest_run": "SELECT vaers_id, run_id, pipeline_version, created_at FROM latest",
    "review_queue": """
        SELECT vaers_id, run_id, pipeline_version, overall_confidence, narrative,
               array_to_string(coded_pts, '|') AS coded_pts, seriousness, created_at
        FROM latest l WHERE hitl_required
          AND run_id NOT IN (SELECT run_id FROM fx_reviews WHERE action IN ('approve', 'reject'))""",
    "case_full": """
        SELECT r.vaers_id, r.symptom_text, t.age_yrs, t.sex, t.serious AS gt_serious, t.n_coded_pts, l.run_id,
               l.pipeline_version, CAST(NULL AS VARCHAR) AS extracted, array_to_string(l.coded_pts, '|') AS coded_pts,
               l.seriousness, l.causality, l.narrative, l.overall_confidence, l.hitl_required, e.f1 AS coding_f1,
               e.precision AS coding_precision, e.recall AS coding_recall, e.seriousness_match
        FROM fx_cases r LEFT JOIN truth t ON t.vaers_id = r.vaers_id
        LEFT JOIN latest l ON l.vaers_id = r.vaers_id LEFT JOIN evaluated e ON e.run_id = l.run_id""",
    "case_status": status_fold(STATUS_LOG),
    "open_cases": f"SELECT * FROM ({status_fold(STATUS_LOG + ' UNION ALL ' + REVIEW_LOG)}) WHERE current_status = 'in_review'",
    "case_progress": f"SELECT vaers_id, event_id, CAST(seq AS BIGINT) AS seq, agent_name, {STATUS} AS status, confidence, created_at AS ts FROM fx_steps",
}


LATIN1 = "regexp_replace(symptom_text, '[^\\x{0}-\\x{FF}]', '?', 'g')"
USED = "recvdate state age_yrs sex symptom_text died l_threat hospital disable recovd vax_date onset_date numdays birth_defect".split()


def _raw_columns() -> str:
    columns = []
    for name in CASE_FILE_COLUMNS:
        if name == "symptom_text":
            columns.append(f"{LATIN1} AS symptom_text")
        elif name in USED or name == "vaers_id":
            columns.append(name)
        else:
            columns.append(f"CAST(NULL AS {'DOUBLE' if name in CASE_FILE_NUMERIC else 'VARCHAR'}) AS {name}")
    return ", ".join(columns)


STEPS = "SELECT event_id, run_id, vaers_id, CAST(seq AS BIGINT) AS seq, agent_name, confidence, output, created_at FROM fx_steps"
FAULTY = """
    SELECT o_orderkey AS case_key, CASE WHEN o_orderkey % 47 = 0 THEN 'not json' ELSE
           '{"seriousness":{"serious":' || CASE WHEN o_orderkey % 23 = 0 THEN '"maybe"' ELSE 'true' END || ',"criteria_met":['
           || CASE o_orderkey % 5 WHEN 0 THEN '"death"' WHEN 1 THEN '"death","hospitalization"' WHEN 2 THEN '"unheard_of","death"' ELSE '' END
           || ']},"causality":{"method":"' || CASE WHEN o_orderkey % 31 = 0 THEN 'guess' ELSE 'WHO-UMC' END || '","category":"'
           || (['certain', 'probable', 'possible', 'unlikely', 'conditional', 'surely'])[o_orderkey % 6 + 1]
           || '","score":' || CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE '5' END
           || CASE WHEN o_orderkey % 37 <> 0 THEN ',"rationale":"r"' ELSE '' END || '},"confidence":'
           || CASE WHEN o_orderkey % 41 = 0 THEN '1.7' ELSE '0.8' END || CASE WHEN o_orderkey % 43 = 0 THEN ',"extra":1' ELSE '' END || '}' END AS output
    FROM orders"""
FAULTS = """list_sort(list_filter([
    CASE WHEN json_type(j, '$.seriousness.serious') <> 'BOOLEAN' THEN 'seriousness.serious: not a truth value' END,
    CASE WHEN len(list_filter(CAST(json_extract_string(j, '$.seriousness.criteria_met[*]') AS VARCHAR[]), lambda c: NOT list_contains(
        ['death', 'life_threatening', 'hospitalization', 'disability', 'congenital_anomaly', 'other_medically_important'], c))) > 0
        THEN 'seriousness.criteria_met[]: not in list' END,
    CASE WHEN json_extract_string(j, '$.causality.method') NOT IN ('WHO-UMC', 'Naranjo') THEN 'causality.method: not in list' END,
    CASE WHEN json_extract_string(j, '$.causality.category') NOT IN ('certain', 'probable', 'possible', 'unlikely', 'conditional',
        'unassessable') THEN 'causality.category: not in list' END,
    CASE WHEN json_type(j, '$.causality.rationale') IS NULL THEN 'causality.rationale: missing' END,
    CASE WHEN CAST(json_extract_string(j, '$.confidence') AS DOUBLE) NOT BETWEEN 0 AND 1 THEN 'confidence: out of range' END,
    CASE WHEN list_contains(json_keys(j), 'extra') THEN 'extra: unknown field' END], lambda e: e IS NOT NULL))"""

BODIES.update({
    "csv_ingest": "SELECT vaers_id, " + ", ".join(
        f"{LATIN1} AS symptom_text" if c == "symptom_text" else f"CAST({c} AS VARCHAR) AS {c}" for c in USED
    ) + " FROM fx_cases",
    "conform_raw": f"SELECT {_raw_columns()}, 'batch-1' AS _load_batch_id FROM fx_cases",
    "load_counts": """
        SELECT 'raw_vaers_data' AS table_name, count(*) AS n, 'batch-1' AS batch_id FROM fx_cases
        UNION ALL SELECT 'raw_vaers_vax', count(*), 'batch-1' FROM fx_vax
        UNION ALL SELECT 'raw_vaers_symptoms', count(*), 'batch-1' FROM fx_symptoms""",
    "audit_append": STEPS,
    "register_views": """
        SELECT vax_name, count(*) AS n, 3 AS n_views FROM fx_vax JOIN scope USING (vax_name) GROUP BY vax_name""",
    "validate_contract": f"""
        SELECT case_key, errors = '' AS valid, errors
        FROM (SELECT case_key, CASE WHEN NOT json_valid(output) THEN 'not JSON' ELSE array_to_string({FAULTS}, '|') END AS errors
              FROM (SELECT *, CASE WHEN json_valid(output) THEN CAST(output AS JSON) END AS j FROM ({FAULTY})))""",
    "validate_stages": """
        SELECT o_orderkey AS case_key, c.contract, coalesce(errors, '') = '' AS valid, coalesce(errors, '') AS errors
        FROM (SELECT o_orderkey, o_orderkey % 7 AS stage, o_orderkey // 7 AS round FROM orders)
        JOIN (VALUES (0, 'triage', 6), (1, 'extraction', 6), (2, 'coding', 5), (3, 'assessment', 4), (4, 'narrative_qc', 5), (5, 'signal', 5),
                     (6, 'assembled_case', 5)) c(stage, contract, rounds) USING (stage)
        LEFT JOIN (VALUES
          ('triage', 1, 'priority: not in list'), ('triage', 2, 'confidence: out of range'), ('triage', 3, 'seriousness_screen.serious: missing'),
          ('triage', 4, 'seriousness_screen.criteria_flagged[]: not in list'), ('triage', 5, 'valid: not a truth value'),
          ('extraction', 1, 'case.patient.sex: not in list'), ('extraction', 2, 'case.days_to_onset: not whole'),
          ('extraction', 3, 'case.events[].outcome: not in list'), ('extraction', 4, 'case.products[].name: missing'),
          ('extraction', 5, 'case.patient.age_years: not a number'),
          ('coding', 1, 'result.coded[].meddra_pt: not text'), ('coding', 2, 'result.coded[].confidence: out of range'),
          ('coding', 3, 'result.uncoded: not a list'), ('coding', 4, 'result: missing|results: unknown field'),
          ('assessment', 1, 'seriousness.criteria_met[]: null'), ('assessment', 2, 'causality.method: not in list'),
          ('assessment', 3, 'causality.rationale: missing'),
          ('narrative_qc', 1, 'qc_flags[].severity: not in list'), ('narrative_qc', 2, 'completeness.completeness_score: out of range'),
          ('narrative_qc', 3, 'narrative: missing'), ('narrative_qc', 4, 'qc_flags[].more: unknown field'),
          ('signal', 1, 'results[].event_pt: missing'), ('signal', 2, 'results[].a: null'), ('signal', 3, 'summary: not text'),
          ('signal', 4, 'caveat: unknown field'),
          ('assembled_case', 1, 'coded_pts: missing'), ('assembled_case', 2, 'vaers_id: not text'),
          ('assembled_case', 3, 'extracted.products[].role: not in list'), ('assembled_case', 4, 'overall_confidence: out of range')
        ) e(contract, fault, errors) ON e.contract = c.contract AND e.fault = round % rounds""",
    "failed_cases": """
        SELECT vaers_id, 'extraction' AS stage, CASE WHEN contains(narrative, 'fatal') THEN 'unreadable report'
               ELSE 'contract: confidence: out of range' END AS error
        FROM fx_narratives WHERE contains(narrative, 'fatal') OR contains(narrative, 'Life-threatening')""",
    "predicted_run": f"""
        SELECT * FROM (WITH told AS (
          SELECT run_id, vaers_id, narrative, contains(narrative, 'Congenital') AS unread, contains(narrative, 'Left disabled') AS broken,
                 regexp_extract(narrative, 'Events: ([^.]*)\\.', 1) AS listed,
                 regexp_matches(narrative, 'Symptoms began \\d+ days') AS timed FROM read_cases),
        events AS (
          SELECT run_id, i, string_split(listed, '; ')[i] AS verbatim
          FROM (SELECT run_id, listed, unnest(range(1, len(string_split(listed, '; ')) + 1)) AS i FROM told WHERE listed <> 'none stated')),
        picked AS (
          SELECT run_id, string_agg(pt_term, '|' ORDER BY i) AS coded_pts, count(*) FILTER (pt_term IS NULL) AS n_open
          FROM events LEFT JOIN (FROM term_top WHERE rank = 1) USING (verbatim) GROUP BY run_id),
        done AS (
          SELECT told.*, coalesce(coded_pts, '') AS coded_pts, coded_pts IS NOT NULL AS serious, coalesce(n_open, 0) AS n_open,
                 least(CASE WHEN coded_pts IS NULL THEN 0.7::DOUBLE ELSE 0.8::DOUBLE END, 0.85::DOUBLE) AS overall_confidence
          FROM told LEFT JOIN picked USING (run_id) WHERE NOT unread AND NOT broken)
        SELECT run_id, vaers_id, '{FULL}' AS pipeline_version,
               '{{"triage_model":"stand-in-triage","extraction_model":"stand-in-extraction","coding_model":"stand-in-coding","assessment_model":"stand-in-assessment","narrative_model":"stand-in-narrative_qc"}}' AS model_config,
               'completed' AS status, overall_confidence, overall_confidence < 0.75 OR n_open > 0 OR timed AS hitl_required,
               coded_pts, serious, CASE WHEN timed THEN 'possible' ELSE 'unassessable' END AS category,
               CASE WHEN serious THEN 'A serious case.' ELSE 'A case.' END AS narrative,
               'stand-in-assessment,stand-in-coding,stand-in-extraction,stand-in-narrative_qc,stand-in-triage' AS models,
               CAST(length('Report ' || vaers_id || ':') + 2 + length(narrative) AS BIGINT) AS triage_tokens,
               CAST(NULL AS VARCHAR) AS stage, CAST(NULL AS VARCHAR) AS error
        FROM done
        UNION ALL
        SELECT run_id, vaers_id, '{FULL}', CASE WHEN unread THEN '{{"triage_model":"stand-in-triage"}}' ELSE '{{"extraction_model":"stand-in-extraction"}}' END,
               'failed', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN unread THEN 'triage' ELSE 'extraction' END,
               CASE WHEN unread THEN 'unreadable report' ELSE 'contract: confidence: out of range' END
        FROM told WHERE unread OR broken)""",
    "active_versions": f"""
        SELECT d.*, v.deployed_at, TRUE AS active
        FROM dashboard d JOIN (SELECT pipeline_version, min(created_at) AS deployed_at FROM fx_output GROUP BY 1) v
          ON v.pipeline_version = d.pipeline_version WHERE d.pipeline_version = '{V}'""",
    "stream_audit": """
        SELECT * EXCLUDE (n) REPLACE (CASE WHEN agent_name = 'triage' THEN
                   '{"valid":true,"missing_criteria":[],"seriousness_screen":{"serious":false,"criteria_flagged":[]},"priority":"'
                   || CASE WHEN n % 10 = 0 THEN 'soon' ELSE 'standard' END || '","confidence":'
                   || CASE WHEN n % 7 = 0 THEN '7' ELSE '0.5' END || '}' ELSE output END AS output),
               NOT (agent_name = 'triage' AND (n % 10 = 0 OR n % 7 = 0)) AS kept
        FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS n FROM (""" + STEPS + "))",
    "stream_case_status": BODIES["case_status"],
    "stream_intake": """
        SELECT run_id, vaers_id, array_to_string(list_transform(coded, lambda c: c.meddra_pt), '|') AS coded_pts,
               CAST(to_json({'serious': serious, 'criteria_met': criteria}) AS VARCHAR) AS seriousness, written AS narrative,
               overall_confidence, hitl_required
        FROM full_cases WHERE length(full_cases.narrative) >= 120 AND vaers_id IN (FROM scope_cases)""",
})


# Whole runs scored against the human codes: the runs take the place of the given outputs.
RUN_OUTPUT = f"""
    SELECT run_id, vaers_id, '{FULL}' AS pipeline_version, list_transform(coded, lambda c: c.meddra_pt) AS coded_pts,
           CAST(to_json({{'serious': serious, 'criteria_met': criteria}}) AS VARCHAR) AS seriousness,
           CAST(to_json({{'category': category}}) AS VARCHAR) AS causality FROM full_cases"""
SLICE = "SELECT vaers_id, recvdate AS received_date, symptom_text AS narrative FROM sliced"


def oracle_sql() -> dict[str, str]:
    queries = {name: with_views(body) for name, body in {**BODIES, **CASE_BODIES}.items()}
    queries["scored_run"] = with_views(
        """SELECT d.*, category, n FROM dashboard d CROSS JOIN
           (SELECT json_extract_string(causality, '$.category') AS category, count(*) AS n FROM fx_output GROUP BY 1)""",
        fx_output=RUN_OUTPUT,
    )
    queries["slice_run"] = with_views(
        "SELECT r.*, f.triage_rationale, f.written AS narrative FROM results r JOIN full_cases f ON f.run_id = r.run_id",
        fx_narratives=SLICE,
    )
    return queries
