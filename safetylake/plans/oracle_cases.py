"""DuckDB text of the case-processing steps, on top of the shared views."""

from __future__ import annotations

from safetylake.operators.mentions import LEXICON

FULL = "pipeline@0.3.0-phase3"
TWO_STAGE = "pipeline@0.2.0-phase2"

WORDS = ", ".join(
    f"('{phrase}','{kind}','{name}')" for kind, names in LEXICON.items() for name, phrases in names.items() for phrase in phrases
)
PHRASE = "trim(regexp_replace(upper({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
DATE = r"(\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4})"
AGE = r"(?i)(?:^|[^\d.])(\d+(?:\.\d+)?)[- ]?(years?|yrs?|months?|mos?|weeks?|wks?|days?)[- ]old\b"
AGE_SHORT = r"(?i)(?:^|[^\d.])(\d+(?:\.\d+)?)[- ]?y(?:\. ?|/)?o\b"
AGED = r"(?i)\baged?[: ]+(\d+(?:\.\d+)?)\b"
NEGATION = r"(?i)\b(?:no|not|nor|without|never|denied|denies|denying)\b"
DENIED = NEGATION + r"(?:[ \t]+[\p{L}\p{N}][\p{L}\p{N}''/-]*){1,4}"
ONGOING = r"(?i)\bnot[ \t]+(?:yet[ \t]+)?(recovered|resolved|subsided|improved|gone|better)\b"
CONTRAST = r"(?i)[ \t]+(but|however|although|except)\b"
AFFIRMED = (
    f"CASE WHEN regexp_matches(narrative, '{NEGATION}') THEN regexp_replace(regexp_replace(regexp_replace("
    f"narrative, '{ONGOING}', '| ongoing', 'g'), '{CONTRAST}', ' | \\1', 'g'), '{DENIED}', ' | ', 'g') ELSE narrative END"
)
ONSET_PATTERN = r"(?i)\bonset\b[^0-9.]*" + DATE


def parsed(c: str) -> str:
    return (
        f"coalesce(CAST(try_strptime({c}, '%Y-%m-%d') AS DATE), CAST(try_strptime({c}, '%m/%d/%Y') AS DATE))"
    )


def items(pattern: str) -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array(regexp_extract(narrative, '{pattern}', 1), '[;,]'), "
        "lambda x: trim(x)), lambda x: x <> '')"
    )


def trigrams(source: str, column: str) -> str:
    """Rows (term, gram, n) of the trigrams of a column."""
    padded = f"(' ' || upper(trim({column})) || ' ')"
    return f"""
        SELECT term, gram, count(*) AS n
        FROM (SELECT {column} AS term, unnest(list_transform(range(1, greatest(length({padded}) - 2, 1) + 1),
                     lambda i: substr({padded}, i, 3))) AS gram FROM (SELECT DISTINCT {column} FROM ({source}))) GROUP BY ALL"""


def vectors_of(grams: str) -> str:
    """Rows (term, slot, weight) of unit vectors; what the model does not hold is slot -1."""
    return f"""
        SELECT term, slot, round(weight / sqrt(sum(weight * weight) OVER (PARTITION BY term)), 9) AS weight
        FROM (SELECT term, coalesce(slot, -1) AS slot,
                     CASE WHEN min(slot) IS NULL THEN sqrt(sum((n * other) ** 2)) ELSE min(n * weight) END AS weight
              FROM {grams} LEFT JOIN vector_model USING (gram), (SELECT round(ln(1.0 + count(*)) + 1, 9) AS other FROM dictionary)
              GROUP BY term, coalesce(slot, -1))"""


def scored(queries: str, terms: str) -> str:
    """Rows (verbatim, pt_term, score) of all pairs of the two tables of vectors."""
    return f"""
        SELECT q.term AS verbatim, t.term AS pt_term, round(coalesce(d.dot, 0) / ((q.length + 1e-9) * (t.length + 1e-9)), 9) AS score
        FROM (SELECT term, sqrt(sum(weight * weight)) AS length FROM {queries} GROUP BY term) q
        CROSS JOIN (SELECT term, sqrt(sum(weight * weight)) AS length FROM {terms} GROUP BY term) t
        LEFT JOIN (SELECT a.term AS q_term, b.term AS t_term, sum(a.weight * b.weight) AS dot
                   FROM {queries} a JOIN {terms} b USING (slot) GROUP BY ALL) d ON d.q_term = q.term AND d.t_term = t.term"""


def cosine(a: str, b: str) -> str:
    return f"""round(list_sum(list_transform(list_zip({a}, {b}), lambda p: CAST(p[1] AS DOUBLE) * p[2]))
        / ((sqrt(list_sum(list_transform({a}, lambda x: CAST(x AS DOUBLE) * x))) + 1e-9)
           * (sqrt(list_sum(list_transform({b}, lambda x: CAST(x AS DOUBLE) * x))) + 1e-9)), 9)"""


def run_id(version: str) -> str:
    return f"sha256(vaers_id || '|{version}|' || received_date || '|' || sha256(narrative))"


def overall(*confidences: str) -> str:
    return f"least({', '.join(confidences)})"


CASE_STRUCT = f"""{{
    'patient': {{'age_years': age_years, 'sex': coalesce(sex, 'unknown')}},
    'products': list_transform(products, lambda p: {{'name': p.name, 'manufacturer': p.maker, 'dose_series': p.dose, 'route': p.route,
        'role': CASE WHEN p.in_scope THEN 'suspect' ELSE 'concomitant' END}}),
    'events': list_transform(events, lambda e: {{'verbatim': e.verbatim, 'onset_date': e.onset_date, 'outcome': e.outcome}}),
    'vaccination_date': strftime(dose, '%Y-%m-%d'), 'onset_date': strftime(onset, '%Y-%m-%d'),
    'days_to_onset': days_to_onset, 'concomitant_meds': meds, 'medical_history': history, 'allergies': allergies}}"""

CASE_VIEWS: dict[str, str] = {
    "voc": f"""
        SELECT phrase, kind, min(name) AS name, bool_or(in_scope) AS in_scope
        FROM (SELECT {PHRASE.format('pt_term')} AS phrase, 'event' AS kind, pt_term AS name, FALSE AS in_scope FROM dictionary
              UNION ALL SELECT DISTINCT {PHRASE.format('vax_name')}, 'product', vax_name,
                     vax_name IN (SELECT vax_name FROM scope WHERE in_scope) FROM fx_vax
              UNION ALL SELECT DISTINCT {PHRASE.format('vax_manu')}, 'maker', vax_manu, FALSE FROM fx_vax
              UNION ALL SELECT phrase, kind, name, FALSE FROM (VALUES {WORDS}) w(phrase, kind, name))
        WHERE phrase <> '' GROUP BY phrase, kind""",
    "tokenised": r"""
        SELECT vaers_id, string_split(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(affirmed,
                   '(^|[^\p{L}\p{N}])(\d{4})-(\d{2})-(\d{2})', '\1 \2D\3D\4 ', 'g'), '(^|[^\p{L}\p{N}])(\d{1,2})/(\d{1,2})/(\d{4})', '\1 \2S\3S\4 ', 'g'),
                   '[.;:!?]+(\s|$)', ' | ', 'g'), '[^\p{L}\p{N}|]+', ' ', 'g')), ' ') AS tokens
        FROM (SELECT vaers_id, """ + AFFIRMED + """ AS affirmed FROM fx_narratives)""",
    "grams": """
        SELECT vaers_id, pos, n, array_to_string(tokens[pos:pos + n - 1], ' ') AS verbatim
        FROM (SELECT vaers_id, tokens, n, unnest(range(1, len(tokens) - n + 2)) AS pos
              FROM tokenised, (SELECT DISTINCT len(string_split(phrase, ' ')) AS n FROM voc))""",
    "found": """
        SELECT vaers_id, kind, name, pos, n, verbatim, in_scope FROM grams JOIN voc ON voc.phrase = upper(verbatim)""",
    "mentioned": """
        SELECT vaers_id, kind, name, min(pos) AS pos, arg_min(verbatim, pos) AS verbatim, bool_or(in_scope) AS in_scope
        FROM found GROUP BY vaers_id, kind, name""",
    "clauses": """
        SELECT vaers_id, pos, token, sum((token = '|')::INT) OVER (PARTITION BY vaers_id ORDER BY pos) AS clause,
               sum((upper(token) IN ('AND', 'THEN', 'WHILE', 'PLUS', 'FOLLOWED'))::INT) OVER (PARTITION BY vaers_id ORDER BY pos) AS part
        FROM (SELECT vaers_id, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS pos FROM tokenised)""",
    "intervals": r"""
        SELECT vaers_id, clause, part, kind, name, pos, n
        FROM (SELECT DISTINCT vaers_id, kind, name, pos, n FROM found
              UNION ALL SELECT vaers_id, 'date', coalesce(strftime(try_strptime(token, '%YD%mD%d'), '%Y-%m-%d'),
                     strftime(try_strptime(token, '%mS%dS%Y'), '%Y-%m-%d')), pos, 1
              FROM clauses WHERE regexp_matches(token, '^(\d{4}D\d{2}D\d{2}|\d{1,2}S\d{1,2}S\d{4})$'))
        JOIN clauses USING (vaers_id, pos) WHERE name IS NOT NULL""",
    "linked": """
        SELECT vaers_id, kind, name, fact, list(value ORDER BY gap, fact_pos, value)[1] AS value
        FROM (SELECT f.vaers_id, f.kind AS fact, f.name AS value, f.pos AS fact_pos, t.kind, t.name,
                     greatest(0, f.pos - t.pos - t.n, t.pos - f.pos - f.n) + 10 * abs(f.part - t.part) AS gap
              FROM intervals f JOIN intervals t ON f.vaers_id = t.vaers_id AND f.clause = t.clause
               AND ((f.kind = 'date' AND t.kind IN ('event', 'product')) OR (f.kind = 'outcome' AND t.kind = 'event')
                    OR (f.kind IN ('dose', 'route', 'maker') AND t.kind = 'product'))
              QUALIFY row_number() OVER (PARTITION BY f.vaers_id, f.kind, f.name, f.pos ORDER BY gap, t.pos, -t.n, t.kind, t.name) = 1)
        GROUP BY ALL""",
    "tied": """
        SELECT vaers_id, kind, name, max(value) FILTER (fact = 'date') AS onset_date, max(value) FILTER (fact = 'outcome') AS outcome,
               max(value) FILTER (fact = 'dose') AS dose, max(value) FILTER (fact = 'route') AS route, max(value) FILTER (fact = 'maker') AS maker
        FROM linked GROUP BY ALL""",
    "mention_lists": """
        SELECT vaers_id,
               list(struct_pack(verbatim := verbatim, name := name, onset_date := onset_date, outcome := outcome) ORDER BY pos, name) FILTER (kind = 'event') AS events,
               list(struct_pack(name := name, in_scope := in_scope, maker := maker, dose := dose, route := route) ORDER BY pos, name) FILTER (kind = 'product') AS products,
               arg_min(name, pos) FILTER (kind = 'sex') AS sex,
               list(name) FILTER (kind = 'criterion') AS met,
               count(*) FILTER (kind = 'reporter') > 0 AS has_reporter
        FROM mentioned LEFT JOIN tied USING (vaers_id, kind, name) GROUP BY vaers_id""",
    "facts": f"""
        SELECT n.vaers_id, n.received_date, narrative, {run_id(FULL)} AS run_id,
               coalesce(round(TRY_CAST(regexp_extract(narrative, '{AGE}', 1) AS DOUBLE)
                        / CASE lower(left(regexp_extract(narrative, '{AGE}', 2), 1)) WHEN 'm' THEN 12 WHEN 'w' THEN 52 WHEN 'd' THEN 365 ELSE 1 END, 4),
                        TRY_CAST(regexp_extract(narrative, '{AGE_SHORT}', 1) AS DOUBLE),
                        TRY_CAST(regexp_extract(narrative, '{AGED}', 1) AS DOUBLE)) AS age_years,
               {parsed(f"regexp_extract(regexp_replace(narrative, '{ONSET_PATTERN}', ' ', 'g'), '{DATE}', 1)")} AS dose,
               {parsed(f"regexp_extract(narrative, '{ONSET_PATTERN}', 1)")} AS onset,
               TRY_CAST(regexp_extract(narrative, '(?i)\\b(\\d+) days? (?:after|later|post)\\b', 1) AS BIGINT) AS stated_days,
               {items('(?i)\\bconcomitant medications?: *([^.]*)')} AS meds,
               {items('(?i)\\bhistory: *([^.]*)')} AS history,
               {items('(?i)\\ballerg(?:y|ies): *([^.]*)')} AS allergies,
               coalesce(events, []) AS events, coalesce(products, []) AS products, sex,
               list_filter(['death', 'life_threatening', 'hospitalization', 'disability', 'congenital_anomaly',
                            'other_medically_important'], lambda c: list_contains(coalesce(met, []), c)) AS criteria,
               coalesce(has_reporter, FALSE) AS has_reporter
        FROM fx_narratives n LEFT JOIN mention_lists m USING (vaers_id)""",
    "read_cases": """
        SELECT *, CAST(onset - dose AS BIGINT) AS gap_days, coalesce(stated_days, CAST(onset - dose AS BIGINT)) AS days_to_onset
        FROM facts""",
    "triaged": """
        SELECT *, len(missing) = 0 AS valid, len(criteria) > 0 AS serious,
               CASE WHEN len(criteria) > 0 THEN 'expedited'
                    WHEN len(missing) = 0 AND len(events) > 0 AND
                         len(list_filter(events, lambda e: NOT list_contains(MINOR_LIST, upper(e.name)))) = 0 THEN 'non_serious'
                    ELSE 'standard' END AS priority,
               round(1.0::DOUBLE - 0.2::DOUBLE * len(missing), 4) AS triage_confidence,
               CASE WHEN len(missing) > 0 THEN 'missing: ' || array_to_string(missing, ', ') END AS triage_rationale
        FROM (SELECT *, list_filter([CASE WHEN age_years IS NULL AND sex IS NULL THEN 'identifiable_patient' END,
                        CASE WHEN NOT has_reporter THEN 'identifiable_reporter' END,
                        CASE WHEN len(products) = 0 THEN 'suspect_product' END,
                        CASE WHEN len(events) = 0 THEN 'adverse_event' END], lambda x: x IS NOT NULL) AS missing
              FROM read_cases)""",
    "extracted_cases": f"""
        SELECT *, {CASE_STRUCT} AS case_struct,
               round(CAST((age_years IS NOT NULL)::INT + (sex IS NOT NULL)::INT + (len(products) > 0)::INT
                    + (len(events) > 0)::INT + (onset IS NOT NULL)::INT AS DOUBLE) / 5, 4) AS extraction_confidence
        FROM triaged""",
    "coded_events": """
        SELECT vaers_id, list(struct_pack(verbatim := verbatim, meddra_pt := pt_term, meddra_version := meddra_version,
                   confidence := 1.0::DOUBLE, requires_review := FALSE) ORDER BY i) FILTER (pt_term IS NOT NULL) AS coded,
               list(verbatim ORDER BY i) FILTER (pt_term IS NULL) AS uncoded
        FROM (SELECT vaers_id, i, events[i].verbatim AS verbatim
              FROM (SELECT vaers_id, events, unnest(range(1, len(events) + 1)) AS i FROM read_cases)) e
        LEFT JOIN (SELECT upper(trim(pt_term)) AS normal, min(pt_term) AS pt_term, arg_min(meddra_version, pt_term) AS meddra_version
                   FROM dictionary GROUP BY 1) d ON d.normal = upper(trim(verbatim))
        GROUP BY vaers_id""",
    "coded_cases": """
        SELECT x.*, coalesce(c.coded, []) AS coded, coalesce(c.uncoded, []) AS uncoded,
               CASE WHEN len(events) = 0 THEN 1.0::DOUBLE WHEN len(coalesce(c.coded, [])) = 0 THEN 0.0::DOUBLE
                    ELSE list_min(list_transform(c.coded, lambda e: e.confidence)) END AS coding_confidence
        FROM extracted_cases x LEFT JOIN coded_events c ON c.vaers_id = x.vaers_id""",
    "assessed": """
        SELECT *, CASE WHEN days_to_onset IS NULL THEN 'unassessable' WHEN days_to_onset < 0 THEN 'unlikely'
                       WHEN days_to_onset <= 2 THEN 'probable' WHEN days_to_onset <= 30 THEN 'possible' ELSE 'unlikely' END AS category,
               CASE WHEN days_to_onset IS NULL THEN 'No onset timing stated.'
                    ELSE 'Onset ' || days_to_onset || ' days after vaccination.' END AS causality_rationale,
               CASE WHEN days_to_onset IS NULL THEN 0.7::DOUBLE ELSE 0.9::DOUBLE END AS assessment_confidence
        FROM coded_cases""",
    "checked": """
        SELECT *, list_filter([CASE WHEN age_years IS NULL THEN 'age' END, CASE WHEN sex IS NULL THEN 'sex' END,
                      CASE WHEN len(products) = 0 THEN 'product' END, CASE WHEN len(events) = 0 THEN 'event' END,
                      CASE WHEN dose IS NULL THEN 'vaccination_date' END, CASE WHEN onset IS NULL THEN 'onset_date' END],
                      lambda x: x IS NOT NULL) AS gaps,
               list_filter([CASE WHEN age_years IS NULL THEN {'type': 'missing_field', 'severity': 'warning', 'detail': 'age'} END,
                      CASE WHEN sex IS NULL THEN {'type': 'missing_field', 'severity': 'warning', 'detail': 'sex'} END,
                      CASE WHEN onset IS NULL THEN {'type': 'missing_field', 'severity': 'warning', 'detail': 'onset_date'} END,
                      CASE WHEN gap_days < 0 THEN {'type': 'temporal_anomaly', 'severity': 'error', 'detail': 'onset before vaccination'} END,
                      CASE WHEN stated_days <> gap_days THEN {'type': 'inconsistency', 'severity': 'warning',
                           'detail': 'stated days to onset differ from the dates'} END,
                      CASE WHEN len(list_filter(coded, lambda c: c.confidence < 0.75)) > 0 THEN
                           {'type': 'low_confidence_coding', 'severity': 'warning', 'detail': 'a coded term is uncertain'} END,
                      CASE WHEN len(uncoded) > 0 THEN {'type': 'unmapped_event', 'severity': 'warning', 'detail': len(uncoded) || ' uncoded'} END],
                      lambda x: x IS NOT NULL) AS flags
        FROM assessed""",
    "qc": """
        SELECT *, greatest(0.0::DOUBLE, round(1.0::DOUBLE - 0.3::DOUBLE * len(list_filter(flags, lambda f: f.severity = 'error'))
                   - 0.05::DOUBLE * len(list_filter(flags, lambda f: f.severity = 'warning')), 4)) AS qc_confidence,
               round(CAST(6 - len(gaps) AS DOUBLE) / 6, 4) AS completeness_score,
               concat_ws(' ',
                   'A ' || concat_ws(' ', CAST(CAST(age_years AS BIGINT) AS VARCHAR) || '-year-old', sex, 'patient') || ' received ' ||
                   CASE WHEN len(products) > 0 THEN array_to_string(list_transform(products, lambda p: p.name || ' (' ||
                        CASE WHEN p.in_scope THEN 'suspect' ELSE 'concomitant' END || ')'), ', ') ELSE 'an unnamed product' END ||
                   coalesce(' on ' || strftime(dose, '%Y-%m-%d'), '') || '.',
                   CASE WHEN len(events) > 0 THEN 'Events reported were: ' || CASE WHEN len(coded) > 0
                        THEN array_to_string(list_transform(coded, lambda c: c.meddra_pt), ', ')
                        ELSE array_to_string(list_transform(events, lambda e: e.verbatim), ', ') END || '.' END,
                   'Onset was ' || strftime(onset, '%Y-%m-%d') || '.',
                   'Time to onset was ' || days_to_onset || ' days.',
                   CASE WHEN serious THEN 'The case was serious (' || array_to_string(criteria, ', ') || ').'
                        ELSE 'The case was not serious.' END,
                   'Causality was assessed as ' || category || '.') AS written
        FROM checked""",
    "full_cases": f"""
        SELECT *, {overall('triage_confidence', 'extraction_confidence', 'coding_confidence', 'assessment_confidence', 'qc_confidence')} AS overall_confidence,
               recommended OR len(uncoded) > 0 OR
               {overall('triage_confidence', 'extraction_confidence', 'coding_confidence', 'assessment_confidence', 'qc_confidence')} < 0.75 AS hitl_required
        FROM (SELECT *, len(list_filter(flags, lambda f: f.severity = 'error')) > 0 OR len(gaps) >= 3 OR qc_confidence < 0.75 AS recommended
              FROM qc)""",
    "results": """
        SELECT run_id, vaers_id, CAST(5 AS BIGINT) AS steps, overall_confidence AS confidence, hitl_required,
               CAST(len(events) AS BIGINT) AS n_events, CAST(len(products) AS BIGINT) AS n_products,
               CAST(len(coded) AS BIGINT) AS n_coded, CAST(len(uncoded) AS BIGINT) AS n_uncoded, serious
        FROM full_cases""",
    "stage_rows": """
        SELECT run_id, vaers_id, 1 AS seq, 'triage' AS agent_name, 'triage-rules-1' AS prompt_version, sha256(narrative) AS input_hash,
               CAST(to_json({'valid': valid, 'missing_criteria': missing,
                    'seriousness_screen': {'serious': serious, 'criteria_flagged': criteria}, 'priority': priority,
                    'confidence': triage_confidence, 'rationale': triage_rationale}) AS VARCHAR) AS output, triage_confidence AS confidence
        FROM full_cases
        UNION ALL SELECT run_id, vaers_id, 2, 'extraction', 'extraction-rules-1', sha256(narrative),
               CAST(to_json({'case': case_struct, 'confidence': extraction_confidence}) AS VARCHAR), extraction_confidence FROM full_cases
        UNION ALL SELECT run_id, vaers_id, 3, 'coding', 'coding-rules-1', sha256(array_to_string(list_transform(events, lambda e: e.verbatim), ' | ')),
               CAST(to_json({'result': {'coded': coded, 'uncoded': uncoded}, 'confidence': coding_confidence}) AS VARCHAR), coding_confidence
        FROM full_cases
        UNION ALL SELECT run_id, vaers_id, 4, 'assessment', 'assessment-rules-1', sha256(vaers_id),
               CAST(to_json({'seriousness': {'serious': serious, 'criteria_met': criteria},
                    'causality': {'method': 'WHO-UMC', 'category': category, 'score': NULL::DOUBLE, 'rationale': causality_rationale},
                    'confidence': assessment_confidence}) AS VARCHAR), assessment_confidence FROM full_cases
        UNION ALL SELECT run_id, vaers_id, 5, 'narrative_qc', 'narrative-rules-1', sha256(vaers_id),
               CAST(to_json({'narrative': written, 'completeness': {'completeness_score': completeness_score, 'gaps': gaps},
                    'qc_flags': flags, 'overall_confidence': qc_confidence, 'hitl_recommended': recommended}) AS VARCHAR), qc_confidence
        FROM full_cases""",
    "dictionary_grams": trigrams("SELECT pt_term FROM dictionary", "pt_term"),
    "vector_model": """
        SELECT gram, row_number() OVER (ORDER BY gram) - 1 AS slot,
               round(ln((1.0 + (SELECT count(DISTINCT pt_term) FROM dictionary)) / (1 + count(DISTINCT term))) + 1, 9) AS weight
        FROM dictionary_grams GROUP BY gram""",
    "embedded": vectors_of("dictionary_grams"),
    "listed_terms": "SELECT DISTINCT unnest(coded_pts) AS verbatim FROM fx_output",
    "outside_terms": """
        SELECT verbatim FROM listed_terms WHERE trim(verbatim) <> ''
          AND upper(trim(verbatim)) NOT IN (SELECT upper(trim(pt_term)) FROM dictionary)""",
    "outside_grams": trigrams("SELECT verbatim FROM outside_terms", "verbatim"),
    "outside_vectors": vectors_of("outside_grams"),
    "outside_best": f"""
        SELECT * FROM ({scored('outside_vectors', 'embedded')})
        QUALIFY row_number() OVER (PARTITION BY verbatim ORDER BY score DESC, pt_term) = 1""",
    "term_top": f"""
        SELECT *, row_number() OVER (PARTITION BY verbatim ORDER BY score DESC, pt_term) AS rank
        FROM ({scored('embedded', 'embedded')}) QUALIFY rank <= 5""",
}
MINOR = ["hot anvil", "hot bolt", "hot gear", "hot gizmo", "hot plate", "hot ring", "hot rod", "hot widget"]
CASE_VIEWS["triaged"] = CASE_VIEWS["triaged"].replace(
    "MINOR_LIST", "[" + ", ".join(f"'{m.upper()}'" for m in MINOR) + "]"
)

EVENT_NAMES = "array_to_string(list_transform(events, lambda e: e.verbatim), '; ')"
JSON_CASE = "CAST(to_json(case_struct) AS VARCHAR)"

CASE_BODIES: dict[str, str] = {
    "triage": """
        SELECT vaers_id, valid, array_to_string(missing, ',') AS missing_criteria, serious,
               array_to_string(criteria, ',') AS criteria_flagged, priority, triage_confidence AS confidence,
               triage_rationale AS rationale FROM triaged""",
    "extract_case": f"SELECT vaers_id, {JSON_CASE} AS extracted, extraction_confidence AS confidence FROM extracted_cases",
    "ground_topk": f"""
        SELECT 'verbatim-' || q.vec_id AS verbatim, 'term-' || t.vec_id AS pt_term,
               row_number() OVER (PARTITION BY q.vec_id ORDER BY {cosine('q.embedding', 't.embedding')} DESC, 'term-' || t.vec_id) AS rank,
               round({cosine('q.embedding', 't.embedding')}, 6) AS score
        FROM embeddings q CROSS JOIN embeddings t QUALIFY rank <= 5""",
    "ground_null": "SELECT 'verbatim-' || vec_id AS verbatim, CAST(0 AS BIGINT) AS n_candidates FROM embeddings",
    "embed_terms": """
        SELECT term AS pt_term, string_agg(slot || ':' || CAST(round(weight * 1000000) AS BIGINT), ',' ORDER BY slot) AS vector
        FROM embedded GROUP BY term""",
    "code_events": """
        SELECT l.verbatim, CASE WHEN d.pt_term IS NOT NULL THEN d.pt_term WHEN b.score >= 0.6 THEN b.pt_term END AS meddra_pt,
               CASE WHEN d.pt_term IS NOT NULL THEN d.meddra_version WHEN b.score >= 0.6 THEN n.meddra_version END AS meddra_version,
               CASE WHEN d.pt_term IS NOT NULL THEN 1.0::DOUBLE ELSE round(coalesce(b.score, 0.0::DOUBLE), 4) END AS confidence,
               d.pt_term IS NULL AND coalesce(b.score, 0) >= 0.6 AND coalesce(b.score, 0) < 0.9 AS requires_review
        FROM listed_terms l LEFT JOIN dictionary d ON upper(trim(d.pt_term)) = upper(trim(l.verbatim))
        LEFT JOIN outside_best b ON b.verbatim = l.verbatim LEFT JOIN dictionary n ON n.pt_term = b.pt_term""",
    "render_candidates": """
        SELECT run_id, 'Code each event below.' || chr(10) || chr(10) ||
               string_agg(i || '. Event: ' || e.verbatim || chr(10) || '   Candidate PTs: ' ||
                          coalesce(shown, '(no candidates retrieved)'), chr(10) ORDER BY i) AS prompt
        FROM (SELECT run_id, i, events[i].verbatim AS verbatim
              FROM (SELECT run_id, events, unnest(range(1, len(events) + 1)) AS i FROM read_cases)) e
        LEFT JOIN (SELECT verbatim, string_agg(pt_term, '; ' ORDER BY rank) AS shown FROM term_top GROUP BY verbatim) c
          ON c.verbatim = e.verbatim
        GROUP BY run_id""",
    "assess": """
        SELECT vaers_id, serious, array_to_string(criteria, ',') AS criteria_met, category, causality_rationale AS rationale,
               assessment_confidence AS confidence FROM assessed""",
    "case_summary": f"""
        SELECT vaers_id, 'Patient: age ' || coalesce(CAST(age_years AS VARCHAR), 'None') || ', sex ' || coalesce(sex, 'unknown')
               || CASE WHEN len(products) > 0 THEN chr(10) || 'Products: ' || array_to_string(list_transform(products, lambda p:
                       p.name || ' [' || CASE WHEN p.in_scope THEN 'suspect' ELSE 'concomitant' END || ']'), '; ') ELSE '' END
               || chr(10) || CASE WHEN len(coded) > 0 THEN 'Coded events (MedDRA PT): ' ||
                       array_to_string(list_transform(coded, lambda c: c.meddra_pt), '; ') ELSE 'Events: ' || {EVENT_NAMES} END
               || chr(10) || 'Vaccination date: ' || coalesce(strftime(dose, '%Y-%m-%d'), 'None') || '; onset: '
               || coalesce(strftime(onset, '%Y-%m-%d'), 'None') || '; days to onset: ' || coalesce(CAST(days_to_onset AS VARCHAR), 'None')
               || CASE WHEN len(history) > 0 THEN chr(10) || 'History: ' || array_to_string(history, '; ') ELSE '' END AS summary
        FROM coded_cases""",
    "narrative": "SELECT vaers_id, written AS narrative FROM qc",
    "qc_flags": """
        SELECT vaers_id, completeness_score, array_to_string(gaps, ',') AS gaps,
               array_to_string(list_transform(flags, lambda f: f.type || ':' || f.severity || ':' || f.detail), '|') AS flags,
               qc_confidence AS overall_confidence, recommended AS hitl_recommended FROM full_cases""",
    "step_events": """
        SELECT sha256(run_id || '|' || seq) AS event_id, run_id, vaers_id, CAST(seq AS BIGINT) AS seq, agent_name,
               agent_name || '@0.1.0' AS agent_version, 'rules-v1' AS model, prompt_version, input_hash, output, confidence
        FROM stage_rows""",
    "run_two_stage": f"""
        SELECT {run_id(TWO_STAGE)} AS run_id, vaers_id, CAST(2 AS BIGINT) AS steps,
               {overall('extraction_confidence', 'coding_confidence')} AS confidence,
               {overall('extraction_confidence', 'coding_confidence')} < 0.75 OR len(uncoded) > 0 AS hitl_required,
               CAST(len(events) AS BIGINT) AS n_events, CAST(len(products) AS BIGINT) AS n_products,
               CAST(len(coded) AS BIGINT) AS n_coded, CAST(len(uncoded) AS BIGINT) AS n_uncoded, CAST(NULL AS BOOLEAN) AS serious
        FROM coded_cases""",
    "run_full": "SELECT * FROM results",
    "hitl_route": """
        SELECT hitl_required, recommended, overall_confidence < 0.75 AS low_confidence, len(uncoded) > 0 AS has_uncoded, count(*) AS n
        FROM full_cases GROUP BY ALL""",
    "case_output": f"""
        SELECT run_id, vaers_id, '{FULL}' AS pipeline_version, 'rules-v1' AS model, {JSON_CASE} AS extracted,
               array_to_string(list_transform(coded, lambda c: c.meddra_pt), '|') AS coded_pts,
               CAST(to_json({{'coded': coded, 'uncoded': uncoded}}) AS VARCHAR) AS coded_detail,
               CAST(to_json({{'serious': serious, 'criteria_met': criteria}}) AS VARCHAR) AS seriousness,
               CAST(to_json({{'method': 'WHO-UMC', 'category': category, 'score': NULL::DOUBLE, 'rationale': causality_rationale}}) AS VARCHAR) AS causality,
               written AS narrative, overall_confidence, hitl_required
        FROM full_cases""",
    "run_record": f"""
        SELECT run_id, vaers_id, '{FULL}' AS pipeline_version,
               '{{"triage_model":"rules-v1","extraction_model":"rules-v1","coding_model":"rules-v1","assessment_model":"rules-v1","narrative_model":"rules-v1"}}' AS model_config,
               'completed' AS status, overall_confidence, hitl_required FROM full_cases""",
    "run_summary": """
        SELECT count(*) AS ok, count(*) FILTER (serious) AS serious, count(*) FILTER (hitl_required) AS hitl,
               CAST(sum(n_events) AS BIGINT) AS n_events, CAST(sum(n_products) AS BIGINT) AS n_products,
               CAST(sum(n_coded) AS BIGINT) AS n_coded, CAST(sum(n_uncoded) AS BIGINT) AS n_uncoded, CAST(0 AS BIGINT) AS failed
        FROM results""",
}
