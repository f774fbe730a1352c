"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from . import catalog as c

W = f"WITH samples AS ({c.SAMPLES})"
LINES = "list_filter(list_transform(string_split(output, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '')"
STREAK = r"regexp_matches(output, '(?:^|\n)(?:[ \t]*[0-9]{1,5}[.):]?[ \t]*(?:\n|$)){%d}')"
ECHO = r"regexp_matches(output, '(?im)^\s*(instruction|input|output)\s*:')"
RATIO = f"(CASE WHEN len({LINES}) < 20 THEN 0.0 ELSE list_max(map_values(list_aggregate({LINES}, 'histogram'))) / len({LINES})::DOUBLE END)"
FENCES = r"regexp_extract_all(output, '```(?:[A-Za-z0-9_+-]+)?\n((?s:.)*?)```', 1)"
NUMERIC_FENCE = rf"(len(list_filter({FENCES}, lambda b: len(list_filter(string_split(b, chr(10)), lambda v: trim(v) <> '')) >= 6 AND len(list_filter(string_split(b, chr(10)), lambda v: regexp_matches(trim(v), '^[0-9]{{1,5}}[.):]?$'))) >= 0.8 * len(list_filter(string_split(b, chr(10)), lambda v: trim(v) <> '')))) > 0)"
COLLAPSED = r"trim(regexp_replace(output, '\s+', ' ', 'g'))"
MD5_ORDER = "md5('42:' || seq)"
GENERIC = ", ".join(f"'{x}'" for x in c.gate.GENERIC_TOPICS)
TOPIC = "lower(trim(string_split(instruction, ':')[-1], ' ' || chr(10)))"
BEFORE = rf"""CASE
  WHEN type = 'yaml_reference' AND trim(input) = '' THEN 'missing_context_input'
  WHEN type = 'yaml_reference' AND (NOT contains(lower(instruction), 'yaml configuration') OR NOT contains(output, ':') OR contains(output, '<?php')) THEN 'yaml_instruction_output_mismatch'
  WHEN type = 'doc_summary' AND (NOT starts_with(lower(instruction), 'explain the following topic') OR length(regexp_replace(output, '[^\pL]', '', 'g')) < 80) THEN 'doc_instruction_output_mismatch'
  WHEN type = 'doc_summary' AND contains(lower(trim(topic, ' ' || chr(10))), 'the ') THEN 'doc_topic_denied'
  WHEN type = 'doc_summary' AND NOT (starts_with(lower(source), 'docs/') OR starts_with(lower(source), 'repos/src1')) THEN 'doc_source_not_allowed'
  WHEN length(output) < (CASE type WHEN 'yaml_reference' THEN 20 ELSE 50 END) THEN 'too_short'
  WHEN length(output) > (CASE type WHEN 'doc_summary' THEN 6000 ELSE 50000 END) THEN 'too_long'
  WHEN {ECHO} THEN 'prompt_wrapper_echo'
  WHEN contains(lower(instruction || chr(10) || input || chr(10) || output), 'repos/') THEN 'path_leakage_token'
  WHEN {STREAK % 40} THEN 'numeric_line_streak'
  WHEN {RATIO} >= 0.25 THEN 'repetitive_output'
  WHEN {NUMERIC_FENCE} THEN 'numeric_code_block_artifact' END"""
AFTER = rf"""CASE
  WHEN {' OR '.join(f"contains(lower(output)[1:200], '{x}')" for x in c.gate.BOILERPLATE)} THEN 'boilerplate_content'
  WHEN starts_with(instruction, 'Show me the implementation of') AND NOT regexp_matches(instruction, '^Show me the implementation of the (class|interface|trait|enum) ([A-Za-z_][A-Za-z0-9_]*) in the file (.+)\.$') THEN 'invalid_symbol_kind_prompt'
  WHEN contains(lower(instruction), 'explain the following topic') AND length({TOPIC}) < 6 THEN 'poor_instruction'
  WHEN contains(lower(instruction), 'explain the following topic') AND {TOPIC} IN ({GENERIC}) THEN 'generic_topic'
  WHEN contains(lower(instruction), 'explain the following topic') AND ({' OR '.join(f"contains({TOPIC}, '{x}')" for x in c.gate.IRRELEVANT_TOPICS)}) THEN 'irrelevant_topic'
  WHEN len({LINES}) < 3 AND length(output) < 500 THEN 'insufficient_detail'
  WHEN contains(output, '<?php') AND NOT contains(output, 'namespace') AND NOT contains(output, 'hook_') THEN 'missing_namespace_in_php' END"""
# One pass in order: outputs and pairs accepted so far.
GATED = f"""{W.replace('WITH', 'WITH RECURSIVE', 1)}, k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY seq) AS i, seq, type, {BEFORE} AS b, {AFTER} AS a, hash(output) AS h, hash(trim(instruction, ' ' || chr(10)) || chr(1) || trim(input)) AS p FROM samples),
  walk AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS seq, NULL::VARCHAR AS type, NULL::VARCHAR AS reason, []::UBIGINT[] AS hs, []::UBIGINT[] AS ps, []::UBIGINT[] AS pairs
    UNION ALL SELECT i, seq, type, reason, CASE WHEN reason IS NULL THEN list_append(hs, h) ELSE hs END, CASE WHEN reason IS NULL THEN list_append(ps, p) ELSE ps END, CASE WHEN reason IS NULL THEN list_append(pairs, hash(p, h)) ELSE pairs END
    FROM (SELECT k.*, hs, ps, pairs, CASE WHEN list_contains(ps, p) AND NOT list_contains(pairs, hash(p, h)) THEN 'ambiguous_instruction_input_pair' WHEN b IS NOT NULL THEN b WHEN list_contains(hs, h) THEN 'near_duplicate_content' ELSE a END AS reason FROM walk JOIN k ON k.i = walk.i + 1))"""
CHECKS = ["malformed_instruction_class_slot", "yaml_too_short_share", "drupal_core_train_share", "train_output_p95", "ambiguous_pair_ratio", "normalized_output_duplicate_ratio", "empty_input_share_by_type", "weak_category_coverage"]
CARD = rf"""{W}, p AS (SELECT count(DISTINCT sha256({COLLAPSED})) AS k, count(*) AS n FROM samples GROUP BY trim(instruction, ' ' || chr(10)), trim(input)),
  v AS (SELECT (SELECT round((count(*) - count(DISTINCT {COLLAPSED})) / count(*)::DOUBLE, 4) FROM samples) AS d, round(coalesce(sum(n) FILTER (k > 1), 0) / sum(n)::DOUBLE, 4) AS a FROM p), y AS (SELECT * FROM samples WHERE type = 'yaml_reference'),
  card AS (SELECT (SELECT count(*) FROM samples WHERE regexp_matches(instruction, 'class c[0-9]')) <= 50 AS malformed_instruction_class_slot, (SELECT avg(CAST(length(output) < 20 AS INT)) FROM y) <= 0.1 AS yaml_too_short_share,
    (SELECT avg(CAST(lang = 'en' AS INT)) FROM samples) <= 0.45 AS drupal_core_train_share, (SELECT quantile_disc(length(output), 0.95) FROM samples) <= 9000 AS train_output_p95, a <= 0.01 AS ambiguous_pair_ratio, d <= 0.01 AS normalized_output_duplicate_ratio,
    (SELECT avg(CAST(trim(input) = '' AS INT)) FROM y) <= 0.01 AS empty_input_share_by_type, (SELECT count(*) FROM samples WHERE contains(output, 'license')) >= 3 AS weak_category_coverage FROM v)"""
KIND = r"coalesce(nullif(regexp_extract(output, '\b(class|interface|trait|enum)\s+([A-Za-z_][A-Za-z0-9_]*)', 1), ''), CASE WHEN lower(source) LIKE '%interface.php' THEN 'interface' WHEN lower(source) LIKE '%trait.php' THEN 'trait' WHEN lower(source) LIKE '%enum.php' THEN 'enum' ELSE 'class' END)"
VALID = rf"""CASE
  WHEN type = 'yaml_reference' AND trim(input) = '' THEN 'missing_context_input'
  WHEN type = 'code_reference' AND contains(instruction, 'class c') THEN 'malformed_instruction_class_slot'
  WHEN type = 'code_reference' AND {KIND} <> 'class' THEN 'class_' || {KIND} || '_mismatch'
  WHEN {ECHO} THEN 'contains_prompt_wrapper_echo' WHEN {STREAK % 12} THEN 'numeric_line_streak_artifact' WHEN {NUMERIC_FENCE} THEN 'numeric_code_block_artifact'
  WHEN ((length(rtrim(output)) - length(replace(rtrim(output), '```', ''))) // 3) % 2 <> 0 THEN 'truncation_artifact' END"""
SANITY = f"CAST(round(greatest(0.0, 1.0 - (CASE WHEN {ECHO} THEN 0.6 ELSE 0.0 END + CASE WHEN {STREAK % 40} THEN 0.4 ELSE 0.0 END + CASE WHEN {RATIO} >= 0.25 THEN 0.2 ELSE 0.0 END)), 4) AS DOUBLE)"
BUCKET = "array_to_string(list_filter(string_split(source, '/'), lambda x: x <> '')[1:2], '/')"
PICKED = f"""tests AS (SELECT seq, row_number() OVER (ORDER BY {MD5_ORDER}, seq) AS r FROM samples WHERE contains(concat_ws(' ', source, instruction, input, output), 'license') OR regexp_matches(concat_ws(' ', source, instruction, input, output), '(?i)license')),
  first AS (SELECT seq FROM tests WHERE r <= least(20, (SELECT count(*) * 3 // 10 FROM samples))),
  rest AS (SELECT seq FROM samples WHERE seq NOT IN (SELECT seq FROM first) ORDER BY {MD5_ORDER}, seq LIMIT (SELECT count(*) * 3 // 10 FROM samples) - (SELECT count(*) FROM first)),
  picked AS (SELECT seq FROM first UNION ALL SELECT seq FROM rest)"""
RESULTS = """results AS (SELECT doc_id AS seq, 'm' || (doc_id % 3) AS model_name, 'p' || (doc_id // 6 % 5) AS prompt_id, CASE WHEN doc_id // 3 % 2 = 0 THEN 'fine_tuned' ELSE 'baseline' END AS variant, (doc_id * 7 % 11) / 10.0 AS score, doc_id % 4 > 0 AS passed, (doc_id % 5) / 4.0 AS sanity, doc_id % 5 > 2 AS is_sane, 'c' || (doc_id // 6 % 2) AS category FROM documents),
  base AS (SELECT model_name, prompt_id, max_by(score, seq) AS b FROM results WHERE variant = 'baseline' GROUP BY ALL),
  deltas AS (SELECT model_name, category, round(score::DOUBLE - b::DOUBLE, 4) AS delta FROM results JOIN base USING (model_name, prompt_id) WHERE variant = 'fine_tuned')"""


CODED = """WITH coded AS (SELECT doc_id AS seq, '<?php' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN 'declare(strict_types=1);' ELSE '' END || chr(10) || 'use A;' || chr(10) || 'trait T' || doc_id || ' {' || chr(10) || CASE WHEN doc_id % 5 = 0 THEN 'public function z() {}' ELSE 'function b() {}' END || chr(10) || 'function a() {}' AS cut, cut || chr(10) || text AS output FROM documents)"""


def _avg(side: str, x: str) -> str:
    return f"round(coalesce(avg({x}) FILTER (variant = '{side}'), 0.0), 4)"


SQL = {
    "fn01_normalize": r"SELECT doc_id, md5(trim(regexp_replace(replace(' ' || chr(10) || replace(text, '. ', '.  ' || chr(10)) || '  ', chr(13), chr(10)), '(?m)[ \t]+$', '', 'g'), ' ' || chr(10)) || chr(10)) AS h FROM documents",
    "fn05_hashes": r"SELECT doc_id, sha256(text) AS raw, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS normal, length(regexp_replace(text, '[^\pL]', '', 'g')) AS letters FROM documents",
    "fn07_code_blocks": f"{W} SELECT seq, CASE WHEN len({FENCES}) > 0 THEN len({FENCES}) WHEN contains(output, '<?php') THEN 1 ELSE 0 END AS n, coalesce(md5(CASE WHEN len({FENCES}) > 0 THEN trim(({FENCES})[1], ' ' || chr(10)) WHEN contains(output, '<?php') THEN trim(output, ' ' || chr(10)) END), '') AS first FROM samples",
    "fn14_format_sanity": f"{W} SELECT seq, {ECHO} AS echo, round({RATIO}, 6) AS repeated, {STREAK % 40} AS streak, {SANITY} AS sanity FROM samples",
    "pj18_paths": rf"""{W} SELECT seq, string_split(source, '/')[-1] AS file, string_split(source, '/')[2] AS module, CASE WHEN source LIKE '%.php' THEN 'php' ELSE 'doc' END AS family, CASE WHEN lower(source) LIKE '%interface.php' THEN 'interface' ELSE 'class' END AS kind, {BUCKET} AS bucket,
        CASE WHEN s = '' THEN 'UnknownSymbol' WHEN regexp_matches(s, '^[A-Za-z]') THEN s ELSE 'Symbol' || s END AS symbol, coalesce(nullif(regexp_replace(regexp_replace(topic, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'model') AS slug
        FROM (SELECT *, array_to_string(list_transform(regexp_extract_all(topic, '[A-Za-z0-9]+'), lambda x: upper(x[1]) || x[2:]), '') AS s FROM samples)""",
    "fn21_labels": """WITH a AS (SELECT doc_id, list_transform(range(1, doc_id % 9 + 4), lambda i: i * 10) AS ids FROM documents), b AS (SELECT *, CAST(ceil(max(len(ids)) OVER (PARTITION BY doc_id // 8) / 8.0) * 8 AS INT) AS size FROM a),
        c AS (SELECT *, list_transform(ids, lambda x, i: CASE WHEN len(ids) >= 4 AND i > 4 THEN x ELSE -100 END) AS labels FROM b)
        SELECT doc_id, array_to_string(list_resize(ids, size, 0), ',') AS ids, array_to_string(list_resize(labels, size, -100), ',') AS labels FROM c""",
    "fl01_gate_rules": f"{W} SELECT seq, {BEFORE} AS before, {AFTER} AS after FROM samples",
    "fl01_gate": f"{GATED} SELECT seq, type, reason AS rejection_reason FROM walk WHERE i > 0",
    "ag02_gate_report": f"{GATED} SELECT coalesce(type, '*') AS type, coalesce(reason, '*') AS reason, count(*) AS n, CAST(grouping(type, reason) AS INT) AS level FROM walk WHERE i > 0 GROUP BY ROLLUP (type, reason)",
    "fl10_validation": f"{W} SELECT seq, {VALID} AS reason FROM samples",
    "fl13_categories": rf"{W} SELECT seq, regexp_matches(s, '(?im)the\s+of') OR regexp_matches(s, '(?im)\bing') AS a, regexp_matches(s, '(?im)license') AS b, false AS c FROM (SELECT seq, concat_ws(' ', source, instruction, input, output) AS s FROM samples)",
    "fl21_audit": f"{W}, a AS (SELECT {STREAK % 13} AS s, {RATIO} > 0.31 AS r, {NUMERIC_FENCE} AS f FROM samples) SELECT count(*) AS n, count_if(s) AS numeric_line_streak, count_if(r) AS repetitive_output, count_if(f) AS numeric_code_block, count_if(s OR r OR f) AS failing, count_if(s OR r OR f) = 0 AS passed FROM a",
    "wn14_line_chunks": f"""{W}, l AS (SELECT *, CASE WHEN string_split(output, chr(10))[-1] = '' THEN string_split(output, chr(10))[:-2] ELSE string_split(output, chr(10)) END AS ls FROM samples), k AS (SELECT *, CASE WHEN len(ls) <= 20 THEN 1 ELSE CAST(ceil((len(ls) - 20) / 15.0) AS INT) + 1 END AS total FROM l), e AS (SELECT *, unnest(range(1, total + 1)) AS i FROM k), r AS (SELECT *, (i - 1) * 15 AS a, least((i - 1) * 15 + 20, len(ls)) AS z FROM e)
        SELECT seq, CASE WHEN total > 1 THEN i END AS chunk_index, CASE WHEN total > 1 THEN total END AS chunk_total, CASE WHEN total > 1 THEN a + 1 END AS line_start, CASE WHEN total > 1 THEN z END AS line_end,
        CASE WHEN total = 1 THEN input ELSE (CASE WHEN trim(input) = '' THEN '' ELSE trim(input) || chr(10) END) || 'Chunk: part ' || i || '/' || total || ', lines ' || (a + 1) || '-' || z || '.' END AS input,
        md5(CASE WHEN total = 1 THEN output ELSE array_to_string(ls[a + 1:z], chr(10)) || CASE WHEN z = len(ls) AND ends_with(output, chr(10)) THEN chr(10) ELSE '' END END) AS h FROM r""",
    "wn01_first_pairs": f"{W} SELECT min(seq) AS seq FROM samples GROUP BY instruction, output",
    "wn02_exact_dedup": "WITH f AS (SELECT 'f' || lpad(doc_id::VARCHAR, 6, '0') || '.md' AS path, sha256(text) AS hash FROM documents), g AS (SELECT *, min(path) OVER (PARTITION BY hash) AS canonical_path FROM f) SELECT path, hash, canonical_path, CASE WHEN path = canonical_path THEN 'canonical' ELSE 'exact' END AS dup_type FROM g",
    "wn04_ranked_dedup": f"{W} SELECT seq, row_number() OVER (PARTITION BY sha256({COLLAPSED}) ORDER BY CASE sample_type WHEN 'bugfix' THEN 0 WHEN 'refactor' THEN 1 WHEN 'write_from_spec' THEN 2 WHEN 'explain_and_implement' THEN 3 WHEN 'retrieval' THEN 4 ELSE 5 END, source, instruction, seq) = 1 AS kept FROM samples",
    "wn07_split": f"{W}, r AS (SELECT seq, row_number() OVER (ORDER BY {MD5_ORDER}, seq) AS p, count(*) OVER () AS n FROM samples) SELECT seq, CASE WHEN p <= floor(n * 0.8) THEN 'train' WHEN p <= floor(n * 0.8) + floor(n * 0.1) THEN 'valid' ELSE 'test' END AS split FROM r",
    "wn08_rebalance": f"{W}, r AS (SELECT seq, contains(lower(source), '/tests/') AS t, row_number() OVER (PARTITION BY contains(lower(source), '/tests/') ORDER BY {MD5_ORDER}, seq) AS p FROM samples) SELECT seq, NOT t OR p <= floor(0.2 * (SELECT count(*) FROM r WHERE NOT t) / 0.8) AS kept FROM r",
    "wn09_share_cap": f"{W}, n AS (SELECT lang, count(*) AS k, sum(count(*)) OVER () AS total FROM samples GROUP BY lang), d AS (SELECT lang, greatest(0, k - greatest(1, floor(0.45 * (total - k) / 0.55))) AS gone FROM n) SELECT seq, lang, row_number() OVER (PARTITION BY lang ORDER BY CASE WHEN contains(output, 'license') THEN 1 ELSE 0 END, {MD5_ORDER}, seq) > gone AS kept FROM samples JOIN d USING (lang)",
    "wn10_quota": f"{W}, {PICKED} SELECT seq FROM picked",
    "wn11_round_robin": f"{W}, {PICKED} SELECT seq, ['bugfix', 'refactor', 'write_from_spec'][(row_number() OVER (ORDER BY {MD5_ORDER}, seq) - 1) % 3 + 1] AS augmentation_type FROM picked",
    "wn17_turn_pairs": "WITH w AS (SELECT conv_id, turn, role, md5(text) AS ask, lead(role) OVER p AS next_role, md5(lead(text) OVER p) AS answer FROM conversations WINDOW p AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, ask, answer FROM w WHERE role = 'user' AND next_role = 'assistant'",
    "ag04_percentiles": f"{W}, s AS (SELECT type, list_sort(list(length(output))) AS l FROM samples GROUP BY type) SELECT type, {', '.join(f'l[CAST(floor((len(l) - 1) * {p}) AS INT) + 1] AS p{round(p * 100)}' for p in (0.5, 0.9, 0.95, 0.99))} FROM s",
    "ag05_empty_inputs": f"{W} SELECT type, round(avg(CASE WHEN trim(input) = '' THEN 1.0 ELSE 0.0 END), 4) AS empty_share FROM samples GROUP BY type",
    "ag06_ambiguity": rf"{W}, p AS (SELECT count(DISTINCT sha256({COLLAPSED})) AS k, count(*) AS n FROM samples GROUP BY trim(instruction, ' ' || chr(10))) SELECT count_if(k > 1) AS pairs, CAST(coalesce(sum(n) FILTER (k > 1), 0) AS BIGINT) AS rows, round(coalesce(sum(n) FILTER (k > 1), 0) / sum(n)::DOUBLE, 4) AS row_ratio FROM p",
    "ag07_duplicates": f"{W} SELECT round((count(*) - count(DISTINCT {COLLAPSED})) / count(*)::DOUBLE, 4) AS duplicate_ratio FROM samples",
    "ag08_concentration": f"{W} SELECT {BUCKET} AS bucket, count(*) AS n, round(count(*) / (SELECT count(*) FROM samples)::DOUBLE, 4) AS share FROM samples GROUP BY 1 ORDER BY n DESC, bucket LIMIT 10",
    "ag12_evaluation": f"""WITH {RESULTS}, s AS (SELECT coalesce(model_name, '*') AS model_name, {_avg('fine_tuned', 'score')} AS fine_tuned_avg_score, {_avg('baseline', 'score')} AS baseline_avg_score, {_avg('fine_tuned', 'passed::INT')} AS fine_tuned_pass_rate, {_avg('baseline', 'passed::INT')} AS baseline_pass_rate, {_avg('fine_tuned', 'sanity')} AS fine_tuned_format_sanity_avg, {_avg('baseline', 'sanity')} AS baseline_format_sanity_avg,
        {_avg('fine_tuned', '(NOT is_sane)::INT')} AS fine_tuned_format_sanity_fail_rate, {_avg('baseline', '(NOT is_sane)::INT')} AS baseline_format_sanity_fail_rate FROM results GROUP BY ROLLUP (model_name)),
        d AS (SELECT coalesce(model_name, '*') AS model_name, count_if(delta > 0) AS fine_tuned_wins, count_if(delta < 0) AS baseline_wins, count_if(delta = 0) AS ties FROM deltas GROUP BY ROLLUP (model_name))
        SELECT *, round(fine_tuned_avg_score - baseline_avg_score, 4) AS delta_avg_score, round(fine_tuned_format_sanity_avg - baseline_format_sanity_avg, 4) AS delta_format_sanity_avg FROM s JOIN d USING (model_name)""",
    "ag11_feedback": f"WITH {RESULTS} SELECT category, count(*) AS n, round(avg(delta), 4) AS avg_delta FROM deltas WHERE delta < 0 GROUP BY category",
    "fn17_scores": "WITH a AS (SELECT doc_id, (doc_id % 6) / 5.0::DOUBLE AS r, CASE WHEN doc_id % 3 > 0 THEN (doc_id % 4) / 3.0::DOUBLE END AS l, CASE WHEN doc_id % 2 = 0 THEN (doc_id % 5) / 4.0::DOUBLE END AS s FROM documents), b AS (SELECT *, (CASE WHEN l IS NULL THEN 0.0 ELSE 0.1 END + CASE WHEN s IS NULL THEN 0.0 ELSE 0.1 END)::DOUBLE AS w FROM a) SELECT doc_id, round(r * (1 - w) + coalesce(l, 1) * coalesce(s, 1) * w, 4) AS score FROM b",
    "ag15_scorecard": f"{CARD} SELECT *, {' AND '.join(CHECKS)} AS overall_passed FROM card",
    "fl22_failed_checks": f"{CARD} " + " UNION ALL ".join(f"SELECT '{x}' AS failed FROM card WHERE NOT {x}" for x in CHECKS),
    "sc11_metadata": """WITH f AS (SELECT doc_id, p, (doc_id + p) % 4 AS k FROM documents, (VALUES (0), (1)) v(p)), first AS (SELECT doc_id, min_by(p, p) AS p, min_by(k, p) AS k FROM f WHERE k > 0 GROUP BY doc_id)
        SELECT 'm' || doc_id AS machine_name, CASE WHEN k < 3 THEN 'b' || p END AS branch, CASE k WHEN 1 THEN '^' || (doc_id % 12) WHEN 2 THEN '^11' END AS core_constraint, CASE k WHEN 1 THEN '>=8.' || (doc_id % 4) END AS php_constraint, CASE WHEN k < 3 THEN k = 1 END AS has_tests FROM first""",
    "ag13_dedup_summary": """WITH d AS (SELECT coalesce(length(text), 0) AS n, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS again FROM documents WHERE text IS NOT NULL)
        SELECT CASE WHEN again THEN 'exact' ELSE 'canonical' END AS dup_type, count(*) AS n, CAST(sum(n) AS BIGINT) AS chars, CAST(sum(CASE WHEN again THEN n ELSE 0 END) AS BIGINT) AS saved FROM d GROUP BY 1""",
    "sc15_storage_paths": r"WITH p AS (SELECT page_id, replace(regexp_extract(url, '://([^/?#]*)', 1), '.', '_') AS h, coalesce(nullif(trim(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/'), ''), 'index') AS p FROM pages) SELECT page_id, h || '/' || p || CASE WHEN regexp_matches(p, '\.(html|md|json|xml)$') THEN '' ELSE '.html' END AS path FROM p",
    "sc16_links": r"""WITH l AS (SELECT regexp_replace(url, '[?#].*$', '') AS url, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages) SELECT url, count(*) AS n, count(DISTINCT string_split(href, '#')[1]) AS n_distinct FROM l GROUP BY url""",
    "fl19_discovery": rf"""WITH n AS ({c.NODES}), r AS (SELECT CASE WHEN machine_name = '' THEN 'missing_machine_name' WHEN contains(lower(title || ' ' || machine_name), 'archived') THEN 'archived_or_security_only' WHEN NOT has_composer THEN 'missing_composer' WHEN NOT regexp_matches(core_constraint, '(^|[^0-9])\^?11(\.|$)') THEN 'core_not_drupal11' WHEN language_constraint = '>=8.1' THEN 'php_constraint_too_low' ELSE 'kept' END AS reason FROM n) SELECT reason, count(*) AS n FROM r GROUP BY reason""",
    "so01_ranking": rf"""WITH n AS ({c.NODES}) SELECT id, machine_name, CAST(regexp_matches(core_constraint, '(^|[^0-9])\^?11(\.|$)') AS INT) AS core_ok, CAST(language_constraint <> '>=8.1' AS INT) AS language_ok FROM n WHERE machine_name <> '' ORDER BY core_ok DESC, language_ok DESC, recent DESC, has_tests DESC, usage DESC, machine_name DESC LIMIT 200""",
    "pj01_code_samples": r"""SELECT 'repos/mod/src/f' || doc_id || '.php' AS source, 'Show me the implementation of the class Thing' || doc_id || ' in the file <source_file>.' AS instruction,
        'Source file: <source_file>' || chr(10) || 'File name hint: f' || doc_id || '.php' || chr(10) || 'Module hint: mod' || chr(10) || 'Target symbol: class Thing' || doc_id || chr(10) || 'Namespace: A' AS input, 'declaration' AS symbol_extraction_method,
        md5('<?php' || chr(10) || chr(10) || 'namespace A;' || chr(10) || chr(10) || 'use B' || chr(92) || 'C;' || chr(10) || 'use D;' || chr(10) || chr(10) || '// class Decoy' || chr(10) || 'class Thing' || doc_id || ' {}' || chr(10) || '/*' || chr(10) || replace(text, '*/', '') || '*/' || chr(10)) AS h FROM documents""",
    "pj06_dispatch": r"""WITH h AS (SELECT *, 'Source file: <source_file>' || chr(10) || 'File name hint: ' AS a, chr(10) || 'Module hint: mod' || chr(10) AS b FROM documents WHERE text IS NOT NULL)
        SELECT 'repos/mod/' || doc_id || '_x.y.yml' AS source, 'Provide the Drupal 11 YAML configuration from <source_file>.' AS instruction, a || doc_id || '_x.y.yml' || b || 'Configuration topic: ' || doc_id || ' x.y' || chr(10) || 'Task: Return the complete Drupal 11 YAML configuration.' AS input, 'yaml_reference' AS type, doc_id || ' x.y' AS topic, md5(text) AS h FROM h WHERE doc_id % 4 = 0
        UNION ALL SELECT 'repos/mod/t-' || doc_id || '.html.twig', 'Show the Twig template implementation in <source_file> for Drupal 11 theming.', a || 't-' || doc_id || '.html.twig' || b || 'Task: Return the complete Drupal 11 Twig template implementation.', 'twig_reference', NULL, md5(text) FROM h WHERE doc_id % 4 = 1""",
    "fl12_candidates": f"""{W}, s AS (SELECT *, lower(source) AS low FROM samples) SELECT seq, CASE WHEN contains(low, '/tests/') OR ends_with(low, 'test.php') THEN 'augmentation_from_test_source' WHEN NOT ends_with(low, '.php') THEN 'augmentation_non_php_source'
        WHEN seq % 2 <> 0 AND NOT regexp_matches(output, '^\\s*<[?]php') THEN 'augmentation_non_php_output' WHEN seq % 10 = 4 THEN 'augmentation_chunked_source' END AS reason FROM s""",
    "fl09_prefixes": f"{W} SELECT seq FROM samples WHERE NOT (starts_with(lower(source), 'repos/src1') OR starts_with(lower(source), 'docs/src2/'))",
    "wn13_feedback": rf"{W} SELECT seq, CAST(regexp_matches(s, '(?im)the\s+of') OR regexp_matches(s, '(?im)\bing') AS INT) + CAST(regexp_matches(s, '(?im)license') AS INT) AS score FROM (SELECT seq, concat_ws(' ', source, instruction, input, output) AS s FROM samples)",
    "wn16_length": f"{W} SELECT CASE WHEN length(output) > 3000 THEN 'max_output_chars' END AS rejection_reason, count(*) AS n, CAST(sum(seq) AS BIGINT) AS s FROM samples GROUP BY 1",
    "pj05_doc_samples": r"""WITH d AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) >= 50 AND NOT starts_with(x, '#') AND NOT starts_with(x, '|') AND len(regexp_extract_all(x, 'http')) < 2) AS ps, '# Title ' || doc_id || ' {#x}' || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) AS content FROM documents),
        o AS (SELECT doc_id, trim(left('Topic: Title ' || doc_id || chr(10) || chr(10) || CASE WHEN len(ps) > 0 THEN array_to_string(ps[1:6], chr(10) || chr(10)) ELSE left(content, 6000) END, 6000), ' ' || chr(10)) AS out FROM d)
        SELECT 'docs/a/' || doc_id || '.md' AS source, 'Title ' || doc_id AS topic, 'Explain the following topic: Title ' || doc_id AS instruction, md5(out) AS h FROM o WHERE length(out) >= 120""",
    "pj12_broken": f"""{CODED} SELECT seq, CASE WHEN seq % 3 = 0 THEN replace(cut, 'strict_types=1', 'strict_types=0') WHEN seq % 5 = 0 THEN replace(cut, 'public function ', 'function ') ELSE cut || '{c.augment.BUG_NOTE}' END AS broken FROM coded""",
    "pj13_augmented": f"""{CODED}, a AS (SELECT *, 'Symbol: T' || seq || chr(10) || 'Source file: <source_file>' || chr(10) || 'File name hint: F' || seq || '.php' || chr(10) AS head,
        'Source file: <source_file>' || chr(10) || 'File name hint: F' || seq || '.php' || chr(10) || 'Target symbol: trait T' || seq || chr(10) || 'Namespace: Drupal\\Custom' || chr(10) || 'Requirements:' || chr(10) || '{c.augment.REQUIREMENTS[0]}' || chr(10) || '- Provide a complete trait implementation for T' || seq || '.' || chr(10) || '- Include required imports:' || chr(10) || '  - A' || chr(10) || '- Ensure these methods exist where relevant:' || chr(10) || '  - a()' || chr(10) || CASE WHEN seq % 5 = 0 THEN '  - z()' ELSE '  - b()' END AS spec,
        CASE WHEN seq % 4 = 3 THEN '{c.augment.PLAN}' ELSE '' END || output AS whole FROM coded), b AS (SELECT *, CASE WHEN ends_with(whole, chr(10)) THEN string_split(whole, chr(10))[:-2] ELSE string_split(whole, chr(10)) END AS ls FROM a)
        SELECT seq, CASE seq % 4 WHEN 0 THEN 'Fix this broken Drupal 11 trait implementation and return corrected PHP code.' WHEN 1 THEN 'Refactor this Drupal 11 trait for readability and maintainability while preserving behavior.' WHEN 2 THEN '{c.augment.INSTRUCTIONS['write_from_spec']}' ELSE '{c.augment.INSTRUCTIONS['explain_and_implement']}' END AS instruction,
        md5(CASE seq % 4 WHEN 0 THEN head || 'Broken snippet:' || chr(10) || CASE WHEN seq % 3 = 0 THEN replace(cut, 'strict_types=1', 'strict_types=0') WHEN seq % 5 = 0 THEN replace(cut, 'public function ', 'function ') ELSE cut || '{c.augment.BUG_NOTE}' END WHEN 1 THEN head || 'Current implementation:' || chr(10) || cut ELSE spec END) AS input,
        md5(CASE WHEN len(ls) > 20 THEN array_to_string(ls[1:20], chr(10)) ELSE whole END) AS output, CASE seq % 4 WHEN 0 THEN 'bugfix' WHEN 1 THEN 'refactor' WHEN 2 THEN 'write_from_spec' ELSE 'explain_and_implement' END AS sample_type FROM b""",
    "fl20_checks": """WITH d AS (SELECT doc_id, lower(text || CASE WHEN doc_id % 2 = 0 THEN ' Services: logger.factory' ELSE ' x.component.yml' END) AS o, doc_id % 3 AS p FROM documents), e AS (SELECT *, CASE p WHEN 0 THEN [true, contains(o, 'services:'), contains(o, 'logger.factory'), contains(o, '__construct('), contains(o, 'logger')] WHEN 1 THEN [true, contains(o, 'component.yml'), contains(o, 'components/') OR contains(o, '/components'), contains(o, '.twig') OR contains(o, 'template')] ELSE [true] END AS l FROM d)
        SELECT doc_id, len(list_filter(l, lambda x: x)) AS held, round(len(list_filter(l[1:CASE p WHEN 0 THEN 4 WHEN 1 THEN 3 ELSE 1 END], lambda x: x)) / CASE p WHEN 0 THEN 4.0 WHEN 1 THEN 3.0 ELSE 1.0 END::DOUBLE, 4) AS share FROM e""",
    "sc12_branches": "SELECT doc_id, lang || CASE WHEN lang = 'en' THEN ',main,1.x,de' WHEN lang = 'de' THEN ',main,en,1.x' ELSE ',main,en,1.x,de' END AS branches FROM documents",
    "sc19_prefixes": "SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'https://symfony.com/doc/7.0/' ELSE url END AS prefix FROM pages",
    "ag17_fetches": "SELECT count(*) AS n, count_if(page_id % 5 > 0) AS succeeded, count_if(page_id % 5 = 0) AS failed, CAST(sum(page_id % 3) AS BIGINT) AS pages, count_if(page_id % 5 > 0 AND page_id % 3 > 0) AS valid FROM pages",
    "st01_sets": f"{W} SELECT seq, 'test' AS part FROM samples WHERE contains(lower(source), '/tests/') UNION ALL SELECT seq, 'repeat' AS part FROM samples WHERE NOT contains(lower(source), '/tests/') AND seq NOT IN (SELECT min(seq) FROM samples GROUP BY instruction, output)",
}
