"""The same results in plain SQL, for the check in another engine."""

from gridledger import fixed
from workload.tables import BENCHMARKS, CLASSIFICATION_DOC, MODELS, RETRIEVAL_DOC


def _list(names):
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


KEYS = "model, pretrained, task_type, benchmark"

VIEWS = {
    "parts": f"""
        SELECT p_partkey, list_extract({_list(MODELS)}, p_partkey % {len(MODELS)} + 1) AS model,
               lower(p_type) || '_s' || p_partkey AS pretrained
        FROM part""",
    "nations": f"""
        SELECT n_nationkey,
               CASE WHEN n_regionkey = 0 THEN 'zeroshot_retrieval'
                    ELSE 'zeroshot_classification' END AS task_type,
               CASE WHEN list_extract({_list(BENCHMARKS)}, n_nationkey + 1) = '' THEN n_name
                    ELSE list_extract({_list(BENCHMARKS)}, n_nationkey + 1) END AS benchmark
        FROM nation""",
    "grid": f"SELECT {KEYS} FROM parts CROSS JOIN nations",
    "items": f"""
        SELECT {KEYS}, l_orderkey, l_linenumber, l_returnflag, l_shipdate
        FROM lineitem JOIN parts ON l_partkey = p_partkey
        JOIN nations ON l_suppkey % 25 = n_nationkey""",
    "runs": f"""
        SELECT {KEYS}, 'r/' || l_orderkey || '-' || l_linenumber || '.json' AS result_file,
               l_shipdate AS mtime
        FROM items""",
    "latest": f"""
        SELECT {KEYS}, result_file, strftime(mtime, '%Y-%m-%dT%H:%M:%S') AS timestamp
        FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}
                                           ORDER BY mtime DESC, result_file DESC) AS n FROM runs)
        WHERE n = 1""",
    "ledger": f"""
        SELECT g.model, g.pretrained, g.task_type, g.benchmark,
               coalesce(u.result_file, '') AS result_file, coalesce(u.timestamp, '') AS timestamp,
               CASE WHEN u.model IS NULL THEN 'pending' ELSE 'completed' END AS status
        FROM grid g LEFT JOIN latest u USING ({KEYS})""",
    "old": f"""
        SELECT {KEYS}, result_file, timestamp,
               CASE WHEN task_type = 'zeroshot_classification' THEN 'completed' END AS status
        FROM latest
        UNION ALL
        SELECT 'retired', c_name, 'zeroshot_classification', 'imagenet1k', '', '', 'pending'
        FROM customer""",
    "names": f"""
        SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN 'openai' ELSE pretrained END AS weights,
               benchmark || '_' || CASE WHEN l_linenumber % 2 = 0 THEN 'openai' ELSE pretrained END
               || '_' || model || '_en_' || task_type || '.json' AS run_name
        FROM items""",
    "listing": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'log_' || l_orderkey || '-' || l_linenumber || '.json'
                    ELSE run_name END AS file_name, l_shipdate AS mtime
        FROM names""",
    # A key read from a name, by list steps: what follows the benchmark is searched for `openai`.
    "cut": """
        SELECT file_name, mtime, p, CASE WHEN p[2] = 'captions' THEN p[1] || '_' || p[2] ELSE p[1] END AS b,
               CASE WHEN p[2] = 'captions' THEN p[3:] ELSE p[2:] END AS rest
        FROM (SELECT file_name, mtime, string_split(replace(file_name, '.json', ''), '_') AS p FROM listing)""",
    "found": """
        SELECT *, coalesce(list_position(rest, 'openai'), 0) AS pos,
               CASE WHEN coalesce(list_position(rest, 'openai'), 0) > 0
                    THEN rest[list_position(rest, 'openai') + 1:] ELSE [] END AS tail
        FROM cut""",
    "parsed": """
        SELECT file_name, mtime,
               CASE WHEN list_contains(p, 'classification') THEN 'zeroshot_classification'
                    ELSE 'zeroshot_retrieval' END AS task_type,
               b AS benchmark,
               CASE WHEN by_place THEN rest[1] ELSE rest[pos] END AS pretrained,
               CASE WHEN by_place THEN rest[2] ELSE named END AS model
        FROM (SELECT *, pos = 0 OR named = '' AS by_place
              FROM (SELECT *, CASE WHEN len(own) = 0 THEN 'unknown'
                                   ELSE array_to_string(own, '_') END AS named
                    FROM (SELECT *, tail[1:coalesce(list_min(list_filter(
                              [list_position(tail, 'en'), list_position(tail, 'zeroshot'),
                               list_position(tail, 'classification'), list_position(tail, 'retrieval')],
                              lambda x: x > 0)), len(tail) + 1) - 1] AS own FROM found)))
        WHERE len(p) >= 5 AND (list_contains(p, 'classification') OR list_contains(p, 'retrieval'))""",
    "documents": f"""
        SELECT {KEYS}, 'results/' || event_id || '.json' AS result_file, ts AS mtime,
               CASE WHEN value < 5 THEN ''
                    WHEN event_type = 'error' THEN substr(props, 1, 4)
                    WHEN event_type = 'signup' THEN '{{}}'
                    WHEN event_type = 'view' THEN '[' || props || ']'
                    WHEN event_type = 'click' THEN replace('{CLASSIFICATION_DOC}', 'N', k)
                    WHEN value > 100 THEN replace('{RETRIEVAL_DOC}', 'N', k) || ' end'
                    ELSE replace('{RETRIEVAL_DOC}', 'N', k) END AS doc
        FROM (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k FROM events)
        JOIN parts ON user_id = p_partkey
        JOIN nations ON event_id % 25 = n_nationkey""",
    "checked": f"""
        SELECT {KEYS}, result_file, mtime, doc,
               CASE WHEN doc = '' THEN 'missing_or_empty'
                    WHEN NOT json_valid(doc) THEN 'decode'
                    WHEN json_type(CASE WHEN json_valid(doc) THEN doc ELSE '1' END) <> 'OBJECT'
                    THEN 'not_object' END AS error_class,
               CASE WHEN doc <> '' AND json_valid(doc) THEN doc ELSE '{{}}' END AS safe
        FROM documents""",
    "parsed_docs": f"""
        SELECT {KEYS}, result_file, mtime, doc, error_class,
               TRY_CAST(json_extract_string(safe, '$.metrics.acc1') AS DOUBLE) AS accuracy,
               TRY_CAST(json_extract_string(safe, '$.metrics.acc5') AS DOUBLE) AS top5_accuracy,
               TRY_CAST(json_extract_string(safe, '$.metrics.mean_per_class_recall') AS DOUBLE)
                   AS mean_per_class_recall,
               TRY_CAST(json_extract_string(safe, '$.metrics."image_retrieval_recall@5"') AS DOUBLE)
                   AS image_retrieval_recall_at_5,
               TRY_CAST(json_extract_string(safe, '$.metrics."text_retrieval_recall@5"') AS DOUBLE)
                   AS text_retrieval_recall_at_5,
               TRY_CAST(json_extract_string(safe, '$.metrics.mean_average_precision') AS DOUBLE)
                   AS mean_average_precision
        FROM checked""",
    # Every key of a document is a cell of the grid, so the latest documents are the completed rows.
    "completed": f"""
        SELECT * EXCLUDE (n), CASE WHEN microsecond(mtime) % 1000000 = 0
                 THEN strftime(mtime, '%Y-%m-%dT%H:%M:%S')
                 ELSE strftime(mtime, '%Y-%m-%dT%H:%M:%S.%f') END AS benchmark_run_at
        FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}
                                           ORDER BY mtime DESC, result_file DESC) AS n FROM parsed_docs)
        WHERE n = 1""",
    "stored": """
        SELECT *, benchmark || '_' || pretrained || '_' || model || '_en_' || task_type || '.json'
                  AS file_name
        FROM completed""",
    "requirement": "SELECT *, {fields} FROM grid".format(fields="1 AS one"),
    "prototypes": """
        SELECT label, embedding FROM embeddings
        JOIN (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label)
        USING (label, vec_id)""",
    "scores": """
        SELECT e.vec_id, e.label, p.label AS class,
               round(list_cosine_similarity(e.embedding::DOUBLE[], p.embedding::DOUBLE[]), 12) AS s
        FROM embeddings e CROSS JOIN prototypes p""",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, class) AS n FROM scores""",
    "pairs": """
        SELECT i.vec_id AS image, t.vec_id AS text, i.label = t.label AS same,
               round(list_cosine_similarity(i.embedding::DOUBLE[], t.embedding::DOUBLE[]), 12) AS s
        FROM embeddings i JOIN embeddings t ON i.vec_id % 2 = 0 AND t.vec_id % 2 = 1""",
    "found_texts": """
        SELECT image, bool_or(same) AS hit
        FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY s DESC, text) AS n FROM pairs)
        WHERE n <= 5 GROUP BY image""",
    "found_images": """
        SELECT text, bool_or(same) AS hit
        FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY s DESC, image) AS n FROM pairs)
        WHERE n <= 5 GROUP BY text""",
    "class_ap": """
        SELECT class AS label,
               sum(CASE WHEN label = class THEN hits * 1.0::DOUBLE / above ELSE 0 END)
               / sum(CASE WHEN label = class THEN 1 ELSE 0 END) AS average_precision
        FROM (SELECT *, count(*) OVER (PARTITION BY class ORDER BY s DESC) AS above,
                     sum(CASE WHEN label = class THEN 1 ELSE 0 END)
                         OVER (PARTITION BY class ORDER BY s DESC) AS hits FROM scores)
        GROUP BY class""",
}


def _requirement(source):
    """Rows of `source` with the five size fields of their model."""
    names = ["gpu_memory_gb", "parameters_millions", "recommended_gpu", "batch_size_hint", "architecture_family"]

    def literal(x):
        return f"'{x}'" if isinstance(x, str) else str(x)

    fields = []
    for i, name in enumerate(names, 1):
        cases = [f"WHEN model = '{row[0]}' THEN {literal(row[i])}" for row in fixed.MODEL_METADATA]
        for row in fixed.MODEL_FALLBACKS[:-1]:
            test = " OR ".join(f"contains(model, '{text}')" for text in row[0])
            cases.append(f"WHEN {test} THEN {literal(row[i])}")
        fields.append(f"CASE {' '.join(cases)} ELSE {literal(fixed.MODEL_FALLBACKS[-1][i])} END AS {name}")
    return f"SELECT *, {', '.join(fields)} FROM {source}"


def _factors(column, values, default):
    cases = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in values.items())
    return f"CASE {column} {cases} ELSE {default}::DOUBLE END"


VIEWS["requirement"] = _requirement("grid")
VIEWS["estimates"] = f"""
    SELECT *, greatest(10, least(180, CAST(trunc(
        20.0::DOUBLE
        * CASE WHEN architecture_family LIKE '%Giant' THEN 3.0::DOUBLE
               WHEN architecture_family LIKE '%Huge' THEN 2.5::DOUBLE
               WHEN architecture_family LIKE '%Large' THEN 2.0::DOUBLE
               WHEN architecture_family LIKE '%Base' THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END
        * CASE WHEN task_type = 'zeroshot_retrieval' THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
        * {_factors("benchmark", fixed.DATASET_FACTORS, 1.0)}) AS INTEGER))) AS minutes
    FROM requirement"""
VIEWS["pending_group"] = f"""
    SELECT model, pretrained, string_agg(task_type || ':' || benchmark, ',' ORDER BY task_type, benchmark) AS runs,
           CAST(count(*) AS INTEGER) AS num_benchmarks
    FROM ledger WHERE status = 'pending' GROUP BY model, pretrained"""
VIEWS["log"] = f"""
    SELECT {KEYS}, event_type = 'error' AS failed, epoch_us(ts) AS started,
           CASE WHEN event_type <> 'error' OR value >= 5 THEN value END AS seconds,
           epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) AS ended
    FROM events JOIN parts ON user_id = p_partkey JOIN nations ON event_id % 25 = n_nationkey"""

# The same for evaluations by key: model-0, model-1 and model-2.
for _name in ("prototypes", "scores", "ranked", "pairs", "found_texts", "found_images", "class_ap"):
    _sql = VIEWS[_name]
    for _other in ("prototypes", "scores", "ranked", "pairs", "found_texts", "found_images"):
        _sql = _sql.replace(f"FROM {_other}", f"FROM keyed_{_other}").replace(
            f"JOIN {_other}", f"JOIN keyed_{_other}"
        )
    VIEWS[f"keyed_{_name}"] = _sql
VIEWS["keyed_prototypes"] = """
    SELECT m, label, embedding
    FROM (SELECT *, vec_id % 3 AS m FROM embeddings)
    JOIN (SELECT vec_id % 3 AS m, label, min(vec_id) AS vec_id FROM embeddings GROUP BY 1, 2)
    USING (m, label, vec_id)"""
VIEWS["keyed_scores"] = """
    SELECT p.m, e.vec_id, e.label, p.label AS class,
           round(list_cosine_similarity(e.embedding::DOUBLE[], p.embedding::DOUBLE[]), 12) AS s
    FROM embeddings e JOIN keyed_prototypes p ON e.vec_id % 3 = p.m"""
VIEWS["keyed_pairs"] = VIEWS["pairs"].replace("SELECT i.vec_id", "SELECT i.vec_id % 3 AS m, i.vec_id") + (
    " AND i.vec_id % 3 = t.vec_id % 3"
)
VIEWS["keyed_found_texts"] = VIEWS["keyed_found_texts"].replace("SELECT image,", "SELECT m, image,").replace(
    "GROUP BY image", "GROUP BY m, image"
)
VIEWS["keyed_found_images"] = VIEWS["keyed_found_images"].replace("SELECT text,", "SELECT m, text,").replace(
    "GROUP BY text", "GROUP BY m, text"
)
VIEWS["keyed_class_ap"] = (
    VIEWS["keyed_class_ap"]
    .replace("SELECT class AS label", "SELECT m, class AS label")
    .replace("PARTITION BY class", "PARTITION BY m, class")
    .replace("GROUP BY class", "GROUP BY m, class")
)

VIEWS["mapping"] = "SELECT * FROM (VALUES {}) AS t(name, task, web, root)".format(
    ", ".join(f"('{name}', '{task}', '{web}', '{root}')" for _, name, web, root, task in fixed.DATASET_MAPPING)
)

METRICS = {
    "classification": "accuracy, top5_accuracy, mean_per_class_recall",
    "retrieval": "image_retrieval_recall_at_5, text_retrieval_recall_at_5, mean_average_precision",
}
_ACC1 = "TRY_CAST(json_extract_string(safe, '$.metrics.acc1') AS DOUBLE)"


def _merged(source="completed"):
    def own(task, names):
        return ", ".join(f"CASE WHEN task_type = 'zeroshot_{task}' THEN {n} END AS {n}" for n in names.split(", "))

    return f"""SELECT model, pretrained, benchmark, task_type, {own("classification", METRICS["classification"])},
               {own("retrieval", METRICS["retrieval"])}, benchmark_run_at
               FROM {source} WHERE error_class IS NULL"""


SELECTS = {
    "ledger_read": "SELECT * FROM ledger",
    "dataset_mapping": """
        SELECT s || '_datasets' AS section, p_name || ' ' || p_partkey AS name,
               'wds/' || p_name || ' ' || p_partkey AS webdataset_name, 'hub' AS dataset_root,
               'zeroshot_' || s AS task
        FROM part CROSS JOIN (VALUES ('retrieval'), ('classification')) AS v(s)""",
    "result_listing": "SELECT substr(result_file, 9) AS file_name, CAST(strlen(doc) AS BIGINT) AS length FROM documents",
    "result_file_status": """
        SELECT substr(result_file, 9) AS file_name, coalesce(error_class, 'ok') AS status,
               CASE WHEN error_class IS NULL THEN accuracy END AS acc1 FROM parsed_docs""",
    "json_load_status": """
        SELECT result_file, coalesce(error_class, 'ok') AS status,
               CASE WHEN error_class IS NULL THEN accuracy END AS acc1,
               CASE WHEN error_class IS NULL THEN text_retrieval_recall_at_5 END AS text_recall
        FROM parsed_docs""",
    "model_catalog": "SELECT DISTINCT model, pretrained FROM parts",
    "metric_tables": _merged(),
    "benchmark_catalog": "SELECT 'zeroshot_classification' AS task_type, benchmark FROM (SELECT benchmark FROM items"
    " WHERE task_type = 'zeroshot_classification' UNION SELECT unnest({}))"
    " UNION ALL SELECT 'zeroshot_retrieval', unnest({})".format(
        _list(fixed.EXTRA_CLASSIFICATION),
        _list(name for section, name, *_ in fixed.DATASET_MAPPING if section == "retrieval_datasets"),
    ),
    "pair_grid": "SELECT * FROM grid",
    "dataset_config": f"""
        SELECT g.model, g.pretrained, g.task_type, g.benchmark,
               coalesce(web, benchmark) AS webdataset_name,
               coalesce(root, 'root') AS dataset_root,
               g.task_type AS task
        FROM grid g LEFT JOIN mapping m ON g.benchmark = m.name AND g.task_type = m.task""",
    "ledger_init": "SELECT *, '' AS result_file, '' AS timestamp, 'pending' AS status FROM grid",
    "ledger_merge": f"""
        SELECT {KEYS}, coalesce(result_file, '') AS result_file, coalesce(timestamp, '') AS timestamp,
               coalesce(status, 'pending') AS status
        FROM grid LEFT JOIN old USING ({KEYS})""",
    "added_cells": f"SELECT {KEYS} FROM grid EXCEPT SELECT {KEYS} FROM old",
    "ledger_upsert": "SELECT * FROM ledger",
    "status_counts": """
        SELECT task_type, count(*) AS total, count(*) FILTER (status = 'completed') AS completed,
               count(*) FILTER (status = 'pending') AS pending
        FROM ledger GROUP BY task_type""",
    "pending_rows": "SELECT * FROM ledger WHERE status = 'pending'",
    "group_rows": """
        SELECT * FROM ledger WHERE status = 'pending' AND model = 'ViT-L-14'
        AND pretrained = (SELECT min(pretrained) FROM parts WHERE model = 'ViT-L-14')""",
    "filename_parse": """
        SELECT file_name, NULL AS model, NULL AS pretrained, NULL AS task_type, NULL AS benchmark
        FROM listing WHERE starts_with(file_name, 'log_')
        UNION ALL SELECT file_name, model, pretrained, task_type, benchmark FROM parsed""",
    "expected_name": f"""
        SELECT {KEYS}, benchmark || '_' || pretrained || '_' || model || '_en_' || task_type || '.json' AS file_name
        FROM grid""",
    "unmatched_files": """
        SELECT file_name, (SELECT count(*) FROM listing WHERE starts_with(file_name, 'log_')) AS total
        FROM listing WHERE starts_with(file_name, 'log_') ORDER BY file_name LIMIT 5""",
    "latest_by_name": """
        SELECT file_name, 'results/' || file_name AS result_file,
               strftime(max(mtime), '%Y-%m-%dT%H:%M:%S') AS timestamp
        FROM listing GROUP BY file_name""",
    "ambiguous_names": """
        SELECT benchmark || '_' || pretrained || '_' || model || '_en_' || task_type || '.json' AS file_name,
               count(*) AS cells
        FROM items GROUP BY 1 HAVING count(*) > 1""",
    "orphan_results": f"""
        SELECT {KEYS}, 'results/' || file_name AS result_file FROM parsed
        WHERE ({KEYS}) NOT IN (SELECT ({KEYS}) FROM grid)""",
    "match_by_name": f"""
        SELECT {KEYS}, 'results/' || run_name AS result_file,
               strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS timestamp
        FROM names WHERE l_returnflag <> 'R' AND weights <> 'openai'""",
    "unexpected_files": """
        SELECT file_name FROM listing
        WHERE starts_with(file_name, 'log_') OR contains(file_name, '_openai_')""",
    "completed_docs": f"""
        SELECT {KEYS}, benchmark_run_at, result_file, error_class,
               CASE WHEN error_class IS NULL THEN accuracy END AS acc1 FROM completed""",
    "classification_metrics": f"""
        SELECT model, pretrained, benchmark, benchmark_run_at, {METRICS["classification"]}
        FROM completed WHERE error_class IS NULL AND task_type = 'zeroshot_classification'""",
    "retrieval_metrics": f"""
        SELECT model, pretrained, benchmark, benchmark_run_at, {METRICS["retrieval"]}
        FROM completed WHERE error_class IS NULL AND task_type = 'zeroshot_retrieval'""",
    "merged_metrics": _merged(),
    "parse_errors": "SELECT result_file, error_class FROM completed WHERE error_class IS NOT NULL",
    "pending_groups": "SELECT * FROM pending_group",
    "sampled_groups": """
        SELECT model, pretrained, num_benchmarks FROM pending_group
        ORDER BY md5('7|' || model || '|' || pretrained) LIMIT 100""",
    "group_plan": _requirement("pending_group").replace("SELECT *,", "SELECT model, pretrained, num_benchmarks,"),
    "plan_summary": """
        SELECT count(*) AS groups, CAST(sum(num_benchmarks) AS BIGINT) AS total_benchmarks,
               CAST(sum(2 * num_benchmarks) AS BIGINT) AS total_minutes,
               CAST(trunc(8 / 0.125) AS INTEGER) AS max_concurrent_jobs
        FROM pending_group""",
    "first_n_per_group": f"""
        SELECT {KEYS} FROM (SELECT *, row_number() OVER (PARTITION BY model, pretrained
                                       ORDER BY task_type, benchmark) AS n
                            FROM ledger WHERE status = 'pending') WHERE n <= 3""",
    "group_label": """
        SELECT model, pretrained, replace('eval/group-' || model || '-' || pretrained, '/', '-') AS label
        FROM parts""",
    "run_summary": """
        SELECT model, pretrained, count(*) AS attempted, count(*) FILTER (failed) AS failed,
               coalesce(sum(seconds), 0) AS benchmark_seconds,
               (max(ended) - min(started)) / 1000000.0::DOUBLE AS overall_seconds,
               (max(ended) - min(started)) / 1000000.0::DOUBLE - coalesce(sum(seconds), 0) AS overhead_seconds,
               count(*) FILTER (failed) = 0 AS ok
        FROM log GROUP BY model, pretrained""",
    "model_requirement": _requirement("(SELECT model, pretrained FROM parts)"),
    "runtime_estimate": f"SELECT {KEYS}, minutes FROM estimates",
    "cost_estimate": f"""
        SELECT {KEYS}, round({_factors("recommended_gpu || ':1'", fixed.GPU_HOURLY_RATES, 2.0)} * (minutes / 60.0::DOUBLE)
               * CASE WHEN task_type = 'zeroshot_classification' THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END, 6) AS cost
        FROM estimates""",
    "incremental_ingest": f"""
        SELECT g.model, g.pretrained, g.task_type, g.benchmark, coalesce(s.file_name, '') AS file_name,
               CASE WHEN s.model IS NULL THEN 'pending' ELSE 'completed' END AS status,
               CASE WHEN s.error_class IS NULL THEN s.accuracy END AS acc1,
               CASE WHEN n.n IS NULL THEN 0 ELSE greatest(n.n - 1, 1) END AS files
        FROM grid g LEFT JOIN stored s USING ({KEYS})
        LEFT JOIN (SELECT {KEYS}, count(*) AS n FROM documents GROUP BY {KEYS}) n USING ({KEYS})""",
    "zeroshot_accuracy": """
        SELECT count(*) FILTER (n = 1) AS items,
               round(sum(CASE WHEN n = 1 AND class = label THEN 1 ELSE 0 END)::DOUBLE / count(*) FILTER (n = 1), 6) AS acc1,
               round(sum(CASE WHEN class = label THEN 1 ELSE 0 END)::DOUBLE / count(*) FILTER (n = 1), 6) AS acc5
        FROM ranked WHERE n <= 5""",
    "mean_per_class_recall": """
        SELECT count(*) AS classes, round(avg(r), 6) AS mean_per_class_recall
        FROM (SELECT label, avg(CASE WHEN class = label THEN 1.0 ELSE 0.0 END) AS r
              FROM ranked WHERE n = 1 GROUP BY label)""",
    "retrieval_recall_at_5": """
        SELECT count(*) AS queries, round(avg(hit::INTEGER), 6) AS recall_at_5, 'texts' AS found FROM found_texts
        UNION ALL SELECT count(*), round(avg(hit::INTEGER), 6), 'images' FROM found_images""",
    "retrieval_recall_by_blocks": """
        SELECT count(*) AS queries, round(avg(hit::INTEGER), 6) AS recall_at_5, 'texts' AS found FROM found_texts
        UNION ALL SELECT count(*), round(avg(hit::INTEGER), 6), 'images' FROM found_images""",
    "class_average_precision": """
        SELECT label, round(average_precision, 6) AS average_precision FROM class_ap""",
    "mean_average_precision": """
        SELECT count(*) AS classes, round(avg(average_precision), 6) AS mean_average_precision FROM class_ap""",
    "grouped_evaluation": """
        SELECT 'model-' || a.m AS model, 'laion400m_e32' AS pretrained, 'embeddings' AS benchmark,
               'zeroshot_classification' AS task_type, round(acc1, 6) AS accuracy, round(acc5, 6) AS top5_accuracy,
               round(r, 6) AS mean_per_class_recall, NULL::DOUBLE AS image_retrieval_recall_at_5,
               NULL::DOUBLE AS text_retrieval_recall_at_5, NULL::DOUBLE AS mean_average_precision
        FROM (SELECT m, sum(CASE WHEN n = 1 AND class = label THEN 1 ELSE 0 END)::DOUBLE / count(DISTINCT vec_id) AS acc1,
                     sum(CASE WHEN class = label THEN 1 ELSE 0 END)::DOUBLE / count(DISTINCT vec_id) AS acc5
              FROM keyed_ranked WHERE n <= 5 GROUP BY m) a
        JOIN (SELECT m, avg(r) AS r FROM (
                SELECT m, label, avg(CASE WHEN class = label THEN 1.0 ELSE 0.0 END) AS r
                FROM keyed_ranked WHERE n = 1 GROUP BY m, label) GROUP BY m) b ON a.m = b.m
        UNION ALL
        SELECT 'model-' || i.m, 'laion400m_e32', 'embeddings', 'zeroshot_retrieval', NULL, NULL, NULL,
               round(i.r, 6), round(t.r, 6), round(p.r, 6)
        FROM (SELECT m, avg(hit::INTEGER) AS r FROM keyed_found_images GROUP BY m) i
        JOIN (SELECT m, avg(hit::INTEGER) AS r FROM keyed_found_texts GROUP BY m) t ON i.m = t.m
        JOIN (SELECT m, avg(average_precision) AS r FROM keyed_class_ap GROUP BY m) p ON i.m = p.m""",
}
SELECTS["group_plan"] = (
    f"SELECT model, pretrained, num_benchmarks, recommended_gpu AS gpu_requirement, "
    f"2 * num_benchmarks AS estimated_runtime_minutes FROM ({_requirement('pending_group')})"
)


def sql(name: str) -> str:
    """The query with the views it needs, each after those it reads."""
    import re

    needed = []

    def add(text):
        for view in re.findall(r"(?:FROM|JOIN)\s+(\w+)", text):
            if view in VIEWS and view not in needed:
                add(VIEWS[view])
                needed.append(view)

    add(SELECTS[name])
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed)
    return (f"WITH {views}\n" if needed else "") + SELECTS[name]
