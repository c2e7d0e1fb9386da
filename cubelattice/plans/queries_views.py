"""View queries, each with its oracle over the cube's tables."""

from __future__ import annotations

from cubelattice.operators import views as v
from cubelattice.plans.queries_statistics import ISO
from cubelattice.sources.catalog_rows import NOW

_PCT = "floor(chunks_completed * 100.0::DOUBLE / chunks_total * 10 + 0.5) / 10"
_SUM = "CAST(sum(CAST(value AS DECIMAL(38,6))) AS DOUBLE)"

PAIRS = {
    "v_units": (lambda wh: v.v_units(wh), "SELECT unit_id, code, symbol, name_ro, name_en, upper(strip_accents(name_ro)) AS name_normalized FROM units"),
    "v_unresolved_labels": (lambda wh: v.v_unresolved_labels(wh), "SELECT label_original, label_normalized, context_type, context_hint, reason, created_at FROM label_mappings WHERE target IS NULL"),
    "v_sync_checkpoints": (
        lambda wh: v.v_sync_checkpoints(wh, NOW),
        f"SELECT chunk_id, matrix_code, chunk_hash, status, cells_returned, error_message, retry_count, next_retry_at, coalesce(CAST(next_retry_at AS TIMESTAMP) > TIMESTAMP '{NOW}', false) AS is_waiting FROM chunks JOIN matrices USING (matrix_id)",
    ),
    "sync_tasks_page": (lambda wh: v.tasks_page(wh, 20, 3), "SELECT task_id, matrix_id, status, created_at FROM tasks ORDER BY created_at DESC, task_id DESC LIMIT 20 OFFSET 3"),
    "sync_tasks_by_status": (lambda wh: v.tasks_by_status(wh), "SELECT CASE status WHEN 'RUNNING' THEN 1 WHEN 'PENDING' THEN 2 ELSE 3 END AS status_rank, status, count(*) AS task_count, min(created_at) AS oldest, max(created_at) AS newest FROM tasks GROUP BY status"),
    "v_matrices": (lambda wh: v.v_matrices(wh), "SELECT matrix_code, m.name_ro, m.name_en, c.code AS context_code, c.path AS context_path, periodicity[1] AS first_periodicity, year_from, year_to, has_uat, has_county, sync_status FROM matrices m LEFT JOIN contexts c USING (context_id)"),
    "v_territories": (lambda wh: v.v_territories(wh), "SELECT t.code, t.name, upper(t.name) AS name_normalized, t.level, t.path, p.code AS parent_code, p.name AS parent_name FROM territories t LEFT JOIN territories p ON p.territory_id = t.parent_id"),
    "v_contexts": (lambda wh: v.v_contexts(wh), "SELECT code, name_ro, level, (SELECT count(*) FROM contexts d WHERE d.parent_id = c.context_id) AS child_count, (SELECT count(*) FROM matrices m WHERE m.context_id = c.context_id) AS matrix_count FROM contexts c"),
    "v_time_periods": (lambda wh: v.v_time_periods(wh), f"SELECT time_period_id, {ISO} AS iso_period, periodicity, label_ro, label_en FROM time_periods"),
    "v_sync_tasks": (
        lambda wh: v.v_sync_tasks(wh, NOW),
        f"SELECT task_id, matrix_code, status, CASE WHEN chunks_total > 0 THEN {_PCT} ELSE 0 END AS progress_pct, coalesce(CAST(locked_until AS TIMESTAMP) > TIMESTAMP '{NOW}', false) AS is_locked, created_at FROM tasks JOIN matrices USING (matrix_id)",
    ),
    "v_sync_task_summary": (lambda wh: v.v_task_summary(wh), "SELECT status, count(*) AS task_count, CAST(sum(chunks_total) AS BIGINT) AS chunks_total, CAST(sum(chunks_completed) AS BIGINT) AS chunks_completed, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, CAST(sum(rows_updated) AS BIGINT) AS rows_updated FROM tasks GROUP BY status"),
    "v_failed_chunks": (
        lambda wh: v.v_failed_chunks(wh, NOW),
        f"SELECT chunk_id, matrix_code, chunk_hash, retry_count, error_message, status = 'FAILED' AND (next_retry_at IS NULL OR CAST(next_retry_at AS TIMESTAMP) <= TIMESTAMP '{NOW}') AS ready_to_retry, CAST(row_number() OVER (ORDER BY next_retry_at NULLS FIRST, chunk_id) AS INTEGER) AS place FROM chunks JOIN matrices USING (matrix_id) WHERE status IN ('FAILED', 'EXHAUSTED')",
    ),
    "v_matrix_sync_status": (
        lambda wh: v.v_matrix_sync_status(wh),
        f""", latest AS (SELECT matrix_id, status AS task_status, CASE WHEN chunks_total > 0 THEN {_PCT} END AS progress_pct FROM tasks QUALIFY row_number() OVER (PARTITION BY matrix_id ORDER BY created_at DESC, task_id DESC) = 1),
        coverage AS (SELECT matrix_id, count(*) AS fact_count, count(DISTINCT territory_id) AS territory_count, min(year) AS min_year, max(year) AS max_year FROM statistics JOIN time_periods USING (time_period_id) GROUP BY 1),
        history AS (SELECT matrix_id, count(*) AS task_count, count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'FAILED') AS failed FROM tasks GROUP BY 1)
        SELECT matrix_code, CASE WHEN task_status IN ('PENDING', 'PLANNING', 'RUNNING') THEN 'SYNCING' WHEN fact_count > 0 AND task_status = 'COMPLETED' THEN 'SYNCED' WHEN fact_count > 0 THEN 'PARTIAL' WHEN task_status = 'FAILED' THEN 'FAILED' ELSE 'NOT_SYNCED' END AS status,
               task_status, progress_pct, coalesce(fact_count, 0) AS fact_count, territory_count, min_year, max_year, coalesce(task_count, 0) AS task_count, coalesce(completed, 0) AS completed, coalesce(failed, 0) AS failed
        FROM matrices LEFT JOIN latest USING (matrix_id) LEFT JOIN coverage USING (matrix_id) LEFT JOIN history USING (matrix_id)""",
    ),
    "sync_status_with_data": (lambda wh: v.sync_status(wh, True), "SELECT matrix_code, sync_status, count(*) AS fact_count FROM matrices JOIN statistics USING (matrix_id) GROUP BY 1, 2"),
    "sync_status_without_data": (lambda wh: v.sync_status(wh, False), "SELECT matrix_code, sync_status, CAST(0 AS BIGINT) AS fact_count FROM matrices WHERE matrix_id NOT IN (SELECT matrix_id FROM statistics)"),
    "sync_status_counts": (
        lambda wh: v.status_counts(wh),
        "SELECT count(*) AS total, count(*) FILTER (matrix_id IN (SELECT matrix_id FROM statistics)) AS with_data, " + ", ".join(f"count(*) FILTER (sync_status = '{k}') AS {k.lower()}" for k in ("PENDING", "SYNCING", "SYNCED", "FAILED", "STALE")) + " FROM matrices",
    ),
    "queue_next_task": (lambda wh: v.next_task(wh, NOW), f"SELECT task_id, matrix_id, status, priority FROM tasks WHERE status = 'PENDING' OR (status IN ('PLANNING', 'RUNNING') AND CAST(locked_until AS TIMESTAMP) < TIMESTAMP '{NOW}') ORDER BY priority DESC, created_at, task_id LIMIT 1"),
    "mv_national_timeseries": (
        lambda wh: v.mv_national(wh),
        f"SELECT matrix_id, year, periodicity, count(*) AS fact_count, {_SUM} AS sum_value, round({_SUM} / count(value), 4) AS avg_value, min(value) AS min_value, max(value) AS max_value, count(*) FILTER (value IS NULL) AS null_count FROM statistics JOIN time_periods USING (time_period_id) LEFT JOIN territories USING (territory_id) WHERE level = 'NATIONAL' OR territory_id IS NULL GROUP BY 1, 2, 3",
    ),
    "mv_annual_nuts2": (
        lambda wh: v.mv_nuts2(wh),
        f"SELECT matrix_id, code AS territory_code, year, count(*) AS fact_count, {_SUM} AS sum_value FROM statistics JOIN time_periods USING (time_period_id) JOIN territories USING (territory_id) WHERE level = 'NUTS2' AND periodicity = 'ANNUAL' GROUP BY 1, 2, 3",
    ),
    "mv_matrix_stats": (
        lambda wh: v.mv_matrix_stats(wh),
        "SELECT matrix_code, count(natural_key) AS fact_count, count(DISTINCT territory_id) AS territory_count, count(DISTINCT time_period_id) AS period_count, min(year) AS min_year, max(year) AS max_year, count(*) FILTER (value IS NULL) AS null_count FROM matrices LEFT JOIN statistics USING (matrix_id) LEFT JOIN time_periods USING (time_period_id) GROUP BY 1",
    ),
}
