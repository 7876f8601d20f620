"""The expected results as plain SQL over the same tables.

Written independently of the DataFrame code: windows and distinct counts where
that uses pre-aggregation, ranks where that uses histograms.
"""

from __future__ import annotations

# Named inputs: name -> (inputs it needs, SQL).
INPUTS: dict[str, tuple[tuple[str, ...], str]] = {
    "e0": (
        (),
        """
        SELECT event_id AS id, ts, user_id, value, json_extract_string(props, '$.k') AS k,
               CASE event_type WHEN 'purchase' THEN 'PushEvent' WHEN 'click' THEN 'PullRequestEvent'
                    WHEN 'view' THEN 'WatchEvent' WHEN 'signup' THEN 'ForkEvent'
                    WHEN 'error' THEN 'IssuesEvent' END AS t
        FROM events""",
    ),
    "ev": (
        ("e0",),
        """
        SELECT CAST(id AS VARCHAR) AS event_id, t AS event_type, ts AS event_ts,
               CAST(ts AS DATE) AS event_date, true AS is_public, user_id AS actor_id,
               'u' || user_id AS actor_login, CAST(k AS BIGINT) AS repo_id, 'r' || k AS repo_name,
               CAST(NULL AS BIGINT) AS org_id, CAST(NULL AS VARCHAR) AS org_login,
               CASE WHEN t = 'PullRequestEvent' THEN
                         CASE id % 4 WHEN 0 THEN 'opened' WHEN 3 THEN 'merged' ELSE 'closed' END
                    WHEN t = 'IssuesEvent' THEN CASE id % 2 WHEN 0 THEN 'opened' ELSE 'closed' END
                    WHEN t = 'WatchEvent' THEN 'started' END AS payload_action,
               CASE WHEN t = 'PullRequestEvent' THEN user_id % 10 END AS payload_number,
               CASE WHEN t = 'IssuesEvent' THEN user_id END AS issue_number,
               CASE WHEN t = 'IssuesEvent' THEN CASE id % 2 WHEN 0 THEN 'open' ELSE 'closed' END END
                    AS issue_state,
               CASE WHEN t = 'PullRequestEvent' THEN user_id % 10 END AS pr_number,
               CASE WHEN t = 'PullRequestEvent' THEN CASE id % 4 WHEN 0 THEN 'open' ELSE 'closed' END END
                    AS pr_state,
               CASE WHEN t = 'PullRequestEvent' AND id % 4 = 1 THEN true END AS pr_merged,
               CASE WHEN t = 'PushEvent' THEN id END AS push_id,
               CASE WHEN t = 'PushEvent' THEN CAST(floor(value / 10) AS BIGINT) END AS push_size,
               CASE WHEN t = 'PushEvent' THEN CAST(floor(value / 10) AS BIGINT) END AS push_distinct_size,
               CASE WHEN t = 'PushEvent' THEN CAST(floor(value / 10) AS INTEGER) END
                    AS commit_count,
               'W' || CAST(floor((day(ts) - 1) / 7) + 1 AS INTEGER) AS era
        FROM e0""",
    ),
    "seed": (
        (),
        """
        SELECT 'r' || p_size AS repo_name, min(p_brand) AS category,
               nullif(lower(arg_max(p_type, p_partkey)), 'standard') AS library_name
        FROM part GROUP BY p_size""",
    ),
    "md0": (
        (),
        """
        SELECT p_partkey AS key, p_size AS size, p_type,
               split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
               p_brand || CASE WHEN p_size = 48 THEN '-' ELSE '/' END || replace(p_name, ' ', '-')
                   || '-' || p_partkey AS raw_id,
               CASE WHEN p_size <> 47 THEN p_brand END AS raw_author, p_brand, p_name,
               CASE WHEN p_size % 5 <> 0 THEN upper(split_part(p_name, ' ', 2)) END AS raw_tag,
               CASE WHEN p_type <> 'STANDARD' THEN p_type END AS raw_library,
               CASE p_size % 6 WHEN 0 THEN 0 WHEN 1 THEN p_size WHEN 2 THEN p_partkey + 101
                    WHEN 3 THEN p_partkey * 1000 WHEN 4 THEN p_partkey * 1000000 END AS downloads,
               CAST(DATE '2023-01-01' + CAST(p_partkey % 730 AS INTEGER) AS DATE) AS modified,
               CASE WHEN p_size <> 45 THEN
                    CAST(DATE '2022-03-02' + CAST(p_partkey * 7 % 400 AS INTEGER) AS DATE) END AS created
        FROM part""",
    ),
    # Cleaned models: flags, ids and dates checked, labels normalized.
    "md": (
        ("md0",),
        """
        SELECT raw_id AS model_id, p_brand AS owner, split_part(raw_id, '/', 2) AS model_name,
               lower(raw_author) AS author, modified AS last_modified_date, created,
               coalesce(lower(raw_tag), 'unknown') AS pipeline_tag,
               coalesce(lower(raw_library), 'unknown') AS library_name,
               CAST(downloads AS BIGINT) AS downloads, CAST(size AS BIGINT) AS likes,
               CAST(downloads * 2 AS BIGINT) AS downloads_all_time,
               CAST(size % 7 AS BIGINT) AS trending_score,
               CASE WHEN size <> 44 THEN replace(p_name, ' ', ',') END AS tags,
               CAST(CASE WHEN size <> 44 THEN len(string_split(p_name, ' ')) ELSE 0 END AS INTEGER) AS tag_count,
               w2 AS training_datasets, 'en' AS languages,
               CASE WHEN size % 3 = 0 THEN p_brand END AS base_model,
               CASE WHEN size % 4 <> 0 THEN key % 97 * 1000000000 END AS parameter_count,
               w1 AS model_type, p_type AS architectures,
               CASE WHEN size <= 4 THEN 'auto' WHEN size <= 8 THEN 'False' END AS gated,
               CASE w1 WHEN 'red' THEN 'apache-2.0' WHEN 'large' THEN 'mit' WHEN 'blue' THEN 'gpl-3.0'
                    WHEN 'new' THEN 'apache-2.0' WHEN 'cold' THEN 'custom' WHEN 'hot' THEN 'bsd-3-clause'
                    WHEN 'old' THEN 'cc-by-4.0' ELSE 'unknown' END AS license
        FROM md0 WHERE size NOT IN (46, 48, 49, 50)""",
    ),
    "pkg": (
        (),
        """
        SELECT lower(p_type) AS project, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month,
               CAST(sum(l_quantity) AS BIGINT) AS downloads
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    ),
    "totals": (
        ("ev",),
        """
        SELECT repo_name, count(*) FILTER (event_type = 'WatchEvent') AS stars,
               count(*) FILTER (event_type = 'ForkEvent') AS forks,
               count(*) FILTER (event_type = 'PushEvent') AS pushes,
               count(*) FILTER (event_type = 'PullRequestEvent') AS prs,
               count(*) FILTER (event_type = 'IssuesEvent') AS issues,
               count(DISTINCT actor_login) AS distinct_actors,
               count(DISTINCT event_date) AS active_days, count(event_id) AS total_events
        FROM ev GROUP BY repo_name""",
    ),
    "top": (("totals",), "SELECT * FROM totals ORDER BY stars DESC, repo_name LIMIT 60"),
    "topai": (
        ("top", "seed"),
        "SELECT *, repo_name IN (SELECT repo_name FROM seed) AS is_ai FROM top",
    ),
    "daily": (
        ("ev", "seed"),
        """
        SELECT repo_name, event_date, count(*) FILTER (event_type = 'WatchEvent') AS stars,
               count(*) FILTER (event_type = 'ForkEvent') AS forks,
               count(*) FILTER (event_type = 'PushEvent') AS pushes,
               count(*) FILTER (event_type = 'PullRequestEvent') AS prs,
               count(*) FILTER (event_type = 'IssuesEvent') AS issues,
               count(DISTINCT actor_login) AS distinct_actors, count(event_id) AS total_events
        FROM ev WHERE repo_name IN (SELECT repo_name FROM seed) GROUP BY 1, 2""",
    ),
    "yearly": (
        ("daily",),
        """
        SELECT repo_name, CAST(sum(stars) AS BIGINT) AS gh_stars_2025,
               CAST(sum(forks) AS BIGINT) AS gh_forks_2025, CAST(sum(pushes) AS BIGINT) AS gh_pushes_2025,
               CAST(sum(prs) AS BIGINT) AS gh_prs_2025, CAST(sum(issues) AS BIGINT) AS gh_issues_2025,
               CAST(sum(distinct_actors) AS BIGINT) AS gh_actors_2025,
               count(DISTINCT event_date) AS gh_active_days
        FROM daily GROUP BY 1""",
    ),
    "libs": (
        ("md",),
        """
        SELECT library_name, count(*) AS hf_model_count,
               CAST(sum(downloads) AS BIGINT) AS hf_total_downloads,
               CAST(sum(likes) AS BIGINT) AS hf_total_likes, round(avg(downloads), 6) AS hf_avg_downloads
        FROM md WHERE library_name <> 'unknown' GROUP BY 1""",
    ),
    "joined": (
        ("libs", "seed", "yearly"),
        """
        SELECT s.repo_name, s.category, l.library_name, l.hf_model_count, l.hf_total_downloads,
               l.hf_total_likes, y.gh_stars_2025, y.gh_forks_2025, y.gh_pushes_2025, y.gh_prs_2025,
               y.gh_issues_2025, y.gh_active_days
        FROM libs l JOIN seed s ON l.library_name = s.library_name
        LEFT JOIN yearly y ON y.repo_name = s.repo_name""",
    ),
    "pyear": (
        ("pkg",),
        """
        SELECT project, CAST(sum(downloads) AS BIGINT) AS pypi_downloads_2025,
               count(DISTINCT month) AS pypi_months_tracked
        FROM pkg GROUP BY 1""",
    ),
    "measures": (
        ("joined", "pyear"),
        """
        SELECT j.*, p.pypi_downloads_2025, p.pypi_months_tracked
        FROM joined j LEFT JOIN pyear p ON p.project = j.library_name""",
    ),
    "scored": (
        ("measures",),
        """
        SELECT *, 0.30 * ln(1 + coalesce(hf_total_downloads, 0))
                      + 0.20 * ln(1 + coalesce(pypi_downloads_2025, 0))
                      + 0.15 * ln(1 + coalesce(gh_stars_2025, 0))
                      + 0.15 * ln(1 + coalesce(gh_pushes_2025, 0))
                      + 0.10 * ln(1 + coalesce(gh_prs_2025, 0))
                      + 0.10 * ln(1 + coalesce(gh_active_days, 0)) AS health_score
        FROM measures""",
    ),
    # Star bursts at the three grains the queries use.
    "watch": (
        ("ev", "top"),
        """
        SELECT repo_name, event_date, strftime(event_date, '%Y-%m') AS month,
               strftime(date_trunc('week', event_date), '%Y-%m-%d') AS week
        FROM ev WHERE event_type = 'WatchEvent' AND repo_name IN (SELECT repo_name FROM top)""",
    ),
    "health": (
        ("ev", "top", "seed"),
        """
        SELECT h.repo_name, h.total_contributors, p.total_pushes, p.push_contributors, p.top1_pushes,
               round(p.top1_pushes / (p.total_pushes + 1), 3) AS top1_push_ratio, r.pr_contributors,
               h.repo_name IN (SELECT repo_name FROM seed) AS is_ai
        FROM (SELECT repo_name, count(DISTINCT actor_login) AS total_contributors
              FROM ev WHERE repo_name IN (SELECT repo_name FROM top) GROUP BY 1) h
        LEFT JOIN (SELECT repo_name, CAST(sum(n) AS BIGINT) AS total_pushes,
                          count(DISTINCT actor_login) AS push_contributors, max(n) AS top1_pushes
                   FROM (SELECT repo_name, actor_login, count(*) AS n FROM ev
                         WHERE event_type = 'PushEvent' GROUP BY 1, 2) GROUP BY 1) p
               ON p.repo_name = h.repo_name
        LEFT JOIN (SELECT repo_name, count(DISTINCT actor_login) AS pr_contributors FROM ev
                   WHERE event_type = 'PullRequestEvent' GROUP BY 1) r ON r.repo_name = h.repo_name""",
    ),
    "summary": (
        ("ev",),
        """
        SELECT era, count(*) AS total_events, count(DISTINCT repo_name) AS distinct_repos,
               count(DISTINCT actor_login) AS distinct_actors,
               count(*) FILTER (event_type = 'PushEvent') AS total_pushes,
               count(DISTINCT CASE WHEN event_type = 'PullRequestEvent' THEN repo_name || '#' || pr_number END)
                   AS distinct_prs,
               count(*) FILTER (event_type = 'PullRequestEvent') AS total_pr_events,
               count(*) FILTER (event_type = 'WatchEvent') AS total_stars,
               count(DISTINCT CASE WHEN event_type = 'PullRequestEvent'
                     AND ((payload_action = 'closed' AND pr_merged) OR payload_action = 'merged')
                     THEN repo_name || '#' || pr_number END) AS merged_prs,
               round(avg(push_distinct_size), 6) AS avg_commit_size,
               quantile_disc(push_distinct_size, 0.5) AS median_commit_size
        FROM ev GROUP BY era""",
    ),
    "sizes": (
        ("ev",),
        """
        SELECT era, count(*) FILTER (push_distinct_size = 0) AS commits_eq_0,
               count(*) FILTER (push_distinct_size = 1) AS commits_eq_1,
               count(*) FILTER (push_distinct_size BETWEEN 2 AND 5) AS commits_2_5,
               count(*) FILTER (push_distinct_size BETWEEN 6 AND 20) AS commits_6_20,
               count(*) FILTER (push_distinct_size > 20) AS commits_gt_20,
               count(push_distinct_size) AS total_push_events
        FROM ev GROUP BY era""",
    ),
    "ratios": (
        ("ev",),
        """
        SELECT era, repo_name, count(*) FILTER (event_type = 'PushEvent') AS pushes,
               count(DISTINCT CASE WHEN event_type = 'PullRequestEvent' THEN pr_number END) AS prs,
               count(DISTINCT actor_login) AS contributors,
               count(DISTINCT CASE WHEN event_type = 'PullRequestEvent' THEN pr_number END)
                   / count(*) FILTER (event_type = 'PushEvent') AS r
        FROM ev GROUP BY 1, 2 HAVING count(*) FILTER (event_type = 'PushEvent') >= 10""",
    ),
    "targets": (
        ("top", "seed"),
        """
        SELECT repo_name, true AS is_ai FROM seed
        UNION ALL
        SELECT repo_name, false FROM (SELECT repo_name FROM top
            WHERE repo_name NOT IN (SELECT repo_name FROM seed) ORDER BY stars DESC, repo_name LIMIT 20)""",
    ),
    "tev": (("ev", "targets"), "SELECT ev.*, targets.is_ai FROM ev JOIN targets USING (repo_name)"),
    "opened": (
        ("tev",),
        "SELECT * FROM tev WHERE event_type = 'PullRequestEvent' AND payload_action = 'opened'",
    ),
    "merges": (
        ("tev",),
        """
        SELECT * FROM tev WHERE event_type = 'PullRequestEvent'
          AND ((payload_action = 'closed' AND pr_merged) OR payload_action = 'merged')""",
    ),
    "lead": (
        ("opened", "merges"),
        """
        SELECT o.era, o.repo_name, o.is_ai, o.pr_number,
               CAST(epoch(date_trunc('second', min(m.event_ts)))
                    - epoch(date_trunc('second', o.ts)) AS BIGINT) AS sec, sec / 3600 AS h
        FROM (SELECT era, repo_name, is_ai, pr_number, min(event_ts) AS ts FROM opened GROUP BY ALL) o
        JOIN merges m ON m.era = o.era AND m.repo_name = o.repo_name AND m.pr_number = o.pr_number
                     AND m.event_ts >= o.ts
        GROUP BY o.era, o.repo_name, o.is_ai, o.pr_number, o.ts""",
    ),
    "lead_any": (
        ("opened", "merges"),
        """
        SELECT o.era, o.repo_name, o.is_ai, o.pr_number,
               CAST(epoch(date_trunc('second', min(m.event_ts)))
                    - epoch(date_trunc('second', o.ts)) AS BIGINT) AS sec, sec / 3600 AS h
        FROM (SELECT repo_name, is_ai, pr_number, min(event_ts) AS ts, arg_min(era, event_ts) AS era
              FROM opened GROUP BY repo_name, is_ai, pr_number) o
        JOIN merges m ON m.repo_name = o.repo_name AND m.pr_number = o.pr_number AND m.event_ts >= o.ts
        GROUP BY o.era, o.repo_name, o.is_ai, o.pr_number, o.ts""",
    ),
    "mtime": (
        ("lead",),
        """
        SELECT era, repo_name, is_ai, count(pr_number) AS merged_pr_count, round(avg(sec) / 3600, 6) AS avg_merge_hours,
               round(quantile_disc(h, 0.5), 6) AS median_merge_hours,
               round(quantile_disc(h, 0.75), 6) AS p75_merge_hours,
               round(quantile_disc(h, 0.9), 6) AS p90_merge_hours
        FROM lead WHERE h BETWEEN 0 AND 8760 GROUP BY 1, 2, 3""",
    ),
    "prdays": (
        ("opened",),
        "SELECT era, repo_name, is_ai, event_date, count(*) AS pr_opened FROM opened GROUP BY 1, 2, 3, 4",
    ),
    "prcount": (
        ("prdays",),
        """
        SELECT era, repo_name, is_ai, CAST(sum(pr_opened) AS BIGINT) AS total_prs,
               avg(pr_opened) AS avg_daily_prs, quantile_disc(pr_opened, 0.5) AS median_daily_prs,
               max(pr_opened) AS peak_daily_prs
        FROM prdays GROUP BY 1, 2, 3""",
    ),
    "cdays": (
        ("tev",),
        """
        SELECT era, repo_name, is_ai, event_date, CAST(sum(push_distinct_size) AS BIGINT) AS daily_commits,
               count(*) AS daily_pushes, avg(push_distinct_size) AS avg_commits_per_push
        FROM tev WHERE event_type = 'PushEvent' AND push_distinct_size IS NOT NULL GROUP BY 1, 2, 3, 4""",
    ),
    "commits": (
        ("cdays",),
        """
        SELECT era, repo_name, is_ai, CAST(sum(daily_commits) AS BIGINT) AS total_commits,
               avg(daily_commits) AS avg_daily_commits,
               quantile_disc(daily_commits, 0.5) AS median_daily_commits,
               avg(avg_commits_per_push) AS avg_commits_per_push
        FROM cdays GROUP BY 1, 2, 3""",
    ),
    "weekend": (("ev",), "SELECT *, dayofweek(event_date) IN (0, 6) AS is_weekend FROM ev"),
    "pusher": (
        ("ev",),
        """
        SELECT era, actor_login, count(*) AS n, count(DISTINCT event_date) AS d,
               count(DISTINCT repo_name) AS r, count(*) / count(DISTINCT event_date) AS pd
        FROM ev WHERE event_type = 'PushEvent' GROUP BY 1, 2""",
    ),
    # Two versions of the data to compare.
    "newer": (("ev",), "SELECT * FROM ev WHERE event_date > DATE '2024-01-01'"),
    "older": (("ev",), "SELECT * FROM ev WHERE event_type <> 'ForkEvent'"),
    # Raw records: each event delivered twice, plus three defective variants of it.
    "variants": (
        (),
        "SELECT unnest(['ok', 'copy', 'other_type', 'bad_time', 'no_repo']) AS variant",
    ),
    "raw": (
        ("ev", "variants"),
        """
        SELECT event_id, CASE variant WHEN 'other_type' THEN 'CreateEvent' ELSE event_type END AS event_type,
               CASE variant WHEN 'bad_time' THEN NULL ELSE date_trunc('second', event_ts) END AS ts,
               upper(actor_login) AS actor_login,
               CASE WHEN variant <> 'no_repo' THEN upper(repo_name) END AS repo_name, payload_action
        FROM ev, variants""",
    ),
    "rawmd": (
        ("md0",),
        "SELECT md0.*, age FROM md0, (SELECT unnest([0, 1]) AS age)",
    ),
}

CLEAN_COLUMNS = """
    event_id, event_type, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, event_date, is_public,
    actor_id, actor_login, repo_id, repo_name, org_id, org_login, payload_action, payload_number,
    issue_number, issue_state, pr_number, pr_state, pr_merged, push_id, push_size, push_distinct_size,
    commit_count"""


def _hype(period: str) -> str:
    return f"""
        SELECT m.repo_name, CAST(sum(n) AS BIGINT) AS total_stars,
               round(avg(n) + 1e-9, 1) AS avg_monthly_stars, max(n) AS peak_stars,
               round(max(n) / (avg(n) + 1), 6) AS peak_ratio, count(*) AS months_active,
               min(CASE WHEN n = best THEN p END) AS peak_month,
               m.repo_name IN (SELECT repo_name FROM seed) AS is_ai
        FROM (SELECT repo_name, {period} AS p, count(*) AS n,
                     max(count(*)) OVER (PARTITION BY repo_name) AS best
              FROM watch GROUP BY 1, 2) m
        GROUP BY 1"""


def _unpivot(row: str, metrics: dict[str, str]) -> str:
    parts = [f"SELECT '{name}' AS metric, CAST({expr} AS VARCHAR) AS value FROM r" for name, expr in metrics.items()]
    return f"WITH r AS ({row}) " + " UNION ALL ".join(parts)


def _stats(key: str, likes: bool = True) -> str:
    extra = ", round(avg(likes) + 1e-9, 2) AS avg_likes" if likes else ""
    return f"""
        SELECT {key}, count(*) AS model_count, CAST(sum(downloads) AS BIGINT) AS total_downloads,
               round(avg(downloads) + 1e-9, 2) AS avg_downloads{extra}
        FROM md GROUP BY 1"""


def _minmax(measures: dict[str, float]) -> str:
    terms = [
        f"coalesce((coalesce({m}, 0) - min(coalesce({m}, 0)) OVER ()) / "
        f"nullif(max(coalesce({m}, 0)) OVER () - min(coalesce({m}, 0)) OVER (), 0), 0) * {w}"
        for m, w in measures.items()
    ]
    return f"SELECT *, round({' + '.join(terms)}, 6) AS health_score_minmax FROM measures"


_NULL_COLUMNS = (
    "event_type", "event_date", "actor_login", "repo_name",
    "pr_merged", "pr_number", "payload_action", "push_distinct_size",
)

_COMPARED = ["total_rows"] + [f"null_{c}" for c in _NULL_COLUMNS]


def _compare_totals() -> str:
    exprs = ["count(*)"] + [f"count(*) FILTER ({c} IS NULL)" for c in _NULL_COLUMNS]
    parts = [
        f"SELECT '{m}' AS metric, (SELECT {x} FROM newer) AS new_value, (SELECT {x} FROM older) AS old_value"
        for m, x in zip(_COMPARED, exprs)
    ]
    return f"""
        SELECT *, new_value - old_value AS diff,
               round((new_value - old_value) * 100.0 / nullif(old_value, 0), 2) AS diff_pct
        FROM ({" UNION ALL ".join(parts)})"""


# Query name -> (inputs it needs, SQL).
EXPECTED: dict[str, tuple[tuple[str, ...], str]] = {
    # cleaning
    "clean_events": (("ev",), f"SELECT {CLEAN_COLUMNS} FROM ev"),
    "clean_events_curated": (
        ("ev", "seed"),
        f"SELECT {CLEAN_COLUMNS} FROM ev WHERE repo_name IN (SELECT repo_name FROM seed)",
    ),
    "clean_models": (
        ("md",),
        """
        SELECT * EXCLUDE (created), strftime(last_modified_date, '%Y-%m-%d %H:%M:%S') AS last_modified_ts,
               strftime(created, '%Y-%m-%d %H:%M:%S') AS created_ts
        FROM md""",
    ),
    "normalize_model_record": (
        (),
        """
        SELECT p_brand || '/' || p_partkey AS "modelId", p_brand AS author,
               CASE WHEN p_size <= 4 THEN 'auto' WHEN p_size <= 8 THEN NULL WHEN p_size <= 12 THEN 'True' END
                   AS gated,
               CAST(p_size AS BIGINT) AS likes, p_partkey AS downloads, p_partkey * 2 AS downloads_all_time,
               CASE WHEN p_size % 7 <> 0 THEN 'mit' END AS license,
               CASE WHEN p_size % 7 <> 0 AND p_size % 3 = 0 THEN p_brand END AS base_model,
               CASE WHEN p_size % 4 <> 0 THEN p_partkey * 1000 END AS total,
               '2022-03-02T00:00:00+00:00' AS created_at
        FROM part""",
    ),
    "flatten_eval_results": (
        (),
        """
        WITH p AS (SELECT * FROM part WHERE p_size % 7 <> 0 AND p_size % 2 = 0)
        SELECT p_brand || '/' || p_partkey AS model_id, 't' AS task_type,
               CAST(NULL AS VARCHAR) AS dataset_type, p_type AS dataset_name,
               CAST(NULL AS VARCHAR) AS dataset_config, CAST(NULL AS VARCHAR) AS dataset_split,
               'acc' AS metric_type, CAST(CAST(floor(p_retailprice) AS INTEGER) AS VARCHAR) AS metric_value,
               true AS verified FROM p
        UNION ALL
        SELECT p_brand || '/' || p_partkey, 't', NULL, 'all', NULL, NULL, 'f1', CAST(p_size AS VARCHAR), NULL
        FROM p""",
    ),
    # activity
    "repo_daily_metrics": (("daily",), "SELECT * FROM daily"),
    "repo_yearly": (("yearly",), "SELECT * FROM yearly"),
    "top_repos": (("top",), "SELECT * FROM top"),
    "label_ai": (("topai",), "SELECT * FROM topai"),
    "group_summary": (
        ("topai",),
        """
        SELECT is_ai, count(*) AS repo_count, round(avg(stars) + 1e-9, 1) AS avg_stars,
               round(avg(forks) + 1e-9, 1) AS avg_forks, round(avg(pushes) + 1e-9, 1) AS avg_pushes,
               round(avg(prs) + 1e-9, 1) AS avg_prs,
               round(avg(distinct_actors) + 1e-9, 1) AS avg_contributors,
               round(avg(active_days) + 1e-9, 1) AS avg_active_days
        FROM topai GROUP BY 1""",
    ),
    "group_summary_medians": (
        ("topai",),
        """
        SELECT is_ai, count(*) AS repo_count, round(avg(stars) + 1e-9, 1) AS avg_stars,
               round(avg(forks) + 1e-9, 1) AS avg_forks, round(avg(pushes) + 1e-9, 1) AS avg_pushes,
               round(avg(prs) + 1e-9, 1) AS avg_prs,
               round(avg(distinct_actors) + 1e-9, 1) AS avg_contributors,
               round(avg(active_days) + 1e-9, 1) AS avg_active_days,
               quantile_disc(stars, 0.5) AS median_stars, quantile_disc(forks, 0.5) AS median_forks,
               quantile_disc(pushes, 0.5) AS median_pushes, quantile_disc(prs, 0.5) AS median_prs,
               quantile_disc(distinct_actors, 0.5) AS median_contributors,
               quantile_disc(active_days, 0.5) AS median_active_days
        FROM topai GROUP BY 1""",
    ),
    "era_summary_approx": (
        ("ev",),
        "SELECT DISTINCT era, true AS distinct_repos_close, true AS distinct_actors_close FROM ev",
    ),
    "star_growth_hype": (("watch", "seed"), _hype("month")),
    "star_growth_hype_weekly": (("watch", "seed"), _hype("week")),
    "contributor_health": (("health",), "SELECT * FROM health"),
    "top_pushers": (
        ("ev",),
        """
        SELECT repo_name, actor_login, push_count FROM (
            SELECT repo_name, actor_login, count(*) AS push_count,
                   rank() OVER (PARTITION BY repo_name ORDER BY count(*) DESC) AS k
            FROM ev WHERE event_type = 'PushEvent' GROUP BY 1, 2)
        WHERE k = 1""",
    ),
    "bus_factor": (
        ("ev",),
        """
        SELECT repo_name, min(k) AS bus_factor FROM (
            SELECT repo_name, row_number() OVER w AS k, sum(n) OVER w AS s,
                   sum(n) OVER (PARTITION BY repo_name) AS total
            FROM (SELECT repo_name, actor_login, count(*) AS n FROM ev
                  WHERE event_type = 'PushEvent' GROUP BY 1, 2)
            WINDOW w AS (PARTITION BY repo_name ORDER BY n DESC, actor_login
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        WHERE s * 10 >= total * 8 GROUP BY 1""",
    ),
    # adoption
    "library_stats_for_join": (("libs",), "SELECT * FROM libs"),
    "hub_repo_join": (("joined",), "SELECT * FROM joined"),
    "package_yearly": (("pyear",), "SELECT * FROM pyear"),
    "health_score": (
        ("scored",),
        "SELECT * REPLACE (round(health_score, 6) AS health_score) FROM scored",
    ),
    "health_score_minmax": (
        ("measures",),
        _minmax(
            {
                "hf_total_downloads": 0.30,
                "pypi_downloads_2025": 0.20,
                "gh_stars_2025": 0.15,
                "gh_pushes_2025": 0.15,
                "gh_prs_2025": 0.10,
                "gh_active_days": 0.10,
            }
        ),
    ),
    # eras
    "era_summary": (("summary",), "SELECT * FROM summary"),
    "era_summary_by_number": (
        ("ev", "summary"),
        """
        SELECT s.* REPLACE (x.p AS distinct_prs, x.m AS merged_prs)
        FROM summary s JOIN (
            SELECT era, count(DISTINCT pr_number) FILTER (event_type = 'PullRequestEvent') AS p,
                   count(DISTINCT pr_number) FILTER (event_type = 'PullRequestEvent'
                       AND ((payload_action = 'closed' AND pr_merged) OR payload_action = 'merged')) AS m
            FROM ev GROUP BY 1) x ON x.era = s.era""",
    ),
    "push_size_distribution": (("sizes",), "SELECT * FROM sizes"),
    "pr_push_ratio": (
        ("ratios",),
        """
        SELECT era, count(*) AS repo_count, round(avg(r), 6) AS avg_pr_push_ratio,
               round(quantile_disc(r, 0.25), 6) AS p25_pr_push_ratio,
               round(quantile_disc(r, 0.5), 6) AS median_pr_push_ratio,
               round(quantile_disc(r, 0.75), 6) AS p75_pr_push_ratio,
               round(avg(contributors), 6) AS avg_contributors_per_repo
        FROM ratios GROUP BY 1""",
    ),
    "pr_push_quartiles": (
        ("ratios",),
        """
        SELECT era, round(quantile_disc(r, 0.25), 6) AS p25_pr_push_ratio,
               round(quantile_disc(r, 0.5), 6) AS median_pr_push_ratio,
               round(quantile_disc(r, 0.75), 6) AS p75_pr_push_ratio
        FROM ratios GROUP BY 1""",
    ),
    "active_repos_monthly": (
        ("ev",),
        """
        SELECT strftime(event_date, '%Y-%m') AS month, era, count(DISTINCT repo_name) AS active_repos,
               count(DISTINCT actor_login) AS active_actors, count(*) AS total_events
        FROM ev GROUP BY 1, 2""",
    ),
    "active_in_first_quarters": (
        (),
        """
        SELECT strftime(o_orderdate, '%Y-%m') AS month, year(o_orderdate) || '-Q1' AS era,
               count(DISTINCT o_custkey) AS active_repos, count(DISTINCT o_orderpriority) AS active_actors,
               count(*) AS total_events
        FROM orders WHERE quarter(o_orderdate) = 1 AND year(o_orderdate) BETWEEN 1995 AND 2001 GROUP BY 1, 2""",
    ),
    "active_by_quarter": (
        (),
        """
        SELECT strftime(o_orderdate, '%Y') AS month, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS era,
               count(DISTINCT o_custkey) AS active_repos, count(DISTINCT o_orderpriority) AS active_actors,
               count(*) AS total_events
        FROM orders GROUP BY 1, 2""",
    ),
    "era_type_counts": (
        ("ev",),
        """
        SELECT era, nullif(count(*) FILTER (event_type = 'WatchEvent'), 0) AS "WatchEvent",
               nullif(count(*) FILTER (event_type = 'ForkEvent'), 0) AS "ForkEvent",
               nullif(count(*) FILTER (event_type = 'PushEvent'), 0) AS "PushEvent",
               nullif(count(*) FILTER (event_type = 'PullRequestEvent'), 0) AS "PullRequestEvent",
               nullif(count(*) FILTER (event_type = 'IssuesEvent'), 0) AS "IssuesEvent"
        FROM ev GROUP BY 1""",
    ),
    "merge_eras": (("sizes",), "SELECT * FROM sizes"),
    "one_commit_share": (
        ("sizes",),
        "SELECT era, round(100.0 * commits_eq_1 / nullif(total_push_events, 0), 6) AS pct FROM sizes",
    ),
    "pr_merge_rate": (
        ("summary",),
        "SELECT era, round(100.0 * merged_prs / nullif(distinct_prs, 0), 6) AS pct FROM summary",
    ),
    "era_delta": (
        ("summary",),
        """
        WITH long AS (
            SELECT 'total_events' AS metric, era, CAST(total_events AS DOUBLE) AS v FROM summary UNION ALL
            SELECT 'distinct_actors', era, distinct_actors FROM summary UNION ALL
            SELECT 'merged_prs', era, merged_prs FROM summary)
        SELECT metric, era,
               round(100.0 * (v - lag(v) OVER w) / nullif(lag(v) OVER w, 0), 6) AS pct_prev,
               round(100.0 * (v - first_value(v) OVER w) / nullif(first_value(v) OVER w, 0), 6) AS pct_first
        FROM long WINDOW w AS (PARTITION BY metric ORDER BY era)""",
    ),
    # deep dive
    "target_repos": (("targets",), "SELECT * FROM targets"),
    "pr_merge_time": (("mtime",), "SELECT * FROM mtime"),
    "pr_merge_time_across_eras": (
        ("lead_any",),
        """
        SELECT era, repo_name, is_ai, count(pr_number) AS merged_pr_count, round(avg(sec) / 3600, 6) AS avg_merge_hours,
               round(quantile_disc(h, 0.5), 6) AS median_merge_hours,
               round(quantile_disc(h, 0.75), 6) AS p75_merge_hours,
               round(quantile_disc(h, 0.9), 6) AS p90_merge_hours
        FROM lead_any WHERE h BETWEEN 0 AND 8760 GROUP BY 1, 2, 3""",
    ),
    "daily_pr_timeseries": (("prdays",), "SELECT * FROM prdays"),
    "daily_pr_count": (
        ("prcount",),
        "SELECT * REPLACE (round(avg_daily_prs, 6) AS avg_daily_prs) FROM prcount",
    ),
    "daily_commits_timeseries": (
        ("cdays",),
        "SELECT * REPLACE (round(avg_commits_per_push, 6) AS avg_commits_per_push) FROM cdays",
    ),
    "daily_commits": (
        ("commits",),
        """
        SELECT * REPLACE (round(avg_daily_commits, 6) AS avg_daily_commits,
                          round(avg_commits_per_push, 6) AS avg_commits_per_push)
        FROM commits""",
    ),
    "contributor_flow": (
        ("tev",),
        """
        SELECT era, repo_name, is_ai, strftime(event_date, '%Y-%m-%d') AS month,
               CASE WHEN event_date = f THEN 'new' ELSE 'returning' END AS contributor_type,
               count(DISTINCT actor_login) AS contributors
        FROM (SELECT *, min(event_date) OVER (PARTITION BY era, repo_name, actor_login) AS f FROM tev)
        GROUP BY 1, 2, 3, 4, 5""",
    ),
    "contributor_flow_in_batches": (
        ("tev",),
        """
        WITH firsts AS (SELECT era, repo_name, actor_login, min(event_date) AS f FROM tev GROUP BY 1, 2, 3)
        SELECT t.era, t.repo_name, t.is_ai, strftime(t.event_date, '%Y-%m-%d') AS month,
               if(t.event_date = f, 'new', 'returning') AS contributor_type, count(DISTINCT t.actor_login) AS contributors
        FROM tev t JOIN firsts USING (era, repo_name, actor_login) GROUP BY 1, 2, 3, 4, 5""",
    ),
    "contributor_flow_monthly": (
        ("tev",),
        """
        SELECT era, repo_name, is_ai, strftime(event_date, '%Y-%m') AS month,
               CASE WHEN strftime(event_date, '%Y-%m') = f THEN 'new' ELSE 'returning' END AS contributor_type,
               count(DISTINCT actor_login) AS contributors
        FROM (SELECT *, min(strftime(event_date, '%Y-%m')) OVER (PARTITION BY era, repo_name, actor_login) AS f
              FROM tev)
        GROUP BY 1, 2, 3, 4, 5""",
    ),
    "group_pr_merge_time": (
        ("lead",),
        """
        SELECT era, is_ai, count(*) AS repo_count, round(avg(med), 6) AS avg_median_merge_hours,
               round(avg(n), 6) AS avg_merged_pr_count
        FROM (SELECT era, repo_name, is_ai, count(*) AS n, quantile_disc(h, 0.5) AS med
              FROM lead WHERE h BETWEEN 0 AND 8760 GROUP BY 1, 2, 3)
        GROUP BY 1, 2""",
    ),
    "group_daily_commits": (
        ("commits",),
        """
        SELECT era, is_ai, count(*) AS repo_count, round(avg(avg_daily_commits), 6) AS avg_daily_commits,
               round(avg(avg_commits_per_push), 6) AS avg_commits_per_push
        FROM commits GROUP BY 1, 2""",
    ),
    "group_daily_prs": (
        ("prcount",),
        """
        SELECT era, is_ai, count(*) AS repo_count, round(avg(avg_daily_prs), 6) AS avg_daily_prs,
               CAST(sum(total_prs) AS BIGINT) AS total_prs
        FROM prcount GROUP BY 1, 2""",
    ),
    # rhythm
    "weekday_weekend": (
        ("weekend",),
        """
        SELECT era, is_weekend, count(*) AS events, count(DISTINCT actor_login) AS actors,
               count(DISTINCT repo_name) AS repos
        FROM weekend GROUP BY 1, 2""",
    ),
    "weekday_weekend_by_type": (
        ("weekend",),
        "SELECT era, is_weekend, event_type, count(*) AS events FROM weekend GROUP BY 1, 2, 3",
    ),
    "push_per_actor": (
        ("pusher",),
        """
        SELECT era, count(*) AS total_push_actors, round(avg(n), 6) AS avg_pushes,
               quantile_disc(n, 0.5) AS median_pushes, quantile_disc(n, 0.75) AS p75_pushes,
               quantile_disc(n, 0.9) AS p90_pushes, quantile_disc(n, 0.99) AS p99_pushes,
               round(avg(pd), 6) AS avg_pushes_per_day,
               round(quantile_disc(pd, 0.5), 6) AS median_pushes_per_day,
               round(quantile_disc(pd, 0.9), 6) AS p90_pushes_per_day,
               round(avg(d), 6) AS avg_active_days, round(avg(r), 6) AS avg_repos_per_actor,
               count(*) FILTER (n > 3) AS actors_gt_3_pushes,
               count(*) FILTER (n > 5) AS actors_gt_5_pushes,
               count(*) FILTER (pd > 1) AS actors_gt_1_per_day
        FROM pusher GROUP BY 1""",
    ),
    "weekend_share": (
        ("weekend",),
        """
        SELECT era, round(100.0 * count(*) FILTER (is_weekend) / count(*), 6) AS weekend_pct,
               round(100.0 * count(DISTINCT CASE WHEN is_weekend THEN event_date END)
                     / count(DISTINCT event_date), 6) AS baseline_pct
        FROM weekend GROUP BY 1""",
    ),
    "weekend_share_by_type": (
        ("weekend",),
        """
        SELECT era, event_type, round(100.0 * count(*) FILTER (is_weekend) / count(*), 6) AS weekend_pct
        FROM weekend GROUP BY 1, 2""",
    ),
    # event profiles
    "events_summary": (
        ("raw",),
        _unpivot(
            "SELECT * FROM raw",
            {
                "total_rows": "count(*)",
                "total_columns": "max(9)",
                "distinct_repositories": "count(DISTINCT coalesce(repo_name, ''))",
                "distinct_actors": "count(DISTINCT coalesce(actor_login, ''))",
                "min_event_timestamp": "strftime(min(ts), '%Y-%m-%d %H:%M:%S')",
                "max_event_timestamp": "strftime(max(ts), '%Y-%m-%d %H:%M:%S')",
            },
        ),
    ),
    "event_type_distribution": (
        ("raw",),
        'SELECT event_type, count(*) AS "count" FROM raw GROUP BY 1',
    ),
    "events_null_counts": (
        ("raw",),
        _unpivot(
            "SELECT * FROM raw",
            {
                "id_nulls": "count(*) FILTER (event_id IS NULL)",
                "type_nulls": "count(*) FILTER (event_type IS NULL)",
                "created_at_or_event_ts_nulls": "max(0)",
                "actor_login_nulls": "count(*) FILTER (actor_login IS NULL)",
                "repo_name_nulls": "count(*) FILTER (repo_name IS NULL)",
                "payload_action_nulls": "count(*) FILTER (payload_action IS NULL)",
            },
        ),
    ),
    "top_active_repos": (
        ("raw",),
        """
        SELECT repo_name, count(*) AS "count" FROM raw WHERE repo_name IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    ),
    "events_sample": (
        ("ev",),
        """
        SELECT event_id AS id, event_type, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS created_at_or_event_ts,
               actor_login, repo_name
        FROM ev ORDER BY ev.event_ts, CAST(event_id AS BIGINT) LIMIT 10""",
    ),
    "null_report": (
        ("ev",),
        """
        SELECT column_name AS "column", n AS null_count, round(n * 100.0 / rows + 1e-9, 1) AS null_pct
        FROM (SELECT count(*) AS rows FROM ev), (
            UNPIVOT (SELECT count(*) - count(COLUMNS(*)) FROM ev)
            ON COLUMNS(*) INTO NAME column_name VALUE n)""",
    ),
    "core_event_share": (
        ("raw",),
        """
        SELECT event_type, count(*) AS "count", event_type <> 'CreateEvent' AS is_core,
               (SELECT round(100.0 * count(*) FILTER (event_type <> 'CreateEvent') / count(*), 1) FROM raw)
                   AS core_pct
        FROM raw GROUP BY 1""",
    ),
    "events_per_hour": (
        ("raw",),
        "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS events FROM raw GROUP BY 1",
    ),
    "distinct_repos_actors": (
        ("raw",),
        "SELECT count(DISTINCT repo_name) AS repos, count(DISTINCT actor_login) AS actors FROM raw",
    ),
    # model profiles and exploration
    "models_summary": (
        ("rawmd",),
        _unpivot(
            "SELECT *, CAST(downloads AS BIGINT) AS dl, size - age AS likes FROM rawmd",
            {
                "total_rows": "count(*)",
                "total_columns": "max(18)",
                "distinct_authors": "count(DISTINCT coalesce(raw_author, ''))",
                "distinct_pipeline_tags": "count(DISTINCT raw_tag)",
                "distinct_library_names": "count(DISTINCT raw_library)",
                "min_downloads": "min(dl)",
                "max_downloads": "max(dl)",
                "avg_downloads": "printf('%.2f', avg(dl))",
                "median_downloads": "quantile_disc(dl, 0.5)",
                "min_likes": "min(likes)",
                "max_likes": "max(likes)",
                "avg_likes": "printf('%.2f', avg(likes))",
            },
        ),
    ),
    "pipeline_tag_distribution": (
        ("rawmd",),
        """SELECT coalesce(raw_tag, '(null)') AS pipeline_tag, count(*) AS "count" FROM rawmd GROUP BY 1""",
    ),
    "library_distribution": (
        ("rawmd",),
        """SELECT coalesce(raw_library, '(null)') AS library_name, count(*) AS "count" FROM rawmd GROUP BY 1""",
    ),
    "models_null_counts": (
        ("rawmd",),
        _unpivot(
            "SELECT * FROM rawmd",
            {
                "modelId_nulls": "max(0)",
                "author_nulls": "count(*) FILTER (raw_author IS NULL)",
                "pipeline_tag_nulls": "count(*) FILTER (raw_tag IS NULL)",
                "library_name_nulls": "count(*) FILTER (raw_library IS NULL)",
                "downloads_nulls": "count(*) FILTER (downloads IS NULL)",
                "likes_nulls": "max(0)",
                "lastModified_nulls": "max(0)",
                "created_at_nulls": "count(*) FILTER (created IS NULL)",
                "license_nulls": "count(*) FILTER (w1 = 'small')",
                "datasets_nulls": "max(0)",
            },
        ),
    ),
    "top_authors": (
        ("rawmd",),
        """
        SELECT raw_author AS author, count(*) AS "count" FROM rawmd WHERE raw_author IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    ),
    "top_downloads": (
        ("md",),
        """
        SELECT model_id, author, pipeline_tag, library_name, downloads, likes FROM md
        WHERE downloads IS NOT NULL ORDER BY downloads DESC, model_id LIMIT 20""",
    ),
    "models_sample": (
        ("md",),
        """
        SELECT model_id, author, pipeline_tag, library_name, downloads, likes,
               strftime(last_modified_date, '%Y-%m-%d %H:%M:%S') AS last_modified_ts
        FROM md ORDER BY downloads DESC NULLS LAST, model_id LIMIT 10""",
    ),
    "downloads_distribution": (
        ("md",),
        """
        SELECT CASE WHEN downloads IS NULL THEN 'unknown' WHEN downloads = 0 THEN '0'
                    WHEN downloads BETWEEN 1 AND 100 THEN '1-100'
                    WHEN downloads BETWEEN 101 AND 10000 THEN '101-10K'
                    WHEN downloads BETWEEN 10001 AND 1000000 THEN '10K-1M' ELSE '1M+' END AS bucket,
               count(*) AS "count"
        FROM md GROUP BY 1""",
    ),
    "downloads_percentiles": (
        ("md",),
        " UNION ALL ".join(
            f"SELECT 'downloads_p{p}' AS metric, quantile_disc(downloads, 0.{p}) AS value FROM md"
            for p in (25, 50, 75, 90, 95, 99)
        ),
    ),
    "downloads_likes_correlation": (
        ("md",),
        "SELECT 'downloads_likes_correlation' AS metric, round(corr(downloads, likes), 4) AS value FROM md",
    ),
    "pipeline_tag_stats": (("md",), _stats("pipeline_tag")),
    "library_stats": (("md",), _stats("library_name")),
    "license_stats": (("md",), _stats("license", likes=False)),
    "monthly_creation_trend": (
        ("md",),
        """
        SELECT CAST(date_trunc('month', created) AS DATE) AS month, count(*) AS new_models,
               CAST(sum(downloads) AS BIGINT) AS total_downloads
        FROM md WHERE created IS NOT NULL GROUP BY 1""",
    ),
    "parameter_distribution": (
        ("md",),
        """
        SELECT CASE WHEN parameter_count IS NULL THEN 'unknown' WHEN parameter_count < 1e9 THEN '<1B'
                    WHEN parameter_count < 7e9 THEN '1-7B' WHEN parameter_count < 13e9 THEN '7-13B'
                    WHEN parameter_count < 70e9 THEN '13-70B' ELSE '70B+' END AS param_bucket,
               count(*) AS "count"
        FROM md GROUP BY 1""",
    ),
    "owner_concentration": (
        ("md",),
        """
        SELECT owner, count(*) AS model_count, CAST(sum(downloads) AS BIGINT) AS total_downloads,
               CAST(sum(likes) AS BIGINT) AS total_likes
        FROM md GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
    ),
    "owner_model_count_distribution": (
        ("md",),
        """
        SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 20 THEN '6-20'
                    WHEN n <= 100 THEN '21-100' ELSE '100+' END AS models_per_owner, count(*) AS "count"
        FROM (SELECT owner, count(*) AS n FROM md GROUP BY 1) GROUP BY 1""",
    ),
    "staleness_distribution": (
        ("md",),
        """
        SELECT CASE WHEN d <= 30 THEN '<30 days' WHEN d <= 90 THEN '30-90 days'
                    WHEN d <= 365 THEN '90-365 days' ELSE '>1 year' END AS staleness, count(*) AS "count"
        FROM (SELECT DATE '2024-07-01' - last_modified_date AS d FROM md) GROUP BY 1""",
    ),
    "gated_stats": (
        ("md",),
        """
        SELECT CASE WHEN gated IS NULL OR gated = 'False' THEN 'non-gated' ELSE 'gated' END AS is_gated,
               count(*) AS model_count, round(avg(downloads) + 1e-9, 2) AS avg_downloads,
               round(avg(likes) + 1e-9, 2) AS avg_likes
        FROM md GROUP BY 1""",
    ),
    # package downloads
    "package_totals": (
        ("pkg",),
        "SELECT project, CAST(sum(downloads) AS BIGINT) AS downloads FROM pkg GROUP BY 1",
    ),
    "package_monthly_pivot": (
        ("pkg",),
        "SELECT month, "
        + ", ".join(
            f"CAST(sum(downloads) FILTER (project = '{p}') AS BIGINT) AS {p}"
            for p in ("economy", "large", "medium", "promo", "small", "standard")
        )
        + " FROM pkg GROUP BY 1",
    ),
    "package_monthly_top": (
        ("pkg",),
        """
        SELECT month, project, downloads FROM pkg WHERE project IN (
            SELECT project FROM pkg GROUP BY 1 ORDER BY sum(downloads) DESC, 1 LIMIT 3)""",
    ),
    "package_growth_pct": (
        ("pkg",),
        """
        SELECT project, round((arg_max(downloads, month) - arg_min(downloads, month)) * 100.0
                              / arg_min(downloads, month), 1) AS growth_pct
        FROM pkg GROUP BY 1""",
    ),
    # quality
    "era_quality": (
        ("ev",),
        f"""
        SELECT era, count(*) AS total_events, count(DISTINCT event_date) AS distinct_days,
               CAST(round(count(*) / count(DISTINCT event_date)) AS BIGINT) AS avg_events_per_day,
               min(event_date) AS date_start, max(event_date) AS date_end,
               count(*) FILTER (event_type = 'PushEvent') AS push_events,
               count(*) FILTER (event_type = 'PullRequestEvent') AS pr_events,
               count(*) FILTER (event_type = 'WatchEvent') AS watch_events,
               count(*) FILTER (event_type = 'IssuesEvent') AS issue_events,
               count(*) FILTER (event_type = 'ForkEvent') AS fork_events,
               {", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in _NULL_COLUMNS)},
               CASE WHEN count(*) FILTER (pr_merged IS NULL) * 2 > count(*) THEN 'ISSUE' ELSE 'OK' END
                   AS flag_pr_merged,
               CASE WHEN count(*) FILTER (push_distinct_size IS NULL) * 2 > count(*) THEN 'ISSUE' ELSE 'OK' END
                   AS flag_push_distinct_size
        FROM ev GROUP BY 1""",
    ),
    "summary_from_sketches": (
        ("ev",),
        """
        SELECT era, count(*) AS total_events, true AS distinct_repos_close, true AS distinct_actors_close
        FROM ev GROUP BY era""",
    ),
    "streamed_days": (
        ("ev",),
        """
        SELECT repo_name, event_date, count(*) FILTER (event_type = 'WatchEvent') AS stars,
               count(*) FILTER (event_type = 'ForkEvent') AS forks, count(*) FILTER (event_type = 'PushEvent') AS pushes,
               count(*) FILTER (event_type = 'PullRequestEvent') AS prs,
               count(*) FILTER (event_type = 'IssuesEvent') AS issues, count(*) AS total_events
        FROM ev GROUP BY repo_name, event_date""",
    ),
    "bucketed_stars": (
        ("ev",),
        """
        SELECT repo_name, count(*) FILTER (event_type = 'WatchEvent') AS stars,
               count(*) FILTER (event_type = 'PushEvent') AS pushes
        FROM ev GROUP BY 1 HAVING stars > 0 AND pushes > 0""",
    ),
    "truncated_archives": (
        ("e0",),
        """
        SELECT id % 3 AS third, id % 3 = 1 AS ended_early, CASE WHEN id % 3 <> 1 THEN count(*) END AS whole_rows,
               id % 3 = 1 AS lost_some, true AS kept_some
        FROM e0 GROUP BY id % 3""",
    ),
    "archive_coverage": (
        ("ev",),
        """
        SELECT d.event_date, coalesce(hours, 0) AS hours_present, coalesce(hours, 0) = 24 AS complete, events
        FROM (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)) AS DATE) AS event_date) d
        LEFT JOIN (
            SELECT event_date, count(DISTINCT hour(event_ts)) AS hours, count(*) AS events FROM ev
            WHERE NOT (day(event_ts) % 5 = 0 AND hour(event_ts) % 7 = 3) GROUP BY 1
        ) USING (event_date)""",
    ),
    "swapped_rows": (
        ("ev", "e0"),
        """
        SELECT CAST(ts AS DATE) AS event_date, CAST(id AS VARCHAR) AS event_id,
               CASE id % 1000 WHEN 7 THEN 'removed' ELSE 'changed' END AS change
        FROM e0 WHERE id % 1000 IN (7, 8) OR id % 97 = 5""",
    ),
    "daily_counts": (("ev",), "SELECT event_date, count(*) AS events FROM ev GROUP BY 1"),
    "field_value_counts": (
        ("ev",),
        'SELECT payload_action, count(*) AS "count" FROM ev GROUP BY 1',
    ),
    "field_value_counts_day": (
        ("ev",),
        """SELECT pr_merged, count(*) AS "count" FROM ev WHERE event_date = DATE '2024-01-15' GROUP BY 1""",
    ),
    "compare_by_type": (
        ("newer", "older"),
        """
        SELECT coalesce(n.event_type, o.event_type) AS event_type, new_count, old_count,
               coalesce(new_count, 0) - coalesce(old_count, 0) AS diff
        FROM (SELECT event_type, count(*) AS new_count FROM newer GROUP BY 1) n
        FULL JOIN (SELECT event_type, count(*) AS old_count FROM older GROUP BY 1) o
               ON n.event_type = o.event_type""",
    ),
    "compare_by_day": (
        ("newer", "older"),
        """
        SELECT coalesce(n.event_date, o.event_date) AS event_date, new_count, old_count,
               coalesce(new_count, 0) - coalesce(old_count, 0) AS diff,
               round((coalesce(new_count, 0) - coalesce(old_count, 0)) * 100.0 / old_count, 2) AS diff_pct
        FROM (SELECT event_date, count(*) AS new_count FROM newer GROUP BY 1) n
        FULL JOIN (SELECT event_date, count(*) AS old_count FROM older GROUP BY 1) o
               ON n.event_date = o.event_date""",
    ),
    "compare_totals_nulls": (("newer", "older"), _compare_totals()),
    "hour_coverage": (
        ("ev",),
        """
        SELECT CAST(d AS DATE) AS event_date, coalesce(n, 0) AS hours_present, coalesce(n, 0) = 24 AS complete
        FROM (SELECT unnest(generate_series(DATE '2023-12-31', DATE '2024-02-01', INTERVAL 1 DAY)) AS d)
        LEFT JOIN (SELECT event_date, count(DISTINCT hour(event_ts)) AS n FROM ev GROUP BY 1) h
               ON h.event_date = CAST(d AS DATE)""",
    ),
    "hour_coverage_raw": (
        ("ev",),
        """
        SELECT CAST(d AS DATE) AS event_date, coalesce(n, 0) AS hours_present, coalesce(n, 0) = 24 AS complete
        FROM (SELECT unnest(generate_series(DATE '2024-01-03', DATE '2024-01-20', INTERVAL 1 DAY)) AS d)
        LEFT JOIN (SELECT event_date, count(DISTINCT hour(event_ts)) AS n FROM ev GROUP BY 1) h
               ON h.event_date = CAST(d AS DATE)""",
    ),
    "missing_hours_raw": (
        ("ev",),
        """
        SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour
        FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-03 00:00:00',
                                            TIMESTAMP '2024-01-20 23:00:00', INTERVAL 1 HOUR)) AS h)
        WHERE h NOT IN (SELECT date_trunc('hour', event_ts) FROM ev)""",
    ),
    "missing_hours": (
        ("ev",),
        """
        SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS hour
        FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-31 00:00:00',
                                            TIMESTAMP '2024-02-01 23:00:00', INTERVAL 1 HOUR)) AS h)
        WHERE h NOT IN (SELECT date_trunc('hour', event_ts) FROM ev)""",
    ),
    # derived reports
    "risk_band": (
        ("health",),
        """
        SELECT repo_name, CASE WHEN top1_push_ratio IS NULL THEN 'gray' WHEN top1_push_ratio < 0.3 THEN 'green'
               WHEN top1_push_ratio < 0.7 THEN 'orange' ELSE 'red' END AS band FROM health""",
    ),
    "contributor_risk_pattern": (
        ("health",),
        """
        SELECT repo_name, CASE
               WHEN coalesce(push_contributors, 0) <= 12 AND coalesce(pr_contributors, 0) <= 17
                    THEN 'audience only'
               WHEN top1_push_ratio >= 0.08 AND coalesce(pr_contributors, 0) <= 17 THEN 'single point'
               WHEN top1_push_ratio >= 0.08 THEN 'concentrated merge' ELSE 'healthy' END AS pattern
        FROM health""",
    ),
    "builder_share": (
        ("health",),
        """
        SELECT repo_name, round(coalesce(push_contributors, 0) / total_contributors, 6) AS share
        FROM health""",
    ),
    "hype_rate": (
        ("watch", "seed"),
        """
        SELECT is_ai, round(100 * avg(CAST(r > 2 AS INTEGER)), 6) AS pct_burst,
               round(100 * avg(CAST(r > 2.5 AS INTEGER)), 6) AS pct_extreme, round(avg(r), 6) AS avg_peak_ratio
        FROM (SELECT repo_name IN (SELECT repo_name FROM seed) AS is_ai, max(n) / (avg(n) + 1) AS r
              FROM (SELECT repo_name, event_date, count(*) AS n FROM watch GROUP BY 1, 2) GROUP BY repo_name)
        GROUP BY 1""",
    ),
    "peak_month_share": (
        ("watch",),
        """
        SELECT repo_name, round(max(n) / sum(n), 6) AS share
        FROM (SELECT repo_name, week, count(*) AS n FROM watch GROUP BY 1, 2) GROUP BY 1""",
    ),
    "owner_hype": (
        ("watch",),
        """
        SELECT split_part(repo_name, '/', 1) AS owner, count(*) AS repos, round(avg(r), 6) AS avg_peak_ratio
        FROM (SELECT repo_name, max(n) / (avg(n) + 1) AS r
              FROM (SELECT repo_name, month, count(*) AS n FROM watch GROUP BY 1, 2) GROUP BY 1)
        GROUP BY 1""",
    ),
    "rank_correlation": (
        ("scored",),
        """
        SELECT round(corr(rx, ry), 6) AS spearman, round(corr(x, y), 6) AS pearson FROM (
            SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
                   rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
            FROM (SELECT gh_stars_2025 AS x, health_score AS y FROM scored WHERE gh_stars_2025 IS NOT NULL))""",
    ),
    "topk_overlap": (
        ("scored",),
        """
        SELECT count(*) AS overlap
        FROM (SELECT repo_name FROM scored WHERE gh_stars_2025 IS NOT NULL
              ORDER BY gh_stars_2025 DESC, repo_name LIMIT 10)
        WHERE repo_name IN (SELECT repo_name FROM scored ORDER BY health_score DESC, repo_name LIMIT 10)""",
    ),
    "adoption_per_star": (
        ("scored",),
        """
        SELECT repo_name, hf_total_downloads, gh_stars_2025,
               round(hf_total_downloads / nullif(gh_stars_2025, 0), 3) AS downloads_per_star
        FROM scored""",
    ),
    "adoption_archetype": (
        ("scored",),
        """
        SELECT repo_name, CASE WHEN gh_stars_2025 >= 20 AND hf_total_downloads >= 10000000 THEN 'true leader'
               WHEN hf_total_downloads >= 10000000 THEN 'quiet power'
               WHEN gh_stars_2025 >= 20 THEN 'ecosystem outsider' ELSE 'niche' END AS archetype
        FROM scored""",
    ),
    "bubble_frame": (
        ("scored",),
        """
        SELECT repo_name, pypi_downloads_2025, gh_stars_2025,
               greatest(290.0, least(310.0, hf_model_count / 1.0)) AS size,
               round(health_score, 6) AS health_score
        FROM scored WHERE gh_stars_2025 IS NOT NULL AND pypi_downloads_2025 IS NOT NULL""",
    ),
    "star_rank_of_healthiest": (
        ("scored", "top"),
        """
        SELECT b.repo_name, r.star_rank
        FROM (SELECT DISTINCT repo_name FROM (SELECT repo_name FROM scored
              ORDER BY health_score DESC, repo_name, library_name LIMIT 10)) b
        LEFT JOIN (SELECT repo_name, rank() OVER (ORDER BY stars DESC) AS star_rank FROM top) r
               ON r.repo_name = b.repo_name""",
    ),
    # sources and sinks
    "cleaned_from_files": (("ev",), f"SELECT {CLEAN_COLUMNS} FROM ev"),
    "stored_events": (
        ("ev",),
        """
        SELECT event_date, event_type, count(*) AS events FROM ev
        WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' AND event_date <> DATE '2024-01-15'
        GROUP BY 1, 2""",
    ),
    "stored_eras": (
        ("weekend",),
        """
        SELECT era, is_weekend, count(*) AS events, count(DISTINCT actor_login) AS actors,
               count(DISTINCT repo_name) AS repos
        FROM weekend WHERE era >= 'W3' OR event_type <> 'ForkEvent' GROUP BY 1, 2""",
    ),
    "exported_metrics": (
        ("ev",),
        " UNION ALL ".join(
            f"SELECT '{c}' AS metric, count(*) FILTER ({c} IS NULL) AS value FROM ev"
            for c in ("pr_number", "pr_merged", "push_distinct_size", "payload_action")
        ),
    ),
    "exported_report": (
        ("ev",),
        """
        SELECT event_id, event_type, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts, repo_name
        FROM ev ORDER BY ev.event_ts, event_id LIMIT 10""",
    ),
    # building blocks
    "exclude_dates": (
        ("ev",),
        """
        SELECT event_date, count(*) AS events FROM ev
        WHERE event_date NOT IN (DATE '2024-01-06', DATE '2024-01-13') GROUP BY 1""",
    ),
    "date_range": (
        ("ev",),
        """
        SELECT event_date, count(*) AS events FROM ev
        WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY 1""",
    ),
    "exclude_repos": (
        ("ev", "seed"),
        """
        SELECT repo_name, count(*) AS "count" FROM ev WHERE repo_name NOT IN (SELECT repo_name FROM seed)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    ),
    "event_value_percentiles": (
        (),
        """
        SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90,
               quantile_disc(value, 0.99) AS p99
        FROM events GROUP BY 1""",
    ),
    "ordered_sample": (
        ("ev",),
        "SELECT event_id, event_type, repo_name FROM ev ORDER BY event_ts, event_id LIMIT 10",
    ),
}


EXPECTED |= {
    "models_from_lines": EXPECTED["clean_models"],
    "models_from_parquet": EXPECTED["clean_models"],
    "packages_from_lines": EXPECTED["package_totals"],
    "events_with_supplement": EXPECTED["daily_counts"],
    "seed_from_array": (("seed",), "SELECT upper(repo_name) AS repo, category, library_name AS hf_library FROM seed"),
    "schema_difference": (
        (),
        """
        SELECT * FROM (VALUES ('pr_number', 'string', 'bigint'), ('era', 'string', NULL),
            ('event_id', NULL, 'string')) AS t("column", new_type, old_type)""",
    ),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    """The named inputs and what they build on, in an order that defines before use."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in INPUTS[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return order


def oracle_sql() -> dict[str, str]:
    """Query name to one self-contained SELECT."""
    out = {}
    for name, (needs, body) in EXPECTED.items():
        with_list = ", ".join(f"{n} AS ({INPUTS[n][1]})" for n in _needed(needs))
        out[name] = f"WITH {with_list} SELECT * FROM ({body}) result" if with_list else body
    return out
