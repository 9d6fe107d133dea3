"""SQL twins of the data-quality suites."""

from __future__ import annotations

from marquee.config import GENERATED_MIN_REVENUE, MIN_BUDGET
from marquee.plans.quality_suite import SCHEMA_TESTS, schema_test_name


def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    return "'" + str(v).replace("'", "''") + "'"


def _test_sql(model: str, col: str, test: str, arg) -> str:
    if model == "dim_date":
        model = "dim_date_full"
    if test == "not_null":
        return f"SELECT COUNT(*) FROM {model} WHERE {col} IS NULL"
    if test == "unique":
        return (f"SELECT COUNT(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING COUNT(*) > 1)")
    if test == "accepted_values":
        vals = ", ".join(_lit(v) for v in arg)
        return (f"SELECT COUNT(*) FROM (SELECT DISTINCT {col} FROM {model} WHERE {col} IS NOT NULL "
                f"AND {col} NOT IN ({vals}))")
    if test == "relationships":
        parent, pcol = arg
        if parent == "dim_date":
            parent = "dim_date_full"
        return (f"SELECT COUNT(*) FROM {model} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")
    raise ValueError(test)


def _suite(rows: list[tuple[str, str]]) -> str:
    parts = [f"SELECT '{name}' AS test_name, CAST(({sql}) AS BIGINT) AS failures" for name, sql in rows]
    return ("SELECT test_name, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n"
            + "\nUNION ALL\n".join(parts) + ")")


def quality_bodies(min_budget=MIN_BUDGET, min_revenue=GENERATED_MIN_REVENUE) -> dict[str, str]:
    schema = _suite([(schema_test_name(m, c, t), _test_sql(m, c, t, a)) for m, c, t, a in SCHEMA_TESTS])
    rules = _suite([
        ("test_fact_genre_budget_roi_recommendable_min_sample",
         "SELECT COUNT(*) FROM fact_genre_budget_roi_recommendable WHERE movie_count < 5"),
        ("test_fact_movie_performance_budget_quartile_consistency",
         "SELECT COUNT(*) FROM fact_movie_performance WHERE (budget IS NOT NULL AND budget > 0 AND "
         "budget_quartile IS NULL) OR ((budget IS NULL OR budget <= 0) AND budget_quartile IS NOT NULL)"),
        ("test_fact_movie_roi_analysis_profit_consistency",
         "SELECT COUNT(*) FROM fact_movie_roi_analysis WHERE profit IS DISTINCT FROM (revenue - budget)"),
        ("test_fact_movie_roi_analysis_roi_pct_consistency",
         "SELECT COUNT(*) FROM fact_movie_roi_analysis WHERE budget > 0 AND roi_pct IS DISTINCT FROM "
         "CAST(ROUND(CAST(CAST(revenue - budget AS DOUBLE) / CAST(budget AS DOUBLE) * 100 AS DECIMAL(38,10)), 2) AS DOUBLE)"),
        ("test_stg_movies_roi_eligible_flag_consistency",
         f"SELECT COUNT(*) FROM stg_movies_roi_eligible WHERE NOT (is_budget_reported AND is_revenue_reported "
         f"AND is_roi_eligible AND budget >= {min_budget} AND revenue >= {min_revenue})"),
    ])
    checks = """
SELECT dataset, metric, CAST(observed AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected,
       CASE WHEN observed = 0 THEN 'PASS' ELSE 'WARN' END AS status FROM (
  SELECT 'movies' AS dataset, 'id_nulls' AS metric, COUNT(*) FILTER (WHERE movie_id IS NULL) AS observed FROM stg_movies
  UNION ALL SELECT 'movies', 'duplicate_ids', COUNT(*) - COUNT(DISTINCT movie_id)
      - CASE WHEN COUNT(*) FILTER (WHERE movie_id IS NULL) > 0 THEN 1 ELSE 0 END FROM stg_movies
  UNION ALL SELECT 'movies', 'release_date_nulls', COUNT(*) FILTER (WHERE release_date IS NULL) FROM stg_movies
  UNION ALL SELECT 'ratings', 'movie_id_nulls', COUNT(*) FILTER (WHERE movie_id IS NULL) FROM stg_ratings
  UNION ALL SELECT 'ratings', 'duplicate_movie_ids', COUNT(*) - COUNT(DISTINCT movie_id)
      - CASE WHEN COUNT(*) FILTER (WHERE movie_id IS NULL) > 0 THEN 1 ELSE 0 END FROM stg_ratings
  UNION ALL SELECT 'ratings', 'avg_rating_nulls', COUNT(*) FILTER (WHERE avg_rating IS NULL) FROM stg_ratings
  UNION ALL SELECT 'ratings', 'total_ratings_nulls', COUNT(*) FILTER (WHERE total_ratings IS NULL) FROM stg_ratings
  UNION ALL SELECT 'ratings', 'last_rated_nulls', COUNT(*) FILTER (WHERE last_rated IS NULL) FROM stg_ratings
  UNION ALL SELECT 'movie_extended', 'id_nulls', COUNT(*) FILTER (WHERE movie_id IS NULL) FROM stg_movie_extended
  UNION ALL SELECT 'movie_extended', 'duplicate_ids', COUNT(*) - COUNT(DISTINCT movie_id)
      - CASE WHEN COUNT(*) FILTER (WHERE movie_id IS NULL) > 0 THEN 1 ELSE 0 END FROM stg_movie_extended)"""
    return {"schema_tests": schema, "business_rule_tests": rules, "expected_count_checks": checks,
            "count_check_totals": f"SELECT dataset, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) FILTER (WHERE status = 'WARN') AS warned FROM ({checks}) GROUP BY dataset"}
