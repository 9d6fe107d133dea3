"""SQL twins of the profiling (EDA) reports."""

from __future__ import annotations

from oracle import r2


def _missing(cte: str, dataset: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS col, COUNT(*) FILTER (WHERE {c} IS NULL) AS nc, COUNT(*) AS n FROM {cte}"
             for c in cols]
    return (f"SELECT '{dataset}' AS dataset, col AS \"column\", CAST(nc AS BIGINT) AS null_count, "
            f"{r2('CAST(nc AS DOUBLE) * 100.0::DOUBLE / n')} AS null_pct FROM ("
            + " UNION ALL ".join(parts) + ")")


def _id_quality(cte: str, col: str, dataset: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, '{col}' AS id_col, COUNT(*) AS rows,
  COUNT(DISTINCT {col}) AS unique_ids, COUNT(*) FILTER (WHERE {col} IS NULL) AS null_ids,
  COUNT(*) - COUNT(DISTINCT {col}) - CASE WHEN COUNT(*) FILTER (WHERE {col} IS NULL) > 0 THEN 1 ELSE 0 END
    AS duplicate_rows_on_id,
  (COUNT(*) - COUNT(DISTINCT {col}) - CASE WHEN COUNT(*) FILTER (WHERE {col} IS NULL) > 0 THEN 1 ELSE 0 END) = 0
    AS is_unique,
  (SELECT COALESCE(string_agg(v, ',' ORDER BY v), '') FROM (SELECT CAST({col} AS VARCHAR) AS v FROM {cte}
     WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1 ORDER BY v LIMIT 5)) AS sample_duplicate_ids
FROM {cte}"""


def _orphans(name: str, child: str, ccol: str, parent: str, pcol: str) -> str:
    diff = (f"SELECT DISTINCT CAST({ccol} AS VARCHAR) AS v FROM {child} WHERE {ccol} IS NOT NULL "
            f"EXCEPT SELECT CAST({pcol} AS VARCHAR) FROM {parent} WHERE {pcol} IS NOT NULL")
    return (f"SELECT '{name}' AS \"check\", (SELECT COUNT(*) FROM ({diff})) AS \"count\", "
            f"(SELECT COALESCE(string_agg(v, ',' ORDER BY v), '') FROM (SELECT v FROM ({diff}) ORDER BY v LIMIT 5)) AS sample")


def _metrics(rows: list[tuple[str, str]], src: str, name: str = "metric", value: str = "value") -> str:
    parts = [f"SELECT '{m}' AS {name}, CAST(({expr}) AS BIGINT) AS \"{value}\" FROM {src}" for m, expr in rows]
    return " UNION ALL ".join(parts)


def _hist(src: str, col: str, bins: int) -> str:
    # every bin from a generated series; its count by its own bounds
    return f"""SELECT * FROM (
WITH x AS (SELECT {col} AS v FROM {src} WHERE {col} IS NOT NULL AND NOT isnan({col})),
m AS (SELECT min(v) AS lo, max(v) AS hi FROM x),
k AS (SELECT CASE WHEN hi > lo THEN least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) ELSE 0 END AS b, COUNT(*) AS n FROM x, m GROUP BY 1)
SELECT CAST(g.b AS INTEGER) AS bin, {r2(f"lo + g.b * ((hi - lo) / {bins})", 6)} AS lower,
  {r2(f"lo + (g.b + 1) * ((hi - lo) / {bins})", 6)} AS upper, COALESCE(n, 0) AS "count"
FROM range({bins}) g(b) CROSS JOIN m LEFT JOIN k ON k.b = g.b WHERE lo IS NOT NULL)"""


ROI = "(revenue_num - budget_num) / budget_num"


def profiling_bodies() -> dict[str, str]:
    b = {}
    b["missingness"] = " UNION ALL ".join([
        _missing("eda_movies", "movies", ["id", "title", "release_date", "budget", "revenue", "budget_num",
                                          "revenue_num", "release_date_parsed"]),
        _missing("stg_movie_extended", "movies_extended", ["movie_id", "genres", "production_companies",
                                                           "production_countries", "spoken_languages"])
        .replace("'movie_id' AS col", "'id' AS col"),
        _missing("eda_ratings", "ratings", ["movie_id", "last_rated", "avg_rating", "total_ratings"])])
    b["id_quality"] = " UNION ALL ".join([
        _id_quality("eda_movies", "id", "movies"), _id_quality("eda_extended", "id", "movies_extended"),
        _id_quality("eda_ratings", "movie_id", "ratings")])
    b["integrity_report"] = " UNION ALL ".join([
        _orphans("extended_not_in_main", "eda_extended", "id", "eda_movies", "id"),
        _orphans("ratings_not_in_main", "eda_ratings", "movie_id", "eda_movies", "id"),
        _orphans("main_not_in_extended", "eda_movies", "id", "eda_extended", "id")])
    b["anomaly_summary"] = _metrics([
        ("exact_duplicate_rows", "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT id, title, release_date, budget, revenue FROM eda_movies))"),
        ("duplicate_movie_ids", "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT id FROM eda_movies))"),
        ("release_date_total_non_null", "COUNT(*) FILTER (WHERE release_date IS NOT NULL)"),
        ("release_date_parse_failures", "COUNT(*) FILTER (WHERE release_date IS NOT NULL AND release_date_parsed IS NULL)"),
        ("budget_nulls", "COUNT(*) FILTER (WHERE budget_num IS NULL)"),
        ("budget_zeros", "COUNT(*) FILTER (WHERE budget_num = 0)"),
        ("budget_negatives", "COUNT(*) FILTER (WHERE budget_num < 0)"),
        ("revenue_nulls", "COUNT(*) FILTER (WHERE revenue_num IS NULL)"),
        ("revenue_zeros", "COUNT(*) FILTER (WHERE revenue_num = 0)"),
        ("revenue_negatives", "COUNT(*) FILTER (WHERE revenue_num < 0)"),
        ("both_budget_and_revenue_zero", "COUNT(*) FILTER (WHERE budget_num = 0 AND revenue_num = 0)"),
    ], "eda_movies")
    def counted(dataset: str, report: str, rows: list[tuple[str, str]], src: str) -> str:
        return f"SELECT '{dataset}' AS dataset, '{report}' AS report, * FROM (" + _metrics(rows, src, "item") + ")"

    def nulls(dataset: str, src: str, cols: dict[str, str]) -> str:
        return counted(dataset, "nulls", [(c, f"COUNT(*) - COUNT({x})") for c, x in cols.items()], src)

    def ids(dataset: str, src: str, col: str, row: str) -> str:
        return counted(dataset, "ids", [
            ("rows", "COUNT(*)"), ("unique_ids", f"COUNT(DISTINCT {col})"), ("null_ids", f"COUNT(*) - COUNT({col})"),
            ("duplicate_rows_on_id", f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {col} FROM {src}))"),
            ("exact_duplicate_rows", f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {row} FROM {src}))")], src)

    b["table_counts"] = " UNION ALL ".join([
        ids("movies", "eda_movies", "id", "id, title, release_date, budget, revenue"),
        nulls("movies", "eda_movies", {c: c for c in ("id", "title", "release_date", "budget", "revenue", "budget_num", "revenue_num", "release_date_parsed")}),
        counted("movies", "anomalies", [
            ("release_date_total_non_null", "COUNT(release_date)"),
            ("release_date_parse_failures", "COUNT(release_date) - COUNT(CASE WHEN release_date IS NOT NULL THEN release_date_parsed END)"),
            *[(f"{m}_{w}", f"COUNT(*) FILTER (WHERE {m}_num {cond})") for m in ("budget", "revenue")
              for w, cond in (("nulls", "IS NULL"), ("zeros", "= 0"), ("negatives", "< 0"))],
            ("both_budget_and_revenue_zero", "COUNT(*) FILTER (WHERE budget_num = 0 AND revenue_num = 0)")], "eda_movies"),
        counted("movies", "date_patterns", [
            ("YYYY-MM-DD", r"COUNT(*) FILTER (WHERE regexp_full_match(release_date, '\d{4}-\d{2}-\d{2}'))"),
            ("MM/DD/YYYY", r"COUNT(*) FILTER (WHERE regexp_full_match(release_date, '\d{2}/\d{2}/\d{4}'))"),
            ("DD-MM-YYYY", r"COUNT(*) FILTER (WHERE regexp_full_match(release_date, '\d{2}-\d{2}-\d{4}'))")], "eda_movies"),
        ids("movies_extended", "stg_movie_extended", "movie_id", "movie_id, genres, production_companies, production_countries, spoken_languages"),
        nulls("movies_extended", "stg_movie_extended", {"id": "movie_id", **{c: c for c in ("genres", "production_companies", "production_countries", "spoken_languages")}}),
        counted("movies_extended", "delimiters", [(c, f"COUNT(*) FILTER (WHERE {c} LIKE '%, %' OR {c} LIKE '% ,%')") for c in ("genres", "production_companies")], "stg_movie_extended"),
        ids("ratings", "eda_ratings", "movie_id", "movie_id, last_rated, avg_rating, total_ratings"),
        nulls("ratings", "eda_ratings", {c: c for c in ("movie_id", "last_rated", "avg_rating", "total_ratings")}),
        counted("ratings", "validity", [
            ("invalid_avg_rating", "COUNT(*) - COUNT(*) FILTER (WHERE avg_rating >= 0 AND avg_rating <= 10)"),
            ("invalid_total_ratings", "COUNT(*) FILTER (WHERE total_ratings < 0)")], "eda_ratings"),
    ])
    b["date_pattern_census"] = _metrics([
        ("YYYY-MM-DD", r"COUNT(*) FILTER (WHERE regexp_matches(release_date, '^\d{4}-\d{2}-\d{2}$'))"),
        ("MM/DD/YYYY", r"COUNT(*) FILTER (WHERE regexp_matches(release_date, '^\d{2}/\d{2}/\d{4}$'))"),
        ("DD-MM-YYYY", r"COUNT(*) FILTER (WHERE regexp_matches(release_date, '^\d{2}-\d{2}-\d{4}$'))"),
    ], "eda_movies WHERE release_date IS NOT NULL", "pattern", "count")
    b["ratings_validity"] = _metrics([
        ("rows", "COUNT(*)"), ("null_avg_rating", "COUNT(*) FILTER (WHERE avg_rating IS NULL)"),
        ("null_total_ratings", "COUNT(*) FILTER (WHERE total_ratings IS NULL)"),
        ("invalid_avg_rating", "COUNT(*) FILTER (WHERE NOT COALESCE(avg_rating BETWEEN 0 AND 10, false))"),
        ("invalid_total_ratings", "COUNT(*) FILTER (WHERE total_ratings < 0)"),
        ("null_last_rated", "COUNT(*) FILTER (WHERE last_rated IS NULL)"),
    ], "eda_ratings", "metric", "count")
    b["range_report"] = " UNION ALL ".join(
        f"SELECT '{c}' AS field, min({c}) AS min, {r2(f'quantile_cont({c}, 0.5)', 6)} AS p50, "
        f"{r2(f'quantile_cont({c}, 0.9)', 6)} AS p90, max({c}) AS max FROM fin_valid"
        for c in ("budget_num", "revenue_num"))
    b["describe_numeric"] = " UNION ALL ".join(
        f"SELECT '{ds}' AS dataset, '{c}' AS \"column\", COUNT({c}) AS \"count\", {r2(f'AVG({c})', 6)} AS mean, "
        f"{r2(f'STDDEV_SAMP({c})', 6)} AS std, MIN({c}) AS min, {r2(f'quantile_cont({c}, 0.25)', 6)} AS p25, "
        f"{r2(f'quantile_cont({c}, 0.5)', 6)} AS p50, {r2(f'quantile_cont({c}, 0.75)', 6)} AS p75, "
        f"MAX({c}) AS max FROM {src}"
        for ds, src, c in (("movies", "eda_movies", "budget_num"), ("movies", "eda_movies", "revenue_num"),
                           ("ratings", "eda_ratings", "avg_rating"), ("ratings", "eda_ratings", "total_ratings")))
    b["budget_tertiles"] = """
SELECT CASE WHEN budget_num <= q0 THEN 'Low' WHEN budget_num <= q1 THEN 'Mid' ELSE 'High' END AS budget_tier,
       COUNT(*) AS movie_count
FROM fin_valid, (SELECT quantile_cont(budget_num, 0.33) AS q0, quantile_cont(budget_num, 0.66) AS q1 FROM fin_valid)
GROUP BY 1"""
    b["budget_revenue_corr"] = (f"SELECT COUNT(*) AS movies, {r2('corr(budget_num, revenue_num)', 6)} AS pearson_r "
                                f"FROM fin_valid")
    b["valid_financials"] = (f"SELECT id, budget_num, revenue_num, {ROI} AS roi, "
                             f"{r2('CASE WHEN budget_num > 0 THEN log10(budget_num) END', 9)} AS log10_budget, "
                             f"{r2('CASE WHEN revenue_num > 0 THEN log10(revenue_num) END', 9)} AS log10_revenue "
                             f"FROM fin_valid")
    b["roi_histogram"] = _hist(f"(SELECT least(greatest({ROI}, -1.0), 20.0) AS roi FROM fin_valid)", "roi", 50)
    b["rating_histogram"] = _hist("eda_ratings", "avg_rating", 30)
    b["top_rated"] = ("SELECT movie_id, total_ratings FROM stg_ratings "
                      "ORDER BY total_ratings DESC NULLS LAST, movie_id LIMIT 20")
    b["low_budget_outliers"] = "SELECT id, title, budget_num, revenue_num FROM fin_valid WHERE budget_num < 10000"
    b["multivalue_stats"] = " UNION ALL ".join(
        f"SELECT '{f}' AS field, {r2(f'AVG({c})', 6)} AS avg_items_per_movie, CAST(MAX({c}) AS INTEGER) AS max_items_per_movie FROM eda_extended"
        for f, c in (("genres", "n_genres"), ("production_companies", "n_companies"),
                     ("production_countries", "n_countries"), ("spoken_languages", "n_languages")))
    b["delimiter_quality"] = " UNION ALL ".join(
        f"SELECT '{f}' AS field, bool_or(regexp_matches(COALESCE({f}, ''), ',\\s|\\s,')) AS contains_comma_space_pattern, "
        f"CAST(MAX({c}) AS INTEGER) AS max_items, {r2(f'AVG({c})', 6)} AS mean_items FROM eda_extended"
        for f, c in (("genres", "n_genres"), ("production_companies", "n_companies")))
    b["genre_count_distribution"] = ("SELECT CAST(n_genres AS INTEGER) AS items, COUNT(*) AS movie_count "
                                     "FROM eda_extended GROUP BY 1")
    b["dimension_cardinality"] = """
SELECT 'dim_genre' AS dimension, (SELECT COUNT(DISTINCT genre) FROM stg_movie_genres) AS unique_count
UNION ALL SELECT 'dim_company', (SELECT COUNT(DISTINCT company) FROM stg_movie_companies)
UNION ALL SELECT 'dim_country', (SELECT COUNT(DISTINCT country) FROM stg_movie_countries)"""
    b["parse_release_dates"] = "SELECT id, release_date, release_date_parsed FROM eda_movies"
    b["normalize_titles"] = (
        "SELECT id, title, trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS title_norm, "
        "lower(trim(regexp_replace(regexp_replace(title, '[^a-z0-9\\\\s]', ' ', 'g'), '\\\\s+', ' ', 'g'))) AS title_norm_as_written "
        "FROM eda_movies")
    b["parse_country_literals"] = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, c.lit AS production_countries, c.names AS country_names_text,
       CAST(COALESCE(c.n, 0) AS INTEGER) AS country_count
FROM orders o LEFT JOIN (
  SELECT l_orderkey, '[' || string_agg('{''iso_3166_1'': ''' || CAST(n_nationkey AS VARCHAR) || ''', ''name'': '
         || CASE n_nationkey % 5 WHEN 1 THEN '"' || n_name || '"' ELSE '''' || replace(n_name, 'É', '\\xc9') || '''' END
         || CASE n_nationkey % 5 WHEN 3 THEN ', ''note'': None' ELSE '' END || '}', ', ' ORDER BY n_name, n_nationkey) || ']' AS lit,
         string_agg(n_name, ',' ORDER BY n_name, n_nationkey) AS names, COUNT(*) AS n
  FROM (SELECT DISTINCT l_orderkey, n_name, n_nationkey FROM li WHERE n_name IS NOT NULL) GROUP BY l_orderkey) c
ON o.o_orderkey = c.l_orderkey"""
    b["duplicate_flags"] = """
SELECT id, title, COUNT(*) OVER (PARTITION BY id) > 1 AS is_duplicated FROM eda_movies"""
    b["stacked_profile"] = """
SELECT 'movies' AS dataset, COUNT(*) AS rows FROM fin_valid UNION ALL SELECT 'ratings', COUNT(*) FROM eda_ratings"""
    for name, src in (("top_genres", "stg_movie_genres"), ("top_countries", "stg_movie_countries")):
        col = "genre" if "genre" in src else "country"
        b[name] = (f"SELECT {col} AS token, COUNT(*) AS movie_count FROM {src} GROUP BY 1 "
                   f"ORDER BY 2 DESC, 1 LIMIT 15")
    b["dataset_sizes"] = """
SELECT 'movies' AS dataset, COUNT(*) AS rows, 5 AS columns FROM raw_mv
UNION ALL SELECT 'movies_extended', COUNT(*), 5 FROM orders
UNION ALL SELECT 'ratings', COUNT(DISTINCT user_id), 3 FROM events"""
    b["valid_financials_summary"] = " UNION ALL ".join(
        f"SELECT '{m}' AS measure, COUNT(*) AS movies, {r2(f'quantile_cont({e}, 0.5)', 6)} AS median FROM fin_valid"
        for m, e in (("budget_num", "budget_num"), ("revenue_num", "revenue_num"), ("roi", ROI)))
    b["date_parse_failures"] = ("SELECT id, release_date FROM eda_movies "
                                "WHERE release_date IS NOT NULL AND release_date_parsed IS NULL")
    b["top_companies"] = ("SELECT company AS token, COUNT(*) AS movie_count FROM stg_movie_companies "
                          "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
    b["top_languages"] = ("SELECT spoken_languages AS token, COUNT(*) AS movie_count FROM stg_movie_extended "
                          "WHERE spoken_languages IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
    fields = [  # column, type, source and the expression that is counted
        *[("movies", c, "string", "eda_movies", c) for c in ("id", "title", "release_date", "budget", "revenue")],
        *[("movies", c, "double", "eda_movies", c) for c in ("budget_num", "revenue_num")],
        ("movies", "release_date_parsed", "date", "eda_movies", "release_date_parsed"),
        ("movies_extended", "id", "string", "stg_movie_extended", "movie_id"),
        *[("movies_extended", c, "string", "stg_movie_extended", c) for c in ("genres", "production_companies", "production_countries", "spoken_languages")],
        *[("movies_extended", c, "array<string>", "stg_movie_extended", "movie_id") for c in ("genres_list", "production_companies_list", "country_names", "language_names")],
        ("ratings", "movie_id", "string", "eda_ratings", "movie_id"), ("ratings", "last_rated", "timestamp", "eda_ratings", "last_rated"),
        *[("ratings", c, "double", "eda_ratings", c) for c in ("avg_rating", "total_ratings")]]
    rows = " UNION ALL ".join(f"SELECT '{c}' AS c, '{d}' AS d, '{t}' AS t, COUNT({e}) AS n FROM {src}" for d, c, t, src, e in fields)
    types = ", ".join(f"COALESCE(max(t) FILTER (WHERE d = '{d}'), '-') AS {d}" for d in ("movies", "movies_extended", "ratings"))
    b["schema_summary"] = f"SELECT c AS \"column\", {types}, CAST(SUM(n) AS BIGINT) AS rows_with_value FROM ({rows}) GROUP BY c"
    return b
