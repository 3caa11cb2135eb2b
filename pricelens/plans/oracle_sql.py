"""The same queries as SQL text, written independently of the DataFrame code."""

from __future__ import annotations

from itertools import combinations

LISTING = """
li AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty, max(l_linenumber) AS mx,
         round(sum(l_extendedprice), 2) AS price
  FROM lineitem GROUP BY l_orderkey),
host AS (SELECT o_custkey AS hk, count(*) AS n_orders FROM orders GROUP BY o_custkey),
listing AS (
  SELECT o_orderkey AS id, o_custkey AS host_id, c_name AS host_name,
    c_mktsegment || ', ' || o_orderstatus AS name,
    CASE WHEN c_nationkey % 2 = 0 THEN 'LA' ELSE 'NY' END AS city, price,
    CASE WHEN c_nationkey % 2 = 0 THEN 34.0522E0 ELSE 40.7128E0 END + c_acctbal / 10000.0E0 AS latitude,
    CASE WHEN c_nationkey % 2 = 0 THEN -118.2437E0 ELSE -74.0060E0 END
      + (o_custkey % 1000) / 10000.0E0 AS longitude,
    CAST(n_lines AS double) AS minimum_nights, qty AS number_of_reviews,
    qty / n_lines AS reviews_per_month,
    CAST(dayofyear(o_orderdate) AS double) AS availability_365,
    CAST(n_orders AS double) AS calculated_host_listings_count,
    CAST(mx AS double) AS number_of_reviews_ltm,
    CAST(o_orderdate AS date) AS last_review,
    o_orderpriority AS room_type, c_mktsegment AS neighbourhood_group
  FROM orders JOIN li ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN host ON o_custkey = hk)"""

RAW = (
    LISTING
    + """,
raw AS (
  SELECT
    CASE day(last_review) WHEN 1 THEN 'x' || CAST(id AS varchar) WHEN 2 THEN NULL WHEN 3 THEN ''
      ELSE CAST(id AS varchar) END AS id,
    CAST(host_id AS varchar) AS host_id, host_name, name, city,
    CASE day(last_review) WHEN 4 THEN 'Private room' WHEN 5 THEN NULL
      WHEN 6 THEN '-' || CAST(price AS varchar) WHEN 7 THEN '0'
      ELSE '$' || format('{:,}', CAST(floor(price) AS bigint)) END AS price,
    CASE day(last_review) WHEN 8 THEN 'n/a' ELSE CAST(latitude AS varchar) END AS latitude,
    CAST(longitude AS varchar) AS longitude,
    CASE day(last_review) WHEN 9 THEN 'Infinity' ELSE CAST(minimum_nights AS varchar) END
      AS minimum_nights,
    CAST(number_of_reviews AS varchar) AS number_of_reviews,
    CASE day(last_review) WHEN 10 THEN NULL ELSE CAST(reviews_per_month AS varchar) END
      AS reviews_per_month,
    CAST(availability_365 AS varchar) AS availability_365,
    CAST(calculated_host_listings_count AS varchar) AS calculated_host_listings_count,
    CASE day(last_review) WHEN 11 THEN 'NaN' ELSE CAST(number_of_reviews_ltm AS varchar) END
      AS number_of_reviews_ltm,
    CASE day(last_review) WHEN 12 THEN '01/05/2024' WHEN 13 THEN '2024-02-30'
      ELSE CAST(last_review AS varchar) END AS last_review,
    CASE day(last_review) WHEN 14 THEN NULL ELSE room_type END AS room_type,
    neighbourhood_group
  FROM listing)"""
)


def number(column: str) -> str:
    """Text to a finite double or NULL."""
    value = f"try_cast({column} AS double)"
    return f"CASE WHEN isfinite({value}) THEN {value} END"


PRICE = number("regexp_replace(price, '[$,]', '', 'g')")
DOUBLES = (
    "latitude",
    "longitude",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "calculated_host_listings_count",
    "availability_365",
    "number_of_reviews_ltm",
)
DEFAULTED = ("reviews_per_month", "number_of_reviews_ltm")


def cleaned_number(column: str) -> str:
    value = number(column)
    return f"coalesce({value}, 0.0E0)" if column in DEFAULTED else value


CLEAN = (
    RAW
    + f""",
clean AS (
  SELECT * FROM (
    SELECT id, host_id, host_name, name, city, {PRICE} AS price,
      {", ".join(f"{cleaned_number(c)} AS {c}" for c in DOUBLES)},
      try_cast(last_review AS date) AS last_review, room_type, neighbourhood_group
    FROM raw WHERE regexp_matches(id, '^[0-9]+$'))
  WHERE price IS NOT NULL)"""
)

NUMERIC = (
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "availability_365",
    "calculated_host_listings_count",
    "number_of_reviews_ltm",
    "dist_to_center",
    "latitude",
    "longitude",
)
CATEGORICAL = ("room_type", "neighbourhood_group")
LEVELS = {"room_type": 5, "neighbourhood_group": 5}

DISTANCE = """CASE city
  WHEN 'LA' THEN sqrt(pow(latitude - 34.0522E0, 2) + pow(longitude + 118.2437E0, 2))
  WHEN 'NY' THEN sqrt(pow(latitude - 40.7128E0, 2) + pow(longitude + 74.0060E0, 2)) END"""
LOG_PRICE = "CASE WHEN price > 0 THEN ln(1 + price) END"

DERIVED = (
    CLEAN
    + f""",
derived AS (
  SELECT * FROM (SELECT *, {LOG_PRICE} AS log_price, {DISTANCE} AS dist_to_center FROM clean)
  WHERE price > 0 AND {" AND ".join(f"{c} IS NOT NULL" for c in (*NUMERIC, *CATEGORICAL))})"""
)


def level_index(source: str) -> str:
    """CTE ``levels``: frequency-ordered index per categorical column."""
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS n FROM {source} "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORICAL
    )
    return f""",
levels AS (
  SELECT "column", level, n, CAST(row_number() OVER (
    PARTITION BY "column" ORDER BY n DESC, level) - 1 AS integer) AS idx FROM ({counts}))"""


def r(expression: str, digits: int) -> str:
    return f"round({expression}, {digits}) + 0.0E0"


def listing(body: str) -> str:
    return f"WITH {LISTING} {body}"


def raw(body: str) -> str:
    return f"WITH {RAW} {body}"


def clean(body: str) -> str:
    return f"WITH {CLEAN} {body}"


def derived(body: str) -> str:
    return f"WITH {DERIVED} {body}"


CLEAN_OUTPUT = (
    "id, city, price, latitude, minimum_nights, reviews_per_month, number_of_reviews_ltm, "
    "last_review, room_type"
)


def per_column(template: str, columns: tuple[str, ...], source: str) -> str:
    """One grouped SELECT per column, stacked."""
    return " UNION ALL ".join(
        f"SELECT city, '{c}' AS \"column\", {template.format(c=c)} FROM {source} GROUP BY city"
        for c in columns
    )


def histogram(column: str, source: str) -> str:
    return f"""
, edges AS (SELECT city, min({column}) AS lo, max({column}) AS hi FROM {source} GROUP BY city),
frame AS (SELECT city, lo, hi, (hi - lo) / 50.0E0 AS width, CAST(b AS integer) AS bin
          FROM edges, range(50) t(b)),
counted AS (
  SELECT s.city, CAST(CASE WHEN hi > lo
      THEN least(floor(({column} - lo) / ((hi - lo) / 50.0E0)), 49) ELSE 0 END AS integer) AS bin,
    count(*) AS n
  FROM {source} s JOIN edges USING (city) WHERE {column} IS NOT NULL GROUP BY ALL)
SELECT f.city, '{column}' AS "column", f.bin, {r("lo + f.bin * width", 6)} AS lower,
  {r("lo + (f.bin + 1) * width", 6)} AS upper, coalesce(n, 0) AS n
FROM frame f LEFT JOIN counted c ON f.city = c.city AND f.bin = c.bin"""


LOGGED = f", logged AS (SELECT *, {LOG_PRICE} AS log_price FROM clean WHERE price > 0) "

CORRELATED = (
    "price",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "availability_365",
    "calculated_host_listings_count",
    "number_of_reviews_ltm",
    "latitude",
    "longitude",
)


def correlation_matrix() -> str:
    pairs = list(combinations(CORRELATED, 2))
    wide = ", ".join(f"{r(f'corr({a}, {b})', 6)} AS r{i}" for i, (a, b) in enumerate(pairs))
    off_diagonal = [
        f"SELECT city, '{x}' AS a, '{y}' AS b, r{i} AS r FROM wide"
        for i, (a, b) in enumerate(pairs)
        for x, y in ((a, b), (b, a))
    ]
    diagonal = [f"SELECT city, '{c}' AS a, '{c}' AS b, 1.0E0 AS r FROM wide" for c in CORRELATED]
    return (
        f", wide AS MATERIALIZED (SELECT city, {wide} FROM clean GROUP BY city) "
        + " UNION ALL ".join(off_diagonal + diagonal)
    )


BUCKET = "('0x' || substr(md5(concat(CAST(id AS varchar), ':42')), 1, 8))::bigint"

SCORES = ", scored AS MATERIALIZED ({}), score AS (SELECT city, model, feature_index, r * r / sum(r * r) OVER (PARTITION BY city) AS importance FROM scored) ".format(
    " UNION ALL ".join(
        f"SELECT city, 'SquaredCorrelation' AS model, CAST({i} AS integer) AS feature_index, "
        f"corr({c}, log_price) AS r FROM derived GROUP BY city"
        for i, c in enumerate(NUMERIC)
    )
)
RANKED = SCORES + (
    ", ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY city, model "
    "ORDER BY importance DESC, feature_index) AS integer) AS rank, "
    "CAST(feature_index AS varchar) AS label FROM score) "
)
RANKED_OUTPUT = (
    f"SELECT city, model, feature_index, {r('importance', 6)} AS importance, rank, label FROM ranked"
)

INDEX_MAP = (
    level_index("derived")
    + ", index_map AS ("
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS integer) AS feature_index, '{c}' AS feature, '{c}' AS source, "
        "CAST(NULL AS varchar) AS level"
        for i, c in enumerate(NUMERIC)
    )
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT CAST({len(NUMERIC)} + {offset} + idx AS integer), '{c}_ohe_' || idx, '{c}', level "
        f"FROM levels WHERE \"column\" = '{c}'"
        for c, offset in (
            ("room_type", "0"),
            (
                "neighbourhood_group",
                "(SELECT count(*) FROM levels WHERE \"column\" = 'room_type')",
            ),
        )
    )
    + ") "
)

TRAINED = f""",
logged AS (SELECT *, ln(1 + price) AS log_price FROM listing),
train AS (SELECT * FROM logged WHERE {BUCKET} % 100 < 80),
test AS (SELECT * FROM logged WHERE {BUCKET} % 100 >= 80),
by_city AS (SELECT city, avg(log_price) AS p FROM train GROUP BY city),
by_room AS (SELECT city, room_type, avg(log_price) AS p FROM train GROUP BY ALL),
by_group AS (SELECT city, neighbourhood_group, avg(log_price) AS p FROM train GROUP BY ALL),
predicted AS (
  SELECT t.city, 'CityMean' AS model, log_price AS y, p FROM test t LEFT JOIN by_city USING (city)
  UNION ALL
  SELECT t.city, 'RoomTypeMean', log_price, p FROM test t LEFT JOIN by_room USING (city, room_type)
  UNION ALL
  SELECT t.city, 'NeighbourhoodMean', log_price, p
  FROM test t LEFT JOIN by_group USING (city, neighbourhood_group)),
metrics AS (
  SELECT city, model, sqrt(avg((p - y) * (p - y))) AS rmse, avg(abs(p - y)) AS mae,
    1 - sum((p - y) * (p - y)) / sum((y - m) * (y - m)) AS r2, count(*) AS n_test
  FROM (SELECT *, avg(y) OVER (PARTITION BY city, model) AS m FROM predicted WHERE p IS NOT NULL)
  GROUP BY city, model),
unscored AS (
  SELECT city, model, count(*) FILTER (WHERE p IS NULL OR y IS NULL) AS n_unscored
  FROM predicted GROUP BY city, model)
"""
METRICS_OUTPUT = (
    f"city, model, {r('rmse', 4)} AS rmse, {r('mae', 4)} AS mae, {r('r2', 4)} AS r2, n_test, n_unscored"
)

PARTS = f""",
train AS (SELECT *, log_price AS y FROM derived WHERE {BUCKET} % 100 < 80),
test AS (SELECT *, log_price AS y FROM derived WHERE {BUCKET} % 100 >= 80)"""
SCORED = """,
metrics AS (
  SELECT city, sqrt(avg((p - y) * (p - y))) AS rmse, avg(abs(p - y)) AS mae,
    1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) AS r2
  FROM predicted GROUP BY city)"""
# Penalty 0.1, half of it absolute and half squared, over the label's deviation.
ELASTIC = (
    PARTS
    + """,
moments AS (
  SELECT city, avg(y) AS my, avg(number_of_reviews) AS mx, stddev_pop(y) AS sy,
    stddev_pop(number_of_reviews) AS sx, corr(number_of_reviews, y) AS rho
  FROM train GROUP BY city),
fitted AS (
  SELECT city, mx, my, sign(rho) * greatest(abs(rho) - 0.05 / sy, 0) / (1 + 0.05 / sy) * sy / sx AS w
  FROM moments),
predicted AS (
  SELECT test.city, y, my + w * (number_of_reviews - mx) AS p FROM test JOIN fitted USING (city))"""
    + SCORED
)
ELASTIC_GROUPS = (
    PARTS
    + """,
moments AS (
  SELECT city, room_type, avg(y) AS my, avg(number_of_reviews) AS mx, stddev_pop(y) AS sy,
    stddev_pop(number_of_reviews) AS sx, corr(number_of_reviews, y) AS rho, count(*) AS n_train
  FROM train GROUP BY city, room_type),
fitted AS (
  SELECT city, room_type, mx, my, n_train,
    sign(rho) * greatest(abs(rho) - 0.05 / sy, 0) / (1 + 0.05 / sy) * sy / sx AS w
  FROM moments),
predicted AS (
  SELECT city, room_type, y, my + w * (number_of_reviews - mx) AS p
  FROM test JOIN fitted USING (city, room_type)),
metrics AS (
  SELECT city, room_type, sqrt(avg((p - y) * (p - y))) AS rmse, avg(abs(p - y)) AS mae,
    1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) AS r2, count(*) AS n_test
  FROM predicted GROUP BY city, room_type)"""
)
_GAINS = """
  SELECT s.city, s.level, s1, s0, n1, n0, s1 / n1 AS m1, s0 / n0 AS m0,
    s1 * s1 / n1 + s0 * s0 / n0 - (s1 + s0) * (s1 + s0) / (n1 + n0) AS gain,
    row_number() OVER (PARTITION BY s.city ORDER BY s1 * s1 / n1 + s0 * s0 / n0 DESC) AS place
  FROM (SELECT a.city, a.level, a.s AS s1, t.s - a.s AS s0, a.n AS n1, t.n - a.n AS n0
        FROM {sums} a JOIN (SELECT city, sum(s) AS s, sum(n) AS n FROM {sums} GROUP BY city) t
        USING (city) WHERE t.n > a.n) s"""
SPLITS = (
    level_index("derived")
    + PARTS
    + """,
sums AS MATERIALIZED (
  SELECT city, room_type AS level, sum(y) AS s, CAST(count(*) AS double) AS n FROM train GROUP BY ALL),
one AS MATERIALIZED (SELECT * FROM ("""
    + _GAINS.format(sums="sums")
    + """) WHERE place = 1),
left_over AS MATERIALIZED (
  SELECT sums.city, sums.level, n,
    2 * (s - n * CASE WHEN sums.level = one.level THEN m1 ELSE m0 END) AS s
  FROM sums JOIN one USING (city)),
two AS MATERIALIZED (SELECT * FROM ("""
    + _GAINS.format(sums="left_over")
    + """) WHERE place = 1),
named AS (SELECT level, 'room_type_ohe_' || idx AS feature FROM levels WHERE "column" = 'room_type')"""
)
FITTED_OUTPUT = f"{r('rmse', 5)} AS rmse, {r('mae', 5)} AS mae, {r('r2', 5)} AS r2"

ORACLES: dict[str, str] = {
    "fit_elastic_one": derived(
        ELASTIC
        + f" SELECT city, {r('w', 5)} AS coefficient, {r('my - w * mx', 5)} AS intercept, "
        + f"{FITTED_OUTPUT} FROM metrics JOIN fitted USING (city)"
    ),
    "fit_one_split": derived(
        SPLITS
        + """,
predicted AS (
  SELECT test.city, y, CASE WHEN room_type = level THEN m1 ELSE m0 END AS p
  FROM test JOIN one USING (city))"""
        + SCORED
        + " SELECT city, feature, 1.0E0 AS importance, "
        + f"{FITTED_OUTPUT} FROM metrics JOIN one USING (city) JOIN named USING (level)"
    ),
    "fit_two_rounds": derived(
        SPLITS
        + """,
predicted AS (
  SELECT test.city, y, CASE WHEN room_type = one.level THEN one.m1 ELSE one.m0 END
    + 0.1 * CASE WHEN room_type = two.level THEN two.m1 ELSE two.m0 END AS p
  FROM test JOIN one USING (city) JOIN two USING (city))"""
        + SCORED
        + """,
used AS (
  SELECT city, feature, sum(gain) / sum(sum(gain)) OVER (PARTITION BY city) AS importance
  FROM (SELECT city, level, gain FROM one UNION ALL SELECT city, level, gain FROM two)
  JOIN named USING (level) GROUP BY city, feature)"""
        + f" SELECT city, feature, {r('importance', 5)} AS importance, "
        + f"{FITTED_OUTPUT} FROM metrics JOIN used USING (city)"
    ),
    "fit_linear_groups": derived(
        ELASTIC_GROUPS
        + f" SELECT city, room_type, {r('w', 5)} AS coefficient, {r('my - w * mx', 5)} AS intercept, "
        + f"n_train, {FITTED_OUTPUT}, n_test FROM metrics JOIN fitted USING (city, room_type)"
    ),
    "training_reports": derived(
        SPLITS
        + """,
predicted AS (
  SELECT test.city, y, CASE WHEN room_type = level THEN m1 ELSE m0 END AS p
  FROM test JOIN one USING (city))"""
        + SCORED
        + ", tested AS (SELECT city, count(*) AS n_test FROM predicted GROUP BY city)"
        + " SELECT city, 'RandomForest' AS model, feature, 1.0E0 AS importance, "
        + f"{FITTED_OUTPUT}, n_test, 'ok' AS status "
        + "FROM metrics JOIN one USING (city) JOIN named USING (level) JOIN tested USING (city)"
    ),
    "row_counts": derived(
        "SELECT 'raw' AS stage, count(*) AS n FROM raw "
        "UNION ALL SELECT 'clean', count(*) FROM clean "
        "UNION ALL SELECT 'model', count(*) FROM derived"
    ),
    "preview": listing("SELECT id, city, price, room_type FROM listing ORDER BY id LIMIT 20"),
    "clean_listings": clean(f"SELECT {CLEAN_OUTPUT} FROM clean"),
    "csv_listings": clean(f"SELECT {CLEAN_OUTPUT} FROM clean"),
    "model_frame_table": derived(
        f"{level_index('derived')} SELECT id, city, {r('log_price', 6)} AS log_price, "
        "CAST(9 + (SELECT count(*) FROM levels) AS integer) AS width, "
        f"{r('dist_to_center', 6)} AS dist_to_center FROM derived"
    ),
    "report_csv": derived(RANKED + RANKED_OUTPUT),
    "keep_numeric_ids": raw("SELECT id, city FROM raw WHERE regexp_matches(id, '^[0-9]+$')"),
    "require_price": raw("SELECT city, price, room_type FROM raw WHERE price IS NOT NULL"),
    "positive_price": clean("SELECT id, city, price FROM clean WHERE price > 0"),
    "price_cap": clean("SELECT id, city, price FROM clean WHERE price > 0 AND price <= 200000"),
    "drop_incomplete": clean(
        "SELECT id, price, latitude, minimum_nights, room_type FROM clean "
        "WHERE latitude IS NOT NULL AND minimum_nights IS NOT NULL AND room_type IS NOT NULL"
    ),
    "fill_defaults": raw(
        "SELECT id, coalesce(try_cast(reviews_per_month AS double), 0.0E0) AS reviews_per_month, "
        f"coalesce({number('number_of_reviews_ltm')}, 0.0E0) AS number_of_reviews_ltm FROM raw"
    ),
    "clean_currency": raw(
        f"SELECT city, price AS text, {PRICE} AS stripped, {number('price')} AS bare FROM raw"
    ),
    "safe_double": raw(
        f"SELECT host_id, {', '.join(f'{number(c)} AS {c}' for c in DOUBLES)} FROM raw"
    ),
    "safe_date": raw(
        "SELECT host_id, city, try_cast(last_review AS date) AS last_review FROM raw"
    ),
    "log_price": clean(
        f"SELECT id, city, {r(LOG_PRICE, 6)} AS log_price FROM clean WHERE price > 0"
    ),
    "dist_to_center": clean(f"SELECT id, city, {r(DISTANCE, 6)} AS dist_to_center FROM clean"),
    "null_counts": clean(
        "SELECT city, "
        + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}"
            for c in (
                "id",
                "host_id",
                "host_name",
                "name",
                "price",
                *DOUBLES,
                "last_review",
                *CATEGORICAL,
            )
        )
        + " FROM clean GROUP BY city"
    ),
    "describe_by_city": clean(
        per_column(
            f"count({{c}}) AS n, {r('avg({c})', 6)} AS mean, {r('stddev_samp({c})', 4)} AS stddev, "
            f"{r('min({c})', 6)} AS min, {r('max({c})', 6)} AS max",
            ("price", *DOUBLES),
            "clean",
        )
    ),
    "describe_text_by_city": clean(
        per_column(
            "count({c}) AS n, min({c}) AS min, max({c}) AS max",
            ("room_type", "neighbourhood_group", "host_name"),
            "clean",
        )
    ),
    "quartiles_by_city": clean(
        per_column(
            "count({c}) AS n, "
            + ", ".join(
                f"{r(f'quantile_cont({{c}}, {p})', 4)} AS {name}"
                for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
            ),
            ("price", *DOUBLES),
            "clean",
        )
    ),
    "price_tail": clean(
        f"SELECT city, {r('max(price)', 4)} AS max, {r('quantile_cont(price, 0.95)', 4)} AS p95, "
        f"{r('quantile_cont(price, 0.99)', 4)} AS p99 FROM clean GROUP BY city"
    ),
    "price_range_capped": clean(
        "SELECT city, min(price) AS min, max(price) AS max, count(*) AS n FROM clean "
        "WHERE price > 0 AND price <= 200000 GROUP BY city"
    ),
    "price_histogram": clean(histogram("price", "clean")),
    "log_price_histogram": clean(LOGGED + histogram("log_price", "logged")),
    "geo_price_grid": clean(
        "SELECT city, CAST(floor(latitude / 0.25E0) AS bigint) AS lat_cell, "
        "CAST(floor(longitude / 0.02E0) AS bigint) AS lon_cell, count(*) AS n, "
        f"{r('avg(price)', 6)} AS mean FROM clean WHERE price > 0 AND price <= 200000 "
        "AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL"
    ),
    "geo_points": clean(
        "SELECT city, latitude, longitude, price FROM clean WHERE price > 0 AND price <= 200000 "
        "AND latitude IS NOT NULL AND longitude IS NOT NULL"
    ),
    "nights_points": clean(
        f"SELECT city, minimum_nights, {r(LOG_PRICE, 6)} AS log_price FROM clean "
        "WHERE price > 0 AND minimum_nights IS NOT NULL"
    ),
    "nights_vs_log_price": clean(
        f"SELECT city, minimum_nights, count(*) AS n, {r(f'avg({LOG_PRICE})', 6)} AS mean, "
        f"{r(f'min({LOG_PRICE})', 6)} AS min, {r(f'max({LOG_PRICE})', 6)} AS max FROM clean "
        "WHERE price > 0 AND minimum_nights IS NOT NULL GROUP BY city, minimum_nights"
    ),
    "scatter_sample": listing(
        f"SELECT id, city, latitude, longitude, price FROM listing WHERE {BUCKET} % 1000 < 50"
    ),
    "scatter_points": listing(
        "SELECT id, city, latitude, longitude, price FROM (SELECT *, row_number() OVER (PARTITION BY city "
        "ORDER BY md5(concat(CAST(id AS varchar), ':42')), id) AS place FROM listing) WHERE place <= 200"
    ),
    "price_correlation": clean(correlation_matrix()),
    "union_cities": listing(
        "SELECT id, 'LA' AS city, price, room_type FROM listing WHERE city = 'LA' "
        "UNION ALL SELECT id, 'NY', price, room_type FROM listing WHERE city = 'NY'"
    ),
    "split_by_key": listing("SELECT id, city, price FROM listing WHERE city = 'LA'"),
    "train_test_split": listing(
        f"SELECT id, city, price, CASE WHEN {BUCKET} % 100 < 80 THEN 'train' ELSE 'test' END "
        "AS part FROM listing"
    ),
    "category_index": clean(f"{level_index('clean')} SELECT * FROM levels"),
    "one_hot_long": clean(
        level_index("clean")
        + " UNION ALL ".join(
            f"SELECT id, '{c}' AS \"column\", idx AS position, 1.0E0 AS value FROM clean "
            f"JOIN levels ON levels.\"column\" = '{c}' AND level = {c}"
            for c in CATEGORICAL
        )
    ),
    "model_frame": derived(
        level_index("derived")
        + f"SELECT id, city, {r('log_price', 6)} AS log_price, "
        + ", ".join(f"{r(c, 6)} AS {c}" for c in NUMERIC)
        + ", "
        + ", ".join(
            f"CASE WHEN {c[0]}.idx = {i} THEN 1.0E0 ELSE 0.0E0 END AS {c}_ohe_{i}"
            for c in CATEGORICAL
            for i in range(LEVELS[c])
        )
        + " FROM derived "
        + " ".join(
            f"LEFT JOIN levels {c[0]} ON {c[0]}.\"column\" = '{c}' AND {c[0]}.level = {c}"
            for c in CATEGORICAL
        )
    ),
    "model_frame_long": derived(
        INDEX_MAP
        + " UNION ALL ".join(
            f"SELECT id, city, CAST({i} AS integer) AS position, {r(c, 6)} AS value FROM derived WHERE {c} <> 0"
            for i, c in enumerate(NUMERIC)
        )
        + " UNION ALL "
        + " UNION ALL ".join(
            f"SELECT id, city, feature_index, 1.0E0 FROM derived JOIN index_map ON source = '{c}' AND index_map.level = {c}"
            for c in CATEGORICAL
        )
    ),
    "feature_index_map": derived(INDEX_MAP + "SELECT * FROM index_map"),
    "evaluate_regression": listing(
        TRAINED + f"SELECT {METRICS_OUTPUT} FROM metrics JOIN unscored USING (city, model) WHERE model = 'RoomTypeMean'"
    ),
    "best_model": listing(
        TRAINED
        + f"SELECT {METRICS_OUTPUT} FROM (SELECT *, row_number() OVER ("
        "PARTITION BY city ORDER BY rmse, model) AS place FROM metrics JOIN unscored USING (city, model)) WHERE place = 1"
    ),
    "named_importance": derived(
        INDEX_MAP
        + SCORES
        + f"SELECT city, model, score.feature_index, {r('importance', 6)} AS importance, feature, "
        "source, level FROM score LEFT JOIN index_map USING (feature_index)"
    ),
    "rank_importance": derived(RANKED + RANKED_OUTPUT),
    "importance_of_pair": derived(RANKED + RANKED_OUTPUT + " WHERE city = 'LA'"),
    "top_features": derived(RANKED + RANKED_OUTPUT + " WHERE rank <= 5"),
    "compare_drivers": derived(
        SCORES
        + f"SELECT model, feature_index, {r('la', 6)} AS \"LA\", {r('ny', 6)} AS \"NY\", "
        f"{r('la - ny', 6)} AS difference FROM (SELECT model, feature_index, "
        "max(importance) FILTER (city = 'LA') AS la, max(importance) FILTER (city = 'NY') AS ny "
        "FROM score GROUP BY model, feature_index)"
    ),
}
