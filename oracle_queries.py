"""DuckDB statements with the same result as the queries of the registry."""

from __future__ import annotations

LISTINGS = """listings AS (
WITH base AS (
  SELECT o_orderkey AS listing_id,
    o_totalprice * CAST(8 AS DOUBLE) AS PRICE,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 6 AS DOUBLE) END AS BEDS,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST((o_orderkey * 31) % 9 AS DOUBLE) / CAST(2 AS DOUBLE) END AS BATH,
    CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN CAST(60000 AS DOUBLE)
         WHEN o_orderkey % 103 = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(400 + (o_orderkey * 37) % 3600 AS DOUBLE) END AS PROPERTYSQFT,
    CAST(404000 + (o_orderkey * 7919) % 5600 AS DOUBLE) / CAST(10000 AS DOUBLE) AS LATITUDE,
    CAST(-743000 + (o_orderkey * 104729) % 7200 AS DOUBLE) / CAST(10000 AS DOUBLE) AS LONGITUDE,
    CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN n_regionkey = 0 THEN 'New York County'
         WHEN n_regionkey = 1 THEN ' Kings County ' WHEN n_regionkey = 2 THEN 'QUEENS'
         WHEN n_regionkey = 3 THEN 'The Bronx' ELSE 'Elsewhere' END AS BOROUGH,
    concat('  ', o_orderpriority, ' For Sale ') AS TYPE,
    concat('Sub ', CAST(o_custkey % 120 AS VARCHAR)) AS SUBLOCALITY,
    CASE WHEN o_custkey % 4 = 0 THEN CAST(10000 + o_custkey AS VARCHAR)
         WHEN o_custkey % 4 = 1 THEN concat(CAST(10000 + o_custkey AS VARCHAR), '.0')
         WHEN o_custkey % 4 = 2 THEN concat(CAST(10000 + o_custkey AS VARCHAR), '-1234')
         ELSE CAST(o_custkey AS VARCHAR) END AS ZIPCODE,
    'residential' AS PROPERTY_CATEGORY
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT * FROM base
UNION ALL SELECT * FROM base WHERE listing_id % 50 = 0
UNION ALL SELECT listing_id + 100000000, PRICE, BEDS, BATH, PROPERTYSQFT,
  LATITUDE + CAST(1 AS DOUBLE) / CAST(100000 AS DOUBLE), LONGITUDE, BOROUGH, TYPE, SUBLOCALITY, ZIPCODE,
  PROPERTY_CATEGORY FROM base WHERE listing_id % 75 = 0)"""

SALES = """sales AS (
WITH b AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice * CAST(8 AS DOUBLE)) AS BIGINT) AS p, n_regionkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT k AS sale_id, n_regionkey + 1 AS BOROUGH,
  CASE WHEN k % 41 = 0 THEN NULL WHEN k % 5 = 0 THEN '01 ONE FAMILY DWELLINGS' WHEN k % 5 = 1 THEN ' R4 CONDOMINIUMS'
       WHEN k % 5 = 2 THEN 'R6 CONDOMINIUMS' WHEN k % 5 = 3 THEN '21 OFFICE BUILDINGS' ELSE 'R5 CONDOMINIUMS' END AS BUILDING_CLASS_CATEGORY,
  CASE WHEN k % 31 = 0 THEN '0' ELSE concat('1,', lpad(CAST(k % 1000 AS VARCHAR), 3, '0')) END AS GROSS_SQUARE_FEET,
  concat(' 2,', lpad(CAST((k * 7) % 1000 AS VARCHAR), 3, '0'), ' ') AS LAND_SQUARE_FEET,
  CASE WHEN k % 37 = 0 THEN 0 ELSE 1900 + k % 120 END AS YEAR_BUILT,
  10000 + k % 1700 AS ZIP_CODE,
  CASE WHEN k % 11 = 0 THEN '0' WHEN k % 13 = 0 THEN '1' WHEN k % 97 = 0 THEN '250,000,000' WHEN k % 29 = 0 THEN ' -  '
       WHEN p >= 1000 THEN concat(CAST((p - p % 1000) / 1000 AS BIGINT), ',', lpad(CAST(p % 1000 AS VARCHAR), 3, '0'))
       ELSE CAST(p AS VARCHAR) END AS SALE_PRICE
FROM b)"""

SCORED = """scored AS (
WITH z AS (SELECT o_orderkey AS k, o_totalprice * CAST(8 AS DOUBLE) AS price, n_regionkey AS grp
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
y AS (SELECT k, grp, price, CASE WHEN price <= 500000 THEN 0 WHEN price <= 1000000 THEN 1 WHEN price <= 2000000 THEN 2 ELSE 3 END AS y_true FROM z),
q AS (SELECT k, grp, price, y_true, CASE WHEN k % 7 = 0 THEN (y_true + 1) % 4 WHEN k % 11 = 0 THEN 0 ELSE y_true END AS y_pred FROM y),
w AS (SELECT *, 1 + (k * 3) % 10 + CASE WHEN y_pred = 0 THEN 8 ELSE 0 END AS w0, 1 + (k * 7) % 10 + CASE WHEN y_pred = 1 THEN 8 ELSE 0 END AS w1,
  1 + (k * 9) % 10 + CASE WHEN y_pred = 2 THEN 8 ELSE 0 END AS w2, 1 + (k * 13) % 10 + CASE WHEN y_pred = 3 THEN 8 ELSE 0 END AS w3 FROM q)
SELECT k AS row_id, grp, y_true, y_pred,
  CAST(w0 AS DOUBLE) / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p0, CAST(w1 AS DOUBLE) / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p1,
  CAST(w2 AS DOUBLE) / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p2, CAST(w3 AS DOUBLE) / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p3,
  price, price * (CAST(1 AS DOUBLE) + CAST(k % 21 - 10 AS DOUBLE) / CAST(100 AS DOUBLE)) AS price_pred
FROM w)"""

STATIONS = """stations AS (SELECT
  CAST(404000 + (s_suppkey * 911) % 5500 AS DOUBLE) / CAST(10000 AS DOUBLE) AS latitude,
  CAST(-743000 + (s_suppkey * 1777) % 7000 AS DOUBLE) / CAST(10000 AS DOUBLE) AS longitude FROM supplier)"""

REQUESTS = """requests AS (SELECT event_id AS request_id, ts,
  CAST(user_id % 23 AS INTEGER) AS beds, CAST(event_id % 33 AS DOUBLE) / CAST(2 AS DOUBLE) AS bath,
  value * CAST(100 AS DOUBLE) AS propertysqft,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 'Manhattan' ELSE 'Queens' END AS borough,
  CASE WHEN event_id % 2 = 0 THEN 'Condo' ELSE 'House' END AS type,
  CASE WHEN event_id % 29 = 0 THEN 'abc' ELSE CAST(10000 + user_id AS VARCHAR) END AS zipcode,
  CAST(404000 + (event_id * 7919) % 5600 AS DOUBLE) / CAST(10000 AS DOUBLE) AS latitude,
  CAST(-743000 + (event_id * 104729) % 7200 AS DOUBLE) / CAST(10000 AS DOUBLE) AS longitude,
  CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE concat('Sub ', CAST(user_id % 120 AS VARCHAR)) END AS sublocality
  FROM events)"""

COLUMNS = """listing_id, PRICE, BEDS, BATH, PROPERTYSQFT, LATITUDE, LONGITUDE, BOROUGH, TYPE, SUBLOCALITY,
  ZIPCODE, PROPERTY_CATEGORY"""

DEDUP = """dedup AS (SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY round_even(LATITUDE * 10000, 0), round_even(LONGITUDE * 10000, 0), PRICE
    ORDER BY listing_id) AS nth FROM listings) t WHERE nth = 1)"""


def stripped(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def text(c: str) -> str:
    return f"lower({stripped(c)})"


def borough(c: str) -> str:
    return f"""CASE {text(c)} WHEN 'new york county' THEN 'manhattan' WHEN 'kings county' THEN 'brooklyn'
  WHEN 'queens county' THEN 'queens' WHEN 'bronx county' THEN 'the bronx' WHEN 'richmond county' THEN 'staten island'
  WHEN 'manhattan' THEN 'manhattan' WHEN 'brooklyn' THEN 'brooklyn' WHEN 'queens' THEN 'queens'
  WHEN 'the bronx' THEN 'the bronx' WHEN 'staten island' THEN 'staten island' ELSE {c} END"""


def zipcode(c: str) -> str:
    return rf"CASE WHEN {c} IS NULL OR regexp_extract({c}, '(\d{{5}})', 1) = '' THEN '00000' ELSE regexp_extract({c}, '(\d{{5}})', 1) END"


def property_type(c: str) -> str:
    return stripped(rf"regexp_replace(regexp_replace({c}, '\s+for\s+sale$', ''), '\s+for\s+rent$', '')")


NORMALIZED = f"""normalized AS (SELECT listing_id, PRICE, BEDS, BATH, PROPERTYSQFT, LATITUDE, LONGITUDE,
  {borough(text("BOROUGH"))} AS BOROUGH, {property_type(text("TYPE"))} AS TYPE, {text("SUBLOCALITY")} AS SUBLOCALITY,
  {zipcode(text("ZIPCODE"))} AS ZIPCODE, {text("PROPERTY_CATEGORY")} AS PROPERTY_CATEGORY FROM dedup)"""


def imputed(source: str) -> str:
    return f"""medians AS (SELECT BOROUGH AS b, median(BEDS) AS mbeds, median(BATH) AS mbath FROM {source}
  WHERE BOROUGH IS NOT NULL GROUP BY BOROUGH),
filled AS (SELECT s.* EXCLUDE (BEDS, BATH), coalesce(BEDS, mbeds) AS BEDS, coalesce(BATH, mbath) AS BATH
  FROM {source} s LEFT JOIN medians ON BOROUGH = b),
overall AS (SELECT median(BEDS) AS obeds, median(BATH) AS obath, median(PROPERTYSQFT) AS osqft FROM filled),
imputed AS (SELECT filled.* EXCLUDE (BEDS, BATH, PROPERTYSQFT), coalesce(BEDS, obeds) AS BEDS,
  coalesce(BATH, obath) AS BATH, coalesce(PROPERTYSQFT, osqft) AS PROPERTYSQFT FROM filled, overall)"""


def capped(source: str, factor: str) -> str:
    names = ["PRICE", "PROPERTYSQFT", "BEDS", "BATH"]
    quartiles = ", ".join(
        f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in names)
    clipped = ", ".join(f"""CASE WHEN {c} < q1_{c} - {factor} * (q3_{c} - q1_{c}) THEN q1_{c} - {factor} * (q3_{c} - q1_{c})
  WHEN {c} > q3_{c} + {factor} * (q3_{c} - q1_{c}) THEN q3_{c} + {factor} * (q3_{c} - q1_{c}) ELSE {c} END AS {c}""" for c in names)
    return f"""fences AS (SELECT {quartiles} FROM {source}),
capped AS (SELECT {source}.* EXCLUDE ({', '.join(names)}), {clipped} FROM {source}, fences)"""


CLEAN = ",\n".join([LISTINGS, DEDUP, NORMALIZED, imputed("normalized"), capped("imputed", "3.0"), """cleaned AS (
SELECT * FROM capped WHERE PRICE > 0 AND PROPERTYSQFT > 0 AND LATITUDE BETWEEN 40.4 AND 40.95
  AND LONGITUDE BETWEEN -74.3 AND -73.6)"""])


def zone(c: str) -> str:
    return f"""CASE WHEN {c} < 0 THEN NULL WHEN {c} <= 500000 THEN 'Low' WHEN {c} <= 1000000 THEN 'Medium'
  WHEN {c} <= 2000000 THEN 'High' WHEN {c} > 2000000 THEN 'Very High' END"""


def size_category(c: str) -> str:
    return f"""CASE WHEN {c} < 0 THEN NULL WHEN {c} <= 1000 THEN 'Small' WHEN {c} <= 2000 THEN 'Medium'
  WHEN {c} > 2000 THEN 'Large' END"""


def zone_code(c: str) -> str:
    return f"CASE {c} WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 WHEN 'Very High' THEN 3 END"


def haversine(lat: str, lon: str, lat0: float, lon0: float) -> str:
    a = f"(pow(sin(radians({lat0} - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians({lat0})) * pow(sin(radians({lon0} - {lon}) / 2), 2))"
    return f"12742 * atan2(sqrt({a}), sqrt(1 - {a}))"


MANHATTAN = haversine("LATITUDE", "LONGITUDE", 40.7580, -73.9855)
PARK = haversine("LATITUDE", "LONGITUDE", 40.7829, -73.9654)
AT_LEAST_ONE = "CASE WHEN {0} < 1 THEN 1 ELSE {0} END"
RATIO = f"BEDS / ({AT_LEAST_ONE.format('BATH')})"
DENSITY = f"(BEDS + BATH) / ({AT_LEAST_ONE.format('PROPERTYSQFT')})"

HEX = """axial AS (SELECT *, (x * sqrt(3) / 3 - y / 3) / 1.2 AS q, (y * 2 / 3) / 1.2 AS r FROM (
  SELECT *, radians(LONGITUDE - (-73.9855)) * 6371 * cos(radians(40.7580)) AS x,
    radians(LATITUDE - 40.7580) * 6371 AS y FROM listings) t),
cubes AS (SELECT *, round_even(q, 0) AS rq, round_even(r, 0) AS rr, round_even(-q - r, 0) AS rs FROM axial),
errors AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs + q + r) AS ds FROM cubes),
hexed AS (SELECT *, concat(
  CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS VARCHAR), '_',
  CAST(CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS VARCHAR)) AS cell
  FROM errors)"""


def top_of(source: str, c: str, n: int) -> str:
    return f"""(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT {n})"""


def kept(source: str, c: str, n: int = 50) -> str:
    return f"CASE WHEN {c} IN {top_of(source, c, n)} THEN {c} ELSE 'other' END"


NEAREST = """nearest AS (SELECT LATITUDE AS la, LONGITUDE AS lo, min(sqrt(pow(radians(LATITUDE) - radians(latitude_s), 2)
  + pow(radians(LONGITUDE) - radians(longitude_s), 2))) * 6371 AS d
  FROM (SELECT DISTINCT LATITUDE, LONGITUDE FROM listings) l,
    (SELECT latitude AS latitude_s, longitude AS longitude_s FROM stations) s GROUP BY 1, 2)"""


def number(c: str) -> str:
    return rf"""CASE WHEN regexp_matches({stripped(f"replace({c}, ',', '')")}, '^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$')
  THEN CAST({stripped(f"replace({c}, ',', '')")} AS DOUBLE) END"""


NUMBERS = f"""numbers AS (SELECT sale_id, BOROUGH, coalesce({stripped("BUILDING_CLASS_CATEGORY")}, 'nan') AS class,
  {number("SALE_PRICE")} AS price, {number("GROSS_SQUARE_FEET")} AS gross, {number("LAND_SQUARE_FEET")} AS land,
  CAST(YEAR_BUILT AS DOUBLE) AS year, ZIP_CODE FROM sales)"""

DROPPED = """dropped AS (SELECT *, CASE WHEN price <= 0 THEN 'sale_price_non_positive'
  WHEN price < 10000 OR price > 100000000 THEN 'sale_price_out_of_range' WHEN gross = 0 THEN 'missing_gross_sqft'
  WHEN year = 0 THEN 'missing_year_built' WHEN NOT starts_with(class, 'R') THEN 'non_residential_class' END AS drop_reason
  FROM numbers)"""

MAPPED = """mapped AS (SELECT sale_id,
  CASE BOROUGH WHEN 1 THEN 'Manhattan' WHEN 2 THEN 'Bronx' WHEN 3 THEN 'Brooklyn' WHEN 4 THEN 'Queens'
    WHEN 5 THEN 'Staten Island' END AS borough_name,
  CAST(land AS BIGINT) AS land_sqft, CAST(gross AS BIGINT) AS property_sqft, substring(class, 1, 2) AS property_type,
  CAST(year AS BIGINT) AS year_built, CAST(ZIP_CODE AS BIGINT) AS zip_code, ln(1 + price) AS TARGET
  FROM dropped WHERE drop_reason IS NULL)"""

FIREWALL = ",\n".join([SALES, NUMBERS, DROPPED, MAPPED])


def label_scores(truth: str = "y_true", pred: str = "y_pred", by: str = "", source: str = "scored") -> str:
    group = f"{by}, " if by else ""
    return f"""pairs AS (SELECT {group}{truth} AS t, {pred} AS p, count(*) AS n FROM {source} GROUP BY ALL),
sides AS (SELECT {group}t AS label, n AS support, 0 AS predicted, CASE WHEN t = p THEN n ELSE 0 END AS hits FROM pairs
  UNION ALL SELECT {group}p, 0, n, 0 FROM pairs),
totals AS (SELECT {group}label, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM sides GROUP BY ALL),
rates AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
  CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall FROM totals),
labels_scored AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM rates)"""


def digest_order(key: str) -> str:
    return f"md5(concat('42:', CAST({key} AS VARCHAR))), {key}"


def split_sql(cte: str, source: str, key: str, stratum: str) -> str:
    head = f"WITH {cte} " if cte else ""
    return f"""{head}SELECT {key}, {stratum}, CASE WHEN r <= round(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT {key}, {stratum}, row_number() OVER (PARTITION BY {stratum} ORDER BY {digest_order(key)}) AS r,
    count(*) OVER (PARTITION BY {stratum}) AS n FROM {source}) t"""


def argmax_sql(scores: list[str]) -> str:
    best = f"greatest({', '.join(scores)})"
    return "CASE " + " ".join(f"WHEN {s} = {best} THEN {i}" for i, s in enumerate(scores)) + " END"


def tuning_sql() -> str:
    """Four greedy passes; each keeps the best candidate so far as a one-row table."""

    def f1_of(cls: int, prev: str, name: str, candidates: str) -> str:
        scores = [f"p{i} / greatest({'c.t' if i == cls else f'b.t{i}'}, 1e-6)" for i in range(4)]
        return f"""{name}_p AS (SELECT c.t AS cand, y_true AS t, {argmax_sql(scores)} AS p, count(*) AS n
  FROM scored, {prev} b, {candidates} c GROUP BY ALL),
{name}_s AS (SELECT cand, t AS label, n AS s, 0 AS q, CASE WHEN t = p THEN n ELSE 0 END AS h FROM {name}_p
  UNION ALL SELECT cand, p, 0, n, 0 FROM {name}_p),
{name}_t AS (SELECT cand, label, sum(s) AS s, sum(q) AS q, sum(h) AS h FROM {name}_s GROUP BY ALL),
{name}_f AS (SELECT cand, round(avg(CASE WHEN h = 0 THEN 0 ELSE 2 * (h / q) * (h / s) / (h / q + h / s) END), 12) AS f FROM {name}_t GROUP BY cand)"""

    parts = [SCORED, "half AS (SELECT CAST(0.5 AS DOUBLE) AS t)",
             "grid AS (SELECT 0.1::DOUBLE + k * 0.8::DOUBLE / 49 AS t FROM range(50) g(k))",
             "b_0 AS (SELECT 0.5::DOUBLE AS t0, 0.5::DOUBLE AS t1, 0.5::DOUBLE AS t2, 0.5::DOUBLE AS t3)",
             f1_of(0, "b_0", "start", "half"),
             "b0 AS (SELECT b_0.*, f AS best FROM b_0, start_f)"]
    for cls in range(4):
        parts.append(f1_of(cls, f"b{cls}", f"c{cls}", "grid"))
        cols = ", ".join(
            f"CASE WHEN w.f > best THEN w.cand ELSE t{i} END AS t{i}" if i == cls else f"t{i}" for i in range(4))
        parts.append(f"""b{cls + 1} AS (SELECT {cols}, CASE WHEN w.f > best THEN w.f ELSE best END AS best
  FROM b{cls}, (SELECT cand, f FROM c{cls}_f ORDER BY f DESC, cand LIMIT 1) w)""")
    names = ["Low", "Medium", "High", "Very High"]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{z}' AS label, round(t{i}, 3) AS threshold, round(best, 6) AS macro_f1 FROM b{i + 1}"
        for i, z in enumerate(names))
    return f"WITH {', '.join(parts)} {rows}"


def leakage_sql() -> str:
    names = ["land_sqft", "property_sqft", "year_built", "zip_code", "smuggled"]
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, TARGET AS y FROM watched WHERE {c} IS NOT NULL AND TARGET IS NOT NULL"
        for c in names)
    return f"""WITH {FIREWALL}, watched AS (SELECT *, exp(TARGET) - 1 AS smuggled FROM mapped),
long AS ({long}),
ranks AS (SELECT *, count(*) OVER (PARTITION BY feature) AS n, rank() OVER (PARTITION BY feature ORDER BY x) AS rx,
  rank() OVER (PARTITION BY feature ORDER BY y) AS ry, count(*) OVER (PARTITION BY feature, x) AS cx,
  count(*) OVER (PARTITION BY feature, y) AS cy FROM long),
binned AS (SELECT *, greatest(2, least(10, floor(sqrt(n / 5)))) AS b FROM ranks),
cells AS (SELECT feature, n, floor(b * (rx - 1) / n) AS bx, floor(b * (ry - 1) / n) AS by_, count(*) AS c FROM binned GROUP BY ALL),
margins AS (SELECT *, sum(c) OVER (PARTITION BY feature, bx) AS nx, sum(c) OVER (PARTITION BY feature, by_) AS ny FROM cells),
info AS (SELECT feature, -sum(c / n * ln(nx / n)) AS hx, -sum(c / n * ln(ny / n)) AS hy,
  sum(c / n * ln(c * n / (nx * ny))) AS i FROM margins GROUP BY feature),
linear AS (SELECT feature, count(*) AS n, corr(x, y) AS pearson, corr(rx + (cx - 1) / 2, ry + (cy - 1) / 2) AS spearman
  FROM ranks GROUP BY feature),
scores AS (SELECT feature, n, pearson, spearman, CASE WHEN hx <= 0 OR hy <= 0 THEN 0 ELSE i / sqrt(hx * hy) END AS nmi
  FROM linear JOIN info USING (feature))
SELECT feature, n, round(pearson, 6) AS pearson, round(spearman, 6) AS spearman, round(nmi, 6) AS nmi,
  (abs(pearson) > 0.95 OR abs(spearman) > 0.95 OR nmi > 0.8) AS flagged FROM scores"""


ENTROPY_FLOOR = "CASE WHEN {0} < 1e-15 THEN 1e-15 ELSE {0} END"
TRUE_P = "CASE y_true WHEN 0 THEN p0 WHEN 1 THEN p1 WHEN 2 THEN p2 ELSE p3 END"


def stats_sql(source: str, c: str, digits: int = 6) -> str:
    return f"""SELECT '{c}' AS feature, round(avg({c}), {digits}) AS mean, round(stddev_samp({c}), {digits}) AS std,
  round(CAST(min({c}) AS DOUBLE), {digits}) AS min, round(CAST(max({c}) AS DOUBLE), {digits}) AS max,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), {digits}) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), {digits}) AS p50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), {digits}) AS p75, count({c}) AS count FROM {source}"""


EVENTS = """old AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'),
new AS (SELECT * FROM events WHERE NOT ts < TIMESTAMP '2024-01-16')"""


def drift_part(c: str) -> str:
    return f"""SELECT '{c}' AS feature, avg(n.{c}) AS m, ANY_VALUE(b.m) AS bm, ANY_VALUE(b.s) AS bs
  FROM new n, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM old) b"""


def profile_part(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls,
  count(DISTINCT {c}) AS distinct_values, min({c}) AS smallest, max({c}) AS largest FROM listings"""


def encoding_cte(c: str) -> str:
    return f"""enc_{c} AS (SELECT {c} AS k, w * m + (1 - w) * prior AS e FROM (SELECT {c}, avg(LOG_PRICE) AS m,
  1 / (1 + exp((20 - count(*)) / 10.0::DOUBLE)) AS w FROM logged WHERE {c} IS NOT NULL GROUP BY {c}) g, prior)"""


def issue(kind: str, column: str, test: str) -> str:
    return f"SELECT '{kind}' AS \"check\", '{column}' AS \"column\", count(*) AS n FROM listings WHERE {test} HAVING count(*) > 0"


ISSUES = [
    *[issue("null", c, f"{c} IS NULL") for c in ("PRICE", "BEDS", "BATH", "PROPERTYSQFT")],
    *[issue("non_positive", c, f"{c} <= 0") for c in ("PRICE", "PROPERTYSQFT")],
    issue("out_of_range", "LATITUDE", "NOT coalesce(LATITUDE BETWEEN 40.4 AND 40.95, false)"),
    issue("out_of_range", "LONGITUDE", "NOT coalesce(LONGITUDE BETWEEN -74.3 AND -73.6, false)"),
    "SELECT 'missing_column', 'BOROUGH', 1",
]

INVALID = {
    "beds": "beds BETWEEN 0 AND 20",
    "bath": "bath BETWEEN 0 AND 15",
    "propertysqft": "propertysqft > 0 AND propertysqft <= 50000",
    "borough": "borough IS NOT NULL",
    "type": "type IS NOT NULL",
    "zipcode": "regexp_matches(zipcode, '^[0-9]{5}$')",
    "latitude": "latitude BETWEEN 40.4 AND 40.95",
    "longitude": "longitude BETWEEN -74.3 AND -73.6",
}
REJECTED = "concat_ws(',', " + ", ".join(
    f"CASE WHEN NOT coalesce({ok}, false) THEN '{name}' END" for name, ok in INVALID.items()) + ")"
REQUEST_MANHATTAN = MANHATTAN.replace("LATITUDE", "latitude").replace("LONGITUDE", "longitude")
REQUEST_PARK = PARK.replace("LATITUDE", "latitude").replace("LONGITUDE", "longitude")

ATTRIBUTIONS = """attributions AS (SELECT vec_id AS row_id, printf('f%03d', i - 1) AS feature,
  CAST(embedding[i] AS DOUBLE) AS value
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) t)"""


def r6(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


def z_score(c: str) -> str:
    return r6(f"({c} - (SELECT avg({c}) FROM listings)) / (SELECT stddev_pop({c}) FROM listings)", f"z_{c}")


ORACLES: dict[str, str] = {
    "clean_listings": f"""WITH {CLEAN} SELECT listing_id, {', '.join(r6(c, c, 4) for c in
        ('PRICE', 'BEDS', 'BATH', 'PROPERTYSQFT', 'LATITUDE', 'LONGITUDE'))},
        BOROUGH, TYPE, SUBLOCALITY, ZIPCODE, PROPERTY_CATEGORY FROM cleaned""",
    "dedup_near": f"WITH {LISTINGS}, {DEDUP} SELECT {COLUMNS} FROM dedup",
    "distinct_listings": f"WITH {LISTINGS} SELECT DISTINCT {COLUMNS} FROM listings",
    "impute_group_median": f"""WITH {LISTINGS}, {imputed('listings')}
        SELECT listing_id, BOROUGH, BEDS, BATH, PROPERTYSQFT FROM imputed""",
    "cap_outliers_iqr": f"""WITH {LISTINGS}, {capped('listings', '0.5')}
        SELECT listing_id, {', '.join(r6(c, c, 4) for c in ('PRICE', 'PROPERTYSQFT', 'BEDS', 'BATH'))} FROM capped""",
    "normalize_text": f"""WITH {LISTINGS} SELECT listing_id, {text('BOROUGH')} AS BOROUGH, {text('TYPE')} AS TYPE,
        {text('SUBLOCALITY')} AS SUBLOCALITY FROM listings""",
    "normalize_borough": f"WITH {LISTINGS} SELECT listing_id, {borough('BOROUGH')} AS BOROUGH FROM listings",
    "normalize_zip": f"WITH {LISTINGS} SELECT listing_id, {zipcode('ZIPCODE')} AS ZIPCODE FROM listings",
    "normalize_type": f"WITH {LISTINGS} SELECT listing_id, {property_type(text('TYPE'))} AS TYPE FROM listings",
    "filter_listings": f"""WITH {LISTINGS} SELECT listing_id, PRICE, LATITUDE FROM listings WHERE PRICE > 0 AND PROPERTYSQFT > 0
        AND LATITUDE BETWEEN 40.4 AND 40.95 AND LONGITUDE BETWEEN -74.3 AND -73.6""",
    "validate_issues": f"WITH {LISTINGS} " + " UNION ALL ".join(ISSUES),
    "default_columns": f"""WITH {LISTINGS} SELECT listing_id, SUBLOCALITY AS BOROUGH,
        'residential' AS PROPERTY_CATEGORY, SUBLOCALITY FROM listings""",
    "numeric_features": f"""WITH {LISTINGS} SELECT listing_id, {r6('BEDS + BATH', 'TOTAL_ROOMS')},
        {r6(RATIO, 'BED_BATH_RATIO')}, {r6('ln(1 + PROPERTYSQFT)', 'LOG_SQFT')}, {r6(DENSITY, 'ROOMS_PER_SQFT')}
        FROM listings""",
    "target_zones": f"""WITH {LISTINGS} SELECT listing_id, {zone('PRICE')} AS PRICE_ZONE,
        {zone_code(zone('PRICE'))} AS ZONE_CODE, {r6('ln(1 + PRICE)', 'LOG_PRICE')},
        {size_category('PROPERTYSQFT')} AS SQFT_CATEGORY FROM listings""",
    "distance_features": f"""WITH {LISTINGS} SELECT listing_id, {r6(MANHATTAN, 'DIST_MANHATTAN_CENTER')},
        {r6(PARK, 'DIST_CENTRAL_PARK')}, {r6(MANHATTAN, 'DIST_NEAREST_SUBWAY')} FROM listings""",
    "nearest_station": f"""WITH {LISTINGS}, {STATIONS}, {NEAREST} SELECT listing_id, {r6('d', 'DIST_NEAREST_SUBWAY')}
        FROM listings JOIN nearest ON LATITUDE = la AND LONGITUDE = lo""",
    "hex_bins": f"""WITH {LISTINGS}, {HEX} SELECT cell AS hex_cell, count(*) AS n,
        round(avg(PRICE), 6) AS avg_price FROM hexed GROUP BY cell""",
    "cap_cardinality": f"""WITH {LISTINGS} SELECT listing_id, {kept('listings', 'SUBLOCALITY')} AS SUBLOCALITY,
        {kept('listings', 'TYPE')} AS TYPE, {kept('listings', 'ZIPCODE')} AS ZIPCODE FROM listings""",
    "top_categories": f"""WITH {LISTINGS} """ + " UNION ALL ".join(
        f"(SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM listings GROUP BY {c} ORDER BY n DESC, value LIMIT 10)"
        for c in ("SUBLOCALITY", "ZIPCODE")),
    "canonical_categories": f"""WITH {LISTINGS} SELECT listing_id, """ + ", ".join(
        f"coalesce({text(c)}, 'nan') AS {c}" for c in ("BOROUGH", "TYPE", "PROPERTY_CATEGORY", "ZIPCODE", "SUBLOCALITY"))
        + " FROM listings",
    "listing_features": f"""WITH {LISTINGS}, {STATIONS}, {NEAREST}, {HEX} SELECT listing_id,
        {r6('BEDS + BATH', 'TOTAL_ROOMS')}, {r6(DENSITY, 'ROOMS_PER_SQFT')}, {r6(PARK, 'DIST_CENTRAL_PARK')},
        {r6('d', 'DIST_NEAREST_SUBWAY')}, cell AS HEX_CELL, {zone('PRICE')} AS PRICE_ZONE,
        {r6('ln(1 + PRICE)', 'LOG_PRICE')}, {size_category('PROPERTYSQFT')} AS SQFT_CATEGORY,
        {kept('listings', 'SUBLOCALITY')} AS SUBLOCALITY, {kept('listings', 'ZIPCODE')} AS ZIPCODE
        FROM hexed JOIN nearest ON LATITUDE = la AND LONGITUDE = lo""",
    "labelled_listings": f"""WITH {LISTINGS} SELECT listing_id, {zone('PRICE')} AS PRICE_ZONE FROM listings
        WHERE BEDS IS NOT NULL AND PRICE IS NOT NULL AND {zone('PRICE')} IS NOT NULL""",
    "training_data": f"""WITH {CLEAN} SELECT listing_id AS LISTING_ID, {zone('PRICE')} AS PRICE_ZONE,
        {zone_code(zone('PRICE'))} AS ZONE_CODE, {r6('ln(1 + PRICE)', 'LOG_PRICE')}, {r6('BEDS', 'BEDS')},
        {r6('BATH', 'BATH')}, {r6('PROPERTYSQFT', 'PROPERTYSQFT')}, {r6('BEDS + BATH', 'TOTAL_ROOMS')},
        {r6(RATIO, 'BED_BATH_RATIO')}, {r6('ln(1 + PROPERTYSQFT)', 'LOG_SQFT')}, {r6(DENSITY, 'ROOMS_PER_SQFT')},
        {r6(MANHATTAN, 'DIST_MANHATTAN_CENTER')}, {r6(PARK, 'DIST_CENTRAL_PARK')}, {r6(MANHATTAN, 'DIST_NEAREST_SUBWAY')},
        coalesce(BOROUGH, 'nan') AS BOROUGH, {kept('cleaned', 'TYPE')} AS TYPE, PROPERTY_CATEGORY,
        {kept('cleaned', 'ZIPCODE')} AS ZIPCODE, {kept('cleaned', 'SUBLOCALITY')} AS SUBLOCALITY FROM cleaned
        WHERE {zone('PRICE')} IS NOT NULL""",
    "zone_share": f"""WITH {CLEAN}, zoned AS (SELECT BOROUGH, {zone('PRICE')} AS PRICE_ZONE, count(*) AS n FROM cleaned GROUP BY ALL)
        SELECT BOROUGH, PRICE_ZONE, n, round(n * 100 / sum(n) OVER (PARTITION BY BOROUGH), 6) AS pct
        FROM zoned WHERE PRICE_ZONE IS NOT NULL""",
    "price_histogram": f"""WITH {LISTINGS}, span AS (SELECT min(PRICE) AS lo, max(PRICE) AS hi FROM listings)
        SELECT CAST(least(floor((PRICE - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS n
        FROM listings, span WHERE PRICE IS NOT NULL GROUP BY 1""",
    "profile": f"WITH {LISTINGS} " + " UNION ALL ".join(
        profile_part(c) for c in ("BOROUGH", "TYPE", "SUBLOCALITY", "ZIPCODE")),
    "cleaning_summary": f"""WITH {CLEAN} SELECT a AS n_raw, b AS n_clean, a - b AS n_dropped FROM
        (SELECT count(*) AS a FROM listings) x, (SELECT count(*) AS b FROM cleaned) y""",
    "coerce_numeric": f"""WITH {SALES}, {NUMBERS} SELECT sale_id, price AS SALE_PRICE, gross AS GROSS_SQUARE_FEET,
        land AS LAND_SQUARE_FEET, year AS YEAR_BUILT FROM numbers""",
    "drop_engine": f"WITH {SALES}, {NUMBERS}, {DROPPED} SELECT sale_id, drop_reason FROM dropped",
    "drop_reasons": f"""WITH {SALES}, {NUMBERS}, {DROPPED} SELECT drop_reason, count(*) AS n FROM dropped
        WHERE drop_reason IS NOT NULL GROUP BY drop_reason""",
    "drop_log": f"""WITH {SALES}, {NUMBERS}, {DROPPED} SELECT count(*) AS n_raw,
        count(*) FILTER (drop_reason IS NULL) AS n_scored, count(drop_reason) AS n_dropped,
        count(drop_reason) AS n_reasons, true AS consistent FROM dropped""",
    "map_features": f"WITH {FIREWALL} SELECT * REPLACE (round(TARGET, 6) AS TARGET) FROM mapped",
    "leakage_scores": leakage_sql(),
    "prediction_health": f"""WITH {SCORED}, counts AS (SELECT price_pred AS v, count(*) AS c FROM scored GROUP BY 1),
        top AS (SELECT v, c FROM counts ORDER BY c DESC, v LIMIT 1)
        SELECT CAST(sum(counts.c) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_nan, CAST(0 AS BIGINT) AS n_inf, round(any_value(top.v), 6) AS dominant_value,
        round(any_value(top.c) / sum(counts.c), 6) AS dominant_share,
        CASE WHEN sum(counts.c) < 500 THEN 'insufficient predictions'
          WHEN any_value(top.c) / sum(counts.c) > 0.95 THEN 'prediction collapse' END AS failure,
        CASE WHEN sum(counts.c) < 500 OR any_value(top.c) / sum(counts.c) > 0.95 THEN 'failed' ELSE 'passed' END AS status
        FROM counts, top""",
    "log_space_r2": f"""WITH {SCORED}, r AS (SELECT 1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)) AS r2, count(*) AS n FROM
        (SELECT ln(1 + price) AS y, ln(1 + price_pred) AS p FROM scored) t)
        SELECT round(r2, 6) AS r2_log_space, n AS n_scored, r2 > 0.95 AS triggered FROM r""",
    "kept_in_both": f"WITH {FIREWALL} SELECT sale_id, borough_name, property_sqft FROM mapped WHERE year_built >= 1950",
    "contract_locks": """SELECT doc_id AS version, sha256(text) AS sha256,
        CASE WHEN lang <> 'de' THEN sha256(trim(text)) END AS registered,
        coalesce(lang <> 'de' AND text = trim(text), false) AS locked FROM documents""",
    "read_exports": f"""WITH {SALES} SELECT CAST(BOROUGH AS VARCHAR) AS BOROUGH, CAST(YEAR_BUILT AS VARCHAR) AS year_built,
        trim(SALE_PRICE) AS sale_price, CASE WHEN sale_id % 3 > 0 THEN CAST(ZIP_CODE AS VARCHAR) END AS zip_code FROM sales""",
    "read_workbooks": f"""WITH {SALES} SELECT CAST(BOROUGH AS VARCHAR) AS BOROUGH, CAST(YEAR_BUILT AS VARCHAR) AS year_built,
        trim(SALE_PRICE) AS sale_price, CASE WHEN sale_id % 3 > 0 THEN CAST(ZIP_CODE AS VARCHAR) END AS zip_code FROM sales""",
    "header_rows": f"""WITH {SALES} SELECT DISTINCT CAST(sale_id % 3 AS INTEGER) AS kind,
        CASE sale_id % 3 WHEN 0 THEN 4 WHEN 1 THEN 3 ELSE 5 END AS header_row FROM sales""",
    "read_exports_with_line_breaks": f"""WITH {SALES} SELECT CAST(BOROUGH AS VARCHAR) AS BOROUGH, trim(SALE_PRICE) AS sale_price,
        'sale' || chr(10) || sale_id AS note FROM sales""",
    "load_raw": f"""WITH {LISTINGS} SELECT CAST(listing_id AS VARCHAR) AS LISTING_ID, round(PRICE, 4) AS PRICE, BEDS, ZIPCODE,
        TYPE || chr(10) || 'a "b"' AS TYPE FROM listings""",
    "firewall_report": f"""WITH {SALES}, {NUMBERS}, {DROPPED} SELECT count(*) AS n_raw, count(drop_reason) AS n_dropped,
        count(*) FILTER (drop_reason IS NULL) AS n_scored, sha256('contract') AS contract_sha256, 'skipped' AS inference,
        false AS leaks_by_name, CAST(0 AS BIGINT) AS n_judged, count(drop_reason) AS n_reasons FROM dropped""",
    "mapping_invariants": """SELECT unnest(['deterministic', 'subset', 'column_order', 'target_shuffle']) AS invariant,
        (SELECT count(*) > 0 FROM orders) AS holds""",
    "union_files": f"""WITH {SALES} SELECT sale_id, BOROUGH, CASE WHEN BOROUGH <> 5 THEN YEAR_BUILT END AS YEAR_BUILT,
        ZIP_CODE, SALE_PRICE FROM sales""",
    "confusion": f"WITH {SCORED} SELECT y_true, y_pred, count(*) AS n FROM scored GROUP BY ALL",
    "confusion_matrix": f"WITH {SCORED} SELECT y_true, " + ", ".join(
        f"count(*) FILTER (y_pred = {i}) AS n{i}" for i in range(4)) + " FROM scored GROUP BY y_true",
    "classifier_metrics": f"""WITH {SCORED}, {label_scores()}, s AS (SELECT CAST(sum(support) AS BIGINT) AS n,
        sum(hits) / sum(support) AS acc, avg(f1) AS macro, sum(f1 * support) / sum(support) AS weighted,
        sum(CAST(support AS DOUBLE) * predicted) / pow(sum(support), 2) AS pe FROM labels_scored)
        SELECT n, round(acc, 6) AS accuracy, round(macro, 6) AS macro_f1, round(weighted, 6) AS weighted_f1,
        round((acc - pe) / (1 - pe), 6) AS cohen_kappa FROM s""",
    "class_report": f"""WITH {SCORED}, {label_scores()}
        SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM labels_scored
        UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
          round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM labels_scored
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
          CAST(sum(support) AS BIGINT) FROM labels_scored
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
          round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
          CAST(sum(support) AS BIGINT) FROM labels_scored""",
    "regressor_metrics": f"""WITH {SCORED}, l AS (SELECT ln(1 + price) AS y, ln(1 + price_pred) AS p FROM scored),
        e AS (SELECT *, exp(y) - 1 AS y0, exp(p) - 1 AS p0 FROM l)
        SELECT round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 4) AS r2, round(sqrt(avg(pow(y - p, 2))), 4) AS rmse,
        round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg(pow(y0 - p0, 2))), 4) AS rmse_usd,
        round(avg(abs(y0 - p0)), 4) AS mae_usd, round(avg(abs(y0 - p0) / greatest(abs(y0), 2.220446049250313e-16)), 4) AS mape
        FROM e""",
    "fairness": f"""WITH {SCORED}, {label_scores(by='grp')} SELECT CAST(grp AS VARCHAR) AS "group",
        CAST(sum(support) AS BIGINT) AS n, round(avg(f1), 6) AS score FROM labels_scored GROUP BY grp
        HAVING sum(support) >= 5""",
    "class_weights": """SELECT quality AS label, count(*) AS n, round((SELECT count(*) FROM labels)
        / ((SELECT count(DISTINCT quality) FROM labels) * count(*)), 6) AS weight FROM labels GROUP BY quality""",
    "focal_loss": f"""WITH {SCORED}, l AS (SELECT {ENTROPY_FLOOR.format('(' + TRUE_P + ')')} AS p,
        CASE y_true WHEN 0 THEN 1.0 WHEN 1 THEN 2.0 WHEN 2 THEN 0.5 ELSE 1.5 END AS a,
        ln(1 + price) - ln(1 + price_pred) AS e FROM scored),
        s AS (SELECT avg(a * pow(1 - p, 2) * -ln(p)) AS f, avg(e * e) AS m FROM l)
        SELECT round(f, 6) AS focal_loss, round(m, 6) AS mse, round(0.6 * f + 0.4 * m, 6) AS total_loss FROM s""",
    "apply_thresholds": f"""WITH {SCORED} SELECT row_id, {argmax_sql(['p0', 'p1', 'p2', 'p3'])} AS plain,
        {argmax_sql(['(p0 / 0.2::DOUBLE)', '(p1 / 0.7::DOUBLE)', '(p2 / 0.5::DOUBLE)', '(p3 / 0.4::DOUBLE)'])} AS tuned FROM scored""",
    "tune_thresholds": tuning_sql(),
    "best_model": f"""WITH {SCORED}, both_models AS (SELECT 'given' AS model, y_true, y_pred FROM scored
        UNION ALL SELECT 'argmax', y_true, {argmax_sql(['p0', 'p1', 'p2', 'p3'])} FROM scored),
        {label_scores(by='model', source='both_models')}, f AS (SELECT model, avg(f1) AS m FROM labels_scored GROUP BY model)
        SELECT model, round(m, 6) AS macro_f1 FROM f ORDER BY m DESC, model DESC LIMIT 1""",
    "stratified_split": split_sql(SCORED, "scored", "row_id", "y_true"),
    "split_labels": split_sql("", "labels", "doc_id", "quality"),
    "kfold": f"""WITH {SCORED} SELECT row_id, y_true, CAST((row_number() OVER (PARTITION BY y_true
        ORDER BY {digest_order('row_id')}) - 1) % 5 AS INTEGER) AS fold FROM scored""",
    "plain_kfold": f"""WITH {SCORED} SELECT row_id, CAST((row_number() OVER (ORDER BY {digest_order('row_id')}) - 1) % 5
        AS INTEGER) AS fold FROM scored""",
    "sample_rows": f"WITH {SCORED} SELECT row_id, y_true FROM scored ORDER BY {digest_order('row_id')} LIMIT 500",
    "standardize": f"""WITH {LISTINGS} SELECT listing_id, {', '.join(z_score(c) for c in
        ('PRICE', 'BEDS', 'BATH', 'PROPERTYSQFT'))} FROM listings""",
    "target_encode": f"""WITH {LISTINGS}, logged AS (SELECT *, ln(1 + PRICE) AS LOG_PRICE FROM listings),
        prior AS (SELECT avg(LOG_PRICE) AS prior FROM logged), {encoding_cte('ZIPCODE')}, {encoding_cte('BOROUGH')}
        SELECT listing_id, round(coalesce(z.e, prior), 6) AS ZIPCODE_TE, round(coalesce(b.e, prior), 6) AS BOROUGH_TE
        FROM logged LEFT JOIN enc_ZIPCODE z ON ZIPCODE = z.k LEFT JOIN enc_BOROUGH b ON BOROUGH = b.k, prior""",
    "ordered_target_encode": f"""WITH {LISTINGS}, logged AS (SELECT *, ln(1 + PRICE) AS LOG_PRICE FROM (SELECT DISTINCT * FROM listings)),
        prior AS (SELECT avg(LOG_PRICE) AS prior FROM logged), hashed AS (SELECT *, md5(concat('42:', listing_id)) AS d FROM logged)
        SELECT listing_id, """ + ", ".join(f"""round(CASE WHEN {c} IS NULL THEN prior ELSE (coalesce(sum(LOG_PRICE) OVER {w}, 0) + prior)
            / (count(LOG_PRICE) OVER {w} + 1) END, 6) AS {c}_OTS""" for c, w in ((c, f"""(PARTITION BY {c} ORDER BY d, listing_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""") for c in ("ZIPCODE", "BOROUGH"))) + " FROM hashed, prior",
    "nearest_parts": """WITH p AS (SELECT * FROM part WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL AND NOT isnan(p_retailprice)),
        pairs AS (SELECT a.p_partkey AS "key", b.p_partkey AS other, sqrt((a.p_size - b.p_size) * (a.p_size - b.p_size)::DOUBLE
            + (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice)) AS distance
            FROM p a JOIN p b ON a.p_brand IS NOT DISTINCT FROM b.p_brand AND a.p_partkey <> b.p_partkey)
        SELECT "key", other, round(distance, 6) AS distance FROM pairs
        QUALIFY row_number() OVER (PARTITION BY "key" ORDER BY pairs.distance, other) <= 5""",
    "label_codes": f"""WITH {LISTINGS}, z AS (SELECT DISTINCT {zone('PRICE')} AS label FROM listings)
        SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code, label FROM z WHERE label IS NOT NULL""",
    "importance": f"""WITH {ATTRIBUTIONS} SELECT feature, round(avg(abs(value)), 6) AS mean_abs FROM attributions
        GROUP BY feature""",
    "top_importance": f"""WITH {ATTRIBUTIONS} SELECT feature, round(avg(abs(value)), 6) AS mean_abs FROM attributions
        GROUP BY feature ORDER BY avg(abs(value)) DESC, feature LIMIT 10""",
    "top_factors": f"""WITH {ATTRIBUTIONS} SELECT row_id, CAST(rank AS INTEGER) AS rank, feature,
        round_even(value, 4) AS value, CASE WHEN value > 0 THEN '+' ELSE '-' END AS direction FROM (
        SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(value) DESC, feature) AS rank FROM attributions) t
        WHERE rank <= 5""",
    "linear_attributions": f"""WITH {LISTINGS}, d AS (SELECT * FROM listings WHERE BEDS IS NOT NULL AND BATH IS NOT NULL
        AND PROPERTYSQFT IS NOT NULL) """ + " UNION ALL ".join(
        f"SELECT listing_id AS row_id, '{c}' AS feature, round({k} * ({c} - (SELECT avg({c}) FROM d)), 6) AS value FROM d"
        for c, k in (("BEDS", 0.125), ("BATH", 0.25), ("PROPERTYSQFT", 0.001))),
    "kernel_attributions": f"""WITH {LISTINGS}, d AS (SELECT listing_id, min(BEDS) AS BEDS, min(BATH) AS BATH,
        min(PROPERTYSQFT) AS PROPERTYSQFT FROM listings
        WHERE BEDS IS NOT NULL AND BATH IS NOT NULL AND PROPERTYSQFT IS NOT NULL GROUP BY listing_id),
        x AS (SELECT * FROM d ORDER BY md5('42:' || listing_id), listing_id LIMIT 500),
        g AS (SELECT * FROM d ORDER BY md5('43:' || listing_id), listing_id LIMIT 100),
        m AS (SELECT avg(BEDS) AS beds, avg(BATH) AS bath, avg(PROPERTYSQFT) AS sqft, avg(BATH * PROPERTYSQFT) AS both FROM g)
        SELECT listing_id AS row_id, 'BEDS' AS feature, round(0.125 * (x.BEDS - m.beds), 6) AS value FROM x, m
        UNION ALL SELECT listing_id, 'BATH',
        round((x.BATH * m.sqft - m.both + (x.BATH - m.bath) * x.PROPERTYSQFT) / 1994, 6) FROM x, m
        UNION ALL SELECT listing_id, 'PROPERTYSQFT',
        round((x.PROPERTYSQFT * m.bath - m.both + (x.PROPERTYSQFT - m.sqft) * x.BATH) / 1994, 6) FROM x, m""",
    "zone_record": f"""WITH {SCORED} SELECT row_id, CASE {argmax_sql(['p0', 'p1', 'p2', 'p3'])}
        WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'Very High' END AS price_zone,
        round_even(greatest(p0, p1, p2, p3), 3) AS confidence, round_even(p0, 3) AS p_low, round_even(p1, 3) AS p_medium,
        round_even(p2, 3) AS p_high, round_even(p3, 3) AS p_very_high FROM scored""",
    "price_record": f"""WITH {SCORED}, v AS (SELECT row_id, price_pred + 0.123::DOUBLE AS v FROM scored)
        SELECT row_id, round_even(v / 100, 0) * 100 AS predicted_price, round_even(v * 0.85::DOUBLE / 100, 0) * 100 AS low,
        round_even(v * 1.15::DOUBLE / 100, 0) * 100 AS high FROM v""",
    "validate_requests": f"WITH {REQUESTS} SELECT request_id, sublocality, {REJECTED} AS rejected FROM requests",
    "request_features": f"""WITH {REQUESTS} SELECT request_id, CAST(beds AS DOUBLE) AS BEDS, bath AS BATH,
        round(propertysqft, 6) AS PROPERTYSQFT, lower(borough) AS BOROUGH, lower(type) AS TYPE,
        'residential' AS PROPERTY_CATEGORY, zipcode AS ZIPCODE, lower(sublocality) AS SUBLOCALITY,
        round(beds + bath, 6) AS TOTAL_ROOMS, round(beds / (CASE WHEN bath < 1 THEN 1 ELSE bath END), 6) AS BED_BATH_RATIO,
        round(ln(1 + propertysqft), 6) AS LOG_SQFT,
        round((beds + bath) / (CASE WHEN propertysqft < 1 THEN 1 ELSE propertysqft END), 6) AS ROOMS_PER_SQFT,
        {r6(REQUEST_MANHATTAN, 'DIST_MANHATTAN_CENTER')}, {r6(REQUEST_PARK, 'DIST_CENTRAL_PARK')},
        {r6(REQUEST_MANHATTAN, 'DIST_NEAREST_SUBWAY')} FROM requests WHERE {REJECTED} = ''""",
    "feature_stats": " UNION ALL ".join(stats_sql("events", c) for c in ("value", "user_id")),
    "saved_baseline": f"WITH {LISTINGS} " + " UNION ALL ".join(
        stats_sql("listings", c, 4) for c in ("PRICE", "BEDS", "PROPERTYSQFT")),
    "drift": f"WITH {EVENTS}, d AS (" + " UNION ALL ".join(drift_part(c) for c in ("value", "user_id", "event_id")) + """)
        SELECT feature, round(m, 4) AS current_mean, round(bm, 4) AS baseline_mean,
        round(round_even(abs(m - bm) / bs, 4), 4) AS shift_ratio FROM d WHERE abs(m - bm) / bs > 0.001""",
    "drift_windowed": f"""WITH {EVENTS}, l AS (SELECT ts, 'value' AS feature, value AS v FROM new UNION ALL
        SELECT ts, 'user_id', user_id FROM new), w AS (SELECT date_trunc('day', ts) AS window_start, feature,
        avg(v) AS m, count(*) AS n FROM l GROUP BY ALL), b AS (SELECT 'value' AS feature, avg(value) AS bm,
        stddev_samp(value) AS bs FROM old UNION ALL SELECT 'user_id', avg(user_id), stddev_samp(user_id) FROM old)
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, feature, n, round(m, 6) AS current_mean,
        round(abs(m - bm) / bs, 6) AS shift, abs(m - bm) / bs > 0.15 AS drifted FROM w JOIN b USING (feature)""",
    "drift_stream": f"""WITH {EVENTS}, l AS (SELECT ts, 'value' AS feature, value AS v FROM events UNION ALL
        SELECT ts, 'user_id', user_id FROM events), w AS (SELECT date_trunc('day', ts) AS window_start, feature,
        avg(v) AS m, count(*) AS n FROM l GROUP BY ALL), b AS (SELECT 'value' AS feature, avg(value) AS bm,
        stddev_samp(value) AS bs FROM old UNION ALL SELECT 'user_id', avg(user_id), stddev_samp(user_id) FROM old)
        SELECT CAST(window_start AS TIMESTAMP) AS window_start, feature, n, round(m, 6) AS current_mean,
        round(abs(m - bm) / bs, 6) AS shift, abs(m - bm) / bs > 0.15 AS drifted FROM w JOIN b USING (feature)
        WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "dedup_stream": """SELECT DISTINCT CAST(404000 + user_id * 7 AS DOUBLE) / CAST(10000 AS DOUBLE) AS LATITUDE,
        CAST(-743000 + user_id * 11 AS DOUBLE) / CAST(10000 AS DOUBLE) AS LONGITUDE,
        CAST(user_id * 1000 AS DOUBLE) AS PRICE FROM events""",
}
