"""SQL equivalents of the named queries, for DuckDB over the fixture tables.

Each string reads the pre-registered views (lineitem, part, supplier, nation,
region, events) and produces the same columns as the Spark query of the same
name.  The daily price sum is rounded to 2 decimals; all other sums of floats are exact on both sides: every fixture price is at least 8, so a whole
multiple of 2**-20, and the sums here are of whole numbers, rounded once at the end.
"""

from __future__ import annotations

from ..params import FIXTURE_DEPARTMENTS, FIXTURE_EXCLUDED_CATEGORY, PRICE_MAX, PRICE_MIN


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


DEPS = _in_list(FIXTURE_DEPARTMENTS)
EXCL = FIXTURE_EXCLUDED_CATEGORY.replace("'", "''")


def star_ctes(category: str = "p_brand") -> str:
    """ventas / productos / locales as CTEs (same mapping as sources.fixtures)."""
    return f"""
ventas AS (
  SELECT l_suppkey AS clave_local, l_partkey AS clave_producto,
         CAST(l_shipdate AS DATE) AS fecha,
         CAST(l_quantity AS FLOAT) AS cant_vta_original,
         CAST(l_extendedprice / l_quantity AS FLOAT) AS precio_unitario,
         l_orderkey + l_linenumber AS clave_venta
  FROM lineitem),
productos AS (
  SELECT p_partkey AS clave, max({category}) AS categoria
  FROM part WHERE p_partkey IS NOT NULL GROUP BY p_partkey),
locales AS (
  SELECT s_suppkey AS clave, max(r_name) AS departamento
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey),
ok_sales AS (
  SELECT * FROM ventas
  WHERE cant_vta_original >= 0 AND NOT isnan(cant_vta_original)
    AND precio_unitario >= {PRICE_MIN} AND precio_unitario <= {PRICE_MAX} AND NOT isnan(precio_unitario)),
ok_prod AS (
  SELECT clave, categoria FROM productos WHERE categoria IS NOT NULL AND categoria <> '{EXCL}'),
ok_loc AS (
  SELECT clave, departamento FROM locales WHERE departamento IN ({DEPS})),
inner_sales AS (
  SELECT s.*, p.categoria, l.departamento, strftime(s.fecha, '%Y') AS year
  FROM ok_sales s JOIN ok_prod p ON s.clave_producto = p.clave JOIN ok_loc l ON s.clave_local = l.clave),
left_sales AS (
  SELECT s.*, coalesce(p.categoria, '') AS categoria, coalesce(l.departamento, '') AS departamento
  FROM ok_sales s LEFT JOIN ok_prod p ON s.clave_producto = p.clave
                  LEFT JOIN ok_loc l ON s.clave_local = l.clave)"""


def with_star(body: str, category: str = "p_brand", extra_ctes: str = "") -> str:
    ctes = star_ctes(category)
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


ORACLE: dict[str, str] = {}


def exact_sum(x: str) -> str:
    return f"(CAST(sum(CAST(CAST({x} AS DOUBLE) * 1048576 AS HUGEINT)) AS DOUBLE) / 1048576)"


ORACLE["daily_price_by_cat_dep_year"] = with_star("""
SELECT categoria, departamento, year, fecha, round(sum(CAST(precio_unitario AS DOUBLE)), 2) AS suma_precio
FROM inner_sales GROUP BY categoria, departamento, year, fecha""")

ORACLE["quantity_by_cat_dep"] = with_star("""
SELECT categoria, departamento, coalesce(sum(CAST(cant_vta_original AS DOUBLE)), 0) AS cantidad
FROM left_sales GROUP BY categoria, departamento""")

ORACLE["enriched_inner"] = with_star("""
SELECT clave_local, clave_producto, fecha, cant_vta_original, precio_unitario, clave_venta,
       categoria, departamento
FROM inner_sales""")

ORACLE["enriched_left"] = with_star("""
SELECT clave_local, clave_producto, fecha, cant_vta_original, precio_unitario, clave_venta,
       categoria, departamento
FROM left_sales""")

ORACLE["avg_by_day"] = with_star(f"""
SELECT categoria, year, fecha, {exact_sum("precio_unitario")} / count(*) AS promedio
FROM inner_sales GROUP BY categoria, year, fecha""", "p_type")

ORACLE["count_by_day"] = with_star("""
SELECT categoria, year, fecha, count(*) AS cantidad
FROM inner_sales GROUP BY categoria, year, fecha""", "p_type")

ORACLE["sum_by_key"] = with_star(f"""
SELECT categoria, year, {exact_sum("precio_unitario")} AS suma
FROM inner_sales GROUP BY categoria, year""", "p_type")

ORACLE["max_by_key"] = with_star("""
SELECT categoria, year, max(CAST(precio_unitario AS DOUBLE)) AS maximo
FROM inner_sales GROUP BY categoria, year""", "p_type")


def regression_sql(series_select: str, keys: list[str], ratio: float = 0.7, min_points: int = 3,
                   category: str = "p_type") -> str:
    """Segmented regression by refitting: every split's two sides anew from the points, with regr_*."""
    k = ", ".join(keys)
    on = " AND ".join(f"s.{c} = d.{c}" for c in keys)
    dk = ", ".join(f"d.{c}" for c in keys)

    def sse(side: str) -> str:
        f = f"FILTER (WHERE {side})"
        return (f"CASE WHEN count(DISTINCT s.x) {f} > 1 THEN regr_syy(s.value, s.x) {f} - "
                f"power(regr_sxy(s.value, s.x) {f}, 2) / regr_sxx(s.value, s.x) {f} END")

    ctes = f"""series AS ({series_select}),
points AS (
  SELECT *, CAST(date_diff('day', min(fecha) OVER (PARTITION BY {k}), fecha) AS DOUBLE) AS x FROM series),
splits AS (SELECT DISTINCT {k}, fecha FROM points),
errs AS (
  SELECT {dk}, d.fecha, count(*) FILTER (WHERE s.fecha <= d.fecha) AS n_left,
         count(*) FILTER (WHERE s.fecha > d.fecha) AS n_right,
         {sse('s.fecha <= d.fecha')} AS sse_left, {sse('s.fecha > d.fecha')} AS sse_right,
         {sse('true')} AS sse_whole, regr_syy(s.value, s.x) AS syy_whole
  FROM splits d JOIN points s ON {on} GROUP BY {dk}, d.fecha)"""
    body = f"""
SELECT {k}, fecha AS change_point, 'ok' AS status FROM errs
WHERE n_left >= {min_points} AND n_right >= {min_points}
  AND sse_whole > 1e-9 * syy_whole
  AND sse_left + sse_right < {ratio} * sse_whole"""
    return with_star(body, category, ctes)


REGRESSION_KEYS = ["categoria", "year", "clave_local"]
REGRESSION_SERIES = ("SELECT categoria, year, clave_local, fecha, CAST(precio_unitario AS DOUBLE) AS value "
                     "FROM inner_sales")
ORACLE["segmented_regression"] = regression_sql(REGRESSION_SERIES, REGRESSION_KEYS)


def cost_rows(p: str, keys: list[str], where: str) -> str:
    """SELECT (keys..., b, a, cost) of the segments between boundaries `aa` and `bb` of `{p}_bnd` that fulfil `where`."""
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)
    L = "CAST(bb.tau - aa.tau AS DOUBLE)"
    S = "CAST(x[2] - x[1] AS DOUBLE)"
    f = f"({S} * 0.5::DOUBLE / {L})"
    term = (f"CASE WHEN x[2] - x[1] = 0 OR x[2] - x[1] = 2 * (bb.tau - aa.tau) THEN 0.0::DOUBLE "
            f"ELSE {L} * ({f} * ln({f}) + (1.0::DOUBLE - {f}) * ln(1.0::DOUBLE - {f})) END")
    return f"""SELECT {", ".join(f"bb.{c}" for c in keys)}, bb.b, aa.b AS a,
         par.fac * list_sum(list_transform(list_zip(aa.pl, bb.pl), lambda x: {term})) AS cost
  FROM {p}_bnd bb JOIN {p}_bnd aa ON {on('bb', 'aa')} JOIN {p}_par par ON {on('bb', 'par')}
  WHERE aa.b < bb.b AND {where}"""


def edpelt_ctes(p: str, pts: str, keys: list[str], allowed: str | None = None, min_points: int = 3) -> str:
    """CTEs computing ED-PELT in SQL; the result CTE is `{p}_out(keys..., change_point)`.

    `pts` names a CTE with (keys..., fecha, value).  `allowed`, if given, names a
    CTE with (keys..., fecha): only boundaries right after those dates may hold
    a change (boundary 0 always may).
    """
    k = ", ".join(keys)
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)
    kcols = lambda a: ", ".join(f"{a}.{c}" for c in keys)
    allowed_join = (f"LEFT JOIN (SELECT DISTINCT {k}, fecha, true AS ok FROM {allowed}) al USING ({k}, fecha)"
                    if allowed else "")
    allowed_expr = "coalesce(al.ok, false)" if allowed else "true"
    two_min = 2 * min_points
    return f"""{p}_nk AS (
  SELECT {k}, count(*) AS n, CAST(least(count(*), ceil(4.0::DOUBLE * ln(count(*)))) AS BIGINT) AS kq
  FROM {pts} GROUP BY {k} HAVING count(*) > 2),
{p}_par AS MATERIALIZED (
  SELECT *, 3 * ln(n) AS pen, 2.0::DOUBLE * (-ln(2 * n - 1)) / CAST(kq AS DOUBLE) AS fac FROM {p}_nk),
{p}_ranked AS (
  SELECT {k}, value, row_number() OVER (PARTITION BY {k} ORDER BY value) - 1 AS rk FROM {pts}),
{p}_targets AS (
  SELECT {k}, i, CAST(floor((n - 1) * (1.0::DOUBLE / (1.0::DOUBLE + pow(CAST(2 * n - 1 AS DOUBLE),
         -(-1.0::DOUBLE + (2 * i + 1.0::DOUBLE) / CAST(kq AS DOUBLE)))))) AS BIGINT) AS rk
  FROM (SELECT *, unnest(range(kq)) AS i FROM {p}_nk)),
{p}_th AS MATERIALIZED (
  SELECT {kcols('t')}, t.i, r.value AS t FROM {p}_targets t JOIN {p}_ranked r ON {on('t', 'r')} AND t.rk = r.rk),
{p}_daily AS (
  SELECT {kcols('q')}, q.fecha, th.i,
         sum(CASE WHEN q.value < th.t THEN 2 WHEN q.value = th.t THEN 1 ELSE 0 END) AS s
  FROM {pts} q JOIN {p}_th th ON {on('q', 'th')} GROUP BY ALL),
{p}_cum AS (
  SELECT {k}, fecha, i, CAST(sum(s) OVER (PARTITION BY {k}, i ORDER BY fecha) AS BIGINT) AS ps FROM {p}_daily),
{p}_cnt AS (SELECT {k}, fecha, count(*) AS c FROM {pts} GROUP BY ALL),
{p}_bnd0 AS (
  SELECT {k}, fecha, row_number() OVER (PARTITION BY {k} ORDER BY fecha) AS b,
         CAST(sum(c) OVER (PARTITION BY {k} ORDER BY fecha) AS BIGINT) AS tau, {allowed_expr} AS allowed
  FROM {p}_cnt {allowed_join}),
{p}_bnd AS MATERIALIZED (
  SELECT {kcols('b0')}, b0.b, b0.tau, b0.fecha, b0.allowed, list(c.ps ORDER BY c.i) AS pl
  FROM {p}_bnd0 b0 JOIN {p}_cum c ON {on('b0', 'c')} AND b0.fecha = c.fecha
  GROUP BY ALL
  UNION ALL
  SELECT {k}, 0 AS b, 0 AS tau, NULL AS fecha, true AS allowed,
         list_transform(range(kq), lambda x: CAST(0 AS BIGINT)) AS pl FROM {p}_nk),
{p}_seg AS MATERIALIZED (
  {cost_rows(p, keys, f"bb.tau - aa.tau >= {min_points} AND aa.allowed")}),
{p}_fold AS MATERIALIZED (
  SELECT {k}, b, list(a ORDER BY a) AS aa, list(cost ORDER BY a) AS cc FROM {p}_seg GROUP BY ALL),
{p}_steps AS MATERIALIZED (
  SELECT {kcols('bd')}, bd.b, bd.tau, coalesce(fo.aa, []) AS aa, coalesce(fo.cc, []) AS cc, par.pen
  FROM {p}_bnd bd LEFT JOIN {p}_fold fo ON {on('bd', 'fo')} AND bd.b = fo.b
  JOIN {p}_par par ON {on('bd', 'par')}
  WHERE bd.b > 0),
{p}_dp AS (
  SELECT {k}, CAST(0 AS BIGINT) AS b, [-pen] AS best, [CAST(-1 AS BIGINT)] AS prev FROM {p}_par
  UNION ALL
  SELECT {kcols('d')}, CAST(s.b AS BIGINT),
         list_append(d.best, CASE WHEN len(s.aa) = 0 THEN 1e300::DOUBLE ELSE list_min(list_transform(
           range(len(s.aa)), lambda j: {{'tot': CASE WHEN s.aa[j + 1] = 0 AND s.tau < {two_min} THEN s.cc[j + 1]
                                            ELSE (d.best[s.aa[j + 1] + 1] + s.cc[j + 1]) + s.pen END,
                                     'a': s.aa[j + 1]}}))['tot'] END),
         list_append(d.prev, CASE WHEN len(s.aa) = 0 THEN CAST(-1 AS BIGINT) ELSE list_min(list_transform(
           range(len(s.aa)), lambda j: {{'tot': CASE WHEN s.aa[j + 1] = 0 AND s.tau < {two_min} THEN s.cc[j + 1]
                                            ELSE (d.best[s.aa[j + 1] + 1] + s.cc[j + 1]) + s.pen END,
                                     'a': s.aa[j + 1]}}))['a'] END)
  FROM {p}_dp d JOIN {p}_steps s ON {on('d', 's')} AND s.b = d.b + 1),
{p}_final AS (
  SELECT {kcols('d')}, d.prev FROM {p}_dp d
  JOIN (SELECT {k}, max(b) AS b FROM {p}_bnd GROUP BY ALL) m ON {on('d', 'm')} AND d.b = m.b),
{p}_trace AS (
  SELECT {k}, prev, prev[len(prev)] AS cur FROM {p}_final
  UNION ALL
  SELECT {k}, prev, prev[cur + 1] FROM {p}_trace WHERE cur > 0),
{p}_out AS (
  SELECT {kcols('t')}, bd.fecha AS change_point FROM {p}_trace t
  JOIN {p}_bnd bd ON {on('t', 'bd')} AND bd.b = t.cur WHERE t.cur > 0)"""


def with_star_recursive(body: str, category: str, extra_ctes: str) -> str:
    return "WITH RECURSIVE " + star_ctes(category) + ",\n" + extra_ctes + "\n" + body


ORACLE["regression_by_blocks"] = ORACLE["segmented_regression"]
_ORIGINAL_KEYS = ["categoria", "year", "clave_producto"]
ORACLE["regression_by_product_year"] = regression_sql(
    "SELECT categoria, year, clave_producto, fecha, CAST(precio_unitario AS DOUBLE) AS value FROM inner_sales", _ORIGINAL_KEYS,
    min_points=2)

EDPELT_KEYS = ["categoria", "year"]
EDPELT_SERIES = "SELECT categoria, year, fecha, CAST(precio_unitario AS DOUBLE) AS value FROM inner_sales"

ORACLE["edpelt"] = with_star_recursive(
    "SELECT categoria, year, change_point, 'ok' AS status FROM e_out", "p_brand",
    f"pts AS ({EDPELT_SERIES}),\n" + edpelt_ctes("e", "pts", EDPELT_KEYS))

#: Cost evaluations that a series of the row below may use.
WORK_BUDGET = 1_500


def within_ctes(p: str, keys: list[str], budget: int, min_points: int = 3) -> str:
    """CTEs over `edpelt_ctes` for a search that a work budget ends: `{p}_rows` (keys..., the columns of the row)."""
    k = ", ".join(keys)
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)
    total = (f"CASE WHEN a = 0 AND tau < {2 * min_points} THEN cost ELSE (best[a + 1] + cost) + pen END")
    return f"""{p}_work AS (
  SELECT {", ".join(f"st.{c}" for c in keys)}, st.b, sum(coalesce(g.n, 0)) OVER (PARTITION BY {", ".join(f"st.{c}" for c in keys)}
           ORDER BY st.b) AS used
  FROM {p}_steps st LEFT JOIN (
    SELECT {", ".join(f"s.{c}" for c in keys)}, s.b, count(*) AS n FROM {p}_seg s JOIN {p}_bnd aa ON {on('s', 'aa')} AND aa.b = s.a
    WHERE s.a = 0 OR aa.tau >= {min_points} GROUP BY ALL) g ON {on('st', 'g')} AND st.b = g.b),
{p}_end AS MATERIALIZED (
  SELECT {k}, max(b) AS last_b, coalesce(max(b) FILTER (WHERE used <= {budget}), 0) AS c,
         coalesce(max(used) FILTER (WHERE used <= {budget}), 0) AS evaluations, count(*) AS dates FROM {p}_work GROUP BY {k}),
{p}_known AS MATERIALIZED (
  SELECT e.*, d.best, d.prev, par.pen, par.n FROM {p}_end e JOIN {p}_dp d ON {on('e', 'd')} AND d.b = e.last_b
  JOIN {p}_par par ON {on('e', 'par')}),
{p}_last AS (
  SELECT {", ".join(f"kn.{c}" for c in keys)}, min({{'tot': {total}, 'a': a}}) AS m
  FROM {p}_seg s JOIN {p}_known kn ON {on('s', 'kn')} AND s.b = kn.last_b AND s.a <= kn.c
  JOIN {p}_bnd bd ON {on('s', 'bd')} AND bd.b = s.b
  GROUP BY ALL),
{p}_parts AS MATERIALIZED (
  SELECT g.* FROM ({cost_rows(p, keys, "true")}) g JOIN {p}_known kn ON {on('g', 'kn')}
  WHERE (g.b = kn.c AND g.a < kn.c) OR (g.b = g.a + 1 AND g.a >= kn.c)),
{p}_low AS (
  SELECT {", ".join(f"kn.{c}" for c in keys)},
    least(CASE WHEN best[c + 1] < 1e299 THEN best[c + 1] + any_value(pen) ELSE 1e300::DOUBLE END,
          coalesce(min(CASE WHEN g.b = c AND best[g.a + 1] < 1e299 THEN best[g.a + 1] + g.cost + pen END), 1e300::DOUBLE))
    + coalesce(sum(g.cost) FILTER (WHERE g.a >= c), 0) AS low
  FROM {p}_known kn LEFT JOIN {p}_parts g ON {on('g', 'kn')} GROUP BY {", ".join(f"kn.{c}" for c in keys)}, c, best),
{p}_walk AS (
  SELECT {", ".join(f"kn.{c}" for c in keys)}, prev, CASE WHEN c = last_b THEN prev[last_b + 1] ELSE m.a END AS cur
  FROM {p}_known kn LEFT JOIN {p}_last l ON {on('kn', 'l')}
  UNION ALL
  SELECT {k}, prev, prev[cur + 1] FROM {p}_walk WHERE cur > 0),
{p}_days AS (
  SELECT {", ".join(f"w.{c}" for c in keys)}, string_agg(strftime(bd.fecha, '%Y-%m-%d'), ', ' ORDER BY bd.fecha) AS change_points
  FROM {p}_walk w JOIN {p}_bnd bd ON {on('w', 'bd')} AND bd.b = w.cur WHERE w.cur > 0 GROUP BY ALL),
{p}_rows AS (
  SELECT {", ".join(f"kn.{c}" for c in keys)}, n AS points, CAST(dates AS INTEGER) AS dates, CAST(evaluations AS BIGINT) AS evaluations,
    CASE WHEN c = last_b THEN 'ok' ELSE 'cut' END AS status,
    CASE WHEN c = last_b THEN best[last_b + 1] ELSE m.tot END AS cost,
    CASE WHEN c = last_b THEN best[last_b + 1] ELSE least(low, m.tot) END AS lower_bound,
    coalesce(change_points, '') AS change_points
  FROM {p}_known kn LEFT JOIN {p}_last l ON {on('kn', 'l')} LEFT JOIN {p}_low lo ON {on('kn', 'lo')}
  LEFT JOIN {p}_days dy ON {on('kn', 'dy')})"""


ORACLE["edpelt_work_budget"] = with_star_recursive(
    "SELECT categoria, year, points, dates, evaluations, status, round(cost, 4) AS cost, round(lower_bound, 4) AS lower_bound, "
    "change_points FROM e_rows", "p_brand",
    f"pts AS ({EDPELT_SERIES}),\n" + edpelt_ctes("e", "pts", EDPELT_KEYS) + ",\n" + within_ctes("e", EDPELT_KEYS, WORK_BUDGET))
ORACLE["edpelt_by_blocks"] = ORACLE["edpelt"]

ORACLE["edpelt_partial_sums"] = with_star(f"""
SELECT categoria, year, fecha, CAST(i AS BIGINT) AS i, t AS threshold,
       CAST(sum(s) OVER (PARTITION BY categoria, year, i ORDER BY fecha) AS BIGINT) AS partial_sum
FROM p_daily""", "p_brand", f"pts AS ({EDPELT_SERIES}),\n" + edpelt_ctes("p", "pts", EDPELT_KEYS).split(
    ",\np_cum AS")[0].replace("sum(CASE", "th.t, sum(CASE"))

DIVIDE_SERIES = ("SELECT categoria, year, CAST(((clave_venta % 8) + 8) % 8 AS INTEGER) AS segmento, fecha, "
                 "CAST(precio_unitario AS DOUBLE) AS value FROM inner_sales")
DIVIDE_CTES = (f"pts1 AS ({DIVIDE_SERIES}),\n" + edpelt_ctes("d1", "pts1", EDPELT_KEYS + ["segmento"])
               + ",\ncands AS (SELECT DISTINCT categoria, year, change_point AS fecha FROM d1_out),\n"
               + f"pts2 AS ({EDPELT_SERIES}),\n" + edpelt_ctes("d2", "pts2", EDPELT_KEYS, allowed="cands"))

ORACLE["divide_pelt_candidates"] = with_star_recursive(
    "SELECT categoria, year, segmento, change_point, 'ok' AS status FROM d1_out", "p_brand",
    f"pts1 AS ({DIVIDE_SERIES}),\n" + edpelt_ctes("d1", "pts1", EDPELT_KEYS + ["segmento"]))

ORACLE["divide_pelt_segments"] = with_star_recursive(
    "SELECT categoria, year, count(DISTINCT segmento) AS n_segments, count(DISTINCT change_point) AS n_candidates "
    "FROM d1_out GROUP BY categoria, year", "p_brand",
    f"pts1 AS ({DIVIDE_SERIES}),\n" + edpelt_ctes("d1", "pts1", EDPELT_KEYS + ["segmento"]))

ORACLE["divide_pelt"] = with_star_recursive(
    "SELECT categoria, year, change_point, 'ok' AS status FROM d2_out", "p_brand", DIVIDE_CTES)

_REG = regression_sql(REGRESSION_SERIES, REGRESSION_KEYS)
_REG_CTES = _REG[len("WITH "):_REG.rindex("\nSELECT")]
_REG_BODY = _REG[_REG.rindex("\nSELECT"):]
REG_RESULT = f"reg AS ({_REG_BODY})"
HIST_SQL = """hist AS (
  SELECT categoria, year, strftime(change_point, '%Y-%m-%d') AS token, count(*) AS n
  FROM {src} GROUP BY ALL)"""
JSON_SELECT = """
SELECT categoria, year,
       '{' || string_agg('"' || token || '": ' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, token) || '}'
         AS histogram
FROM hist GROUP BY categoria, year"""

ORACLE["conclusion_histogram"] = ("WITH " + _REG_CTES + ",\n" + REG_RESULT + ",\n" + HIST_SQL.format(src="reg")
                                  + "\nSELECT categoria, year, token, n FROM hist")
ORACLE["conclusion_json"] = "WITH " + _REG_CTES + ",\n" + REG_RESULT + ",\n" + HIST_SQL.format(src="reg") + JSON_SELECT

ORACLE["conclusion_file"] = ("WITH " + _REG_CTES + ",\n" + REG_RESULT + ",\n" + HIST_SQL.format(src="reg") + f""",
js AS ({JSON_SELECT})
SELECT categoria || chr(9) || year || chr(9) || histogram AS value, CAST(1 AS BIGINT) AS files FROM js""")

SUPPLIER_KEYS = ["categoria", "year", "clave_local"]
SUPPLIER_SERIES = REGRESSION_SERIES
ORACLE["edpelt_by_supplier"] = with_star_recursive(
    "SELECT categoria, year, clave_local, change_point, 'ok' AS status FROM s_out", "p_type",
    f"pts AS ({SUPPLIER_SERIES}),\n" + edpelt_ctes("s", "pts", SUPPLIER_KEYS))
ORACLE["conclusion_json_edpelt"] = with_star_recursive(
    JSON_SELECT, "p_type",
    f"pts AS ({SUPPLIER_SERIES}),\n" + edpelt_ctes("s", "pts", SUPPLIER_KEYS) + ",\n"
    + HIST_SQL.format(src="s_out"))

PRODUCT_KEYS = ["categoria", "clave_producto"]
PRODUCT_SERIES = ("SELECT categoria, clave_producto, fecha, CAST(precio_unitario AS DOUBLE) AS value "
                  "FROM inner_sales")
ORACLE["edpelt_by_product"] = with_star_recursive(
    "SELECT categoria, clave_producto, change_point, 'ok' AS status FROM pp_out", "p_brand",
    f"pts AS ({PRODUCT_SERIES}),\n" + edpelt_ctes("pp", "pts", PRODUCT_KEYS))
ORACLE["regression_by_product"] = regression_sql(PRODUCT_SERIES, PRODUCT_KEYS, category="p_brand")

EVENT_KEYS = ["event_type", "user_id"]
EVENT_SERIES = ("SELECT event_type, user_id, CAST(ts AS DATE) AS fecha, CAST(value AS DOUBLE) AS value FROM events "
                "WHERE ts IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)")
ORACLE["events_edpelt"] = ("WITH RECURSIVE " + f"pts AS ({EVENT_SERIES}),\n" + edpelt_ctes("ev", "pts", EVENT_KEYS)
                           + "\nSELECT event_type, user_id, change_point, 'ok' AS status FROM ev_out")
_EVR = regression_sql(EVENT_SERIES, EVENT_KEYS)
ORACLE["events_regression"] = "WITH " + _EVR[_EVR.index("series AS ("):]

DEPARTMENT_KEYS = ["categoria", "year", "departamento"]
DEPARTMENT_SERIES = ("SELECT categoria, year, departamento, fecha, CAST(precio_unitario AS DOUBLE) AS value "
                     "FROM inner_sales")
DEPARTMENT_SEG_SERIES = ("SELECT categoria, year, departamento, CAST(((clave_venta % 8) + 8) % 8 AS INTEGER) "
                         "AS segmento, fecha, CAST(precio_unitario AS DOUBLE) AS value FROM inner_sales")
ORACLE["edpelt_by_department"] = with_star_recursive(
    "SELECT categoria, year, departamento, change_point, 'ok' AS status FROM dd_out", "p_type",
    f"pts AS ({DEPARTMENT_SERIES}),\n" + edpelt_ctes("dd", "pts", DEPARTMENT_KEYS))
ORACLE["divide_pelt_by_department"] = with_star_recursive(
    "SELECT categoria, year, departamento, change_point, 'ok' AS status FROM q2_out", "p_type",
    f"pts1 AS ({DEPARTMENT_SEG_SERIES}),\n" + edpelt_ctes("q1", "pts1", DEPARTMENT_KEYS + ["segmento"])
    + ",\nqc AS (SELECT DISTINCT categoria, year, departamento, change_point AS fecha FROM q1_out),\n"
    + f"pts2 AS ({DEPARTMENT_SERIES}),\n" + edpelt_ctes("q2", "pts2", DEPARTMENT_KEYS, allowed="qc"))

ORACLE["edpelt_range_ranks"] = ORACLE["edpelt_radix_ranks"] = ORACLE["edpelt"]

_DEP_KEYS = ["categoria", "departamento", "year"]
_DEP = regression_sql("SELECT categoria, departamento, year, clave_local, fecha, CAST(precio_unitario AS DOUBLE) AS value "
                      "FROM inner_sales", _DEP_KEYS + ["clave_local"])
ORACLE["conclusion_by_department"] = ("WITH " + _DEP[len("WITH "):_DEP.rindex("\nSELECT")] + ",\nreg AS ("
                                      + _DEP[_DEP.rindex("\nSELECT"):] + """),
hist AS (
  SELECT categoria, departamento, year, strftime(change_point, '%Y-%m-%d') AS token, count(*) AS n FROM reg GROUP BY ALL)
SELECT categoria, departamento, year,
       '{' || string_agg('"' || token || '": ' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, token) || '}' AS histogram
FROM hist GROUP BY ALL""")

ORACLE["conclusion_timeouts"] = with_star("""
SELECT categoria, year, 'Timeout' AS token, count(*) AS n
FROM (SELECT categoria, year, clave_local FROM inner_sales GROUP BY ALL HAVING count(*) > 2)
GROUP BY categoria, year""", "p_type")

ORACLE["user_detector"] = with_star("""
SELECT categoria, year, clave_local, arg_min(before, fecha) AS change_point, 'ok' AS status
FROM (SELECT *, max(step) OVER (PARTITION BY categoria, year, clave_local) AS top FROM steps WHERE before IS NOT NULL)
WHERE step = top GROUP BY categoria, year, clave_local""", "p_type", """daily AS (
  SELECT categoria, year, clave_local, fecha, avg(CAST(precio_unitario AS DOUBLE)) AS m FROM inner_sales GROUP BY ALL),
steps AS (
  SELECT *, lag(fecha) OVER w AS before, round(abs(m - lag(m) OVER w), 6) AS step
  FROM daily WINDOW w AS (PARTITION BY categoria, year, clave_local ORDER BY fecha))""")

_DOUBLED = f"""all_prod AS (
  SELECT p_partkey AS clave, p_brand AS categoria FROM part UNION ALL
  SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '{EXCL}' ELSE 'Brand#99' END FROM part WHERE p_partkey % 3 = 0),
all_loc AS (
  SELECT s_suppkey AS clave, r_name AS departamento
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey UNION ALL
  SELECT s_suppkey, 'ZZZ' FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 4 = 0)"""
_COLS = ("s.clave_local, s.clave_producto, s.fecha, s.cant_vta_original, s.precio_unitario, s.clave_venta, "
         "coalesce(p.categoria, '') AS categoria, coalesce(l.departamento, '') AS departamento")
ORACLE["duplicate_keys_inner"] = with_star(f"""
SELECT {_COLS} FROM ok_sales s
JOIN (SELECT clave, max(categoria) AS categoria FROM all_prod GROUP BY clave) p
  ON s.clave_producto = p.clave AND p.categoria <> '{EXCL}'
JOIN (SELECT clave, max(departamento) AS departamento FROM all_loc GROUP BY clave) l
  ON s.clave_local = l.clave AND l.departamento IN ({DEPS})""", extra_ctes=_DOUBLED)
ORACLE["duplicate_keys_left"] = with_star(f"""
SELECT {_COLS} FROM ok_sales s
LEFT JOIN (SELECT clave, max(categoria) AS categoria FROM all_prod WHERE categoria <> '{EXCL}' GROUP BY clave) p
  ON s.clave_producto = p.clave
LEFT JOIN (SELECT clave, max(departamento) AS departamento FROM all_loc WHERE departamento IN ({DEPS}) GROUP BY clave) l
  ON s.clave_local = l.clave""", extra_ctes=_DOUBLED)

ORACLE["enriched_inner_reduced"] = ORACLE["enriched_inner"]
ORACLE["enriched_left_tagged"] = ORACLE["duplicate_keys_left"]

_READ = "clave_venta % 13 <> 0 AND clave_venta % 17 <> 0"
ORACLE["text_sales"] = with_star(f"""
SELECT clave_local, clave_producto,
       CASE WHEN clave_venta % 11 = 0 THEN '2024-13-45' ELSE strftime(fecha, '%Y-%m-%d') END AS fecha,
       cant_vta_original AS cant_vta, precio_unitario, clave_venta
FROM ventas WHERE {_READ}""")
ORACLE["text_rejects"] = with_star("""
SELECT CASE WHEN clave_venta % 17 = 0 THEN 'short line' ELSE 'bad cant_vta' END AS reason,
  CAST(clave_local AS VARCHAR) || ';' || CAST(clave_producto AS VARCHAR) || ';'
  || CASE WHEN clave_venta % 11 = 0 THEN '2024-13-45' ELSE strftime(fecha, '%Y-%m-%d') END || ';'
  || printf('%.1f', cant_vta_original) || ';'
  || CASE WHEN clave_venta % 13 = 0 THEN 'dos' ELSE printf('%.1f', cant_vta_original) END AS five_fields,
  CAST(1 AS BIGINT) AS lines_at_a_place
FROM ventas WHERE clave_venta % 13 = 0 OR clave_venta % 17 = 0""")
ORACLE["text_last_duplicate"] = """
SELECT p_partkey AS clave, CASE WHEN p_partkey % 3 = 0 THEN 'AA' || CAST(p_partkey AS VARCHAR) ELSE p_brand END AS categoria
FROM part"""
ORACLE["text_dimensions"] = """
SELECT 'categoria' AS tabla, p_brand AS valor, p_partkey AS clave FROM part WHERE p_partkey % 100 <> 0
UNION ALL
SELECT 'departamento', r_name, s_suppkey
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE s_suppkey % 100 <> 0"""
ORACLE["text_price_points"] = with_star(f"""
SELECT clave_local, fecha, count(*) AS n, {exact_sum("precio_unitario")} AS suma
FROM ventas WHERE {_READ} AND clave_venta % 11 <> 0 GROUP BY clave_local, fecha""")
ORACLE["text_quantity_sum"] = with_star("""
SELECT clave_local, coalesce(sum(CAST(cant_vta_original AS DOUBLE)) FILTER (WHERE clave_venta % 13 <> 0), 0) AS suma
FROM ventas GROUP BY clave_local""")
ORACLE["text_detections"] = ("WITH " + _REG_CTES + ",\n" + REG_RESULT + """
SELECT categoria || chr(9) || year || chr(9) || CAST(clave_local AS VARCHAR) || ';'
       || string_agg(strftime(change_point, '%Y-%m-%d'), ', ' ORDER BY change_point) AS value
FROM reg GROUP BY categoria, year, clave_local""")
