"""DuckDB SQL for the registered queries, written from the definitions and not from the plans.

Reports are joins here where the library stacks and sums, groups are compared by self joins
where the library pivots, and salts meet units in a plain product.
"""

from __future__ import annotations

from workload.queries import DASHBOARD_SALT, PAIR_TRIALS, TOP, TRIALS, WALK_TRIALS
from workload.views import CAP, END, EXPERIMENT_START, PARTNERS, PERIOD, RUN_DATE, START, ctes

BAD = "('fraudulent', 'test', 'unknown')"
METRIC_LIST = ("m1", "m2")


def r(expr: str, digits: int = 6) -> str:
    """Rounded as in the queries: ties nudged off the boundary, no negative zeros."""
    return f"ROUND(CAST({expr} AS DOUBLE) + 3e-{digits + 2}, {digits}) + 0e0"


def rounded(columns: str, digits: int = 6) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns.split())


def integers(columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns.split())


def ratio(num: str, den: str) -> str:
    return (
        f"CASE WHEN {den} <> 0 THEN {num} / {den} WHEN {den} IS NULL THEN NULL "
        f"WHEN {num} > 0 THEN 'inf'::DOUBLE WHEN {num} < 0 THEN '-inf'::DOUBLE END"
    )


def query(parts: list[str], select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


# Experiments: unit-days, salts, group days.

UNIT_DAY = """unit_day AS (
    SELECT user_id AS unit_id, CAST(ts AS DATE) AS day, CAST(COUNT(*) AS DOUBLE) AS m1, SUM(value) AS m2
    FROM events WHERE user_id IS NOT NULL GROUP BY ALL HAVING COUNT(*) <> 0 OR SUM(value) <> 0)"""
SLOT = "CAST('0x' || substr(md5(CAST(unit_id AS VARCHAR) || salt), 29, 4) AS INT)"
GROUP_OF_TEN = "CASE WHEN {b} < 2 THEN 0 WHEN {b} < 5 THEN 1 ELSE 2 END"


def salts_cte(name: str = "salts", run_date: str = RUN_DATE, n: int = TRIALS) -> str:
    digits = len(str(n))
    text = f"substr('B{run_date[5:7]}{run_date[8:]}' || lpad(CAST(i AS VARCHAR), {digits}, '0'), 1, 10)"
    return f"{name} AS (SELECT i AS salt_id, {text} AS salt FROM range({n}) t(i))"


def group_days(name: str, salts: str, slots: int, group: str, start: str = START, end: str = END) -> list[str]:
    """Daily sums and distinct units per salt and group; ``group`` is an expression in ``slot``."""
    return [
        f"""{name}_rows AS (SELECT salt, {group} AS grp, unit_id, day, m1, m2
            FROM (SELECT *, {SLOT} % {slots} AS slot FROM unit_day, {salts} WHERE day BETWEEN '{start}' AND '{end}'))""",
        f"{name}_units AS (SELECT salt, grp, COUNT(DISTINCT unit_id) AS n_units FROM {name}_rows GROUP BY ALL)",
        f"""{name} AS (SELECT salt, grp, day, n_units, SUM(m1) AS m1, SUM(m2) AS m2
            FROM {name}_rows JOIN {name}_units USING (salt, grp) GROUP BY ALL)""",
    ]


THREE_GROUPS = GROUP_OF_TEN.format(b="slot")


def losses(name: str, salts: str, version: int, start: str = START, end: str = END, period: int = PERIOD) -> list[str]:
    """Losses of the groups 0 and 1 against group 2."""
    parts = group_days(f"{name}_days", salts, 10, THREE_GROUPS, start, end)

    def per_unit(m: str) -> str:
        return ratio(f"(t.{m} / t.n_units)", f"(c.{m} / c.n_units)")

    parts.append(f"""{name}_pairs AS (SELECT c.salt, {per_unit('m1')} AS m1, {per_unit('m2')} AS m2
        FROM {name}_days c LEFT JOIN (SELECT * FROM {name}_days WHERE grp IN (0, 1)) t USING (salt, day) WHERE c.grp = 2)""")
    if version == 3:
        total = " + ".join(f"SUM(ABS({m} - 1)) / VAR_POP({m} - 1)" for m in METRIC_LIST)
        divisor = period
    else:
        total = " + ".join(f"SUM(ABS(ABS({m}) - 1))" for m in METRIC_LIST)
        divisor = period * 3 if version == 1 else period
    parts.append(f"{name} AS (SELECT salt, ({total}) / {divisor} AS pae FROM {name}_pairs GROUP BY salt)")
    return parts


STORED = [
    salts_cte("early_salts", EXPERIMENT_START),
    *losses("early", "early_salts", 1, "2024-01-01", "2024-01-15", 15),
    f"stored AS (SELECT salt, pae FROM early ORDER BY pae, salt LIMIT {TOP})",
]


def loss_query(version: int) -> str:
    return query([UNIT_DAY, salts_cte(), *losses("loss", "salts", version)], f"SELECT salt, {rounded('pae', 9)} FROM loss")


# Bootstrap.

SCHEMES = [(20, 1), (10, 2), (4, 5), (2, 10)]


def paired(name: str, salts: str, schemes: list[tuple[int, str]], slots: int) -> list[str]:
    """Relative differences per day of all pairs of groups of every scheme."""
    parts = []
    for groups, expr in schemes:
        parts += group_days(f"{name}_{groups}", salts, slots, expr)
    union = " UNION ALL ".join(f"SELECT {g} AS num_groups, * FROM {name}_{g}" for g, _ in schemes)
    return parts + [
        f"{name}_all AS ({union})",
        f"""{name}_ranked AS (SELECT salt, num_groups, day,
                DENSE_RANK() OVER (PARTITION BY salt, num_groups ORDER BY day) AS day_rank
            FROM (SELECT DISTINCT salt, num_groups, day FROM {name}_all WHERE grp < num_groups - 1))""",
        f"""{name}_pairs AS (SELECT l.salt, l.num_groups, l.day, day_rank, l.grp AS i, j.j,
                {ratio('l.m1', 'rt.m1')} - 1 AS rdiff_m1, {ratio('l.m2', 'rt.m2')} - 1 AS rdiff_m2
            FROM {name}_all l
            JOIN (SELECT g AS j FROM range(20) t(g)) j ON j.j > l.grp AND j.j < l.num_groups
            JOIN {name}_ranked k USING (salt, num_groups, day)
            LEFT JOIN {name}_all rt ON rt.salt = l.salt AND rt.num_groups = l.num_groups AND rt.day = l.day AND rt.grp = j.j)""",
        f"""{name} AS (SELECT salt, i || '_' || j AS paired_groups, h AS num_days, num_groups,
                AVG(rdiff_m1) AS rdiff_m1, AVG(rdiff_m2) AS rdiff_m2
            FROM {name}_pairs JOIN (SELECT 7 * w AS h FROM range(1, {PERIOD // 7 + 1}) t(w)) ON day_rank <= h
            GROUP BY ALL)""",
    ]


BOOT = [UNIT_DAY, salts_cte(), *paired("boot", "salts", [(g, f"slot // {size}") for g, size in SCHEMES], 20)]
SMART_BOOT = paired("smart", "stored", [(3, THREE_GROUPS)], 10)
STORED_BOOT = paired("sboot", "stored", [(g, f"slot // {size}") for g, size in SCHEMES], 20)


def intervals(name: str, table: str, where: str) -> list[str]:
    return [
        f"""{name}_eb AS (SELECT num_days, num_groups,
                rdiff_m1 - AVG(rdiff_m1) OVER (PARTITION BY num_days, num_groups) AS m1,
                rdiff_m2 - AVG(rdiff_m2) OVER (PARTITION BY num_days, num_groups) AS m2
            FROM {table} WHERE {where})""",
        f"""{name} AS (SELECT CASE p WHEN 0.025 THEN '2.5%' ELSE '97.5%' END AS confidence_interval, num_groups, num_days,
                CASE p WHEN 0.025 THEN QUANTILE_CONT(m1, 0.025) ELSE QUANTILE_CONT(m1, 0.975) END AS eb_m1,
                CASE p WHEN 0.025 THEN QUANTILE_CONT(m2, 0.025) ELSE QUANTILE_CONT(m2, 0.975) END AS eb_m2
            FROM {name}_eb, (VALUES (0.025), (0.975)) t(p) GROUP BY p, num_groups, num_days)""",
    ]


CI_COLUMNS = f"confidence_interval, num_groups, num_days, {rounded('eb_m1 eb_m2', 9)}"

DENSITY = [
    f"""kept AS (SELECT num_days, num_groups, rdiff_m2 AS x FROM boot WHERE num_groups = 2 AND ABS(rdiff_m2) < 5)""",
    """shape AS (SELECT num_days, num_groups, COUNT(x) AS n, AVG(x) AS mean, MIN(x) AS lo, MAX(x) AS hi,
        STDDEV_SAMP(x) * POW(COUNT(x), -0.2) AS bw FROM kept GROUP BY ALL)""",
    """grid AS (SELECT num_days, num_groups, n, mean, bw, p AS point,
        lo - 3 * bw + p * (hi - lo + 6 * bw) / 99 AS v FROM shape, range(100) t(p))""",
    """density AS (SELECT num_days, num_groups, point, v - mean AS x,
        SUM(EXP(-0.5 * POW((v - kept.x) / bw, 2))) / (n * bw * SQRT(2 * PI())) AS density
        FROM grid JOIN kept USING (num_days, num_groups) GROUP BY num_days, num_groups, point, v, mean, n, bw)""",
]

# Stationarity of sums, groups 0 and 1 against group 2.

LONG = [
    *group_days("gd", "salts", 10, THREE_GROUPS),
    f"""ratios AS (SELECT c.salt, g.test, c.day, {ratio('t.m1', 'c.m1')} AS m1, {ratio('t.m2', 'c.m2')} AS m2
        FROM gd c CROSS JOIN (VALUES (0), (1)) g(test)
        LEFT JOIN gd t ON t.salt = c.salt AND t.day = c.day AND t.grp = g.test WHERE c.grp = 2)""",
    """long AS (SELECT salt, test, day, 'm1' AS metric, m1 AS x FROM ratios
        UNION ALL SELECT salt, test, day, 'm2', m2 FROM ratios)""",
]
SERIES = [
    UNIT_DAY, salts_cte(), *LONG,
    """defined AS (SELECT salt, test, metric, COUNT(*) >= 8 AND COUNT(*) = COUNT(x) AND NOT BOOL_OR(isinf(x)) AS ok
        FROM long GROUP BY ALL)""",
    """centred AS (SELECT salt, test, metric, day, x, x - AVG(x) OVER w AS e, COUNT(*) OVER w AS n,
        ROW_NUMBER() OVER (PARTITION BY salt, test, metric ORDER BY day) AS i
        FROM long WINDOW w AS (PARTITION BY salt, test, metric))""",
]
LEGACY_LAGS, SHORT_LAGS = "CEIL(12 * POW(n / 100, 0.25))", "FLOOR(4 * POW(n / 100, 0.25))"
KPSS = [
    f"lagged AS (SELECT *, CAST({LEGACY_LAGS} AS INT) AS l FROM centred)",
    """walked AS (SELECT salt, test, metric, n, l, e,
        SUM(e) OVER (PARTITION BY salt, test, metric ORDER BY i) AS s FROM lagged)""",
    "base AS (SELECT salt, test, metric, n, l, SUM(s * s) AS ss, SUM(e * e) AS g0 FROM walked GROUP BY ALL)",
    """cov AS (SELECT a.salt, a.test, a.metric, SUM((1 - (a.i - b.i) / (a.l + 1)) * a.e * b.e) AS g
        FROM lagged a JOIN lagged b ON a.salt = b.salt AND a.test = b.test AND a.metric = b.metric
            AND a.i > b.i AND a.i - b.i <= a.l GROUP BY ALL)""",
    "kpss AS (SELECT salt, test, metric, ss / n / n / ((g0 + 2 * g) / n) AS kpss FROM base JOIN cov USING (salt, test, metric))",
]
KPSS_P = """CASE WHEN kpss <= 0.347 THEN 0.10 WHEN kpss >= 0.739 THEN 0.01
    WHEN kpss < 0.463 THEN 0.10 - 0.05 * (kpss - 0.347) / (0.463 - 0.347)
    WHEN kpss < 0.574 THEN 0.05 - 0.025 * (kpss - 0.463) / (0.574 - 0.463)
    WHEN kpss < 0.739 THEN 0.025 - 0.015 * (kpss - 0.574) / (0.739 - 0.574) END"""
DICKEY_FULLER = [
    "steps AS (SELECT salt, test, metric, LAG(x) OVER s AS x0, x - LAG(x) OVER s AS dx FROM centred "
    "JOIN defined USING (salt, test, metric) WHERE ok WINDOW s AS (PARTITION BY salt, test, metric ORDER BY day))",
    """df AS (SELECT salt, test, metric, REGR_SLOPE(dx, x0)
        / SQRT((REGR_SYY(dx, x0) - REGR_SLOPE(dx, x0) * REGR_SXY(dx, x0)) / (REGR_COUNT(dx, x0) - 2) / REGR_SXX(dx, x0))
        AS df_stat FROM steps GROUP BY ALL)""",
]

# Unit-root tests: columns of a regression as lists, made orthogonal one after the other.

NORMAL_CDF = """CASE WHEN z < -8 THEN 0 WHEN z > 8 THEN 1 WHEN z = 0 THEN 0.5 ELSE 0.5 + sign(z) * exp(-z * z / 2) / sqrt(2 * pi()) *
    list_sum(list_transform(range(0, 200), lambda i: exp((2 * i + 1) * ln(abs(z)) - lgamma(2 * i + 2) + i * ln(2) + lgamma(i + 1)))) END"""


def centred_list(v: str, name: str) -> str:
    return f"list_transform({v}, lambda {name}: {name} - list_avg({v}))"


def lagged_changes(lags: str, m: str) -> str:
    return f"list_transform(range(1, {lags} + 1), lambda k: d[({lags} - k + 1)::BIGINT:({lags} - k + {m})::BIGINT])"


def orthogonalised(name: str, source: str, steps: str) -> list[str]:
    """Recursion that takes ``steps`` first columns of v out of the others; ``rest`` keeps the last one's squared length."""
    along = "list_dot_product(u, v[1]) / nullif(list_dot_product(v[1], v[1]), 0)"
    less = f"list_transform(v[2:], lambda u: list_transform(list_zip(u, v[1]), lambda p: p[1] - coalesce({along}, 0) * p[2]))"
    return [
        f"""{name}_fold AS (SELECT salt, test, metric, {steps} AS todo, v, []::DOUBLE[] AS rest FROM {source}
            UNION ALL SELECT salt, test, metric, todo - 1, w, list_append(rest, list_dot_product(w[-1], w[-1]))
            FROM (SELECT *, {less} AS w FROM {name}_fold WHERE todo > 0))""",
        f"{name} AS (SELECT * FROM {name}_fold WHERE todo = 0)",
    ]


def level_t(name: str, source: str, trend: bool) -> list[str]:
    """t statistic of the level in ``source`` (x, d, n, lags)."""
    columns = "[x[(lags + 1)::BIGINT:(n - 1)::BIGINT], d[(lags + 1)::BIGINT:(n - 1)::BIGINT]]"
    time = "[list_transform(range(1, n - lags), lambda i: i::DOUBLE)]" if trend else "[]::DOUBLE[][]"
    return [
        f"""{name}_design AS (SELECT *, list_transform(list_concat({time}, {lagged_changes('lags', '(n - 1 - lags)')}, {columns}),
            lambda c: {centred_list('c', 'e')}) AS v FROM {source})""",
        *orthogonalised(f"{name}_left", f"{name}_design", "lags + 1" if trend else "lags"),
        f"""{name} AS (SELECT s.salt, s.test, s.metric, s.lags, s.n,
            CASE WHEN xx > 1e-20 * pow(greatest(list_max(list_transform(x, lambda e: abs(e))), 1e-300), 2) AND yy - xy * xy / xx > 0
                THEN xy / sqrt((yy - xy * xy / xx) / (n - 1 - 2 * lags - {3 if trend else 2}) * xx) END AS t
            FROM {source} s JOIN (SELECT *, list_dot_product(v[1], v[1]) AS xx, list_dot_product(v[1], v[2]) AS xy,
                list_dot_product(v[2], v[2]) AS yy FROM {name}_left) USING (salt, test, metric))""",
    ]


XS = """xs AS (SELECT salt, test, metric, list(x ORDER BY day) AS x, COUNT(*)::INT AS n FROM centred JOIN defined USING (salt, test, metric)
        WHERE ok GROUP BY ALL)"""
CHANGES = "list_transform(range(1, n), lambda k: x[k + 1] - x[k]) AS d"
ADF = [
    XS,
    f"""shaped AS (SELECT *, {CHANGES}, greatest(0, least(CAST(CEIL(12 * POW(n / 100, 0.25)) AS INT), n // 2 - 2)) AS most FROM xs)""",
    f"""searched AS (SELECT *, n - 1 - most AS m, list_transform(list_concat([x[(most + 1)::BIGINT:(n - 1)::BIGINT]],
            {lagged_changes('most', '(n - 1 - most)')}, [d[(most + 1)::BIGINT:(n - 1)::BIGINT]]), lambda c: {centred_list('c', 'e')}) AS v FROM shaped)""",
    *orthogonalised("search", "searched", "most + 1"),
    """scored AS (SELECT s.salt, s.test, s.metric, x, d, n,
            list_transform(range(0, most + 1), lambda k: m * ln(greatest(rest[k + 1], 1e-300) / m) + 2 * (k + 2)) AS aic
        FROM searched s JOIN search USING (salt, test, metric))""",
    "fitted AS (SELECT *, (list_position(aic, list_min(aic)) - 1)::INT AS lags FROM scored)",
    *level_t("adf_t", "fitted", False),
    """adf_z AS (SELECT *, CASE WHEN t <= -1.61 THEN 2.1659 + 1.4412 * t + 0.038269 * t * t
            ELSE 1.7339 + 0.93202 * t - 0.12745 * t * t - 0.010368 * t * t * t END AS z FROM adf_t)""",
    f"""adf AS (SELECT salt, test, metric, t AS adf, lags AS adf_lags,
            CASE WHEN t > 2.74 THEN 1 WHEN t < -18.83 THEN 0 ELSE {NORMAL_CDF} END AS adf_pvalue FROM adf_z)""",
]
TESTED = [
    f"kpss_p AS (SELECT k.*, {KPSS_P} AS p FROM kpss k JOIN defined USING (salt, test, metric) WHERE ok)",
    """judged AS (SELECT salt, test, metric, ok AND adf_pvalue IS NOT NULL AND kpss IS NOT NULL AS known, adf_pvalue AS a, p AS k
        FROM defined LEFT JOIN adf USING (salt, test, metric) LEFT JOIN kpss_p USING (salt, test, metric))""",
    """stationary AS (SELECT salt, bool_and(coalesce(known AND a < 0.05 AND k > 0.05, false)) AS stat_result,
            CASE WHEN bool_or(NOT coalesce(known, false)) THEN 'undefined ratio' WHEN bool_or(a >= 0.05) THEN 'unit root'
                WHEN bool_or(k <= 0.05) THEN 'level shift' END AS reason FROM judged GROUP BY salt)""",
]


def walk(version: int, choice: list[str], select: str) -> str:
    """Salts ranked by loss, batches of 500, and the stationary ones of a batch."""
    return recursive([
        UNIT_DAY, salts_cte(n=WALK_TRIALS), *losses("loss", "salts", version), *LONG, *SERIES[len(LONG) + 2:], *KPSS, *ADF, *TESTED,
        """ranked AS (SELECT salt, coalesce(pae, 0) AS pae, ROW_NUMBER() OVER (ORDER BY pae NULLS LAST, salt) - 1 AS index
            FROM salts LEFT JOIN loss USING (salt))""",
        "passed AS (SELECT *, index // 500 AS batch FROM ranked JOIN stationary USING (salt) WHERE stat_result)",
        *choice,
    ], select)


def recursive(parts: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


def smart_salt() -> str:
    return walk(1, [
        """chosen AS (SELECT salt, pae, index, stat_result FROM passed
            UNION ALL SELECT salt, pae, index, false FROM ranked WHERE index = 0)""",
    ], f"SELECT salt, {rounded('pae')}, index, stat_result FROM chosen ORDER BY stat_result DESC, index LIMIT 1")


def smart_salt_table(version: int) -> str:
    return walk(version, ["enough AS (SELECT MIN(batch) AS batch FROM (SELECT batch FROM passed GROUP BY batch HAVING COUNT(*) >= 100))"],
                f"""SELECT salt, {rounded('pae')}, index, stat_result FROM passed, enough
                    WHERE enough.batch IS NULL OR passed.batch = enough.batch""")


# Student-t: shares of the integral of cos^(df - 1), by Simpson's rule.

def _area(start: str, df: str) -> str:
    at = f"greatest(cos({start} + i * (pi() / 2 - {start}) / 2000), 0)"
    weight = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"(list_sum(list_transform(range(0, 2001), lambda i: {weight} * pow({at}, {df} - 1))) * (pi() / 2 - {start}))"


def t_tail(t: str, df: str) -> str:
    """P(|T| > |t|) for df of 1 and more."""
    return f"({_area(f'atan(abs({t}) / sqrt({df}))', df)} / {_area('0', df)})"


def t_reach(name: str, source: str) -> list[str]:
    """(df, reach) for every df in ``source``: the t with probability 0.05 beyond it, by halving t / (1 + t)."""
    middle = "((low + high) / 2)"
    return [
        f"""{name}_halved AS (SELECT DISTINCT CAST(df AS DOUBLE) AS df, 0::DOUBLE AS low, 1::DOUBLE AS high, 0 AS k FROM {source} WHERE df > 0
            UNION ALL SELECT df, CASE WHEN above THEN {middle} ELSE low END, CASE WHEN above THEN high ELSE {middle} END, k + 1
            FROM (SELECT *, {t_tail(f'({middle} / (1 - {middle}))', 'df')} > 0.05 AS above FROM {name}_halved WHERE k < 52))""",
        f"{name} AS (SELECT df, low / (1 - low) AS reach FROM {name}_halved WHERE k = 52)",
    ]


# Accounts.

IN_WINDOW = f"BETWEEN '{START}' AND '{END}'"
UNIT_OF = "COALESCE(TRY_CAST(NULLIF(regexp_extract(r.label, 'hotel[-](.*)[_]xqdz', 1), '') AS INT), r.hotel_id)"
LOCALE = """CASE WHEN length(regexp_extract(r.label, '[-]core(.*)[-]hotel', 1)) > 0
    THEN upper(regexp_extract(r.label, '[-]core(.*)[-]hotel', 1)) ELSE 'US' END"""
DEVICE = """CASE WHEN regexp_matches(r.label, '(linkmob[-]core.*[-]hotel)') THEN 'mobile'
    WHEN regexp_matches(a.name, '(Mobile)') THEN 'mobile' ELSE 'web' END"""
DIST = "regexp_extract(a.name, '^(.*)[.](.*)[.].*', 1)"
PLACE = "regexp_extract(a.name, '^(.*)[.](.*)[.].*', 2)"
CORE = f"a.partner_id = {PARTNERS['two_sided']} AND regexp_matches(a.name, '([_][Cc]ore[.])')"
PLACED = f"a.partner_id = {PARTNERS['placement']} AND regexp_matches(a.name, '(DMeta|Mobile)')"


def reservations(dimensions: str, affiliates: str, under: str) -> str:
    return f"""booked AS (SELECT r.id AS hotelreservation_id, CAST({UNIT_OF} AS INT) AS hotel_id,
            CAST(r.created AS DATE) AS yyyy_mm_dd, {dimensions}, 1 AS gross_bookings,
            r.commission_amount_euro AS gross_commission, r.roomnights
        FROM reservation r JOIN affiliate a ON r.affiliate_id = a.id AND {affiliates}
        WHERE CAST(r.created AS DATE) {IN_WINDOW} AND r.commission_amount_euro {under} {CAP} AND r.status NOT IN {BAD})"""


def revenue(keys: str) -> list[str]:
    kept = "(1 - COALESCE(prediction, nits_score, 0.0))"
    return [f"""revenue AS (SELECT {keys}, SUM(gross_bookings) AS gross_bookings, SUM(gross_commission) AS gross_commission,
            SUM(gross_bookings * {kept}) AS nits_bookings, SUM(gross_commission * {kept}) AS nits_commission,
            SUM(roomnights) AS roomnights
        FROM booked LEFT JOIN (SELECT CAST(hotelreservation_id AS VARCHAR) AS hotelreservation_id, prediction FROM score
                WHERE created_date {IN_WINDOW}) USING (hotelreservation_id)
            LEFT JOIN (SELECT * FROM postbook WHERE CAST(mysql_row_created_at AS DATE) {IN_WINDOW}) USING (hotelreservation_id)
        GROUP BY {keys})"""]


TWO_KEYS = "hotel_id, locale, device, yyyy_mm_dd"
CLICKS = ["""clicks AS (SELECT CAST(hotel_id AS INT) AS hotel_id, locale, device, yyyy_mm_dd,
        SUM(COALESCE(clicks_core, 0) + COALESCE(clicks_bob, 0)) AS clicks,
        SUM(COALESCE(cost_core, 0) + COALESCE(cost_bob, 0)) AS cost
    FROM (SELECT *, 'web' AS device FROM web_cost UNION ALL SELECT *, 'mobile' AS device FROM mobile_cost)
    WHERE yyyy_mm_dd """ + IN_WINDOW + """ AND hotel_id IS NOT NULL GROUP BY ALL)"""]
TWO_BOOKED = [*ctes(["reservation", "affiliate"]), reservations(f"{LOCALE} AS locale, {DEVICE} AS device", CORE, "<=")]
TWO_SIDED = [
    *ctes(["web_cost", "mobile_cost", "reservation", "affiliate", "score", "postbook"]),
    *TWO_BOOKED[len(ctes(["reservation", "affiliate"])):], *revenue(TWO_KEYS), *CLICKS,
    f"joined AS (SELECT * FROM clicks FULL OUTER JOIN revenue USING ({TWO_KEYS}))",
]
SILO_COST = """clicks AS (SELECT CAST(partnerpropertyid AS INT) AS hotel_id,
        regexp_extract(siloname, '(.*)(DMeta|Mobile)', 1) AS distribution,
        regexp_extract(siloname, '(.*)(DMeta|Mobile)', 2) AS placement, date AS yyyy_mm_dd,
        COUNT(*) AS clicks, SUM(cost_eur) AS cost, SUM(length_of_stay) AS length_of_stay
    FROM click_cost WHERE date """ + IN_WINDOW + """ AND hour IS NOT NULL AND siloname IS NOT NULL GROUP BY ALL)"""
PLACE_KEYS = "hotel_id, distribution, placement, yyyy_mm_dd"
PLACEMENT = [
    *ctes(["click_cost", "reservation", "affiliate", "score", "postbook"]),
    reservations(f"{DIST} AS distribution, {PLACE} AS placement", PLACED, "<"), *revenue(PLACE_KEYS), SILO_COST,
    f"joined AS (SELECT * FROM clicks FULL OUTER JOIN revenue USING ({PLACE_KEYS}))",
]
SUMS = "nits_bookings nits_commission gross_bookings gross_commission cost clicks roomnights"
KEYS = "hotel_id, yyyy_mm_dd"


def summary(source: str, measures: str = SUMS, where: str = "TRUE") -> str:
    sums = ", ".join(f"SUM({m}) AS {m}" for m in measures.split())
    return f"""perf AS (SELECT *, nits_commission - cost AS nits_profit, gross_commission - cost AS gross_profit
        FROM (SELECT {KEYS}, {sums} FROM {source} WHERE {where} GROUP BY {KEYS}))"""


COUNTS = "gross_bookings clicks roomnights"
MONEY = "nits_bookings nits_commission gross_commission cost nits_profit gross_profit"
PERF_COLUMNS = f"{KEYS}, {integers(COUNTS)}, {rounded(MONEY)}"
CANCEL_COLUMNS = f"{KEYS}, {integers('cancellations cancelled_roomnights')}, {rounded('cancelled_commission')}"


def cancelled(source: str, where: str) -> str:
    return f"""canc AS (SELECT CAST({{unit}} AS INT) AS hotel_id, r.date_cancelled AS yyyy_mm_dd, COUNT(*) AS cancellations,
            SUM(r.commission_amount_euro) AS cancelled_commission, SUM(r.roomnights) AS cancelled_roomnights
        FROM {source} WHERE r.date_cancelled {IN_WINDOW} AND r.status NOT IN {BAD} AND {where} GROUP BY ALL)"""


def agg_stats(extra: str = "", zero_sided: bool = False) -> str:
    """Performance outer-joined with cancellations, as-booked values, missing values 0."""
    z = (lambda c: f"COALESCE({c}, 0)") if zero_sided else (lambda c: c)
    values = {
        "nits_profit": f"{z('nits_commission')} - {z('cost')}", "gross_profit": f"{z('gross_commission')} - {z('cost')}",
        "asbooked_commission": f"{z('gross_commission')} - {z('cancelled_commission')}",
    }
    money = ["nits_bookings", "nits_commission", "gross_commission", "cost", "cancelled_commission"]
    counts = f"{COUNTS} {extra} cancellations cancelled_roomnights".split()
    columns = [KEYS]
    columns += [f"CAST(COALESCE({c}, 0) AS BIGINT) AS {c}" for c in counts]
    columns.append(f"CAST(COALESCE({z('roomnights')} - {z('cancelled_roomnights')}, 0) AS BIGINT) AS asbooked_roomnights")
    columns += [f"{r(f'COALESCE({c}, 0)')} AS {c}" for c in money]
    columns += [f"{r(f'COALESCE({v}, 0)')} AS {c}" for c, v in values.items()]
    return f"SELECT {', '.join(columns)} FROM perf FULL OUTER JOIN canc USING ({KEYS})"


def wide_sums(perf: str) -> str:
    return perf.replace("nits_commission - cost AS nits_profit, gross_commission - cost AS gross_profit", "1 AS one")


TWO_CANC = cancelled(f"reservation r JOIN affiliate a ON r.affiliate_id = a.id AND {CORE}", "TRUE").format(unit="r.hotel_id")
PLACE_CANC = cancelled(f"reservation r JOIN affiliate a ON r.affiliate_id = a.id AND {PLACED}", "{where}")
SIMPLE_CANC = cancelled(
    "reservation r JOIN flat_affiliate f ON f.affiliate_id = r.affiliate_id",
    f"r.date_cancelled < '{END}' AND r.partner_id = {PARTNERS['simple']} AND {{where}}",
)
SIMPLE_ROWS = f"""simple AS (SELECT hotel_id, yyyy_mm_dd, pos, nits_bookings, commission_expected_euro AS nits_commission,
        bookings AS gross_bookings, commission_amount_euro AS gross_commission, cost_euro AS cost, clicks, roomnights
    FROM performance WHERE yyyy_mm_dd {IN_WINDOW} AND clicks > 0 AND commission_expected_euro <= {CAP})"""
CAMPAIGN_ROWS = f"""campaigned AS (SELECT hotel_id, yyyy_mm_dd, pos, bookings AS gross_bookings, nits_bookings,
        commission AS gross_commission, nits_commission, cost, clicks, roomnights
    FROM report JOIN campaign USING (campaign_id) WHERE yyyy_mm_dd {IN_WINDOW})"""


def last_token(key: str) -> str:
    tokens = f"list_filter(string_split(r.label, '_'), lambda t: regexp_matches(t, '^{key}-[^-]*$'))"
    return f"substr(list_last({tokens}), {len(key) + 2})"


LABELLED = f"""labelled AS (SELECT r.id, r.date_cancelled AS yyyy_mm_dd, r.hotel_id,
        CAST(COALESCE(CASE WHEN {last_token('cid')} IS NOT NULL THEN TRY_CAST(NULLIF({last_token('cid')}, '') AS INT)
                           ELSE cu.cid END, ca.cid, cb.cid, 66) AS INT) AS campaign_id,
        r.commission_amount_euro AS cancelled_commission, r.roomnights AS cancelled_roomnights
    FROM reservation r
    JOIN device_class d ON d.hotelreservation_id = r.id
    JOIN affiliate a ON a.id = r.affiliate_id AND a.partner_id = {PARTNERS['campaign']}
    LEFT JOIN country cu ON cu.cc = {last_token('ucc')}
    LEFT JOIN country ca ON ca.cc = NULLIF(split_part(split_part(a.name, '.', 1), '_', 2), '')
    LEFT JOIN country cb ON cb.cc = upper(r.booker_cc1)
    WHERE r.date_cancelled {IN_WINDOW} AND r.status NOT IN {BAD})"""
CAMPAIGN_CANC = f"""canc AS (SELECT hotel_id, yyyy_mm_dd, COUNT(*) AS cancellations,
        SUM(cancelled_commission) AS cancelled_commission, SUM(cancelled_roomnights) AS cancelled_roomnights
    FROM labelled JOIN campaign USING (campaign_id) GROUP BY ALL)"""
LABEL_VIEWS = ctes(["reservation", "affiliate", "device_class", "country", "campaign"])

TOKENS = """tokens AS (SELECT id, i, t, string_split(t, '-') AS p FROM (
        SELECT id, generate_subscripts(string_split(label, '_'), 1) AS i, unnest(string_split(label, '_')) AS t
        FROM reservation))"""
ENTRIES = """entries AS (
        SELECT id, i, p[1] AS key, p[2] AS value FROM tokens WHERE len(p) = 2
        UNION ALL SELECT id, i, 'placement', CASE WHEN contains(lower(t), 'mapresults') THEN 'mapresults' ELSE 'localuniversal' END
        FROM tokens WHERE len(p) <> 2 AND (contains(lower(t), 'mapresults') OR contains(lower(t), 'localuniversal'))
        UNION ALL SELECT id, i, 'hotel_id', string_split(t, 'hotel-')[2]
        FROM tokens WHERE len(p) <> 2 AND contains(lower(t), 'hotel-'))"""

# Dashboard series.


def dashboard(numbered: bool) -> list[str]:
    number = "grp // 2 + 1"
    role = "CASE WHEN grp % 2 = 0 THEN 'control' ELSE 'test' END"
    return [
        UNIT_DAY, f"one AS (SELECT '{DASHBOARD_SALT}' AS salt)", *group_days("dd_days", "one", 4, "slot"),
        f"""dd AS (SELECT day AS date, {role} AS role, {number} AS num, {role} || {number} AS logic,
            {role} || '-' || {number} AS short, CASE WHEN day < '{EXPERIMENT_START}' THEN 'pre' ELSE 'post' END AS phase,
            CASE WHEN isodow(day) > 5 THEN 'weekend' ELSE 'week' END AS part, m2 / n_units AS value FROM dd_days)""",
        f"""pairs AS (SELECT x.date, x.phase, x.part, x.logic || ' X ' || y.logic AS logic,
            x.short || ' X ' || y.short AS comparison, x.logic AS x_logic, y.logic AS y_logic, x.value AS x, y.value AS y
            FROM dd x JOIN dd y ON x.date = y.date AND x.role = 'control' AND y.role = 'test'
            {'AND x.num = y.num' if numbered else ''})""",
    ]


def welch(keys: str, numbered: bool) -> str:
    se = "(VAR_SAMP(x) / COUNT(*) + VAR_SAMP(y) / COUNT(*))"
    squares = "(POW(VAR_SAMP(x) / COUNT(*), 2) + POW(VAR_SAMP(y) / COUNT(*), 2))"
    return query(dashboard(numbered), f"""SELECT {keys}, COUNT(*) AS n,
        {r(f'(AVG(y) - AVG(x)) / SQRT({se})')} AS t_stat, {r(f'POW({se}, 2) / ({squares} / (COUNT(*) - 1))')} AS df,
        {r('(AVG(x / y) - 1) * 100')} AS relative_diff, {r('AVG(x - y)')} AS mean_abs_diff FROM pairs GROUP BY {keys}""")


DID = [
    """stacked AS (SELECT logic AS comparison, 0 AS treat, CASE phase WHEN 'pre' THEN 0 ELSE 1 END AS after, x AS v FROM pairs
        UNION ALL SELECT logic, 1, CASE phase WHEN 'pre' THEN 0 ELSE 1 END, y FROM pairs)""",
    """fitted AS (SELECT *, v - AVG(v) OVER (PARTITION BY comparison, treat, after) AS e,
        COUNT(*) OVER (PARTITION BY comparison, treat, after) AS cell FROM stacked)""",
    """did AS (SELECT comparison, AVG(v) FILTER (treat = 1 AND after = 1) - AVG(v) FILTER (treat = 1 AND after = 0)
            - AVG(v) FILTER (treat = 0 AND after = 1) + AVG(v) FILTER (treat = 0 AND after = 0) AS estimate,
        SQRT(SUM(e * e) / (COUNT(*) - 4) * SUM(1 / (CAST(cell AS DOUBLE) * cell))) AS std_error, COUNT(*) - 4 AS df
        FROM fitted GROUP BY comparison)""",
]


def effects(season: str) -> list[str]:
    """Effects per day with their errors; sums over the days so far are joins of the days with the earlier ones."""
    return [
        *dashboard(True),
        f"seasonal AS (SELECT *, {season} AS s FROM pairs)",
        "base AS (SELECT comparison, s, AVG(x) AS bx, AVG(y) AS by_, COUNT(*) AS m FROM seasonal WHERE phase = 'pre' GROUP BY ALL)",
        "shifted AS (SELECT *, x - bx AS dx, y - by_ AS dy FROM seasonal JOIN base USING (comparison, s))",
        """fit AS (SELECT comparison, SUM(dx * dy) / SUM(dx * dx) AS b, SUM(dx * dx) AS xx,
            CAST(COUNT(*) - COUNT(DISTINCT s) - 1 AS DOUBLE) AS df,
            SQRT((SUM(dy * dy) - SUM(dx * dy) * SUM(dx * dy) / SUM(dx * dx)) / (COUNT(*) - COUNT(DISTINCT s) - 1)) AS sigma
            FROM shifted WHERE phase = 'pre' GROUP BY comparison)""",
        *t_reach("reaches", "fit"),
        """daily AS (SELECT comparison, date, s, m, dx, y AS actual, by_ + b * dx AS predicted, y - by_ - b * dx AS effect, xx, df, sigma, reach
            FROM shifted JOIN fit USING (comparison) JOIN reaches USING (df) WHERE phase = 'post')""",
        """earlier AS (SELECT a.comparison, a.date, b.s, any_value(b.m) AS m, COUNT(*) AS t, SUM(b.dx) AS dx, SUM(b.effect) AS effect
            FROM daily a JOIN daily b ON a.comparison = b.comparison AND b.date <= a.date GROUP BY ALL)""",
        """sums AS (SELECT comparison, date, SUM(t) AS days, SUM(effect) AS cumulative_effect, SUM(t * t / m) AS shared, SUM(dx) AS dx_sum
            FROM earlier GROUP BY ALL)""",
        """bounded AS (SELECT *, reach * sigma * SQRT(1 + 1 / m + dx * dx / xx) AS half, sigma * SQRT(days + shared + dx_sum * dx_sum / xx) AS total
            FROM daily JOIN sums USING (comparison, date))""",
        f"""effects AS (SELECT *, predicted - half AS predicted_low, predicted + half AS predicted_high, effect - half AS effect_low,
            effect + half AS effect_high, cumulative_effect - reach * total AS cumulative_effect_low,
            cumulative_effect + reach * total AS cumulative_effect_high, {t_tail('(cumulative_effect / total)', 'df')} AS p_value FROM bounded)""",
    ]


EFFECT_COLUMNS = """actual predicted effect cumulative_effect predicted_low predicted_high effect_low effect_high cumulative_effect_low
    cumulative_effect_high p_value"""


def counterfactual(season: str) -> str:
    return recursive(effects(season), f"SELECT comparison, date, CAST(days AS BIGINT) AS days, {rounded(EFFECT_COLUMNS)} FROM effects")


def counterfactual_summary() -> str:
    names = "effect", "effect_low", "effect_high"
    columns = ["actual", "predicted", *[f"cumulative_{n}" for n in names], "p_value"]
    columns += [f"cumulative_{n} / days AS average_{n}" for n in names]
    columns += [f"100 * cumulative_{n} / days / predicted AS relative_{n}" for n in names]
    parts = [c.split(" AS ") if " AS " in c else (c, c) for c in columns]
    return recursive([
        *effects("isodow(date)"),
        f"""whole AS (SELECT comparison, MAX(days) AS days, AVG(actual) AS actual, AVG(predicted) AS predicted,
            {', '.join(f'arg_max(cumulative_{n}, days) AS cumulative_{n}' for n in names)}, arg_max(p_value, days) AS p_value
            FROM effects GROUP BY comparison)""",
    ], f"SELECT comparison, CAST(days AS BIGINT) AS days, {', '.join(f'{r(e)} AS {n}' for e, n in parts)}, p_value < 0.05 AS significant FROM whole")


def cuped() -> str:
    def window(name: str, start: str, end: str) -> str:
        return f"""{name} AS (SELECT 'exp' || (unit_id % 2) AS exp_name, unit_id, SUM(m1) AS m1, SUM(m2) AS m2
            FROM unit_day WHERE day BETWEEN '{start}' AND '{end}' GROUP BY ALL)"""

    def adjusted(m: str) -> str:
        return r(f"{m} - (SELECT COVAR_SAMP(prev_{m}, {m}) / VAR_SAMP(prev_{m}) FROM merged) * prev_{m}")

    return query([
        UNIT_DAY, window("cur", EXPERIMENT_START, "2024-01-29"), window("prev", "2024-01-02", "2024-01-15"),
        """merged AS (SELECT exp_name, unit_id, c.m1, c.m2, COALESCE(p.m1, 0) AS prev_m1, COALESCE(p.m2, 0) AS prev_m2
            FROM cur c LEFT JOIN prev p USING (exp_name, unit_id))""",
    ], f"""SELECT exp_name, unit_id, {integers('m1 prev_m1')}, {rounded('m2 prev_m2')},
        {adjusted('m1')} AS cuped_m1, {adjusted('m2')} AS cuped_m2 FROM merged""")


def cuped_unit_level() -> str:
    def total(m: str, name: str, weeks: int) -> str:
        days = f"day BETWEEN first - {7 * weeks} AND last - {7 * weeks}"
        return f"COALESCE(SUM(CASE WHEN {days} THEN {m} END), 0) AS {name}"

    def adjusted(m: str) -> str:
        return r(f"{m} - theta_{m} * prev_{m}")

    sums = ", ".join(total(m, prefix + m, weeks) for weeks, prefix in ((0, ""), (2, "prev_")) for m in ("m1", "m2"))
    thetas = ", ".join(f"COVAR_SAMP(prev_{m}, {m}) / VAR_SAMP(prev_{m}) AS theta_{m}" for m in ("m1", "m2"))
    return query([
        UNIT_DAY, "units AS (SELECT DISTINCT unit_id FROM unit_day)",
        f"""exposed AS (SELECT 'exp0' AS exp_name, unit_id, DATE '{EXPERIMENT_START}' AS first, DATE '2024-01-29' AS last FROM units WHERE unit_id % 2 = 0
            UNION ALL SELECT 'exp1', unit_id, DATE '2024-01-19', DATE '2024-01-29' FROM units WHERE unit_id % 2 = 1 OR unit_id % 3 = 0)""",
        f"totals AS (SELECT exp_name, unit_id, {sums} FROM exposed LEFT JOIN unit_day USING (unit_id) GROUP BY exp_name, unit_id)",
        f"thetas AS (SELECT exp_name, {thetas} FROM totals GROUP BY exp_name)",
    ], f"""SELECT exp_name, unit_id, {integers('m1 prev_m1')}, {rounded('m2 prev_m2')},
        {adjusted('m1')} AS cuped_m1, {adjusted('m2')} AS cuped_m2 FROM totals JOIN thetas USING (exp_name)""")


def trend_pvalue() -> str:
    """Between the critical values with trend for 25 observations and fewer; the dashboard has no longer pre period."""
    points = [(-4.38, 0.01), (-3.95, 0.025), (-3.60, 0.05), (-3.24, 0.10), (-1.14, 0.90), (-0.80, 0.95), (-0.50, 0.975), (-0.15, 0.99)]
    steps = " ".join(f"WHEN t <= {b} THEN {p} + (t - ({a})) * {(q - p) / (b - a)!r}" for (a, p), (b, q) in zip(points, points[1:]))
    return f"CASE WHEN t <= {points[0][0]} THEN {points[0][1]} {steps} WHEN t > {points[-1][0]} THEN {points[-1][1]} END"


def pre_stationarity() -> str:
    return recursive([
        *dashboard(False),
        f"ratios AS (SELECT logic AS salt, 0 AS test, '' AS metric, date AS day, {ratio('y', 'x')} AS x FROM pairs WHERE phase = 'pre')",
        "errors AS (SELECT logic AS salt, SQRT(AVG(POW(y - x, 2))) AS rmse FROM pairs WHERE phase = 'pre' GROUP BY logic)",
        *[part.replace("FROM long", "FROM ratios") for part in SERIES if part.startswith(("defined", "centred"))],
        *[part.replace(LEGACY_LAGS, SHORT_LAGS) for part in KPSS], XS,
        f"shaped AS (SELECT *, {CHANGES}, CAST(FLOOR(POW(n - 1, 1 / 3) + 1e-9) AS INT) AS lags FROM xs)",
        *level_t("trended", "shaped", True),
    ], f"""SELECT salt AS comparison, {r('rmse')} AS rmse, {r(KPSS_P)} AS kpss_pvalue, {r(trend_pvalue())} AS adf_pvalue
        FROM errors LEFT JOIN kpss USING (salt) LEFT JOIN trended USING (salt)""")


def welch_pvalue() -> str:
    se = "(VAR_SAMP(x) / COUNT(*) + VAR_SAMP(y) / COUNT(*))"
    squares = "(POW(VAR_SAMP(x) / COUNT(*), 2) + POW(VAR_SAMP(y) / COUNT(*), 2))"
    return recursive([
        *dashboard(True),
        f"""welch AS (SELECT comparison, logic, COUNT(*) AS n, AVG(y) - AVG(x) AS diff, SQRT({se}) AS se,
            POW({se}, 2) / ({squares} / (COUNT(*) - 1)) AS df, (AVG(x / y) - 1) * 100 AS relative_diff, AVG(x - y) AS mean_abs_diff
            FROM pairs GROUP BY comparison, logic)""",
        *t_reach("reaches", "welch"),
        f"tested AS (SELECT *, diff / se AS t_stat, {t_tail('(diff / se)', 'df')} AS p_value FROM welch JOIN reaches USING (df))",
    ], f"""SELECT comparison, logic, n, {rounded('t_stat df relative_diff mean_abs_diff')}, {r('diff - reach * se')} AS ci_from,
        {r('diff + reach * se')} AS ci_to, {r('p_value')} AS p_value, p_value < 0.05 AS significant FROM tested""")


ORACLES: dict[str, str] = {
    "salt_table": """
        SELECT run_date, t.i AS trial,
               substr('B' || strftime(run_date, '%m%d') || lpad(CAST(t.i AS VARCHAR), CAST(length(CAST(n AS VARCHAR)) AS INT), '0'), 1, 10) AS salt
        FROM (SELECT CAST(ts AS DATE) AS run_date, COUNT(DISTINCT user_id) AS n FROM events GROUP BY ALL) d, range(d.n) t(i)""",
    "calendar_days": """
        SELECT unit_id, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT user_id AS unit_id, MIN(CAST(ts AS DATE)) AS first_day, MAX(CAST(ts AS DATE)) AS last_day
              FROM events GROUP BY ALL)""",
    "assign_groups": query([salts_cte()], f"""
        SELECT unit_id, salt, {GROUP_OF_TEN.format(b='slot')} AS bucket
        FROM (SELECT unit_id, salt, {SLOT} % 10 AS slot FROM (SELECT DISTINCT user_id AS unit_id FROM events), salts)"""),
    "unit_day_metrics": query(ctes(["ev"]), f"""
        SELECT unit_id, day, CAST(COALESCE(bookings, 0) AS BIGINT) AS bookings, {r('COALESCE(cost, 0)')} AS cost
        FROM (SELECT user_id AS unit_id, day, COUNT(*) AS bookings FROM ev WHERE event_type = 'purchase' GROUP BY ALL)
        FULL OUTER JOIN (SELECT user_id AS unit_id, day, SUM(value / 10) AS cost FROM ev
            WHERE event_type IN ('click', 'view') GROUP BY ALL) USING (unit_id, day)
        WHERE COALESCE(bookings, 0) <> 0 OR COALESCE(cost, 0) <> 0"""),
    "salt_loss_v1": loss_query(1),
    "salt_loss_v2": loss_query(2),
    "salt_loss_v3": loss_query(3),
    "random_salt_perf": loss_query(1),
    "stored_salts_top_n": query([UNIT_DAY, *STORED], f"""
        SELECT ROW_NUMBER() OVER (ORDER BY pae, salt) - 1 AS salt_id, salt, {rounded('pae', 9)} FROM stored"""),
    "smart_salt_perf": query([UNIT_DAY, *STORED, *losses("loss", "stored", 1)], f"SELECT salt, {rounded('pae', 9)} FROM loss"),
    "bootstrap_pairs": query([part if not part.startswith("salts AS") else salts_cte(n=PAIR_TRIALS) for part in BOOT], f"""
        SELECT salt_id, num_groups, day, day_rank, i, j, {rounded('rdiff_m1 rdiff_m2', 9)} FROM boot_pairs JOIN salts USING (salt)"""),
    "bootstrap_rdiff": query(BOOT, f"SELECT salt, paired_groups, num_days, num_groups, {rounded('rdiff_m1 rdiff_m2', 9)} FROM boot"),
    "bootstrap_smart_salts": query([UNIT_DAY, *STORED, *SMART_BOOT], f"""
        SELECT salt, paired_groups, num_days, num_groups, {rounded('rdiff_m1 rdiff_m2', 9)} FROM smart"""),
    "bootstrap_ci": query([*BOOT, *intervals("ci", "boot", "paired_groups = '0_1'")], f"SELECT {CI_COLUMNS} FROM ci"),
    "bootstrap_ci_trimmed": query([*BOOT, *intervals("ci", "boot", "ABS(rdiff_m2) < 5")], f"SELECT {CI_COLUMNS} FROM ci"),
    "ci_comparison": query(
        [*BOOT, *STORED, *STORED_BOOT, *intervals("random", "boot", "paired_groups = '0_1'"),
         *intervals("best", "sboot", "paired_groups = '0_1'")],
        f"""SELECT confidence_interval, num_groups, num_days, {r('a.eb_m1', 9)} AS random_m1, {r('b.eb_m1', 9)} AS smart_m1,
            {r('a.eb_m2', 9)} AS random_m2, {r('b.eb_m2', 9)} AS smart_m2
        FROM random a JOIN best b USING (confidence_interval, num_groups, num_days)"""),
    "bootstrap_density": query([*BOOT, *DENSITY], f"SELECT num_days, num_groups, point, {rounded('x density', 5)} FROM density"),
    "kpss_stat": query([*SERIES, *KPSS], f"""
        SELECT test, metric, salt, {r('kpss')} AS kpss, {r(KPSS_P)} AS kpss_pvalue
        FROM defined LEFT JOIN (SELECT k.* FROM kpss k JOIN defined USING (salt, test, metric) WHERE ok)
            USING (salt, test, metric)"""),
    "df_stat_lag0": query([*SERIES, *DICKEY_FULLER], f"""
        SELECT test, metric, salt, {r('CASE WHEN ok THEN df_stat END')} AS df_stat
        FROM defined LEFT JOIN df USING (salt, test, metric)"""),
    "adf_aic": recursive([*SERIES, *ADF], f"""
        SELECT test, metric, salt, {rounded('adf adf_pvalue')}, adf_lags FROM defined LEFT JOIN adf USING (salt, test, metric)"""),
    "salt_stationarity": recursive([*SERIES, *KPSS, *ADF, *TESTED], """
        SELECT salt, stat_result, reason FROM salts LEFT JOIN stationary USING (salt)"""),
    "smart_salt": smart_salt(),
    "smart_salt_table_v1": smart_salt_table(1),
    "smart_salt_table_v2": smart_salt_table(2),
    "smart_salt_table_v3": smart_salt_table(3),
    "reservations_clean": query(TWO_BOOKED, "SELECT * FROM booked"),
    "nits_adjusted_revenue": query(TWO_SIDED, f"""
        SELECT {TWO_KEYS}, {integers('gross_bookings roomnights')},
            {rounded('gross_commission nits_bookings nits_commission')} FROM revenue"""),
    "clicks_union_devices": query([*ctes(["web_cost", "mobile_cost"]), *CLICKS],
                                  f"SELECT {TWO_KEYS}, {integers('clicks')}, {rounded('cost')} FROM clicks"),
    "click_cost_by_placement": query([*ctes(["click_cost"]), SILO_COST], f"""
        SELECT {PLACE_KEYS}, {integers('clicks length_of_stay')}, {rounded('cost')} FROM clicks"""),
    "cost_revenue_outer": query(TWO_SIDED, f"""
        SELECT {TWO_KEYS}, {integers(COUNTS)}, {rounded('cost gross_commission nits_bookings nits_commission')} FROM joined"""),
    "perf_summary_two_sided": query([*TWO_SIDED, summary("joined")], f"SELECT {PERF_COLUMNS} FROM perf"),
    "perf_summary_placement": query([*PLACEMENT, summary("joined", SUMS + " length_of_stay")],
                                    f"SELECT {PERF_COLUMNS}, {integers('length_of_stay')} FROM perf"),
    "perf_summary_simple": query([*ctes(["performance"]), SIMPLE_ROWS, summary("simple")], f"SELECT {PERF_COLUMNS} FROM perf"),
    "perf_pos_filtered": query([*ctes(["performance"]), SIMPLE_ROWS, summary("simple", where="pos IN ('US', 'GB')")],
                               f"SELECT {PERF_COLUMNS} FROM perf"),
    "perf_summary_campaign": query(
        [*ctes(["report", "campaign"]), CAMPAIGN_ROWS, summary("campaigned", where="pos IN ('US', 'JP', 'IT')")],
        f"SELECT {PERF_COLUMNS} FROM perf"),
    "booking_summary_campaign": query([*ctes(["report", "campaign"]), CAMPAIGN_ROWS, summary("campaigned")], f"""
        SELECT {KEYS}, {integers('gross_bookings roomnights')},
            {rounded('nits_bookings gross_commission nits_commission')} FROM perf"""),
    "cancellations_labelled": query([*LABEL_VIEWS, LABELLED], "SELECT * FROM labelled"),
    "cancellations_campaign": query([*LABEL_VIEWS, LABELLED, CAMPAIGN_CANC], f"SELECT {CANCEL_COLUMNS} FROM canc"),
    "cancellations_agg": query([*ctes(["reservation", "affiliate"]), TWO_CANC], f"SELECT {CANCEL_COLUMNS} FROM canc"),
    "cancellations_placement": query(
        [*ctes(["reservation", "affiliate"]), PLACE_CANC.format(unit="r.hotel_id", where=f"{DIST} = 'US'")],
        f"SELECT {CANCEL_COLUMNS} FROM canc"),
    "cancellations_simple": query(
        [*ctes(["reservation", "flat_affiliate"]),
         SIMPLE_CANC.format(unit="COALESCE(r.dest_id, r.hotel_id)", where="f.distribution IN ('US', 'DE')")],
        f"SELECT {CANCEL_COLUMNS} FROM canc"),
    "agg_stats": query([*TWO_SIDED, wide_sums(summary("joined")), TWO_CANC], agg_stats()),
    "agg_stats_placement": query(
        [*PLACEMENT, wide_sums(summary("joined", SUMS + " length_of_stay")), PLACE_CANC.format(unit="r.hotel_id", where="TRUE")],
        agg_stats("length_of_stay")),
    "agg_stats_simple": query(
        [*ctes(["performance", "reservation", "flat_affiliate"]), SIMPLE_ROWS, wide_sums(summary("simple")),
         SIMPLE_CANC.format(unit="COALESCE(r.dest_id, r.hotel_id)", where="TRUE")],
        agg_stats(zero_sided=True)),
    "agg_stats_campaign": query(
        [*ctes(["report", "reservation", "affiliate", "device_class", "country", "campaign"]), CAMPAIGN_ROWS,
         wide_sums(summary("campaigned")), LABELLED, CAMPAIGN_CANC],
        agg_stats()),
    "label_fields": query([*ctes(["reservation"]), TOKENS, ENTRIES], """
        SELECT r.id, cid, ucc, placement, x.hotel_id FROM reservation r LEFT JOIN (
            SELECT id, arg_max(value, i) FILTER (key = 'cid') AS cid, arg_max(value, i) FILTER (key = 'ucc') AS ucc,
                   arg_max(value, i) FILTER (key = 'placement') AS placement,
                   arg_max(value, i) FILTER (key = 'hotel_id') AS hotel_id
            FROM entries GROUP BY id) x ON x.id = r.id"""),
    "affiliate_fields": query(ctes(["reservation", "affiliate"]), """
        SELECT NULLIF(split_part(split_part(name, '.', 1), '_', 2), '') AS cc,
               CASE split_part(name, '.', 2) WHEN 'LU' THEN 'localuniversal' WHEN 'MR' THEN 'mapresults' END AS placement,
               CASE split_part(name, '.', 3) WHEN 'PC' THEN 'desktop' WHEN 'Mobile' THEN 'mobile' WHEN 'Tablet' THEN 'tablet' END
                   AS device, COUNT(*) AS n
        FROM reservation r JOIN affiliate a ON a.id = r.affiliate_id GROUP BY ALL"""),
    "cuped_adjusted": cuped(),
    "cuped_unit_level": cuped_unit_level(),
    "pre_rmse": query(dashboard(True), f"""
        SELECT logic AS comparison, {r('SQRT(AVG(POW(y - x, 2)))')} AS rmse FROM pairs WHERE phase = 'pre' GROUP BY logic"""),
    "pre_stationarity": pre_stationarity(),
    "welch_pvalue": welch_pvalue(),
    "did_pvalue": query([*dashboard(True), *DID, f"tested AS (SELECT *, {t_tail('(estimate / std_error)', 'df')} AS p_value FROM did)"], f"""
        SELECT comparison, {rounded('estimate std_error')}, df, {r('estimate / std_error')} AS t_value, {rounded('p_value')},
            p_value < 0.05 AS significant FROM tested"""),
    "welch_ttest": welch("comparison, logic", False),
    "welch_by_dimension": welch("part, comparison, logic", True),
    "did": query([*dashboard(False), *DID], f"""
        SELECT comparison, {rounded('estimate std_error')}, df, {r('estimate / std_error')} AS t_value FROM did"""),
    "counterfactual_effect": counterfactual("0"),
    "counterfactual_weekly": counterfactual("isodow(date)"),
    "counterfactual_summary": counterfactual_summary(),
    "reldiff_descriptives": query(dashboard(False), f"""
        SELECT logic, comparison, {r('AVG(x / y) * 100')} AS rel_diff FROM pairs GROUP BY ALL"""),
    "abs_diff_descriptives": query(dashboard(False), f"""
        SELECT logic, comparison, {r('(AVG(y) - AVG(x)) * 100')} AS absolute_difference FROM pairs GROUP BY ALL"""),
}
