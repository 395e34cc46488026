"""Input tables of the workload, derived from the ``events`` table.

Each definition is plain SQL that Spark and DuckDB read alike, so the queries and their oracles
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Whole range of the data; the experiment starts half way.
RUN_DATE, PERIOD = "2024-01-31", 30
START, END = "2024-01-01", "2024-01-30"
EXPERIMENT_START = "2024-01-16"
PARTNERS = {"campaign": 101, "two_sided": 102, "placement": 103, "simple": 100}
CAP = 150.0

CLICKS = "event_type IN ('click', 'view')"
BOOKED = "event_type = 'purchase'"
KEPT = "(1 - CAST(k AS DOUBLE) / 100)"

_MEASURES = f"""
    SUM(CASE WHEN {BOOKED} THEN 1 ELSE 0 END) AS bookings,
    SUM(CASE WHEN {BOOKED} THEN {KEPT} ELSE 0 END) AS nits_bookings,
    SUM(CASE WHEN {BOOKED} THEN value ELSE 0 END) AS commission,
    SUM(CASE WHEN {BOOKED} THEN value * {KEPT} ELSE 0 END) AS nits_commission,
    SUM(CASE WHEN {CLICKS} THEN value / 10 ELSE 0 END) AS cost,
    SUM(CASE WHEN {CLICKS} THEN 1 ELSE 0 END) AS clicks,
    SUM(CASE WHEN {BOOKED} THEN 1 + k % 5 ELSE 0 END) AS roomnights
"""


def _device_cost(device: str) -> str:
    return f"""
        SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS hotel_id, day AS yyyy_mm_dd, locale,
               CASE WHEN event_type = 'click' THEN 1 END AS clicks_core,
               CASE WHEN event_type = 'view' THEN 1 END AS clicks_bob,
               CASE WHEN event_type = 'click' THEN value / 10 END AS cost_core,
               CASE WHEN event_type = 'view' THEN value / 10 END AS cost_bob
        FROM ev WHERE {CLICKS} AND device = '{device}'"""


VIEWS = {
    "ev": """
        SELECT event_id, user_id, ts, day, event_type, value, k,
               CASE k % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'JP' ELSE 'DE' END AS locale,
               CASE WHEN event_id % 3 = 0 THEN 'mobile' ELSE 'web' END AS device
        FROM (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day, event_type, value,
                     CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT) AS k FROM events) e""",
    "web_cost": _device_cost("web"),
    "mobile_cost": _device_cost("mobile"),
    "click_cost": f"""
        SELECT day AS date, CASE WHEN event_id % 31 = 0 THEN NULL ELSE hour(ts) END AS hour,
               user_id AS partnerpropertyid,
               CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 50 = 1 THEN 'other'
                    ELSE concat(locale, CASE WHEN device = 'mobile' THEN 'Mobile' ELSE 'DMeta' END) END AS siloname,
               value / 10 AS cost_eur, k % 7 AS length_of_stay
        FROM ev WHERE {CLICKS}""",
    "reservation": """
        SELECT CAST(event_id AS STRING) AS id, user_id AS hotel_id, user_id % 7 AS hotel_ufi,
               CASE WHEN event_type = 'purchase' THEN ts ELSE ts - INTERVAL '40' DAY END AS created,
               CASE WHEN event_type = 'error' THEN day END AS date_cancelled,
               event_id % 10 AS affiliate_id,
               CASE WHEN event_id % 53 = 0 THEN NULL
                    WHEN event_id % 7 = 0 THEN concat('link_xqdz_cid-', CAST(k % 6 AS STRING))
                    ELSE concat('link', CASE WHEN device = 'mobile' THEN 'mob' ELSE '' END, '-core', lower(locale),
                                '-hotel-', CAST(user_id AS STRING), '_xqdz',
                                CASE event_id % 4 WHEN 0 THEN concat('_ucc-', locale) WHEN 1 THEN ''
                                                  ELSE concat('_cid-9_cid-', CAST(k % 8 AS STRING)) END,
                                CASE event_id % 5 WHEN 0 THEN '_gha-MapResults-x' WHEN 1 THEN '_a-localuniversal-b'
                                                  ELSE '' END) END AS label,
               value AS commission_amount_euro, 1 + k % 5 AS roomnights,
               CASE WHEN event_id % 17 = 0 THEN 'fraudulent' WHEN event_id % 19 = 0 THEN 'test' ELSE 'ok' END AS status,
               CASE k % 3 WHEN 0 THEN lower(locale) WHEN 1 THEN 'zz' END AS booker_cc1,
               CASE WHEN event_id % 4 = 0 THEN user_id + 1 END AS dest_id,
               100 + event_id % 3 AS partner_id
        FROM ev WHERE event_type IN ('purchase', 'error')""",
    "affiliate": """
        SELECT id, name, partner_id FROM (VALUES
            (0, 'US.DMeta.x', 103), (1, 'GB.Mobile.x', 103), (2, 'a_Core.PC', 102), (3, 'b_core.Mobile', 102),
            (4, 'x_US.LU.PC', 101), (5, 'x_GB.MR.Tablet', 101), (6, 'x_JP.XX.Mobile', 101), (7, 'malformed', 101),
            (8, 'JP.DMeta.y', 103), (9, 'c_Core.Mobile.z', 102)) AS t(id, name, partner_id)""",
    "flat_affiliate": """
        SELECT id AS affiliate_id, CASE id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'JP' ELSE 'DE' END
               AS distribution FROM affiliate""",
    "score": f"""
        SELECT event_id AS hotelreservation_id, CAST(k AS DOUBLE) / 100 AS prediction, day AS created_date
        FROM ev WHERE {BOOKED} AND k % 2 = 0""",
    "postbook": f"""
        SELECT CAST(event_id AS STRING) AS hotelreservation_id, CAST(k AS DOUBLE) / 200 AS nits_score,
               ts AS mysql_row_created_at
        FROM ev WHERE {BOOKED} AND k % 3 = 0""",
    "device_class": """
        SELECT CAST(event_id AS STRING) AS hotelreservation_id, device AS device_class
        FROM ev WHERE event_type = 'error' AND event_id % 13 <> 0""",
    "campaign": """
        SELECT campaign_id, pos FROM (VALUES (0, 'US'), (1, 'GB'), (2, 'JP'), (3, 'DE'), (4, 'FR'), (5, 'IT'),
            (66, 'ROW')) AS t(campaign_id, pos)""",
    "country": """
        SELECT cc, cid FROM (VALUES ('US', 0), ('GB', 1), ('JP', 2), ('DE', 3)) AS t(cc, cid)""",
    "performance": f"""
        SELECT hotel_id, yyyy_mm_dd, pos, clicks, nits_bookings, bookings, nits_commission AS commission_expected_euro,
               commission AS commission_amount_euro, cost AS cost_euro, roomnights
        FROM (SELECT user_id AS hotel_id, day AS yyyy_mm_dd, locale AS pos, {_MEASURES} FROM ev
              GROUP BY user_id, day, locale) p""",
    "report": f"""
        SELECT campaign_id, hotel_id, yyyy_mm_dd, bookings, nits_bookings, commission, nits_commission,
               nits_commission - cost AS nits_profit, cost, clicks, roomnights
        FROM (SELECT k % 8 AS campaign_id, user_id AS hotel_id, day AS yyyy_mm_dd, {_MEASURES} FROM ev
              GROUP BY k % 8, user_id, day) p""",
}

# Views that a view reads.
NEEDS = {name: ["ev"] for name in VIEWS} | {"ev": [], "flat_affiliate": ["affiliate"]}
NEEDS |= {name: [] for name in ("affiliate", "campaign", "country")}


def with_needs(names: list[str]) -> list[str]:
    """The named views and those they read, in order of definition."""
    wanted = set(names) | {n for name in names for n in NEEDS[name]}
    return [name for name in VIEWS if name in wanted]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view of the workload as a frame; nothing is registered in the session."""
    frames = {"events": load(spark, sf_dir, "events")}
    for n in with_needs([name]):
        reads = [*NEEDS[n], "events"] if n == "ev" else NEEDS[n]
        text = VIEWS[n].replace("{", "{{").replace("}", "}}")
        for r in reads:
            text = text.replace(f"FROM {r}", f"FROM {{{r}}}")
        frames[n] = spark.sql(text, **{r: frames[r] for r in reads})
    return frames[name]


def ctes(names: list[str]) -> list[str]:
    """The same views as SQL common table expressions."""
    return [f"{name} AS ({VIEWS[name].strip()})" for name in with_needs(names)]
