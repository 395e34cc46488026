import datetime as dt

import pytest
from pyspark.sql import functions as F

from splitlab.functions import labels
from splitlab.operators import accounts

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
LABEL_CASES = {
    "link-coreus-hotel-12_xqdz_cid-3": {"hotel_id": "12", "cid": "3"},
    "cid-1_cid-2_ucc-gb": {"cid": "2", "ucc": "gb"},
    "x_gha-MapResults-y_a-b-localuniversal": {"placement": "localuniversal"},
    "mapresults_placement-own": {"placement": "own"},
    "a-Hotel-7": {"hotel_id": None},
    "hotel-5": {"hotel": "5"},
    "a-hotel-7-hotel-8_cid-": {"hotel_id": "7-", "cid": ""},
    "": {},
    None: None,
}


def test_label_map(spark):
    df = spark.createDataFrame([(k,) for k in LABEL_CASES], "label string")
    rows = df.select("label", labels.label_map(F.col("label")).alias("m"), labels.label_value(F.col("label"), "cid").alias("c"))
    for row in rows.collect():
        want = LABEL_CASES[row.label]
        assert row.m == want, row.label
        assert row.c == (want or {}).get("cid")


def test_label_unit_locale_device(spark):
    cases = [
        ("link-coregb-hotel-12_xqdz_a", "n", 12, "GB", "web"), ("linkmob-corejp-hotel-9_xqdz", "n", 9, "JP", "mobile"),
        ("link_xqdz", "x_Core.Mobile", 77, "US", "mobile"), ("link-core-hotel-99999999999_xqdz", "n", 77, "US", "web"),
        (None, None, 77, "US", "web"), ("x-hotel-abc_xqdz", "n", 77, "US", "web"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "label string, name string")
    got = df.select(
        labels.unit_of(F.col("label"), F.lit(77)).alias("u"), labels.locale_of(F.col("label")).alias("l"),
        labels.device_of(F.col("label"), F.col("name")).alias("d"),
    ).collect()
    assert [tuple(r) for r in got] == [c[2:] for c in cases]


def test_affiliate_names(spark):
    cases = {
        "x_US.LU.PC": ("US", "localuniversal", "desktop"), "x_GB.MR.Tablet": ("GB", "mapresults", "tablet"),
        "x_A_B.XX.Mobile.z": ("A", None, "mobile"), "plain": (None, None, None), "": (None, None, None), None: (None, None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    kinds = ("cc", "placement", "device", "other")
    rows = df.select("name", *[labels.affiliate_info(F.col("name"), k).alias(k) for k in kinds]).collect()
    assert all((r.cc, r.placement, r.device) == cases[r.name] and r.other is None for r in rows)
    parts = df.select(labels.name_part(F.col("name"), 1).alias("p")).where("name = 'plain'").first()
    assert parts.p == ""


RESERVATION = "id string, hotel_id int, created timestamp, date_cancelled date, affiliate_id int, label string, " \
    "commission_amount_euro double, roomnights int, status string, booker_cc1 string, dest_id int, partner_id int"


def booking(i, hotel, day, amount, status="ok", cancelled=None, affiliate=1, label=None, cc=None, dest=None):
    at = dt.datetime(day.year, day.month, day.day, 23, 59, 59) if day else None
    return (str(i), hotel, at, cancelled, affiliate, label, amount, 2, status, cc, dest, 5)


def performance(spark, rows):
    schema = "hotel_id int, yyyy_mm_dd date, pos string, clicks int, nits_bookings double, bookings int, " \
        "commission_expected_euro double, commission_amount_euro double, cost_euro double, roomnights int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def two_sided(spark):
    cost = "hotel_id int, yyyy_mm_dd date, locale string, clicks_core int, clicks_bob int, cost_core double, cost_bob double"
    web = spark.createDataFrame([(1, D1, "US", 3, None, 1.5, None), (None, D1, "US", 9, 9, 9.0, 9.0)], cost)
    mobile = spark.createDataFrame([(1, D2, "US", None, 2, None, 0.5)], cost)
    reservations = spark.createDataFrame([
        booking(1, 1, D1, 10.0), booking(2, 2, D2, 50.0), booking(3, 2, D2, 50.01), booking(4, 2, D2, 1.0, "fraudulent"),
        booking(5, 2, D2, 1.0, affiliate=2), booking(6, 2, dt.date(2023, 12, 31), 1.0),
        booking(7, 2, None, 4.0, cancelled=D2), booking(8, 3, None, 6.0, cancelled=D2),
    ], RESERVATION)
    affiliates = spark.createDataFrame([(1, "a_core.x", 9), (2, "a_Core.x", 8)], "id int, name string, partner_id int")
    preferred = spark.createDataFrame([(1, 0.5, D1), (2, 0.1, dt.date(2023, 1, 1))], "hotelreservation_id long, prediction double, created_date date")
    fallback = spark.createDataFrame(
        [("1", 0.9, dt.datetime(2024, 1, 1, 5)), ("2", 0.2, dt.datetime(2024, 1, 2, 23))],
        "hotelreservation_id string, nits_score double, mysql_row_created_at timestamp",
    )

    def build(**options):
        return accounts.TwoSidedAccount(
            "2024-01-01", "2024-01-02", max_rpb=50.0, partner_id=9, web_costs_table=web, mobile_costs_table=mobile,
            reservation_table=reservations, affiliate_table=affiliates, nits_score_table=preferred,
            nits_postbook_table=fallback, **options,
        )

    return build


def by_key(df):
    return {(r.hotel_id, r.yyyy_mm_dd): r for r in df.collect()}


def test_two_sided_report_and_null_profit(two_sided):
    rows = by_key(two_sided().get_stats_summary())
    assert set(rows) == {(1, D1), (1, D2), (2, D2)}
    both, cost_only, revenue_only = rows[1, D1], rows[1, D2], rows[2, D2]
    assert (both.nits_bookings, both.nits_commission, both.nits_profit) == (0.5, 5.0, 3.5)
    assert cost_only.nits_profit is None and cost_only.cost == 0.5 and cost_only.clicks == 2
    assert revenue_only.gross_profit is None and revenue_only.nits_commission == pytest.approx(40.0)
    assert by_key(two_sided(null_as_zero=True).get_stats_summary())[1, D2].nits_profit == -0.5


def test_agg_stats_fill_and_as_booked(two_sided):
    rows = by_key(two_sided().get_agg_stats())
    assert set(rows) == {(1, D1), (1, D2), (2, D2), (3, D2)}
    assert rows[2, D2].asbooked_commission == 46.0 and rows[1, D1].asbooked_commission == 0
    assert rows[3, D2].cancelled_commission == 6.0 and rows[3, D2].asbooked_commission == 0
    zero = by_key(two_sided(null_as_zero=True).get_agg_stats())
    assert zero[1, D1].asbooked_commission == 10.0 and zero[3, D2].asbooked_commission == -6.0


def test_reports_by_other_keys(two_sided):
    rows = two_sided(agg_on=["yyyy_mm_dd", "device"]).get_agg_stats().collect()
    assert {(r.yyyy_mm_dd, r.device) for r in rows} == {(D1, "web"), (D2, "web"), (D2, "mobile")}
    assert len(two_sided().get_cost_and_revenue().collect()) == 3


def test_cap_is_excluded_in_the_placement_account(spark, two_sided):
    sources = two_sided().sources
    costs = spark.createDataFrame(
        [(D1, 3, 1, "USDMeta", 2.0, 1), (D1, None, 1, "USDMeta", 2.0, 1), (D1, 3, 1, None, 2.0, 1), (D1, 3, 1, "odd", 4.0, 1)],
        "date date, hour int, partnerpropertyid int, siloname string, cost_eur double, length_of_stay int",
    )
    names = spark.createDataFrame([(1, "US.DMeta.x", 9)], "id int, name string, partner_id int")
    shared = {k: sources[k] for k in ("reservation_table", "nits_score_table", "nits_postbook_table")}

    def build(**options):
        return accounts.PlacementAccount(
            "2024-01-01", "2024-01-02", max_rpb=50.0, partner_id=9, costs_table=costs, affiliate_table=names, **shared, **options
        )

    rows = by_key(build().get_stats_summary())
    assert set(rows) == {(1, D1)} and rows[1, D1].clicks == 2 and rows[1, D1].cost == 6.0
    assert by_key(build(strict_silo=True).get_stats_summary())[1, D1].cost == 2.0
    assert by_key(build(pos="US").get_stats_summary())[1, D1].cost == 2.0
    assert build(pos=["GB"]).get_cancellations().count() == 0
    assert build(pos=["US"]).get_cancellations().count() == 2


def test_simple_account(spark):
    rows = [(1, D1, "US", 1, 1.0, 1, 5.0, 6.0, 2.0, 1), (1, D1, "GB", 0, 1.0, 1, 5.0, 6.0, 2.0, 1), (1, D1, "GB", 1, 1.0, 1, 50.5, 6.0, 2.0, 1)]
    cancelled = [booking(1, 1, None, 3.0, cancelled=D1, dest=8), booking(2, 1, None, 3.0, cancelled=D2)]
    flat = spark.createDataFrame([(1, "US")], "affiliate_id int, distribution string")
    account = accounts.SimpleAccount(
        D1, D2, pos=["US", "US", "GB"], max_rpb=50.0, partner_id=5, performance_table=performance(spark, rows),
        reservation_table=spark.createDataFrame(cancelled, RESERVATION), affiliate_table=flat,
    )
    report = by_key(account.get_stats_summary())
    assert len(report) == 1 and report[1, D1].gross_profit == 4.0 and report[1, D1].clicks == 1
    assert set(by_key(account.get_cancellations())) == {(8, D1)}
    assert account.get_metrics(accounts.METRICS).columns == ["hotel_id", "yyyy_mm_dd", *accounts.METRICS]


def test_campaign_of_cancellations(spark):
    cases = [
        ("cid-4", "x_US.LU.PC", "gb", 4), ("ucc-GB", "x_US.LU.PC", None, 1), ("none", "x_US.LU.PC", "gb", 0),
        ("none", "plain", "gb", 1), ("none", "plain", "zz", 66), (None, "plain", None, 66), ("cid-zz_ucc-GB", "plain", None, 66),
    ]
    rows = [booking(i, 1, None, 1.0, cancelled=D1, affiliate=i, label=c[0], cc=c[2]) for i, c in enumerate(cases)]
    names = [(i, c[1], 9) for i, c in enumerate(cases)]
    account = accounts.CampaignAccount(
        D1, D2, partner_id=9, reservation_table=spark.createDataFrame(rows, RESERVATION),
        affiliate_table=spark.createDataFrame(names, "id int, name string, partner_id int"),
        device_classes=spark.createDataFrame([(str(i),) for i in range(len(cases))], "hotelreservation_id string"),
        country_campaigns=spark.createDataFrame([("US", 0), ("GB", 1)], "cc string, cid int"),
        campaign_table=spark.createDataFrame([(0, "US"), (1, "GB"), (4, "FR")], "campaign_id int, pos string"),
    )
    got = {int(r.id): r.campaign_id for r in account.labelled_cancellations().collect()}
    assert [got[i] for i in range(len(cases))] == [c[3] for c in cases]
    assert account.get_cancellations().first().cancellations == 4


def test_null_unit_groups_do_not_meet(spark, two_sided):
    """As in a full join, a missing unit of one side does not match a missing unit of the other."""
    merged = accounts.outer_merge([
        spark.createDataFrame([(None, 1.0), (None, 2.0)], "hotel_id int, a double"),
        spark.createDataFrame([(None, 5.0)], "hotel_id int, b double"),
    ], ["hotel_id"])
    assert sorted((r.a or 0, r.b or 0) for r in merged.collect()) == [(0, 5.0), (3.0, 0)]


def test_facts_are_not_dealt_by_affiliate(two_sided, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = two_sided().get_cancellations()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [affiliate_id" in plan and "hashpartitioning(affiliate_id" not in plan
