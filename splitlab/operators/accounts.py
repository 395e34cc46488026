"""Unit-day performance reports of advertising accounts, from their raw tables.

Every report is one stack of measure rows (cost, revenue, cancellations) and one grouped sum on
the report keys. That equals grouping the sources apart and outer-joining them, at one shuffle,
and partial sums absorb a unit or source that holds much of the data. The only row-level joins
are those with dimension tables and with the scores of single reservations.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from splitlab.functions import labels
from splitlab.functions.dates import in_days, in_days_ts
from splitlab.operators.metrics import outer_merge
from splitlab.plans.session import broadcast_if_small

UNIT, DAY = "hotel_id", "yyyy_mm_dd"
# Reservation states that are left out, and the campaign of last resort.
BAD_STATUS = ["fraudulent", "test", "unknown"]
DEFAULT_CAMPAIGN = 66

PERFORMANCE = ["nits_bookings", "nits_commission", "gross_bookings", "gross_commission", "cost", "clicks", "roomnights"]
CANCELLED = ["cancellations", "cancelled_commission", "cancelled_roomnights"]
METRICS = ["nits_bookings", "nits_profit", "gross_bookings", "gross_profit"]


def read_source(source: DataFrame | str) -> DataFrame:
    """A frame as it is, or a catalog table by name."""
    return SparkSession.active().table(source) if isinstance(source, str) else source


def grouped_sums(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def valid_reservations(reservations: DataFrame, cap: float, cap_inclusive: bool) -> DataFrame:
    """Reservations in an accepted state with a commission under the cap."""
    commission = F.col("commission_amount_euro")
    under = commission <= cap if cap_inclusive else commission < cap
    return reservations.where(~F.col("status").isin(BAD_STATUS) & under)


def adjust_for_cancellation(reservations: DataFrame, preferred: DataFrame, fallback: DataFrame) -> DataFrame:
    """Add nits_bookings and nits_commission: the share expected to survive cancellation.

    The expected loss is the preferred prediction, else the fallback score, else 0. The preferred
    scores carry numeric reservation ids. Both joins use the same key and one partitioning.
    """
    key = "hotelreservation_id"
    first = preferred.select(F.col(key).cast("string").alias(key), "nits_pred")
    scored = reservations.join(first, key, "left").join(fallback.select(key, "nits_score"), key, "left")
    kept = 1 - F.coalesce("nits_pred", "nits_score", F.lit(0.0))
    return scored.withColumns({
        "nits_bookings": F.col("gross_bookings") * kept, "nits_commission": F.col("gross_commission") * kept,
    }).drop("nits_pred", "nits_score")


class Account:
    """One account: ``performance_rows`` and ``cancellation_rows`` make all its reports.

    ``null_as_zero`` decides what a profit is when commission or cost is missing, and an
    as-booked value when nothing was cancelled: undefined, so 0 once filled (the default), or
    computed with 0 for the missing side.
    """

    measures = PERFORMANCE
    pos_column = "pos"
    # Bucket weights an experiment on this account uses; None where the caller chooses them.
    weights: Sequence[int] | None = [1] * 10

    def __init__(
        self, start_date: date | str, end_date: date | str, pos: str | Sequence[str] = "All",
        max_rpb: float = 3000.0, partner_id: int | None = None, agg_on: Sequence[str] = (UNIT, DAY),
        null_as_zero: bool = False, **sources: DataFrame | str,
    ):
        self.start_date, self.end_date = start_date, end_date
        self.pos = [pos] if isinstance(pos, str) else list(pos)
        self.max_rpb, self.partner_id = max_rpb, partner_id
        self.agg_on, self.null_as_zero = list(agg_on), null_as_zero
        self.sources = sources

    def source(self, name: str) -> DataFrame:
        return read_source(self.sources[name])

    def performance_rows(self) -> DataFrame:
        raise NotImplementedError

    def cancellation_rows(self) -> DataFrame:
        raise NotImplementedError

    def in_pos(self, rows: DataFrame) -> DataFrame:
        """Rows of the selected points of sale; the list is a filter, so repeats do not multiply."""
        return rows if self.pos == ["All"] else rows.where(F.col(self.pos_column).isin(self.pos))

    def less(self, left: str, right: str) -> Column:
        if self.null_as_zero:
            return F.coalesce(F.col(left), F.lit(0)) - F.coalesce(F.col(right), F.lit(0))
        return F.col(left) - F.col(right)

    def with_profit(self, report: DataFrame) -> DataFrame:
        return report.withColumns({
            "nits_profit": self.less("nits_commission", "cost"), "gross_profit": self.less("gross_commission", "cost"),
        })

    def get_stats_summary(self) -> DataFrame:
        return self.with_profit(grouped_sums(self.in_pos(self.performance_rows()), self.agg_on, self.measures))

    def get_cancellations(self) -> DataFrame:
        return grouped_sums(self.in_pos(self.cancellation_rows()), self.agg_on, CANCELLED)

    def get_agg_stats(self) -> DataFrame:
        """Performance and cancellations side by side, as-booked values, missing values 0."""
        both = outer_merge(
            [
                self.in_pos(self.performance_rows()).select(*self.agg_on, *self.measures),
                self.in_pos(self.cancellation_rows()).select(*self.agg_on, *CANCELLED),
            ],
            self.agg_on,
        )
        report = self.with_profit(both).withColumns({
            "asbooked_commission": self.less("gross_commission", "cancelled_commission"),
            "asbooked_roomnights": self.less("roomnights", "cancelled_roomnights"),
        })
        return report.na.fill(0, subset=[c for c in report.columns if c not in self.agg_on])

    def get_metrics(self, metrics: Sequence[str]) -> DataFrame:
        """(hotel_id, yyyy_mm_dd, metrics): any number of metrics from one run of the report."""
        return self.get_stats_summary().select(UNIT, DAY, *metrics)

    # Parts shared by the accounts that read single reservations.

    def of_partner(self, rows: DataFrame) -> DataFrame:
        """Rows of the account's partner; all rows where it names none."""
        return rows if self.partner_id is None else rows.where(F.col("partner_id") == self.partner_id)

    def affiliates(self, name_pattern: str | None = None) -> DataFrame:
        rows = self.of_partner(self.source("affiliate_table"))
        if name_pattern is not None:
            rows = rows.where(F.col("name").rlike(name_pattern))
        return rows.select(F.col("id").alias("affiliate_id"), F.col("name").alias("affiliate_name"))

    def scores(self) -> tuple[DataFrame, DataFrame]:
        preferred = self.source("nits_score_table").where(in_days(F.col("created_date"), self.start_date, self.end_date))
        fallback = self.source("nits_postbook_table").where(
            in_days_ts(F.col("mysql_row_created_at"), self.start_date, self.end_date)
        )
        return (
            preferred.select("hotelreservation_id", F.col("prediction").alias("nits_pred")),
            fallback.select("hotelreservation_id", "nits_score"),
        )

    def bookings(self, name_pattern: str, cap_inclusive: bool, dimensions: dict[str, Column]) -> DataFrame:
        """Valid reservations made in the window under matching affiliates, with ``dimensions``."""
        made = self.source("reservation_table").where(in_days_ts(F.col("created"), self.start_date, self.end_date))
        valid = valid_reservations(made, self.max_rpb, cap_inclusive)
        return valid.join(broadcast_if_small(self.affiliates(name_pattern)), "affiliate_id").select(
            F.col("id").alias("hotelreservation_id"),
            labels.unit_of(F.col("label"), F.col(UNIT)).alias(UNIT),
            F.to_date("created").alias(DAY),
            *[c.alias(name) for name, c in dimensions.items()],
            F.lit(1).alias("gross_bookings"),
            F.col("commission_amount_euro").alias("gross_commission"),
            "roomnights",
        )

    def cancelled(self, closed: bool = True) -> DataFrame:
        """Reservations cancelled in the window, in an accepted state."""
        rows = self.source("reservation_table").where(
            in_days(F.to_date("date_cancelled"), self.start_date, self.end_date, closed) & ~F.col("status").isin(BAD_STATUS)
        )
        return rows.withColumns({
            DAY: F.to_date("date_cancelled"), "cancellations": F.lit(1),
            "cancelled_commission": F.col("commission_amount_euro"), "cancelled_roomnights": F.col("roomnights"),
        })


class TwoSidedAccount(Account):
    """Costs in one table per device; revenue by locale and device from labels and affiliate names.

    Sources: web_costs_table, mobile_costs_table, reservation_table, affiliate_table,
    nits_score_table, nits_postbook_table. Points of sale are not filtered in this account.
    """

    dimensions = [UNIT, "locale", "device", DAY]

    def __init__(self, *args, devices: Sequence[str] = ("web", "mobile"), **kwargs):
        super().__init__(*args, **kwargs)
        self.devices = devices

    def in_pos(self, rows: DataFrame) -> DataFrame:
        return rows

    def click_rows(self) -> DataFrame:
        def side(source: str, device: str) -> DataFrame:
            rows = self.source(source).where(in_days(F.col(DAY), self.start_date, self.end_date) & F.col(UNIT).isNotNull())
            return rows.select(
                F.col(UNIT).cast("int").alias(UNIT), DAY, "locale", F.lit(device).alias("device"),
                (F.coalesce("clicks_core", F.lit(0)) + F.coalesce("clicks_bob", F.lit(0))).alias("clicks"),
                (F.coalesce("cost_core", F.lit(0.0)) + F.coalesce("cost_bob", F.lit(0.0))).alias("cost"),
            )

        return stack([side("web_costs_table", self.devices[0]), side("mobile_costs_table", self.devices[1])])

    def revenue_rows(self) -> DataFrame:
        booked = self.bookings(labels.NAME_CORE, True, {
            "locale": labels.locale_of(F.col("label")),
            "device": labels.device_of(F.col("label"), F.col("affiliate_name")),
        })
        return adjust_for_cancellation(booked, *self.scores())

    def performance_rows(self) -> DataFrame:
        return stack([self.click_rows(), self.revenue_rows()])

    def get_cost_and_revenue(self) -> DataFrame:
        """Cost outer-joined with revenue on unit, locale, device and day."""
        clicks = self.click_rows().select(*self.dimensions, "clicks", "cost")
        revenue = self.revenue_rows().drop("hotelreservation_id")
        return outer_merge([clicks, revenue], self.dimensions)

    def cancellation_rows(self) -> DataFrame:
        rows = self.cancelled().join(broadcast_if_small(self.affiliates(labels.NAME_CORE)), "affiliate_id")
        return rows.withColumns({
            "locale": labels.locale_of(F.col("label")),
            "device": labels.device_of(F.col("label"), F.col("affiliate_name")),
        })


class PlacementAccount(Account):
    """One cost row per click; distribution and placement from silo and affiliate names.

    Sources: costs_table, reservation_table, affiliate_table, nits_score_table,
    nits_postbook_table. The commission cap itself is excluded. Clicks of any named silo count;
    ``strict_silo`` keeps only silos that name a placement.
    """

    measures = [*PERFORMANCE, "length_of_stay"]
    pos_column = "distribution"
    weights = None

    def __init__(self, *args, placements: Sequence[str] = ("DMeta", "Mobile"), strict_silo: bool = False, **kwargs):
        super().__init__(*args, **kwargs)
        self.placements, self.strict_silo = placements, strict_silo

    @property
    def any_placement(self) -> str:
        return f"({'|'.join(self.placements)})"

    def click_rows(self) -> DataFrame:
        rows = self.source("costs_table").where(
            in_days(F.col("date"), self.start_date, self.end_date) & F.col("hour").isNotNull() & F.col("siloname").isNotNull()
        )
        if self.strict_silo:
            rows = rows.where(F.col("siloname").rlike(self.any_placement))
        pattern = labels.silo_pattern(self.placements)
        return rows.select(
            F.col("partnerpropertyid").cast("int").alias(UNIT), F.col("date").alias(DAY),
            F.regexp_extract("siloname", pattern, 1).alias("distribution"),
            F.regexp_extract("siloname", pattern, 2).alias("placement"),
            F.lit(1).alias("clicks"), F.col("cost_eur").alias("cost"), "length_of_stay",
        )

    def revenue_rows(self) -> DataFrame:
        name = F.col("affiliate_name")
        booked = self.bookings(self.any_placement, False, {
            "distribution": labels.name_part(name, 1), "placement": labels.name_part(name, 2),
        })
        return adjust_for_cancellation(booked, *self.scores())

    def performance_rows(self) -> DataFrame:
        return stack([self.click_rows(), self.revenue_rows()])

    def cancellation_rows(self) -> DataFrame:
        name = F.col("affiliate_name")
        rows = self.cancelled().join(broadcast_if_small(self.affiliates(self.any_placement)), "affiliate_id")
        return rows.withColumns({"distribution": labels.name_part(name, 1), "placement": labels.name_part(name, 2)})


class SimpleAccount(Account):
    """Performance from one pre-joined table. Sources: performance_table, reservation_table,
    affiliate_table (affiliate_id, distribution). The last day has no cancellations."""

    weights = [1] * 20

    def performance_rows(self) -> DataFrame:
        rows = self.source("performance_table").where(
            in_days(F.col(DAY), self.start_date, self.end_date)
            & (F.col("clicks") > 0) & (F.col("commission_expected_euro") <= self.max_rpb)
        )
        return rows.select(
            UNIT, DAY, "pos", "nits_bookings", F.col("commission_expected_euro").alias("nits_commission"),
            F.col("bookings").alias("gross_bookings"), F.col("commission_amount_euro").alias("gross_commission"),
            F.col("cost_euro").alias("cost"), "clicks", "roomnights",
        )

    def cancellation_rows(self) -> DataFrame:
        rows = self.of_partner(self.cancelled(closed=False))
        sales = self.source("affiliate_table").select("affiliate_id", F.col("distribution").alias("pos"))
        return rows.join(broadcast_if_small(sales), "affiliate_id").withColumn(UNIT, F.coalesce("dest_id", UNIT).cast("int"))


class CampaignAccount(Account):
    """Performance from two ready campaign reports; cancellations resolved to campaigns.

    Sources: booking_report and stats_report (campaign_id, hotel_id, yyyy_mm_dd, measures),
    campaign_table (campaign_id, pos), country_campaigns (cc, cid), device_classes
    (hotelreservation_id), reservation_table, affiliate_table.
    """

    def campaigns(self) -> DataFrame:
        rows = self.source("campaign_table").select("campaign_id", "pos")
        return rows if self.pos == ["All"] else rows.where(F.col("pos").isin(self.pos))

    def in_pos(self, rows: DataFrame) -> DataFrame:
        return rows.join(broadcast_if_small(self.campaigns()), "campaign_id")

    def report_rows(self, source: str) -> DataFrame:
        rows = self.source(source).where(in_days(F.col(DAY), self.start_date, self.end_date))
        return rows.withColumnsRenamed({"bookings": "gross_bookings", "commission": "gross_commission"})

    def performance_rows(self) -> DataFrame:
        return self.report_rows("stats_report")

    def get_booking_summary_extended(self) -> DataFrame:
        measures = ["gross_bookings", "nits_bookings", "gross_commission", "nits_commission", "roomnights"]
        return grouped_sums(self.in_pos(self.report_rows("booking_report")), self.agg_on, measures)

    def with_campaign_of(self, rows: DataFrame, country: Column, name: str) -> DataFrame:
        """Add the campaign of a country as ``name``."""
        lookup = self.source("country_campaigns").select(F.col("cc").alias("__cc"), F.col("cid").alias(name))
        keyed = rows.withColumn("__country", country)
        joined = keyed.join(broadcast_if_small(lookup), F.col("__country") == F.col("__cc"), "left")
        return joined.drop("__country", "__cc")

    def labelled_cancellations(self) -> DataFrame:
        """Cancelled reservations with their campaign: from the label, else the affiliate's
        country, else the booker's country, else the campaign of last resort."""
        devices = self.source("device_classes").select(F.col("hotelreservation_id").alias("id"))
        affiliates = broadcast_if_small(
            self.affiliates().select("affiliate_id", labels.affiliate_info(F.col("affiliate_name"), "cc").alias("aff_cc"))
        )
        rows = self.cancelled().join(affiliates, "affiliate_id").join(devices, "id")
        cid = labels.label_value(F.col("label"), "cid")
        rows = self.with_campaign_of(rows, labels.label_value(F.col("label"), "ucc"), "ucc_cid")
        rows = self.with_campaign_of(rows, F.col("aff_cc"), "aff_cid")
        rows = self.with_campaign_of(rows, F.upper("booker_cc1"), "booker_cid")
        label_cid = F.when(cid.isNotNull(), labels.int_or_null(cid)).otherwise(F.col("ucc_cid"))
        return rows.withColumn(
            "campaign_id", F.coalesce(label_cid, "aff_cid", "booker_cid", F.lit(DEFAULT_CAMPAIGN)).cast("int")
        )

    def cancellation_rows(self) -> DataFrame:
        return self.labelled_cancellations()

    def get_metrics(self, metrics: Sequence[str]) -> DataFrame:
        """Bookings come from the booking report, profits from the stats report."""
        keys = [UNIT, DAY]
        booked = [m for m in metrics if m.endswith("_bookings")]
        earned = [m for m in metrics if m not in booked]
        parts = []
        if booked:
            parts.append(self.get_booking_summary_extended().select(*keys, *booked))
        if earned:
            parts.append(self.get_stats_summary().select(*keys, *earned))
        return outer_merge(parts, keys).select(*keys, *metrics)
