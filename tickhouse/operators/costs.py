"""Billing lines to a cost snapshot, and a cost snapshot to the public cost section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions.numbers import money
from tickhouse.functions.times import epoch_or_iso_text, lenient_instant
from tickhouse.schemas import DAILY_COST_TEXT, SERVICE_COST_TEXT

# Ten digits of head room: sums stay decimal(38,9) without losing the ninth decimal.
LINE_MONEY = "decimal(28,9)"
TOTAL_MONEY = "decimal(38,9)"
CURRENCY = r"^[A-Z]{3}$"
SERVICE_NAME = r"^[A-Za-z0-9 .&()+/_-]{1,96}$"
SNAPSHOT_FIELDS = (
    "aggregated_at_utc", "source_exported_at_utc", "currency", "seven_day_net_cost",
    "month_to_date_net_cost", "daily_costs", "top_services",
)


def lookback_start(day: Column) -> Column:
    """The earlier of six days before ``day`` and the first of its month."""
    return F.least(F.date_sub(day, 6), F.trunc(day, "MM"))


def flat_lines(billing: DataFrame) -> DataFrame:
    """Exported billing rows with plain columns."""
    return billing.select(
        "usage_start_time",
        F.col("service.description").alias("service_name"),
        F.col("project.id").alias("project_id"),
        "currency",
        "cost",
        "credits",
        "export_time",
    )


def net_cost(cost: Column, credits: Column) -> Column:
    zero = F.lit(0).cast(LINE_MONEY)
    credit = F.aggregate(
        F.coalesce(credits, F.array()),
        zero,
        lambda total, c: (total + F.coalesce(c["amount"].cast(LINE_MONEY), zero)).cast(LINE_MONEY),
    )
    return (cost.cast(LINE_MONEY) + credit).cast(LINE_MONEY)


def lines_in_lookback(lines: DataFrame, day: Column, project: str | None = None) -> DataFrame:
    """Lines the snapshot needs: from the look-back bound through ``day`` itself.

    Both bounds are on the stored timestamp, so the scan can prune. The upper one changes nothing
    for today and keeps a snapshot of a past day from counting later usage.
    """
    kind = lines.schema["usage_start_time"].dataType
    used = F.col("usage_start_time")
    kept = lines.filter(used >= lookback_start(day).cast(kind)).filter(
        used < F.date_add(day, 1).cast(kind)
    )
    if project is not None:
        kept = kept.filter(F.col("project_id") == project)
    return kept.withColumn("usage_day", F.to_date("usage_start_time")).withColumn(
        "net_cost", net_cost(F.col("cost"), F.col("credits"))
    )


def daily_costs(lines: DataFrame, day: Column) -> DataFrame:
    return (
        lines.filter(F.col("usage_day") >= F.date_sub(day, 6))
        .groupBy("usage_day", "currency")
        .agg(F.sum("net_cost").cast(TOTAL_MONEY).alias("net_cost"))
    )


def monthly_services(lines: DataFrame, day: Column) -> DataFrame:
    return (
        lines.filter(F.col("usage_day") >= F.trunc(day, "MM"))
        .groupBy("service_name", "currency")
        .agg(F.sum("net_cost").cast(TOTAL_MONEY).alias("net_cost"))
    )


def cost_snapshot(lines: DataFrame, as_of: Column, project: str | None = None) -> DataFrame:
    """One row with totals, daily costs and the three dearest services of the month.

    The lines are scanned and shuffled once: each is folded into per-day and per-service subtotals
    map-side, and both the totals and the top-three read that one small exchange.
    """
    day = F.to_date(as_of)
    recent = lines_in_lookback(lines, day, project)
    in_week = F.col("usage_day") >= F.date_sub(day, 6)
    in_month = F.col("usage_day") >= F.trunc(day, "MM")
    facts = recent.groupBy("usage_day", "service_name", "currency").agg(
        F.sum("net_cost").cast(TOTAL_MONEY).alias("net_cost"),
        F.max("export_time").alias("exported_at"),
    )
    cells = F.array(
        F.struct(F.lit("day").alias("part"), F.date_format("usage_day", "yyyy-MM-dd").alias("label"),
                 in_week.alias("counted")),
        F.struct(F.lit("service").alias("part"), F.col("service_name").alias("label"),
                 in_month.alias("counted")),
    )
    subtotals = (
        facts.select("currency", "net_cost", "exported_at", F.explode(cells).alias("cell"))
        .groupBy("cell.part", "cell.label", "currency")
        .agg(
            F.sum(F.when(F.col("cell.counted"), F.col("net_cost"))).cast(TOTAL_MONEY).alias("net_cost"),
            F.max("exported_at").alias("exported_at"),
        )
    )
    counted = F.col("net_cost").isNotNull()
    is_day, is_service = F.col("part") == "day", F.col("part") == "service"
    zero = F.lit(0).cast(TOTAL_MONEY)

    def total(which: Column) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col("net_cost"))), zero).cast(TOTAL_MONEY)

    day_item = F.struct(F.col("label").alias("day_utc"), "net_cost", "currency")
    totals = subtotals.agg(
        F.max("exported_at").alias("source_exported_at"),
        F.min("currency").alias("currency"),
        F.size(F.collect_set("currency")).alias("currency_count"),
        total(is_day).alias("seven_day_net_cost"),
        total(is_service).alias("month_to_date_net_cost"),
        F.array_sort(F.collect_list(F.when(is_day & counted, day_item))).alias("_days"),
    )
    # No filter on the part here: it would be pushed below the exchange and stop its reuse.
    ranked = subtotals.orderBy(
        (is_service & counted).desc(), F.col("net_cost").desc(), F.col("label"), F.col("currency"),
        F.col("exported_at"),
    ).limit(3)
    service_item = F.struct(
        (-F.col("net_cost")).alias("dearest_first"), F.col("label").alias("service_name"),
        "net_cost", "exported_at",
    )
    top = ranked.agg(
        F.array_sort(F.collect_list(F.when(is_service & counted, service_item))).alias("_services")
    )
    # Two one-row aggregates side by side: each column has a value in at most one of the rows.
    both = totals.unionByName(top, allowMissingColumns=True)
    one = both.agg(*[F.first(name, ignorenulls=True).alias(name) for name in both.columns])
    return one.select(
        as_of.alias("aggregated_at"),
        "source_exported_at",
        "currency",
        "currency_count",
        "seven_day_net_cost",
        "month_to_date_net_cost",
        F.transform("_days", lambda d: F.struct(d["day_utc"], d["net_cost"])).alias("daily_costs"),
        F.transform("_services", lambda s: F.struct(s["service_name"], s["net_cost"])).alias(
            "top_services"
        ),
    )


# ---- public section ------------------------------------------------------------------------


def clean_daily(items: Column) -> Column:
    """Last seven readable days in day order; equal days keep their input order."""
    numbered = F.transform(items, lambda item, i: F.struct(
        item["day_utc"].alias("day_utc"), i.alias("i"), money(item["net_cost"]).alias("net_cost")
    ))
    good = F.filter(numbered, lambda item: lenient_instant(item["day_utc"]).isNotNull()
                    & item["net_cost"].isNotNull())
    ordered = F.array_sort(good)
    # slice(-7) of a shorter array is empty, hence the guard.
    tail = F.when(F.size(ordered) > 7, F.slice(ordered, -7, 7)).otherwise(ordered)
    return F.coalesce(
        F.transform(tail, lambda item: F.struct(item["day_utc"], item["net_cost"])), F.array()
    )


def clean_services(items: Column) -> Column:
    """The first three entries, then only those with a plain name and a readable cost."""
    priced = F.transform(F.slice(items, 1, 3), lambda item: F.struct(
        item["service_name"].alias("service_name"), money(item["net_cost"]).alias("net_cost")
    ))
    return F.coalesce(
        F.filter(priced, lambda item: item["service_name"].rlike(SERVICE_NAME)
                 & item["net_cost"].isNotNull()),
        F.array(),
    )


def cost_on(items: Column, day_text: Column) -> Column:
    """Net cost of the first item of that day, or null."""
    return F.get(F.filter(items, lambda item: item["day_utc"] == day_text), F.lit(0))["net_cost"]


def cost_section(snapshots: DataFrame, now: Column, reason: Column | None = None) -> DataFrame:
    """Public cost section of text snapshots, one row in, one row out.

    A row whose ``currency, aggregated_at_utc…`` columns are all null was never read: ``reason``
    says why. A row that was read but is unusable becomes ``invalid_snapshot``.
    """
    absent = F.lit(True)
    for name in SNAPSHOT_FIELDS:
        absent = absent & F.col(name).isNull()
    aggregated = epoch_or_iso_text(F.col("aggregated_at_utc"))
    week, month = money(F.col("seven_day_net_cost")), money(F.col("month_to_date_net_cost"))
    bad = ~(
        F.coalesce(F.col("currency").rlike(CURRENCY), F.lit(False))
        & aggregated.isNotNull() & week.isNotNull() & month.isNotNull()
    )
    problem = F.when(absent, F.lit("not_configured") if reason is None else reason).when(
        bad, "invalid_snapshot"
    )
    days = clean_daily(F.col("daily_costs"))
    shown = {
        "currency": F.col("currency"),
        "aggregated_at_utc": aggregated,
        "source_exported_at_utc": epoch_or_iso_text(F.col("source_exported_at_utc")),
        "today_net_cost": cost_on(days, F.date_format(now, "yyyy-MM-dd")),
        "seven_day_net_cost": week,
        "month_to_date_net_cost": month,
    }
    lists = {"daily_costs": days, "top_services": clean_services(F.col("top_services"))}
    others = [c for c in snapshots.columns if c not in SNAPSHOT_FIELDS]
    checked = snapshots.withColumn("_problem", problem)
    fine = F.col("_problem").isNull()
    return checked.select(
        *others,
        F.when(fine, "available").otherwise("unavailable").alias("status"),
        F.col("_problem").alias("reason"),
        *[F.when(fine, value).alias(name) for name, value in shown.items()],
        *[F.when(fine, value).otherwise(F.array()).alias(name) for name, value in lists.items()],
    )


def decode_row_payload(payload: Column) -> Column:
    """Snapshot struct from the repeated ``f``/``v`` row encoding; null when the shape is wrong.

    Exactly one row, seven cells in snapshot order, and two cells in each repeated record.
    """
    cells = "f array<struct<v string>>"
    row = F.from_json(payload, f"rows array<struct<{cells}>>")["rows"]
    values = F.get(row, F.lit(0))["f"]
    repeated = f"array<struct<v struct<{cells}>>>"

    def pairs(cell: Column, names: tuple[str, str]) -> tuple[Column, Column]:
        records = F.from_json(cell, repeated)
        shape = F.coalesce(
            F.forall(records, lambda r: F.coalesce(F.size(r["v"]["f"]) == 2, F.lit(False))),
            F.lit(False),
        )
        items = F.transform(records, lambda r: F.struct(*[
            F.get(r["v"]["f"], F.lit(i))["v"].alias(name) for i, name in enumerate(names)
        ]))
        return shape, items

    def cell(i: int) -> Column:
        return F.get(values, F.lit(i))["v"]

    days_ok, days = pairs(cell(5), tuple(DAILY_COST_TEXT.elementType.names))
    services_ok, services = pairs(cell(6), tuple(SERVICE_COST_TEXT.elementType.names))
    good = (F.size(row) == 1) & (F.size(values) == len(SNAPSHOT_FIELDS)) & days_ok & services_ok
    return F.when(good, F.struct(
        *[cell(i).alias(name) for i, name in enumerate(SNAPSHOT_FIELDS[:5])],
        days.alias("daily_costs"),
        services.alias("top_services"),
    ))
