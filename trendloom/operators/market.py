"""Market prices and the contribution growth table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trendloom.functions.scores import percent_change

# Fixed values of the price card.
PRICE_FORMAT = "#,##0.################"
CHANGE_FORMAT = "0.00"
MONTHS = 12


def ticker_changes(tickers: DataFrame) -> DataFrame:
    """Change of every stored price against its previous close, in percent."""
    return tickers.select(
        "ticker_symbol",
        "current_price",
        "prev_close_price",
        percent_change("current_price", "prev_close_price").alias("change_pct"),
    )


def price_cards(prices: DataFrame) -> DataFrame:
    """Upper-case name, trend, price with thousands separators, two-place change.

    The trend is ``up`` for a positive change, else ``down``; a missing change gives nulls.
    """
    change = F.col("usd_24h_change")
    return prices.select(
        F.upper("coin").alias("name"),
        F.when(change > 0, F.lit("up")).when(change.isNotNull(), F.lit("down")).alias("trend"),
        F.concat(F.lit("$"), F.call_function("format_number", F.col("usd"), F.lit(PRICE_FORMAT))).alias("price"),
        F.concat(F.call_function("format_number", change, F.lit(CHANGE_FORMAT)), F.lit("%")).alias("change"),
    )


def growth_schedule(plans: DataFrame) -> DataFrame:
    """One row per plan and year: paid in so far, interest of the year, total, two places.

    Each year adds twelve payments and then multiplies by ``1 + rate / 100``.
    """
    yearly = (F.col("monthly") * MONTHS).cast("double")
    factor = F.col("rate_pct") / 100.0 + 1.0
    start = F.array().cast("array<struct<before:double,total:double>>")

    def add_year(acc, _):
        paid = F.coalesce(F.get(acc, F.size(acc) - 1)["total"], F.lit(0.0)) + yearly
        return F.array_append(acc, F.struct(paid.alias("before"), (paid * factor).alias("total")))

    years = F.aggregate(F.sequence(F.lit(1), F.col("years")), start, add_year)
    return (
        plans.filter(F.col("years") >= 1)
        .select("plan_id", "monthly", F.posexplode(years).alias("pos", "y"))
        .select(
            "plan_id",
            (F.col("pos") + 1).alias("year"),
            (F.col("monthly") * MONTHS * (F.col("pos") + 1)).cast("long").alias("invested"),
            F.round(F.col("y.total") - F.col("y.before"), 2).alias("interest"),
            F.round("y.total", 2).alias("total"),
        )
    )
