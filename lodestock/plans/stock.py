"""What to do about repairable stock below its maximum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import positive_part
from ..operators.joins import lookup, per_key_totals

# Labels of the report.
IN_HOUSE = "In House Repair"
NO_ACTION = "0-No Action"
RELEASE_REPAIR = "1-Release Repair PO"
RETURN_USED = "2-Facilitate NRR Returns"
MOVE_EXCESS = "3-Initiate Excess Transfer"
BUY_NEW = "4-Release New Buy PO"
ASK_COST = "5-Require CostRep Disposition (NB/Algo/Backorder)"
NOT_AGING = "NotAging(<7days)"
AGING = "Aging"
BOTH_AGES = "AGING and NOT_AGING"

AGING_DAYS = 14
BACKORDER_DAYS = 8
COST_LIMIT = 2000


def open_returns(stock: DataFrame, returns: DataFrame, as_of: Column, keys: dict[str, str]) -> DataFrame:
    """Stock with open returns above and below the age limit.

    A return exactly at the limit counts in neither.
    """
    age = F.datediff(as_of, "returned_on")
    totals = {
        "nrr_aging": F.sum(F.when(age > AGING_DAYS, F.col("return_qty"))),
        "nrr_not_aging": F.sum(F.when(age < AGING_DAYS, F.col("return_qty"))),
    }
    return per_key_totals(stock, returns, keys, totals).fillna(0, ["nrr_aging", "nrr_not_aging"])


def dispositions(stock: DataFrame, excess: DataFrame, as_of: Column, key: str = "item") -> DataFrame:
    """Supply, demand, missing quantities and disposition codes per stock row.

    Input columns: ``avail_qty``, ``max_qty``, ``open_po_qty``,
    ``open_order_qty``, ``reject_qty``, ``nrr_aging``, ``nrr_not_aging``,
    ``category``, ``new_price``, ``oldest_order``; ``excess`` has the key and
    ``excess_qty``.  Only rows with missing stock remain.
    """
    zero = lambda c: F.coalesce(c, F.lit(0))
    df = stock.withColumns(
        {
            "supply": zero("avail_qty") + zero("open_po_qty"),
            "demand": zero("max_qty") + zero("open_order_qty"),
        }
    )
    df = df.withColumn("missing_qty", F.col("demand") - F.col("supply")).filter("missing_qty > 0")
    df = lookup(df, excess, {key: key}, {"excess_qty": "excess_qty"}).fillna(0, ["excess_qty"])

    gap = F.col("demand") - F.col("supply") - F.col("reject_qty")
    used = F.col("nrr_aging") + F.col("nrr_not_aging")
    in_house = F.coalesce(F.col("category").contains(IN_HOUSE), F.lit(False))
    df = df.withColumns(
        {
            "backorder_age": F.when((F.col("open_order_qty") == 0) | F.col("oldest_order").isNull(), "")
            .when(F.datediff(as_of, "oldest_order") < BACKORDER_DAYS, NOT_AGING)
            .otherwise(AGING),
            "in_house": F.when(in_house, IN_HOUSE).otherwise(""),
            "nrr_age": F.when((F.col("nrr_aging") != 0) & (F.col("nrr_not_aging") != 0), BOTH_AGES)
            .when(F.col("nrr_aging") != 0, AGING)
            .when(F.col("nrr_not_aging") != 0, NOT_AGING)
            .otherwise(""),
            "nrr_qty": used,
            "missing_after_reject": positive_part(gap),
            "missing_after_nrr": positive_part(gap - used),
            "missing_after_excess": positive_part(gap - used - F.col("excess_qty")),
        }
    )
    df = df.withColumn("missing_amount", F.col("new_price") * F.col("missing_after_excess"))

    idle = in_house & (F.col("open_order_qty") == 0)
    still = ~idle & (F.col("missing_after_excess") > 0)
    amount = F.col("missing_amount")
    label = lambda rule, text: F.when(rule, text).otherwise("")
    # An amount of exactly the limit gets neither of the last two codes.
    codes = {
        "d0": label(idle, NO_ACTION),
        "d1": label(~idle & (F.col("reject_qty") > 0), RELEASE_REPAIR),
        "d2": label(~idle & (F.col("missing_after_reject") > 0) & (F.col("nrr_qty") > 0), RETURN_USED),
        "d3": label(~idle & (F.col("missing_after_nrr") > 0) & (F.col("excess_qty") > 0), MOVE_EXCESS),
        "d4": label(still & (amount > 0) & (amount < COST_LIMIT) & ~in_house, BUY_NEW),
        "d5": label(still & (amount > COST_LIMIT), ASK_COST),
    }
    df = df.withColumns(codes)
    later = [F.when(F.col(d) != "", F.concat(F.lit(";"), F.col(d))).otherwise("") for d in ("d2", "d3", "d4", "d5")]
    return df.withColumns(
        {
            "disposition": F.when(F.col("d0") != "", F.col("d0")).otherwise(F.concat("d1", *later)),
            "final_missing_qty": F.when(F.col("d0") != "", F.col("missing_after_excess")).otherwise(0),
        }
    )
