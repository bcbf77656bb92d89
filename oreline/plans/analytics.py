"""The star schema as frames, and the customer-profitability queries over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.scores import risk_adjusted
from oreline.operators.ranking import top_k_by_rank


@dataclass(frozen=True)
class Star:
    """``fact`` holds sk_customer, sk_product, sk_date, amount; the dimensions are keyed
    by the same names.  ``sk_date`` is YYYYMMDD."""

    fact: DataFrame
    customer: DataFrame
    product: DataFrame
    date: DataFrame


RANKED_ATTRIBUTES = ("id_type", "id_number", "full_name", "city", "risk_flag", "risk_amount")


def facts_of_year(star: Star, year: int) -> DataFrame:
    """Facts whose day the calendar files under ``year``.

    The key range follows from the key's form; it reaches the scan, so files and
    row groups of other years are skipped.  A year has at most 366 calendar rows.
    """
    low, high = year * 10000 + 101, year * 10000 + 1231
    fact = star.fact.where(F.col("sk_date").between(low, high))
    if "month_key" in fact.columns:
        fact = fact.where(F.col("month_key").between(year * 100 + 1, year * 100 + 12))
    days = star.date.where(F.col("year") == year).select("sk_date").where(
        F.col("sk_date").between(low, high)
    )
    return fact.join(F.broadcast(days), "sk_date")


def product_volumes(facts: DataFrame, star: Star, owner: Column) -> DataFrame:
    """Count, sum and average per owner and product.

    Facts are reduced to surrogate keys and measures first; what a hot customer
    leaves is one row per product.
    """
    return (
        facts.groupBy(owner, "sk_product")
        .agg(
            F.count("*").alias("n"),
            F.sum("amount").alias("total"),
            F.avg("amount").alias("mean"),
        )
        .join(star.product.select("sk_product"), "sk_product")
    )


def customer_metrics(volumes: DataFrame, owner: str) -> DataFrame:
    """Second level: input is unique per product, so a plain count is the distinct one."""
    return volumes.groupBy(owner).agg(
        F.count("sk_product").alias("num_products"),
        F.sum("n").alias("total_transactions"),
        F.sum("total").alias("total_amount"),
        F.avg("mean").alias("average_ticket"),
    )


def profitability_ranking(star: Star, year: int, k: int = 100) -> DataFrame:
    """The k most profitable customers of a year, risk-reported ones discounted.

    Only versions that are active now are ranked; facts keyed to an older version
    of a customer do not count.
    """
    volumes = product_volumes(facts_of_year(star, year), star, F.col("sk_customer"))
    active = star.customer.where(F.col("is_active"))
    scored = customer_metrics(volumes, "sk_customer").join(
        active.select("sk_customer", "risk_flag"), "sk_customer"
    )
    return _ranked(scored, "sk_customer", active, k)


def profitability_by_natural_key(star: Star, year: int, k: int = 100) -> DataFrame:
    """The same ranking over all versions of a customer.

    Facts are summed per version before the versions are mapped to their customer.
    """
    per_version = (
        facts_of_year(star, year)
        .groupBy("sk_customer", "sk_product")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    )
    active = star.customer.where(F.col("is_active"))
    owners = star.customer.select("sk_customer", "id_type", "id_number").join(
        active.select("id_type", "id_number", F.col("sk_customer").alias("sk_owner")),
        ["id_type", "id_number"],
    )
    total = F.sum("total").cast("decimal(28,2)")
    volumes = (
        per_version.join(owners.select("sk_customer", "sk_owner"), "sk_customer")
        .join(star.product.select("sk_product"), "sk_product")
        .groupBy("sk_owner", "sk_product")
        .agg(
            F.sum("n").alias("n"),
            total.alias("total"),
            (total / F.sum("n")).cast("decimal(22,6)").alias("mean"),
        )
    )
    scored = customer_metrics(volumes, "sk_owner").join(
        active.select(F.col("sk_customer").alias("sk_owner"), "risk_flag"), "sk_owner"
    )
    return _ranked(scored, "sk_owner", active, k)


def _ranked(scored: DataFrame, owner: str, active: DataFrame, k: int) -> DataFrame:
    """Rank on keys and measures; names and addresses join only the winners."""
    total = F.col("total_amount").cast("decimal(38,2)")
    narrow = scored.select(
        owner,
        "num_products",
        "total_transactions",
        total.alias("total_amount"),
        F.col("average_ticket").cast("decimal(26,10)").alias("average_ticket"),
        risk_adjusted(total.cast("decimal(34,2)"), F.col("risk_flag"))
        .cast("decimal(38,3)")
        .alias("score"),
    )
    winners = top_k_by_rank(narrow, "score", k, "ranking")
    details = active.select(F.col("sk_customer").alias(owner), *RANKED_ATTRIBUTES)
    return (
        winners.join(details, owner)
        .select(
            "ranking",
            "id_type",
            "id_number",
            "full_name",
            "city",
            "num_products",
            "total_transactions",
            "total_amount",
            "average_ticket",
            "score",
            "risk_flag",
            "risk_amount",
        )
        .orderBy("ranking", "id_type", "id_number")
    )


def star_rollup(star: Star) -> DataFrame:
    """Volume by year, city and product type.

    Facts are first summed per customer, product and year; the joins that follow
    never meet more rows than that, however hot a customer is.
    """
    per_year = (
        star.fact.join(star.date.select("sk_date", "year"), "sk_date")
        .groupBy("sk_customer", "sk_product", "year")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    )
    return (
        per_year.join(star.product.select("sk_product", "product_type"), "sk_product")
        .join(star.customer.select("sk_customer", "city"), "sk_customer")
        .groupBy("year", "city", "product_type")
        .agg(
            F.sum("n").alias("num_transactions"),
            F.sum("total").cast("decimal(38,2)").alias("total_amount"),
        )
    )
