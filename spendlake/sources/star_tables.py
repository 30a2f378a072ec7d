"""Star-schema tables (customer, part, orders, lineitem, events..) in the shape of the exports.

Every nested array is built from the columns of its own row, so no step gathers a group: a
customer, order or part that holds a large share of the rows costs nothing extra here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROVIDERS = ("GCP", "AWS", "Azure")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    """Concatenation where plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _day(first: str, offset: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), offset.cast("int"))


def _numbered(count: Column, element: Callable[[Column], Column]) -> Column:
    """Array of element(1) .. element(count); ``count`` is at most 3."""
    numbers = F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda k: k <= count)
    return F.transform(numbers, element)


def _present(*candidates: tuple[Column, Column]) -> Column:
    """Array of the elements whose condition holds, in the order given."""
    parts = [F.when(condition, F.array(element)) for condition, element in candidates]
    return F.concat(*[F.coalesce(part, F.array()) for part in parts])


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Nested customer records, with 0 to 3 contacts, subscriptions and accounts each."""
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = read_table(spark, folder, "customer")
    df = customer.join(places, customer.c_nationkey == places.n_nationkey)
    key = F.col("c_custkey")
    customer_id = _text("cus_", key)
    nation_key = F.col("n_nationkey")

    def contact(k: Column) -> Column:
        return F.struct(
            _text("ct_", key, "_", k).alias("contact_id"),
            _text("Contact ", k, " of ", F.col("c_name")).alias("full_name"),
            _text("contact", k, ".", key, "@example.com").alias("email"),
            F.when(k == 1, "Billing").otherwise("Technical").alias("role"),
            ((k == 1) | (key % 7 == 0)).alias("is_primary"),
        )

    def subscription(k: Column) -> Column:
        start = _day("1995-01-15", (key * 31 + k * 97) % 1500)
        has_ended = (key + k) % 3 == 0
        return F.struct(
            _text("sub_", key, "_", k).alias("subscription_id"),
            _text(
                "prd_",
                F.when(k == 1, key)
                .when(k == 2, F.floor(key / 2).cast("long"))
                .otherwise(key + F.floor(key / 2).cast("long")),
            ).alias("product_id"),
            _text("Tier ", k).alias("tier"),
            start.alias("start_date"),
            F.when(has_ended, F.date_add(start, ((key * 17) % 800).cast("int") - 20)).alias(
                "end_date"
            ),
            ((key * k) % 50).cast("long").alias("seats"),
            ((key % 90) * 2.5 + 100.0).alias("mrr_usd"),
            F.when(k % 2 == 1, "monthly").otherwise("annual").alias("billing_frequency"),
            F.when(has_ended, "CHURNED").otherwise("Active").alias("status"),
        )

    def account(k: Column) -> Column:
        return F.struct(
            _text("ba_", key, "_", k).alias("billing_account_id"),
            F.when((key + k) % 3 == 0, PROVIDERS[0])
            .when((key + k) % 3 == 1, PROVIDERS[1])
            .otherwise(PROVIDERS[2])
            .alias("cloud_provider"),
            F.when(nation_key % 3 == 0, "USD")
            .when(nation_key % 3 == 1, "EUR")
            .otherwise("GBP")
            .alias("currency"),
            F.when(k == 1, "NET30").otherwise("NET45").alias("payment_terms"),
            (key % 2 == 0).alias("is_reseller_account"),
            _day("1994-06-01", (key * 13 + k * 50) % 600).alias("activated_on"),
        )

    return df.select(
        customer_id.alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(key % 5 == 0, "Churned").otherwise("Active").alias("status"),
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "Enterprise")
        .when(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD"), "Mid-Market")
        .otherwise("Startup")
        .alias("segment"),
        F.col("c_mktsegment").alias("industry"),
        _day("1994-01-01", key % 700).cast("timestamp").alias("created_at"),
        F.struct(
            _text(key, " Main Street").alias("street"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("country"),
            _text("N", nation_key).alias("country_code"),
            F.col("r_name").alias("region"),
        ).alias("address"),
        F.struct(
            _text("emp_", nation_key).alias("employee_id"),
            _text("Manager ", nation_key).alias("name"),
            _text("manager", nation_key, "@example.com").alias("email"),
            F.col("r_name").alias("region"),
        ).alias("account_manager"),
        F.when(key % 11 != 0, _numbered(key % 3, contact)).alias("contacts"),
        _numbered(key % 4, subscription).alias("subscriptions"),
        _numbered((key + 1) % 4, account).alias("billing_accounts"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Nested catalogue records, with 0 to 3 features and 0 to 2 pricing tiers each."""
    key = F.col("p_partkey")

    def feature(k: Column) -> Column:
        return F.struct(
            _text("f", k).alias("feature_code"),
            _text("Feature ", k).alias("feature_name"),
            F.when((key + k) % 3 == 0, "GA")
            .when((key + k) % 3 == 1, "PREVIEW")
            .otherwise("RETIRED")
            .alias("availability"),
            _text("Tier ", k).alias("min_tier"),
        )

    def tier(k: Column) -> Column:
        return F.struct(
            _text("Tier ", k).alias("tier_name"),
            ((k - 1) * 1000).cast("long").alias("min_monthly_spend_usd"),
            F.when(k < 2, (k * 1000).cast("long")).alias("max_monthly_spend_usd"),
            (F.lit(3.0) - k * 0.5).alias("rate_pct"),
            F.when(k == 1, "standard").otherwise("premium").alias("included_support"),
        )

    providers = F.array(*[F.lit(p) for p in PROVIDERS])
    return read_table(spark, folder, "part").select(
        _text("prd_", key).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_family"),
        _text(F.col("p_brand"), " ", F.col("p_name")).alias("description"),
        _day("1993-01-01", key % 900).alias("launch_date"),
        (F.col("p_size") % 2 == 0).alias("is_active"),
        F.slice(providers, F.lit(1), F.col("p_size") % 4).alias("supported_providers"),
        _numbered(key % 4, feature).alias("features"),
        F.struct(
            F.when(F.col("p_size") % 3 == 0, "percentage_of_spend")
            .otherwise("flat_monthly")
            .alias("model"),
            F.lit("USD").alias("currency"),
            F.col("p_retailprice").alias("base_fee_usd"),
            _numbered(key % 3, tier).alias("tiers"),
        ).alias("pricing"),
    )


def cloud_usage(spark: SparkSession, folder: str) -> DataFrame:
    """Nested usage lines: a line item with the customer of its order and the SKU of its part."""
    lineitem = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders")
    part = read_table(spark, folder, "part")
    # Orders grow with their lines, so the two are merged at every size, and the lines, still
    # narrow, then lie in as many tasks as a shuffle has, however few files they came from.
    df = lineitem.join(orders.hint("merge"), lineitem.l_orderkey == orders.o_orderkey).join(
        part, lineitem.l_partkey == part.p_partkey
    )
    order, supplier = F.col("l_orderkey"), F.col("l_suppkey")
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    usage_id = _text("usg_", order, "_", line, "_", F.col("l_partkey"), "_", supplier)
    discount = price * F.col("l_discount")
    eligible = F.col("l_linestatus") == "O"

    def credit(kind: str, number: str, amount: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("credit_type"),
            _text(usage_id, "-", number).alias("credit_id"),
            amount.alias("amount_usd"),
        )

    credits = _present(
        (line % 3 == 0, credit("committed_use_discount", "1", price * -0.02)),
        (
            F.col("l_returnflag") == "R",
            credit("promotional_credit", "2", F.col("l_quantity") * -0.5),
        ),
        (F.col("l_tax") >= 0.07, credit("reseller_discount", "3", price * -0.01)),
    )

    def label(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    status = F.col("o_orderstatus")
    environment = F.when(status == "F", "prod").when(status == "O", "dev").otherwise("staging")
    always = F.array(
        label("env", environment),
        label("team", _text("team-", F.substring("o_orderpriority", 1, 1))),
    )
    sometimes = _present(
        (order % 10 < 7, label("cost_centre", _text("cc-", supplier % 8))),
        (order % 20 < 7, label("app", _text("app-", F.col("l_partkey") % 12))),
    )
    day = F.to_date("l_shipdate")
    return df.select(
        usage_id.alias("usage_id"),
        day.alias("usage_date"),
        F.date_add(day, 1).cast("timestamp").alias("export_time"),
        _text("cus_", F.col("o_custkey")).alias("customer_id"),
        _text("ba_", F.col("o_custkey"), "_", line % 3 + 1).alias("billing_account_id"),
        F.when(F.col("l_returnflag") == "A", PROVIDERS[1])
        .when(F.col("l_returnflag") == "R", PROVIDERS[2])
        .otherwise(PROVIDERS[0])
        .alias("cloud_provider"),
        F.struct(
            _text("prj_", supplier).alias("project_id"),
            _text("Project ", supplier).alias("project_name"),
        ).alias("project"),
        F.struct(
            _text("svc_", F.lower("p_type")).alias("service_id"),
            F.col("p_type").alias("service_name"),
            F.col("p_brand").alias("service_category"),
        ).alias("service"),
        F.struct(
            _text("sku_", F.col("l_partkey")).alias("sku_id"),
            F.col("p_name").alias("sku_description"),
            F.lit("unit").alias("pricing_unit"),
            F.col("p_retailprice").alias("list_unit_price_usd"),
        ).alias("sku"),
        F.struct(
            _text("region-", supplier % 5).alias("region"),
            _text("region-", supplier % 5, "-", line % 3).alias("zone"),
        ).alias("location"),
        F.struct(F.col("l_quantity").alias("quantity"), F.lit("unit").alias("unit")).alias("usage"),
        F.struct(
            price.alias("list_cost_usd"),
            discount.alias("discount_usd"),
            (price - discount).alias("net_cost_usd"),
            F.lit("USD").alias("currency"),
        ).alias("cost"),
        F.struct(
            eligible.alias("flexsave_eligible"),
            F.when(eligible, price * 0.03).otherwise(0.0).alias("flexsave_savings_usd"),
            (price * F.col("l_tax")).alias("optimisation_savings_usd"),
        ).alias("savings"),
        F.when(line != 7, credits).alias("credits"),
        F.concat(always, sometimes).alias("labels"),
    )


def event_usage(spark: SparkSession, folder: str) -> DataFrame:
    """Nested usage lines from the event stream: a short window of days, no join."""
    kind, value = F.col("event_type"), F.col("value")
    no_credits = "array<struct<credit_type: string, credit_id: string, amount_usd: double>>"
    usage_id = _text("evt_", F.col("event_id"))
    day = F.to_date("ts")
    credit = F.array(
        F.struct(
            F.lit("promotional_credit").alias("credit_type"),
            _text(usage_id, "-1").alias("credit_id"),
            (value * -0.25).alias("amount_usd"),
        )
    )
    return read_table(spark, folder, "events").select(
        usage_id.alias("usage_id"),
        day.alias("usage_date"),
        F.col("ts").cast("timestamp").alias("export_time"),
        _text("cus_", F.col("user_id")).alias("customer_id"),
        _text("ba_", F.col("user_id"), "_1").alias("billing_account_id"),
        F.when(F.col("user_id") % 3 == 0, PROVIDERS[0])
        .when(F.col("user_id") % 3 == 1, PROVIDERS[1])
        .otherwise(PROVIDERS[2])
        .alias("cloud_provider"),
        F.struct(
            _text("prj_", F.col("user_id") % 10).alias("project_id"),
            _text("Project ", F.col("user_id") % 10).alias("project_name"),
        ).alias("project"),
        F.struct(
            _text("svc_", kind).alias("service_id"),
            kind.alias("service_name"),
            F.lit("events").alias("service_category"),
        ).alias("service"),
        F.struct(
            _text("sku_", kind).alias("sku_id"),
            kind.alias("sku_description"),
            F.lit("event").alias("pricing_unit"),
            F.lit(1.0).alias("list_unit_price_usd"),
        ).alias("sku"),
        F.struct(F.lit("region-0").alias("region"), F.lit("region-0-0").alias("zone")).alias("location"),
        F.struct(F.lit(1.0).alias("quantity"), F.lit("event").alias("unit")).alias("usage"),
        F.struct(
            value.alias("list_cost_usd"),
            F.lit(0.0).alias("discount_usd"),
            value.alias("net_cost_usd"),
            F.lit("USD").alias("currency"),
        ).alias("cost"),
        F.struct(
            F.lit(False).alias("flexsave_eligible"),
            F.lit(0.0).alias("flexsave_savings_usd"),
            F.lit(0.0).alias("optimisation_savings_usd"),
        ).alias("savings"),
        F.when(kind == "purchase", credit).otherwise(F.array().cast(no_credits)).alias("credits"),
        F.array(F.struct(F.lit("env").alias("key"), kind.alias("value"))).alias("labels"),
    )
