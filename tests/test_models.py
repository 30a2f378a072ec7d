"""Models over hand-made records, with the expected rows spelt out."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from spendlake import Settings
from spendlake.plans import core, finops, raw, staging
from tests import fixtures as fx

SETTINGS = Settings(as_of=date(2024, 3, 10), reporting_currency="EUR")


class Built:
    def __init__(self, spark):
        rc = raw.raw_customers(fx.customers(spark))
        rp = raw.raw_products(fx.products(spark))
        self.raw_usage = raw.raw_cloud_usage(fx.usage(spark, fx.january_lines()))
        self.customers = staging.stg_customers(rc)
        self.contacts = staging.stg_customer_contacts(rc)
        self.subscriptions = staging.stg_subscriptions(rc, SETTINGS)
        self.accounts = staging.stg_billing_accounts(rc)
        self.products = staging.stg_products(rp)
        self.features = staging.stg_product_features(rp)
        self.tiers = staging.stg_product_pricing_tiers(rp)
        self.usage = staging.stg_cloud_usage(self.raw_usage)
        self.dim_customers = core.dim_customers(
            self.customers, self.subscriptions, self.accounts, self.contacts, SETTINGS
        )
        self.dim_products = core.dim_products(
            self.products, self.features, self.tiers, self.subscriptions
        )
        self.dim_accounts = core.dim_billing_accounts(self.accounts, self.customers, self.usage)
        self.fact = finops.fct_cloud_usage_daily(
            self.usage, self.dim_customers, self.dim_accounts, SETTINGS
        )


@pytest.fixture(scope="module")
def built(spark):
    return Built(spark)


def rows(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


def test_stamp(built):
    row = built.raw_usage.first()
    assert row._source_table == "landing.cloud_usage" and row._loaded_at is not None


def test_customers_count_arrays_and_lower_status(built):
    got = rows(built.customers, "customer_id", "customer_status", "contact_count", "subscription_count", "customer_created_date", "sales_region")
    assert got == {
        "c1": ("active", 3, 6, date(2024, 1, 31), "EMEA"),
        "c2": ("churned", None, None, date(2024, 1, 31), "EMEA"),
        "c3": ("active", 0, 0, None, "EMEA"),
    }


def test_exploding_drops_parents_without_elements(built):
    assert {r.customer_id for r in built.contacts.collect()} == {"c1"}
    assert built.features.count() == 2 and built.tiers.count() == 2


def test_subscription_flags_and_tenure(built):
    got = rows(built.subscriptions, "subscription_id", "is_active", "is_churned", "tenure_months", "arr_usd")
    assert got["s1"] == (False, True, 0, 1200.0)
    assert got["s2"] == (False, True, -1, 84.0)
    assert got["s3"] == (True, False, 10, 240.0)
    assert got["s4"] == (True, False, 2, 42.0)
    assert got["s6"] == (False, False, 1, 12.0)  # churned by status, no end date


def test_products(built):
    got = rows(built.products, "product_id", "supported_providers_list", "supported_provider_count", "feature_count", "pricing_tier_count")
    assert got == {"p1": ("GCP, AWS", 3, 2, 2), "p2": ("", 0, 0, 0), "p3": (None, None, None, None)}


def test_tiers_keep_struct_siblings_and_cast(built):
    got = rows(built.tiers, "tier_name", "pricing_model", "min_monthly_spend_usd", "max_monthly_spend_usd")
    assert got == {"Low": ("percentage", 0.0, 1000.0), "High": ("percentage", 1000.0, None)}


def test_usage_labels_credits_and_ratios(built):
    got = rows(built.usage, "usage_id", "environment", "cost_centre", "label_count", "credit_count", "credit_amount_usd", "effective_cost_usd", "discount_rate")
    assert got["u1"] == ("prod", "cc1", 4, 2, -10.0, 80.0, 0.1)
    assert got["u2"] == (None, None, 0, None, 0.0, 90.0, 0.1)
    assert got["u3"] == (None, None, None, 0, 0.0, 0.0, None)
    assert got["u4"][:2] == ("dev", "unallocated")
    assert got["u6"][5] == -110.0


def test_credits_and_labels_rows(built):
    credits = staging.stg_cloud_usage_credits(built.raw_usage)
    got = rows(credits, "credit_id", "usage_id", "credit_amount_usd", "credit_abs_amount_usd", "usage_month")
    month = date(2024, 1, 1)
    assert got["k1"] == ("u1", -10.0, 10.0, month) and got["k2"] == ("u1", None, None, month)
    labels = staging.stg_cloud_usage_labels(built.raw_usage)
    assert labels.where("usage_id = 'u4' AND label_key = 'env'").count() == 2
    assert labels.where("usage_id IN ('u2', 'u3')").count() == 0


def test_dim_customers(built):
    got = rows(built.dim_customers, "customer_id", "primary_contact_name", "primary_contact_email",
               "subscription_count", "active_subscription_count", "active_mrr_usd", "cloud_providers",
               "is_multicloud", "billing_account_count", "customer_tenure_months", "first_account_activated_on")
    # Name and e-mail are maxima of their own.
    assert got["c1"] == ("Zoe", "z@example.com", 6, 2, 23.5, "AWS, GCP", True, 3, 2, date(2023, 5, 1))
    assert got["c2"] == (None, None, 0, 0, 0.0, None, False, 0, 2, None)
    assert got["c3"][8] is None


def test_dim_products(built):
    got = rows(built.dim_products, "product_id", "feature_count", "ga_feature_count", "retired_feature_count",
               "min_rate_pct", "max_addressable_monthly_spend_usd", "customer_count", "subscription_count", "active_mrr_usd")
    assert got["p1"] == (2, 1, 1, 1.5, 1000.0, 1, 3, 0.0)
    assert got["p2"] == (0, 0, 0, None, None, 1, 2, 23.5)
    assert got["p3"] == (0, 0, 0, None, None, 0, 0, 0.0)


def test_dim_accounts_without_usage_have_zeros(built):
    got = rows(built.dim_accounts, "billing_account_id", "usage_line_count", "lifetime_effective_cost_usd", "first_usage_date")
    # Usage of an unknown customer on a known account counts here.
    assert got["b1"] == (4, 260.0, date(2024, 1, 5))
    assert got["b2"] == (1, -110.0, date(2024, 2, 3))
    assert got["b3"] == (0, 0.0, None)


def test_fct_subscriptions(built):
    fact = core.fct_subscriptions(built.subscriptions, built.customers, built.products)
    got = rows(fact, "subscription_id", "mrr_per_seat_usd", "product_name")
    assert "s6" not in got  # unknown product
    assert got["s4"] == (None, "Second") and got["s1"] == (10.0, "First")


def test_fact_drops_unknown_customers_and_keeps_unknown_accounts(built):
    got = rows(built.fact, "usage_id", "billing_currency", "reporting_currency")
    assert set(got) == {"u1", "u2", "u3", "u4", "u6"}
    assert got["u4"] == (None, "EUR") and got["u6"] == ("EUR", "EUR")


def test_daily(built):
    daily = finops.agg_customer_daily_spend(built.fact)
    got = rows(daily, "customer_provider_day_key", "usage_line_count", "effective_cost_usd",
               "effective_cost_7d_avg_usd", "prev_day_effective_cost_usd", "day_over_day_change_usd",
               "day_over_day_change_pct", "spend_vs_7d_avg_ratio")
    assert got["c1|GCP|2024-01-05"] == (1, 80.0, 80.0, None, None, None, 1.0)
    assert got["c1|GCP|2024-01-06"] == (2, 90.0, 85.0, 80.0, 10.0, 90 / 80 - 1, 90 / 85)
    assert got["c1|AWS|2024-02-03"] == (1, -110.0, -110.0, None, None, None, None)


def test_trailing_average_counts_rows_not_days(spark):
    customers = staging.stg_customers(raw.raw_customers(fx.customers(spark)))
    accounts = staging.stg_billing_accounts(raw.raw_customers(fx.customers(spark)))
    lines = [fx.line(f"u{i}", date(2024, 1, 1 + 3 * i), cost=(0.0, 0.0, float(i), "USD")) for i in range(9)]
    usage = staging.stg_cloud_usage(raw.raw_cloud_usage(fx.usage(spark, lines)))
    fact = finops.fct_cloud_usage_daily(usage, customers, accounts)
    daily = finops.agg_customer_daily_spend(fact)
    got = rows(daily, "usage_date", "effective_cost_7d_avg_usd")
    assert got[date(2024, 1, 25)] == ((2 + 3 + 4 + 5 + 6 + 7 + 8) / 7,)


def test_monthly(built):
    monthly = finops.agg_customer_monthly_spend(built.fact, built.subscriptions, SETTINGS)
    got = rows(monthly, "customer_month_key", "active_days", "billing_account_count", "service_count",
               "effective_cost_usd", "avg_daily_effective_cost_usd", "flexsave_eligible_cost_usd",
               "subscription_mrr_usd", "live_subscription_count", "revenue_to_spend_ratio")
    # January: s1, s3, s4, s5.  February: s3, s4, s5 (ends on the 1st), s6; never s2.
    assert got["c1|2024-01-01"] == (3, 2, 2, 260.0, 260 / 3, 260.0, 163.5, 4, 163.5 / 260)
    assert got["c1|2024-02-01"] == (1, 1, 1, -110.0, -110.0, -110.0, 64.5, 4, None)


def test_service_rank_is_deterministic_on_ties(spark, built):
    services = finops.agg_service_monthly_spend(built.fact)
    january = {r.service_id: r for r in services.where("usage_month = '2024-01-01'").collect()}
    assert (january["svc1"].service_cost_rank, january["svc2"].service_cost_rank) == (1, 2)
    assert january["svc1"].customer_month_effective_cost_usd == 260.0
    assert january["svc1"].share_of_customer_month_spend == 170 / 260
    ties = [fx.line(f"t{i}", date(2024, 1, 1), service=(f"s{i}", "S", "x")) for i in (2, 1, 3)]
    usage = staging.stg_cloud_usage(raw.raw_cloud_usage(fx.usage(spark, ties)))
    fact = finops.fct_cloud_usage_daily(usage, built.customers, built.accounts)
    ranked = rows(finops.agg_service_monthly_spend(fact), "service_id", "service_cost_rank")
    assert ranked == {"s1": (1,), "s2": (2,), "s3": (3,)}


def test_allocation_buckets(built):
    allocation = finops.agg_cost_allocation_monthly(built.fact).where("usage_month = '2024-01-01'")
    got = {(r.environment, r.cost_centre): r for r in allocation.collect()}
    literal = got["dev", "unallocated"]
    assert literal.is_missing_cost_centre and literal.unallocated_cost_usd is None
    missing = got["unallocated", "unallocated"]
    assert missing.unallocated_cost_usd == 90.0 and missing.usage_line_count == 2
    assert missing.customer_month_effective_cost_usd == 260.0
    assert sum(r.share_of_customer_month_spend for r in got.values()) == pytest.approx(1.0)
    february = finops.agg_cost_allocation_monthly(built.fact).where("usage_month = '2024-02-01'").first()
    assert february.share_of_customer_month_spend is None


def test_column_order_of_the_fact(built):
    assert built.fact.columns[:5] == ["usage_id", "usage_date", "usage_month", "usage_day_name", "is_weekend"]
    assert len(built.fact.columns) == 44 and built.fact.columns[-1] == "reporting_currency"
    assert built.fact.where(F.col("is_weekend")).count() == 3
