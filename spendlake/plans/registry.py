"""The models in build order, with how each is stored and refreshed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from spendlake.plans import core, finops, raw, staging
from spendlake.settings import Settings
from spendlake.sinks.tables import Layout
from spendlake.sinks.turns import is_turn


@dataclass(frozen=True)
class Refresh:
    """Which input an incremental run narrows, and to what grain.

    ``partition_column`` is what that input is partitioned by, when it is not ``column``: the
    first day of a month bounds the days of the month as well, so both are filtered and the
    scan skips the older partitions.  ``drop_vanished`` empties partitions of the window the batch has no rows for.  It is off
    for the raw model, whose landing may hold only a few days.
    """

    input_name: str
    column: str
    grain: str
    partition_column: str | None = None
    drop_vanished: bool = True


@dataclass(frozen=True)
class State:
    """Totals per partition of one input that a model is merged from, stored beside the model.

    An incremental run makes them anew for the days it reads again, and reads no other day of
    the input; ``build`` of the model takes them in place of the input.
    """

    name: str
    build: Callable[[DataFrame], DataFrame]
    merge: Callable[..., DataFrame]
    layout: Layout
    refresh: Refresh


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    tags: frozenset[str]
    kind: str = "table"  # view, table or incremental
    layout: Layout = field(default_factory=Layout)
    refresh: Refresh | None = None
    takes_settings: bool = False
    state: State | None = None
    #: The input that may be taken some customers after the others: all groups, joins and windows of
    #: the model have the customer among their keys, or join tables that stay whole.
    lines: str | None = None

    def plan(self, inputs: dict[str, DataFrame], settings: Settings) -> DataFrame:
        """``inputs`` may hold the model's state in place of the input it is made from."""
        if self.state and self.state.name in inputs:
            names = [self.state.name if n == self.state.refresh.input_name else n for n in self.inputs]
            return self.state.merge(*[inputs[name] for name in names])
        frames = [inputs[name] for name in self.inputs]
        return self.build(*frames, settings) if self.takes_settings else self.build(*frames)

    def parts(self, inputs: dict[str, DataFrame], settings: Settings) -> list[DataFrame]:
        """The plan, for each share of the customers where it is to run in turns."""
        if self.lines is None or settings.turns == 1:
            return [self.plan(inputs, settings)]
        lines, turns = inputs[self.lines], settings.turns
        shares = [lines.where(is_turn("customer_id", turn, turns)) for turn in range(turns)]
        return [self.plan({**inputs, self.lines: share}, settings) for share in shares]


def _daily(cluster: tuple[str, ...], description: str, comments: dict[str, str]) -> Layout:
    return Layout("usage_date", cluster, description, comments)


def _monthly(cluster: tuple[str, ...], description: str, comments: dict[str, str]) -> Layout:
    return Layout("usage_month", cluster, description, comments)


def _tags(*names: str) -> frozenset[str]:
    return frozenset(names)


MODELS: list[Model] = [
    Model(
        "raw_customers",
        ("customers",),
        raw.raw_customers,
        _tags("raw", "customers"),
        layout=Layout(
            description="Customer records as landed, nested parts kept.",
            column_comments={"customer_id": "Natural key.", "_loaded_at": "When this table was built."},
        ),
        takes_settings=True,
    ),
    Model(
        "raw_products",
        ("products",),
        raw.raw_products,
        _tags("raw", "products"),
        layout=Layout(
            description="Catalogue records as landed, nested parts kept.",
            column_comments={"product_id": "Natural key.", "_loaded_at": "When this table was built."},
        ),
        takes_settings=True,
    ),
    Model(
        "raw_cloud_usage",
        ("cloud_usage",),
        raw.raw_cloud_usage,
        _tags("raw", "cloud_usage", "incremental"),
        kind="incremental",
        layout=_daily(
            ("customer_id", "billing_account_id"),
            "Billing lines as landed; accumulates the days of all loads.",
            {"usage_id": "Natural key of the line.", "credits": "Credits, as negative amounts."},
        ),
        refresh=Refresh("cloud_usage", "usage_date", "day", drop_vanished=False),
        takes_settings=True,
    ),
    Model("stg_customers", ("raw_customers",), staging.stg_customers, _tags("staging", "customers"), "view"),
    Model(
        "stg_customer_contacts",
        ("raw_customers",),
        staging.stg_customer_contacts,
        _tags("staging", "customers"),
        "view",
    ),
    Model(
        "stg_subscriptions",
        ("raw_customers",),
        staging.stg_subscriptions,
        _tags("staging", "subscriptions"),
        "view",
        takes_settings=True,
    ),
    Model(
        "stg_billing_accounts",
        ("raw_customers",),
        staging.stg_billing_accounts,
        _tags("staging", "billing_accounts"),
        "view",
    ),
    Model("stg_products", ("raw_products",), staging.stg_products, _tags("staging", "products"), "view"),
    Model(
        "stg_product_features",
        ("raw_products",),
        staging.stg_product_features,
        _tags("staging", "products"),
        "view",
    ),
    Model(
        "stg_product_pricing_tiers",
        ("raw_products",),
        staging.stg_product_pricing_tiers,
        _tags("staging", "products"),
        "view",
    ),
    Model(
        "stg_cloud_usage",
        ("raw_cloud_usage",),
        staging.stg_cloud_usage,
        _tags("staging", "cloud_usage", "incremental"),
        kind="incremental",
        layout=_daily(
            ("customer_id", "cloud_provider"),
            "One flat row per billing line.",
            {
                "effective_cost_usd": "Net cost plus the (negative) credits.",
                "environment": "Label env, when set.",
            },
        ),
        refresh=Refresh("raw_cloud_usage", "usage_date", "day"),
    ),
    Model(
        "stg_cloud_usage_credits",
        ("raw_cloud_usage",),
        staging.stg_cloud_usage_credits,
        _tags("staging", "cloud_usage", "incremental"),
        kind="incremental",
        layout=_daily(
            ("customer_id", "credit_type"),
            "One row per billing line and credit.",
            {"credit_amount_usd": "Amount taken off the line, negative."},
        ),
        refresh=Refresh("raw_cloud_usage", "usage_date", "day"),
    ),
    Model(
        "stg_cloud_usage_labels",
        ("raw_cloud_usage",),
        staging.stg_cloud_usage_labels,
        _tags("staging", "cloud_usage", "incremental"),
        kind="incremental",
        layout=_daily(
            ("customer_id", "label_key"),
            "One row per billing line and label.",
            {"label_value": "Value as landed."},
        ),
        refresh=Refresh("raw_cloud_usage", "usage_date", "day"),
    ),
    Model(
        "dim_customers",
        ("stg_customers", "stg_subscriptions", "stg_billing_accounts", "stg_customer_contacts"),
        core.dim_customers,
        _tags("marts", "core"),
        layout=Layout(
            description="Customers with revenue and cloud footprint.",
            column_comments={
                "active_mrr_usd": "Monthly revenue of active subscriptions.",
                "is_multicloud": "Accounts with more than one provider.",
            },
        ),
        takes_settings=True,
    ),
    Model(
        "dim_products",
        ("stg_products", "stg_product_features", "stg_product_pricing_tiers", "stg_subscriptions"),
        core.dim_products,
        _tags("marts", "core"),
        layout=Layout(
            description="Products with feature availability, price range and adoption.",
            column_comments={"active_mrr_usd": "Monthly revenue of active subscriptions."},
        ),
    ),
    Model(
        "dim_billing_accounts",
        ("stg_billing_accounts", "stg_customers", "stg_cloud_usage"),
        core.dim_billing_accounts,
        _tags("marts", "core"),
        layout=Layout(
            description="Billing accounts with their customer and lifetime usage.",
            column_comments={"lifetime_effective_cost_usd": "Effective cost of all its lines."},
        ),
        state=State(
            "dim_billing_accounts_usage",
            core.account_usage_by_day,
            core.billing_accounts_by_state,
            Layout("usage_date", ("billing_account_id",), "Usage totals per account and day."),
            Refresh("stg_cloud_usage", "usage_date", "day"),
        ),
    ),
    Model(
        "fct_subscriptions",
        ("stg_subscriptions", "stg_customers", "stg_products"),
        core.fct_subscriptions,
        _tags("marts", "core"),
        layout=Layout(
            description="Subscriptions with customer and product attributes.",
            column_comments={"mrr_per_seat_usd": "NULL when there are no seats."},
        ),
    ),
    Model(
        "fct_cloud_usage_daily",
        ("stg_cloud_usage", "dim_customers", "dim_billing_accounts"),
        finops.fct_cloud_usage_daily,
        _tags("marts", "finops", "incremental"),
        kind="incremental",
        layout=_daily(
            ("customer_id", "cloud_provider", "service_id"),
            "Billing lines with customer and account attributes.",
            {
                "effective_cost_usd": "What the customer is charged.",
                "total_savings_usd": "All savings on the line.",
            },
        ),
        refresh=Refresh("stg_cloud_usage", "usage_date", "day"),
        takes_settings=True,
        lines="stg_cloud_usage",
    ),
    Model(
        "agg_customer_daily_spend",
        ("fct_cloud_usage_daily",),
        finops.agg_customer_daily_spend,
        _tags("marts", "finops"),
        layout=Layout(
            description="Spend per customer, provider and day; always rebuilt whole.",
            column_comments={"spend_vs_7d_avg_ratio": "Above 1.5 deserves a look."},
        ),
        lines="fct_cloud_usage_daily",
    ),
    Model(
        "agg_customer_monthly_spend",
        ("fct_cloud_usage_daily", "stg_subscriptions"),
        finops.agg_customer_monthly_spend,
        _tags("marts", "finops", "incremental"),
        kind="incremental",
        layout=_monthly(
            ("customer_id", "customer_segment"),
            "Spend and live subscription revenue per customer and month.",
            {"revenue_to_spend_ratio": "Subscription revenue by effective cost."},
        ),
        refresh=Refresh("fct_cloud_usage_daily", "usage_month", "month", "usage_date"),
        lines="fct_cloud_usage_daily",
        takes_settings=True,
    ),
    Model(
        "agg_service_monthly_spend",
        ("fct_cloud_usage_daily",),
        finops.agg_service_monthly_spend,
        _tags("marts", "finops", "incremental"),
        kind="incremental",
        layout=_monthly(
            ("customer_id", "cloud_provider", "service_id"),
            "Spend per customer, month and service, ranked.",
            {"service_cost_rank": "1 is the dearest service of the customer month."},
        ),
        refresh=Refresh("fct_cloud_usage_daily", "usage_month", "month", "usage_date"),
        lines="fct_cloud_usage_daily",
    ),
    Model(
        "agg_cost_allocation_monthly",
        ("fct_cloud_usage_daily",),
        finops.agg_cost_allocation_monthly,
        _tags("marts", "finops", "incremental"),
        kind="incremental",
        layout=_monthly(
            ("customer_id", "cost_centre"),
            "Spend per customer, month and label bucket.",
            {"is_missing_cost_centre": "The bucket is the one of unlabelled lines."},
        ),
        refresh=Refresh("fct_cloud_usage_daily", "usage_month", "month", "usage_date"),
        lines="fct_cloud_usage_daily",
    ),
]

MODEL_BY_NAME = {model.name: model for model in MODELS}


def select(tags: set[str] | None = None, names: set[str] | None = None) -> list[Model]:
    """Models carrying any of the tags or names, in build order; all when neither is given."""
    if not tags and not names:
        return list(MODELS)
    return [m for m in MODELS if (tags and m.tags & tags) or (names and m.name in names)]
