"""The star tables as flat domain tables, in SQL: the common part of the comparison queries."""

from __future__ import annotations


def money(expression: str, over: str = "") -> str:
    """Exact sum of a double amount: its bits down to 2**-78 as a 128-bit integer, then a double.

    The integer is rounded once, by reading its decimal text as a double, and scaled.
    """
    total = f"sum(CAST(CAST({expression} AS DOUBLE) * pow(2, 78) AS HUGEINT)) {over}"
    return f"CAST(CAST({total} AS VARCHAR) AS DOUBLE) * pow(2, -78)"


def ratio(numerator: str, denominator: str) -> str:
    return f"CASE WHEN {denominator} > 0 THEN {numerator} / {denominator} END"


_PROVIDER = "CASE WHEN {0} % 3 = 0 THEN 'GCP' WHEN {0} % 3 = 1 THEN 'AWS' ELSE 'Azure' END"

_ATTRIBUTES = (
    "customer_id, customer_name, customer_segment, customer_status, sales_region, "
    "account_manager_name"
)

# name -> (tables it is made from, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}

TABLES["numbers"] = ((), "SELECT unnest([1, 2, 3]) AS n")

TABLES["cust"] = (
    (),
    """
    SELECT c_custkey AS k, n_nationkey AS nk, 'cus_' || c_custkey AS customer_id,
           c_name AS customer_name,
           CASE WHEN c_custkey % 5 = 0 THEN 'churned' ELSE 'active' END AS customer_status,
           CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'Enterprise'
                WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'Mid-Market'
                ELSE 'Startup' END AS customer_segment,
           c_mktsegment AS industry, c_custkey || ' Main Street' AS address_street,
           n_name AS address_city, n_name AS address_country,
           'N' || n_nationkey AS address_country_code, r_name AS sales_region,
           'emp_' || n_nationkey AS account_manager_id,
           'Manager ' || n_nationkey AS account_manager_name,
           'manager' || n_nationkey || '@example.com' AS account_manager_email,
           CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 3 END AS contact_count,
           c_custkey % 4 AS subscription_count,
           (c_custkey + 1) % 4 AS billing_account_count,
           CAST(DATE '1994-01-01' + CAST(c_custkey % 700 AS INTEGER) AS TIMESTAMP)
               AS customer_created_at,
           DATE '1994-01-01' + CAST(c_custkey % 700 AS INTEGER) AS customer_created_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    """,
)

TABLES["contacts"] = (
    ("numbers", "cust"),
    """
    SELECT 'ct_' || k || '_' || n AS contact_id, customer_id,
           'Contact ' || n || ' of ' || customer_name AS contact_name,
           'contact' || n || '.' || k || '@example.com' AS contact_email,
           CASE WHEN n = 1 THEN 'Billing' ELSE 'Technical' END AS contact_role,
           n = 1 OR k % 7 = 0 AS is_primary_contact
    FROM cust, numbers WHERE n <= contact_count
    """,
)

TABLES["subs"] = (
    ("numbers", "cust"),
    """
    SELECT *, subscription_status = 'active' AND end_date IS NULL AS is_active,
           end_date IS NOT NULL AS is_churned,
           date_diff('month', start_date, coalesce(end_date, DATE '2002-01-01')) AS tenure_months
    FROM (
        SELECT 'sub_' || k || '_' || n AS subscription_id, customer_id,
               'prd_' || CASE n WHEN 1 THEN k WHEN 2 THEN k // 2 ELSE k + k // 2 END AS product_id,
               'Tier ' || n AS subscription_tier,
               CASE WHEN (k + n) % 3 = 0 THEN 'churned' ELSE 'active' END AS subscription_status,
               CASE WHEN n = 2 THEN 'annual' ELSE 'monthly' END AS billing_frequency,
               (k * n) % 50 AS seats, (k % 90) * 2.5::DOUBLE + 100 AS mrr_usd,
               ((k % 90) * 2.5::DOUBLE + 100) * 12 AS arr_usd,
               DATE '1995-01-15' + CAST((k * 31 + n * 97) % 1500 AS INTEGER) AS start_date,
               CASE WHEN (k + n) % 3 = 0 THEN DATE '1995-01-15'
                   + CAST((k * 31 + n * 97) % 1500 + (k * 17) % 800 - 20 AS INTEGER) END AS end_date
        FROM cust, numbers WHERE n <= subscription_count
    )
    """,
)

TABLES["accounts"] = (
    ("numbers", "cust"),
    f"""
    SELECT 'ba_' || k || '_' || n AS billing_account_id, customer_id,
           {_PROVIDER.format("(k + n)")} AS cloud_provider,
           CASE nk % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS billing_currency,
           CASE WHEN n = 1 THEN 'NET30' ELSE 'NET45' END AS payment_terms,
           k % 2 = 0 AS is_reseller_account,
           DATE '1994-06-01' + CAST((k * 13 + n * 50) % 600 AS INTEGER) AS activated_on
    FROM cust, numbers WHERE n <= billing_account_count
    """,
)

TABLES["prod"] = (
    (),
    """
    SELECT p_partkey AS k, 'prd_' || p_partkey AS product_id, p_name AS product_name,
           p_type AS product_family, p_brand || ' ' || p_name AS product_description,
           p_size % 2 = 0 AS is_active_product,
           DATE '1993-01-01' + CAST(p_partkey % 900 AS INTEGER) AS launch_date,
           CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN 'GCP' WHEN 2 THEN 'GCP, AWS'
                ELSE 'GCP, AWS, Azure' END AS supported_providers_list,
           CAST(p_size % 4 AS BIGINT) AS supported_provider_count,
           p_partkey % 4 AS feature_count,
           CASE WHEN p_size % 3 = 0 THEN 'percentage_of_spend' ELSE 'flat_monthly' END
               AS pricing_model,
           'USD' AS pricing_currency, p_retailprice AS base_fee_usd,
           p_partkey % 3 AS pricing_tier_count
    FROM part
    """,
)

TABLES["features"] = (
    ("numbers", "prod"),
    """
    SELECT product_id, 'f' || n AS feature_code, 'Feature ' || n AS feature_name,
           CASE (k + n) % 3 WHEN 0 THEN 'GA' WHEN 1 THEN 'PREVIEW' ELSE 'RETIRED' END
               AS availability_status,
           'Tier ' || n AS minimum_tier, (k + n) % 3 = 0 AS is_generally_available
    FROM prod, numbers WHERE n <= feature_count
    """,
)

TABLES["tiers"] = (
    ("numbers", "prod"),
    """
    SELECT product_id, 'Tier ' || n AS tier_name, pricing_model, pricing_currency,
           CAST((n - 1) * 1000 AS DOUBLE) AS min_monthly_spend_usd,
           CASE WHEN n = 1 THEN 1000.0::DOUBLE END AS max_monthly_spend_usd,
           3 - n * 0.5::DOUBLE AS rate_pct,
           CASE WHEN n = 1 THEN 'standard' ELSE 'premium' END AS included_support
    FROM prod, numbers WHERE n <= pricing_tier_count
    """,
)

TABLES["lines"] = (
    (),
    """
    SELECT l.*, o.*, p.*, CAST(l_shipdate AS DATE) AS usage_date,
           'usg_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey
               AS usage_id,
           'cus_' || o_custkey AS customer_id,
           'ba_' || o_custkey || '_' || (l_linenumber % 3 + 1) AS billing_account_id,
           CASE l_returnflag WHEN 'A' THEN 'AWS' WHEN 'R' THEN 'Azure' ELSE 'GCP' END
               AS cloud_provider
    FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN part p ON l_partkey = p_partkey
    """,
)

TABLES["usage"] = (
    ("lines",),
    f"""
    SELECT *, net_cost_usd + credit_amount_usd AS effective_cost_usd,
           flexsave_savings_usd + optimisation_savings_usd AS total_savings_usd,
           {ratio("discount_usd", "list_cost_usd")} AS discount_rate
    FROM (
        SELECT usage_id, usage_date, CAST(usage_date + 1 AS TIMESTAMP) AS exported_at,
               CAST(date_trunc('month', usage_date) AS DATE) AS usage_month,
               dayname(usage_date) AS usage_day_name, dayofweek(usage_date) IN (0, 6) AS is_weekend,
               customer_id, billing_account_id, cloud_provider,
               'prj_' || l_suppkey AS project_id, 'Project ' || l_suppkey AS project_name,
               'svc_' || lower(p_type) AS service_id, p_type AS service_name,
               p_brand AS service_category, 'sku_' || l_partkey AS sku_id,
               p_name AS sku_description, 'unit' AS pricing_unit,
               p_retailprice AS list_unit_price_usd,
               'region-' || (l_suppkey % 5) AS cloud_region,
               'region-' || (l_suppkey % 5) || '-' || (l_linenumber % 3) AS cloud_zone,
               l_quantity AS usage_quantity, 'unit' AS usage_unit,
               l_extendedprice AS list_cost_usd, l_extendedprice * l_discount AS discount_usd,
               l_extendedprice - l_extendedprice * l_discount AS net_cost_usd,
               'USD' AS cost_currency, l_linestatus = 'O' AS is_flexsave_eligible,
               CASE WHEN l_linestatus = 'O' THEN l_extendedprice * 0.03::DOUBLE ELSE 0 END
                   AS flexsave_savings_usd,
               l_extendedprice * l_tax AS optimisation_savings_usd,
               CASE o_orderstatus WHEN 'F' THEN 'prod' WHEN 'O' THEN 'dev' ELSE 'staging' END
                   AS environment,
               'team-' || substr(o_orderpriority, 1, 1) AS team,
               CASE WHEN l_orderkey % 10 < 7 THEN 'cc-' || (l_suppkey % 8) END AS cost_centre,
               CASE WHEN l_orderkey % 20 < 7 THEN 'app-' || (l_partkey % 12) END AS application,
               CAST(2 + (l_orderkey % 10 < 7)::INTEGER + (l_orderkey % 20 < 7)::INTEGER AS BIGINT)
                   AS label_count,
               CASE WHEN l_linenumber <> 7 THEN CAST((l_linenumber % 3 = 0)::INTEGER
                   + (l_returnflag = 'R')::INTEGER + (l_tax >= 0.07::DOUBLE)::INTEGER AS BIGINT) END
                   AS credit_count,
               CASE WHEN l_linenumber = 7 THEN 0 ELSE
                   (CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice * -0.02::DOUBLE ELSE 0 END)
                   + (CASE WHEN l_returnflag = 'R' THEN l_quantity * -0.5::DOUBLE ELSE 0 END)
                   + (CASE WHEN l_tax >= 0.07::DOUBLE THEN l_extendedprice * -0.01::DOUBLE ELSE 0 END)
               END AS credit_amount_usd
        FROM lines
    )
    """,
)

TABLES["credits"] = (
    ("lines",),
    """
    SELECT credit_id, usage_id, usage_date,
           CAST(date_trunc('month', usage_date) AS DATE) AS usage_month,
           customer_id, billing_account_id, cloud_provider, credit_type, credit_amount_usd,
           abs(credit_amount_usd) AS credit_abs_amount_usd
    FROM (
        SELECT *, usage_id || '-1' AS credit_id, 'committed_use_discount' AS credit_type,
               l_extendedprice * -0.02::DOUBLE AS credit_amount_usd
        FROM lines WHERE l_linenumber % 3 = 0 AND l_linenumber <> 7
        UNION ALL
        SELECT *, usage_id || '-2', 'promotional_credit', l_quantity * -0.5::DOUBLE
        FROM lines WHERE l_returnflag = 'R' AND l_linenumber <> 7
        UNION ALL
        SELECT *, usage_id || '-3', 'reseller_discount', l_extendedprice * -0.01::DOUBLE
        FROM lines WHERE l_tax >= 0.07::DOUBLE AND l_linenumber <> 7
    )
    """,
)

TABLES["labels_tall"] = (
    ("usage",),
    """
    SELECT usage_id, usage_date, customer_id, 'env' AS label_key, environment AS label_value
    FROM usage
    UNION ALL SELECT usage_id, usage_date, customer_id, 'team', team FROM usage
    UNION ALL SELECT usage_id, usage_date, customer_id, 'cost_centre', cost_centre
    FROM usage WHERE cost_centre IS NOT NULL
    UNION ALL SELECT usage_id, usage_date, customer_id, 'app', application
    FROM usage WHERE application IS NOT NULL
    """,
)

TABLES["dim_cust"] = (
    ("cust", "subs", "accounts", "contacts"),
    f"""
    SELECT c.customer_id, customer_name, customer_status, customer_segment, industry, sales_region,
           address_country, address_country_code, address_city, account_manager_id,
           account_manager_name, account_manager_email, primary_contact_name,
           primary_contact_email, contact_count,
           coalesce(s.n, 0) AS subscription_count,
           coalesce(s.n_active, 0) AS active_subscription_count,
           coalesce(s.mrr, 0) AS active_mrr_usd, coalesce(s.arr, 0) AS active_arr_usd,
           first_subscription_date, coalesce(a.n, 0) AS billing_account_count,
           coalesce(a.n_providers, 0) AS cloud_provider_count, cloud_providers,
           coalesce(a.n_providers, 0) > 1 AS is_multicloud, first_account_activated_on,
           customer_created_at, customer_created_date,
           date_diff('month', customer_created_date, DATE '2002-01-01') AS customer_tenure_months
    FROM cust c
    LEFT JOIN (
        SELECT customer_id, count(*) AS n, count(*) FILTER (is_active) AS n_active,
               {money("CASE WHEN is_active THEN mrr_usd END")} AS mrr,
               {money("CASE WHEN is_active THEN arr_usd END")} AS arr,
               min(start_date) AS first_subscription_date
        FROM subs GROUP BY customer_id
    ) s ON s.customer_id = c.customer_id
    LEFT JOIN (
        SELECT customer_id, count(*) AS n, count(DISTINCT cloud_provider) AS n_providers,
               string_agg(DISTINCT cloud_provider, ', ' ORDER BY cloud_provider) AS cloud_providers,
               min(activated_on) AS first_account_activated_on
        FROM accounts GROUP BY customer_id
    ) a ON a.customer_id = c.customer_id
    LEFT JOIN (
        SELECT customer_id, max(contact_name) AS primary_contact_name,
               max(contact_email) AS primary_contact_email
        FROM contacts WHERE is_primary_contact GROUP BY customer_id
    ) p ON p.customer_id = c.customer_id
    """,
)

TABLES["fact"] = (
    ("usage", "cust", "accounts"),
    """
    SELECT u.* EXCLUDE (exported_at, pricing_unit, cost_currency, label_count),
           customer_name, customer_segment, customer_status, sales_region, account_manager_name,
           billing_currency, payment_terms, is_reseller_account, 'USD' AS reporting_currency
    FROM usage u JOIN cust c ON c.customer_id = u.customer_id
    LEFT JOIN accounts a ON a.billing_account_id = u.billing_account_id
    """,
)

_COSTS = "list_cost_usd discount_usd net_cost_usd credit_amount_usd effective_cost_usd".split()
_SAVINGS = "flexsave_savings_usd optimisation_savings_usd total_savings_usd".split()


def money_columns(names: list[str]) -> str:
    return ", ".join(f"{money(name)} AS {name}" for name in names)


TABLES["daily"] = (
    ("fact",),
    f"""
    SELECT customer_id || '|' || cloud_provider || '|' || usage_date AS customer_provider_day_key,
           *, effective_cost_usd - prev_day_effective_cost_usd AS day_over_day_change_usd,
           {ratio("effective_cost_usd", "prev_day_effective_cost_usd")} - 1
               AS day_over_day_change_pct,
           {ratio("effective_cost_usd", "effective_cost_7d_avg_usd")} AS spend_vs_7d_avg_ratio
    FROM (
        SELECT *, {money("effective_cost_usd", "OVER w7")} / count(effective_cost_usd) OVER w7
                   AS effective_cost_7d_avg_usd,
               lag(effective_cost_usd) OVER (PARTITION BY customer_id, cloud_provider
                                             ORDER BY usage_date) AS prev_day_effective_cost_usd
        FROM (
            SELECT customer_id, customer_name, customer_segment, sales_region, cloud_provider,
                   usage_date, usage_month, count(*) AS usage_line_count,
                   count(DISTINCT service_id) AS service_count,
                   count(DISTINCT project_id) AS project_count, {money_columns(_COSTS + _SAVINGS)}
            FROM fact GROUP BY ALL
        )
        WINDOW w7 AS (PARTITION BY customer_id, cloud_provider ORDER BY usage_date
                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
    )
    """,
)

TABLES["monthly"] = (
    ("fact", "subs"),
    f"""
    SELECT ms.customer_id || '|' || ms.usage_month AS customer_month_key, ms.* EXCLUDE (eligible),
           effective_cost_usd / nullif(active_days, 0) AS avg_daily_effective_cost_usd,
           coalesce(eligible, 0) AS flexsave_eligible_cost_usd,
           {ratio("total_savings_usd", "list_cost_usd")} AS savings_rate,
           coalesce(mrr, 0) AS subscription_mrr_usd, coalesce(n, 0) AS live_subscription_count,
           {ratio("coalesce(mrr, 0)", "effective_cost_usd")} AS revenue_to_spend_ratio,
           'USD' AS reporting_currency
    FROM (
        SELECT {_ATTRIBUTES}, usage_month, count(DISTINCT usage_date) AS active_days,
               count(DISTINCT billing_account_id) AS billing_account_count,
               count(DISTINCT cloud_provider) AS cloud_provider_count,
               count(DISTINCT service_id) AS service_count, {money_columns(_COSTS + _SAVINGS)},
               {money("CASE WHEN is_flexsave_eligible THEN effective_cost_usd END")} AS eligible
        FROM fact GROUP BY {_ATTRIBUTES}, usage_month
    ) ms
    LEFT JOIN (
        SELECT usage_month, customer_id, {money("mrr_usd")} AS mrr, count(*) AS n
        FROM (SELECT DISTINCT usage_month FROM fact)
        JOIN subs ON start_date <= last_day(usage_month)
                 AND (end_date IS NULL OR end_date >= usage_month)
        GROUP BY usage_month, customer_id
    ) sr ON sr.customer_id = ms.customer_id AND sr.usage_month = ms.usage_month
    """,
)

TABLES["services"] = (
    ("fact",),
    f"""
    SELECT *, {ratio("effective_cost_usd", "customer_month_effective_cost_usd")}
                  AS share_of_customer_month_spend
    FROM (
        SELECT *, {money("effective_cost_usd", "OVER (PARTITION BY customer_id, usage_month)")}
                   AS customer_month_effective_cost_usd,
               row_number() OVER (
                   PARTITION BY customer_id, usage_month
                   ORDER BY effective_cost_usd DESC, cloud_provider, service_id, service_category
               ) AS service_cost_rank
        FROM (
            SELECT customer_id, customer_name, customer_segment, usage_month, cloud_provider,
                   service_id, service_name, service_category, count(*) AS usage_line_count,
                   count(DISTINCT sku_id) AS sku_count, count(DISTINCT cloud_region) AS region_count,
                   sum(usage_quantity) AS usage_quantity,
                   {money_columns([*_COSTS, "total_savings_usd"])}
            FROM fact GROUP BY ALL
        )
    )
    """,
)

TABLES["allocation"] = (
    ("fact",),
    f"""
    SELECT *, {ratio("effective_cost_usd", "customer_month_effective_cost_usd")}
                  AS share_of_customer_month_spend,
           cost_centre = 'unallocated' AS is_missing_cost_centre
    FROM (
        SELECT *, {money("effective_cost_usd", "OVER (PARTITION BY customer_id, usage_month)")}
                   AS customer_month_effective_cost_usd
        FROM (
            SELECT customer_id, customer_name, customer_segment, usage_month, cloud_provider,
                   coalesce(environment, 'unallocated') AS environment,
                   coalesce(team, 'unallocated') AS team,
                   coalesce(f.cost_centre, 'unallocated') AS cost_centre,
                   coalesce(application, 'unallocated') AS application,
                   count(*) AS usage_line_count,
                   {money_columns(["net_cost_usd", "credit_amount_usd", "effective_cost_usd",
                                   "total_savings_usd"])},
                   {money("CASE WHEN f.cost_centre IS NULL THEN effective_cost_usd END")}
                       AS unallocated_cost_usd
            FROM fact f GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
        )
    )
    """,
)

# Usage lines made from the event stream, flat.
TABLES["event_lines"] = (
    (),
    f"""
    SELECT 'evt_' || event_id AS usage_id, CAST(ts AS DATE) AS usage_date, ts AS exported_at,
           CAST(date_trunc('month', ts) AS DATE) AS usage_month,
           'cus_' || user_id AS customer_id, 'ba_' || user_id || '_1' AS billing_account_id,
           {_PROVIDER.format("user_id")} AS cloud_provider, event_type,
           'svc_' || event_type AS service_id, event_type AS service_name,
           event_type AS sku_description, 1.0::DOUBLE AS usage_quantity, 'event' AS usage_unit,
           value AS list_cost_usd, 0.0::DOUBLE AS discount_usd, value AS net_cost_usd,
           CASE WHEN event_type = 'purchase' THEN value * -0.25::DOUBLE ELSE 0 END
               AS credit_amount_usd,
           value + CASE WHEN event_type = 'purchase' THEN value * -0.25::DOUBLE ELSE 0 END
               AS effective_cost_usd,
           event_type AS environment
    FROM events
    """,
)


def sql(body: str, *names: str) -> str:
    """``body`` with the named tables, and those they are made from, in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in TABLES[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS ({TABLES[name][1]})" for name in ordered)
    return f"WITH {parts}\n{body}"
