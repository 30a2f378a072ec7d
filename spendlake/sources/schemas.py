"""Schemas of the three nested exports.

Fixed values: field names and types are those of the export files, so that existing files
load unchanged.  They are always given to the reader, as DDL; inference would leave dates and
timestamps as strings.
"""

CUSTOMERS = """
    customer_id STRING, customer_name STRING, status STRING, segment STRING, industry STRING,
    created_at TIMESTAMP,
    address STRUCT<street: STRING, city: STRING, country: STRING, country_code: STRING,
                   region: STRING>,
    account_manager STRUCT<employee_id: STRING, name: STRING, email: STRING, region: STRING>,
    contacts ARRAY<STRUCT<contact_id: STRING, full_name: STRING, email: STRING, role: STRING,
                          is_primary: BOOLEAN>>,
    subscriptions ARRAY<STRUCT<subscription_id: STRING, product_id: STRING, tier: STRING,
                               start_date: DATE, end_date: DATE, seats: BIGINT, mrr_usd: DOUBLE,
                               billing_frequency: STRING, status: STRING>>,
    billing_accounts ARRAY<STRUCT<billing_account_id: STRING, cloud_provider: STRING,
                                  currency: STRING, payment_terms: STRING,
                                  is_reseller_account: BOOLEAN, activated_on: DATE>>
"""

PRODUCTS = """
    product_id STRING, product_name STRING, product_family STRING, description STRING,
    launch_date DATE, is_active BOOLEAN, supported_providers ARRAY<STRING>,
    features ARRAY<STRUCT<feature_code: STRING, feature_name: STRING, availability: STRING,
                          min_tier: STRING>>,
    pricing STRUCT<model: STRING, currency: STRING, base_fee_usd: DOUBLE,
                   tiers: ARRAY<STRUCT<tier_name: STRING, min_monthly_spend_usd: BIGINT,
                                       max_monthly_spend_usd: BIGINT, rate_pct: DOUBLE,
                                       included_support: STRING>>>
"""

CLOUD_USAGE = """
    usage_id STRING, usage_date DATE, export_time TIMESTAMP, customer_id STRING,
    billing_account_id STRING, cloud_provider STRING,
    project STRUCT<project_id: STRING, project_name: STRING>,
    service STRUCT<service_id: STRING, service_name: STRING, service_category: STRING>,
    sku STRUCT<sku_id: STRING, sku_description: STRING, pricing_unit: STRING,
               list_unit_price_usd: DOUBLE>,
    location STRUCT<region: STRING, zone: STRING>,
    usage STRUCT<quantity: DOUBLE, unit: STRING>,
    cost STRUCT<list_cost_usd: DOUBLE, discount_usd: DOUBLE, net_cost_usd: DOUBLE,
                currency: STRING>,
    savings STRUCT<flexsave_eligible: BOOLEAN, flexsave_savings_usd: DOUBLE,
                   optimisation_savings_usd: DOUBLE>,
    credits ARRAY<STRUCT<credit_type: STRING, credit_id: STRING, amount_usd: DOUBLE>>,
    labels ARRAY<STRUCT<key: STRING, value: STRING>>
"""

LANDING_SCHEMAS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "cloud_usage": CLOUD_USAGE,
}
