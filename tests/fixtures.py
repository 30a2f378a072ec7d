"""Small hand-made landing records covering the edge cases."""

from datetime import date, datetime

from spendlake.sources.schemas import CLOUD_USAGE, CUSTOMERS, PRODUCTS


def _customer(key, **changes):
    record = dict(
        customer_id=key,
        customer_name=f"Name {key}",
        status="ACTIVE",
        segment="Startup",
        industry="Retail",
        created_at=datetime(2024, 1, 31, 23, 0),
        address=("1 Road", "Oslo", "Norway", "NO", "EMEA"),
        account_manager=("e1", "Kim", "kim@example.com", "EMEA"),
        contacts=[],
        subscriptions=[],
        billing_accounts=[],
    )
    return tuple({**record, **changes}.values())


def customers(spark):
    both = [
        ("ct1", "Ann", "z@example.com", "CFO", True),
        ("ct2", "Zoe", "a@example.com", "CTO", True),
        ("ct3", "Pat", "pat@example.com", "Dev", False),
    ]
    subscriptions = [
        # live in January only; ends before it starts; open; starts on a month's last day;
        # ends on a month's first day; churned status without an end date; no seats
        ("s1", "p1", "Gold", date(2024, 1, 10), date(2024, 1, 20), 10, 100.0, "monthly", "Churned"),
        ("s2", "p1", "Gold", date(2024, 3, 1), date(2024, 2, 1), 1, 7.0, "monthly", "Churned"),
        ("s3", "p2", "Gold", date(2023, 5, 1), None, 4, 20.0, "annual", "ACTIVE"),
        ("s4", "p2", "Gold", date(2024, 1, 31), None, 0, 3.5, "annual", "Active"),
        ("s5", "p1", "Gold", date(2023, 1, 1), date(2024, 2, 1), 2, 40.0, "annual", "churned"),
        ("s6", "p9", "Gold", date(2024, 2, 15), None, 5, 1.0, "annual", "CHURNED"),
    ]
    accounts = [
        ("b1", "GCP", "USD", "NET30", False, date(2023, 6, 1)),
        ("b2", "AWS", "EUR", "NET45", True, date(2023, 5, 1)),
        ("b3", "GCP", "USD", "NET30", False, date(2023, 7, 1)),
    ]
    rows = [
        _customer("c1", contacts=both, subscriptions=subscriptions, billing_accounts=accounts),
        _customer("c2", status="Churned", contacts=None, subscriptions=None, billing_accounts=None),
        _customer("c3", created_at=None),
    ]
    return spark.createDataFrame(rows, CUSTOMERS)


def products(spark):
    features = [("f1", "One", "GA", "Basic"), ("f2", "Two", "RETIRED", "Gold")]
    tiers = [("Low", 0, 1000, 3.0, "mail"), ("High", 1000, None, 1.5, "phone")]
    rows = [
        ("p1", "First", "Save", "Saves", date(2020, 1, 1), True, ["GCP", None, "AWS"], features,
         ("percentage", "USD", 10.0, tiers)),
        ("p2", "Second", "Save", "Saves", date(2021, 1, 1), False, [], [], ("flat", "USD", 5.0, [])),
        ("p3", "Third", "View", "Views", None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, PRODUCTS)


def line(key, day, **changes):
    record = dict(
        usage_id=key,
        usage_date=day,
        export_time=datetime(2024, 3, 1, 4, 0),
        customer_id="c1",
        billing_account_id="b1",
        cloud_provider="GCP",
        project=("prj", "Project"),
        service=("svc1", "Compute", "compute"),
        sku=("sku1", "vCPU", "hour", 0.5),
        location=("eu", "eu-a"),
        usage=(4.0, "hour"),
        cost=(100.0, 10.0, 90.0, "USD"),
        savings=(True, 5.0, 1.0),
        credits=[],
        labels=[("env", "prod"), ("team", "core"), ("cost_centre", "cc1"), ("app", "web")],
    )
    return tuple({**record, **changes}.values())


def usage(spark, lines):
    return spark.createDataFrame(lines, CLOUD_USAGE)


def january_lines():
    return [
        line("u1", date(2024, 1, 5), credits=[("promotional_credit", "k1", -10.0), ("x", "k2", None)]),
        line("u2", date(2024, 1, 6), labels=[], credits=None),
        line("u3", date(2024, 1, 6), labels=None, cost=(0.0, 0.0, 0.0, "USD"), savings=(None, 0.0, 0.0)),
        line("u4", date(2024, 1, 9), labels=[("env", "dev"), ("env", "prod"), ("cost_centre", "unallocated")],
             billing_account_id="unknown", service=("svc2", "Store", "storage")),
        line("u5", date(2024, 1, 9), customer_id="nobody"),
        line("u6", date(2024, 2, 3), credits=[("reseller_discount", "k3", -200.0)], cloud_provider="AWS",
             billing_account_id="b2"),
    ]
