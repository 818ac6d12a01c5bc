"""All reports of the warehouse by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.plans import hr_reports, rfm_reports, sales_reports, vendor_reports

# pack -> (tables it reads, reports over the first of them); a report may take the other tables as well
PACKS = {
    "sales": (
        ("fact_sales_performance",),
        (
            sales_reports.preview,
            sales_reports.top_products,
            sales_reports.by_territory,
            sales_reports.top_per_territory,
            sales_reports.margin_by_category,
            sales_reports.high_margin_low_quantity,
            sales_reports.category_share,
            sales_reports.load_audit,
        ),
    ),
    "hr": (
        ("fact_hr_workforce",),
        (
            hr_reports.tenure_by_department,
            hr_reports.top_pay,
            hr_reports.mover_percent,
            hr_reports.pay_by_bracket,
            hr_reports.job_titles,
            hr_reports.long_tenure_low_pay,
        ),
    ),
    "vendor": (
        ("fact_vendor_performance",),
        (
            vendor_reports.ranking,
            vendor_reports.price_status,
            vendor_reports.best_of_both,
            vendor_reports.performance_bands,
            vendor_reports.load_audit,
        ),
    ),
    "vendor_orders": (("fact_vendor_performance", "stg_purchase_orders"), (vendor_reports.by_ship_method,)),
    "rfm": (
        ("fact_customer_rfm",),
        (
            rfm_reports.top_champions,
            rfm_reports.segment_distribution,
            rfm_reports.territory_profile,
            rfm_reports.win_back,
            rfm_reports.champions_percent,
            rfm_reports.heat_map,
            rfm_reports.load_audit,
        ),
    ),
}


def analytic_queries(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every report whose tables are given, as ``pack/report``; nothing runs until a report is used."""
    out = {}
    for pack, (needed, reports) in PACKS.items():
        if all(t in tables for t in needed):
            for report in reports:
                out[f"{pack}/{report.__name__}"] = report(*[tables[t] for t in needed])
    return out
