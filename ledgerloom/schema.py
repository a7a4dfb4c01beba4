"""Column groups of the ledger, the one wide fact table, and its amount record."""

from __future__ import annotations

#: The five amounts of a row, in printed order.
LEVELS = ("prior_year_enacted", "budget_estimate", "committee_recommendation")
DELTAS = ("delta_vs_enacted", "delta_vs_estimate")
AMOUNTS = (*LEVELS, *DELTAS)
PRIMARY = "committee_recommendation"
#: Block inference tries the columns in this order.
BLOCK_ORDER = ("committee_recommendation", "budget_estimate", "prior_year_enacted")
FLOW_LEVELS = ("chamber", "stage", "subcommittee", "title_name", "department", "agency", "account")
AMOUNT_TYPE = "struct<value:bigint,raw_text:string,in_thousands:boolean>"
#: Annual averages of the consumer price index, fixed values.
CPI = {2015: 237.017, 2016: 240.007, 2017: 245.120, 2018: 251.107, 2019: 255.657, 2020: 258.811, 2021: 270.970, 2022: 292.655, 2023: 304.702, 2024: 313.689, 2025: 321.943}
REAL_BASE = 2024

#: The columns of the combined fact, in the order in which it is written.
FACT = (
    "report_id", "congress", "chamber", "fiscal_year", "subcommittee", "stage", "title_name", "department", "agency", "account", "account_inferred", "is_memo", "program", "line_item_text",
    "prior_year_enacted", "budget_estimate", "committee_recommendation", "delta_vs_enacted", "delta_vs_estimate", "is_subtotal", "hierarchy_depth", "in_thousands", "extraction_method", "verified",
    "verification_method", "verification_tier", "column_layout", "account_key", "account_key_title", "account_match", "account_key_agency", "account_key_bureau", "designation", "real_factor_2024",
)
