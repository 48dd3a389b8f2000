"""Cleansing, keys, joins, gold builders and quality checks."""

from .cleansing import (SILVER_SPECS, Cleansing, cleanse, cleanse_customers, drop_critical, enforce_types, fill_unknown,
                        latest_per_key, rename)
from .dictionary import KeyDictionary, lasting_dimension
from .gold import (GOLD_ORDER, GoldBuildError, active_only, build_gold, dim_customer_info, dim_product_info,
                   fact_sales, resolve_gender, sales_key_report)
from .joins import fits_broadcast, left_join_dim, left_join_dims, measured_join, projection_bytes
from .keys import surrogate_key
from .partials import SalesPartials
from .rejects import Accounted, cleanse_accounted, reconciliation
from .rollup import rollup
from .running import running_windows
from .sketches import ProfileStore
from .storage import read_by_month, sales_in_months, sales_of, write_by_month
from .upsert import KeyedTable
from .quality import (IntegrityError, assert_integrity, integrity_report, natural_key_report, profile_columns,
                      profile_tables)

__all__ = ["cleanse_customers", "drop_critical", "enforce_types", "fill_unknown",
           "latest_per_key", "rename", "GOLD_ORDER", "GoldBuildError", "active_only", "build_gold",
           "dim_customer_info", "dim_product_info", "fact_sales", "resolve_gender",
           "left_join_dim", "projection_bytes", "surrogate_key", "integrity_report",
           "profile_columns", "profile_tables", "IntegrityError", "assert_integrity",
           "fits_broadcast", "measured_join", "rollup", "SILVER_SPECS", "Cleansing", "cleanse",
           "left_join_dims", "natural_key_report", "sales_key_report",
           "KeyDictionary", "lasting_dimension", "SalesPartials", "KeyedTable", "write_by_month", "read_by_month",
           "sales_of", "sales_in_months", "running_windows", "cleanse_accounted", "Accounted", "reconciliation", "ProfileStore"]
