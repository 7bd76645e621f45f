"""Names and settings that tables, features and outputs share with their users."""

from __future__ import annotations

from datetime import date

# Column names, codes, texts and limits that results must have.
KEYS = ["account_id", "snapshot_date"]
INFO = ["cif", "branch_code", "product_code", "person_cluster_id", "ring_id"]
FEATURES = [
    "account_age_days", "min_kyc_flag", "dormant_reactivated_flag", "inflow_to_declared_income_30d", "distinct_senders_7d",
    "distinct_receivers_7d", "pass_through_ratio_7d", "median_hold_hours_30d", "night_txn_share_30d", "round_amount_share_30d",
    "new_device_logins_30d", "vpa_or_mobile_changes_30d", "accounts_on_same_device", "cifs_sharing_mobile", "person_cluster_size",
    "ring_size", "hops_to_known_mule", "credits_from_complainants_30d",
]
LABEL = "is_mule_90d"
FEATURE_COLUMNS = [*KEYS, *INFO, *FEATURES, LABEL]
ALERT_INFO = ["snapshot_date", "account_id", "cif", "branch_code", "product_code", "person_cluster_id", "ring_id", "ring_size", "hops_to_known_mule"]

FIRST_SNAPSHOT = date(2025, 5, 2)
HORIZON_DAYS = 90
MONEY_WINDOW_DAYS = 90
MAX_HOLD_HOURS = 720.0
MIN_MONTHLY_INCOME = 5000.0
MAX_HUB = 25
MIN_SHARED = 2
FAR_HOPS = 3
FRAUD_FREEZES = ["CYBER_COMPLAINT", "SUSPECT_REGISTRY", "INTERNAL_FRM"]
CONFIRMED = "CONFIRMED_MULE"
PERSON_LINKS = ["DEVICE", "MOBILE", "PAN", "ADDRESS"]
NO_TIER = "NONE"

POLICY = {
    "label": {"horizon_days": 90},
    "context": {"lookback_weeks": 26, "max_mules": 2000, "negatives_per_mule": 3, "book_mule_rate": 0.0007},
    "holdout": {"test_weeks": 4, "gap_days": 90, "negative_sample": 0.05},
    "gate": {"min_capture_top1pct": 0.40, "min_precision_top02pct": 0.10, "min_lift_over_rules": 1.2},
    "tiers": [
        {"code": "T1_FREEZE_REVIEW", "upto_pct": 0.002, "action": "Debit freeze pending video re-KYC (maker-checker)"},
        {"code": "T2_HOLD_MONITOR", "upto_pct": 0.010, "action": "Hold outward credits above INR 50,000; enhanced monitoring"},
        {"code": "T3_WATCHLIST", "upto_pct": 0.030, "action": "Watchlist; review at next login or large credit"},
    ],
    "rules": {
        "shared_device_accounts": 3, "shared_mobile_cifs": 2, "pass_through_ratio": 0.8, "hold_hours": 6, "inflow_multiple": 5,
        "distinct_senders_7d": 15, "new_account_days": 60, "night_share": 0.3, "device_or_mobile_changes": 1, "ring_size": 5,
    },
}

BANDS = [("top 0.2%", 0.002), ("0.2-1%", 0.01), ("1-3%", 0.03), ("3-5%", 0.05), ("5-10%", 0.10), ("10-25%", 0.25), ("rest", 1.0)]
