"""A seeded synthetic world: units of customers with accounts, transfers, sessions and reports, as nested rows and flat extracts.

Each unit has a random generator of its own, so that a world is the same however it is dealt to tasks."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import FIRST_SNAPSHOT, FRAUD_FREEZES

CUSTOMER = "cif string, customer_name string, dob date, gender string, pan string, aadhaar_ref string, mobile string, email string, address_line string, city string, pincode string, kyc_type string, onboarding_channel string, onboarding_date date, home_branch string, occupation string, declared_annual_income double"
ACCOUNT = "account_id string, cif string, product_code string, branch_code string, open_date date, status string, dormant_from date, reactivated_on date, freeze_date date, freeze_reason string"
TXN = "txn_id string, utr string, txn_ts timestamp, account_id string, direction string, amount double, payer_vpa string, payee_vpa string, counterparty_account_id string, counterparty_ifsc string, channel string, remarks string"
SESSION = "session_id string, cif string, session_ts timestamp, channel string, device_id string, ip_address string, geo_city string, event_type string, new_value string, account_id string"
REPORT = "report_id string, report_ts timestamp, source string, reported_account_id string, reported_vpa string, reported_mobile string, complainant_vpa string, amount double, txn_utr string, category string, remarks string"
WORLD = f"unit bigint, customers array<struct<{CUSTOMER.replace(' ', ':').replace(',:', ',')}>>, accounts array<struct<{ACCOUNT.replace(' ', ':').replace(',:', ',')}>>, txns array<struct<{TXN.replace(' ', ':').replace(',:', ',')}>>, sessions array<struct<{SESSION.replace(' ', ':').replace(',:', ',')}>>, reports array<struct<{REPORT.replace(' ', ':').replace(',:', ',')}>>"
EXTRACTS = {"kyc_onboarding": "customers", "cbs_accounts": "accounts", "upi_transactions": "txns", "digital_sessions": "sessions", "fraud_reports": "reports"}
KEYS = {"kyc_onboarding": "cif", "cbs_accounts": "account_id", "upi_transactions": "txn_id", "digital_sessions": "session_id", "fraud_reports": "report_id"}

BRANCHES = [(f"B{i:02d}", f"Branch {i}", ("Pune", "Delhi", "Chennai", "Kolkata")[i % 4], ("West", "North", "South", "East")[i % 4], ("MH", "DL", "TN", "WB")[i % 4]) for i in range(12)]
PRODUCTS = [("SB", "Savings", "1"), ("CA", "Current", "2"), ("SAL", "Salary", "3")]
START = FIRST_SNAPSHOT - timedelta(days=31)


def unit_rows(unit: int, seed: int, days: int, mule_share: float) -> dict:
    """One unit's nested row: one to three customers, rarely a ring that shares a device and passes money on."""
    rng = np.random.default_rng([seed, unit])
    ring = bool(rng.random() < mule_share)
    people = int(rng.integers(3, 7)) if ring else int(rng.integers(1, 4))
    device, address, mobile = f"dev-{unit}", f"{unit} Long Road", f"9{unit % 10**9:09d}"
    out: dict[str, list] = {k: [] for k in ("customers", "accounts", "txns", "sessions", "reports")}
    started = START + timedelta(days=int(rng.integers(30, max(31, days - 60)))) if ring else None

    def moment(day: int) -> datetime:
        hour = int(rng.choice([23, 0, 2, 14])) if ring else int(rng.integers(7, 22))
        return datetime.combine(START + timedelta(days=day), datetime.min.time()) + timedelta(hours=hour, seconds=int(rng.integers(0, 3600)))

    for p in range(people):
        cif = f"C{unit:08d}{p}"
        letters = "".join(chr(65 + int(x)) for x in rng.integers(0, 26, 6))
        opened = START - timedelta(days=int(rng.integers(5, 60) if ring else rng.integers(60, 2000)))
        own_mobile = mobile if ring and p < 2 else f"8{(unit * 7 + p) % 10**9:09d}"
        out["customers"].append({"cif": cif, "customer_name": f" Person {unit}-{p} ", "dob": date(1970, 1, 1) + timedelta(days=int(rng.integers(0, 12000))), "gender": str(rng.choice(["F", "M"])), "pan": f"{letters[:5]}{int(rng.integers(0, 10000)):04d}{letters[5]}", "aadhaar_ref": f"{int(rng.integers(10**11, 10**12))}", "mobile": f"+91-{own_mobile}", "email": f"p{unit}.{p}@mail.example", "address_line": address, "city": BRANCHES[unit % 12][2], "pincode": f"{400000 + unit % 1000}", "kyc_type": "min_kyc" if ring and p else "full_kyc", "onboarding_channel": "APP", "onboarding_date": opened, "home_branch": BRANCHES[unit % 12][0], "occupation": "salaried", "declared_annual_income": float(rng.integers(2, 15)) * 1e5})
        frozen = started + timedelta(days=int(rng.integers(20, 80))) if ring and rng.random() < 0.7 else None
        reason = str(rng.choice(FRAUD_FREEZES)) if frozen else None
        account = f"A{unit:08d}{p}"
        out["accounts"].append({"account_id": account, "cif": cif, "product_code": PRODUCTS[(unit + p) % 3][0], "branch_code": BRANCHES[unit % 12][0], "open_date": opened, "status": "frozen" if frozen else "active", "dormant_from": None, "reactivated_on": None, "freeze_date": frozen, "freeze_reason": reason})
        vpa = f"{account.lower()}@bank"
        for day in range(days):
            today = START + timedelta(days=day)
            if frozen and today > frozen:
                break
            busy = ring and started and today >= started
            for k in range(int(rng.poisson(3 if busy else 0.25))):
                at = moment(day)
                amount = float(rng.integers(1, 40)) * (1000 if busy else 37)
                other = f"payer{int(rng.integers(0, 5000))}@bank"
                base = f"{account}-{day}-{k}"
                credit = busy or bool(rng.random() < 0.5)
                out["txns"].append({"txn_id": base, "utr": f"U{base}", "txn_ts": at, "account_id": account, "direction": "CR" if credit else "DR", "amount": amount, "payer_vpa": other if credit else vpa, "payee_vpa": vpa if credit else other, "counterparty_account_id": None, "counterparty_ifsc": None, "channel": "upi", "remarks": None})
                if busy:
                    to = (p + 1) % people
                    out["txns"].append({"txn_id": base + "-out", "utr": f"U{base}o", "txn_ts": at + timedelta(minutes=int(rng.integers(5, 240))), "account_id": account, "direction": "DR", "amount": amount * 0.95, "payer_vpa": vpa, "payee_vpa": f"a{unit:08d}{to}@bank", "counterparty_account_id": f"A{unit:08d}{to}" if to != p else None, "counterparty_ifsc": None, "channel": "upi", "remarks": None})
                    if rng.random() < 0.02:
                        out["reports"].append({"report_id": f"R{base}", "report_ts": at + timedelta(days=int(rng.integers(1, 10))), "source": "ncrp", "reported_account_id": account if rng.random() < 0.5 else None, "reported_vpa": vpa, "reported_mobile": own_mobile, "complainant_vpa": other, "amount": amount, "txn_utr": f"U{base}", "category": "UPI fraud", "remarks": None})
            if rng.random() < 0.06:
                out["sessions"].append({"session_id": f"S{account}-{day}", "cif": cif, "session_ts": moment(day), "channel": "APP", "device_id": f"{device}" if ring or p == 0 else f"{device}-{p}", "ip_address": f"10.{unit % 250}.{p}.{day % 250}", "geo_city": BRANCHES[unit % 12][2], "event_type": "login", "new_value": None, "account_id": account})
        if ring and started:
            out["sessions"].append({"session_id": f"S{account}-m", "cif": cif, "session_ts": datetime.combine(started, datetime.min.time()) + timedelta(hours=3), "channel": "APP", "device_id": device, "ip_address": f"10.{unit % 250}.9.9", "geo_city": BRANCHES[unit % 12][2], "event_type": "mobile_change", "new_value": mobile, "account_id": account})
    return {"unit": unit, **out}


def world(spark: SparkSession, units: int, seed: int = 42, days: int = 200, mule_share: float = 0.02, tasks: int | None = None) -> DataFrame:
    """A nested row for each unit."""

    def run(frames):
        for frame in frames:
            for unit in frame["id"]:
                yield pd.DataFrame([unit_rows(int(unit), seed, days, mule_share)])

    return spark.range(0, units, 1, tasks or spark.sparkContext.defaultParallelism).mapInPandas(run, WORLD)


def extracts(nested: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """The five extracts as they stand on a day: later rows are gone, later facts of earlier rows are null."""
    end = F.date_add(F.lit(as_of), 1).cast("timestamp")

    def known(column: str) -> Column:
        return F.when(F.col(column) <= F.lit(as_of), F.col(column))

    out = {name: nested.select(F.inline(array)) for name, array in EXTRACTS.items()}
    out["kyc_onboarding"] = out["kyc_onboarding"].where(F.col("onboarding_date") <= F.lit(as_of))
    accounts = out["cbs_accounts"].where(F.col("open_date") <= F.lit(as_of))
    frozen = F.col("freeze_date") <= F.lit(as_of)
    accounts = accounts.withColumns({"freeze_reason": F.when(frozen, F.col("freeze_reason")), "status": F.when(F.coalesce(frozen, F.lit(False)) | (F.col("status") != "frozen"), F.col("status")).otherwise("active")})
    out["cbs_accounts"] = accounts.withColumns({c: known(c) for c in ("dormant_from", "reactivated_on", "freeze_date")})
    for name, column in (("upi_transactions", "txn_ts"), ("digital_sessions", "session_ts"), ("fraud_reports", "report_ts")):
        out[name] = out[name].where(F.col(column) < end)
    stamp = {"batch_as_of": F.lit(as_of), "ingested_at": F.lit(as_of).cast("timestamp")}
    return {name: df.withColumns(stamp) for name, df in out.items()}


def resent(df: DataFrame, key: str, one_in: int = 200) -> DataFrame:
    """df with some rows sent again a second later, chosen by hash of the key."""
    again = df.where(F.pmod(F.xxhash64(key), F.lit(one_in)) == 0)
    return df.unionByName(again.withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 1 second")))


def spoiled(txn: DataFrame, rows: int = 50) -> DataFrame:
    """Transactions with bad ones among them: amounts below zero and an unknown direction, for the first rows by id."""
    bad = txn.orderBy("txn_id").limit(rows)
    return txn.unionByName(bad.withColumns({"txn_id": F.concat("txn_id", F.lit("-bad")), "amount": -F.col("amount"), "direction": F.lit("XX")}))


def references(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "branch_map": spark.createDataFrame(BRANCHES, "branch_code string, branch_name string, city string, region string, state string"),
        "product_map": spark.createDataFrame(PRODUCTS, "product_code string, product_name string, account_prefix string"),
        "bank_devices": spark.createDataFrame([("kiosk-1", "KIOSK", "B00")], "device_id string, device_type string, branch_code string"),
    }


def bronze(spark: SparkSession, units: int, as_of: date, **options) -> dict[str, DataFrame]:
    """Extracts with re-sent rows, and the reference tables."""
    flat = extracts(world(spark, units, **options), as_of)
    return {name: df if name == "cbs_accounts" else resent(df, KEYS[name]) for name, df in flat.items()} | references(spark)
