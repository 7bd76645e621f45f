"""The daily run: holdout and gate, context, scoring, tiers, reasons, rings, publication; and what serves single requests."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import FEATURE_COLUMNS, FEATURES, LABEL, NO_TIER, POLICY
from ..functions.scalars import prior_corrected
from ..operators import evaluate as ev
from ..operators import quality
from ..operators import score as sc
from ..operators import scorers
from ..session import cut

RUN = (
    "run_date date, run_id string, run_ts timestamp, model_family string, model_id string, model_version string, device string, snapshot_date date, scored_accounts int, alerts_t1 int, alerts_t2 int, alerts_t3 int, "
    "t1_cutoff double, t2_cutoff double, t3_cutoff double, context_rows int, context_mules int, context_negatives int, context_from date, context_to date, context_mule_rate double, book_mule_rate double, book_rate_source string, "
    "source_table string, source_snapshot_id string, holdout_test_from date, holdout_test_to date, holdout_context_rows int, holdout_rows int, holdout_mules int, holdout_mule_rate double, holdout_auc double, holdout_pr_auc double, "
    "capture_top1 double, capture_top5 double, precision_top02 double, precision_top1 double, rules_capture_top1 double, rules_precision_top1 double, lift_over_rules double, gate_passed boolean, gate_detail string, alerts_published boolean, "
    "policy_json string, triggered_by string, duration_s double"
)
DECISIONS = "decision_id string, run_date date, account_id string, cif string, decision string, action string, maker string, checker string, notes string, decided_at timestamp, ingested_at timestamp"


@dataclass
class Outcome:
    run: dict
    alerts: DataFrame
    rings: DataFrame
    holdout: DataFrame | None
    published: bool
    gate: list[str] = field(default_factory=list)


def in_order(run_id_date: date) -> str:
    return f"{run_id_date:%Y%m%d}-{uuid.uuid4().hex[:8]}"


def run(store, run_date: date | None = None, family: str = "stub", policy: dict | None = None, scorer: scorers.Scorer | None = None, triggered_by: str = "manual", publish_on_fail: bool = False, with_holdout: bool = True, write: bool = True, on_done: Callable[[dict], None] | None = None) -> Outcome:
    """Scores the book of a day with what was known then, and publishes its alerts if the gate holds.

    All reads are of one version of the feature table, which the run row names. A failed gate withholds alerts and rings; run
    row and holdout are written anyway. What was published is checked against the run row, and the findings are recorded."""
    began, policy = time.monotonic(), policy or POLICY
    spark: SparkSession = store.spark
    version = store.version("mule_features")
    book_all = store.read("mule_features", version).select(*FEATURE_COLUMNS)
    run_date = run_date or sc.latest_date(book_all)
    known_to = run_date - timedelta(days=policy["label"]["horizon_days"])
    dates = [d for d in sc.labelled_dates(book_all) if d <= known_to]
    if not dates:
        raise ValueError(f"no labelled snapshot up to {known_to}")
    on = scorers.device(spark)
    family = family if scorer else scorers.resolved(family, on)
    fit, ctx, run_id = scorer or scorers.FAMILIES[family].fit, policy["context"], in_order(run_date)

    def sample(last: date) -> tuple[DataFrame, date]:
        first = last - timedelta(weeks=ctx["lookback_weeks"])
        return cut(sc.context(book_all, first, last, scorers.max_positives(ctx, family, on), ctx["negatives_per_mule"])), first

    summary: dict = {}
    bands, passed, lines = None, True, ["holdout skipped"]
    test_from = test_to = held_rows = None
    if with_holdout:
        h = policy["holdout"]
        test_from, test_to, known = sc.test_window(dates, h["test_weeks"], h["gap_days"])
        held, _ = sample(known)
        held_rows = held.count()
        test = fit(held)(sc.holdout_sample(book_all, test_from, test_to, h["negative_sample"]))
        test = cut(test.select(F.concat_ws("|", "account_id", "snapshot_date").alias("id"), F.col(LABEL).alias("y"), "weight", "p", sc.rules_score(policy["rules"]).alias("rules")))
        summary, bands = ev.summary(test), ev.bands(test)
        passed, lines = ev.gate(summary, policy["gate"])

    context, first = sample(dates[-1])
    seen = context.agg(F.count("*").alias("n"), F.sum(LABEL).alias("y")).first()
    rate, source = sc.labelled_rate(book_all, first, dates[-1]), "measured"
    if not rate or not 0 < rate < 1:
        rate, source = float(ctx["book_mule_rate"]), "policy fallback"
    book = book_all.where(F.col("snapshot_date") == F.lit(run_date))
    scored = cut(fit(context)(book).withColumn("p_adj", prior_corrected(F.col("p"), seen["y"] / seen["n"], rate)))
    n = scored.count()
    if not n:
        raise ValueError(f"no rows on {run_date}: run dates are snapshot dates")
    ranked = sc.ranked_book(scored, policy["tiers"])
    # only alerted accounts get reasons
    why = sc.with_reasons(book.join(ranked.where(F.col("tier") != NO_TIER).select("account_id"), "account_id"), policy["rules"]).select("account_id", "reason_codes", "reasons")
    ranked = ranked.join(why, "account_id", "left").withColumns({"reason_codes": F.coalesce("reason_codes", F.lit("")), "reasons": F.coalesce("reasons", F.lit(""))})
    ranked = cut(ranked)
    stamp = {"run_date": F.lit(run_date), "run_id": F.lit(run_id)}
    alerts, rings = ranked.where(F.col("tier") != NO_TIER).withColumns(stamp), sc.ring_rollup(ranked).withColumns(stamp)
    tiers, publish = sc.cutoffs(ranked), passed or publish_on_fail
    codes = [t["code"] for t in policy["tiers"]][:3]
    row = {
        "run_date": run_date, "run_id": run_id, "run_ts": datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None), "model_family": family, "model_id": family, "model_version": None, "device": on, "snapshot_date": run_date, "scored_accounts": n,
        "context_rows": seen["n"], "context_mules": int(seen["y"]), "context_negatives": seen["n"] - int(seen["y"]), "context_from": first, "context_to": dates[-1], "context_mule_rate": round(seen["y"] / seen["n"], 5),
        "book_mule_rate": round(rate, 7), "book_rate_source": source, "source_table": "mule_features", "source_snapshot_id": str(version), "holdout_test_from": test_from, "holdout_test_to": test_to, "holdout_context_rows": held_rows,
        "gate_passed": passed, "gate_detail": " | ".join(lines), "alerts_published": publish, "policy_json": json.dumps(policy, sort_keys=True), "triggered_by": triggered_by, "duration_s": round(time.monotonic() - began, 1),
    }
    row |= {f"alerts_t{i + 1}": tiers.get(c, (0, None))[0] for i, c in enumerate(codes)} | {f"t{i + 1}_cutoff": tiers.get(c, (0, None))[1] for i, c in enumerate(codes)} | summary
    if write:
        names = [c.split()[0] for c in RUN.split(", ")]
        store.replace_where("mule_model_run", spark.createDataFrame([tuple(row.get(c) for c in names)], RUN), "run_date", run_date)
        if bands is not None:
            store.replace_where("mule_holdout", bands.withColumns(stamp), "run_date", run_date)
        if publish:
            store.replace_where("mule_alerts", alerts, "run_date", run_date)
            store.replace_where("mule_rings", rings, "run_date", run_date)
        published = {t: store.read(t) for t in ("mule_model_run", "mule_alerts", "mule_rings", "mule_holdout") if store.exists(t)}
        store.append("dq_results", quality.recorded(spark, quality.publish_suite(published | {"mule_features": book_all}, run_date), "publish", run_date))
    if on_done:
        on_done(row)
    return Outcome(row, alerts, rings, bands, publish, lines)


def backfill(store, dates: Iterable[date], **options) -> list[Outcome]:
    """A run for each date, as if on that day."""
    return [run(store, run_date=d, triggered_by="backfill", **options) for d in sorted(dates)]


def decide(store, rows: DataFrame) -> int:
    """Appends investigators' decisions."""
    return store.append("investigator_decisions", rows)


# ---------------------------------------------------------------- requests

MOST_ACCOUNTS = 1000


def checked(request: dict) -> tuple[list[dict], dict]:
    """The accounts and the overlay of a request. Raises ValueError with what is wrong."""
    accounts, overlay = request.get("accounts"), request.get("what_if") or {}
    if not isinstance(accounts, list) or not accounts:
        raise ValueError("accounts: a list of one account or more is needed")
    if len(accounts) > MOST_ACCOUNTS:
        raise ValueError(f"accounts: at most {MOST_ACCOUNTS}, not {len(accounts)}")
    if not isinstance(overlay, dict):
        raise ValueError("what_if: an object is needed")

    def number(where: str, name: str, value) -> float:
        if isinstance(value, bool) or not isinstance(value, (int, float)) or not math.isfinite(value):
            raise ValueError(f"{where}: {name} is not a finite number")
        return float(value)

    if unknown := sorted(set(overlay) - set(FEATURES)):
        raise ValueError(f"what_if: unknown features {', '.join(unknown)}")
    rows = []
    for i, a in enumerate(accounts):
        if not isinstance(a, dict):
            raise ValueError(f"account {i}: an object is needed")
        if missing := [f for f in FEATURES if a.get(f) is None]:
            raise ValueError(f"account {i}: missing {', '.join(missing)}")
        rows.append({"account_id": str(a.get("account_id", i))} | {f: number(f"account {i}", f, a[f]) for f in FEATURES})
    return rows, {k: number("what_if", k, v) for k, v in overlay.items()}


class Endpoint:
    """Scores single requests with the context, rates and cut-offs of the latest published run."""

    def __init__(self, store, family: str | None = None, policy: dict | None = None, scorer: scorers.Scorer | None = None):
        self.spark, self.policy = store.spark, policy or POLICY
        last = store.read("mule_model_run").orderBy(F.desc("run_ts")).limit(1).collect()
        if not last:
            raise ValueError("no run to serve from")
        self.run = r = last[0].asDict()
        features = store.read("mule_features", int(r["source_snapshot_id"])).select(*FEATURE_COLUMNS)
        c = self.policy["context"]
        on = scorers.device(self.spark)
        name = r["model_family"] if scorer else scorers.resolved(family or r["model_family"], on)
        context = cut(sc.context(features, r["context_from"], r["context_to"], scorers.max_positives(c, name, on), c["negatives_per_mule"]))
        self.score_rows = (scorer or scorers.FAMILIES[name].fit)(context)
        self.cutoffs = [r["t1_cutoff"], r["t2_cutoff"], r["t3_cutoff"]]

    def _scored(self, rows: list[dict]) -> list[dict]:
        schema = ", ".join(["i int", "account_id string", *(f"{f} double" for f in FEATURES)])
        frame = self.spark.createDataFrame([(i, r["account_id"], *[r[f] for f in FEATURES]) for i, r in enumerate(rows)], schema)
        out = self.score_rows(frame).withColumn("p_adj", prior_corrected(F.col("p"), self.run["context_mule_rate"], self.run["book_mule_rate"]))
        out = sc.with_reasons(out, self.policy["rules"])
        tiers = self.policy["tiers"]
        out = out.select("i", "account_id", F.round("p", 5).alias("p_mule"), F.round("p_adj", 6).alias("p_mule_adj"), sc.tier_by_cutoffs(F.col("p_adj"), self.cutoffs, tiers).alias("tier"), sc.tier_by_cutoffs(F.col("p_adj"), self.cutoffs, tiers, "action").alias("action"), "reason_codes", "reasons")
        return [{k: v for k, v in r.asDict().items() if k != "i"} for r in sorted(out.collect(), key=lambda r: r["i"])]  # at most MOST_ACCOUNTS rows

    def __call__(self, request: dict) -> dict:
        rows, overlay = checked(request)
        scores = self._scored(rows)
        if overlay:
            for s, w in zip(scores, self._scored([r | overlay for r in rows]), strict=True):
                s |= {f"{k}_what_if": v for k, v in w.items() if k != "account_id"}
        r = self.run
        return {"scores": scores, "model": {"model_id": r["model_id"], "run_id": r["run_id"], "context_rows": r["context_rows"], "context_to": str(r["context_to"]), "source_snapshot_id": r["source_snapshot_id"]}}
