"""Weighted evaluation of a ranking: top shares, capture, precision, ROC AUC, average precision, bands, gate.

All take rows with a label, a weight and a score, and one global order; ties go by a key, so that results are the same in
every run. Aggregates, not rows, come to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import BANDS
from .relational import numbered


def ordered(df: DataFrame, score: str, key: str, weight: str = "weight") -> DataFrame:
    """df with pos (from 1) and upto (running weight) in the order of falling scores."""
    return numbered(df, [F.col(score).desc(), F.col(key)], "pos", F.col(weight), "upto")


def top(total: float, share: float, first_weight: float) -> Column:
    """Whether a row is in the riskiest share: running weight within it, or the very first row."""
    return (F.col("upto") <= share * total) | (F.col("pos") == 1)


def shares(df: DataFrame, score: str, cuts: list[float], label: str = "y", key: str = "id", weight: str = "weight") -> dict[float, dict[str, float | None]]:
    """capture and precision of each top share; capture is None without positives, precision without rows."""
    rows = ordered(df, score, key, weight)
    total = rows.agg(F.sum(weight).alias("w"), F.sum(F.col(label) * F.col(weight)).alias("p")).first()
    if not total["w"]:
        return {c: {"capture": None, "precision": None} for c in cuts}
    hit = F.col(label) * F.col(weight)
    aggs = [a for i, c in enumerate(cuts) for a in (F.sum(F.when(top(total["w"], c, 1.0), hit)).alias(f"h{i}"), F.sum(F.when(top(total["w"], c, 1.0), F.col(weight))).alias(f"w{i}"))]
    got = rows.agg(*aggs).first()
    return {c: {"capture": (got[f"h{i}"] or 0.0) / total["p"] if total["p"] else None, "precision": (got[f"h{i}"] or 0.0) / got[f"w{i}"]} for i, c in enumerate(cuts)}


def score_groups(df: DataFrame, score: str, label: str = "y", weight: str = "weight") -> DataFrame:
    """(s, pos_w, neg_w, pos_upto, neg_upto) for each distinct score, sums running from the highest down to and with it."""
    w, y = F.col(weight), F.col(label)
    groups = df.groupBy(F.col(score).alias("s")).agg(F.sum(w * y).alias("pos_w"), F.sum(w * (1 - y)).alias("neg_w"))
    groups = numbered(groups, [F.col("s").desc()], "k", F.col("pos_w"), "pos_upto")
    return numbered(groups, [F.col("s").desc()], "k", F.col("neg_w"), "neg_upto")


def roc_auc(df: DataFrame, score: str, label: str = "y", weight: str = "weight") -> float | None:
    """The weighted share of pairs of a positive and a negative in the right order, ties by half; None for one class."""
    groups = score_groups(df, score, label, weight)
    above = F.col("pos_upto") - F.col("pos_w")
    got = groups.agg(F.sum(F.col("neg_w") * (above + F.col("pos_w") / 2)).alias("s"), F.sum("pos_w").alias("p"), F.sum("neg_w").alias("n")).first()
    return got["s"] / (got["p"] * got["n"]) if got["p"] and got["n"] else None


def average_precision(df: DataFrame, score: str, label: str = "y", weight: str = "weight") -> float | None:
    """The sum over distinct scores of precision times the gain in recall; None without positives."""
    groups = score_groups(df, score, label, weight)
    here = F.col("pos_w") * F.try_divide(F.col("pos_upto"), F.col("pos_upto") + F.col("neg_upto"))
    got = groups.agg(F.sum(here).alias("s"), F.sum("pos_w").alias("p")).first()
    return got["s"] / got["p"] if got["p"] else None


def _round(x: float | None) -> float | None:
    return None if x is None else round(x, 4)


def summary(test: DataFrame, label: str = "y", key: str = "id") -> dict:
    """The summary row of a holdout with columns y, weight, p and rules."""
    total = test.agg(F.count("*").alias("n"), F.sum(label).alias("y"), F.try_divide(F.sum(F.col(label) * F.col("weight")), F.sum("weight")).alias("r")).first()
    model, rules = shares(test, "p", [0.01, 0.05, 0.002], label, key), shares(test, "rules", [0.01], label, key)
    cap, rule_cap = model[0.01]["capture"], rules[0.01]["capture"]
    return {
        "holdout_rows": total["n"],
        "holdout_mules": int(total["y"] or 0),
        "holdout_mule_rate": _round(total["r"]),
        "holdout_auc": _round(roc_auc(test, "p", label)),
        "holdout_pr_auc": _round(average_precision(test, "p", label)),
        "capture_top1": _round(cap),
        "capture_top5": _round(model[0.05]["capture"]),
        "precision_top02": _round(model[0.002]["precision"]),
        "precision_top1": _round(model[0.01]["precision"]),
        "rules_capture_top1": _round(rule_cap),
        "rules_precision_top1": _round(rules[0.01]["precision"]),
        "lift_over_rules": _round(cap / rule_cap) if cap is not None and rule_cap else None,
    }


def bands(test: DataFrame, label: str = "y", key: str = "id") -> DataFrame:
    """Accounts, positives and cumulative capture by risk band, for the model's score p and for the rules' score."""
    spark = test.sparkSession
    rows = ordered(test, "p", key)
    total = rows.agg(F.sum("weight").alias("w"), F.sum(F.col(label) * F.col("weight")).alias("p")).first()
    w, positives = total["w"] or 0.0, max(total["p"] or 0.0, 1e-9)
    share = F.col("upto") / F.lit(w) if w else F.lit(1.0)
    band = F.lit(len(BANDS) - 1)
    for i in range(len(BANDS) - 2, -1, -1):
        band = F.when(share <= BANDS[i][1] + 1e-12, F.lit(i)).otherwise(band)
    hit = F.col(label) * F.col("weight")
    found = rows.groupBy(band.alias("i")).agg(F.sum("weight").alias("accounts"), F.sum(hit).alias("mules"), F.try_divide(F.sum(F.col("p") * F.col("weight")), F.sum("weight")).alias("mean_p"))
    cuts = [c for _, c in BANDS if c < 1]
    model, rules = shares(test, "p", cuts, label, key), shares(test, "rules", cuts, label, key)
    cum = [(i, name, c, 1.0 if c >= 1 else (model[c]["capture"] or 0.0) if total["p"] else 0.0, 1.0 if c >= 1 else (rules[c]["capture"] or 0.0) if total["p"] else 0.0) for i, (name, c) in enumerate(BANDS)]
    names = spark.createDataFrame(cum, "i int, band string, upto_pct double, cum_capture double, rules_cum_capture double")
    out = names.join(F.broadcast(found), "i", "left")
    return out.orderBy("i").select(
        "band", "upto_pct", F.round(F.coalesce("accounts", F.lit(0.0)), 1).alias("accounts"), F.round(F.coalesce("mules", F.lit(0.0)), 1).alias("mules"),
        F.round(F.try_divide(F.col("mules"), F.col("accounts")), 5).alias("mule_rate"), F.round("mean_p", 5).alias("mean_p_mule"),
        F.round("cum_capture", 4).alias("cum_capture"), F.round("rules_cum_capture", 4).alias("rules_cum_capture"),
    )


CHECKS = [("capture_top1", "min_capture_top1pct", "capture in top 1%"), ("precision_top02", "min_precision_top02pct", "precision in top 0.2% (T1 queue)"), ("lift_over_rules", "min_lift_over_rules", "lift over rules-only at top 1%")]


def gate(found: dict, limits: dict) -> tuple[bool, list[str]]:
    """Whether every configured check holds, and a line for each; a metric that is missing fails."""
    lines, passed = [], True
    for metric, limit, text in CHECKS:
        if limit in limits:
            value, least = found.get(metric), float(limits[limit])
            good = value is not None and value >= least
            passed &= good
            shown = "n/a" if value is None else f"{value:.3f}"
            lines.append(f"{'PASS' if good else 'FAIL'} {text}: {shown} (min {least:.3f})")
    return passed, lines
