"""The ordered rule cascade and the evidence it rests on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.prefix import covering
from tidewell.sources import layout


def decide(now: Column) -> list[Column]:
    """``rule``, ``action``, ``reasons`` from the facts of one row: ``status``, ``signal_flag``, ``discovered_at``,
    ``reprocessed_at`` (timestamps), ``label``, ``label_source``, ``label_at``, ``siblings`` (array of labels),
    ``protected`` (array of reasons), ``auto_label``, ``auto_reason``, ``name``. The first rule that applies wins:
    busy or young P2; protected P1 (R1 if its own label says delete); label delete D1, or R1 with problems;
    label interrogate or an unlabelled bad signal R1; otherwise K0."""
    label, siblings = F.col("label"), F.coalesce("siblings", F.array().cast("array<string>"))
    busy = F.col("status").isin(*layout.BUSY_STATUSES)
    young = F.col("discovered_at").isNotNull() & (F.col("discovered_at") > now - F.expr(f"INTERVAL {layout.ACTIVE_DAYS} DAYS"))
    guarded = F.array_compact(F.concat(
        F.coalesce("protected", F.array().cast("array<string>")), F.array(F.when(label == "keep", "labelled keep")),
        F.array(F.when(F.array_contains(siblings, "keep"), "a sibling copy is labelled keep")),
    ))
    problems = F.array_compact(F.array(
        F.when(F.coalesce("label_source", F.lit("human")) != "human", "label is not from a person"),
        F.when(F.exists(siblings, lambda x: x != "delete"), "a sibling copy has another label"),
        F.when(F.col("label_at") < F.col("reprocessed_at"), "label is older than the last processing"),
        F.when((F.col("auto_label") == "keep") & (F.col("auto_reason") == "motion_detected"), "automatic triage saw motion"),
        F.when(F.col("name").rlike(layout.BEAD_OR_PSF), "looks like a bead or PSF recording"),
    ))
    held, delete = F.size(guarded) > 0, label == "delete"
    bad = F.col("signal_flag").isin(*layout.BAD_SIGNALS) & label.isNull()
    cases = [
        (busy, "P2", "KEEP", F.array(F.concat(F.lit("status is "), "status"))), (young, "P2", "KEEP", F.array(F.lit("discovered recently"))),
        (held & delete, "R1", "REVIEW", F.array_prepend(guarded, F.lit("label is delete but dataset is protected"))), (held, "P1", "KEEP", F.array_append(guarded, F.lit("protected: nothing derived from it is offered"))),
        (delete & (F.size(problems) > 0), "R1", "REVIEW", problems), (delete, "D1", "SUGGEST_DELETE", F.array(F.lit("labelled delete"))),
        (label == "interrogate", "R1", "REVIEW", F.array(F.lit("labelled interrogate"))), (bad, "R1", "REVIEW", F.array(F.concat(F.lit("signal is "), "signal_flag"))),
    ]
    rule, action, reasons = F.lit("K0"), F.lit("KEEP"), F.array(F.lit("no evidence for deletion"))
    for when, r, a, why in reversed(cases):
        rule, action, reasons = F.when(when, r).otherwise(rule), F.when(when, a).otherwise(action), F.when(when, why).otherwise(reasons)
    return [rule.alias("rule"), action.alias("action"), reasons.alias("reasons")]


def overall_status(stages: DataFrame, key: str, stage: str, status: str, last_stage: str, flag: Column) -> DataFrame:
    """One status per key: blocked, failed, done, running, in_progress, pending, whichever applies first."""
    has = lambda v: F.bool_or(F.coalesce(F.col(status) == v, F.lit(False)))
    agg = stages.groupBy(key).agg(
        has("failed").alias("f"), has("running").alias("r"), F.count(status).alias("n"), F.max(flag).alias("flag"),
        F.bool_or(F.coalesce((F.col(stage) == last_stage) & (F.col(status) == "done"), F.lit(False))).alias("d"),
    )
    out = F.when(F.col("f") & (F.col("flag") == "blocked"), "blocked").when(F.col("f"), "failed").when(F.col("d"), "done").when(F.col("r"), "running").when(F.col("n") > 0, "in_progress").otherwise("pending")
    return agg.select(key, out.alias("overall"))


def protected_reasons(rows: DataFrame, named: DataFrame, pins: DataFrame, key: str = "key", path: str = "path") -> DataFrame:
    """Reasons per row: a lookup by key, and pinned prefixes (plain string prefixes, no component boundary), which meet
    the paths in a merge of intervals."""
    pinned = covering(rows.select(key, path), path, pins, "pin", sep=None, name="pins_")
    hit = pinned.select(key, F.explode("pins_").alias("pin")).select(key, F.concat(F.lit("pinned: "), "pin").alias("why")).union(named.select(key, "why"))
    return rows.join(hit.groupBy(key).agg(F.sort_array(F.collect_set("why")).alias("protected")), key, "left")


def report_diff(old: DataFrame, new: DataFrame, keys: list[str], stamp: str, kept: str) -> DataFrame:
    """What became of each old row: gone, changed, other keeper, same."""
    now = new.select(*keys, F.col(stamp).alias("s_"), F.col(kept).alias("k_"), F.lit(True).alias("here_"))
    what = F.when(F.col("here_").isNull(), "missing").when(~F.col("s_").eqNullSafe(F.col(stamp)), "changed").when(~F.col("k_").eqNullSafe(F.col(kept)), "other keeper").otherwise("same")
    return old.join(now, keys, "left").withColumn("outcome", what).drop("s_", "k_", "here_")
