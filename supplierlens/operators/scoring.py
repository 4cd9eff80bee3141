"""Component scores, grades and the overall score."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplierlens.functions.numeric import clamp_score, pct

DEFAULT_RULES = Path(__file__).parent.parent / "plans" / "rules.json"
SCORED = "SCORED"
TOO_FEW_COMPONENTS = "INSUFFICIENT COMPONENT COVERAGE"


@dataclass(frozen=True)
class Component:
    """One scored component: its rule key, column prefix, metric and status texts."""

    rule: str
    prefix: str
    metric: str
    sample: str
    too_few: str
    no_metric: str | None
    minimum_key: str = "minimum_sample"

    @property
    def score(self) -> str:
        return f"{self.prefix}_prototype_score"

    @property
    def grade(self) -> str:
        return f"{self.prefix}_prototype_grade"

    @property
    def status(self) -> str:
        return f"{self.prefix}_score_status"


# Metrics and status vocabulary, in the order scores are added up.
COMPONENTS = (
    Component("on_time_delivery", "delivery", "on_time_delivery_pct", "delivery_eligible_count",
              "INSUFFICIENT SAMPLE", "NO VALID DELIVERY METRIC"),
    Component("quality", "quality", "supplier_linked_ncr_rate_pct", "po_transaction_count",
              "INSUFFICIENT PO SAMPLE", None, "minimum_po_transactions"),
    Component("lead_time", "lead_time", "lead_time_adherence_pct", "lead_time_eligible_count",
              "INSUFFICIENT BENCHMARK DATA", "NO VALID LEAD-TIME METRIC"),
    Component("responsiveness", "responsiveness", "responsiveness_proxy_pct",
              "responsiveness_eligible_ncr_count",
              "INSUFFICIENT RESPONSE EVENTS", "NO VALID RESPONSIVENESS METRIC"),
    Component("commercial", "commercial", "price_stability_pct", "price_comparison_count",
              "INSUFFICIENT PRICE HISTORY", "NO VALID COMMERCIAL METRIC"),
)


def load_rules(path: str | Path = DEFAULT_RULES) -> dict:
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def rules_table(spark: SparkSession, rules: dict) -> DataFrame:
    """The component rules as rows."""
    rows = [
        (c.rule, r["label"], float(r["weight"]), int(r[c.minimum_key]),
         float(r["ncr_rate_penalty_factor"]) if "ncr_rate_penalty_factor" in r else None)
        for c in COMPONENTS for r in [rules["components"][c.rule]]
    ]
    return spark.createDataFrame(
        rows, "component string, label string, weight double, minimum_sample int, penalty double")


def thresholds(rules: dict) -> list[tuple[str, float]]:
    """Grades with their minimum score, best first."""
    return sorted(rules["grade_thresholds"].items(), key=lambda g: g[1], reverse=True)


def thresholds_table(spark: SparkSession, rules: dict) -> DataFrame:
    return spark.createDataFrame([(g, float(m)) for g, m in thresholds(rules)],
                                 "grade string, minimum_score double")


def grade(score: Column, rules: dict) -> Column:
    ladder = F.when(score.isNull(), "N/A")
    for letter, minimum in thresholds(rules):
        ladder = ladder.when(score >= minimum, letter)
    return ladder.otherwise("N/A")


def _raw_metric(c: Component, rules: dict) -> Column:
    if c.rule != "quality":
        return F.col(c.metric)
    factor = rules["components"]["quality"]["ncr_rate_penalty_factor"]
    rate = F.coalesce("supplier_linked_ncr_count", F.lit(0)) / F.col("po_transaction_count") * 100
    return 100 - rate * factor


def with_component_scores(vendors: DataFrame, rules: dict) -> DataFrame:
    vendors = vendors.withColumn(
        "supplier_linked_ncr_rate_pct",
        pct(F.col("supplier_linked_ncr_count"), F.col("po_transaction_count")))
    scores = {}
    for c in COMPONENTS:
        minimum = rules["components"][c.rule][c.minimum_key]
        sample = F.col(c.sample)
        status = F.when(sample.isNull() & F.lit(c.no_metric is None), c.too_few)
        status = status.when(sample < minimum, c.too_few)
        if c.no_metric:
            status = status.when(F.col(c.metric).isNull(), c.no_metric)
        scores[c.status] = status.otherwise(SCORED)
    vendors = vendors.withColumns(scores)
    vendors = vendors.withColumns({
        c.score: F.when(F.col(c.status) == SCORED, clamp_score(_raw_metric(c, rules)))
        for c in COMPONENTS
    })
    return vendors.withColumns({c.grade: grade(F.col(c.score), rules) for c in COMPONENTS})


def with_overall(vendors: DataFrame, rules: dict) -> DataFrame:
    """Weighted mean of the scored components; missing ones do not count as zero."""
    weighted, weight, scored = F.lit(0.0), F.lit(0.0), F.lit(0)
    for c in COMPONENTS:
        w = float(rules["components"][c.rule]["weight"])
        present = F.col(c.score).isNotNull()
        weighted = weighted + F.coalesce(F.col(c.score) * w, F.lit(0.0))
        weight = weight + F.when(present, w).otherwise(0.0)
        scored = scored + F.when(present, 1).otherwise(0)
    total = float(sum(rules["components"][c.rule]["weight"] for c in COMPONENTS))
    needed = rules["overall"]["minimum_available_components"]
    vendors = vendors.withColumns({"prototype_scored_component_count": scored, "_weight": weight,
                                   "_weighted": weighted})
    enough = (F.col("prototype_scored_component_count") >= needed) & (F.col("_weight") > 0)
    vendors = vendors.withColumns({
        "prototype_weight_coverage_pct": F.col("_weight") / F.lit(total) * 100,
        "prototype_overall_score": F.when(enough, F.col("_weighted") / F.col("_weight")),
        "prototype_overall_status": F.when(enough, SCORED).otherwise(TOO_FEW_COMPONENTS),
    }).drop("_weight", "_weighted")
    return vendors.withColumn("prototype_overall_grade",
                              grade(F.col("prototype_overall_score"), rules))


def score_vendors(vendors: DataFrame, rules: dict) -> DataFrame:
    return with_overall(with_component_scores(vendors, rules), rules)
