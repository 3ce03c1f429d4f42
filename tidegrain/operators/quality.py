"""Rule engine: predicates to counts, actions, table scores, run score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrain.functions.numbers import half_up

# Severity weights of the table score.
SEVERITY_WEIGHTS = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1}
# Table weights of the run score.
TABLE_WEIGHTS = {"clean_clients": 4.0, "clean_prices": 3.5, "clean_weather": 3.0, "clean_calculations": 3.0, "gold_fact_energy_forecast": 2.5,
                 "gold_dim_client": 2.0, "gold_dim_datetime": 1.5, "gold_dim_weather": 1.0}
# Lowest acceptable table score in percent.
TABLE_THRESHOLDS = {"clean_clients": 95.0, "clean_weather": 90.0, "clean_prices": 95.0, "clean_calculations": 92.0, "gold_dim_client": 98.0,
                    "gold_dim_datetime": 100.0, "gold_dim_weather": 95.0, "gold_fact_energy_forecast": 90.0}


@dataclass(frozen=True)
class Rule:
    """``predicate`` is SQL that holds for a good row of the ``scope``; ``tolerance`` is the accepted share of bad rows there."""

    id: str
    table: str
    predicate: str
    dimension: str
    severity: str
    tolerance: float = 0.0
    scope: str = "TRUE"


RESULT_COLUMNS = ["rule_id", "table_name", "dimension", "severity", "tolerance", "total", "failed"]


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate row rules of one table in a single pass; an unknown predicate (NULL) counts as failed."""
    cells = [
        F.struct(
            F.lit(r.id).alias("rule_id"), F.lit(r.table).alias("table_name"), F.lit(r.dimension).alias("dimension"), F.lit(r.severity).alias("severity"),
            F.lit(r.tolerance).cast("double").alias("tolerance"), F.count_if(F.expr(r.scope)).alias("total"),
            F.count_if(F.expr(r.scope) & ~F.coalesce(F.expr(r.predicate), F.lit(False))).alias("failed"),
        )
        for r in rules
    ]
    return df.agg(F.array(*cells).alias("_c")).select(F.inline("_c"))


def _one(df: DataFrame, rule: Rule, total: Column, failed: Column) -> DataFrame:
    return df.agg(total.cast("bigint").alias("total"), F.coalesce(failed, F.lit(0)).cast("bigint").alias("failed")).select(
        F.lit(rule.id).alias("rule_id"), F.lit(rule.table).alias("table_name"), F.lit(rule.dimension).alias("dimension"), F.lit(rule.severity).alias("severity"),
        F.lit(rule.tolerance).cast("double").alias("tolerance"), "total", "failed")


def unique_rule(df: DataFrame, keys: Sequence[str], rule: Rule) -> DataFrame:
    """Rows beyond the first of each key; counted per key with partial aggregation."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _one(per, rule, F.coalesce(F.sum("_n"), F.lit(0)), F.sum(F.col("_n") - 1))


def coverage_rule(df: DataFrame, keys: Sequence[str], least: int, rule: Rule) -> DataFrame:
    """Groups that hold fewer than ``least`` rows."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _one(per, rule, F.count(F.lit(1)), F.count(F.when(F.col("_n") < least, 1)))


def reference_rule(fact: DataFrame, dim: DataFrame, key: str, rule: Rule) -> DataFrame:
    """Fact rows without a dimension row; the fact is counted per key before the join."""
    per = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = dim.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    return _one(per.join(known, key, "left"), rule, F.coalesce(F.sum("_n"), F.lit(0)), F.sum(F.when(F.col("_known").isNull(), F.col("_n"))))


def dq_action(results: DataFrame) -> DataFrame:
    """Block, alert or record by severity and share of bad rows."""
    share = F.when(F.col("total") > 0, F.col("failed") / F.col("total")).otherwise(F.lit(0.0))
    s = F.col("severity")
    action = (
        F.when(F.col("failed") == 0, "PASS").when((s == "CRITICAL") | ((s == "HIGH") & (share > 0.05)), "BLOCK")
        .when((s == "HIGH") | ((s == "MEDIUM") & (share > 0.20)), "ALERT").otherwise("RECORD")
    )
    return results.withColumns({"failed_pct": half_up(share * F.lit(100.0), 4), "within_tolerance": (share <= F.col("tolerance")).cast("int").cast("bigint"), "action": action})


def lookup(c: Column, values: Mapping[str, float], default: float) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default))


def quality_score(results: DataFrame) -> DataFrame:
    """Severity-weighted pass rate per table, in percent."""
    weight = lookup(F.col("severity"), SEVERITY_WEIGHTS, 1)
    rate = F.when(F.col("total") > 0, F.lit(1.0) - F.col("failed") / F.col("total")).otherwise(F.lit(1.0))
    return results.groupBy("table_name").agg(half_up(F.lit(100.0) * F.sum(weight * rate) / F.sum(weight), 2).alias("quality_score"), F.count(F.lit(1)).alias("rules"))


def run_score(scores: DataFrame) -> DataFrame:
    """Weighted score of a run with its class and the number of tables below their threshold."""
    t = F.col("table_name")
    weight = lookup(t, TABLE_WEIGHTS, 1.0)
    low = F.count(F.when(F.col("quality_score") < lookup(t, TABLE_THRESHOLDS, 90.0), 1))
    out = scores.agg(half_up(F.sum(weight * F.col("quality_score")) / F.sum(weight), 2).alias("run_quality_score"), low.alias("tables_below_threshold"))
    q = F.col("run_quality_score")
    return out.withColumn("quality_class", F.when(q >= 97, "✅ EXCELENTE").when(q >= 90, "✅ BUENO").when(q >= 80, "⚠️ DEGRADADO").otherwise("🔴 CRÍTICO"))


def check_schema(df: DataFrame, record: str, required: Sequence[tuple[str, str]], integers: Sequence[str]) -> DataFrame:
    """Missing keys and wrong types of JSON records, one row per violation.

    ``required`` holds (code, JSON path); ``integers`` holds paths whose value must be a whole number.
    Each record is parsed once, into a variant that keeps the types of its values.
    """
    parsed = df.withColumn("_v", F.try_parse_json(record)).drop(record)

    def at(path: str) -> Column:
        return F.try_variant_get("_v", path, "variant")

    faults = [F.when(at(p).isNull(), F.concat(F.lit(f"{code} missing "), F.lit(p))) for code, p in required]
    for i, p in enumerate(integers, 1):
        faults.append(F.when(at(p).isNotNull() & (F.schema_of_variant(at(p)) != "BIGINT"), F.lit(f"T{i:02d} not an integer {p}")))
    listed = F.filter(F.array(*faults), lambda x: x.isNotNull())
    return parsed.select(*[c for c in df.columns if c != record], F.explode(listed).alias("violation"))
