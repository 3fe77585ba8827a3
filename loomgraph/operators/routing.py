"""Guards, resolution of references, identities, codes and units, and the three-way outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAPPED, SOURCE_ONLY, REJECTED = "mapped", "source-only", "rejected"


def has_modifier(*arrays: Column) -> Column:
    out = F.lit(False)
    for a in arrays:
        out = out | F.coalesce(F.size(a) > 0, F.lit(False))
    return out


def present_values(**variants: Column) -> Column:
    """Which variant of a polymorphic element is there: its name, ``none`` or ``several``."""
    n = sum((v.isNotNull().cast("int") for v in variants.values()), F.lit(0))
    out = F.when(n == 0, "none").when(n > 1, "several")
    for name, v in variants.items():
        out = out.when(v.isNotNull(), name)
    return out


def resolve_identity(rows: DataFrame, reference: str, identity_map: DataFrame) -> DataFrame:
    """``rows`` with person_iri and n_candidates, and the evidence of the identity table, if it has any, after that of earlier
    references. Candidates are counted before the join, so an ambiguous reference never multiplies rows; its person is null, as
    is that of an unknown one."""
    shown = "evidence" in identity_map.columns
    n = F.min("evidence").alias("why") if shown else F.lit(None).cast("string").alias("why")
    known = identity_map.groupBy(F.col("source_ref").alias("ref_key")).agg(F.count_distinct("person_iri").alias("n_candidates"), F.min("person_iri").alias("one"), n)
    out = rows.join(known, F.col(reference) == F.col("ref_key"), "left")
    if shown:
        out = out.withColumn("evidence", F.concat_ws("; ", *[F.col("evidence")] * ("evidence" in rows.columns), "why"))
    return out.drop("why").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0))).withColumn("person_iri", F.when(F.col("n_candidates") == 1, F.col("one"))).drop("ref_key", "one")


def resolve_refs(rows: DataFrame, reference: Column, targets: DataFrame, key: str, contained: Column | None = None) -> DataFrame:
    """``rows`` with target_key: the key of the referred record, a contained id found in the same row, or null."""
    named = targets.select(F.col(key).alias("target_key")).distinct()
    out = rows.withColumn("ref_value", reference).join(named, F.col("ref_value") == F.col("target_key"), "left")
    if contained is not None:
        out = out.withColumn("target_key", F.coalesce("target_key", F.when(F.array_contains(contained, F.substring(F.col("ref_value"), F.lit(2), F.length("ref_value"))), F.col("ref_value"))))
    return out.drop("ref_value")


def _one_rule(rules: DataFrame, keys: dict[str, str], *values: str) -> DataFrame:
    """One row per key: the values of its only rule, null if rules disagree, and ``n_rules``, how many they are. Equal rules
    are one, so a repeated or a conflicting rule never multiplies records. Spark broadcasts the result if its size allows."""
    rows = rules.select(*[F.col(k).alias(name) for name, k in keys.items()], *values).distinct()
    n = F.count(F.lit(1))
    return rows.groupBy(*keys).agg(n.alias("n_rules"), *[F.when(n == 1, F.min(v)).alias(v) for v in values])


def type_by_code(rows: DataFrame, system: Column, code: Column, rules: DataFrame) -> DataFrame:
    """``rows`` with target_class and map_id of the reviewed rule; null if there is none or if rules disagree."""
    r = _one_rule(rules, {"r_system": "system", "r_code": "code"}, "target_class", "map_id")
    return rows.join(r, (system == F.col("r_system")) & (code == F.col("r_code")), "left").drop("r_system", "r_code", "n_rules")


def unit_node(rows: DataFrame, system: Column, code: Column, rules: DataFrame) -> DataFrame:
    """``rows`` with unit_iri; null if the unit is missing, not recognised, or rules disagree."""
    r = _one_rule(rules, {"u_system": "system", "u_code": "code"}, "unit_iri")
    return rows.join(r, (system == F.col("u_system")) & (code == F.col("u_code")), "left").drop("u_system", "u_code", "n_rules")


def eligibility(rows: DataFrame, status: Column, policy: DataFrame, resource_type: str) -> DataFrame:
    """``rows`` with status_outcome by policy; a status without a policy is source-only, one with several is rejected."""
    p = _one_rule(policy.where(F.col("resource_type") == resource_type), {"p_status": "status"}, "outcome").withColumnsRenamed({"outcome": "p_outcome", "n_rules": "p_rules"})
    out = F.when(F.col("p_rules") > 1, REJECTED).otherwise(F.coalesce("p_outcome", F.lit(SOURCE_ONLY)))
    return rows.join(p, status == F.col("p_status"), "left").withColumn("status_outcome", out).drop("p_status", "p_outcome", "p_rules")


def route(rows: DataFrame, reasons: dict[str, tuple[Column, str]], shape: Column | None = None) -> DataFrame:
    """``rows`` with outcome and reasons. ``reasons``: name to (condition, outcome). All that hold are listed; one that
    rejects outweighs one that keeps the source only. A row without any is mapped if it has the ``shape`` that its map
    asks for, and otherwise source-only with the reason "shape", so that none is lost between outcome and graph."""
    held = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, (c, _) in reasons.items()]))
    rejecting = F.lit(False)
    for c, outcome in reasons.values():
        if outcome == REJECTED:
            rejecting = rejecting | F.coalesce(c, F.lit(False))
    if shape is not None:
        held = F.when((F.size(held) == 0) & ~F.coalesce(shape, F.lit(False)), F.array(F.lit("shape"))).otherwise(held)
    return rows.withColumn("reasons", held).withColumn("outcome", F.when(rejecting, REJECTED).when(F.size("reasons") > 0, SOURCE_ONLY).otherwise(MAPPED))


def alternatives(rows: DataFrame, options: dict[str, Column]) -> DataFrame:
    """``rows`` with every alternative that matches, for inspection, whether there are several, and the only one."""
    matching = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in options.items()]))
    rows = rows.withColumn("alternatives", matching).withColumn("ambiguous", F.size("alternatives") > 1)
    return rows.withColumn("map_id", F.when(F.size("alternatives") == 1, F.get("alternatives", F.lit(0))))


def unknown_fields(rows: DataFrame, raw: str, allowed: list[str]) -> DataFrame:
    """``rows`` with the top-level elements of the raw JSON that no rule names (readers drop them silently)."""
    return rows.withColumn("unknown", F.array_sort(F.array_except(F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")), F.array(*[F.lit(a) for a in allowed]))))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    reason = F.explode_outer(F.when(F.size("reasons") > 0, F.col("reasons")))
    return outcomes.select("outcome", reason.alias("reason")).groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("n"))
