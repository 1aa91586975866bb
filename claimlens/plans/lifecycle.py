"""Model life cycle on tables: versions, baseline, candidate, gates, promotion, rollback."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.operators import governance as G
from claimlens.operators.merge import new_rows
from claimlens.sources.tables import append, replace_partitions, table_or_empty

VERSION_SCHEMA = (
    "model_name string, version string, status string, run_status string, roc_auc double, area_under_pr double, "
    "top20_capture double, seed int, git_commit string, model_path string, marker string"
)


@dataclass(frozen=True)
class LifecycleTables:
    """Names of the tables. Versions, events and manifests only grow; the gate results of a
    candidate are one partition, replaced as a whole when it is validated again."""

    versions: str = "model_versions"
    events: str = "model_governance_events"
    gates: str = "model_validation_results"
    manifests: str = "model_reproducibility_manifest"
    location: str | None = None


def _empty_or(spark: SparkSession, name: str, schema: str) -> DataFrame:
    return table_or_empty(spark, name, spark.createDataFrame([], schema).schema)


def versions(spark: SparkSession, tables: LifecycleTables) -> DataFrame:
    return _empty_or(spark, tables.versions, VERSION_SCHEMA)


def events(spark: SparkSession, tables: LifecycleTables) -> DataFrame:
    return _empty_or(spark, tables.events, G.EVENT_SCHEMA)


def aliases(spark: SparkSession, tables: LifecycleTables, model: str) -> dict[str, str]:
    """Where the aliases of one model point now."""
    state = G.alias_state(events(spark, tables).filter(F.col("model_name") == model))
    return {r["model_alias"]: r["version"] for r in state.collect()}


def log(spark: SparkSession, tables: LifecycleTables, new: DataFrame) -> None:
    """Append the events that are not in the log yet, in one write."""
    append(new_rows(new, events(spark, tables), ["event_id"]), tables.events, None, tables.location)


def add_version(spark: SparkSession, tables: LifecycleTables, model: str, marker: str, **facts) -> str:
    """Add a version unless one with this marker exists; returns its number either way."""
    known = versions(spark, tables).filter(F.col("model_name") == model)
    found = known.filter(F.col("marker") == marker).select("version").first()
    if found:
        return found["version"]
    last = known.agg(F.max(G.as_int("version"))).first()[0] or 0
    row = {"status": "READY", "run_status": "FINISHED", **facts, "model_name": model, "version": str(last + 1), "marker": marker}
    append(spark.createDataFrame([row], VERSION_SCHEMA), tables.versions, None, tables.location)
    return row["version"]


def point(
    spark: SparkSession, tables: LifecycleTables, model: str, alias: str, version: str, event_id: str, at: datetime, by: str, action: str, reason: str = ""
) -> None:
    """Log one event that points an alias to a version (baseline, candidate)."""
    row = (event_id, at, model, action, None, version, alias, "APPROVED" if alias == G.CHAMPION else "PENDING", by, reason, None)
    log(spark, tables, spark.createDataFrame([row], G.EVENT_SCHEMA))


def validate(spark: SparkSession, tables: LifecycleTables, model: str, at: datetime) -> str:
    """Run the nine gates for the candidate, store them, and return the decision."""
    now = aliases(spark, tables, model)
    known = versions(spark, tables).filter(F.col("model_name") == model)
    champion = known.filter(F.col("version") == now[G.CHAMPION]).select("model_name", F.col("version").alias("champion_version"), F.col("roc_auc").alias("champion_roc_auc"))
    candidate = known.filter(F.col("version") == now[G.CANDIDATE]).withColumnRenamed("version", "candidate_version")
    gates = G.gate_results(candidate.join(champion, "model_name"), F.lit(at).cast("timestamp"))
    replace_partitions(gates, tables.gates, ["model_name", "candidate_version"], tables.location)
    return decision(spark, tables, model, now[G.CANDIDATE])


def decision(spark: SparkSession, tables: LifecycleTables, model: str, version: str) -> str | None:
    """The decision from the stored gates of one version; None if it was never validated."""
    stored = spark.table(tables.gates) if spark.catalog.tableExists(tables.gates) else None
    if stored is None:
        return None
    row = G.gate_decision(stored.filter((F.col("model_name") == model) & (F.col("candidate_version") == version))).first()
    return row["decision"] if row else None


def promote(spark: SparkSession, tables: LifecycleTables, model: str, at: datetime, by: str, ticket: str, allow_exception: bool = False) -> bool:
    """Promote the candidate if its stored gates allow it; False when it is champion already."""
    now = aliases(spark, tables, model)
    outcome = decision(spark, tables, model, now.get(G.CANDIDATE, ""))
    new = G.promote(events(spark, tables), model, outcome, at, by, ticket, allow_exception)
    if new.isEmpty():
        return False
    log(spark, tables, new)
    return True


def roll_back(spark: SparkSession, tables: LifecycleTables, model: str, at: datetime, by: str, ticket: str) -> bool:
    """Restore the previous champion; False when it is restored already."""
    new = G.roll_back(events(spark, tables), model, at, by, ticket)
    if new.isEmpty():
        return False
    log(spark, tables, new)
    return True


def store_manifest(spark: SparkSession, tables: LifecycleTables, row: DataFrame) -> None:
    """Keep a manifest once."""
    append(new_rows(row, _empty_or(spark, tables.manifests, G.MANIFEST_SCHEMA), ["manifest_id"]), tables.manifests, None, tables.location)
