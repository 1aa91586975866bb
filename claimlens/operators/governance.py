"""Model governance on tables: events, alias state, candidates, gates, promotion, rollback.

There is no registry service. An alias points to the target version of its latest event, so the
event table alone is the state, and a promotion is one append of a batch of events.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.functions.scoring import row_hash
from claimlens.operators.merge import merge_insert, merge_update

EVENT_SCHEMA = (
    "event_id string, event_timestamp timestamp, model_name string, action string, previous_version string, "
    "target_version string, model_alias string, validation_status string, approved_by string, reason string, "
    "metadata_json string"
)
MANIFEST_SCHEMA = (
    "manifest_id string, captured_at timestamp, model_name string, model_version string, run_id string, "
    "experiment_id string, source_table string, source_table_version bigint, source_table_timestamp timestamp, "
    "source_notebook string, git_commit string, parameters_json string, metrics_json string, random_seed int, "
    "mlflow_version string, model_signature_status string, environment_status string, "
    "reproducibility_status string, limitations string, source_content_digest string"
)
# Columns that a repeated event or validation replaces; the others keep their first value.
EVENT_UPDATES = ["event_timestamp", "validation_status", "approved_by", "reason", "metadata_json"]
GATE_UPDATES = ["validation_timestamp", "gate_status", "observed_value", "required_value", "details"]

CHAMPION, CANDIDATE, PREVIOUS, ROLLED_BACK = "Champion", "Candidate", "PreviousChampion", "RolledBack"


def as_int(version: str | Column) -> Column:
    """Versions are text; compare them as numbers, or "9" beats "10"."""
    return (F.col(version) if isinstance(version, str) else version).try_cast("int")


# --- merges of the three tables ------------------------------------------------------------


def record_events(log: DataFrame, events: DataFrame) -> DataFrame:
    """The log after a merge by event id: a known event is renewed, a new one comes in."""
    return merge_update(log, events, ["event_id"], EVENT_UPDATES)


def record_gates(results: DataFrame, gates: DataFrame) -> DataFrame:
    """The gate results after a merge by validation id."""
    return merge_update(results, gates, ["validation_id"], GATE_UPDATES)


def record_manifest(manifests: DataFrame, row: DataFrame) -> DataFrame:
    """The manifests after an insert-only merge: the first one of an id stays."""
    return merge_insert(manifests, row, ["manifest_id"])


# --- event log and alias state ---------------------------------------------------------


def alias_state(events: DataFrame) -> DataFrame:
    """The version each (model, alias) points to now: the target of its latest event.

    Row number 1 is kept per task before the shuffle, so a busy model does not load one task.
    """
    latest = W.partitionBy("model_name", "model_alias").orderBy(F.desc("event_timestamp"), F.desc("event_id"))
    return (
        events.withColumn("_n", F.row_number().over(latest))
        .filter("_n = 1")
        .select("model_name", "model_alias", F.col("target_version").alias("version"), "event_timestamp", "event_id")
    )


def event_history(events: DataFrame, newest_first: bool = True) -> DataFrame:
    direction = F.desc if newest_first else F.asc
    return events.select(
        "event_id", "event_timestamp", "action", "previous_version", "target_version", "model_alias", "validation_status", "approved_by", "reason"
    ).orderBy(direction("event_timestamp"), direction("event_id"))


def check_aliases(state: DataFrame, expected: dict[str, str], model_name: str) -> None:
    """The aliases of one model must be exactly as expected (a handful of rows)."""
    names = sorted(expected)
    found = {
        r["model_alias"]: r["version"]
        for r in state.filter((F.col("model_name") == model_name) & F.col("model_alias").isin(names)).collect()
    }
    wrong = {a: found.get(a) for a in names if found.get(a) != expected[a]}
    if wrong:
        raise ValueError(f"alias state of {model_name}: expected {expected}, found {wrong}")


def newest_ready(versions: DataFrame) -> DataFrame:
    """The newest READY version per model, compared as a number."""
    return versions.filter(F.col("status") == "READY").groupBy("model_name").agg(F.max(as_int("version")).alias("version"))


def new_candidates(wanted: DataFrame, existing: DataFrame, marker: str = "marker") -> DataFrame:
    """Candidates whose marker is not taken yet: a repeated request creates nothing."""
    return wanted.join(existing.select("model_name", marker), ["model_name", marker], "left_anti")


# --- manifest -------------------------------------------------------------------------------


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free content digest of a table, standing for its data version.

    A row's digest is the first 64 bits of the MD5 of its columns as text, each with its length, null apart from empty; the digest of the
    table is their sum modulo 2^64. It is combined map-side, does not depend on the order of rows, counts repeated rows, and any
    SQL engine with MD5 computes the same.
    """
    text = [F.coalesce(F.concat(F.char_length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in df.columns]
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *text)), 1, 16), 16, 10).cast("decimal(20,0)")
    total = F.coalesce(F.sum(row), F.lit(0)).cast("decimal(38,0)") % F.lit(str(1 << 64)).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("filas"), total.cast("decimal(20,0)").cast("string").alias("huella"))


def manifest(
    source: DataFrame, manifest_id: str, model_name: str, version: str, parameters: dict, metrics: dict,
    captured_at: datetime, source_table: str, run_id: str | None = None, git_commit: str | None = None,
) -> DataFrame:
    """One manifest row: what is needed to repeat the training of a version.

    The data version is the row count together with the content digest, which has a column of its own.
    """
    facts = content_fingerprint(source)
    none = F.lit(None).cast("string")
    complete = git_commit is not None
    row = facts.select(
        F.lit(manifest_id).alias("manifest_id"),
        F.lit(captured_at).cast("timestamp").alias("captured_at"),
        F.lit(model_name).alias("model_name"),
        F.lit(version).alias("model_version"),
        F.lit(run_id).cast("string").alias("run_id"),
        none.alias("experiment_id"),
        F.lit(source_table).alias("source_table"),
        F.col("filas").alias("source_table_version"),
        F.lit(captured_at).cast("timestamp").alias("source_table_timestamp"),
        none.alias("source_notebook"),
        F.lit(git_commit).cast("string").alias("git_commit"),
        F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in parameters.items()])).alias("parameters_json"),
        F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in metrics.items()])).alias("metrics_json"),
        F.lit(parameters.get("seed")).cast("int").alias("random_seed"),
        none.alias("mlflow_version"),
        F.lit("REGISTERED").alias("model_signature_status"),
        F.lit("PARTIAL").alias("environment_status"),
        F.lit("COMPLETE" if complete else "PARTIAL").alias("reproducibility_status"),
        F.lit("" if complete else "NO_CODE_VERSION").alias("limitations"),
        F.col("huella").alias("source_content_digest"),
    )
    return row


# --- gates ------------------------------------------------------------------------------------


def gate_results(pairs: DataFrame, validated_at: Column, limits: C.GateLimits = C.GateLimits()) -> DataFrame:
    """Nine gate rows per candidate.

    ``pairs`` has one row per candidate next to its champion: model_name, champion_version,
    candidate_version, status, run_status, roc_auc, area_under_pr, top20_capture, champion_roc_auc,
    seed, git_commit. A missing figure fails its gate, and so does a missing champion; a missing code version is only a warning.
    """

    def verdict(ok: Column, otherwise: str = "FAIL") -> Column:
        return F.when(ok, "PASS").otherwise(otherwise)

    def text(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("None"))

    def figure(value: Column) -> Column:
        """Six decimals, so that a figure reads alike in every engine: whole millionths of the product of doubles, halves away from zero.

        Cast at once, a double goes to a decimal by its shortest text here and by such a product elsewhere; they part next to a half.
        """
        millionths = F.round(value * 1e6).cast("decimal(18,0)")
        return text((millionths * F.expr("0.000001BD")).cast("decimal(18,6)"))

    c = F.col
    loss = c("roc_auc") - c("champion_roc_auc")
    has_commit = c("git_commit").isNotNull() & (c("git_commit") != "")
    gates = [
        ("MODEL_READY", verdict(c("status") == "READY"), text(c("status")), F.lit("READY"), "the version must be available"),
        (
            "SEPARATE_FROM_CHAMPION",
            verdict(c("candidate_version") != c("champion_version")),
            text(c("candidate_version")),
            F.concat(F.lit("not "), text(c("champion_version"))),
            "candidate and champion must be two versions",
        ),
        ("RUN_FINISHED", verdict(c("run_status") == "FINISHED"), text(c("run_status")), F.lit("FINISHED"), "training must have ended well"),
        ("MIN_ROC_AUC", verdict(c("roc_auc") >= limits.roc_auc), figure(c("roc_auc")), F.lit(f">= {limits.roc_auc}"), "floor for discrimination"),
        ("MIN_AREA_UNDER_PR", verdict(c("area_under_pr") >= limits.area_under_pr), figure(c("area_under_pr")), F.lit(f">= {limits.area_under_pr}"), "floor for finding positives"),
        ("MIN_TOP20_CAPTURE", verdict(c("top20_capture") >= limits.top20_capture), figure(c("top20_capture")), F.lit(f">= {limits.top20_capture}"), "floor for ranking in the first fifth"),
        ("MAX_ROC_DEGRADATION", verdict(loss >= -limits.roc_loss), figure(loss), F.lit(f">= -{limits.roc_loss}"), "no material loss against the champion"),
        ("RANDOM_SEED_REGISTERED", verdict(c("seed").isNotNull()), text(c("seed")), F.lit("required"), "training must be repeatable"),
        ("CODE_VERSION_REGISTERED", verdict(has_commit, "WARNING"), F.when(has_commit, c("git_commit")).otherwise("NO_REGISTRADO"), F.lit("required"), "code must be traceable"),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("gate_name"), s.alias("gate_status"), o.alias("observed_value"), r.alias("required_value"), F.lit(d).alias("details"))
            for n, s, o, r, d in gates
        ]
    )
    return pairs.select("model_name", "champion_version", "candidate_version", F.inline(rows)).select(
        F.concat_ws("-", "model_name", F.concat(F.lit("v"), F.col("candidate_version")), "gate_name").alias("validation_id"),
        validated_at.alias("validation_timestamp"),
        "model_name",
        "champion_version",
        "candidate_version",
        "gate_name",
        "gate_status",
        "observed_value",
        "required_value",
        "details",
    )


def gate_decision(gates: DataFrame) -> DataFrame:
    """FAIL if any gate fails, PASS_WITH_EXCEPTION if any warns, else PASS; counts per outcome."""
    status = F.col("gate_status")
    return gates.groupBy("model_name", "candidate_version").agg(
        F.count_if(status == "FAIL").alias("fallos"),
        F.count_if(status == "WARNING").alias("advertencias"),
        F.element_at(
            F.array(F.lit("PASS"), F.lit("PASS_WITH_EXCEPTION"), F.lit("FAIL")),
            F.max(F.when(status == "FAIL", 3).when(status == "WARNING", 2).otherwise(1)),
        ).alias("decision"),
    )


def latest_candidate_report(results: DataFrame) -> DataFrame:
    """Gate rows of each model's newest candidate, worst first (versions compared as numbers)."""
    newest = results.groupBy("model_name").agg(F.max(as_int("candidate_version")).alias("_v"))
    order = F.when(F.col("gate_status") == "FAIL", 1).when(F.col("gate_status") == "WARNING", 2).otherwise(3)
    return (
        results.join(newest, "model_name")
        .filter(as_int("candidate_version") == F.col("_v"))
        .select("model_name", "candidate_version", "gate_name", "gate_status", "observed_value", "required_value", "details")
        .orderBy("model_name", order, "gate_name")
    )


def metric_comparison(champion: DataFrame, candidate: DataFrame) -> DataFrame:
    """Champion and candidate metrics side by side; one that a side lacks has a null delta. In: model_name, metric, value."""
    a = champion.select("model_name", "metric", F.col("value").alias("champion_value"))
    b = candidate.select("model_name", "metric", F.col("value").alias("candidate_value"))
    return a.join(b, ["model_name", "metric"], "full").withColumn("delta", F.col("candidate_value") - F.col("champion_value"))


# --- promotion and rollback -------------------------------------------------------------------


def promotion_decisions(pairs: DataFrame, allow_exception: bool = True) -> DataFrame:
    """What a promotion of each candidate would do. In: champion_version, candidate_version, decision."""
    decision = F.col("decision")
    return pairs.withColumn(
        "resultado",
        F.when(F.col("champion_version") == F.col("candidate_version"), "NO_CHANGE")
        .when(decision == "PASS", "PROMOTE")
        .when((decision == "PASS_WITH_EXCEPTION") & F.lit(allow_exception), "PROMOTE")
        .otherwise("BLOCKED"),
    )


def _events(rows: DataFrame, at: datetime, by: str | None, meta: dict, moves: list[tuple]) -> DataFrame:
    """Event rows from (suffix, action, old, new, alias, status, reason) per input row.

    ``rows`` needs ``model_name`` and ``_stem``; all moves of a row come out together.
    """

    def column(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value).cast("string")

    made = F.array(
        *[
            F.struct(
                F.concat(F.col("_stem"), F.lit(suffix)).alias("event_id"),
                column(action).alias("action"),
                column(old).alias("previous_version"),
                column(new).alias("target_version"),
                column(alias).alias("model_alias"),
                column(status).alias("validation_status"),
                column(reason).alias("reason"),
            )
            for suffix, action, old, new, alias, status, reason in moves
        ]
    )
    return rows.select("model_name", F.inline(made)).select(
        "event_id",
        F.lit(at).cast("timestamp").alias("event_timestamp"),
        "model_name",
        "action",
        "previous_version",
        "target_version",
        "model_alias",
        "validation_status",
        (F.current_user() if by is None else F.lit(by)).alias("approved_by"),
        "reason",
        F.lit(json.dumps(meta)).alias("metadata_json"),
    )


def promotion_events(decided: DataFrame, at: datetime, approved_by: str | None, ticket: str) -> DataFrame:
    """The events of all allowed promotions, to be appended to the log in one write; without an approver the session's user records them.

    ``decided`` comes from ``promotion_decisions``; only its PROMOTE rows give events. One event
    keeps the champion as PreviousChampion, one moves Champion to the candidate. They are written
    together, so a reader sees both or none and there is nothing to put back.
    """
    old, new, status = F.col("champion_version"), F.col("candidate_version"), F.col("decision")
    rows = decided.filter(F.col("resultado") == "PROMOTE").withColumn(
        "_stem", F.concat(F.lit("PROMOTE-"), "model_name", F.lit("-v"), old, F.lit("-to-v"), new, F.lit(f"-{ticket}"))
    )
    meta = {"approval_ticket": ticket, "rollback_alias": PREVIOUS, "candidate_alias": CANDIDATE}
    return _events(
        rows, at, approved_by, meta,
        [
            ("-keep", "KEEP_PREVIOUS", None, old, PREVIOUS, status, "recovery point"),
            ("", "PROMOTE", old, new, CHAMPION, status, "controlled promotion"),
        ],
    )


def rollback_events(events: DataFrame, at: datetime, approved_by: str | None, ticket: str) -> DataFrame:
    """The events that move Champion back to PreviousChampion and keep the withdrawn version.

    Models without a recovery point, or already on it, give none.
    """
    state = alias_state(events)
    pairs = state.groupBy("model_name").agg(
        F.max(F.when(F.col("model_alias") == CHAMPION, F.col("version"))).alias("_now"),
        F.max(F.when(F.col("model_alias") == PREVIOUS, F.col("version"))).alias("_back"),
    )
    now, back = F.col("_now"), F.col("_back")
    rows = pairs.filter(now != back).withColumn(
        "_stem", F.concat(F.lit("ROLLBACK-"), "model_name", F.lit("-v"), now, F.lit("-to-v"), back, F.lit(f"-{ticket}"))
    )
    meta = {"rollback_ticket": ticket, "rolled_back_alias": ROLLED_BACK, "recovery_alias": PREVIOUS}
    return _events(
        rows, at, approved_by, meta,
        [
            ("-keep", "KEEP_WITHDRAWN", None, now, ROLLED_BACK, "RESTORED", "kept for analysis"),
            ("", "ROLLBACK", now, back, CHAMPION, "RESTORED", "controlled rollback"),
        ],
    )


def promote(
    events: DataFrame, model_name: str, decision: str | None, at: datetime, approved_by: str, ticket: str, allow_exception: bool = False
) -> DataFrame:
    """The events that promote the candidate of one model; none if it is champion already.

    A failed, missing or unknown decision, or an exception nobody approved, is an error.
    """
    state = alias_state(events.filter(F.col("model_name") == model_name))
    now = {r["model_alias"]: r["version"] for r in state.collect()}  # one row per alias
    if CANDIDATE not in now or CHAMPION not in now:
        raise ValueError(f"{model_name} needs a champion and a candidate, found {sorted(now)}")
    row = [(model_name, now[CHAMPION], now[CANDIDATE], decision)]
    pair = events.sparkSession.createDataFrame(row, "model_name string, champion_version string, candidate_version string, decision string")
    decided = promotion_decisions(pair, allow_exception)
    if decided.first()["resultado"] == "BLOCKED":
        raise ValueError(f"promotion of {model_name} blocked by validation status {decision}")
    return promotion_events(decided, at, approved_by, ticket)


def roll_back(events: DataFrame, model_name: str, at: datetime, approved_by: str, ticket: str) -> DataFrame:
    """The events that restore the previous champion of one model; none if it is restored already."""
    own = events.filter(F.col("model_name") == model_name)
    if own.filter(F.col("model_alias") == PREVIOUS).isEmpty():
        raise ValueError(f"{model_name} has no version to go back to")
    return rollback_events(own, at, approved_by, ticket)
