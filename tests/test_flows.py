from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimlens import config as C
from claimlens.operators import governance as G
from claimlens.operators import model as MD
from claimlens.plans import training as TR
from claimlens.plans.batch_scoring import ScoringTables, quality_report, run_report, score_batch, unscored
from claimlens.sources import claims as A
from claimlens.sources.tables import append
from claimlens.streaming.arrivals import score_arrivals

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source"))
    A.scoring_input(spark, SMALL).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def formula(df):
    return df.withColumn("score_fraude", F.col("score_formula"))


def tables(name, folder):
    return ScoringTables(f"s_{name}", f"g_{name}", f"r_{name}", folder)


def audit(spark, t):
    return {r.id_ejecucion: r for r in spark.table(t.runs).collect()}


def test_incremental_scoring(spark, source, folder):
    t = tables("inc", folder)
    first = score_batch(source.filter("lote = 0"), formula, "m:1", t, run_id="a")
    assert first.state == "SUCCESS" and first.received == first.published == source.filter("lote = 0").count()
    second = score_batch(source, formula, "m:1", t, run_id="b")
    assert second.published == source.filter("lote > 0").count()
    assert score_batch(source, formula, "m:1", t, run_id="c").state == "NO_DATA"
    assert score_batch(source, formula, "m:2", t, run_id="d").published == source.count()
    runs = audit(spark, t)
    assert {k: v.estado for k, v in runs.items()} == {"a": "SUCCESS", "b": "SUCCESS", "c": "NO_DATA", "d": "SUCCESS"}
    assert runs["c"].mensaje_error == C.NO_DATA_MESSAGE and runs["a"].registros_error == 0
    assert spark.table(t.stage).count() == 0
    summary, row = run_report(spark, t, "d")
    assert sum(r.casos for r in summary.collect()) == source.count() and row.count() == 1


def test_repeated_run_publishes_nothing_twice(spark, source, folder):
    t = tables("rep", folder)
    score_batch(source, formula, "m:1", t, run_id="a")
    before = spark.table(t.scores).select(C.KEY, "score_fraude").orderBy(C.KEY).collect()
    score_batch(source, lambda df: df.withColumn("score_fraude", F.lit(0.0)), "m:1", t, run_id="a")
    assert spark.table(t.scores).select(C.KEY, "score_fraude").orderBy(C.KEY).collect() == before


def test_interrupted_publication_is_completed(spark, source, folder):
    t = tables("cut", folder)
    score_batch(source.filter("lote = 0"), formula, "m:1", t, run_id="a")
    # The run is started again with everything: what it published before is not published twice.
    result = score_batch(source, formula, "m:1", t, run_id="a")
    assert result.published == source.count() == spark.table(t.scores).count()


def test_failures_are_recorded_and_raised(spark, source, folder):
    t = tables("bad", folder)
    with pytest.raises(ValueError, match="more than once"):
        score_batch(source.unionByName(source), formula, "m:1", t, run_id="dup")
    with pytest.raises(ValueError, match="without"):
        score_batch(source.withColumn(C.KEY, F.when(F.col("lote") == 0, " ").otherwise(F.col(C.KEY))), formula, "m:1", t, run_id="blank")
    with pytest.raises(ValueError, match="missing"):
        score_batch(source.drop("A_o"), formula, "m:1", t, run_id="schema")
    with pytest.raises(ValueError, match="outcome"):
        score_batch(source.withColumn("label", F.lit(1.0)), formula, "m:1", t, run_id="leak")
    assert {k: v.estado for k, v in audit(spark, t).items()} == dict.fromkeys(["dup", "blank", "schema", "leak"], "FAILED")
    assert not spark.catalog.tableExists(t.scores)


def test_a_run_id_belongs_to_one_version(spark, source, folder):
    t = tables("owned", folder)
    score_batch(source, formula, "m:1", t, run_id="a")
    before = audit(spark, t)
    with pytest.raises(ValueError, match="belongs to another model version"):
        score_batch(source, formula, "m:2", t, run_id="a")
    rows = {r.id_ejecucion: r for r in spark.table(t.runs).collect()}
    assert rows["a"].estado == "SUCCESS" and rows["a"].version_modelo == "m:1"
    assert rows["a@m:2"].estado == "FAILED" and rows["a@m:2"].registros_exitosos == 0
    assert spark.table(t.scores).filter("version_modelo = 'm:2'").count() == 0 and before
    assert score_batch(source, formula, "m:2", t, run_id="b").published == source.count()


def test_scorer_with_other_inputs_is_refused(spark, source, folder):
    t = tables("inputs", folder)

    def scorer(df):
        return formula(df)

    scorer.features = C.FEATURES[::-1]
    with pytest.raises(ValueError, match="approved order"):
        score_batch(source, scorer, "m:1", t, run_id="a")
    long = "first line\n" + "x" * 900
    with pytest.raises(RuntimeError):
        score_batch(source, lambda df: (_ for _ in ()).throw(RuntimeError(long)), "m:1", t, run_id="b")
    assert {r.id_ejecucion: r.mensaje_error for r in spark.table(t.runs).collect()}["b"] == long


def test_null_keys_survive_the_anti_join(spark):
    claims = spark.createDataFrame([("a",), (None,)], "id_reclamacion string")
    scores = spark.createDataFrame([("a", "m:1"), (None, "m:1"), ("b", "m:2")], "id_reclamacion string, version_modelo string")
    assert [r[0] for r in unscored(claims, scores, "m:1").collect()] == [None]
    assert unscored(claims, scores, "m:2").count() == 2


def test_quality_report(source):
    rows = quality_report(source).collect()
    assert len(rows) == 16 and rows[0].valores_faltantes >= rows[-1].valores_faltantes


def test_arrivals_are_scored_once(spark, source, folder):
    t = tables("arr", folder)
    arriving, checkpoint = f"{folder}/arriving", f"{folder}/checkpoint"
    source.filter("lote = 0").write.parquet(arriving)

    def go():
        score_arrivals(spark, arriving, source.schema, formula, "m:1", checkpoint, t).awaitTermination(120)

    go()
    assert spark.table(t.scores).count() == source.filter("lote = 0").count()
    source.filter("lote = 1").write.mode("append").parquet(arriving)
    go()
    go()
    assert spark.table(t.scores).count() == source.filter("lote < 2").count()
    assert {r.modo_scoring for r in spark.table(t.runs).collect()} == {"stream"}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    raw = A.claims(spark, SMALL).drop("score_formula", "lote")
    return TR.train(raw, model_path=str(tmp_path_factory.mktemp("model") / "best"))


def test_training_compares_three_models(spark, trained):
    assert {t.name for t in trained.trained} == {"logistic_regression", "random_forest", "gradient_boosting"}
    assert all(0.0 < t.roc_auc < 1.0 and 0.0 < t.area_under_pr < 1.0 for t in trained.trained)
    assert trained.best.area_under_pr == max(t.area_under_pr for t in trained.trained)
    n = trained.train.count() + trained.test.count()
    assert trained.train.count() == int(n * 0.75) and trained.scored.count() == trained.test.count()
    lift = trained.lift.collect()
    assert [r.decil for r in lift] == list(range(1, 11)) and sum(r.casos for r in lift) == trained.test.count()
    assert all(a.score_min >= b.score_max for a, b in zip(lift, lift[1:]))
    scores = trained.scored.agg(F.min("score_fraude"), F.max("score_fraude")).first()
    assert 0.0 <= scores[0] <= scores[1] <= 1.0
    names = TR.save_results(trained, "entrenamiento")
    assert spark.table(names[0]).count() == 3 and spark.table(names[1]).count() == 10
    assert set(spark.table(names[2]).columns) <= set(C.SCORED_TEST_COLUMNS)


def test_training_is_repeatable(spark, trained):
    rows = [trained.train, trained.test]
    before, fitted = spark.conf.get("spark.sql.shuffle.partitions"), []
    for setting in (before, "7"):  # the session's setting has no say
        spark.conf.set("spark.sql.shuffle.partitions", setting)
        fitted += MD.fit_all(*rows, names=["random_forest"])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    a, b = fitted
    assert a.area_under_pr == b.area_under_pr
    doubles = trained.test.withColumns({f: F.col(f).cast("double") for f in C.FEATURES})
    assert MD.model_equivalence(a.model, b.model, doubles).first().max_diferencia_score == 0.0


def test_linear_model_gives_the_probabilities_of_its_pipeline(spark, trained, folder):
    """Coefficients, divisors and fill values of a saved pipeline as one expression, nulls and NaN included."""
    fitted = next(t for t in trained.trained if t.name == "logistic_regression")
    MD.save_model(fitted.model, f"{folder}/model")
    loaded = MD.load_model(f"{folder}/model")
    linear = MD.linear_model(loaded)
    odd = {C.FEATURES[0]: F.lit(None).cast("double"), C.FEATURES[1]: F.lit(float("nan"))}
    rows = trained.test.withColumns({f: F.col(f).cast("double") for f in C.FEATURES})
    for frame in (rows, rows.withColumns(odd)):
        both = MD.apply_model(loaded, linear(frame).withColumnRenamed("score_fraude", "linear"), "by_model")
        assert both.filter(F.abs(F.col("linear") - F.col("by_model")) > 1e-12).count() == 0
    medians = MD.exact_medians(trained.train, C.FEATURES)
    assert list(linear.fill) == [medians[f] for f in C.FEATURES] and list(linear.features) == C.FEATURES


def test_placement_follows_the_rows_and_is_kept(spark, trained):
    assert [MD.placement_of(n) for n in (0, 10**6, 16 * 10**6, 16 * 10**6 + 1, 10**11)] == [16, 16, 16, 17, 100_000]
    facts = trained.best.parameters()
    assert facts == {"placement": 16, "seed": C.SEED}
    row = G.manifest(trained.train, "id", "m", "1", facts, {}, datetime(2026, 1, 1), "t").first()
    assert row.parameters_json == '{"placement":16,"seed":42}'


def test_contract_sample(trained):
    sample = MD.contract_sample(trained.test)
    assert sample.columns == C.FEATURES and sample.count() == 10 and {t for _, t in sample.dtypes} == {"double"}
    assert '"name": "A_o"' in MD.input_signature()


def test_unapproved_feature_stops_training(spark):
    raw = A.claims(spark, SMALL).drop("score_formula", "lote").withColumn("Extra", F.lit(1))
    with pytest.raises(ValueError, match="not approved"):
        TR.split_frame(raw)


MODEL = "m"


def event(id, day, action, version, alias):
    return (id, datetime(2026, 1, day), MODEL, action, None, version, alias, "APPROVED", "yo", "", None)


@pytest.fixture()
def log(spark):
    rows = [event("b", 1, "BASELINE_SNAPSHOT", "1", G.CHAMPION), event("c", 2, "REGISTER", "2", G.CANDIDATE)]
    return spark.createDataFrame(rows, G.EVENT_SCHEMA)


def test_promotion_and_rollback(spark, log):
    at = datetime(2026, 2, 1)
    promoted = log.unionByName(G.promote(log, MODEL, "PASS", at, "yo", "T1"))
    G.check_aliases(G.alias_state(promoted), {G.CHAMPION: "2", G.PREVIOUS: "1", G.CANDIDATE: "2"}, MODEL)
    assert G.promote(promoted, MODEL, "FAIL", at, "yo", "T1").count() == 0
    back = promoted.unionByName(G.roll_back(promoted, MODEL, datetime(2026, 3, 1), "yo", "T2"))
    G.check_aliases(G.alias_state(back), {G.CHAMPION: "1", G.CANDIDATE: "2", G.ROLLED_BACK: "2"}, MODEL)
    assert G.roll_back(back, MODEL, datetime(2026, 4, 1), "yo", "T3").count() == 0
    with pytest.raises(ValueError, match="alias state"):
        G.check_aliases(G.alias_state(back), {G.CHAMPION: "2"}, MODEL)
    history = [r.action for r in G.event_history(back, newest_first=False).collect()]
    assert history[0] == "BASELINE_SNAPSHOT" and history[-1] in ("ROLLBACK", "KEEP_WITHDRAWN") and len(history) == 6


@pytest.mark.parametrize("decision, allow, ok", [("PASS", False, True), ("PASS_WITH_EXCEPTION", True, True), ("PASS_WITH_EXCEPTION", False, False), ("FAIL", True, False), (None, True, False), ("??", True, False)])
def test_who_may_be_promoted(log, decision, allow, ok):
    args = (log, MODEL, decision, datetime(2026, 2, 1), "yo", "T", allow)
    if ok:
        assert G.promote(*args).count() == 2
    else:
        with pytest.raises(ValueError, match="blocked"):
            G.promote(*args)


def test_nothing_to_go_back_to(log):
    with pytest.raises(ValueError, match="no version"):
        G.roll_back(log, MODEL, datetime(2026, 2, 1), "yo", "T")


PAIR = "model_name string, champion_version string, candidate_version string, status string, run_status string, roc_auc double, area_under_pr double, top20_capture double, champion_roc_auc double, seed int, git_commit string"


@pytest.mark.parametrize(
    "change, gate, status, decision",
    [
        ({}, None, None, "PASS"),
        ({"git_commit": None}, "CODE_VERSION_REGISTERED", "WARNING", "PASS_WITH_EXCEPTION"),
        ({"git_commit": ""}, "CODE_VERSION_REGISTERED", "WARNING", "PASS_WITH_EXCEPTION"),
        ({"seed": None}, "RANDOM_SEED_REGISTERED", "FAIL", "FAIL"),
        ({"roc_auc": None}, "MIN_ROC_AUC", "FAIL", "FAIL"),
        ({"champion_roc_auc": None}, "MAX_ROC_DEGRADATION", "FAIL", "FAIL"),
        ({"champion_roc_auc": 0.83}, "MAX_ROC_DEGRADATION", "FAIL", "FAIL"),
        ({"area_under_pr": 0.5499}, "MIN_AREA_UNDER_PR", "FAIL", "FAIL"),
        ({"top20_capture": 0.34}, "MIN_TOP20_CAPTURE", "FAIL", "FAIL"),
        ({"status": "PENDING"}, "MODEL_READY", "FAIL", "FAIL"),
        ({"run_status": None}, "RUN_FINISHED", "FAIL", "FAIL"),
        ({"champion_version": "2"}, "SEPARATE_FROM_CHAMPION", "FAIL", "FAIL"),
    ],
)
def test_gates(spark, change, gate, status, decision):
    pair = {"model_name": MODEL, "champion_version": "1", "candidate_version": "2", "status": "READY", "run_status": "FINISHED", "roc_auc": 0.8,
            "area_under_pr": 0.6, "top20_capture": 0.4, "champion_roc_auc": 0.81, "seed": 42, "git_commit": "abc"}
    gates = G.gate_results(spark.createDataFrame([{**pair, **change}], PAIR), F.lit("2026-01-01").cast("timestamp"))
    rows = {r.gate_name: r for r in gates.collect()}
    assert len(rows) == 9 and {r.validation_id for r in rows.values()} == {f"m-v2-{g}" for g in rows}
    if gate:
        assert rows[gate].gate_status == status
    others = {g for g, r in rows.items() if r.gate_status != "PASS"} - {gate}
    # Without its own area, a candidate cannot be compared with the champion either.
    assert others == ({"MAX_ROC_DEGRADATION"} if change == {"roc_auc": None} else set())
    assert G.gate_decision(gates).first().decision == decision


def test_figures_next_to_a_half_read_as_in_sql(spark):
    """Metrics of whole cents by whole counts lie on halves of a millionth, but for the last bit."""
    import duckdb

    pair = {"model_name": MODEL, "champion_version": "1", "status": "READY", "run_status": "FINISHED", "area_under_pr": 0.6, "seed": 42, "git_commit": "abc"}
    values = [0.7 + n / 1e2 / 20 / 1e3 for n in range(20_001, 32_001, 60)]
    captures = [0.33568749999999997, *[0.3 + n / 1e2 / 20 / 9e2 for n in range(1, len(values))]]
    made = [{**pair, "candidate_version": str(i), "roc_auc": v, "top20_capture": c, "champion_roc_auc": 0.75 + i / 2e6} for i, (v, c) in enumerate(zip(values, captures))]
    gates = G.gate_results(spark.createDataFrame(made, PAIR), F.lit("2026-01-01").cast("timestamp"))
    found = {(r.candidate_version, r.gate_name): r.observed_value for r in gates.collect()}
    given = duckdb.connect()
    given.execute("CREATE TABLE figures (version VARCHAR, gate VARCHAR, figure DOUBLE)")
    rows = [(m["candidate_version"], g, v) for m in made for g, v in (("MIN_ROC_AUC", m["roc_auc"]), ("MIN_TOP20_CAPTURE", m["top20_capture"]), ("MAX_ROC_DEGRADATION", m["roc_auc"] - m["champion_roc_auc"]))]
    given.executemany("INSERT INTO figures VALUES (?, ?, ?)", rows)
    want = given.execute("SELECT version, gate, CAST(CAST(figure AS DECIMAL(18, 6)) AS VARCHAR) FROM figures").fetchall()
    assert [(v, g, found[v, g]) for v, g, _ in want] == want
    assert found["0", "MIN_TOP20_CAPTURE"] == "0.335688"


def test_versions_compare_as_numbers(spark):
    v = spark.createDataFrame([(MODEL, "9", "READY"), (MODEL, "10", "READY"), (MODEL, "11", "PENDING"), (MODEL, "x", "READY")], "model_name string, version string, status string")
    assert G.newest_ready(v).first().version == 10
    r = v.select("model_name", F.col("version").alias("candidate_version"), F.lit("G").alias("gate_name"), F.lit("PASS").alias("gate_status"),
                 *[F.lit("").alias(c) for c in ("observed_value", "required_value", "details")])
    assert [x.candidate_version for x in G.latest_candidate_report(r).collect()] == ["11"]


def test_candidates_and_manifest_once(spark):
    have = spark.createDataFrame([(MODEL, "mark-1")], "model_name string, marker string")
    want = spark.createDataFrame([(MODEL, "mark-1"), (MODEL, "mark-2")], "model_name string, marker string")
    assert [r.marker for r in G.new_candidates(want, have).collect()] == ["mark-2"]
    row = G.manifest(have, "id-1", MODEL, "1", {"seed": 42, "num_trees": 50}, {"roc_auc": 0.78}, datetime(2026, 1, 1), "t")
    assert row.schema.simpleString() == spark.createDataFrame([], G.MANIFEST_SCHEMA).schema.simpleString()
    first = row.first()
    assert first.random_seed == 42 and first.parameters_json == '{"seed":42,"num_trees":50}' and first.limitations == "NO_CODE_VERSION"
    append(row, "manifiestos")
    from claimlens.operators.merge import new_rows

    append(new_rows(row, spark.table("manifiestos"), ["manifest_id"]), "manifiestos")
    assert spark.table("manifiestos").count() == 1


def test_persisted_views_equal_the_functions(spark):
    from claimlens.operators.drift import active_alerts
    from claimlens.operators.reports import consumer_view
    from claimlens.plans.consumption import create_alert_view, create_consumer_view
    from claimlens.sources.tables import overwrite

    overwrite(A.score_history(spark, SMALL), "historia")
    view = create_consumer_view(spark, "vista_consumo", "historia")
    assert view.exceptAll(consumer_view(spark.table("historia"))).count() == 0
    assert view.schema.simpleString() == consumer_view(spark.table("historia")).schema.simpleString()
    rows = [("score_fraude", "PREDICTION", 0.3, 0.2, 0.0, C.CRITICAL), ("x", "CATEGORICAL", 0.11, None, None, C.WARNING), ("y", "NUMERIC", 0.0, 0.0, 1.0, C.STABLE)]
    overwrite(spark.createDataFrame(rows, "feature_name string, feature_type string, psi double, ks_statistic double, ks_pvalue double, drift_status string"), "deriva")
    alerts = create_alert_view(spark, "vista_alertas", "deriva")
    assert sorted(alerts.collect()) == sorted(active_alerts(spark.table("deriva")).collect())


def test_source_is_read_once(spark, source, folder):
    """One scan of the source per run: its files are counted by Spark's own accumulator of the write."""
    reads = spark.sparkContext.accumulator(0)
    from pyspark.sql.functions import udf

    @udf("boolean")
    def seen(_):
        reads.add(1)
        return True

    n = source.count()
    t = ScoringTables("once_scores", "once_stage", "once_runs", f"{folder}/once")
    watched = source.filter(seen.asNondeterministic()(F.col(C.KEY)))
    result = score_batch(watched, lambda df: df.withColumn("score_fraude", F.lit(0.5)), "m:1", t, run_id="once")
    assert result.published == n and reads.value == n
