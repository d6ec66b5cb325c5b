from cartwheel.operators import quality


def test_checks_return_violating_rows(spark):
    df = spark.createDataFrame([(1, "view"), (1, "cart"), (None, "signup"), (2, None)],
                               "id long, t string")
    assert quality.not_null(df, "id").count() == 1
    assert [r.id for r in quality.unique(df, "id").collect()] == [1]
    assert quality.unique_combination(df, ["id", "t"]).count() == 0
    assert [r.value_field for r in quality.accepted_values(df, "t", ["view", "cart"]).collect()] == ["signup"]
    assert [r.t for r in quality.predicate(df, quality.one_of("t", ["view", "cart"])).collect()] == ["signup"]
    parent = spark.createDataFrame([(1,)], "pid long")
    assert [r.id for r in quality.relationships(df, "id", parent, "pid").collect()] == [2]


def test_summary_counts_like_the_row_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, -1), (None, 3)], "id long, amount long")
    checks = [quality.Check("t", "not_null", ("id",)), quality.Check("t", "unique", ("id",)),
              quality.Check("t", "predicate", rule=quality.not_negative("amount"), label="neg")]
    got = {r.check_name: r.violations for r in quality.dq_summary({"t": df}, checks).collect()}
    assert got == {"t.id.not_null": 1, "t.id.unique": 1, "t.neg": 1}


def test_catalogue_names_are_unique():
    names = [c.name for c in quality.CHECKS]
    assert len(names) == len(set(names))


def test_rules_mark_the_rows_that_break_them(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(
        [(1, 0, 2, True, 0.5), (2, -1, 2, False, 1.0), (3, 3, 2, False, 1.5), (4, None, None, None, None), (5, 0, 0, True, -0.1)],
        "id int, a int, b int, flag boolean, r double")
    rules = {"not_negative": (quality.not_negative("a", "b"), [2]), "above_zero": (quality.above_zero("a"), [1, 2, 5]),
             "in_order": (quality.in_order("a", "b"), [3]), "share": (quality.share("r"), [3, 5]),
             "flags": (quality.flags("flag", "a"), [1, 3, 5]), "missing": (quality.missing("a", "r"), [4]),
             "unset": (quality.unset("a", "r"), [1, 2, 3, 5]), "covers": (quality.covers("b", "a", "a"), [3]),
             "given": (quality.given(lambda: F.col("b") == 2, quality.is_zero("a")), [2, 3])}
    for name, (rule, broken) in rules.items():
        assert [r.id for r in quality.predicate(df, rule).orderBy("id").collect()] == broken, name


def test_oracle_states_every_row_check():
    from cartwheel.plans import oracle_checks
    assert {(c.model, c.label) for c in quality.CHECKS if c.kind == "predicate"} == {
        (m, label) for m, checks in oracle_checks.ROW_SQL.items() for label in checks}


def test_observed_checks_need_no_scan_and_are_exact(spark, tmp_path):
    from cartwheel.session import scratch_path
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, None)], "id long, t string")
    child = spark.createDataFrame([(1, 5, "x"), (3, -1, "y"), (3, 2, "y"), (None, 3, "z")], "ref long, amount long, kind string")
    checks = [*quality._nn("p", "id", "t"), quality.Check("p", "unique", ("id",)), quality.Check("p", "unique_combination", ("id", "t")),
              *quality._nn("c", "amount"), quality.Check("c", "relationships", ("ref",), "p", "id"), quality.Check("c", "unique", ("kind",)),
              quality.Check("c", "accepted_values", ("kind",), values=("x", "z")), quality.Check("c", "accepted_values", ("amount",), values=(5, -1, 2, 3)),
              quality.Check("c", "predicate", rule=quality.not_negative("amount"), label="neg"),
              quality.Check("c", "predicate", rule=quality.above_zero("ref"), label="ref_positive")]
    models, counts = {}, {}
    for name, df in (("p", parent), ("c", child)):
        checked, seen = quality.observe(df, name, checks)
        path = scratch_path(spark, "test_observed", tmp_path.name, name)
        checked.write.mode("overwrite").parquet(path)
        models[name], counts[name] = spark.read.parquet(path), seen()
    assert counts["p"] == {"p.id.not_null": 2, "p.t.not_null": 1} and counts["c"]["c.neg"] == 1 and counts["c"]["c.ref_positive"] == 0
    want = {"p.id.not_null": 2, "p.t.not_null": 1, "p.id.unique": 1, "p.id+t.unique_combination": 0, "c.amount.not_null": 0,
            "c.ref.references.p.id": 2, "c.kind.unique": 1, "c.kind.accepted_values": 1, "c.amount.accepted_values": 0, "c.neg": 1, "c.ref_positive": 0}
    for observed in (None, counts, {"p": counts["p"]}, {m: {k: v + 7 * (v > 0) for k, v in c.items()} for m, c in counts.items()}):
        got = quality.dq_summary(models, checks, observed)
        assert {r.check_name: r.violations for r in got.collect()} == want and got.count() == len(checks)
    # a clean model is read for its keys alone
    clean = {"p": models["p"].where("id = 1")}
    plan = quality.dq_summary(clean, [c for c in checks if c.model == "p" and len(c.cols) == 1], {"p": {"p.id.not_null": 0, "p.t.not_null": 0}})
    assert "ReadSchema: struct<id:bigint>" in plan._jdf.queryExecution().executedPlan().toString()


def test_every_written_model_is_observed(spark):
    from cartwheel.plans.warehouse import MATERIALISED, Warehouse
    wh = Warehouse(spark, "/root/testdata/sf0.001")
    models = wh.quality_models()
    assert set(wh.observed) == set(MATERIALISED)
    plain = {r.check_name: r.violations for r in quality.dq_summary(models).collect()}
    assert {r.check_name: r.violations for r in quality.dq_summary(models, observed=wh.observed).collect()} == plain
    assert len(plain) == len(quality.CHECKS) + 1


def test_summary_in_turn_holds_one_pass_at_a_time(spark, monkeypatch):
    """The driver of the registered summary gets counts alone, and no broadcast by what file sizes say."""
    from cartwheel.plans import registry
    from cartwheel.plans.warehouse import Warehouse
    models = {"p": spark.createDataFrame([(1,), (1,), (None,)], "id long"), "c": spark.createDataFrame([(1, -1), (3, 2)], "ref long, amount long")}
    checks = [*quality._nn("p", "id"), quality.Check("p", "unique", ("id",)), quality.Check("c", "relationships", ("ref",), "p", "id"),
              quality.Check("c", "predicate", rule=quality.not_negative("amount"), label="neg")]
    turn = quality.dq_summary_in_turn(models, checks, {"c": {"c.neg": 0}})
    assert sorted(turn.collect()) == sorted(quality.dq_summary(models, checks, {"c": {"c.neg": 0}}).collect())
    assert {r.check_name: r.violations for r in turn.collect()} == {
        "p.id.not_null": 1, "p.id.unique": 1, "c.ref.references.p.id": 1, "c.neg": 0}
    plan = turn._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Union" not in plan

    keys, seen = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"), []
    before, in_turn = [spark.conf.get(k, None) for k in keys], quality.dq_summary_in_turn

    def spy(value):
        seen.append(tuple(spark.conf.get(k) for k in keys))
        return value
    monkeypatch.setattr(Warehouse, "quality_models", lambda self: spy(models))
    monkeypatch.setattr(quality, "dq_summary_in_turn", lambda m, observed: spy(in_turn(m, checks)))
    assert registry.QUERIES["dq_summary"](spark, "/nowhere/but/here").count() == len(checks)
    assert seen == [("-1", "1m")] * 2 and [spark.conf.get(k, None) for k in keys] == before
