"""The stage runner: switches, stored outputs, failures and resumption."""

import pytest
from pyspark.sql import functions as F

from inkwell.plans import q_run
from inkwell.plans.runner import MissingStage, Runner, Stage, StageFailed
from inkwell.session import scratch_path

SF = "/root/testdata/sf0.001"


class Steps:
    """Three stages that count how often they are built; ``broken`` fails in the middle of its job."""

    def __init__(self, spark, path):
        self.spark, self.built, self.broken, self.factor = spark, [], False, 2
        self.source = path
        spark.range(10).write.parquet(path)

    def stages(self):
        def read():
            self.built.append("read")
            return self.spark.read.parquet(self.source)

        def scale(df):
            self.built.append("scale")
            bad = F.raise_error(F.lit("no luck")).cast("bigint")
            return df.select(F.when(F.lit(self.broken) & (F.col("id") == 7), bad).otherwise(F.col("id") * self.factor).alias("x"))

        def total(a, b):
            self.built.append("total")
            return a.crossJoin(b.agg(F.sum("x").alias("s"))).agg(F.max("s").alias("s"), F.count("id").alias("n"))

        return [Stage("read", read, files=(self.source,)), Stage("scale", scale, ("read",), params={"factor": self.factor}),
                Stage("total", total, ("read", "scale"))]

    def run(self, root, **more):
        self.built.clear()
        runner = Runner(self.spark, root, self.stages(), {"work": ("scale", "total")})
        return runner, [o.action for o in runner.run(**more)]


@pytest.fixture
def steps(spark):
    return Steps(spark, scratch_path(spark, "source")), scratch_path(spark, "run")


def test_builds_then_reuses_then_rebuilds_what_changed(steps):
    s, root = steps
    runner, done = s.run(root)
    assert done == ["built"] * 3 and runner.output("total").collect()[0]["s"] == 90
    assert s.run(root)[1] == ["reused"] * 3 and s.built == []
    assert s.run(root, resume=False)[1] == ["built"] * 3
    s.factor = 3
    runner, done = s.run(root)
    assert done == ["reused", "built", "built"] and runner.output("total").collect()[0]["s"] == 135
    s.spark.range(5).write.mode("append").parquet(s.source)
    assert s.run(root)[1] == ["built"] * 3
    assert runner.manifest().where("stage = 'total'").count() == 4


def test_a_failed_run_goes_on_where_it_stopped(steps):
    s, root = steps
    s.broken = True
    with pytest.raises(StageFailed) as e:
        s.run(root)
    assert e.value.stage == "scale" and s.built == ["read", "scale"]
    assert set(Runner(s.spark, root, s.stages()).last()) == {"read"}
    s.broken = False
    runner, done = s.run(root)
    assert done == ["reused", "built", "built"] and s.built == ["scale", "total"]
    assert runner.output("scale").count() == 10


@pytest.mark.parametrize("skip,actions", [
    (["read"], ["skipped", "reused", "reused"]), (["scale"], ["reused", "skipped", "reused"]),
    (["total"], ["reused", "reused", "skipped"]), (["work"], ["reused", "skipped", "skipped"]),
    (["read", "scale", "total"], ["skipped"] * 3), ([], ["reused"] * 3)])
def test_every_switch_takes_the_stored_output(steps, skip, actions):
    s, root = steps
    s.run(root)
    runner, done = s.run(root, skip=skip)
    assert done == actions and s.built == []
    assert runner.output("total").collect()[0]["n"] == 10


def test_a_skipped_stage_is_not_run_again_for_new_input(steps):
    s, root = steps
    s.run(root)
    s.factor = 5
    runner, done = s.run(root, skip=["scale"])
    assert done == ["reused", "skipped", "reused"] and runner.output("total").collect()[0]["s"] == 90


def test_what_cannot_work_is_refused_before_anything_runs(steps):
    s, root = steps
    for skip in (["read"], ["scale"]):
        with pytest.raises(MissingStage):
            s.run(root, skip=skip)
        assert s.built == []
    assert s.run(root, skip=["work"])[1] == ["built", "skipped", "skipped"]
    with pytest.raises(MissingStage):
        Runner(s.spark, root, s.stages()).output("total")
    with pytest.raises(ValueError):
        s.run(root, skip=["nothing"])
    with pytest.raises(ValueError):
        Runner(s.spark, root, list(reversed(s.stages())))


def test_article_run_in_two_goes(spark):
    root = scratch_path(spark, "articles")
    runner, done = q_run.article_run(spark, SF, root, skip=["classify", "fine-tune"])
    assert [o.action for o in done] == ["built"] * 3 + ["skipped"] * 4
    runner, done = q_run.article_run(spark, SF, root, skip=["ingest", "preprocess", "vectorize"])
    assert [o.action for o in done] == ["skipped"] * 3 + ["built"] * 4
    c = runner.output("classify")
    assert c.count() > 0 and {"cleaned_text", "sentiment", "topic", "label_scores", "absent_score"} <= set(c.columns)
    assert {r["task"] for r in runner.output("tune").select("task").distinct().collect()} <= {"sentiment", "topic"}
    # other parameters of tuning build that stage alone
    _, done = q_run.article_run(spark, SF, root, epochs=5)
    assert [o.action for o in done] == ["reused"] * 6 + ["built"]
