import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array

from barograph.operators.features import feature_plan
from barograph.operators.prepare import CategoryCodes, code_stage, fit_categories, fit_columns, fused_plan


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    rows = [(k, float(a) + 1e6, None if k % 5 == 0 else float("nan") if k % 7 == 0 else float(b), k % 3, None, 4.0, "xyz"[k % 3] if k % 4 else None)
            for k, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    return spark.createDataFrame(rows, "k int, a double, b double, c int, nothing double, same double, kind string").repartition(3).cache()


def vectors(plan, data):
    fitted = Pipeline(stages=plan.stages).fit(data)
    rows = fitted.transform(data).select("k", vector_to_array("features").alias("v")).orderBy("k").collect()
    return np.array([r.v for r in rows])


@pytest.mark.parametrize("scale", [False, True])
def test_values_equal_separate_stages(data, scale):
    columns = ["a", "b", "same"]
    mine = vectors(fused_plan(data, [*columns, "nothing"], scale=scale, relative_error=1e-6), data)
    theirs = vectors(feature_plan(columns, scale=scale, relative_error=1e-6), data)
    assert np.allclose(mine, theirs, rtol=1e-9)


def test_one_job_fits_all_columns(spark, data):
    found = fit_columns(data, ["a", "b", "c", "nothing", "same"])
    assert (found["nothing"].count, found["nothing"].median, found["nothing"].deviation) == (0, None, None)
    assert found["same"].deviation == 0 and found["c"].median == 1.0
    pdf = data.toPandas()
    assert found["a"].deviation == pytest.approx(pdf.a.std(), rel=1e-9)
    with pytest.raises(ValueError):
        fused_plan(data, ["nothing"])


def test_fused_stages_are_saved_with_a_pipeline(data, tmp_path):
    plan = fused_plan(data, ["a", "b"], ["kind"], top=2, hashed=3)
    fitted = Pipeline(stages=plan.stages).fit(data)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(data).select("features").collect()
    assert again == fitted.transform(data).select("features").collect()


def test_codes_are_bounded_whatever_the_categories(spark):
    rows = spark.range(100_000).selectExpr("IF(id % 10 = 0, 'it''s \\\\ hot', IF(id % 10 = 1, 'second', concat('c', id))) AS kind")
    codes = fit_categories(rows, "kind", top=2, hashed=16)
    assert codes.labels == ("it's \\ hot", "second") and codes.size == 19
    found = {r.kind_idx: r["count"] for r in code_stage([codes]).transform(rows).groupBy("kind_idx").count().collect()}
    assert found[0.0] == found[1.0] == 10_000 and set(found) == {float(k) for k in range(18)}
    assert max(n for k, n in found.items() if k >= 2) < 6_500
    odd = spark.createDataFrame([(None,), ("",), ("second",)], "kind string")
    assert [r.kind_idx for r in code_stage([codes]).transform(odd).collect()][::2] == [18.0, 1.0]


def test_no_category_at_all(spark):
    empty = spark.createDataFrame([(None,), (None,)], "kind string")
    codes = fit_categories(empty, "kind", top=3, hashed=2)
    assert codes == CategoryCodes("kind", (), 2)
    assert [r.kind_idx for r in code_stage([codes]).transform(empty).collect()] == [2.0, 2.0]
