import pytest
from pyspark.sql import functions as F

from swipelens import config as C
from swipelens.operators import encoders as E
from swipelens.plans.features import feature_engineering
from swipelens.session import materialize, new_path
from swipelens.sources import stand_in


def jobs(spark, rows):
    return spark.createDataFrame(rows, "job STRING, city STRING, is_fraud INT")


def encoded(model, df):
    return {r["job"]: r["job_target_enc"] for r in model.transform(df).collect()}


def test_unseen_and_missing_get_the_global_mean(spark):
    model = E.SmoothedTargetEncoder(["job"]).fit(jobs(spark, [("a", "x", 1)] * 8 + [("b", "x", 0)] * 2))
    assert encoded(model, jobs(spark, [("new", "x", 0), (None, "x", 0)])) == {"new": model.global_mean, None: model.global_mean}
    assert model.global_mean == 0.8


def test_frequent_category_keeps_its_own_mean(spark):
    rows = [("a", "x", 1)] * 200 + [("b", "x", 0)] * 2
    model = E.SmoothedTargetEncoder(["job"]).fit(jobs(spark, rows))
    got = encoded(model, jobs(spark, [("a", "x", 0), ("b", "x", 0)]))
    mean = model.global_mean
    assert abs(got["a"] - 1) < abs(mean - 1) and abs(got["b"] - mean) < mean


def test_names():
    assert E.SmoothedTargetEncoder(["job", "city"]).get_feature_names_out() == ["job_target_enc", "city_target_enc"]


def test_plain_join_gives_the_same_encodings(spark, monkeypatch):
    rows = jobs(spark, [("a", "x", 1)] * 30 + [("b", "y", 0)] * 9 + [(None, "y", 1)])
    model = E.SmoothedTargetEncoder(["job", "city"]).fit(rows)
    small = sorted(map(tuple, model.transform(rows).select("job_target_enc", "city_target_enc").collect()))
    monkeypatch.setattr(E, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, model.transform(rows).select("job_target_enc", "city_target_enc").collect())) == small


def test_one_hot(spark):
    rows = jobs(spark, [("b", "x", 1), ("a", "x", 0)])
    columns = E.one_hot(E.one_hot_categories(rows, ["job"]))
    assert list(columns) == ["job_a", "job_b"]
    got = jobs(spark, [("a", "x", 0), ("c", "x", 0), (None, "x", 0)]).select(*[v.alias(n) for n, v in columns.items()])
    assert [tuple(r) for r in got.collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_one_hot_vector_of_unknown_is_zero(spark):
    model = E.one_hot_vector(jobs(spark, [("b", "x", 1), ("a", "x", 0)]), "job", "v")
    got = [r["v"].toArray().tolist() for r in model.transform(jobs(spark, [("a", "x", 0), ("c", "x", 0)])).collect()]
    assert got == [[1.0, 0.0], [0.0, 0.0]]


def test_scaling_uses_population_std_and_exact_median(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, 4.0), (10.0, 4.0)], "x DOUBLE, k DOUBLE")
    stats = E.scale_statistics(df, ["x", "k"])
    assert stats["x"] == pytest.approx((4.0, 12.5 ** 0.5)) and stats["k"] == (4.0, 1.0)
    filled = E.median_impute(spark.createDataFrame([(None,)], "x DOUBLE"), {"x": 2.5}).first()
    assert filled["x"] == 2.5


@pytest.fixture(scope="module")
def parts(txn):
    return tuple(materialize(feature_engineering(f(txn))) for f in (stand_in.train_rows, stand_in.test_rows))


def test_matrix_order_and_reload(spark, parts):
    train, test = parts
    model = E.FeatureEncoder().fit(train)
    names = model.feature_names()
    assert names[:20] == C.SCALED_COLUMNS + C.PASSTHROUGH_COLUMNS
    assert names[20:] == ["gender_F", "gender_M"] + [f"{c}_target_enc" for c in C.TARGET_ENCODED_COLUMNS]
    assert model.encode(test).columns == names
    path = new_path(spark)
    model.save(path)
    again = E.FeatureEncoderModel.load(spark, path)
    rows = [sorted(map(str, m.transform(test).collect())) for m in (model, again)]
    assert rows[0] == rows[1] and len(rows[0]) == test.count()


def test_encoder_ignores_later_rows(parts):
    train, test = parts
    model = E.FeatureEncoder().fit(train)
    whole = model.encode(test.withColumn("amt_log", F.lit(0.0)), [C.ROW_ID]).drop("amt_log")
    assert sorted(map(str, whole.collect())) == sorted(map(str, model.encode(test, [C.ROW_ID]).drop("amt_log").collect()))


def test_out_of_fold_rows_do_not_see_themselves(spark):
    rows = spark.createDataFrame([(str(i), "only" if i == 0 else "a", int(i == 0)) for i in range(60)], "trans_num STRING, job STRING, is_fraud INT")
    got = E.out_of_fold_encode(rows, 3, E.SmoothedTargetEncoder(["job"]))
    assert got.count() == 60
    assert got.where("job = 'only'").first()["job_target_enc"] == 0.0


def test_sparse_columns_take_any_number_of_categories(spark):
    from swipelens.session import new_path

    rows = [(f"k{i % 5000:04d}", "a" if i % 3 else "b", i % 2) for i in range(6000)]
    df = jobs(spark, rows)
    other = [c for c in df.columns if c not in ("job",)]
    encoder = E.FeatureEncoder(scaled=[], passthrough=[], onehot=[], encoded=[other[0]], sparse=["job"], target=df.columns[-1], keep=[])
    fitted = encoder.fit(df)
    names = fitted.feature_names()
    assert len(names) == 1 + df.select("job").distinct().count() and names[1].startswith("job_")
    vector = fitted.transform(df.limit(1)).first()["features"]
    assert vector.size == len(names) and vector.toArray()[1:].sum() == 1.0
    path = new_path(spark)
    fitted.save(path)
    again = E.FeatureEncoderModel.load(spark, path)
    assert again.feature_names() == names
    assert again.transform(df.limit(1)).first()["features"] == vector
    unseen = fitted.transform(jobs(spark, [("new", "a", 1)])).first()["features"]
    assert unseen.toArray()[1:].sum() == 0.0


def test_wide_one_hot_columns_become_sparse(spark, monkeypatch):
    monkeypatch.setattr(E, "ONE_HOT_LIMIT", 20)
    df = jobs(spark, [(f"k{i % 40:02d}", "a" if i % 3 else "b", i % 2) for i in range(200)])
    fitted = E.FeatureEncoder(scaled=[], passthrough=[], onehot=["job"], encoded=[df.columns[1]], target=df.columns[-1], keep=[]).fit(df)
    assert fitted.roles["onehot"] == [] and fitted.roles["sparse"] == ["job"]
    assert fitted.feature_names()[1:] == [f"job_k{i:02d}" for i in range(40)]
    with pytest.raises(ValueError):
        E.one_hot_categories(df, ["job"])
