"""Named queries over the given tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from swipelens import config as C
from swipelens.functions import scalars as S
from swipelens.operators import encoders as E
from swipelens.operators import explain as X
from swipelens.operators import history as H
from swipelens.operators import metrics as M
from swipelens.operators import neighbours as K
from swipelens.operators import profiles as P
from swipelens.operators import quality as Q
from swipelens.operators import quantiles as N
from swipelens.operators import series as R
from swipelens.operators import splits as L
from swipelens.operators import stationarity as Y
from swipelens.operators import training as G
from swipelens.operators.ordering import row_blocks
from swipelens.plans.features import feature_engineering, history_features, leak_probe, row_features
from swipelens.session import ON_RELEASE, materialize, new_path, use_utc
from swipelens.sources import stand_in as SI
from swipelens.sources import transactions as IO

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NUMERIC = ["amt", "lat", "long", "city_pop", "merch_lat", "merch_long"]


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result types that compare across engines: BIGINT, rounded DOUBLE, text.

    Amounts are whole cents, so a mean can lie exactly halfway between two rounded values;
    a small nudge makes every engine round it up.
    """
    nudge = 10.0 ** -(digits + 3)
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int").cast("bigint")
        elif isinstance(f.dataType, (T.FractionalType, T.DecimalType)):
            c = F.round(c.cast("double") + nudge, digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, digits: int = 6) -> Callable[[Callable], Callable]:
    def register(build: Callable) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            use_utc(spark)
            return tidy(build(SI.transactions(spark, folder)), digits)

        QUERIES[name] = run
        return build

    return register


def _pair(txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    return SI.train_rows(txn), SI.test_rows(txn)


def _write_csv(df: DataFrame) -> str:
    path = new_path(df.sparkSession)
    df.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return path


# Sources and sinks


@query("scan_transactions")
def _(txn):
    path = _write_csv(txn.withColumn("unix_time", S.unix_seconds(C.TIME)))
    return IO.read_transactions(txn.sparkSession, path)


@query("load_pair")
def _(txn):
    paths = [_write_csv(part) for part in _pair(txn)]
    return IO.row_counts(*IO.read_pair(txn.sparkSession, *paths))


@query("parquet_roundtrip")
def _(txn):
    path = new_path(txn.sparkSession)
    IO.save_parquet(txn, path)
    return IO.load_parquet(txn.sparkSession, path)


@query("report_sink")
def _(txn):
    report = P.fraud_rate_by(txn, "state", top=None)
    path = new_path(txn.sparkSession)
    IO.save_report(report, path)
    return IO.load_report(txn.sparkSession, path, report.schema)


@query("model_matrix")
def _(txn):
    path = new_path(txn.sparkSession)
    IO.save_matrix(feature_engineering(txn), path, C.FEATURE_COLUMNS, C.TARGET)
    rows, features = IO.load_matrix(txn.sparkSession, path)
    return rows.select(*features, C.TARGET)


# Projection, filters, quality


@query("select_roles")
def _(txn):
    return feature_engineering(txn).select(C.TARGET, *C.FEATURE_COLUMNS)


@query("class_filter")
def _(txn):
    return P.amount_by_class(txn)


@query("fraud_rows")
def _(txn):
    return Q.class_rows(txn, C.TARGET, 1).select(C.ROW_ID, C.KEY, C.AMOUNT)


@query("missing_counts")
def _(txn):
    return Q.missing_counts(*[
        history_features(part).select(C.ROW_ID, *H.SPREAD, "time_diff_hours", "transaction_velocity_kmh")
        for part in _pair(txn)
    ])


@query("fraud_value_share", 4)
def _(txn):
    return P.fraud_value_share(*_pair(txn))


@query("string_violations")
def _(txn):
    parts = [
        Q.string_violations(txn, c, n, True).withColumn("column", F.lit(c))
        for c, n in ((C.KEY, 3), (C.ROW_ID, 4), ("merchant", 8))
    ]
    return L.union_all(*parts)


@query("column_profile")
def _(txn):
    return Q.column_profile(history_features(txn).select(*txn.columns, "time_diff_hours", "prev_lat"))


@query("duplicate_rows")
def _(txn):
    return Q.duplicate_rows(txn)


@query("required_columns")
def _(txn):
    found = materialize(feature_engineering(txn))
    always = [
        "distance_km", "first_digit", "last_digit", "amt_log", "city_pop_log",
        "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month",
    ]
    return Q.required_columns(found, C.FEATURE_COLUMNS, always, txn.count())


@query("date_filter")
def _(txn):
    return Q.from_date(txn, C.TIME, "2024-01-20").select(C.ROW_ID, C.AMOUNT)


# Scalar functions


@query("time_parts")
def _(txn):
    return txn.select(
        C.ROW_ID, S.hour_of_day(C.TIME).alias("hour_of_day"),
        S.day_of_week(C.TIME).alias("day_of_week"), S.month_of_year(C.TIME).alias("month"),
    )


@query("calendar_flags")
def _(txn):
    return txn.select(
        C.ROW_ID, S.day_of_month(C.TIME).alias("day_of_month"), S.is_weekend(C.TIME).alias("is_weekend"),
        S.is_night(C.TIME).alias("is_night"), S.unix_seconds(C.TIME).alias("unix_time"),
    )


@query("day_name")
def _(txn):
    return txn.select(C.ROW_ID, S.day_name(S.day_of_week(C.TIME)).alias("day_name"))


@query("cyclical_encode")
def _(txn):
    hour_sin, hour_cos = S.cyclical(S.hour_of_day(C.TIME), S.HOURS_PER_DAY)
    dow_sin, dow_cos = S.cyclical(S.day_of_week(C.TIME), S.DAYS_PER_WEEK)
    return txn.select(
        C.ROW_ID, hour_sin.alias("hour_sin"), hour_cos.alias("hour_cos"),
        dow_sin.alias("dow_sin"), dow_cos.alias("dow_cos"),
    )


@query("haversine_km")
def _(txn):
    return txn.select(C.ROW_ID, S.haversine_km("lat", "long", "merch_lat", "merch_long").alias("distance_km"))


@query("log_transform")
def _(txn):
    return txn.select(C.ROW_ID, S.log_amount(C.AMOUNT).alias("amt_log"), S.log_amount("city_pop").alias("city_pop_log"))


@query("last_cents_digit")
def _(txn):
    return txn.select(C.ROW_ID, S.last_cents_digit(C.AMOUNT).alias("last_digit"))


@query("leading_digit")
def _(txn):
    return txn.select(C.ROW_ID, S.leading_digit(C.AMOUNT).alias("first_digit"))


@query("min_max_scale")
def _(txn):
    return P.min_max_scale(txn.select(C.ROW_ID, C.AMOUNT), C.AMOUNT, "amt_scaled").select(C.ROW_ID, "amt_scaled")


@query("z_scale_series")
def _(txn):
    return P.z_scale(txn.select(C.ROW_ID, C.AMOUNT), C.AMOUNT, "amt_z").select(C.ROW_ID, "amt_z")


@query("age_at_date")
def _(txn):
    fixed = F.lit("2021-01-01").cast("date")
    return txn.select(
        C.ROW_ID, S.age_years("dob", C.TIME).alias("idade"), S.age_years("dob", fixed).alias("age_fixed")
    )


# Windows per card


@query("prev_transaction")
def _(txn):
    return H.card_windows(txn).select(C.ROW_ID, *H.PREVIOUS)


@query("time_diff_hours")
def _(txn):
    return H.card_windows(txn).select(C.ROW_ID, "time_diff_hours")


@query("prev_distance_km")
def _(txn):
    return H.card_windows(txn).select(C.ROW_ID, H.prev_distance_km().alias("prev_distance_km"))


@query("velocity_kmh", 4)
def _(txn):
    speed = H.velocity_kmh()
    return H.card_windows(txn).select(
        C.ROW_ID, speed.alias("transaction_velocity_kmh"),
        H.above(speed, C.VELOCITY_LIMIT_KMH).alias("impossible_velocity"),
        H.above(speed, 900.0).alias("impossible_velocity_900"),
    )


@query("expanding_mean_std")
def _(txn):
    return H.card_windows(txn).select(C.ROW_ID, *H.SPREAD)


@query("amt_zscore_outlier")
def _(txn):
    return history_features(txn).select(C.ROW_ID, "amt_zscore_expanding", "amt_is_outlier")


@query("recent_count_sum")
def _(txn):
    return H.card_windows(txn).select(C.ROW_ID, *H.RECENT)


@query("recent_count_sum_dense")
def _(txn):
    """The layout for large cards, forced, with every card above 70 rows cut into periods."""
    return H.card_windows(txn, "36h", dense_rows=0, hot_rows=70, period="5h").select(C.ROW_ID, *H.SPREAD, *H.RECENT)


@query("feature_engineering", 4)
def _(txn):
    return feature_engineering(txn).select(C.ROW_ID, C.TARGET, *C.SCALED_COLUMNS, *C.PASSTHROUGH_COLUMNS)


@query("seeded_history", 4)
def _(txn):
    train, test = _pair(txn)
    found = feature_engineering(test, history=train)
    return found.select(C.ROW_ID, *H.SPREAD, *H.RECENT, "time_diff_hours")


@query("leak_probe")
def _(txn):
    return leak_probe(txn, "2024-01-15").agg(F.count(F.lit(1)).alias("n_changed"))


def _hourly(txn: DataFrame) -> DataFrame:
    """An hourly series of counts, sums and frauds."""
    return txn.groupBy(F.date_trunc("hour", C.TIME).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(C.AMOUNT).alias("total"), F.sum(C.TARGET).alias("frauds")
    )


#: Block length for the registered series queries, short enough that blocks meet at 0.01.
BLOCK = 100


@query("centered_moving_avg")
def _(txn):
    return R.centered_moving_avg(_hourly(txn), ["hour"], "n", 24, block_rows=BLOCK).select("hour", "n", "moving_avg")


@query("band_anomalies")
def _(txn):
    return R.band_anomalies(_hourly(txn), ["hour"], "n", 24, block_rows=BLOCK).select(
        "hour", "n", "moving_avg", "lower_bound", "upper_bound"
    )


@query("card_profile_zscore")
def _(txn):
    return H.profile_zscore(txn).select(C.ROW_ID, "profile_zscore", "profile_outlier")


@query("last_n_mean")
def _(txn):
    newest = [F.desc(C.TIME), F.desc(C.ROW_ID)]
    return R.last_n_mean(txn, newest, C.AMOUNT, 50)


@query("last_n_weighted_mean")
def _(txn):
    newest = [F.desc(C.TIME), F.desc(C.ROW_ID)]
    return R.last_n_weighted_mean(txn, newest, C.AMOUNT, [5.0, 4.0, 3.0, 2.0, 1.0])


@query("rolling_corr")
def _(txn):
    return R.rolling_corr(_hourly(txn), ["hour"], "n", "total", 30, block_rows=BLOCK).select("hour", "rolling_corr")


@query("lag_difference")
def _(txn):
    return R.lag_difference(_hourly(txn), ["hour"], "total", 24, block_rows=BLOCK).select("hour", "difference")


@query("interpolate_bfill")
def _(txn):
    gaps = F.when(F.col("category") != "click", F.col(C.AMOUNT))
    rows = txn.select(C.ROW_ID, C.TIME, gaps.alias("amt_gaps"))
    return R.interpolate_bfill(rows, [C.TIME, C.ROW_ID], ["amt_gaps"]).select(C.ROW_ID, "amt_gaps")


# Aggregations


@query("class_distribution")
def _(txn):
    return P.class_distribution(txn)


@query("fraud_rate_by")
def _(txn):
    parts = [
        P.fraud_rate_by(txn.withColumn("_k", key.cast("string")), "_k").select(
            F.lit(name).alias("key"), F.col("_k").alias("key_value"), "n", "fraud_rate_pct"
        )
        for name, key in (
            ("hour", S.hour_of_day(C.TIME)), ("dow", S.day_of_week(C.TIME)),
            ("state", F.col("state")), ("category", F.col("category")),
        )
    ]
    return L.union_all(*parts)


@query("describe_numeric", 4)
def _(txn):
    # Several passes follow: they read the narrow columns, not the joins behind them.
    rows = materialize(txn.select(C.TARGET, *NUMERIC))
    everything = P.describe_numeric(rows, NUMERIC).withColumn(C.TARGET, F.lit(-1))
    return everything.unionByName(P.describe_numeric(rows, NUMERIC, [C.TARGET]))


@query("describe_categorical")
def _(txn):
    return P.describe_categorical(txn, ["merchant", "category", "gender", "job", "state", "city"])


@query("histogram_by_class")
def _(txn):
    return P.histogram_by_class(txn, C.AMOUNT)


@query("period_counts")
def _(txn):
    days = R.period_counts(txn, C.TIME, "day")
    smooth = R.centered_moving_avg(days, ["period"], "n", 30).drop("_position")
    parts = [smooth.withColumn("unit", F.lit("day"))]
    parts += [
        R.period_counts(txn, C.TIME, unit).withColumns(
            {"moving_avg": F.lit(None).cast("double"), "unit": F.lit(unit)}
        )
        for unit in ("month", "year")
    ]
    return L.union_all(*parts)


@query("series_overview")
def _(txn):
    return R.series_overview(txn, C.TIME, C.AMOUNT)


@query("digit_distribution")
def _(txn):
    digits = txn.select(C.TARGET, S.leading_digit(C.AMOUNT).alias("first_digit"), S.last_cents_digit(C.AMOUNT).alias("last_digit"))
    first = P.digit_distribution(digits, "first_digit").withColumnRenamed("first_digit", "digit")
    last = P.digit_distribution(digits, "last_digit").withColumnRenamed("last_digit", "digit")
    return first.withColumn("which", F.lit("first")).unionByName(
        last.drop("pct_benford").withColumns({"pct_benford": F.lit(None).cast("double"), "which": F.lit("last")})
    )


@query("row_normalised_crosstab")
def _(txn):
    rows = history_features(txn)
    parts = [
        P.row_normalised_crosstab(rows, flag).withColumnRenamed(flag, "flag").withColumn("which", F.lit(flag))
        for flag in ("impossible_velocity", "amt_is_outlier")
    ]
    return L.union_all(*parts)


@query("correlation_matrix")
def _(txn):
    columns = [*NUMERIC, "distance_km", "hour_of_day", "day_of_week", C.TARGET]
    return P.correlation_matrix(materialize(row_features(txn).select(*columns)), columns)


@query("target_correlations")
def _(txn):
    return P.target_correlations(row_features(txn), [*NUMERIC, "distance_km", "hour_of_day"])


@query("spearman_corr")
def _(txn):
    return P.spearman(txn, C.AMOUNT, "city_pop")


@query("kendall_tau_b")
def _(txn):
    rows = row_features(txn)
    return P.kendall_tau_b(rows, "hour_of_day", "first_digit")


@query("lagged_corr")
def _(txn):
    return R.lagged_corr(_hourly(txn), ["hour"], "n", "total", 12, block_rows=BLOCK)


@query("autocorrelation")
def _(txn):
    return R.autocorrelation(_hourly(txn), ["hour"], "n", block_rows=BLOCK)


@query("partial_autocorrelation")
def _(txn):
    return Y.partial_autocorrelation(_hourly(txn), ["hour"], "n", block_rows=BLOCK)


@query("adf_test")
def _(txn):
    return Y.adf_test(_hourly(txn), ["hour"], "total", block_rows=BLOCK)


@query("kpss_test")
def _(txn):
    return Y.kpss_test(_hourly(txn), ["hour"], "total", block_rows=BLOCK)


@query("linear_trend")
def _(txn):
    return R.linear_trend(_hourly(txn), ["hour"], "total")


@query("mutual_information")
def _(txn):
    numeric, categorical = [*NUMERIC, "distance_km"], ["gender", "category", "job"]
    rows = materialize(row_features(txn).select(C.TARGET, *numeric, *categorical))
    return P.mutual_information(rows, numeric, categorical)


@query("neighbour_information")
def _(txn):
    numeric = [*NUMERIC, "distance_km"]
    return K.neighbour_information(materialize(row_features(txn).select(C.TARGET, *numeric)), numeric, C.TARGET, block_rows=BLOCK)


@query("iqr_outliers", 4)
def _(txn):
    return P.iqr_summary(txn, C.AMOUNT)


@query("iqr_cleaned_shape", 4)
def _(txn):
    return P.shape_summary(materialize(P.iqr_cleaned(txn.select(C.AMOUNT), C.AMOUNT)), C.AMOUNT)


@query("box_numbers", 4)
def _(txn):
    return P.box_numbers(txn, C.AMOUNT, C.TARGET)


@query("top_categories")
def _(txn):
    gaps = F.when(F.col("merchant") != "merch_7", F.col("merchant"))
    parts = [
        P.top_categories(rows, c).withColumn("column", F.lit(c))
        for rows, c in ((txn.withColumn("merchant", gaps), "merchant"), (txn, "city"))
    ]
    return L.union_all(*parts)


@query("mean_confidence_interval")
def _(txn):
    return P.mean_confidence_interval(txn, C.AMOUNT)


@query("mae_mape")
def _(txn):
    rows = txn.select(
        (F.col(C.AMOUNT) + 1).alias("actual"), (F.col("city_pop") / 1e3).alias("predicted")
    )
    return P.mae_mape(rows, "actual", "predicted")


@query("drop_collinear")
def _(txn):
    rows = row_features(txn)
    columns = ["amt", "amt_log", "lat", "merch_lat", "long", "merch_long", "city_pop", "city_pop_log"]
    kept = P.drop_collinear(rows, columns)
    return P.correlation_pairs(rows, kept)


# Joins, splits, samples


@query("left_equi_join")
def _(txn):
    return H.with_card_profile(txn).select(C.ROW_ID, "card_avg_amt", "card_stddev_amt")


@query("time_series_folds")
def _(txn):
    a = L.time_series_folds(txn, 3).select(C.ROW_ID, "test_fold")
    b = L.time_series_folds(txn, 4, txn.count() // 8).select(C.ROW_ID, F.col("test_fold").alias("sized_fold"))
    return a.join(b, C.ROW_ID)


@query("block_folds")
def _(txn):
    return L.block_folds(txn, 4, 0.22).select(C.ROW_ID, "test_block")


@query("time_based_split")
def _(txn):
    parts = L.time_based_split(txn, 0.2)
    return L.union_all(*[p.select(C.ROW_ID, F.lit(n).alias("part")) for p, n in zip(parts, ("train", "validation"))])


@query("stratified_split")
def _(txn):
    parts = L.stratified_split(txn, 0.2)
    return L.union_all(*[p.select(C.ROW_ID, F.lit(n).alias("part")) for p, n in zip(parts, ("train", "test"))])


@query("exact_sample")
def _(txn):
    return L.exact_sample(txn, 500).select(C.ROW_ID)


@query("balance_data")
def _(txn):
    return L.balance_data(SI.train_rows(txn)).select(C.ROW_ID, C.TARGET)


@query("top_n")
def _(txn):
    return L.top_n(txn, C.AMOUNT, 25, C.ROW_ID).select(C.ROW_ID, C.AMOUNT)


@query("union_all")
def _(txn):
    return L.union_all(*_pair(txn)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_sorted")
def _(txn):
    return L.distinct_sorted(txn.withColumn("day", F.to_date(C.TIME)), "day", "2024-01-10")


# Encoders


def _featured(txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of train and test, computed apart; written once since encoders scan twice."""
    return tuple(materialize(feature_engineering(part)) for part in _pair(txn))


@query("median_impute")
def _(txn):
    columns = ["avg_amt_expanding", "stddev_amt_expanding", "time_diff_hours"]
    train, test = (materialize(history_features(p).select(C.ROW_ID, *columns)) for p in _pair(txn))
    values = N.medians(train, columns)
    return L.union_all(*[E.median_impute(part, values) for part in (train, test)])


@query("standard_scale")
def _(txn):
    train, test = _pair(txn)
    stats = E.scale_statistics(train, ["amt", "lat"])
    return L.union_all(*[E.standard_scale(p.select(C.ROW_ID, "amt", "lat"), stats, "_scaled") for p in (train, test)])


@query("target_encode")
def _(txn):
    train, test = _pair(txn)
    unseen = F.when(F.col("merchant") != "merch_3", F.col("merchant"))
    fitted = E.SmoothedTargetEncoder(C.TARGET_ENCODED_COLUMNS).fit(train.withColumn("merchant", unseen))
    return fitted.transform(test).select(C.ROW_ID, *fitted.names())


@query("one_hot")
def _(txn):
    train, test = _pair(txn)
    seen = train.where(F.col("category") != "click")
    columns = E.one_hot(E.one_hot_categories(seen, ["gender", "category"]))
    return test.select(C.ROW_ID, *[v.cast("int").alias(n) for n, v in columns.items()])


@query("encoded_matrix", 4)
def _(txn):
    train, test = _featured(txn)
    fitted = E.FeatureEncoder().fit(train)
    return L.union_all(*[fitted.encode(part, [C.ROW_ID]) for part in (train, test)])


# Training


#: What was fitted in this application, by application, name and input files.
_FITTED: dict[tuple, object] = {}
ON_RELEASE.append(_FITTED.clear)


def _once(txn: DataFrame, name: str, build: Callable[[], object]) -> object:
    """Fitting is the long part of these queries, and several of them read the same fit."""
    key = (txn.sparkSession.sparkContext.applicationId, name, *sorted(txn.inputFiles()))
    if key not in _FITTED:
        _FITTED[key] = build()
    return _FITTED[key]


def _encoded(txn: DataFrame) -> tuple[E.FeatureEncoderModel, DataFrame, DataFrame]:
    def build():
        train, test = _featured(txn)
        fitted = E.FeatureEncoder().fit(train)
        return fitted, materialize(fitted.transform(train)), materialize(fitted.transform(test))

    return _once(txn, "encoded", build)


def _matrix(txn: DataFrame) -> tuple:
    """The training matrix and its class counts, which all fits share."""
    def build():
        rows = G.matrix(_encoded(txn)[1])
        return rows, G.class_counts(rows)

    return _once(txn, "matrix", build)


def _bins(txn: DataFrame):
    """The bins of the training matrix, for boosted fits."""
    return _once(txn, "bins", lambda: G.binned(_matrix(txn)[0]))


def _model(txn: DataFrame, name: str):
    """A preset at full size, fitted on the training rows."""
    rows, counts = _matrix(txn)

    def build():
        return G.train(rows, name, bins=_bins(txn) if G.needs_bins(name, rows, sum(counts)) else None, counts=counts)

    return _once(txn, name, build)


def _models(txn: DataFrame, names: list[str] | None = None) -> dict:
    """All presets, or those named; those that are not fitted yet are fitted side by side."""
    names = list(G.PRESETS) if names is None else names
    rows, counts = _matrix(txn)
    if any(G.needs_bins(n, rows, sum(counts)) for n in names):
        _bins(txn)
    return dict(zip(names, G.together([lambda n=n: _model(txn, n) for n in names])))


def _scores(txn: DataFrame, name: str) -> DataFrame:
    return _once(txn, f"scores of {name}", lambda: materialize(G.score_rows(_model(txn, name), _encoded(txn)[2])))


@query("class_weights")
def _(txn):
    return G.class_weights(SI.train_rows(txn))


def _reloaded(txn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Test scores of encoder and model, and of both after they were saved and loaded."""
    fitted, _, _ = _encoded(txn)
    folder = new_path(txn.sparkSession)
    fitted.save(f"{folder}/encoder")
    G.save_model(_model(txn, "Logistic Regression"), "Logistic Regression", folder)
    encoder = E.FeatureEncoderModel.load(txn.sparkSession, f"{folder}/encoder")
    again = encoder.transform(feature_engineering(SI.test_rows(txn)))
    return _scores(txn, "Logistic Regression"), G.score_rows(G.load_model("Logistic Regression", folder), again)


@query("model_store")
def _(txn):
    return _reloaded(txn)[1]


@query("model_store_check")
def _(txn):
    """Rows whose score changes when encoder and model are saved and loaded."""
    before, after = _reloaded(txn)
    both = before.select(C.ROW_ID, F.col("score").alias("_a")).join(after.select(C.ROW_ID, F.col("score").alias("_b")), C.ROW_ID, "full")
    same = F.col("_a").eqNullSafe(F.col("_b")) | (F.abs(F.col("_a") - F.col("_b")) < 1e-12)
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.coalesce(same, F.lit(False))).alias("n_changed"))


def _trained(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda txn: M.evaluate_scores(_scores(txn, name), name)


query("train_logistic")(_trained("Logistic Regression"))
query("train_forest")(_trained("Random Forest"))
query("train_gbt")(_trained("Gradient Boosted Trees"))
query("train_xgboost")(_trained("XGBoost"))
query("train_lightgbm")(_trained("LightGBM"))


@query("train_all")
def _(txn):
    _models(txn)
    return L.union_all(*[_trained(name)(txn) for name in G.PRESETS])


@query("train_all_check")
def _(txn):
    """Per model: scored rows, scores out of range, and what the confusion counts add up to."""
    _models(txn)
    parts = [
        _scores(txn, name).agg(
            F.lit(name).alias("model"), F.count("score").alias("n_scored"),
            F.count_if((F.col("score") < 0) | (F.col("score") > 1)).alias("n_out_of_range"),
        ).join(
            M.evaluate_scores(_scores(txn, name), name)
            .select("model", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n_counted")),
            "model",
        )
        for name in G.PRESETS
    ]
    return L.union_all(*parts)


@query("boosting_check")
def _(txn):
    """Per boosted model: trees, the rows of an unsampled root, and trees that break their bounds."""
    parts = []
    for name in G.BOOSTED:
        model = _model(txn, name)
        nodes, p = txn.sparkSession.createDataFrame(model.nodes), model.settings
        leaf = F.col("feature") < 0
        trees = nodes.groupBy("tree").agg(
            F.sum(leaf.cast("long")).alias("leaves"), F.max(F.when(F.col("node") == 0, F.col("rows"))).alias("root"),
            F.sum(F.when(leaf, F.col("rows"))).alias("in_leaves"), F.min(F.when(leaf, F.col("rows"))).alias("least"),
        )
        parts.append(trees.agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_trees"),
            (F.max("root") if p.subsamplingRate == 1 else F.lit(None).cast("long")).alias("n_root_rows"),
            F.count_if(F.col("leaves") > p.numLeaves).alias("n_too_many_leaves"),
            F.count_if(F.col("least") < F.least(F.lit(p.minInstancesPerNode), F.col("root"))).alias("n_small_leaves"),
            F.count_if(F.col("root") != F.col("in_leaves")).alias("n_lost_rows"),
        ))
    return L.union_all(*parts)


@query("search_check")
def _(txn):
    """Trials, ranges that a draw left, measures out of range, and whether the first trial is the best."""
    table, _ = _searched(txn)
    outside = [
        (F.col(k).cast("double") < low) | (F.col(k).cast("double") > high) for k, (low, high, _) in G.BOOSTING_SPACE.items()
    ]
    ap = F.col("average_precision")
    first = table.orderBy(F.desc("average_precision"), "trial").first()["trial"]
    return table.agg(
        F.count(F.lit(1)).alias("n_trials"), F.countDistinct("trial").alias("n_different"),
        *[F.count_if(o).alias(f"n_outside_{k}") for k, o in zip(G.BOOSTING_SPACE, outside)],
        F.count_if(ap.isNull() | (ap < 0) | (ap > 1)).alias("n_bad_measures"),
        (F.max_by("trial", F.struct(ap, -F.col("trial"))) == F.lit(first)).alias("best_first"),
    )


def _searched(txn: DataFrame):
    def build():
        train = materialize(feature_engineering(SI.train_rows(txn)))
        table, model = G.param_search([L.time_based_split(train, 0.2)], "LightGBM", G.BOOSTING_SPACE, trials=25, full=train)
        return materialize(table), model

    return _once(txn, "search", build)


@query("param_search")
def _(txn):
    """The trials, best first; beside the best, the measures of its refit on the test rows."""
    table, model = _searched(txn)
    ranked = [F.desc("average_precision"), "trial"]
    refit = M.evaluate_scores(materialize(G.score_rows(model, _encoded(txn)[2])), "LightGBM Tuned").drop("model")
    refit = refit.select(F.lit(table.orderBy(*ranked).first()["trial"]).alias("trial"), *[F.col(c).alias(f"test_{c}") for c in refit.columns])
    return table.join(refit, "trial", "left").orderBy(*ranked)


@query("calibrate")
def _(txn):
    _, train, test = _encoded(txn)
    small = L.balance_data(train)
    model = _once(txn, "undersampled forest", lambda: G.train(small, "Random Forest", strategy="undersample"))
    held_out = materialize(G.score_rows(model, train))
    scores = materialize(G.score_rows(model, test))
    parts = [
        G.calibrate(held_out, m)(scores).select(C.ROW_ID, "label", F.col("score").alias(m))
        for m in ("isotonic", "sigmoid")
    ]
    return parts[0].join(parts[1].drop("label"), C.ROW_ID)


def _swept(txn: DataFrame) -> DataFrame:
    def build():
        _, train, test = _encoded(txn)
        return materialize(G.ratio_sweep(train, test, [1, 5, 10, 20], calibrated=True))

    return _once(txn, "ratios", build)


@query("calibrate_check")
def _(txn):
    """Calibrated scores out of range, and pairs of neighbours in score that changed places."""
    _, train, test = _encoded(txn)
    model = _model(txn, "Random Forest")
    scores, held_out = _scores(txn, "Random Forest"), materialize(G.score_rows(model, train))
    parts = []
    for method in ("isotonic", "sigmoid"):
        found = G.calibrate(held_out, method)(scores).select(C.ROW_ID, F.col("score").alias("p"))
        both = materialize(scores.select(C.ROW_ID, "score").join(found, C.ROW_ID))
        # Equal scores get equal values, and a larger score no smaller one.
        levels = both.groupBy("score").agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
        spread, window = row_blocks(levels, ["score"], 1, 0)
        falls = (F.col("before") > F.col("lo") + 1e-12) | (F.col("hi") > F.col("lo") + 1e-12)
        n_falls = spread.withColumn("before", F.lag("hi").over(window)).where("_own").where(falls).count()
        parts.append(both.agg(
            F.lit(method).alias("method"), F.count("p").alias("n_rows"),
            F.count_if((F.col("p") < 0) | (F.col("p") > 1)).alias("n_out_of_range"), F.lit(n_falls).alias("n_falls"),
        ))
    return L.union_all(*parts)


@query("ratio_sweep")
def _(txn):
    return _swept(txn)


@query("ratio_sweep_check")
def _(txn):
    """Per ratio: rows counted in the confusion table, and rows that the undersampled table has."""
    _, train, _ = _encoded(txn)
    kept = [
        L.balance_data(train, C.TARGET, ratio, C.SEED).agg(
            F.lit(float(ratio)).alias("ratio"), F.count_if(F.col(C.TARGET) == 1).alias("n_positive"),
            F.count_if(F.col(C.TARGET) == 0).alias("n_negative"),
        )
        for ratio in (1, 5, 10, 20)
    ]
    counted = _swept(txn).select("ratio", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n_counted"))
    return L.union_all(*kept).join(counted, "ratio")


@query("best_ratios_check")
def _(txn):
    """Measures for which another ratio beats the one that is called best."""
    swept, best = _swept(txn), G.best_ratios(_swept(txn))
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("other")) for m in ("f1", "g_mean", "pr_auc")]))
    others = swept.select(cells.alias("_c")).select("_c.*")
    return best.join(others, "measure").groupBy("measure").agg(
        F.count(F.lit(1)).alias("n_ratios"), F.count_if(F.col("other") > F.col("value")).alias("n_better")
    )


@query("best_ratios")
def _(txn):
    return G.best_ratios(_swept(txn))


# Evaluation


@query("classification_metrics")
def _(txn):
    return M.classification_metrics(SI.scored(txn))


@query("score_transactions")
def _(txn):
    return _scores(txn, "Random Forest")


@query("rank_curves")
def _(txn):
    return M.rank_points(SI.scored(txn)).select("score", "tp", "fp", "tpr", "fpr", "precision")


@query("rank_metrics")
def _(txn):
    return M.rank_metrics(SI.scored(txn))


@query("cost_curve", 4)
def _(txn):
    return M.cost_curve(SI.scored(txn))


@query("cost_threshold", 4)
def _(txn):
    return M.cost_threshold(SI.scored(txn))


@query("cost_scenarios")
def _(txn):
    return M.cost_scenarios(M.confusion_by_threshold(SI.scored(txn), [0.1, 0.3, 0.5, 0.7, 0.9]), "threshold")


@query("best_model_summary", 4)
def _(txn):
    scores = {n: _scores(txn, n) for n in G.PRESETS}
    results = materialize(L.union_all(*[M.evaluate_scores(s, n) for n, s in scores.items()]))
    return M.best_model_summary(results, scores)


@query("best_model_check")
def _(txn):
    """The summary's model against the largest measure in the table of all models."""
    scores = {n: _scores(txn, n) for n in _models(txn)}
    results = materialize(L.union_all(*[M.evaluate_scores(s, n) for n, s in scores.items()]))
    named = M.best_model_summary(results, scores).first()["model"]
    return results.agg(
        F.count(F.lit(1)).alias("n_models"),
        (F.max(F.when(F.col("model") == named, F.col("pr_auc"))) == F.max("pr_auc")).alias("is_best"),
    )


@query("importance_check")
def _(txn):
    """Per model: features, negative importances, and whether those of trees add up to one."""
    names, parts = _encoded(txn)[0].feature_names(), []
    for name, model in _models(txn, ["Random Forest", *G.BOOSTED]).items():
        table = M.importance_table(txn.sparkSession, names, [v for _, v in G.importances(model, names)], top=None)
        value = F.col("importance")
        parts.append(table.agg(
            F.lit(name).alias("model"), (F.count(F.lit(1)) == len(names)).alias("all_features"),
            F.count_if(value < 0).alias("n_negative"), F.round(F.sum(value), 6).alias("total"),
        ))
    return L.union_all(*parts)


@query("fold_means_check")
def _(txn):
    """Models in the walk-forward summary, and mean measures out of range."""
    means = _walked(txn)
    measures = [c for c in means.columns if c != "model"]
    bad = [F.count_if(F.col(c).isNull() | (F.col(c) < 0) | (F.col(c) > 1)).alias(f"n_bad_{c}") for c in measures]
    return means.agg(F.countDistinct("model").alias("n_models"), *bad)


@query("fold_means")
def _(txn):
    return _walked(txn)


def _walked(txn: DataFrame) -> DataFrame:
    def build():
        rows = materialize(L.time_series_folds(feature_engineering(txn), 5))
        results = G.fold_results([L.fold(rows, k) for k in range(1, 6)], list(G.PRESETS))
        return materialize(G.fold_summary(results))

    return _once(txn, "folds", build)


@query("importance_table")
def _(txn):
    named = G.importances(_model(txn, "Random Forest"), _encoded(txn)[0].feature_names())
    return M.importance_table(txn.sparkSession, [n for n, _ in named], [v for _, v in named])


@query("sampled_attribution")
def _(txn):
    fitted, _, test = _encoded(txn)
    names = fitted.feature_names()
    parts = []
    for name in ("Logistic Regression", "Random Forest", "LightGBM"):
        parts.append(X.attribution(_model(txn, name), test, names, sample=2000).withColumn("model", F.lit(name)))
    return L.union_all(*parts)


@query("attribution_check")
def _(txn):
    """Per exact model: explained rows, and rows whose contributions do not add up to the margin."""
    fitted, _, test = _encoded(txn)
    names, parts = fitted.feature_names(), []
    for name in ("Logistic Regression", *G.BOOSTED):
        model = _model(txn, name)
        raw = model.transform(test).select(C.ROW_ID, G.vector_to_array("rawPrediction")[1].alias("margin"))
        if name in G.BOOSTED:
            found, base = X.tree_contributions(model, test, names, sample=500)
        else:
            found = X.linear_contributions(model, test, names, sample=500)
        sums = materialize(
            found.groupBy(C.ROW_ID).agg(F.sum("contribution").alias("sum"), F.count(F.lit(1)).alias("n")).join(raw, C.ROW_ID)
        )
        if name not in G.BOOSTED:
            # Contributions of the linear model are those beside the mean row of the sample.
            base = sums.agg(F.avg("margin")).first()[0] or 0.0
        off = F.abs(F.col("sum") + F.lit(base) - F.col("margin")) > 1e-6 * (1 + F.abs("margin"))
        parts.append(sums.agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.count_if(off).alias("n_off"),
            F.count_if(F.col("n") != len(names)).alias("n_incomplete"),
        ))
    return L.union_all(*parts)
