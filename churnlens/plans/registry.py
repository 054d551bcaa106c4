"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given ``events`` table (through the event-log adapter)
and runs one operator or job of the library over all of it. Double columns
are rounded to 6 decimals (float32 for the ``describe`` figures, whose sums
are order-dependent at their magnitude) so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators import clean as C
from churnlens.operators import explore as X
from churnlens.operators import features as FE
from churnlens.operators.histogram import histogram
from churnlens.operators.joins import attach_features, materialize, rows_of_users
from churnlens.operators.metrics import evaluator_metrics, weighted_metrics
from churnlens.operators.ml import assembler, scaler, train, train_with_scores
from churnlens.operators.split import split_column, train_validation_split, with_class_weights
from churnlens.plans.clean_job import run_clean
from churnlens.plans.compare import compare_models
from churnlens.plans.evaluate_job import evaluate, run_evaluation
from churnlens.plans.feature_job import feature_table, run_features, weighted_split
from churnlens.plans.train_job import run_training
from churnlens.schema import FEATURE_PAGES, RAW_COLUMNS
from churnlens.session import ensure_core_conf, scratch_path
from churnlens.sources import (
    events_as_event_log, events_with_nulls, load_model, read_event_log, read_fold_scores, read_metrics,
    read_parquet, save_model, write_event_log_json, write_metrics, write_parquet,
)

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (``round(x * 10^d) / 10^d``)."""
    scale = float(10 ** digits)
    return df.select(*[
        (F.round(F.col(f.name) * scale) / scale).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields])


# --- Inputs ----------------------------------------------------------------------

def raw(spark: SparkSession, sf: str) -> DataFrame:
    ensure_core_conf(spark)
    return events_as_event_log(spark, sf)


def kept(spark: SparkSession, sf: str) -> DataFrame:
    return C.keep_columns(C.drop_anonymous(C.with_user_system(raw(spark, sf))))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(raw(spark, sf))


def features(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table(cleaned(spark, sf))


# --- Sources and cleaning --------------------------------------------------------

def q_load_events(spark, sf):
    """JSON source: the adapted log written as JSON lines and read back with the schema."""
    path = write_event_log_json(raw(spark, sf), scratch_path(spark, "event-log-json"))
    return read_event_log(spark, path).select(*RAW_COLUMNS)


def q_user_system(spark, sf):
    return C.with_user_system(raw(spark, sf))


def q_drop_anonymous(spark, sf):
    return C.drop_anonymous(C.with_user_system(raw(spark, sf)))


def q_kept_columns(spark, sf):
    return kept(spark, sf)


def q_cancel_flag(spark, sf):
    return C.with_cancel_flag(kept(spark, sf))


def q_churn_label(spark, sf):
    return C.with_churn(C.with_cancel_flag(kept(spark, sf)))


def q_clean_log(spark, sf):
    return rounded(cleaned(spark, sf))


def q_churn_phase(spark, sf):
    return rounded(C.with_churn_phase(cleaned(spark, sf)))


def q_time_parts(spark, sf):
    return X.with_time_parts(cleaned(spark, sf)).select("userId", "ts", "hour", "month", "weekday")


# --- Profiles --------------------------------------------------------------------

def q_unique(column):
    return lambda spark, sf: X.unique_values(raw(spark, sf), column)


def q_first_events(spark, sf):
    """A look at the first ten raw events, ordered by time, then every column."""
    df = raw(spark, sf)
    order = ["ts"] + [c for c in df.columns if c != "ts"]
    return X.first_rows(df, 10, order)


def q_null_profile(spark, sf):
    return X.null_profile(raw(spark, sf))


def q_describe_events(spark, sf):
    """Figures as doubles; mean and deviation to nine significant digits, as their sums
    depend on the order of the rows in the last bits."""
    d = X.describe_numeric(raw(spark, sf))
    return d.select("column", "count", *[_nine_digits(F.col(c)).alias(c) for c in ("mean", "stddev")], "min", "max")


def _nine_digits(c):
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))) - 8)
    return F.when(c == 0, 0.0).otherwise(F.round(c / unit)).cast("long")


def q_describe_strings(spark, sf):
    return X.describe_strings(raw(spark, sf))


def with_nulls(spark, sf):
    ensure_core_conf(spark)
    return C.clean(events_with_nulls(spark, sf))


def _as_text(df):
    """Whole numbers that may be NULL as text, which compares alike everywhere."""
    return df.withColumns({c: F.col(c).cast("string") for c in ("ts", "itemInSession")})


def q_null_edge_weights(spark, sf):
    """Class weights by a column with NULLs: every row keeps a weight."""
    return rounded(with_class_weights(with_nulls(spark, sf), by=["gender"]).select("userId", "gender", "churn", "weightCol"))


def q_null_edge_histogram(spark, sf):
    return rounded(histogram(with_nulls(spark, sf), "itemInSession", ("gender",)))


def q_null_edge_users(spark, sf):
    c = with_nulls(spark, sf)
    return rounded(attach_features(attach_features(FE.avg_items_p_sess(c), FE.acc_age(c), ["acc_age"]),
                                   FE.avg_sess_len(c), ["avg_sess_len"]))


def q_random_split(spark, sf):
    """``randomSplit`` of the users: where SQL cannot know the parts, their union, overlap and seed are checked."""
    f = materialize(FE.user_features(cleaned(spark, sf)).select("userId", "churn"), "split-input")
    train_df, validation = train_validation_split(f, method="random")
    again = train_validation_split(f, method="random")[1].select("userId", F.lit(1).alias("again"))
    parts = train_df.withColumn("part", F.lit(1)).unionByName(validation.withColumn("part", F.lit(2)))
    return (parts.join(again, "userId", "left").groupBy("userId", "churn")
            .agg(F.count(F.lit(1)).alias("times"),
                 F.bool_and(F.coalesce(F.col("again") == 1, F.lit(False)) == (F.col("part") == 2)).alias("same_again")))


def q_clean_job(spark, sf):
    """The clean job through its own source and sink: JSON lines in, parquet out."""
    path = write_event_log_json(raw(spark, sf), scratch_path(spark, "job-log-json"))
    out = run_clean(spark, path, scratch_path(spark, "job-cleaned"))
    return rounded(read_parquet(spark, out))


def _job_tables(spark, sf):
    cleaned_path = write_parquet(cleaned(spark, sf), scratch_path(spark, "job-cleaned"))
    return run_features(spark, cleaned_path, scratch_path(spark, "job-train"), scratch_path(spark, "job-validation"))


def q_feature_job(spark, sf):
    """The feature job's two tables, read back."""
    train_path, validation_path = _job_tables(spark, sf)
    parts = [read_parquet(spark, p).withColumn("split", F.lit(n))
             for p, n in ((train_path, "train"), (validation_path, "validation"))]
    return rounded(parts[0].unionByName(parts[1]).drop("pref_user_system_ohe"))


def _trained(spark, sf):
    """Paths of the validation table and of a model that the training job saved."""
    train_path, validation_path = _job_tables(spark, sf)
    model_path = scratch_path(spark, "job-model")
    run_training(spark, "nb", train_path, model_path)
    return validation_path, model_path


def q_evaluate_job(spark, sf):
    """Train, save, evaluate as jobs; the metrics record as written next to the model."""
    validation_path, model_path = _trained(spark, sf)
    run_evaluation(spark, validation_path, model_path)
    return rounded(read_metrics(spark, {"nb": model_path}).drop("Path"))


def q_training_job_scores(spark, sf):
    """The fold scores that the training job writes beside the model."""
    return rounded(read_fold_scores(spark, _trained(spark, sf)[1]))


def q_ordered_shares(spark, sf):
    """The loyal users' hour shares with their place in the output's order."""
    rows = q_share("hour", X.loyal)(spark, sf).coalesce(1).withColumn("place", F.monotonically_increasing_id())
    before = F.lag("count").over(Window.orderBy("place"))  # at most 24 rows
    return rows.withColumn("in_order", F.coalesce(before >= F.col("count"), F.lit(True))).drop("place")


def q_ordered_sessions(spark, sf):
    """Whether each session follows its predecessor in the output's order (user, start)."""
    s = X.session_durations(cleaned(spark, sf))
    starts = cleaned(spark, sf).groupBy("userId", "sessionId").agg(F.min("ts").alias("start"))
    placed = materialize(s.withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id()), "ordered")
    w = Window.partitionBy("userId").orderBy("__id")
    x = placed.join(starts, ["userId", "sessionId"])
    return x.select("userId", "sessionId", F.coalesce(F.lag("start").over(w) <= F.col("start"), F.lit(True)).alias("in_order"))


# --- Per-user features -----------------------------------------------------------

def q_user_label(spark, sf):
    return FE.user_label(cleaned(spark, sf))


def q_feature(fn):
    return lambda spark, sf: rounded(fn(cleaned(spark, sf)))


def q_sql_features(spark, sf):
    """Per-user features written as SQL text over the cleaned log, using the SQL helpers."""
    from churnlens.functions.sql import register_sql_functions

    register_sql_functions(spark)
    return rounded(spark.sql(
        """SELECT userId,
                  COUNT(DISTINCT sessionId) / (to_days(MAX(ts) - MIN(ts)) + 1) AS avg_sess_p_day,
                  to_days(MAX(ts) - MIN(ts)) AS acc_age,
                  to_month(AVG(ts)) AS mean_month,
                  to_hour(MIN(ts)) AS first_hour,
                  to_day(MAX(ts)) AS last_weekday,
                  MAX(to_minutes(ts - 1704067200000)) AS max_minute_of_day
           FROM {log} GROUP BY userId""", log=cleaned(spark, sf)))


def q_attach_features(spark, sf):
    c = cleaned(spark, sf)
    out = attach_features(FE.user_label(c), FE.avg_length(c), ["avg_length"])
    return rounded(attach_features(out, FE.acc_age(c), ["acc_age"]))


def q_page_clicks_monthly(spark, sf):
    return rounded(FE.page_clicks(cleaned(spark, sf)))


def q_page_pivot(spark, sf):
    return rounded(FE.page_pivot(FE.page_clicks(cleaned(spark, sf))))


def q_training_pages(spark, sf):
    return rounded(FE.page_pivot(FE.page_clicks(cleaned(spark, sf)), FEATURE_PAGES))


def q_user_features(spark, sf):
    return rounded(features(spark, sf).drop("pref_user_system_ohe"))


# --- Group comparisons -----------------------------------------------------------

def q_loyal_events(spark, sf):
    c = cleaned(spark, sf)
    return rows_of_users(c, X.loyal_users(c)).select("userId", "ts", "page")


def q_loyal_events_all(spark, sf):
    c = cleaned(spark, sf)
    return rows_of_users(c, X.loyal_users(c))


def q_share(bucket, group):
    return lambda spark, sf: rounded(X.bucket_share(cleaned(spark, sf), bucket, group()))


def q_explore(fn):
    return lambda spark, sf: rounded(fn(cleaned(spark, sf)))


def q_system_by_churn(spark, sf):
    return X.system_counts(cleaned(spark, sf))


def q_by_churn(fn, **kw):
    """A per-user feature computed per (churn, userId), as the group comparisons use it."""
    return lambda spark, sf: rounded(fn(cleaned(spark, sf), X.BY_CHURN_USER, **kw))


def q_lifetimes(spark, sf):
    return X.lifetimes(cleaned(spark, sf))


def q_session_stats_long(spark, sf):
    return rounded(X.melt(X.session_stats(cleaned(spark, sf)), ["churn", "userId"]))


def q_up_down_grades_long(spark, sf):
    return X.melt(X.up_down_grades(cleaned(spark, sf)), ["churn", "userId"], "long")


# --- Histograms ------------------------------------------------------------------

def q_hist_avg_length(spark, sf):
    return rounded(histogram(FE.avg_length(cleaned(spark, sf), X.BY_CHURN_USER, "avg_len"),
                             "avg_len"))


def q_hist_items_p_sess(spark, sf):
    return rounded(histogram(FE.avg_items_p_sess(cleaned(spark, sf), X.BY_CHURN_USER, "avg"),
                             "avg"))


def q_hist_sess_p_day(spark, sf):
    return rounded(histogram(FE.avg_sess_p_day(cleaned(spark, sf), X.BY_CHURN_USER),
                             "avg_sess_p_day", bins=[0, 1, 2, 3, 4, 5]))


def q_hist_lifetime(spark, sf):
    return rounded(histogram(X.lifetimes(cleaned(spark, sf)), "lifetime", density=True))


def q_hist_session_duration(spark, sf):
    return rounded(histogram(X.session_durations(cleaned(spark, sf), ordered=False),
                             "session_duration", density=True))


def q_hist_session_stats(spark, sf):
    long = X.melt(X.session_stats(cleaned(spark, sf)), ["churn", "userId"])
    return rounded(histogram(long, "value", ("churn", "variable"), density=True))


def q_hist_up_down_grades(spark, sf):
    long = X.melt(X.up_down_grades(cleaned(spark, sf)), ["churn", "userId"], "long")
    return rounded(histogram(long, "value", ("churn", "variable"), density=True))


# --- Split, weights, ML features ---------------------------------------------------

def q_train_val_split(spark, sf):
    f = FE.user_features(cleaned(spark, sf))
    return f.select("userId", "churn", split_column().alias("split"))


def q_class_weights(spark, sf):
    f = FE.user_features(cleaned(spark, sf)).select("userId", "churn")
    f = f.withColumn("split", split_column())
    return rounded(with_class_weights(f, by=["split"], groups=2))


def q_system_index(spark, sf):
    return features(spark, sf).select("userId", "pref_user_system", "pref_user_system_ind")


def q_system_onehot(spark, sf):
    arr = vector_to_array("pref_user_system_ohe")
    hot = F.array_position(arr, 1.0).cast("int") - 1
    return features(spark, sf).select(
        "userId", "pref_user_system_ind", F.size(arr).alias("ohe_size"),
        F.when(hot >= 0, hot).alias("ohe_hot"))


def _long_vector(df: DataFrame, col: str) -> DataFrame:
    """All vector entries as ``userId, size, idx, value`` rows."""
    arr = vector_to_array(col)
    return df.select("userId", F.size(arr).alias("size"), F.posexplode(arr).alias("idx", "value"))


def q_assembled_users(spark, sf):
    return rounded(_long_vector(assembler().transform(features(spark, sf)), "features"))


def q_scaled_features(spark, sf):
    assembled = assembler().transform(features(spark, sf))
    scaled = scaler().fit(assembled).transform(assembled)
    return rounded(_long_vector(scaled, "features_scaled"))


def q_confusion_metrics(spark, sf):
    """Metric operator fed with a fixed rule (``acc_age < 15`` -> churn)."""
    f = with_class_weights(FE.user_features(cleaned(spark, sf)))
    pred = f.withColumn("prediction", F.when(F.col("acc_age") < 15, 1.0).otherwise(0.0))
    return rounded(weighted_metrics(pred))


def q_churn_model(algo):
    def run(spark, sf):
        train_df, validation = weighted_split(features(spark, sf))
        model = train(train_df, algo)
        return model.transform(validation).select("userId", "churn", "prediction")
    return run


def q_churn_facts(algo):
    """What SQL can know of an iterative or randomised model: the users scored and their
    label, and, computed from the fitted model, that a saved and reloaded model agrees and
    that the one-pass metrics equal MLlib's."""
    def run(spark, sf):
        train_df, validation = (materialize(x, "model-part") for x in weighted_split(features(spark, sf)))
        model = train(train_df, algo)
        again = load_model(save_model(model, scratch_path(spark, f"model-{algo}")))
        scored = model.transform(validation).select("userId", "churn", "weightCol", "prediction")
        reloaded = again.transform(validation).select("userId", F.col("prediction").alias("__again"))
        scored = materialize(scored, "scored")
        ours = weighted_metrics(scored).first().asDict()
        theirs = evaluator_metrics(scored)
        equal = all(abs(ours[k] - theirs[k]) < 1e-9 for k in ours)
        return scored.join(reloaded, "userId").select(
            "userId", "churn", F.col("prediction").isin(0.0, 1.0).alias("is_class"),
            (F.col("prediction") == F.col("__again")).alias("reload_agrees"), F.lit(equal).alias("metrics_agree"))
    return run


def q_churn_cv_nb(spark, sf):
    """Cross-validation of naive Bayes with folds from a hash of the user: mean and spread
    of the folds' F1."""
    train_df, _ = weighted_split(features(spark, sf))
    fold = F.conv(F.substring(F.md5(F.concat(F.lit("fold:"), "userId")), 1, 8), 16, 10).cast("long") % 3
    fitted = train_with_scores(train_df.withColumn("fold", fold.cast("int")), "nb", fold_col="fold")
    return rounded(spark.createDataFrame([(float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0]))],
                                         "f1_mean double, f1_std double"))


def q_model_roundtrip(spark, sf):
    """Save a fitted pipeline, load it back and score the validation split.

    Uses naive Bayes, whose closed form lets SQL check the reloaded model.
    """
    train_df, validation = weighted_split(features(spark, sf))
    path = save_model(train(train_df, "nb"), scratch_path(spark, "model-nb"))
    return load_model(path).transform(validation).select("userId", "churn", "prediction")


def q_model_comparison(spark, sf):
    train_df, validation = (materialize(x, "model-part") for x in weighted_split(features(spark, sf)))
    root = scratch_path(spark, "models")
    paths = {}
    for algo in ("svm", "lr", "nb", "rf"):
        path = save_model(train(train_df, algo), f"{root}/{algo}")
        write_metrics(evaluate(load_model(path), validation, path), path)
        paths[algo] = path
    # naive Bayes by value; of the others, that the records hold what the saved models score
    table = compare_models(spark, paths)
    again = None
    for algo, path in paths.items():
        m = weighted_metrics(load_model(path).transform(validation))
        one = (m.select(F.lit(algo).alias("Algorithm"), *[F.col(c.lower()).alias(c) for c in ("Recall", "Precision", "Accuracy", "F1")])
               .unpivot(["Algorithm"], ["Recall", "Precision", "Accuracy", "F1"], "Metric", "__again"))
        again = one if again is None else again.unionByName(one)
    return rounded(table.join(again, ["Algorithm", "Metric"]).select(
        "Algorithm", "Metric", F.when(F.col("Algorithm") == "nb", F.col("Score")).alias("Score"),
        (F.abs(F.col("Score") - F.col("__again")) < 1e-9).alias("agrees"), F.col("Score").between(0, 1).alias("in_range")))


QUERIES: dict[str, Query] = {
    # sources and cleaning
    "load_events": q_load_events,
    "user_system": q_user_system,
    "drop_anonymous": q_drop_anonymous,
    "kept_columns": q_kept_columns,
    "cancel_flag": q_cancel_flag,
    "churn_label": q_churn_label,
    "clean_log": q_clean_log,
    "churn_phase": q_churn_phase,
    "time_parts": q_time_parts,
    # profiles
    "unique_pages": q_unique("page"),
    "unique_levels": q_unique("level"),
    "unique_auth": q_unique("auth"),
    "unique_genders": q_unique("gender"),
    "first_events": q_first_events,
    "null_profile": q_null_profile,
    "describe_events": q_describe_events,
    "describe_strings": q_describe_strings,
    # rows with NULLs in the columns that the operators read
    "null_edge_clean": lambda spark, sf: rounded(_as_text(with_nulls(spark, sf))),
    "null_edge_phase": lambda spark, sf: rounded(_as_text(C.with_churn_phase(with_nulls(spark, sf)))),
    "null_edge_weights": q_null_edge_weights,
    "null_edge_histogram": q_null_edge_histogram,
    "null_edge_users": q_null_edge_users,
    "null_edge_genders": lambda spark, sf: X.gender_by_churn(with_nulls(spark, sf)),
    # jobs through their own sources and sinks
    "clean_job": q_clean_job,
    "feature_job": q_feature_job,
    "evaluate_job": q_evaluate_job,
    "training_job_scores": q_training_job_scores,
    # per-user features
    "user_label": q_user_label,
    "avg_sess_p_day": q_feature(FE.avg_sess_p_day),
    "avg_length": q_feature(FE.avg_length),
    "avg_items_p_sess": q_feature(FE.avg_items_p_sess),
    "acc_age": q_feature(FE.acc_age),
    "avg_sess_len": q_feature(FE.avg_sess_len),
    "bin_gender": q_feature(FE.bin_gender),
    "pref_user_system": q_feature(FE.pref_user_system),
    "attach_features": q_attach_features,
    "sql_features": q_sql_features,
    "page_clicks_monthly": q_page_clicks_monthly,
    "page_pivot": q_page_pivot,
    "training_pages": q_training_pages,
    "user_features": q_user_features,
    # group comparisons
    "cancelled_users": q_explore(X.cancelled_users),
    "loyal_users": q_explore(X.loyal_users),
    "loyal_events": q_loyal_events,
    "loyal_events_all": q_loyal_events_all,
    "gender_by_churn": q_explore(X.gender_by_churn),
    "system_by_churn": q_system_by_churn,
    "system_share": q_explore(X.system_share),
    "hour_share_loyal": q_share("hour", X.loyal),
    "hour_share_cancelled": q_share("hour", X.cancelled),
    "weekday_share_loyal": q_share("weekday", X.loyal),
    "weekday_share_cancelled": q_share("weekday", X.cancelled),
    "cancel_level": q_explore(X.cancel_level),
    "lifetime_stats": q_explore(X.lifetime_stats),
    "session_durations": q_explore(X.session_durations),
    "lifetimes": q_lifetimes,
    "avg_length_by_churn": q_by_churn(FE.avg_length, name="avg_len"),
    "avg_items_by_churn": q_by_churn(FE.avg_items_p_sess, name="avg"),
    "avg_sess_p_day_by_churn": q_by_churn(FE.avg_sess_p_day),
    "pref_user_system_by_churn": q_by_churn(FE.pref_user_system),
    "session_stats": q_explore(X.session_stats),
    "session_stats_long": q_session_stats_long,
    "up_down_grades": q_explore(X.up_down_grades),
    "up_down_grades_long": q_up_down_grades_long,
    "page_clicks_by_churn": q_explore(X.page_clicks_by_churn),
    "page_click_means": q_explore(X.page_click_means),
    # histograms
    "hist_avg_length": q_hist_avg_length,
    "hist_items_p_sess": q_hist_items_p_sess,
    "hist_sess_p_day": q_hist_sess_p_day,
    "hist_lifetime": q_hist_lifetime,
    "hist_session_duration": q_hist_session_duration,
    "hist_session_stats": q_hist_session_stats,
    "hist_up_down_grades": q_hist_up_down_grades,
    # split, weights, ML
    "train_val_split": q_train_val_split,
    "random_split": q_random_split,
    "ordered_shares": q_ordered_shares,
    "ordered_sessions": q_ordered_sessions,
    "class_weights": q_class_weights,
    "system_index": q_system_index,
    "system_onehot": q_system_onehot,
    "assembled_users": q_assembled_users,
    "scaled_features": q_scaled_features,
    "confusion_metrics": q_confusion_metrics,
    "churn_svm": q_churn_facts("svm"),
    "churn_nb": q_churn_model("nb"),
    "churn_lr": q_churn_facts("lr"),
    "churn_rf": q_churn_facts("rf"),
    "churn_cv_nb": q_churn_cv_nb,
    "model_roundtrip": q_model_roundtrip,
    "model_comparison": q_model_comparison,
}
