"""Queries on linear models: margins, SVM solvers and softmax regression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.order import start_value
from rankloom.operators import layout, metrics, softmax, svm
from rankloom.plans import words
from rankloom.plans.oracle import margin as sql
from rankloom.plans.registry import Query, rounded, saved
from rankloom.plans.views import Views

LAM, RATE = 100.0, 0.001
PEGASOS = {"epochs": 3, "batch_size": 100}
SGD = {"epochs": 20, "batch_size": 150, "block_batches": 2}
NEWTON = {"epochs": 2, "cg_tol": 0.0, "cg_iterations": 3}
NEWTON_SETTLED = {"epochs": 51, "cg_tol": 0.1}
CG_SETTLED = {"tol": 0.1, "max_iter": 100}
SOFTMAX_BATCH, EVAL_SEED = 256, 7


def given_weights(v: Views) -> DataFrame:
    return v.dense_features().select("idx").distinct().withColumn("w", start_value("idx", 0) * 20 - 10)


def scored(v: Views) -> DataFrame:
    return svm.margins(v.dense_features(), v.dense_labels().select("row_id", "y"), given_weights(v))


def gradient(v: Views) -> DataFrame:
    labels = v.dense_labels().select("row_id", "y")
    return svm.svm_gradient(v.dense_features(), labels, given_weights(v), labels.count(), 1, LAM)


def _train(v: Views) -> tuple[DataFrame, DataFrame]:
    return v.dense_features(False), v.dense_labels(False).select("row_id", "y")


def _test(v: Views) -> dict[str, DataFrame]:
    return {"test_features": v.dense_features(True), "test_labels": v.dense_labels(True).select("row_id", "y")}


def pegasos(v: Views) -> svm.SvmFit:
    return svm.svm_pegasos(*_train(v), LAM, learning_rate=RATE, **PEGASOS, **_test(v))


def sgd(v: Views) -> svm.SvmFit:
    return svm.svm_sgd(*_train(v), LAM, learning_rate=RATE, **SGD, **_test(v))


def newton(v: Views) -> svm.SvmFit:
    return svm.svm_newton(*_train(v), LAM, **NEWTON, **_test(v))


def _cg(v: Views) -> DataFrame:
    n = v.dense_labels().count()
    step, _ = svm.conjugate_gradient(v.dense_features(), gradient(v), n, LAM, tol=0.0, max_iter=3)
    return rounded(step, 6)


def _cg_settled(v: Views) -> DataFrame:
    n = v.dense_labels().count()
    step, done = svm.conjugate_gradient(v.dense_features(), gradient(v), n, LAM, **CG_SETTLED)
    return rounded(step, 6).withColumn("iterations", F.lit(done))


def _objective(v: Views) -> DataFrame:
    rows = saved(v, "svm-scored", lambda: scored(v))
    n = rows.count()
    value = svm.svm_objective(rows, given_weights(v), n, LAM)
    return rounded(svm.squared_hinge_loss(rows, n).withColumn("objective", F.lit(value)), 6)


def _trace(fit: svm.SvmFit) -> DataFrame:
    rows = fit.trace
    return rows.select(
        "method", "iter", F.round("grad_norm", 5).alias("grad_norm"), F.round("loss", 6).alias("loss"),
        F.round("objective", 5).alias("objective"), "rel", F.round("acc", 9).alias("acc"),
    )


def _multiclass(v: Views) -> DataFrame:
    """Held-out predictions of the balanced one-vs-rest model."""
    weights = svm.svm_multiclass_balanced(v.dense_features(False), v.dense_labels(False).select("row_id", "cls"))
    rows = v.dense_labels(True)
    return rows.join(svm.multiclass_predict(v.dense_features(True), rows, weights), "row_id").select(
        "row_id", "cls", "prediction"
    )


# ---------------------------------------------------------------- softmax


def star_labels(v: Views, split: str) -> DataFrame:
    rows = v.reviews().filter(F.col("split") == split)
    return rows.select(F.col("doc_id").alias("row_id"), F.col("stars").alias("cls"))


def star_features(v: Views, scheme: str = "DF") -> DataFrame:
    return saved(v, f"star-features-{scheme}", lambda: words.doc_term(v, scheme))


def eval_labels(v: Views) -> DataFrame:
    def build() -> DataFrame:
        rows = v.reviews().filter("split = 'train'").select("doc_id", "stars")
        chosen = layout.holdout_sample(rows, "doc_id", 0.3, EVAL_SEED).filter("in_eval")
        return chosen.select(F.col("doc_id").alias("row_id"), F.col("stars").alias("cls"))

    return saved(v, "star-eval", build)


def star_weights(v: Views, scheme: str = "DF") -> DataFrame:
    def build() -> DataFrame:
        train, held = star_labels(v, "train"), eval_labels(v)
        rows = star_features(v, scheme).join(train.select("row_id"), "row_id", "left_semi")
        return softmax.softmax_train(
            rows, train, rows.join(held.select("row_id"), "row_id", "left_semi"), held, batch_size=SOFTMAX_BATCH
        ).weights

    return saved(v, f"star-weights-{scheme}", build)


def star_guess(v: Views, split: str = "dev") -> DataFrame:
    rows = star_labels(v, split)
    return softmax.softmax_predict(star_features(v), rows, star_weights(v))


def _entropy(v: Views) -> DataFrame:
    chances = softmax.class_probabilities(star_features(v), star_labels(v, "dev"), star_weights(v))
    return rounded(metrics.cross_entropy(chances.withColumn("p", softmax.true_probability(5)), "p"), 9)


QUERIES: dict[str, Query] = {
    "svm_margins": Query(lambda v: rounded(scored(v)), sql.MARGINS),
    "active_set": Query(lambda v: svm.active_set(scored(v)).select("row_id"), sql.ACTIVE),
    "svm_gradient": Query(lambda v: rounded(gradient(v).select("idx", "grad"), 6), sql.GRADIENT),
    "svm_objective": Query(_objective, sql.OBJECTIVE),
    "squared_hinge_loss": Query(
        lambda v: rounded(svm.squared_hinge_loss(scored(v), v.dense_labels().count()), 9), sql.HINGE
    ),
    "sign_accuracy": Query(lambda v: rounded(svm.sign_accuracy(scored(v))), sql.SIGN_ACCURACY),
    "minibatches": Query(
        lambda v: layout.minibatches(v.dense_labels().select("row_id"), "row_id", 150, 0), sql.batches(150)
    ),
    "conjugate_gradient": Query(_cg, sql.CG),
    "conjugate_gradient_settled": Query(_cg_settled, sql.settled_cg(CG_SETTLED["tol"], CG_SETTLED["max_iter"])),
    "svm_pegasos": Query(lambda v: rounded(pegasos(v).weights, 6), sql.pegasos(**PEGASOS)),
    "svm_sgd": Query(lambda v: rounded(sgd(v).weights, 6), sql.sgd(**SGD)),
    "svm_newton": Query(lambda v: rounded(newton(v).weights, 6), sql.newton(NEWTON["epochs"], NEWTON["cg_iterations"])),
    "svm_trace_pegasos": Query(lambda v: _trace(pegasos(v)), sql.pegasos_trace(**PEGASOS)),
    "svm_trace_sgd": Query(lambda v: _trace(sgd(v)), sql.sgd_trace(**SGD)),
    "svm_trace": Query(lambda v: _trace(newton(v)), sql.newton_trace(NEWTON["epochs"], NEWTON["cg_iterations"])),
    "svm_newton_settled": Query(lambda v: _trace(svm.svm_newton(*_train(v), LAM, **NEWTON_SETTLED, **_test(v)))),
    "svm_multiclass_balanced": Query(_multiclass),
    "softmax_train": Query(lambda v: rounded(star_weights(v)), sql.softmax("weights")),
    "softmax_train_ctf": Query(lambda v: rounded(star_weights(v, "CTF")), sql.softmax("weights", "CTF")),
    "softmax_train_bal": Query(lambda v: rounded(star_weights(v, "BAL")), sql.softmax("weights", "BAL")),
    "best_epoch": Query(
        lambda v: rounded(metrics.best_epoch(newton(v).trace), 6), sql.best_epoch(NEWTON["epochs"], NEWTON["cg_iterations"])
    ),
    "softmax_predict": Query(lambda v: rounded(star_guess(v).select("row_id", "hard", "soft"), 6), sql.softmax("predict")),
    "softmax_loglik": Query(
        lambda v: rounded(softmax.softmax_loglik(star_features(v), eval_labels(v), star_weights(v)), 6),
        sql.softmax("loglik"),
    ),
    "argmax_class": Query(lambda v: star_guess(v, "test").select("row_id", "hard"), sql.softmax("argmax")),
    "accuracy": Query(lambda v: rounded(metrics.accuracy(star_guess(v), "cls", "hard")), sql.softmax("accuracy")),
    "rmse_stars": Query(lambda v: rounded(metrics.rmse(star_guess(v), "cls", "soft"), 6), sql.softmax("rmse")),
    "cross_entropy": Query(_entropy, sql.softmax("entropy")),
}
