"""Quality of scored tables, from counts over pairs of labels or single aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acreage.functions import scalar as X

EPSILON = 2.220446049250313e-16
LOG_FLOOR = 1e-15


def confusion(df: DataFrame, truth: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """Rows per pair of labels; everything about a classifier follows from these few rows."""
    return df.groupBy(*(by or []), F.col(truth).alias("y_true"), F.col(predicted).alias("y_pred")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: list) -> DataFrame:
    """Dense form: one row per true label, one column per predicted label."""
    wide = confusion(df, truth, predicted).groupBy("y_true").pivot("y_pred", labels).agg(F.sum("n"))
    return wide.na.fill(0).orderBy("y_true")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(F.try_divide(a, b))


def label_scores(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support for each label seen in truth or prediction."""
    by = by or []
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0))
    sides = F.explode(F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("hits")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("hits")),
    ))
    totals = (
        counts.select(*by, sides.alias("_s")).select(*by, "_s.*").groupBy(*by, "label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    scored = totals.withColumns({"precision": precision, "recall": recall})
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1)


def score_summary(labels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, macro and weighted F1 and Cohen kappa, one row per group."""
    n = F.sum("support")
    sums = labels.groupBy(*(by or [])).agg(
        n.alias("n"),
        (F.sum("hits") / n).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"),
        (F.sum(F.col("support").cast("double") * F.col("predicted")) / (n.cast("double") * n)).alias("_chance"),
    )
    kappa = F.try_divide(F.col("accuracy") - F.col("_chance"), F.lit(1.0) - F.col("_chance"))
    return sums.withColumn("cohen_kappa", kappa).drop("_chance")


def evaluate_classifier(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return score_summary(label_scores(confusion(df, truth, predicted)))


def class_report(df: DataFrame, truth: str, predicted: str, names_of: list[str] | None = None) -> DataFrame:
    """Per label, then the accuracy, macro and weighted rows; `names_of` names the codes from 0."""
    labels = label_scores(confusion(df, truth, predicted))
    names = ["precision", "recall", "f1"]
    shown = F.get(F.array(*[F.lit(n) for n in names_of]), F.col("label")) if names_of else F.col("label").cast("string")
    per_label = labels.select(shown.alias("label"), *names, "support")
    n = F.sum("support")
    accuracy = F.sum("hits") / n
    macro = labels.agg(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names], n.alias("support"))
    weighted = labels.agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(c) * F.col("support")) / n).alias(c) for c in names], n.alias("support"),
    )
    overall = labels.agg(
        F.lit("accuracy").alias("label"), *[accuracy.alias(c) for c in names], n.alias("support")
    )
    return per_label.unionByName(overall).unionByName(macro).unionByName(weighted)


def evaluate_by_group(
    df: DataFrame, truth: str, predicted: str, group: str, metric: str = "macro_f1", min_rows: int = 5
) -> DataFrame:
    """Score per group, best first; groups that are null or too small are left out."""
    known = df.filter(F.col(group).isNotNull())
    summary = score_summary(label_scores(confusion(known, truth, predicted, [group]), [group]), [group])
    score = "macro_f1" if metric == "macro_f1" else "accuracy"
    return (
        summary.filter(F.col("n") >= min_rows)
        .select(F.col(group).cast("string").alias("group"), "n", F.col(score).alias("score"))
        .orderBy(F.desc("score"), "group")
    )


def evaluate_regressor(df: DataFrame, truth: str, predicted: str, log_target: bool = True) -> DataFrame:
    """One pass: R2, RMSE, MAE, and on the original scale also RMSE, MAE and MAPE.

    R2 of a truth that does not vary is 1 for a perfect fit and 0 for any other."""
    y, p = F.col(truth), F.col(predicted)
    error = y - p
    loss, spread = F.sum(error * error), F.var_pop(y) * F.count(y)
    r2 = F.when(F.min(y) == F.max(y), F.when(loss == 0, 1.0).otherwise(0.0)).otherwise(F.lit(1.0) - F.try_divide(loss, spread))
    out = [
        r2.alias("r2"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
    ]
    if log_target:
        y0, p0 = F.expm1(y), F.expm1(p)
        e0 = y0 - p0
        relative = F.abs(e0) / X.clip(F.abs(y0), low=F.lit(EPSILON))
        out += [
            F.sqrt(F.avg(e0 * e0)).alias("rmse_usd"), F.avg(F.abs(e0)).alias("mae_usd"),
            F.avg(relative).alias("mape"),
        ]
    return df.agg(*out)


def log_space_r2(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """R2, null when the truth does not vary, and the number of rows."""
    y, error = F.col(truth), F.col(truth) - F.col(predicted)
    spread = F.var_pop(y) * F.count(y)
    return df.agg(
        F.when(spread > 0, F.lit(1.0) - F.sum(error * error) / spread).alias("r2_log_space"),
        F.count("*").alias("n_scored"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: total / (number of classes * rows of the class)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k"))
    total, classes = totals.select("total").scalar(), totals.select("k").scalar()
    return counts.withColumn("weight", total / (classes * F.col("n")))


def focal_loss(truth: str, probabilities: str, gamma: float = 2.0, alpha: list[float] | None = None) -> Column:
    """Aggregate expression: mean of alpha * (1 - p)^gamma * -ln(p) at the true class."""
    p = X.clip(F.element_at(F.col(probabilities), F.col(truth) + 1), low=F.lit(LOG_FLOOR))
    weight = F.lit(1.0)
    if alpha:
        weight = F.element_at(F.array(*[F.lit(float(a)) for a in alpha]), F.col(truth) + 1)
    return F.avg(weight * F.pow(F.lit(1.0) - p, F.lit(float(gamma))) * -F.ln(p))


def multitask_loss(
    df: DataFrame, truth: str, probabilities: str, log_truth: str, log_predicted: str,
    share: float = 0.6, gamma: float = 2.0, alpha: list[float] | None = None,
) -> DataFrame:
    """Focal, squared-error and combined loss of scored rows."""
    focal = focal_loss(truth, probabilities, gamma, alpha)
    error = F.col(log_truth) - F.col(log_predicted)
    squared = F.avg(error * error)
    return df.agg(
        focal.alias("focal_loss"), squared.alias("mse"),
        (F.lit(share) * focal + F.lit(1 - share) * squared).alias("total_loss"),
    )


def best_model(scores: DataFrame, metric: str, order: str = "position") -> DataFrame:
    """Model with the largest metric; the first one wins a tie."""
    key = F.struct(F.col(metric), -F.col(order))
    return scores.agg(F.max_by("model", key).alias("model"), F.max(metric).alias(metric))
