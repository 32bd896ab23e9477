"""Agreement statistics from aggregated counts and moments, with their degenerate cases."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def confusion(pred: Column, truth: Column) -> dict[str, Column]:
    """Aggregates tp, fp, tn, fn."""
    return {
        "tp": count_where(pred & truth), "fp": count_where(pred & ~truth),
        "tn": count_where(~pred & ~truth), "fn": count_where(~pred & truth),
    }


def prf(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall, F1 and accuracy from the four counts; 0 for an empty denominator."""
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {"precision": p, "recall": r, "f1": ratio(p * r * 2.0, p + r), "accuracy": ratio(tp + tn, tp + fp + tn + fn)}


def cohens_kappa(tp: Column, fp: Column, tn: Column, fn: Column) -> Column:
    """Cohen's kappa of two yes/no raters from the four counts of their agreement.
    0 without rows; when chance agreement is certain, 1 for full agreement and else 0."""
    n = tp + fp + tn + fn
    observed = ratio(tp + tn, n)
    yes_a, yes_b = ratio(tp + fp, n), ratio(tp + fn, n)
    chance = yes_a * yes_b + (1 - yes_a) * (1 - yes_b)
    certain = F.when(observed == 1.0, 1.0).otherwise(0.0)
    return F.when(n == 0, 0.0).when(chance == 1.0, certain).otherwise(F.try_divide(observed - chance, 1 - chance))


def kappa_label(kappa: Column) -> Column:
    # The bands of kappa and their names.
    return (
        F.when(kappa < 0, "below chance").when(kappa < 0.20, "poor").when(kappa < 0.40, "fair")
        .when(kappa < 0.60, "moderate").when(kappa < 0.80, "substantial").otherwise("near-perfect")
    )


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: correlation of two columns; 0 without rows or when one of them is constant."""
    constant = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    spread = F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y))
    r = F.try_divide(F.covar_pop(x, y), spread)
    return F.when(constant, 0.0).otherwise(F.coalesce(r, F.lit(0.0)))
