"""Evaluation measures as aggregate expressions over one pass."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(top, bottom):
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def r2(y, predicted) -> Column:
    """1 - residual sum / total sum; constant y scores 1 if exact, else 0."""
    residual = F.sum(F.pow(y - predicted, F.lit(2.0)))
    total = F.var_pop(y) * F.count(y)
    constant = F.when(residual == 0, 1.0).otherwise(0.0)
    return F.when(F.max(y) == F.min(y), constant).otherwise(1.0 - F.try_divide(residual, total))


def rmse(y, predicted) -> Column:
    """Root of the mean squared error."""
    return F.sqrt(F.avg(F.pow(y - predicted, F.lit(2.0))))


def confusion(label, flagged):
    """tp, fp, fn, tn counts; ``flagged`` is the thresholded prediction."""
    positive = label == 1
    return {
        "tp": F.count_if(positive & flagged),
        "fp": F.count_if(~positive & flagged),
        "fn": F.count_if(positive & ~flagged),
        "tn": F.count_if(~positive & ~flagged),
    }


def accuracy(label, flagged) -> Column:
    c = confusion(label, flagged)
    return _ratio(c["tp"] + c["tn"], F.count(F.lit(1)))


def precision(label, flagged) -> Column:
    c = confusion(label, flagged)
    return _ratio(c["tp"], c["tp"] + c["fp"])


def recall(label, flagged) -> Column:
    c = confusion(label, flagged)
    return _ratio(c["tp"], c["tp"] + c["fn"])
