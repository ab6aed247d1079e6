"""The verdict cascade: user list, safe list, block list, then the model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.features import url_features
from urlwarden.functions.hosts import with_hostname
from urlwarden.functions.text import sealed
from urlwarden.functions.vocab import FEATURE_NAMES
from urlwarden.operators.listmatch import DomainLists, with_list_flags

VERDICT_COLUMNS = ("result", "reason", "score", "error")
NO_ANSWER = "the model gave no prediction"

# A scorer takes a frame with the feature columns and adds `prediction INT` and
# `probability_phishing DOUBLE`.
Scorer = Callable[[DataFrame], DataFrame]


def model_probability(prediction: Column, probability: Column) -> Column:
    return F.coalesce(probability, F.when(prediction == 1, 0.99).otherwise(0.01))


def model_result(prediction: Column, probability: Column) -> Column:
    return F.when((prediction == 1) | (probability > 0.5), "phishing").otherwise("safe")


def verdict_cascade(
    df: DataFrame,
    lists: DomainLists,
    scorer: Scorer | None = None,
    url_col: str = "url",
    profile: str = "browser",
    host_col: str | None = None,
) -> DataFrame:
    """Add ``result, reason, score, error``; all null for an invalid address.

    One pass over the rows. Addresses settled by a list reach the feature
    stage as null, which makes every feature of theirs a null at once. The
    verdict is sealed: a filter on it does not move below, where it would call
    the model again. ``error`` tells why no verdict was possible. ``host_col``
    keeps the host name under that name.
    """
    given = df.columns
    flagged = with_list_flags(with_hostname(df, url_col, "__host"), lists, "__host")
    valid = F.col("__host").isNotNull()
    listed = (
        F.when(F.col("in_whitelist"), "whitelist")
        .when(F.col("in_safe"), "global_safe")
        .when(F.col("in_blacklist"), "blacklist")
    )
    flagged = flagged.select(*given, "__host", valid.alias("__valid"), F.when(valid, listed).alias("__listed"))
    if scorer is None:
        scored = flagged.withColumns({
            "prediction": F.lit(None).cast("int"), "__p": F.lit(None).cast("double"),
            "__features": F.lit(True),
        })
        unscored_reason = "model_not_loaded"
    else:
        undecided = F.col("__valid") & F.col("__listed").isNull()
        staged = flagged.withColumn("__ml_url", F.when(undecided, F.col(url_col)))
        features = url_features(staged, "__ml_url", profile=profile)
        scored = scorer(features)
        scored = scored.withColumn("__features", F.col(FEATURE_NAMES[0]).isNotNull())
        scored = scored.withColumn("__p", model_probability(F.col("prediction"), F.col("probability_phishing")))
        unscored_reason = "feature_extraction_failed"
    listed, p = F.col("__listed"), F.col("__p")
    failed = F.lit(True) if scorer is None else ~F.col("__features")
    # The model was asked and gave neither a class nor a probability.
    unanswered = F.lit(False) if scorer is None else F.col("prediction").isNull() & F.col("probability_phishing").isNull()
    result = (
        F.when(~F.col("__valid"), None)
        .when(listed.isin("whitelist", "global_safe"), "safe")
        .when(listed == "blacklist", "phishing")
        .when(failed | unanswered, "error")
        .otherwise(model_result(F.col("prediction"), p))
    )
    reason = (
        F.when(~F.col("__valid"), None).when(listed.isNotNull(), listed)
        .when(failed, unscored_reason).when(unanswered, "prediction_failed").otherwise("ml")
    )
    score = (
        F.when(~F.col("__valid"), None)
        .when(listed.isin("whitelist", "global_safe"), 0.0)
        .when(listed == "blacklist", 1.0)
        .when(~failed & ~unanswered, p)
    )
    error = F.when(reason == "prediction_failed", NO_ANSWER)
    kept = [F.col(f"`{c}`") for c in given] + ([F.col("__host").alias(host_col)] if host_col else [])
    return sealed(scored, kept, {"result": result, "reason": reason, "score": score.cast("double"), "error": error})


def answer_requests(requests: DataFrame, lists: DomainLists, scorer: Scorer | None = None, url_col: str = "url") -> DataFrame:
    """One answer per request; no verdict becomes ``error / no_response``."""
    verdicts = verdict_cascade(requests, lists, scorer, url_col)
    missing = F.col("result").isNull()
    return verdicts.withColumns({
        "reason": F.when(missing, "no_response").otherwise(F.col("reason")),
        "result": F.when(missing, "error").otherwise(F.col("result")),
    })


def alerts(verdicts: DataFrame, url_col: str = "url") -> DataFrame:
    """One alert per phishing verdict, with host and message. A ``host`` that the
    verdicts have is taken; else the address is parsed."""
    hits = verdicts.where(F.col("result") == "phishing")
    hits = hits if "host" in hits.columns else with_hostname(hits, url_col, "host")
    return hits.withColumn("message", F.concat(F.col("host"), F.lit(" may be dangerous")))
