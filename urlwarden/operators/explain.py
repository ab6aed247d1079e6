"""From a score to risk level, reasons, sentence and prediction record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.vocab import FEATURE_NAMES

# Sentences and reasons, in reason order.
TEXTS = {
    "ru": {
        "phishing": ("URL классифицирован как ФИШИНГ (", "). Причины: ", "."),
        "safe": ("URL классифицирован как безопасный (", ")."),
        "reasons": (
            "использует IP-адрес вместо домена",
            "содержит подозрительные ключевые слова",
            "имеет аномально большую длину",
            "содержит много точек",
            "содержит символ @",
            "глубокая структура пути",
            "необычная длина TLD",
            "содержит чувствительные слова (пароль, оплата)",
        ),
        "fallback": "обнаружены скрытые паттерны фишинга",
    },
    "en": {
        "phishing": ("URL classified as PHISHING (", "). Reasons: ", "."),
        "safe": ("URL classified as safe (", ")."),
        "reasons": (
            "uses an IP address instead of a domain",
            "contains suspicious keywords",
            "is unusually long",
            "contains many dots",
            "contains the @ symbol",
            "deep path structure",
            "unusual TLD length",
            "contains sensitive words (password, payment)",
        ),
        "fallback": "hidden phishing patterns detected",
    },
}


def confidence(prediction: Column, p_phish: Column, p_legit: Column) -> Column:
    return F.when(prediction == 1, p_phish).otherwise(p_legit)


def risk_level(p_phish: Column) -> Column:
    return (
        F.when(p_phish > 0.9, "CRITICAL").when(p_phish > 0.75, "HIGH")
        .when(p_phish > 0.5, "MEDIUM").otherwise("LOW")
    )


def reasons(prediction: Column, language: str = "ru") -> Column:
    """Why an address was called phishing; empty for the others."""
    triggers = (
        F.col("has_ip_address") == 1,
        F.col("has_suspicious_keywords") == 1,
        F.col("url_length") > 75,
        F.col("qty_dot_url") > 3,
        F.col("has_at_symbol") == 1,
        F.col("qty_slash_url") > 5,
        (F.col("tld_length") > 4) & (F.col("tld_length") < 10),
        F.col("has_sensitive_words") == 1,
    )
    texts = TEXTS[language]
    found = F.array_compact(F.array(*(F.when(t, text) for t, text in zip(triggers, texts["reasons"]))))
    some = F.when(F.size(found) == 0, F.array(F.lit(texts["fallback"]))).otherwise(found)
    return F.when(prediction == 1, some).otherwise(F.array().cast("array<string>"))


def percent(share: Column) -> Column:
    """``12.3%``; no thousands separator can occur."""
    return F.concat(F.format_number(share * 100, 1), F.lit("%"))


def percent_up(share: Column) -> Column:
    """As ``percent``, but of two equally near tenths the larger, as browsers
    write numbers. Only odd quarters are equally near in binary."""
    value = share * 100
    quarters = value * 4
    tie = (quarters == F.floor(quarters)) & (quarters % 2 == 1)
    return F.when(tie, F.concat(F.format_number((F.floor(value * 10) + 1) / 10, 1), F.lit("%"))).otherwise(percent(share))


def explanation(prediction: Column, p_phish: Column, why: Column, language: str = "ru") -> Column:
    texts = TEXTS[language]
    opening, middle, closing = texts["phishing"]
    safe_opening, safe_closing = texts["safe"]
    return F.when(
        prediction == 1,
        F.concat(F.lit(opening), percent(p_phish), F.lit(middle), F.array_join(why, ", "), F.lit(closing)),
    ).otherwise(F.concat(F.lit(safe_opening), percent(1 - p_phish), F.lit(safe_closing)))


def prediction_record(scored: DataFrame, language: str = "ru", url_col: str = "url") -> DataFrame:
    """The nine-field record from a scored feature frame."""
    prediction, p = F.col("prediction"), F.col("probability_phishing")
    legit = F.col("probability_legitimate")
    staged = scored.withColumn("__why", reasons(prediction, language))
    return staged.select(
        F.col(url_col).alias("url"),
        prediction.cast("int").alias("prediction"),
        (prediction == 1).alias("is_phishing"),
        p.alias("probability_phishing"),
        legit.alias("probability_legitimate"),
        confidence(prediction, p, legit).alias("confidence"),
        risk_level(p).alias("risk_level"),
        explanation(prediction, p, F.col("__why"), language).alias("explanation"),
        F.struct(*FEATURE_NAMES).alias("features"),
    )


def display_text(result: Column, reason: Column, score: Column, error: Column) -> Column:
    """The line shown to a user for a verdict; the texts are fixed values."""
    return (
        F.when((result == "phishing") & (reason == "blacklist"), "Found in known blacklist")
        .when((result == "phishing") & (reason == "ml"), F.concat(F.lit("ML Confidence: "), percent_up(score)))
        .when(result == "phishing", "Suspicious activity detected")
        .when((result == "safe") & (reason == "whitelist"), "In your whitelist")
        .when((result == "safe") & (reason == "global_safe"), "Verified safe domain")
        .when((result == "safe") & (reason == "ml"), F.concat(F.lit("Safety Score: "), percent_up(1 - score)))
        .when(result == "safe", "No threats detected")
        .otherwise(F.coalesce(F.nullif(error, F.lit("")), F.lit("Analysis in progress...")))
    )
