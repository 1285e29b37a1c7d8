"""Accounting of bulk replies: plain group-bys, so counts are summed before the shuffle.

The input has one row per request: ``status`` (HTTP) and ``reply`` (JSON text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docferry.functions.replies import accepted_count, error_cause, is_accepted, parse_reply

# Request statuses that are not an answer about single items.
REFUSED = (400, 429)


def reply_items(replies: DataFrame) -> DataFrame:
    """One row per item of each reply: action, index, id, status, and error type and reason."""
    item = F.col("item")
    error = item["error"]
    return (
        replies.select(parse_reply(F.col("reply")).alias("r"))
        .select("r.errors", F.explode("r.items").alias("entry"))
        .select("errors", F.explode("entry").alias("action", "item"))
        .select(
            "errors",
            "action",
            item["_index"].alias("index"),
            item["_id"].alias("id"),
            item["status"].alias("status"),
            F.coalesce(error["caused_by"]["type"], error["type"]).alias("type"),
            F.coalesce(error["caused_by"]["reason"], error["reason"]).alias("reason"),
            error.isNotNull().alias("failed"),
        )
    )


def success_counts(replies: DataFrame) -> DataFrame:
    """Items and accepted items per action."""
    return (
        reply_items(replies)
        .groupBy("action")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.count_if(is_accepted(F.col("action"), F.col("status"))).alias("n_accepted"),
        )
    )


def error_counts(replies: DataFrame) -> DataFrame:
    """Failed items per index, error type and reason, of replies that declare errors."""
    return (
        reply_items(replies)
        .where(F.col("errors") & F.col("failed"))
        .groupBy("index", "type", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def error_messages(replies: DataFrame) -> DataFrame:
    """The error counts as text, one message per row."""
    message = F.concat(
        F.lit("("), F.col("n").cast("string"), F.lit(") <"), F.coalesce("index", F.lit("")), F.lit("> "),
        F.coalesce("type", F.lit("unknown")), F.lit(" - "), F.coalesce("reason", F.lit("")),
    )
    return error_counts(replies).select(message.alias("message"))


def request_errors(replies: DataFrame) -> DataFrame:
    """Refused requests per status and cause."""
    cause = error_cause(parse_reply(F.col("reply"))["error"])
    return (
        replies.where(F.col("status").isin(*REFUSED))
        .groupBy("status", cause.alias("cause"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def run_summary(replies: DataFrame) -> DataFrame:
    """One row: requests, documents sent, documents accepted, and the summary text.

    Needs ``n_docs`` per request. A refused request counts no accepted document.
    """
    accepted = F.when(
        ~F.col("status").isin(*REFUSED), accepted_count(parse_reply(F.col("reply"))["items"])
    ).otherwise(F.lit(0))
    totals = replies.agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(accepted), F.lit(0)).alias("n_accepted"),
    )
    text = F.format_string("%s of %s docs accepted", F.format_number("n_accepted", 0), F.format_number("n_docs", 0))
    return totals.withColumn("summary", text)
