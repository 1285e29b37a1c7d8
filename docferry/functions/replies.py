"""Shape of a bulk reply and expressions over it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CAUSE = "type: string, reason: string"
REPLY = (
    "errors: boolean, error: variant, items: array<map<string, struct<_index: string, _id: string, status: int, "
    f"error: struct<{_CAUSE}, caused_by: struct<{_CAUSE}>>>>>"
)
REPLY_DDL = f"struct<{REPLY}>"

# Item statuses that count as accepted, by action.
ACCEPTED = {"create": [201], "index": [200, 201], "update": [200, 201]}


def parse_reply(reply: Column) -> Column:
    return F.from_json(reply, REPLY_DDL)


def error_cause(error: Column) -> Column:
    """Cause of a refused request: the type of an error object, an error text, or ``unknown``."""
    return F.coalesce(
        F.try_variant_get(error, "$.type", "string"),
        F.when(F.schema_of_variant(error) == "STRING", F.try_variant_get(error, "$", "string")),
        F.lit("unknown"),
    )


def is_accepted(action: Column, status: Column) -> Column:
    result = F.lit(False)
    for name, codes in ACCEPTED.items():
        result = result | ((action == name) & status.isin(codes))
    return F.coalesce(result, F.lit(False))


def accepted_count(items: Column) -> Column:
    """Accepted items of one reply, without exploding them."""
    def ok(item: Column) -> Column:
        return F.exists(F.map_entries(item), lambda e: is_accepted(e["key"], e["value"]["status"]))

    return F.coalesce(F.size(F.filter(items, ok)), F.lit(0)).cast("bigint")
