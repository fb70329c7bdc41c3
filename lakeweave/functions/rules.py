"""Named silver rules per entity.

A rule is a boolean column; a row passes when every rule is TRUE (SQL
three-valued logic: NULL fails).  Rules read bronze columns plus
``created_at_ts`` (added by the silver operator before filtering).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def present(col: str) -> Rule:
    """required key is not NULL."""
    return Rule(f"{col}_present", F.col(col).isNotNull())


def positive(col: str, reject_nan: bool = False) -> Rule:
    """strictly positive amount.  NaN passes (NaN > 0 in Spark) unless
    ``reject_nan``."""
    pred = F.col(col) > 0
    if reject_nan:
        pred = pred & ~F.isnan(F.col(col))
    return Rule(f"{col}_positive", pred)


def non_negative(col: str) -> Rule:
    """value >= 0."""
    return Rule(f"{col}_non_negative", F.col(col) >= 0)


def equals(col: str, value: str) -> Rule:
    """exact, case-sensitive match."""
    return Rule(f"{col}_is_{value}", F.col(col) == F.lit(value))


def event_time_parsed(col: str = "created_at_ts") -> Rule:
    """event time parsed."""
    return Rule("event_time_parsed", F.col(col).isNotNull())


def exclude_values(col: str, values: tuple[str, ...]) -> Rule:
    """Optional business rule: drop rows whose ``col`` is in ``values``
    (NULL ``col`` is kept)."""
    return Rule(f"{col}_not_excluded", F.coalesce(~F.col(col).isin(*values), F.lit(True)))


def rules_for(entity: str, reject_nan: bool = False) -> list[Rule]:
    """the rule set of one entity, in declaration order."""
    if entity == "orders":
        return [present("order_id"), present("customer_id"),
                positive("total_amount", reject_nan), event_time_parsed()]
    if entity == "payments":
        return [present("payment_id"), present("order_id"),
                positive("amount", reject_nan), event_time_parsed(),
                equals("payment_status", "success")]
    if entity == "inventory":
        return [present("inventory_id"), present("product_id"),
                non_negative("quantity_on_hand"), event_time_parsed()]
    raise ValueError(f"no silver rules for entity {entity!r}")


def all_pass(rules: list[Rule]) -> Column:
    pred = F.lit(True)
    for r in rules:
        pred = pred & r.predicate
    return pred


def fails(rule: Rule) -> Column:
    """TRUE when the row is rejected by ``rule`` (FALSE or NULL)."""
    return ~F.coalesce(rule.predicate, F.lit(False))
