"""Silver layer (P5, P6, F1-F6, D1): typed, rule-checked, de-duplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, all_pass, fails, rules_for
from ..functions.timefmt import event_time
from ..schemas import ENTITY_KEY
from .dedup import dedup_first, dedup_stream

# Arrival order of a message: the batch stand-in for "first seen".
ARRIVAL_ORDER = ["kafka_timestamp", "partition", "offset"]


def with_event_time(bronze: DataFrame, text_col: str = "created_at",
                    out_col: str = "created_at_ts") -> DataFrame:
    """P5: parse the event time once, ahead of the rules that read it."""
    return bronze.withColumn(out_col, event_time(F.col(text_col)))


def to_silver(bronze: DataFrame, rules: list[Rule], stamp: bool = True) -> DataFrame:
    """P5 + F6 + P6: add ``created_at_ts``, keep rows passing every rule,
    stamp ``cleaned_at``.  The filter is placed before any watermark or
    de-duplication so rejected rows never reach state."""
    out = with_event_time(bronze).filter(all_pass(rules))
    if stamp:
        out = out.withColumn("cleaned_at", F.current_timestamp())
    return out


def reject_counts(bronze: DataFrame, rules: list[Rule]) -> DataFrame:
    """F6 report: ``(rule, rows)`` rejected by each rule (a row failing two
    rules counts in both), plus ``all_rules`` = rows the silver filter
    drops.  One pass, one partial aggregate, a handful of output rows."""
    typed = with_event_time(bronze)
    aggs = [F.count_if(fails(r)).alias(r.name) for r in rules]
    aggs.append(F.count_if(~F.coalesce(all_pass(rules), F.lit(False))).alias("all_rules"))
    names = [r.name for r in rules] + ["all_rules"]
    wide = typed.agg(*aggs)
    stack = "stack({n}, {pairs}) as (rule, rows)".format(
        n=len(names), pairs=", ".join(f"'{n}', `{n}`" for n in names))
    return wide.selectExpr(stack)


def observe_rejects(bronze_typed: DataFrame, rules: list[Rule], name: str) -> DataFrame:
    """Attach reject counts as observed metrics (works on streams: read them
    from ``query.lastProgress['observedMetrics']``).  Input must already
    carry ``created_at_ts``."""
    metrics = [F.count_if(fails(r)).alias(r.name) for r in rules]
    return bronze_typed.observe(name, F.count(F.lit(1)).alias("rows"), *metrics)


def silver_entity(bronze: DataFrame, entity: str, stamp: bool = True,
                  delay: str = "10 minutes", reject_nan: bool = False,
                  observe: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Whole silver job for one entity, batch or stream.

    Stream: rules -> watermark + ``dropDuplicatesWithinWatermark`` (D1).
    Batch: rules -> keep first arrival per key (same result as D1 when no
    duplicate outlives the delay).  With ``observe`` the per-rule reject
    counts of every (micro-)batch are published as observed metrics under
    that name.

    ``keep`` names the columns a downstream consumer needs: after the rules
    the rows are narrowed to key + arrival order + ``keep`` before the
    de-duplication, so the bronze scan reads only those and the rule
    columns.  The kept row does not change: arrival order (partition,
    offset) is unique per message within a topic, so the tie-break on the
    remaining columns never decides.
    """
    rules = rules_for(entity, reject_nan=reject_nan)
    key = ENTITY_KEY[entity]
    typed = with_event_time(bronze)
    if observe:
        typed = observe_rejects(typed, rules, observe)
    clean = typed.filter(all_pass(rules))
    if keep is not None:
        wanted = [key] + ARRIVAL_ORDER + ["created_at_ts"] + list(keep)
        clean = clean.select(*dict.fromkeys(wanted))
    if clean.isStreaming:
        out = dedup_stream(clean, key, delay=delay)
    else:
        out = dedup_first(clean, key, ARRIVAL_ORDER)
    if stamp:
        out = out.withColumn("cleaned_at", F.current_timestamp())
    return out
