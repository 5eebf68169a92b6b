"""Ordered edits of a text by the most specific rule of its host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A tail is cut only where this many characters stay.
KEEP = 300


def suffixes(host: Column) -> Column:
    """The host and all its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def edited(text: Column, steps: Column) -> Column:
    """text after steps, an array of (kind, pattern, keep, with) in order.

    header: what the pattern matches at the beginning goes; tail: the text ends before the first match, if at
    least `keep` trimmed characters stay; replace: every match becomes `with`. Then the text is trimmed.
    """

    def one(t: Column, s: Column) -> Column:
        at = F.regexp_instr(t, s["pattern"])
        left = F.left(t, at - 1)
        return (
            F.when(s["kind"] == "header", F.regexp_replace(t, F.concat(F.lit("^(?:"), s["pattern"], F.lit(")")), F.lit("")))
            .when((s["kind"] == "tail") & (at > 0) & (F.length(F.trim(left)) >= s["keep"]), left)
            .when(s["kind"] == "replace", F.regexp_replace(t, s["pattern"], s["with"]))
            .otherwise(t)
        )

    return F.trim(F.aggregate(steps, text, one))


def apply_rules(rows: DataFrame, host: str, text: str, rules: DataFrame, name: str = "clean") -> DataFrame:
    """rows with `name`, the text after the edits of the longest rule host that is the host or a parent
    domain of it, and rule_host (null where none is; the text is then only trimmed).

    rules: host, step, kind, pattern, keep (null: KEEP), with (null: nothing). Hosts meet rules by equality on
    their suffixes: distinct hosts are exploded, not rows, and each keeps its longest match.
    """
    step = F.struct("step", "kind", "pattern", F.coalesce("keep", F.lit(KEEP)).alias("keep"), F.coalesce("with", F.lit("")).alias("with"))
    steps = rules.groupBy(F.lower("host").alias("rule_host")).agg(F.array_sort(F.collect_list(step)).alias("steps"))
    hosts = rows.select(F.col(host).alias("__host")).where("__host IS NOT NULL").distinct()
    met = hosts.select("__host", F.explode(suffixes(F.lower("__host"))).alias("rule_host")).join(steps.select("rule_host"), "rule_host")
    best = met.groupBy("__host").agg(F.max_by("rule_host", F.length("rule_host")).alias("rule_host")).join(steps, "rule_host")
    found = rows.join(best, F.col(host) == F.col("__host"), "left").drop("__host")
    none = F.array().cast(steps.schema["steps"].dataType)
    return found.withColumn(name, edited(F.col(text), F.coalesce("steps", none))).drop("steps")
