"""Work that hangs on order, on ranges that hand on no more than their edge: completeness of row ranges,
merging the runs of several workers, digests of large sets, and states of keys over their events."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialise, shuffle_partitions


def following(parts: DataFrame, first: str, rows: str, by: list[str] = ()) -> DataFrame:
    """parts with `expected`, where the part before it (of equal `by`) ends; null for the first.

    Parts are dealt by range and sorted; within a range the part before is at hand, and a range hands
    on one row, its last part, which the first of the next range meets. Only these edges, one row a
    range, are put in one order.
    """
    spark, by = parts.sparkSession, list(by)
    names, keys = parts.columns, [*by, first, rows]
    dealt = parts.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)

    def run(batches):
        from pyspark import TaskContext

        range_, last, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in keys]
            expected, group = [], [tuple(c[i] for c in columns[: len(by)]) for i in range(batch.num_rows)]
            for i in range(batch.num_rows):
                same = last is not None and last[0] == group[i]
                expected.append(last[1] if same else None)
                last = group[i], columns[-2][i] + columns[-1][i]
            head = pa.array([place == 0 and i == 0 for i in range(batch.num_rows)])
            places = pa.array(range(place, place + batch.num_rows), pa.int64())
            place += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(expected, pa.int64()), head, pa.array([range_] * batch.num_rows, pa.int32()), places], names=[*names, "expected", "__head", "__range", "__place"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) + ", expected long, __head boolean, __range int, __place long"
    met = materialise(dealt.mapInArrow(run, schema), "ranges")
    ends = met.groupBy("__range").agg(F.max_by(F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], (F.col(first) + F.col(rows)).cast("long").alias("end")), "__place").alias("last"))
    before = F.lag("last").over(Window.orderBy("__range"))  # one row a range that has parts
    edges = ends.select("__range", before.alias("before"))
    heads = met.where("__head").join(edges, "__range")
    same = F.lit(True)
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"before.g{i}"))
    heads = heads.withColumn("expected", F.when(F.col("before").isNotNull() & same, F.col("before.end")))
    return met.where("NOT __head").select(*names, "expected").unionByName(heads.select(*names, "expected"))


def range_faults(parts: DataFrame, first: str, rows: str, start: int, stop: int) -> DataFrame:
    """(fault, at, expected) of parts that should cover start to stop in turn: gap and overlap with the
    part before, the first that begins late, the last that ends early or beyond."""
    met = following(parts.select(first, rows), first, rows)
    at = F.coalesce("expected", F.lit(start).cast("long"))
    inner = met.select(F.when(F.col(first) > at, "gap").when(F.col(first) < at, "overlap").alias("fault"), F.col(first).cast("long").alias("at"), at.alias("expected")).where("fault IS NOT NULL")
    end = parts.agg(F.coalesce(F.max(F.col(first) + F.col(rows)), F.lit(start)).cast("long").alias("at"))
    outer = end.select(F.when(F.col("at") < stop, "short").when(F.col("at") > stop, "beyond").alias("fault"), "at", F.lit(stop).cast("long").alias("expected")).where("fault IS NOT NULL")
    return inner.unionByName(outer)


def merged_runs(records: DataFrame, parts: DataFrame, key: str, run: str, first: str, rows: str, body: str, sha: str) -> tuple[DataFrame, DataFrame]:
    """(faults, merged) of the runs of several workers.

    faults: (fault, run, subject), where a part leaves a gap or overlaps with the part before it over all
    runs, a record's body has another digest than it says or none (damaged), or a key has a sound record
    in more than one run (duplicate; one row for each run but the first). merged: one sound record a key, of
    the first run that has one; records of equal key and run go by digest.
    """
    ranges = following(parts.select(run, first, rows).withColumn("__r", F.col(run)), first, rows)
    broken = ranges.where(F.col("expected").isNotNull() & (F.col("expected") != F.col(first)))
    faults = broken.select(F.when(F.col(first) > F.col("expected"), "gap").otherwise("overlap").alias("fault"), F.col(run).cast("string").alias("run"), F.col(first).cast("string").alias("subject"))
    sound = F.coalesce(F.sha2(F.col(body), 256) == F.col(sha), F.lit(False))
    judged = materialise(records.withColumn("__sound", sound), "runs")
    damaged = judged.where("NOT __sound").select(F.lit("damaged").alias("fault"), F.col(run).cast("string").alias("run"), F.col(key).cast("string").alias("subject"))
    good = judged.where("__sound").drop("__sound")
    each = good.select(key, run).distinct()
    firsts = each.groupBy(key).agg(F.min(run).alias("__first"))
    again = each.join(firsts, key).where(F.col(run) != F.col("__first")).select(F.lit("duplicate").alias("fault"), F.col(run).cast("string").alias("run"), F.col(key).cast("string").alias("subject"))
    names = good.columns
    order = [run, sha, *[c for c in names if c not in (run, sha, key)]]
    best = good.groupBy(key).agg(F.min(F.struct(*order)).alias("r")).select(key, "r.*").select(*names)
    return faults.unionByName(damaged).unionByName(again), best


FANOUT = 16


def tree_digest(rows: DataFrame, key: str, columns: list[str], leaf: int = 1024, deepest: int | None = None) -> DataFrame:
    """(digest, rows, keys): one digest of a set of rows, however large, the same for the same rows.

    A row's digest is that of its key and columns, each with its length in bytes before it. Equal digests are counted first, so copies are one
    entry. Entries go to leaves by the first digits of their digest, as many digits as leave about `leaf`
    entries in each; a leaf's digest is that of its entries in order, and sixteen nodes make one of the
    level above. No buffer holds more than a leaf or sixteen digests. `deepest` fixes the most digits of a
    leaf, for digests that must equal those of a tree of that height: its leaves then grow with the rows, as
    one in 16 ** deepest of them. A null key is a key like any other.
    """
    value = lambda c: F.concat_ws(":", F.octet_length(F.col(c).cast("string")), F.col(c).cast("string"))
    part = lambda c: F.when(F.col(c).isNull(), "-").otherwise(value(c))
    text = F.concat_ws(",", *[part(c) for c in (key, *columns)])
    entries = materialise(rows.select(F.sha2(text, 256).alias("h")).groupBy("h").agg(F.count("*").alias("n")), "entries")
    total, distinct = entries.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    depth = 0
    while distinct > leaf * FANOUT**depth and depth != deepest:
        depth += 1
    line = F.concat_ws(":", "h", "n")
    nodes = entries.groupBy(F.substring("h", 1, depth).alias("node")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("d"))
    for level in range(depth - 1, -1, -1):
        child = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "node", "d"))), "\n")
        nodes = nodes.groupBy(F.substring("node", 1, level).alias("node2")).agg(F.sha2(child, 256).alias("d")).withColumnRenamed("node2", "node")
    keys = rows.select(key).distinct().agg(F.count("*").alias("keys"))
    root = nodes.agg(F.coalesce(F.max("d"), F.sha2(F.lit(""), 256)).alias("digest"))
    return root.crossJoin(keys).select("digest", F.lit(total).cast("long").alias("rows"), "keys")  # two single rows


def lifecycle(events: DataFrame, key: str, order: list[str], event: str, moves: dict[tuple[str, str], str], start: str) -> DataFrame:
    """events with state_before, accepted and state: each key goes through its events in order; an event
    that its state has no move for is rejected and leaves the state.

    Rows meet by key, come sorted and pass as a stream with one state in hand, so a key of any length
    takes no memory. A null key is a key of its own.
    """
    names = events.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema) + ", state_before string, accepted boolean, state string"

    def run(batches):
        current, state, begun = None, start, False
        for batch in batches:
            before, accepted, after = [], [], []
            for k, e in zip(batch.column(key).to_pylist(), batch.column(event).to_pylist(), strict=True):
                if not begun or k != current:
                    current, state, begun = k, start, True
                before.append(state)
                to = moves.get((state, e))
                accepted.append(to is not None)
                state = state if to is None else to
                after.append(state)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.string()), pa.array(accepted, pa.bool_()), pa.array(after, pa.string())], names=[*names, "state_before", "accepted", "state"])

    return events.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)
