"""Structured Streaming: the batch operators run on every micro-batch of the change stream."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.progress import event_counts, merge_progress, progress_of, progress_state
from tidemark.plans.replicate import TableSpec, apply_table, counted_events, table_rejects, typed_table
from tidemark.sources.bucket_store import BucketStore, merge_guarded
from tidemark.sources.changelog import parse_changes, parse_events, split_events
from tidemark.sources.snapshot import events_for_mode
from tidemark.sources.table_store import TableStore, merge_into_catalog


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the stream that owns a checkpoint; it survives restarts."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return json.loads(line.value)["id"].split("-")[0]


def run_stream(spark: SparkSession, raw: DataFrame, specs: Mapping[str, TableSpec], store_dir: str, checkpoint: str,
               order_col: str = "seq", available_now: bool = True, interval: str = "10 seconds",
               sources: Mapping[str, Callable[[], DataFrame]] | None = None, targets: Mapping[str, str] | None = None,
               mode: str = "initial", buckets: int = 64, horizon: int | None = None, guarded: bool = False,
               **parse_options) -> StreamingQuery:
    """Apply a change stream to the tables under `store_dir`, one folder per table.

    Keyed tables are kept in `buckets` folders each, and a batch rewrites those it changes (see `BucketStore`). The
    position of every event decides, not the batch it comes in: late, repeated and reordered events do no harm as long
    as deletes are remembered (`horizon` positions, or for good). Keyed tables named in `targets` (name -> catalog table
    that supports MERGE) are merged there instead; with `guarded` these hold positions too (`guarded_merge_statement`),
    otherwise their batches must come in order. Tables without a key need their batches in order and are written anew,
    but only if a batch has events for them. `mode` is a snapshot mode; it decides which events of the log are applied.

    A batch that is delivered again after a failure changes nothing where it was already applied. Rejected events go to
    `<store_dir>/_rejected/<batch>`, the progress so far to `<store_dir>/_progress` (see `stream_progress`). With
    `sources` (keyed tables by name), orphans are removed once per run, at the first batch that ends the snapshot or
    streams; how many went is in `<store_dir>/_removed/<batch>`. `available_now` drains what is there and stops.
    At most 16 tables are worked on at a time, each by jobs of its own over the parsed batch.
    """
    root = store_dir.rstrip("/")
    stores = {name: TableStore(spark, f"{root}/{name}") if not spec.keys else
              BucketStore(spark, f"{root}/{name}", spec.schema, spec.keys, spec.partial, buckets, horizon) for name, spec in specs.items()}
    run = {"cleaned": not sources, "id": None}

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        run["id"] = run["id"] or stream_id(spark, checkpoint)
        tag = f"{run['id']}-{batch_id}"
        time_col = "event_ms" if parse_options.get("time_field") else None
        events = parse_events(batch, order_col, **parse_options).persist()
        good, damaged = split_events(events, order_col, list(specs))
        rejects = [damaged.select(order_col, F.lit(None).cast("string").alias("table"),
                                  F.lit(None).cast("string").alias("op"), F.col("reject_reason").alias("reason"))]
        rejects += [table_rejects(typed_table(good, name, spec), spec, order_col)
                    .select(order_col, F.lit(name).alias("table"), "op", "reason") for name, spec in specs.items()]

        def one_table(name: str, spec: TableSpec, cleaning: bool, touched: bool) -> int | None:
            """Apply the batch to one table; the number of orphans removed, if they were looked for."""
            typed = events_for_mode(typed_table(good, name, spec), mode)
            if spec.keys and name in (targets or {}):
                if touched and guarded:
                    merge_guarded(typed, targets[name], spec.schema.names, spec.keys, spec.partial, order_col)
                elif touched:
                    merge_into_catalog(typed, targets[name], spec.keys, order_col, spec.partial)
                return None
            if spec.keys:
                if touched:
                    stores[name].apply(stores[name].changes(typed, order_col))
                return stores[name].remove_orphans(sources[name]()) if cleaning and name in sources else None
            if touched and not stores[name].has(tag):
                stores[name].write(apply_table(stores[name].read(), typed, spec, order_col), tag)
            return None

        def keep_progress() -> None:
            parts = [progress_state(counted_events(good, specs, order_col), order_col, time_col)]
            before = _progress_before(spark, f"{root}/_progress/{run['id']}", batch_id)
            parts += [spark.read.schema(parts[0].schema).parquet(before)] if before else []
            merge_progress(*parts).coalesce(1).write.mode("overwrite").parquet(f"{root}/_progress/{run['id']}/{batch_id:012d}")

        try:
            events.count()  # parse once, before several jobs read the result
            cleaning = not run["cleaned"] and good.where(F.col("stage").isin("last", "stream")).limit(1).count() > 0
            touched = {r.table for r in good.select("table").distinct().collect()}  # names in `specs`
            # Tables are independent, so their jobs share the cluster instead of queueing up.
            with ThreadPoolExecutor(min(len(specs) + 1, 16)) as pool:
                jobs = {name: pool.submit(inheritable_thread_target(spark)(one_table), name, spec, cleaning, name in touched)
                        for name, spec in specs.items()}
                others = [pool.submit(inheritable_thread_target(spark)(keep_progress)), pool.submit(inheritable_thread_target(spark)(
                    lambda: reduce(DataFrame.unionByName, rejects).write.mode("overwrite").parquet(f"{root}/_rejected/{tag}")))]
                removed = [(name, n) for name, job in jobs.items() if (n := job.result()) is not None]
                for job in others:
                    job.result()
            if removed:
                spark.createDataFrame(removed, "table string, removed bigint").coalesce(1).write.mode("overwrite").parquet(f"{root}/_removed/{tag}")
            run["cleaned"] = run["cleaned"] or cleaning
        finally:
            events.unpersist()

    writer = raw.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def _progress_before(spark: SparkSession, folder: str, batch_id: int) -> str | None:
    """The latest complete progress of a stream before a batch."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(root):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    earlier = sorted(name for name in names if int(name) < batch_id)
    return f"{folder}/{earlier[-1]}" if earlier else None


def stream_progress(spark: SparkSession, store_dir: str, checkpoint: str, registered: DataFrame | None = None,
                    totals: DataFrame | None = None) -> DataFrame:
    """What `progress` says of all events a stream has applied so far: counts, phase, changes, share of the snapshot.

    Every batch leaves the merged state under its own number, so a batch that comes again counts once.
    """
    folder = f"{store_dir.rstrip('/')}/_progress/{stream_id(spark, checkpoint)}"
    last = _progress_before(spark, folder, 1 << 62)
    if last is None:
        raise ValueError("no batch has been applied yet")
    return progress_of(spark.read.parquet(last), registered, totals)


def running_counts(raw: DataFrame, order_col: str = "seq", time_col: str | None = None,
                   specs: Mapping[str, TableSpec] | None = None, **parse_options) -> DataFrame:
    """Streaming counts per table; the state is one row per table. Write it in complete or update mode.

    With `specs` the events of these tables are counted by the rule of the batch plan (`counted_events`).
    """
    good, _ = parse_changes(raw, order_col, images=bool(specs), **parse_options)
    if specs:
        good = counted_events(good, specs, order_col)
    return event_counts(good, order_col, time_col)


def stop_gracefully(query: StreamingQuery, seconds: int = 30) -> bool:
    """Let the stream finish what it has, for at most `seconds`, then stop it. True if it had ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)
