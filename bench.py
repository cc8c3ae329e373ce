"""Headline queries: median wall-clock of full materialisation (noop sink); prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the number of local cores, BENCH_RUNS the measured runs.
Change logs are written as JSON lines beforehand, the way a capture process would leave them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.functions import decode as D  # noqa: E402
from tidemark.operators import merge, progress, reconcile, unkeyed  # noqa: E402
from tidemark.plans.replicate import TableSpec  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.changelog import changelog_text, decode_images, parse_changes  # noqa: E402
from tidemark.streaming.apply import run_stream  # noqa: E402
from workload import fixtures as X  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def write_log(spark, envelopes, path, files):
    """JSON lines with the position inside the envelope (source.pos)."""
    marked = """regexp_replace(value, '"source":\\\\{', concat('"source":{"pos":', cast(seq as string), ',')) AS value"""
    text = envelopes.selectExpr("seq", marked)
    text.repartitionByRange(files, "seq").sortWithinPartitions("seq").select("value").write.text(path)


def main():
    spark = build_session("bench", master=f"local[{CPUS}]", shuffle_partitions=int(CPUS), conf={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.sql.files.openCostInBytes": "0"})
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="run-bench-")
    logs = {}
    for name, make in (("full", X.event_envelopes), ("partial", X.partial_envelopes), ("orders", X.order_envelopes),
                       ("lines", X.line_envelopes)):
        logs[name] = f"{work}/{name}"
        write_log(spark, make(spark, SF_DIR), logs[name], int(CPUS))
    write_log(spark, X.event_envelopes(spark, SF_DIR), f"{work}/stream", 10)
    # Twenty times as long: each event repeated with positions of its own.
    logs["long"] = f"{work}/long"
    write_log(spark, X.event_envelopes(spark, SF_DIR).selectExpr("seq", "value", "explode(sequence(0, 19)) AS copy").selectExpr(
        "seq * 20 + copy AS seq", "value"), logs["long"], 4 * int(CPUS))
    logs["bag"] = f"{work}/bag"
    write_log(spark, X.chained_bag_envelopes(spark, SF_DIR), logs["bag"], int(CPUS))
    X.orders_target(spark, SF_DIR).select(*X.ORDER_SCHEMA.names).write.parquet(f"{work}/target")
    events = ["id", "event_type", "value"]

    def log(name, **options):
        return parse_changes(changelog_text(spark, logs[name]), order_field="pos", **options)[0]

    def replay_full():
        last = merge.latest_per_key(decode_images(log("full"), X.EVENT_SCHEMA, keys=["id"]), ["id"], events, scope=["table"])
        return last.where("NOT deleted")

    def replay_partial():
        return merge.apply_partial(X.customers_as_rows(spark, SF_DIR), decode_images(
            log("partial").where("table = 'users'"), X.EVENT_SCHEMA, keys=["id"]), ["id"])

    def replay_on_base():
        typed = decode_images(log("orders"), X.ORDER_SCHEMA, keys=["o_orderkey"])
        return merge.apply_changes(spark.read.parquet(f"{work}/target"), typed, ["o_orderkey"], partial=False)

    def replay_composite():
        typed = decode_images(log("lines"), X.LINE_SCHEMA, keys=X.LINE_KEYS)
        return merge.apply_changes(None, typed, X.LINE_KEYS, partial=False)

    def decode_decimal():
        from pyspark.sql import functions as F
        wire = X.load(spark, SF_DIR, "orders").selectExpr("o_orderkey", f"{X.WIRE_CENTS} AS wire")
        return wire.select("o_orderkey", D.decode_decimal(F.col("wire"), 2, 18, 2).alias("price"))

    def noop_deletes():
        typed = decode_images(log("full").where("table = 'users'"), X.EVENT_SCHEMA, keys=["id"])
        return merge.noop_events(X.suppliers_as_rows(spark, SF_DIR), typed, ["id"])

    def orphan_rows():
        return reconcile.orphan_rows(X.orders_target(spark, SF_DIR), X.load(spark, SF_DIR, "orders"), ["o_orderkey"])

    def orphan_rows_composite():
        return reconcile.orphan_rows(X.lineitem_target(spark, SF_DIR), X.load(spark, SF_DIR, "lineitem"), X.LINE_KEYS)

    def reconcile_counts():
        names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
        source = {n: X.load(spark, SF_DIR, n) for n in names}
        target = {**source, "orders": X.orders_target(spark, SF_DIR), "lineitem": X.lineitem_target(spark, SF_DIR)}
        return reconcile.reconcile_counts(source, target)

    def progress_report():
        return progress.progress(log("full", images=False))

    def progress_long():
        return progress.progress(log("long", images=False))

    def replay_long():
        last = merge.latest_per_key(decode_images(log("long"), X.EVENT_SCHEMA, keys=["id"]), ["id"], events, scope=["table"])
        return last.where("NOT deleted")

    def unkeyed_chain():
        return unkeyed.apply_unkeyed(None, decode_images(log("bag"), X.STATE_SCHEMA))

    plans = [replay_full, replay_partial, replay_on_base, replay_composite, decode_decimal, noop_deletes, orphan_rows,
             orphan_rows_composite, reconcile_counts, progress_report, progress_long, replay_long, unkeyed_chain]
    seconds, shapes = {}, {}
    for plan in plans:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            df = plan()
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        text = df._jdf.queryExecution().executedPlan().toString()
        shapes[plan.__name__] = {"shuffles": text.count("Exchange hashpartitioning"), "joins": text.count("Join ")}
        seconds[plan.__name__] = round(statistics.median(times[1:]), 3)

    start = time.perf_counter()
    raw = changelog_text(spark, f"{work}/stream", streaming=True, max_files_per_trigger=5)
    specs = {t: TableSpec(X.EVENT_SCHEMA, ("id",), partial=False) for t in X.TABLES}
    run_stream(spark, raw, specs, f"{work}/store", f"{work}/checkpoint", order_field="pos").awaitTermination()
    seconds["stream_replay"] = round(time.perf_counter() - start, 3)

    print(json.dumps({"metric": "total_wall_clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(SF_DIR).name.removeprefix("sf"), "cpus": int(CPUS), "plans": shapes}))
    spark.stop()


if __name__ == "__main__":
    main()
