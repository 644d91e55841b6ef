"""Benchmark: the headline stages of the all-wikis recommendation run, the sinks, and a
one-wiki-at-a-time loop. ``value`` is the seconds of the run without the sinks, as in earlier rounds.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: seconds}, "sf", ...}.
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from picsel.operators import manifest as Mf  # noqa: E402
from picsel.operators import metric_state as Ms  # noqa: E402
from picsel.operators import metrics as E  # noqa: E402
from picsel.operators import publish as D  # noqa: E402
from picsel.operators import serving as V  # noqa: E402
from picsel.plans.recommend import RecommendationRun, materialize  # noqa: E402
from picsel.session import build_session, stage_root  # noqa: E402
from picsel.sources.standins import FULL_DATE, MONTH, STANDIN_WIKIS  # noqa: E402

DATASET_ID = "bench"
INSERTION_TS = 1611532800.0
POOL_STEPS: dict[str, float] = {}
SINKS = ("write_candidates", "publish_production", "publish_search", "write_exports", "write_serving")


def _sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def run_all(spark, sf_dir: str, wikis=None):
    """Pool (staged, checkpointed) -> selection -> production rows -> two metrics."""
    run = RecommendationRun.standin(spark, sf_dir, wikis=wikis)
    out = {}
    # claims: with the placeholders and unillustrated pages that they wait for, as concurrent jobs
    steps = {"claims": lambda: run.claims, "pool": lambda: run.pool, "numbering": lambda: run.numbered_category_images, "rows": lambda: _sink(run.pool_rows())}
    POOL_STEPS.update({k: round(_timed(fn), 3) for k, fn in steps.items()})
    out["candidate_pool"] = sum(POOL_STEPS.values())
    out["selection"] = _timed(lambda: _sink(run.candidates))
    holder = {}
    # the production table is written once and then read by the metrics, as in the pipeline
    out["production_rows"] = _timed(
        lambda: holder.setdefault("prod", materialize(run.production_table(DATASET_ID, INSERTION_TS))))
    prod = holder["prod"]
    out["suggestion_histogram"] = _timed(lambda: _sink(E.suggestion_histogram(prod, MONTH)))
    out["column_frequencies"] = _timed(lambda: _sink(E.column_frequencies(prod)))
    return out, run, prod


def run_writers(spark, run, prod) -> dict[str, float]:
    """The sinks over the finished production table."""
    root = f"{stage_root(spark)}/bench-{uuid.uuid4().hex}"
    keys = prod.where("try_cast(page_id AS BIGINT) % 50 = 0").select("wiki", "page_id").distinct()
    return {
        "write_candidates": _timed(lambda: D.write_candidates(run.raw, f"{root}/candidates")),
        "publish_production": _timed(lambda: D.publish_production(prod, f"{root}/production")),
        "publish_search": _timed(lambda: D.publish_search(D.search_table(prod, FULL_DATE, MONTH), f"{root}/search")),
        "write_exports": _timed(lambda: D.write_exports(D.export_rows(prod, MONTH), f"{root}/exports")),
        "write_serving": _timed(lambda: V.write_serving(D.serving_table(D.export_rows(prod, MONTH)), f"{root}/serving")),
        "serving_lookup": _timed(lambda: _sink(V.lookup(V.read_serving(spark, f"{root}/serving"), keys))),
        "publish_manifest": _timed(lambda: Mf.publish(prod, f"{root}/committed", ["wiki", "snapshot"], ["page_id"])),
        "metric_state": _timed(lambda: Ms.update(prod, f"{root}/state", MONTH)),
        "top_values": _timed(lambda: _sink(E.top_values(prod))),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    _, run, prod = run_all(spark, "/root/testdata/sf0.001")  # warm-up: JVM, code paths, parquet footers
    run_writers(spark, run, prod)
    t0 = time.perf_counter()
    queries, run, prod = run_all(spark, sf_dir)
    total, steps = time.perf_counter() - t0, dict(POOL_STEPS)
    writers = run_writers(spark, run, prod)
    t1 = time.perf_counter()
    for w in STANDIN_WIKIS:
        run_all(spark, sf_dir, wikis=(w,))
    loop_total = time.perf_counter() - t1
    queries = {k: round(v, 3) for k, v in (queries | writers).items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "all_wikis_run_seconds", "value": round(total, 3), "unit": "sec", "queries": queries,
        "sf": sf, "per_wiki_loop_seconds": round(loop_total, 3), "write_seconds": round(sum(writers[k] for k in SINKS), 3),
        "candidate_pool_steps": steps,
        "speedup_vs_per_wiki_loop": round(loop_total / total, 2) if total > 0 else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
