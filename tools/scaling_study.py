"""Scaling study with our own operators: run headline queries of bench.py at
several core counts, then compute speedup and efficiency with W1 and put the
queries side by side with J5.

    python tools/scaling_study.py [--sf DIR] [--cpus 1,2,4,8]

Writes SCALING.md (markdown tables) next to this repository's README.
"""

from __future__ import annotations

import argparse
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

QUERIES = ["demographics", "batches", "hash_embed", "embed_text", "training_pairs",
           "letterbox_geometry", "prepare_images_numpy"]


def run(sf: str, cpus: int) -> dict:
    env = dict(os.environ, BENCH_SF_DIR=sf, BENCH_CPUS=str(cpus), BENCH_RUNS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), *QUERIES], env=env,
                         capture_output=True, text=True, timeout=3600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")][-1]
    return json.loads(line)["queries"]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--cpus", default="1,2,4,8")
    args = ap.parse_args()
    cache = os.path.join("/tmp", f"scaling-{os.path.basename(args.sf)}-{args.cpus}.json")
    if os.path.exists(cache):
        rows = [tuple(r) for r in json.load(open(cache))]
    else:
        rows = []
        for c in [int(x) for x in args.cpus.split(",")]:
            for q, secs in run(args.sf, c).items():
                rows.append((q, c, float(secs)))
            print(f"local[{c}] done", flush=True)
        json.dump(rows, open(cache, "w"))

    from latentforge.operators import joins as jn
    from latentforge.operators import windows as win
    from latentforge.session import build_session

    spark = build_session("local[2]", app="scaling-study", shuffle_partitions=4)
    spark.sparkContext.setLogLevel("ERROR")
    runs = spark.createDataFrame(rows, "method string, workers int, seconds double")
    table = win.scaling_table(runs).orderBy("method", "workers").collect()
    side = jn.compare_methods(win.scaling_table(runs), QUERIES, values=("speedup",)).orderBy("workers").collect()
    lines = [f"# Scaling study ({os.path.basename(args.sf)}, local[n], warm best of 2)", "",
             "| query | cores | seconds | speedup | efficiency % |", "| --- | --- | --- | --- | --- |"]
    lines += [f"| {r.method} | {r.workers} | {r.seconds:.3f} | {r.speedup:.2f} | {r.efficiency_pct:.1f} |"
              for r in table]
    lines += ["", "Speedup side by side (J5):", "", "| cores | " + " | ".join(QUERIES) + " |",
              "| --- |" + " --- |" * len(QUERIES)]
    lines += [f"| {r.workers} | " + " | ".join(f"{r[q + '_speedup']:.2f}" if r[q + "_speedup"] is not None
                                               else "" for q in QUERIES) + " |" for r in side]
    with open(os.path.join(ROOT, "SCALING.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
