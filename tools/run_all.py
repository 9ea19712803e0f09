"""Run every registered query once and print rows and seconds.

usage: python tools/run_all.py [sf_dir] [name ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.plans.catalog import registry  # noqa: E402
from feedlens.session import build_session  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
names = sys.argv[2:] or list(registry())
spark = build_session("local[8]", 8)
failed = []
for name in names:
    t0 = time.time()
    try:
        rows = registry()[name](spark, sf_dir).collect()
        print(f"{name:28s} rows={len(rows):6d} {time.time() - t0:6.2f}s", flush=True)
    except Exception as e:  # report and continue
        failed.append(name)
        print(f"{name:28s} FAILED {type(e).__name__}: {str(e).splitlines()[0][:300]}", flush=True)
print("failed:", failed)
