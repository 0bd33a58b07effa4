"""importing the library must not need a running SparkContext."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
MODULES = [
    "strata.rules", "strata.session", "strata.functions.columns", "strata.functions.fingerprint",
    "strata.operators.cleanse", "strata.operators.dedupe", "strata.operators.scd", "strata.operators.items",
    "strata.operators.marts", "strata.operators.rank", "strata.operators.evolution", "strata.operators.control",
    "strata.operators.reports", "strata.operators.enrich", "strata.sources.extract", "strata.sources.contracts",
    "strata.sources.publish", "strata.plans.business", "strata.plans.oracle", "strata.plans.queries",
    "strata.plans.jobs", "strata.streaming.incremental", "__spark_entry__",
]


def test_modules_import_without_spark():
    code = (
        "import importlib, sys\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        f"for m in {MODULES!r}: importlib.import_module(m)\n"
        "from pyspark import SparkContext\n"
        "assert SparkContext._active_spark_context is None\n"
        "print('ok')\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0 and out.stdout.strip() == "ok", out.stderr[-2000:]
