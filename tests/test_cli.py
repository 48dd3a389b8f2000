"""The command line builds gold from a silver folder and runs a named query."""

import os
import subprocess
import sys

from medalforge.plans import reports
from medalforge.session import scratch_path
from medalforge.sources import Layers
from medalforge.warehouse import silver_for
from tests.conftest import ROOT, SF001


def _cli(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "medalforge", *args], cwd=ROOT, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_cli_build_and_query(spark):
    root = scratch_path(spark, "cli-warehouse")
    layers = Layers(spark, root)
    for name, df in silver_for(spark, SF001).items():
        layers.write(df, "silver", name)
    assert "customer_360" in _cli("list")
    timings = _cli("build", "--root", root, "--local", "--verify")
    assert "fact_sales" in timings
    out = scratch_path(spark, "cli-out")
    _cli("query", "customer_360", "--root", root, "--as-of", "2002-01-01", "--out", out, "--local")
    plan = _cli("query", "monthly_trend", "--root", root, "--explain", "--show", "3", "--local")
    assert "Physical Plan" in plan and "order_month" in plan
    got = spark.read.parquet(out)
    want = reports.customer_360(layers.gold("fact_sales"), layers.gold("dim_customer_info"),
                                "2002-01-01")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
