import importlib.util
import os

import pytest

from genomeloom import catalog
from genomeloom.session import scratch

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
# One query per area; tools/check_oracle.py runs them all.
SAMPLE = (
    "masked_as_declared", "mask_intervals", "take_prefix", "gene_model_summary", "gff_roundtrip", "functional_statistics", "coverage", "fingerprint_diff",
    "verify_bundle", "evaluate_bands", "route_projects", "delivery_verdicts", "run_ledger", "first_breach", "panels_extended", "protocol", "leak_scan",
    "functional_variants", "stream_run_machine", "stream_progress",
)


@pytest.fixture(scope="module")
def tool():
    spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "tools", "check_oracle.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def con(tool):
    db = tool.duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for name in tool.TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, tool, con, name):
    status, _, _, note = tool.compare(spark, con, catalog.load()[name], SF)
    assert status == "ok", note


def test_every_inventory_id_is_covered():
    covered = {i for e in catalog.load().values() for i in e.covers}
    wanted = (
        [f"SRC-{n:02d}" for n in range(1, 16)] + [f"SNK-{n:02d}" for n in range(1, 5)] + [f"PRJ-{n:02d}" for n in range(1, 20)]
        + [f"J-{n:02d}" for n in range(1, 28)] + [f"A-{n:02d}" for n in range(1, 31)] + [f"W-{n:02d}" for n in range(1, 11)]
        + [f"T-{n:02d}" for n in range(1, 5)] + [f"X-{n:02d}" for n in range(1, 5)] + [f"ST-{n:02d}" for n in range(1, 5)] + [f"C-{n:02d}" for n in range(1, 18)]
    )
    assert sorted(set(wanted) - covered) == []


class Session:
    """Just enough of a session to look up the shared folder."""

    def __init__(self, master, folder=None):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" and self.folder else default


def test_scratch_follows_the_cluster_setting():
    assert scratch(Session("yarn", "/shared/space"), "x").startswith("/shared/space/genomeloom/x-")
    assert scratch(Session("local[2]"), "x").startswith("/tmp/")
    with pytest.raises(RuntimeError):
        scratch(Session("yarn"), "x")


def test_entry_module_loads_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 100"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
