import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session

    s = get_session("local[4]", 8, "ledgerline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def two_runs(spark, tmp_path_factory):
    """A warehouse after two runs of the job: its root, the folder of the snapshots, and both runs' load counts. Tests that
    change it work on a copy (a manifest names folders relative to its table)."""
    from ledgerline.plans import job
    from test_job import RUN1, RUN2, write_snapshots

    base = tmp_path_factory.mktemp("job")
    root = str(base / "warehouse")
    write_snapshots(spark, str(base / "src1"), RUN1)
    write_snapshots(spark, str(base / "src2"), RUN2)
    _, loads1 = job.run_pipeline(spark, root, str(base / "src1"), RUN1)
    _, loads2 = job.run_pipeline(spark, root, str(base / "src2"), RUN2)
    return root, base, loads1, loads2
