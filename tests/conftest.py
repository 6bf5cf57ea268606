import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
_SESSION = {}


@pytest.fixture(scope="session")
def spark():
    from voxtide.session import build_session
    # 1 GB, the default heap, is full when eight tasks write Parquet at once (the suite's peak was 1,005 of 1,024 MB)
    s = build_session("local[*]", app="voxtide-tests", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g", "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voxtide-test-ckpt-"))
    _SESSION["spark"] = s
    yield s
    _SESSION.clear()
    s.stop()


@pytest.hookimpl(hookwrapper=True)
def pytest_runtest_makereport(item, call):
    """A context that is gone fails every later test alike: end there, with the
    first test's error as the last word."""
    report = (yield).get_result()
    s = _SESSION.get("spark")
    if report.failed and s is not None and s.sparkContext._jsc.sc().isStopped():
        pytest.exit(f"the Spark context stopped in {item.nodeid}:\n{report.longreprtext[-4000:]}", returncode=1)
