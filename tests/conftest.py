import os
import sys
import tempfile

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
_ROOT = os.path.dirname(_HERE)
sys.path.insert(0, _ROOT)
# Python workers import test-local helpers (toy models) by module name.
os.environ["PYTHONPATH"] = os.pathsep.join([_ROOT, _HERE] + [p for p in [os.environ.get("PYTHONPATH")] if p])

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tonalert.session import local_session

    # Intermediate tables of tests go to a folder of their own.
    s = local_session(cores="*", shuffle_partitions=8, app="tonalert-tests", shared=tempfile.mkdtemp(prefix="tonalert-test-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tonalert-test-")


def one_col(spark, values, name="c", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
