import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from adlake.session import get_spark
    ck = tempfile.mkdtemp(prefix="adlake-test-ckpt-")
    s = get_spark("local[4]", app="adlake-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": ck, "spark.ui.showConsoleProgress": "false",
                         "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SMOKE = "/root/testdata/sf0.001"
