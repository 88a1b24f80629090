import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from servicelens.session import local_session

    extra = {}
    s = local_session(cpus=4, shuffle_partitions=4, memory="8g", extra=extra)
    # Tests run where no shared checkpoint folder is configured: use a scratch one.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="servicelens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def years(spark):
    from servicelens.functions import workcal

    return workcal.default_year_table(spark)
