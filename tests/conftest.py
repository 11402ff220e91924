import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stayline.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="stayline-tests", local_driver_memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
