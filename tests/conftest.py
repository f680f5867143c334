import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.session import local_session

    spark = local_session(8)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark
