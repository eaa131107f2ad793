import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from leadlake.session import checkpoint_dir, create_session

    warehouse = tmp_path_factory.mktemp("warehouse")
    s = create_session(
        "leadlake-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(warehouse),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests only: the cluster names its shared folder itself
    checkpoint_dir(s, fallback=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as sorted tuples of the given (or all) columns."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
