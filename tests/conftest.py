import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fundgraph.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark(
        "tests", "8",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            # several ranges and partitions even for tiny tables
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    yield s
    s.stop()


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())
