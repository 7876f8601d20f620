import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitals.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={folder}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT = (
    "event_id string, event_type string, event_ts string, actor_login string, repo_name string, "
    "payload_action string, pr_number bigint, pr_merged boolean, push_distinct_size bigint, era string"
)


@pytest.fixture(scope="session")
def events_of(spark):
    """Cleaned events from dicts; missing fields are NULL."""
    names = [part.split()[0] for part in EVENT.split(",")]

    def build(rows):
        data = [tuple(r.get(n) for n in names) for r in rows]
        df = spark.createDataFrame(data, EVENT)
        return df.selectExpr(
            "* except (event_ts)", "cast(event_ts as timestamp) event_ts", "to_date(event_ts) event_date"
        )

    return build
