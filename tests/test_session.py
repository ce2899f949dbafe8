from __future__ import annotations

import os
import time

import pytest

from tagwright import session
from tagwright.plans.registry import REGISTRY

SMALL = "/root/testdata/sf0.001"


def folders(spark):
    root = session._scratch_root(spark).removeprefix("file:")
    return {f: sorted(os.listdir(f"{root}/{f}")) for f in os.listdir(root)} if os.path.isdir(root) else {}


@pytest.fixture()
def own_root(monkeypatch, tmp_path):
    """A shared folder of the test's own: the session's may hold others' work."""
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    return tmp_path / "tagwright"


class Context:
    def __init__(self, master, checkpoint_dir=None):
        self.master, self.checkpoint_dir = master, checkpoint_dir

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, path):
        self.checkpoint_dir = f"file:{path}/run"


class Session:
    def __init__(self, context, **conf):
        self.sparkContext = context
        self.conf = type("Conf", (), {"get": staticmethod(conf.get)})()


def test_shared_dir_follows_the_session():
    named = Session(Context("yarn"), **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.shared_dir(named) == "hdfs:///shared"
    set_later = Session(Context("yarn", "hdfs:///other"))
    assert session.shared_dir(set_later) == "hdfs:///other"


def test_a_cluster_without_a_shared_dir_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(Context("yarn")))


def test_local_mode_gets_a_folder_of_its_own():
    local = Session(Context("local[4]"))
    assert session.shared_dir(local) == session.shared_dir(local)


def test_written_table_keeps_schema_and_rows(spark):
    df = spark.range(10).selectExpr("id", "cast(null as binary) as raw", "array(id) as ids")
    stored = session.write_shared(df)
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert stored.count() == 10


@pytest.mark.parametrize(
    ("size", "partitions"), [(0, 200), (10**12, 7451), (10**14, 745_059), (10**13, 74506)]
)
def test_partitions_grow_with_the_data(size, partitions):
    assert session.cluster_settings(size)["spark.sql.shuffle.partitions"] == str(partitions)


@pytest.mark.parametrize(
    "name", ["label_deep_page", "batch_bounds", "duplicate_addresses", "batch_running_rate", "batch_payload_sizes", "retry_candidates"]
)
def test_no_folder_is_left_after_a_query(spark, own_root, name):
    before = folders(spark)
    with session.scratch(spark) as path:
        REGISTRY[name](spark, SMALL).collect()
        assert os.listdir(path.removeprefix("file:"))
    assert folders(spark) == before


def test_scratch_ends_with_an_error_and_may_be_nested(spark, own_root):
    before = folders(spark)
    with pytest.raises(ValueError), session.scratch(spark):
        outer = session.write_shared(spark.range(3))
        with session.scratch(spark):
            assert session.write_shared(spark.range(2)).count() == 2
        assert outer.count() == 3
        raise ValueError
    assert folders(spark) == before


def test_dead_owners_are_swept_and_live_ones_stay(spark, own_root):
    with session.scratch(spark):
        kept = session.write_shared(spark.range(4))
        for name, hours in (("owner-dead", 30), ("owner-idle", 30), ("owner-alive", 1), ("other", 90)):
            (own_root / name / "table").mkdir(parents=True)
            then = time.time() - hours * 3600
            os.utime(own_root / name / "table", (then, then))
            os.utime(own_root / name, (then, then))
        os.utime(own_root / "owner-idle" / "table")  # its folder is old, a table in it is not
        assert session.sweep_scratch(spark, idle_hours=24) == ["owner-dead"]
        assert session.sweep_scratch(spark, idle_hours=24) == []
        assert {"owner-idle", "owner-alive", "other"} <= set(folders(spark)) and kept.count() == 4
        for hours in (0, -1):
            with pytest.raises(ValueError):
                session.sweep_scratch(spark, hours)


def test_release_removes_what_the_application_wrote(spark, own_root):
    own = f"owner-{spark.sparkContext.applicationId}"
    session.write_shared(spark.range(1))
    for other in (f"{own}0", "table"):  # another application's, and nobody's
        (own_root / other).mkdir()
    assert own in folders(spark)
    session.release_scratch(spark)
    assert set(folders(spark)) == {f"{own}0", "table"}
