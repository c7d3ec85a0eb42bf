"""Where intermediate files go."""

from pathlib import Path

import pytest

from glyphmill.sources import scratch
from glyphmill.sources.scratch import clean_scratch, materialize, scratch_path, scratch_root


class FakeConf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class FakeSession:
    def __init__(self, master, **conf):
        self.conf = FakeConf(conf)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"])
def test_a_cluster_must_name_the_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(FakeSession(master))
    named = FakeSession(master)
    named.conf.set("spark.checkpoint.dir", "hdfs://x/shared/")
    assert scratch_path(named, "a").startswith("hdfs://x/shared/glyphmill/app-1/a-")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_may_leave_it_unset(master):
    session = FakeSession(master)
    assert scratch_root(session) == scratch_root(session)


def test_files_of_the_application_can_be_removed(spark):
    frame = materialize(spark.range(5), "numbers")
    folder = Path(frame.inputFiles()[0].removeprefix("file://")).parent
    assert frame.count() == 5 and folder.is_dir()
    clean_scratch(spark)
    assert not folder.exists() and materialize(spark.range(3), "again").count() == 3


def test_a_thin_table_is_written_by_few_tasks(spark):
    many = spark.range(500).repartition(200)
    stored = materialize(many, "thin", thin=True)
    folder = Path(stored.inputFiles()[0].removeprefix("file://")).parent
    most = scratch.THIN_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert len(list(folder.glob("part-*"))) <= most < 200
    assert sorted(r[0] for r in stored.collect()) == list(range(500))
