import pytest

from regiscope.plans import publish
from regiscope.streaming.snapshots import ingest_new_months, latest_snapshot, missing_families


class Feed:
    """Month folders below one root, and a log of the loads they caused."""

    def __init__(self, spark, base):
        self.spark, self.base, self.loads, self.fail = spark, base, [], False
        self.root, self.target, self.state = str(base / "in"), str(base / "out"), str(base / "state")
        (base / "in").mkdir()

    def arrive(self, month, rows, name="main"):
        path = f"{self.root}/{month}/{name}.parquet"
        self.spark.range(rows).coalesce(1).write.parquet(path)

    def load(self, spark, folder, month):
        if self.fail:
            raise RuntimeError("load failed")
        self.loads.append(month)
        rows = spark.read.option("recursiveFileLookup", True).parquet(folder)
        publish.publish(rows, self.target, "t", month=month)

    def run(self, state=None, **options):
        ingest_new_months(self.spark, self.root, self.target, state or self.state, self.load, **options)

    def count(self):
        return publish.read_table(self.spark, self.target, "t").count()


class Flat(Feed):
    def arrive(self, month, rows, name="main"):
        import glob
        import os
        import shutil

        super().arrive(f"../tmp-{month}-{name}", rows, "x")
        os.makedirs(f"{self.root}/{month}", exist_ok=True)
        part = glob.glob(f"{self.base}/tmp-{month}-{name}/x.parquet/part*.parquet")[0]
        shutil.copy(part, f"{self.root}/{month}/{name}.parquet")


@pytest.fixture
def feed(spark, tmp_path):
    return Flat(spark, tmp_path)


def test_newest_month_is_loaded_once(feed):
    feed.arrive("2026-01", 5)
    feed.arrive("2026-02", 7)
    feed.run()
    feed.run()
    assert feed.loads == ["2026-02"] and feed.count() == 7
    feed.arrive("2026-03", 9)
    feed.run()
    assert feed.loads == ["2026-02", "2026-03"] and feed.count() == 9
    assert publish.published_month(feed.spark, feed.target) == "2026-03"


def test_older_month_is_ignored(feed):
    feed.arrive("2026-02", 7)
    feed.run()
    feed.arrive("2026-01", 5)
    feed.run()
    assert feed.loads == ["2026-02"] and feed.count() == 7


def test_incomplete_month_waits_for_its_files(feed):
    needed = (r"^main\.", r"^lookup\.")
    feed.arrive("2026-02", 7)
    feed.run(required=needed)
    assert feed.loads == []
    feed.arrive("2026-02", 1, "lookup")
    feed.run(required=needed)
    assert feed.loads == ["2026-02"] and feed.count() == 8, "the whole folder is loaded"


def test_newest_complete_month_is_loaded(feed):
    needed = (r"^main\.", r"^lookup\.")
    for name in ("main", "lookup"):
        feed.arrive("2026-01", 4, name)
    feed.arrive("2026-02", 7)
    feed.run(required=needed)
    assert feed.loads == ["2026-01"] and feed.count() == 8
    feed.arrive("2026-02", 1, "lookup")
    feed.run(required=needed)
    assert feed.loads == ["2026-01", "2026-02"] and feed.count() == 8


def test_failed_load_is_retried(feed):
    feed.arrive("2026-02", 7)
    feed.fail = True
    with pytest.raises(Exception, match="load failed"):
        feed.run()
    assert publish.published_month(feed.spark, feed.target) is None
    feed.fail = False
    feed.run()
    assert feed.loads == ["2026-02"] and feed.count() == 7


def test_lost_checkpoint_does_not_reload(feed, tmp_path):
    feed.arrive("2026-02", 7)
    feed.run()
    feed.run(state=str(tmp_path / "other"))
    assert feed.loads == ["2026-02"]


def test_folder_that_is_no_month(feed):
    feed.arrive("misc", 7)
    feed.run()
    assert feed.loads == []


def test_missing_families(feed):
    feed.arrive("2026-02", 1)
    folder = f"{feed.root}/2026-02"
    assert missing_families(feed.spark, folder, [r"^main", r"^zip"]) == [r"^zip"]
    assert missing_families(feed.spark, folder, []) == []


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("2026-01", 1), ("2026-02", 2), ("2026-02", 3), (None, 4)], "month string, v int")
    assert sorted(r.v for r in latest_snapshot(df).collect()) == [2, 3]
