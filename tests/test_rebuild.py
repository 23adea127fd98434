import datetime as dt
import time

import pytest

from helpers import local
from tillwatch.sources.views import sales_view
from tillwatch.streaming import rebuild
from tillwatch.streaming.rebuild import Store, read_rebuilt, run_rebuilding

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
START = dt.datetime(2024, 1, 1)


class Shop:
    """Files that arrive, and a store that takes them in."""

    def __init__(self, spark, path):
        self.spark, self.source, self.store = spark, str(path / "in"), str(path / "store")

    def bring(self, *rows):
        """Rows (event_id, day, value, kind) in one file."""
        data = [(i, None if day is None else START + dt.timedelta(days=day, minutes=(i or 0) % 600), 1, kind, value, "") for i, day, value, kind in rows]
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

    def run(self, **options):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return run_rebuilding(self.spark, self.source, schema, self.store, ["id"], transform=sales_view, **options)

    def files(self):
        return set(self.spark.read.parquet(Store(self.store).daily).inputFiles())

    def totals(self):
        found = local(read_rebuilt(self.spark, self.store), "day", "coffee_name")
        return {((r.day - START.date()).days, r.coffee_name): (r.sales, r.transactions) for r in found.itertuples()}


@pytest.fixture()
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_nothing_before_the_first_run(shop):
    assert shop.totals() == {}


def test_late_rows_rebuild_their_day_only(shop):
    shop.bring(*[(i, i // 10, 1.0, "view") for i in range(300)])
    assert shop.run() | {"remembered": 0} == {"rows": 300, "stored": 300, "days": 30, "remembered": 0}
    before = shop.files()
    shop.bring((1000, 10, 5.0, "view"), (1001, 10, 2.5, "click"))  # twenty days late
    assert shop.run()["days"] == 1
    totals = shop.totals()
    assert totals[10, "view"] == (15.0, 11) and totals[10, "click"] == (2.5, 1) and len(totals) == 31
    changed = shop.files() ^ before
    assert changed and all("day=2024-01-11" in f for f in changed)  # other days' files are the same


def test_a_repeated_file_changes_nothing(shop):
    rows = [(i, i // 10, 1.0, "view") for i in range(50)]
    shop.bring(*rows)
    shop.run()
    first = shop.totals()
    shop.bring(*rows)
    seen = shop.run()
    assert seen["rows"] == 50 and seen["stored"] == 0 and shop.totals() == first
    shop.bring(*rows[:20], (900, 2, 1.0, "view"))
    assert shop.run()["stored"] == 1 and shop.totals()[2, "view"] == (11.0, 11)


def test_state_is_bounded_and_later_copies_are_left_out(shop):
    """Keys are forgotten after a while; a copy that comes still later is stored and not counted."""
    for n in range(4):
        shop.bring(*[(100 * n + i, n, 1.0, "view") for i in range(100)])
        seen = shop.run(remember="1 second")
        assert seen["remembered"] <= 200  # this run's and the last one's, not all
        time.sleep(2.5)
    shop.bring(*[(i, 0, 1.0, "view") for i in range(100)])
    seen = shop.run(remember="1 second")
    assert seen["stored"] == 100 and seen["remembered"] <= 200
    assert shop.totals() == {(n, "view"): (100.0, 100) for n in range(4)}


def test_a_repeated_batch_replaces_itself(shop, monkeypatch):
    """A run that fails after it stored its rows is done again under the same number."""
    shop.bring(*[(i, 0, 2.0, "view") for i in range(10)])
    real, calls = rebuild.add_up, []

    def broken(*args):
        calls.append(1)
        raise RuntimeError("lost")

    monkeypatch.setattr(rebuild, "add_up", broken)
    with pytest.raises(Exception, match="lost"):
        shop.run()
    monkeypatch.setattr(rebuild, "add_up", real)
    shop.run()
    assert calls and shop.totals() == {(0, "view"): (20.0, 10)}
    assert shop.spark.read.parquet(Store(shop.store).rows).count() == 10


def test_missing_cells(shop):
    shop.bring((1, None, 1.0, "view"), (2, 0, None, "view"), (3, 0, 1.5, None), (4, 0, 1.0, "view"))
    seen = shop.run()
    assert seen["stored"] == 4 and seen["days"] == 1
    found = {r["coffee_name"]: (r["sales"], r["transactions"]) for r in read_rebuilt(shop.spark, shop.store).collect()}
    assert found == {"view": (1.0, 1), None: (1.5, 1)}


def test_several_batches_of_one_run(shop):
    for n in range(3):
        shop.bring(*[(10 * n + i, i % 2, 1.0, "view") for i in range(10)])
    seen = shop.run(max_files=1)
    assert seen["stored"] == 30 and seen["days"] == 6
    assert shop.totals() == {(0, "view"): (15.0, 15), (1, "view"): (15.0, 15)}


def test_rows_without_a_key_are_told_apart_by_all_they_hold(shop):
    shop.bring((None, 0, 1.0, "view"), (None, 0, 2.0, "view"), (None, 0, 2.0, "view"), (7, 0, 4.0, "view"))
    assert shop.run()["stored"] == 3 and shop.totals() == {(0, "view"): (7.0, 3)}
    shop.bring((None, 0, 2.0, "view"), (None, 0, 8.0, "view"), (7, 0, 4.0, "view"))
    assert shop.run()["stored"] == 1 and shop.totals() == {(0, "view"): (15.0, 4)}
