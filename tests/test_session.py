"""Session helpers and time-range variants of the dashboard view."""

import duckdb
import pytest

from conftest import SF_MID
from pricewatch import fixed
from pricewatch.plans import catalog
from pricewatch.plans.driver import AS_OF, AS_OF_SQL
from pricewatch.operators import dashboard
from pricewatch.session import checkpoint_dir, sized_conf


def test_checkpoint_dir_is_read_not_replaced(spark):
    first = checkpoint_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == first
    assert checkpoint_dir(spark) == first


def test_unset_checkpoint_dir_on_a_cluster_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_sized_conf():
    assert sized_conf(10 ** 6)["spark.sql.shuffle.partitions"] == "8"
    assert sized_conf(64 * 256 * 1024 * 1024)["spark.sql.shuffle.partitions"] == "64"
    assert sized_conf(100 * 1024 ** 4)["spark.sql.shuffle.partitions"] == "50000"


@pytest.mark.parametrize("hours", fixed.HOURS_CHOICES)
def test_recent_prices_every_range(spark, hours):
    got = dashboard.recent_prices(catalog._history(spark, SF_MID), catalog._dimension(spark, SF_MID),
                                  hours=hours, as_of=AS_OF)
    con = duckdb.connect()
    for t in ("events", "customer", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    want = con.execute(f"""
        SELECT p.listing_id FROM {catalog._PH} p JOIN {catalog._DIM} d ON p.event_id = d.event_id
        WHERE p.timestamp >= {AS_OF_SQL} - INTERVAL {hours} HOURS
        ORDER BY p.timestamp DESC, p.listing_id DESC LIMIT {fixed.HISTORY_LIMIT}""").fetchall()
    assert [r.listing_id for r in got.collect()] == [r[0] for r in want]


def test_entry_schema_is_stable(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).schema == entry.entry(spark).schema
