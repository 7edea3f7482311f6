"""Publishing. The relational path is tested up to the connection: no database runs here."""

import datetime as dt

import pytest

from daymark.operators import screening
from daymark.operators.daily_metrics import daily_user_metrics
from daymark.schemas import GOLD
from daymark.sinks import serving
from daymark.sources.tables import read_table
from helpers import event, events_df, rows

D5, D6 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def gold_of(spark, *events):
    return daily_user_metrics(screening.clean(events_df(spark, *events)))


def test_projection_drops_extra_columns_and_orders(spark):
    gold = gold_of(spark, event()).select("last_event_ts", *[c for c in GOLD.fieldNames() if c != "last_event_ts"])
    shaped = serving.serving_projection(gold.withColumn("extra", gold.user_id))
    assert shaped.columns == GOLD.fieldNames()


def test_publish_replaces_only_its_dates(spark, tmp_path):
    target = str(tmp_path / "serving")
    both = gold_of(spark, event(), event(event_id="e2", event_timestamp="2024-01-06T00:00:00Z"))
    assert serving.publish_parquet(both, target) == [D5, D6]
    first = rows(read_table(spark, target, GOLD))
    serving.publish_parquet(both, target)
    assert rows(read_table(spark, target, GOLD)) == first
    newer = gold_of(spark, event(), event(event_id="e3", user_id="9"))
    assert serving.publish_parquet(newer, target) == [D5]
    table = read_table(spark, target, GOLD)
    assert rows(table.select("event_date", "user_id")) == [(D5, 7), (D5, 9), (D6, 7)]


def test_named_date_without_rows_is_removed(spark, tmp_path):
    target = str(tmp_path / "serving")
    serving.publish_parquet(gold_of(spark, event()), target)
    empty = gold_of(spark, event()).limit(0)
    assert serving.publish_parquet(empty, target) == []
    assert read_table(spark, target, GOLD).count() == 1
    assert serving.publish_parquet(empty, target, [D5]) == [D5]
    assert read_table(spark, target, GOLD).count() == 0


def test_unsound_gold_is_refused_and_the_target_kept(spark, tmp_path):
    target = str(tmp_path / "serving")
    gold = gold_of(spark, event())
    serving.publish_parquet(gold, target)
    before = rows(read_table(spark, target, GOLD))
    with pytest.raises(ValueError, match="Primary key"):
        serving.publish_parquet(gold.union(gold), target)
    assert rows(read_table(spark, target, GOLD)) == before


def test_replace_statements():
    create, delete, insert = serving.replace_statements("dw.metrics", "stage", [D5, D6])
    assert create.startswith("CREATE TABLE IF NOT EXISTS dw.metrics (")
    assert "PRIMARY KEY (event_date, user_id)" in create
    columns = create[create.index("(") + 1 :].split(", ")
    assert "event_date date NOT NULL" in columns and "user_id bigint NOT NULL" in columns
    assert "total_amount double precision" in columns and "last_event_ts timestamp with time zone" in columns
    assert sum("NOT NULL" in c for c in columns) == 10
    assert delete == "DELETE FROM dw.metrics WHERE event_date IN (DATE '2024-01-05', DATE '2024-01-06')"
    assert insert.endswith("FROM stage") and "SELECT DISTINCT event_date, user_id" in insert


@pytest.mark.parametrize("name", ["a; DROP TABLE b", "a b", "", "a.b.c", "1a"])
def test_table_names_are_checked(name):
    with pytest.raises(ValueError, match="table name"):
        serving.replace_statements(name, "stage", [D5])


class Connection:
    """Records what a JDBC connection is asked to do."""

    def __init__(self, fail_on=None):
        self.log, self.fail_on = [], fail_on

    def setAutoCommit(self, on):
        self.log.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        if sql == self.fail_on:
            raise RuntimeError("duplicate key")
        self.log.append(sql)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_transaction_commits_once():
    connection = Connection()
    serving.run_in_transaction(connection, ["a", "b"])
    assert connection.log == ["autocommit False", "a", "b", "commit", "close"]


def test_transaction_rolls_back_on_failure():
    connection = Connection(fail_on="b")
    with pytest.raises(RuntimeError, match="duplicate key"):
        serving.run_in_transaction(connection, ["a", "b"])
    assert connection.log == ["autocommit False", "a", "rollback", "close"]


def test_no_dates_touch_no_database(spark):
    empty = gold_of(spark, event()).limit(0)
    assert serving.publish_jdbc(empty, "jdbc:none:", "t", "s") == []


def test_only_the_given_dates_are_published(spark, tmp_path):
    events = [event(event_id=f"e{k}", event_timestamp=f"2024-01-0{k}T00:00:00Z") for k in (5, 6, 7)]
    gold = daily_user_metrics(screening.clean(events_df(spark, *events)))
    target = str(tmp_path / "serving")
    assert serving.publish_parquet(gold, target, [dt.date(2024, 1, 6)]) == [dt.date(2024, 1, 6)]
    assert [r.event_date for r in spark.read.parquet(target).collect()] == [dt.date(2024, 1, 6)]
