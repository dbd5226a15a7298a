from __future__ import annotations

import builders as b
import pytest
from compare import connect, differences

import __spark_entry__ as contract
from ebbtide.session import broadcast_if_small, stage, work_folder
from ebbtide.sources import retail_views as views
from ebbtide.sources.readers import for_users, read_activity, read_attributes, read_holidays, write_table


def test_csv_sources_keep_their_schema(spark, small, tmp_path):
    activity, people = views.activity(spark, small), views.attributes(spark, small)
    activity.write.option("header", True).csv(str(tmp_path / "activity"))
    people.write.option("header", True).csv(str(tmp_path / "people"))
    assert differences(read_activity(spark, str(tmp_path / "activity")).toPandas(), activity.toPandas()) == []
    assert differences(read_attributes(spark, str(tmp_path / "people")).toPandas(), people.toPandas()) == []
    inferred = read_attributes(spark, str(tmp_path / "people"), infer_schema=True)
    assert dict(inferred.dtypes)["is_company"] == "boolean" and inferred.count() == people.count()


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("ID,mobile_device,country,preferred_language,gender,is_company\nx,,nl,nl,f,true\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_attributes(spark, str(tmp_path / "bad.csv")).collect()


def test_users_by_id_list_and_table(spark):
    frame = b.activity(spark, [(1, "2024-01-01", 1), (2, "2024-01-01", 1), (2, "2024-01-08", 1)])
    assert for_users(frame, 2).count() == 2
    assert for_users(frame, [1, 2]).count() == 3
    assert for_users(frame, spark.createDataFrame([(2,), (2,), (9,)], "ID bigint")).count() == 2


def test_holiday_table_round_trip(spark, tmp_path):
    days = b.holidays(spark, [("nl", "2024-01-01")])
    write_table(days, str(tmp_path / "h"))
    assert differences(read_holidays(spark, str(tmp_path / "h")).toPandas(), days.toPandas()) == []


def test_staged_tables_lie_in_the_named_folder(spark):
    table = stage(spark.range(5), "numbers")
    assert work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark) in table.inputFiles()[0].replace("file://", "")
    assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_limit(spark):
    def hinted(frame):
        return "ResolvedHint" in frame._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(spark.range(5), 5))
    assert not hinted(broadcast_if_small(spark.range(6), 5))


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if not n.startswith("tree_")])
def test_query_equals_sql(spark, small, con, name):
    frame = contract.queries()[name](spark, small).toPandas()
    assert len(frame)
    assert differences(frame, con.execute(contract.oracle_sql()[name]).df()) == []


def test_entry_is_the_feature_table(spark):
    table = contract.entry(spark)
    assert len(table.columns) == 188 and table.count() > 0
