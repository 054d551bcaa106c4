"""Table functions in SQL, and the profile of a log's fields."""

import json

from churnlens.functions.sql_tables import sql_scope, user_features_sql
from churnlens.operators import features as FE
from churnlens.plans.registry import cleaned, rounded, with_nulls
from churnlens.schema import EVENT_LOG
from churnlens.sources.drift import MALFORMED, field_kinds, merged_schema, schema_drift, variant_lines

from .conftest import SF001


def values(df):
    return sorted(map(repr, map(tuple, rounded(df.select(*sorted(df.columns))).collect())))


def test_feature_job_in_sql_equals_the_functions(spark):
    for log in (cleaned(spark, SF001), with_nulls(spark, SF001)):
        got, want = user_features_sql(spark, log), FE.user_features(log)
        assert dict(got.dtypes) == dict(want.dtypes) and values(got) == values(want)


def test_scopes_do_not_see_each_other_and_leave_nothing(spark):
    log = cleaned(spark, SF001)
    before = {r[0] for r in spark.sql("SHOW USER FUNCTIONS").collect()}
    with sql_scope(spark, log=log) as a, sql_scope(spark, log=log.limit(0)) as b:
        many, none = (s.sql("SELECT * FROM {events_between}(0, 9999999999999)") for s in (a, b))
        share = a.sql("SELECT hour, events / SUM(events) OVER () AS s FROM {bucket_counts}(false)")
        assert a.names["log"] != b.names["log"]
        assert len(a.names) == 4
    assert many.count() == log.filter("ts IS NOT NULL").count() and none.count() == 0  # valid after the scope
    assert abs(sum(r["s"] for r in share.collect()) - 1) < 1e-9
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("scope_")]
    after = {r[0] for r in spark.sql("SHOW USER FUNCTIONS").collect()}
    assert not [f for f in after - before if "scope_" in f]


def test_a_skipped_page_is_a_parameter(spark):
    log = cleaned(spark, SF001)
    with sql_scope(spark, base=FE.base_aggregate(log)) as s:
        got = s.sql("SELECT * FROM {page_means}('NextSong')")
    assert values(got) == values(FE.page_clicks(log, exclude=("NextSong",)))


def test_drift_report(spark, tmp_path):
    lines = [json.dumps(x) for x in (
        {"userId": "1", "ts": 5, "length": 3, "page": None}, {"userId": "1", "ts": "5", "length": 2.5, "tags": ["a"]},
        {"userId": 7, "ts": 5.5, "device": {"os": "x"}}, {"userId": "2", "ts": 6, "device": "tv", "on": True})]
    (tmp_path / "log.json").write_text("\n".join([*lines, "{broken", "", "[1]", "5"]))
    kinds = field_kinds(variant_lines(spark, str(tmp_path)))
    whole = {r["kind"]: r["n"] for r in kinds.filter("field IS NULL").collect()}
    assert whole == {"lines": 7, MALFORMED: 3}
    got = {r["field"]: r.asDict() for r in schema_drift(spark, str(tmp_path)).collect()}
    assert set(got) == {f.name for f in EVENT_LOG.fields} | {"device", "tags", "on"}
    pick = lambda f: tuple(got[f][c] for c in ("expected", "fits", "mistyped", "nulls", "missing", "kinds"))
    assert pick("ts") == ("bigint", 2, 2, 0, 0, "integer,number,string")
    assert pick("userId") == ("string", 3, 1, 0, 0, "integer,string")
    assert pick("length") == ("double", 2, 0, 0, 2, "integer,number")
    assert pick("page") == ("string", 0, 0, 1, 3, "null") and pick("song") == ("string", 0, 0, 0, 4, "")
    assert pick("device") == (None, 0, 0, 0, 2, "object,string") and pick("on")[5] == "boolean"
    assert "device" in merged_schema(variant_lines(spark, str(tmp_path)))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "log.json").write_text("")
    assert schema_drift(spark, str(tmp_path / "empty")).filter("missing <> 0 OR fits <> 0").count() == 0
