from pyspark.sql import functions as F

from churnlens.operators import features as FE
from churnlens.operators.clean import clean
from churnlens.schema import FEATURE_COLS, PAGE_COLUMNS
from tests.conftest import ev, rows


def test_one_event_user(spark):
    c = clean(rows(spark, [ev(user="1", ts=5, length=100.0, page="NextSong")]))
    f = FE.user_features(c).first()
    assert f.acc_age == 0 and f.avg_sess_p_day == 1.0 and f.avg_sess_len == 0


def test_25_hour_session(spark):
    c = clean(rows(spark, [ev(user="1", ts=0), ev(user="1", ts=90_000_000)]))
    f = FE.user_features(c).first()
    assert f.acc_age == 1 and f.avg_sess_len == 60.0
    assert f.avg_sess_p_day == 0.5


def test_no_song_user_has_null_length(spark):
    c = clean(rows(spark, [ev(user="1"), ev(user="2", page="NextSong", length=200.0)]))
    f = {r.userId: r.avg_length for r in FE.user_features(c).collect()}
    assert f == {"1": None, "2": 200.0}


def test_system_max_versus_mode(spark):
    iphone = "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2)"
    x11 = "Mozilla/5.0 (X11; Linux x86_64)"
    mac = "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4)"
    c = clean(rows(spark, [ev(user="1", agent=iphone)] * 3 + [ev(user="1", agent=x11)]
                   + [ev(user="2", agent=mac)] * 3 + [ev(user="2", agent=x11)]))
    mx = {r.userId: r.pref_user_system for r in FE.pref_user_system(c).collect()}
    md = {r.userId: r.pref_user_system for r in FE.pref_user_system(c, mode=True).collect()}
    assert mx == {"1": "iPhone", "2": "X11"}
    assert md == {"1": "iPhone", "2": "Macintosh"}


def test_unusable_systems_become_unknown(spark):
    c = clean(rows(spark, [ev(user="1", agent="curl/7.0"), ev(user="2", agent=None)]))
    got = {r.userId: r.pref_user_system for r in FE.user_features(c).collect()}
    assert got == {"1": "unknown", "2": "unknown"}


def test_same_month_two_years_is_one_group(spark):
    jan23, jan24 = 1673000000000, 1704800000000
    c = clean(rows(spark, [ev(user="1", ts=jan23, session=1), ev(user="1", ts=jan24, session=2),
                           ev(user="1", ts=jan24 + 1, session=2)]))
    monthly = FE.monthly_page_clicks(FE.session_page_counts(c)).collect()
    assert len(monthly) == 1 and monthly[0].month == 1.0 and monthly[0].avg_cnt == 1.5


def test_pivot_has_every_page_column(spark):
    c = clean(rows(spark, [ev(user="1", page="Home")]))
    f = FE.user_features(c)
    assert set(PAGE_COLUMNS) <= set(f.columns)
    r = f.first()
    assert r.Home == 1.0 and r.About == 0.0


def test_combined_features_equal_single_features(spark):
    from churnlens.plans.registry import cleaned

    c = cleaned(spark, "/root/testdata/sf0.01")
    combined = FE.user_features(c)
    singles = (FE.avg_sess_p_day(c).join(FE.avg_length(c), "userId").join(FE.acc_age(c), "userId")
               .join(FE.avg_sess_len(c), "userId").join(FE.avg_items_p_sess(c), "userId")
               .join(FE.bin_gender(c), "userId")
               .join(FE.page_pivot(FE.page_clicks(c)), "userId"))
    j = combined.alias("a").join(singles.alias("b"), "userId")
    cols = ["avg_sess_p_day", "avg_length", "avg_items_p_sess", "acc_age", "avg_sess_len",
            "bin_gender"] + PAGE_COLUMNS
    bad = j.filter(F.greatest(*[F.abs(F.coalesce(F.col(f"a.{k}"), F.lit(-1.0))
                                      - F.coalesce(F.col(f"b.{k}"), F.lit(-1.0))) for k in cols]) > 1e-9)
    assert bad.count() == 0 and j.count() == combined.count() == 141


def test_one_row_per_user(spark):
    from churnlens.plans.registry import features

    f = features(spark, "/root/testdata/sf0.01")
    assert f.count() == f.select("userId").distinct().count() == 141
    assert all(c in f.columns for c in FEATURE_COLS)


def test_ml_label_is_binary_while_raw_label_counts(spark):
    c = clean(rows(spark, [ev(user="1", page="Cancellation Confirmation", ts=1),
                           ev(user="1", page="Cancellation Confirmation", ts=2), ev(user="2", ts=3)]))
    raw_label = {r.userId: r.churn for r in FE.user_label(c).collect()}
    ml = {r.userId: r.churn for r in FE.user_features(c).collect()}
    assert raw_label == {"1": 2, "2": 0} and ml == {"1": 1, "2": 0}
