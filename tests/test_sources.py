import json

from churnlens.operators.clean import clean
from churnlens.schema import EVENT_LOG
from churnlens.session import scratch_path
from churnlens.sources import read_event_log, read_metrics, write_metrics


def test_json_log_with_extra_and_missing_fields(spark, tmp_path):
    lines = [
        {"userId": "30", "page": "NextSong", "level": "paid", "sessionId": 29, "ts": 1538352117000,
         "gender": "M", "itemInSession": 50, "length": 277.89, "auth": "Logged In",
         "userAgent": "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36",
         "artist": "Martha Tilston", "song": "Rockpools", "status": 200, "registration": 1538173362000},
        {"userId": "", "page": "Home", "auth": "Logged Out", "ts": 1538352118000, "sessionId": 8},
        {"userId": "30", "page": "Cancellation Confirmation", "ts": 1538352119000, "sessionId": 29,
         "level": "paid", "gender": "M", "itemInSession": 51, "auth": "Cancelled"},
    ]
    path = tmp_path / "log.json"
    path.write_text("\n".join(json.dumps(x) for x in lines))
    df = read_event_log(spark, f"file://{path}")
    assert df.schema == EVENT_LOG
    out = {(r.page, r.churn, r.userSystem) for r in clean(df).collect()}
    assert out == {("NextSong", 1, "Windows NT 6.1"), ("Cancellation Confirmation", 1, None)}


def test_metrics_record_round_trip(spark):
    root = scratch_path(spark, "metrics")
    rec = spark.createDataFrame([(f"{root}/lr/", 0.8, 0.81, 0.8, 0.79)],
                                "model_path string, recall double, precision double, accuracy double, f1 double")
    write_metrics(rec, f"{root}/lr/")
    back = read_metrics(spark, {"lr": f"{root}/lr/"}).collect()
    assert len(back) == 1 and back[0].Algorithm == "lr" and back[0].F1 == 0.79
    assert back[0].Path.endswith("/lr/")
