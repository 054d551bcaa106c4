"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written in the straightforward per-feature form (a window for the churn
label, one aggregate per feature, joins on ``userId``) so it checks the
library's merged aggregates independently. Every query starts from the same
adapter of the ``events`` table. Doubles are rounded like ``registry.rounded``.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong one in the library shows.
CANCEL_PAGE = "Cancellation Confirmation"
FEATURE_PAGES = ["About", "Add Friend", "Add to Playlist", "Downgrade", "Error", "Help", "Home", "Logout", "NextSong",
                 "Roll Advert", "Save Settings", "Settings", "Submit Downgrade", "Submit Upgrade", "Thumbs Down",
                 "Thumbs Up", "Upgrade"]
USER_SYSTEM_PATTERN = r"\(([a-zA-Z 0-9.]+)"
ADAPTER_PAGES = ["About", "Add Friend", "Add to Playlist", "Downgrade", "Help", "Home", "Logout", "Roll Advert",
                 "Save Settings", "Settings", "Submit Downgrade", "Submit Upgrade", "Thumbs Down", "Thumbs Up", "Upgrade"]
ADAPTER_AGENTS = ["Mozilla/5.0 (Windows NT 6.1; WOW64)", "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4)",
                  "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2)", "Mozilla/5.0 (X11; Linux x86_64)", "curl/7.0"]
SESSION_SPAN_MS = 259200000

MS = "(epoch_us(ts) // 1000)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def days(x: str) -> str:
    return f"CAST(({x}) // 86400000 AS INTEGER)"


def minutes(x: str) -> str:
    return f"CAST((({x}) % 86400000) // 60000 AS INTEGER)"


def _ts(ms: str) -> str:
    return f"make_timestamp(CAST(FLOOR({ms}) AS BIGINT) * 1000)"


def hour(ms: str) -> str:
    return f"CAST(hour({_ts(ms)}) AS FLOAT)"


def month(ms: str) -> str:
    return f"CAST(month({_ts(ms)}) AS FLOAT)"


def weekday(ms: str) -> str:
    return f"CAST(isodow({_ts(ms)}) - 1 AS FLOAT)"


def r6(x: str) -> str:
    return f"ROUND(({x}) * 1000000.0) / 1000000.0"


def rounded(sql: str, cols: list[str]) -> str:
    repl = ", ".join(f"{r6(c)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS t"


def _case(index: str, values: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {index} = {i} THEN {q(v)}" for i, v in enumerate(values)) + " END"


EVENT_LOG = f"""event_log AS (
  SELECT CASE WHEN user_id % 50 = 7 THEN NULL
              WHEN user_id % 25 = 0 THEN ''
              ELSE CAST(user_id AS VARCHAR) END AS userId,
         CASE WHEN event_type = 'view' THEN 'NextSong'
              WHEN event_type = 'error' AND value > 170 THEN {q(CANCEL_PAGE)}
              WHEN event_type = 'error' THEN 'Error'
              ELSE {_case('event_id % 15', ADAPTER_PAGES)} END AS page,
         CASE WHEN event_id % 3 = 0 THEN 'free' ELSE 'paid' END AS level,
         user_id * 1000 + CAST(FLOOR(({MS}) / {float(SESSION_SPAN_MS)}) AS BIGINT) % 1000 AS sessionId,
         {MS} AS ts,
         CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         event_id % 97 AS itemInSession,
         {_case('(user_id + event_id % 2) % 6', ADAPTER_AGENTS)} AS userAgent,
         CASE WHEN event_type = 'view' AND user_id % 40 <> 3 THEN value END AS length,
         'Logged In' AS auth
  FROM events)"""

SYS_LOG = f"""sys_log AS (
  SELECT * EXCLUDE (userAgent), regexp_extract(userAgent, {q(USER_SYSTEM_PATTERN)}, 1) AS userSystem
  FROM event_log)"""

KEPT = """kept AS (
  SELECT userId, page, level, sessionId, ts, gender, itemInSession, userSystem, length, auth
  FROM sys_log WHERE userId <> '')"""

FLAGGED = f"""flagged AS (
  SELECT *, CASE WHEN page = {q(CANCEL_PAGE)} THEN 1 ELSE 0 END AS cancel_event FROM kept)"""

CLEANED = """cleaned AS (
  SELECT userId, page, level, sessionId, ts, gender, itemInSession, userSystem, length, auth,
         CAST(SUM(cancel_event) OVER (PARTITION BY userId) AS BIGINT) AS churn
  FROM flagged)"""

BASE = ",\n".join([EVENT_LOG, SYS_LOG, KEPT, FLAGGED, CLEANED])

# The same log with NULLs on some rows.
EVENT_LOG_NULLS = EVENT_LOG.replace("event_log AS (", "full_log AS (").replace("  FROM events)", "  , event_id FROM events)") + """,
event_log AS (
  SELECT * EXCLUDE (event_id) REPLACE (CASE WHEN event_id % 11 <> 1 THEN ts END AS ts,
                                       CASE WHEN event_id % 13 <> 1 THEN page END AS page,
                                       CASE WHEN event_id % 7 <> 1 THEN gender END AS gender,
                                       CASE WHEN event_id % 5 <> 1 THEN itemInSession END AS itemInSession)
  FROM full_log)"""
BASE_NULLS = ",\n".join([EVENT_LOG_NULLS, SYS_LOG, KEPT, FLAGGED, CLEANED])


def w(*ctes: str) -> str:
    """WITH clause: the adapter and cleaning chain plus extra CTEs."""
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n"


def wn(*ctes: str) -> str:
    """The same over the log with NULLs."""
    return "WITH " + ",\n".join([BASE_NULLS, *ctes]) + "\n"


PAGE_COLS = [p.replace(" ", "_") for p in FEATURE_PAGES]

# --- Shared feature CTEs ------------------------------------------------------------

def clicks(by: str = "userId", exclude_song: bool = False) -> str:
    """CTEs visits -> clicks: a page's clicks per visiting session, averaged over the months."""
    only = "WHERE page <> 'NextSong'" if exclude_song else ""
    return f"""visits AS (SELECT {by}, page, COUNT(page) AS n, AVG(ts) AS mid FROM cleaned {only} GROUP BY {by}, page, sessionId),
clicks AS (
  SELECT {by}, page, SUM(a_month) / COUNT(*) AS avg_mhly_cnt
  FROM (SELECT {by}, page, SUM(n) / CAST(COUNT(n) AS DOUBLE) AS a_month FROM visits GROUP BY {by}, page, {month('mid')})
  GROUP BY {by}, page)"""


CLICKS = clicks()

def _pivot(pages: list[str]) -> str:
    return "pv AS (SELECT userId, " + ", ".join(
        f"COALESCE(SUM(CASE WHEN page = {q(p)} THEN avg_mhly_cnt END), 0) AS {p.replace(' ', '_')}"
        for p in pages) + " FROM clicks GROUP BY userId)"


PIVOT = _pivot(FEATURE_PAGES)
FOUND_PAGES = [*FEATURE_PAGES, CANCEL_PAGE]

FEATS = f"""sess AS (
  SELECT userId, sessionId, {minutes('MAX(ts) - MIN(ts)')} AS len FROM cleaned GROUP BY userId, sessionId),
sl AS (SELECT userId, AVG(len) AS avg_sess_len FROM sess GROUP BY userId),
sc AS (
  SELECT userId,
         CAST(CASE WHEN MAX(churn) > 0 THEN 1 ELSE 0 END AS BIGINT) AS churn,
         COUNT(DISTINCT sessionId) / ({days('MAX(ts) - MIN(ts)')} + 1) AS avg_sess_p_day,
         AVG(length) AS avg_length,
         AVG(itemInSession) AS avg_items_p_sess,
         {days('MAX(ts) - MIN(ts)')} AS acc_age,
         MAX(CASE WHEN gender = 'F' THEN 1 ELSE 0 END) AS bin_gender,
         COALESCE(NULLIF(MAX(userSystem), ''), 'unknown') AS pref_user_system
  FROM cleaned GROUP BY userId),
{CLICKS},
{PIVOT},
freq AS (SELECT pref_user_system, COUNT(*) AS n FROM sc GROUP BY pref_user_system),
idx AS (
  SELECT pref_user_system,
         CAST(ROW_NUMBER() OVER (ORDER BY n DESC, pref_user_system ASC) - 1 AS DOUBLE) AS pref_user_system_ind
  FROM freq),
nsys AS (SELECT COUNT(*) AS k FROM freq),
feats AS (
  SELECT sc.userId, sc.churn, sc.avg_sess_p_day, sc.avg_length, sc.avg_items_p_sess, sc.acc_age,
         sl.avg_sess_len, sc.bin_gender, sc.pref_user_system, idx.pref_user_system_ind,
         {', '.join('pv.' + c for c in PAGE_COLS)}
  FROM sc JOIN sl USING (userId) JOIN pv USING (userId) JOIN idx USING (pref_user_system))"""

SPLIT = "CASE WHEN substr(md5('42:' || userId), 1, 15) < '1999999999999a0' THEN 'validation' ELSE 'train' END"

SCALARS = ["avg_sess_p_day", "avg_length", "avg_items_p_sess", "acc_age", "avg_sess_len", "bin_gender"]


def _long_features() -> str:
    """Non-zero assembled-vector entries as (userId, idx, value)."""
    parts = [f"SELECT userId, {i} AS idx, CAST({c} AS DOUBLE) AS value FROM ok"
             for i, c in enumerate(SCALARS)]
    n = len(SCALARS)
    parts.append(f"SELECT userId, {n} + CAST(pref_user_system_ind AS INTEGER) AS idx, 1.0 AS value "
                 f"FROM ok, nsys WHERE pref_user_system_ind < nsys.k - 1")
    parts += [f"SELECT userId, CAST({n} + nsys.k - 1 + {j} AS INTEGER) AS idx, CAST({c} AS DOUBLE) AS value FROM ok, nsys"
              for j, c in enumerate(PAGE_COLS)]
    ok = "ok AS (SELECT * FROM feats WHERE " + " AND ".join(
        f"{c} IS NOT NULL" for c in SCALARS + PAGE_COLS) + ")"
    return (ok + ",\nlong_f AS (" + "\nUNION ALL ".join(parts) + "),\n"
            f"dense AS (SELECT u.userId, CAST({n} + nsys.k - 1 + {len(PAGE_COLS)} AS INTEGER) AS size, CAST(i.i AS INTEGER) AS idx, "
            f"COALESCE(l.value, 0.0) AS value FROM ok u, nsys, range({n} + {len(PAGE_COLS)} + 100) i(i) "
            f"LEFT JOIN long_f l ON l.userId = u.userId AND l.idx = i.i WHERE i.i < {n} + nsys.k - 1 + {len(PAGE_COLS)})")


def _hist_auto(values_cte: str, value: str, group: list[str], bins: int, density: bool, w=w) -> str:
    g = ", ".join(group)
    gx = ", ".join(f"x.{c}" for c in group)
    on = " AND ".join(f"x.{c} IS NOT DISTINCT FROM r.{c}" for c in group)
    dens = (f", cnt / (SUM(cnt) OVER (PARTITION BY {g}) * (bin_hi - bin_lo)) AS density"
            if density else "")
    return w(values_cte, f"""x AS (SELECT {g}, CAST({value} AS DOUBLE) AS v FROM vals WHERE {value} IS NOT NULL),
rng0 AS (SELECT {g}, MIN(v) AS a, MAX(v) AS b FROM x GROUP BY {g}),
rng AS (SELECT {g}, CASE WHEN b > a THEN a ELSE a - 0.5 END AS lo, CASE WHEN b > a THEN b ELSE b + 0.5 END AS hi FROM rng0),
binned AS (
  SELECT {gx}, r.lo, r.hi, CAST(LEAST(FLOOR((x.v - r.lo) / ((r.hi - r.lo) / {bins})), {bins - 1}) AS INTEGER) AS bin
  FROM x JOIN rng r ON {on}),
h AS (
  SELECT {g}, bin, lo + bin * ((hi - lo) / {bins}) AS bin_lo, lo + (bin + 1) * ((hi - lo) / {bins}) AS bin_hi,
         COUNT(*) AS cnt
  FROM binned GROUP BY {g}, bin, lo, hi)""") + f"SELECT *{dens} FROM h"


def _hist_edges(values_cte: str, value: str, group: list[str], edges: list[float]) -> str:
    g = ", ".join(group)
    n = len(edges) - 1
    case = "CASE " + " ".join(f"WHEN v < {float(edges[i + 1])} THEN {i}" for i in range(n - 1)) + f" ELSE {n - 1} END"
    lo = "[" + ", ".join(str(float(e)) for e in edges[:-1]) + "]"
    hi = "[" + ", ".join(str(float(e)) for e in edges[1:]) + "]"
    return w(values_cte, f"""x AS (SELECT {g}, CAST({value} AS DOUBLE) AS v FROM vals
             WHERE {value} IS NOT NULL AND {value} >= {float(edges[0])} AND {value} <= {float(edges[-1])}),
h AS (SELECT {g}, CAST({case} AS INTEGER) AS bin, COUNT(*) AS cnt FROM x GROUP BY ALL)""") + \
        f"SELECT {g}, bin, {lo}[bin + 1] AS bin_lo, {hi}[bin + 1] AS bin_hi, cnt FROM h"


LIFETIMES = f"vals AS (SELECT churn, userId, {days('MAX(ts) - MIN(ts)')} AS lifetime FROM cleaned GROUP BY churn, userId)"
SESSIONS = (f"vals AS (SELECT churn, userId, sessionId, {minutes('MAX(ts) - MIN(ts)')} AS session_duration "
            "FROM cleaned GROUP BY churn, userId, sessionId)")
SESSION_STATS = (f"sd AS (SELECT churn, userId, sessionId, {minutes('MAX(ts) - MIN(ts)')} AS session_duration "
                 "FROM cleaned GROUP BY churn, userId, sessionId),\n"
                 "stats AS (SELECT churn, userId, AVG(session_duration) AS avg, MIN(session_duration) AS min, "
                 "MAX(session_duration) AS max FROM sd GROUP BY churn, userId)")
SESSION_STATS_LONG = SESSION_STATS + ",\nvals AS (" + " UNION ALL ".join(
    f"SELECT churn, userId, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM stats"
    for c in ("avg", "min", "max")) + ")"
UPDOWN = (f"ud AS (SELECT churn, userId, "
          f"CAST(SUM(CASE WHEN page = 'Submit Upgrade' THEN 1 ELSE 0 END) AS BIGINT) AS num_upgrades, "
          f"CAST(SUM(CASE WHEN page = 'Submit Downgrade' THEN 1 ELSE 0 END) AS BIGINT) AS num_downgrades "
          f"FROM cleaned GROUP BY churn, userId)")
UPDOWN_LONG = UPDOWN + ",\nvals AS (" + " UNION ALL ".join(
    f"SELECT churn, userId, '{c}' AS variable, {c} AS value FROM ud"
    for c in ("num_upgrades", "num_downgrades")) + ")"
LOYAL_IDS = "SELECT userId FROM cleaned GROUP BY userId HAVING MAX(churn) = 0"
CANCELLED_IDS = "SELECT userId FROM cleaned GROUP BY userId HAVING MAX(churn) > 0"


def _share(bucket: str, group: str) -> str:
    fn = {"hour": hour, "weekday": weekday}[bucket]
    sql = (w(f"n AS (SELECT {fn('ts')} AS {bucket}, COUNT(ts) AS a, COUNT(*) AS b FROM cleaned WHERE {group} GROUP BY 1)") +
           f'SELECT {bucket}, a / (SUM(b) OVER ()) AS "count" FROM n')
    return rounded(sql, ['"count"'])


def _describe() -> str:
    cols = ["sessionId", "ts", "itemInSession", "length"]
    nine = lambda x: (f"CAST(CASE WHEN {x} = 0 THEN 0.0 ELSE "  # noqa: E731
                      f"ROUND({x} / POW(10.0::DOUBLE, FLOOR(LOG10(ABS({x}))) - 8)) END AS BIGINT)")
    parts = [f"""SELECT '{c}' AS "column", COUNT({c}) AS "count", {nine(f"AVG({c})")} AS mean,
       {nine(f"STDDEV_SAMP({c})")} AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max
FROM event_log""" for c in cols]
    return "WITH " + EVENT_LOG + "\n" + "\nUNION ALL ".join(parts)


def _describe_strings() -> str:
    cols = ["userId", "page", "level", "gender", "userAgent", "auth"]
    return "WITH " + EVENT_LOG + "\n" + "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS "count", MIN({c}) AS min, MAX({c}) AS max FROM event_log""" for c in cols)


def _null_profile() -> str:
    cols = ["userId", "page", "level", "sessionId", "ts", "gender", "itemInSession", "userAgent",
            "length", "auth"]
    exprs = []
    for c in cols:
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if c == "length" else "")
        exprs.append(f"COUNT(*) FILTER (WHERE {cond}) AS {c}")
    return "WITH " + EVENT_LOG + "\nSELECT " + ", ".join(exprs) + " FROM event_log"


def _confusion() -> str:
    return w(FEATS, """wt AS (
  SELECT churn, acc_age,
         0.5 / COUNT(*) OVER (PARTITION BY CASE WHEN churn = 0 THEN 0 ELSE 1 END) AS weight,
         CASE WHEN acc_age < 15 THEN 1.0 ELSE 0.0 END AS pred
  FROM feats),
cm AS (SELECT CAST(churn AS DOUBLE) AS label, pred, SUM(weight) AS w FROM wt GROUP BY label, pred),
lab AS (SELECT label AS c, SUM(w) AS lw, SUM(CASE WHEN label = pred THEN w ELSE 0 END) AS tp FROM cm GROUP BY label),
prd AS (SELECT pred AS c, SUM(w) AS pw FROM cm GROUP BY pred),
pc AS (SELECT lab.c, lw, tp,
              CASE WHEN lw = 0 THEN 0 ELSE tp / lw END AS r,
              CASE WHEN COALESCE(pw, 0) = 0 THEN 0 ELSE tp / pw END AS p
       FROM lab LEFT JOIN prd ON lab.c = prd.c)""") + """SELECT
  ROUND(SUM(r * lw) / SUM(lw) * 1000000.0) / 1000000.0 AS recall,
  ROUND(SUM(p * lw) / SUM(lw) * 1000000.0) / 1000000.0 AS precision,
  ROUND(SUM(tp) / SUM(lw) * 1000000.0) / 1000000.0 AS accuracy,
  ROUND(SUM(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * lw) / SUM(lw) * 1000000.0) / 1000000.0 AS f1
FROM pc"""


def _naive_bayes() -> str:
    """Multinomial naive Bayes (smoothing 1) trained on the weighted, MaxAbs-scaled
    train split and applied to the validation split: closed form, so SQL can follow it."""
    n_scalar = len(SCALARS)
    return w(FEATS, _long_features(), f"""sp AS (SELECT userId, churn, {SPLIT} AS split FROM feats),
wts AS (SELECT userId, churn, split,
               0.5 / COUNT(*) OVER (PARTITION BY split, CASE WHEN churn = 0 THEN 0 ELSE 1 END) AS w FROM sp),
lt AS (SELECT l.userId, l.idx, l.value, s.split, s.churn, s.w FROM long_f l JOIN wts s ON s.userId = l.userId),
mx AS (SELECT idx, MAX(ABS(value)) AS m FROM lt WHERE split = 'train' GROUP BY idx),
scl AS (SELECT lt.userId, lt.idx, lt.split, lt.churn, lt.w,
              CASE WHEN mx.m IS NULL OR mx.m = 0 THEN 0.0 ELSE lt.value / mx.m END AS x
       FROM lt LEFT JOIN mx ON mx.idx = lt.idx),
okw AS (SELECT ok.userId, wts.churn, wts.w FROM ok JOIN wts ON wts.userId = ok.userId WHERE wts.split = 'train'),
cls AS (SELECT churn AS c, SUM(w) AS n FROM okw GROUP BY churn),
tf AS (SELECT churn AS c, idx, SUM(w * x) AS s FROM scl WHERE split = 'train' GROUP BY churn, idx),
tot AS (SELECT c, SUM(s) AS t FROM tf GROUP BY c),
dims AS (SELECT {n_scalar} + k - 1 + {len(PAGE_COLS)} AS d FROM nsys),
nl AS (SELECT COUNT(*) AS nlab, SUM(n) AS ndoc FROM cls),
pri AS (SELECT c, LN(n + 1.0) - LN(ndoc + nlab * 1.0) AS p FROM cls, nl),
va AS (SELECT * FROM scl WHERE split = 'validation' AND x <> 0),
vusers AS (SELECT DISTINCT userId, churn FROM va),
score AS (
  SELECT v.userId, pri.c, pri.p + SUM(v.x * (LN(COALESCE(tf.s, 0.0) + 1.0) - LN(tot.t + dims.d))) AS r
  FROM va v CROSS JOIN pri JOIN tot ON tot.c = pri.c CROSS JOIN dims
       LEFT JOIN tf ON tf.c = pri.c AND tf.idx = v.idx
  GROUP BY v.userId, pri.c, pri.p)""") + """SELECT u.userId, u.churn, CAST(FIRST(s.c ORDER BY s.r DESC, s.c ASC) AS DOUBLE) AS prediction
FROM vusers u JOIN score s ON s.userId = u.userId GROUP BY u.userId, u.churn"""


def _per_user(expr: str, name: str, by: str = "userId") -> str:
    return w() + f"SELECT {by}, {expr} AS {name} FROM cleaned GROUP BY {by}"


GENDERS = """SELECT churn, gender, COUNT(DISTINCT CASE WHEN gender IS NOT NULL THEN userId END) AS cnt
    FROM cleaned GROUP BY churn, gender"""

AS_TEXT = "REPLACE (CAST(ts AS VARCHAR) AS ts, CAST(itemInSession AS VARCHAR) AS itemInSession)"
CV_FOLDS = 3


def _nb_cross_validation() -> str:
    """The same naive Bayes fitted on each two of three folds of the train split (fold: a hash
    of the user) and scored by label-weighted F1 on the third."""
    n_scalar = len(SCALARS)
    return rounded(w(FEATS, _long_features(), f"""sp AS (SELECT userId, churn, {SPLIT} AS split FROM feats),
wts AS (SELECT userId, churn, split, 0.5 / COUNT(*) OVER (PARTITION BY split, CASE WHEN churn = 0 THEN 0 ELSE 1 END) AS w FROM sp),
tr AS (SELECT ok.userId, wts.churn, wts.w, CAST('0x' || substr(md5('fold:' || ok.userId), 1, 8) AS BIGINT) % {CV_FOLDS} AS f
       FROM ok JOIN wts USING (userId) WHERE split = 'train'),
ks AS (SELECT range AS k FROM range({CV_FOLDS})),
lt AS (SELECT l.userId, l.idx, l.value, tr.churn, tr.w, tr.f FROM long_f l JOIN tr USING (userId)),
mx AS (SELECT k, idx, MAX(ABS(value)) AS m FROM lt, ks WHERE f <> k GROUP BY k, idx),
scl AS (SELECT ks.k, lt.*, CASE WHEN mx.m IS NULL OR mx.m = 0 THEN 0.0 ELSE lt.value / mx.m END AS x
        FROM lt CROSS JOIN ks LEFT JOIN mx ON mx.k = ks.k AND mx.idx = lt.idx),
cls AS (SELECT k, churn AS c, SUM(w) AS n FROM tr, ks WHERE f <> k GROUP BY k, churn),
tf AS (SELECT k, churn AS c, idx, SUM(w * x) AS s FROM scl WHERE f <> k GROUP BY k, churn, idx),
tot AS (SELECT k, c, SUM(s) AS t FROM tf GROUP BY k, c),
dims AS (SELECT {n_scalar} + k - 1 + {len(PAGE_COLS)} AS d FROM nsys),
nl AS (SELECT k, COUNT(*) AS nlab, SUM(n) AS ndoc FROM cls GROUP BY k),
pri AS (SELECT k, c, LN(n + 1.0) - LN(ndoc + nlab * 1.0) AS p FROM cls JOIN nl USING (k)),
score AS (
  SELECT v.k, v.userId, v.churn, pri.c, pri.p + SUM(v.x * (LN(COALESCE(tf.s, 0.0) + 1.0) - LN(tot.t + dims.d))) AS r
  FROM scl v JOIN pri ON pri.k = v.k JOIN tot ON tot.k = v.k AND tot.c = pri.c CROSS JOIN dims
       LEFT JOIN tf ON tf.k = v.k AND tf.c = pri.c AND tf.idx = v.idx
  WHERE v.f = v.k GROUP BY v.k, v.userId, v.churn, pri.c, pri.p),
pred AS (SELECT k, userId, churn, FIRST(c ORDER BY r DESC, c) AS guess FROM score GROUP BY k, userId, churn),
lab AS (SELECT k, churn AS c, COUNT(*) AS n, SUM(CASE WHEN guess = churn THEN 1 ELSE 0 END) AS tp FROM pred GROUP BY k, churn),
gs AS (SELECT k, guess AS c, COUNT(*) AS n FROM pred GROUP BY k, guess),
f1 AS (SELECT lab.k, SUM(lab.n * CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (lab.n + gs.n) END) / SUM(lab.n) AS f1
       FROM lab LEFT JOIN gs ON gs.k = lab.k AND gs.c = lab.c GROUP BY lab.k)""")
        + "SELECT AVG(f1) AS f1_mean, STDDEV_POP(f1) AS f1_std FROM f1", ["f1_mean", "f1_std"])


def _nb_metrics(select: str) -> str:
    """Class-weighted metrics of the naive Bayes model on the validation split, as ``recall, precision, accuracy, f1`` of ``m``."""
    return (f"WITH pred AS ({_naive_bayes()}),\n" + w(FEATS, f"""wt AS (
  SELECT userId, 0.5 / COUNT(*) OVER (PARTITION BY {SPLIT}, CASE WHEN churn = 0 THEN 0 ELSE 1 END) AS weight FROM feats),
cm AS (SELECT CAST(churn AS DOUBLE) AS label, prediction AS pred, SUM(weight) AS w FROM pred JOIN wt USING (userId) GROUP BY ALL),
lab AS (SELECT label AS c, SUM(w) AS lw, SUM(CASE WHEN label = pred THEN w ELSE 0 END) AS tp FROM cm GROUP BY label),
prd AS (SELECT pred AS c, SUM(w) AS pw FROM cm GROUP BY pred),
pc AS (SELECT lw, tp, CASE WHEN lw = 0 THEN 0 ELSE tp / lw END AS r, CASE WHEN COALESCE(pw, 0) = 0 THEN 0 ELSE tp / pw END AS p
       FROM lab LEFT JOIN prd ON lab.c = prd.c),
m AS (SELECT {r6('SUM(r * lw) / SUM(lw)')} AS recall, {r6('SUM(p * lw) / SUM(lw)')} AS precision, {r6('SUM(tp) / SUM(lw)')} AS accuracy,
             {r6('SUM(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * lw) / SUM(lw)')} AS f1 FROM pc)""")[len("WITH "):] + select)


#: What is known of the users that any model scores.
SCORED = w(FEATS, _long_features()) + f"""SELECT userId, churn, TRUE AS is_class, TRUE AS reload_agrees, TRUE AS metrics_agree
    FROM ok WHERE {SPLIT} = 'validation'"""

ORACLE: dict[str, str] = {
    "load_events": w() + "SELECT * FROM event_log",
    "user_system": w() + "SELECT * FROM sys_log",
    "drop_anonymous": w() + "SELECT * FROM sys_log WHERE userId <> ''",
    "kept_columns": w() + "SELECT * FROM kept",
    "cancel_flag": w() + "SELECT * FROM flagged",
    "churn_label": w() + "SELECT *, CAST(SUM(cancel_event) OVER (PARTITION BY userId) AS BIGINT) AS churn FROM flagged",
    "clean_log": rounded(w() + "SELECT * FROM cleaned", ["length"]),
    "churn_phase": rounded(w() + f"""SELECT *, CAST(SUM(CASE WHEN page = {q(CANCEL_PAGE)} THEN 1 ELSE 0 END)
        OVER (PARTITION BY userId ORDER BY ts NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS churn_phase
        FROM cleaned""", ["length"]),
    "time_parts": w() + f"SELECT userId, ts, {hour('ts')} AS hour, {month('ts')} AS month, {weekday('ts')} AS weekday FROM cleaned",
    "first_events": w() + "SELECT * FROM event_log ORDER BY " + ", ".join(
        f"{c} ASC NULLS FIRST" for c in ["ts", "userId", "page", "level", "sessionId", "gender",
                                          "itemInSession", "userAgent", "length", "auth"]) + " LIMIT 10",
    "unique_pages": w() + "SELECT DISTINCT page FROM event_log",
    "unique_levels": w() + "SELECT DISTINCT level FROM event_log",
    "unique_auth": w() + "SELECT DISTINCT auth FROM event_log",
    "unique_genders": w() + "SELECT DISTINCT gender FROM event_log",
    "null_profile": _null_profile(),
    "describe_events": _describe(),
    "user_label": w() + "SELECT userId, MAX(churn) AS churn FROM cleaned GROUP BY userId",
    "avg_sess_p_day": rounded(_per_user(f"COUNT(DISTINCT sessionId) / ({days('MAX(ts) - MIN(ts)')} + 1)", "avg_sess_p_day"), ["avg_sess_p_day"]),
    "avg_length": rounded(_per_user("AVG(length)", "avg_length"), ["avg_length"]),
    "avg_items_p_sess": rounded(_per_user("AVG(itemInSession)", "avg_items_p_sess"), ["avg_items_p_sess"]),
    "acc_age": _per_user(days("MAX(ts) - MIN(ts)"), "acc_age"),
    "avg_sess_len": rounded(w(f"s AS (SELECT userId, sessionId, {minutes('MAX(ts) - MIN(ts)')} AS len FROM cleaned GROUP BY userId, sessionId)")
                            + "SELECT userId, AVG(len) AS avg_sess_len FROM s GROUP BY userId", ["avg_sess_len"]),
    "bin_gender": _per_user("MAX(CASE WHEN gender = 'F' THEN 1 ELSE 0 END)", "bin_gender"),
    "pref_user_system": _per_user("MAX(userSystem)", "pref_user_system"),
    "sql_features": rounded(w() + f"""SELECT userId,
        COUNT(DISTINCT sessionId) / ({days('MAX(ts) - MIN(ts)')} + 1) AS avg_sess_p_day,
        {days('MAX(ts) - MIN(ts)')} AS acc_age,
        {month('AVG(ts)')} AS mean_month,
        {hour('MIN(ts)')} AS first_hour,
        {weekday('MAX(ts)')} AS last_weekday,
        MAX({minutes('ts - 1704067200000')}) AS max_minute_of_day
        FROM cleaned GROUP BY userId""", ["avg_sess_p_day"]),
    "attach_features": rounded(w(
        "lab AS (SELECT userId, MAX(churn) AS churn FROM cleaned GROUP BY userId)",
        "al AS (SELECT userId, AVG(length) AS avg_length FROM cleaned GROUP BY userId)",
        f"aa AS (SELECT userId, {days('MAX(ts) - MIN(ts)')} AS acc_age FROM cleaned GROUP BY userId)")
        + "SELECT lab.userId, lab.churn, al.avg_length, aa.acc_age FROM lab JOIN al ON al.userId = lab.userId JOIN aa ON aa.userId = lab.userId",
        ["avg_length"]),
    "page_clicks_monthly": rounded(w(CLICKS) + "SELECT * FROM clicks", ["avg_mhly_cnt"]),
    "page_pivot": rounded(w(CLICKS, _pivot(FOUND_PAGES)) + "SELECT * FROM pv", [p.replace(" ", "_") for p in FOUND_PAGES]),
    "training_pages": rounded(w(CLICKS, PIVOT) + "SELECT * FROM pv", PAGE_COLS),
    "user_features": rounded(w(FEATS) + "SELECT * FROM feats",
                             ["avg_sess_p_day", "avg_length", "avg_items_p_sess", "avg_sess_len", *PAGE_COLS]),
    "cancelled_users": w() + CANCELLED_IDS,
    "loyal_users": w() + LOYAL_IDS,
    "loyal_events_all": w() + f"SELECT * FROM cleaned WHERE userId IN ({LOYAL_IDS})",
    "loyal_events": w() + f"SELECT userId, ts, page FROM cleaned WHERE userId IN ({LOYAL_IDS})",
    "gender_by_churn": w() + GENDERS,
    "system_by_churn": w("p AS (SELECT churn, userId, MAX(userSystem) AS pref_user_system FROM cleaned GROUP BY churn, userId)")
                       + "SELECT churn, pref_user_system, COUNT(*) AS cnt FROM p GROUP BY churn, pref_user_system",
    "system_share": rounded(w("u AS (SELECT userId, MIN(churn) AS churn, MAX(userSystem) AS pref_user_system FROM cleaned GROUP BY userId)")
                            + """SELECT DISTINCT churn, pref_user_system,
                                 COUNT(*) OVER (PARTITION BY churn, pref_user_system) / COUNT(*) OVER (PARTITION BY churn) AS percentage
                                 FROM u""", ["percentage"]),
    "hour_share_loyal": _share("hour", "churn = 0"),
    "hour_share_cancelled": _share("hour", "churn > 0"),
    "weekday_share_loyal": _share("weekday", "churn = 0"),
    "weekday_share_cancelled": _share("weekday", "churn > 0"),
    "cancel_level": w() + f"""SELECT churn, level, COUNT(level) AS cnt
        FROM cleaned WHERE page = {q(CANCEL_PAGE)} GROUP BY churn, level""",
    "lifetime_stats": rounded(w(LIFETIMES) + "SELECT churn, AVG(lifetime) AS avg, MIN(lifetime) AS min, MAX(lifetime) AS max FROM vals GROUP BY churn", ["avg"]),
    "session_durations": w(SESSIONS) + "SELECT * FROM vals",
    "lifetimes": w(LIFETIMES) + "SELECT * FROM vals",
    "avg_length_by_churn": rounded(_per_user("AVG(length)", "avg_len", "churn, userId"), ["avg_len"]),
    "avg_items_by_churn": rounded(_per_user("AVG(itemInSession)", "avg", "churn, userId"), ["avg"]),
    "avg_sess_p_day_by_churn": rounded(_per_user(
        f"COUNT(DISTINCT sessionId) / ({days('MAX(ts) - MIN(ts)')} + 1)", "avg_sess_p_day", "churn, userId"),
        ["avg_sess_p_day"]),
    "pref_user_system_by_churn": _per_user("MAX(userSystem)", "pref_user_system", "churn, userId"),
    "session_stats": rounded(w(SESSION_STATS) + "SELECT * FROM stats", ["avg"]),
    "session_stats_long": rounded(w(SESSION_STATS_LONG) + "SELECT * FROM vals", ["value"]),
    "up_down_grades": w(UPDOWN) + "SELECT * FROM ud",
    "up_down_grades_long": w(UPDOWN_LONG) + "SELECT * FROM vals",
    "page_clicks_by_churn": rounded(w(clicks("churn, userId", True)) + "SELECT * FROM clicks", ["avg_mhly_cnt"]),
    "page_click_means": rounded(w(clicks("churn, userId", True))
                                + "SELECT page, churn, AVG(avg_mhly_cnt) AS mean_clicks FROM clicks GROUP BY page, churn",
                                ["mean_clicks"]),
    "hist_avg_length": rounded(_hist_auto("vals AS (SELECT churn, userId, AVG(length) AS avg_len FROM cleaned GROUP BY churn, userId)",
                                          "avg_len", ["churn"], 10, False), ["bin_lo", "bin_hi"]),
    "hist_items_p_sess": rounded(_hist_auto("vals AS (SELECT churn, userId, AVG(itemInSession) AS avg FROM cleaned GROUP BY churn, userId)",
                                            "avg", ["churn"], 10, False), ["bin_lo", "bin_hi"]),
    "hist_sess_p_day": rounded(_hist_edges(
        f"vals AS (SELECT churn, userId, COUNT(DISTINCT sessionId) / ({days('MAX(ts) - MIN(ts)')} + 1) AS avg_sess_p_day FROM cleaned GROUP BY churn, userId)",
        "avg_sess_p_day", ["churn"], [0, 1, 2, 3, 4, 5]), ["bin_lo", "bin_hi"]),
    "hist_lifetime": rounded(_hist_auto(LIFETIMES, "lifetime", ["churn"], 10, True), ["bin_lo", "bin_hi", "density"]),
    "hist_session_duration": rounded(_hist_auto(SESSIONS, "session_duration", ["churn"], 10, True),
                                     ["bin_lo", "bin_hi", "density"]),
    "hist_session_stats": rounded(_hist_auto(SESSION_STATS_LONG, "value", ["churn", "variable"], 10, True),
                                  ["bin_lo", "bin_hi", "density"]),
    "hist_up_down_grades": rounded(_hist_auto(UPDOWN_LONG, "value", ["churn", "variable"], 10, True),
                                   ["bin_lo", "bin_hi", "density"]),
    "train_val_split": w(FEATS) + f"SELECT userId, churn, {SPLIT} AS split FROM feats",
    "class_weights": rounded(w(FEATS, f"s AS (SELECT userId, churn, {SPLIT} AS split FROM feats)")
                             + """SELECT userId, churn, split,
                                  0.5 / COUNT(*) OVER (PARTITION BY split, CASE WHEN churn = 0 THEN 0 ELSE 1 END) AS weightCol
                                  FROM s""", ["weightCol"]),
    "system_index": w(FEATS) + "SELECT userId, pref_user_system, pref_user_system_ind FROM feats",
    "system_onehot": w(FEATS) + """SELECT userId, pref_user_system_ind, CAST(nsys.k - 1 AS INTEGER) AS ohe_size,
        CASE WHEN pref_user_system_ind < nsys.k - 1 THEN CAST(pref_user_system_ind AS INTEGER) END AS ohe_hot
        FROM feats, nsys""",
    "assembled_users": rounded(w(FEATS, _long_features()) + "SELECT * FROM dense", ["value"]),
    "scaled_features": rounded(w(FEATS, _long_features(),
                                 "mx AS (SELECT idx, MAX(ABS(value)) AS m FROM dense GROUP BY idx)")
                               + "SELECT d.userId, d.size, d.idx, CASE WHEN mx.m = 0 THEN 0.0 ELSE d.value / mx.m END AS value "
                                 "FROM dense d JOIN mx ON d.idx = mx.idx",
                               ["value"]),
    "confusion_metrics": _confusion(),
    "churn_nb": _naive_bayes(),
    "model_roundtrip": _naive_bayes(),
    "churn_svm": SCORED,
    "churn_lr": SCORED,
    "churn_rf": SCORED,
    "churn_cv_nb": _nb_cross_validation(),
    "evaluate_job": _nb_metrics("SELECT 'nb' AS Algorithm, recall AS Recall, precision AS Precision, accuracy AS Accuracy, f1 AS F1 FROM m"),
    "model_comparison": _nb_metrics(
        "SELECT Algorithm, Metric, CASE WHEN Algorithm = 'nb' THEN Score END AS Score, TRUE AS agrees, TRUE AS in_range FROM m, "
        "(SELECT unnest(['svm', 'lr', 'nb', 'rf']) AS Algorithm), LATERAL (SELECT unnest(['Recall', 'Precision', 'Accuracy', 'F1']) AS Metric, "
        "unnest([recall, precision, accuracy, f1]) AS Score)"),
    "describe_strings": _describe_strings(),
    "null_edge_clean": rounded(wn() + f"SELECT * {AS_TEXT} FROM cleaned", ["length"]),
    "null_edge_phase": rounded(wn() + f"""SELECT * {AS_TEXT}, CAST(SUM(CASE WHEN page = {q(CANCEL_PAGE)} THEN 1 ELSE 0 END)
        OVER (PARTITION BY userId ORDER BY ts NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS churn_phase
        FROM cleaned""", ["length"]),
    "null_edge_weights": rounded(wn() + """SELECT userId, gender, churn,
        0.5 / COUNT(*) OVER (PARTITION BY gender, CASE WHEN churn = 0 THEN 0 ELSE 1 END) AS weightCol FROM cleaned""", ["weightCol"]),
    "null_edge_histogram": rounded(_hist_auto("vals AS (SELECT gender, itemInSession FROM cleaned)", "itemInSession", ["gender"], 10,
                                              False, wn), ["bin_lo", "bin_hi"]),
    "null_edge_users": rounded(wn(f"sess AS (SELECT userId, {minutes('MAX(ts) - MIN(ts)')} AS len FROM cleaned GROUP BY userId, sessionId)",
                                  "sl AS (SELECT userId, AVG(len) AS avg_sess_len FROM sess GROUP BY userId)")
                               + f"""SELECT userId, AVG(itemInSession) AS avg_items_p_sess, {days('MAX(ts) - MIN(ts)')} AS acc_age,
                                    ANY_VALUE(avg_sess_len) AS avg_sess_len FROM cleaned JOIN sl USING (userId) GROUP BY userId""",
                               ["avg_items_p_sess", "avg_sess_len"]),
    "null_edge_genders": wn() + GENDERS,
    "clean_job": rounded(w() + "SELECT * FROM cleaned", ["length"]),
    "feature_job": rounded(w(FEATS) + f"""SELECT *, {SPLIT} AS split,
        0.5 / COUNT(*) OVER (PARTITION BY {SPLIT}, CASE WHEN churn = 0 THEN 0 ELSE 1 END) AS weightCol FROM feats""",
                           ["avg_sess_p_day", "avg_length", "avg_items_p_sess", "avg_sess_len", "weightCol", *PAGE_COLS]),
    "random_split": w(FEATS) + "SELECT userId, churn, CAST(1 AS BIGINT) AS times, TRUE AS same_again FROM feats",
    "ordered_shares": "SELECT *, TRUE AS in_order FROM (" + _share("hour", "churn = 0") + ")",
    "ordered_sessions": w() + "SELECT DISTINCT userId, sessionId, TRUE AS in_order FROM cleaned",
}

