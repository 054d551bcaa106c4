"""Quality rules with host-level verdicts.

Each document is judged by simple rules over its whole text; the failures are
aggregated by host (the ``source`` of ``documents``) and each host's failure rate
is shrunk towards the corpus by a beta prior fitted to the hosts (empirical
Bayes, method of moments). A host with few documents stays near the corpus rate, so
one bad document does not condemn it. The shrunk rate is the prior chance that a
document of the host is bad; a document that fails a rule of its own multiplies the odds by
``RULE_ODDS``; it goes when the odds are above those of ``max_rate``. So a host whose rate exceeds
``max_rate`` loses all its documents, another one those that also fail a rule,
and a host that hardly ever fails keeps even these.

The rules run as one Arrow-batched function on the text column (one pass, no
shuffle of text). The host table is a partial aggregate, one row per task and
host, so a host that holds a third of all rows costs nothing extra; joining
the verdicts back is left to Spark, which broadcasts the host table when its
measured size allows.

Defined results: null and empty texts have no words and fail; texts of any length are judged as a
whole; a null host is a host of its own; repeated rows are judged alike and each counts; an
empty table gives an empty table. ``keep_good`` returns all columns as they were, whatever their
names; ``judge_documents`` adds columns that begin with two underscores and replaces such of
the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from churnlens.llm.text import WHITE, field, in_small_batches, packed, unpacked, words
from churnlens.operators.joins import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 0.25
#: Share of a text's lines (those with a word) that equal an earlier one.
MAX_DUP_LINE_SHARE = 0.5
#: Hosts whose shrunk failure rate is above this are rejected.
MAX_HOST_RATE = 0.5
#: How much more often bad documents than good ones fail a rule beyond base.
RULE_ODDS = 20.0
#: Bounds of the prior's strength (alpha + beta), in documents.
PRIOR_DOCS = (2.0, 1000.0)

SYMBOLS = "#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


def repeated_words(w: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice in the text."""
    grams = list(zip(w, w[1:], w[2:]))
    if len(set(grams)) == len(grams):
        return 0
    n = Counter(grams)
    hit = bytearray(len(w))
    for i, g in enumerate(grams):
        if n[g] > 1:
            hit[i] = hit[i + 1] = hit[i + 2] = 1
    return sum(hit)


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0, 0
    w = words(text)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (len(w), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(w), len(lines))


def _stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([text_stats(t) for t in texts],
                           columns=[c.split()[0] for c in STATS.split(", ")])


def with_rules(docs: DataFrame, text: str = "text", at: str = "__q") -> DataFrame:
    """``docs`` with a struct column: the counts, base_failed, rule_failed (one beyond base) and failed (any)."""
    q = F.col(at)
    base = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    more = ((q["n_symbols"] > MAX_SYMBOLS_PER_WORD * q["n_words"])
            | (q["n_dup_lines"] > MAX_DUP_LINE_SHARE * q["n_lines"]))
    return (in_small_batches(docs).withColumn(at, pandas_udf(_stats, STATS)(F.col(text)))
            .withColumn(at, q.withField("base_failed", base).withField("rule_failed", more).withField("failed", base | more)))


def host_rates(judged: DataFrame, host: str, failed) -> DataFrame:
    """One row per host: __host, __rate (shrunk failure rate).

    Prior: mean m = all failures / all documents; the variance of the hosts'
    rates beyond binomial noise, v, gives the strength m (1 - m) / v - 1, held
    within PRIOR_DOCS. The sums come from one row per host.
    """
    hosts = materialize(judged.groupBy(F.col(host).alias("__host"))
                        .agg(F.count(F.lit(1)).alias("__n"), F.sum(failed.cast("long")).alias("__k")), "hosts")
    total = hosts.agg(F.sum("__n").alias("n"), F.sum("__k").alias("k"), F.count(F.lit(1)).alias("h")).first()
    n, k, h = total["n"] or 0, total["k"] or 0, total["h"]
    mean = k / n if n else 0.0
    spread = hosts.agg(F.sum(F.col("__n") * F.pow(F.col("__k") / F.col("__n") - mean, 2))).first()[0] or 0.0
    between = (spread - mean * (1 - mean) * h) / n if n else 0.0
    low, high = PRIOR_DOCS
    strength = min(high, max(low, mean * (1 - mean) / between - 1)) if between > 0 else high
    rate = (F.col("__k") + F.lit(mean * strength)) / (F.col("__n") + F.lit(strength))
    return hosts.select("__host", rate.alias("__rate"))


def verdict(rate: Column, rule_failed: Column, max_rate: float = MAX_HOST_RATE) -> Column:
    """Whether a document that passes base stays, given its host's rate and its own rules."""
    odds = F.when(rule_failed, F.lit(RULE_ODDS)).otherwise(1.0) * rate * (1 - max_rate)
    return odds <= (1 - rate) * max_rate


def judge_documents(docs: DataFrame, text: str = "text", host: str = "source", *,
                    max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``docs`` with ``__q`` (counts, base_failed), ``__rate`` and ``__kept``.

    The text is read twice, once for the hosts and once for the verdicts; it is
    neither shuffled nor written.
    """
    judged = with_rules(docs, text)
    hosts = host_rates(judged, host, F.col("__q.failed"))
    return (judged.join(hosts, F.col(host).eqNullSafe(F.col("__host")), "left")
            .withColumn("__kept", ~F.col("__q.base_failed") & verdict(F.col("__rate"), F.col("__q.rule_failed"), max_rate)))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows that the rules and their host's verdict keep, columns unchanged, whatever their names.

    The rules run once: their verdicts are written with the rows and read again for the hosts'."""
    rows = packed(docs).withColumns({"text": field(docs, text), "host": field(docs, host)})
    judged = materialize(with_rules(rows, "text").select("row", "host", "__q.base_failed", "__q.rule_failed", "__q.failed"), "judged")
    hosts = host_rates(judged, "host", F.col("failed"))
    kept = judged.filter("NOT base_failed").join(hosts, F.col("host").eqNullSafe(F.col("__host")), "left")
    return unpacked(kept.filter(verdict(F.col("__rate"), F.col("rule_failed"))), docs)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    stats = materialize(with_rules(docs).select("doc_id", "source", "__q"), "rules")
    hosts = host_rates(stats, "source", F.col("__q.failed"))
    return (stats.join(hosts, F.col("source").eqNullSafe(F.col("__host")), "left")
            .select("doc_id", "__q.n_words", "__q.word_chars", "__q.n_symbols", "__q.n_dup_lines",
                    "__q.n_repeat_words", "__q.base_failed",
                    (~F.col("__q.base_failed") & verdict(F.col("__rate"), F.col("__q.rule_failed"))).alias("kept"),
                    "__q.rule_failed", F.round("__rate", 9).alias("host_rate")))


OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT r, gram FROM g GROUP BY ALL HAVING count(*) > 1),
hit AS (SELECT r, count(DISTINCT word) AS n FROM (SELECT r, i + unnest([0, 1, 2]) AS word FROM g JOIN twice USING (r, gram))
        GROUP BY r),
s AS (SELECT w.r, doc_id, source, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
             coalesce(hit.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN hit ON w.r = hit.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s),
f AS (SELECT *, base_failed OR rule_failed AS failed
      FROM (SELECT *, n_symbols > 0.25 * n_words OR n_dup_lines > 0.5 * n_lines AS rule_failed FROM b)),
h AS (SELECT source, count(*) AS n, sum(failed::INT) AS k FROM f GROUP BY source),
m AS (SELECT sum(n) AS n, count(*) AS hs, sum(k) / sum(n) AS mean FROM h),
v AS (SELECT mean, (sum(h.n * pow(k / h.n - mean, 2)) - mean * (1 - mean) * any_value(hs)) / any_value(m.n) AS extra
      FROM h, m GROUP BY mean),
p AS (SELECT mean, CASE WHEN extra > 0 THEN least(1000.0, greatest(2.0, mean * (1 - mean) / extra - 1))
                        ELSE 1000.0 END AS strength FROM v),
r AS (SELECT source, (k + mean * strength) / (n + strength) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND CASE WHEN rule_failed THEN 20 ELSE 1 END * rate * 0.5 <= (1 - rate) * 0.5 AS kept,
       rule_failed, round(rate, 9) AS host_rate
FROM f JOIN r ON r.source IS NOT DISTINCT FROM f.source
"""
