"""URL filters: glob rules simulated together by a bit-parallel Shift-And automaton.

Every glob is a small non-deterministic automaton: one bit per state, the bits
of all globs packed behind each other into a few 64-bit words. Reading one
character moves all globs at once::

    D = (shift(D) & MOVE[c]) | (D & STAY[c])

where ``MOVE[c]`` has the states that ``c`` enters and ``STAY[c]`` the states
under a wildcard that ``c`` keeps alive. A batch of URLs runs side by side
in numpy, one step per character position, URLs that have ended dropping out.

Glob language over the canonical URL (host + path): ``**`` any characters,
``*`` any characters but ``/``, ``?`` one character but ``/``; everything else
stands for itself. The whole URL must match.

Defined results: a null URL or one without ``://`` has empty host and path,
matches no rule and gets the default verdict; very long URLs are read whole;
repeated rows get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from churnlens.llm.text import lower_az

#: (verdict, host and path prefix): fits the host and its subdomains; the longest wins.
HOST_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
#: (verdict, glob) for URLs that no host rule fits; the glob with most literal
#: characters wins, then block before allow, then the earlier.
GLOBS = (
    ("block", "m.*/**"),
    ("block", "amp.*/**"),
    ("block", "ads?.*/**"),
    ("block", "**/wp-admin/**"),
    ("block", "**/wp-login.php"),
    ("block", "**/cgi-bin/**"),
    ("block", "**/login"),
    ("block", "**/cart/**"),
    ("block", "**.zip"),
    ("block", "**.exe"),
    ("allow", "m.*.org/*/?"),
    ("allow", "m.*.org/*/??"),
)
DEFAULT = "allow"


class ShiftAnd:
    """All globs packed into multiword masks; ``match`` runs a batch of strings."""

    def __init__(self, globs: Sequence[str]):
        self.n = len(globs)
        moves: list[str | None] = []  # per state: what enters it; None: a start state
        loops: list[str] = []  # per state: "", "*" or "**"
        start, accept = [], []
        for glob in globs:
            start.append(len(moves))
            moves.append(None)
            loops.append("")
            for part in re.findall(r"\*\*|\*|.", glob, re.S):
                if part in ("*", "**"):
                    loops[-1] = max(loops[-1], part)
                else:
                    moves.append(part)
                    loops.append("")
            accept.append(len(moves) - 1)
        alphabet = sorted({m for m in moves if m not in (None, "?")} | {"/"})
        self.words = max(1, -(-len(moves) // 64))
        self.accept = np.array(accept)
        classes = ["", *alphabet]  # class 0: any character that no glob names
        self.move = np.zeros((len(classes), self.words), np.uint64)
        self.stay = np.zeros_like(self.move)
        self.first = np.zeros(self.words, np.uint64)
        for s in start:
            self.first[s // 64] |= np.uint64(1 << s % 64)
        for s, (enters, loop) in enumerate(zip(moves, loops)):
            bit = np.uint64(1 << s % 64)
            for k, c in enumerate(classes):
                if enters is not None and (enters == c or enters == "?" and c != "/"):
                    self.move[k, s // 64] |= bit
                if loop == "**" or loop == "*" and c != "/":
                    self.stay[k, s // 64] |= bit
        self.of_char = np.zeros(max(map(ord, alphabet)) + 2, np.intp)  # the last one: class 0
        for k, c in enumerate(alphabet, 1):
            self.of_char[ord(c)] = k

    def match(self, strings: Sequence[str]) -> np.ndarray:
        """Booleans (string, glob)."""
        out = np.zeros((len(strings), self.n), bool)
        if not len(strings) or not self.n:
            return out
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        order = np.argsort(-lengths, kind="stable")
        codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = self.of_char[np.minimum(codes, len(self.of_char) - 1)]
        begin = (np.cumsum(lengths) - lengths)[order]
        ends = lengths[order]
        state = np.repeat(self.first[None, :], len(strings), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        running = len(strings)
        for at in range(int(ends[0]) if running else 0):
            running = int(np.searchsorted(-ends[:running], -at, "left"))  # those longer than at
            c = codes[begin[:running] + at]
            now = state[:running]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:running] = (moved & self.move[c]) | (now & self.stay[c])
        out[order] = (state[:, self.accept // 64] >> (self.accept % 64).astype(np.uint64)) & one
        return out


def _host_globs(rule: str) -> tuple[str, str]:
    return f"{rule}**", f"*.{rule}**"


def host_and_path(url):
    """Columns (host, path) of a URL column; both empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)
    found = F.coalesce(at > 0, F.lit(False))
    return (F.when(found, lower_az(raw)).otherwise(F.lit("")),
            F.when(found, path).otherwise(F.lit("")))


def judge_urls(pages: DataFrame, url: str = "url", *,
               host_rules: Sequence[tuple[str, str]] = HOST_RULES,
               globs: Sequence[tuple[str, str]] = GLOBS, default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule, glob and verdict of every URL (columns of
    those names are replaced). The rules are part of the call: their masks
    have (total rule length) bits per character class, whatever the table's size."""
    automaton = ShiftAnd([g for _, r in host_rules for g in _host_globs(r)] + [g for _, g in globs])
    by_length = sorted(range(len(host_rules)), key=lambda i: (-len(host_rules[i][1]), i))
    by_weight = sorted(range(len(globs)), key=lambda i: (-len(re.sub(r"[*?]", "", globs[i][1])),
                                                        globs[i][0] != "block", i))
    n = 2 * len(host_rules)

    @pandas_udf("rule string, glob string, verdict string")
    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            hits = automaton.match(urls.tolist())
            rule = np.full(len(urls), None, object)
            glob = np.full(len(urls), None, object)
            verdict = np.full(len(urls), default, object)
            for i in reversed(by_weight):
                fit = hits[:, n + i]
                verdict[fit], glob[fit] = globs[i]
            for i in reversed(by_length):
                fit = hits[:, 2 * i] | hits[:, 2 * i + 1]
                verdict[fit], rule[fit] = host_rules[i]
            yield pd.DataFrame({"rule": rule, "glob": glob, "verdict": verdict})

    host, path = host_and_path(F.col(url))
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "glob", "verdict")]
    return (pages.select(*keep, host.alias("host"), path.alias("path"))
            .withColumn("__v", verdicts(F.concat("host", "path")))
            .select(*keep, "host", "path", "__v.rule", "__v.glob", "__v.verdict"))


def op1_url_filters(spark, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).drop("url")


def _regex(glob: str) -> str:
    parts = {"**": ".*", "*": "[^/]*", "?": "[^/]"}
    return "".join(parts.get(p, re.sub(r"([.+()\[\]{}|^$\\])", r"\\\1", p))
                   for p in re.findall(r"\*\*|\*|.", glob))


def _glob_sql() -> str:
    ranked = sorted(GLOBS, key=lambda g: (-len(re.sub(r"[*?]", "", g[1])), g[0] != "block"))
    return " ".join(f"WHEN regexp_full_match(host || path, '{_regex(g)}', 's') THEN '{g}'" for _, g in ranked)


OP1_SQL = f"""
WITH p AS (SELECT page_id, coalesce(strpos(url, '://'), 0) AS pos, url FROM pages),
r AS (SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM p),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
u AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
v AS (SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
      CASE {_glob_sql()} END AS "glob" FROM u)
SELECT page_id, host, path, rule, "glob",
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN "glob" IN ('m.*.org/*/?', 'm.*.org/*/??') THEN 'allow' WHEN "glob" IS NOT NULL THEN 'block'
            ELSE 'allow' END AS verdict
FROM v
"""
