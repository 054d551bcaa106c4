"""Token counts of whole texts under a byte-level BPE vocabulary, mostly without merging.

A text falls into pre-tokens (words with their leading space, numbers, runs of
signs or of white space), and each is merged for itself. Most vocabulary strings
encode alone as one token, but not all: merges are applied by rank, so a string
can be in the vocabulary and still never be reached. ``prove`` therefore runs the
merges over every vocabulary string once, on the driver, and keeps those that end
as one token. In the tasks a pre-token among them counts 1 by a look into that
table, without any merge; only the rest is merged, by a queue of pairs in order of
rank and place, and remembered.

The file is read and proven on the driver and sent to the tasks as one broadcast,
whose size is that of the vocabulary, not of the data. Rows stay where they are:
there is no shuffle. A task remembers at most two generations of ``KNOWN``
pre-tokens of up to ``LONGEST`` characters; a longer one is merged where it stands.

Defined results: a null or empty text has 0 bytes and 0 tokens and is not over
the limit; rows are counted one by one, so repeated rows repeat their result; a
null id stays null; texts of any length are counted whole; the strings of added
(special) tokens inside a text count as one token each and end the pre-token
before them, as in the library; an empty table gives an empty table. Other
columns stay as they are, except that columns named n_bytes, n_tokens or
over_limit are replaced.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from churnlens.llm.text import in_small_batches

LIMIT = 1024
#: Pre-tokens in each of the two generations that a task remembers, beside the whole tokens.
KNOWN = 200_000
LONGEST = 64
#: Texts of more characters are walked match by match instead of as one list.
LONG_TEXT = 1 << 20
#: The pre-tokens of byte-level BPE, in order of precedence (fixed values), over the classes of
#: letters, numbers and white space.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d"
             r"| ?{L}+| ?{N}+| ?[^{W}{L}{N}]+"
             r"|{W}+(?![^{W}])|{W}+")
CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "W": r"\p{White_Space}"}
#: The same classes in the words of the library's own patterns.
LIBRARY_CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "W": r"\s"}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the file: printable Latin-1 characters for
    themselves, the other bytes in order for the code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _pattern(classes: dict[str, str]) -> str:
    out = PRE_TOKEN
    for name, c in classes.items():
        out = out.replace("{" + name + "}", c)
    return out


def _ranges(points: str) -> str:
    """A set of code points, as the inside of a character class."""
    out: list[list[int]] = []
    for c in sorted(map(ord, points)):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in out)


def class_differences() -> dict[str, tuple[str, str]]:
    """Per class the code points that ``regex`` has and the library has not, and the other way
    round: the two follow different versions of Unicode. The library itself is asked, by
    letting it delete its class from all the code points of ours and of the rest."""
    from tokenizers import Regex, normalizers

    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = {}
    for name, ours in CLASSES.items():
        theirs = normalizers.Replace(Regex(f"[{LIBRARY_CLASSES[name]}]"), "")
        mine = "".join(regex.findall(ours, points))
        rest = "".join(regex.findall(f"[^{ours}]", points))
        out[name] = theirs.normalize_str(mine), "".join(set(rest) - set(theirs.normalize_str(rest)))
    return out


class PreTokens:
    """Splits text into pre-tokens as the library does."""

    def __init__(self, differences: dict[str, tuple[str, str]]):
        odd = "".join(a + b for a, b in differences.values())
        exact = {name: (f"[{CLASSES[name]}" + (f"--[{_ranges(gone)}]" if gone else "") + "]")
                 if not more else f"[[{CLASSES[name]}" + (f"--[{_ranges(gone)}]" if gone else "") + f"]||[{_ranges(more)}]]"
                 for name, (gone, more) in differences.items()}
        self.patterns = _pattern(CLASSES), "(?V1)" + _pattern(exact), f"[{_ranges(odd)}]" if odd else None
        self._compile()

    def _compile(self):
        plain, exact, odd = self.patterns
        self.plain, self.exact = regex.compile(plain), regex.compile(exact)
        self.odd = regex.compile(odd) if odd else None

    def __getstate__(self):
        return self.patterns

    def __setstate__(self, patterns):
        self.patterns = patterns
        self._compile()

    def of(self, text: str) -> regex.Pattern:
        """The pattern for a text: the plain one unless a code point of it differs."""
        return self.exact if self.odd and self.odd.search(text) else self.plain


class Merges:
    """The merges of a vocabulary, over strings of byte letters."""

    def __init__(self, merges: list[tuple[str, str]]):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.letters = byte_letters()

    def spell(self, s: str) -> list[str]:
        return [self.letters[b] for b in s.encode()]

    def count(self, parts: list[str]) -> int:
        """Symbols left when no pair can be merged: the pair of lowest rank goes first, of
        equal pairs the leftmost. Pairs wait in a queue; one whose symbols have changed is
        passed over."""
        parts, n = list(parts), len(parts)
        rank, left = self.rank, list(range(-1, n - 1))
        right = list(range(1, n + 1))
        queue = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank.get((a, b))) is not None]
        heapq.heapify(queue)
        count = n
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j], right[i] = a + b, "", right[j]
            count -= 1
            if right[i] < n:
                left[right[i]] = i
                after = parts[right[i]]
                if (r := rank.get((a + b, after))) is not None:
                    heapq.heappush(queue, (r, i, a + b, after))
            if left[i] >= 0:
                before = parts[left[i]]
                if (r := rank.get((before, a + b))) is not None:
                    heapq.heappush(queue, (r, left[i], before, a + b))
        return count


class Vocabulary:
    """A byte-level BPE vocabulary with its proven whole tokens."""

    def __init__(self, tokens: list[str], merges: list[tuple[str, str]], added: list[str]):
        self.pre_tokens = PreTokens(class_differences())
        self.merges = Merges(merges)
        self.added = added
        self.whole = self.prove(tokens)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            d = json.load(f)
        model, pre = d["model"], d["pre_tokenizer"] or {}
        odd = [k for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback", "ignore_merges")
               if model.get(k)]
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or d["normalizer"] or odd \
                or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        added = d["added_tokens"]
        if any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path} has added tokens that match more than their own string")
        missing = set(byte_letters()) - set(model["vocab"])
        if missing:
            raise ValueError(f"{path} has no token for {len(missing)} bytes")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(list(model["vocab"]), merges, [a["content"] for a in added])

    def prove(self, tokens: list[str]) -> dict[str, int]:
        """The texts of the vocabulary strings that the merges bring back to one token."""
        byte_of = {c: b for b, c in enumerate(self.merges.letters)}
        whole = {}
        for token in tokens:
            if self.merges.count(list(token)) == 1:
                try:
                    whole[bytes(byte_of[c] for c in token).decode()] = 1
                except UnicodeDecodeError:  # a part of a character is never a pre-token
                    pass
        return whole


class Counter(dict):
    """Tokens of pre-tokens: the whole ones, and those merged so far."""

    def __init__(self, vocabulary: Vocabulary, known: int = KNOWN):
        super().__init__(vocabulary.whole)
        self.vocabulary, self.known, self.older = vocabulary, known, {}
        longest_first = sorted(vocabulary.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None

    def __missing__(self, s: str) -> int:
        merges = self.vocabulary.merges
        n = self.older.get(s) or merges.count(merges.spell(s))
        if len(s) <= LONGEST:
            if len(self) >= len(self.vocabulary.whole) + self.known:
                self.older = dict(self)
                self.clear()
                self.update(self.vocabulary.whole)
            self[s] = n
        return n

    def of(self, text: str | None) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        parts = self.added.split(text) if self.added else [text]
        total, get = len(parts) - 1, self.__getitem__
        pattern = self.vocabulary.pre_tokens.of(text)
        for part in parts:
            if len(part) > LONG_TEXT:
                total += sum(get(m.group()) for m in pattern.finditer(part))
            else:
                total += sum(map(get, pattern.findall(part)))
        return total


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    return Vocabulary.read(path)


#: The counter of this Python worker's last task: what it remembers serves the next one.
_last: list[Counter] = []


def _counter_of_worker(vocabulary: Vocabulary) -> Counter:
    if not _last or _last[0].vocabulary is not vocabulary:
        _last[:] = [Counter(vocabulary)]
    return _last[0]


def count_tokens(docs: DataFrame, text: str = "text", *, vocabulary: str | None = None,
                 limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of the
    whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary or default_vocabulary()))

    @pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter_of_worker(shared.value)
        for texts in batches:
            yield pd.Series([counter.of(t) for t in texts], dtype="int64")

    new = ("n_bytes", "n_tokens", "over_limit")
    body = F.col(f"`{text}`")
    counted = in_small_batches(docs).select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new],
        F.coalesce(F.octet_length(body), F.lit(0)).cast("long").alias("n_bytes"),
        tokens(body).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
