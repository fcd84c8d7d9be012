"""Secret scan: fixed credential patterns plus guess-cost dynamic programming.

The base kinds (assignments, access keys, long hex runs) are regular
expressions. Beyond them, values in a wider credential context (``pwd:``,
``Authorization: Bearer``, ``passphrase is``, ...) are scored like a password
meter: a dynamic program finds the cheapest segmentation of the value into
dictionary words, dates, repeats, keyboard or alphabet walks and brute-force
spans, in log2 guesses. Values that stay expensive under the best attack look
generated and are reported as kind ``guess``; prose after such a word is cheap
and is not.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import ship

KINDS = ("assign", "access", "hex", "guess")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
#: log2 guesses from which a value in credential context counts as a secret
MIN_BITS = 40.0
#: longest word looked up, and how near its start and its end a run of repeats may be left for another span
WORD, EDGE = 24, 40

# fixed values: the base patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_STEMS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_MAP = bytes(1 if c in b"0123456789abcdef" else 0 for c in range(256))
_HEX_RUN = bytes([1]) * HEX_MIN

# wider credential contexts; the value is quoted, with blanks or not, or one run without blanks
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(pass(?:word|wd|phrase|code)?|pwd|pin|secret(?:_?key)?|credentials?|auth(?:orization|_?token)?|bearer"""
    r"""|(?:access|private|client|session|encryption)[_-]?(?:key|secret|token)|api[_-]?key|token|(?<![_-])key)["']?"""
    r"""(?:[\x20\t]*(?:[:=]|:=|=>|[\x20\t]is[\x20\t])[\x20\t]*(?:bearer[\x20\t]+|basic[\x20\t]+)?|[\x20\t]+(?:bearer|basic)[\x20\t]+)"""
    r"""(?:"([^"\r\n]{6,})"|'([^'\r\n]{6,})'|["']?([^\s"'<>,;]{6,}))""", re.IGNORECASE | re.ASCII)
#: the body of a private key in PEM form
PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----\s*+([A-Za-z0-9+/=\s]{32,}+)")
_URL = re.compile(r"[a-z][a-z0-9+.-]*://[^@]*\Z", re.IGNORECASE)
_CONTEXT_STEMS = ("pass", "pwd", "pin", "secret", "credential", "auth", "bearer", "key", "token")

#: rows of common keyboards and the alphabet, walked in either direction (fixed values)
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop", "1234567890", "abcdefghijklmnopqrstuvwxyz",
         "1qaz2wsx3edc4rfv5tgb6yhn7ujm")
#: frequent passwords and their parts (fixed values); list place is the guess rank
COMMON = ("password", "admin", "welcome", "letmein", "login", "secret", "changeme", "default", "master", "dragon", "monkey", "sunshine",
          "princess", "football", "baseball", "shadow", "iloveyou", "trustno", "hello", "freedom", "whatever", "test", "guest", "root",
          "user", "example", "your", "here", "token", "value", "none", "null", "true", "false", "string", "redacted", "hidden", "placeholder")
_LEET = str.maketrans("@4310$5!7", "aaeiossit")
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")


@functools.cache
def ranks(words: str | None) -> dict[str, int]:
    """Guess rank of every dictionary word: the common list, then the letter
    tokens (3 or more letters) of the tokenizer file ``words`` in id order, as
    byte-pair ids follow frequency. None: the common list only."""
    out = {w: i + 1 for i, w in enumerate(COMMON)}
    if words:
        with open(words, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        for token, i in sorted(vocab.items(), key=lambda x: x[1]):
            w = token.lstrip("Ġ").lower()
            if len(w) >= 3 and w.isascii() and w.isalpha():
                out.setdefault(w, len(COMMON) + i + 1)
    return out


def _alphabet(value: str) -> float:
    kinds = ((r"[a-z]", 26), (r"[A-Z]", 26), (r"[0-9]", 10), (r"[^A-Za-z0-9]", 33))
    return math.log2(sum(n for p, n in kinds if re.search(p, value)) or 2)


def guess_bits(value: str, words: str | None = None, enough: float = math.inf) -> float:
    """log2 of the guesses the cheapest segmentation of ``value`` takes, or
    some number from ``enough`` on if it takes at least that many.

    Spans: dictionary words (rank, doubled for capitals or substitutions),
    dates (2^15), repeats of a unit (the unit's characters times the count),
    keyboard or alphabet walks (2^6 times the length), and single brute-force
    characters (the value's alphabet; hexadecimal values use 16). Each further
    span costs one bit. The whole value is one program, whatever its length;
    its work is linear: a run of repeats is left within EDGE characters of
    its start or end only (another span that begins further inside costs more
    than the run), and it stops once every way has cost ``enough``."""
    n, low, rank = len(value), value.lower(), ranks(words)
    plain = low.translate(_LEET)
    brute = 4.0 if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) else _alphabet(value)
    best = [0.0] + [math.inf] * n
    equal = {}  # unit -> how many characters from each on equal the one a unit later
    for unit in (1, 2, 3, 4):
        same = [0] * (n + 1)
        for i in range(n - unit - 1, -1, -1):
            same[i] = same[i + 1] + 1 if value[i] == value[i + unit] else 0
        equal[unit] = same
    far = 0  # the furthest place reached
    for i in range(n):
        here = best[i]
        if i % 64 == 63 and min(best[i:far + 1]) >= enough:
            return min(best[i:far + 1])

        def reach(j: int, bits: float, here: float = here) -> None:
            nonlocal far
            best[j] = min(best[j], here + bits)
            far = max(far, j)

        reach(i + 1, brute)
        for j in range(i + 3, min(n, i + WORD) + 1):
            if r := rank.get(low[i:j]):
                reach(j, math.log2(r) + 1 + (value[i:j] != low[i:j]))
            elif r := rank.get(plain[i:j]):
                reach(j, math.log2(r) + 2 + (value[i:j] != low[i:j]))
        if m := _DATE.match(value, i):
            reach(m.end(), 15.0)
        for unit in (1, 2, 3, 4):
            most = equal[unit][i] // unit + 1  # whole units from here
            least = max(2, -(-3 // unit))
            near = EDGE // unit
            for times in (*range(least, min(most, near) + 1), *range(max(least, near + 1, most - near), most + 1)):
                reach(i + unit * times, unit * brute + math.log2(times) + 1)
        for row in WALKS:
            for line in (row, row[::-1]):
                at = line.find(low[i])
                if at >= 0:
                    k = 1
                    while i + k < n and at + k < len(line) and line[at + k] == low[i + k]:
                        k += 1
                    for length in range(3, k + 1):
                        reach(i + length, 6.0 + math.log2(length))
    return best[n]


def _outside(start: int, end: int, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The pieces of ``start`` to ``end`` that no base span covers."""
    out = []
    for s, e in sorted((s, e) for _, s, e in base if s < end and start < e):
        if start < s:
            out.append((start, s))
        start = max(start, e)
    return out + [(start, end)] if start < end else out


def _costly(name: str, value: str, words: str | None, min_bits: float) -> bool:
    """Whether a value in credential context looks generated. One with blanks
    does by its costliest word, as prose of many words is dear in sum; what
    a bare ``key`` names must hold letters and digits; an address without
    user part is none."""
    if _URL.match(value) or name.lower() == "key" and not (re.search(r"[0-9]", value) and re.search(r"[A-Za-z]", value)):
        return False
    return any(len(v) >= 6 and guess_bits(v, words, min_bits) >= min_bits for v in value.split())


def spans(text: str | None, words: str | None = None, min_bits: float = MIN_BITS) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start, then kind
    as listed. Null and empty texts have none. Base kinds: leftmost
    non-overlapping matches per kind, too short ones dropped. ``guess`` spans
    are values in credential context that cost ``min_bits`` or more, scored
    whole (quoted ones with blanks by their costliest word), and the bodies of
    private keys; of a value that base spans cover in part, the pieces outside
    them."""
    if not text:
        return []
    found = []
    low = text.lower()
    linked = ":" in text or "=" in text
    if linked and any(s in low for s in _ASSIGN_STEMS) or not low.isascii() and linked:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if _HEX_RUN in text.encode("utf-8", "replace").translate(_HEX_MAP):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = list(found)
    if (linked or " is " in low or "\t" in low or "bearer" in low or "basic" in low) and any(s in low for s in _CONTEXT_STEMS):
        for m in CONTEXT.finditer(text):
            at = next(i for i in (2, 3, 4) if m[i] is not None)
            value = m[at].rstrip(".,:!?)]}") if at == 4 else m[at].strip()
            start = m.start(at) + (len(m[at]) - len(m[at].lstrip()) if at < 4 else 0)
            left = _outside(start, start + len(value), base) if len(value) >= 6 else []
            if left and _costly(m[1], value, words, min_bits):
                found += [("guess", s, e) for s, e in left]
    if "PRIVATE KEY-----" in text:
        held = list(found)
        for m in PEM.finditer(text):
            body = m[1].rstrip()
            if guess_bits(body, words, min_bits) >= min_bits:
                found += [("guess", s, e) for s, e in _outside(m.start(1), m.start(1) + len(body), held)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def redact(text: str | None, found: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlapping ones joined) replaced by ``mark``."""
    if not found:
        return text
    out, at, end = [], 0, -1
    for _, s, e in sorted(found, key=lambda x: x[1:]):
        if s > end:
            if end >= 0:
                at = end
            out += [text[at:s], mark]
        end = max(end, e)
    out.append(text[end:])
    return "".join(out)


def scan(docs: DataFrame, words: str | None = None, min_bits: float = MIN_BITS) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256 (digest
    of the base spans), spans (all spans as kind:start:end), n_guess.

    ``words`` is the path of a tokenizer file on every executor (see
    ``ranks``). Null texts count as empty; null and repeated ids are returned
    as given; other columns are ignored; an empty table gives an empty result."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for text in f["text"]:
                got = spans(text, words, min_bits)
                kinds = [g[0] for g in got]
                base = listed([g for g in got if g[0] != "guess"])
                rows.append((*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(base.encode()).hexdigest(), listed(got), kinds.count("guess")))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])
            out.insert(0, "doc_id", f["doc_id"].to_numpy())
            yield out

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long")


def redacted(text: Column, words: str | None = None, min_bits: float = MIN_BITS) -> Column:
    """The text column with all secrets masked (null stays null)."""
    ship(SparkSession.active())

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, spans(t, words, min_bits)) for t in texts], dtype=object)

    return run(text)


