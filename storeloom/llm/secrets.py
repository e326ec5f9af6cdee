"""Secret scan: fixed patterns, and a battery of randomness tests on long unbroken strings.

Runs of the characters of the usual encodings are split at '=' unless it is padding at the end, so that the value of
NAME=value is tested by itself. If no alphabet holds a part, it is split at '-' and '_' and, once more, at '+' and '/';
of strings that lie within each other and are both random the longest is reported. For every string of at least
MIN_LENGTH characters the smallest alphabet that holds it is taken as its encoding. Three tests ask whether its symbols could be drawn evenly and independently from that
alphabet: chi-squared uniformity (of symbols and of character classes), the number of runs above and below the
middle of the alphabet, and serial correlation of neighbours. Fisher's method joins them into one p value, which
is uniform for a random string and near zero for words or names. How many strings are truly random is estimated from
the corpus for each encoding and length band (a short string gives the tests less power, so each length band has
its own threshold): the lowest threshold is taken at which the estimated share of false discoveries stays within
``false_share``. Strings count once, however many copies there are. Bands of few strings are judged together. A
candidate within a fixed pattern's match is left out.

Defined cases: null text is empty; an empty text has no spans. Offsets count code points, ends are exclusive.
Repeated rows get equal results, other columns are kept. Hot strings only add to counts.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.texts import map_texts
from storeloom.scratch import stage

# Fixed by the output contract: patterns, least sizes and the order of kinds.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")

MIN_LENGTH = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
PART = re.compile(r"[^=]+(?:=+\Z)?")
# Alphabets hold the one or the other pair of signs.
ONE_ALPHABET = (re.compile(r"[^_-]+"), re.compile(r"[^+/]+"))
BINS = 64
SPARSE = 500  # distinct strings below which a band gives no estimate of its own
SPARSE_LEAST = 4  # lowest bin that a sparse band may accept: words and names lie below it
_LOWER, _UPPER, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "upper_hex": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "upper_base36": _DIGITS + _UPPER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_SETS = {name: frozenset(letters) for name, letters in ALPHABETS.items()}
_PLACE = {name: {c: i for i, c in enumerate(letters)} for name, letters in ALPHABETS.items()}


def _class(c: str) -> int:
    return 0 if c in _LOWER else 1 if c in _UPPER else 2 if c in _DIGITS else 3


_SHARES = {name: [sum(_class(c) == k for c in letters) / len(letters) for k in range(4)]
           for name, letters in ALPHABETS.items()}


def encoding_of(text: str) -> str | None:
    """The smallest alphabet that holds the string, padding aside."""
    used = frozenset(text.rstrip("="))
    return next((name for name in ALPHABETS if used and used <= _SETS[name]), None)


def candidates(text: str) -> Iterator[tuple[int, str, str]]:
    """(start, string, encoding) of the strings to test."""
    for m in CANDIDATE.finditer(text):
        for part in PART.finditer(m[0]):
            at, encoding = m.start() + part.start(), encoding_of(part[0])
            if encoding is not None:
                found = [(at, part[0], encoding)]
            else:
                found = [(at + x.start(), x[0], encoding_of(x[0])) for signs in ONE_ALPHABET for x in signs.finditer(part[0])]
            yield from (x for x in found if len(x[1]) >= MIN_LENGTH and x[2] is not None)


def _upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi_tail(x: float, df: float) -> float:
    """Upper tail of chi-squared by the cube root approximation."""
    if df <= 0:
        return 1.0
    return _upper_tail(((max(x, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def randomness(text: str, encoding: str) -> float:
    """Joint p value of the battery; uniform on 0 to 1 for evenly drawn symbols."""
    symbols = text.rstrip("=")
    place, n, size = _PLACE[encoding], len(symbols), len(ALPHABETS[encoding])
    values = [place[c] for c in symbols]
    # Sparse tables: mean and variance of the statistic are exact, its tail is approximate.
    spread = sum(k * k for k in Counter(values).values()) * size / n - n
    scale = (n - 1) / n
    uniform = _chi_tail((size - 1) + (spread - (size - 1)) / math.sqrt(scale), size - 1)
    classes = Counter(map(_class, symbols))
    kinds = [(classes[k], share * n) for k, share in enumerate(_SHARES[encoding]) if share]
    by_class = _chi_tail(sum((o - e) ** 2 / e for o, e in kinds), len(kinds) - 1) if len(kinds) > 1 else 1.0
    chi = min(1.0, 2 * min(uniform, by_class)) if len(kinds) > 1 else uniform

    high = [2 * v >= size for v in values]
    up = sum(high)
    down = n - up
    if up and down:
        mean = 1 + 2 * up * down / n
        variance = max(1e-9, (mean - 1) * (mean - 2) / (n - 1))
        runs = math.erfc(abs(1 + sum(a != b for a, b in zip(high, high[1:], strict=False)) - mean) / math.sqrt(2 * variance))
    else:
        runs = 2.0 ** (1 - n)

    middle = sum(values) / n
    total = sum((v - middle) ** 2 for v in values)
    if total:
        r = sum((a - middle) * (b - middle) for a, b in zip(values, values[1:], strict=False)) / total
        serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    else:
        serial = 0.0
    half = -sum(math.log(max(p, 1e-300)) for p in (chi, runs, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' matches; kind is its place in KINDS."""
    spans = []
    low = raw.lower()
    if any(word in low for word in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def _band(length: int) -> int:
    return length.bit_length() * 2 + (length >> (length.bit_length() - 2) & 1)


SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("rank", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])
CHANCE = T.StructType([*SPAN.fields, T.StructField("encoding", T.StringType()), T.StructField("band", T.IntegerType()),
                       T.StructField("bin", T.IntegerType()), T.StructField("hash", T.LongType()),
                       T.StructField("within", T.IntegerType())])
ADDED = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("chances", T.ArrayType(CHANCE))])


def outside(found: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[bool]:
    """Whether each (start, end) lies within none of the (start, kind, end), which are in order of their start."""
    starts, reach = [s for s, _, _ in spans], list(accumulate((e for _, _, e in spans), max))
    return [not k or reach[k - 1] < end for k, end in ((bisect_right(starts, start), end) for start, end in found)]


def enclosing(found: list[tuple[int, int]]) -> list[int]:
    """Place of the longer (start, end) that holds each; -1 if none does. The strings of one split of a part are apart, so
    a string lies in at most one of the other split."""
    out, top = [-1] * len(found), -1
    for i in sorted(range(len(found)), key=lambda i: (found[i][0], -found[i][1])):
        start, end = found[i]
        if top >= 0 and found[top][1] >= end:
            if found[top][1] - found[top][0] > end - start:
                out[i] = top
        else:
            top = i
    return out


def _scan(parts: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
    for texts in parts:
        bases, chances = [], []
        for raw in texts:
            raw = raw or b""
            text = raw.decode("utf-8", "replace")
            base = base_spans(text, raw)
            tested = [(start, start + len(part), part, encoding) for start, part, encoding in candidates(text)]
            tested = [x for x, out in zip(tested, outside([x[:2] for x in tested], base), strict=True) if out]
            found = []
            for (start, end, part, encoding), within in zip(tested, enclosing([x[:2] for x in tested]), strict=True):
                p = randomness(part, encoding)
                found.append({"start": start, "rank": 3, "end": end, "encoding": encoding, "band": _band(len(part)),
                              "bin": min(BINS - 1, int(p * BINS)), "hash": xxhash.xxh3_64_intdigest(part) - (1 << 63),
                              "within": within})
            bases.append([{"start": s, "rank": k, "end": e} for s, k, e in base])
            chances.append(found)
        yield [bases, chances]


def _lowest(bins: dict[int, int], false_share: float, random: float) -> int:
    """The lowest bin from which on the share of false discoveries stays within bounds; ``random`` strings are in the top quarter."""
    per_bin, accepted, least = random / (BINS // 4), 0, BINS
    for b in range(BINS - 1, -1, -1):
        accepted += bins.get(b, 0)
        if accepted and accepted - per_bin * (BINS - b) <= false_share * accepted:
            least = b
    return least


def thresholds(histogram: dict[tuple[str, int], dict[int, int]], false_share: float = 0.05) -> dict[tuple[str, int], int]:
    """Lowest accepted bin of each encoding and length band, from its numbers of distinct strings; BINS accepts none.

    Random strings spread evenly over the bins, so the top quarter tells how many there are; what a range of bins
    holds beyond its even share are false discoveries. Bands of fewer than SPARSE strings share one threshold, taken
    from all of them; there the number of random strings is its upper 95 % bound, since few strings or even one may
    all lie below the top quarter, and bins below SPARSE_LEAST stay out.
    """
    out, pool, sparse = {}, Counter(), []
    for key, bins in histogram.items():
        if sum(bins.values()) < SPARSE:
            pool.update(bins)
            sparse.append(key)
        else:
            out[key] = _lowest(bins, false_share, sum(bins.get(b, 0) for b in range(BINS - BINS // 4, BINS)))
    top = sum(pool[b] for b in range(BINS - BINS // 4, BINS))
    # Upper bound of a Poisson mean, by the cube root approximation; 3.0 for no string seen.
    bound = (top + 1) * (1 - 1 / (9 * (top + 1)) + 1.645 / (3 * math.sqrt(top + 1))) ** 3
    shared = max(SPARSE_LEAST, _lowest(pool, false_share, bound))
    return out | dict.fromkeys(sparse, shared)


def scan(documents: DataFrame, text: Column, false_share: float = 0.05, keep: tuple[str, ...] | None = None) -> DataFrame:
    """All rows (with all columns or those to keep) in struct ``row`` with ``found``: spans (start, rank, end) of all kinds in order; rank is the place in
    KINDS. The statistics of the tests cover all documents."""
    scanned = stage(map_texts(documents, text, ADDED, _scan, keep=keep), "secret-spans")
    strings = scanned.select(F.explode("chances").alias("c")).select("c.encoding", "c.band", "c.bin", "c.hash").distinct()
    counted = strings.groupBy("encoding", "band", "bin").count().collect()
    histogram: dict[tuple[str, int], dict[int, int]] = {}
    for r in counted:
        histogram.setdefault((r["encoding"], r["band"]), {})[r["bin"]] = r["count"]

    def is_secret(x: Column) -> Column:
        verdict = F.lit(False)
        for (encoding, band), least in thresholds(histogram, false_share).items():
            if least < BINS:
                verdict = verdict | ((x["encoding"] == encoding) & (x["band"] == band) & (x["bin"] >= least))
        return verdict

    random = F.filter("chances", lambda x: is_secret(x) & ~F.coalesce(is_secret(F.get("chances", x["within"])), F.lit(False)))
    spans = F.transform(random, lambda x: F.struct(x["start"], x["rank"], x["end"])).cast(T.ArrayType(SPAN))
    return scanned.select("row", F.sort_array(F.concat("base", spans)).alias("found"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
