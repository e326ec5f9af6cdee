"""Filter audit, periodic runs and neighbour search against brute force on small tables with odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeloom.llm import adaptive_scan, filter_audit, periodic_runs, queries_audits

FULL = "doc_id long, text string, lang string, row string, part string, n long, good boolean, failed int, digest string"


def documents(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "r", "p", 3, True, 9, "d") for r in rows], FULL)


def failures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {c for c, bad in (("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
                             ("C", 100 * sum("A" <= x <= "Z" for x in text) > 3 * len(text)),
                             ("D", any(x in "#$%&*|" for x in text))) if bad}


def audited(docs, labels):
    """All steps of all orders by walking through them."""
    rows = []
    for i, text, lang in docs:
        smaller = [j for j, t, _ in docs if i is not None and j is not None and j < i and (t or "") == (text or "")]
        mine = [x for x in labels if x[0] == i and i is not None]
        rows.append((lang or "", failures(text or "") | ({"E"} if smaller else set()),
                     any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out = []
    for part in {r[0] for r in rows}:
        here, lines = [r for r in rows if r[0] == part], []
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, c in enumerate(order, 1):
                gone = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                lines.append([part, "".join(order), step, len(left), len(gone), sum(c in r[1] for r in here) - len(gone),
                              sum(r[1] == {c} for r in here), sum(r[2] for r in gone), sum(r[3] for r in gone), c])
        total = Counter()
        for line in lines:
            total[line[-1]] += line[4]
        out += [(*line[:-1], total[line[-1]]) for line in lines]
    return sorted(out)


def test_filter_audit(spark):
    rng = random.Random(3)
    vocabulary = [a + b for a in "abcdefgh" for b in "ijklmnop"] + ["Ä", "ß\x1c", "#x", "A|B", "ABC"]

    def text():
        return rng.choice([" ", "\n", "\x0b "]).join(rng.choices(vocabulary[:rng.choice([3, 64, 67, 69])], k=rng.choice([0, 3, 100, 199, 200, 320])))

    texts = [text() for _ in range(25)] + [None, "", " ", "É" * 33 + "A", "x " * 60_000]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [rows[3], rows[3], (3, "other", "en"), (None, rows[5][1], "en"), (None, rows[5][1], "en"), (-7, rows[9][1], "fr"), (999, None, "zz")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int, n int")
    got = filter_audit.audit(documents(spark, rows), frame)
    order = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.select(order).collect()) == audited(rows, labels)
    assert filter_audit.audit(documents(spark, rows).limit(0), frame).count() == 0
    assert filter_audit.audit(documents(spark, rows[:5]), frame.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 5000])
def test_positional_counts(size):
    rng = np.random.default_rng(size)
    words = rng.integers(0, 1 << 32, size, dtype=np.uint32)
    weights = np.where(rng.random(size) < 0.5, 1, rng.integers(1, 1 << 40, size))
    want = [(weights * ((words >> b) & 1)).sum() for b in range(32)]
    assert filter_audit.positional_counts(words, weights).tolist() == want


def test_a_word_holds_five_filters(spark):
    masks = spark.createDataFrame([("a", True, False, 0, 2)], "part string, good boolean, toxic boolean, failed int, n long")
    with pytest.raises(ValueError):
        filter_audit.subset_survivors(masks, 6)
    assert filter_audit.subset_survivors(masks, 2).where("n = 2 and n_good = 2 and n_toxic = 0").count() == 4


def slow_runs(words, least):
    """All maximal stretches by their smallest period, by trying every period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - start
            if i > start and size >= max(least, 2 * q) and not any(s <= start and start + size <= s + m for s, m, _ in out):
                out.append((start, size, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(11)
    for _ in range(600):
        n, letters = rng.randrange(80), rng.choice([1, 2, 3, 6])
        words = [rng.randrange(letters) for _ in range(n)]
        if n > 6 and rng.random() < 0.6:
            begin, period = rng.randrange(n - 4), rng.randrange(1, n)
            words = [words[min(n - 1, begin + (i - begin) % period)] if i >= begin else w for i, w in enumerate(words)]
        for least in (2, 12):
            assert periodic_runs.runs_of(words, least) == slow_runs(words, least)
        named = [bytes([97 + w]) for w in words]
        assert periodic_runs.runs_of_texts([named, [], named[::-1], named * 2], 12) == [
            slow_runs(x, 12) for x in (words, [], words[::-1], words * 2)]


def test_long_stretches():
    assert periodic_runs.runs_of([0] * 30_000) == [(0, 30_000, 1)]
    rng = random.Random(4)
    base = [rng.randrange(10**6) for _ in range(3000)]
    assert periodic_runs.runs_of(base * 3 + base[:7]) == [(0, 9007, 3000)]
    fibonacci = [0], [0, 1]
    while len(fibonacci[-1]) < 1500:
        fibonacci = fibonacci[-1], fibonacci[-1] + fibonacci[-2]
    assert periodic_runs.runs_of(fibonacci[-1]) == slow_runs(fibonacci[-1], 12)


def test_periodic_runs(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = ["a", "b", "B", "é", "c\x1cd"]
    rows = [(i, rng.choice([" ", "\n\t"]).join(rng.choices(vocabulary, k=rng.randrange(60))), "en") for i in range(120)]
    rows += [rows[4], rows[4], (None, "x y " * 20, None), (500, None, "en"), (501, "", "en"), (502, " \x0b", "en"), (503, "w" * 100_000, "en"),
             (504, "u v w " * 9000, "en")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries_audits.op12(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = []
    for i, text, _ in rows:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        n, checksum = len(words), None if i is None else zlib.crc32(str(i).encode())
        if checksum is not None and checksum % 10 == 0 and n:
            seed = checksum // 10
            begin = seed % n
            period = 1 + (n - begin) // (3 + seed % 8)
            words = [words[begin + (j - begin) % period] if j >= begin else w for j, w in enumerate(words)]
        runs = [(0, 27_000, 3)] if i == 504 else slow_runs(words, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        gone = {j for s, size, q in runs for j in range(s + q, s + size)}
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        want.append((i, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
                     hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows if r[0] is not None)
    found = periodic_runs.find(documents(spark, [(1, "z " + "x y " * 20, "en")]), F.col("text"))
    assert found.select("row.n", "collapsed", "runs").first()[:2] == (3, "z x y")
    assert periodic_runs.find(documents(spark, rows[:1]).limit(0), F.col("text")).count() == 0


def neighbours(rows, k):
    """(query, rank, id, distance) by comparing all rows."""
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    out = []
    for a, (q, v) in enumerate(rows):
        if q is None or q % 100 or not fine(v):
            continue
        others = [(float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i is None, i) for b, (i, w) in enumerate(rows)
                  if b != a and fine(w) and len(w) == len(v)]
        others.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(q, r, i, d) for r, (d, _, i) in enumerate(others[:k], 1)]
    return out


def as_known(found):
    return Counter((q, r, i, round(d, 9)) for q, r, i, d in found)


def search(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, "k", 1.0) for i, v in rows], "vec_id long, embedding array<double>, key string, radius double")
    return [tuple(r) for r in adaptive_scan.search(frame, F.col("vec_id") % 100 == 0, **options).collect()]


def test_search_finds_what_brute_force_finds(spark, monkeypatch):
    monkeypatch.setattr(adaptive_scan, "BLOCK", 16)  # lists of several blocks
    monkeypatch.setattr(adaptive_scan, "QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(int(i) * 25, rng.standard_normal(24).tolist()) for i in range(160)]
    copy = rng.standard_normal(24).tolist()
    rows += [(10_000 + 50 * i, copy) for i in range(40)]  # one vector many times, more than ten
    rows += [(20_000, copy), (20_000, copy), (20_100, rows[0][1]), (None, copy), (None, rows[4][1])]
    rows += [(30_000, None), (30_100, []), (30_200, [0.0] * 24), (30_300, [None] + [1.0] * 23), (30_400, [float("nan")] * 24),
             (30_500, [float("inf")] + [1.0] * 23), (30_600, [1.0, 2.0]), (30_601, [1.0, 2.5]), (30_700, [3.0] * 5)]
    rows += [(40_000 + 50 * i, (np.array(copy) + 1e-3 * rng.standard_normal(24)).tolist()) for i in range(40)]
    got = search(spark, rows, goal=1.0, confidence=1e9)
    assert as_known(got) == as_known(neighbours(rows, 10))
    near, true = (Counter((r[0], r[2]) for r in found) for found in (search(spark, rows), neighbours(rows, 10)))
    assert sum((near & true).values()) >= 0.93 * sum(true.values()) and sum(near.values()) == sum(true.values())
    assert search(spark, rows[:1]) == [] == search(spark, [(1, [1.0])]) == search(spark, [])
    assert search(spark, [(0, [1.0, 0.0]), (5, [1.0, 3.0])]) == [(0, 1, 5, 3.0)]


def test_abandoning_keeps_the_nearest():
    rng = np.random.default_rng(9)
    given = rng.standard_normal((3000, 64))
    turned = given @ adaptive_scan.rotation(64)
    columns = [turned[:, c:c + 16] for c in range(0, 64, 16)]
    weights = np.ones(3000, int)
    hits = 0
    for _ in range(20):
        query = rng.standard_normal(64)
        true = np.argsort(np.sqrt(((given - query) ** 2).sum(axis=1)))[:11]
        for radius in (np.inf, np.sqrt(((given[true[-1]] - query) ** 2).sum())):
            near, at = adaptive_scan.scan_block(query, query @ adaptive_scan.rotation(64), columns, given, weights, 11, radius, 2.1)
            hits += len(set(true.tolist()) & set(at[:11].tolist()))
            assert (np.diff(near) >= 0).all()
    assert hits >= 0.97 * 20 * 2 * 11
    assert np.allclose(adaptive_scan.rotation(64) @ adaptive_scan.rotation(64).T, np.eye(64))
