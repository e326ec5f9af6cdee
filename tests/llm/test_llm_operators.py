"""Every operator against brute force on small tables, with nulls, empty texts, ties, repeats and clashing names."""

import functools
import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from storeloom.llm import (bin_completion, decontaminate, jaccard_join, language_id, lattice_lm, licenses, line_dedup,
                           nn_descent, packing, secrets, warc)
from storeloom.llm.vocabularies import tokenizer_path
from storeloom.llm.words import alphanumeric_words, blank_words, split_words
from storeloom.scratch import DROP_SHUFFLES, stage, unstage

SCHEMA = "doc_id long, text string, lang string, row string, place long, class string, text_hash long"
WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "ke", "lo") for b in ("ra", "so", "ti", "mun", "x")]


def table(spark, texts, langs=None):
    """Documents with extra columns whose names the operators use inside."""
    rows = [(i, t, (langs or {}).get(i), "r", 7, "c", 1) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def blank_split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def word_split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


ODD = [None, "", " ", "É é A-b_c  d\x0be\x1cf", "x" * 3000, "ÀB cD\n\n9z", "  a b", "..", "ſK İ"]


def test_word_rules_agree(spark):
    got = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string").select(
        "i", split_words(F.col("t")).alias("w"), split_words(F.col("t"), r"[\x20\x09-\x0D]+").alias("b")).collect()
    for r in got:
        raw = None if ODD[r["i"]] is None else ODD[r["i"]].encode()
        assert r["w"] == word_split(ODD[r["i"]]) == [w.decode() for w in alphanumeric_words(raw)]
        assert r["b"] == blank_split(ODD[r["i"]]) == [w.decode() for w in blank_words(raw)]


def test_warc_round_trip(spark):
    pages = [(1, "http://a/ b", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u\r\nv", None), (4, "u", ""), (5, "u", "\r\n\r\nWARC/1.1"),
             (5, "u", "\r\n\r\nWARC/1.1"), (None, "u", "<p>é</p>"), (9, "u", "long " * 50_000)]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, payload string, offset int")
    index = warc.write(frame, warc.scratch_dir(spark, "warc"), archive_bytes=200)
    got = warc.read(index, with_payload=True).collect()
    assert len(got) == len(pages)
    by_text = {}
    for i, _, html in pages:
        by_text.setdefault(html or "", []).append(i)
    want = Counter()
    for i, _, html in pages:
        payload = (html or "").encode()
        newest = max(x for x in by_text[html or ""] if x is not None)
        digest = __import__("base64").b32encode(hashlib.sha1(payload).digest()).decode()
        kind = "response" if i == newest else "revisit"
        want[(i, len(payload), digest, kind, None if i == newest else newest, payload if kind == "response" else None)] += 1
    assert want == Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                            None if r["payload"] is None else bytes(r["payload"])) for r in got)
    assert warc.read(index.where("page_id = 9")).first()["payload_bytes"] == 250_000
    assert warc.round_trip(frame.limit(0)).count() == 0
    assert all(r["record_type"] == "response" for r in warc.round_trip(frame, least_bytes=10**9).collect())


def test_read_tasks_follow_the_bytes_of_the_records(spark, monkeypatch):
    rng = random.Random(1)
    pages = spark.createDataFrame([(i, "u", rng.randbytes(3000).hex()) for i in range(300)], "page_id long, url string, html string")
    index = warc.write(pages, warc.scratch_dir(spark, "warc"), archive_bytes=100_000)
    monkeypatch.setattr(warc, "READ_BYTES", 100_000)
    read = warc.read(index, with_payload=True)
    assert read.rdd.getNumPartitions() >= 9
    assert {r["page_id"] for r in read.collect()} == set(range(300))


def test_ranges_are_joined_only_when_close():
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 200, 5), ("b", 0, 5), ("b", 5, 100)]
    assert list(warc.runs(ranges, gap=10, longest=50)) == [(0, 2), (2, 3), (3, 4), (4, 5)]


def slow_bits(rows, text, order):
    """Code length of a text under one language's counts, by recursion over contexts."""
    counts = {}
    for length, (values, ns) in rows.items():
        for v, n in zip(values, ns, strict=True):
            gram = int(v).to_bytes(length, "big")
            counts.setdefault(gram[:-1], {})[gram[-1]] = int(n)

    @functools.cache
    def chance(context, byte):
        lower = (lambda b: 1 / 256) if not context else (lambda b: chance(context[1:], b))
        seen = counts.get(context)
        if not seen:
            return lower(byte)
        total, distinct = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (total + distinct)
        return distinct / (total + distinct) * lower(byte) / sum(lower(b) for b in range(256) if b not in seen)

    return -sum(math.log2(chance(text[max(0, i - order):i], b)) for i, b in enumerate(text))


def test_code_lengths_match_recursion():
    rng = random.Random(5)
    texts = {"aa": [b"abracadabra banana", b"abba"], "bb": ["çé xyz xyzzy".encode(), b"zz"]}
    rows = {k: {n: (v, c) for n, v, c in language_id.count_grams(t, 2)} for k, t in texts.items()}
    # A context needs two occurrences; give the recursion the same trees.
    model = language_id.build(rows, 2, max_states=1000)
    asked = [b"abra xyz", b"q", "é".encode() * 3, bytes(rng.choice(b"abxyz ") for _ in range(700))]
    got = language_id.code_lengths(model, asked, 2)
    kept = Counter()
    for r in rows.values():
        for n in (1, 2):
            for v, c in zip(*r[n], strict=True):
                kept[int(v).to_bytes(n, "big")] += int(c)
    contexts = {b""} | {c for c, n in kept.items() if n >= 2}
    for j, language in enumerate(model.languages):
        trees = {}
        for n, (values, counts) in rows[language].items():
            held = [i for i, v in enumerate(values) if int(v).to_bytes(n, "big")[:-1] in contexts]
            trees[n] = (values[held], counts[held])
        for k, text in enumerate(asked):
            assert got[k, j] == pytest.approx(slow_bits(trees, text, 2), rel=1e-4)


def test_language_id(spark):
    rng = random.Random(2)
    alphabets = {"en": "etaoin shrdlu", "fr": "éèà esaitnru", "xx": "qzwkjv xyb"}
    texts, langs = [], {}
    for i in range(120):
        lang = rng.choice(sorted(alphabets))
        texts.append((i, "".join(rng.choice(alphabets[lang]) for _ in range(200))))
        langs[i] = lang
    odd = [(1000, None), (1001, ""), (1002, "123 .."), (1003, "é")]
    docs = table(spark, texts + odd + texts[:2], langs)
    model = language_id.train_on_folds(docs)
    got = language_id.identify(docs, F.col("text"), model).select("row.*", "lang_pred", "score").collect()
    assert len(got) == 126
    held = [r for r in got if r["doc_id"] < 1000 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert held and all(r["lang_pred"] == langs[r["doc_id"]] and 0.9 < r["score"] <= 1 for r in held)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[1000] == by[1001] == by[1002] == ("und", 0.0) and by[1003][0] == "fr"
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {*range(120), 1003}
    assert language_id.keep_identified(docs.limit(0)).count() == 0


def test_bin_plans():
    rng = random.Random(3)
    for _ in range(150):
        capacity, n = rng.choice([10, 20, 50, 100]), rng.randint(1, 40)
        counts = Counter(rng.randint(1, capacity) for _ in range(n))
        plans = bin_completion.best_fit(counts, capacity), bin_completion.complete(counts, capacity, 2000)
        for plan in plans:
            held = Counter()
            for filling, times in plan:
                assert sum(filling) <= capacity and times > 0
                held.update({k: v * times for k, v in Counter(filling).items()})
            assert held == counts
        assert bin_completion.lower_bound(counts, capacity) <= bin_completion.n_bins(plans[1]) <= bin_completion.n_bins(plans[0])
    # Best fit needs four bins here, the search finds three.
    assert bin_completion.n_bins(bin_completion.complete(Counter([6, 5, 5, 4, 4, 3, 3]), 10)) == 3
    assert bin_completion.complete({}, 10) == []


def test_packing(spark):
    from tokenizers import Tokenizer

    path, rng = tokenizer_path("word_bpe_49k.json"), random.Random(4)
    texts = [(i, prose(rng, rng.randint(1, 30))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "a\x1cb <|endoftext|> É½"), (103, prose(rng, 400)), texts[0]]
    got = packing.pack(table(spark, texts), F.col("text"), path, capacity=64, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for i, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    histogram = Counter(r["length"] for r in got)
    assert len(sequences) == bin_completion.n_bins(bin_completion.complete(histogram, 64))
    assert packing.pack(table(spark, []), F.col("text"), path).count() == 0


def test_secret_patterns(spark):
    odd = ["Password = 'abcdef1' token:xyz passwd=short secret=toolong99", "tokEn = KKeep", "AKIA" + "A" * 16 + " AKIA123 xAKIAAKIA" + "B" * 20,
           "f" * 24 + "g" + "0" * 23, "é api_key:\"Zz9+/=.-_\" apikey=123456", "token=secret=abcdefg", None, ""]
    got = {r["i"]: r for r in secrets.scan(spark.createDataFrame([(i, t, 1) for i, t in enumerate(odd)], "i int, text string, found int"),
                                           F.col("text")).select("row.i", "found", secrets.written(F.col("found")).alias("w")).collect()}
    for i, text in enumerate(odd):
        text, want = text or "", []
        pattern = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        want += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert [tuple(s) for s in got[i]["found"] if s["rank"] < 3] == sorted(want)
        assert got[i]["w"] == ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in [tuple(s) for s in got[i]["found"]])


def test_randomness_battery(spark):
    rng = random.Random(9)
    letters = secrets.ALPHABETS["base64"]
    strings = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(300)]
    values = [secrets.randomness(s, "base64") for s in strings]
    assert 0.35 < np.mean(values) < 0.65 and sum(v < 0.05 for v in values) < 45
    names = ["".join(rng.choice(WORDS).title() for _ in range(10))[:40] + "Id" for _ in range(300)]
    assert max(secrets.randomness(n, "base64") for n in names) < 0.05
    assert secrets.encoding_of("deadbeef00") == "hex" and secrets.encoding_of("a!") is None
    docs = spark.createDataFrame([(i, f"see {s} end") for i, s in enumerate(strings + names)], "i int, text string")
    got = secrets.scan(docs, F.col("text")).select("row.i", F.size("found").alias("n")).collect()
    assert sum(r["n"] for r in got if r["i"] < 300) > 250 and sum(r["n"] for r in got if r["i"] >= 300) < 15


def test_secret_thresholds_count_strings_once(spark):
    rng = random.Random(10)
    letters = secrets.ALPHABETS["base64"]
    strings = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(1000)]
    names = list({"".join(rng.choice(WORDS).title() for _ in range(10))[:40] + "Id" for _ in range(1000)})
    for lowest, highest in ((0.3, 0.4), (0.6, 0.7), (0.9, 1.0)):  # thousands of copies change nothing
        copied = next(s for s in strings if lowest <= secrets.randomness(s, "base64") < highest)
        rows = [(i, f"see {s} end") for i, s in enumerate(strings + names + [copied] * 3000)]
        got = secrets.scan(spark.createDataFrame(rows, "i int, text string"), F.col("text")).select("row.i", F.size("found").alias("n")).collect()
        assert sum(r["n"] for r in got if r["i"] < 1000) > 900
        assert sum(r["n"] for r in got if 1000 <= r["i"] < 1000 + len(names)) < 100
    alone = next(s for s in strings if 0.3 <= secrets.randomness(s, "base64") < 0.4)  # a band of one string
    for s, n in ((alone, 1), (names[0], 0)):
        row = spark.createDataFrame([(f"see {s} end",)], "text string")
        assert secrets.scan(row, F.col("text")).select(F.size("found")).first()[0] == n
    for size in (5, 30):
        kept = []
        for _ in range(100):
            bins = Counter(min(63, int(secrets.randomness(s, "base64") * 64)) for s in rng.sample(strings, size))
            least = secrets.thresholds({("base64", 12): bins})["base64", 12]
            kept.append(sum(n for b, n in bins.items() if b >= least) / size)
        assert np.mean(kept) > 0.85


def test_secrets_behind_names(spark):
    rng = random.Random(11)
    letters = secrets.ALPHABETS["base64"]

    def value():
        return "".join(rng.choice(letters) for _ in range(18)) + "+" + "".join(rng.choice(letters) for _ in range(18)) + "/Aa"

    forms = [("AWS_ACCESS=", ""), ("https://host/path?sig=", "&x=1"), ("client_id=a&client_key=", "=="), ("my_name-", ""), ("=", ""),
             ("A_LONGER_NAME_THAN_TWENTY_LETTERS=", "")]
    rows = []
    for i in range(600):
        before, after = forms[i % len(forms)]
        s = value()
        rows.append((i, f"é {before}{s}{after} end", 2 + len(before), 2 + len(before) + len(s) + after.count("==") * 2))
    docs = spark.createDataFrame(rows, "i int, text string, start int, end int")
    got = secrets.scan(docs, F.col("text")).select("row.*", "found").collect()
    hit = [any(s["rank"] == 3 and (s["start"], s["end"]) == (r["start"], r["end"]) for s in r["found"]) for r in got]
    for k in range(len(forms)):
        assert np.mean([h for h, r in zip(hit, got, strict=True) if r["i"] % len(forms) == k]) > 0.85
    text = "x=" + "a" * 30 + "=b " + "C" * 20 + "== /dir/my_file-" + "D" * 25 + " =" + "e" * 19
    found = {(text[a:a + len(s)], s) for a, s, _ in secrets.candidates(text)}
    assert {s for _, s in found} == {"a" * 30, "C" * 20 + "==", "D" * 25, "my_file-" + "D" * 25} and all(a == b for a, b in found)


def test_spans_within_others_match_all_pairs():
    rng = random.Random(12)
    for _ in range(200):
        cuts = sorted(rng.sample(range(200), 20))
        spans = [(a, rng.randrange(3), b) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        spans += [(a, 2, rng.randrange(a + 1, 220)) for a, _, _ in rng.sample(spans, 3)]
        spans.sort()
        found = [(a, a + rng.randrange(1, 30)) for a in (rng.randrange(200) for _ in range(30))]
        assert secrets.outside(found, spans) == [not any(s <= a and b <= e for s, _, e in spans) for a, b in found]
        one, two = ([(a, b) for a, b in zip(c[:-1], c[1:], strict=True) if rng.random() < 0.8]
                    for c in (sorted(rng.sample(range(100), n)) for n in (6, 25)))
        both = one + two
        want = [next((i for i, (s, e) in enumerate(both) if s <= a and b <= e and e - s > b - a), -1) for a, b in both]
        assert secrets.enclosing(both) == want
    assert secrets.outside([], []) == secrets.enclosing([]) == []


def test_secret_scan_of_a_long_list_of_hashes(spark):
    """Two fixed and one random string a line, 6 MB in one text: far beyond what comparing all spans with all would allow."""
    rng = random.Random(13)
    n = 50_000
    lines = [f"{rng.getrandbits(128):032x} password=x{i:07d} " + "".join(rng.choices(secrets.ALPHABETS["base64"][:62], k=24)) + "-"
             + "".join(rng.choices(secrets.ALPHABETS["base64"][:62], k=24)) + "+" + "a" * 20 for i in range(n)]
    text = "\n".join(lines)
    assert len(text) > 6_000_000
    found = secrets.scan(spark.createDataFrame([(1, text), (2, None), (None, ""), (1, "f" * 24), (1, "f" * 24)], "doc_id long, text string"),
                         F.col("text")).select("row.doc_id", F.size(F.filter("found", lambda s: s["rank"] == 0)).alias("assign"),
                                               F.size(F.filter("found", lambda s: s["rank"] == 2)).alias("hex"),
                                               F.size("found").alias("n")).collect()
    by_size = sorted(((r["doc_id"] or 0, r["assign"], r["hex"], r["n"]) for r in found), key=lambda x: (x[3], x[0]))
    assert by_size[:4] == [(0, 0, 0, 0), (2, 0, 0, 0), (1, 0, 1, 1), (1, 0, 1, 1)]
    # Of a line's strings the longest random one stays, the one across "-".
    assert by_size[4][:3] == (1, n, n) and 2.9 * n < by_size[4][3] <= 3 * n
    empty = secrets.scan(spark.createDataFrame([], "doc_id long, text string"), F.col("text"))
    assert empty.count() == 0 and empty.columns == ["row", "found"]


def all_ways(lattice, text):
    """Every segmentation's log probability."""
    if not text:
        return [0.0]
    out = []
    for k in range(1, len(text) + 1):
        score = lattice.pieces.get(text[:k])
        if score is not None:
            out += [score + rest for rest in all_ways(lattice, text[k:])]
    if text[0] not in lattice.pieces:
        spelt = sum(lattice.spelt[b] for b in text[0].encode())
        out += [spelt + rest for rest in all_ways(lattice, text[1:])]
    return out


def test_lattice_sums_all_segmentations():
    pieces = {"▁": -3.0, "▁a": -2.0, "a": -2.5, "b": -2.2, "ab": -1.5, "ba": -1.9, "▁ab": -1.1, "aba": -4.0}
    lattice = lattice_lm.Lattice(pieces, np.linspace(-9, -8, 256))
    for n in range(1, 6):
        for word in map("".join, itertools.product("abé", repeat=n)):
            total = math.log(sum(map(math.exp, all_ways(lattice, "▁" + word))))
            assert lattice.log_probability(word) == pytest.approx(total)


def test_lm_scoring(spark):
    path, rng = tokenizer_path("piece_bpe_32k.model"), random.Random(6)
    texts = [(i, prose(rng, rng.randint(0, 40)) + (" Rare%d É\x1cz" % i if i % 3 else "")) for i in range(60)] + [(99, None), (98, " \n"), (5, "ba")]
    docs = table(spark, texts)
    train = ~language_id.held_out(F.col("doc_id"), 7)
    got = lattice_lm.score_documents(docs, F.col("text"), train, path, frequent_words=20).select(
        "row.doc_id", "row.text", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    learn = [t for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in learn for w in blank_split(t))
    total, types = sum(counts.values()) + len(learn), len(counts) + 1
    known = lambda w: (counts[w] + 1) / (total + types + 1)
    assert len(got) == len(texts)
    piece = np.zeros(32000)
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for w, n in counts.items():
        for k in model.encode(w):
            piece[k] += n
    lattice, end = lattice_lm.lattice(path, piece, len(learn))
    for r in got:
        words = blank_split(r["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words) + 1, sum(counts[w] > 0 for w in words) + 1, total)
        assert r["base_score"] == pytest.approx(sum(math.log10(known(w)) for w in words) + math.log10((len(learn) + 1) / (total + types + 1)))
        assert r["score"] == pytest.approx((sum(map(lattice.log_probability, words)) + end) / math.log(10))
    assert lattice_lm.score_documents(docs.limit(0), F.col("text"), train, path).count() == 0


def near_sets(rng):
    """Documents with exact copies, a long chain of near copies, short sets and odd texts."""
    base = [rng.choice(WORDS) + str(k) for k in range(60)]
    texts = []
    for k in range(24):
        words = list(base)
        words[k % 60] = f"new{k}"
        texts.append(" ".join(words if k % 4 else words[:58 - k % 3]))
    texts += [texts[0].upper(), texts[0], "a b c", "a b c", "a b", "", None, " \t", "a b c d e f g h", "a b c d e f g x", "a b c d e f g h i"]
    for _ in range(40):
        texts.append(prose(rng, rng.randint(1, 14)))
    return list(enumerate(texts, start=3))


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = blank_split(t)
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("long_list", [3, 1000])
def test_jaccard_join(spark, monkeypatch, long_list):
    monkeypatch.setattr(jaccard_join, "LONG_LIST", long_list)
    monkeypatch.setattr(jaccard_join, "FAMILY_BLOCK", 8)
    texts = near_sets(random.Random(7))
    found = jaccard_join.near_duplicates(table(spark, texts)).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in found} == brute_components(texts)


def test_jaccard_pairs_take_turns_and_leave_no_texts(spark, monkeypatch):
    labels, stage_as = [], jaccard_join.stage
    monkeypatch.setattr(jaccard_join, "PART_SHINGLES", 1)
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 20)
    monkeypatch.setattr(jaccard_join, "stage", lambda df, label: labels.append((label, stage_as(df, label))) or labels[-1][1])
    texts = near_sets(random.Random(8))
    found = jaccard_join.near_duplicates(table(spark, texts)).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in found} == brute_components(texts)
    of_texts = [staged for label, staged in labels if label == "class-texts"]
    assert len(of_texts) > jaccard_join.PARTS
    paths = [spark._jvm.java.io.File(spark._jvm.java.net.URI(file)) for staged in of_texts for file in staged.inputFiles()]
    assert paths and not any(path.exists() for path in paths)


def test_only_staged_tables_are_deleted(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    with pytest.raises(ValueError):
        unstage(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3


def test_jaccard_keeps_one_of_each_group(spark):
    texts = [(4, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (9, None), (8, ""), (7, "x y z")]
    kept = jaccard_join.keep_first(table(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 8, 9]
    assert jaccard_join.keep_first(table(spark, [])).count() == 0


def test_selection_and_bounds():
    rng = np.random.default_rng(1)
    costs = jaccard_join.Costs(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for size in (1, 3, 4, 6, 7, 30, 96, 97, 500):
        base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        own = set(np.concatenate(jaccard_join.index_keys(base, (3, 4), 0, costs)).tolist())
        for _ in range(20):
            other = set(base.tolist())
            for x in rng.permutation(base)[:jaccard_join.allowed(size, size, (3, 4)) // 2]:
                other.discard(int(x))
                other.add(int(rng.integers(0, 1 << 63, dtype=np.uint64)))
            theirs = np.sort(np.array(sorted(other), dtype=np.uint64))
            assert own & set(np.concatenate(jaccard_join.index_keys(theirs, (3, 4), 0, costs)).tolist())


def test_overlaps_and_forest():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 20), dtype=np.uint64)) for _ in range(12)]
    got = jaccard_join.overlaps(sets[:5], sets[5:])
    assert (got == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]).all()
    linked = np.array([[True, False], [True, False], [False, True]])
    pairs = jaccard_join.forest(linked, np.array([5, 3, 9]), np.array([7, 8]))
    assert sorted(zip(*map(list, pairs), strict=True)) == [(3, 5), (3, 7), (8, 9)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_line_dedup(spark):
    rng = random.Random(8)
    lines = [prose(rng, rng.randint(5, 25)) for _ in range(12)]
    texts = []
    for i in range(30):
        chosen = [rng.choice(lines) for _ in range(3)] + [prose(rng, 3), "", prose(rng, 12)]
        chosen[0] = chosen[0].title().replace(" ", " ,", 1)
        if i % 5 == 0:
            words = chosen[1].split()
            chosen[1] = " ".join(words[:-1] + [words[-1] + "y"])
        texts.append((i, "\n".join(chosen)))
    texts += [(100, None), (101, ""), (102, "\n\n"), (103, lines[0]), (3, texts[3][1])]
    docs = table(spark, texts)
    got = line_dedup.dedup_documents(docs).select("row.*", "n_lines", "n_removed").collect()
    norm = {" ".join(word_split(line)) for _, text in texts if text for line in text.split("\n") if len(word_split(line)) >= 5}
    root = {n: n for n in norm}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    # Every word differs in one word at most here, so no pair within the edit similarity may be missed.
    for a, b in itertools.combinations(sorted(norm), 2):
        if levenshtein(a, b) <= int(max(len(a), len(b)) * 0.1 + 1e-9):
            root[find(b)] = find(a)
    seen, want = {}, {}
    for i, text in sorted(dict(texts).items()):
        if text is None:
            want[i] = (None, 0, 0)
            continue
        kept = []
        for line in text.split("\n"):
            key = " ".join(word_split(line))
            if len(word_split(line)) >= 5 and seen.setdefault(find(key), (i, len(kept), line)) != (i, len(kept), line):
                continue
            kept.append(line)
        n = len(text.split("\n"))
        if len(kept) == n or any(map(word_split, kept)):
            want[i] = ("\n".join(kept), n, n - len(kept))
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in got} == want
    assert Counter(r["doc_id"] for r in got)[3] == 2 and 103 not in want
    assert line_dedup.dedup_documents(table(spark, [])).count() == 0


def test_line_dedup_of_long_and_unspaced_lines(spark):
    mixed = " ".join(WORDS[i % 7] if i % 3 else "zz" for i in range(70_000))
    lines = ["same " * 70_000, mixed, "今日は天気がとてもいいです", "สวัสดีชาวโลกทุกคน"]
    texts = [(i, line + "\nend") for i, line in enumerate(lines)] + [(i + 10, line + "\nend") for i, line in enumerate(lines)]
    texts += [(30, "今日\nend"), (31, "今日\nend"), (32, "un mot élégant ici\nend"), (33, "un mot élégant ici\nend")]
    docs = table(spark, texts)
    removed = {r["i"]: r["n_removed"] for r in line_dedup.dedup_documents(docs).select(F.col("row.doc_id").alias("i"), "n_removed").collect()}
    assert removed == {i: int(10 <= i < 20) for i, _ in texts}


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def test_simhash_bits(spark):
    rng = random.Random(3)
    lists = [[signed(rng.getrandbits(64)) for _ in range(n)] for n in (0, 1, 2, 3, 4, 8, 13, 15)]
    got = spark.createDataFrame([(h,) for h in lists], "h array<bigint>").select(line_dedup.short_simhash(F.col("h"))).collect()
    assert [r[0] & (2**64 - 1) for r in got] == [sum(1 << k for k in range(64) if sum(x >> k & 1 for x in h) * 2 > len(h)) for h in lists]
    words = {"a": WORDS[:12], "b": [f"w{i}" for i in range(45)], "c": [f"{i}" for i in range(3000)] * 2}
    lines = spark.createDataFrame([(k, v, len(v)) for k, v in words.items()], "k string, words array<string>, n_words int")
    hashes = {r["w"]: r["h"] for r in lines.select(F.explode("words").alias("w")).distinct().select("w", F.xxhash64("w").alias("h")).collect()}
    want = {}
    for k, v in words.items():
        for number, first, in_use in ((line_dedup.FEW_BLOCKS, 0, len(v) < 48), (line_dedup.MANY_BLOCKS, line_dedup.MANY_SLOTS, len(v) >= 40)):
            for slot in range(number if in_use else 0):
                mine = [hashes[w] for w in set(v) if hashes[w] % number == slot]
                if mine:
                    want[k, slot + first] = (len(mine), sum(1 << b for b in range(63) if sum(h >> b & 1 for h in mine) * 2 > len(mine)))
    blocks = line_dedup.block_simhashes(lines, ["k", "n_words"]).collect()
    assert {(r["k"], r["slot"]): (r["n"], r["s"]) for r in blocks} == want and len(blocks) == len(want)


def typo(rng, text):
    at = rng.choice([i for i, c in enumerate(text) if c != " "])
    return text[:at] + rng.choice("abcdefgh".replace(text[at], "")) + text[at + 1:]


def test_line_recall_against_edit_similarity(spark):
    """Pairs within the edit similarity that are found: one letter changed, and as many as the similarity allows, up to three."""
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvw", k=rng.randint(2, 9))) for _ in range(2000)]
    docs, kind = [], {}
    for n, edits, _ in itertools.product((5, 8, 12, 20, 40, 90), (1, 2, 3), range(25)):
        line = " ".join(rng.choices(vocabulary, k=n))
        other = line
        for _ in range(edits):
            other = typo(rng, other)
        if levenshtein(line, other) <= int(len(line) * 0.1 + 1e-9) and line != other:
            docs += [(2 * len(docs), line + "\nend"), (2 * len(docs) + 1, other + "\nend")]
            kind[docs[-1][0]] = (n, edits)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    removed = {r["i"]: r["n_removed"] for r in line_dedup.dedup_documents(frame).select(F.col("row.doc_id").alias("i"), "n_removed").collect()}
    assert all(removed[i] == 0 for i, _ in docs if i not in kind)
    shares = {}
    for i, k in kind.items():
        shares.setdefault(k[1], []).append(removed[i])
    assert sum(shares[1]) == len(shares[1])  # one letter, at every length
    assert sum(shares[2]) >= 0.9 * len(shares[2])
    assert sum(sum(v) for v in shares.values()) >= 0.85 * len(kind)


def edited(rng, text, n):
    for _ in range(n):
        at, kind = rng.randrange(len(text)), rng.random()
        text = text[:at] + ("" if kind < 0.3 else rng.choice("ab é")) + text[at + (kind < 0.7):]
    return text


def test_lines_within_the_edit_similarity_are_all_found(spark):
    """As many letters and blanks changed, taken out or put in as the similarity allows, anywhere."""
    rng = random.Random(21)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvw", k=rng.randint(1, 9))) for _ in range(500)]
    docs, close = [], set()
    for n, _ in itertools.product((5, 8, 12, 20, 40, 90), range(25)):
        line = " ".join(rng.choices(vocabulary, k=n))
        other = edited(rng, line, max(1, len(line) // 10 - rng.randint(0, 1)))
        norms = [" ".join(word_split(x)) for x in (line, other)]
        docs += [(2 * len(docs), line + "\nend"), (2 * len(docs) + 1, other + "\nend")]
        if levenshtein(*norms) <= int(max(map(len, norms)) * 0.1 + 1e-9) and len(word_split(other)) >= 5:
            close.add(docs[-1][0])
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    removed = {r["i"] for r in line_dedup.dedup_documents(frame).where("n_removed > 0").select(F.col("row.doc_id").alias("i")).collect()}
    assert removed == close and len(close) > 100


def test_pairs_to_compare_hold_all_within_the_edit_similarity_and_few_others(spark):
    """Long lines with one phrase in common at the same place are not compared; pairs within the similarity are, at every length."""
    rng = random.Random(5)
    norms = []
    for n, _ in itertools.product((10, 11, 19, 20, 45, 89, 90, 91, 150, 200, 305), range(4)):
        line = "".join(rng.choices("abcdefgh ", k=n))
        norms += [line, edited(rng, line, len(line) // 10), edited(rng, line, max(1, len(line) // 10 - 2))]
    norms += ["ab" * 400, "ab" * 380 + "ba" * 20, "a" * 300, "a" * 290]
    phrase = "a phrase that two lines share"
    apart = [head + phrase + tail for head, tail in (("".join(rng.choices("abcdefgh ", k=150)), "".join(rng.choices("abcdefgh ", k=150))) for _ in range(2))]
    norms += apart
    rows = [(i, len(x), i, x) for i, x in enumerate(norms)]
    lines = spark.createDataFrame(rows, "line long, length int, component long, norm string")
    close = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(norms), 2)
             if abs(len(a) - len(b)) <= 0.1 * max(len(a), len(b)) and levenshtein(a, b) <= int(max(len(a), len(b)) * 0.1 + 1e-9)}
    pairs = line_dedup.untouched_pairs(lines, 0.9)
    found = [tuple(r) for r in pairs.select("a", "b").collect()]
    assert len(found) == len(set(found)) and close <= set(found) and len(close) > 40
    assert (len(norms) - 2, len(norms) - 1) not in found
    every = spark.createDataFrame(list(itertools.combinations(range(len(norms)), 2)), "a long, b long")
    allowed = {tuple(r) for r in line_dedup.letters_allow(every, lines, 0.9).select("a", "b").collect()}
    assert close <= allowed and len(allowed) < every.count() / 2


def test_ranges_of_lengths_take_turns_and_lose_no_pair(spark, monkeypatch):
    """Pairs within the similarity are found when their lengths are in different ranges too, each pair once."""
    monkeypatch.setattr(line_dedup, "ROUNDS", 100)
    monkeypatch.setattr(line_dedup, "ROUND_CHARACTERS", 500)
    rng = random.Random(8)
    norms = []
    for n in range(10, 320, 4):
        line = "".join(rng.choices("abcdefgh ", k=n))
        norms += [line, edited(rng, line, n // 10), line[:n - n // 10], "x" * (n // 10) + line]
    rows = [(i, len(x), i, x) for i, x in enumerate(norms)]
    lines = spark.createDataFrame(rows, "line long, length int, component long, norm string")
    ranges = line_dedup.length_ranges(lines)
    assert len(ranges) > 10 and ranges[0][0] <= min(map(len, norms)) and ranges[-1][1] > max(map(len, norms))
    assert all(a[1] == b[0] for a, b in itertools.pairwise(ranges))
    close = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(norms), 2)
             if abs(len(a) - len(b)) <= 0.1 * max(len(a), len(b)) and levenshtein(a, b) <= int(max(len(a), len(b)) * 0.1 + 1e-9)}
    found = [tuple(r) for r in line_dedup.untouched_pairs(lines, 0.9).select("a", "b").collect()]
    assert len(found) == len(set(found)) and close <= set(found) and len(close) > 150
    assert line_dedup.untouched_pairs(lines.limit(0), 0.9).count() == 0


def test_pieces_are_looked_for_only_where_the_edits_before_them_can_move_them(spark):
    rng = random.Random(9)
    one, two = ("".join(rng.choices(letters, k=89)) for letters in ("abcdefgh", "stuvwxyz"))
    moved = two[:5] + one[:9] + two[14:]  # the first piece of nine, five places off, can only stand there after an edit
    far, near = (two[:at] + one[39:48] + two[at + 9:] for at in (44, 43))  # the fifth may be moved by four
    rows = [(i, len(x), i, x) for i, x in enumerate((one, moved, far, near))]
    lines = spark.createDataFrame(rows, "line long, length int, component long, norm string")
    found = {tuple(r) for r in line_dedup.untouched_pairs(lines, 0.9).select("a", "b").collect()}
    assert {p for p in found if p[0] == 0} == {(0, 3)}


def test_staging_takes_the_shuffle_files_with_it(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before = shuffled()
    staged = stage(spark.range(1000).repartition(5, "id"), "kept")
    deadline = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not shuffled() - before
    assert staged.count() == 1000 and spark.conf.get(DROP_SHUFFLES) == "false"


def test_equal_ends_are_taken_off_long_lines(spark):
    rng = random.Random(2)
    base = "".join(rng.choices("abcé ", k=3000))
    pairs = [(base, base[:700] + "XY" + base[710:]), (base, "q" + base), (base, base + "q"), (base, base[1:]), (base, base), ("ab" * 800, "ba" * 700),
             ("short", "shirt")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    got = frame.select(line_dedup._cores(F.col("a"), F.col("b")).alias("c")).select("c.a", "c.b").collect()
    for (a, b), (x, y) in zip(pairs, got, strict=True):
        if len(a) < 1000:
            assert (x, y) == (a, b)
            continue
        start = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
        a, b = a[start:], b[start:]
        end = next((i for i, (p, q) in enumerate(zip(a[::-1], b[::-1])) if p != q), min(len(a), len(b)))
        a, b = a[:len(a) - end], b[:len(b) - end]
        assert (x[::-1], y[::-1]) == (a, b)


@pytest.mark.parametrize("similarity", [0.5, 0.75, 0.9, 1.0])
def test_lengths_within_reach_share_a_band(spark, similarity):
    sizes = spark.range(1, 400).select(F.col("id").cast("int").alias("n"))
    rows = sizes.select("n", line_dedup._bands(F.col("n"), similarity).alias("bands")).collect()
    bands = {r["n"]: set(r["bands"]) for r in rows}
    for a, b in itertools.combinations(bands, 2):
        if b - a <= int(b * (1 - similarity) + 1e-9):
            assert bands[a] & bands[b]


def test_license_scan(spark):
    texts = [(1, "Released under the MIT License."), (2, "x MIT License mit-license"), (3, "general public  license, apache LICENSE"), (4, None),
             (5, ""), (6, "the license of nothing"), (7, "a " * 30 + licenses.TEMPLATES[9].text + " b"), (8, "Licensed under CC BY-NC 4.0."),
             (9, "redistribution and use " + "z " * 60 + " in source and binary forms")]
    rng = random.Random(1)
    texts += [(100 + k, prose(rng, 20)) for k in range(60)]
    got = {r["doc_id"]: r for r in licenses.scan(table(spark, texts), F.col("text")).select("row.doc_id", *[f.name for f in licenses.ADDED]).collect()}
    for i, text in texts:
        words, places, labels = word_split(text), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k:k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    assert got[7]["labels"] == "bsd" and got[7]["score"] == 1 and got[8]["labels"] == "cc"
    assert got[6]["labels"] == got[9]["labels"] == "" and got[3]["labels"] == "apache,gpl"
    assert licenses.scan(table(spark, []), F.col("text")).count() == 0


def test_decontamination(spark):
    rng = random.Random(11)
    items = [(k, prose(rng, n)) for k, n in enumerate((30, 13, 5, 1, 0, 20, 30))] + [(50, None), (51, "qq only"), (10, "same Words"), (9, "same words")]
    items[6] = (6, items[0][1])
    texts = []
    for i in range(40):
        words = prose(rng, 30).split()
        k, item = rng.choice(items[:7])
        part = (item or "").split()
        start = rng.randint(0, max(0, len(part) - 14))
        texts.append((i, " ".join(words[:10] + part[start:start + rng.choice([12, 13, 14, 40])] + words[10:])))
    texts += [(90, None), (91, ""), (92, "same, WORDS"), (93, items[0][1] * 2), texts[0], (None, items[1][1])]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, place string")
    got = decontaminate.contamination(table(spark, texts), bench).drop("text_hash", "n_near_items").collect()
    want = []
    for i, text in texts:
        words, hit, found = word_split(text), set(), set()
        for k, item in items:
            w = word_split(item)
            n = min(13, len(w))
            for s in range(len(w) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at:at + n] == w[s:s + n]:
                        hit |= set(range(at, at + n))
                        found.add(k)
        ids = ",".join(sorted(map(str, found)))
        want.append((i, len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert any(w[2] for w in want) and any(not w[2] for w in want)
    clean = decontaminate.clean_documents(table(spark, texts), bench)
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(w[0]) for w in want if not w[5])
    assert decontaminate.contamination(table(spark, []), bench).count() == 0
    assert decontaminate.contamination(table(spark, texts), bench.limit(0)).where("n_hit > 0").count() == 0


def test_embedding_near_dedup(spark):
    rng = np.random.default_rng(12)
    vectors = []
    for k in range(60):
        centre = rng.standard_normal(16)
        for _ in range(1 + k % 4):
            vectors.append(centre + rng.standard_normal(16) * 0.06)
    hub = rng.standard_normal(16)
    vectors += [hub + rng.standard_normal(16) * 0.05 for _ in range(40)] + [vectors[5]] * 3
    rows = [(int(i), v.tolist(), 0, "x") for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    odd = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] + [1.0] * 15), (1004, []), (1005, [1.0, 2.0]), (1006, [2.0, 4.0])]
    frame = spark.createDataFrame(rows + [(i, v, 1, "y") for i, v in odd], "vec_id long, embedding array<double>, label int, unit string")
    got = {r["id"]: (r["n_links"], r["component"]) for r in nn_descent.near_duplicates(frame).collect()}
    ids = [r[0] for r in rows]
    units = np.array([r[1] for r in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    linked = units @ units.T >= 0.95
    np.fill_diagonal(linked, False)
    found = sum(got[i][0] for i in ids)
    assert found <= linked.sum() and found >= 0.95 * linked.sum() and len(got) == len(rows) + len(odd)
    root = dict(zip(ids, ids, strict=True))
    for _ in range(len(ids)):
        new = {i: min([root[i], *(root[ids[k]] for k in np.flatnonzero(linked[a]))]) for a, i in enumerate(ids)}
        if new == root:
            break
        root = new
    assert sum(got[i][1] == root[i] for i in ids) >= 0.95 * len(ids)
    assert all(got[i] == (0, i) for i in range(1000, 1005)) and got[1005] == got[1006] == (1, 1005)
    assert nn_descent.near_duplicates(frame.limit(0)).count() == 0


def test_embedding_recall_is_reached_or_all_are_compared(spark, monkeypatch):
    rng = np.random.default_rng(13)
    vectors = list(rng.standard_normal((2400, 24)))  # few links: a first slice of the audit may hold none
    vectors += [v + rng.standard_normal(24) * 0.02 for v in vectors[:60]]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    # A search that starts from nothing finds nothing; the links must come out all the same.
    first = spark.createDataFrame([], nn_descent.EDGES)
    monkeypatch.setattr(nn_descent, "_first_graph", lambda *a: first)
    got = {r["id"]: (r["n_links"], r["component"]) for r in nn_descent.near_duplicates(frame, rounds=1).collect()}
    units = np.stack(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = units @ units.T >= 0.95
    np.fill_diagonal(linked, False)
    assert linked.sum() >= 120 and all(got[i][0] == linked[i].sum() for i in range(len(vectors)))
    assert all(got[2400 + k] == (1, k) and got[k] == (1, k) for k in range(60))


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, folder), name)
        assert docs.columns == columns
        assert 0 < docs.count() <= n
        n = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == n
