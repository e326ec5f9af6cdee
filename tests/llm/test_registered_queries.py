"""The registered queries themselves, on a folder of tables with null ids, repeated rows and a very long text."""

import hashlib
import random

import pytest

from storeloom.llm.all_queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
WORDS = ["river", "stone", "window", "garden", "letter", "morning", "silver", "market", "winter", "bridge", "music", "paper"]
PASSAGE = " ".join(f"bench{i}" for i in range(20))
LONG_ID = 6


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)

    def prose(n):
        return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))

    repeated = (3, prose(60), "en", "b", 1)
    rows = [(1, prose(80), "en", "a", 1), (2, None, None, "a", 0), repeated, repeated, (None, prose(50), "en", "a", 1),
            (None, None, None, None, None), (5, "", "de", "a", 0),
            (LONG_ID, prose(120_000) + f" {PASSAGE} mit license password=abcdef12", "en", "c", 1)]
    root = str(tmp_path_factory.mktemp("tables"))
    for name, data in (("full", rows), ("none", [])):
        spark.createDataFrame(data, SCHEMA).write.parquet(f"{root}/{name}/documents.parquet")
        spark.createDataFrame([("b1", PASSAGE), ("b2", None)], "item_id string, text string").write.parquet(f"{root}/{name}/benchmark.parquet")
    return root, rows


def ids(got):
    return sorted((r["doc_id"] for r in got), key=lambda x: (x is not None, x))


@pytest.mark.parametrize("name", ["op4_secret_scan", "op8_license_scan", "op9_benchmark_decontamination"])
def test_one_row_per_document(spark, tables, name):
    root, rows = tables
    got = QUERIES[name](spark, f"{root}/full").collect()
    assert ids(got) == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    assert len({tuple(r) for r in got if r["doc_id"] == 3}) == 1
    long = next(r for r in got if r["doc_id"] == LONG_ID)
    if name.startswith("op4"):
        start, end = rows[-1][1].index("password"), len(rows[-1][1])
        assert long["n_assign"] == 1 and long["base_sha256"] == hashlib.sha256(f"assign:{start}:{end}".encode()).hexdigest()
    elif name.startswith("op8"):
        assert long["base_labels"] == "mit" and long["first_word"] == long["last_word"] == 120_020
    else:
        assert long["n_hit"] == 20 and long["n_items"] == 1 and not long["contaminated"]
    assert QUERIES[name](spark, f"{root}/none").count() == 0


def test_packing_of_whole_documents(spark, tables):
    root, rows = tables
    got = QUERIES["op3_best_fit_packing"](spark, f"{root}/full").collect()
    long = sorted((r for r in got if r["doc_id"] == LONG_ID), key=lambda r: r["piece"])
    assert [r["start"] for r in long] == [4096 * k for k in range(len(long))] and all(r["length"] == 4096 for r in long[:-1])
    assert len([r for r in got if r["length"] == 1]) == 3  # no text: the end alone
    assert len(got) == len(rows) - 1 + len(long)
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert QUERIES["op3_best_fit_packing"](spark, f"{root}/none").count() == 0


def test_jaccard_classes_of_whole_texts(spark, tables):
    root, rows = tables
    got = QUERIES["op6_ngram_jaccard_join"](spark, f"{root}/full").collect()
    words = [(i, (t or "").lower().split()) for i, t, *_ in rows]
    sizes = [(i, len({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}) if w else 0) for i, w in words]
    order = lambda x: (x[0] is not None, x)
    assert sorted(((r["doc_id"], r["n_shingles"]) for r in got), key=order) == sorted(sizes, key=order)
    assert all(r["component_id"] == r["doc_id"] for r in got if r["doc_id"] is not None)
    assert QUERIES["op6_ngram_jaccard_join"](spark, f"{root}/none").count() == 0
