from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as cp
from quarry.llm.common import read, saved
from tests.llm.helpers import SF, documents, empty_documents, odd_documents
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check_layout, expected


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = read(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        docs = saved(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_the_four_asked_for():
    assert [n for n, _ in cp.STAGES] == ["quality", "language", "near_duplicates", "packing"]


def test_quality_keeps_good_and_drops_bad(outputs):
    kept = ids(outputs[0])
    label = {x["doc_id"]: x["quality"] for x in documents("labels")}
    judged = [(i in kept, q == 1) for i, q in label.items()]
    assert sum(a == b for a, b in judged) > 0.95 * len(judged)
    assert set(kept) < {d["doc_id"] for d in documents()}


def test_columns_and_rows_survive_unchanged(spark, outputs):
    source = {d["doc_id"]: d for d in documents()}
    for df in outputs[:3]:
        assert df.columns == read(spark, SF, "documents").columns
        for r in df.collect():
            assert r.asDict() == source[r.doc_id]


def test_language_keeps_what_it_knows(outputs):
    before, after = ids(outputs[0]), ids(outputs[1])
    assert after <= before and sum(after.values()) > 0.98 * sum(before.values())


def test_one_document_of_each_group_stays(outputs):
    rows = [(r.doc_id, r.text) for r in outputs[1].collect()]
    by_words = brute_five(rows)
    assert ids(outputs[2]) == Counter(set(by_words.values()))


def brute_five(rows):
    from tests.llm import test_jaccard

    old = test_jaccard.shingle_set
    test_jaccard.shingle_set = lambda text, k=5: old(text, k)
    try:
        return {d: c for d, _, c, _ in brute(rows, 80)}
    finally:
        test_jaccard.shingle_set = old


def test_packing_holds_every_document_left(outputs):
    rows = outputs[3].collect()
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == expected((r.doc_id, r.text) for r in outputs[2].collect())
    check_layout(rows)


def test_run_gives_the_last_stage(spark, outputs):
    got = cp.run(spark, SF)
    assert got.columns == outputs[3].columns
    assert Counter(r.doc_id for r in got.collect()) == Counter(
        r.doc_id for r in outputs[3].collect())


def test_rows_without_an_id_or_with_the_same(spark):
    texts = [f"w{i} " * 30 + " ".join(f"x{i}-{j}" for j in range(40)) for i in range(3)]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[2]),
            (9, texts[2] + " more"), (5, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = cp.near_duplicates_stage(spark, df, SF).collect()
    assert Counter(map(tuple, got)) == Counter(
        [(None, texts[0]), (None, texts[1]), (4, texts[2]), (5, "")])


def test_near_copies_without_an_id(spark):
    texts = [" ".join(f"{t}{j}" for j in range(60)) for t in "abcd"]
    rows = [(4, texts[0]), (None, texts[0]), (None, texts[0] + " more"),
            (None, texts[1]), (None, texts[1]), (None, texts[1] + " more"),
            (None, texts[2]), (None, ""), (None, ""), (None, None),
            (5, texts[0] + " other"), (5, texts[3])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter(map(tuple, cp.near_duplicates_stage(spark, df, SF).collect()))
    of_b = [x for x in got if x[0] is None and (x[1] or "").startswith("b0")]
    assert len(of_b) == 1 and got[of_b[0]] == 1
    del got[of_b[0]]
    assert got == Counter([(4, texts[0]), (None, texts[2]), (None, ""), (None, None),
                           (5, texts[3])])


def test_texts_of_one_id_in_different_groups_lose_nothing(spark):
    texts = [" ".join(f"{t}{j}" for j in range(60)) for t in "abc"]
    rows = [(5, texts[0]), (5, texts[1]), (7, texts[1] + " more"), (8, texts[2]), (5, ""),
            (5, " "), (9, texts[2] + " more"), (8, texts[2] + " other"), (None, texts[2])]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        got = [tuple(r) for r in cp.near_duplicates_stage(spark, df, SF).collect()]
        assert sorted(i for i, _ in got) == [5, 5, 5, 8]
        assert {t for i, t in got if i == 5 and t.strip()} == {texts[0], texts[1]}
        [last] = [t for i, t in got if i == 8]
        assert last in (texts[2], texts[2] + " other")


def test_every_group_keeps_one_row_whatever_its_ids(spark):
    """Groups of near copies under few ids, by brute force over texts."""
    import random

    rng = random.Random(7)
    bases = [" ".join(f"{t}{j}" for j in range(50)) for t in "pqrst"]
    rows = [(rng.choice([1, 2, 3, 4, None]), rng.choice(bases) + rng.choice(["", " x", " y z"]))
            for _ in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in cp.near_duplicates_stage(spark, df, SF).collect()]
    for base in bases:
        group = [r for r in rows if r[1].startswith(base)]
        kept = [r for r in got if r[1].startswith(base)]
        ids_ = [i for i, _ in group if i is not None]
        assert len(kept) == bool(group) and set(kept) <= set(group)
        assert not kept or kept[0][0] == min(ids_, default=None)


def test_the_row_that_stays_does_not_depend_on_the_run(spark):
    text = " ".join(f"w{j}" for j in range(30))
    rows = [(1, text, "en", s, n) for s in ("b", "a", None) for n in (3, 2)]
    rows += [(None, "other " + text, "en", s, 1) for s in "zy"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    seen = set()
    for parts in (1, 2, 5):
        df = spark.createDataFrame(rows[::-1 if parts == 2 else 1], schema).repartition(parts)
        got = cp.near_duplicates_stage(spark, df, SF)
        assert got.columns == df.columns
        seen.add(frozenset(map(tuple, got.collect())))
    assert len(seen) == 1 and len(next(iter(seen))) == 1


@pytest.mark.parametrize("make", [odd_documents, empty_documents])
def test_odd_and_empty_tables(spark, make):
    docs = make(spark)
    columns = docs.columns
    for name, stage in cp.STAGES[:3]:
        docs = saved(stage(spark, docs, SF), f"odd-{name}")
        assert docs.columns == columns
    cp.packing_stage(spark, docs, SF).collect()
