"""Leaks of benchmark items: verbatim, re-parameterised, partial, and look-alikes."""

from __future__ import annotations

import re

from corpus_cases import frame, invented
from tidewheel.llm.decontamination import leaks

ITEM = (
    "A train leaves the old harbour of Lisbon with 120 passengers on board and travels for 45 minutes at 80 km"
    " per hour until Maria and 12 other passengers leave it, so how many of the 120 passengers are still on it"
)


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(df):
    return {(r.doc_id, r.item_id): r for r in df.collect()}


def test_reparameterised_questions(spark):
    other = ITEM.replace("120", "75").replace("45", "30").replace("Lisbon", "Bremen").replace("Maria", "Jonas").replace("12 other", "9 other").replace("80 km", "55 miles")
    torn = ITEM.replace("120 passengers on", "75 passengers on").replace("the 120", "the 300").replace("Lisbon", "Bremen")
    merged = ITEM.replace("120", "12")  # two values of the item become one
    lead, tail = invented(1, 60) + " and ", " " + invented(2, 60)
    texts = [lead + ITEM + tail, lead + other + tail, lead + torn + tail, merged, ITEM.upper(), invented(3, 200), lead + ITEM[:180] + tail, None, ""]
    got = found(leaks(frame(spark, texts), bench(spark, ITEM, "too short to tell", None)))
    assert {d for d, _ in got} >= {0, 1, 6} and {i for _, i in got} == {0}
    assert not {d for d, _ in got} & {2, 3, 5, 7, 8}
    assert got[0, 0].n_slots == got[0, 0].n_same_values == 9
    assert (got[1, 0].n_slots, got[1, 0].n_same_values) == (9, 1)  # only the minutes are the same
    assert got[0, 0].coverage > 0.9 and 0.3 <= got[6, 0].coverage < 0.95


def test_same_item_twice_with_other_values(spark):
    other = ITEM.replace("120", "75")
    got = found(leaks(frame(spark, [ITEM + ". " + other + "."]), bench(spark, ITEM)))
    assert got[0, 0].n_found >= 0.9 * got[0, 0].n_windows


def test_copy_after_words_with_inner_capitals(spark):
    """Names inside a word, and text written like a placeholder, leave the values of later names in place."""
    item = ITEM.replace("12 other passengers leave", "12 friends of Maria leave")
    leads = ["As seen on YouTube and on GitHub today, ", "We met at McDonald in town, ", "Write <name> or <NUM> here, ", "a <b>bold</b> start of Tom<br> and "]
    got = found(leaks(frame(spark, [lead + item for lead in leads]), bench(spark, item)))
    assert set(got) == {(k, 0) for k in range(len(leads))}
    assert all(r.n_slots == r.n_same_values == 10 for r in got.values())


def test_conflicting_slots_spoil_only_their_windows(spark):
    """A copy with one of two equal numbers altered is a leak, and so is a long literal passage with slots
    that take one value."""
    altered = ITEM.replace("the 120", "the 300")
    long_item = invented(5, 60) + " add 3 to 5 now"
    merged = long_item.replace("3 to 5", "4 to 4")
    named = ITEM.replace("12 other passengers leave", "12 friends of Maria leave")
    other_name = named.replace("of Maria", "of Jonas")
    got = found(leaks(frame(spark, [altered, merged, other_name]), bench(spark, ITEM, long_item, named)))
    assert {(0, 0), (1, 1), (2, 2)} <= set(got)
    assert (got[0, 0].n_found, got[0, 0].n_windows, got[0, 0].n_slots, got[0, 0].n_same_values) == (29, 35, 8, 8)
    assert (got[1, 1].n_slots, got[1, 1].n_same_values) == (0, 0) and got[1, 1].n_found < got[1, 1].n_windows


def test_benchmark_table(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    words = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    inside = {
        (d.doc_id, i.item_id)
        for d in documents.collect()
        for i in items.collect()
        if f" {words(i.text)} " in f" {words(d.text)} "
    }
    assert set(found(leaks(documents, items))) == inside and inside


def test_odd_repeated_and_empty(spark, odd, none):
    items = bench(spark, ITEM, ITEM)
    assert leaks(odd, items).count() == 0 and leaks(none, items).count() == 0
    assert leaks(odd, items.where("1 = 0")).count() == 0
    twice = frame(spark, [ITEM, ITEM, ITEM], [1, 1, None])
    assert set(found(leaks(twice, items))) == {(1, 0), (1, 1)}


def test_many_placeholders_in_one_text(spark):
    """Work grows with the placeholders: every number gets its own value, also the last of many."""
    from tidewheel.llm.decontamination import _valued

    text = " ".join(f"word {k} km" for k in range(20_000))
    frame_ = spark.createDataFrame([(1, text), (1, text), (2, "In 5 kg and 7 g there are Anna's 3,5")], "doc_id long, text string")
    rows = _valued(frame_, "doc_id").collect()
    numbers = {r.place: r.value for r in rows if r.doc_id == 1 and r.kind == "<num>"}
    assert [numbers[p] for p in sorted(numbers)] == [str(k) for k in range(20_000)]
    assert sorted((r.kind, r.value) for r in rows if r.doc_id == 2) == [("<name>", "Anna"), ("<num>", "35"), ("<num>", "5"), ("<num>", "7"), ("<unit>", "g"), ("<unit>", "kg")]
