"""Line dedup, repeated passages and mixing: against SQL on the driver's and on odd tables, and their own rules."""

import pytest
from compare import assert_same_rows
from odd import DOCUMENTS, row, sentence
from farebox.llm.line_dedup import drop_boilerplate
from farebox.llm.mixing import mix_sources, water_fill
from farebox.llm.queries import ORACLES, QUERIES
from farebox.llm.substring_dedup import remove_repeats

NAMES = ("op5_mix_sources", "op6_line_dedup", "op7_substring_dedup")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, data, name):
    assert assert_same_rows(QUERIES[name](spark, data), data, ORACLES[name]) == 200


@pytest.mark.parametrize("name", NAMES)
def test_odd_documents_equal_sql(spark, odd_folder, name):
    assert assert_same_rows(QUERIES[name](spark, odd_folder), odd_folder, ORACLES[name]) == 31


@pytest.mark.parametrize("operator", [mix_sources, drop_boilerplate, remove_repeats])
def test_empty_tables_and_clashing_names(no_documents, odd, operator):
    assert operator(no_documents).collect() == []
    out = operator(odd)
    assert len(set(out.columns)) == len(out.columns) and "lang" in out.columns and "key" in out.columns


def test_boilerplate_goes_copies_stay(spark):
    rows = [row(k, f"menu of the site\n{sentence(k)}\n  menu of the site ") for k in range(30)] + [row(k, sentence(99)) for k in range(40, 100)]
    rows += [row(200 + k, "rare line\n" + sentence(300 + k), "other") for k in range(9)]
    out = {x.doc_id: x for x in drop_boilerplate(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert out[3].text == sentence(3) and out[3].n_dropped == 2
    assert out[50].text == sentence(99) and out[50].n_dropped == 0
    assert out[200].text == "rare line\n" + sentence(300)


def test_repeats_keep_the_first_and_their_places(spark):
    passage = sentence(1, 60)
    texts = [f"intro\n{passage}\nend", f"{sentence(2)}\n  {passage.upper()} ", f"{passage}\n{passage}", "short line\nshort line"]
    out = {x.doc_id: x for x in remove_repeats(spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], DOCUMENTS)).collect()}
    assert out[0].text == texts[0] and out[0].n_removed == 0
    assert out[1].text == sentence(2)
    assert [texts[1][s:e] for s, e in out[1].removed] == [f"  {passage.upper()} "]
    assert out[2].text == "" and [texts[2][s:e] for s, e in out[2].removed] == [passage, passage]
    assert out[3].text == texts[3]


def test_paragraphs(spark):
    rows = [row(1, f"{sentence(1)}\n\nb"), row(2, f"c\n\n{sentence(1)}")]
    out = {x.doc_id: x.text for x in remove_repeats(spark.createDataFrame(rows, DOCUMENTS), separator="\n\n").collect()}
    assert out == {1: f"{sentence(1)}\n\nb", 2: "c"}


def test_wrapped_passages_go_lone_lines_stay(spark):
    words = sentence(1, 60).split()
    wrapped = "\n".join(" ".join(words[i : i + 12]) for i in range(0, 60, 12))
    texts = [f"Heading\n\n{wrapped}\n\nend", f"Heading\n\n{wrapped.upper()}\n\nother", f"Heading\n\n{' '.join(words)}", "Heading\n\n" + "\n".join(words[:12])]
    out = {x.doc_id: x for x in remove_repeats(spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], DOCUMENTS)).collect()}
    assert (out[0].text, out[3].text) == (texts[0], texts[3])
    assert out[1].text == "Heading\n\n\nother" and out[1].n_removed == 5
    assert "\n".join(texts[1][s:e] for s, e in out[1].removed) == wrapped.upper()
    assert out[2].text == "Heading\n"


def fill_by_rounds(sizes, weights, budget, epochs):
    target, free = dict.fromkeys(sizes, 0.0), {s for s in sizes if weights[s] > 0}
    full: set = set(sizes) - free
    while free:
        left = budget - sum(target[s] for s in full)
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > epochs * sizes[s]}
        if not over:
            return target | share
        target |= {s: epochs * sizes[s] for s in over}
        full |= over
        free -= over
    return target


@pytest.mark.parametrize("ratio", [0.2, 1.0, 1.5, 2.0, 5.0])
def test_water_filling_equals_rounds_of_sharing(spark, ratio):
    sizes = {"a": 10, "b": 1000, "c": 400, "d": 0, "e": 77, "f": 50}
    weights = {"a": 5.0, "b": 2.0, "c": 1.0, "d": 5.0, "e": 0.0, "f": 9.0}
    one = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    two = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = {x.source: x.target for x in water_fill(one, two, ratio, 2.0).collect()}
    assert got == pytest.approx(fill_by_rounds(sizes, weights, ratio * sum(sizes.values()), 2.0))


def test_sources_come_near_their_targets(spark):
    rows = [row(k, sentence(k, 1 + k * 37 % 90), f"s{k % 3 if k % 2 else 9}") for k in range(4000)]
    mixed = mix_sources(spark.createDataFrame(rows, DOCUMENTS)).cache()
    again = mix_sources(spark.createDataFrame(rows, DOCUMENTS).repartition(7))
    assert sorted((x.doc_id, x.copies) for x in mixed.collect()) == sorted((x.doc_id, x.copies) for x in again.collect())
    for x in mixed.groupBy("source", "target").agg({"size": "sum"}).collect():
        taken = sum(y.size * y.copies for y in mixed.filter(mixed.source == x.source).collect())
        assert abs(taken - x.target) < 0.01 * x.target + 100
    assert mixed.filter("copies > 2").count() == 0
    mixed.unpersist()
