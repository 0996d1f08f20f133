"""Repeated passages by sentence-bounded units: against a plain version, and for passages inside lines."""

from __future__ import annotations

import random

from farebox.llm.passage_dedup import PIECES, remove_passages, units_of
from odd import DOCUMENTS, row, sentence


def prose(seed, sentences):
    draw = random.Random(seed)
    return " ".join(sentence(seed * 1000 + k, draw.randrange(4, 14)).capitalize() + draw.choice(".!?") for k in range(sentences))


def plain(rows, min_words):
    first, out = set(), {}
    for i, text in sorted(set(rows)):
        gone = set()
        units = list(units_of(text, min_words))
        for start, stop, digest in units:
            if digest in first:
                gone |= set(range(start, stop))
            first.add(digest)
        out[i] = "".join(c for k, c in enumerate(text) if k not in gone)
    return out


def test_pieces_are_the_whole_text():
    for text in ("", "a", "a.b", "..a!? b\n\n c", "\n", prose(1, 20)):
        assert "".join(PIECES(text)) == text
    assert list(units_of("too short.", 4)) == []


def test_passages_that_begin_and_end_inside_lines(spark):
    passage = prose(1, 8)
    rows = [(k, f"{prose(10 + k, 3)} {passage} {prose(50 + k, 2)}\n{prose(90 + k, 2)}") for k in range(12)]
    rows += [(20, "A short remark. " + prose(70, 5)), (21, "A short remark. " + prose(71, 5)), (22, prose(72, 40))]
    out = {x.doc_id: x for x in remove_passages(spark.createDataFrame([row(*r) for r in rows[::-1]], DOCUMENTS)).collect()}
    want = plain(rows, 15)
    assert {i: x.text for i, x in out.items()} == want
    assert out[0].text == rows[0][1] and all(out[k].n_removed == 1 for k in range(1, 12))
    for k in range(1, 12):
        (span,) = out[k].removed
        assert passage.startswith(rows[k][1][span.start : span.end].strip()) or passage in rows[k][1][span.start : span.end]
        assert span.end - span.start > 0.8 * len(passage)
    assert all(out[k].n_removed == 0 for k in (20, 21, 22))


def test_random_texts_equal_plain_version(spark):
    draw = random.Random(5)
    pool = [sentence(k, draw.randrange(2, 9)) + draw.choice([".", "?", "\n", "...\n\n", "! "]) for k in range(60)]
    rows = [(k, "".join(draw.choice(pool) for _ in range(draw.randrange(30)))) for k in range(150)]
    frame = spark.createDataFrame([row(*r) for r in rows], DOCUMENTS).repartition(5)
    out = remove_passages(frame, min_words=8)
    assert {x.doc_id: x.text for x in out.collect()} == plain(rows, 8)


def test_one_line_fifty_thousand_times(spark):
    text = (sentence(1, 20) + "\n") * 50_000
    (out,) = remove_passages(spark.createDataFrame([row(1, text)], DOCUMENTS)).collect()
    assert out.text == sentence(1, 20) + "\n" and [tuple(x) for x in out.removed] == [(len(out.text), len(text))]


def test_empty_and_clashing_names(spark, odd, no_documents):
    assert remove_passages(no_documents).collect() == []
    out = remove_passages(odd)
    assert out.columns == [*[c for c in odd.columns if c != "removed"], "removed", "n_removed"] and out.count() == odd.count()
