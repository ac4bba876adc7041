"""Every operator on nulls, empty and long texts, repeated rows, clashing columns, and an empty table."""

import pytest
from corpus_rows import edge, edge_rows, none  # noqa: F401

from touchline.llm import decontam, fingerprint, language, lm, mixing, neardup, pii, quality, repeats, secrets


def _labels(docs):
    return docs.sparkSession.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")


def _items(docs):
    return docs.sparkSession.createDataFrame([(0, "cat sat on a mat", "while rain fell"), (1, None, None), (None, "", "")],
                                             "item_id long, question string, answer string")


OPERATORS = {
    "language": lambda d: language.identify(d, language.fit_languages(d)),
    "pii": pii.find_pii,
    "redact": pii.redact,
    "repeats": repeats.remove_repeats,
    "mixing": mixing.mix_sources,
    "fingerprint": fingerprint.compare_with_next,
    "fingerprints": fingerprint.fingerprints,
    "lm": lambda d: lm.score_texts(d, *lm.learn(d)),
    "secrets": secrets.find_secrets,
    "neardup": neardup.near_duplicates,
    "quality": lambda d: quality.score_quality(d, quality.fit_quality(d, _labels(d))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_rows(name, edge, none, edge_rows):
    out = OPERATORS[name](edge)
    assert len(out.columns) == len(set(out.columns))
    assert len(out.collect()) == len(edge_rows)
    assert OPERATORS[name](none).collect() == []


def test_edge_rows_of_leaks(edge, none):
    hits = decontam.leaks(edge, _items(edge)).collect()
    assert {(r.doc_id, r.item_id) for r in hits} == {(1, 0), (5, 0), (8, 0), (None, 0)}
    assert decontam.leaks(none, _items(edge)).collect() == []
    assert decontam.leaks(edge, _items(edge).limit(0)).collect() == []
    left = decontam.without_leaks(edge, _items(edge))
    assert left.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 2, 3, 4, 6, 7, 9]
