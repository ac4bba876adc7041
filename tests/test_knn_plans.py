"""What the nearest-neighbour queries plan, write and send."""

import os

import numpy as np
import pandas as pd
import pytest

from touchline.operators import cells, knn
from touchline.operators import models as ml


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(600).selectExpr("id AS MatchId", "CAST(id % 3 AS INT) AS label", "CAST(id % 17 AS DOUBLE) AS a", "CAST(id % 13 AS DOUBLE) AS b")


def test_sampled_rows_are_stored_before_the_search(rows, monkeypatch):
    """Planning the search on top of the sample's own plan took all memory of a driver of 750 MB."""
    seen, search = [], ml.knn_predict

    def noted(train, test, *rest):
        seen.append(test._jdf.queryExecution().optimizedPlan().toString())
        return search(train, test, *rest)
    monkeypatch.setattr(ml, "knn_predict", noted)
    train, test = rows.filter("MatchId % 5 > 0"), rows.filter("MatchId % 5 = 0")
    done = ml.knn_evaluate(train, test, ["a", "b"], k=3, fraction=0.1)
    assert done.predictions.count() == 12
    assert "Relation" in seen[0] and "Join" not in seen[0] and "Window" not in seen[0]


def test_many_pieces_are_met_in_rounds(spark, monkeypatch):
    """What moves at a time is bounded, however many pieces a query wants; a round's shuffle files are freed as it ends."""
    r, tables = np.random.default_rng(5), []
    rows = pd.DataFrame(r.normal(size=(400, 6)), columns=list("abcdef"))  # no near rows: nearly every piece is wanted
    rows["MatchId"], rows["label"] = np.arange(400), np.arange(400) % 3
    df, write = spark.createDataFrame(rows), knn.kept
    monkeypatch.setattr(knn, "kept", lambda table, name: tables.append(name) or write(table, name))
    plain = knn.knn_neighbours(df, df, list("abcdef"), "label", 4).collect()
    tables.clear()
    got = knn.knn_neighbours(df, df, list("abcdef"), "label", 4, max_pairs=0, piece_rows=50, round_bytes=20_000).collect()
    assert tables.count("knn-met") > 8
    assert sorted(map(tuple, got)) == sorted(tuple(row[c] for c in got[0].__fields__) for row in plain)
    assert spark.conf.get(knn._FREED) == "false"


def test_tables_of_the_search_are_deleted(rows, monkeypatch):
    """Of what the search writes only the lists of neighbours stay."""
    tables, write = {}, knn.kept
    monkeypatch.setattr(knn, "kept", lambda table, name: tables.setdefault(name, write(table, name)))
    found = knn.knn_neighbours(rows, rows, ["a", "b"], "label", 4, max_pairs=0, piece_rows=100)
    there = {name for name, table in tables.items() if os.path.exists(table.kept_at.removeprefix("file:"))}
    assert set(tables) >= {"knn-train", "knn-queries", "knn-cells", "knn-homes", "knn-found"} and there <= {"knn-found", "knn-met"}
    assert found.count() == 4 * 600


def test_rounds_hold_every_piece_once():
    counts = np.array([0, 10, 5000, 3, 40, 0, 7])
    rounds = cells.meeting_rounds(counts, 4, 100, 1000, 100_000)
    assert sorted(p for names, share, _ in rounds if share == 0 for p in names.tolist()) == [1, 2, 3, 4, 6]
    shares = [(share, n) for names, share, n in rounds if names.tolist() == [2]]
    assert len(shares) > 1 and shares == [(i, len(shares)) for i in range(len(shares))]
