"""Groups of the frequency shuffle are bounded, whatever the corpus."""

from pulseloom.llm import jaccard


def test_spread():
    assert jaccard.spread(1, 4) == 4
    for total in (10**6, 10**9, 10**11):
        assert total / jaccard.spread(total, 4) <= jaccard.CELLS


def test_more_ranges_than_partitions(spark, monkeypatch):
    """The result does not depend on the number of ranges, and a range holds about as many cells as stated."""
    word = [f"w{i}" for i in range(60)]
    data = [(i, " ".join(word[(i // 3 * 7 + k + (k == i % 3)) % 60] for k in range(30))) for i in range(120)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    expected = sorted(tuple(r) for r in jaccard.report(docs).collect())
    made, cells = [], jaccard._cells
    monkeypatch.setattr(jaccard, "CELLS", 100)
    monkeypatch.setattr(jaccard, "_cells", lambda bits, ranges: made.append(ranges) or cells(bits, ranges))
    assert sorted(tuple(r) for r in jaccard.report(docs).collect()) == expected
    assert len(made) == 1 and made[0] > 4
