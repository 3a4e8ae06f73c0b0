def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["cluster", "feature", "n", "mean", "median", "std"]
    assert len(rows) == 4 * 5
    sizes = {r["cluster"]: r["n"] for r in rows if r["feature"] == "total_spent"}
    means = {r["cluster"]: r["mean"] for r in rows if r["feature"] == "total_spent"}
    assert sorted(sizes) == [0, 1, 2, 3]
    # clusters are numbered by descending mean spend
    assert [means[c] for c in range(4)] == sorted(means.values(), reverse=True)


def test_other_queries_stay_when_the_corpus_queries_cannot_be_imported(monkeypatch):
    import sys

    import pytest

    import __spark_entry__ as E
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # as if it, or a library it needs, were missing
    with pytest.warns(UserWarning, match="left out"):
        names = set(E.queries())
    assert "a10_customer_features" in names and "pipeline" not in names and not any(n.startswith("op1") for n in names)
