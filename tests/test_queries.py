"""Every query of the reference's operators against its oracle."""

import pytest

from marlstone.plans import corpus


@pytest.mark.parametrize("name", sorted(corpus.queries()))
def test_query(name, spark, sf_dir, same):
    df = corpus.queries()[name](spark, sf_dir)
    if name in corpus.oracle_sql():
        same(df, corpus.oracle_sql()[name])
    else:
        assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(corpus.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def tables(spark, folder, **rows):
    for name, (schema, data) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_leak_against_benchmark(spark, tmp_path):
    """Every item that begins alike counts, over whole texts, also after leading blanks."""
    long = [f"w{i}" for i in range(200)]
    docs = [(1, "w0 x"), (2, "\n " + " ".join(long)), (3, "w0 " * 60), (4, None), (5, " "), (6, " ".join(long[:50])), (7, " ".join(long[:48] + ["y"]))]
    items = [(1, " ".join(long[:120])), (2, "w0 x y"), (3, "other words"), (4, None), (5, "")]
    d = tables(spark, tmp_path, documents=("doc_id long, text string", docs), benchmark=("item_id long, text string", items))
    got = {(r.doc_id, r.item_id): r.run for r in corpus.leak_benchmark_runs(spark, d).collect()}
    assert got == {(1, 1): 1, (1, 2): 2, (2, 1): 120, (2, 2): 1, (3, 1): 1, (3, 2): 1, (6, 1): 50, (6, 2): 1, (7, 1): 48, (7, 2): 1}
    r = corpus.leak_metric(spark, d).first()
    assert (r.n, r.exact, r.mean_run, r.ok) == (3, 1, (48 + 2 + 0) / 3, False)


def test_whole_lines_and_names(spark, tmp_path):
    """What stands after the 120th character of a line or the 150th of a text counts."""
    latin = "plain words of one language " * 6
    docs = [(1, latin + "end\nnext"), (2, latin + "漢" * 40), (3, latin + "¶ÇÄÓÂÎß"), (4, None)]
    d = tables(spark, tmp_path, documents=("doc_id long, text string", docs))
    got = {r.doc_id: r for r in corpus.language_plausible_whole(spark, d).collect()}
    assert {i: r.plausible for i, r in got.items()} == {1: True, 2: False, 3: False}
    assert got[1].line == latin + "end"
    names = {r.doc_id: r for r in corpus.clean_short_name_whole(spark, d).collect()}
    assert names[1].name == latin + "end next" and names[2].name == latin + "漢" * 40
    assert {len(r.short) <= 50 for r in names.values()} == {True}
