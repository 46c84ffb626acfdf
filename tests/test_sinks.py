"""File scans beyond the plain census, copies that are compared before a delete, and sinks."""

from pyspark.sql import functions as F

from marlstone.sources import files


def put(folder, **named):
    for name, body in named.items():
        path = folder / name.replace("__", "/").replace("_", ".")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)


def test_scans(spark, tmp_path):
    put(tmp_path, a_pdf=b"1", docs__b_pdf=b"2", sub__c_PDF=b"3", t_jpg=b"4")
    assert {r.rel for r in files.scan_unmanaged(spark, str(tmp_path), ["pdf"]).collect()} == {"a.pdf", "sub/c.PDF"}
    tiles = files.scan(spark, str(tmp_path), ["png", "jpg"])
    assert [r.rel for r in files.first_kind(tiles).collect()] == ["t.jpg"]
    put(tmp_path, u_png=b"5")
    assert [r.rel for r in files.first_kind(files.scan(spark, str(tmp_path), ["png", "jpg"])).collect()] == ["u.png"]


def test_verified_copies(spark, tmp_path):
    put(tmp_path / "s", a_bin=b"1", d__b_bin=b"2")
    put(tmp_path / "c", a_bin=b"1", d__b_bin=b"2")
    got = lambda: {r.rel: (r.status, r.may_delete) for r in files.verified_copies(spark, str(tmp_path / "s"), str(tmp_path / "c")).collect()}
    assert got() == {"a.bin": ("ok", True), "d/b.bin": ("ok", True)}
    put(tmp_path / "c", a_bin=b"x")
    assert got() == {"a.bin": ("mismatch", False), "d/b.bin": ("ok", False)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "one", None), (2, "two", 3)], "doc long, text string, n int")
    files.write_json(df, f"{tmp_path}/j")
    assert {r.value for r in spark.read.text(f"{tmp_path}/j").collect()} == {'{"doc":1,"text":"one","n":null}', '{"doc":2,"text":"two","n":3}'}
    files.write_texts(df, f"{tmp_path}/t", "text", ["doc"])
    assert {(r.doc, r.value) for r in spark.read.text(f"{tmp_path}/t").collect()} == {(1, "one"), (2, "two")}
    assert [r.x for r in df.select(files.filled("{a}: {b}", a=F.col("doc"), b=F.col("n")).alias("x")).collect()] == ["1: —", "2: 3"]
