"""Traced cases and edge cases of single operators."""

import hashlib
import zlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marlstone.functions import rules, text
from marlstone.operators import census, classify, dedupe, fold, gate, grid
from marlstone.sources import files, marks, pages


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'bigint' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


# ---- ordered folds


def reference_chunks(lines, size, overlap):
    """Line by line: the plain statement of the rule."""
    out, have, n = [], [], 0
    for i, x in enumerate(lines):
        have.append(i)
        n += x
        if n >= size:
            out.append((have[0], have[-1]))
            keep, k = [], 0
            while have and overlap > 0 and k < overlap:
                keep.insert(0, have.pop())
                k += lines[keep[0]]
            have, n = keep, k
    return out + ([(have[0], have[-1])] if have else [])


@pytest.mark.parametrize("size,overlap", [(40, 8), (10, 0), (5, 5), (100, 20), (7, 30)])
def test_chunk_lines(size, overlap):
    import random

    r = random.Random(size)
    for _ in range(200):
        lines = [r.choice([1, 2, 3, 9, 51]) for _ in range(r.randint(1, 25))]
        assert fold.line_chunks(lines, size, overlap) == reference_chunks(lines, size, overlap)
    assert len(fold.line_chunks([51, 2, 2, 2, 2, 2, 2], 40, 8)) == 6


def test_chunks(spark):
    df = spark.createDataFrame([(1, "x" * 50 + "\n" + "y\n" * 6), (2, None), (3, "  \n "), (4, "one line"), (5, "")], "doc_id int, text string")
    got = fold.chunks(df, size=40, overlap=8).collect()
    assert [(r.line_from, r.line_to) for r in got if r.doc_id == 1] == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 6)]
    assert [r.text for r in got if r.doc_id == 4] == ["one line"]
    assert {r.doc_id for r in got} == {1, 4}


def test_turn_windows(spark):
    rows = [(1, 0, "system", "a b"), (1, 1, "user", "a b c"), (1, 2, "assistant", "a"), (1, 3, "user", "a b c d e f g h i j"), (1, 4, "assistant", "z"), (2, 0, "system", "s"), (None, 0, "user", "q"), (3, 0, "user", None), (3, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id int, turn long, role string, text string")
    got = {(r.conv_id, r.win): (r.first_turn, r.last_turn, r.tokens, r.trained) for r in fold.turn_windows(df, max_len=12).collect()}
    # head 4; turns 5 + 3 fit; turn 3 is cut to 8 and has no trained token; turn 4 begins anew.
    assert got == {(1, 0): (1, 2, 12, 3), (1, 1): (4, 4, 7, 3), (3, 0): (0, 1, 4, 2)}
    assert fold.turn_windows(df, max_len=4).where("conv_id = 1").count() == 0


def test_page_groups(spark):
    rows = [(1, 1, 0.1, 10.0, 1), (1, 2, 0.3, 10.0, 1), (1, 3, 0.12, 12.0, 1), (1, 4, 0.31, 11.0, 1), (1, 5, 0.1, 10.0, 2), (2, 1, 0.1, 10.0, 1)]
    got = fold.page_groups(spark.createDataFrame(rows, "doc_id int, page int, ink double, line_h double, cols int"))
    assert [r.group for r in got.orderBy("doc_id", "page").collect()] == [0, 1, 0, 1, 2, 0]


def test_leak(spark):
    df = spark.createDataFrame([([1, 2, 3], [1, 2, 3]), ([1, 2, 3], [1, 9, 3]), ([5], [6])], "a array<int>, b array<int>")
    r = fold.leak(df, "a", "b", window=3).first()
    assert (r.n, r.exact, r.mean_run, r.ok) == (3, 1, 4 / 3, False)
    assert fold.leak(df.limit(0), "a", "b").first().ok is False


# ---- geometry


def test_page_spec(spark):
    cases = {"1-3,15": [1, 2, 3, 15], "7-3": [], "0": [], "99": [], "18-40": [18, 19, 20], "x, 2 ,2": [2], "": list(range(1, 21))}
    for spec, want in cases.items():
        assert one(spark, grid.page_spec("s", "n"), s=spec, n=20) == want, spec


def test_samples_and_starts(spark):
    for n, want in {0: [1], 1: [1], 3: [1, 3], 30: [1, 10, 20, 30], 100: [1, 20, 40, 60, 80, 100]}.items():
        assert one(spark, grid.sample_pages("n"), n=n) == want
    for n, want in {10: [0], 20: [0], 21: [0, 1], 40: [0, 15, 20], 35: [0, 15]}.items():
        assert one(spark, grid.overlap_starts("n", 20, 5), n=n) == want
    assert one(spark, grid.clean_starts("n", 10), n=0) == []
    assert one(spark, grid.effective_dpi("px", "pt"), px=3408, pt=818) == 300
    assert one(spark, grid.effective_dpi("px", "pt"), px=0, pt=818) == 300
    assert one(spark, grid.effective_dpi("px", "pt", max_px=1000), px=3408, pt=818) == 88


def test_best_neighbours(spark):
    rows = [("k", i, [float(i), 1.0], [float(i - 1), 1.0]) for i in range(40)] + [("k", 99, None, []), ("other", 5, [1.0, 1.0], [1.0, 1.0])]
    df = spark.createDataFrame(rows, "kit string, id long, o array<double>, i array<double>")
    got = {r.id: (r.match, r.cost) for r in grid.best_neighbours(df, "kit", "id", "o", "i", block=7).collect()}
    assert all(got[i] == (i + 1, 0.0) for i in range(39)) and got[39] == (38, 1.0)
    assert 5 in got and 99 not in got
    truth = spark.createDataFrame([("x", i, i + 1) for i in range(39)], "axis string, id long, neighbour long")
    matches = spark.createDataFrame([("x", i, *got[i]) for i in got if i != 5], "axis string, id long, match long, cost double")
    q = grid.match_quality(matches, truth, 0.5).first()
    assert (q.found, q.correct, q.exact) == (38, 38, 38)


def test_islands(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1, 1, 0, 1, 0, 1, 1])], "p string, i int, v int")
    every = [(r.start, r.length) for r in grid.islands(df, "p", "i", F.col("v") == 1).orderBy("start").collect()]
    assert every == [(1, 2), (4, 1), (6, 2)]
    assert grid.islands(df, "p", "i", F.col("v") == 1, keep_tail=False).count() == 2


# ---- names and text


def test_names(spark):
    assert one(spark, text.shortened("s"), s="a" * 60) == "a" * 50
    assert one(spark, text.shortened("s"), s="b" * 40 + " " + "c" * 30) == "b" * 40
    assert one(spark, text.shortened("s"), s="b" * 10 + " " + "c" * 60) == ("b" * 10 + " " + "c" * 60)[:50]
    assert one(spark, text.cleaned("s"), s=' a/b:  c*?"<x>|. ') == "a b c x"
    for name, want in {"us1234": True, "2105.01234v2": True, "ГОСТ25752-83": False, "длинное имя": False, "abc": True, "漢字": True}.items():
        assert one(spark, text.unreadable("s"), s=name) is want, name
    assert one(spark, text.preprint_id("s"), s="x 2105.01234v2.pdf") == "2105.01234"
    assert one(spark, text.preprint_id("s"), s="12105.01234") is None
    assert one(spark, text.metadata_title("s"), s="Title:   Untitled\n") is None
    assert one(spark, text.metadata_title("s"), s="a\nTitle: Download Precision clocks\nb") == "Precision clocks"
    assert one(spark, text.plausible("s"), s="Ромашка лекарственная аптечная") is True
    assert one(spark, text.plausible("s"), s="¶ÇÄÓÂÎß 2000 Å. ´ÑÏ 170") is False
    assert one(spark, text.memory_mib("s"), s="RTX 3060, 12288 MiB") == 12288
    q = one(spark, text.quality("s"), s="слово word x1 смешaнное ~~")
    assert (q["words"], q["coherent"], q["odd"]) == (3, 2, 2)
    assert one(spark, text.quality("s"), s="  ")["junk"] is None
    assert one(spark, text.patent_name("a", "b"), a="US5272449", b="x\n[54] ATOMIC CLOCK SYSTEM [75]") == "Патент США 5272449 — Atomic Clock System"
    assert one(spark, text.patent_name("a", "b"), a="none", b="") is None


def test_neighbours_in_many_tasks(spark):
    """Blocks aren't gathered in one task because their bytes are few; costs and ties are those of a plain loop."""
    import random

    r = random.Random(5)
    edge = lambda: [float(r.randint(0, 3)) for _ in range(8)]
    rows = [("k", i, edge(), edge()) for i in range(200)] + [("k", 200, [1.0], []), ("l", 1, edge(), edge())]
    df = spark.createDataFrame(rows, "kit string, id long, out array<double>, `in` array<double>")
    found = grid.best_neighbours(df, "kit", "id", "out", "in", block=40)
    want = {i: min((sum(abs(a - b) for a, b in zip(out, into, strict=True)) / 8, j) for _, j, _, into in rows[:200] if j != i) for _, i, out, _ in rows[:200]}
    assert {x.id: (x.cost, x.match) for x in found.collect()} == want
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()


# ---- rights, duplicates, gate


def test_classify(spark):
    df = spark.createDataFrame([(1, "arXiv: by Springer"), (2, "nothing"), (3, None), (4, "ГОСТ25752-83\nтекст")], "doc_id int, text string")
    got = {r.doc_id: r for r in classify.classify(df).collect()}
    assert got[1].verdict == rules.CLOSED and got[1].marker == "Springer" and len(got[1].hits) == 2
    assert got[2].verdict == rules.UNKNOWN and got[3].verdict == rules.UNKNOWN
    assert got[4].snippet == "ГОСТ25752-83 текст"
    c = classify.coverage(classify.classify(df)).first()
    assert (c.total, c.determined, c.percent) == (4, 2, 50.0)
    assert classify.coverage(classify.classify(df.limit(0))).first().percent == 0


def test_override(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "path string, verdict string")
    manual = spark.createDataFrame([("a", "m"), ("old/b", "m")], "path string, verdict string")
    z1 = spark.createDataFrame([("b", "lost")], "current string, original string")
    z2 = spark.createDataFrame([("b", "old/b")], "current string, original string")
    got = {r.path: (r.verdict, r.decided_by) for r in classify.override(rows, manual, classify.aliases(z1, z2)).collect()}
    assert got == {"a": ("m", "manual"), "b": ("m", "alias"), "c": ("x", "rules")}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "A  b"), (2, "A  b"), (3, "a B "), (4, None), (5, None), (6, "z"), (7, "z")], "id int, text string")
    h = df.select("id", dedupe.content_hash("text").alias("sha"), dedupe.signature("text").alias("sig"), F.octet_length("text").alias("bytes"))
    t = dedupe.totals(dedupe.groups(h, "sha", "id", "bytes")).first()
    assert (t.groups, t.extra_copies, t.wasted) == (2, 2, 5)
    near = dedupe.near_groups(h, "sha", "sig", "id").collect()
    assert [(r.n, r.first_id) for r in near] == [(3, 1)]
    assert dedupe.totals(dedupe.groups(h.limit(0), "sha", "id", "bytes")).first().wasted == 0


def test_page_signature(spark):
    docs = spark.createDataFrame([(1, 5, 100), (2, 5, 100), (3, 5, None), (4, None, None), (5, None, 7), (6, 5, 100)], "doc long, pages int, chars int")
    rasters = spark.createDataFrame([(1, 1, b"a"), (1, 2, b"b"), (1, 9, b"x"), (2, 1, b"a"), (2, 2, b"b"), (2, 9, b"other"), (4, 2, b"b"), (5, 3, b"c"), (6, 1, b"a"), (6, 2, None)], "doc long, page int, image binary")
    got = {r.doc: r.signature for r in dedupe.page_signature(docs, rasters, "doc").collect()}
    assert got[1] == got[2] != got[6] and got[3] == got[4] == "" and len(got[5]) == 64
    assert got[1] == hashlib.sha256("\n".join(["pages=5", "txt=100", *(f"p{i}=" + hashlib.sha256(x).hexdigest()[:32] for i, x in ((1, b"a"), (2, b"b")))]).encode()).hexdigest()


def test_gate(spark):
    paths = {"a/chatlog/x.md": "chat transcript", "x.jsonl": "profile transcript", ".env": "environment file", "k/id_rsa": "private key", "docs/a.md": None, "inbox/note.md": None, "a.pem": "key container"}
    for p, want in paths.items():
        assert one(spark, gate.forbidden_path(F.col("p")), p=p) == want, p
    secret = 'token = "abcdefgh1"\nUSER: hi'
    assert one(spark, gate.forbidden_content(F.col("t")), t=secret) == ["key as value", "transcript markup"]
    assert one(spark, gate.forbidden_content(F.col("t"), F.lit(True)), t=secret) == ["key as value"]
    df = spark.createDataFrame([("m/a", rules.PUBLIC), ("m/b", None), ("m/c", rules.CLOSED), ("n/d", None), ("m/e.pointer.md", None)], "path string, verdict string")
    assert [r.path for r in gate.rights_hold(df, ["m/"]).orderBy("path").collect()] == ["m/b", "m/c"]
    assert one(spark, gate.staged(F.col("s")), s="a\x00b\x00") == ["a", "b"]
    v = gate.violations(spark.createDataFrame([(1, "x.jsonl", secret)], "id int, path string, text string"), "path", "text", "id")
    assert v.count() == 3


def test_rules_mean_the_same_everywhere(spark):
    """Letters of other alphabets are no words next to a rule's, and only line feeds end lines."""
    key = "AKIA" + "C3" * 8
    texts = {"é" + key: ["cloud key"], key + "я": ["cloud key"], "e" + key: [], "漢xoxb-" + "d4" * 6: ["chat token"], "a\rUSER: hi": [], "a\x85USER: hi": [], "a\n\r USER\f: hi": ["transcript markup"], "\x0bUSER: hi": [], "ſecret = 'longenough'": ["key as value"]}
    for t, want in texts.items():
        assert one(spark, gate.forbidden_content(F.col("t")), t=t) == want, t
    assert one(spark, gate.forbidden_path(F.col("p")), p="x.pem\n") is None


# ---- census, state


def test_census(spark):
    f = spark.createDataFrame([("r", "a/x", 5), ("r", "a/b/y", 7), ("r", "c", 1), ("q", "a", 2)], "repo string, rel string, bytes long")
    rule = spark.createDataFrame([("r", ["a/"], ["a/b/"])], "repo string, include array<string>, exclude array<string>")
    got = {r.rel: (r.taken, r.reason) for r in census.select(f, rule).collect()}
    assert got == {"a/x": (True, None), "a/b/y": (False, "excluded"), "c": (False, "outside"), "a": (False, "outside")}
    t = {r.repo: (r.taken, r.skipped, r.bytes) for r in census.totals(census.select(f, rule)).collect()}
    assert t == {"r": (1, 2, 5), "q": (0, 1, 0), None: (1, 3, 5)}


def test_moves(spark):
    plan = spark.createDataFrame([("a", "1"), ("b", "2")], "path string, sha256 string")
    good = census.verify_moves(plan, plan, "path").collect()
    assert all(r.may_delete and r.status == "ok" for r in good)
    bad = census.verify_moves(plan, plan.where("path = 'a'"), "path").collect()
    assert not any(r.may_delete for r in bad) and {r.status for r in bad} == {"ok", "missing"}


def test_lookup_and_state(spark):
    docs = spark.createDataFrame([("abc1", 1, None), ("Abc", 2, None), ("abc", 3, "bad")], "id string, place int, error string")
    assert census.lookup(docs, "abc", "id", "place").first().place == 1
    assert census.lookup(docs, "Abc", "id", "place").first().place == 2
    bounds = spark.createDataFrame([(0.0, "s"), (6.0, "m"), (12.0, "l")], "bound double, name string")
    v = spark.createDataFrame([(-1.0,), (6.0,), (24.0,)], "v double")
    assert [r.name for r in census.at_least(v, "v", bounds).orderBy("v").collect()] == [None, "m", "l"]
    assert census.own_state(spark.createDataFrame([("x", "/a"), ("y", "/b")], "step string, folder string"), "/a").count() == 1


# ---- sources


def test_scan(spark, tmp_path):
    for p in ("a/x.PDF", "a/.git/y.pdf", "b.djvu", "c.txt", "inventory.git.pdf"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"%PDF-1.4" if p.lower().endswith("pdf") else b"text")
    got = files.scan(spark, str(tmp_path), ["pdf", "djvu"])
    assert sorted((r.rel, r.ext, r.bytes) for r in got.collect()) == [("a/x.PDF", "pdf", 8), ("b.djvu", "djvu", 4), ("inventory.git.pdf", "pdf", 8)]
    kinds = files.scan(spark, str(tmp_path), content=True).select("rel", files.kind(F.col("path"), F.col("content")).alias("k"))
    assert {r.rel: r.k for r in kinds.collect()} == {"a/x.PDF": "pdf", "b.djvu": "djvu", "c.txt": "unknown", "inventory.git.pdf": "pdf"}
    both = files.scan_zones(spark, {"u": str(tmp_path / "a"), "v": str(tmp_path)}, ["pdf"])
    assert sorted(r.zone for r in both.collect()) == ["u", "v", "v"]


def test_scan_opens_no_file(spark, tmp_path):
    """Names and sizes come from listings; odd names, hidden folders and a pattern as a root too."""
    for p in ("a/b c/ü%20.pdf", "a/k=1/_x=1.pdf", "_no/x.pdf", "a/.hid/x.pdf", "a/_x.pdf", "x.pdf"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_bytes(b"12")
    want = {(r.path, r.rel, r.bytes) for r in files.scan(spark, str(tmp_path), ["pdf"], content=True).collect()}
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        got = files.scan(spark, root, ["pdf"])
        assert "binaryFile" not in got._jdf.queryExecution().toString()
        assert {r.rel for r in got.collect()} == {"a/b c/ü%20.pdf", "a/k=1/_x=1.pdf", "x.pdf"}
        assert {(r.path, r.rel, r.bytes) for r in got.collect()} == want
    assert [r.bytes for r in files.scan(spark, f"{tmp_path}/*.pdf").collect()] == [2]
    assert [r.rel for r in files.scan(spark, str(tmp_path), recursive=False).collect()] == ["x.pdf"]


def test_json(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}\nbroken\n')
    assert [(r.turn, r.role, r.text) for r in files.chat_lines(spark, str(tmp_path / "c.jsonl")).orderBy("turn").collect()] == [(0, "user", "q"), (1, "assistant", "a")]
    assert files.json_table(spark, str(tmp_path / "none.json"), "a int").count() == 0


def test_marks(spark):
    body = b"%PDF /OpenAction /JavaScript /JS /JSx stream\n" + zlib.compress(b"/Launch " * 30) + b"endstream stream\nbroken but long enough here endstream"
    df = spark.createDataFrame([("a", body), ("b", b"plain"), ("c", None), ("d", b"/AA")], "path string, content binary")
    found = marks.marks(df)
    assert {(r.path, r.mark): r.n for r in found.collect()} == {("a", "/OpenAction"): 1, ("a", "/JavaScript"): 1, ("a", "/JS"): 1, ("a", "/Launch"): 30, ("d", "/AA"): 1}
    b = {r.path: r for r in marks.buckets(found).collect()}
    assert b["a"].bucket == "heavy" and b["a"].heavy == ["/JS", "/JavaScript", "/Launch"] and b["d"].bucket == "routine"


def test_marks_by_chance(spark):
    """Deflated bytes that spell a mark don't count; streams of any length inflate, those after a false start too."""
    stored = zlib.compressobj(0)
    chance = stored.compress(b"/AA /AA ") + stored.flush()
    long = zlib.compress(bytes(i * i % 251 for i in range(300_000)) + b"/Launch ", 0)
    body = b"%PDF /AA stream\n" + chance + b"endstream\nstream\n" + long + b"endstream\nstream\nstream\n" + zlib.compress(b"/XFA ") + b"endstream stream\n/Movie endstream"
    df = spark.createDataFrame([("a", body)], "path string, content binary")
    assert {r.mark: r.n for r in marks.marks(df).collect()} == {"/AA": 3, "/Launch": 1, "/XFA": 1, "/Movie": 1}


def test_pages_source(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ftwo")
    spark.dataSource.register(pages.PagesSource)
    got = spark.read.format("pages").option("paths", f"{tmp_path}/a.txt\n{tmp_path}/none.txt\n{tmp_path}/x.djvu").load().collect()
    assert sorted((r.page, r.pages, r.text) for r in got if r.error is None) == [(1, 2, "one"), (2, 2, "two")]
    assert len([r for r in got if r.error]) == 2


def test_parts_and_texts(spark):
    df = spark.createDataFrame([(1, bytearray(b"abcdefg")), (2, bytearray(b""))], "id int, content binary")
    assert [bytes(r.content) for r in files.split_parts(df, "content", 3).orderBy("part").collect()] == [b"abc", b"def", b"g"]
    s = one(spark, files.page_sizes(F.col("s")), s="Page 1 size: 595.5 x 842 pts\nPage 2 size: 10 x 20 pts")
    assert [(x["w"], x["h"]) for x in s] == [(595.5, 842.0), (10.0, 20.0)]
    xml = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A\n b</title><author><name>X</name></author><author><name>Y</name></author></entry></feed>'
    f = files.atom_entry(F.col("s"))
    assert one(spark, f["title"], s=xml) == "A b" and one(spark, f["authors"], s=xml) == "X, Y" and one(spark, f["license"], s=xml) == "—"
    assert "and 1 more" in files.markdown(spark.range(3), ["id"], ["id"], 2)


# ---- streams


def _stream(spark, tmp_path, df, parts):
    for i, p in enumerate(parts):
        p.coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in*"))


def test_gated_stream(spark, tmp_path):
    from marlstone.streaming import watch

    df = spark.createDataFrame([('{"tool_input": {"file_path": "a/chatlog/x"}}',), ('{"tool_input": {"path": "ok.md"}}',), ("broken",)], "event string")
    q = watch.gated(_stream(spark, tmp_path, df, [df])).writeStream.format("memory").queryName("gated").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.blocked for r in spark.table("gated").collect()) == [False, False, True]


def test_stalls_stream(spark, tmp_path):
    from marlstone.streaming import watch

    t = datetime(2024, 1, 1)
    at = lambda s: t + timedelta(seconds=s)
    make = lambda rows: spark.createDataFrame(rows, "run string, ts timestamp, size long")
    parts = [make([("a", at(0), 1), ("b", at(0), 1)]), make([("a", at(40), 1), ("b", at(40), 2)]), make([("c", at(70), 1)]), make([("c", at(71), 2)])]
    q = watch.stalls(_stream(spark, tmp_path, parts[0], parts)).writeStream.format("memory").queryName("stalls").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert [r.run for r in spark.table("stalls").collect()] == ["a"]


def test_stalls_in_small_batches(spark, tmp_path):
    """The rows of a run may reach the function in several batches that aren't in order; milliseconds are whole."""
    from marlstone.streaming import watch

    t = datetime(2024, 1, 1)
    rows = [("a", t + timedelta(milliseconds=60_001 - i), 100 - i % 50) for i in range(50)] + [("a", t + timedelta(milliseconds=1001 + i), 100) for i in range(20)] + [("a", None, 5), ("z", t + timedelta(seconds=300), 1)]
    df = spark.createDataFrame(rows, "run string, ts timestamp, size long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = watch.drained(watch.stalls(_stream(spark, tmp_path, df, [df])), "stalls").select("run", F.unix_millis("last").alias("last"), "seen").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert list(map(tuple, got)) == [("a", 1_704_067_201_001, 70)]


def test_upsert(spark, tmp_path):
    from marlstone.streaming import watch

    write = watch.upsert_latest(str(tmp_path / "state"), "run", "ts")
    make = lambda rows: spark.createDataFrame(rows, "run string, ts int, step int")
    write(make([("a", 1, 1), ("b", 1, 1)]), 0)
    write(make([("a", 2, 5)]), 1)
    write(make([("a", 2, 5)]), 1)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "state/v=1")).collect())) == [("a", 2, 5), ("b", 1, 1)]
