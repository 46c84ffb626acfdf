from __future__ import annotations

import itertools
import random

from marlstone.llm import common, pieces, queries
from marlstone.llm.queries import tokenizer_file


def model(ranked: list[str], scores: dict[str, float] | None = None) -> pieces.Model:
    found = {p: (i, -float(i)) for i, p in enumerate(ranked)}
    found |= {p: (found[p][0], s) for p, s in (scores or {}).items()}
    return pieces.Model(found, "bpe", [""] * 500, 200, max(map(len, ranked)))


def test_turns():
    got = pieces.turns(model(["bc", "abc", "ab", "xyz", "a", "b", "c"]))
    assert got == {"bc": (1, 0, 0, 0), "abc": (1, 1, 0, 0), "ab": (1, 2, 0, 0)}  # abc never comes of ab and c; xyz never at all
    got = pieces.turns(model(["cabab", "abab", "abc", "ab", "a", "b", "c"]))
    assert got["abc"] == (2, 3, 0, 2) and got["abab"] == (2, 3, 2, 1)  # right after the first and the second ab
    assert got["cabab"] == (1, 3, 3, 3)  # right after abab


def test_one_pass_is_the_merges_in_their_order(spark):
    draw = random.Random(3)
    many = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("abc", repeat=n)]
    models = [model(["aa", "ab", "ba", "aab", "abab", "bc", "aaab", "cab", "bca", "a", "b", "c"]), model(["abc", "aba", "abab", "ab", "bba", "bb", "cabab", "a", "b", "c"])]
    models += [model(draw.sample(many, 40)) for _ in range(5)]
    words = list({"".join(draw.choices("aabbcé", k=draw.randint(1, 60))) for _ in range(800)} | {"a" * n for n in range(1, 61)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for m in models:
        assert {r.word: r.ids for r in pieces.lattice(df, m, spark).collect()} == {w: pieces.fold(w, m) for w in words}
        assert not pieces.tied(m)
    equal = model(["abc", "ab", "bc", "a", "b", "c"], {"bc": -1.0})  # units that hold either take the fold that looks for the best pair
    assert pieces.tied(equal) == ["ab", "bc"]
    assert {r.word: r.ids for r in pieces.lattice(df, equal, spark).collect()} == {w: pieces.fold(w, equal) for w in words}


def test_public_model(spark):
    m = pieces.read_model(tokenizer_file("piece_bpe_32k.model"))
    assert pieces.tied(m) == ["▁▁"]
    draw = random.Random(4)
    some = list(m.pieces)
    words = list({"".join(draw.choices(some, k=draw.randint(1, 6)))[:60] for _ in range(3000)} | {"▁" * n for n in range(1, 61)})
    got = pieces.lattice(spark.createDataFrame([(w,) for w in words], "word string"), m, spark).collect()
    assert len(got) == len(words) and {r.word: r.ids for r in got} == {w: pieces.fold(w, m) for w in words}


def test_texts_are_not_written_again(spark, monkeypatch):
    """Copies, whole copies, empty texts and rows without an id get their ids, though no row is numbered."""
    written = []

    def told(df, name, by=None):
        written.append((name, df.columns))
        return common.durable(df, name, by)

    monkeypatch.setattr(pieces, "durable", told)
    file = tokenizer_file("piece_bpe_32k.model")
    rows = [(1, "zig zag zug"), (2, "zig zag zug"), (3, "zag 漢字 " + "q" * 70), (3, "zag 漢字 " + "q" * 70), (4, ""), (5, None), (None, " zug\n\nzig "), (6, "▁ zig")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.text), list(r.ids)) for r in pieces.encode(df, file, most=1).collect())
    m = pieces.read_model(file)
    assert got == sorted((str(i), str(t), [x for u in pieces.units(t or "") for x in pieces.fold(u, m)]) for i, t in rows)
    assert written and not any("text" in columns for _, columns in written)


def test_parts_have_the_ids_of_their_units():
    draw = random.Random(6)
    many = ["".join(p) for n in (1, 2, 3, 4) for p in itertools.product("abc▁", repeat=n)]
    for n in range(8):
        m = model([*draw.sample([p for p in many if pieces.BLANK not in p.lstrip(pieces.BLANK)], 30), "a", "b", "c", "é"])
        m.kind = "unigram" if n == 7 else "bpe"
        texts = [None, "", *("".join(draw.choices("aabc é\n漢▁", k=draw.randint(1, 90))) for _ in range(300))]
        got = pieces.Cutter(m).cut(texts)
        assert len(set(got.words)) == len(got.words) and got.size.tolist() == [len(w) for w in got.words]
        for i, t in enumerate(texts):
            own = [got.words[k] for k in got.which[got.bounds[i] : got.bounds[i + 1]]]
            assert "".join(own) == "".join(pieces.units(t or ""))
            assert [x for w in own for x in pieces.fold(w, m)] == [x for u in pieces.units(t or "") for x in pieces.fold(u, m)]
        text, word = got.rare(got.known({got.words[0]: 0}))
        for i, t in enumerate(texts):
            own = [got.words[k] for k in got.which[got.bounds[i] : got.bounds[i + 1]]]
            assert [got.words[k] for k in word[text == i]] == [w for w in dict.fromkeys(own) if w != got.words[0] and len(w) <= pieces.LONGEST]


def test_decoded_by_characters_and_by_bytes(spark):
    file = tokenizer_file("piece_bpe_32k.model")
    texts = ["plain text", " lead", "line\nbreak", "漢字 \ue000 \ue001", "\U0001d4b3 é", "", "a, b,c", "\x00\x7f\x80"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = pieces.encode(df, file, keep=("text",)).withColumn("back", pieces.decoded("ids", file)).collect()
    assert sorted((r.text, r.back) for r in got) == sorted((t, t) for t in texts)


def test_texts_come_back_in_the_pass_that_spells_them(spark, sf_dir):
    """The query decodes no ids one by one in expressions; texts that come back are those of decoded()."""
    file = tokenizer_file("piece_bpe_32k.model")
    texts = ["plain text", " lead", "  two", "line\nbreak", "漢字  ", "\U0001d4b3 é", "", None, " ", "\n", "a▁b ▁", "\x00\x7f\x80 ÿ", "q" * 70 + " é", "one " * 3000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for most in (1, pieces.DICTIONARY):
        got = pieces.encode(df, file, keep=("text",), most=most, back="back").withColumn("decoded", pieces.decoded("ids", file)).collect()
        assert len(got) == len(texts) and all(r.back == r.decoded == (r.text or "").replace(pieces.BLANK, " ") for r in got)
    empty = pieces.encode(df.where("text is null or text = ''"), file, keep=("text",), back="back").collect()
    assert [(r.ids, r.back) for r in empty] == [([], "")] * 2
    plan = queries.op8_sentencepiece(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "transform(" not in plan


def test_parts_are_cut_in_the_bytes_of_the_texts():
    """No word becomes a Python string until it is asked for; ASCII, Latin-1 and wider texts are cut alike."""
    m = pieces.read_model(tokenizer_file("piece_bpe_32k.model"))
    cutter = pieces.Cutter(m)
    kinds = (["", "plain the words"], ["née à l'été", None, "the ÿ"], ["漢字 \U0001d4b3", "the é"], ["▁ a▁▁b", "  "], [None, ""])
    for texts in [*kinds, [t for k in kinds for t in k]]:
        got = cutter.cut(texts)
        assert "words" not in vars(got)
        own = ["".join(got.words[k] for k in got.which[a:b]) for a, b in itertools.pairwise(got.bounds)]
        assert own == ["".join(pieces.units(t or "")) for t in texts]
        assert len(set(got.words)) == len(got.words) and got.told.to_pylist() == got.words


def test_blocks_are_of_texts_not_of_compressed_ones():
    assert list(pieces._spans([3, 3, 3, 50, 0, 2], 7)) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(pieces._spans([], 7)) == []


def test_blanks_without_a_piece_come_back(spark, monkeypatch):
    """A model that spells a lone blank as bytes gives the texts back, too."""
    file, read = tokenizer_file("piece_bpe_32k.model"), pieces.read_model

    def without(*args):
        m = read(*args)
        m.pieces = {p: x for p, x in m.pieces.items() if p.strip(pieces.BLANK)}
        return m

    monkeypatch.setattr(pieces, "read_model", without)
    texts = ["plain text", " 漢 \x00", " ", "a  b "]
    got = pieces.encode(spark.createDataFrame([(t,) for t in texts], "text string"), file, keep=("text",), back="back").collect()
    assert sorted((r.text, r.back) for r in got) == sorted((t, t) for t in texts)
