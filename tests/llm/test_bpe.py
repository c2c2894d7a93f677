import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedlark.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["the", " ", "  ", "\n", "'", "'re", "'ll", "'s", "é", "𝄞", "ß", "1", "23", "a", "Z", "!", "?!", "\t", " ", "　",
          "<|endoftext|>", "<|endof", "|>", "aaaa", "===", "\x1c", "​", "日本", "́"]


@pytest.fixture(scope="module")
def v():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(text, v, block):
    return [i for group in bpe.encode(text, v, block) for i in group]


def test_any_block_size_gives_the_library_s_ids(v, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_PIECE", 8)
    rnd = random.Random(11)
    for n in range(1500):
        text = "".join(rnd.choices(PIECES, k=rnd.randint(0, 25)))
        if n % 5 == 0:
            text += rnd.choice([" ", "x", "é", "\n", "7", "=", "ab"]) * rnd.randint(1, 300) + rnd.choice(["", " ", "b", " b", "\n"])
        want = library.encode(text, add_special_tokens=False).ids
        for block in (1, 2, 3, 7, 50, 1 << 16):
            assert ids(text, v, block) == want, (text, block)


def test_long_runs(v, library):
    rnd = random.Random(2)
    for run in ("".join(rnd.choices("etaoinsh", k=300_000)), " " * 50_000 + "x", "ab" * 40_000 + " ", "=" * 70_000, "7" * 30_001):
        assert ids(run, v, bpe.BLOCK) == library.encode(run, add_special_tokens=False).ids


def test_windows_of_the_transducer(v, monkeypatch):
    rnd = random.Random(4)
    for _ in range(30):
        piece = "".join(rnd.choices(["ing", "tion", "e", "s", "the", "an", "q"], k=900)).encode()
        t = bpe.Transducer(v)
        t.window = v.lookahead + 40
        got = [i for k in range(0, len(piece), 13) for i in t.feed(piece[k : k + 13])] + t.finish()
        assert got == [v.ids[x] for x in v.merged(piece)]


def test_lookahead_of_small_lists():
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    # abc: whether b joins a depends on whether it has joined c, which depends on d
    assert bpe.sufficient_lookahead([(b"c", b"d"), (b"b", b"c"), (b"a", b"b")]) == 3


def test_decoder_state_machine(v, library):
    rnd = random.Random(8)
    for _ in range(300):
        given = [rnd.randrange(50257) for _ in range(rnd.randint(0, 12))]
        d = bpe.Decoder(v)
        assert "".join(d.feed([i]) for i in given) + d.finish() == library.decode(given, skip_special_tokens=False)


def test_columns_nulls_and_empty_table(spark, library):
    rows = [(1, None), (2, ""), (2, ""), (3, "a <|endoftext|> b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.with_text(bpe.with_ids(df, PATH), PATH).collect()
    assert [r["decoded"] for r in got] == ["", "", "", "a <|endoftext|> b"]
    assert got[3]["ids"] == library.encode("a <|endoftext|> b", add_special_tokens=False).ids
    assert bpe.with_round_trip(df.limit(0), PATH).count() == 0
    clash = df.selectExpr("doc_id as ids", "text", "7 as _told", "8 as n_tokens")
    assert bpe.with_ids(clash, PATH).columns == ["text", "_told", "n_tokens", "ids"]
    assert [r["n_tokens"] for r in bpe.with_round_trip(clash, PATH).collect()][:2] == [0, 0]


def test_query_on_the_whole_table(spark, library):
    got = {r["doc_id"]: r for r in queries.op5_bpe_round_trip(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        back = library.decode(want, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
