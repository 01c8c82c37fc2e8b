"""BPE, prefix counts and wavelet shards against the tokenizer library."""

from __future__ import annotations

import hashlib
import random
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from remanente.llm import bpe, common, prefix_counts, wavelet

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
ODD = [
    "",
    "a  b\t\x1c c",
    "ΣΑΣ İstanbul é ́x ſ K Å ﬁ",
    "<|endoftext|>a <|startoftext|>b c<|endoftext|>'s",
    "don't we'll 'Re x'ye",
    "x\x85y\xa0z​q w",
    "한국어 각 ㄱㅏ 日本語",
    "🙂👩‍👩‍👧 ½ Ⅷ ٣\x00",
    " lead\n\n\nand trail ",
]


def random_texts(n: int) -> list[str]:
    draw = random.Random(4)
    ranges = [(32, 127), (0, 0x250), (0x300, 0x370), (0x1100, 0x1200), (0, 0xD800), (32, 33)]

    def letter() -> str:
        return chr(draw.randrange(*draw.choice(ranges)))

    return ["".join(letter() for _ in range(draw.randrange(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


def test_bpe_encodes_and_decodes_as_the_library(word_library):
    own = bpe.WordBpe(WORD)
    for text in ODD + random_texts(400):
        want = word_library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want
        ((ids, back),) = bpe.encoded([text], WORD)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert back == word_library.decode(want, skip_special_tokens=False)


def test_bpe_over_documents(spark, word_library):
    found = cases.rows()
    docs = cases.crowded(cases.documents(spark, found), "ids", "n_tokens", "decoded")
    got = cases.as_dict(bpe.encode_decode_digests(docs, WORD))
    for doc, text in found:
        ids = word_library.encode(text or "", add_special_tokens=False).ids
        back = word_library.decode(ids, skip_special_tokens=False)
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert bpe.encode_decode_digests(cases.nothing(spark), WORD).count() == 0


def test_counts_of_every_prefix(word_library):
    own = prefix_counts.PrefixCounts(bpe.WordBpe(WORD))
    draw = random.Random(3)
    texts = ["don't we'll 'Re it's 're x'ye 'll", "a<|endoftext|>b <|end", "é́x ÀÉ ĳ ﬀ", " \n a\n\n b"]
    texts += ["".join(draw.choice("abe'rlstvmd 1!é́ñ<|\n") for _ in range(25)) for _ in range(30)]
    texts.append("internationalization hahahahah")
    for text in texts:
        want = [
            len(word_library.encode(text[:i], add_special_tokens=False).ids)
            for i in range(len(text) + 1)
        ]
        assert own.text(text).tolist() == want


def test_token_counts_and_cuts(spark, word_library):
    found = cases.rows()
    docs = cases.crowded(cases.documents(spark, found), "n_bytes", "counts")
    got = cases.as_dict(prefix_counts.count_tokens(docs, WORD, limit=90))

    def size(text: str) -> int:
        return len(word_library.encode(text, add_special_tokens=False).ids)

    for doc, text in found:
        row, text = got[doc], text or ""
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), size(text))
        assert row["over_limit"] == (row["n_tokens"] > 90)
        assert size(text[: row["cut_chars"]]) <= 90
        if row["cut_chars"] < len(text):
            assert all(size(text[: row["cut_chars"] + k]) > 90 for k in range(1, 12))
    assert prefix_counts.count_tokens(cases.nothing(spark), WORD).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 512, 513, 5000])
def test_wavelet_access_count_and_select(n):
    draw = np.random.default_rng(n)
    tokens = draw.integers(0, 50_257, n).astype(np.uint32)
    tokens[: n // 2] %= 40
    docs, counts, matrix = wavelet.from_file(wavelet.to_file([1, None], [n, 0], tokens))
    assert docs == [1, None] and counts.tolist() == [n, 0]
    assert (matrix.tokens() == tokens).all()
    assert all(matrix[i] == tokens[i] for i in range(0, n, max(1, n // 60)))
    for token in [*set(tokens.tolist())][:30] + [3, 70_000]:
        places = np.flatnonzero(tokens == token).tolist()
        assert matrix.count(token) == len(places)
        assert matrix.occurrences(token) == places
        assert matrix.count(token, n // 3, n // 2) == sum(n // 3 <= p < n // 2 for p in places)
    with pytest.raises(IndexError):
        matrix[n]


def test_chunks_encode_as_the_library(byte_library):
    own = wavelet.ChunkEncoder(BYTE)
    texts = ODD + random_texts(300) + ["a <|endoftext|> b", "x  y 　z", "Ünï, cödé; ok! a.b"]
    got = own.encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == byte_library.encode(text, add_special_tokens=False).ids


def test_documents_from_shards(spark, byte_library):
    found = cases.rows()
    docs = cases.crowded(cases.documents(spark, found), "part", "shard", "ids")
    files = wavelet.write_shards(docs, BYTE, shard_tokens=500)
    assert files.count() > 5
    got, start = cases.as_dict(wavelet.read_documents(files)), 0
    for doc, text in sorted(found):
        ids = [*byte_library.encode(text or "", add_special_tokens=False).ids, 0]
        want = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == want
        start += len(ids)
    assert wavelet.read_documents(wavelet.write_shards(cases.nothing(spark), BYTE)).count() == 0


def test_shards_take_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (2, "b"), (2, "b"), (2, None)], "doc_id long, text string")
    got = wavelet.read_documents(wavelet.write_shards(docs, BYTE)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 2, 2, 2]
    assert [r.start for r in got][0] == 0 and sorted(r.n_tokens for r in got) == [1, 2, 2, 2]


def test_plain_chunks_are_encoded_without_splitting(monkeypatch):
    plain = ["Orsh", "étÄR.", "nd$$$", "ÿß[]{}", "a!?", "THE", "x" * 70 + ";"]
    other = ["it's", "a.b", "x1", "a<|endoftext|>", "<|endoftext|>a", "e\u0301t.", "İo", "ªb", ".", "a'"]
    own, library = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    for chunk in plain + other:
        ids = library.encode(chunk, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert own.shown_chunk(chunk) == (np.array(ids, "<u4").tobytes(), back), chunk
    asked = []
    monkeypatch.setattr(own, "encode_chunk", lambda chunk: asked.append(chunk) or [])
    for chunk in plain + other:
        own.shown_chunk(chunk)
    assert asked == other


def test_words_around_a_line_end_need_no_whole_way(monkeypatch):
    own, library = wavelet.ChunkEncoder(BYTE), Tokenizer.from_file(BYTE)
    short = "Orsh étÄr.\nNd, the\nthe a!\nB? st"
    texts = [short, "a\n\nb c", "a \nb", "a\n b", "a\u3000 b c", " a", "a ", "a  b", "x.\n1 y1\nz", "a.,\nb q\nr's", ""]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in own.encode(texts)] == want
    asked = []
    monkeypatch.setattr(own, "whole", lambda found: asked.extend(found) or [b""] * len(found))
    own.first, own.later = {"Orsh": b""}, {}
    own.encode([short])
    assert asked == []


def test_words_before_runs_of_marks_need_no_whole_way(monkeypatch):
    encoder = wavelet.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a " + " ".join(f"mot{chr(97 + k % 26)}{chr(97 + k // 26)}é{mark}" for k in range(50)) for mark in ("###", ".&&&", "**|%")]
    texts += ["x y'#s z... \nw?! ,b c$$$\nd### e###########f g&1"]
    want = [e.ids for e in encoder.library.encode_batch_fast(texts, add_special_tokens=False)]
    asked, whole = [], encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda chunks: asked.extend(chunks) or whole(chunks))
    assert [list(x) for x in encoder.encode(texts)] == want
    assert not [chunk for chunk in asked if "mot" in chunk]


def test_chunks_seen_lately_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(wavelet, "MEMORY", 40)
    own, asked = wavelet.ChunkEncoder(BYTE), []
    real = own.word
    monkeypatch.setattr(own, "word", lambda letters, before: asked.append(letters) or real(letters, before))
    texts = [f"a common phrase and {random_texts(1)[0]} x{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)]
    library = Tokenizer.from_file(BYTE)
    for text in texts:
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.later) <= 200 and asked.count("common") == 1


def test_letter_classes_ask_for_few_letters_at_once(monkeypatch):
    asked, real = [], bpe.pre_tokenizers.Split

    class Asked:
        def __init__(self, *given, **named):
            self.split = real(*given, **named)

        def pre_tokenize_str(self, text):
            asked.append(text)
            return self.split.pre_tokenize_str(text)

    monkeypatch.setattr(bpe.pre_tokenizers, "Split", Asked)
    classes = bpe.letter_classes.__wrapped__()
    every = "".join(chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000)
    assert "".join(asked) == 3 * every
    assert max(map(len, asked)) <= 1 << 14
    for name, ranges in classes.items():
        split = real(bpe.Regex(name + "+"), "removed", invert=True)
        spans = [(found[0], found[-1]) for found, _ in split.pre_tokenize_str(every)]
        assert ranges == "".join(f"\\U{ord(a):08x}-\\U{ord(b):08x}" for a, b in spans)


def test_workers_forget_what_a_stage_before_kept(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('word', id) AS text").repartition(8)

    def kept(texts):
        return {"kept": [bpe.memory.cache_info().currsize + bpe.tokenizer.cache_info().currsize] * len(texts)}

    for _ in range(2):
        encoded = bpe.encode_decode(docs, WORD).collect()
        assert {r.decoded for r in encoded if r.doc_id == 7} == {bpe.WordBpe(WORD).decode(bpe.WordBpe(WORD).encode("word7"))}
        found = common.over_texts(docs, kept, "kept int").collect()
        assert len(found) == 4000 and {r.kept for r in found} == {0}
