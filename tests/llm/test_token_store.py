import io
import zlib

import numpy as np
import pytest

from fleetvolt.llm import token_store

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def check(df, rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    ids = [e.ids + [1] for e in tok.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    facts = [(r[0], len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(rows, ids)]
    got = [tuple(r) for r in token_store.token_round_trip(df, PATH).select("doc_id", "n_tokens", "ids_crc32", "start").collect()]
    assert sorted((g[:3] for g in got), key=str) == sorted(facts, key=str)
    got.sort(key=lambda g: g[3])
    at = 0
    for g in got:
        assert g[3] == at
        at += g[1]
    assert [g[0] for g in got] == sorted((g[0] for g in got), key=lambda x: (x is not None, x or 0))


def test_documents(documents):
    check(documents, [tuple(r) for r in documents.collect()])


def test_edge_documents(edge_docs, edge_rows):
    check(edge_docs, edge_rows)


def test_tricky_texts(spark):
    rows = list(enumerate(["a\x1cb c", "ÉCOLE é   x y", "<|endoftext|> a<|startoftext|>b", "don't I'LL 123", "中文 🙂", "", "İstanbul ΣΑΣ"]))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_words_whose_last_letter_gets_a_mark(spark):
    rows = list(enumerate(["TAKS\u0130. x", "\u09b9\u09df, y", "\u0915\u0958. \ufb2a, \u0f43.", "plain, Words. Ende\u00e9."]))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def library(texts):
    from tokenizers import Tokenizer
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def encoded(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in token_store._Encoder(PATH).encode(texts)]


def test_every_letter_with_every_combining_mark():
    texts = [f"{a}{chr(m)} abc {a}{chr(m)}x, x{a}{chr(m)}." for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
             for m in range(0x300, 0x370)]
    assert encoded(texts) == library(texts)


def test_every_latin_character_between_letters_and_digits():
    texts = [f"a{c}b {c}1{c} {c}{c}. 'S{c} {c}'ll Don'T{c}ÀÉ" for c in map(chr, range(0x21, 0x250))]
    assert encoded(texts) == library(texts)


def test_random_texts_of_mixed_scripts():
    rng = np.random.default_rng(11)
    marks = "\u0301\u0308\u030c\u0331\u0327"
    pool = list("abcXYZÀéßÿÆœİıΣςДжא中🙂0189²½.,;'\"-_!?<|>$€¿«»­\u00a0\u0085 \n\t  ") + list(marks) + ["'S", "'re", "<|endoftext|>", "<|ENDOFTEXT|>", " the ", "J\u030c"]
    texts = ["".join(rng.choice(pool, rng.integers(0, 60))) for _ in range(5000)]
    assert encoded(texts) == library(texts)


def test_another_tokenizer_encodes_whole_texts():
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    texts = ["Hello  world\n\n x", " lead", ""]
    encoder = token_store._Encoder(path)
    assert not encoder.by_word
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [
        e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_plain_texts_are_cut_without_their_words():
    texts = ["Don't stop, l'École.\tWe'LL x'S 'tis 12a3--b\n\x0b ÀÉ?!", "", " \r\n", "a a. A, \x0c(ÿö«b»)", "a|b <c> ''s 'Re'VE"]
    mixed = [texts[0], "a <|endoftext|> b.", texts[3], "tail \x1c x", "naïve “quoted” 中文", texts[1], texts[4]]
    encoder = token_store._Encoder(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == library(texts)
    assert not encoder.known and encoder.pieces
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(mixed)] == library(mixed)


def test_no_documents(no_docs):
    assert token_store.token_round_trip(no_docs, PATH).count() == 0


class Unclosed(io.BytesIO):
    def close(self):
        pass


def written(monkeypatch, docs, frame=64):
    monkeypatch.setattr(token_store, "FRAME_BYTES", frame)
    out = Unclosed()
    w = token_store.TokenFileWriter(out)
    for doc_id, ids in docs:
        w.add(doc_id, np.array(ids, "<u4").tobytes())
    w.close()
    return out.getvalue()


DOCS = [(None, [9]), (-4, []), (0, [1, 2, 3]), (5, list(range(40))), (5, [7]), (6, [8] * 10), (90, [2])]


def test_file_round_trip_and_lookup(monkeypatch):
    import zstandard
    data = written(monkeypatch, DOCS)
    r = token_store.TokenFileReader(io.BytesIO(data))
    assert [(d, i.tolist()) for d, _, i in r.documents()] == DOCS
    opened = []
    monkeypatch.setattr(r, "frame", lambda k, f=r.frame: opened.append(k) or f(k))
    assert [(d, i.tolist()) for d, _, i in r.documents({6, 90})] == DOCS[-2:] and len(opened) < len(r.frames)
    assert list(r.documents({77})) == []
    # any zstandard tool reads the frames one after the other
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as s:
        assert len(s.read()) == int(r.places["size"].sum())


def test_damage_is_reported(monkeypatch):
    data = bytearray(written(monkeypatch, DOCS, 1 << 20))
    places = token_store.TokenFileReader(io.BytesIO(bytes(data))).places
    at = len(data) - 9 - 4
    data[at] ^= 1                                    # the stored checksum
    with pytest.raises(token_store.TokenFileError):
        list(token_store.TokenFileReader(io.BytesIO(bytes(data))).documents())
    with pytest.raises(token_store.TokenFileError):
        token_store.TokenFileReader(io.BytesIO(bytes(data[:-3])))
    assert len(places) == 1
