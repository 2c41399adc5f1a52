import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sparkwarden.llm import sentencepiece_codec, token_counts, token_store
from sparkwarden.llm.pretokens import WordCodes, encode, kind_of, load, odd_documents, spaced_pieces

from .helpers import docs_of, rows_of
from .test_dedup import ODD, table_texts

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
STRANGE = ["<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "e\u0301t\u00e9 \u0130I", "\x1c\x1d x\x85y\u00a0z", "'s 't don't I'LL", "\u4f60\u597d 123 \u0661", "\U0001f600 !!", "  lead", "trail  ", "\n\n a\n", "\u2581x", "x\u2581y", "<s> </s> <unk> <0x41>", "ﬁ ŉ ǅ", "\x00\x01", "a" * 3000, "x y " * 5000]


def texts_of(spark):
    return ODD + STRANGE + table_texts(spark, 100)


def test_token_counts(spark):
    texts = texts_of(spark)
    library = Tokenizer.from_file(BYTE)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in enumerate(texts)]
    got = rows_of(token_counts.token_counts(docs_of(spark, texts, True), BYTE), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(docs_of(spark, []), BYTE).count() == 0


def random_texts(n=400):
    rng = random.Random(1)
    alphabet = [chr(c) for c in range(0x250)] + [" "] * 150 + ["\n"] * 30 + list("eeeaattss'' ") * 9 + ["<|endoftext|>", "\u0301", "\u2003", "\u3000", "\u4f60", "\u03a3"] * 3
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["  ", " a", "a ", "a  b", "a\n b", "a \nb", "a \n b", "a\n \nb", "\n", "\na b", " \n a"]


def test_words_are_the_librarys():
    library = Tokenizer.from_file(WORD)
    codes = WordCodes(WORD)
    assert codes.by_word and not WordCodes(BYTE).by_word and kind_of(BYTE) == "spaced"
    texts = random_texts()
    flat, counts = codes.ids(pa.array(texts, pa.large_string()))
    small = WordCodes(WORD, entries=50)
    parts = [small.ids(pa.array([t], pa.large_string())) for t in texts]  # the cache forgets again and again
    assert np.concatenate([x[0] for x in parts]).tolist() == flat.tolist()
    for t, end, n in zip(texts, np.cumsum(counts), counts, strict=True):
        assert flat[end - n : end].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_sentencepiece_words():
    """Words and lines from the cache, odd blanks by the whole model, and decoding: as the library has it, also with a tiny cache."""
    rng = random.Random(5)
    pool = ["a", "\n", " ", "  ", "\u00e9", "\u2581", "\u65e5\u672c", "\t", "\r\n", ".", "</s>", "<0x0A>", "\U0001f600", "word", "the", "\x00", "\n\n", " \n", " ", " "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    codes = sentencepiece_codec.PieceCodes(PIECE)
    codes.entries = 100
    assert codes.by_word
    got = [codes.ids(pa.array(texts[k : k + 50], pa.large_string()), 0) for k in range(0, 2000, 50)]
    flat, counts = (np.concatenate([x[k] for x in got]) for k in (0, 1))
    want = codes.exact.encode(texts)
    assert flat.tolist() == [i for x in want for i in x] and counts.tolist() == list(map(len, want))
    assert [x.decode() for x in codes.decoded(flat, counts)] == codes.whole.decode_batch(want, skip_special_tokens=False)
    junk = [[rng.randrange(3, 400) for _ in range(6)] for _ in range(300)]  # bytes that make no text
    assert sentencepiece_codec.decode(junk, PIECE) == codes.whole.decode_batch(junk, skip_special_tokens=False)


def test_sentencepiece_is_taken_where_the_rebuilt_model_differs(monkeypatch):
    codes = sentencepiece_codec.PieceCodes(PIECE)
    monkeypatch.setattr(codes, "cut", lambda texts: pa.array([["wrong"]] * len(texts), pa.list_(pa.large_string())))
    texts = ["one two", "three", "four"]
    flat, counts = codes.ids(pa.array(texts, pa.large_string()), 1)
    assert flat.tolist() == [i for x in codes.exact.encode(texts) for i in x]


def test_pieces_are_the_librarys():
    library, cut = load(BYTE), 0
    for t in random_texts(3000):
        data = np.frombuffer(t.encode(), np.uint8)
        pieces = None if odd_documents(data, np.array([0, len(data)]))[0] else spaced_pieces(t)
        if pieces is not None:
            cut += 1
            ids = encode(library, [pieces[0]] + [" " + p for p in pieces[1:]])
            assert [i for x in ids for i in x] == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert cut > 100


def test_token_store(spark, tmp_path):
    texts = texts_of(spark)
    library = Tokenizer.from_file(WORD)
    want, start = [], 0
    for i, t in enumerate(texts):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    path = str(tmp_path / "ids")
    token_store.write_tokens(docs_of(spark, texts, True).repartition(5), path, WORD, end_id=1)
    got = rows_of(token_store.read_tokens(spark, path), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(want, key=repr)
    assert token_store.stored(docs_of(spark, []), WORD, "none", end_id=1).count() == 0


def test_token_store_null_and_repeated_ids(spark, tmp_path):
    df = spark.createDataFrame([(None, "b"), (3, "c"), (3, "a"), (1, None)], "doc_id long, text string")
    token_store.write_tokens(df, str(tmp_path / "ids"), WORD, end_id=1)
    got = token_store.read_tokens(spark, str(tmp_path / "ids"), with_ids=True).orderBy("start").collect()
    a, b, c = (Tokenizer.from_file(WORD).encode(x, add_special_tokens=False).ids for x in "abc")
    rows = [(r["doc_id"], r["ids"]) for r in got]
    assert rows[:2] == [(None, b + [1]), (1, [1])] and sorted(rows[2:]) == sorted([(3, a + [1]), (3, c + [1])])


def test_tokens_at(spark, tmp_path, monkeypatch):
    """Single ids by their places in the whole store, over many blocks and parts."""
    monkeypatch.setattr(token_store, "BLOCK_IDS", 500)
    texts = texts_of(spark)
    path = str(tmp_path / "ids")
    token_store.write_tokens(docs_of(spark, texts), path, WORD, end_id=1)
    library = Tokenizer.from_file(WORD)
    want = [i for t in texts for i in library.encode(t or "", add_special_tokens=False).ids + [1]]
    assert spark.read.parquet(path).count() > 10
    places = [0, 1, len(want) - 1, 7, 7, *range(3, len(want), 97)]
    frame = spark.createDataFrame([(p,) for p in [*places, None, -1, len(want)]], "position long")
    assert rows_of(token_store.tokens_at(frame, path), "position", "token") == sorted(((p, want[p]) for p in places), key=repr)


@pytest.mark.parametrize("top", [200, 255, 256, 60_000, 1 << 24, (1 << 32) - 1])
def test_block_random_access(top):
    rng = np.random.default_rng(top)
    ids = np.r_[rng.integers(0, top + 1, 5000), rng.integers(0, 10, 3000), 0, top, 255, 256 % (top + 1)].astype(np.uint32)
    block = token_store.Block(token_store.pack(ids, np.array([4, 9]), np.array([1, 1]), np.array([100, len(ids) - 100])))
    assert (block.tokens(0, len(ids)) == ids).all()
    for i in rng.integers(0, len(ids), 300):
        assert block.token(int(i)) == ids[i]
        j = int(rng.integers(i, len(ids) + 1))
        assert (block.tokens(int(i), j) == ids[i:j]).all()
    assert (block.document(0) == ids[:100]).all() and (block.document(1) == ids[100:]).all()


def test_sentencepiece_parity(spark):
    texts = [t or "" for t in texts_of(spark)]
    exact = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = exact.encode(texts)
    assert sentencepiece_codec.encode(texts, PIECE, 0) == want
    assert sentencepiece_codec.decode(want, PIECE) == exact.decode(want)
    got = rows_of(sentencepiece_codec.encode_documents(docs_of(spark, texts, True), PIECE, verify_every=1), "doc_id", "n_pieces", "ids_crc32", "round_trip")
    assert got == sorted(((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes()), exact.decode(x) == texts[i]) for i, x in enumerate(want)), key=repr)
    assert sentencepiece_codec.encode_documents(docs_of(spark, []), PIECE).count() == 0
    out = sentencepiece_codec.add_pieces(docs_of(spark, [None, "a b"], True), PIECE).orderBy("doc_id").collect()
    assert [r["pieces"] for r in out] == [[], exact.encode("a b")] and out[0]["text"] is None
