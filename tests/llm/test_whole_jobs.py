"""Nothing is cut, left behind or named twice: whole training texts, ids without neighbours, folders and columns."""

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from sparkwarden import storage
from sparkwarden.llm import decontaminate, exact_dedup, pretokens, sentencepiece_codec, simhash, toxicity, workers
from sparkwarden.storage import scratch, written

from .helpers import docs_of

PIECE, WORD = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json"))


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_dir", lambda spark: f"file://{tmp_path}/shared")
    return lambda: sorted(p.name.rsplit("-", 1)[0] for p in Path(tmp_path, "shared", "sparkwarden").glob("*"))


def words_of(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def test_top_windows_come_from_the_whole_text():
    rng = random.Random(1)
    net = toxicity.train([" ".join([*words_of(rng, 10), *["vilezwqx"] * (k % 2)]) for k in range(200)], [k % 2 for k in range(200)], steps=100)
    words = words_of(rng, 5000)
    for at in (0, 2345, 4997):
        text = " ".join([*words[:at], "vilezwqx", "vilezwqx", *words[at:]])
        taken = toxicity.Scorer(net).top_windows(text, 3)
        assert "vilezwqx" in taken and len(taken.split()) == 3 * toxicity.WINDOW
        assert abs(toxicity.Scorer(net).scores([taken])[0] - toxicity.Scorer(net).scores([text])[0]) < 0.5


def test_long_texts_are_learned_from_whole(spark, folder, monkeypatch):
    """Long texts are toxic by a word that no short text has and no excerpt shows: only their best windows can teach it."""
    monkeypatch.setattr(toxicity, "TRAIN_WORDS", 64)
    rng = random.Random(2)
    texts, marks = [], []
    for k in range(120):
        if k < 40:
            texts.append(" ".join([*words_of(rng, 30), *["foulwxyz"] * (k % 2), *words_of(rng, 30)]))
            marks.append((k, k % 2))
            continue
        words = words_of(rng, 200)
        if k % 2:  # between the windows of an excerpt, which are words 0 to 31 and the last 32
            for at in rng.sample(range(40, 160), 6):
                words[at] = "vilezwqx"
        texts.append(" ".join(words))
        marks.append((k, k % 2))
        assert "vilezwqx" not in toxicity.excerpt(texts[-1], 64)
    docs, labels = docs_of(spark, texts, True), spark.createDataFrame(marks, "doc_id long, toxic int")
    net = toxicity.fit_toxicity(docs, labels)
    assert "vilezwqx" in net.vocabulary and folder() == []
    got = toxicity.Scorer(net).scores(texts)
    assert (got[1::2] > 0.5).mean() > 0.95 and (got[::2] < 0.5).mean() > 0.95


def test_ids_do_not_depend_on_neighbours(monkeypatch):
    """A rebuilt model that errs in one word: that word has SentencePiece's ids, in any slice, and so have whole texts."""
    exact = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    codes = sentencepiece_codec.PieceCodes(PIECE)

    class Erring:
        def __init__(self, library):
            self.library = library

        def encode_batch_fast(self, texts, add_special_tokens):
            return self.library.encode_batch_fast([t.replace("hello", "jelly") for t in texts], add_special_tokens=add_special_tokens)

    codes.lines, codes.whole = Erring(codes.lines), Erring(codes.whole)
    texts = ["hello there", "say\nhello", "other words", "two  blanks hello", "", "\nhello"]
    for part in (texts, *([t] for t in texts), texts[::-1]):
        flat, counts = codes.ids(pa.array(part, pa.large_string()))
        assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == exact.encode(part)


def test_caches_are_given_up():
    first = pretokens.word_codes(WORD)
    assert pretokens.word_codes(WORD) is first and pretokens.known_counts(WORD)[1] == {}
    assert list(workers._KEPT) == [("counts", WORD)]
    workers.forget()
    assert pretokens.word_codes(WORD) is not first
    workers.forget()


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y", 2)], "doc_id long, text string, Pieces string, `meta.lang` string, Score int")
    out = sentencepiece_codec.add_pieces(docs, PIECE)
    assert sorted(out.columns) == ["Score", "doc_id", "meta.lang", "pieces", "text"] and out.first()["meta.lang"] == "y"
    net = toxicity.train(["a", "b"], [0, 1], steps=1)
    out = toxicity.scored(docs, net)
    assert sorted(out.columns) == ["Pieces", "doc_id", "meta.lang", "score", "text"] and 0 <= out.first()["score"] <= 1
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs.withColumn("__TOXICITY", F.lit(1)), labels, threshold=0.6).first()["__TOXICITY"] == 1


def test_what_stays_in_the_folder(spark, folder):
    rng = random.Random(3)
    texts = [" ".join(words_of(rng, 40)) for _ in range(30)]
    docs = docs_of(spark, [*texts, *texts[:3], *(t + " more" for t in texts[3:6])])
    bench = spark.createDataFrame([(0, texts[9])], "item_id long, text string")
    for drop, left, gone in ((exact_dedup.drop_exact_copies, 33, "gone"), (simhash.drop_near_copies, 30, "gone"), (lambda d: decontaminate.drop_contaminated(d, bench), 35, "contaminated")):
        with scratch() as keep:
            out = drop(docs)
            assert folder() == [gone]  # which the result still reads
            out = keep(written(out, "result"))
        assert folder() == ["result"] and out.count() == left
        with scratch():
            assert written(out, "more").count() == left
        assert folder() == ["result"]
        storage.discard(out)
        assert folder() == []


@pytest.mark.parametrize("rows", [0, 40])
def test_pipeline_leaves_its_result_only(spark, folder, tmp_path, rows):
    """Also over an empty table, and with null and repeated ids."""
    rng = random.Random(4)
    texts = [" ".join(words_of(rng, 60)) for _ in range(rows)]
    docs = docs_of(spark, texts)
    docs = docs.unionByName(docs.where("doc_id < 3")).unionByName(docs.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, texts[7] if rows else "a"), (1, "zz")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    monkey = [(n, (lambda spark, docs, sf_dir: docs) if n == "toxicity" else f) for n, f in corpus_pipeline.STAGES]  # no labels: nothing is learned, all score one half
    before, corpus_pipeline.STAGES = corpus_pipeline.STAGES, monkey
    try:
        out = corpus_pipeline.run(spark, str(tmp_path))
    finally:
        corpus_pipeline.STAGES = before
    assert folder() == ["SentencePiece"]
    got = sorted((r["doc_id"] for r in out.collect()), key=lambda x: (x is not None, x))
    assert got == ([None] + sorted([k for k in range(rows) if k != 7] + [0, 1, 2]) if rows else [])
