"""Toxicity by a bidirectional gated recurrent network with attention pooling, written and trained in numpy.

Every word has two inputs: an embedding of the word, where the training sample knew it, and the mean embedding of its
character n-grams.  Windows of overlapping words are read in both directions, attention pools the states of a window,
and a document scores as its most toxic window.  Training picks, in each step, every document's top window and descends
on that (multiple-instance learning), because labels are for documents.  Of long labelled texts the driver holds some
windows only: executors read each such text whole, between passes, and hand over those that score highest by then.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sparkwarden.llm import arrays, workers
from sparkwarden.llm.labelled import held_out, training_sample
from sparkwarden.storage import discard, written

WINDOW, STRIDE = 32, 16
#: Labelled rows of each class that training uses at most, and words of each text that the driver holds at a time.
TOXIC_ROWS, CLEAN_ROWS, TRAIN_WORDS = 1500, 3000, 800
#: Characters of the longest input word, and those that neighbouring pieces of a longer run share.
PIECE, OVERLAP = 40, 10
VOCABULARY, GRAM_BUCKETS = 4096, 1 << 13
WORD_SIZE, GRAM_SIZE, HIDDEN, ATTENTION = 8, 12, 8, 8
STEPS, BATCH, RATE = 400, 48, 0.01
#: Where training stops for long texts to be read again, as shares of all steps.
PASSES = (0.6, 0.8, 1.0)
#: Texts that have a word of the vocabulary.
LEAST_TEXTS = 4
_EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_~^=+/\\"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def tokens(text: str | None) -> list[str]:
    """The input words of a text: its runs between blanks, those over ``PIECE`` characters as overlapping pieces."""
    words = (text or "").lower().split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[k : k + PIECE] for w in words for k in range(0, max(1, len(w) - OVERLAP), PIECE - OVERLAP)]


def excerpt(text: str | None, words: int = TRAIN_WORDS) -> str:
    """The input words of a text; of one with over ``words`` of them, windows at even distances from its beginning to its end."""
    every = tokens(text)
    if len(every) > words:
        every = [w for s in np.linspace(0, len(every) - WINDOW, words // WINDOW).astype(int).tolist() for w in every[s : s + WINDOW]]
    return " ".join(every)


def grams(word: str) -> list[int]:
    """Buckets of the 3- to 5-grams at the word's beginning, and of its 4-grams, with edges marked."""
    word = f"<{word}>"
    found = {word[:k] for k in (4, 5, 6)} | {word[k : k + 4] for k in range(max(1, len(word) - 3))}
    return sorted({zlib.crc32(g.encode()) % GRAM_BUCKETS for g in found})


@dataclass
class Inputs:
    """What the network sees of words: vocabulary entries, n-gram buckets (flat), and how many each word has (one at least)."""

    known: np.ndarray
    flat: np.ndarray
    count: np.ndarray

    def of(self, some: np.ndarray) -> Inputs:
        count, start = self.count[some], (np.cumsum(self.count) - self.count)[some]
        ends = np.cumsum(count)
        return Inputs(self.known[some], self.flat[np.arange(int(count.sum())) + np.repeat(start - (ends - count), count)], count)


@dataclass
class Network:
    vocabulary: dict[str, int]  # 0 is for other words
    p: dict[str, np.ndarray]

    def inputs(self, words: list[str]) -> Inputs:
        """Of each (raw) word: its vocabulary entry and its n-grams."""
        known, flat, count = array("i"), array("i"), array("i")
        for w in words:
            w = w.strip(_EDGES)
            known.append(self.vocabulary.get(w, 0))
            g = grams(w)
            flat.extend(g)
            count.append(len(g))
        return Inputs(np.array(known, np.int64), np.array(flat, np.int64), np.array(count, np.int64))

    def vectors(self, rows: Inputs) -> np.ndarray:
        if not len(rows.known):
            return np.zeros((0, WORD_SIZE + GRAM_SIZE), np.float32)
        means = np.add.reduceat(self.p["grams"][rows.flat], np.cumsum(rows.count) - rows.count, axis=0) / rows.count[:, None].astype(np.float32)
        return np.concatenate([self.p["words"][rows.known], np.tanh(means)], axis=1)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What the words bring to the gates of both directions (update, reset, new: thrice the hidden size each)."""
        return x @ self.p["W"] + self.p["b"]

    def run(self, gates: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Logits of windows. ``gates``: (steps, windows, 6 * hidden); ``mask``: (steps, windows), 1 where there is a word."""
        steps, n, h = gates.shape[0], gates.shape[1], HIDDEN
        states = np.empty((steps, n, 2 * h), np.float32)
        memory = []
        for way in (0, 1):
            u, g = self.p[f"U{way}"], gates[:, :, 3 * h * way : 3 * h * (way + 1)]
            state = np.zeros((n, h), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                back = state @ u
                zr = _sigmoid(g[t, :, : 2 * h] + back[:, : 2 * h])
                new = np.tanh(g[t, :, 2 * h :] + zr[:, h:] * back[:, 2 * h :])
                after = new + zr[:, :h] * (state - new)
                if mask is not None:
                    after = np.where(mask[t][:, None] > 0, after, state)
                if keep:
                    memory.append((way, t, state, back, zr, new))
                state = after
                states[t, :, h * way : h * (way + 1)] = state
        lean = np.tanh(states @ self.p["A"])
        e = lean @ self.p["v"]
        if mask is not None:
            e = np.where(mask > 0, e, -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, states)
        logits = pooled @ self.p["out"] + self.p["c"][0]
        return (logits, (states, lean, a, pooled, memory)) if keep else logits


def window_starts(n: int) -> list[int]:
    """Where the windows of ``n`` words begin; the last one ends with the text, and a short text is one window."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _gradients(net: Network, rows: Inputs, index: np.ndarray, mask: np.ndarray, delta_of):
    """Gradients of the loss for windows ``index`` (steps, windows: places in ``rows``' words)."""
    used, at = np.unique(index, return_inverse=True)
    at = at.reshape(index.shape)
    mine = rows.of(used)
    x = net.vectors(mine)
    gates = net.project(x)[at]
    logits, (states, lean, a, pooled, memory) = net.run(gates, mask, keep=True)
    d = delta_of(logits).astype(np.float32)
    p, h, g = net.p, HIDDEN, {}
    g["out"], g["c"] = pooled.T @ d, np.array([d.sum()])
    d_pooled = d[:, None] * p["out"]
    d_states = a[:, :, None] * d_pooled
    d_a = np.einsum("tnh,nh->tn", states, d_pooled)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    g["v"] = np.einsum("tnk,tn->k", lean, d_e)
    d_lean = d_e[:, :, None] * p["v"] * (1 - lean * lean)
    g["A"] = np.einsum("tnh,tnk->hk", states, d_lean)
    d_states += d_lean @ p["A"].T
    d_gates = np.zeros_like(gates)
    for way in (1, 0):
        u, g_u = p[f"U{way}"], np.zeros_like(p[f"U{way}"])
        carry = np.zeros((index.shape[1], h), np.float32)
        for w, t, state, back, zr, new in reversed(memory):
            if w != way:
                continue
            d_after = d_states[t, :, h * way : h * (way + 1)] + carry
            on = mask[t][:, None]
            d_in = d_after * on
            z, r = zr[:, :h], zr[:, h:]
            d_new = d_in * (1 - z) * (1 - new * new)
            d_z = d_in * (state - new) * z * (1 - z)
            d_r = d_new * back[:, 2 * h :] * r * (1 - r)
            d_back = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_gates[t, :, 3 * h * way : 3 * h * (way + 1)] = np.concatenate([d_z, d_r, d_new], axis=1)
            g_u += state.T @ d_back
            carry = d_in * z + d_back @ u.T + d_after * (1 - on)
        g[f"U{way}"] = g_u
    flat_gates = d_gates.reshape(-1, 6 * h)
    d_words = np.zeros((len(used), 6 * h), np.float32)
    np.add.at(d_words, at.ravel(), flat_gates)
    g["W"], g["b"] = x.T @ d_words, d_words.sum(axis=0)
    d_x = d_words @ p["W"].T
    g["words"] = (mine.known, d_x[:, :WORD_SIZE])
    d_sum = d_x[:, WORD_SIZE:] * (1 - x[:, WORD_SIZE:] ** 2) / mine.count[:, None]
    g["grams"] = (mine.flat, np.repeat(d_sum, mine.count, axis=0))
    return g


def entries(text: str | None) -> set[str]:
    """What of a text may be in the vocabulary."""
    return {w.strip(_EDGES) for w in tokens(text)} - {""}


def vocabulary_of(seen: list[tuple[str, int]]) -> dict[str, int]:
    """Numbers of the words that most texts have, four at least, given words and in how many texts they are."""
    return {w: k + 1 for k, (w, n) in enumerate(sorted(seen, key=lambda x: (-x[1], x[0]))[: VOCABULARY - 1]) if n >= LEAST_TEXTS}


def new_network(vocabulary: dict[str, int], rng: np.random.Generator) -> Network:
    draw = lambda *shape, by=0.3: (rng.standard_normal(shape) * by).astype(np.float32)
    size = WORD_SIZE + GRAM_SIZE
    p = {"words": draw(VOCABULARY, WORD_SIZE, by=0.05), "grams": draw(GRAM_BUCKETS, GRAM_SIZE, by=0.05), "W": draw(size, 6 * HIDDEN), "b": np.zeros(6 * HIDDEN, np.float32), "U0": draw(HIDDEN, 3 * HIDDEN), "U1": draw(HIDDEN, 3 * HIDDEN), "A": draw(2 * HIDDEN, ATTENTION), "v": draw(ATTENTION), "out": draw(2 * HIDDEN), "c": np.zeros(1, np.float32)}
    return Network(vocabulary, p)


def train(texts: list[str | None], labels: list[int], steps: int = STEPS, seed: int = 3, net: Network | None = None, begin: int = 0, of_steps: int | None = None, moment: dict | None = None) -> Network:
    """Fit a network to texts and their 0/1 labels. Without both classes it stays untrained and scores by its bias.

    A network ``net`` is trained further, for ``steps`` of ``of_steps`` after ``begin``: the rate falls over all of them,
    and the optimiser's means go on in ``moment``, which starts as an empty dictionary.
    """
    rng = np.random.default_rng(seed + begin)
    words = [tokens(t) or [""] for t in texts]
    if net is None:
        net = new_network(vocabulary_of(list(Counter(w for t in texts for w in entries(t)).items())), rng)
    p = net.p
    y = np.asarray(labels, np.float32)
    classes = [np.flatnonzero(y == c) for c in (0, 1)]
    if not all(map(len, classes)):
        net.p["out"][:] = 0
        net.p["c"][:] = 0 if not len(y) else 4 * (2 * y[0] - 1)
        return net
    every = sorted({w for ws in words for w in ws})
    number = {w: k for k, w in enumerate(every)}
    rows = net.inputs(every)
    ids = [np.fromiter(map(number.__getitem__, ws), np.int64, len(ws)) for ws in words]
    del every, number, words  # the driver keeps numbers only
    moment = {} if moment is None else moment
    for k, v in p.items():
        moment.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
    order, at = [rng.permutation(c) for c in classes], [0, 0]
    for step in range(1, steps + 1):
        batch = []
        for c in (0, 1):
            for _ in range(BATCH // 2):
                if at[c] == len(order[c]):
                    order[c], at[c] = rng.permutation(classes[c]), 0
                batch.append(order[c][at[c]])
                at[c] += 1
        here, place = np.unique(np.concatenate([ids[d] for d in batch]), return_inverse=True)
        gates, ends = net.project(net.vectors(rows.of(here))), np.cumsum([len(ids[d]) for d in batch])
        local = [place[b - len(ids[d]) : b] for d, b in zip(batch, ends.tolist(), strict=True)]
        spans = [(k, s) for k, d in enumerate(batch) for s in window_starts(len(ids[d]))]
        index = np.zeros((WINDOW, len(spans)), np.int64)
        mask = np.zeros((WINDOW, len(spans)), np.float32)
        for j, (k, s) in enumerate(spans):
            piece = local[k][s : s + WINDOW]
            index[: len(piece), j] = piece
            mask[: len(piece), j] = 1
        logits = net.run(gates[index], mask)
        of = np.array([k for k, _ in spans])
        first = np.flatnonzero(np.r_[True, np.diff(of) > 0])
        top = [int(a + np.argmax(logits[a:b])) for a, b in zip(first, [*first[1:], len(of)], strict=True)]
        target = y[batch]
        g = _gradients(net, rows, here[index[:, top]], mask[:, top], lambda z: (_sigmoid(z) - target) / len(target))
        rate = RATE * min(1.0, 2.0 * (1 - (begin + step) / ((of_steps or steps) + 1)))
        for k, grad in g.items():
            m, v = moment[k]
            if isinstance(grad, tuple):  # embeddings: only the rows that took part move
                where, part = np.unique(grad[0], return_inverse=True)
                full = np.zeros((len(where), grad[1].shape[1]), np.float32)
                np.add.at(full, part, grad[1])
                m[where], v[where] = 0.9 * m[where] + 0.1 * full, 0.99 * v[where] + 0.01 * full * full
                p[k][where] -= rate * m[where] / (np.sqrt(v[where]) + 1e-6)
            else:
                m[:], v[:] = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
                p[k] -= (rate * (m / (1 - 0.9 ** (begin + step))) / (np.sqrt(v / (1 - 0.99 ** (begin + step))) + 1e-6)).astype(np.float32)
    return net


class Scorer:
    """Scores whole texts; the gates of words are kept between texts."""

    CACHE_WORDS = 200_000
    CHUNK_WINDOWS = 2048

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.gates = np.zeros((1024, 6 * HIDDEN), np.float32)

    def _ids(self, words: list[str]) -> np.ndarray:
        found = list(map(self.index.get, words))
        if None in found:
            fresh = list({w for w, k in zip(words, found, strict=True) if k is None})
            start = len(self.index)
            while start + len(fresh) > len(self.gates):
                self.gates = np.concatenate([self.gates, np.zeros_like(self.gates)])
            for a in range(0, len(fresh), 4096):
                part = fresh[a : a + 4096]
                self.gates[start + a : start + a + len(part)] = self.net.project(self.net.vectors(self.net.inputs(part)))
            self.index.update(zip(fresh, range(start, start + len(fresh)), strict=True))
            found = list(map(self.index.__getitem__, words))
        return np.asarray(found, np.int64)

    def top_windows(self, text: str, most: int) -> str:
        """The ``most`` windows of a long text that score highest, in the text's order; all its windows are scored."""
        if len(self.index) > self.CACHE_WORDS:
            self.clear()
        words = tokens(text)
        found, start = self._ids(words), np.asarray(window_starts(len(words)))
        logits = np.concatenate([self.net.run(self.gates[found[start[a : a + self.CHUNK_WINDOWS] + np.arange(WINDOW)[:, None]]], None) for a in range(0, len(start), self.CHUNK_WINDOWS)])
        top = np.sort(np.argsort(-logits, kind="stable")[:most])
        return " ".join(w for s in start[top].tolist() for w in words[s : s + WINDOW])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), -np.inf, np.float32)
        if len(self.index) > self.CACHE_WORDS:
            self.clear()
        ids, owners, starts, short = [], [], [], []
        base = 0
        for k, text in enumerate(texts):
            words = tokens(text) or [""]
            found = self._ids(words)
            if len(found) < WINDOW:
                short.append((k, found))
                continue
            ids.append(found)
            begin = np.asarray(window_starts(len(found))) + base
            starts.append(begin)
            owners.append(np.full(len(begin), k))
            base += len(found)
        if ids:
            flat, start, owner = np.concatenate(ids), np.concatenate(starts), np.concatenate(owners)
            for a in range(0, len(start), self.CHUNK_WINDOWS):
                index = flat[start[a : a + self.CHUNK_WINDOWS] + np.arange(WINDOW)[:, None]]
                np.maximum.at(out, owner[a : a + self.CHUNK_WINDOWS], self.net.run(self.gates[index], None))
        for a in range(0, len(short), self.CHUNK_WINDOWS):
            part = short[a : a + self.CHUNK_WINDOWS]
            index = np.zeros((WINDOW, len(part)), np.int64)
            mask = np.zeros((WINDOW, len(part)), np.float32)
            for j, (_, found) in enumerate(part):
                index[: len(found), j] = found
                mask[: len(found), j] = 1
            out[[k for k, _ in part]] = self.net.run(self.gates[index], mask)
        return _sigmoid(out.astype(np.float64))


def _vocabulary(sample: DataFrame) -> dict[str, int]:
    """The vocabulary of whole sampled texts. The driver sees the words that are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(w for t in batch.column(0) for w in entries(t.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    counts = sample.select("text").mapInArrow(workers.lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TEXTS)
    return vocabulary_of([(r["word"], r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - 1).collect()])


def _excerpts(sample: DataFrame, net: Network | None) -> dict:
    """``(excerpt, label, is_long)`` by id of sampled texts, long ones only if there is a network to choose their windows."""
    held = sample.sparkSession.sparkContext.broadcast(net)
    kind = sample.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value) if held.value else None
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            is_long = [len(tokens(t)) > TRAIN_WORDS for t in texts]
            if scorer:
                batch, texts, is_long = batch.filter(pa.array(is_long, pa.bool_())), [t for t, x in zip(texts, is_long, strict=True) if x], [True] * sum(is_long)
            found = [scorer.top_windows(t, TRAIN_WORDS // WINDOW) if scorer else excerpt(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), batch.column(2), pa.array(is_long, pa.bool_())], ["doc_id", "text", "label", "is_long"])

    rows = sample.select("doc_id", "text", "label").mapInArrow(workers.lean(run), f"doc_id {kind}, text string, label int, is_long boolean").collect()
    held.destroy()
    return {r["doc_id"]: (r["text"], r["label"], r["is_long"]) for r in rows}


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> Network:
    """Train on at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` labelled rows outside the held-out fifth, on all windows of each.

    The driver holds ``TRAIN_WORDS`` words of each row at most.  Of longer texts these are windows at even distances
    first; then, after each of the ``PASSES``, those windows of the whole text that score highest by then.  In a clean
    text these are the ones that training has to correct, in a toxic one those that may have made it so.
    """
    sample = written(training_sample(docs, labels, label, {1: TOXIC_ROWS, 0: CLEAN_ROWS}, id_col, text_col), "training-sample")
    rows = _excerpts(sample, None)
    ids = sorted(rows)
    net, moment = new_network(_vocabulary(sample), np.random.default_rng(3)), {}
    stops = [round(STEPS * x) for x in PASSES] if any(x for _, _, x in rows.values()) else [STEPS]
    for begin, end in zip([0, *stops], stops, strict=False):
        if begin:
            rows.update(_excerpts(sample, net))
        net = train([rows[k][0] for k in ids], [rows[k][1] for k in ids], end - begin, net=net, begin=begin, of_steps=STEPS, moment=moment)
    discard(sample)
    return net


def scored(docs: DataFrame, net: Network, text_col: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score of each text in one more column. Null and empty texts are windows of one empty word.

    A column of that name, as Spark compares names, is replaced; names may hold dots.
    """
    held = docs.sparkSession.sparkContext.broadcast(net)
    plain, at, out = arrays.extended(docs, text_col, column, DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            texts = arrays.as_strings(batch.column(at))
            for a, b in arrays.slices(texts):
                found = scorer.scores(texts.slice(a, b - a).to_pylist())
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], out.names)

    return plain.mapInArrow(workers.lean(run), out)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier), ``predicted``.

    Scores see the text only, all of it.  Without labels of both classes the score is the known class's (or one half).
    Repeated rows and rows without an id each get a row; an empty table gives an empty result.
    """
    net = fit_toxicity(docs, labels, id_col, text_col, label)
    out = scored(docs.select(F.col(id_col), F.col(text_col).alias("text")), net)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay.

    Null and empty texts are scored as one empty word, and rows without an id like any other.  An empty table stays empty.
    """
    net = fit_toxicity(docs, labels, **options)
    column = "__toxicity"
    while column in {c.lower() for c in docs.columns}:
        column += "_"
    return scored(docs, net, options.get("text_col", "text"), column).where(F.col(column) < threshold).drop(column)
