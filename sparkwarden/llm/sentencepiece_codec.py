"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed and rebuilt: normaliser, ``▁`` marker, pieces with their scores (unigram) or the merges that
the scores imply (BPE), and byte fallback.  Where no piece reaches across a marker and the normaliser leaves texts as
they are, a text's ids are those of its words; each worker keeps the ids of words it has seen, and new ones are encoded
in batches by the library on as many threads as the task has cores.  Other texts are encoded whole.  Every new word, and
every text that is encoded whole, is encoded by the SentencePiece library as well; where the ids differ, that library's
are taken for that word or text.  So a text's ids depend on the text alone.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from sparkwarden.llm import arrays, workers
from sparkwarden.llm.pretokens import Codes

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Words whose ids a worker remembers.
CACHE_WORDS = 300_000
#: Bytes of text that are cut into words at a time.
BATCH_BYTES = 1 << 21
#: New words that one thread of the library encodes at a time.
BATCH_WORDS = 2000


def _merges(pieces: list) -> list[tuple[str, str]]:
    """Pairs in the order in which a BPE model joins them: by the score of what they make, the best first."""
    score = {p.piece: p.score for p in pieces if p.type in (NORMAL, USER_DEFINED)}
    pairs = []
    for piece, s in score.items():
        for k in range(1, len(piece)):
            if piece[:k] in score and piece[k:] in score:
                pairs.append((-s, len(pairs), piece[:k], piece[k:]))
    return [(a, b) for _, _, a, b in sorted(pairs)]


def rebuild(path: str) -> Tokenizer:
    """The tokenizer of the model file at ``path``."""
    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    pieces, spec, kind = list(model.pieces), model.normalizer_spec, model.trainer_spec
    unknown = next(k for k, p in enumerate(pieces) if p.type == UNKNOWN)
    if kind.model_type == BPE:
        core = models.BPE({p.piece: k for k, p in enumerate(pieces)}, _merges(pieces), unk_token=pieces[unknown].piece, fuse_unk=True, byte_fallback=kind.byte_fallback)
    elif kind.model_type == UNIGRAM:
        core = models.Unigram([(p.piece, p.score if p.type in (NORMAL, USER_DEFINED) else -1e9) for p in pieces], unk_id=unknown, byte_fallback=kind.byte_fallback)
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(spec.precompiled_charsmap)] if spec.precompiled_charsmap else []
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if spec.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    # Where no piece has the marker after another character, no piece crosses into the next word: words go one by one.
    if not any(MARK in p.piece.lstrip(MARK) for p in pieces if p.type == NORMAL):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    out.add_tokens([AddedToken(p.piece, normalized=False) for p in pieces if p.type == USER_DEFINED])
    strip = [decoders.Strip(" ", 1, 0)] if spec.add_dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return out


def _threads() -> int:
    """Let the library have as many threads as the task has cores; it looks once, before its first batch."""
    task = TaskContext.get()
    os.environ.setdefault("RAYON_NUM_THREADS", str(task.cpus() if task else 1))
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
    return int(os.environ["RAYON_NUM_THREADS"])


class PieceCodes(Codes):
    """Ids of texts by a rebuilt model, with a cache of words.

    A word is what stands between single spaces, with the marker before it.  A line break that is in no piece ends a
    word as well: what follows it up to the next space is a word without a marker (here: it begins with the break).
    """

    def __init__(self, path: str):
        super().__init__(CACHE_WORDS)
        _threads()
        self.whole = rebuild(path)
        self.exact = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, plain = model.normalizer_spec, [p.piece for p in model.pieces if p.type in (NORMAL, USER_DEFINED)]
        number = {p.piece: k for k, p in enumerate(model.pieces)}
        self.marked = spec.add_dummy_prefix
        self.by_word = (
            self.marked and not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and model.trainer_spec.byte_fallback
            and not any(p.type == USER_DEFINED for p in model.pieces) and not any(MARK in x.lstrip(MARK) or "\n" in x for x in plain) and "<0x0A>" in number
        )
        self.bytes_of = [bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode() for p in model.pieces]
        if self.by_word:
            self.line_break = number["<0x0A>"]
            self.lines = Tokenizer(self.whole.model)  # no normaliser: words come with their markers
            self.lines.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")

    def cut(self, texts: pa.Array) -> pa.Array:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words as lines of a few texts: the ids of line breaks deal the ids out again."""
        bare = np.fromiter((w[:1] == "\n" for w in words), bool, len(words))
        lines = [w[1:] if w[:1] == "\n" else MARK + w for w in words]
        texts = ["".join(f"{x}\n" for x in lines[k : k + BATCH_WORDS]) for k in range(0, len(lines), BATCH_WORDS)]
        ids = np.concatenate([np.array(e.ids, np.int64) for e in self.lines.encode_batch_fast(texts, add_special_tokens=False)])
        # SentencePiece puts a marker before the text: a line break takes it, and both are cut off again.
        exact = self.exact.encode(["\n" + t for t in texts], num_threads=_threads())
        exact = np.concatenate([np.array(x[x.index(self.line_break) + 1 :], np.int64) for x in exact])
        if not np.array_equal(ids, exact):
            ids = exact  # it is the same for every word that agrees
        stops = np.flatnonzero(ids == self.line_break)
        if len(stops) != len(words):
            raise ValueError("line breaks do not deal out the ids")
        # The break stands behind its line: it goes where the word begins with one, before the line.
        per = np.diff(stops, prepend=-1) - 1
        out = np.empty(int((per + bare).sum()), np.int64)
        begin = np.cumsum(per + bare) - (per + bare)
        out[begin[bare]] = self.line_break
        solid = np.ones(len(ids), bool)
        solid[stops] = False
        out[np.arange(int(per.sum())) + np.repeat(begin + bare - (np.cumsum(per) - per), per)] = ids[solid]
        return out, per + bare

    def _library(self, texts: list[str]) -> list[list[int]]:
        found = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        exact = self.exact.encode(texts, num_threads=_threads())
        return [x if x == y else y for x, y in zip(found, exact, strict=True)]

    def ids(self, texts: pa.Array, verify_every: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, flat, and each text's number of them.

        With ``verify_every``, texts at every so many-th place are encoded whole by SentencePiece once more, and those that
        differ have its ids.
        """
        if not self.by_word:
            own: dict[int, list[int]] = dict(enumerate(self._library(texts.to_pylist())))
        else:  # texts whose blanks run together, or that hold the marker itself or nothing
            odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK)), pc.or_(pc.starts_with(texts, " "), pc.equal(texts, "")))
            places = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
            own = dict(zip(places, self._library(texts.take(pa.array(places, pa.int64())).to_pylist()), strict=True)) if places else {}
        if len(own) == len(texts):
            flat, counts = np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        elif own:
            rest = np.setdiff1d(np.arange(len(texts)), list(own))
            flat, some = super().ids(texts.take(pa.array(rest)))
            counts = np.zeros(len(texts), np.int64)
            counts[rest] = some
        else:
            flat, counts = super().ids(texts)
        if verify_every:
            ends = np.cumsum(counts)
            some = range(0, len(texts), verify_every)
            checked = dict(zip(some, self.exact.encode([texts[k].as_py() for k in some], num_threads=_threads()), strict=True))
            own.update({k: x for k, x in checked.items() if x != (own[k] if k in own else flat[ends[k] - counts[k] : ends[k]].tolist())})
        if not own:
            return flat, counts
        parts, ends = [], np.cumsum(counts)
        for k in range(len(texts)):
            parts.append(np.asarray(own[k], np.uint32) if k in own else flat[ends[k] - counts[k] : ends[k]])
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def decoded(self, flat: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """What the ids say, as UTF-8. Ids that do not make text are left to the library."""
        out, at, table = [], 0, self.bytes_of
        ids = flat.tolist()
        for n in counts.tolist():
            found = b"".join(map(table.__getitem__, ids[at : at + n]))
            try:
                found.decode()
            except UnicodeDecodeError:
                found = self.whole.decode(ids[at : at + n], skip_special_tokens=False).encode()
            else:
                if self.marked and found[:1] == b" ":
                    found = found[1:]
            out.append(found)
            at += n
        return out


def piece_codes(path: str) -> PieceCodes:
    """The worker's codes for a model: its cache goes on from task to task, until tasks of another kind come."""
    return workers.kept("pieces", path, lambda: PieceCodes(path))


def encode(texts: list[str], path: str, verify_every: int = 0) -> list[list[int]]:
    """Ids of each text."""
    flat, counts = piece_codes(path).ids(pa.array(texts, pa.large_string()), verify_every)
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if texts else []


def decode(ids: list[list[int]], path: str) -> list[str]:
    flat = np.fromiter((i for x in ids for i in x), np.uint32)
    return [x.decode() for x in piece_codes(path).decoded(flat, np.fromiter(map(len, ids), np.int64, len(ids)))]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, verify_every: int = 0) -> DataFrame:
    """One row per row of ``docs``: id, ``n_pieces``, ``ids_crc32``, ``decoded_sha256``, ``round_trip`` (and ``ids``).

    Whole texts are encoded without begin or end, and the ids decoded again; ``round_trip`` says whether that gave the
    text back (it doesn't where the text itself holds the marker character or the normaliser changed it).  Null is the
    empty text, which has no pieces.  ``ids_crc32`` is of the ids as little-endian unsigned 32-bit numbers.  Repeated
    rows and rows without an id each get a row; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_pieces", "ids_crc32", "decoded_sha256", "round_trip", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = piece_codes(model)
        for batch in batches:
            column = arrays.as_strings(batch.column(1))
            for a, b in arrays.slices(column, BATCH_BYTES):
                texts = column.slice(a, b - a)
                flat, counts = codes.ids(texts, verify_every)
                back = codes.decoded(flat, counts)
                bounds = np.cumsum(np.r_[0, counts]).tolist()
                little = flat.astype("<u4")
                out = [
                    batch.column(0).slice(a, b - a),
                    pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(little[x:y].tobytes()) for x, y in zip(bounds, bounds[1:], strict=False)], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                    pc.equal(pa.array(back, pa.large_binary()), texts.cast(pa.large_binary())),
                ]
                yield pa.RecordBatch.from_arrays([*out, *([_lists(flat, counts)] if with_ids else [])], names)

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean" + (", ids array<int>" if with_ids else ""))


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.r_[0, counts]), pa.int32()), pa.array(flat.astype(np.int32)))


def add_pieces(docs: DataFrame, model: str, text_col: str = "text", column: str = "pieces") -> DataFrame:
    """``docs`` with the ids of each text in one more column, an array of int; null texts have none.

    A column of that name, as Spark compares names, is replaced; names may hold dots.  Repeated rows and rows without an
    id stay; an empty table stays empty.
    """

    plain, at, out = arrays.extended(docs, text_col, column, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = piece_codes(model)
        for batch in batches:
            whole = arrays.as_strings(batch.column(at))
            for a, b in arrays.slices(whole, BATCH_BYTES):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(*codes.ids(whole.slice(a, b - a)))], out.names)

    return plain.mapInArrow(run, out)
