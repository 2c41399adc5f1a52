"""What a BPE tokenizer makes of a text's words, kept in worker caches.

Both kinds of public tokenizers here cut texts at blanks before they merge bytes, so a text's ids are those of its
words, one after the other:

* tokenizers that drop blanks (``WordCodes``): words are runs between ASCII blanks;
* byte-level tokenizers (``spaced_pieces``): a word takes the single space before it along.  That holds where no space
  follows another blank and the text does not end in a blank.

Words go to the library as they are, special strings included, so every result is the library's; texts outside these
conditions go to the library whole.
"""

from __future__ import annotations

import json
import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, pre_tokenizers

from sparkwarden.llm import workers

#: Entries that a worker's cache holds before it keeps only the more frequent half, or is emptied.
CACHE_ENTRIES = 800_000
#: Latin words of which it is certain how many pre-tokens they have.
_PLAIN = regex.compile(r"[!-~\u00C0-\u012F\u0131-\u024F]+")
#: Bytes that begin blanks outside ASCII (or are taken for blanks by some): texts with them go to the library.
_ODD = np.zeros(256, bool)
_ODD[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_PAIRS = tuple(b + " " for b in " \t\n\r\x0b\x0c")
_BLANKS = tuple(" \t\n\r\x0b\x0c")


def load(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
    out = Tokenizer.from_file(path)
    out.no_padding()
    out.no_truncation()
    return out


def encode(library: Tokenizer, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def kind_of(path: str) -> str | None:
    """``spaced`` (byte-level, keeps blanks), ``blankless`` (drops blanks), or None for any other tokenizer."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]] if spec["normalizer"] else [])
    cuts = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or set(t["content"]) & set(" \t\n\r\x0b\x0c") for t in spec["added_tokens"]):
        return None
    if not steps and len(cuts) == 1 and cuts[0]["type"] == "ByteLevel" and cuts[0]["use_regex"] and not cuts[0]["add_prefix_space"]:
        return "spaced"
    known = all(s["type"] in ("NFC", "Lowercase") or s.get("pattern") == {"Regex": "\\s+"} and s["content"] == " " for s in steps)
    # The pattern keeps letters, numbers and runs of what is neither, so no match crosses a blank.
    keeps = cuts[0]["type"] == "Split" and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and cuts[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    if known and keeps and [c["type"] for c in cuts[1:]] == ["ByteLevel"] and not cuts[1]["use_regex"] and not cuts[1]["add_prefix_space"]:
        return "blankless"
    return None


def odd_documents(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which documents of a slice have bytes that may be blanks outside ASCII."""
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, np.flatnonzero(_ODD[data]), side="right") - 1] = True
    return out


def spaced_pieces(text: str) -> list[str] | None:
    """The pieces between single spaces, or None where a text's ids are not those of its pieces."""
    if text.endswith(_BLANKS) or any(p in text for p in _PAIRS):
        return None
    return text.split(" ")


def _taken(flat: np.ndarray, start: np.ndarray, length: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The stretches ``at`` of ``flat``, one after the other."""
    per = length[at]
    ends = np.cumsum(per)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(start[at] - (ends - per), per)]


class Codes:
    """Ids of words in one flat array, filled as words are first seen; the rarer words go when it is full.

    A subclass cuts texts into words (``cut``) and says what a word's ids are (``encoded``).
    """

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries = entries
        self.index: dict[str, int] = {}
        self._room(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def cut(self, texts: pa.Array) -> pa.Array:
        """The words of each text (large strings): an array of lists."""
        raise NotImplementedError

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, flat, and the number of each word's."""
        raise NotImplementedError

    def _room(self, flat: np.ndarray, length: np.ndarray, seen: np.ndarray) -> None:
        """Take over the ids, lengths and counts of the entries, with room to grow."""
        n, self.used = len(length), len(flat)
        self.flat = np.zeros(max(1 << 20, 2 * self.used), np.uint32)
        self.start, self.length, self.seen = (np.zeros(max(1 << 16, 2 * n), np.int64) for _ in range(3))
        self.flat[: self.used], self.length[:n], self.seen[:n] = flat, length, seen
        self.start[:n] = np.cumsum(length) - length

    def forget(self) -> None:
        """Keep the more frequent half of the entries, with half their counts."""
        words, n = list(self.index), len(self.index)
        keep = np.sort(np.argsort(-self.seen[:n], kind="stable")[: n // 2])
        flat = self._expand(keep)
        self.index = {words[k]: j for j, k in enumerate(keep.tolist())}
        self._room(flat, self.length[keep].copy(), self.seen[keep] // 2)

    def _expand(self, at: np.ndarray) -> np.ndarray:
        return _taken(self.flat, self.start, self.length, at)

    def _learn(self, words: list[str]) -> None:
        ids, per = self.encoded(words)
        k, total = len(self.index), len(ids)
        while k + len(words) > len(self.start):
            self.start, self.length, self.seen = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length, self.seen))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[k : k + len(words)], self.length[k : k + len(words)] = self.used + np.cumsum(per) - per, per
        self.flat[self.used : self.used + total] = ids
        self.index.update(zip(words, range(k, k + len(words)), strict=True))
        self.used += total

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the entries of distinct words are."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            at[fresh] = np.arange(len(self.index), len(self.index) + len(fresh))
            self._learn([words[k] for k in fresh.tolist()])
        return at

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (large strings without nulls), flat, and the number of each text's ids."""
        if len(self.index) > self.entries:
            self.forget()
        lists = self.cut(texts)
        # Arrow finds the distinct words of the slice, so that Python looks up each of them once.
        values = lists.flatten().dictionary_encode()
        at = self._places(values.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = values.indices.to_numpy()
        self.seen[at] += np.bincount(which, minlength=len(at))
        places = at[which]
        bounds = np.cumsum(np.r_[0, pc.list_value_length(lists).to_numpy(zero_copy_only=False)])
        upto = np.r_[0, np.cumsum(self.length[places])][bounds]
        return self._expand(places), np.diff(upto)


class WordCodes(Codes):
    """Ids of texts by a tokenizer that drops blanks: those of its words, one after the other.

    Words that the cache lacks are cut into pre-tokens by the tokenizer's own pattern, and those that are not words by
    themselves are encoded together, as lines of one text, by the library's model without its normaliser.  Every
    pre-token ends in a token of its own kind (``</w>``), which deals the ids out again.  Words outside plain Latin
    script, and words with special strings, are encoded one by one by the whole tokenizer.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        super().__init__(entries)
        self.library = load(path)
        self.by_word = kind_of(path) == "blankless"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix")
        self.find = None
        if self.by_word and suffix:
            self.find = regex.compile("\\n|" + spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
            self.lines = Tokenizer.from_file(path)
            self.lines.normalizer = None
            self.lines.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.lower = any(x["type"] == "Lowercase" for x in (spec["normalizer"] or {}).get("normalizers", []))

    def cut(self, texts: pa.Array) -> pa.Array:
        return pc.ascii_split_whitespace(texts)

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain words by their pre-tokens; the others, and all where the ends do not add up, one by one."""
        plain = self.find is not None
        sure = np.fromiter((plain and (w.isascii() and w.isprintable() or _PLAIN.fullmatch(w) is not None) for w in words), bool, len(words))
        if sure.any() and any(s in "\n".join(words) for s in self.special):
            sure &= np.fromiter((not any(s in w for s in self.special) for w in words), bool, len(words))
        out = self._by_pretokens([words[k] for k in np.flatnonzero(sure).tolist()] if not sure.all() else words) if sure.any() else None
        if out is None:
            sure[:] = False
            out = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if sure.all():
            return out
        alone = encode(self.library, [words[k] for k in np.flatnonzero(~sure).tolist()])
        pool = np.concatenate([out[0], np.fromiter((i for x in alone for i in x), np.uint32)])
        length = np.concatenate([out[1], np.fromiter(map(len, alone), np.int64, len(alone))])
        back = np.argsort(np.r_[np.flatnonzero(sure), np.flatnonzero(~sure)], kind="stable")
        return _taken(pool, np.cumsum(length) - length, length, back), length[back]

    def _by_pretokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        text = "\n".join(words)
        tokens = pa.array(self.find(text.lower() if self.lower else text), pa.large_string()).dictionary_encode()
        kinds, which = tokens.dictionary.to_numpy(zero_copy_only=False).tolist(), tokens.indices.to_numpy()
        at = np.fromiter(map(self.index.get, kinds, repeat(-1)), np.int64, len(kinds))
        line = kinds.index("\n") if len(words) > 1 else -1
        fresh = [k for k in np.flatnonzero(at < 0).tolist() if k != line]
        ids = np.array(self.lines.encode_batch_fast(["\n".join(kinds[k] for k in fresh)], add_special_tokens=False)[0].ids, np.int64)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(fresh):
            return None
        length, start = self.length[at], self.start[at]  # of known ones
        length[fresh] = np.diff(stops, prepend=0)
        start[fresh] = self.used + stops - length[fresh]
        if line >= 0:
            length[line] = 0
        pool = np.concatenate([self.flat[: self.used], ids.astype(np.uint32)])
        per_word = np.bincount(np.cumsum(which == line), weights=length[which], minlength=len(words)).astype(np.int64)
        return _taken(pool, start, length, which), per_word

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.by_word:
            return super().ids(texts)
        found = encode(self.library, texts.to_pylist())
        return np.fromiter((i for x in found for i in x), np.uint32), np.fromiter(map(len, found), np.int64, len(found))


def word_codes(path: str) -> WordCodes:
    """The worker's codes for a tokenizer: its cache goes on from task to task, until tasks of another kind come."""
    return workers.kept("words", path, lambda: WordCodes(path))


def known_counts(path: str) -> tuple[Tokenizer, dict[str, int]]:
    """A tokenizer and the worker's token counts of its pieces, kept from task to task like ``word_codes``."""
    return workers.kept("counts", path, lambda: (load(path), {}))
