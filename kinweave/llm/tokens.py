"""Token ids by a public tokenizer file, with repeated words encoded once per worker.

A byte-level tokenizer's own pattern always starts a new piece at a space that a non-space follows, and a single line end
between other signs is a piece by itself. So a text without other white space can be cut there, and each unit (a word with the
space before it, or a line end with what follows) encoded alone: the ids are those of the whole text (tests hold this against
the library on any text). Texts repeat most of their units, so each worker keeps a bounded table of them, with
a pool of ids, and hands only new ones to the library; a batch of texts is cut, looked up and put together column by column.
Texts with other white space or the opening of a special token, and all texts of other kinds of tokenizers, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kinweave.llm import workers

#: Units that a worker keeps; beyond that the half that was not used for longest goes.
KEPT_WORDS = 800_000
TOGETHER = 4_000
#: What keeps a text from being cut: runs of white space, white space but for spaces and line ends, at the end of a text, "<|".
_WHOLE = r"[\t-\r ][\t-\r ]|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[\t-\r ]\z|<\|"
_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?!\S)")
#: Units of letters of long-settled blocks, ASCII digits and marks, whose pieces are plain to see, and these pieces.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ", r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(f"[\n0-9{_LETTERS}{_MARKS}]+")
_PIECES = re.compile(f"\n| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+")
_ENCODERS: dict[str, "Encoder"] = {}
workers.keeps("tokens", _ENCODERS.clear)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_signs() -> str:
    """The sign that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(hidden)) for b in range(256))


def ragged(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pool's runs one after another, and where each of them ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    at += np.arange(total, dtype=kind)
    return pool.take(at), ends


class Encoder:
    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        pre = told.get("pre_tokenizer") or {}
        self.cuts = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not told.get("normalizer") and len(self.tokenizer.encode("\n", add_special_tokens=False).ids) == 1
        if self.cuts:
            # the same model over signs of bytes, one piece a line; no plain unit has the byte 0, which parts pieces
            self.bare = Tokenizer.from_file(path)
            self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            self.signs = "\n" + _byte_signs()[1:]
            size = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
                size[i] = len(token)  # one character stands for one byte
            self.size = size
            line = self.tokenizer.encode("\n", add_special_tokens=False).ids
            self.known, self.pool = {"\n": 0}, np.array(line, np.uint32)
            self.starts, self.sizes, self.used, self.turn = np.zeros(1, np.int64), np.ones(1, np.int64), np.full(1, 1 << 60), 0

    @staticmethod
    def cut(text: str) -> list[str]:
        """The text without each space that a non-space follows, cut there."""
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), 1024):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[i : i + 1024], add_special_tokens=False)]
        return out

    def _learn(self, new: list[str]) -> None:
        """Encodes new units together; the bytes that each id stands for tell where a unit ends."""
        plain, other = [], []
        for i in range(0, len(new), TOGETHER):
            some = new[i : i + TOGETHER]
            if all(some) and _PLAIN.fullmatch("".join(some)):
                plain += range(i, i + len(some))
            else:
                for k, w in enumerate(some, i):
                    (plain if _PLAIN.fullmatch(w) else other).append(k)
        ids, sizes = [], []
        for rows, model in ((plain, self.bare), (other, self.tokenizer)):
            groups = [rows[i : i + TOGETHER] for i in range(0, len(rows), TOGETHER)]
            units = [[new[i] if new[i][0] == "\n" else " " + new[i] for i in g] for g in groups]
            joined = ["".join(u) for u in units]
            if model is self.bare:
                joined = ["\0".join(_PIECES.findall(j)).encode().decode("latin1").translate(self.signs) for j in joined]
            # a few at a time: the library's own results are many times the ids
            for u, e in zip(units, (e for i in range(0, len(joined), 8) for e in model.encode_batch_fast(joined[i : i + 8], add_special_tokens=False))):
                own = np.array(e.ids, np.uint32)
                ends = np.cumsum(pc.binary_length(pa.array(u, pa.large_string())).to_numpy())
                cuts = np.searchsorted(np.cumsum(self.size[own]), ends) + 1
                ids.append(own)
                sizes.append(np.diff(cuts, prepend=0))
        order = np.argsort(np.array(plain + other, np.int64))
        sizes = np.concatenate(sizes)
        starts = np.cumsum(sizes) - sizes + len(self.pool)
        self.pool = np.concatenate([self.pool, *ids])
        self.starts, self.sizes = np.r_[self.starts, starts[order]], np.r_[self.sizes, sizes[order]]
        self.used = np.r_[self.used, np.full(len(new), self.turn)]

    def _forget(self) -> None:
        order = np.argsort(-self.used, kind="stable")[: self.kept // 2]
        order.sort()
        names = list(self.known)
        self.known.clear()  # else both tables are held at once
        self.known = {names[i]: k for k, i in enumerate(order.tolist())}
        self.sizes, self.used = self.sizes[order], self.used[order]
        self.pool, ends = ragged(self.pool, self.starts[order], self.sizes)
        self.starts = ends - self.sizes

    def flat(self, texts: list[str | None] | pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each text's followed by `end`, and each text's number of ids. A null text is empty."""
        tail = np.array([] if end is None else [end], np.uint32)
        if not len(texts):
            return tail[:0], np.zeros(0, np.int64)
        column = pc.fill_null(texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), "")
        whole = pc.match_substring_regex(column, _WHOLE).to_numpy(zero_copy_only=False) if self.cuts else np.ones(len(texts), bool)
        if whole.any():
            parts: list = [None] * len(texts)
            for i, x in zip(np.flatnonzero(whole).tolist(), self._whole(column.filter(pa.array(whole)).to_pylist())):
                parts[i] = np.concatenate([x, tail])
            others = np.flatnonzero(~whole)
            if len(others):
                ids, sizes = self._cut(column.filter(pa.array(~whole)), end)
                for i, x in zip(others.tolist(), np.split(ids, np.cumsum(sizes)[:-1])):
                    parts[i] = x
            return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return self._cut(column, end)

    def _cut(self, column: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        # a text's first word has no space before it: it stands after a line end, whose id is taken away again
        start, none = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())
        lines = pc.binary_join_element_wise(start, pc.replace_substring(column, "\n", " \n"), none)
        split = pc.split_pattern(lines, " ")
        units, bounds = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        if len(self.known) > self.kept:
            self._forget()
        self.turn += 1
        coded = units.dictionary_encode()
        names, known = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        at = np.fromiter(map(known.get, names, repeat(-1)), np.int64, len(names))
        if len(new := np.flatnonzero(at < 0)):
            at[new] = np.arange(len(known), len(known) + len(new))
            new = [names[i] for i in new.tolist()]
            self._learn(new)
            known.update(zip(new, count(len(known))))
        self.used[at] = np.maximum(self.used[at], self.turn)
        at = at[coded.indices.to_numpy()]
        ids, ends = ragged(self.pool, self.starts[at], self.sizes[at])
        ends = np.r_[0, ends][bounds - bounds[0]]
        sizes = np.diff(ends)
        if end is None:
            return np.delete(ids, ends[:-1]), sizes - 1
        ids[ends[:-1]] = end
        return np.r_[ids[1:], np.uint32(end)], sizes

    def encode(self, texts: list[str | None], end: int | None = None) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, then `end`."""
        ids, sizes = self.flat(texts, end)
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


def encoder(path: str, kept: int = KEPT_WORDS) -> Encoder:
    """One per worker and file, which keeps as many units from now on."""
    workers.serve("tokens")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].kept = kept
    return _ENCODERS[path]


def slices(texts: list[str | None] | pa.Array, most: int = 2_000_000):
    """Ranges of texts with about `most` characters at most, one text at least, to bound what is held at once."""
    start = held = 0
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist() if isinstance(texts, pa.Array) else (len(t or "") for t in texts)
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def crc(ids: bytes | memoryview) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
