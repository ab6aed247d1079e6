"""Ids of a byte-level BPE vocabulary, by `tokenizers`, with each word merged once.

The vocabulary's pattern cuts a text before any merge, and equal cuts have equal
ids. Texts of plain characters, one byte each, are cut here by the same pattern,
many texts at once: classes of bytes give the cuts, a hash of each cut its number
among the distinct ones, and only cuts that are new are merged. Texts with other
characters are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from urlwarden.llm.common import worker_store

UNUSUAL = re.compile("[^\\n -~À-ÿ]")  # "<|" may open a special token; such texts are unusual too
KEPT_CUTS = 1_000_000  # in a worker, some 25 MB; beyond, all are forgotten
GROUP = 2_000_000  # characters cut at once
SAFE = re.compile("(?<=[^ \\n]) (?=[^ \\n])")  # a cut begins at such a blank, whatever stands around it
LETTER, DIGIT, OTHER, BLANK = 1, 2, 3, 4  # classes of bytes; 0 ends a text


def classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[[c for c in range(256) if chr(c).isalpha() and (c < 128 or c >= 192)]] = LETTER
    out[48:58] = DIGIT
    out[[10, 32]] = BLANK
    out[0] = 0
    return out


def byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it is visible, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in seen)
    return {b: b for b in seen} | {b: 256 + k for k, b in enumerate(hidden)}


CLASS = classes()
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
SALT = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)


def powers(base: int, count: int) -> np.ndarray:
    """Modulo 2**64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def cut_starts(data: np.ndarray) -> np.ndarray:
    """Where the vocabulary's pattern begins a cut in texts that each end in a zero byte: contractions; letters, digits or
    others with one blank before them; blanks and line ends, the last of which stays apart from what follows. Ends count too."""
    kind = CLASS[data]
    starts = np.empty(len(data), bool)
    starts[0] = True
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts[data == 0] = True
    after = np.flatnonzero(starts[1:] & (kind[:-1] == BLANK) & (kind[1:] != 0)) + 1
    starts[after - 1] = True
    starts[after[data[after - 1] == 32]] = False
    marks = np.flatnonzero((data == 39) & starts)
    if len(marks):
        one, two = data[np.minimum(marks + 1, len(data) - 1)], data[np.minimum(marks + 2, len(data) - 1)]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)  # re, ve, ll
        starts[marks[short | long] + 1] = False
        starts[marks[short] + 2] = True
        starts[marks[long] + 3] = True
    return np.flatnonzero(starts)


class Subwords:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.letters = byte_letters()
        self.power, self.back = powers(BASE, 1), powers(1, 1)
        self.forget()

    def forget(self) -> None:
        """What is known: hashes of cuts in order, where the ids of each begin in the pool, and how many there are."""
        self.keys, self.begins, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, self.dtype)

    def ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def learn(self, hashes: np.ndarray, cuts: list[bytes]) -> None:
        merge, letters = self.tokenizer.model.tokenize, self.letters
        found = [[token.id for token in merge(cut.decode("latin-1").encode().decode("latin-1").translate(letters))] for cut in cuts]
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        begins = (len(self.pool) + sizes.cumsum() - sizes).astype(np.int32)
        self.pool = np.concatenate([self.pool, np.fromiter((x for ids in found for x in ids), self.dtype, int(sizes.sum()))])
        order = np.argsort(hashes)
        keys = np.concatenate([self.keys, hashes[order]])
        merged = np.argsort(keys, kind="stable")  # of two rising parts
        self.keys = keys[merged]
        self.begins = np.concatenate([self.begins, begins[order]])[merged]
        self.sizes = np.concatenate([self.sizes, sizes[order]])[merged]

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where known hashes stand, -1 for others. ``hashes`` rise, as neighbours are then found close to each other."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def hashed(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A hash of each cut: its bytes' salts as the digits of a number, modulo 2**64, scrambled."""
        if len(self.power) <= len(data):
            self.power, self.back = powers(BASE, len(data) + 1), powers(pow(BASE, -1, 1 << 64), len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(SALT[data] * self.power[:len(data)], out=sums[1:])
        ends = np.append(starts[1:], len(data))
        out = (sums[ends] - sums[starts]) * self.back[starts]
        out ^= out >> np.uint64(31)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(29))

    def encode_group(self, texts: list[bytes]) -> list[bytes]:
        """Ids of plain texts."""
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        starts = cut_starts(data)
        ends_text = data[starts] == 0
        coded = pa.array(self.hashed(data, starts)).dictionary_encode()
        distinct = coded.dictionary.to_numpy()
        order = np.argsort(distinct)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        place, distinct = rank[coded.indices.to_numpy()], distinct[order]
        if len(self.keys) > KEPT_CUTS:
            self.forget()
        which = self.places(distinct)
        new = np.flatnonzero(which < 0)
        if len(new):
            first = np.empty(len(distinct), np.int64)
            first[place[::-1]] = np.arange(len(place) - 1, -1, -1)
            raw, ends, at = data.tobytes(), np.append(starts[1:], len(data)), first[new]
            self.learn(distinct[new], [raw[s:e].rstrip(b"\0") for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            which = self.places(distinct)
        which = which[place]
        sizes = np.where(ends_text, 0, self.sizes[which])
        total = sizes.cumsum(dtype=np.int64)
        ids = self.pool[np.repeat(self.begins[which] - (total - sizes), sizes) + np.arange(int(total[-1]))].tobytes()
        bounds = np.concatenate([[0], total[ends_text]]) * self.dtype.itemsize
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, as bytes of ``dtype``."""
        out: list[list[bytes]] = []
        held: list[bytes] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                for k, ids in zip(owner, self.encode_group(held)):
                    out[k].append(ids)
            held.clear()
            owner.clear()
            size = 0

        for k, text in enumerate(texts):
            out.append([])
            if "<|" in text or UNUSUAL.search(text):
                out[k].append(self.ids(text))
                continue
            for part in parts(text):
                if size and size + len(part) > GROUP:
                    flush()
                held.append(part.encode("latin-1"))
                owner.append(k)
                size += len(part)
        flush()
        return [ids[0] if len(ids) == 1 else b"".join(ids) for ids in out]


def parts(text: str) -> Iterator[str]:
    """A text in parts of some ``GROUP`` characters, each beginning where a cut does."""
    at = 0
    while len(text) - at > GROUP:
        found = SAFE.search(text, at + GROUP)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


def subwords(path: str) -> Subwords:
    """One for each vocabulary and Python worker, kept from task to task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    kept = worker_store()
    if path not in kept:
        kept[path] = Subwords(path)
    return kept[path]
