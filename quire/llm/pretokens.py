"""Token ids and counts of whole texts, through a library's own tokenizer.

For the word BPE (lower-cased pre-tokens, each merged alone) the text is cut
into pre-tokens with array operations on its code points, and the library
encodes every distinct pre-token once per Python worker; a table of bounded
size remembers its ids under the pre-token's 64-bit hash.  Texts that hold a
special string or a character outside the simple ones (``SAFE``) go to the
library whole, as do all texts for any other vocabulary file."""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import chunks, mix, segment_hashes, utf8

#: The normaliser and pre-tokeniser that the array form reproduces.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Slots of each of the two tables of known pre-tokens (3 MB in all), and
#: entries after which they start anew (some 3 MB with their ids).
SLOT_BITS = 17
MOST_ENTRIES = 1 << 17
SPACE, LETTER, NUMBER, OTHER, HARD = range(5)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of the code points below 0x10000.  A character is
    hard if it may combine with others, is beyond the tabulated ranges, or has
    no lower case of one character that stays as it is."""
    kind, lower = np.full(0x10001, HARD, np.uint8), np.arange(0x10001, dtype=np.uint32)
    for a, b in ((0x4E00, 0x9FA6), (0xAC00, 0xD7A4)):
        kind[a:b] = LETTER
    white = {*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F}
    for c in range(0x2C00):
        ch = chr(c)
        cat = unicodedata.category(ch)
        low = ch.lower()
        if cat[0] == "M" or cat == "Cn" or 0x1100 <= c < 0x1200 or c == 0x3A3 or len(low) != 1 or unicodedata.normalize("NFC", ch) != ch or low.lower() != low:
            continue
        lower[c] = ord(low)
        kind[c] = SPACE if c in white else LETTER if cat[0] == "L" else NUMBER if cat[0] == "N" else OTHER
    return kind, lower


KIND, LOWER = _tables()
VALUE = mix(LOWER.astype(np.uint64) + np.uint64(0x51ED27))


def pretokens(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the pre-tokens of texts whose code points lie one
    after the other, text i from at[i] on."""
    n = len(points)
    p = np.minimum(points, 0x10000)
    kind = np.zeros(n + 4, np.uint8)
    kind[:n] = KIND[p]
    low = np.zeros(n + 4, np.uint32)
    low[:n] = LOWER[p]
    cut = np.zeros(n + 4, bool)
    cut[at] = True
    start = (kind != SPACE) & (cut | (kind == NUMBER))
    start[1:] |= (kind[1:] != SPACE) & (kind[1:] != kind[:-1])
    start[n:] = False
    # An apostrophe that is alone before s, t, m, d, re, ve or ll takes them.
    i = np.flatnonzero((low == 39) & start)
    i = i[(kind[i + 1] == LETTER) & ~cut[i + 1]]
    a, b = low[i + 1], np.where((kind[i + 2] == LETTER) & ~cut[i + 2], low[i + 2], 0)
    size = np.isin(a, [ord(x) for x in "stmd"]) + 2 * (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
    i, size = i[size > 0], size[size > 0]
    start[i + 1] = False
    after = i + 1 + size
    start[after[(kind[after] == LETTER) & ~cut[after]]] = True
    edge = start | (kind == SPACE) | cut
    edge[n] = True
    edges, starts = np.flatnonzero(edge[:n + 1]), np.flatnonzero(start)
    return starts, edges[np.searchsorted(edges, starts) + 1] if len(starts) else starts, np.searchsorted(starts, at)


class Encoder:
    """Ids of texts for one vocabulary file, given as its bytes."""

    def __init__(self, content: bytes, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.piece = kind == ".model"
        self.by_words = False
        if self.piece:
            import sentencepiece
            self.lib = sentencepiece.SentencePieceProcessor(model_proto=content)
        else:
            from tokenizers import Tokenizer
            self.lib = Tokenizer.from_str(content.decode())
            config = json.loads(content)
            self.special = [t["content"].encode() for t in config["added_tokens"]]
            norm, pre = config["normalizer"] or {}, config["pre_tokenizer"] or {}
            self.by_words = (
                [x.get("type") for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and norm["normalizers"][1]["pattern"] == {"Regex": "\\s+"}
                and [x.get("type") for x in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["pattern"] == {"Regex": SPLIT}
                and not pre["pretokenizers"][1]["add_prefix_space"] and config["model"]["type"] == "BPE" and not config["post_processor"]
                and config["model"]["end_of_word_suffix"] == "</w>" and not config["model"]["continuing_subword_prefix"])
            self.ends = np.zeros(self.lib.get_vocab_size(with_added_tokens=True), bool)
            self.ends[[i for t, i in self.lib.get_vocab(with_added_tokens=True).items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.keys, self.entry = np.zeros((2, 1 << SLOT_BITS), np.uint64), np.zeros((2, 1 << SLOT_BITS), np.int32)
        self.at, self.n, self.ids = np.zeros(1 << 12, np.int64), 0, np.zeros(1 << 14, np.uint32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        """The library's own ids."""
        if self.piece:
            return self.lib.encode(texts, num_threads=1) if texts else []
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def single_words(self) -> np.ndarray:
        """Hashes of the vocabulary's strings that encode alone as one token.
        This is tried with the library, string by string."""
        if not self.by_words:
            return np.zeros(0, np.uint64)
        chars = _byte_chars()
        words = []
        for s in self.lib.get_vocab(with_added_tokens=False):
            if s.endswith("</w>") and all(c in chars for c in s[:-4]):
                try:
                    words.append(bytes(chars[c] for c in s[:-4]).decode())
                except UnicodeDecodeError:
                    continue
        words = [w for w in words if w and w == "".join(chr(LOWER[min(ord(c), 0x10000)]) for c in w) and all(KIND[min(ord(c), 0x10000)] not in (SPACE, HARD) for c in w)]
        one = [w for w, ids in zip(words, self.whole(words), strict=True) if len(ids) == 1]
        points = np.frombuffer("".join(one).encode("utf-32-le"), np.uint32)
        at = np.r_[0, np.cumsum([len(w) for w in one])].astype(np.int64)
        start, end, first = pretokens(points, at)
        alone = np.flatnonzero(np.diff(first) == 1)
        start, end = start[first[alone]], end[first[alone]]
        return np.sort(segment_hashes(VALUE[np.minimum(points, 0x10000)], start, end))

    def _merged(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of pre-tokens.  They go to the library in one text, with
        spaces between; a token with the end-of-word mark ends each."""
        size = end - start
        at = np.cumsum(size + 1) - size - 1
        text = np.full(int((size + 1).sum()), 32, np.uint32)
        text[np.repeat(at - np.cumsum(size) + size, size) + np.arange(size.sum())] = points[np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())]
        ids = np.array(self.whole([text.tobytes().decode("utf-32-le")])[0], np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) == len(size) and (not len(ids) or last[-1] == len(ids) - 1):
            return ids, np.diff(np.r_[-1, last])
        found = self.whole([points[a:b].tobytes().decode("utf-32-le") for a, b in zip(start, end, strict=True)])
        return np.array([x for f in found for x in f], np.uint32), np.array([len(f) for f in found], np.int64)

    def _remember(self, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Entries of new pre-tokens."""
        flat, sizes = self._merged(points, start, end)
        have = int(self.at[self.n])
        while self.n + len(sizes) + 1 > len(self.at):
            self.at = np.r_[self.at, np.zeros_like(self.at)]
        while have + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[have:have + len(flat)] = flat
        self.at[self.n + 1:self.n + 1 + len(sizes)] = have + np.cumsum(sizes)
        new = np.arange(self.n, self.n + len(sizes))
        self.n += len(sizes)
        return new

    def entries(self, hashes: np.ndarray, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each pre-token.  A hash has a place in either table; a
        new one takes the second if the first is taken."""
        if self.n > MOST_ENTRIES:
            self.clear()
        place = lambda h, k: (h >> np.uint64(64 - SLOT_BITS if k == 0 else 8) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64)
        slot = place(hashes, 0)
        out = self.entry[0, slot].astype(np.int64)
        missed = np.flatnonzero(self.keys[0, slot] != hashes)
        if len(missed):
            slot = place(hashes[missed], 1)
            out[missed] = self.entry[1, slot]
            missed = missed[self.keys[1, slot] != hashes[missed]]
        if len(missed):
            new, first, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
            got = self._remember(LOWER[np.minimum(points, 0x10000)], start[missed[first]], end[missed[first]])
            out[missed] = got[which]
            slot = place(new, 0)
            free = self.keys[0, slot] == 0
            self.keys[0, slot[free]], self.entry[0, slot[free]] = new[free], got[free]
            slot = place(new[~free], 1)
            self.keys[1, slot], self.entry[1, slot] = new[~free], got[~free]
        return out

    def split(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(easy, points, at): which texts the array form handles, and their code points."""
        data, offsets = utf8(column)
        n = len(offsets) - 1
        if not self.by_words:
            return np.zeros(n, bool), np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        at, easy = offsets, np.ones(n, bool)
        if len(points) < len(data):
            at = np.r_[0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)].astype(np.int64)[offsets]
            hard = np.flatnonzero(KIND[np.minimum(points, 0x10000)] == HARD)
            easy[np.searchsorted(at, hard, "right") - 1] = False
        for special in self.special:
            k = raw.find(special)
            while k >= 0:
                easy[np.searchsorted(offsets, k, "right") - 1] = False
                k = raw.find(special, k + 1)
        return easy, points, at

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, at): the ids of all texts one after the other, and where each text's begin."""
        easy, points, at = self.split(column)
        n = np.zeros(len(easy), np.int64)
        ids = np.zeros(0, np.uint32)
        if easy.any():
            start, end, first = pretokens(points, at)
            keep = np.repeat(easy, np.diff(first))
            e = self.entries(segment_hashes(VALUE[np.minimum(points, 0x10000)], start[keep], end[keep]), points, start[keep], end[keep])
            size = self.at[e + 1] - self.at[e]
            ids = self.ids[np.repeat(self.at[e] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            total = np.r_[0, np.cumsum(size)]
            first = np.r_[0, np.cumsum(np.diff(first) * easy)]
            n = total[first[1:]] - total[first[:-1]]
        if easy.all():
            return ids, np.r_[0, np.cumsum(n)]
        hard = np.flatnonzero(~easy)
        whole = self.whole(["" if t is None else t for t in column.take(pa.array(hard)).to_pylist()])
        parts, have = [], np.r_[0, np.cumsum(n)]
        by_row = dict(zip(hard.tolist(), whole, strict=True))
        for i in range(len(easy)):
            parts.append(np.array(by_row[i], np.uint32) if i in by_row else ids[have[i]:have[i + 1]])
        return np.concatenate(parts), np.r_[0, np.cumsum([len(x) for x in parts])]


def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: the
    printable ones for themselves, the others by code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in shown}
    out.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
    return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(content: bytes, kind: str) -> Encoder:
    """The worker's encoder for a vocabulary; tasks of one worker share it."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(content, kind)
    return _ENCODERS[key]


def vocabulary(spark, path: str):
    """The vocabulary file's bytes, broadcast (a fixed file of a few MB), and its kind."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read()), os.path.splitext(path)[1]


def encoded(batches: Iterator[pa.RecordBatch], content: bytes, kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batches in chunks with their ids and offsets."""
    enc = encoder(content, kind)
    for b in chunks(batches):
        yield b, *enc.encode(b.column("text"))
