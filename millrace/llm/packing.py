"""Pack documents into token windows with their lexical neighbours.

Documents are range-partitioned by the smallest hashes of their words, in order, so texts that share words meet,
also where many share the first ones; equal sketches are split by id, so a text with a third of all copies spreads
over many tasks. Neighbours are looked for in a document's own shard only. A task reads its range in
order and cuts it into shards of bounded size. Each shard has a BM25 inverted index over token ids. A
window starts with the rest of the last document or the next unused one (the seed); the index returns the
seed's best unused neighbours, which fill the window greedily. The neighbour that crosses the border is
cut and its rest seeds the next window, also into the next shard, so only the last window of a task can be
short. That one is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

WINDOW = 2_048
END_ID = 1
SHARD_TOKENS = 1_000_000
SHARD_DOCS = 4_096
NEIGHBOURS = 16
K1, B = 1.2, 0.75
SKETCH = 8
CACHE_PIECES = 1_000_000
CACHE_IDS = 8_000_000
TEXT_BYTES = 1 << 20
COMPARED = 1 << 14  # pieces whose bytes are laid side by side at a time

# Fixed: how byte-level BPE files of this kind split a text into words.
BYTE_LEVEL_SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[*range(9, 14), *range(28, 33)]] = True
# Lead bytes of the characters among which all wider blanks are.
_WIDE_LEAD = [0xC2, 0xE1, 0xE2, 0xE3]
_MAY_BE_WHITE = _IS_BLANK.copy()
_MAY_BE_WHITE[_WIDE_LEAD] = True

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


def _bytes_of_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the next free characters."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            out[chr(free)] = b
            free += 1
    return out


def fast_encoder(path: str):
    """A tiktoken encoder with the ids of a byte-level BPE tokenizer file, or None where the file is another kind.

    Merging by rank is merging by id exactly when every merge made the next id; that is checked.
    """
    spec = json.loads(open(path, encoding="utf-8").read())
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if (model["type"], split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) != (
            "BPE", "ByteLevel", True, False) or spec.get("normalizer") or spec.get("post_processor"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    import tiktoken
    of, added = _bytes_of_alphabet(), {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places ``start .. start + length`` of each range, one after the other."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


class TokenIds:
    """Token ids of texts, with a cache of pieces between blanks.

    A blank alone between two other characters always starts a token, so the ids of a text are those of its
    pieces, each with the blank before it. Pieces are found, hashed (64 bits) and looked up as arrays;
    only pieces not seen before are encoded. Every piece is compared with the bytes that its hash stands for; one that
    only shares the hash is looked up by its bytes.
    """

    def __init__(self, path: str, end_id: int):
        self.path, self.fast, self.end_id = path, fast_encoder(path), end_id
        self.added = [t["content"] for t in json.loads(open(path, encoding="utf-8").read())["added_tokens"]]
        self.line_feed = self._ids("\n")[0]
        self._grow(1 << 20)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        # piece 0 is the end of a document
        self.pool, self.at, self.size = [np.array([self.end_id], "<u4")], np.array([0]), np.array([1])
        self.held = 1
        self.bytes, self.byte_at, self.byte_size = np.zeros(0, np.uint8), np.array([0]), np.array([0])
        self.odd: dict[bytes, int] = {}  # pieces whose hash stands for another one

    def _grow(self, n: int) -> None:
        """Powers of the hash base and of its inverse."""
        base = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
        back = np.full(n, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
        base[0] = back[0] = 1
        self.powers, self.inverse = np.cumprod(base), np.cumprod(back)

    @cached_property
    def tokenizer(self):
        """Loaded only where a text needs it: beside the fast encoder it would be a second copy of the vocabulary."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def _ids(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.added):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast(text)

    def _encode(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces ``data[start:stop]``, one after the other, and how many each has.

        No piece has white space inside, so they go in as lines of one text: a line feed between them is a
        token of its own.
        """
        length = stop - start + 1
        before = np.cumsum(length) - length
        lines = data[np.minimum(np.repeat(start - before, length) + np.arange(int(length.sum())), len(data) - 1)]
        lines[before + length - 1] = 10
        ids = np.array(self._ids(lines[:-1].tobytes().decode()), "<u4")
        ends = np.flatnonzero(ids == self.line_feed)
        if len(ends) != len(start) - 1:
            return self._encode_alone(data, start, stop)
        return ids[ids != self.line_feed], np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1

    def _encode_alone(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        found = [self._ids(raw[i:j].decode()) for i, j in zip(start.tolist(), stop.tolist())]
        sizes = np.array([len(f) for f in found])
        return np.fromiter(chain.from_iterable(found), "<u4", int(sizes.sum())), sizes

    def _learn(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Encode new pieces into the pool; their numbers."""
        odd = np.concatenate([[0], np.cumsum(_MAY_BE_WHITE[data])])
        alone = odd[stop] - odd[start + (data[start] == 32)] > 0
        numbers = np.zeros(len(start), np.int64)
        for at, encode in ((np.flatnonzero(~alone), self._encode), (np.flatnonzero(alone), self._encode_alone)):
            if len(at):
                ids, sizes = encode(data, start[at], stop[at])
                numbers[at] = np.arange(len(self.at), len(self.at) + len(at))
                length = stop[at] - start[at]
                self.byte_at = np.concatenate([self.byte_at, len(self.bytes) + np.cumsum(length) - length])
                self.byte_size = np.concatenate([self.byte_size, length])
                self.bytes = np.concatenate([self.bytes, data[_ranges(start[at], length)]])
                self.at = np.concatenate([self.at, self.held + np.cumsum(sizes) - sizes])
                self.size = np.concatenate([self.size, sizes])
                self.pool.append(ids)
                self.held += len(ids)
        self.pool = [np.concatenate(self.pool)]
        return numbers

    def _settle(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The numbers of the pieces of ``data``, those corrected whose bytes are not the ones their hash stands for."""
        length = stop - start
        wrong = self.byte_size[numbers] != length
        size = np.where(wrong, 0, length)
        for lo in range(0, len(size), COMPARED):
            own = slice(lo, lo + COMPARED)
            held = self.bytes[_ranges(self.byte_at[numbers[own]], size[own])]
            differ = np.flatnonzero(held != data[_ranges(start[own], size[own])])
            wrong[lo + np.searchsorted(np.cumsum(size[own]), differ, side="right")] = True
        for i in np.flatnonzero(wrong):
            piece = data[start[i]:stop[i]].tobytes()
            if piece not in self.odd:
                self.odd[piece] = int(self._learn(data, start[i:i + 1], stop[i:i + 1])[0])
            numbers[i] = self.odd[piece]
        return numbers

    def _cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Positions of blanks that stand alone between two other characters of one text."""
        at = np.flatnonzero(data == 32)
        padded = np.concatenate([np.full(3, 32, np.uint8), data, np.full(1, 32, np.uint8)])
        p3, p2, p1, n1 = (padded[at + k] for k in (0, 1, 2, 4))
        # Taking too many characters for wide blanks only makes longer pieces.
        wide = (p2 == 0xC2) | ((p3 >= 0xE1) & (p3 <= 0xE3) & (p1 >= 0x80)) | _MAY_BE_WHITE[n1]
        at = at[~(_IS_BLANK[p1] | wide)]
        bounds = np.zeros(len(data) + 1, bool)
        bounds[starts] = True
        return at[~bounds[at] & ~bounds[at + 1]]

    def __call__(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text and the end id."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets -= offsets[0]
        if len(data) >= len(self.powers):
            self._grow(len(data) + 1)
        full = offsets[:-1][np.diff(offsets) > 0]
        start = np.sort(np.concatenate([full, self._cuts(data, offsets)]))
        stop = np.append(start[1:], len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        own = sums[1:]
        own += data
        own += np.uint64(1)
        own *= self.powers[:len(data)]
        np.cumsum(own, out=own)
        hashes, first, inverse = np.unique((sums[stop] - sums[start]) * self.inverse[start], return_index=True,
                                           return_inverse=True)
        place = np.searchsorted(self.keys, hashes)
        seen = np.zeros(len(hashes), bool)
        inside = place < len(self.keys)
        seen[inside] = self.keys[place[inside]] == hashes[inside]
        new = np.flatnonzero(~seen)
        if len(new):
            numbers = self._learn(data, start[first[new]], stop[first[new]])
            self.keys = np.insert(self.keys, place[new], hashes[new])
            self.numbers = np.insert(self.numbers, place[new], numbers)
            place = np.searchsorted(self.keys, hashes)
        # the pieces of each text in order, then its end
        per_text = np.bincount(np.searchsorted(offsets, start, side="right") - 1, minlength=len(texts))
        piece = np.zeros(len(start) + len(texts), np.int64)
        is_end = np.zeros(len(piece), bool)
        is_end[np.cumsum(per_text + 1) - 1] = True
        if len(start):
            piece[~is_end] = self._settle(data, start, stop, self.numbers[place][inverse])
        length = self.size[piece]
        before = np.cumsum(length) - length
        ids = self.pool[0][np.repeat(self.at[piece] - before, length) + np.arange(int(length.sum()))]
        cut = (before + length)[is_end]
        if len(self.keys) > CACHE_PIECES or self.held > CACHE_IDS:
            self._forget()
        return np.split(ids, cut[:-1])


class Shard:
    """An inverted BM25 index over the token ids of at most ``SHARD_DOCS`` documents."""

    def __init__(self, docs: list[np.ndarray]):
        n = self.n = len(docs)
        sizes = np.array([len(d) for d in docs])
        keys = np.concatenate(docs).astype(np.int64)
        keys *= n
        keys += np.repeat(np.arange(n), sizes)
        keys.sort()
        entry = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        tf, keys = np.diff(np.r_[entry, len(keys)]), keys[entry]
        term, self.doc = keys // n, (keys % n).astype(np.int32)
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.r_[first, len(term)])
        self.df = df
        self.term = np.repeat(np.arange(len(first)), df).astype(np.int32)  # terms renumbered by id
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes / sizes.mean())
        self.weight = (idf[self.term] * tf * (K1 + 1) / (tf + norm[self.doc])).astype(np.float32)
        # The terms of each document, for when it is a seed; words no other document has cannot find one.
        useful = np.flatnonzero(df[self.term] > 1)
        order = useful[np.argsort(self.doc[useful], kind="stable")]
        self.forward = self.term[order]
        self.begin = np.searchsorted(self.doc[order], np.arange(n + 1))
        self.unused = np.ones(n, bool)
        self.listed = n  # documents that the postings still hold
        self._keep(df[self.term] > 1)

    def _keep(self, entries: np.ndarray) -> None:
        """Leave these entries in the postings, which are ordered by term."""
        self.term, self.doc, self.weight = self.term[entries], self.doc[entries], self.weight[entries]
        self.first = np.searchsorted(self.term, np.arange(len(self.df) + 1))

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents by falling score of all terms of the seed, ties by place; only those that share a term."""
        left = np.count_nonzero(self.unused)
        if 4 * left < 3 * self.listed:
            self._keep(self.unused[self.doc])
            self.listed = left
        terms = self.forward[self.begin[seed]:self.begin[seed + 1]]
        entries = _ranges(self.first[terms], self.first[terms + 1] - self.first[terms])
        scores = np.bincount(self.doc[entries], self.weight[entries], self.n)
        scores[~self.unused] = 0
        best = np.argpartition(-scores, NEIGHBOURS)[:NEIGHBOURS] if self.n > NEIGHBOURS else np.arange(self.n)
        best = best[scores[best] > 0]
        return best[np.lexsort((best, -scores[best]))]


class Packer:
    """Fills windows of one task; ``rows`` are finished pieces."""

    def __init__(self, task: int, window: int):
        self.window, self.next_id = window, task << 33
        self.open: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the window being filled
        self.filled = 0
        self.rows: list[tuple] = []

    def _close(self) -> None:
        offset = 0
        for doc_id, start, ids, total in self.open:
            self.rows.append((doc_id, start, ids.astype("<u4").tobytes(), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1
        self.open, self.filled = [], 0

    def add(self, doc_id, ids: np.ndarray) -> bool:
        """Append a whole document over as many windows as it needs; True if its rest leaves a window open."""
        at = 0
        while at < len(ids):
            piece = ids[at:at + self.window - self.filled]
            self.open.append((doc_id, at, piece, len(ids)))
            self.filled += len(piece)
            at += len(piece)
            if self.filled == self.window:
                self._close()
        return bool(self.filled)

    def shard(self, doc_ids: list, docs: list[np.ndarray]) -> None:
        """Place all documents of a shard; the last window may stay open for the next one."""
        index = Shard(docs)
        in_order, seed, near = iter(range(len(docs))), None, []
        for _ in docs:
            if seed is not None and not near:
                near = index.neighbours(seed)[::-1].tolist()
            i = near.pop() if near else next(j for j in in_order if index.unused[j])
            index.unused[i] = False
            window = self.next_id
            open_ = self.add(doc_ids[i], docs[i])
            if self.next_id != window:  # the border was crossed: what is left of this one seeds the new window
                near, seed = [], i if open_ else None
            elif not near:
                seed = i

    def finish(self) -> None:
        """Cut what is left into sequences of powers of two."""
        left = self.open
        self.open, self.filled = [], 0
        room = 1 << (sum(len(p[2]) for p in left).bit_length() - 1) if left else 0
        total = sum(len(p[2]) for p in left)
        for doc_id, start, ids, doc_tokens in left:
            at = 0
            while at < len(ids):
                piece = ids[at:at + room - self.filled]
                self.open.append((doc_id, start + at, piece, doc_tokens))
                self.filled += len(piece)
                at += len(piece)
                if self.filled == room:
                    self._close()
                    total -= room
                    room = 1 << (total.bit_length() - 1) if total else 0


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
                   shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in windows: doc_id, start, ids, doc_tokens, sequence_id, offset.

    Every document is its token ids and then ``end_id``; ``ids`` are a piece's ids as little-endian 32-bit
    bytes, ``start`` and ``doc_tokens`` count in the document, ``offset`` in the sequence. Each id lies in
    exactly one piece; all sequences are full but the last ones of a task, whose sizes are powers of two.
    Null texts are empty and give the end id alone. Repeated rows are packed each on its own. Other columns
    are not read. An empty table gives no rows. ``tokenizer`` is a file the workers can open. A retry of a
    lost task gives the same pieces.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = F.slice(F.array_distinct(F.sort_array(F.transform(F.split("text", " "), lambda w: F.xxhash64(w)))), 1, SKETCH)
    ranged = own.select(near.alias("near"), "doc_id", F.xxhash64("text").alias("key"), "text",
                        F.octet_length("text").alias("bytes")).repartitionByRange("near", "doc_id", "key")
    ranged = ranged.sortWithinPartitions("near", "doc_id", "key")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = TokenIds(tokenizer, end_id), Packer(TaskContext.get().partitionId(), window)
        doc_ids, arrays, tokens = [], [], 0

        def rows() -> pa.RecordBatch:
            cols = list(zip(*packer.rows)) or [()] * 6
            packer.rows = []
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            ends = np.cumsum(batch.column(4).to_numpy()) // TEXT_BYTES
            for at in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(ends)) + 1):
                if not len(at):
                    continue
                part = batch.slice(int(at[0]), len(at))
                doc_ids += part.column(1).to_pylist()
                arrays += encode(part.column(3))
                tokens += sum(map(len, arrays[-len(at):]))
                if tokens >= shard_tokens or len(arrays) >= SHARD_DOCS:
                    packer.shard(doc_ids, arrays)
                    doc_ids, arrays, tokens = [], [], 0
                    yield rows()
        if arrays:
            packer.shard(doc_ids, arrays)
        packer.finish()
        yield rows()

    return ranged.mapInArrow(pack, PIECES)
