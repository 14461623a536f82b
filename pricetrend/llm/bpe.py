"""Byte-level BPE encoding and decoding by speculation and verification.

Every distinct word is first cut greedily into the longest vocabulary tokens.
A cut is the true BPE encoding exactly when each adjacent token pair would also
stay apart if its two tokens were encoded alone, so all pairs of a batch are
tested together with numpy; only words holding a failing pair are merged
exactly, rank by rank.

The pair test replays the merges backwards. Undoing merges from the latest to
the earliest walks down the right edge of the left token and the left edge of
the right token. At each step the two parts that touch are known, and a merge
of them that comes before the merge that consumed either part would have joined
the tokens. Of equal merges the leftmost comes first.

Nulls count as empty texts; empty texts give no ids. Very long texts are encoded whole,
the words of one section at a time. Repeated rows are encoded row by row; an empty table
gives no rows. Input columns that have the name of an output column are replaced; other
columns are kept.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from pricetrend.llm.common import slices, without

# Fixed value: the public pattern that splits text before the merges.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
NEVER = np.int64(1) << 40
# Distinct words and token pairs a task remembers before it starts anew; bounds its memory only.
WORD_MEMORY = 300_000
PAIR_MEMORY = 300_000
SECTION = 1 << 20       # characters of a text that are split into words at once


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level vocabulary files: printable Latin-1
    stands for itself, the other bytes follow from 256 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairModel:
    """A byte-level BPE vocabulary with its pair test and an exact merger."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        raw = lambda token: bytes(to_byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        n = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes_of: list[bytes] = [b""] * n
        self.rank = np.full(n, -1, np.int64)
        self.left = np.zeros(n, np.int64)
        self.right = np.zeros(n, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = token.encode() if token in self.special else raw(token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.merge_of: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            if (x, y) not in self.merge_of:
                self.merge_of[x, y] = (r, made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = r, x, y
        keys = np.array([(x << 32) | y for x, y in self.merge_of], np.int64)
        ranks = np.array([r for r, _ in self.merge_of.values()], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        self.rank_made = np.zeros(1 + max([-1, *ranks.tolist()]), np.int64)
        for r, made in self.merge_of.values():
            self.rank_made[r] = made
        self.byte_id = [0] * 256
        for i, b in enumerate(self.bytes_of):
            if len(b) == 1 and self.rank[i] < 0:
                self.byte_id[b[0]] = i
        # A token may be proposed if encoding its own bytes gives it back.
        merged = np.flatnonzero(self.rank >= 0)
        whole = self.apart(self.left[merged], self.right[merged], self.rank[merged])
        good = {int(i) for i in merged[whole]} | set(self.byte_id)
        for i in merged[np.argsort(self.rank[merged])].tolist():
            if i in good and not (int(self.left[i]) in good and int(self.right[i]) in good):
                good.discard(i)
        self.token_id = {self.bytes_of[i]: i for i in good}
        # The longest token with each start of four bytes; other starts have at most three.
        self.reach: dict[bytes, int] = {}
        for b in self.token_id:
            if len(b) > 3:
                self.reach[b[:4]] = max(len(b), self.reach.get(b[:4], 0))
        self.split = regex.compile(PATTERN)
        self.cut_special = (regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None)
        self.forget()

    def forget(self) -> None:
        """Drop the remembered words and pairs."""
        self.row_of: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)    # the ids of all remembered words
        self.ends = np.zeros(1 << 14, np.int64)     # where each word's ids end
        self.known_pairs: dict[int, bool] = {}
        for token, i in self.special.items():
            self._keep("\0special:" + token, [i])

    # -- verification --------------------------------------------------------

    def merge_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = (x << 32) | y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens ``a[i]`` and ``b[i]`` next to each other stay two tokens
        under all merges (ranked below ``before[i]``)."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        top = np.full(len(x), NEVER, np.int64) if before is None else before.astype(np.int64)
        eaten_x, eaten_y = top.copy(), top - (before is not None)
        ok, live = np.ones(len(x), bool), np.arange(len(x))
        while len(live):
            lx, ly = x[live], y[live]
            m = self.merge_rank(lx, ly)
            joined = (m < eaten_x[live]) & (m <= eaten_y[live])
            ok[live[joined]] = False
            rx, ry = self.rank[lx], self.rank[ly]
            on = ~joined & ((rx >= 0) | (ry >= 0))
            undo_y = on & (ry >= rx)
            undo_x = on & ~undo_y
            i = live[undo_y]
            eaten_y[i], y[i] = ry[undo_y], self.left[ly[undo_y]]
            i = live[undo_x]
            eaten_x[i], x[i] = rx[undo_x], self.right[lx[undo_x]]
            live = live[on]
        return ok

    # -- speculation and exact merging -----------------------------------------

    def propose(self, word: bytes) -> list[int]:
        """The word cut from the left into the longest tokens."""
        out, at, n, ids, reach = [], 0, len(word), self.token_id, self.reach
        while at < n:
            end = at + reach.get(word[at:at + 4], 3)
            if end > n:
                end = n
            while (i := ids.get(word[at:end])) is None:
                end -= 1
            out.append(i)
            at = end
        return out

    def merge_exactly(self, word: bytes) -> list[int]:
        """All merges of one word in order of (rank, position)."""
        return self.merge_all([word])[0]

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """The same for many words side by side: each round makes the first merge of
        the least rank in every word, and looks up only the pairs that it changed."""
        out: list[list[int]] = [[] for _ in words]
        live = np.array([i for i, w in enumerate(words) if len(w) <= 64], np.int64)
        for i, w in enumerate(words):
            if len(w) > 64:
                out[i] = self._merge_long([self.byte_id[b] for b in w])
        sizes = np.array([len(words[i]) for i in live], np.int64)
        live, sizes = live[sizes > 0], sizes[sizes > 0]
        tokens = np.array(self.byte_id, np.int64)[np.frombuffer(b"".join(words[i] for i in live.tolist()), np.uint8)]
        ranks = np.full(len(tokens), NEVER, np.int64)  # of each token with the next one of its word
        ranks[:-1] = self.merge_rank(tokens[:-1], tokens[1:]) if len(tokens) else ranks[:-1]
        ends = np.cumsum(sizes)
        ranks[ends - 1] = NEVER
        while len(live):
            starts = ends - sizes
            least = np.minimum.reduceat(ranks, starts)
            done = least >= NEVER
            if done.any():
                for i, a, b in zip(live[done].tolist(), starts[done].tolist(), ends[done].tolist()):
                    out[i] = tokens[a:b].tolist()
                stay = np.repeat(~done, sizes)
                tokens, ranks = tokens[stay], ranks[stay]
                live, sizes, least = live[~done], sizes[~done], least[~done]
                ends = np.cumsum(sizes)
                if not len(live):
                    break
            owner = np.repeat(np.arange(len(live)), sizes)
            hits = np.flatnonzero(ranks == least[owner])
            first = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]
            tokens[first] = self.rank_made[least]
            ranks[first] = ranks[first + 1]     # what is left of the swallowed token's end of word
            last = first + 1 == ends - 1
            keep = np.ones(len(tokens), bool)
            keep[first + 1] = False
            tokens, ranks = tokens[keep], ranks[keep]
            at = first - np.arange(len(first))  # one token fewer in each word before
            sizes = sizes - 1
            ends = np.cumsum(sizes)
            right = at[~last]
            ranks[right] = self.merge_rank(tokens[right], tokens[right + 1])
            left = at[at > ends - sizes] - 1
            ranks[left] = self.merge_rank(tokens[left], tokens[left + 1])
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The merges of one long word on a linked list with a heap."""
        n = len(ids)
        prev, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*self.merge_of[p], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.merge_of]
        heap = [(r, i, made, p) for r, made, i, p in heap]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, made, (x, y) = heapq.heappop(heap)
            if gone[i] or ids[i] != x or (j := after[i]) >= n or ids[j] != y:
                continue
            ids[i], gone[j] = made, True
            after[i] = k = after[j]
            if k < n:
                prev[k] = i
                if hit := self.merge_of.get(p := (made, ids[k])):
                    heapq.heappush(heap, (hit[0], i, hit[1], p))
            if (h := prev[i]) >= 0 and (hit := self.merge_of.get(p := (ids[h], made))):
                heapq.heappush(heap, (hit[0], h, hit[1], p))
        return [t for t, dead in zip(ids, gone) if not dead]

    def _keep(self, word: str, ids: list[int]) -> None:
        row = len(self.row_of)
        start = int(self.ends[row - 1]) if row else 0
        end = start + len(ids)
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        if row == len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[start:end] = ids
        self.ends[row] = end
        self.row_of[word] = row

    def learn(self, words: Iterable[str]) -> None:
        """Encode new words: propose, test every adjacent pair, merge the failures."""
        words = list(words)
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        cuts = [self.propose(b) for b in raw]
        sizes = np.array([len(c) for c in cuts], np.int64)
        tokens = np.fromiter((t for c in cuts for t in c), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        keys, where = np.unique((tokens[inner] << 32) | tokens[inner + 1], return_inverse=True)
        known = self.known_pairs
        listed = keys.tolist()
        if new := [k for k in listed if k not in known]:
            if len(known) > PAIR_MEMORY:
                known.clear()
                new = listed
            pairs = np.array(new, np.int64)
            known.update(zip(new, self.apart(pairs >> 32, pairs & 0xFFFFFFFF).tolist()))
        fine = np.fromiter((known[k] for k in listed), bool, len(listed))
        failing = set(owner[inner[~fine[where]]].tolist())
        again = sorted(failing)
        for i, ids in zip(again, self.merge_all([raw[i] for i in again])):
            cuts[i] = ids
        for word, ids in zip(words, cuts):
            self._keep(word, ids)

    # -- texts -------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        if self.cut_special is None or not any(s in text for s in self.special):
            return self.split.findall(text)
        out: list[str] = []
        for part in self.cut_special.split(text):
            if part in self.special:
                out.append("\0special:" + part)
            elif part:
                out.extend(self.split.findall(part))
        return out

    def sections(self, text: str) -> Iterator[str]:
        """A very long text cut before blanks that follow other signs: words always end
        there and special tokens hold no blanks, so sections are encoded alone."""
        start, n = 0, len(text)
        while n - start > SECTION:
            cut = start + SECTION
            while (cut := text.find(" ", cut)) >= 0 and text[cut - 1].isspace():
                cut += 1
            if cut < 0:
                break
            yield text[start:cut]
            start = cut
        yield text[start:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, unsigned 32-bit."""
        if any(len(t) > SECTION for t in texts):
            return [np.concatenate([self.encode([s])[0] for s in parts]) if len(parts := list(self.sections(t))) > 1
                    else self._encode([t])[0] for t in texts]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.row_of) > WORD_MEMORY:
            self.forget()
        split = [self.pieces(t) for t in texts]
        row_of = self.row_of
        if new := {w for words in split for w in words if w not in row_of}:
            self.learn(sorted(new))
        ends = self.ends
        out = []
        for words in split:
            rows = np.fromiter(map(row_of.__getitem__, words), np.int64, len(words))
            start = np.where(rows > 0, ends[rows - 1], 0)
            n = ends[rows] - start
            upto = np.cumsum(n)
            at = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(start - upto + n, n)
            out.append(self.flat[at])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that aren't UTF-8 become U+FFFD."""
        bytes_of = self.bytes_of
        return b"".join([bytes_of[i] for i in ids.tolist()]).decode("utf-8", "replace")


_MODELS: dict[str, BytePairModel] = {}


def model(path: str) -> BytePairModel:
    """The vocabulary at ``path``, read once in each worker process."""
    if path not in _MODELS:
        _MODELS[path] = BytePairModel(path)
    return _MODELS[path]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
           count: str = "n_tokens") -> DataFrame:
    """``df`` with the ids of ``text`` (binary, little-endian unsigned 32-bit) and their number."""
    kept = without(df, [count, ids])
    schema = StructType([*kept.schema.fields, StructField(count, LongType()), StructField(ids, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for part in slices(batches):
            got = bpe.encode([t or "" for t in part.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([len(x) for x in got], pa.int64()),
                 pa.array([x.astype("<u4").tobytes() for x in got], pa.binary())], schema.names)
        bpe.forget()

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of the binary ``ids``; null ids give an empty text."""
    kept = without(df, [text])
    schema = StructType([*kept.schema.fields, StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for part in slices(batches):
            got = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in part.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.string())], schema.names)

    return kept.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
               count: str = "n_tokens", decoded: str = "decoded") -> DataFrame:
    """``encode`` followed by ``decode`` of the ids in one pass over the rows; the
    result has the other columns of ``df``, but not ``text``."""
    df = without(df, {count, ids, decoded} - {text})
    carried = [c for c in df.columns if c.lower() != text.lower()]
    schema = StructType([*(df.schema[c] for c in carried), StructField(count, LongType()),
                         StructField(ids, BinaryType()), StructField(decoded, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for part in slices(batches):
            got = bpe.encode([t or "" for t in part.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in carried),
                 pa.array([len(x) for x in got], pa.int64()),
                 pa.array([x.astype("<u4").tobytes() for x in got], pa.binary()),
                 pa.array([bpe.decode(x) for x in got], pa.string())], schema.names)
        bpe.forget()

    return df.mapInArrow(run, schema)
