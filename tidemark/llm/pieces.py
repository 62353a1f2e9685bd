"""SentencePiece encoding and decoding of a BPE model with byte fallback, by suffix-array matching.

The distinct stretches of a batch (white space and what follows, which no piece crosses) are joined and indexed by a
suffix array as deep as the longest piece. Each piece is binary-searched for its range of suffixes; the ranges are the
edges of a lattice. Edges are relaxed by position: the encoding of a beginning has one last piece, and an edge extends it
if the two pieces, joined, are encoded as these two. That pairwise rule makes the path the one of the merges.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Code points that are indexed at once, and encoded stretches that a worker remembers, in two halves of different age.
INDEXED = 1 << 19
REMEMBERED = 1 << 19
#: Places in which the pairs that were met last are looked up first, without a search; a power of two.
PLACES = 1 << 20
#: Pairs of pieces that a worker remembers to be compatible or not; characters from which merging takes a heap.
PAIRS = 1 << 21
LONG = 64
ROWS_AT_ONCE = 1000


class Pieces:
    """The vocabulary of a model file and what is derived from it."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(size)]
        self.bytes = {int(self.texts[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        normal = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {self.texts[i]: i for i in normal}
        self.rank = {self.texts[i]: -model.get_score(i) for i in normal}
        characters = sorted({c for t in self.ids for c in t})
        if len(characters) >= 1 << 15:
            raise ValueError(f"{len(characters)} characters in the vocabulary, 32767 at most fit the suffix array's numbers")
        self.dense = np.zeros(0x110001, dtype=np.uint16)
        self.dense[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        # Only pieces that merging their own characters gives can be in an encoding.
        reached = [i for i in normal if self.merged(self.texts[i]) == [i] and len(set(self.texts[i]) - {SPACE}) > 0 or self.texts[i] == SPACE]
        self.piece_ids = np.array(reached, dtype=np.int64)
        self.piece_sizes = np.array([len(self.texts[i]) for i in reached], dtype=np.int64)
        self.depth = int(self.piece_sizes.max())
        low = np.zeros((len(reached), self.depth), dtype=">u2")
        high = np.full((len(reached), self.depth), 0xFFFF, dtype=">u2")
        for row, i in enumerate(reached):
            points = self.dense[[ord(c) for c in self.texts[i]]]
            low[row, : len(points)] = high[row, : len(points)] = points
        self.low, self.high = (m.view(f"S{2 * self.depth}").ravel() for m in (low, high))
        by_text = np.argsort(self.low)  # neighbours are searched after each other
        self.low, self.high = self.low[by_text], self.high[by_text]
        self.piece_ids, self.piece_sizes = self.piece_ids[by_text], self.piece_sizes[by_text]
        self.pair_keys, self.pair_valid = np.zeros(0, np.int64), np.zeros(0, bool)
        self.place_keys, self.place_valid = np.full(PLACES, -1, np.int64), np.zeros(PLACES, bool)
        self.known: dict[str, bytes] = {}  # 32-bit ids
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[int]:
        """Ids by plain merging: the adjacent pair with the best score, the left one of equals, until none is a piece."""
        if len(text) > LONG:
            return self.merged_long(text)
        parts, rank = list(text), self.rank
        costs = [rank.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
        while costs and (best := min(costs)) != np.inf:
            i = costs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i > 0:
                costs[i - 1] = rank.get(parts[i - 1] + parts[i], np.inf)
            if i < len(costs):
                costs[i] = rank.get(parts[i] + parts[i + 1], np.inf)
        return [self.ids.get(p, -1) for p in parts]

    def merged_long(self, text: str) -> list[int]:
        """The same with a heap of pairs and linked neighbours, so that a long run takes n log n steps."""
        parts: list[str | None] = list(text)
        n, rank = len(parts), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(cost, i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (cost := rank.get(a + b)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, whole = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j == n or parts[i] + parts[j] != whole:
                continue  # one of the two was merged elsewhere
            parts[i], parts[j] = whole, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (cost := rank.get(pair := parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (cost, a, pair))
        return [self.ids.get(p, -1) for p in parts if p is not None]

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of pieces is its own encoding.

        The place of a pair follows from its number and holds the one that came last; the others are searched.
        """
        keys = left * len(self.texts) + right
        places = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (PLACES - 1)
        valid = self.place_valid[places]
        missed = np.flatnonzero(self.place_keys[places] != keys)
        if len(missed):
            places, keys = places[missed], keys[missed]
            valid[missed] = found = self.searched(keys)
            # Of pairs that share a place one is kept, the same in both columns.
            kept, first = np.unique(places, return_index=True)
            self.place_keys[kept], self.place_valid[kept] = keys[first], found[first]
        return valid

    def searched(self, keys: np.ndarray) -> np.ndarray:
        """The same for pairs by their numbers, from all that are remembered; new ones are decided by merging."""
        if len(self.pair_keys) > PAIRS:
            self.pair_keys, self.pair_valid = self.pair_keys[:0], self.pair_valid[:0]
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        fresh = keys if not len(self.pair_keys) else keys[self.pair_keys[at] != keys]
        if len(fresh):
            fresh = np.unique(fresh)
            pairs = [divmod(k, len(self.texts)) for k in fresh.tolist()]
            valid = np.array([self.merged(self.texts[a] + self.texts[b]) == [a, b] for a, b in pairs])
            places = np.searchsorted(self.pair_keys, fresh)
            self.pair_keys, self.pair_valid = np.insert(self.pair_keys, places, fresh), np.insert(self.pair_valid, places, valid)
            at = np.searchsorted(self.pair_keys, keys)
        return self.pair_valid[at]

    def suffixes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array of dense symbols, sorted to the depth of the longest piece, and the sorted beginnings."""
        padded = np.concatenate([symbols, np.zeros(self.depth, np.uint16)])
        # Four symbols fit one number, as there are fewer than 2^15; then ranks double the width they stand for.
        wide = np.concatenate([padded.astype(np.int64), np.zeros(3, np.int64)])
        n, width = len(padded), 4
        key = (wide[:n] << 45) | (wide[1 : n + 1] << 30) | (wide[2 : n + 2] << 15) | wide[3 : n + 3]
        while width < self.depth:
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
            key = rank * (int(rank.max()) + 1)
            key[:-width] += rank[width:]
            width *= 2
        order = np.argsort(key[: len(symbols)])
        begins = np.lib.stride_tricks.sliding_window_view(padded.astype(">u2"), self.depth)[order]
        return order, np.ascontiguousarray(begins).view(f"S{2 * self.depth}").ravel()

    def matched(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches without runs of spaces, and where those of each begin and, last, end.

        -1 - code point stands for a character that is no piece.
        """
        sizes = np.array([len(s) for s in stretches], dtype=np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]  # a separator follows each stretch
        points = np.full(int((sizes + 1).sum()), 0x110000, dtype=np.int64)
        inside = np.ones(len(points), dtype=bool)
        inside[begin + sizes] = False
        points[inside] = np.frombuffer("".join(stretches).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = self.dense[points]
        order, begins = self.suffixes(symbols)
        first, last = np.searchsorted(begins, self.low, "left"), np.searchsorted(begins, self.high, "right")
        counts = last - first
        which = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
        start, piece, size = order[rows], self.piece_ids[which], self.piece_sizes[which]
        other = np.flatnonzero((symbols == 0) & inside)
        start, piece = np.concatenate([start, other]), np.concatenate([piece, -1 - points[other]])
        size = np.concatenate([size, np.ones(len(other), np.int64)])
        offset = start - np.repeat(begin, sizes + 1)[start]
        small = offset.astype(np.uint16) if len(offset) and offset.max() < 1 << 16 else offset  # sorted by digits
        by_offset = np.argsort(small, kind="stable")
        start, piece, size, offset = start[by_offset], piece[by_offset], size[by_offset], offset[by_offset]
        none = -(1 << 40)
        final, back = np.full(len(points) + 1, none, dtype=np.int64), np.zeros(len(points) + 1, dtype=np.int64)
        steps = np.flatnonzero(np.concatenate([[True], offset[1:] != offset[:-1], [True]])) if len(offset) else np.zeros(1, int)
        for lo, hi in zip(steps[:-1], steps[1:]):
            here, p, n = start[lo:hi], piece[lo:hi], size[lo:hi]
            if offset[lo] > 0:
                before = final[here]
                fits = before != none
                both = fits & (before >= 0) & (p >= 0)
                fits[both] = self.compatible(before[both], p[both])
                here, p, n = here[fits], p[fits], n[fits]
            final[here + n], back[here + n] = p, here
        # Back from the ends, all stretches side by side.
        at, tokens, owners = begin + sizes, [], []
        open_ones = np.arange(len(stretches))
        while len(open_ones):
            tokens.append(final[at[open_ones]])
            owners.append(open_ones)
            at[open_ones] = back[at[open_ones]]
            open_ones = open_ones[at[open_ones] > begin[open_ones]]
        tokens, owners = np.concatenate(tokens)[::-1], np.concatenate(owners)[::-1]
        by_owner = np.argsort(owners, kind="stable")
        return tokens[by_owner], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(stretches)))])

    def expanded(self, tokens: np.ndarray) -> bytes:
        if not len(tokens) or tokens.min() >= 0:
            return tokens.astype(np.int32).tobytes()
        out: list[int] = []
        for t in tokens.tolist():
            out += [t] if t >= 0 else [self.bytes[b] for b in chr(-1 - t).encode("utf-8", "surrogatepass")]
        return np.array(out, dtype=np.int32).tobytes()

    def learn(self, stretches: set[str]) -> None:
        """Encodes what is not remembered. Stretches that were not met since the last change of halves are forgotten first."""
        if len(self.known) + len(stretches) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = [s for s in stretches if s not in known]
        if older:
            known.update({s: older[s] for s in new if s in older})
            new = [s for s in new if s not in older]
        runs = [s for s in new if s.startswith(SPACE * 2)]
        for s in runs:  # pieces of spaces share one score, so that the pairwise rule does not hold for them
            characters = iter(self.unmatched(s))
            self.known[s] = self.expanded(np.array([p if p >= 0 else -1 - next(characters) for p in self.merged(s)], dtype=np.int64))
        plain = [s for s in new if not s.startswith(SPACE * 2)] if runs else new
        if not plain:
            return
        part = np.cumsum([len(s) + 1 for s in plain]) // INDEXED
        cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(plain)]]).tolist()
        for lo, hi in zip(cuts, cuts[1:]):
            tokens, ends = self.matched(plain[lo:hi])
            raw, other = tokens.astype(np.int32).tobytes(), np.add.reduceat(np.append(tokens < 0, False), ends[:-1]) > 0
            at = (4 * ends).tolist()
            self.known.update(zip(plain[lo:hi], map(raw.__getitem__, map(slice, at, at[1:]))))
            for i in np.flatnonzero(other).tolist():
                self.known[plain[lo + i]] = self.expanded(tokens[ends[i] : ends[i + 1]])

    def unmatched(self, text: str) -> list[int]:
        return [ord(c) for c in text if c not in self.ids]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; an empty one has none."""
        split = [STRETCH.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn({s for parts in split for s in parts})
        known = self.known
        return [np.frombuffer(b"".join([known[s] for s in parts]), np.int32) for parts in split]


def decode(ids: list[int], raw: list[bytes]) -> str:
    """The text of ids, less the space that encoding puts in front; broken bytes give replacement characters."""
    text = b"".join(map(raw.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


@cache
def raw_pieces(model_file: str) -> list[bytes]:
    """What each piece stands for when it is decoded; control pieces stand for nothing."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    raw = []
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        silent = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        raw.append(b"" if silent else bytes([int(text[3:5], 16)]) if model.is_byte(i) else text.replace(SPACE, " ").encode())
    return raw


@cache
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _encode_batches(model_file: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary = pieces(model_file)
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(at, ROWS_AT_ONCE)
            texts = batch.column("text").to_pylist()
            ids = vocabulary.encode([t or "" for t in texts])
            ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            missing = pa.array([t is None for t in texts])
            array = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])), mask=missing)
            yield pa.RecordBatch.from_arrays([*batch.columns, array], names=[*batch.schema.names, "piece_ids"])


def _decode_batches(model_file: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw = raw_pieces(model_file)
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_AT_ONCE):
            batch = whole.slice(at, ROWS_AT_ONCE)
            column = batch.column("piece_ids")
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).tolist()
            ids = column.flatten().to_numpy(zero_copy_only=False).tolist()
            present = column.is_valid().to_pylist()
            texts = [decode(ids[a:b], raw) if is_there else None for a, b, is_there in zip(ends, ends[1:], present)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "piece_text"])


def encoded(documents: DataFrame, model_file: str) -> DataFrame:
    """``documents`` with piece_ids, an array; a missing text has none, an empty one an empty array.

    The model file lies at one path on every executor. A column of that name is replaced, others pass through.
    """
    plain = documents.drop("piece_ids")
    return plain.mapInArrow(lambda batches: _encode_batches(model_file, batches), f"{_fields(plain)}, piece_ids array<int>")


def decoded(rows: DataFrame, model_file: str) -> DataFrame:
    """``rows`` with piece_text, the text of piece_ids. It is the encoded text but for U+2581, which reads as a space."""
    plain = rows.drop("piece_text")
    return plain.mapInArrow(lambda batches: _decode_batches(model_file, batches), f"{_fields(plain)}, piece_text string")


def digest(documents: DataFrame, model_file: str) -> DataFrame:
    """Number and hash of the ids of every text, and whether decoding them gives the text back."""
    rows = decoded(encoded(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model_file), model_file)
    same = F.replace("text", F.lit(SPACE), F.lit(" ")).eqNullSafe(F.col("piece_text"))
    return rows.select("doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"), F.xxhash64("piece_ids").alias("ids_hash"), same.alias("round_trip"))
