"""Best-fit packing of tokenized documents by swap-based local search.

Every document becomes its byte-pair ids and one end id; only a document longer
than a sequence is cut, into whole sequences with the remainder first.  A piece
that fills a sequence is a sequence.  The others are dealt by hash into blocks of
about ``BLOCK_ROWS``.  In a block pieces are placed best fit, longest first; then,
while there are more bins than the pieces need, the emptiest bin gives to the other
underfull ones: it moves a piece, exchanges one piece for a shorter one, two for
one, or one for two.  An exchange shifts tokens from an emptier bin to a fuller one,
so the sum of squared fills always grows, and bins run empty.

A block's emptiest underfull bins, with a quarter of its pieces at most, are opened
again and dealt into the blocks of the next round, a quarter as many, until one
block is left: what a block wastes does not add up over the blocks, no task sees
more than a block, and only numbers (a row and its length) are shuffled.

Ids are those of the ``tokenizers`` file.  Its vocabulary is applied by ``tiktoken``,
which gives the same ids in a quarter of the time, except to texts with very long
words, for which ``tokenizers`` needs less time.

Defined cases: a null text counts as empty (one piece, the end id alone); null and
repeated doc_ids are packed row by row; repeated rows have pieces of their own; an
empty table gives an empty result.  Columns other than doc_id and text are not read,
whatever their names.
"""
from __future__ import annotations

import base64
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import ship, written
from judgeline.session import cut_lineage

ship(__name__)

TOKENIZERS = "/opt/tokenizers"
CAPACITY = 2048
END = 0
BLOCK_ROWS = 4096         # pieces that are packed together
CARRIED = 4               # at most one piece in so many is packed again in the next round
EXCHANGES = 200           # steps that one bin may take to run empty
STUCK = 8                 # bins that fail to run empty, one after the other, end the search
PAIRED = 24               # longest pieces of a bin that are taken two at a time
LONG_WORD = 500           # characters without white space, or of white space alone
TEXT_BLOCK = 65_536       # characters that `tokenizers` is given at once
HELD_TOKENS = 2_000_000   # tokens of pieces that a task holds before it passes them on

#: Fixed value: how the vocabulary cuts a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}


class Vocabulary:
    """The files of a byte-level vocabulary, read on the driver and sent to tasks."""

    def __init__(self, folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
        with open(os.path.join(folder, f"{name}.json"), encoding="utf-8") as f:
            self.json = f.read()
        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Tokenizer:
    """Ids of texts (``tokenizers``' own, without special tokens of its choosing)."""

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken
        self.v, self.slow = vocabulary, None
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens=SPECIAL)
        self.wide = re.compile(r"\s{%d}" % LONG_WORD)

    def ids(self, text: str) -> np.ndarray:
        if max(map(len, text.split()), default=0) < LONG_WORD and not self.wide.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        return np.concatenate([self._slow(part) for part in _cut(text)])

    def _slow(self, text: str) -> np.ndarray:
        if self.slow is None:
            import tokenizers
            self.slow = tokenizers.Tokenizer.from_str(self.v.json)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def _cut(text: str) -> list[str]:
    """Parts of about ``TEXT_BLOCK``, cut before a blank between two characters that
    are no white space: a word always starts there, so ids stay the same."""
    inside = re.compile(r"(?<=\S) (?=\S)")
    out, start = [], 0
    while (found := inside.search(text, start + TEXT_BLOCK)) is not None:
        out.append(text[start:found.start()])
        start = found.start()
    return [*out, text[start:]]


def cut_document(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, the remainder first."""
    first = length if length <= capacity else length % capacity or capacity
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def token_pieces(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY,
                 keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, unless told otherwise, ids."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or Vocabulary())
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if keep_ids else 5]

    def run(batches):
        tokenizer = Tokenizer(shared.value)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            owners, rows, ids, held = [], [], [], 0

            def passed_on():
                columns = list(zip(*rows))
                arrays = [doc_ids.take(pa.array(owners, pa.int64())), pa.array(columns[0], pa.int32()),
                          *[pa.array(c, pa.int64()) for c in columns[1:]]]
                if keep_ids:
                    arrays.append(pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids), pa.int32())))
                return pa.RecordBatch.from_arrays(arrays, names=names)

            for i in range(batch.num_rows):
                own = np.append(tokenizer.ids(texts[i].as_py() or ""), np.uint32(END)).astype("<u4")
                for k, (start, length) in enumerate(cut_document(len(own), capacity)):
                    part = own[start:start + length]
                    owners.append(i)
                    rows.append((k, start, length, zlib.crc32(part.tobytes())))
                    if keep_ids:
                        ids.append(part.astype(np.int32))
                held += len(own)
                if held >= HELD_TOKENS:
                    yield passed_on()
                    owners, rows, ids, held = [], [], [], 0
            if rows:
                yield passed_on()

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, schema)


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: tokens, and pieces of which no two fit together."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of places) by best fit, longest piece first."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0                                   # bit f: some bin has room for f tokens exactly
    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = lengths.tolist()
    for i in order:
        size = sizes[i]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[own].append(i)
        else:
            room, own = capacity, len(bins)
            bins.append([i])
        if room > size:
            by_room[room - size].append(own)
            rooms |= 1 << room - size
    return bins


class Underfull:
    """Underfull bins, for the search of exchanges.  Of a bin it knows the sets of
    none, one or two of its pieces: their tokens and their members (-1: nothing)."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], capacity: int):
        self.sizes, self.capacity, self.bins = lengths, capacity, bins
        self.fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
        self.sets = [self._sets(b) for b in bins]
        self._join()

    def _sets(self, pieces: list[int]) -> tuple[np.ndarray, np.ndarray]:
        own = np.array(sorted(pieces, key=lambda i: -self.sizes[i]), np.int64)
        size = self.sizes[own]
        a, b = np.triu_indices(min(len(own), PAIRED), 1)
        members = np.full((2, 1 + len(own) + len(a)), -1, np.int64)
        members[0, 1:] = np.concatenate((own, own[a]))
        members[1, 1 + len(own):] = own[b]
        return np.concatenate((np.zeros(1, np.int64), size, size[a] + size[b])), members

    def _join(self) -> None:
        """All bins' sets in one row of arrays."""
        counts = [len(tokens) for tokens, _ in self.sets]
        self.first = np.cumsum(counts) - counts
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self.tokens = np.concatenate([tokens for tokens, _ in self.sets])
        self.pair = np.concatenate([members[1] >= 0 for _, members in self.sets])

    def run_empty(self, giver: int) -> bool:
        """Shifts tokens from one bin to fuller ones; whether it becomes empty."""
        for _ in range(EXCHANGES):
            if not self.bins[giver] or not self._exchange(giver):
                break
        return not self.bins[giver]

    def _exchange(self, giver: int) -> bool:
        """Gives a set for the smaller set, of a bin as full or fuller, that leaves just
        room for it; of all such exchanges the one that shifts most tokens.  Two
        pieces are not exchanged for two.  False: there is none."""
        room = self.tokens + (self.capacity - self.fill)[self.owner]
        usable = (self.fill[self.owner] >= self.fill[giver]) & (self.owner != giver)
        tokens, members = self.sets[giver]
        best, found = 0, None
        for k in range(1, len(tokens)):
            given = int(tokens[k])
            fits = usable & (room >= given) & (self.tokens < given)
            if members[1, k] >= 0:
                fits &= ~self.pair
            at = int(np.where(fits, self.tokens, given).argmin())
            if fits[at] and given - self.tokens[at] > best:
                best, found = given - int(self.tokens[at]), (k, at)
        if found is None:
            return False
        k, at = found
        taker = int(self.owner[at])
        given = [x for x in members[:, k].tolist() if x >= 0]
        back = [x for x in self.sets[taker][1][:, at - self.first[taker]].tolist() if x >= 0]
        self.bins[giver] = [x for x in self.bins[giver] if x not in given] + back
        self.bins[taker] = [x for x in self.bins[taker] if x not in back] + given
        self.fill[giver] -= best
        self.fill[taker] += best
        for k in (giver, taker):
            self.sets[k] = self._sets(self.bins[k])
        self._join()
        return True


def pack_block(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of pieces (lists of places in ``lengths``)."""
    lengths = np.asarray(lengths, np.int64)
    bins = best_fit(lengths, capacity)
    least = least_bins(lengths, capacity)
    if len(bins) <= least:
        return bins
    fill = [int(lengths[b].sum()) for b in bins]
    full = [b for b, f in zip(bins, fill) if f == capacity]
    under = Underfull(lengths, [b for b, f in zip(bins, fill) if f < capacity], capacity)
    stuck = 0
    for giver in np.argsort(under.fill, kind="stable").tolist():
        if len(full) + sum(map(bool, under.bins)) <= least or stuck == STUCK:
            break
        stuck = 0 if under.run_empty(giver) else stuck + 1
    return full + [b for b in under.bins if b]


def _pack_group(rows: pd.DataFrame) -> pd.DataFrame:
    """Packs one block; ``open``: the bin is to be packed again."""
    rows = rows.sort_values("row", ignore_index=True)
    lengths, capacity = rows["length"].to_numpy(np.int64), int(rows["capacity"].iloc[0])
    bins = pack_block(lengths, capacity)
    fill = np.array([lengths[b].sum() for b in bins])
    number, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    again, left = np.zeros(len(rows), bool), len(rows) // CARRIED
    for k in np.argsort(fill, kind="stable").tolist():
        own = np.array(bins[k])
        number[own] = k
        offset[own] = np.cumsum(lengths[own]) - lengths[own]
        if fill[k] < capacity and len(own) <= left:
            again[own] = True
            left -= len(own)
        else:
            left = 0
    return pd.DataFrame({"row": rows["row"], "length": lengths, "block": rows["block"],
                         "bin": number, "offset": offset, "open": again})


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """row, sequence_id, offset of ``pieces`` (row: a different long each; length: 1 to
    ``capacity``).  ``pieces`` should be materialised: it is read more than once."""
    whole = pieces.where(F.col("length") == capacity).select(
        "row", (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = pieces.where(F.col("length") < capacity).select("row", F.col("length").cast("long").alias("length"))
    done, level = whole, 0
    while True:
        blocks = max(1, -(-left.count() // BLOCK_ROWS))
        dealt = left.withColumn("block", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(blocks))) \
            .withColumn("capacity", F.lit(capacity))
        packed = cut_lineage(dealt.groupBy("block").applyInPandas(
            _pack_group, "row long, length long, block long, bin long, offset long, open boolean"))
        closed = packed if blocks == 1 else packed.where("NOT open")
        done = done.unionByName(closed.select(
            "row", (F.lit(level << 54) + F.col("block") * (1 << 16) + F.col("bin")).alias("sequence_id"), "offset"))
        if blocks == 1:
            return done
        left, level = packed.where("open").select("row", "length"), level + 1


def pack_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY,
                   keep_ids: bool = True) -> DataFrame:
    """The pieces of ``token_pieces`` with their sequence_id and offset in it."""
    pieces = written(token_pieces(docs, vocabulary, capacity, keep_ids)
                     .withColumn("row", F.monotonically_increasing_id()))
    return pieces.join(pack(pieces.select("row", "length"), capacity), "row").drop("row")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence, from packed pieces that kept theirs."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts")["ids"]).alias("ids"))
