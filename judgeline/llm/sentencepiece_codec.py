"""SentencePiece encoding with seeded merge-dropout, and decoding.

The vocabulary is that of a public merge-type SentencePiece model, read on the
driver from a path that is a parameter.  A text is cut where no piece can reach
across; in each part the agenda holds the adjacent pairs that form a piece, best
piece first, and a candidate merge taken from it is skipped when a keyed hash of
its place falls under the dropout rate.  The key is made of the seed, the doc_id
and the part's place in the text, so that reruns agree and every occurrence of a
word is drawn by itself.

How a part ends depends on the part and on which merges are skipped, so a task
remembers, for a part and the merges skipped so far, the merges that follow and
the ids they lead to.  Occurrences are drawn by whole arrays: the first merge that
an occurrence skips leads it to what is remembered for one more skipped merge,
until it skips none.  What is not known yet goes on from where that merge was taken,
together, a step merging every part's best candidate; long parts and those with unknown characters use a
heap.  Without dropout the result is the model's own.

Decoding puts the pieces' bytes one after the other and drops the leading blank
that encoding added; characters without a piece, and the blank mark itself, are
spelled in byte pieces, so every text comes back as it was.

Defined cases: a null text has null ids and decodes to null; an empty text has no
ids; repeated rows are encoded alike; an empty table gives an empty result.
Columns other than doc_id and text are not read, whatever their names.
"""
from __future__ import annotations

import re
import zlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from judgeline.llm.common import hash_key, ship

ship(__name__)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 7
REMEMBERED = 200_000      # segmentations that a task remembers
SHORT = 24                # characters of a part that is merged with others
ROWS = 8_192              # parts merged together, a step at a time
TOGETHER = 300_000        # characters of texts encoded together
PARTS = 60_000            # parts of these texts that are drawn together
MARK = "▁"                # stands for a blank in pieces
NONE = np.int32(2**31 - 1)
_PLACE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9))


class Vocabulary:
    """Pieces of a model: ids by piece, bytes by id, and the merges' order."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.vocab_size())
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        # best score first; equal scores stand by id
        ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
        self.rank = {model.id_to_piece(i): r for r, i in enumerate(ranked)}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b""] * model.vocab_size()
        for piece, i in self.ids.items():
            self.bytes[i] = piece.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        self.longest = max(map(len, self.ids))
        pairs = [(self.ids[p[:k]], self.ids[p[k:]], r, self.ids[p]) for p, r in self.rank.items()
                 for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        self.pairs = np.array(pairs, np.int32).reshape(-1, 4)   # left, right, rank, merged
        inner = {c for piece in self.ids if len(piece) > 1 for c in piece}
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("the model has pieces that reach across blanks")
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in inner)
        self.part = f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (f"|[{alone}]" if alone else "")


class _Pairs:
    """Hash table of the pairs that form a piece, looked up by whole arrays."""

    def __init__(self, pairs: np.ndarray, bits: int = 20):
        while len(pairs) * 4 > 1 << bits:
            bits += 1
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.table = np.full((1 << bits, 2), -1, np.int64)     # pair, then rank and merged piece
        key = self._keys(pairs[:, 0], pairs[:, 1])
        value = self._keys(pairs[:, 2], pairs[:, 3])
        slot, left = self._slots(key), np.arange(len(pairs))
        while len(left):            # linear probing, all entries a step at a time
            free = self.table[slot[left], 0] < 0
            self.table[slot[left[free]], 0] = key[left[free]]
            placed = self.table[slot[left], 0] == key[left]
            own = left[placed]
            self.table[slot[own], 1] = value[own]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & self.mask

    @staticmethod
    def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.int64) << 32) | b.astype(np.int64)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no piece) and merged piece of each pair."""
        key = self._keys(a, b)
        slot = self._slots(key)
        found = self.table[slot]
        value = np.where(found[:, 0] == key, found[:, 1], np.int64(NONE) << 32)
        left = np.flatnonzero((found[:, 0] != key) & (found[:, 0] >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            found = self.table[slot[left]]
            hit = found[:, 0] == key[left]
            value[left[hit]] = found[hit, 1]
            left = left[~hit & (found[:, 0] >= 0)]
        return (value >> 32).astype(np.int32), value.astype(np.int32)


class _Rows:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.all, self.size = np.zeros(1024, kind), 0

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at):
        return self.all[at]

    def add(self, values) -> None:
        size = self.size + len(values)
        if size > len(self.all):
            self.all = np.concatenate((self.all[:self.size], np.zeros(2 * size - self.size, self.all.dtype)))
        self.all[self.size:size] = values
        self.size = size


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which row each place belongs to, and the places of all rows: first, first + 1 and so on."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) + (first - np.cumsum(count) + count)[row]


class Encoder:
    """Encodes and decodes texts with one vocabulary, seed and dropout rate."""

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        self.v, self.seed = vocabulary, seed
        self.limit = int(dropout * 2**32)
        self.parts = re.compile(vocabulary.part).findall
        self.pairs = _Pairs(vocabulary.pairs)
        self.char = np.zeros(0x110000, np.int32)      # id of a character; 0: unknown
        for piece, i in vocabulary.ids.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        self._forget()

    def _forget(self) -> None:
        """Nothing remembered but the blank mark's own bytes, as node 0."""
        self.roots: dict[str | None, int] = {}      # node of a part of which no merge is skipped
        self.text: list[str] = []                   # parts by number; their characters' ids
        self.symbols, self.symbol_first, self.symbol_count = _Rows(np.int32), _Rows(np.int64), _Rows(np.int64)
        # of each node: its part, the node above, the code of the merge that is skipped
        # there (start << 32, and stop; -1: none), how many merges of the node above come
        # before it, how many merges come before it in all, and how many are skipped
        self.part, self.above, self.code = _Rows(np.int32), _Rows(np.int32), _Rows(np.int64)
        self.kept, self.done, self.depth = _Rows(np.int32), _Rows(np.int32), _Rows(np.int32)
        self.first, self.count = _Rows(np.int64), _Rows(np.int32)      # merges that follow
        self.id_first, self.id_count = _Rows(np.int64), _Rows(np.int32)
        self.merges = _Rows(np.int64)               # codes of merges; where their right side starts; merged pieces
        self.middle, self.piece = _Rows(np.int32), _Rows(np.int32)
        self.child = _Rows(np.int32)                # node when that merge is skipped; 0: not known yet
        self.ids = _Rows(np.int32)
        self.roots[None] = 0
        self._add_parts([""])
        nodes = self._add_nodes(*np.zeros((2, 1), np.int64), np.full(1, -1), *np.zeros((3, 1), np.int64))
        ids = np.array([self.v.byte[b] for b in MARK.encode()], np.int32)
        self._store(nodes, ids, np.array([len(ids)]), *np.zeros((3, 0), np.int64), np.zeros(1, np.int64))

    def _add_parts(self, parts: list[str]) -> None:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.symbol_first.add(len(self.symbols) + np.cumsum(sizes) - sizes)
        self.symbol_count.add(sizes)
        self.symbols.add(self.char[chars])
        self.text += parts

    def _add_nodes(self, part, above, code, kept, done, depth) -> np.ndarray:
        nodes = np.arange(len(self.part), len(self.part) + len(part))
        none = np.zeros(len(part), np.int64)
        for rows, values in ((self.part, part), (self.above, above), (self.code, code), (self.kept, kept),
                             (self.done, done), (self.depth, depth), (self.first, none), (self.count, none),
                             (self.id_first, none), (self.id_count, none)):
            rows.add(values)
        return nodes

    def _store(self, nodes, ids, id_counts, codes, middle, piece, counts) -> None:
        """Ids of nodes and the merges that follow, one node after the other."""
        for rows, start, count, sizes in ((self.ids, self.id_first, self.id_count, id_counts),
                                          (self.merges, self.first, self.count, counts)):
            start.all[nodes] = len(rows) + np.cumsum(sizes) - sizes
            count.all[nodes] = sizes
        for rows, values in ((self.ids, ids), (self.merges, codes), (self.middle, middle), (self.piece, piece),
                             (self.child, np.zeros(len(codes), np.int32))):
            rows.add(values)

    def _skips(self, key: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Whether occurrences with these keys skip these merges."""
        start, stop = (code >> 32).astype(np.uint64), (code & 0xFFFFFFFF).astype(np.uint64)
        h = key ^ (start * _PLACE[0] + stop * _PLACE[1])
        h = (h ^ (h >> np.uint64(31))) * _PLACE[2]
        return (h >> np.uint64(32)) < np.uint64(self.limit)

    def _keys(self, keys: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Keys of occurrences: of seed, document and place in the text."""
        h = keys.astype(np.uint64) + np.uint64((self.seed + 1) * int(_PLACE[1]) % 2**64)
        for more in (place.astype(np.uint64) * _PLACE[0], np.uint64(0)):
            h = h + more
            h = (h ^ (h >> np.uint64(30))) * _PLACE[2]
            h = (h ^ (h >> np.uint64(27))) * _PLACE[1]
            h = h ^ (h >> np.uint64(31))
        return h

    def _ranked(self, a, b, start, stop, skipped) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of candidates; those that are skipped have none."""
        rank, merged = self.pairs.find(a, b)
        if skipped.shape[1]:
            code = (start.astype(np.int64) << 32) + stop
            rank[(skipped == code[:, None]).any(axis=1)] = NONE
        return rank, merged

    def _segment(self, nodes: np.ndarray) -> None:
        """Ids and merges of new nodes."""
        part = self.part[nodes]
        sizes = self.symbol_count[part]
        row, at = _spread(self.symbol_first[part], sizes)
        odd = (np.bincount(row, self.symbols[at] == 0, len(nodes)) > 0) | (sizes > SHORT)
        least = 0
        for most in (8, 12, 16, SHORT):
            own = nodes[~odd & (sizes > least) & (sizes <= most)]
            least = most
            for k in range(0, len(own), ROWS):
                self._store(own[k:k + ROWS], *self._lockstep(own[k:k + ROWS]))
        for k in nodes[odd].tolist():
            skipped, above = [], k
            for _ in range(self.depth[k]):
                skipped.append(int(self.code[above]))
                above = self.above[above]
            ids, path = self._merged((self.text[self.part[k]], *skipped))
            path = np.array(path[self.done[k]:], np.int64)
            unused = np.zeros(len(path), np.int32)
            self._store(np.array([k]), ids, np.array([len(ids)]), path, unused, unused, np.array([len(path)]))

    def _lockstep(self, nodes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids and merges of nodes of SHORT characters at most: all agendas a step at a
        time, from where the node above was when it took the merge that is skipped."""
        part, count = self.part[nodes], len(nodes)
        sizes = self.symbol_count[part]
        width = int(sizes.max()) + 1
        symbols = np.full(count * width, -1, np.int32)  # by place of their first character; -1: none starts there
        row, at = _spread(self.symbol_first[part], sizes)
        symbols[row * width + at - self.symbol_first[part][row]] = self.symbols[at]
        skipped = np.full((count, int(self.depth[nodes].max())), -1, np.int64)
        levels, own = [], nodes
        for k in range(skipped.shape[1]):
            skipped[:, k] = self.code[own]
            levels.append((self.above[own], self.kept[own]))
            own = self.above[own]
        for above, kept in reversed(levels):            # merges of the nodes above, the first one's first
            row, at = _spread(self.first[above], kept)
            symbols[row * width + (self.merges[at] >> 32)] = self.piece[at]
            symbols[row * width + self.middle[at]] = -1
        here = np.flatnonzero(symbols >= 0)
        row = here // width
        place = here - row * width
        last = np.append(row[1:] != row[:-1], True)
        after = np.append(place[1:], 0)
        after[last] = sizes[row[last]]
        end = np.zeros(count * width, np.int64)         # of the symbol that starts here
        before = np.zeros(count * width, np.int64)      # start of the symbol before
        end[here] = after
        before[row * width + after] = place
        rank = np.full((count, width), NONE, np.int32)  # of the pair that starts here
        merged = np.zeros(count * width, np.int32)
        k = np.flatnonzero(~last)
        left, right = here[k], here[k + 1]
        rank.ravel()[left], merged[left] = self._ranked(symbols[left], symbols[right], place[k], end[right], skipped[row[k]])
        codes = np.zeros((count, width), np.int64)
        middles, pieces = np.zeros((2, count, width), np.int32)
        taken, live, step = np.zeros(count, np.int64), np.arange(count), 0
        while True:
            at = rank.argmin(axis=1)
            go = np.flatnonzero(rank[np.arange(len(live)), at] != NONE)
            if not len(go):
                break
            at = at[go]
            if len(go) * 5 < len(live) * 4:
                live, rank, skipped, go = live[go], rank[go], skipped[go], np.arange(len(go))
            rows = live[go]
            base = rows * width
            left = base + at
            middle = end[left]
            right = base + middle
            stop = end[right]
            codes[rows, step], middles[rows, step], pieces[rows, step] = (at << 32) + stop, middle, merged[left]
            step += 1
            taken[rows] = step
            symbols[left] = merged[left]
            symbols[right] = -1
            end[left] = stop
            before[base + stop] = at
            rank[go, middle] = rank[go, at] = NONE
            some = np.flatnonzero(stop < sizes[rows])               # the pair with the symbol after
            near, far = left[some], (base + stop)[some]
            rank[go[some], at[some]], merged[near] = self._ranked(
                symbols[near], symbols[far], at[some], end[far], skipped[go[some]])
            some = np.flatnonzero(at > 0)                           # and with the one before
            near = left[some]
            start = before[near]
            far = base[some] + start
            rank[go[some], start], merged[far] = self._ranked(
                symbols[far], symbols[near], start, stop[some], skipped[go[some]])
        found, path = symbols >= 0, np.arange(width) < taken[:, None]
        return (symbols[found], found.reshape(count, width).sum(axis=1),
                codes[path], middles[path], pieces[path], taken)

    def _merged(self, node: tuple) -> tuple[tuple[int, ...], list[int]]:
        """Ids and merges of one part, by a heap."""
        w, skipped, path = node[0], set(node[1:]), []
        v, n = self.v, len(w)
        rank, longest = v.rank, v.longest
        end, before = list(range(1, n + 1)), list(range(-1, n))
        agenda = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(w[i:i + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, i, stop = heappop(agenda)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue            # one of its sides has changed
            if (i << 32) + stop in skipped:
                continue
            path.append((i << 32) + stop)
            end[i], end[middle] = stop, 0
            before[stop] = i
            if stop < n and (far := end[stop]) - i <= longest and (r := rank.get(w[i:far])) is not None:
                heappush(agenda, (r, i, far))
            if i and stop - (left := before[i]) <= longest and (r := rank.get(w[left:stop])) is not None:
                heappush(agenda, (r, left, stop))
        out, i = [], 0
        while i < n:
            piece = v.ids.get(w[i:end[i]])
            if piece is None:
                out.extend(v.byte[b] for b in w[i:end[i]].encode())
            else:
                out.append(piece)
            i = end[i]
        return tuple(out), path

    def encode(self, texts: list[str | None], keys=0) -> list[list[int] | None]:
        """Ids of each text; ``keys``: a number of each document, or one of all."""
        return [None if x is None else x.tolist() for x in self.arrays(texts, keys)]

    def arrays(self, texts: list[str | None], keys=0) -> list[np.ndarray | None]:
        """Ids of each text as an array (int32).  Some texts are taken together, by ``TOGETHER``."""
        keys = np.broadcast_to(np.asarray(keys, np.int64), len(texts))
        out, start, size = [], 0, 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= TOGETHER:
                out += self._encode_some(texts[start:i + 1], keys[start:i + 1])
                start, size = i + 1, 0
        return out + self._encode_some(texts[start:], keys[start:])

    def _encode_some(self, texts: list[str | None], keys: np.ndarray) -> list[np.ndarray | None]:
        every: list[str | None] = []        # parts of all texts; None: a blank mark in the text itself
        ends = []
        for text in texts:
            for k, x in enumerate(text.split(MARK) if text else []):
                if k:
                    every.append(None)
                every += self.parts((x if k else " " + x).replace(" ", MARK))
            ends.append(len(every))
        sizes = np.diff([0, *ends])
        place = _spread(np.zeros(len(sizes), np.int64), sizes)[1]
        drawn = self._keys(np.repeat(keys, sizes), place) if self.limit else None
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for at in range(0, len(every), PARTS):      # a draw does not depend on what is drawn with it
            found, number = self._encode_parts(every[at:at + PARTS], None if drawn is None else drawn[at:at + PARTS])
            ids.append(found)
            counts.append(number)
        ids = np.concatenate(ids)
        stops = np.cumsum(np.concatenate(counts))[[0, *ends]].tolist()
        return [None if text is None else ids[a:b] for text, a, b in zip(texts, stops, stops[1:])]

    def _encode_parts(self, every: list[str | None], drawn: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts one after the other, and how many each has.  What is remembered
        is forgotten when it is too much, also inside a text."""
        if len(self.part) > REMEMBERED:
            self._forget()
        new = [p for p in dict.fromkeys(every) if p not in self.roots]
        if new:
            number, none = len(self.text) + np.arange(len(new)), np.zeros(len(new), np.int64)
            self._add_parts(new)
            # a node of its own stands above a root
            nodes = self._add_nodes(number, len(self.part) + np.arange(len(new)), none - 1, none, none, none)
            self.roots.update(zip(new, nodes.tolist()))
            self._segment(nodes)
        node = np.fromiter(map(self.roots.__getitem__, every), np.int64, len(every))
        if drawn is not None:
            self._draw(node, drawn)
        counts = self.id_count[node]
        return self.ids[_spread(self.id_first[node], counts)[1]], counts

    def _draw(self, node: np.ndarray, keys: np.ndarray) -> None:
        """Moves occurrences on, in place, until they skip no more merges."""
        going = np.arange(len(node))
        while len(going):
            own = node[going]
            row, at = _spread(self.first[own], self.count[own])
            hit = np.flatnonzero(self._skips(keys[going][row], self.merges[at]))
            row, at = row[hit], at[hit]
            lead = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
            row, at = row[lead], at[lead]           # the first merge that each one skips
            going = going[row]
            fresh = np.flatnonzero(self.child[at] == 0)
            open_, which = np.unique(at[fresh], return_index=True)
            if len(open_):
                above = node[going[fresh[which]]]
                kept = open_ - self.first[above]
                nodes = self._add_nodes(self.part[above], above, self.merges[open_], kept,
                                        self.done[above] + kept, self.depth[above] + 1)
                self.child.all[open_] = nodes
                self._segment(nodes)
            node[going] = self.child[at]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.v.bytes.__getitem__, ids)).decode()[1:]


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"),
                       hash_key(docs["doc_id"], "dropout").alias("key"))


def _slices(batches, column: str = "text"):
    """The batches in slices of about ``TOGETHER`` bytes of a column, so that a task
    holds the ids of a slice as Python numbers, not of a whole batch."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // TOGETHER
        starts = np.flatnonzero(np.diff(group, prepend=-1)).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(a, b - a)


def _encoded(batch: pa.RecordBatch, encoder: Encoder):
    """Texts and ids of a batch."""
    texts = batch.column("text").to_pylist()
    return texts, encoder.arrays(texts, batch.column("key").to_numpy())


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, dropout: float = DROPOUT,
           seed: int = SEED) -> DataFrame:
    """doc_id and ids (array<int>; null for a null text)."""
    v = vocabulary or Vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = Encoder(v, dropout, seed)
        for batch in _slices(batches):
            _, ids = _encoded(batch, encoder)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _rows(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """doc_id and text of rows with doc_id and ids."""
    v = vocabulary or Vocabulary()
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = Encoder(v)
        for batch in batches:
            texts = [None if ids is None else encoder.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select(encoded["doc_id"].alias("doc_id"), encoded["ids"].alias("ids")).mapInArrow(
        run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: Vocabulary | None = None, dropout: float = DROPOUT,
               seed: int = SEED) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of the ids as little-endian 32-bit numbers) and
    lossless (whether decoding gives the text again); null for a null text."""
    v = vocabulary or Vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = Encoder(v, dropout, seed)
        for batch in _slices(batches):
            texts, ids = _encoded(batch, encoder)
            sums = [None if x is None else zlib.crc32(x.astype("<i4").tobytes()) for x in ids]
            same = [None if x is None else encoder.decode(x.tolist()) == t for x, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([None if x is None else len(x) for x in ids], pa.int64()),
                 pa.array(sums, pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "n_ids", "ids_crc32", "lossless"])

    return _rows(docs).mapInArrow(run, f"doc_id {kind}, n_ids long, ids_crc32 long, lossless boolean")
