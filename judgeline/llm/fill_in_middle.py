"""Fill-in-middle transformation through an indexable skip list.

A text is a list of units: a word with the white space before it, or the white
space that ends the text.  The list has express lanes: a node of lane k+1 is a
node of lane k whose keyed hash says so (one in four), and every link carries its
width in units and its width in code points.  To find a cut, the search starts at
the head of the top lane, goes on while the units passed do not exceed the cut's
rank, and goes down a lane otherwise; on the lowest lane it stands at the rank
exactly, and the code points it has passed say where the text is cut.

The lanes of a block of documents lie one after the other in arrays, so that all
documents of the block take each step of the search together.  A block is closed
at ``BLOCK_BYTES`` of text; a longer text is a block by itself.

Where a document is cut, and which form it takes, depends on the seed and its
doc_id alone, so reruns agree and nothing is shuffled.

Defined cases: a null text counts as empty (n is 0, the form plain, the output
empty); a null doc_id is hashed as the word null; repeated rows are transformed
alike; an empty table gives an empty result.  Columns other than doc_id and text
are not read, whatever their names.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import ship

ship(__name__)

SEED = 42
FIM_PERCENT = 50          # documents that are transformed
SPM_PERCENT = 80          # of these, the ones whose suffix comes first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK_BYTES = 4_000_000   # text whose lists are held together
LANE_BITS = 2             # a node is on the next lane with a chance of 2**-LANE_BITS
_FAR = np.int64(2**62)    # units behind the end of a list

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _unit_widths(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of texts that lie one after the other in ``data`` (UTF-8, text i ends
    before ``ends[i]``): how many each text has, and each unit's code points."""
    n = len(data)
    last = np.zeros(n + 1, bool)            # the byte is the last one of its text
    last[ends - 1] = True                   # an empty first text marks the spare byte
    space = _SPACE[data]
    stop = np.empty(n, bool)                # the byte is the last one of its unit
    stop[:-1] = ~space[:-1] & space[1:]
    stop[-1:] = True
    stop |= last[:n]
    at = np.flatnonzero(stop)
    counts = np.diff(np.searchsorted(at, ends, "left"), prepend=0)
    points = np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int32), np.concatenate(([0], at[:-1] + 1))) \
        if n else np.zeros(0, np.int32)
    return counts, points.astype(np.int64)


class SkipList:
    """The lists of several documents: ``counts`` units each, ``points`` code
    points per unit."""

    def __init__(self, counts: np.ndarray, points: np.ndarray, seed: int = SEED):
        docs = np.arange(len(counts))
        # lowest lane: a head, one node behind each unit; a link leads to the next node
        size = counts + 1
        start = np.cumsum(size) - size
        units = np.ones(size.sum(), np.int64)
        width = np.zeros(size.sum(), np.int64)
        tail = start + counts
        inner = np.ones(size.sum(), bool)
        inner[tail] = False
        units[tail] = _FAR
        width[inner] = points
        rank = np.arange(size.sum()) - np.repeat(start, size)
        key = _mix(rank + np.repeat(docs, size) * 0x1000003 + seed)
        self.lanes = [(units, width, None, start)]      # units, code points, node below, heads
        while len(rank) > len(docs):
            up = (rank == 0) | ((key & np.uint64(2**LANE_BITS - 1)) == 0)
            at = np.flatnonzero(up)
            units, width, _, below = self.lanes[-1]
            owner_ends = np.append(below[1:], len(rank)) - 1
            open_units = units.copy()
            open_units[owner_ends] = 0                  # the last link of a list leads nowhere
            far = np.add.reduceat(open_units, at)
            wide = np.add.reduceat(width, at)
            heads = np.searchsorted(at, below)
            far[np.append(heads[1:], len(at)) - 1] = _FAR
            self.lanes.append((far, wide, at, heads))
            rank, key = rank[at], key[at] >> np.uint64(LANE_BITS)
        self.heads = self.lanes[-1][3]

    def code_points(self, ranks: np.ndarray) -> np.ndarray:
        """Code points of the first ``ranks[i]`` units of document i."""
        node, left = self.heads.copy(), ranks.astype(np.int64)
        passed = np.zeros(len(ranks), np.int64)
        for units, width, below, _ in reversed(self.lanes):
            going = np.flatnonzero(units[node] <= left)
            while len(going):
                own = node[going]
                left[going] -= units[own]
                passed[going] += width[own]
                node[going] = own + 1
                going = going[units[own + 1] <= left[going]]
            if below is not None:
                node = below[node]
        return passed


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads numbers over 64 bits."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draws(doc_ids: list, seed: int) -> np.ndarray:
    """Four numbers of 32 bits per document, from the SHA-256 of ``seed:doc_id``."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def _blocks(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Row ranges of up to ``BLOCK_BYTES``, or of one row."""
    out, first, held = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > BLOCK_BYTES:
            out.append((first, i))
            first, held = i, 0
        held += size
    return [*out, (first, len(sizes))] if len(sizes) else out


def _transform(doc_ids: list, texts: pa.Array, seed: int, fim: int, spm: int) -> list[list]:
    """n, form, prefix_chars, middle_chars and output of each text of a block."""
    own = [t or "" for t in texts.to_pylist()]
    raw = [t.encode() for t in own]
    data = np.frombuffer(b"".join(raw), np.uint8)
    counts, points = _unit_widths(data, np.cumsum([len(t) for t in raw], dtype=np.int64))
    h = _draws(doc_ids, seed)
    cuts = np.sort(h[:, :2] % (counts + 1)[:, None], axis=1)
    lists = SkipList(counts, points, seed)
    first, second = lists.code_points(cuts[:, 0]), lists.code_points(cuts[:, 1])
    rows = []
    for text, n, a, b, form_draw, order_draw in zip(
            own, counts.tolist(), first.tolist(), second.tolist(), h[:, 2].tolist(), h[:, 3].tolist()):
        if not text or form_draw % 100 >= fim or PREFIX in text or SUFFIX in text or MIDDLE in text:
            rows.append([n, "plain", None, None, text])
        elif order_draw % 100 < spm:
            rows.append([n, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"])
        else:
            rows.append([n, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"])
    return rows


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (units), form (plain, spm or psm), prefix_chars, middle_chars
    (code points; null if plain) and output (the text to train on)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            sizes = np.array([0 if x is None else x for x in batch.column("size").to_pylist()], np.int64)
            for a, b in _blocks(sizes):
                rows = _transform(ids[a:b].to_pylist(), texts[a:b], seed, fim_percent, spm_percent)
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids[a:b], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"),
                       F.octet_length(docs["text"]).alias("size"))
    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` of a ``form`` was made from.  A transformed text
    holds no mark of its own, so the first of each kind is the one put there."""
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(output, MIDDLE, 1)
        one = F.substring_index(head, second, 1)
        return (F.substr(one, F.lit(len(first) + 1)),
                F.substr(head, F.char_length(one) + F.lit(len(second) + 1)),
                F.substr(output, F.char_length(head) + F.lit(len(MIDDLE) + 1)))

    p, s, m = parts(PREFIX, SUFFIX)
    s2, p2, m2 = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with SHA-256 of the output and of the text
    rebuilt from it, in place of the output."""
    return transformed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
