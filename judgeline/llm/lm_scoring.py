"""Language-model scores by logistic context mixing.

A text is coded byte by byte, a byte bit by bit, most significant first, and one
end symbol closes it.  For each bit several predictors look up how often it was 0
or 1 after the last 0, 1, 2 or 3 bytes (hashed contexts) and the bits of the byte
so far.  Their log odds are mixed with weights that a gate picks by the
evidence the two longest contexts have and the bit's place, and the mix is
refined by an adaptive table over the last byte and the mixed odds.  The sum of
the bits' costs is the text's log probability; bits per byte follow from it.

One pass over all training texts counts their byte groups; the counts over all
tasks make the context tables.  Weights and the adaptive table are then learned
from all groups, each as often as it occurs and predicted by the tables without
that one occurrence (leave one out).  Tasks add up errors and curvature, and the
weights are moved by the sums of all tasks (Newton steps, ``ROUNDS`` times), so
that what is learned does not depend on how the texts are dealt to tasks.

The base score is a word model with counts of all training words.  Words that
make up a millionth of all words or more are at most a million; they are
broadcast after a measurement.  Other words have no hot key and are joined.

Defined cases: a null text counts as empty and costs its end symbol; rows that
repeat both doc_id and text each have their own result row; a null doc_id is
hashed as empty; without training text every bit costs one bit; an empty table
gives an empty result.  Columns other than doc_id and text are not read.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import WORD, broadcast_if_small, crc_mod, lower_ascii, ship, written

ship(__name__)

FOLDS, HELD_OUT = 7, 2
END = 0xFF                        # no byte of UTF-8; also stands before a text
ORDERS = 4                        # contexts of 0 to 3 bytes
SLOT_BITS = (8, 16, 20, 22)       # of each order's table
BATCH = 1 << 20                   # bytes counted or scored together
ROUNDS = 6                        # Newton steps of the weights
PRIOR = 0.4                       # count added to either bit
FREQUENT = 1e-6                   # share of all words from which a word is broadcast
_START = np.concatenate(([0], np.cumsum([1 << b for b in SLOT_BITS])))
_INPUTS, _GATES, _STEPS, _EDGE = ORDERS + 1, 16 * 8, 33, 8.0
_FIRST_WEIGHT, _RIDGE, _APM_PRIOR = 0.3, 20.0, 8.0
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 14                       # bits of a slot's place inside a chunk of the tables


def groups(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte groups (uint32: three bytes of context, then the byte coded) of
    all texts, one after the other, and where each text starts."""
    coded = [(t or "").encode("utf-8", "surrogatepass") + b"\xff" for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(c) for c in coded])[:-1])).astype(np.int64)
    own = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint32)
    found = own.copy()
    for back in (1, 2, 3):
        before = np.full(len(own), END, np.uint32)
        before[back:] = own[:-back]
        for k in range(back):               # nothing of the text before reaches into a text
            at = starts + k
            before[at[at < len(own)]] = END
        found |= before << np.uint32(8 * back)
    return found, starts


class _Bits:
    """The eight coded bits of groups: arrays of (groups x 8)."""

    def __init__(self, found: np.ndarray):
        place = np.arange(8, dtype=np.uint32)
        byte = (found & np.uint32(255))[:, None]
        self.bit = ((byte >> (7 - place)) & 1).astype(bool)
        node = (np.uint32(1) << place) | (byte >> (8 - place))
        self.last = ((found >> np.uint32(8)) & np.uint32(255)).astype(np.int64)[:, None]
        self.slots = []
        for order, bits in enumerate(SLOT_BITS):
            context = (found >> np.uint32(8)) & np.uint32((1 << 8 * order) - 1)
            key = (context.astype(np.uint64)[:, None] << np.uint64(8)) | node
            if 8 * (order + 1) > bits:
                key = (key * _MULTIPLIER) >> np.uint64(64 - bits)
            self.slots.append(key.astype(np.int64) + _START[order])
        self.place = place.astype(np.int64)


def _level(evidence: np.ndarray) -> np.ndarray:
    """How much a context has seen, in four steps."""
    return (evidence >= 1).astype(np.int64) + (evidence >= 4) + (evidence >= 32)


class Mixer:
    """Gated weights and the adaptive table."""

    def __init__(self, weights: np.ndarray, apm: np.ndarray):
        self.weights, self.apm = weights, apm       # (gates, inputs); (256, steps, 2) counts of 0 and 1

    @staticmethod
    def first() -> Mixer:
        weights = np.full((_GATES, _INPUTS), _FIRST_WEIGHT)
        weights[:, -1] = 0.0
        centre = 1 / (1 + np.exp(-np.linspace(-_EDGE, _EDGE, _STEPS)))
        return Mixer(weights, np.tile(_APM_PRIOR * np.stack((1 - centre, centre), 1), (256, 1, 1)))

    def predict(self, bits: _Bits, odds: list[np.ndarray], gate: np.ndarray):
        """Probability that a bit is 1: mixed alone, and refined; and the places
        (low step, share of the next) in the adaptive table."""
        dot = self.weights[gate, _INPUTS - 1] * 0.5
        for i, x in enumerate(odds):
            dot += self.weights[gate, i] * x
        dot = np.clip(dot, -_EDGE, _EDGE)
        mixed = 1 / (1 + np.exp(-dot))
        at = (dot + _EDGE) * ((_STEPS - 1) / (2 * _EDGE))
        low = np.minimum(at.astype(np.int64), _STEPS - 2)
        share = at - low
        seen = self.apm[..., 1] / self.apm.sum(-1)
        refined = seen[bits.last, low] * (1 - share) + seen[bits.last, low + 1] * share
        return mixed, (mixed + refined) / 2, low, share


def _counted(found: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Counts of 0 and 1 by slot."""
    counts = np.zeros((2, _START[-1]), np.float32)
    for at in range(0, len(found), 1 << 16):
        bits, n = _Bits(found[at:at + (1 << 16)]), times[at:at + (1 << 16), None].astype(np.float32)
        for slots in bits.slots:
            for value in (0, 1):
                own = bits.bit == bool(value)
                np.add.at(counts[value], slots[own], np.broadcast_to(n, own.shape)[own])
    return counts


class Corrections:
    """Sums, over groups, from which weights are moved and the adaptive table is
    made.  ``counts`` are those of all training texts."""

    def __init__(self, counts: np.ndarray, mixer: Mixer):
        self.counts, self.mixer = counts, mixer
        self.push = np.zeros((_GATES, _INPUTS))
        self.curve = np.zeros((_GATES, _INPUTS, _INPUTS))
        self.apm = np.zeros((256, _STEPS, 2))

    def add(self, found: np.ndarray, times: np.ndarray) -> None:
        for at in range(0, len(found), 1 << 15):
            self._add(found[at:at + (1 << 15)], times[at:at + (1 << 15)])

    def _add(self, found: np.ndarray, times: np.ndarray) -> None:
        bits = _Bits(found)
        odds, evidence = [], []
        for slots in bits.slots:            # without the occurrence that is predicted
            zero = np.maximum(self.counts[0][slots] - ~bits.bit, 0)
            one = np.maximum(self.counts[1][slots] - bits.bit, 0)
            odds.append(np.log((one + PRIOR) / (zero + PRIOR)))
            evidence.append(zero + one)
        gate = (_level(evidence[3]) * 4 + _level(evidence[2])) * 8 + bits.place
        mixed, _, low, share = self.mixer.predict(bits, odds, gate)
        weight = np.broadcast_to(times[:, None].astype(float), gate.shape)
        miss, slope = weight * (bits.bit - mixed), weight * np.maximum(mixed * (1 - mixed), 1e-4)
        inputs, flat = [*odds, np.full(gate.shape, 0.5)], gate.ravel()
        self.push += np.stack([np.bincount(flat, (miss * x).ravel(), _GATES) for x in inputs], 1)
        for i in range(_INPUTS):
            for j in range(i + 1):
                own = np.bincount(flat, (slope * inputs[i] * inputs[j]).ravel(), _GATES)
                self.curve[:, i, j] += own
                if i != j:
                    self.curve[:, j, i] += own
        for shift, part in ((0, 1 - share), (1, share)):
            where = (bits.last * _STEPS + low + shift) * 2 + bits.bit
            self.apm += np.bincount(where.ravel(), (weight * part).ravel(), 256 * _STEPS * 2).reshape(256, _STEPS, 2)

    def sums(self) -> np.ndarray:
        """All as one array that sums over tasks."""
        moved = np.einsum("gij,gj->gi", self.curve, self.mixer.weights) + self.push
        return np.concatenate((self.curve.ravel(), moved.ravel(), self.apm.ravel()))


class Learner:
    """The groups of some texts, and what they alone teach."""

    def __init__(self):
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []

    def learn(self, texts: list[str | None]) -> None:
        self.seen.append(np.unique(groups(texts)[0], return_counts=True))
        if len(self.seen) > 16:
            self._merge()

    def _merge(self) -> None:
        if not self.seen:
            return
        found, where = np.unique(np.concatenate([f for f, _ in self.seen]), return_inverse=True)
        times = np.bincount(where, np.concatenate([t for _, t in self.seen]), len(found)).astype(np.int64)
        self.seen = [(found, times)]

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Groups and how often each occurs."""
        self._merge()
        return self.seen[0] if self.seen else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    @property
    def counts(self) -> np.ndarray:
        return _counted(*self.groups())

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Groups, their counts, and the sums of the last Newton step."""
        found, times = self.groups()
        counts = self.counts

        def sums_of(mixer: Mixer) -> np.ndarray:
            own = Corrections(counts, mixer)
            own.add(found, times)
            return own.sums()

        return found, times, _stepped(sums_of)


def _stepped(sums_of) -> np.ndarray:
    """The sums of the last Newton step; ``sums_of`` gives those of a mixer."""
    sums = sums_of(Mixer.first())
    for _ in range(ROUNDS - 1):
        sums = sums_of(Mixer(_joined(sums).weights, Mixer.first().apm))
    return sums


def _joined(sums: np.ndarray) -> Mixer:
    """The mixer that all tasks' sums make."""
    first = Mixer.first()
    a, b = _GATES * _INPUTS * _INPUTS, _GATES * _INPUTS
    ridge = _RIDGE * np.eye(_INPUTS)
    curve = sums[:a].reshape(_GATES, _INPUTS, _INPUTS) + ridge
    moved = sums[a:a + b].reshape(_GATES, _INPUTS) + first.weights @ ridge
    return Mixer(np.linalg.solve(curve, moved[..., None])[..., 0], first.apm + sums[a + b:].reshape(256, _STEPS, 2))


class Model:
    """Frozen tables: log odds (eighths to the sixteenth) and evidence by slot."""

    def __init__(self, odds: np.ndarray, level: np.ndarray, mixer: Mixer):
        self.odds, self.level, self.mixer = odds, level, mixer

    def cost(self, found: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each group costs."""
        out = np.zeros(len(found))
        for at in range(0, len(found), 1 << 15):
            bits = _Bits(found[at:at + (1 << 15)])
            odds = [self.odds[s] / np.float32(15.0) for s in bits.slots]
            gate = (self.level[bits.slots[3]].astype(np.int64) * 4 + self.level[bits.slots[2]]) * 8 + bits.place
            p = np.clip(self.mixer.predict(bits, odds, gate)[1], 1e-6, 1 - 1e-6)
            out[at:at + (1 << 15)] = -np.log2(np.where(bits.bit, p, 1 - p)).sum(1)
        return out


class Scorer:
    """Total bits of texts; remembers the cost of groups it has met."""

    def __init__(self, model: Model, bits: int = 21):
        self.model, self.shift = model, np.uint32(32 - bits)
        self.key, self.filled = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, bool)
        self.value = np.zeros(1 << bits)

    def total(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits and bytes (with the end symbol) of each text."""
        found, starts = groups(texts)
        slot = (found * np.uint32(2654435761)) >> self.shift
        cost = self.value[slot]
        new = np.flatnonzero((self.key[slot] != found) | ~self.filled[slot])
        if len(new):
            fresh, where = np.unique(found[new], return_inverse=True)
            own = self.model.cost(fresh)
            cost[new] = own[where]
            at = (fresh * np.uint32(2654435761)) >> self.shift
            self.key[at], self.filled[at] = fresh, True
            self.value[at] = own
            # several fresh groups may share a slot: the key tells whose value stands there
            self.value[at[self.key[at] == fresh]] = own[self.key[at] == fresh]
        return np.add.reduceat(cost, starts), np.diff(np.concatenate((starts, [len(found)])))


def _some(batch: pa.RecordBatch, size: int = BATCH):
    """Slices of a batch with about so many characters."""
    texts, at, total = batch.column("text").to_pylist(), 0, 0
    for i, t in enumerate(texts):
        total += len(t or "") + 1
        if total >= size or i == len(texts) - 1:
            yield at, texts[at:i + 1]
            at, total = i + 1, 0


def learn(texts: DataFrame) -> Model:
    """The model of all texts (column text)."""
    def run(batches):
        learner = Learner()
        for batch in batches:
            for _, some in _some(batch):
                learner.learn(some)
        found, times = learner.groups()
        for at in range(0, len(found), 100_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[at:at + 100_000].astype(np.int64)), pa.array(times[at:at + 100_000])], names=["key", "value"])

    parts = texts.select("text").mapInArrow(run, "key long, value long")
    gathered = written(parts.groupBy("key").agg(F.sum("value").alias("value")))

    def counted(batches):
        for batch in batches:
            found, times = batch.column("key").to_numpy().astype(np.uint32), batch.column("value").to_numpy()
            for at in range(0, len(found), 1 << 14):
                bits = _Bits(found[at:at + (1 << 14)])
                slot = np.concatenate([s.ravel() for s in bits.slots])
                one = np.tile(bits.bit.ravel(), ORDERS)
                n = np.tile(np.repeat(times[at:at + (1 << 14)], 8), ORDERS)
                own, where = np.unique(slot, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(np.bincount(where, n * ~one, len(own))), pa.array(np.bincount(where, n * one, len(own)))],
                    names=["slot", "zero", "one"])

    # groups with one context come together, so that its slots are summed before they are sent
    grams = gathered.repartition(F.shiftright("key", 16)).sortWithinPartitions("key")
    slots = grams.mapInArrow(counted, "slot long, zero double, one double") \
        .groupBy("slot").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    packed = slots.select(F.shiftright("slot", _CHUNK).alias("chunk"), F.struct(
        (F.col("slot") % (1 << _CHUNK)).cast("int").alias("at"), "zero", "one").alias("s"))

    def pack(batches):
        for batch in batches:
            for chunk, own in zip(batch.column("chunk").to_pylist(), batch.column("all")):
                own = own.values
                dense = np.zeros((2, 1 << _CHUNK), np.float32)
                at = own.field("at").to_numpy()
                dense[0, at], dense[1, at] = own.field("zero").to_numpy(), own.field("one").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([dense.tobytes()], pa.binary())],
                                                 names=["chunk", "dense"])

    chunks = packed.groupBy("chunk").agg(F.collect_list("s").alias("all")).mapInArrow(pack, "chunk long, dense binary")
    # eight bytes for each slot: the tables' sizes bound what comes to the driver
    counts = np.zeros((2, ((int(_START[-1]) >> _CHUNK) + 1) << _CHUNK), np.float32)
    for r in chunks.toLocalIterator():
        counts[:, r["chunk"] << _CHUNK:(r["chunk"] + 1) << _CHUNK] = np.frombuffer(r["dense"], np.float32).reshape(2, -1)
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def sums_of(mixer: Mixer) -> np.ndarray:
        def correct(batches):
            own = Corrections(shared.value, mixer)
            for batch in batches:
                own.add(batch.column("key").to_numpy().astype(np.uint32), batch.column("value").to_numpy())
            sums = own.sums()
            where = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(sums[where])], names=["key", "value"])

        # the number of sums is fixed by the gates, inputs and steps
        out = np.zeros(_GATES * _INPUTS * (_INPUTS + 1) + 256 * _STEPS * 2)
        for r in gathered.mapInArrow(correct, "key long, value double").groupBy("key").agg(F.sum("value").alias("value")).collect():
            out[r["key"]] = r["value"]
        return out

    mixer = _joined(_stepped(sums_of))
    shared.destroy()
    odds = np.clip(np.round(np.log((counts[1] + PRIOR) / (counts[0] + PRIOR)) * 15), -127, 127).astype(np.int8)
    return Model(odds, _level(counts.sum(0)).astype(np.int8), mixer)


def base_scores(rows: DataFrame) -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score for rows with key, text
    and train: per row of ``rows``, rows with one key having equal texts."""
    words = F.concat(F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0)),
                     F.array(F.lit("")))               # the empty word is the end
    tokens = rows.select("key", "train", F.explode(words).alias("w"))
    counts = written(tokens.groupBy("w").agg(
        F.sum(F.col("train").cast("long")).alias("c"), F.count("*").alias("n")))
    s = counts.agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.sum((F.col("c") > 0).cast("long")).alias("v")).first()
    train, every, distinct = s["c"] or 0, s["n"] or 0, s["v"] or 0
    often = F.col("n") >= every * FREQUENT
    frequent = broadcast_if_small(counts.where(often).select("w", "c"), 64)
    gain = F.log10(F.col("c") + 1)
    known = (F.col("c") > 0).cast("long")
    marked = tokens.join(frequent, "w", "left")
    own = marked.groupBy("key").agg(
        F.count("*").alias("n_tokens"), F.sum((F.col("w") == "").cast("long")).alias("copies"),
        F.coalesce(F.sum(known), F.lit(0)).alias("n_known"), F.coalesce(F.sum(gain), F.lit(0.0)).alias("gain"))
    rare = marked.where("c is null").select("key", "w").join(counts.where(~often & (F.col("c") > 0)).select("w", "c"), "w") \
        .groupBy("key").agg(F.sum(known).alias("more"), F.sum(gain).alias("more_gain"))
    floor = math.log10(train + distinct + 1)
    per = lambda total: total / F.col("copies")
    return own.join(rare, "key", "left").select(
        "key", per(F.col("n_tokens")).cast("long").alias("n_tokens"),
        per(F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"),
        per(F.col("gain") + F.coalesce("more_gain", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"))


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10
    probability) and bits_per_byte: one row per row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    held_out = crc_mod(docs["doc_id"], FOLDS) == HELD_OUT
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), (~held_out).alias("train"))
    # rows that repeat doc_id and text share a key; two hashes make others differ
    text = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("key", F.struct(F.col("doc_id").alias("id"), F.xxhash64(text).alias("hash")))
    model = docs.sparkSession.sparkContext.broadcast(learn(rows.where("train")))

    def run(batches):
        scorer = Scorer(model.value)
        for batch in batches:
            for at, some in _some(batch):
                bits, size = scorer.total(some)
                part = batch.slice(at, len(some))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("train"), part.column("hash"),
                     pa.array(-bits * math.log10(2)), pa.array(bits / size)],
                    names=["doc_id", "train", "hash", "score", "bits_per_byte"])

    scored = rows.select("doc_id", "train", F.col("key.hash").alias("hash"), "text").mapInArrow(
        run, f"doc_id {kind}, train boolean, hash long, score double, bits_per_byte double")
    base = base_scores(rows)
    same = scored["doc_id"].eqNullSafe(base["key.id"]) & (scored["hash"] == base["key.hash"])
    return scored.join(base, same).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "bits_per_byte")
