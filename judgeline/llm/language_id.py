"""Language identification with string kernels.

A text's letters, A to Z and others, lower-cased and with everything else as one
blank, are cut into blocks.  The kernel of two blocks is the blended spectrum:
the number of n-grams (1 to 3 characters) present in both, over the geometric
mean of the numbers present in each.  Landmark blocks span the Nystroem
features, on which one ridge regression per language (one versus rest) is
fitted.  The kernel is linear in the presence bits, so landmarks and
coefficients fold into one weight matrix, and blocks are scored as batched
products of presence rows with it.

A document's score for a language is the mean over all its blocks, weighted by
their letters: whole texts count, and no text is held as more than one block's
bits at a time.

The classifier is fitted on a bounded sample (``PER_LANGUAGE`` documents of each
language, one block of each, by hash); prediction reads the text alone.

Defined cases: null text, or one without a letter: ``und`` with score 0; nothing
to learn from: every other text is ``und`` too; labels that are null are not
learned; repeated rows are predicted one by one; an empty table gives an empty
result.  Other columns of the input, whatever their names, pass through
``reject`` and are not read by ``predict``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from judgeline.llm.common import KEY_BITS, broadcast_if_small, crc_mod, hash_key, ship
from judgeline.session import cut_lineage

ship(__name__)

PER_LANGUAGE = 400        # documents of a language that the classifier is fitted on
LANDMARKS = 48            # of these, the first so many span the features
ALL_LANDMARKS = 384       # of all languages together
SPARE = 3                 # times as many are expected under the bound on their keys
MAX_SAMPLE = 4_000        # blocks in all, however many languages there are
BLOCK = 4096              # characters of a block
RIDGE = 1e-3
FOLDS, HELD_OUT = 3, 1
MIN_SCORE = 0.2           # reject() drops documents below it, and those without a letter
UNKNOWN = "und"
#: Slots of the hashed 1-, 2- and 3-grams; a multiplier spreads the characters.
SLOTS = (1 << 12, 1 << 16, 1 << 17)
_MULTIPLIERS = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def blocks(text: str | None) -> Iterator[np.ndarray]:
    """Code points (uint32) of each block of a text: letters, and single blanks."""
    if not text:
        return
    # str decides what a letter is: a table of the characters that occur
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    top = int(chars.max()) + 1
    seen = np.zeros(top, bool)
    seen[chars] = True
    table = np.zeros(top, np.uint32)
    for c in np.flatnonzero(seen).tolist():
        if chr(c).isalpha():
            table[c] = c
    chars = table[chars]
    blank = chars == 0
    chars = chars[~blank | ~np.concatenate(([True], blank[:-1]))]
    for at in range(0, len(chars), BLOCK):
        part = chars[at:at + BLOCK]
        if part.any():
            yield part


def grams(block: np.ndarray) -> np.ndarray:
    """Slots of the n-grams present in a block, ascending, each once."""
    padded = np.concatenate((np.zeros(1, np.uint32), block, np.zeros(1, np.uint32)))
    present = np.zeros(sum(SLOTS), bool)
    base, code = 0, np.zeros(len(padded), np.uint32)
    for n, slots in enumerate(SLOTS, 1):
        code = code[:len(padded) - n + 1] * _MULTIPLIERS[1] + padded[n - 1:] * _MULTIPLIERS[0]
        mixed = (code ^ (code >> np.uint32(15))) * _MULTIPLIERS[2]
        present[base + (mixed >> np.uint32(7)) % np.uint32(slots)] = True
        base += slots
    return np.flatnonzero(present)


class Model:
    """Folded weights: presence rows times ``weights`` are the languages' scores."""

    def __init__(self, languages: list[str], weights: np.ndarray, offset: np.ndarray):
        self.languages, self.weights, self.offset = languages, weights, offset

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        """Scores (blocks x languages) of presence rows, as one product."""
        starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])[:-1]))
        products = np.add.reduceat(self.weights[np.concatenate(rows)], starts, axis=0)
        return products / np.sqrt([[len(r)] for r in rows]) + self.offset


def fit(sample: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nystroem features on the first blocks of each language, then ridge regression.

    Presence is held as bits for the landmarks alone, so that the driver's memory
    is bounded by their number and the slots."""
    languages = sorted({lang for lang, _ in sample})
    each = max(1, min(landmarks, ALL_LANDMARKS // len(languages)))
    taken, marks = dict.fromkeys(languages, 0), []
    for i, (lang, _) in enumerate(sample):
        if taken[lang] < each:
            taken[lang] += 1
            marks.append(i)
    bits = np.zeros((sum(SLOTS), len(marks)), bool)
    for j, i in enumerate(marks):
        bits[sample[i][1], j] = True
    own = np.sqrt([len(present) for _, present in sample])
    kernel = np.array([np.count_nonzero(bits[present], axis=0) for _, present in sample], float)
    kernel /= own[:, None] * own[marks]
    values, vectors = np.linalg.eigh(kernel[marks])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])           # K(L, L) ** -1/2
    features = np.concatenate((kernel @ root, np.ones((len(sample), 1))), axis=1)
    target = np.array([[float(lang == other) for other in languages] for lang, _ in sample])
    weight = target @ (1 / (len(languages) * target.sum(0)))   # languages weigh the same
    penalty = np.diag([ridge] * (features.shape[1] - 1) + [0.0])
    found = np.linalg.solve((features.T * weight) @ features + penalty, (features.T * weight) @ target)
    by_mark = (root @ found[:-1]) / own[marks][:, None]
    folded = np.concatenate([part.astype(np.float32) @ by_mark.astype(np.float32)
                             for part in np.array_split(bits, 64)])
    return Model(languages, folded, found[-1])


def _sample(docs: DataFrame, per_language: int) -> list[tuple[str, np.ndarray]]:
    """One block of each sampled document, as presence slots; at most MAX_SAMPLE."""
    learn = docs.where(docs["text"].isNotNull() & docs["lang"].isNotNull()
                       & (crc_mod(docs["doc_id"], FOLDS) != HELD_OUT))
    learn = learn.select(learn["doc_id"].alias("doc_id"), learn["lang"].alias("lang"), learn["text"].alias("text"),
                         F.xxhash64(learn["text"]).alias("hash"))
    # copies of a document count once, however often it is repeated
    same = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("hash"))
    narrow = cut_lineage(learn.select("doc_id", "lang", "hash", hash_key(same, "language").alias("key")))
    # the smallest keys of a language lie under a bound that its number of documents
    # gives: only some SPARE times as many as wanted are dealt by language and ranked
    bound = F.lit(float(1 << KEY_BITS)) * (SPARE * per_language) / F.approx_count_distinct("key")
    bounds = cut_lineage(narrow.groupBy("lang").agg(bound.alias("bound")))
    narrow = narrow.join(broadcast_if_small(bounds), "lang").where("key <= bound").drop("bound").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id", "hash"))
    narrow = narrow.withColumn("place", place).where(F.col("place") <= per_language)
    chosen = cut_lineage(narrow.orderBy("place", "lang", "key").limit(MAX_SAMPLE)
                         .select(F.col("doc_id").alias("id"), F.col("lang").alias("of"), F.col("hash").alias("own")))
    if chosen.isEmpty():
        return []
    found = learn["doc_id"].eqNullSafe(chosen["id"]) & (learn["lang"] == chosen["of"]) & (learn["hash"] == chosen["own"])
    texts = learn.join(F.broadcast(chosen), found, "left_semi").dropDuplicates(["doc_id", "lang", "hash"]) \
        .select("lang", "text", hash_key(F.col("doc_id"), "block").alias("key"))

    def present(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = list(blocks(row["text"]))
                if own:
                    out.append({"lang": row["lang"], "key": row["key"],
                                "slots": grams(own[row["key"] % len(own)]).astype(np.int32).tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("lang", pa.string()), ("key", pa.int64()), ("slots", pa.binary())]))

    rows = texts.mapInArrow(present, "lang string, key long, slots binary").collect()
    rows.sort(key=lambda r: (r["key"], r["lang"], bytes(r["slots"])))
    return [(r["lang"], np.frombuffer(r["slots"], np.int32)) for r in rows]


def _predicted(texts: list[str | None], model: Model | None) -> list[tuple[str, float]]:
    """(language, score) of each text; blocks are scored some hundred at a time."""
    if model is None:
        return [(UNKNOWN, 0.0)] * len(texts)
    totals = np.zeros((len(texts), len(model.languages)))
    letters = np.zeros(len(texts))
    rows, owners, sizes = [], [], []

    def flush():
        if rows:
            scores = model.score(rows) * np.array(sizes)[:, None]
            np.add.at(totals, owners, scores)
            np.add.at(letters, owners, sizes)
            rows.clear(), owners.clear(), sizes.clear()

    for i, text in enumerate(texts):
        for block in blocks(text):
            rows.append(grams(block))
            owners.append(i)
            sizes.append(float(np.count_nonzero(block)))
            if len(rows) >= 256:
                flush()
    flush()
    best = totals.argmax(1) if len(texts) else []
    return [(model.languages[b], float(min(1.0, max(0.0, t[b] / n)))) if n else (UNKNOWN, 0.0)
            for t, n, b in zip(totals, letters, best)]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    sample = _sample(docs, per_language)
    return fit(sample) if sample else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(docs["doc_id"].alias("doc_id"), (crc_mod(docs["doc_id"], FOLDS) == HELD_OUT).alias("held_out"),
                       docs["text"].alias("text"))

    def score(batches):
        for batch in batches:
            found = _predicted(batch.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def reject(docs: DataFrame, model: Model | None, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is found with
    ``min_score`` or more."""
    def keep(batches):
        for batch in batches:
            found = _predicted(batch.column("text").to_pylist(), model)
            yield batch.filter(pa.array([x != UNKNOWN and y >= min_score for x, y in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
