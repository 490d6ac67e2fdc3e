"""Operators over documents against brute force, with the odd cases: nulls in any
column, empty and very long texts, ties, repeated rows, empty tables and extra
columns whose names clash with the operators' own."""
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from judgeline.llm import (
    language_id, license_scan, lm_scoring, minhash_dedup, mixing, quality_rules,
    sentencepiece_codec, sharding)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, `key` string, jl_id int"
LINE = "the quick brown fox jumps over the lazy dog while it rains in the old town and nobody minds at all "
OTHER = "der schnelle braune fuchs springt nicht über den faulen hund und das ist für die leute im dorf auch gut "


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def texts():
    rng = random.Random(5)
    out = []
    for k in range(60):
        base = (LINE if k % 3 else OTHER).split()
        own = [rng.choice(base) + (str(rng.randrange(9)) if rng.random() < 0.3 else "") for _ in range(rng.randrange(60, 140))]
        out.append(" ".join(own))
        if k % 4 == 0:
            out += [out[-1], out[-1] + " end", " ".join(own[:-1])]
    return out + [None, "", "   ", "one", "one", "One\n\ttwo", "#### $$$ %%% |", "same line\n" * 30,
                  "a b c a b c", "word " * 30_000, "▁x  y\u3000z\x00é", "Released under the MIT License.",
                  "x Apache  License, Version 2.0 CC BY-NC", "This work is licensed under the GNU General Public License, version 3."]


def rows():
    own = [(i, t, ("de" if "der " in (t or "") else "en") if i % 7 else None, f"src{i % 4}" if i % 11 else None,
            1, 2, True, "k", 3) for i, t in enumerate(texts())]
    return own + [own[0], own[0], (None, LINE * 2, "en", "src1", 0, 0, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_mixing(docs, empty):
    got = mixing.mix_words(docs).collect()
    assert len(got) == len(rows())
    sizes, by_id = Counter(), {}
    for r in rows():
        sizes[r[3]] += len(words_of(r[1]))
        by_id[r[0]] = (r[3], len(words_of(r[1])))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, budget = {}, set(order), 1.5 * sum(sizes.values())
    while True:                                    # the contract's own words
        share = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
            left.remove(s)
    taken = Counter()
    for r in got:
        source, size = by_id[r.doc_id]
        assert (r.size, r.source_size) == (size, sizes[source])
        assert abs(r.target - target[source]) < 1e-6 and 0 <= r.taken <= 2 * size
        taken[source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in order)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_words(docs.repartition(7)).collect()))
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(words_of(r.text))
    assert all(abs(words[s] - target[s]) <= max(len(words_of(r[1])) for r in rows() if r[3] == s) for s in order)
    assert mixing.mix_words(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


@pytest.mark.parametrize("equal", [False, True])
def test_mix_without_ids(spark, equal):
    """A source of rows without doc_id, all different or all equal, and rows of one
    doc_id: off the target by half a document at most, as in the words' mix."""
    own = [(None, f"{LINE}{'' if equal else k}", "hot", k % 2) for k in range(800)]
    own += [(7, f"{OTHER} {k % 5}", "one", 0) for k in range(600)] + [(1000 + k, LINE * (k % 9), "rest", 0) for k in range(300)]
    table = spark.createDataFrame(own, "doc_id long, text string, source string, `before` int").repartition(5)
    words = Counter()
    mixed = mixing.mix_documents(table).collect()
    for r in mixed:
        words[r.source] += len(words_of(r.text))
    targets = {r.source: r.target for r in table.select("doc_id", "source").distinct()
               .join(mixing.mix_words(table), "doc_id").select("source", "target").distinct().collect()}
    nulls = mixing.mix_words(table).where("doc_id is null").collect()
    targets["hot"] = nulls[0].target
    assert sum(r.taken for r in nulls) == math.floor(nulls[0].target + 0.5)
    for source in ("hot", "one", "rest"):
        longest = max(len(words_of(r[1])) for r in own if r[2] == source)
        assert abs(words[source] - targets[source]) <= longest / 2 + 1
    assert sorted(map(str, mixed)) == sorted(map(str, mixing.mix_documents(table.repartition(9)).collect()))


def test_prefix_sums_of_a_hot_key(spark):
    """Rows of one key, equal ones too, are summed over many ranges, in one order."""
    from pyspark.sql import functions as F
    from judgeline.llm.common import counted, each_copy, hash_key, prefix_sums
    own = [(None, k % 50) for k in range(3000)] + [(None, 7)] * 5000 + [(k, 3) for k in range(2000)]
    rows = counted(spark.createDataFrame(own, "id long, size long"), most=10).withColumn("key", hash_key(F.col("id"), "x"))
    rows = rows.withColumn("g", F.lit(None).cast("string")).cache()
    got = each_copy(prefix_sums(rows, ["g"], "key", ["id", "size", "part"], F.col("size") * F.col("copies"), "before", 20)).collect()
    assert Counter((r.id, r["size"]) for r in got) == Counter(own)
    now = 0
    for before, size in sorted((r.before + r.copy * r["size"], r["size"]) for r in got):
        assert before == now
        now += size
    assert set(got[0].asDict()) == {"id", "size", "copies", "part", "key", "g", "before", "copy"}


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_sharding(docs, empty, spark):
    got = sharding.shard_documents(docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    same = spark.createDataFrame([(None, "a")] * 3000 + [(5, str(k)) for k in range(3000)], "doc_id long, text string")
    found = sharding.shard_documents(same).collect()
    assert len(found) == 6000
    for s in {r.shard for r in found}:
        own = sorted(r.slot for r in found if r.shard == s)
        assert own == list(range(len(own)))
    shard_of = {}
    for r in got:
        assert shard_of.setdefault(r.doc_id, r.shard) == r.shard
    keys = [0, 1, 2**63, 2**64 - 1, *[random.Random(k).randrange(2**64) for k in range(40)]]
    frame = spark.createDataFrame([(str(k),) for k in keys], "k string").selectExpr("k", "cast(k as decimal(20,0)) as key64")
    for r in frame.select("k", sharding.jump_hash("key64", 17).alias("s")).collect():
        assert r.s == jump(int(r.k), 17)
    assert sharding.shard_documents(empty).count() == 0


def test_quality(docs, empty):
    found = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    for r in rows():
        w, t, g = words_of(r[1]), r[1] or "", found[r[0]]
        windows = Counter(zip(w, w[1:], w[2:]))
        repeated = {p for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if words_of(x)]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))
        assert g.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert g.kept == (not g.base_failed and not g.failed_rules)
    passed = quality_rules.passing(docs)
    assert passed.columns == docs.columns
    assert Counter(r.doc_id for r in passed.collect()) == Counter(r[0] for r in rows() if found[r[0]].kept)
    assert quality_rules.judge(empty).count() == 0 and quality_rules.passing(empty).count() == 0


def test_licenses(docs, empty):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    found = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    for r in rows():
        w = words_of(lowered(r[1]), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        places = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        g = found[r[0]]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (
            len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert g.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, g.base_labels.split(","))) <= set(filter(None, g.labels.split(",")))
        assert 0 <= g.score <= 1 and (g.score > 0) == (g.labels != "")
    assert [r.labels for r in found.values() if r.doc_id == len(texts()) - 1] == ["gpl-3"]
    assert license_scan.scan(empty).count() == 0


@pytest.mark.parametrize("phrases", [("c d",), ()])
def test_license_without_its_rarest_words(spark, phrases):
    """A passage that holds enough in place is found though its template's rarest words lack."""
    own = [(0, "x y c d e f g h i j k l"), (1, "c d e f"), *((i, "nothing here") for i in range(2, 60))]
    got = license_scan.scan(spark.createDataFrame(own, "doc_id long, text string"),
                            templates=(("own", "a b c d e f g h i j k l", phrases),)).collect()
    assert [r.doc_id for r in got if r.labels] == [0]


@pytest.mark.parametrize("size", [2, 5])
def test_minhash(docs, empty, size):
    def shingles(text):
        w = words_of(lowered(text))
        return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}

    sets = {r[0]: shingles(r[1]) for r in rows() if r[0] is not None}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                n = len(sets[i] & sets[j])
                if i < j and n and 100 * n >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    got = minhash_dedup.near_duplicates(docs, words=size).collect()
    assert len(got) == len(rows())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)
    kept = minhash_dedup.one_of_each(docs, words=size)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, *{i for i in root if root[i] == i}])
    assert minhash_dedup.near_duplicates(empty, words=size).count() == 0


def test_minhash_centre(spark):
    """Copies that are each like one centre but not like each other, with the centre last."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    own = []
    for i in range(120):
        w = list(base)
        for p in rng.sample(range(120), 6):
            w[p] = f"x{i}y{p}"
        own.append((i, " ".join(w)))
    own.append((500, " ".join(base)))
    got = minhash_dedup.near_duplicates(spark.createDataFrame(own, "doc_id long, text string"), words=2).collect()
    assert {r.component_id for r in got} == {0}


def component_roots(sets):
    """Smallest id reachable by links of 80 percent, all pairs compared."""
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            n = len(sets[i] & sets[j])
            if i < j and 100 * n >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root


def partial_copies():
    """Two like documents, and many lower partial copies, a little too short for a link."""
    rng = random.Random(11)
    core = [f"w{i}" for i in range(200)]
    return [rng.sample(core, 166) for _ in range(60)] + [core + [f"{end}{i}" for i in range(10)] for end in "ab"]


def edited_copies():
    """Two like documents, and many lower copies under half like them and each other."""
    rng = random.Random(12)
    core = [f"w{i}" for i in range(200)]
    return [rng.sample(core, 104) for _ in range(500)] + [core + [f"{end}{i}" for i in range(20)] for end in "ab"]


@pytest.mark.parametrize("make", [partial_copies, edited_copies])
@pytest.mark.parametrize("small", [minhash_dedup.SMALL, 2])
def test_minhash_third_hub(spark, monkeypatch, make, small):
    """Linked documents whose buckets all have a third, unlike document as the smallest."""
    monkeypatch.setattr(minhash_dedup, "SMALL", small)
    own = make()
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(own)], "doc_id long, text string")
    got = minhash_dedup.near_duplicates(docs, words=1).collect()
    assert {r.doc_id: r.component_id for r in got} == component_roots({k: set(w) for k, w in enumerate(own)})


def test_minhash_opens_whole_buckets(spark):
    """Buckets of several families, salted or not, are opened with all their members."""
    rng = random.Random(13)
    core, halves = [f"w{i}" for i in range(200)], 3
    own = [rng.sample(core, 170) for _ in range(300)] + [rng.sample(core, 60) for _ in range(100)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(own)], "doc_id long, text string")
    classes = minhash_dedup.signatures(docs, 1, halves, 1).selectExpr("doc_id rep", "n_shingles n", "u", "v").cache()
    hot = minhash_dedup._hot(classes, classes.count())
    stars = minhash_dedup._stars(classes, hot, 50, halves).cache()
    assert {r.kind for r in stars.select("kind").distinct().collect()} == {0, 1, 2}
    families = spark.createDataFrame([(k, 1000 + (k % 7 == 0)) for k in range(0, 400, 2)], "id long, family long")
    family = {r.id: r.family for r in families.collect()}
    buckets = {}
    for r in classes.collect():
        for i, u in enumerate(r.u):
            for j, v in enumerate(r.v):
                buckets.setdefault((i * halves + j, u, v), set()).add(r.rep)
    several = {(t, min(b)): b for (t, _, _), b in buckets.items() if len({family.get(k, k) for k in b}) > 1}
    opened = {}
    for r in minhash_dedup._open_buckets(classes, stars, families, halves).collect():
        assert r.family == family.get(r.rep, r.rep)
        for t in range(halves * halves):
            if r.t0 >> t & 1:
                opened.setdefault((t, r.hub), set()).add(r.rep)
    assert opened == several


def test_minhash_expands_each_half_key_once(spark, monkeypatch):
    """Neither the hot half keys nor the open buckets are expanded a second time."""
    seen, bucket = [], minhash_dedup._bucket
    monkeypatch.setattr(minhash_dedup, "_bucket", lambda rows: seen.append(rows) or bucket(rows))
    own = partial_copies()
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(own)], "doc_id long, text string")
    got = minhash_dedup.near_duplicates(docs, words=1).collect()
    assert {r.doc_id: r.component_id for r in got} == component_roots({k: set(w) for k, w in enumerate(own)})
    assert len(seen) == 1


def test_language(docs, empty):
    model = language_id.train(docs)
    got = language_id.predict(docs, model).collect()
    by_id = {r[0]: r[1] for r in rows()}
    assert len(got) == len(rows())
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        text = by_id[r.doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif len(words_of(text)) > 50:
            assert r.lang_pred == ("de" if "fuchs" in text else "en") or len(set(words_of(text))) < 5
    kept = language_id.reject(docs, model)
    assert kept.columns == docs.columns and kept.where("text is null").count() == 0
    assert language_id.train(empty) is None and language_id.predict(empty, None).count() == 0


def test_language_sample(spark):
    """Neither a document in very many rows nor rows without doc_id cost a language."""
    own = [(1, LINE, "en")] * 6000 + [(i, OTHER + str(i), "de") for i in range(20)] + [(None, "le la les des mots", "fr")] * 3
    learned = language_id._sample(spark.createDataFrame(own, "doc_id long, text string, lang string").repartition(5), 400)
    count = Counter(lang for lang, _ in learned)
    assert (count["en"], count["fr"]) == (1, 1)
    assert count["de"] == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(20))


def test_language_sample_of_a_large_language(spark):
    """The documents ranked per language are those of the smallest keys: all of them are there."""
    own = [(i, f"{LINE} {i}", "en") for i in range(3000)] + [(9000 + i, f"{OTHER} {i}", "de") for i in range(40)]
    table = spark.createDataFrame(own, "doc_id long, text string, lang string").repartition(5)
    learned = Counter(lang for lang, _ in language_id._sample(table, 50))
    assert learned == {"en": 50, "de": sum(zlib.crc32(str(9000 + i).encode()) % 3 != 1 for i in range(40))}


def test_language_kernel():
    """Folded weights give what the kernel, written out, gives."""
    import numpy as np
    some = [(("en", LINE), ("de", OTHER))[k % 2] for k in range(20)]
    sample = [(lang, language_id.grams(next(language_id.blocks(t[k:])))) for k, (lang, t) in enumerate(some)]
    model = language_id.fit(sample, landmarks=3)
    unseen = [language_id.grams(next(language_id.blocks(t))) for t in (LINE[40:], OTHER[30:])]
    scores = model.score(unseen)
    assert (scores.argmax(1) == [1, 0]).all() and model.languages == ["de", "en"]
    presence = np.zeros(sum(language_id.SLOTS))
    presence[unseen[0]] = 1
    assert np.allclose(presence @ model.weights / math.sqrt(presence.sum()) + model.offset, scores[0], atol=1e-4)


def test_sentencepiece(docs, empty):
    vocabulary = sentencepiece_codec.Vocabulary()
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    plain = sentencepiece_codec.Encoder(vocabulary, dropout=0)
    for t in texts():
        if t and "▁" not in t:
            assert plain.encode([t])[0] == model.encode(t)
    varied = sentencepiece_codec.Encoder(vocabulary, dropout=0.3)
    for t in texts():
        ids = varied.encode([t], 1)[0]
        assert ids is None if t is None else varied.decode(ids) == t
    once = [k for k in range(len(varied.part)) if varied.depth[k] == 1][:400]
    for k in once:                                             # lockstep equals the heap
        at = varied.id_first[k]
        ids = tuple(varied.ids[at:at + varied.id_count[k]].tolist())
        assert varied._merged((varied.text[varied.part[k]], int(varied.code[k])))[0] == ids
    assert len(once) > 20
    other = sentencepiece_codec.Encoder(vocabulary, dropout=0.3, seed=8)
    assert other.encode([LINE * 3], 1) != varied.encode([LINE * 3], 1)
    encoded = sentencepiece_codec.encode(docs, vocabulary)
    back = sentencepiece_codec.decode(encoded, vocabulary).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1]) for r in rows())
    trip = sentencepiece_codec.round_trip(docs, vocabulary).collect()
    assert all(r.lossless for r in trip if r.n_ids is not None) and len(trip) == len(rows())
    assert sentencepiece_codec.round_trip(empty, vocabulary).count() == 0


def agenda(word, vocabulary, rng):
    """Ids of a word, each candidate merge skipped by a draw of its own."""
    pieces, skipped = [(i, i + 1) for i in range(len(word))], {}
    while True:
        ways = sorted((vocabulary.rank[word[a:d]], a, d, k) for k, ((a, _), (_, d)) in enumerate(zip(pieces, pieces[1:]))
                      if word[a:d] in vocabulary.rank and not skipped.get((a, d)))
        if not ways:
            return [vocabulary.ids[word[a:b]] for a, b in pieces]
        _, a, d, k = ways[0]
        if not skipped.setdefault((a, d), rng.random() < sentencepiece_codec.DROPOUT):
            pieces[k:k + 2] = [(a, d)]


def test_sentencepiece_occurrences(spark):
    """Every occurrence of a word is drawn by itself, between documents and inside one."""
    vocabulary = sentencepiece_codec.Vocabulary()
    word = "international"
    own = [(i, f"{word}\n") for i in range(2000)] + [(9999, f"{word}\n" * 2000)]
    got = sentencepiece_codec.encode(spark.createDataFrame(own, "doc_id long, text string"), vocabulary).collect()
    assert len({tuple(r.ids) for r in got if r.doc_id < 9999}) > 4
    ids = next(r.ids for r in got if r.doc_id == 9999)
    text = "".join(vocabulary.bytes[i].decode() for i in ids)
    assert text == " " + f"{word}\n" * 2000
    lines, line = Counter(), []
    for i in ids:
        line.append(i)
        if vocabulary.bytes[i].endswith(b"\n"):
            lines[tuple(line)] += 1
            line = []
    assert len(lines) > 4
    encoder = sentencepiece_codec.Encoder(vocabulary)
    assert encoder.encode([t for _, t in own[:9]], [5] * 9) == [encoder.encode([f"{word}\n"], 5)[0]] * 9
    rng = random.Random(4)
    drawn = Counter(tuple(agenda(word, vocabulary, rng)) for _ in range(2000))
    found = Counter({line[:-1]: n for line, n in lines.items()})
    assert abs(drawn.most_common(1)[0][1] - found[drawn.most_common(1)[0][0]]) < 150
    assert sum((drawn & found).values()) > 1600


def keyed_agenda(word, vocabulary, key, dropout):
    """Ids of a word, each candidate merge skipped by the keyed hash of its place."""
    pieces, skipped = [(i, i + 1) for i in range(len(word))], {}

    def skips(a, d):
        h = key ^ (a * 0x9E3779B97F4A7C15 + d * 0xC2B2AE3D27D4EB4F) % 2**64
        h = (h ^ (h >> 31)) * 0xBF58476D1CE4E5B9 % 2**64
        return h >> 32 < int(dropout * 2**32)

    while True:
        ways = sorted((vocabulary.rank[word[a:d]], a, d, k) for k, ((a, _), (_, d)) in enumerate(zip(pieces, pieces[1:]))
                      if word[a:d] in vocabulary.rank and not skipped.get((a, d)))
        if not ways:
            return [i for a, b in pieces for i in (
                [vocabulary.ids[word[a:b]]] if word[a:b] in vocabulary.ids else [vocabulary.byte[x] for x in word[a:b].encode()])]
        _, a, d, k = ways[0]
        if not skipped.setdefault((a, d), skips(a, d)):
            pieces[k:k + 2] = [(a, d)]


def occurrence_key(seed, doc_key, place):
    h = (doc_key + (seed + 1) * 0xC2B2AE3D27D4EB4F) % 2**64
    for more in (place * 0x9E3779B97F4A7C15, 0):
        h = (h + more) % 2**64
        h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        h = (h ^ (h >> 27)) * 0xC2B2AE3D27D4EB4F % 2**64
        h ^= h >> 31
    return h


def test_sentencepiece_seeded_agenda(monkeypatch):
    """Every part of every text equals an agenda replayed with the same keyed hash,
    also where what is remembered is forgotten inside a text."""
    vocabulary = sentencepiece_codec.Vocabulary()
    own = [t for t in texts() if t and len(t) < 20_000]
    own += [" ".join(["internationalization", "überraschenderweise", "日本語の文章", "\u0000x", "a" * 40, "né"] * 30), "x\n\n\ty ▁ z"]
    for remembered, dropout, seed in ((200_000, 0.1, 7), (50, 0.5, 3)):
        monkeypatch.setattr(sentencepiece_codec, "REMEMBERED", remembered)
        monkeypatch.setattr(sentencepiece_codec, "PARTS", 64 if remembered == 50 else 60_000)
        encoder = sentencepiece_codec.Encoder(vocabulary, dropout, seed)
        for doc_key, (t, ids) in enumerate(zip(own, encoder.encode(own, np.arange(len(own))))):
            parts = []
            for k, x in enumerate(t.split("▁")):
                parts += [None] * (k > 0) + encoder.parts((x if k else " " + x).replace(" ", "▁"))
            want = []
            for place, part in enumerate(parts):
                if part is None:
                    want += [vocabulary.byte[x] for x in "▁".encode()]
                else:
                    want += keyed_agenda(part, vocabulary, occurrence_key(seed, doc_key, place), dropout)
            assert ids == want


def test_language_model(docs, empty):
    got = lm_scoring.score_documents(docs).collect()
    assert len(got) == len(rows())
    tokens = lambda t: words_of(lowered(t)) + [""]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    counts = Counter()
    for r in rows():
        if not held(r[0]):
            counts.update(tokens(r[1]))
    n, v, by_id = sum(counts.values()), len(counts), {r[0]: r[1] for r in rows()}
    for r in got:
        own = tokens(by_id[r.doc_id])
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(counts[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    whole = [r for r in got if by_id[r.doc_id] and len(by_id[r.doc_id]) > 300]
    assert sum(r.bits_per_byte for r in whole) / len(whole) < 4
    assert lm_scoring.score_documents(empty).count() == 0


def test_language_model_is_a_distribution():
    import numpy as np
    learner = lm_scoring.Learner()
    for _ in range(3):
        learner.learn([LINE, OTHER, None, ""])
    found, times, sums = learner.result()
    every = Counter()
    for t in [LINE, OTHER, "", ""]:
        coded = b"\xff\xff\xff" + t.encode() + b"\xff"
        every.update(int.from_bytes(coded[i:i + 4], "big") for i in range(len(coded) - 3))
    assert dict(zip(found.tolist(), times.tolist())) == {k: 3 * n for k, n in every.items()}
    odds = np.clip(np.round(np.log((learner.counts[1] + 0.4) / (learner.counts[0] + 0.4)) * 15), -127, 127).astype(np.int8)
    model = lm_scoring.Model(odds, lm_scoring._level(learner.counts.sum(0)).astype(np.int8), lm_scoring._joined(sums))
    for context in (0x207468, 0xFFFFFF, 0x123456):
        cost = model.cost(np.uint32(context << 8) + np.arange(256, dtype=np.uint32))
        assert abs((2.0 ** -cost).sum() - 1) < 1e-3
    long, short = (lm_scoring.Scorer(model, bits=b).total([LINE, None, OTHER])[0] for b in (20, 4))
    assert np.allclose(long, short)


def test_language_model_of_many_partitions(spark, docs):
    """What is learned does not depend on how the texts are dealt to tasks."""
    import numpy as np
    texts = docs.select("text")
    one, many = (lm_scoring.learn(texts.repartition(n)) for n in (1, 60))
    assert np.array_equal(one.odds, many.odds) and np.array_equal(one.level, many.level)
    assert np.allclose(one.mixer.weights, many.mixer.weights, atol=1e-6)
    assert np.allclose(one.mixer.apm, many.mixer.apm, rtol=1e-6)
    first = lm_scoring.Mixer.first()
    assert np.abs(many.mixer.weights - first.weights).max() > 0.3
    unseen = [" ".join(t.split()[::-1]) for t in (LINE, OTHER)]
    start = lm_scoring.Model(many.odds, many.level, first)
    better, worse = (lm_scoring.Scorer(m).total(unseen)[0] for m in (many, start))
    assert (better < worse).all()


def test_pipeline_stages(spark, docs, empty):
    """Each stage keeps the columns and what brute force says it should keep."""
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, "")
        assert after.columns == docs.columns, name
        assert after.count() > 0
        now = after.cache()
    kept = {r.doc_id for r in now.collect()}
    encoded = corpus_pipeline.STAGES[-1][1](spark, now, "").collect()
    assert {r.doc_id for r in encoded} == kept
    assert all(r.n_ids == len(r.ids) for r in encoded)
    now = empty
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
    assert now.count() == 0
