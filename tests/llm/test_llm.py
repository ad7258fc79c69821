"""The training-data operators against brute force, on small tables with nulls, ties, repeated rows and odd columns."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lossgrid.llm import likeness, lines, lm, mixing, packing, pages, simhash, sketch, token_ids, toxicity, vectors
from lossgrid.llm.common import components, fold, prepared

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, _cut string, rank int"
WORDS = "the of and in to house river stone market letter winter garden window bridge".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{rng.integers(0, 40)}" for i in rng.integers(0, len(WORDS), n))


def rows():
    out = [(i, prose(i, 30 + 7 * i), "en", f"s{i % 5}", 1, "k", "c", 1) for i in range(40)]
    out += [(100 + i, prose(3, 51), "en", None if i == 0 else f"s{i}", None, "k", None, 1) for i in range(6)]  # copies
    near = prose(5, 65).split()
    out += [(200 + i, " ".join([*near[:i], "changed", *near[i + 1 :]]), "fr", "s1", 1, None, None, 2) for i in range(4)]
    shared = "One line that many sites carry, word for word."
    out += [(300 + i, f"{prose(50 + i, 20)}\n{shared}\n\n  {shared} \n{prose(80 + i, 9)}", "de", f"t{i}", 1, "k", "c", 3) for i in range(8)]
    out += [(400, None, None, None, None, None, None, None), (401, "", "en", "s0", 0, "", "", 0), (402, " \n\t ", "en", "s0", 4, "", "", 0), (403, "word", "en", "s0", 4, "", "", 0)]
    out += [(404, "x " * 30000, "en", "s2", 60000, "", "", 0), (405, "été 中文   naïve\x0bnext", "fr", "s3", 9, "", "", 0)]
    out += [(None, "a row without id " + prose(9, 12), "en", "s1", 3, "k", "c", 1), (7, prose(7, 79), "en", "s2", 1, "k", "c", 1)]  # null id; row 7 twice
    return out


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


@pytest.fixture(scope="module")
def docs(session):
    return session.createDataFrame(rows(), DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(session):
    return session.createDataFrame([], DOCS)


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# -- 1 ----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("ids", [[], [0], [0] * 700, [2**64 - 1, 5, 2**60, 2**60 - 1], list(range(3000)), [50256] * 513 + [1] * 600, [0, 2**63] * 400])
def test_ids_round_trip(ids):
    ids = np.array(ids, np.uint64)
    packed, offsets, raw = token_ids.encode(ids)
    assert len(offsets) == -(-len(ids) // token_ids.BLOCK)
    assert np.array_equal(token_ids.decode(packed, offsets, raw, len(ids)), ids)


def test_random_ids_round_trip():
    rng = np.random.default_rng(1)
    for bits in (1, 3, 8, 16, 33, 61, 64):
        ids = rng.integers(0, 2**bits - 1, 2000, dtype=np.uint64, endpoint=True) >> rng.integers(0, bits, 2000).astype(np.uint64)
        assert np.array_equal(token_ids.decode(*token_ids.encode(ids), len(ids)), ids)


def test_token_files(docs, empty, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    found = token_ids.op1(docs, path, str(tmp_path)).collect()
    wanted, start = [], 0
    for row in sorted(rows(), key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2]
        wanted.append((row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == wanted
    assert token_ids.op1(empty, path, str(tmp_path)).collect() == []


# -- 2 ----------------------------------------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets([("a", 10), ("b", 10), ("c", 10)]) == pytest.approx([18.75, 7.5, 3.75])
    assert mixing.targets([("a", 1), ("b", 100), ("c", 0)]) == pytest.approx([3, 98, 0])
    assert mixing.targets([]) == []


def test_fit_finds_the_budget():
    rng = np.random.default_rng(4)
    for _ in range(30):
        counts = {int(n): int(c) for n, c in zip(rng.integers(1, 60, 6), rng.integers(1, 5, 6))}
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        budget = int(rng.integers(0, sum(n * c for n, c in counts.items()) + 1))
        taken = mixing.fit(counts, budget)
        got = sum(n * c for n, c in taken.items())
        assert all(0 <= taken[n] <= c for n, c in counts.items())
        assert abs(got - budget) <= min(abs(s - budget) for s in sums) + min(counts)
    big = {100: 5000, 37: 10_000, 5000: 300}
    assert sum(n * c for n, c in mixing.fit(big, 1_234_567).items()) == 1_234_567


def test_mix(docs, empty):
    found = mixing.op2(docs).collect()
    assert len(found) == len(rows())
    sizes = {(r[0], len(split_words(r[1]))) for r in rows()}
    assert {(r["doc_id"], r["size"]) for r in found} == sizes
    total = sum(len(split_words(r[1])) for r in rows())
    by = {}
    for r in found:
        assert r["taken"] <= 3 * r["size"]
    source = {(r[0], len(split_words(r[1]))): r[3] for r in rows()}
    for r in found:
        by.setdefault(source[r["doc_id"], r["size"]], []).append(r)
    assert sum(g[0]["target"] for g in by.values()) == pytest.approx(total)
    for group in by.values():
        assert group[0]["source_size"] == sum(r["size"] for r in group)
        assert abs(sum(r["taken"] for r in group) - group[0]["target"]) <= max(r["size"] for r in group)
    assert sorted(map(str, mixing.op2(docs.repartition(2)).collect())) == sorted(map(str, found))
    assert mixing.op2(empty).collect() == []
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 400").count() == 1


# -- 3 ----------------------------------------------------------------------------------------------------------------

INSULTS = ["blockhead", "numbskull", "dimwitted", "scoundrel"]


def toxic_rows(n=400):
    out = []
    for i in range(n):
        words = prose(1000 + i, 25).split()
        toxic = int(i % 4 == 0)
        if toxic:
            bad = INSULTS[(i // 4) % 4]
            words[i % 25] = bad if i % 8 else bad[:4] + "-" + bad[4:]
        out.append((i, " ".join(words), toxic))
    return out


def test_toxicity(session, docs, empty):
    made = toxic_rows()
    table = session.createDataFrame([(i, t) for i, t, _ in made], "doc_id bigint, text string")
    labels = session.createDataFrame([(i, 1, y) for i, _, y in made] + [(None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity.op3(table, labels).collect()}
    assert len(found) == len(made)
    for i, _, y in made:
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.7) == y
    machine = toxicity.train(table, labels)
    probes = session.createDataFrame([(1, "you bl0ckhead"), (2, "n u m b s k u l l indeed"), (3, "dim.wit.ted"), (4, prose(5, 40)), (5, None), (6, "")], "doc_id bigint, text string")
    assert [r["predicted"] for r in sorted(toxicity.score(probes, machine).collect())] == [1, 1, 1, 0, 0, 0]
    odd = toxicity.op3(docs, labels)
    assert odd.count() == len(rows()) and toxicity.op3(empty, labels).collect() == []
    assert toxicity.op3(docs, labels.limit(0)).where("score between 0 and 1").count() == len(rows())
    kept = toxicity.keep_clean(table, labels)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, y in made if not y}


def test_toxicity_is_not_fitted_in_the_driver(session, monkeypatch):
    made = toxic_rows()
    table = session.createDataFrame([(i, t) for i, t, _ in made], "doc_id bigint, text string")
    labels = session.createDataFrame([(i, 1, y) for i, _, y in made for _ in range(2)], "doc_id bigint, quality int, toxic int")
    kept = [(i, set(toxicity.units(t)), y) for i, t, y in made if fold(i, 3) != 1]
    clean = [words for _, words, y in kept if not y]
    counts = {w: sum(w in words for words in clean) for words in clean for w in words}
    wanted = toxicity.fit([words for _, words, y in kept if y], counts, len(clean))
    calls = []
    monkeypatch.setattr(toxicity, "fit", lambda *a, f=toxicity.fit: calls.append(a) or f(*a))  # a task has a list of its own
    machine = toxicity.train(table, labels)
    assert calls == []
    assert np.allclose(machine.weights, wanted.weights, atol=1e-4) and machine.weights.any()
    assert (machine.bias, machine.slope, machine.offset) == pytest.approx((wanted.bias, wanted.slope, wanted.offset), abs=1e-4)


def test_toxicity_in_other_scripts():
    rng = np.random.default_rng(6)
    for low_code, high in ((0x3B1, 0x3C9), (0x430, 0x44F), (0x627, 0x64A), (0x4E00, 0x9000)):
        words = ["".join(map(chr, rng.integers(low_code, high, 8))) for _ in range(240)]
        bad, clean = words[:4], words[4:]
        texts = [{*clean[i : i + 12], bad[i % 4]} for i in range(60)]
        machine = toxicity.fit(texts, {w: 5 for w in clean}, 200)
        found = toxicity.text_margins([f"{clean[0]} {b}" for b in bad] + clean, machine, {})
        predicted = machine.probability(found) >= toxicity.THRESHOLD
        assert predicted[:4].all() and predicted[4:].sum() <= 2


# -- 4 ----------------------------------------------------------------------------------------------------------------


def test_best_fit_is_tightest_compatible():
    rng = np.random.default_rng(6)
    lengths = sorted(rng.integers(1, 50, 200).tolist(), reverse=True)
    clusters, sources = rng.integers(-1, 30, 200).tolist(), rng.integers(0, 4, 200).tolist()
    free, held, wanted = [], [], []
    for n, c, s in zip(lengths, clusters, sources):
        fits = [(f, b) for b, f in enumerate(free) if f >= n and (c < 0 or c not in held[b][0]) and held[b][1].count(s) < 2]
        bin_ = min(fits)[1] if fits else len(free)
        if not fits:
            free.append(60)
            held.append(([], []))
        wanted.append((bin_, 60 - free[bin_]))
        free[bin_] -= n
        held[bin_][0].append(c)
        held[bin_][1].append(s)
    assert packing.best_fit(lengths, clusters, sources, 60, 2) == wanted


def test_packing(docs, empty):
    found = packing.op4(docs).collect()
    size = {}
    for r in rows():
        size.setdefault(r[0], []).append(len(split_words(r[1])))
    got, bins = {}, {}
    for r in found:
        got[r["doc_id"], r["copy"]] = got.get((r["doc_id"], r["copy"]), 0) + r["length"]
        if r["bin_id"] is not None:
            bins.setdefault(r["bin_id"], []).append((r["start"], r["length"], r["doc_id"]))
    totals = {}
    for (doc, _), n in got.items():
        totals.setdefault(doc, []).append(n)
    assert {k: sorted(v) for k, v in totals.items()} == {k: sorted(v) for k, v in size.items()}
    copies = {3, *range(100, 106)}
    for pieces in bins.values():
        end = 0
        for start, length, _ in sorted(pieces):
            assert start == end
            end += length
        assert end <= packing.CAPACITY
        assert len(copies & {d for _, _, d in pieces}) <= 1
    assert packing.op4(empty).collect() == []


# -- 5 ----------------------------------------------------------------------------------------------------------------


def test_lm_counts_and_base(docs, empty):
    found = lm.score(docs).collect()
    tokens = [[*split_words(low(r[1])), "\n"] for r in rows()]
    train = [t for r, t in zip(rows(), tokens) if fold(r[0], 7) != 2]
    counts = {}
    for t in train:
        for w in t:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    wanted = sorted((str(r[0]), fold(r[0], 7) == 2, len(t), sum(w in counts for w in t), n, round(sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in t), 6)) for r, t in zip(rows(), tokens))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == wanted
    assert all(r["score"] < 0 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert lm.score(empty).collect() == []
    assert lm.score(docs.where("doc_id = 403").select("doc_id", "text")).count() == 1


def test_words_of_blocks_move_by_numbers_alone(session, docs, monkeypatch):
    made, moved = [], []
    monkeypatch.setattr(lm, "written", lambda df, write=lm.written: made.append(write(df)) or made[-1])
    join = type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda self, other, on=None, how=None: moved.append(self.columns) or join(self, other, on, how))
    found = lm.score(docs)
    assert made[0].schema["block"].dataType.simpleString() == "bigint" and ["asked_by", "place", "word"] in moved
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in found.collect():
        size = sum(len(w.encode()) + 1 for w in split_words(low(texts[r["doc_id"]]))) + 2
        assert abs(r["bits_per_byte"] + r["score"] * np.log2(10) / size) < 1e-9


def test_spellings_are_a_distribution():
    words = [w.encode() for w in "the then than that this those these there".split()]
    n0, n1 = np.zeros((2, len(lm.ORDERS), 1 << lm.TABLE_BITS), np.int32)
    slots, bit, _, _ = lm._bits(words)
    for k in range(len(lm.ORDERS)):
        np.add.at(n0[k], slots[k][bit == 0], 1)
        np.add.at(n1[k], slots[k][bit == 1], 1)
    mixer, by_gate, by_bin = lm.tune(n0, n1, words)
    mixer.adaptive = np.clip(mixer.adaptive, 1e-5, 1 - 1e-5)
    assert by_gate.sum() == 2 * len(bit) and by_bin.sum() == len(bit)
    single = [bytes([b]) for b in range(1, 256)] + [b""]
    two = [bytes([116, b]) for b in range(1, 256)]
    p = 10 ** mixer.words(single)
    assert p.sum() < 1
    assert (10 ** mixer.words(two)).sum() < 1 - p.sum()
    assert mixer.words([b"the"])[0] > mixer.words([b"qzx"])[0]
    alone = mixer.words([b"that"])
    assert np.allclose(mixer.words([b"some", b"that", b"x"])[1], alone)  # a spelling does not depend on its neighbours


def naive_tune(n0, n1, words, warm):
    """Bit by bit, with dictionaries: counts without the word itself, mixing by gate, steps after each 200 words."""
    weights, adaptive = {}, {}
    centre = lambda b: 1 / (1 + np.exp(-((b - lm.BINS // 2) / 2)))
    plan = [(0, words[:warm]), (1, words[:warm]), (1, words[warm:])]
    for turn, chosen in plan:
        for low in range(0, len(chosen), 200):
            steps, places = {}, {}
            for word in chosen[low : low + 200]:
                slots, bits, at, _ = lm._bits([word])
                for i, bit in enumerate(bits.tolist()):
                    own = [(int(n0[k][slots[k, i]]) - (bit == 0), int(n1[k][slots[k, i]]) - (bit == 1)) for k in range(len(lm.ORDERS))]
                    x = [np.log((max(b, 0) + 0.4) / (max(a, 0) + 0.4)) for a, b in own]
                    gate = min(int(at[i]), lm.PLACES - 1) * (len(lm.ORDERS) + 1) + sum(a + b > 0 for a, b in own)
                    mixed = sum(w * v for w, v in zip(weights.get(gate, [0.35] * len(x)), x))
                    error = bit - 1 / (1 + np.exp(-mixed))
                    steps.setdefault(gate, []).append([error * v for v in x])
                    places.setdefault((gate, int(np.clip(np.rint(mixed * 2 + lm.BINS // 2), 0, lm.BINS - 1))), []).append(bit)
            for gate, each in steps.items():
                old = weights.get(gate, [0.35] * len(each[0]))
                weights[gate] = [w + 0.15 / (1 + turn) * sum(e[k] for e in each) / max(len(each), 20) for k, w in enumerate(old)]
            if turn or low >= len(chosen) // 2:
                for (gate, b), each in places.items():
                    old = adaptive.get((gate, b), centre(b))
                    adaptive[gate, b] = old + (1 - (1 - lm.RATE) ** len(each)) * (np.mean(each) - old)
    return weights, adaptive


def test_mixer_against_a_naive_one_and_mean_over_groups(session):
    words = sorted({f"{a}{b}".encode() for a in "ab abc the then st".split() for b in range(90)})
    n0, n1 = lm.counted(session.createDataFrame([(bytearray(w),) for w in words], "word binary"), len(words))
    wanted0, wanted1 = np.zeros((2, len(lm.ORDERS), 1 << lm.TABLE_BITS), np.int32)
    slots, bit, _, _ = lm._bits(words)
    for k in range(len(lm.ORDERS)):
        np.add.at(wanted0[k], slots[k][bit == 0], 1)
        np.add.at(wanted1[k], slots[k][bit == 1], 1)
    assert (n0 == wanted0).all() and (n1 == wanted1).all()
    mixer, by_gate, _ = lm.tune(n0, n1, words, 150)
    weights, adaptive = naive_tune(n0, n1, words, 150)
    assert set(np.flatnonzero(by_gate)) == set(weights)
    for gate, w in weights.items():
        assert np.allclose(mixer.weights[gate], w, atol=2e-3)
    close = [abs(mixer.adaptive[g * lm.BINS + b] - v) for (g, b), v in adaptive.items()]
    assert np.mean(np.array(close) < 0.01) > 0.98  # a mix on the border of two bins may fall into either

    table = session.createDataFrame([(bytearray(w),) for w in words], "word binary").repartition(4)
    dealt = {bytes(r["word"]): (r["g"], r["rank"]) for r in table.selectExpr("word", f"pmod(xxhash64(word, {lm.SEED}), 3) AS g", f"xxhash64(word, {lm.SEED + 1}) AS rank").collect()}
    parts = [lm.tune(n0, n1, sorted((w for w in words if dealt[w][0] == g), key=lambda w: (dealt[w][1], w)), 60) for g in range(3)]
    found = lm.learn(table, len(words), 200, 60)  # three groups
    hits = sum(p[1] for p in parts)
    mean = sum(p[0].weights * p[1][:, None] for p in parts) / np.maximum(hits, 1)[:, None]
    assert np.allclose(found.weights[hits > 0], mean[hits > 0], atol=1e-5) and np.allclose(found.weights[hits == 0], 0.35)
    assert (found.weights == lm.learn(table.repartition(7), len(words), 200, 60).weights).all()


def test_language_classes_come_from_training_rows(session, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "_blocks", lambda langs, made=lm._blocks: seen.append(langs) or made(langs))
    held = [i for i in range(400) if fold(i, 7) == 2][:40]
    rows = [(i, "some words here", "held") for i in held] + [(i, "other words there", "train") for i in range(400) if fold(i, 7) != 2][:20]
    assert lm.score(session.createDataFrame(rows, "doc_id bigint, text string, lang string")).count() == 60
    assert seen == [["train"]]


def test_bits_of_many_and_of_long_words_are_held_in_pieces():
    import tracemalloc

    rng = np.random.default_rng(3)
    long = bytes(rng.integers(97, 123, 3 * 16_384 + 5).astype(np.uint8))
    words = [f"word{i * 7919}".encode() for i in range(20_000)] + [long, b"", long[:16_383], long[:16_384]]
    rows = [pa.record_batch({"word": pa.array(words[i : i + 1000], pa.binary())}) for i in range(0, len(words), 1000)]

    def peak(run):
        tracemalloc.start()
        try:
            return run(), tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    def counts():
        table = np.zeros((len(lm.ORDERS) << (lm.TABLE_BITS - lm.RANGE_BITS), 2 << lm.RANGE_BITS), np.int32)
        for batch in lm._count(iter(rows)):
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                table[part] = np.frombuffer(zlib.decompress(packed), np.int32)
        return np.moveaxis(table.reshape(len(lm.ORDERS), -1, 2), 2, 0)

    (n0, n1), mb = peak(counts)
    assert mb < 80  # of which the two tables are 50; 20,000 words at once took 171
    whole = np.zeros((2, len(lm.ORDERS), 1 << lm.TABLE_BITS), np.int32)
    slots, bit, place, _ = lm._bits(words)
    for k in range(len(lm.ORDERS)):
        np.add.at(whole[0][k], slots[k][bit == 0], 1)
        np.add.at(whole[1][k], slots[k][bit == 1], 1)
    assert (n0 == whole[0]).all() and (n1 == whole[1]).all()

    mixer = lm.untuned(n0, n1)
    found, mb = peak(lambda: mixer.words([long * 4] * 8))
    assert mb < 40 and len(set(found.tolist())) == 1  # 1.6 million bytes of words
    found = mixer.words(words)
    assert np.allclose(found[-4:], [mixer.words([w])[0] for w in words[-4:]], rtol=1e-12)
    gate = mixer._gate(place, sum(mixer.seen[k][slots[k]].astype(np.int64) for k in range(len(lm.ORDERS))))
    mixed = sum(mixer.weights[gate, k] * mixer.stretched[k][slots[k]] for k in range(len(lm.ORDERS)))
    p = (1 / (1 + np.exp(-mixed)) + mixer.adaptive[mixer._bin(mixed, gate)]) / 2
    assert np.isclose(found.sum(), np.log10(np.where(bit == 1, p, 1 - p)).sum(), rtol=1e-9)
    assert peak(lambda: lm.tune(n0, n1, [long] * 3, 1))[1] < 120  # of which copies of the tables are most


def test_texts_of_a_block_are_scored_a_few_at_a_time(docs, monkeypatch):
    wanted = {str(r): r for r in lm.score(docs).collect()}

    def few(number, text, work=lm._earlier):
        if len(number) > 20 and text.max() > 0:
            raise ValueError(f"{len(number)} words of several texts at once")
        return work(number, text)

    monkeypatch.setattr(lm, "_earlier", few)
    monkeypatch.setattr(lm, "PIECE_TOKENS", 20, raising=False)
    assert {str(r): r for r in lm.score(docs).collect()} == wanted


# -- 6 ----------------------------------------------------------------------------------------------------------------


def test_sketches(docs, empty):
    found = sketch.op6(docs).collect()
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0]), reverse=True)
    by = {}
    for r in found:
        by.setdefault(r["doc_id"], []).append(r)
    for row, after in zip(order, [*order[1:], order[0]]):
        text, other = row[1] or "", after[1] or ""
        half = len(text) // 2
        digest = hashlib.sha256((text[: len(text) - half] + other[:half]).encode()).hexdigest()
        assert any(r["edited_sha256"] == digest and r["n_chars"] == len(text) for r in by[row[0]]) or row[0] == 7 or after[0] == 7
    prints = {}
    for r in rows():
        prints.setdefault(r[1] or "", set()).update(x["fingerprint"] for x in by[r[0]])
    assert all(len(p) == 1 for p in prints.values())
    assert sketch.op6(empty).collect() == []
    one = sketch.op6(docs.where("doc_id = 403")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_sketch_estimates():
    words = prose(1, 6000).split()
    a, b = " ".join(words), " ".join(words[:1500])
    x, y = sketch.Sketch.of(a), sketch.Sketch.of(b)
    assert y.inside(x) == pytest.approx(1, abs=0.05) and x.inside(y) == pytest.approx(0.25, abs=0.12)
    assert x.likeness(x) == 1 and sketch.Sketch.of("").likeness(sketch.Sketch.of(None)) == 1 and sketch.Sketch.of("").likeness(x) == 0
    again = sketch.Sketch.unpack(x.pack())
    assert again.text() == x.text()
    halves = sketch.Sketch.of(" ".join(words[:3004])).merge(sketch.Sketch.of(" ".join(words[3000:])))
    assert halves.text() == x.text()


# -- 7 ----------------------------------------------------------------------------------------------------------------


def test_lcs_against_table():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = (["xyzuvw"[i] for i in rng.integers(0, 6, rng.integers(0, 14))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        shared = pages.common(a, b)
        assert len(shared) == best[-1, -1]
        rest = iter(b)
        assert all(x in rest for x in (a[i] for i in sorted(shared)))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li>Menu</li></ul></nav>
<!-- x --><div class="ad">Buy</div><article><h1>Title &amp; more</h1><p><b>First &lt;one&gt;<br><p>Second   one
 here</p><form><input>Send</form><div class="comments">Nice!</div><p>Third &eacute;</article><aside>Side</aside><footer>&copy; x"""


def test_blocks():
    inside = [t for t, k in pages.blocks(PAGE) if k == pages.INSIDE]
    assert inside == ["Title & more", "First <one>", "Second one here", "Third é"]


@pytest.mark.parametrize("page", [
    '<body class="no-sidebar"><article><p>Story</p></article></body>',
    '<body id="menu"><main class="has-sidebar"><p>Story</p></main><div class="sidebar">Side</div></body>',
    '<div id="header-fixed"><main><p>Story</p></main></div>',
    '<article class="post comments-open"><p>Story</p><div class="comments"><article class="comment">Nice</article></div></article>',
    '<form id="all"><div class="social"><article><p>Story</p><form><label>Send</label></form></article></div></form>',
    '<article><div class="article-header"><p>Story</p></div><div class="share-bar">Share</div></article>',
    '<div class="widget"><main><p>Story</p></main></div><div class="related"><article>Other</article></div><nav>Menu</nav>',
])
def test_marked_wrappers(page):
    assert [t for t, k in pages.blocks(page) if k == pages.INSIDE] == ["Story"]


def test_marked_parts_and_bare_forms():
    assert [t for t, k in pages.blocks('<p>Story</p><div class="navbar navbar-fixed-top">Home</div><div id="cookie_notice">Yes</div><form>Go</form>') if k == pages.OUTSIDE] == ["Story"]
    assert [t for t, k in pages.blocks('<form id="aspnet"><p>Story</p><nav>Menu</nav></form>') if k == pages.OUTSIDE] == ["Story"]
    assert [t for t, k in pages.blocks('<article><p>Story</p></article><div id="comments"><article>Nice</article></div>') if k == pages.INSIDE] == ["Story"]


def test_pages(session):
    plain = "<body><div>Site name</div><p>Story {0}</p><p>More of {0}</p><div>All rights reserved</div></body>"
    made = [(i, f"http://h.example/a/{i}", plain.format(i)) for i in range(6)]
    made += [(10, "http://i.example/", plain.format(10)), (11, None, PAGE), (12, "nonsense", None), (13, "http://h.example/z", ""), (1, "http://h.example/a/1", plain.format(1))]
    made = [(*m, "x", "y") for m in made]
    table = session.createDataFrame(made, "page_id bigint, url string, html string, text string, key string")
    found = {r["page_id"]: r for r in pages.extract(table).collect()}
    assert pages.extract(table).count() == len(made)
    for i in (0, 2, 3, 4, 5):
        assert found[i]["text"] == f"Story {i}\n\nMore of {i}"
    assert found[10]["text"].startswith("Site name") and found[10]["n_chars"] == len(found[10]["text"])
    assert found[11]["text"] == "Title & more\n\nFirst <one>\n\nSecond one here\n\nThird é"
    assert found[12]["text"] == "" and found[13]["n_chars"] == 0
    assert pages.extract(table.limit(0)).collect() == []


def test_articles_are_differenced_with_their_nearest_page(session):
    page = "<html><body><nav>Menu</nav><article><h1>Story {0}</h1><p>{1} told in some words</p>{2}<div>Read this story on our site, too.</div></article></body></html>"
    quoted = "<blockquote>Passage that two neighbours quote</blockquote>"
    made = [(i, f"http://a.example/n/{i}", page.format(i, prose(600 + i, 30), quoted if i in (2, 3) else "")) for i in range(7)]
    copied = page.format(77, prose(77, 40), "")
    made += [(20 + i, f"http://b.example/{i}", copied.replace("<div>", f"<p>Edition {i}</p><div>")) for i in range(6)]  # near copies alone on their host
    bare = "<body><div>Site name</div><p>Story {0}</p><div>All rights reserved</div></body>"
    made += [(30 + i, f"http://c.example/{i}", bare.format(i)) for i in range(5)] + [(40, "http://c.example/4/print", bare.format(4)), (36, "http://d.example/x", bare.format(6)), (36, "http://d.example/x", bare.format(6))]
    table = session.createDataFrame(made, "page_id bigint, url string, html string")
    found = {r["page_id"]: r["text"].split("\n\n") for r in pages.extract(table).collect()}
    for i in range(7):  # the site's line goes, the passage two pages quote stays
        assert found[i] == [f"Story {i}", f"{prose(600 + i, 30)} told in some words", *(["Passage that two neighbours quote"] if i in (2, 3) else [])]
    for i in range(6):
        assert found[20 + i] == ["Story 77", f"{prose(77, 40)} told in some words", f"Edition {i}", "Read this story on our site, too."]
    assert found[34] == found[40] == ["Story 4"] and found[32] == ["Story 2"]  # a copy for neighbour does not empty a page
    assert found[36] == ["Site name", "Story 6", "All rights reserved"] and pages.extract(table).count() == len(made)


def test_nearest_against_all_pairs_of_a_host(session):
    rng = np.random.default_rng(3)
    made = sorted({(f"h{rng.integers(0, 3)}", "/" + "/".join("ab"[i] * int(rng.integers(1, 3)) for i in rng.integers(0, 2, rng.integers(1, 5)))) for _ in range(60)})
    table = session.createDataFrame([(i, h, p) for i, (h, p) in enumerate(made)], "key bigint, host string, path string")
    found = {r["key"]: r["partner"] for r in pages.nearest(table).collect()}
    start = lambda x, y: next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    for i, (host, path) in enumerate(made):
        rivals = [(start(path, p), -j) for j, (h, p) in enumerate(made) if h == host and j != i]
        assert (max(rivals)[0] == start(path, made[found[i]][1]) and made[found[i]][0] == host) if rivals else i not in found


# -- 8 ----------------------------------------------------------------------------------------------------------------


def brute_simhash(text):
    words = split_words(low(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints, radius=4):
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_simhash(docs, empty):
    found = simhash.op8(docs).collect()
    ids = [r[0] for r in rows()]
    prints = [brute_simhash(r[1]) for r in rows()]
    root = brute_components(prints)
    least = {r: min((i for i, x in zip(ids, root) if x == r and i is not None), default=None) for r in set(root)}
    wanted = sorted((str(i), f"{p:016x}", least[r]) for i, p, r in zip(ids, prints, root))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in found) == wanted
    assert simhash.op8(empty).collect() == []
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert len(left) == len(set(left)) and {least[r] is None for r in root} and len([i for i in left if i is not None]) == len({x for x, i in zip(root, ids) if i is not None})


@pytest.mark.parametrize("limit", [4096, 20])
def test_links_in_crowded_cells(session, limit):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 30, dtype=np.uint64)
    prints = {int(c) for c in centres}
    for c in centres[:5]:
        for _ in range(120):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(1, 7)):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    table = session.createDataFrame([(s,) for s in signed], "fp bigint")
    roots = {r["node"]: r["root"] for r in components(simhash.links(table, limit=limit)).collect()}
    wanted = brute_components(prints)
    groups, expected = {}, {}
    for s, w in zip(signed, wanted):
        groups.setdefault(roots.get(s, s), set()).add(s)
        expected.setdefault(w, set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def brute_shingles(text):
    words = split_words(low(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("limit", [512, 7])
def test_pipeline_drops_edited_copies(session, limit):
    made = []
    for g in range(12):
        base = prose(4000 + g, 120).split()
        made.append((100 * g, " ".join(base)))
        for k in range(1, 5):  # one edit costs ten shingles of 232 in both: k edits reach 0.92, 0.84, 0.77, 0.71
            edited = list(base)
            for e in range(k):
                edited[8 + 20 * e + g] = f"changed{k}x{e}"
            made.append((100 * g + k, " ".join(edited)))
    made += [(9000, None), (9001, ""), (9002, "two words"), (9003, "Two  words"), (9004, "two other")]
    sets = [brute_shingles(t) for _, t in made]
    root = list(range(len(made)))
    for i in range(len(made)):
        for j in range(i):
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    table = session.createDataFrame(made, "doc_id bigint, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in likeness.near_duplicates(table, limit=limit).collect()}
    assert found == {made[i][0]: made[root[i]][0] for i in range(len(made))}
    import corpus_pipeline

    if limit == 512:
        assert corpus_pipeline.near_dedup(session, table, "").count() == len(set(root))
        assert likeness.near_duplicates(table.limit(0)).collect() == []


def test_near_dedup_goes_through_the_fingerprint_grid(session, monkeypatch):
    import corpus_pipeline

    base = prose(4400, 900).split()
    made = [(0, " ".join(base)), (1, " ".join([*base[:400], "changed", *base[401:]])), (2, prose(4401, 900)), (3, "two words"), (4, None), (5, "")]
    table = session.createDataFrame(made, "doc_id bigint, text string")
    monkeypatch.setattr(likeness, "bands", lambda hashes: np.array([xxhash.xxh64_intdigest(hashes.tobytes())], np.uint64).view(np.int64))  # brings none together
    wanted = {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4}
    rows = likeness.marked(table).collect()
    prints = {r["doc_id"]: r["fp"] for r in rows}
    assert 0 < bin((prints[0] ^ prints[1]) % 2**64).count("1") <= likeness.RADIUS and prints[4] == 0
    cells = [set(r["cells"]) for r in rows if r["doc_id"] < 2]
    assert not cells[0] & cells[1]
    assert {r["doc_id"]: r["component_id"] for r in likeness.near_duplicates(table).collect()} == wanted
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(session, table, "").collect()) in ([0, 2, 3, 4], [1, 2, 3, 4])


def test_components_of_a_chain(session):
    edges = session.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 100), (5, 5)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
    assert components(edges.limit(0)).collect() == []


# -- 9 ----------------------------------------------------------------------------------------------------------------


def test_line_dedup(docs, empty):
    found = lines.op9(docs)
    db = duckdb.connect()
    documents = docs.toPandas().astype({"doc_id": "Int64"})
    db.register("documents", documents)
    names = ["doc_id", "lines_removed", "kept_chars", "kept_md5"]
    wanted = db.execute(f"SELECT {', '.join(names)} FROM ({lines.SQL_OP9})").fetchall()
    assert sorted(map(str, (tuple(r) for r in found.select(*names).collect()))) == sorted(map(str, wanted))
    assert lines.op9(empty).collect() == []
    kept = lines.dedup_lines(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    texts = {r["doc_id"]: r for r in kept.collect()}
    assert "many sites" in texts[300]["text"] and texts[300]["text"].count("many sites") == 1
    assert "many sites" not in texts[304]["text"] and texts[304]["n_chars"] == len(texts[304]["text"])
    assert texts[400]["text"] is None and texts[1]["n_chars"] == 1


def test_spread_estimates(session):
    made = [(n, i) for n in (1, 2, 5, 40, 300, 3000) for i in range(n)]
    table = session.createDataFrame(made, "line bigint, number bigint").select("line", F.xxhash64("number").alias("site"))
    for r in lines.spread(table).collect():
        assert r["estimate"] == pytest.approx(r["line"], rel=0.4)


@pytest.mark.parametrize("registers", [16, 256])
def test_boilerplate_equals_exact_counts_at_every_threshold(session, monkeypatch, registers):
    monkeypatch.setattr(lines, "REGISTERS", registers)
    monkeypatch.setattr(lines, "ALPHA", 0.673 if registers == 16 else lines.ALPHA)
    sizes = [1, 2, 3, 4, 5, 6, 7, 9, 12, 15, 16, 17, 20, 28, 40, 64, 90, 120, 200, 320, 500]
    made = [(1000 * k + n, i) for k in range(6) for n in sizes for i in range(n)] + [(7, i % 3) for i in range(60)]
    table = session.createDataFrame(made, "line bigint, number bigint").select("line", F.xxhash64("line", "number").alias("site"))
    counts = {r["line"]: r["n"] for r in table.groupBy("line").agg(F.count_distinct("site").alias("n")).collect()}
    for sites in (1, 2, 6, 16, 40, 150):
        assert {r["line"] for r in lines.boilerplate(table, sites).collect()} == {line for line, n in counts.items() if n >= sites}
    assert "estimate" in lines.spread(table).columns and lines.settled(6) == pytest.approx(registers * np.log(registers / (registers - 6)))


def test_sites_that_share_registers(session):
    names = session.range(3000).select(F.concat(F.lit("site"), "id").alias("source")).withColumn("register", F.xxhash64("source").bitwiseAND(F.lit(lines.REGISTERS - 1)))
    sites = [r["source"] for r in names.where("register < 2").orderBy("source").limit(6).collect()]
    made = [(i, f"text {i}\na line of six sites in two registers", s) for i, s in enumerate(sites)] + [(9, "text\nfive sites only", "x")]
    made += [(10 + i, f"other {i}\nfive sites only", s) for i, s in enumerate(sites[:4])]
    table = session.createDataFrame(made, "doc_id bigint, text string, source string")
    assert {r["doc_id"]: r["lines_removed"] for r in lines.op9(table).collect()} == {m[0]: int(m[0] in range(1, 6)) for m in made}


def test_repeated_passages(session):
    one, two, short = prose(70, 50), prose(71, 60), prose(72, 49)
    made = [(1, f"a\n{one}\nb", "s1"), (2, f"c\n {one}", "s2"), (3, f"{two}\n{short}", "s1"), (4, f"d\n{two}\n{short}", "s1"), (5, prose(73, 80), "s1"), (5, prose(73, 80), "s1")]
    table = session.createDataFrame(made, "doc_id bigint, text string, source string")
    wanted = [(1, made[0][1]), (2, "c"), (3, made[2][1]), (4, f"d\n{short}"), (5, made[4][1]), (5, made[4][1])]
    assert sorted((r["doc_id"], r["text"]) for r in lines.dedup_lines(table).collect()) == wanted
    assert all(r["lines_removed"] == 0 for r in lines.op9(table).collect())  # op9 is held to its SQL


# -- 10 ---------------------------------------------------------------------------------------------------------------


def test_neighbours(session):
    rng = np.random.default_rng(12)
    centre = rng.normal(size=(20, 16))
    data = (centre[rng.integers(0, 20, 1500)] + 0.4 * rng.normal(size=(1500, 16))).astype(np.float32)
    data[700:760] = data[0]
    made = [(i, v.tolist(), 1, 2) for i, v in enumerate(data)]
    odd = [(2000, None, 0, 0), (2100, [0.0] * 16, 0, 0), (2200, [None, 1.0], 0, 0), (2300, [float("nan")] * 16, 0, 0), (2400, [float("inf")] * 16, 0, 0), (None, [1.0] * 16, 0, 0), (2500, [1.0, 2.0], 0, 0), (2501, [1.0, 2.5], 0, 0), (0, data[0].tolist(), 1, 2)]
    table = session.createDataFrame(made + odd, "vec_id bigint, embedding array<float>, label int, score int")
    good = vectors.usable(table)
    found = {}
    for r in vectors.search(vectors.index(good, 10, shard=400), good.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "vector"), 10).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {*range(0, 1500, 100), 2500}
    hits = total = 0
    wide = data.astype(float)
    for q in range(0, 1500, 100):
        distance = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        best = sorted((d, i) for i, d in enumerate(distance.tolist()) if i != q)[:10]
        got = sorted(found[q])
        assert [r for r, _, _ in got] == list(range(1, 11)) and [s for _, _, s in got] == sorted(s for _, _, s in got)
        assert all(abs(distance[i] - s) < 1e-12 for _, i, s in got)
        hits += len({i for _, i in best} & {i for _, i, _ in got})
        total += 10
    assert hits >= 0.95 * total
    assert sorted(found[0])[:2] == [(1, 700, 0.0), (2, 701, 0.0)]
    assert found[2500] == [(1, 2501, 0.5)]
    assert vectors.op10(table.limit(0)).collect() == []


# -- pipeline -----------------------------------------------------------------------------------------------------------


def test_pipeline(session, tmp_path):
    import corpus_pipeline

    made = [(i, t, "en", f"s{i % 7}", len(t)) for i, t, _ in toxic_rows()]
    made += [(1000 + i, made[1][1], "en", f"s{i % 3}", 1) for i in range(5)] + [(2000, None, None, None, None), (2001, "", "en", "s1", 0)]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    session.createDataFrame(made, columns).write.parquet(f"{tmp_path}/documents.parquet")
    session.createDataFrame([(i, 1, y) for i, _, y in toxic_rows()], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = session.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(session, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    out = corpus_pipeline.run(session, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in out}
    assert ids and not ids & {i for i, _, y in toxic_rows() if y}
    assert len(ids & {1, *range(1000, 1005)}) <= 1
    spread = session.createDataFrame([], columns)
    for _, stage in corpus_pipeline.STAGES:
        spread_out = stage(session, spread, str(tmp_path))
        assert spread_out.collect() == []


def test_pieces_equal_whole_texts_whatever_is_remembered(monkeypatch):
    """Words, their signs, apostrophes, digits and odd white space, met for the first time, again and after forgetting."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    parts = ["naïve,", "Straße.", "don't", "it's,", "x1y", "word", "word,", "word))", "'tis", "...", "œuvre!?", "中文", "a", "été#", "İd", "ǆ:", "<|endoftext|>", "ª", "end\\", "12,5"]
    rng = np.random.default_rng(3)
    texts = ["".join(parts[i] + [" ", "\n", " ", "  ", "\t "][rng.choice(5, p=[0.7, 0.15, 0.1, 0.03, 0.02])] for i in rng.integers(0, len(parts), 40)) for _ in range(300)]
    texts += [" ".join(parts), "\n".join(parts), "", " ", "\n"]
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for memory in (10**6, 7):
        monkeypatch.setattr(token_ids, "PIECES", memory)
        encoder = token_ids.PieceEncoder(path)
        assert [ids for low in range(0, len(texts), 20) for ids in encoder.encode(texts[low : low + 20])] == expected
        assert encoder.encode(texts) == expected


def test_the_library_gets_a_piece_once_whatever_stands_beside_it():
    """Words under signs and beside all white space: almost nothing of the texts goes to the library, and nothing again."""
    import public_tokenizers

    encoder = token_ids.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer, given = encoder.tokenizer, []

    class Spy:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    rng = np.random.default_rng(4)
    words, signs, spaces = [f"{a}{b}" for a in ("wor", "été", "Straß", "12") for b in ("da", "ne", "ê", "7")], ["", ",", ".", "!!", "%%%"], [" ", " ", "  ", " \n", "\n\n", "\t "]
    texts = ["".join(words[rng.integers(16)] + signs[rng.integers(5)] + spaces[rng.integers(6)] for _ in range(200)) for _ in range(300)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder.tokenizer = Spy()
    assert encoder.encode(texts) == expected
    assert 0 < sum(map(len, given)) < sum(map(len, texts)) / 50
    given.clear()
    assert encoder.encode(texts[::-1]) == expected[::-1] and not given


@pytest.mark.parametrize("memory", [10**6, 50])
def test_pieces_of_odd_texts(monkeypatch, memory):
    """Any white space, controls, signs and whole or broken special strings beside each other; long pieces; pools of few bytes."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(token_ids, "PIECES", memory)
    monkeypatch.setattr(token_ids, "POOL_BYTES", 3000)
    rng = np.random.default_rng(11)
    spaces = [*"\t\n\v\f\r\x1c\x1f  \n\x85\xa0\xad\u1680\u180e\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff\0"]
    parts = ["a", "word", "é", "×", "'s", "'re", "'", "don't", "12", "5", "٣", "²", "ª", ".", "!!", "—", "“", "…", "中", "😀", "\u0301", "\x7f", "İ", "x" * 150]
    parts += ["<|endoftext|>", "<|", "|>", "endoftext", "<|endoftext", "<|<|endoftext|>|>", "a<|endoftext|>,"]
    texts = ["".join((spaces if rng.random() < (0.1, 0.4, 0.8)[i % 3] else parts)[int(rng.integers(25))] for _ in range(rng.integers(25))) for i in range(6000)]
    texts += ["".join(parts[int(rng.integers(len(parts)))] for _ in range(rng.integers(12))) for _ in range(2000)] + [None, ""]
    encoder, found = token_ids.PieceEncoder(path), []
    rows = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    for ids, some in token_ids._pools(iter([rows.slice(0, 5), rows.slice(5, 0), rows.slice(5)])):
        flat, ends = encoder.ids(some)
        found += zip(ids, [x.tolist() for x in np.split(flat, ends)])
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert found == list(enumerate(expected))


def test_every_word_holds_as_many_ids_as_fit():
    rng = np.random.default_rng(12)
    for _ in range(30):
        n = int(rng.integers(1, 1500))
        ids = rng.integers(0, 2**64 - 1, n, dtype=np.uint64, endpoint=True) >> rng.integers(0, 64, n).astype(np.uint64)
        ids[rng.random(n) < 0.95] = 0
        at, held = 0, []
        while at < n:
            left = min(token_ids.BLOCK - at % token_ids.BLOCK, n - at)
            s = next((s for s, (count, bits) in enumerate(token_ids.PACKING) if (ids[at : at + min(count, left)] < 1 << bits).all()), token_ids.ESCAPE)
            held += [s] if s < token_ids.ESCAPE else [s, None]
            at += min(token_ids.PACKING[s][0], left) if s < token_ids.ESCAPE else 1
        words, _, raw = token_ids.encode(ids)
        assert [None if i in set(raw.tolist()) else int(w) >> 60 for i, w in enumerate(words)] == held


def shingles(text, size=5):
    tokens = low(text).encode().split()
    return {b" ".join(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))} if tokens else set()


def test_sketch_estimates_stay_within_the_stated_error_of_exact_sets():
    rng = np.random.default_rng(12)
    far = []
    for _ in range(150):
        n = int(rng.integers(60, 3000))
        tokens = [f"w{i}" for i in rng.integers(0, 10**6, n)]
        other = tokens[: int(n * rng.random())] + [f"v{i}" for i in rng.integers(0, 10**6, int(rng.integers(1, 3000)))]
        a, b = " ".join(tokens), " ".join(other)
        x, y, p, q = sketch.Sketch.of(a), sketch.Sketch.of(b), shingles(a), shingles(b)
        union = len(p | q)
        for found, exact, size in ((x.likeness(y), len(p & q) / union, union), (x.inside(y), len(p & q) / len(p), len(p))):
            far.append((found - exact) / max(np.sqrt(7 * max(exact * (1 - exact), 1 / size) / size), 1e-9))
    assert np.abs(far).max() < 5 and 0.6 < np.std(far) < 1.3
    # the kept hashes are those of the fraction, whatever the length of the text
    for n in (3, 40, 5000):
        text = " ".join(f"w{i}" for i in range(n))
        hashes = {xxhash.xxh64_intdigest(s, sketch.SEED) >> 32 for s in shingles(text)}
        assert sketch.Sketch.of(text).hashes.tolist() == sorted(h for h in hashes if h < 2**32 / 8)
    coarse = sketch.Sketch.of(text, fraction=1 / 64)
    assert 0 < len(coarse.hashes) < len(sketch.Sketch.of(text).hashes) and coarse.likeness(sketch.Sketch.of(text)) == 1


def test_sketch_of_a_very_long_text_and_of_texts_without_hashes(session):
    long = " ".join(f"w{i % 70_000}" for i in range(150_000))
    rows = [(3, long), (2, "two words"), (1, "Two  Words"), (0, "other words")]
    found = {r.doc_id: r for r in sketch.op6(session.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    exact = shingles(long)
    changed = shingles(sketch.edited(long, "two words"))
    assert found[3].near_edited == pytest.approx(len(exact & changed) / len(exact | changed), abs=0.02)
    empty = [r for r in (found[2], found[1], found[0]) if len(r.fingerprint) == 10]
    assert {r.near_next for r in empty} <= {0.0, 1.0}
    if len(found[2].fingerprint) == 10 and len(found[1].fingerprint) == 10:
        assert found[2].near_next == 1.0
