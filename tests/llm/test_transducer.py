"""Token counts of the compiled transducers against the tokenizer library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lossgrid.llm import transducer
from lossgrid.llm.common import prepared

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "e", "s", "t", "'", "re", "'ll", "'ve", "'s", "'r", "'l", "x'v", " ", "  ", "\n", "\t", "　", " ", "1", "23", "é", "中文", "🎉", "!", "...", "_",
    "<|endoftext|>", "<|endof", "the", "ing", " of", "​", "\x1c", "\x85", "٣", "²", "ǅ", "\x00",
]


@pytest.fixture(scope="module")
def counter():
    return transducer._counter(PATH, transducer._classes(PATH))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, texts):
    return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def texts(n, seed):
    rng = random.Random(seed)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    odd = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(30)) for _ in range(n // 4)]
    return mixed + odd


def test_counts_equal_the_library(counter, tokenizer):
    some = texts(3000, 5)
    n_bytes, n_tokens = counter.counts(some)
    assert n_tokens.tolist() == expected(tokenizer, some)
    assert n_bytes.tolist() == [len(t.encode()) for t in some]


def test_pieces_longer_than_a_chunk(counter, tokenizer):
    rng = random.Random(3)
    some = ["a" * n for n in (511, 512, 513, 1025, 9000)] + ["ab" * 4000, "-" * 5000, " " * 3000 + "x", "\n" * 2000, "中" * 3000, "é" * 1501, "'" * 1700 + "re"]
    some += ["".join(rng.choice("abcdefghij") for _ in range(9000)), "the" * 3000 + " " + "of" * 2000]
    assert counter.counts(some)[1].tolist() == expected(tokenizer, some)


def test_long_texts_are_cut_without_a_trace(counter, tokenizer, monkeypatch):
    some = [" ".join(texts(40, 9)), "word's  end\n " * 300]
    monkeypatch.setattr(transducer, "SEGMENT_CHARS", 50)
    monkeypatch.setattr(transducer, "POOL_BYTES", 300)
    assert counter.counts(some)[1].tolist() == expected(tokenizer, some)


def test_a_table_that_starts_again_gives_the_same(tokenizer, monkeypatch):
    monkeypatch.setattr(transducer, "MOST_STATES", 50)
    fresh = transducer.Counter(PATH, transducer._classes(PATH))
    some = texts(300, 11)
    for low in range(0, len(some), 25):
        assert fresh.counts(some[low : low + 25])[1].tolist() == expected(tokenizer, some[low : low + 25])


def test_chunk_maps_compose_as_one_run():
    rng = np.random.default_rng(2)
    classes = rng.integers(0, len(transducer.CLASSES), 5000).astype(np.uint8)
    state, starts = 0, np.zeros(len(classes), bool)
    for i, c in enumerate(classes):
        mark = transducer.MARK[state, c]
        starts[i] |= bool(mark & transducer.HERE)
        if mark & transducer.BEFORE:
            starts[i - 1] = True
        state = transducer.STEP[state, c]
    starts |= classes == transducer.CLASSES["end"]
    assert (transducer.piece_starts(classes) == starts).all()


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        transducer._classes(public_tokenizers.path("word_bpe_49k.json"))


def test_rows_with_nulls_repeats_and_other_columns(spark, tokenizer):
    session = prepared(spark)
    long = "many words, " * 20_000
    rows = [(1, "a word", "x", 3), (1, "a word", "x", 3), (2, None, None, None), (None, "no id", "y", 1), (3, "", "", 0), (4, long, "", 1), (5, "<|endoftext|>", "", 1)]
    docs = session.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, over_limit int")
    found = sorted(map(tuple, transducer.token_counts(docs, PATH).collect()), key=repr)
    counts = expected(tokenizer, [r[1] or "" for r in rows])
    assert found == sorted(((r[0], len((r[1] or "").encode()), n, n > 512) for r, n in zip(rows, counts)), key=repr)
    assert transducer.token_counts(docs.limit(0), PATH).count() == 0
