"""Token counts by a byte-level BPE tokenizer compiled to finite-state transducers.

Two deterministic transducers run one after the other; each transition carries what it emits.

* The first reads character classes and marks where the pieces start that merges never cross (the pattern of byte-level
  vocabularies: contractions, letters, digits, other signs, white space). It has 11 states, so the map of a chunk of
  characters (state in, state out) is a row of 11 numbers. All maps of a batch come out of one pass in step, are composed
  by a parallel prefix scan, and a second pass from the now known states emits the marks.
* The second reads the bytes of a piece. After i bytes the encoding of what was read has c(i) tokens; the transition emits
  c(i) - c(i-1), so the emitted counts of a piece add up to its tokens. The last token of each prefix is the one whose
  bytes end there, which is whole by itself and compatible with the last token before it, so a state needs only the
  longest suffix that starts a token, and the last tokens and counts at the places inside that suffix. Transitions are
  compiled when first met and kept in a table that numpy looks up for many chunks in step. A piece longer than a chunk
  is cut: its chunks run from the start state, and their maps are put right for the state that really comes in, which
  needs a few bytes until both runs meet.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Fixed values of byte-level vocabularies: the pattern's character classes, contractions by their letters.
CLASSES = {"other": 0, "letter": 1, "stmd": 2, "rv": 3, "l": 4, "e": 5, "number": 6, "space": 7, "blank": 8, "apostrophe": 9, "end": 10}
STATES = ["start", "letters", "numbers", "others", "apostrophe", "before_e", "before_l", "space", "blank", "spaces", "blanks"]
HERE, BEFORE = 1, 2
MAP_CHARS, LANE_BYTES = 128, 512
#: Bytes of text handled at once, and the longest segment; longer texts are cut where a space follows another character.
POOL_BYTES, SEGMENT_CHARS = 1 << 21, 1 << 20
#: States a worker compiles before it starts again with an empty table; this bounds memory and never shows in a count.
MOST_STATES = 400_000
LIMIT = 512


def _boundaries() -> tuple[np.ndarray, np.ndarray]:
    """Next state and mark for (state, class)."""
    at = {name: i for i, name in enumerate(STATES)}
    step, mark = np.zeros((len(STATES), len(CLASSES)), np.uint8), np.zeros((len(STATES), len(CLASSES)), np.uint8)
    runs = {"other": "others", "number": "numbers", "space": "space", "blank": "blank", "apostrophe": "apostrophe", "end": "start"}
    for state in STATES:
        for name, c in CLASSES.items():
            letter = name in ("letter", "stmd", "rv", "l", "e")
            target, said = runs.get(name, "letters"), HERE  # a new piece starts at this character
            if state == "letters" and letter or state == "numbers" and name == "number":
                said = 0
            elif state == "others" and name in ("other", "apostrophe"):
                target, said = "others", 0
            elif state == "apostrophe":
                if name == "stmd":
                    target, said = "start", 0
                elif name in ("rv", "l"):  # either a contraction of two letters or a letter piece that starts here
                    target, said = ("before_e" if name == "rv" else "before_l"), 0
                elif name in ("other", "apostrophe"):
                    target, said = "others", 0
            elif state in ("before_e", "before_l"):
                if name == state[-1]:
                    target, said = "start", 0
                else:
                    said = BEFORE if letter else BEFORE | HERE
            elif state in ("space", "blank", "spaces", "blanks"):
                many = state in ("spaces", "blanks")
                if name in ("space", "blank"):
                    target, said = name + "s", 0
                elif name != "end":
                    joined = state in ("space", "spaces")  # the last space leads the piece that follows
                    said = (BEFORE if many else 0) | (0 if joined else HERE)
                    if joined and name == "apostrophe":
                        target = "others"
            step[at[state], c], mark[at[state], c] = at[target], 0 if name == "end" and state not in ("before_e", "before_l") else said & (BEFORE if name == "end" else HERE | BEFORE)
    return step, mark


STEP, MARK = _boundaries()


def piece_starts(classes: np.ndarray) -> np.ndarray:
    """Which characters start a piece; texts are closed by the class ``end``, which is marked as well."""
    n, k = len(classes), len(STATES)
    chunks = -(-n // MAP_CHARS)
    grid = np.full((chunks, MAP_CHARS), CLASSES["end"], np.uint8)
    grid.ravel()[:n] = classes
    maps = np.tile(np.arange(k, dtype=np.uint8), (chunks, 1))
    flat, width = STEP.ravel(), len(CLASSES)
    for t in range(MAP_CHARS):
        maps = flat[maps.astype(np.int32) * width + grid[:, t, None]]
    reach = 1
    while reach < chunks:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.int64), axis=1)
        reach *= 2
    state = np.concatenate(([0], maps[:-1, 0])).astype(np.int32)
    said = np.zeros((chunks, MAP_CHARS), np.uint8)
    for t in range(MAP_CHARS):
        place = state * width + grid[:, t]
        said[:, t] = MARK.ravel()[place]
        state = flat[place].astype(np.int32)
    said = said.ravel()[:n]
    starts = (said & HERE) > 0
    starts[:-1] |= (said[1:] & BEFORE) > 0
    return starts | (classes == CLASSES["end"])


def character_classes(tokenizer) -> bytes:
    """Class of each code point up to planes 4 to 16 (all "other"), asked from the tokenizer itself; compressed."""
    table = np.zeros(0x110000, np.uint8)
    letters, numbers, blanks = np.zeros(0x110000, bool), np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    for low in [*range(0, 0x40000, 0x4000), *range(0xE0000, 0xF0000, 0x4000)]:
        codes = [c for c in range(low, low + 0x4000) if not 0xD800 <= c < 0xE000]
        for sign, found in (("a", letters), ("1", numbers), ("!", table)):
            text = "".join(sign + chr(c) for c in codes)
            starts = np.zeros(len(text) + 1, bool)
            starts[[span[0] for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(text)]] = True
            found[codes] = ~starts[1 : len(text) : 2]
    blanks[:] = ~(letters | numbers | table.astype(bool))
    blanks[0x40000:0xE0000] = blanks[0xF0000:] = blanks[0xD800:0xE000] = False
    table[:] = CLASSES["other"]
    table[letters], table[numbers], table[blanks] = CLASSES["letter"], CLASSES["number"], CLASSES["blank"]
    for name, signs in (("stmd", "stmd"), ("rv", "rv"), ("l", "l"), ("e", "e"), ("space", " "), ("apostrophe", "'")):
        table[[ord(s) for s in signs]] = CLASSES[name]
    return zlib.compress(table.tobytes())


def _bytes_of_signs() -> dict[str, int]:
    """The byte each sign of a byte-level vocabulary stands for: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def check_supported(source: dict) -> None:
    """Raise unless the tokenizer is plain byte-level BPE with verbatim special tokens."""
    model, before = source["model"], source["pre_tokenizer"] or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)] + [k for k in ("byte_fallback", "ignore_merges") if model.get(k)]
    if model["type"] != "BPE" or odd or source["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex"):
        raise ValueError(f"only byte-level BPE without normalizer and prefix space is compiled, not {model['type']} {odd} {before}")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in source["added_tokens"]):
        raise ValueError("added tokens that strip, need whole words or are normalized are not compiled")


class PieceTransducer:
    """Transitions (state, byte) to (state, emitted tokens), compiled on demand from the merges."""

    def __init__(self, source: dict) -> None:
        signs = _bytes_of_signs()
        tokens = [bytes([b]) for b in range(256)]
        ids = {t: i for i, t in enumerate(tokens)}
        self.merge: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        for pair in source["model"]["merges"]:
            left, right = (ids[bytes(map(signs.__getitem__, side))] for side in (pair.split(" ") if isinstance(pair, str) else pair))
            made = tokens[left] + tokens[right]
            if made in ids:
                raise ValueError("a token has two merges")
            ids[made] = self.merge[left, right] = len(tokens)  # ids are ranks: a part always has a smaller one
            tokens.append(made)
            self.parts.append((left, right))
        self.tokens = tokens
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        self.depth = [0]
        for token, spelled in enumerate(tokens):
            node = 0
            for b in spelled:
                following = self.children[node].get(b)
                if following is None:
                    following = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = following
            self.token_at[node] = token
        self.fail = [0] * len(self.children)
        self.ending = [0] * len(self.children)  # nearest proper suffix that is a token
        level = list(self.children[0].values())
        while level:
            deeper = []
            for node in level:
                for b, child in self.children[node].items():
                    back = self.fail[node]
                    while back and b not in self.children[back]:
                        back = self.fail[back]
                    self.fail[child] = self.children[back].get(b, 0)
                    deeper.append(child)
                back = self.fail[node]
                self.ending[node] = back if self.token_at[back] >= 0 else self.ending[back]
            level = deeper
        self.clear()

    def clear(self) -> None:
        #: (node, last token and count to take back at each place from here on backwards); the start has no token.
        self.held: list[tuple[int, ...]] = [(0, -1, 0)]
        self.states = {self.held[0]: 0}
        self.fits: dict[tuple[int, int], bool] = {}
        self.size, self.used = 1 << 16, 0
        self.keys, self.values, self.emits = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int32), np.zeros(self.size, np.int8)
        self.known: dict[int, int] = {}

    def _crosses(self, left: int, right: int, top: int) -> bool:
        """Whether, while both sides are merged up, a merge across their border comes first."""
        sides = []
        for token, which in ((left, 1), (right, 0)):
            spine, parent = [], top
            while True:
                spine.append((token, parent))
                if self.parts[token] is None:
                    break
                parent, token = token, self.parts[token][which]
            sides.append(spine)
        for x, over_x in sides[0]:
            for y, over_y in sides[1]:
                made = self.merge.get((x, y))
                if made is not None and made < over_x and made <= over_y and made != top:
                    return True
        return False

    def whole(self, token: int) -> bool:
        """Whether the token's bytes alone are encoded as this token."""
        fine = self.fits.get((-1, token))
        if fine is None:
            parts = self.parts[token]
            fine = parts is None or self.whole(parts[0]) and self.whole(parts[1]) and not self._crosses(*parts, token)
            self.fits[-1, token] = fine
        return fine

    def follows(self, left: int, right: int) -> bool:
        fine = self.fits.get((left, right))
        if fine is None:
            fine = self.whole(right) and not self._crosses(left, right, len(self.tokens))
            self.fits[left, right] = fine
        return fine

    def compile(self, key: int) -> tuple[int, int]:
        """(next state, emitted tokens) of ``state << 8 | byte``."""
        found = self.known.get(key)
        if found is not None:
            return found >> 8, (found & 255) - 128
        b, last = key & 255, self.held[key >> 8]
        node = last[0]
        while node and b not in self.children[node]:
            node = self.fail[node]
        node = self.children[node].get(b, 0)
        at = node if self.token_at[node] >= 0 else self.ending[node]
        while at:
            token, back = self.token_at[at], 2 * self.depth[at] - 1
            before, count = last[back], last[back + 1]
            if self.whole(token) if before < 0 else self.follows(before, token):
                break
            at = self.ending[at]
        emitted = 1 - count
        kept = list(last[1 : 2 * self.depth[node] + 1])
        kept[1::2] = [c + emitted for c in kept[1::2]]
        entry = (node, token, 0, *kept)
        following = self.states.get(entry)
        if following is None:
            following = self.states[entry] = len(self.held)
            self.held.append(entry)
        self.known[key] = following << 8 | emitted + 128
        self._insert(key, following, emitted)
        return following, emitted

    def _insert(self, key: int, following: int, emitted: int) -> None:
        if 2 * self.used > self.size:
            self.size *= 4
            self.keys, self.values, self.emits = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int32), np.zeros(self.size, np.int8)
            self.used = 0
            for k, found in self.known.items():
                if k != key:
                    self._insert(k, found >> 8, (found & 255) - 128)
        slot = self._slot(key)
        while self.keys[slot] >= 0:
            slot = (slot + 1) % self.size
        self.keys[slot], self.values[slot], self.emits[slot] = key, following, emitted
        self.used += 1

    def _slot(self, key):
        """Place of a key or of an array of keys."""
        return ((key ^ (key >> 15)) * 40503 + (key >> 7)) % self.size

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = self._slot(keys)
        there = self.keys[slots]
        open_ = np.flatnonzero(there != keys)
        while len(open_):
            empty = there[open_] < 0
            if empty.any():
                for key in np.unique(keys[open_[empty]]).tolist():
                    self.compile(key)
                return self.look_up(keys)
            slots[open_] = (slots[open_] + 1) % self.size
            there[open_] = self.keys[slots[open_]]
            open_ = open_[there[open_] != keys[open_]]
        return self.values[slots], self.emits[slots]

    def emitted(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens emitted at each byte; ``starts`` marks the first byte of each piece."""
        n = len(data)
        out = np.zeros(n, np.int8)
        if not n:
            return out
        if len(self.held) > MOST_STATES:
            self.clear()
        first = np.flatnonzero(starts)
        cuts = first[np.unique(np.searchsorted(first, np.arange(0, n, LANE_BYTES)).clip(max=len(first) - 1))]
        cuts = np.unique(np.concatenate(([0], cuts)))
        spans = np.diff(np.append(cuts, n))
        extra = [np.arange(c + LANE_BYTES, c + s, LANE_BYTES) for c, s in zip(cuts[spans > 2 * LANE_BYTES], spans[spans > 2 * LANE_BYTES])]
        lanes = np.unique(np.concatenate([cuts, *extra]))
        lengths = np.diff(np.append(lanes, n))
        order = np.argsort(-lengths, kind="stable")
        at, left = lanes[order], lengths[order]
        alive = np.searchsorted(-left, -np.arange(int(left[0])), side="left")
        state = np.zeros(len(at), np.int64)
        seen = np.zeros(n, np.int32)
        for t, count in enumerate(alive.tolist()):
            place = at[:count] + t
            before = np.where(starts[place], 0, state[:count])
            following, emits = self.look_up(before << 8 | data[place])
            state[:count], out[place], seen[place] = following, emits, following
        for lane, length in zip(lanes.tolist(), lengths.tolist()):
            if lane and not starts[lane]:  # inside a piece: put the chunk right for the state that comes in
                now, i = int(seen[lane - 1]), lane
                while i < lane + length and not starts[i]:
                    now, emit = self.compile(now << 8 | int(data[i]))
                    out[i] = emit
                    if now == seen[i]:
                        break
                    seen[i] = now
                    i += 1
        return out


class Counter:
    """Token counts of texts by one tokenizer file."""

    def __init__(self, path: str, classes: bytes) -> None:
        with open(path, encoding="utf-8") as file:
            source = json.load(file)
        check_supported(source)
        self.classes = np.frombuffer(zlib.decompress(classes), np.uint8)
        self.transducer = PieceTransducer(source)
        special = sorted((t["content"] for t in source["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.break_ = re.compile(r"\S(?= )")

    def _segments(self, text: str) -> list[str]:
        """Text without special strings, cut where it is very long; the cuts are borders of pieces in any case."""
        out = []
        for part in self.special.split(text)[::2] if self.special else [text]:
            while len(part) > SEGMENT_CHARS:
                found = self.break_.search(part, SEGMENT_CHARS)
                if not found:
                    break
                out.append(part[: found.end()])
                part = part[found.end() :]
            out.append(part)
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, tokens) of each text."""
        n_bytes, n_tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        held, owners, size = [], [], 0

        def flush() -> None:
            for owner, tokens in zip(owners, self._run(held)):
                n_tokens[owner] += tokens

        for i, text in enumerate(texts):
            n_bytes[i] = len(text.encode("utf-8", "replace"))
            n_tokens[i] = len(self.special.findall(text)) if self.special else 0
            for part in self._segments(text):
                held.append(part)
                owners.append(i)
                size += len(part)
                if size >= POOL_BYTES:
                    flush()
                    held, owners, size = [], [], 0
        flush()
        return n_bytes, n_tokens

    def _run(self, parts: list[str]) -> list[int]:
        if not parts:
            return []
        joined = "\n".join(parts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        classes = self.classes[codes]
        classes[ends] = CLASSES["end"]
        starts = piece_starts(classes)
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.cumsum(width) - width
        data = np.frombuffer(joined.encode("utf-8", "replace"), np.uint8)
        flags = np.zeros(len(data), bool)
        flags[place[starts]] = True
        emitted = self.transducer.emitted(data, flags)
        emitted[place[ends]] = 0
        total = np.concatenate(([0], np.cumsum(emitted, dtype=np.int64)))
        return np.diff(np.concatenate(([0], total[place[ends] + 1]))).tolist()


@lru_cache(maxsize=4)
def _classes(path: str) -> bytes:
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        check_supported(json.load(file))
    return character_classes(Tokenizer.from_file(path))


@lru_cache(maxsize=2)
def _counter(path: str, classes: bytes) -> Counter:
    """One compiled tokenizer per worker process, kept from task to task."""
    return Counter(path, classes)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, as the tokenizers library counts them without added tokens.

    Special strings inside a text count as their one token. A null text counts as empty; a null id, repeated rows and empty
    texts each give a row; other columns are not read. Rows stay where they are read: there is no shuffle.
    """
    classes = _classes(tokenizer_path)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                n_bytes, n_tokens = _counter(tokenizer_path, classes).counts([t or "" for t in batch.column("text").to_pylist()])
                yield pa.record_batch([batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
