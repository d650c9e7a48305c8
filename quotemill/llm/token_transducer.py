"""Token counts by a byte-level BPE vocabulary compiled to deterministic transducers.

Two transducers run in a cascade over whole texts, an Arrow batch at a time.

**Splitting.** Code points are mapped to symbols and read by an automaton of a dozen
states (`split_tables`), whose transitions mark where pieces of the vocabulary's
splitting pattern start. The symbols of a batch are dealt into chunks of equal
length, all read in lockstep. Pass one computes each chunk's whole state map (for
every state at its start the state at its end), and a parallel prefix scan composes
the maps, which gives every chunk its true first state. Pass two reads the chunks
again from there and takes the marks.

**Merging.** Of byte-pair encodings it is known that a sequence of tokens is the
encoding of its bytes exactly if all neighbouring pairs are (Berglund and van der
Merwe, 2023). So every prefix of a piece has one last token, and the encoding of a
longer prefix follows from those of a few shorter ones. The transducer's state is
what the future can depend on: the longest suffix that may become a token (a node of
the Aho-Corasick automaton of all tokens) and, for every position in it, last token
and count of the prefix that ends there. A transition reads one byte and is annotated
with the net number of tokens it emits, which is negative where tokens merge. The
transducer is determinised as bytes ask for it; its transitions are kept in an open
hash table that a whole array of (state, byte) keys is looked up in at once.

All pieces of a slice are read in lockstep. A long piece is dealt into chunks whose
state maps are first computed for likely states (the start, and the state in which
the chunk before it ends when read from the start) and then composed in order; where
a chunk is reached in another state, its map is extended by reading it from there.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes that are read at once; a longer text is read in several blocks.
SLICE_BYTES = 1 << 19
# Symbols of a chunk of the splitting automaton, bytes of a chunk of a long piece.
CHUNK = 256
# Transitions after which a transducer starts afresh, between two slices.
MOST_TRANSITIONS = 1 << 19

SCHEMA = "n_bytes bigint, n_tokens bigint, over_limit boolean"

# --- splitting -----------------------------------------------------------------

# Symbols: end of text, space, other white space, letters, numbers, the rest, and
# the characters of the contractions 's 't 'm 'd 're 've 'll.
END, SPACE, WHITE, LETTER, NUMBER, OTHER, QUOTE, STMD, R, V, LL, E = range(12)
# States: between pieces, in a run of letters, numbers or the rest, after one or more
# white characters (the last a space or not), after a quote that starts a piece, and
# after such a quote and r, v or l.
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, SP1, SP2, WS1, WS2, Q, QR, QV, QL = range(12)
# Marks: a piece starts at the current, or at the previous character.
CURRENT, PREVIOUS = 1, 2
_LETTERS = {LETTER, STMD, R, V, LL, E}
_RUN = {IN_LETTERS: _LETTERS, IN_NUMBERS: {NUMBER}, IN_OTHER: {OTHER, QUOTE}}


def _enter(symbol: int, spaced: bool = False) -> int:
    """State after the first character of a piece, or the first after its space."""
    if symbol in _LETTERS:
        return IN_LETTERS
    return {SPACE: SP1, WHITE: WS1, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, QUOTE: IN_OTHER if spaced else Q}[symbol]


def _split_step(state: int, symbol: int) -> tuple[int, int]:
    """Next state and marks, for the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    if state in (QR, QV, QL):
        if symbol == (LL if state == QL else E):
            return START, 0
        # No contraction: the letter after the quote has started a run of letters.
        after, marks = _split_step(IN_LETTERS, symbol)
        return after, marks | PREVIOUS
    if symbol == END:
        return START, 0
    if state in (SP1, SP2, WS1, WS2):
        if symbol in (SPACE, WHITE):
            return (SP2 if symbol == SPACE else WS2), 0
        # The last white character leaves its run; a space joins what follows it.
        split = PREVIOUS if state in (SP2, WS2) else 0
        if state in (SP1, SP2):
            return _enter(symbol, spaced=True), split
        return _enter(symbol), split | CURRENT
    if state == Q:
        if symbol == STMD:
            return START, 0
        if symbol in (R, V, LL):
            return {R: QR, V: QV, LL: QL}[symbol], 0
        if symbol in (OTHER, QUOTE):
            return IN_OTHER, 0
    elif symbol in _RUN.get(state, ()):
        return state, 0
    return _enter(symbol), CURRENT


def split_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next states and marks by state * 12 + symbol."""
    steps = [_split_step(state, symbol) for state in range(12) for symbol in range(12)]
    return tuple(np.array(part, dtype=np.uint8) for part in zip(*steps, strict=True))


_NEXT, _MARK = split_tables()


def chunk_maps(chunks: np.ndarray) -> np.ndarray:
    """Of every chunk (a column of symbols) the state at its end, by the state at its start."""
    states = np.tile(np.arange(12, dtype=np.uint8), (chunks.shape[1], 1))
    for symbols in chunks:
        states = _NEXT.take(states * np.uint8(12) + symbols[:, None])
    return states


def scan_maps(maps: np.ndarray) -> np.ndarray:
    """Of every chunk the composition of its map after those of all chunks before it."""
    scanned, step = maps.copy(), 1
    while step < len(scanned):
        scanned[step:] = np.take_along_axis(scanned[step:], scanned[:-step], axis=1)
        step *= 2
    return scanned


def split_marks(symbols: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each symbol."""
    n = len(symbols)
    width = max(1, min(CHUNK, n))
    padded = np.zeros(-(-n // width) * width, dtype=np.uint8)
    padded[:n] = symbols
    chunks = np.ascontiguousarray(padded.reshape(-1, width).T)
    states = np.full(chunks.shape[1], START, dtype=np.uint8)
    states[1:] = scan_maps(chunk_maps(chunks))[:-1, START]
    marks = np.empty_like(chunks)
    for at, row in enumerate(chunks):
        edges = states * np.uint8(12) + row
        marks[at] = _MARK.take(edges)
        states = _NEXT.take(edges)
    marks = marks.T.reshape(-1)[:n]
    starts = (marks & CURRENT) > 0
    starts[:-1] |= (marks[1:] & PREVIOUS) > 0
    return starts


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and value of each code point of UTF-8; stray bytes count as code points."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if len(data) and (not len(at) or at[0]):
        at = np.insert(at, 0, 0)
    lead = data[at].astype(np.int32)
    value = lead.copy()
    last = max(0, len(data) - 1)
    for least, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        rows = np.flatnonzero(lead >= least)
        held = lead[rows] & mask
        for k in range(1, more + 1):
            held = (held << 6) | (data[np.minimum(at[rows] + k, last)] & 0x3F)
        value[rows] = held
    return at, np.minimum(value, 0x10FFFF)


# --- the vocabulary --------------------------------------------------------------


class Vocabulary(NamedTuple):
    """A byte-level BPE vocabulary: bytes of each token, merges by rank, added strings, symbols."""

    tokens: list[bytes]
    merges: list[tuple[int, int, int]]  # left, right, merged
    added: list[bytes]
    symbols: bytes  # of each code point, compressed


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a letter: printable ones as themselves,
    the others, in order, as the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _symbols_of(tokenizer) -> bytes:
    """The symbol of every code point, by the letters and numbers that the library knows.

    Where two installed Unicode tables agree on a code point, that is its class;
    where they are of different age, the library's own splitter is asked.
    """
    import regex

    text = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    known = np.array([unicodedata.category(c)[0] for c in text])
    for pattern, kind, symbol in ((r"\p{L}", "L", LETTER), (r"\p{N}", "N", NUMBER)):
        newer = np.zeros(0x110000, dtype=bool)
        newer[[m.start() for m in regex.finditer(pattern, text)]] = True
        table[newer & (known == kind)] = symbol
        doubtful = np.flatnonzero(newer != (known == kind)).tolist()
        beside = "a" if kind == "L" else "1"
        for lo in range(0, len(doubtful), 2000):
            part = doubtful[lo : lo + 2000]
            probe = "\n".join(beside + chr(c) + beside for c in part)
            starts = {span[0] for _, span in tokenizer.pre_tokenizer.pre_tokenize_str(probe)}
            table[[c for k, c in enumerate(part) if 4 * k + 1 not in starts]] = symbol
    for c in [m.start() for m in regex.finditer(r"\s", text)]:
        table[c] = WHITE
    for letters, symbol in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("l", LL), ("e", E)):
        table[[ord(c) for c in letters]] = symbol
    return zlib.compress(table.tobytes(), 1)


def read_vocabulary(path: str) -> Vocabulary:
    """Compile what the transducers need of a tokenizer file; other kinds than byte-level BPE are an error."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, splitter = content["model"], content["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    byte_level = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
    if not plain or not byte_level or splitter.get("add_prefix_space") or content["normalizer"]:
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
    added = content["added_tokens"]
    if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
        raise ValueError(f"added tokens that take text around them are not known: {path}")
    letters = _byte_letters()
    ids = model["vocab"]
    if not set(letters) <= set(ids):
        raise ValueError(f"the vocabulary does not hold every byte: {path}")
    tokens = [b""] * (max(ids.values()) + 1)
    for word, number in ids.items():
        if all(c in letters for c in word):
            tokens[number] = bytes(letters[c] for c in word)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    strings = sorted((a["content"].encode() for a in added), key=len, reverse=True)
    return Vocabulary(tokens, merges, strings, _symbols_of(Tokenizer.from_file(path)))


# --- merging -------------------------------------------------------------------


class _Table:
    """Transitions by key, in an open hash table that takes arrays of keys."""

    def __init__(self, bits: int = 14):
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << bits, dtype=np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys, -1 where there is none. Values are never negative."""
        slots = self._slots(keys)
        held = self.keys.take(slots)
        found = np.where(held == keys, self.values.take(slots), -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            at = slots[open_]
            held = self.keys.take(at)
            hit = held == keys[open_]
            found[open_[hit]] = self.values.take(at[hit])
            open_ = open_[~hit & (held >= 0)]
        return found

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New keys, each once."""
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys >= 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            bits = self.bits
            while 3 * len(keys) > 1 << bits:
                bits += 1
            self.__init__(bits)
        mask = len(self.keys) - 1
        for key, value, slot in zip(keys.tolist(), values.tolist(), self._slots(keys).tolist(), strict=True):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & mask
            self.keys[slot], self.values[slot] = key, value
        self.used += len(keys)


class Transducer:
    """Token counts of pieces, determinised as far as the pieces read so far ask for it."""

    def __init__(self, vocabulary: Vocabulary):
        self.symbols = np.frombuffer(zlib.decompress(vocabulary.symbols), dtype=np.uint8)
        self.added = re.compile(b"|".join(map(re.escape, vocabulary.added))) if vocabulary.added else None
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(vocabulary.merges)}
        self.parts = {merged: (a, b, r) for r, (a, b, merged) in enumerate(vocabulary.merges)}
        self._spines: tuple[dict, dict] = ({}, {})
        self._pairs: dict[tuple[int, int], bool] = {}
        self._plant([(t, n) for n, t in enumerate(vocabulary.tokens) if t and self._forms(n)])
        self.restart()

    # Which tokens may stand side by side.

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces of the token at its right (1) or left (0) edge, with the rank of the merge that takes each."""
        held = self._spines[side].get(token)
        if held is None:
            held, piece, taken = [], token, float("inf")
            while True:
                held.append((piece, taken))
                if piece not in self.parts:
                    break
                taken = self.parts[piece][2]
                piece = self.parts[piece][side]
            self._spines[side][token] = held
        return held

    def _merges_across(self, left: int, right: int, before: float) -> bool:
        """Whether a merge of a rank below ``before`` would take a piece of each of both tokens.

        A merge acts only while both pieces are there. Of equal merges that share a
        piece the left one is first.
        """
        for p, p_taken in self._spine(left, 1):
            for q, q_taken in self._spine(right, 0):
                rank = self.rank.get((p, q))
                if rank is not None and rank < before and rank < p_taken and rank <= q_taken:
                    return True
        return False

    def _forms(self, token: int) -> bool:
        """Whether the token's bytes are encoded as this token."""
        stack = [token]
        while stack:
            made = self.parts.get(stack.pop())
            if made is not None:
                if self._merges_across(made[0], made[1], made[2]):
                    return False
                stack += made[:2]
        return True

    def _fits(self, left: int, right: int) -> bool:
        held = self._pairs.get((left, right))
        if held is None:
            held = self._pairs[left, right] = not self._merges_across(left, right, float("inf"))
        return held

    # The automaton of all tokens.

    def _plant(self, tokens: list[tuple[bytes, int]]) -> None:
        self.child: dict[int, int] = {}
        self.depth, token_at, self.fail = [0], [-1], [0]
        below: list[list[tuple[int, int]]] = [[]]
        for word, number in tokens:
            node = 0
            for byte in word:
                key = node << 8 | byte
                after = self.child.get(key)
                if after is None:
                    after = self.child[key] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                    token_at.append(-1)
                    self.fail.append(0)
                    below.append([])
                    below[node].append((byte, after))
                node = after
            token_at[node] = number
        # Of each node the node of the longest shorter token that ends there.
        self.shorter = [0] * len(self.depth)
        order = deque([0])
        while order:
            node = order.popleft()
            for byte, after in below[node]:
                if node:
                    self.fail[after] = self._goto(self.fail[node], byte)
                nearest = self.fail[after]
                if token_at[nearest] < 0:
                    nearest = self.shorter[nearest]
                self.shorter[after] = nearest
                order.append(after)
        self.token_at = token_at

    def _goto(self, node: int, byte: int) -> int:
        while True:
            after = self.child.get(node << 8 | byte)
            if after is not None:
                return after
            if not node:
                return 0
            node = self.fail[node]

    # States and transitions.

    def restart(self) -> None:
        """Forget all states but the first."""
        first = (0, -1, 0)
        self.ids, self.states, self.table = {first: 0}, [first], _Table()
        self._pairs.clear()

    def _step(self, state: int, byte: int) -> int:
        """The next state and the tokens emitted, packed. A state is its node, then last token
        and tokens since, for every position from the node's start to its end."""
        old = self.states[state]
        node = self._goto(old[0], byte)
        end = self.depth[old[0]] + 1
        at = node if self.token_at[node] >= 0 else self.shorter[node]
        while True:
            token, start = self.token_at[at], end - self.depth[at]
            before, since = old[1 + 2 * start], old[2 + 2 * start]
            if before < 0 or self._fits(before, token):
                break
            at = self.shorter[at]
            if not at:
                raise ValueError("no token may end here: the vocabulary is not a proper BPE")
        gain = 1 - since
        new = [node]
        for k in range(end - self.depth[node], end):
            new += (old[1 + 2 * k], old[2 + 2 * k] + gain)
        new += (token, 0)
        key = tuple(new)
        number = self.ids.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        return number << 16 | (gain + (1 << 15))

    def _follow(self, keys: np.ndarray) -> np.ndarray:
        found = self.table.find(keys)
        missing = found < 0
        if missing.any():
            new = np.unique(keys[missing])
            steps = [self._step(k >> 8, k & 255) for k in new.tolist()]
            self.table.put(new, np.array(steps, dtype=np.int64))
            found = self.table.find(keys)
        return found

    def read(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, states: np.ndarray):
        """Last state and tokens emitted of each stretch of bytes, all read in lockstep."""
        order = np.argsort(-lengths, kind="stable")
        at, state = starts[order], states[order].astype(np.int64)
        emitted = np.zeros(len(order), dtype=np.int64)
        longer = len(order) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
        for k, m in enumerate(longer.tolist()):
            step = self._follow(state[:m] << 8 | data[at[:m] + k])
            state[:m] = step >> 16
            emitted[:m] += (step & 0xFFFF) - (1 << 15)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], emitted[back]

    def pieces(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        counts = np.zeros(len(starts), dtype=np.int64)
        short = lengths <= CHUNK
        where = np.flatnonzero(short)
        counts[where] = self.read(data, starts[where], lengths[where], np.zeros(len(where)))[1]
        long = np.flatnonzero(~short)
        if len(long):
            counts[long] = self._long_pieces(data, starts[long], lengths[long])
        return counts

    def _long_pieces(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of pieces of several chunks, by composing the chunks' state maps."""
        n_chunks = -(-lengths // CHUNK)
        piece = np.repeat(np.arange(len(starts)), n_chunks)
        first = np.cumsum(n_chunks) - n_chunks
        offset = (np.arange(len(piece)) - first[piece]) * CHUNK
        at, size = starts[piece] + offset, np.minimum(CHUNK, lengths[piece] - offset)
        fresh, emitted = self.read(data, at, size, np.zeros(len(at)))
        maps = [{0: (e, g)} for e, g in zip(fresh.tolist(), emitted.tolist(), strict=True)]
        inner = np.flatnonzero(offset > 0)
        likely = fresh[inner - 1]
        ends, emitted = self.read(data, at[inner], size[inner], likely)
        for chunk, s, e, g in zip(inner.tolist(), likely.tolist(), ends.tolist(), emitted.tolist(), strict=True):
            maps[chunk][s] = (e, g)
        counts = np.zeros(len(starts), dtype=np.int64)
        state = 0
        for chunk, owner in enumerate(piece.tolist()):
            state = state if offset[chunk] else 0
            if state not in maps[chunk]:
                maps[chunk][state] = self._walk(state, data[at[chunk] : at[chunk] + size[chunk]].tobytes())
            state, gain = maps[chunk][state]
            counts[owner] += gain
        return counts

    def _walk(self, state: int, stretch: bytes) -> tuple[int, int]:
        """Last state and tokens emitted of one stretch of bytes."""
        total = 0
        for byte in stretch:
            step = int(self._follow(np.array([state << 8 | byte]))[0])
            state = step >> 16
            total += (step & 0xFFFF) - (1 << 15)
        return state, total

    # Whole texts.

    def _make_room(self) -> None:
        if self.table.used > MOST_TRANSITIONS:
            self.restart()

    def _marked(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets where pieces start, and where pieces or texts end, of texts that end at ``ends``."""
        at, value = code_points(data)
        symbols = self.symbols[value]
        closing = np.searchsorted(at, ends)
        symbols = np.insert(symbols, closing, END)
        at = np.insert(at, closing, ends)
        starts = split_marks(symbols)
        events = np.flatnonzero(starts | (symbols == END))
        stops = np.append(at[events[1:]], len(data))
        opens = starts[events]
        return at[events][opens], stops[opens]

    def _segments(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each of several texts that lie end to end in ``data``."""
        self._make_room()
        starts, stops = self._marked(data, ends)
        counts = self.pieces(data, starts, stops - starts)
        owner = np.searchsorted(ends, starts, side="right")
        return np.bincount(owner, counts, minlength=len(ends)).astype(np.int64)

    def _long_text(self, data: np.ndarray) -> int:
        """Tokens of one text, read in blocks that end where a piece certainly starts."""
        total, lo, size = 0, 0, SLICE_BYTES
        while len(data) - lo > size:
            hi = lo + size
            while hi > lo + 1 and data[hi] & 0xC0 == 0x80 and hi > lo + size - 4:
                hi -= 1
            block = data[lo:hi]
            starts, stops = self._marked(block, np.zeros(0, dtype=np.int64))
            # The next characters may still move a mark by one; 8 bytes hold two characters or more.
            sure = starts[starts <= len(block) - 8]
            if len(sure) < 2:
                size *= 2
                continue
            self._make_room()
            # The pattern goes on from the start of a piece as from the start of a text.
            before = starts < sure[-1]
            total += int(self.pieces(block, starts[before], (stops - starts)[before]).sum())
            lo, size = lo + int(sure[-1]), SLICE_BYTES
        rest = data[lo:]
        return total + int(self._segments(rest, np.array([len(rest)]))[0])

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        n = len(texts)
        sizes = np.zeros(n, dtype=np.int64)
        tokens = np.zeros(n, dtype=np.int64)
        held: list[bytes] = []
        owners: list[int] = []
        held_bytes = 0

        def flush() -> None:
            nonlocal held_bytes
            if held:
                ends = np.cumsum([len(s) for s in held])
                data = np.frombuffer(b"".join(held), dtype=np.uint8)
                np.add.at(tokens, owners, self._segments(data, ends))
            held.clear()
            owners.clear()
            held_bytes = 0

        for row in range(n):
            text = texts[row].as_py()
            sizes[row] = len(text)
            segments = [text]
            if self.added:
                segments = self.added.split(text)
                tokens[row] += len(segments) - 1
            for segment in segments:
                if len(segment) > SLICE_BYTES:
                    tokens[row] += self._long_text(np.frombuffer(segment, dtype=np.uint8))
                elif segment:
                    held.append(segment)
                    owners.append(row)
                    held_bytes += len(segment)
                    if held_bytes >= SLICE_BYTES:
                        flush()
        flush()
        return sizes, tokens


# --- the operator -----------------------------------------------------------------

_sent: dict[tuple[str, str], object] = {}
_built: dict[tuple[str, str], Transducer] = {}


def _transducer(key: tuple[str, str], shared) -> Transducer:
    """The transducer of this worker process, kept from task to task."""
    if key not in _built:
        _built.clear()
        _built[key] = Transducer(shared.value)
    return _built[key]


def count_tokens(
    df: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """Bytes and tokens of every text: ``doc_id``, n_bytes, n_tokens, and whether n_tokens exceeds the limit.

    ``path`` names a byte-level BPE vocabulary on the driver. Added tokens inside a
    text count as one token each; none is added at its start or end. A null or empty
    text has no bytes and no tokens. Rows that repeat an id are separate rows.
    Other columns of ``df`` are not read. Texts of any length are read whole.
    """
    key = (df.sparkSession.sparkContext.applicationId, path)
    if key not in _sent:
        # Once an application; its size is that of the file and does not grow with the data.
        _sent[key] = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    shared = _sent[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = _transducer(key, shared)
        for batch in batches:
            sizes, tokens = transducer.count(batch.column(1))
            columns = [batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, names=[doc_id, "n_bytes", "n_tokens", "over_limit"])

    source = df.select(doc_id, F.col(text).alias("t"))
    return source.mapInArrow(run, f"`{doc_id}` {source.schema[0].dataType.simpleString()}, {SCHEMA}")
