"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer.

Two deterministic machines stand for the tokenizer, and every transition of either carries the number
of outputs it adds.

*Pieces.*  The pre-tokenizer's pattern is a machine of twelve states over twelve classes of characters.
A transition says whether a piece begins at the character, or began at the one before.  Texts are
laid end to end, a reset between them, and cut into chunks; all chunks run at once from every state,
which gives one state map a chunk; the maps are composed by a parallel prefix scan, and a second run
from the then known states emits the pieces.

*Tokens.*  The prefix of a BPE encoding is the encoding of a prefix, so its last token decides how it may
go on, and a token may follow another if the two together are encoded as just these two.  A state is
therefore the set of open trie paths, each with the token before it and the tokens counted since.  A
transition moves the paths on, finds the one token that may end here and counts the difference.
States that depend on the same open paths coincide, so their number follows the vocabulary's
affixes rather than the corpus's words.  Transitions are compiled when first needed, the library's own model
answering which tokens may follow each other, and are kept in a hash table that all pieces of a block
walk in step; a machine that has grown too large starts anew between blocks.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from chronoweave.llm.token_files import _byte_letters, plain_byte_level

RESET, SPACE, WHITE, LETTER, NUMBER, OTHER, QUOTE, ENDING, BEFORE_E, BEFORE_E2, ELL, E = range(12)
UNKNOWN = 255
#: Letters of contractions: 's 't 'm 'd, 're, 've, 'll.
MARKED = {"'": QUOTE, " ": SPACE, "s": ENDING, "t": ENDING, "m": ENDING, "d": ENDING, "r": BEFORE_E, "v": BEFORE_E2, "l": ELL, "e": E}
LETTERS = (LETTER, ENDING, BEFORE_E, BEFORE_E2, ELL, E)

START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, TO_SPACE, ONE_WHITE, TO_WHITE, QUOTED, WAITS_E, WAITS_L, DONE = range(12)
STATES, CLASSES = 12, 12

#: Bytes tokenised together, and characters of a chunk.
BLOCK_BYTES = 1 << 20
CHUNK = 128
#: Transitions after which a machine starts anew; the table keeps room for one more block.
MOST_TRANSITIONS = 1 << 20
SLOT_BITS = 22
#: Pieces below which a block's rest is walked one by one.
FEW = 24
#: A place where a piece ends whatever stands before: a mark, digit or letter before white space.
CUT = re.compile(rb"[!-~](?=[ \n\t\r])")


def _move(state: int, kind: int) -> tuple[int, int, int]:
    """Next state, whether a piece begins here, and whether one began a character earlier."""
    waits = state in (WAITS_E, WAITS_L)
    if kind == RESET:
        return START, 0, int(waits)
    if kind in (SPACE, WHITE):
        if state in (ONE_SPACE, TO_SPACE, ONE_WHITE, TO_WHITE):
            return (TO_SPACE if kind == SPACE else TO_WHITE), 0, 0
        return (ONE_SPACE if kind == SPACE else ONE_WHITE), 1, int(waits)
    if state == QUOTED:
        if kind in (ENDING, BEFORE_E, BEFORE_E2, ELL):
            return (DONE if kind == ENDING else WAITS_L if kind == ELL else WAITS_E), 0, 0
        if kind in (OTHER, QUOTE):
            return IN_OTHERS, 0, 0
    if (state == WAITS_E and kind == E) or (state == WAITS_L and kind == ELL):
        return DONE, 0, 0
    then = IN_LETTERS if kind in LETTERS else IN_NUMBERS if kind == NUMBER else IN_OTHERS
    # A last space belongs to the word after it; of several white characters the last one begins a piece.
    if state in (ONE_SPACE, TO_SPACE):
        return then, 0, int(state == TO_SPACE)
    if state == (IN_LETTERS if waits else then) or (waits and then == IN_LETTERS):
        return then, 0, int(waits)
    return (QUOTED if kind == QUOTE else then), 1, int(waits or state == TO_WHITE)


_TABLE = np.array([[_move(s, k) for k in range(CLASSES)] for s in range(STATES)], np.uint8).reshape(-1, 3)
NEXT, HERE, EARLIER = (np.ascontiguousarray(_TABLE[:, i]) for i in range(3))


def state_maps(rows: np.ndarray) -> np.ndarray:
    """State after each chunk for every state before it; ``rows`` has a column per chunk."""
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], rows.shape[1], axis=1)
    for row in rows:
        maps = NEXT[maps * np.uint8(CLASSES) + row]
    return np.ascontiguousarray(maps.T)


def entry_states(maps: np.ndarray) -> np.ndarray:
    """State before each chunk, from a prefix scan that composes the chunks' maps in doubling steps."""
    done, step = maps.copy(), 1
    while step < len(done):
        done[step:] = np.take_along_axis(done[step:], done[:-step], axis=1)
        step *= 2
    return np.concatenate(([np.uint8(START)], done[:-1, START]))


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each character; the last character must be a reset."""
    chunks = -(-len(kinds) // CHUNK)
    rows = np.zeros(chunks * CHUNK, np.uint8)
    rows[: len(kinds)] = kinds
    rows = np.ascontiguousarray(rows.reshape(chunks, CHUNK).T)
    state = entry_states(state_maps(rows))
    taken = np.empty_like(rows)
    for at, row in enumerate(rows):
        taken[at] = state * np.uint8(CLASSES) + row
        state = NEXT[taken[at]]
    flat = taken.T.ravel()[: len(kinds)]
    begins = HERE[flat].astype(bool)
    begins[:-1] |= EARLIER[flat[1:]].astype(bool)
    return begins


class TokenMachine:
    """Transducer from the bytes of a piece to its number of tokens, compiled as far as it is used."""

    def __init__(self, model, vocabulary: dict[str, int], most_transitions: int = MOST_TRANSITIONS, slot_bits: int = SLOT_BITS):
        self.model, self.most, self.bits = model, most_transitions, slot_bits
        self.names = {i: t for t, i in vocabulary.items()}
        back = {letter: byte for byte, letter in _byte_letters().items()}
        self.child, self.token, self.inner = {}, [-1], [False]
        for name, number in vocabulary.items():
            node = 0
            for letter in name:
                key = node << 8 | back[letter]
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = self.child[key]
            self.token[node] = number
        self.clear()

    def clear(self) -> None:
        """Forget all states but the first one."""
        # An open path: trie node, token before it (-1: none), tokens counted since it was opened.
        first = ((0, -1, 0),)
        self.states, self.paths, self.steps, self.follows = {first: 0}, [first], {}, {}
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.next, self.adds = np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.int16)

    def may_follow(self, before: int, token: int) -> bool:
        """Whether the two tokens are the encoding of their joined text; -1 stands for a piece's start."""
        key = before, token
        if key not in self.follows:
            name = self.names[token] if before < 0 else self.names[before] + self.names[token]
            wanted = [token] if before < 0 else [before, token]
            self.follows[key] = [t.id for t in self.model.tokenize(name)] == wanted
        return self.follows[key]

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and tokens added for a byte."""
        moved, last, since = [], None, 0
        for node, before, count in self.paths[state]:
            child = self.child.get(node << 8 | byte)
            if child is None:
                continue
            token = self.token[child]
            if last is None and token >= 0 and self.may_follow(before, token):
                last, since = token, count
            if self.inner[child]:
                moved.append((child, before, count))
        if last is None:
            raise ValueError("the vocabulary cannot encode every text")
        adds = 1 - since
        paths = (*((node, before, count + adds) for node, before, count in moved), (0, last, 0))
        after = self.states.setdefault(paths, len(self.paths))
        if after == len(self.paths):
            self.paths.append(paths)
        return after, adds

    def _slot(self, keys):
        return (keys * np.int64(0x9E3779B97F4A7C15 - (1 << 64))) >> np.int64(64 - self.bits) & np.int64((1 << self.bits) - 1)

    def _learn(self, keys: list[int]) -> None:
        with np.errstate(over="ignore"):
            slots = self._slot(np.array(keys, np.int64)).tolist()
        for key, slot in zip(keys, slots, strict=True):
            step = self.steps[key] = self._compile(key >> 8, key & 255)
            while self.keys[slot] >= 0:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.keys[slot] = key
            self.next[slot], self.adds[slot] = step

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """Slots of transitions, compiling those that are new."""
        with np.errstate(over="ignore"):
            slots = self._slot(keys)
        while True:
            held = self.keys[slots]
            off = np.flatnonzero(held != keys)
            if not len(off):
                return slots
            new = off[held[off] < 0]
            if len(new):
                self._learn(np.unique(keys[new]).tolist())
                with np.errstate(over="ignore"):
                    slots[new] = self._slot(keys[new])
                off = off[held[off] >= 0]
            slots[off] = (slots[off] + 1) & ((1 << self.bits) - 1)

    def _walk(self, piece: bytes, state: int, count: int) -> int:
        for byte in piece:
            key = state << 8 | byte
            if key not in self.steps:
                self._learn([key])
            state, adds = self.steps[key]
            count += adds
        return count

    def counts(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each piece of ``data``."""
        if len(self.steps) > self.most:
            self.clear()
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        found, state = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for at, left in enumerate(alive.tolist()):
            if left < FEW:
                for i in range(left):
                    piece = data[starts[i] + at : starts[i] + sizes[i]].tobytes()
                    found[i] = self._walk(piece, int(state[i]), int(found[i]))
                break
            slots = self._look(state[:left] << 8 | data[starts[:left] + at])
            found[:left] += self.adds[slots]
            state[:left] = self.next[slots]
        out = np.empty_like(found)
        out[order] = found
        return out


class Counter:
    """Token counts of texts under one tokenizer file."""

    def __init__(self, path: str, block_bytes: int = BLOCK_BYTES, most_transitions: int = MOST_TRANSITIONS, slot_bits: int = SLOT_BITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if not plain_byte_level(tokenizer):
            raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
        added = sorted((t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None
        # A text may be cut before white space unless an added token holds some.
        self.cut = None if any(re.search(rb"\s", a) for a in added) else CUT
        self.pieces_of, self.block_bytes = tokenizer.pre_tokenizer.pre_tokenize_str, block_bytes
        self.machine = TokenMachine(tokenizer.model, tokenizer.get_vocab(with_added_tokens=False), most_transitions, slot_bits)
        self.kinds = np.full(0x110000, UNKNOWN, np.uint8)
        self._classify(np.arange(128))
        for letter, kind in MARKED.items():
            self.kinds[ord(letter)] = kind

    def _classify(self, points: np.ndarray) -> None:
        """Ask the pre-tokenizer which run a character continues: one of letters, numbers, others or none."""
        for point in points.tolist():
            leads = (("a", LETTER), ("1", NUMBER), ("!", OTHER))
            self.kinds[point] = next((k for lead, k in leads if len(self.pieces_of(lead + chr(point))) == 1), WHITE)

    def _characters(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offset and class of every character."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[at]
        if len(at) == len(data):
            return at, self.kinds[lead]
        points = lead.astype(np.int32)
        for size, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0x100)):
            some = np.flatnonzero((lead >= low) & (lead < high))
            value = (lead[some] & (0x7F >> size)).astype(np.int32)
            for i in range(1, size):
                value = value << 6 | (data[at[some] + i] & 0x3F)
            points[some] = value
        kinds = self.kinds[points]
        new = points[kinds == UNKNOWN]
        if len(new):
            self._classify(np.unique(new))
            kinds = self.kinds[points]
        return at, kinds

    def _block(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of texts that are tokenised together."""
        joined = b"".join(texts)
        data, ends = np.frombuffer(joined, np.uint8), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        found = np.zeros(len(texts), np.int64)
        at, kinds = self._characters(data)
        # Added tokens lie inside one text each, so texts are searched one by one where any may hold one.
        for text, low in enumerate((ends - [len(t) for t in texts]).tolist() if self.added and self.added.search(joined) else ()):
            for match in self.added.finditer(texts[text]):
                found[text] += 1
                kinds[np.searchsorted(at, low + match.start()) : np.searchsorted(at, low + match.end())] = RESET
        # One reset follows every text.
        texts_of = np.searchsorted(ends, at, side="right")
        size = len(at) + len(texts)
        placed = np.arange(len(at)) + texts_of
        last = np.searchsorted(at, ends) + np.arange(len(texts))
        line, offsets = np.zeros(size, np.uint8), np.empty(size, np.int64)
        line[placed], offsets[placed], offsets[last] = kinds, at, ends
        begins = piece_starts(line)
        bounds = np.flatnonzero(begins | (line == RESET))
        piece = np.flatnonzero(begins[bounds])
        starts = offsets[bounds[piece]]
        tokens = self.machine.counts(data, starts, offsets[bounds[piece + 1]] - starts)
        texts_of = np.searchsorted(ends, starts, side="right")
        return found + np.bincount(texts_of, tokens, len(texts)).astype(np.int64)

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of each text, by blocks of bounded size; a longer text is cut where a piece ends anyway."""
        found, block, owners, held = np.zeros(len(texts), np.int64), [], [], 0

        def count() -> None:
            np.add.at(found, owners, self._block(block))
            block.clear()
            owners.clear()

        for row, text in enumerate(texts):
            low = 0
            while low < len(text):
                high = len(text)
                if self.cut and high - low > self.block_bytes:
                    cut = self.cut.search(text, low + self.block_bytes)
                    high = cut.end() if cut else high
                block.append(text[low:high])
                owners.append(row)
                held, low = held + high - low, high
                if held >= self.block_bytes:
                    count()
                    held = 0
        if block:
            count()
        return found


_COUNTERS: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    """The counter of this process, which later tasks use again."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, ``keep``, n_bytes (UTF-8) and n_tokens of the whole text.

    Counts are those of the tokenizers library without added begin or end tokens; a special token's string inside a text is
    that one token, as the library's default has it.  Null and empty texts have none.  Repeated rows
    keep their own row, other columns are not read, an empty table gives an empty one.  ``tokenizer``
    is the path of a byte-level BPE file that every executor can read; other kinds raise ValueError.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(counter.counts(texts))], names=["doc", "n_bytes", "n_tokens"]
            )

    read = docs.select(F.struct(F.col(doc_id).alias("doc_id"), *keep).alias("doc"), F.col(text).cast("string").alias("text"))
    schema = StructType([read.schema["doc"], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])
    return read.mapInArrow(counted, schema).select("doc.*", "n_bytes", "n_tokens")


def digest(counts: DataFrame, limit: int = 1_024) -> DataFrame:
    """Counts with over_limit, true of documents with more than ``limit`` tokens."""
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
