"""Token-id output: ORC files with run-length encoded ids, row indexes and Bloom filters on the id.

Documents are range-partitioned by id, tokenised where they arrive and written one row per document,
so a file covers a range of ids and its stripes, row index and Bloom filters let a reader skip to a
document.  Rows also hold their file's number and the tokens before them in it; with the totals per
file, which a reader sums from one column, every document's global offset follows without a window
over the corpus.

A byte-level tokenizer with the usual pre-tokenizer never merges over a single space between two other
characters, so a text is cut there and each distinct piece is encoded once per task.  Under any other
tokenizer every text is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from chronoweave.llm.common import parts_for, running_before
from chronoweave.scratch import hadoop_path, scratch_root, write_scratch
from chronoweave.skew import BROADCAST_ROWS

END = 2
#: Pieces a process remembers, at some 200 bytes each.
MEMORY_PIECES = 1_000_000
#: Marks that end a word without joining it.
MARKS = frozenset(".,;:!?")
#: Longest piece that is remembered, in characters.
PIECE_LENGTH = 64
#: Tokens of a batch handed on at once.
BATCH_TOKENS = 500_000

ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
    "compression": "zstd",
}

#: The pre-tokenizer whose pieces end at single spaces, and parts of a model that must be absent or off for them.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
UNUSED = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")

#: A space that has white space beside it, or stands at an end, does not always begin a token.
_RARE_SPACE = re.compile(r"[^\S \n]")
_ASCII_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_PLAIN_SPACE = re.compile(r"(?<=\S) (?=\S)")


def _odd_spaces(text: str) -> bool:
    return (
        text[0] == " "
        or text[-1] == " "
        or "  " in text
        or "\n " in text
        or " \n" in text
        or (any(c in text for c in _ASCII_SPACE) if text.isascii() else _RARE_SPACE.search(text) is not None)
    )


def _byte_letters() -> dict[int, str]:
    """Letter that stands for each byte in a byte-level vocabulary, keyed by the byte.

    Printable bytes stand for themselves, the others for the letters from 256 on in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


def plain_byte_level(tokenizer) -> bool:
    """Whether a tokenizer is byte-level BPE with the usual pre-tokenizer and nothing else.

    Its parts are asked one by one: the whole of it as text takes more memory than the tokenizer itself.
    """
    from tokenizers.models import BPE

    model, before = tokenizer.model, tokenizer.pre_tokenizer
    plan = json.loads(before.__getstate__()) if before is not None else {}
    return (
        isinstance(model, BPE)
        and not any(getattr(model, part) for part in UNUSED)
        and all(plan.get(k) == v for k, v in PRE_TOKENIZER.items())
        and tokenizer.normalizer is None
        and not any(t.single_word or t.lstrip or t.rstrip for t in tokenizer.get_added_tokens_decoder().values())
    )


class Memory:
    """Two generations of remembered pieces: the older one goes when the younger one is full."""

    def __init__(self, most: int):
        self.half, self.young, self.old = most // 2, {}, {}

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Encoder:
    """Token ids of texts, with a memory of pieces already encoded.

    Truncation and padding that the file may ask for are off: ids are those of whole texts.
    """

    def __init__(self, path: str, pieces: int = MEMORY_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_piece = plain_byte_level(self.tokenizer)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        # Texts that contain a special token's string are encoded whole.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.starts, self.rest = Memory(pieces), Memory(pieces // 8), Memory(pieces // 8)
        self.marks = {mark: self._encode(mark) for mark in MARKS}

    def _encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}i", *ids)

    def _word(self, word: str, memory: Memory, lead: str) -> bytes:
        """Ids of letters after ``lead`` (a space or nothing), which are one unit of the tokenizer."""
        ids = memory.young.get(word)
        if ids is None:
            ids = memory.old.get(word)
            if ids is None:
                unit = (lead + word).encode().decode("latin-1").translate(self.letters)
                tokens = [t.id for t in self.model.tokenize(unit)]
                ids = struct.pack(f"<{len(tokens)}i", *tokens)
            if len(word) <= PIECE_LENGTH:
                memory.put(word, ids)
        return ids

    def _piece(self, piece: str, lead: str = " ") -> bytes:
        """Ids of ``lead`` and a piece of text without plain spaces."""
        if "\n" not in piece:
            return self._line(piece, lead)
        lines, out = piece.split("\n"), []
        for at, (head, tail) in enumerate(zip(lines, lines[1:])):
            # A line break between two other characters is a unit of its own.
            if not head or not tail or head[-1].isspace() or tail[0].isspace():
                out.append(self._other(lead + "\n".join(lines[at:])))
                return b"".join(out)
            out += (self._line(head, lead), self._other("\n"))
            lead = ""
        out.append(self._line(lines[-1], lead))
        return b"".join(out)

    def _line(self, line: str, lead: str) -> bytes:
        """Ids of ``lead`` and text without plain spaces and line breaks."""
        memory = self.words if lead else self.starts
        if line.isalpha():
            return self._word(line, memory, lead)
        # Letters before one mark at the end are a unit of their own.
        if line[:-1].isalpha() and line[-1] in MARKS:
            return self._word(line[:-1], memory, lead) + self.marks[line[-1]]
        return self._other(lead + line)

    def _other(self, text: str) -> bytes:
        memory = self.rest
        ids = memory.young.get(text) or memory.old.get(text)
        if ids is None:
            ids = self._encode(text)
        if len(text) <= PIECE_LENGTH and text not in memory.young:
            memory.put(text, ids)
        return ids

    def ids(self, text: str) -> bytes:
        """Ids of a text and the end id, as little-endian 32-bit integers."""
        if not text or not self.by_piece or any(s in text for s in self.special):
            return self._encode(text) + END.to_bytes(4, "little")
        pieces = _PLAIN_SPACE.split(text) if _odd_spaces(text) else text.split(" ")
        out = list(map(self.words.young.get, pieces))
        out[0] = self._piece(pieces[0], "")
        if None in out:
            known, marks, other = self.words.young.get, self.marks.get, self._piece
            for at, ids in enumerate(out):
                if ids is None:
                    piece = pieces[at]
                    # Only letters are remembered as words, so a known word before a mark needs no other look.
                    word, mark = known(piece[:-1]), marks(piece[-1:])
                    out[at] = other(piece) if word is None or mark is None else word + mark
        out.append(END.to_bytes(4, "little"))
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The encoder of this process, which later tasks use again."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encode_batches(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = _encoder(path), TaskContext.get().partitionId(), 0

        def batch_of(ids, docs, starts) -> pa.RecordBatch:
            sizes = np.fromiter((len(b) // 4 for b in ids), np.int64, len(ids))
            ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends), flat)
            columns = [docs, pa.array([part] * len(ids), pa.int32()), pa.array(starts), pa.array(sizes), lists]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "before", "n_tokens", "ids"])

        for batch in batches:
            ids, starts, first, held = [], [], 0, 0
            for row, text in enumerate(batch.column(1)):
                ids.append(encoder.ids(text.as_py() or ""))
                starts.append(before)
                before += len(ids[-1]) // 4
                held += len(ids[-1]) // 4
                if held >= BATCH_TOKENS:
                    yield batch_of(ids, batch.column(0).slice(first, len(ids)), starts)
                    ids, starts, first, held = [], [], row + 1, 0
            if ids:
                yield batch_of(ids, batch.column(0).slice(first, len(ids)), starts)

    return encode


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, doc_id: str = "doc_id", text: str = "text", parts: int | None = None
) -> str:
    """Write the token ids of every document to ORC files at ``path`` in ascending order of doc_id.

    Columns: doc_id, part (the file), before (tokens before the row in it), n_tokens, ids.  Null and
    empty texts have the end id only.  Null ids come first; rows of equal id stand in order of their
    text, so repeated rows follow each other.  Other columns are not read.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.md5("text")]
    ranged = read.repartitionByRange(parts or parts_for(docs), *order).sortWithinPartitions(*order)
    schema = StructType(
        [
            read.schema["doc_id"],
            StructField("part", IntegerType()),
            StructField("before", LongType()),
            StructField("n_tokens", LongType()),
            StructField("ids", ArrayType(IntegerType())),
        ]
    )
    ranged.mapInArrow(_encode_batches(tokenizer), schema).write.options(**ORC_OPTIONS).orc(path)
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files at ``path``: doc_id, start (tokens before it in all files), n_tokens, ids."""
    rows = spark.read.orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row per file; files are numbered in cells so that no number of them meets in one task.
    totals = write_scratch(totals.withColumn("cell", F.floor(F.col("part") / 1_000)), "token-totals").df
    at = running_before(totals, [], "cell", ["part"], F.col("total"), "offset").select("part", "offset")
    at = F.broadcast(at) if totals.count() <= BROADCAST_ROWS else at
    return rows.join(at, "part").select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids")


def _crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        flat = lists.flatten().to_numpy().astype("<u4", copy=False)
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(crcs, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def digest(tokens: DataFrame) -> DataFrame:
    """Offsets and checksums of the ids that :func:`read_tokens` gives."""
    schema = StructType([tokens.schema["doc_id"], *(StructField(c, LongType()) for c in ("start", "n_tokens", "ids_crc32"))])
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(_crc32, schema)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files in the shared scratch folder."""
    import uuid

    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Rows of some documents; row indexes and Bloom filters prune what is read."""
    return spark.read.orc(path).filter(F.col("doc_id").isin(ids))


def discard(spark: SparkSession, path: str) -> None:
    """Remove written token files."""
    fs, at = hadoop_path(spark, path)
    fs.delete(at, True)
