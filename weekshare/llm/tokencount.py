"""Token counts without token ids (operator 11).

Byte-level BPE never merges across pre-tokens, so a text's count is the sum of
its pre-tokens' counts, and each distinct pre-token need be encoded only once
for the whole corpus.

1. One map cuts every whole text into pre-tokens and keeps, per chunk of
   documents, the chunk's distinct pre-tokens and every document's frequencies
   of them (sorted numbers as differences, compressed). A chunk ends when its
   text or its dictionary is full, so a task's memory does not follow the data.
2. The chunks' dictionaries are dealt to shards by a hash of the pre-token, packed:
   one row per chunk and shard. A pre-token is there once per chunk, however often
   it occurs, so none is hotter than the number of chunks. A shard encodes each
   distinct pre-token once, by the vocabulary's library; only its number of pieces
   is kept, and goes back to the chunks that asked, in their own numbering.
3. The answers of a chunk join its documents' frequencies; a document's count is
   the sum of frequency times pieces.

Pre-tokens are cut by the vocabulary's published pattern. Character classes
differ between Unicode versions, so texts with a character that was unassigned
in Unicode 3.2 (emoji, for example) are cut by the library's own pre-tokeniser.

Defined cases: a null or empty text has no tokens; repeated ids and repeated
rows are counted each; null ids stay null; the literal of a special token in a
text is that one token, as the library's default has it; very long texts are
cut in slices before a blank that follows a character, where every pre-token
ends; one unbroken run is one pre-token; more columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_of, plain_texts, read_table, staged, text_batches
from .tokens import hash_words

LIMIT = 512                 # tokens; longer documents are flagged
CHUNK_BYTES = 16 << 20      # text per chunk; a longer text is its own chunk
CHUNK_PIECES = 1 << 19      # distinct pre-tokens per chunk, checked after each document
SHARD_BYTES = 64 << 20      # text per shard of the pre-tokens
SLICE = 1 << 20             # characters of a text cut at a time

# Rows of documents (shard NULL; ``packed`` holds their frequencies) and rows of
# pre-tokens (``packed`` holds their numbers in the chunk).
CHUNKS = ("chunk long, shard int, ids array<long>, n_bytes array<long>, specials array<long>, "
          "sizes array<int>, packed binary, n int, pieces binary")
COUNTS = "doc_id long, n_bytes long, n_tokens long"

_CUTTERS: dict = {}


def _assigned_in_3_2() -> str:
    """A character class of the code points that Unicode 3.2 assigns."""
    known = unicodedata.ucd_3_2_0
    runs, start = [], None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and known.category(chr(code)) not in ("Cn", "Cs")
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            runs.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(runs)


class Cutter:
    """Pre-tokens of a text, and their number of pieces, for one vocabulary file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark deals out the cores
        self.library = Tokenizer.from_file(path)
        self._find = regex.compile(public_tokenizers.PATTERN).findall
        self._unsure = re.compile(f"[^{_assigned_in_3_2()}]").search
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) \
            if special else None

    def cut(self, text: str) -> tuple[Counter, int]:
        """Frequencies of the pre-tokens, and the number of special tokens."""
        parts = self._special.split(text) if self._special else [text]
        freqs: Counter = Counter()
        for part in parts:
            for piece in slices(part):
                if piece.isascii() or not self._unsure(piece):
                    freqs.update(self._find(piece))
                else:
                    freqs.update(piece[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(piece))
        return freqs, len(parts) - 1

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch(pre_tokens, add_special_tokens=False)]


def slices(text: str, limit: int = SLICE) -> Iterator[str]:
    """Parts of about ``limit`` characters, cut where a blank follows a
    character that is no white space: a pre-token ends there in any case."""
    start = 0
    while len(text) - start > limit:
        at = text.find(" ", start + limit)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    if start < len(text):
        yield text[start:] if start else text


def _cutter(path: str | None) -> Cutter:
    if path not in _CUTTERS:
        import public_tokenizers

        _CUTTERS[path] = Cutter(path or public_tokenizers.path("byte_bpe_50k.json"))
    return _CUTTERS[path]


def pack_numbers(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, byte plane by byte plane: planes of zeros vanish."""
    planes = np.concatenate(columns).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(packed: bytes, n: int, columns: int) -> np.ndarray:
    """``columns`` rows of ``n`` numbers."""
    raw = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, 4 * n * columns))
    planes = np.frombuffer(raw, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(columns, n).astype(np.int64)


def pack_freqs(numbers: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> bytes:
    """Each document's pre-token numbers, sorted, as differences, and their counts."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(doc << 32 | numbers, kind="stable")
    numbers, counts = numbers[order], counts[order]
    step = np.diff(numbers, prepend=numbers[:1])
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    step[first] = numbers[first]
    return pack_numbers(step, counts)


def unpack_freqs(packed: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(numbers, counts)`` of all documents, one after the other."""
    step, counts = unpack_numbers(packed, int(sizes.sum()), 2)
    upto = np.concatenate([[0], np.cumsum(step)])
    begin = np.cumsum(sizes) - sizes
    return upto[1:] - np.repeat(upto[begin], sizes), counts     # each document starts anew


def pack_pieces(pieces: list[bytes]) -> bytes:
    lengths = np.array([len(p) for p in pieces], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(lengths + b"".join(pieces))


def unpack_pieces(packed: bytes, n: int) -> list[str]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    ends = np.cumsum(np.frombuffer(raw, "<u4", n)) + 4 * n
    return [raw[a:b].decode() for a, b in zip([4 * n, *ends.tolist()], ends.tolist())]


def _chunks(path: str | None, shards: int):
    names = ["chunk", "shard", "ids", "n_bytes", "specials", "sizes", "packed", "n", "pieces"]
    kinds = [pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 3, pa.list_(pa.int32()), pa.binary(),
             pa.int32(), pa.binary()]

    def rows_of(chunk, index, ids, n_bytes, specials, sizes, numbers, counts) -> pa.RecordBatch:
        freqs = pack_freqs(np.array(numbers, np.int64), np.array(counts, np.int64), np.array(sizes, np.int64))
        rows = [(chunk, None, ids, n_bytes, specials, sizes, freqs, None, None)]
        pieces = [p.encode() for p in index]
        lengths = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        of = (hash_words(data, np.cumsum(lengths) - lengths, lengths) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        cut = np.flatnonzero(np.diff(of[order])) + 1
        for part in np.split(order, cut) if len(order) else []:
            rows.append((chunk, int(of[part[0]]), None, None, None, None,
                         pack_numbers(np.diff(part, prepend=0)), len(part),
                         pack_pieces([pieces[k] for k in part.tolist()])))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(path)
        chunk = TaskContext.get().partitionId() << 33

        def fresh():
            return defaultdict(count().__next__), [], [], [], [], array("I"), array("I")

        held, state = 0, fresh()
        for batch in text_batches(batches):
            for doc, text in zip(batch.column("doc_id").to_pylist(),
                                 plain_texts(batch.column("text")).to_pylist()):
                size = len(text.encode())
                if state[1] and (held + size > CHUNK_BYTES or len(state[0]) > CHUNK_PIECES):
                    yield rows_of(chunk, *state)
                    chunk, held, state = chunk + 1, 0, fresh()
                index, ids, n_bytes, specials, sizes, numbers, counts = state
                freqs, special = cutter.cut(text)
                numbers.extend(map(index.__getitem__, freqs))
                counts.extend(freqs.values())
                for column, value in ((ids, doc), (n_bytes, size), (specials, special), (sizes, len(freqs))):
                    column.append(value)
                held += size
        if state[1]:
            yield rows_of(chunk, *state)
    return run


def _answers(path: str | None):
    """Rows of pre-tokens, ordered by shard -> their numbers of pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = _cutter(path)
        at, known = None, {}
        for batch in batches:
            out = []
            for i, (shard, n) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("n").to_pylist())):
                if shard != at:
                    at, known = shard, {}
                pieces = unpack_pieces(batch.column("pieces")[i].as_py(), n)
                new = [p for p in pieces if p not in known]
                known.update(zip(new, cutter.pieces(new)))
                out.append(pack_numbers(np.fromiter(map(known.__getitem__, pieces), np.int64, n)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("n"), batch.column("packed"), pa.array(out, pa.binary())],
                names=["chunk", "n", "numbers", "counts"])
    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            def column(name, i=i):
                return batch.column(name)[i].values

            sizes = column("sizes").to_numpy(zero_copy_only=False).astype(np.int64)
            answers = batch.column("answers")[i].as_py() or []
            pieces = np.zeros(sum(a["n"] for a in answers), np.int64)
            for a in answers:
                pieces[np.cumsum(unpack_numbers(a["numbers"], a["n"], 1)[0])] = \
                    unpack_numbers(a["counts"], a["n"], 1)[0]
            numbers, counts = unpack_freqs(batch.column("packed")[i].as_py(), sizes)
            upto = np.concatenate([[0], np.cumsum(pieces[numbers] * counts)])
            ends = np.cumsum(sizes)
            total = upto[ends] - upto[ends - sizes] + column("specials").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [column("ids"), column("n_bytes"), pa.array(total, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row's whole text.

    ``vocabulary`` is a byte-level BPE file of the ``tokenizers`` library, as
    the executors see it; by default each asks the public tokenizers package.
    """
    rows = docs.selectExpr(f"cast(`{id_col}` AS long) AS doc_id", f"`{text_col}` AS text")
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(buckets_of(docs.sparkSession), -(-size // SHARD_BYTES))
    chunks = staged(rows.mapInArrow(_chunks(vocabulary, shards), CHUNKS), "tokencount-chunks", "uncompressed")
    asked = chunks.where("shard IS NOT NULL").select("chunk", "shard", "packed", "n", "pieces")
    # A chunk without pre-tokens (only empty texts) has no answers.
    answers = (asked.repartition("shard").sortWithinPartitions("shard")
               .mapInArrow(_answers(vocabulary), "chunk long, n int, numbers binary, counts binary")
               .groupBy("chunk").agg(F.collect_list(F.struct("n", "numbers", "counts")).alias("answers")))
    return (chunks.where("shard IS NULL").select("chunk", "ids", "n_bytes", "specials", "sizes", "packed")
            .join(answers, "chunk", "left").drop("chunk").mapInArrow(_sums, COUNTS))


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    return (count_tokens(read_table(spark, sf_dir, "documents"))
            .withColumn("over_limit", F.col("n_tokens") > LIMIT))
