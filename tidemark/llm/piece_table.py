"""SentencePiece (BPE) encoding by a table of distinct chunks.

Where no piece holds a white-space marker after another character, no merge can
cross from one marked word into the next, so a text's ids are those of its
marked words, one after the other.  Three passes:

1. Texts are cut into marked words.  A task numbers the distinct ones of a batch
   of documents; the documents become lists of these numbers, and the distinct
   words go, packed, to the bucket of their hash.
2. A bucket meets all occurrences of its words, so each distinct word is
   segmented once (the table of a bucket is bounded; a full one is begun again).
   The ids go back to the batches they came from.
3. A batch puts the ids in the place of the numbers and decodes them.

What is shuffled is the distinct words of each batch and their ids, packed and
compressed.  Texts are not, and the numbers are written once, bucketed by batch,
where the third pass finds them without a shuffle.  A task holds the words and
numbers of one batch, of bounded size, or of one document where that is larger.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import _arrow_schema, map_stream, scratch_dir, text_or_empty

MARK = "▁"
# A batch ends with the document that reaches one of these.
BATCH_CHARS = 16_000_000
BATCH_WORDS = 400_000
# Documents are packed in rows of at least this many numbers.
ROW_NUMBERS = 1 << 16
# A text of more characters is cut lazily; ids of this many words are joined at once.
LAZY_CHARS = 1_000_000
JOIN_WORDS = 1 << 16
MAX_KNOWN = 500_000
# Longer words are merged with a heap.
SHORT = 40
NO_RANK = 1 << 60


class PieceModel(NamedTuple):
    """What encoding and decoding need of a model file."""
    ranks: dict[str, int]  # pieces that merges may make, the best score first
    ids: dict[str, int]
    byte_ids: list[int]
    texts: list[str | None]  # by id; None: a byte or control piece
    dummy_prefix: bool
    loners: str  # white space that no longer piece holds


def read_model(blob: bytes) -> PieceModel:
    """Parse a model file; raises where this method does not apply."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(blob)
    kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    if trainer.model_type != trainer.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback and leading markers")
    if normalizer.precompiled_charsmap or normalizer.remove_extra_whitespaces or not normalizer.escape_whitespaces:
        raise ValueError("only models that leave texts as they are")
    normal = [(k, p) for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
        raise ValueError("models with user-defined or unused pieces are not supported")
    crossing = [p.piece for _, p in normal if MARK in p.piece.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross white-space markers: {crossing[:3]}")
    scores = {s: n for n, s in enumerate(sorted({p.score for _, p in normal}, reverse=True))}
    byte_ids = [0] * 256
    for k, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            byte_ids[int(p.piece[3:5], 16)] = k
    held = set("".join(p.piece for _, p in normal if len(p.piece) > 1))
    return PieceModel({p.piece: scores[p.score] for _, p in normal}, {p.piece: k for k, p in normal}, byte_ids,
                      [p.piece.replace(MARK, " ") if p.type == kinds.NORMAL else None for p in model.pieces],
                      normalizer.add_dummy_prefix, "".join(c for c in "\t\n\v\f\r" if c not in held))


def share_model(spark: SparkSession, path: str) -> Broadcast:
    """The model, parsed on the driver (some ten thousand pieces) for all executors."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(read_model(f.read()))


class Pieces:
    """Marked words to ids, and ids to text."""

    def __init__(self, model: PieceModel):
        self.model = model
        cut = re.escape(model.loners)
        self.words = re.compile(f"{MARK}*[^{MARK}{cut}]+|{MARK}+" + (f"|[{cut}]+" if cut else ""))
        self.byte_of = {k: bytes([b]) for b, k in enumerate(model.byte_ids)}

    def marked(self, text: str) -> Iterator[str]:
        """The marked words of a text, in order."""
        if not text:
            return iter(())
        whole = text.replace(" ", MARK)
        if self.model.dummy_prefix:
            whole = MARK + whole
        if len(whole) <= LAZY_CHARS:
            return iter(self.words.findall(whole))
        return (found.group() for found in self.words.finditer(whole))

    def segment(self, word: str) -> list[str]:
        """Merge the neighbours whose union has the best score, leftmost on ties, until none is a piece."""
        return self._by_list(word) if len(word) <= SHORT else self._by_heap(word)

    def _by_list(self, word: str) -> list[str]:
        get, parts = self.model.ranks.get, list(word)
        ranks = [get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            k = ranks.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = get(parts[k] + parts[k + 1], NO_RANK)
            if k:
                ranks[k - 1] = get(parts[k - 1] + parts[k], NO_RANK)
        return parts

    def _by_heap(self, word: str) -> list[str]:
        get, parts, n = self.model.ranks.get, list(word), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, k, word[k:k + 2]) for k in range(n - 1) if (rank := get(word[k:k + 2], NO_RANK)) < NO_RANK]
        heapq.heapify(heap)
        while heap:
            _, left, made = heapq.heappop(heap)
            right = after[left]
            if not parts[left] or right >= n or parts[left] + parts[right] != made:
                continue  # one of the two has been merged meanwhile
            parts[left], parts[right] = made, ""
            after[left] = right = after[right]
            if right < n:
                before[right] = left
            for a, b in ((before[left], left), (left, right)):
                if a >= 0 and b < n and (rank := get(parts[a] + parts[b], NO_RANK)) < NO_RANK:
                    heapq.heappush(heap, (rank, a, parts[a] + parts[b]))
        return [p for p in parts if p]

    def encode(self, word: str) -> list[int]:
        """Ids of one marked word; what is no piece is spelled in bytes."""
        known, out = self.model.ids, []
        for part in self.segment(word):
            k = known.get(part)
            if k is None:
                out += [self.model.byte_ids[b] for b in part.encode("utf-8", "replace")]
            else:
                out.append(k)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids of one marked word, markers as spaces."""
        texts = [self.model.texts[k] for k in ids]
        if None not in texts:
            return "".join(texts)
        return b"".join(self.byte_of[k] if t is None else t.encode() for k, t in zip(ids, texts)).decode("utf-8", "replace")


_pieces: dict[int, Pieces] = {}


def pieces_of(shared: Broadcast) -> Pieces:
    """One table per worker process and model."""
    model = shared.value
    if id(model) not in _pieces:
        _pieces.clear()
        _pieces[id(model)] = Pieces(model)
    return _pieces[id(model)]


def pack(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers: those below 255 a byte each, of the others all lowest bytes first."""
    numbers = numbers.astype("<u4")
    large = numbers >= 255
    few = zstandard.compress(np.where(large, 255, numbers).astype(np.uint8).tobytes(), 3)
    planes = np.ascontiguousarray(numbers[large].view(np.uint8).reshape(-1, 4).T)
    return len(few).to_bytes(4, "little") + few + zstandard.compress(planes.tobytes(), 3)


def unpack(blob: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(blob[:4], "little")
    numbers = np.frombuffer(zstandard.decompress(blob[4:cut]), np.uint8).astype("<u4")
    planes = np.frombuffer(zstandard.decompress(blob[cut:]), np.uint8).reshape(4, -1)
    numbers[numbers == 255] = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return numbers


class _Numbers(dict):
    """A number for each new key."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def _pack_batches(rows: Iterator[tuple], pieces: Pieces, buckets: int) -> Iterator[tuple]:
    """(batch, bucket, docs, lengths, numbers, words); bucket -1 holds documents."""
    first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    count, held, numbers, chars = 0, [], _Numbers(), 0

    def batch_rows() -> Iterator[tuple]:
        # The most frequent word gets the smallest number, so that numbers pack well.
        often = np.bincount(np.concatenate([found for _, found in held]), minlength=len(numbers))
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        ids, parts, size = [], [], 0
        for doc, found in [*held, (None, None)]:
            if ids and (found is None or size >= ROW_NUMBERS):
                yield first + count, -1, ids, [len(p) for p in parts], pack(rank[np.concatenate(parts)]), None
                ids, parts, size = [], [], 0
            if found is not None:
                ids.append(doc)
                parts.append(found)
                size += len(found)
        words = list(numbers)
        words = [words[k] for k in order.tolist()]
        of = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) % buckets for w in words), np.int64, len(words))
        order = np.argsort(of, kind="stable")
        starts = np.flatnonzero(np.r_[True, of[order][1:] != of[order][:-1]]) if len(words) else []
        for low, high in zip(starts, [*starts[1:], len(words)]):
            mine = order[low:high]
            yield (first + count, int(of[mine[0]]), None, None, pack(np.diff(mine, prepend=0)),
                   zstandard.compress(" ".join([words[k] for k in mine]).encode("utf-8", "replace"), 3))

    for doc, text in rows:
        held.append((doc, np.fromiter(map(numbers.__getitem__, pieces.marked(text)), np.uint32)))
        chars += len(text)
        if chars >= BATCH_CHARS or len(numbers) >= BATCH_WORDS:
            yield from batch_rows()
            count, held, chars = count + 1, [], 0
            numbers.clear()
    if held:
        yield from batch_rows()


def _segment_words(rows: Iterator[tuple], pieces: Pieces) -> Iterator[tuple]:
    """(batch, numbers, sizes, ids) of the words of a bucket, each distinct word segmented once."""
    here, known = None, {}
    for batch, bucket, numbers, words in rows:
        if bucket != here:
            here, known = bucket, {}
        found = []
        for word in zstandard.decompress(words).decode("utf-8").split(" "):
            ids = known.get(word)
            if ids is None:
                if len(known) >= MAX_KNOWN:
                    known.clear()
                ids = known[word] = np.array(pieces.encode(word), "<u4").tobytes()
            found.append(ids)
        yield batch, numbers, pack(np.array([len(f) // 4 for f in found])), pack(np.frombuffer(b"".join(found), "<u4"))


def _put_back(docs: Iterator[tuple], ids: Iterator[tuple], pieces: Pieces, with_ids: bool) -> Iterator[tuple]:
    """The documents of a batch, rows (docs, lengths, numbers), with the ids of its words, rows (numbers, sizes, ids)."""
    names, texts, counts = _lookup(ids, pieces)
    for names_of, lengths, numbers in docs:
        of, start = unpack(numbers), 0
        for doc, length in zip(names_of, lengths):
            mine = of[start:start + length]
            start += length
            id_digest, text_digest = hashlib.sha256(), hashlib.sha256()
            for low in range(0, length, JOIN_WORDS):
                part = mine[low:low + JOIN_WORDS].tolist()
                text = "".join([texts[k] for k in part])
                text_digest.update((text[1:] if pieces.model.dummy_prefix and not low else text).encode("utf-8"))
                id_digest.update(("," * (low > 0) + ",".join([names[k] for k in part])).encode("ascii"))
            out = doc, int(counts[mine].sum()), id_digest.hexdigest(), text_digest.hexdigest()
            yield (*out, [int(k) for n in mine.tolist() for k in names[n].split(",")]) if with_ids else out


def _lookup(found: Iterator[tuple], pieces: Pieces) -> tuple[list[str], list[str], np.ndarray]:
    """By number: ids as decimals joined by commas, text, and count of ids."""
    parts = [(np.cumsum(unpack(n).astype(np.int64)), unpack(s).astype(np.int64), unpack(i)) for n, s, i in found]
    total = sum(len(n) for n, _, _ in parts)
    names, texts, counts = [""] * total, [""] * total, np.zeros(total, np.int64)
    for numbers, sizes, ids in parts:
        counts[numbers] = sizes
        ids, start = ids.tolist(), 0
        for number, size in zip(numbers.tolist(), sizes.tolist()):
            mine = ids[start:start + size]
            start += size
            names[number] = ",".join(map(str, mine))
            texts[number] = pieces.decode(mine)
    return names, texts, counts


def encode_documents(docs: DataFrame, model: Broadcast, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, token_ids]): one row per input row.

    A null or empty text has no ids (the digests are those of no bytes).  Every
    character of a text counts, white space too; what no piece covers is spelled
    in bytes.  The decoded text has a space for each marker.  Repeated rows each
    stay, a null id stays null, other columns are ignored; an empty table gives
    an empty one.
    """
    spark = docs.sparkSession
    wide = 2 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    packed = _bucketed(map_stream(
        source, ["id", "text"], f"batch long, bucket int, docs array<{kind}>, lengths array<int>, numbers binary, words binary",
        lambda rows: _pack_batches(rows, pieces_of(model), wide)), wide)

    words = packed.where("bucket >= 0").select("batch", "bucket", "numbers", "words") \
        .repartition(wide, "bucket").sortWithinPartitions("bucket")
    segmented = map_stream(words, ["batch", "bucket", "numbers", "words"], "batch long, numbers binary, sizes binary, ids binary",
                           lambda rows: _segment_words(rows, pieces_of(model)))
    documents = packed.where("bucket < 0").select("batch", "docs", "lengths", "numbers")
    out = spark.createDataFrame([], f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
                                + (", token_ids array<int>" if with_ids else "")).schema
    arrow_out = _arrow_schema(out)

    def put_back(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(zip(*_put_back(_rows(left, ["docs", "lengths", "numbers"]), _rows(right, ["numbers", "sizes", "ids"]),
                                    pieces_of(model), with_ids)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(found or [[]] * len(arrow_out), arrow_out)], schema=arrow_out)

    return documents.groupby("batch").cogroup(segmented.groupby("batch")).applyInArrow(put_back, out).withColumnRenamed("id", id_col)


def _rows(table: pa.Table, columns: list[str]) -> Iterator[tuple]:
    for batch in table.select(columns).to_batches():
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Write ``df`` to the shared folder, bucketed by batch, and read it back.

    The table is in the catalog only until its files are known to the frame.
    """
    spark, name = df.sparkSession, f"tidemark_pieces_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "batch").option("path", scratch_dir(spark, "piece-batches")).saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return written
