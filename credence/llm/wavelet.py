"""Token ids as wavelet matrices, one per shard, in one compressed file per range of documents.

File format: the ids of the documents in ascending order are cut into shards of at most
``SHARD_TOKENS`` ids, never inside a document (a longer document is a shard of its own). A shard is
one blob: a header, the zstd-compressed bit planes of its wavelet matrix from the highest bit down,
and the documents' ids and lengths. A part file holds the blobs of one range of documents and is
written by Spark's own committer, so any store will do and a lost executor leaves no half files.

``WaveletMatrix`` answers access, rank, select and count on the planes with popcounts per block,
without decoding the ids.

Defined results: null text is the empty text and encodes to the end id alone; rows with equal
document ids are ordered by their text, a null id comes first; an empty table stays empty.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credence.llm.text_kernel import blocks, text_buffer
from credence.llm.work import new_folder

END_ID = 2
SHARD_TOKENS = 1 << 19
MAGIC = b"WVM1"
BATCH_BYTES = 12 << 20
#: Words whose ids a Python process keeps from one batch to the next.
KNOWN_WORDS = 1_000_000
_SMALL = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"  # not U+0130: its small form is two characters
_SIGNS = re.compile(r"[!-&(-/:;=-@\[-`{-~]+")


class WaveletMatrix:
    """Bit planes of a sequence of ids; plane 0 holds the highest bit."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.depth = len(planes)
        self._ranks: list[np.ndarray] | None = None

    @classmethod
    def from_ids(cls, ids: np.ndarray) -> WaveletMatrix:
        """Splits the ids by bit after bit, each time stably, zeros first."""
        top = int(ids.max()) if len(ids) else 0
        level = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
        planes, zeros = [], []
        for shift in range(max(top.bit_length(), 1) - 1, -1, -1):
            ones = (level & level.dtype.type(1 << shift)).astype(bool)
            planes.append(np.packbits(ones, bitorder="little"))
            low = level.compress(~ones)
            zeros.append(len(low))
            level = np.concatenate((low, level.compress(ones)))
        return cls(len(ids), planes, zeros)

    def ids(self) -> np.ndarray:
        """All ids in order: the splits undone from the lowest bit up."""
        kind = np.uint16 if self.depth <= 16 else np.uint32
        level = np.zeros(self.n, kind)
        for depth in range(self.depth - 1, -1, -1):
            ones = np.unpackbits(self.planes[depth], count=self.n, bitorder="little").view(bool)
            level[self.zeros[depth]:] |= kind(1 << (self.depth - 1 - depth))
            above = np.empty(self.n, kind)
            above[np.flatnonzero(~ones)] = level[:self.zeros[depth]]
            above[np.flatnonzero(ones)] = level[self.zeros[depth]:]
            level = above
        return level

    def _rank1(self, depth: int, position: int) -> int:
        """Ones in the plane before the position."""
        if self._ranks is None:
            self._ranks = []
            for plane in self.planes:
                counts = np.bitwise_count(np.pad(plane, (0, -len(plane) % 64)).reshape(-1, 64))
                self._ranks.append(np.concatenate(([0], np.cumsum(counts.sum(1, dtype=np.int64)))))
        block, rest = divmod(position, 512)
        inside = self.planes[depth][block * 64:block * 64 + -(-rest // 8)].copy()
        if rest % 8:
            inside[-1] &= (1 << rest % 8) - 1
        return int(self._ranks[depth][block]) + int(np.bitwise_count(inside).sum())

    def _bit(self, depth: int, position: int) -> int:
        return int(self.planes[depth][position >> 3]) >> (position & 7) & 1

    def access(self, position: int) -> int:
        """The id at a position."""
        value = 0
        for depth in range(self.depth):
            bit, ones = self._bit(depth, position), self._rank1(depth, position)
            value = value << 1 | bit
            position = self.zeros[depth] + ones if bit else position - ones
        return value

    def _descend(self, value: int, first: int, last: int) -> tuple[int, int]:
        for depth in range(self.depth):
            a, b = self._rank1(depth, first), self._rank1(depth, last)
            if value >> (self.depth - 1 - depth) & 1:
                first, last = self.zeros[depth] + a, self.zeros[depth] + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, value: int, first: int = 0, last: int | None = None) -> int:
        """Occurrences of an id in a range of positions."""
        if value >> self.depth:
            return 0
        a, b = self._descend(value, first, self.n if last is None else last)
        return b - a

    def select(self, value: int, k: int) -> int:
        """Position of the k-th occurrence of an id, from 0; -1 if there are fewer."""
        if value >> self.depth:
            return -1
        first, last = self._descend(value, 0, self.n)
        if k >= last - first:
            return -1
        position = first + k
        for depth in range(self.depth - 1, -1, -1):
            bit = value >> (self.depth - 1 - depth) & 1
            rank = position - self.zeros[depth] if bit else position
            low, high = 0, self.n
            while low < high:  # the position whose rank among equal bits is ``rank``
                middle = (low + high) // 2
                ones = self._rank1(depth, middle + 1)
                if (ones if bit else middle + 1 - ones) > rank:
                    high = middle
                else:
                    low = middle + 1
            position = low
        return position

    def to_bytes(self) -> bytes:
        pack = zstandard.ZstdCompressor(level=1)
        parts = [struct.pack("<QB", self.n, self.depth)]
        for plane, zeros in zip(self.planes, self.zeros):
            body = pack.compress(plane.tobytes())
            parts += [struct.pack("<QI", zeros, len(body)), body]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, blob) -> WaveletMatrix:
        unpack, view = zstandard.ZstdDecompressor(), memoryview(blob)
        n, depth = struct.unpack_from("<QB", view)
        at, planes, zeros = 9, [], []
        for _ in range(depth):
            z, size = struct.unpack_from("<QI", view, at)
            at += 12
            planes.append(np.frombuffer(unpack.decompress(view[at:at + size]), np.uint8))
            zeros.append(z)
            at += size
        return cls(n, planes, zeros)


def shard_blob(ids: np.ndarray, doc_ids: np.ndarray, known: np.ndarray, sizes: np.ndarray) -> bytes:
    """A shard: its matrix, then document ids, which of them are known, and lengths."""
    matrix = WaveletMatrix.from_ids(ids).to_bytes()
    index = zstandard.ZstdCompressor(level=1).compress(
        doc_ids.astype("<i8").tobytes() + known.astype("u1").tobytes()
        + sizes.astype("<u4").tobytes())
    return MAGIC + struct.pack("<QII", len(matrix), len(doc_ids), len(index)) + matrix + index


def open_shard(blob) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """(matrix, document ids, which of them are known, lengths) of a shard."""
    view = memoryview(blob)
    if bytes(view[:4]) != MAGIC:
        raise ValueError("not a wavelet shard")
    size, docs, index = struct.unpack_from("<QII", view, 4)
    matrix = WaveletMatrix.from_bytes(view[20:20 + size])
    raw = zstandard.ZstdDecompressor().decompress(view[20 + size:20 + size + index])
    return (matrix, np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, "u1", docs, 8 * docs) > 0,
            np.frombuffer(raw, "<u4", docs, 9 * docs))


class WordEncoder:
    """Token ids of texts, by way of their distinct words.

    The vocabulary's splitter never joins what a blank parts, nor a Latin letter or digit with a
    sign after it (other than an apostrophe or a special token's), so a text's ids are those of such pieces in order. ``probe`` checks
    that of the file; without it whole texts are encoded. Pieces of letters only, or of signs only,
    are encoded many at a time; as each then is one word to the model, the tokens that end a word
    tell them apart, and their number must be that of the pieces. Other pieces go one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        probe = "Isn't 12ab\tof the; ab.cd,\n end, \u00e1! <|endoftext|>x  y"
        whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
        pieces = pc.ascii_split_whitespace(self.apart(pa.array([probe])))[0].as_py()
        # The same model without the normaliser, for words that it leaves as they are.
        self.direct = Tokenizer.from_file(path)
        self.direct.normalizer = None
        self.direct.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words = pa.array([], pa.large_string())
        self.begins = self.sizes = self.flat = np.zeros(0, np.int32)
        self.by_word = whole == [i for w in pieces for i in
                                 self.tokenizer.encode(w, add_special_tokens=False).ids]

    @staticmethod
    def apart(column: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(column, f"([{_LETTERS}0-9])([!-&(-/:;=?@\\[-`{{}}~])", r"\1 \2")

    @staticmethod
    def lowered(column: pa.Array) -> pa.Array:
        """A-Z in lower case, where the vocabulary would do the same.

        Not with marks of special tokens, nor with combining accents (lead bytes CC and CD), which
        compose with some small letters only.
        """
        data = text_buffer(column)[0]
        if ((data & 0xFE) == 0xCC).any() or pc.any(pc.match_substring(column, "<|")).as_py():
            return column
        return pc.ascii_lower(column)

    def pieces(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin of each word's, number of each word's)."""
        words = column.to_pylist()
        begins, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        is_small = pc.match_substring_regex(column, _SMALL).to_numpy(zero_copy_only=False)
        small, plain, others = np.flatnonzero(is_small).tolist(), [], []
        for i in np.flatnonzero(~is_small).tolist():
            (plain if words[i].isalpha() or _SIGNS.fullmatch(words[i]) else others).append(i)
        pool, held = [], 0
        for tokenizer, own in ((self.direct, small), (self.tokenizer, plain)):
            chunks = [own[i:i + 1000] for i in range(0, len(own), 1000)]
            for k in range(0, len(chunks), 16):
                encoded = tokenizer.encode_batch_fast(
                    [" ".join([words[i] for i in c]) for c in chunks[k:k + 16]],
                    add_special_tokens=False)
                for chunk, e in zip(chunks[k:k + 16], encoded):
                    ids = np.array(e.ids, np.int64)
                    stops = np.flatnonzero(self.ends_word[ids]) + 1
                    if len(stops) != len(chunk):
                        others += chunk
                        continue
                    begins[chunk] = held + np.append(0, stops[:-1])
                    sizes[chunk] = np.diff(stops, prepend=0)
                    pool.append(ids)
                    held += len(ids)
        for k in range(0, len(others), 5000):
            chunk = others[k:k + 5000]
            encoded = self.tokenizer.encode_batch_fast([words[i] for i in chunk],
                                                       add_special_tokens=False)
            for i, e in zip(chunk, encoded):
                begins[i], sizes[i] = held, len(e.ids)
                pool.append(np.array(e.ids, np.int64))
                held += len(e.ids)
        return np.concatenate(pool or [np.zeros(0, np.int64)]), begins, sizes

    def known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``pieces``, where words of earlier batches need no encoding.

        Once ``KNOWN_WORDS`` are passed, only the batch's own are kept.
        """
        at = pc.index_in(words, value_set=self.words)
        fresh = np.asarray(at.is_null())
        at = at.fill_null(0).to_numpy().astype(np.int64)
        flat, begins, sizes = self.pieces(words.filter(pa.array(fresh)))
        if len(self.words) + len(begins) > KNOWN_WORDS:
            kept, at[~fresh] = at[~fresh], np.arange(len(at) - len(begins))
            own = self.sizes[kept].astype(np.int64)
            tops = np.cumsum(own)
            self.flat = self.flat[np.repeat(self.begins[kept] - tops + own, own)
                                  + np.arange(own.sum())]
            self.words, self.begins, self.sizes = self.words.take(pa.array(kept)), tops - own, own
        at[fresh] = len(self.words) + np.arange(len(begins))
        self.words = pa.concat_arrays([self.words, words.filter(pa.array(fresh))])
        self.begins, self.sizes, self.flat = (
            np.concatenate(x).astype(np.int32) for x in (
                (self.begins, begins + len(self.flat)), (self.sizes, sizes), (self.flat, flat)))
        return self.flat, self.begins[at].astype(np.int64), self.sizes[at].astype(np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per text)."""
        column = column.fill_null("")
        if not self.by_word:
            found = self.tokenizer.encode_batch(column.to_pylist(), add_special_tokens=False)
            sizes = np.array([len(e.ids) for e in found], np.int64)
            return np.array([i for e in found for i in e.ids], np.int64), sizes
        words = pc.ascii_split_whitespace(self.lowered(self.apart(column)))
        edges = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        flat, begins, sizes = self.known(coded.dictionary.cast(pa.large_string()))
        order = coded.indices.to_numpy(zero_copy_only=False)
        del words, coded
        size = sizes[order]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = flat[np.repeat(begins[order] - total[:-1], size) + np.arange(total[-1])]
        edges -= edges[0]
        return ids, total[edges[1:]] - total[edges[:-1]]


@functools.cache
def encoder_of(path: str) -> WordEncoder:
    """The vocabulary's encoder, read once by a Python process whatever number of tasks it runs."""
    return WordEncoder(path)


def write_shards(docs: DataFrame, vocabulary: str, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> str:
    """Writes all texts' ids in ascending order of documents; returns the folder of the files.

    ``part`` numbers the ranges of documents in order, ``shard`` the shards within one, and
    ``start`` counts the ids before a shard within its range.
    """
    def encode(batches):
        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        part, encoder = TaskContext.get().partitionId(), encoder_of(vocabulary)
        shard = start = held = 0
        ids, doc_ids, known, sizes = [], [], [], []

        def flush():
            nonlocal shard, start, held, ids, doc_ids, known, sizes
            blob = shard_blob(np.concatenate(ids), np.concatenate(doc_ids),
                              np.concatenate(known), np.concatenate(sizes))
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                 pa.array([start], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([blob], pa.binary())], ["part", "shard", "start", "n_ids", "blob"])
            shard, start, held = shard + 1, start + held, 0
            ids, doc_ids, known, sizes = [], [], [], []
            return row

        for whole in batches:
            for at, end in blocks(text_buffer(whole.column("text"))[1], BATCH_BYTES):
                batch = whole.slice(at, end - at)
                found, lengths = encoder.encode(batch.column("text"))
                ends = np.cumsum(lengths)
                found, lengths = np.insert(found, ends, end_id), lengths + 1
                ends = np.cumsum(lengths)
                key = batch.column("doc_id")
                valid = np.asarray(key.is_valid())
                key = key.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                first = 0
                while first < len(lengths):
                    begin = ends[first] - lengths[first]
                    last = int(np.searchsorted(ends, begin + shard_tokens - held, "right"))
                    if last == first and not held:
                        last = first + 1
                    if last > first:
                        ids.append(found[begin:ends[last - 1]])
                        doc_ids.append(key[first:last])
                        known.append(valid[first:last])
                        sizes.append(lengths[first:last])
                        held += int(ends[last - 1] - begin)
                    if last < len(lengths):
                        yield flush()
                    first = last
        if held:
            yield flush()

    path = f"{new_folder(docs.sparkSession)}/wavelet"
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
     .repartitionByRange(F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(encode, "part int, shard int, start long, n_ids long, blob binary")
     .write.parquet(path))
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``first``, the position of their first id in the whole corpus.

    The sums run over the ranges of documents, whose number the session's partitions bound.
    """
    shards = spark.read.schema(
        "part int, shard int, start long, n_ids long, blob binary").parquet(path)
    parts = sorted((r["part"], r["n"]) for r in shards.groupBy("part").agg(
        F.sum("n_ids").alias("n")).collect())
    offsets, total = [], 0
    for part, n in parts:
        offsets.append((part, total))
        total += n
    known = spark.createDataFrame(offsets, "part int, offset long")
    return shards.join(F.broadcast(known), "part").withColumn(
        "first", F.col("offset") + F.col("start")).drop("offset", "start")


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    def decode(batches):
        for batch in batches:
            for first, blob in zip(batch.column("first").to_pylist(), batch.column("blob")):
                matrix, doc_ids, known, sizes = open_shard(blob.as_buffer())
                raw = memoryview(matrix.ids().astype("<u4").tobytes())
                ends = np.cumsum(sizes, dtype=np.int64)
                crc = [zlib.crc32(raw[4 * (e - s):4 * e]) for s, e in
                       zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64(), mask=~known),
                     pa.array(first + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_shards(spark, path).select("first", "blob").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, shard, n, first_at): how often a shard holds an id, and where in the corpus first."""
    def look(batches):
        for batch in batches:
            out = []
            for part, shard, first, blob in zip(*(batch.column(c).to_pylist() for c in
                                                  ("part", "shard", "first", "blob"))):
                matrix = open_shard(blob)[0]
                n = matrix.count(token)
                out.append((part, shard, n, first + matrix.select(token, 0) if n else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(),
                                                            pa.int64()))],
                ["part", "shard", "n", "first_at"])

    return read_shards(spark, path).select("part", "shard", "first", "blob").mapInArrow(
        look, "part int, shard int, n long, first_at long")
