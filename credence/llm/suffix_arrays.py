"""Removal of repeated passages by suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts in a document of smaller id is
removed. The work is dealt so that no suffix array spans the corpus, and little text moves:

1. Minimizers. Of the ``GRAM``-byte grams inside each ``LENGTH``-byte window the one with the least hash is
   the window's anchor. Equal windows have equal anchors, so a window can only repeat if its anchor
   occurs in another document. Anchors' hashes meet in buckets (one entry for each distinct hash of
   a task's batch, so a very common passage does not pile up), and documents learn which are shared.
2. Shards. Runs of windows with one shared anchor are cut out of their documents with the bytes they
   cover and dealt to shards by the anchor, so equal windows always meet. Equal strings of a batch
   travel once: those in larger documents are hits already. Anchors of very many different strings
   (the edges of a common passage, common phrases) are known from a sample of the documents; their
   strings are cut into single windows, which are dealt by their own bytes, so no anchor is one group.
3. Suffix arrays. Windows whose hash is alone in a part have no equal; strings are cut to what lies
   between their first and last other window. A shard sorts the suffixes left by their first
   ``LENGTH`` bytes with Larsson-Sadakane refinement: the first 8 bytes, then doubling, each time
   only the groups not yet told apart.
   Common prefixes of neighbours in the order mark the classes of equal windows; the smallest
   document of a class keeps it. The prefixes are compared directly, in 8-byte words, up to
   ``LENGTH``: Kasai's carry from one suffix to the next needs the complete order of all suffixes,
   and an order of the first ``LENGTH`` bytes does not give it.
4. Merging. A shard is worked through in parts of bounded bytes, cut between anchors. Only if one
   anchor alone exceeds a part, its parts' suffix arrays are merged by binary search.

Defined results: null text is the empty text; texts shorter than ``LENGTH`` lose nothing; a document
equal to one of smaller id loses all its bytes; rows without id lose nothing and count for nothing;
rows with equal ids do not count for each other; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from credence.llm.text_kernel import BYTE_VALUES, give_back, mixed, powers, text_buffer
from credence.llm.work import Workspace, small_batches, table, text_of

LENGTH = 50
GRAM = 20
#: Grams in a window.
SPAN = LENGTH - GRAM + 1
PIECE_BYTES = 1 << 18
BATCH_BYTES = 8 << 20
#: Text for each bucket of anchors, and of strings.
MEETING_BYTES = 16 << 20
BUCKET_BYTES = 8 << 20
PART_BYTES = 1 << 20
#: One document in so many shows which anchors are hot: those of about so many different strings.
SAMPLE = 64
HOT_STRINGS = 16384
#: Strings of hot anchors cut into windows at a time.
HOT_STEP = 20_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Offsets of the 8-byte words that make up a gram after the first; the last ends with it.
_GRAM_WORDS = [*range(8, GRAM - 8, 8), GRAM - 8]


def words8(data: np.ndarray, big: bool = False) -> np.ndarray:
    """The 8 bytes from each position on, as an integer, without a copy of the data.

    Big-endian integers sort like the bytes. Take what is needed, then convert with ``whole``.
    """
    return np.ndarray((max(len(data) - 7, 0),), ">u8" if big else "<u8",
                      np.ascontiguousarray(data), strides=(1,))


def whole(words: np.ndarray) -> np.ndarray:
    return words.astype(np.uint64)


def gram_hash(*words: np.ndarray) -> np.ndarray:
    """Hash of a gram from its 8-byte words."""
    h = words[0] * _A
    for w in words[1:]:
        h = mixed(h ^ w * _B)
    return h


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at each position."""
    w = whole(words8(data))
    if len(w) <= GRAM - 8:
        return np.zeros(0, np.uint64)
    return gram_hash(*(w[k:len(w) - GRAM + 8 + k] for k in (0, *_GRAM_WORDS)))


def runs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
    """(first window, last window, anchor, piece) of runs of windows that share their anchor.

    Pieces are byte ranges of the buffer; windows lie inside one piece. Ties go to the leftmost
    gram, so a window's anchor depends on nothing but its bytes.
    """
    none = np.zeros(0, np.int64)
    grams = gram_hashes(data)
    if len(grams) < SPAN:
        return none, none, none, none, grams
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    step, n = 1, len(grams) - SPAN + 1
    while 2 * step <= SPAN:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:n], least[SPAN - step:SPAN - step + n])
    anchor = (least & low).astype(np.int64)
    fits = ends - begins >= LENGTH
    piece = np.flatnonzero(fits)
    first, last = begins[fits], ends[fits] - LENGTH
    inside = np.zeros(len(anchor) + 1, np.int64)
    np.add.at(inside, first, 1)
    np.add.at(inside, last + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    start = inside.copy()
    start[1:] &= anchor[1:] != anchor[:-1]
    start[first] = True
    begin = np.flatnonzero(start)
    owner = np.searchsorted(first, begin, "right") - 1
    after = np.append(begin[1:], len(anchor))
    return begin, np.minimum(after - 1, last[owner]), anchor[begin], piece[owner], grams


def pieces(offsets: np.ndarray, first: int, last: int):
    """(document, begin, end) of pieces of long texts; neighbours overlap by a window less one."""
    docs, begins, ends = [], [], []
    for doc in range(first, last):
        a, b = int(offsets[doc]), int(offsets[doc + 1])
        while True:
            end = min(a + PIECE_BYTES + LENGTH - 1, b)
            docs.append(doc)
            begins.append(a)
            ends.append(end)
            if end == b:
                break
            a += PIECE_BYTES
    return (np.array(x, np.int64) for x in (docs, begins, ends))


def text_runs(data: np.ndarray, offsets: np.ndarray):
    """Per block: (document, begin, end, anchor position, anchor hash) of its runs, in the buffer."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + PIECE_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        docs, begins, ends = pieces(offsets, first, last)
        for k in range(0, len(docs), 1 if last == first + 1 else len(docs)):
            part = slice(k, k + 1) if last == first + 1 else slice(None)
            base, top = begins[part][0], ends[part][-1]
            a, b, anchor, piece, grams = runs(data[base:top], begins[part] - base,
                                              ends[part] - base)
            yield (docs[part][piece], a + base, b + base + LENGTH, anchor + base,
                   mixed(grams[anchor]) >> np.uint64(16))  # least hashes are not uniform
        first = last


def id_column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def grouped(batches, limit: int):
    """Batches joined up to about ``limit`` bytes and 60,000 rows."""
    held, size, rows = [], 0, 0
    for batch in batches:
        step = max(1, min(2000, batch.num_rows))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.nbytes
            rows += part.num_rows
            if size >= limit or rows >= 60_000:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


PACKED = "bucket int, doc_id long, key long, ids binary, refs binary, data binary, more binary"
PACKED_NAMES = [x.split()[0] for x in PACKED.split(", ")]


def packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*rows)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      PACKED_NAMES)


def blobs(rows: pa.Table, name: str) -> list:
    """The column's values as buffers, not copied."""
    return [x.as_buffer() for chunk in rows.column(name).chunks for x in chunk]


def spread(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 48-bit hash; keeps their order."""
    return ((hashes >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def dealt(ids: np.ndarray, keys: np.ndarray, items: list[np.ndarray], dests: int):
    """(destination, documents, counts, items) of documents' items: a row for each destination.

    ``ids`` and ``keys`` name the document of each item; items of a document need not be neighbours.
    """
    order = np.lexsort((keys, ids))
    ids, keys, items = ids[order], keys[order], [x[order] for x in items]
    begin = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])))
    many = np.diff(np.append(begin, len(ids)))
    ids, keys = ids[begin], keys[begin]
    dest = (mixed(ids.view(np.uint64) * _A ^ keys.view(np.uint64)) % np.uint64(dests)).astype(
        np.int64)
    order = np.argsort(dest, kind="stable")
    edges = np.searchsorted(dest[order], np.arange(dests + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        own = order[edges[k]:edges[k + 1]]
        tops = np.cumsum(many[own])
        at = np.repeat(begin[own] - tops + many[own], many[own]) + np.arange(tops[-1])
        yield (k, ids[own].tobytes() + keys[own].tobytes(), many[own].astype(np.int64).tobytes(),
               b"".join(x[at].tobytes() for x in items))


DEALT = "dest long, ids binary, refs binary, data binary"


def dealt_table(rows) -> pa.Table:
    rows = list(rows)
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                    [x.split()[0] for x in DEALT.split(", ")])


def collected(rows: pa.Table, kinds: list[type]):
    """Per document of a destination: id, key and its items, together."""
    ids, keys, items = [], [], [[] for _ in kinds]
    for names, many, data in zip(*(blobs(rows, c) for c in ("ids", "refs", "data"))):
        names, many = np.frombuffer(names, np.int64), np.frombuffer(many, np.int64)
        total = int(many.sum())
        ids.append(np.repeat(names[:len(many)], many))
        keys.append(np.repeat(names[len(many):], many))
        for k, kind in enumerate(kinds):
            items[k].append(np.frombuffer(data, kind, total, 8 * k * total))
    ids, keys = np.concatenate(ids), np.concatenate(keys)
    order = np.lexsort((keys, ids))
    ids, keys, items = ids[order], keys[order], [np.concatenate(x)[order] for x in items]
    begin = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])))
    for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(ids)]):
        yield int(ids[i]), int(keys[i]), [x[i:j] for x in items]


def anchors(texts: DataFrame, buckets: int, dests: int) -> DataFrame:
    """Entries of the anchors in buckets, and anchors already seen to be shared by document.

    Of each distinct hash in a batch one entry goes to its bucket: data = 48-bit hashes (four low
    bytes, then two high ones), refs = the place of a document that has it, or 65535 if two have
    it. Rows with a doc_id, which is a destination there, carry hashes that documents share within
    the batch, packed as by ``dealt``.
    """
    def extract(batches):
        for rows in grouped(batches, BATCH_BYTES):
            data, offsets = text_buffer(rows.column("text"))
            ids, keys = id_column(rows, "doc_id"), id_column(rows, "key")
            found = [(d, h) for d, _, _, _, h in text_runs(data, offsets)]
            if not found:
                continue
            docs, hashes = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((docs, hashes))
            docs, hashes = docs[order], hashes[order]
            new = np.ones(len(docs), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
            docs, hashes = docs[new], hashes[new]
            new = np.ones(len(docs), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            begin = np.flatnonzero(new)
            count = np.diff(np.append(begin, len(docs)))
            refs = np.where(count > 1, 65535, docs[begin]).astype(np.uint16)
            unique = hashes[begin]
            edges = np.searchsorted(spread(unique, buckets), np.arange(buckets + 1))
            out = []
            for k in np.flatnonzero(np.diff(edges)).tolist():
                part = unique[edges[k]:edges[k + 1]]
                used = refs[edges[k]:edges[k + 1]]
                own, place = np.unique(used, return_inverse=True)
                own = own[own != 65535]
                place = np.where(used == 65535, 65535, place).astype(np.uint16)
                out.append((k, None, None, ids[own].tobytes() + keys[own].tobytes(),
                            place.tobytes(), (part & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                            .tobytes(), (part >> np.uint64(32)).astype(np.uint16).tobytes()))
            many = np.repeat(count > 1, count)
            docs, hashes = docs[many], hashes[many]
            if len(docs):
                out += [(k % buckets, k, None, names, counts, items, None)
                        for k, names, counts, items in dealt(ids[docs], keys[docs], [hashes],
                                                             dests)]
            yield packed(out)
            give_back()

    return texts.mapInArrow(extract, PACKED)


def passing(rows: pa.Table) -> pa.Table:
    """What a bucket only hands on to a destination."""
    rows = rows.filter(rows.column("doc_id").is_valid())
    return rows.select(["doc_id", "ids", "refs", "data"]).rename_columns(
        [x.split()[0] for x in DEALT.split(", ")])


def shared_anchors(entries: DataFrame, dests: int) -> DataFrame:
    """(doc_id, key, shared): anchors of the document that occur in another one too.

    A bucket answers in one row for each destination, not each document; there they meet.
    """
    def meet(rows: pa.Table) -> pa.Table:
        give_back()
        rows = rows.combine_chunks()
        passed = passing(rows)
        rows = rows.filter(rows.column("doc_id").is_null())
        hashes, ids, keys, mine = [], [], [], []
        for header, place, low, high in zip(*(blobs(rows, c) for c in
                                              ("ids", "refs", "data", "more"))):
            header = np.frombuffer(header, np.int64)
            place = np.frombuffer(place, np.uint16).astype(np.int64)
            hashes.append(np.frombuffer(low, np.uint32).astype(np.uint64)
                          | np.frombuffer(high, np.uint16).astype(np.uint64) << np.uint64(32))
            mine.append(place != 65535)
            place, half = np.where(mine[-1], place, 0), len(header) // 2
            for out, part in ((ids, header[:half]), (keys, header[half:])):
                out.append(part[place] if half else np.zeros(len(place), np.int64))
            # What two documents of a batch share needs no answer; entered again it counts as two.
            hashes.append(hashes[-1][~mine[-1]])
            for out in (ids, keys, mine):
                out.append(np.zeros(len(hashes[-1]), out[-1].dtype))
        if not hashes:
            return passed
        hashes, ids, keys, mine = (np.concatenate(x) for x in (hashes, ids, keys, mine))
        order = np.argsort(hashes, kind="stable")
        hashes, ids, keys, mine = hashes[order], ids[order], keys[order], mine[order]
        same = np.zeros(len(hashes) + 1, bool)
        same[1:-1] = hashes[1:] == hashes[:-1]
        shared = (same[1:] | same[:-1]) & mine
        hashes, ids, keys = hashes[shared], ids[shared], keys[shared]
        if not len(ids):
            return passed
        return pa.concat_tables([passed, dealt_table(dealt(ids, keys, [hashes], dests))])

    def gather(rows: pa.Table) -> pa.Table:
        give_back()
        found = [(i, k, np.unique(h).tobytes()) for i, k, (h,) in collected(rows, [np.uint64])]
        return pa.table([pa.array([f[c] for f in found], kind) for c, kind in enumerate(
            (pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "key", "shared"])

    return entries.groupBy("bucket").applyInArrow(meet, DEALT).groupBy("dest").applyInArrow(
        gather, "doc_id long, key long, shared binary")


def string_marks(data: np.ndarray, a: np.ndarray, b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hash of each string's length, anchor offset and bytes' fingerprint."""
    w = words8(data)
    mark = (b - a).astype(np.uint64) << np.uint64(8) | off.astype(np.uint64)
    for k in range(0, LENGTH - 7, 8):
        mark = mixed(mark * _B + mixed(whole(w[a + k])))
    mark = mixed(mark * _B + mixed(whole(w[a + LENGTH - 8])))
    for k in range(LENGTH, LENGTH + SPAN, 8):
        # Beyond the first window: 8 bytes at a time, the last 8 ending with the string.
        mark = mixed(mark * _B + mixed(whole(w[np.minimum(a + k, b - 8)])))
    return mark


def hot_anchors(texts: DataFrame) -> np.ndarray:
    """Sorted hashes of the anchors that many different strings share, estimated from a sample.

    Any choice gives the same results; it decides only how strings are dealt.
    """
    def count(batches):
        for rows in grouped(batches, BATCH_BYTES):
            data, offsets = text_buffer(rows.column("text"))
            found = [(h, string_marks(data, a, b, anchor - a))
                     for _, a, b, anchor, h in text_runs(data, offsets) if len(h)]
            if found:
                h, mark = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((mark, h))
                h, mark = h[order], mark[order]
                h = h[np.append(True, (h[1:] != h[:-1]) | (mark[1:] != mark[:-1]))]
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[n > 1].astype(np.int64)), pa.array(n[n > 1])], ["h", "n"])
            give_back()

    sample = texts.filter(F.pmod(F.xxhash64("doc_id", "key"), F.lit(SAMPLE)) == 0)
    hot = (sample.select("text").mapInArrow(count, "h long, n long").groupBy("h")
           .agg(F.sum("n").alias("n")).filter(F.col("n") * SAMPLE >= HOT_STRINGS))
    return np.sort(np.array([r["h"] for r in hot.select("h").collect()], np.uint64))


def strings(texts: DataFrame, buckets: int, hot: np.ndarray, dests: int) -> DataFrame:
    """The runs whose anchor is shared, in shards, and hits found within a batch.

    refs = document places, data = the bytes, compressed, more = offsets in the documents, lengths and anchor
    offsets. Rows with a doc_id, a destination, carry hits: data = begins and ends.
    """
    def cut(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for rows in grouped(batches, BATCH_BYTES):
            data, offsets = text_buffer(rows.column("text"))
            ids, keys = id_column(rows, "doc_id"), id_column(rows, "key")
            wanted = [np.frombuffer(x, np.uint64) for x in blobs(rows, "shared")]
            parts = []
            for docs, a, b, anchor, h in text_runs(data, offsets):
                if not len(docs):
                    continue
                keep = np.zeros(len(docs), bool)
                edges = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
                for i, j in zip(edges.tolist(), np.append(edges[1:], len(docs)).tolist()):
                    w = wanted[docs[i]]
                    if len(w):
                        at = np.minimum(np.searchsorted(w, h[i:j]), len(w) - 1)
                        keep[i:j] = w[at] == h[i:j]
                parts.append([x[keep] for x in (docs, a, b, anchor, h)])
            if not parts:
                continue
            docs, a, b, anchor, h = (np.concatenate(x) for x in zip(*parts))
            if not len(docs):
                continue
            stay, early, out = [], [], []

            def collapse(docs, a, b, off, h, mark):
                """Keeps equal strings' smallest document; the others' are hits."""
                owner = ids[docs]
                order = np.lexsort((owner, mark, h))
                docs, a, b, off, h, mark, owner = (
                    x[order] for x in (docs, a, b, off, h, mark, owner))
                new = np.append(True, (mark[1:] != mark[:-1]) | (h[1:] != h[:-1]))
                keep = owner == owner[new][np.cumsum(new) - 1]
                d = docs[~keep]
                early.append((ids[d], keys[d], a[~keep] - offsets[d], b[~keep] - offsets[d]))
                return [x[keep] for x in (docs, a, b, off, h)]

            # Equal strings: same anchor hash, length, anchor offset and bytes' fingerprint.
            found = collapse(docs, a, b, anchor - a, h, string_marks(data, a, b, anchor - a))
            at = np.isin(found[4], hot)
            stay.append([x[~at] for x in found])
            found = [x[at] for x in found]
            for k in range(0, len(found[0]), HOT_STEP):
                docs, a, b, off, h = (x[k:k + HOT_STEP] for x in found)
                many = b - a - LENGTH + 1
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                docs, a, off = (np.repeat(x, many) for x in (docs, a, off))
                a, off = a + step, off - step
                mark = string_marks(data, a, a + LENGTH, off)
                stay.append(collapse(docs, a, a + LENGTH, off, mark >> np.uint64(16), mark))
            docs, a, b, off, h = (np.concatenate(x) for x in zip(*stay))
            order = np.argsort(h, kind="stable")
            docs, a, b, off, h = (x[order] for x in (docs, a, b, off, h))
            edges = np.searchsorted(spread(h, buckets), np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                i, j = edges[k], edges[k + 1]
                own, place = np.unique(docs[i:j], return_inverse=True)
                size = b[i:j] - a[i:j]
                top = np.cumsum(size)
                body = data[np.repeat(a[i:j] - top + size, size) + np.arange(top[-1])]
                out.append((k, None, None, ids[own].tobytes() + keys[own].tobytes(),
                            place.astype(np.uint16).tobytes(), pack.compress(body.tobytes()),
                            (a[i:j] - offsets[docs[i:j]]).astype(np.int64).tobytes()
                            + size.astype(np.uint8).tobytes()
                            + off[i:j].astype(np.uint8).tobytes()))
            own, key, s, e = (np.concatenate(x) for x in zip(*early))
            if len(own):
                out += [(k % buckets, k, None, names, counts, items, None)
                        for k, names, counts, items in dealt(own, key, [s, e], dests)]
            yield packed(out)
            give_back()

    return texts.mapInArrow(cut, PACKED)


def refined(rank: np.ndarray, at: np.ndarray, ahead: int):
    """Ranks of the suffixes ``at`` made finer by the ranks ``ahead`` bytes on.

    A rank is the place of a group's first suffix in the order. Suffixes alone in their group are
    left as they are (Larsson and Sadakane); the others are sorted inside their groups.
    """
    counts = np.bincount(rank[at], minlength=len(rank))
    at = at[counts[rank[at]] > 1]
    pair = rank[at].astype(np.uint64) << np.uint64(32) | rank[at + ahead].astype(np.uint64)
    order = np.argsort(pair)
    at, pair = at[order], pair[order]
    if not len(at):
        return rank
    group = pair >> np.uint64(32)
    place = np.arange(len(at))
    new_group = np.append(True, group[1:] != group[:-1])
    new_pair = np.append(True, pair[1:] != pair[:-1])
    begin = np.maximum.accumulate(np.where(new_group, place, 0))
    own = np.maximum.accumulate(np.where(new_pair, place, 0))
    rank = rank.copy()
    rank[at] = group.astype(np.int64) + own - begin
    return rank


def common_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Whether two suffixes agree in their first ``limit`` bytes, 8 at a time while they agree."""
    w = words8(data)
    equal = np.ones(len(a), bool)
    live = np.arange(len(a))
    for k in [*range(0, limit - 7, 8), limit - 8]:
        live = live[w[a[live] + k] == w[b[live] + k]]
    equal[:] = False
    equal[live] = True
    return equal


def suffix_order(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts class): windows sorted by their bytes, and where a new class begins.

    ``ends`` holds the end of the string each byte belongs to; windows start where ``LENGTH`` bytes
    are left.
    """
    left = ends - np.arange(len(data))
    at = np.flatnonzero(left >= 8)
    first = whole(words8(data, big=True)[at])
    order = np.argsort(first)
    sorted_ = first[order]
    new = np.append(True, sorted_[1:] != sorted_[:-1])
    rank = np.zeros(len(data), np.int64)
    rank[at[order]] = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    rank = refined(rank, np.flatnonzero(left >= 16), 8)
    rank = refined(rank, np.flatnonzero(left >= 32), 16)
    windows = np.flatnonzero(left >= LENGTH)
    rank = refined(rank, windows, LENGTH - 32)
    order = windows[np.argsort(rank[windows], kind="stable")]
    new = np.append(True, ~common_prefixes(data, order[:-1], order[1:], LENGTH))
    return order, new[:len(order)]


def window_keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The windows' bytes as rows of integers that compare like them."""
    w = words8(data, big=True)
    return np.stack([whole(w[at + k]) for k in [*range(0, LENGTH - 7, 8), LENGTH - 8]], 1)


def search(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted row among sorted rows, by binary search."""
    low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(keys), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        x, y = keys[middle], wanted[open_]
        differ = x != y
        column = differ.argmax(1)
        row = np.arange(len(open_))
        less = differ.any(1) & (x[row, column] < y[row, column])
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]


def smallest_owner(data: np.ndarray, sizes: np.ndarray, owner: np.ndarray, parts: list[slice]):
    """For every window of the strings: its place, and the smallest document that has it."""
    found = []
    tops = np.cumsum(sizes)
    merged_keys = merged_least = None
    for part in parts:
        a, b = int(tops[part.start] - sizes[part.start]), int(tops[part.stop - 1])
        ends = np.repeat(tops[part] - a, sizes[part])
        order, new = suffix_order(data[a:b], ends)
        own = np.repeat(owner[part], sizes[part])[order]
        begin = np.flatnonzero(new)
        least = np.minimum.reduceat(own, begin)
        class_of = np.cumsum(new) - 1
        if len(parts) > 1:
            keys = window_keys(data[a:b], order[begin])
            if merged_keys is None:
                merged_keys, merged_least = keys, least
            else:
                at = search(merged_keys, keys)
                inside = np.minimum(at, len(merged_keys) - 1)
                same = (merged_keys[inside] == keys).all(1)
                np.minimum.at(merged_least, inside[same], least[same])
                merged_keys = np.insert(merged_keys, at[~same], keys[~same], 0)
                merged_least = np.insert(merged_least, at[~same], least[~same])
            found.append([order + a, class_of, keys])
        else:
            found.append([order + a, class_of, least])
    for f in found:
        if len(parts) > 1:
            f[2] = merged_least[search(merged_keys, f[2])]
        yield f[0], f[2][f[1]]


def repeated(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, first, last): strings with windows whose hash occurs twice, and the outer ones' places.

    Equal windows have equal hashes, so no other window is in a class of two.
    """
    tops = np.cumsum(sizes)
    many = sizes - LENGTH + 1
    ends = np.cumsum(many)
    at = np.arange(ends[-1]) + np.repeat(tops - sizes - ends + many, many)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=sums[1:])
    hashes = mixed((sums[at + LENGTH] - sums[at]) * down[at])
    order = np.argsort(hashes)
    same = np.zeros(len(at) + 1, bool)
    same[1:-1] = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.sort(order[same[1:] | same[:-1]])
    string = np.searchsorted(ends, twice, "right")
    new = np.flatnonzero(np.append(True, string[1:] != string[:-1])[:len(string)])
    last = np.append(new[1:], len(string))[:len(new)] - 1
    string, base = string[new], (ends - many)[string[new]]
    return string, twice[new] - base, twice[last] - base


def hit_runs(shards: DataFrame, dests: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, key, runs): begins and ends of a document's byte runs found in smaller ones.

    A bucket answers in one row for each destination; there a document's runs are united.
    """
    def judge(rows: pa.Table) -> pa.Table:
        give_back()
        rows = rows.combine_chunks()
        passed = passing(rows)
        rows = rows.filter(rows.column("doc_id").is_null())
        ids, keys, body, froms, sizes, offs = [], [], [], [], [], []
        unpack = zstandard.ZstdDecompressor()
        for header, place, data, more in zip(*(blobs(rows, c) for c in
                                               ("ids", "refs", "data", "more"))):
            header, place = np.frombuffer(header, np.int64), np.frombuffer(place, np.uint16)
            n, half = len(place), len(header) // 2
            ids.append(header[:half][place])
            keys.append(header[half:][place])
            body.append(np.frombuffer(unpack.decompress(data), np.uint8))
            froms.append(np.frombuffer(more, np.int64, n))
            sizes.append(np.frombuffer(more, np.uint8, n, 8 * n).astype(np.int64))
            offs.append(np.frombuffer(more, np.uint8, n, 9 * n).astype(np.int64))
        if not ids:
            return passed
        ids, keys, body, froms, sizes, offs = (
            np.concatenate(x) for x in (ids, keys, body, froms, sizes, offs))
        begin = np.cumsum(sizes) - sizes
        w = words8(body)
        hashes = gram_hash(*(whole(w[begin + offs + k]) for k in (0, *_GRAM_WORDS)))
        order = np.argsort(hashes, kind="stable")
        new = np.append(True, hashes[order][1:] != hashes[order][:-1])
        anchors_at = np.append(np.flatnonzero(new), len(order))
        weight = np.append(0, np.cumsum(sizes[order]))
        out = [[], [], [], []]
        i = 0
        while i < len(anchors_at) - 1:
            a = int(anchors_at[i])
            j = int(np.searchsorted(weight[anchors_at], weight[a] + part_bytes, "right")) - 1
            j = max(j, i + 1)
            b = int(anchors_at[j])
            own = order[a:b]
            size = sizes[own]
            tops = np.cumsum(size)
            data = body[np.repeat(begin[own] - tops + size, size) + np.arange(tops[-1])]
            low = np.zeros(len(own), np.int64)
            if tops[-1] <= 2 * part_bytes:  # a larger group of one anchor stays whole
                kept, low, high = repeated(data, size)
                if not len(kept):
                    i = j
                    continue
                source = (tops - size)[kept] + low
                own, size = own[kept], high - low + LENGTH
                tops = np.cumsum(size)
                data = data[np.repeat(source - tops + size, size) + np.arange(tops[-1])]
            if j == i + 1 and tops[-1] > part_bytes:
                cuts = np.searchsorted(tops, np.arange(part_bytes, tops[-1], part_bytes), "right")
                cuts = np.unique(np.concatenate(([0], cuts, [len(own)])))
                parts = [slice(int(x), int(y)) for x, y in zip(cuts[:-1], cuts[1:])]
            else:
                parts = [slice(0, len(own))]
            hit = np.zeros(len(data) + 1, bool)
            owner = ids[own]
            string_of = np.repeat(np.arange(len(own)), size)
            for at, least in smallest_owner(data, size, owner, parts):
                hit[at] = least < owner[string_of[at]]
            # Windows of one string that follow each other; a string's last bytes start none.
            first = np.flatnonzero(hit[:-1] & ~np.append(False, hit[:-2]))
            last = np.flatnonzero(hit[:-1] & ~hit[1:])
            s = string_of[first]
            base = (froms[own] + low)[s] - (tops - size)[s]
            for k, x in enumerate((ids[own][s], keys[own][s], first + base, last + base + LENGTH)):
                out[k].append(x)
            i = j
        ids, keys, s, e = (np.concatenate([np.zeros(0, np.int64), *x]) for x in out)
        if not len(ids):
            return passed
        return pa.concat_tables([passed, dealt_table(dealt(ids, keys, [s, e], dests))])

    def unite(rows: pa.Table) -> pa.Table:
        give_back()
        found = [(i, k, np.concatenate(merged_runs(*se)).tobytes())
                 for i, k, se in collected(rows, [np.int64, np.int64])]
        return pa.table([pa.array([f[c] for f in found], kind) for c, kind in enumerate(
            (pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "key", "runs"])

    return shards.groupBy("bucket").applyInArrow(judge, DEALT).groupBy("dest").applyInArrow(
        unite, "doc_id long, key long, runs binary")


def merged_runs(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the union of byte runs."""
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.append(True, s[1:] > e[:-1])
    return s[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)]


def cut_texts(texts: DataFrame) -> DataFrame:
    """doc_id, key, n_removed, n_spans, what is left and its SHA-256, for (text, runs) rows."""
    def cut(batches):
        for batch in batches:
            removed, spans, kept, sums = [], [], [], []
            for text, pairs in zip(batch.column("text").to_pylist(),
                                   batch.column("runs").to_pylist()):
                raw, at, left = (text or "").encode(), 0, []
                s, e = np.frombuffer(pairs, np.int64).reshape(2, -1)
                for x, y in zip(s.tolist(), e.tolist()):
                    left.append(raw[at:x])
                    at = y
                left = b"".join([*left, raw[at:]])
                removed.append(len(raw) - len(left))
                spans.append(len(s))
                kept.append(left)
                sums.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(sums, pa.string())],
                ["doc_id", "key", "n_removed", "n_spans", "kept", "kept_sha256"])

    return texts.select("doc_id", "key", "text", "runs").mapInArrow(
        cut, "doc_id long, key long, n_removed long, n_spans long, kept binary, "
             "kept_sha256 string")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                       F.xxhash64(text_of()).alias("key"))


def touched_texts(docs: DataFrame, digests: DataFrame, space: Workspace,
                  part_bytes: int = PART_BYTES) -> DataFrame:
    """The texts that lose bytes to others, with what is left of them; exact copies left out."""
    texts = keyed(docs).filter("doc_id IS NOT NULL")
    total = digests.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(24, -(-total // BUCKET_BYTES))
    meetings = max(24, -(-total // MEETING_BYTES))
    long = texts.filter(F.octet_length("text") >= LENGTH)
    found = shared_anchors(anchors(long, meetings, meetings), meetings)
    found = found.join(digests.filter("doc_id = first").select("doc_id", "key").distinct(),
                       ["doc_id", "key"], "left_semi")
    shards = strings(long.join(found, ["doc_id", "key"]), buckets, hot_anchors(long), meetings)
    runs_of = space.table(hit_runs(shards, meetings, part_bytes), "hit_runs")
    touched = space.id_list(runs_of.select("doc_id", "key"), "touched")
    return cut_texts(texts.join(touched, ["doc_id", "key"], "left_semi")
                     .join(runs_of, ["doc_id", "key"]))


def text_digests(docs: DataFrame) -> DataFrame:
    """doc_id, key, size and SHA-256 of every text, and ``first``, the smallest id that has it."""
    rows = table(keyed(docs).select("doc_id", "key", F.octet_length("text").cast("long")
                                    .alias("n_bytes"),
                                    F.sha2(F.col("text").cast("binary"), 256).alias("sha")),
                 "digests")
    # Written before the join: then both sides are plain exchanges, and adaptive execution splits
    # the key of a text that very many documents share.
    firsts = rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    many = table(firsts.filter("n > 1").select("sha", "first"), "shared_texts")
    return rows.join(many, "sha", "left").withColumn("first", F.coalesce("first", "doc_id"))


def repeat_digest(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes left, per document."""
    digests = table(text_digests(docs), "text_digests")
    with Workspace(docs.sparkSession) as space, small_batches(docs.sparkSession):
        cut = table(touched_texts(docs, digests, space, part_bytes).drop("kept").dropDuplicates(
            ["doc_id", "key"]), "cut").withColumnRenamed("kept_sha256", "cut_sha")
    copy = F.coalesce((F.col("first") < F.col("doc_id")) & (F.col("n_bytes") >= LENGTH),
                      F.lit(False))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return digests.join(cut, ["doc_id", "key"], "left").select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, empty).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and the bytes left of every text, as binary: a cut may fall inside a character."""
    digests = table(text_digests(docs), "text_digests")
    with Workspace(docs.sparkSession) as space, small_batches(docs.sparkSession):
        cut = table(touched_texts(docs, digests, space).select("doc_id", "key", "kept")
                    .dropDuplicates(["doc_id", "key"]), "cut")
    copies = digests.filter(F.col("first") < F.col("doc_id")).filter(
        F.col("n_bytes") >= LENGTH).select("doc_id", "key", F.lit(True).alias("copy")).distinct()
    return (keyed(docs).join(cut, ["doc_id", "key"], "left")
            .join(copies, ["doc_id", "key"], "left")
            .select("doc_id", F.when(F.col("copy"), F.lit("").cast("binary")).otherwise(
                F.coalesce("kept", F.col("text").cast("binary"))).alias("kept")))
