"""Exact substring dedup: every byte in a string of ``width`` bytes that also
starts in a document with a smaller id.

Sorting all suffixes would move the text many times. Two equal strings of
``width`` bytes hold the same smallest ``GRAM``-byte gram (by hash, leftmost
of ties) at the same place, so each string is filed under that anchor, and
neighbouring strings with one anchor form a region. Texts are shuffled once,
as blocks; then

1. each block reports its distinct (anchor, region) pairs with their smallest
   document, and learns which regions are wholly in a smaller document and
   which may agree in part with a differing region of the same anchor: equal
   strings hold the anchor in the same place, so their regions agree in all
   bytes of half a string's way before it, or in those of the other half's way
   after it, and each pair carries a hash of both;
2. only such regions, one copy of each, have their strings sorted (those of an
   anchor with very many of them are dealt out by a hash of the string, each
   block's equal ones as one, so no bucket grows with one frequent gram or
   line), by bucket-pointer refinement: buckets of equal 8-byte grams are
   refined by the bucket identifiers of later offsets (8, then 16, then 18 on),
   each pass sorting on the identifiers the last one made and leaving out what
   is alone in its bucket;
3. each block marks what it learned and what its own smaller documents hold.

Anchors are told apart by hashes of 40 bits, regions by 64 (104 bits a pair);
the refined strings by their bytes; the hashes of 24 bits before and after an
anchor only choose what is sorted. Tasks work on one block or one bucket of
anchors; their numbers follow the input. Each block writes a message to each
bucket, so a bucket holds the anchors of several blocks' worth of text.

Defined results: strings never cross documents; a null text is empty; texts
under ``width`` bytes lose nothing; documents with one id never match each
other, a null id counts as the smallest; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from siltlake.llm.arrays import mix64
from siltlake.llm.blocks import block_count, freed, open_block, pack_arrays, to_blocks, unpack_arrays

WIDTH, GRAM = 50, 16
_CHUNK, _PLACE = 1 << 16, 24
#: text of a block, and of the regions sorted at once; raise them with the executors' memory
BLOCK_BYTES, SORT_BYTES = 4 << 20, 1 << 20
#: blocks whose worth of anchors a bucket holds
BUCKET_BLOCKS = 4
_ODD = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA0761D6478BD642F)
_ANCHOR = ~np.uint64((1 << 24) - 1)
HELD, SEND, SPLIT = 1, 2, 4
#: an anchor with more such regions than this sends its distinct strings one by one, each to the bucket of its hash
HOT_REGIONS = 1024


def _words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as one number."""
    data = np.ascontiguousarray(data)
    return np.array(np.ndarray((len(data) - 7,), dtype="<u8", buffer=data.data, strides=(1,)))


def _chunks(at: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of whole documents, about a chunk each; a longer document
    is cut so that every string lies in exactly one range by its start."""
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + _CHUNK, side="right")) - 1)
        if at[j] - at[i] <= 2 * _CHUNK:
            yield int(at[i]), int(at[j])
        else:
            for lo in range(int(at[i]), int(at[j]), _CHUNK):
                yield lo, min(lo + _CHUNK + width - 1, int(at[j]))
        i = j


def regions(data: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Per region: anchor hash, region hash, document number, its first string
    (a place in ``data``), how many strings it has, and hashes of the anchor
    with the bytes before it, and after it, that two regions with a string in
    common have in common: those before it where the anchor is ``half`` bytes
    into the string or more, else those after it. A side on which the region
    has no such string gets a hash of its own."""
    span = width - GRAM + 1  # grams a string
    half = span // 2
    power = np.full(2 * _CHUNK + width, _ODD, dtype=np.uint64)
    inverse = np.full(len(power), _INVERSE, dtype=np.uint64)
    power[0] = inverse[0] = 1
    np.cumprod(power, out=power)
    np.cumprod(inverse, out=inverse)
    out: list[tuple[np.ndarray, ...]] = []
    for lo, hi in _chunks(at, width):
        if hi - lo < width:
            continue
        v = mix64(_words8(data[lo:hi]))
        key = v[:-8] * _A + v[8:] * _B
        key ^= key >> np.uint64(32)
        key *= _ODD
        anchors = key
        m = key & ~np.uint64((1 << _PLACE) - 1) | np.arange(len(key), dtype=np.uint64)
        have = 1
        while 2 * have <= span:
            m = np.minimum(m[:len(m) - have], m[have:])
            have *= 2
        if have < span:
            m = np.minimum(m[:len(m) - (span - have)], m[span - have:])
        where = (m & np.uint64((1 << _PLACE) - 1)).astype(np.int64)  # the anchor of each start
        first, last = np.searchsorted(at, (lo, hi), side="right")
        ends = at[first:last + 1] - lo
        late = (ends[:, None] - np.arange(1, width)[None, :]).ravel()  # no string of this document starts here
        valid = np.ones(len(where), dtype=bool)
        valid[late[(late >= 0) & (late < len(valid))]] = False
        goes_on = np.zeros(len(where), dtype=bool)
        goes_on[1:] = valid[1:] & valid[:-1] & (where[1:] == where[:-1])
        begin = np.flatnonzero(valid & ~goes_on)
        if not len(begin):
            continue
        end = np.flatnonzero(valid & ~np.append(goes_on[1:], False)) + 1
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * power[:len(v)])])
        place = where[begin]
        region = (total[end + width - 8] - total[begin]) * inverse[begin]
        region = mix64(region + (place - begin).astype(np.uint64) * _A + (end - begin).astype(np.uint64) * _B)
        sides = []
        for there, x, y in ((place - begin >= half, place - half, place + GRAM - 7), (place - end + 1 < half, place, place + width - half - 6)):
            own = region.copy()
            own[there] = mix64((total[y[there]] - total[x[there]]) * inverse[x[there]])
            sides.append((own >> np.uint64(40)).astype(np.uint32))
        # smallest hashes crowd at the low end of their range: mixed again, they spread over the buckets
        out.append((mix64(anchors[place]) & _ANCHOR, region, np.searchsorted(at, begin + lo, side="right") - 1, begin + lo, end - begin, *sides))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.uint32, np.uint32))
    return tuple(np.concatenate(x) for x in zip(*out))


class _Block:
    """A block's documents, their regions, and the distinct pairs among these."""

    def __init__(self, payloads, width: int):
        self.ids, self.flags, self.data, self.at = open_block(payloads)
        anchor, region, doc, self.start, self.count, before, after = regions(self.data, self.at, width)
        order = np.lexsort((region, anchor))
        self.doc, self.start, self.count = doc[order], self.start[order], self.count[order]
        anchor, region = anchor[order], region[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (region[1:] != region[:-1])
        begin = np.flatnonzero(new)
        self.pair = np.cumsum(new) - 1  # of each region
        self.anchor, self.region = anchor[begin], region[begin]
        self.before, self.after = before[order[begin]], after[order[begin]]
        ids = self.ids[self.doc]
        self.smallest = np.minimum.reduceat(ids, begin) if len(begin) else np.empty(0, np.int64)
        # the regions of each pair in its smallest document; the first stands for them
        self.of_smallest = np.flatnonzero(ids == self.smallest[self.pair]) if len(ids) else np.empty(0, np.int64)
        self.example_at = np.searchsorted(self.pair[self.of_smallest], np.arange(len(begin) + 1))
        self.example = self.of_smallest[self.example_at[:-1]]

    def hot_strings(self, flags: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """Of each string of the regions sent string by string: pair, place in
        the region, number among the distinct strings; of each of these: hash,
        smallest document, and where it stands."""
        hot = np.flatnonzero((flags & SEND > 0) & (flags & SPLIT > 0))
        if not len(hot):
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64, np.int64))
        each = self.count[self.example[hot]]
        pair = np.repeat(hot, each)
        shift = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        at = self.start[self.example[pair]] + shift
        words, offsets = _words8(np.append(self.data, np.zeros(8, np.uint8))), (*range(0, width - 8, 8), width - 8)
        hashes = np.zeros(len(at), dtype=np.uint64)
        for k in offsets:
            hashes = mix64(hashes * _ODD + words[at + k])
        order = np.argsort(hashes, kind="stable")
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        for k in offsets:
            word = words[at[order] + k]
            new[1:] |= word[1:] != word[:-1]
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        ids = self.ids[self.doc[self.example[pair[order]]]]
        least = np.minimum.reduceat(ids, begin) if len(begin) else ids
        return pair, shift, number, hashes[order[begin]], least, at[order[begin]]


def _cut(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of n buckets begins among sorted hashes, and their end."""
    edges = np.array([(i << 64) // n for i in range(1, n)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]]).astype(np.int64)


def _shared(group: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which of the regions of a group's anchor have this hash with another."""
    _, number, size = np.unique(group.astype(np.uint64) << np.uint64(32) | side, return_inverse=True, return_counts=True)
    return size[number] > 1


def pack_pairs(anchor: np.ndarray, *others: np.ndarray) -> bytes:
    """Lists of one length as one value, the first of them ascending: by
    planes of bytes, so that those which are zero take no room."""
    columns = (np.diff(anchor, prepend=anchor.dtype.type(0)), *others)
    return pack_arrays(*(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T for x in columns))


def unpack_pairs(value: bytes, *types: str) -> list[np.ndarray]:
    planes = zip(types, unpack_arrays(value, *["u1"] * len(types)))
    anchor, *others = (np.ascontiguousarray(x.reshape(np.dtype(t).itemsize, len(x) // np.dtype(t).itemsize).T).view(t).ravel() for t, x in planes)
    return [np.cumsum(anchor, dtype=anchor.dtype), *others]


def judge_pairs(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """For the (anchor, region, smallest document, hash before, hash after)
    lists of several blocks, flags in the same order: HELD, a smaller document
    in another block has the region; SEND, this block's copy stands for it and
    a differing region of the anchor may have some of its strings; SPLIT, the
    anchor has so many of these that one bucket should not hold them."""
    sizes = np.cumsum([len(p[0]) for p in parts])[:-1]
    anchor, region, doc, before, after = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((doc, region, anchor))
    a, r, d = anchor[order], region[order], doc[order]
    new_anchor = np.ones(len(a), dtype=bool)
    new_anchor[1:] = a[1:] != a[:-1]
    new_pair = new_anchor.copy()
    new_pair[1:] |= r[1:] != r[:-1]
    pair = np.cumsum(new_pair) - 1
    first = np.flatnonzero(new_pair)
    group = np.cumsum(new_anchor)[first] - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    like = np.zeros(len(first), dtype=bool)
    like[several] = _shared(group[several], before[order[first[several]]]) | _shared(group[several], after[order[first[several]]])
    many = np.bincount(group, weights=like)[group] > HOT_REGIONS
    flags = np.zeros(len(a), dtype=np.uint8)
    flags[order] = np.where(d > d[first][pair], HELD, 0) | np.where(like[pair] & new_pair, SEND, 0) | np.where(many[pair], SPLIT, 0)
    return np.split(flags, sizes)


def refine(text: np.ndarray, left: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Starts of strings of ``width`` bytes that are not alone, and the bucket
    of each. ``left``: how many bytes of its region each place still has."""
    place = np.flatnonzero(left >= 8)
    if not len(place):
        return place, place
    words = _words8(np.append(text, np.zeros(8, np.uint8)))[place]
    bucket = np.full(len(text) + 1, -1, dtype=np.int64)  # -1: alone in its bucket
    depth, value = 8, words
    while True:
        _, number, size = np.unique(value, return_inverse=True, return_counts=True)
        shared = size[number] > 1
        place, number = place[shared], number[shared]
        if depth == width:
            return place, number
        bucket[:] = -1
        bucket[place] = number
        offset = min(depth, width - depth)
        depth += offset
        place = place[left[place] >= depth]
        later = bucket[place + offset]
        place = place[later >= 0]
        value = bucket[place] * np.int64(len(size) + 1) + bucket[place + offset]


def held_strings(doc: np.ndarray, count: np.ndarray, text: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Of regions with these documents, the runs of strings that a smaller
    document's region has too: region number, first and last string in it."""
    lengths = count + width - 1
    at = np.concatenate([[0], np.cumsum(lengths)])
    left = np.repeat(at[1:], lengths) - np.arange(len(text))
    place, bucket = refine(text, left, width)
    region = np.searchsorted(at, place, side="right") - 1
    own = doc[region]
    least = np.full(int(bucket.max()) + 1 if len(bucket) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, bucket, own)
    held = own > least[bucket]
    place, region = place[held], region[held]
    order = np.argsort(place)
    place, region = place[order], region[order]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (region[1:] != region[:-1]) | (place[1:] != place[:-1] + 1)
    end = np.append(new[1:], True)[:len(new)]
    return region[new], place[new] - at[region[new]], place[end] - at[region[end]]


def repeated_bytes(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte
    ranges, end exclusive)."""
    n = block_count(docs, text_col, BLOCK_BYTES)
    n_buckets = (n - 1) // BUCKET_BLOCKS + 1
    blocks = to_blocks(docs, n, id_col, text_col).groupBy("block")
    message = "bucket int, block int, kind string, value binary"

    def table(bucket, block, kind: str, values: list[bytes]) -> pa.Table:
        size = len(values)
        return pa.table({"bucket": pa.array(np.broadcast_to(bucket, size).astype(np.int32)), "block": pa.array(np.broadcast_to(block, size).astype(np.int32)),
                         "kind": pa.array([kind] * size, pa.string()), "value": pa.array(values, pa.binary())})

    def report(key: tuple, texts: pa.Table) -> pa.Table:
        b = _Block(texts.column("payload").to_pylist(), width)
        cut = _cut(b.anchor, n_buckets)
        some = np.flatnonzero(np.diff(cut))
        values = [pack_pairs(*(x[cut[k]:cut[k + 1]] for x in (b.anchor, b.region, b.smallest, b.before, b.after))) for k in some]
        return table(some, key[0].as_py(), "pairs", values)

    def judge(key: tuple, rows: pa.Table) -> pa.Table:
        flags = judge_pairs([unpack_pairs(v, "<u8", "<u8", "<i8", "<u4", "<u4") for v in rows.column("value").to_pylist()])
        return table(key[0].as_py(), rows.column("block").to_numpy(), "flags", [pack_arrays(f) for f in flags])

    def flags_of(rows: pa.Table) -> np.ndarray:
        own = rows.filter(pc.equal(rows.column("kind"), "flags"))
        values, order = own.column("value").to_pylist(), np.argsort(own.column("bucket").to_numpy(), kind="stable")
        return np.concatenate([np.empty(0, np.uint8), *(unpack_arrays(values[i], "u1")[0] for i in order)])

    def send(key: tuple, texts: pa.Table, rows: pa.Table) -> pa.Table:
        b = _Block(texts.column("payload").to_pylist(), width)
        flags = flags_of(rows)
        pair = np.flatnonzero((flags & SEND > 0) & (flags & SPLIT == 0))
        own = b.example[pair]
        _, _, _, hashes, least, places = b.hot_strings(flags, width)
        route, ids = np.concatenate([b.anchor[pair], hashes]), np.concatenate([b.ids[b.doc[own]], least])
        number = np.concatenate([pair, len(b.anchor) + np.arange(len(hashes))])  # distinct strings count on after the pairs
        count, start = np.concatenate([b.count[own], np.ones(len(hashes), np.int64)]), np.concatenate([b.start[own], places])
        order = np.argsort(route, kind="stable")
        route, ids, number, count, start = (x[order] for x in (route, ids, number, count, start))
        cut, buckets, values = _cut(route, n_buckets), [], []
        for k, (i, j) in enumerate(zip(cut, cut[1:])):
            if i == j:
                continue
            lengths = count[i:j] + width - 1
            place = np.repeat(start[i:j] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            buckets.append(k)
            values.append(pack_arrays(route[i:j], ids[i:j], number[i:j], count[i:j], b.data[place]))
        return table(np.array(buckets, dtype=np.int32), key[0].as_py(), "regions", values)

    def sort(key: tuple, rows: pa.Table) -> pa.Table:
        source = rows.column("block").to_numpy()
        parts = [unpack_arrays(v, "<u8", "<i8", "<i8", "<i8", "u1") for v in rows.column("value").to_pylist()]
        source = np.repeat(source, [len(p[0]) for p in parts])
        route, ids, number, count, text = (np.concatenate(x) for x in zip(*parts))
        del parts
        lengths = count + width - 1
        start = np.cumsum(lengths) - lengths
        # equal strings came by equal hashes: ranges of these are sorted one after another
        pieces = max(1, len(text) // SORT_BYTES)
        low, wide = (key[0].as_py() << 64) // n_buckets, (1 << 64) // n_buckets // pieces + 1
        order = np.argsort(route, kind="stable")
        cut = np.searchsorted(route[order], np.array([min(low + i * wide, (1 << 64) - 1) for i in range(1, pieces)], dtype=np.uint64))
        held = []
        for own in np.split(order, cut):
            size = lengths[own]
            place = np.repeat(start[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
            region, first, last = held_strings(ids[own], count[own], text[place], width)
            region = own[region]
            held.append((source[region], number[region], first, last))
        source, *found = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(source, kind="stable")
        edges = np.flatnonzero(np.diff(source[order], prepend=-1, append=-1))
        values = [pack_arrays(*(x[order[i:j]] for x in found)) for i, j in zip(edges, edges[1:])]
        return table(key[0].as_py(), source[order[edges[:-1]]], "strings", values)

    def mark(key: tuple, texts: pa.Table, rows: pa.Table) -> pa.Table:
        b = _Block(texts.column("payload").to_pylist(), width)
        flags = flags_of(rows)
        own = (b.ids[b.doc] > b.smallest[b.pair]) | (flags[b.pair] & HELD > 0) if len(b.pair) else np.empty(0, bool)
        first, last = [b.start[own]], [b.start[own] + b.count[own] - 1]
        found = [unpack_arrays(v, "<i8", "<i8", "<i8") for v in rows.filter(pc.equal(rows.column("kind"), "strings")).column("value").to_pylist()]
        pair, lo, hi = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found) if found else ((), (), ())))
        one, shift, number, _, least, _ = b.hot_strings(flags, width)
        alike = pair >= len(b.anchor)  # distinct strings
        gone = np.zeros(len(least), dtype=bool)
        gone[pair[alike] - len(b.anchor)] = True
        gone = gone[number] | (b.ids[b.doc[b.example[one]]] > least[number])
        pair, lo, hi = (np.concatenate([x[~alike], y[gone]]) for x, y in ((pair, one), (lo, shift), (hi, shift)))
        i, many = b.example_at[pair], b.example_at[pair + 1] - b.example_at[pair]
        like = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(i, many)
        at = b.start[b.of_smallest[like]]
        first.append(at + np.repeat(lo, many))
        last.append(at + np.repeat(hi, many))
        cover = np.zeros(len(b.data) + 1, dtype=np.int32)
        np.add.at(cover, np.concatenate(first), 1)
        np.add.at(cover, np.concatenate(last) + width, -1)
        gone = np.cumsum(cover[:-1]) > 0
        some = np.flatnonzero(np.diff(b.at))  # a run ends where its document does
        starts, ends = gone.copy(), gone.copy()
        starts[1:] &= ~gone[:-1]
        ends[:-1] &= ~gone[1:]
        starts[b.at[some]] = gone[b.at[some]]
        ends[b.at[some + 1] - 1] = gone[b.at[some + 1] - 1]
        lo, hi = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        i, j = np.searchsorted(lo, b.at[:-1]), np.searchsorted(lo, b.at[1:])
        removed = np.concatenate([[0], np.cumsum(gone)])
        kept, spans = [], []
        for d, (x, y) in enumerate(zip(b.at[:-1].tolist(), b.at[1:].tolist())):
            kept.append(hashlib.sha256(b.data[x:y][~gone[x:y]].tobytes()).hexdigest())
            spans.append([{"start": int(s) - x, "end": int(e) - x} for s, e in zip(lo[i[d]:j[d]], hi[i[d]:j[d]])])
        return pa.table({
            "doc_id": pa.array(b.ids, pa.int64(), mask=b.flags >= 2), "n_bytes": pa.array(np.diff(b.at), pa.int64()),
            "n_removed": pa.array(removed[b.at[1:]] - removed[b.at[:-1]], pa.int64()), "n_spans": pa.array(j - i, pa.int64()),
            "kept_sha256": pa.array(kept, pa.string()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    pairs = blocks.applyInArrow(lambda key, rows: freed(report(key, rows)), message)
    # dealt out here: both that read the flags read this exchange
    flags = pairs.groupBy("bucket").applyInArrow(lambda key, rows: freed(judge(key, rows)), message).repartition("block")
    sent = blocks.cogroup(flags.groupBy("block")).applyInArrow(lambda key, texts, rows: freed(send(key, texts, rows)), message)
    strings = sent.groupBy("bucket").applyInArrow(lambda key, rows: freed(sort(key, rows)), message)
    return blocks.cogroup(flags.union(strings).groupBy("block")).applyInArrow(lambda key, texts, rows: freed(mark(key, texts, rows)), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>")
