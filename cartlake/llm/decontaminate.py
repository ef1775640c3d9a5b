"""Benchmark decontamination by random-walk embedding and bit-sampling LSH.

Texts are lower-cased and white space is collapsed. An item of n characters counts as leaked where a
span of the text is at most k = `edit_rate` * n edits away.

The CGK walk maps edit distance to Hamming distance: each step emits the byte under the pointer, and a
pseudo-random bit of (step, byte) moves the pointer on or not, so that two walks fall into step again
soon after an edit. A key is a hash of `SAMPLED` of the first `STEPS` steps; `WALKS` walks with `SAMPLINGS`
samplings each are the repetitions. At 10 % edits two walks over a whole item would end far apart, so an
item is looked for by windows: at every place of the item, and at every `STRIDE`-th byte of the text, a
window of some `WINDOW` bytes gives its keys. A common key places the item, and with it the item-sized
window of the text that is compared. About `SURVIVES` of the edits leave a walk's key whole, which makes
the chance of a miss (1 - exp(-rate * WINDOW * (1 - SURVIVES))) ^ (WALKS * windows); items long enough
for `MISS` (81 bytes at 10 %) are found so.

Shorter items are out of the walk's reach and go by exact pieces: cut into k + 1 pieces, k edits leave one
piece whole. Each piece gives a seed of up to `SEED` bytes, looked up at all places of a text; items under
1 / `edit_rate` characters are their own piece.

A place is kept if the text around it holds as many of the item's five-byte grams as k edits must leave
(one edit of a character of b bytes breaks b + 4 at most), and is then verified with the exact edit
distance of the item to the best span there.

One scan does it all, without a shuffle. The benchmark goes to the tasks as texts in blocks of about
`BLOCK_SYMBOLS` symbols, a scan for each block; the driver holds one block at a time, and the keys
are made where they are used.

Results for odd input: null or blank texts hold no leak, null or blank items leak nowhere; of
rows that repeat doc_id or item_id each takes part and the smallest distance counts. Items of
equal text under several ids are all reported. An item of one or two symbols is found wherever
they occur. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartlake.llm.common import chunked, per_batch, small_batches
from cartlake.llm.words import mix

EDIT_RATE = 0.1
WALKS = 4
SAMPLINGS = 2
STEPS = 36
SAMPLED = 10
WINDOW = STEPS // 2  # bytes a walk passes on average
STRIDE = 7
SURVIVES = 0.4  # share of the edits in a window after which a walk still gives the same key
MISS = 1e-6
SEED = 8  # bytes, at most
GRAM = 5  # bytes
GRAM_BITS = 12
BLOCK_SYMBOLS = 250_000
_BITMAP_BITS = 20
_CELLS = 1 << 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def shortest_walked(rate: float) -> int:
    """Bytes from which an item's windows give it a chance below `MISS` of sharing no key with a leak at this edit rate."""
    whole = min(0.99, math.exp(-rate * WINDOW * (1 - SURVIVES)))
    windows = math.log(MISS) / math.log1p(-whole) / WALKS
    return WINDOW + STRIDE * math.ceil(windows)


def walk_keys(data: np.ndarray, starts: np.ndarray, walk: int) -> list[np.ndarray]:
    """For each sampling the 64-bit keys of the windows that begin at `starts`; data has `STEPS` spare bytes at its end."""
    draw = np.random.RandomState(7919 + walk)
    # The top bit of the product with an odd number moves the pointer.
    odd = (draw.randint(0, 128, size=STEPS) * 2 + 1).astype(np.uint8)
    picks = [set(draw.choice(STEPS, SAMPLED, replace=False).tolist()) for _ in range(SAMPLINGS)]
    at = starts.astype(np.intp)
    keys = [np.zeros(len(at), np.uint64) for _ in picks]
    symbol, move = np.empty(len(at), np.uint8), np.empty(len(at), np.uint8)
    for step in range(1 + max(max(p) for p in picks)):
        np.take(data, at, out=symbol, mode="clip")
        for key, pick in zip(keys, picks):
            if step in pick:
                key *= _SPREAD
                key += symbol
        np.multiply(symbol, odd[step], out=move)
        np.right_shift(move, 7, out=move)
        np.add(at, move, out=at)
    return [mix(key) for key in keys]


def sliding(data: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each of the first n places on as one number; data has 16 spare bytes at its end."""
    out = np.empty(-(-n // 8) * 8, np.uint64)
    for j in range(8):
        out[j::8] = np.frombuffer(data, "<u8", len(out) // 8, j)
    return out[:n]


def _top(values: np.ndarray, length: int, bits: int) -> np.ndarray:
    """Hash of the first `length` bytes of each value in so many bits."""
    mask = np.uint64((1 << 8 * length) - 1)
    return (((values & mask) * _SPREAD) >> np.uint64(64 - bits)).astype(np.int64)


def edit_match(item: str, text: str) -> tuple[int, int]:
    """(distance, end) of the span of `text` nearest to `item` in edits; the first end counts.

    Bit-parallel dynamic programming over one column per character; a match may begin anywhere.
    """
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, score = full, 0, len(item)
    best, where = score, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(zero | plus)), plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(zero | up)), up & zero
        if score < best:
            best, where = score, j + 1
    return best, where


def pieces_of(item: str, n: int) -> list[str]:
    """The item cut into n pieces: fewer than n edits leave one of them whole."""
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [item[a:b] for a, b in zip(cuts, cuts[1:])]


def seeds_of(item: str, most: int) -> tuple[int, list[range]]:
    """Bytes of a seed, and for each piece of the item the byte offsets at which a seed lies whole in it."""
    pieces = [len(x.encode()) for x in pieces_of(item, most + 1)]
    length, spots, at = min(SEED, *pieces, SEED), [], 0
    for size in pieces:
        spots.append(range(at, at + size - length + 1))
        at += size
    return length, spots


@dataclass
class Table:
    """Sorted keys with the item and the byte offset of each; a bitmap tells most other keys at once."""

    seen: np.ndarray
    keys: np.ndarray
    owner: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, slots: np.ndarray, keys: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> Table:
        order = np.argsort(keys, kind="stable")
        seen = np.zeros(1 << _BITMAP_BITS, bool)
        seen[slots] = True
        return cls(seen, keys[order], owner[order].astype(np.int32), offset[order].astype(np.int32))


def _slots(keys: np.ndarray) -> np.ndarray:
    """Bitmap places of walk keys."""
    return (keys >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)


@dataclass
class Index:
    """A block of items: a table for each walk and sampling, and one for each seed length."""

    items: list[tuple[int, str, bytes]]
    walks: list[list[Table]]
    seeds: dict[int, Table]
    most: np.ndarray
    sizes: np.ndarray
    needs: np.ndarray  # grams of the item that `most` edits leave at least
    wide: int  # bytes of the items' widest character
    grams: np.ndarray  # for each item a bit for each hash of its grams
    rate: float

    @classmethod
    def of(cls, items: list[tuple[int, str]], rate: float) -> Index:
        known = [(i, t, t.encode()) for i, t in ((i, normal(t)) for i, t in items) if t]
        most = np.array([int(rate * len(t)) for _, t, _ in known], np.int64)
        sizes = np.array([len(raw) for _, _, raw in known], np.int64)
        wide = np.array([max(len(c.encode()) for c in set(t)) for _, t, _ in known], np.int64)
        needs = sizes - (GRAM - 1) - most * (GRAM - 1 + wide)
        grams = np.zeros((len(known), 1 << GRAM_BITS >> 3), np.uint8)
        walked = sizes >= shortest_walked(rate)
        groups: dict[int, list[tuple[int, list[range]]]] = defaultdict(list)
        for n, (_, t, raw) in enumerate(known):
            if not walked[n]:
                length, spots = seeds_of(t, int(most[n]))
                groups[length].append((n, spots))
            data = np.frombuffer(raw + bytes(16), np.uint8)
            own = _top(sliding(data, max(0, len(raw) - GRAM + 1)), GRAM, GRAM_BITS)
            np.bitwise_or.at(grams[n], own >> 3, (1 << (own & 7)).astype(np.uint8))
        seeds = {}
        for length, members in groups.items():
            # Of the seeds a piece offers, the one that is rarest among all items gives fewest places to verify.
            often = Counter(known[n][2][i : i + length] for n, spots in members for spot in spots for i in spot)
            found, owner, offset = [], [], []
            for n, spots in members:
                raw = known[n][2]
                for spot in spots:
                    best = min(spot, key=lambda i: often[raw[i : i + length]])
                    found.append(int.from_bytes(raw[best : best + length], "little"))
                    owner.append(n)
                    offset.append(best)
            found = np.array(found, np.uint64)
            seeds[length] = Table.of(_top(found, length, _BITMAP_BITS), found, np.array(owner), np.array(offset))
        walks = cls._walks([(n, known[n][2]) for n in np.flatnonzero(walked).tolist()])
        return cls(known, walks, seeds, most, sizes, needs, int(max(wide, default=1)), grams, rate)

    @staticmethod
    def _walks(items: list[tuple[int, bytes]]) -> list[list[Table]]:
        """Tables of the windows at every place of the items."""
        if not items:
            return []
        size = np.array([len(raw) for _, raw in items])
        windows = size - WINDOW + 1
        offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        owner = np.repeat([n for n, _ in items], windows)
        starts = offset + np.repeat(np.cumsum(size) - size, windows)
        data = np.frombuffer(b"".join(raw for _, raw in items) + bytes(STEPS), np.uint8)
        return [
            [Table.of(_slots(keys), keys, owner, offset) for keys in walk_keys(data, starts, walk)]
            for walk in range(WALKS)
        ]

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, item, byte where the item would begin, give or take its edits) for places that may hold an item."""
        out: set[tuple[int, int, int]] = set()
        values = sliding(data, int(offsets[-1]))
        grams = _top(values, GRAM, GRAM_BITS).astype(np.uint16)
        highest = int(data.max())
        wide = max(self.wide, 1 + (highest >= 0xC0) + (highest >= 0xE0) + (highest >= 0xF0))
        starts = np.arange(0, len(values), STRIDE)
        for walk, tables in enumerate(self.walks):
            for table, keys in zip(tables, walk_keys(data, starts, walk)):
                maybe = np.flatnonzero(table.seen[_slots(keys)])
                self._places(table, keys[maybe], starts[maybe], grams, wide, offsets, out)
        for length, table in self.seeds.items():
            maybe = np.flatnonzero(table.seen[_top(values, length, _BITMAP_BITS)])
            found = values[maybe] & np.uint64((1 << 8 * length) - 1)
            self._places(table, found, maybe, grams, wide, offsets, out)
        return out

    def _places(
        self,
        table: Table,
        found: np.ndarray,
        where: np.ndarray,
        grams: np.ndarray,
        wide: int,
        offsets: np.ndarray,
        out: set[tuple[int, int, int]],
    ) -> None:
        """Adds to `out` where the items of the keys found at the bytes `where` would begin, if enough grams are there."""
        low, high = np.searchsorted(table.keys, found, "left"), np.searchsorted(table.keys, found, "right")
        where, low, high = where[high > low], low[high > low], high[high > low]
        total = np.cumsum(high - low)
        # Hits in parts, so that a key many items share does not fill the memory.
        for part in np.split(np.arange(len(where)), np.flatnonzero(np.diff(total // _CELLS)) + 1):
            times = high[part] - low[part]
            if not len(part):
                continue
            x = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low[part], times)
            at, item = np.repeat(where[part], times), table.owner[x].astype(np.int64)
            row = np.searchsorted(offsets, at, "right") - 1
            # Hits of one item within its edits of each other are one place, told by its middle.
            unit = np.maximum(1, self.most[item])
            cell = (at - offsets[row] - table.offset[x]) // unit
            places = np.unique(np.stack([row, item, cell]), axis=1)
            unit = np.maximum(1, self.most[places[1]])
            begin = places[2] * unit + unit // 2
            keep = self._enough(grams, wide, offsets, places[0], places[1], begin)
            out.update(zip(places[0][keep].tolist(), places[1][keep].tolist(), begin[keep].tolist()))

    def _enough(self, grams: np.ndarray, wide: int, offsets: np.ndarray, row: np.ndarray, item: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Numbers of the places around which enough grams of the item lie."""
        # An edit moves what follows by the bytes of one character of the text at most.
        slack = wide * self.most[item] + self.most[item] // 2 + 1
        first = np.maximum(offsets[row], offsets[row] + begin - slack)
        last = np.minimum(offsets[row + 1], offsets[row] + begin + self.sizes[item] + slack)
        span = np.maximum(0, last - first)
        order, keep, i = np.argsort(span, kind="stable"), [], 0
        while i < len(order):
            # Places of like width go together; the widest is last.
            j = min(len(order), i + max(1, _CELLS // max(1, int(2 * span[order[i]]))))
            j = max(i + 1, int(np.searchsorted(span[order[i:j]], 2 * span[order[i]] + 16, "right")) + i)
            some = order[i:j]
            width = np.arange(int(span[some[-1]]))
            g = grams[np.minimum(first[some, None] + width, len(grams) - 1)]
            held = (self.grams[item[some, None], g >> 3] >> (g & 7)) & 1
            count = (held.astype(bool) & (width < span[some, None])).sum(axis=1)
            keep.append(some[count >= self.needs[item[some]]])
            i = j
        return np.concatenate(keep) if keep else np.zeros(0, np.int64)

    def leaks(self, texts: list[str]) -> list[dict[int, tuple[int, int, int]]]:
        """For each normalised text: item number to (distance, begin of the searched region, end of the match)."""
        raws = [t.encode() for t in texts]
        offsets = np.zeros(len(raws) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in raws], out=offsets[1:])
        data = np.frombuffer(b"\n".join(raws) + bytes(256), np.uint8)
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        for d, n, begin in sorted(self.candidates(data, offsets)):
            _, item, raw = self.items[n]
            most = int(self.rate * len(item))
            if out[d].get(n, (most + 1,))[0] == 0:
                continue
            slack = 5 * most + 8
            region = raws[d][max(0, begin - slack) : begin + len(raw) + slack].decode("utf-8", "ignore")
            if item in region:
                distance, end = 0, region.index(item) + len(item)
            elif any(piece in region for piece in pieces_of(item, most + 1)):
                distance, end = edit_match(item, region)
            else:
                continue
            if distance <= most and distance < out[d].get(n, (most + 1,))[0]:
                out[d][n] = (distance, max(0, begin - slack), end)
        return out


@dataclass
class Block:
    """Items as they are sent to the tasks; their index is made once in each Python worker."""

    items: list[tuple[int, str]]
    rate: float

    @cached_property
    def index(self) -> Index:
        return Index.of(self.items, self.rate)


def blocks(benchmark: DataFrame, rate: float = EDIT_RATE) -> Iterator[Block]:
    """The benchmark in blocks of bounded size; each is read and sent on its own."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    held, size = [], 0
    for row in items.toLocalIterator():
        held.append((row.item_id, row.text))
        size += len(row.text or "")
        if size >= BLOCK_SYMBOLS:
            yield Block(held, rate)
            held, size = [], 0
    if held:
        yield Block(held, rate)


def _scan(batch: pa.RecordBatch, index: Index):
    texts = [normal(x) for x in batch.column("text").to_pylist()]
    for i, j in chunked([t.encode() for t in texts]):
        for d, hits in enumerate(index.leaks(texts[i:j])):
            yield i + d, hits


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """(doc_id, item_id, distance, item_chars): one row per document and item it holds."""
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    schema = "doc_id long, item_id long, distance int, item_chars int"
    found = None
    for block in blocks(benchmark, rate):
        sent = spark.sparkContext.broadcast(block)

        def work(batch, sent=sent):
            ids, index = batch.column("doc_id").to_pylist(), sent.value.index
            rows = [
                (ids[d], index.items[n][0], hit[0], len(index.items[n][1]))
                for d, hits in _scan(batch, index)
                for n, hit in hits.items()
            ]
            columns = list(zip(*rows)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "distance", "item_chars"]
            )

        part = given.mapInArrow(per_batch(work), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.groupBy("doc_id", "item_id").agg(
        F.min("distance").alias("distance"), F.min("item_chars").alias("item_chars")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of docs, all columns, that hold no benchmark item."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    for block in blocks(benchmark, rate):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def work(batch, sent=sent):
            texts = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
            clean = [not hits for _, hits in _scan(texts, sent.value.index)]
            yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(per_batch(work), docs.schema)
    return docs
