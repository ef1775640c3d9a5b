"""Links between the members of hash buckets, and the components they form.

Every step is a join or an aggregation on a key; no group is gathered in one task and no
pair list of a whole bucket is built. Buckets are resolved by comparing members with a
leader, then only members that lie in different components are compared further.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cartlake.llm.common import bounded, chunked, land, per_batch, small_batches, texts_of
from cartlake.llm.words import alike, document_words, exact_shingles, few_edits, mix, shingle_hashes, split_words


def shared_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, node) rows of the buckets that hold two different nodes at least, landed and distinct.

    Counting combines on the map side and the join back is a plain one that adaptive
    execution splits, so one bucket may hold any share of the rows. When few buckets are
    shared, the counted list is broadcast instead.
    """
    ends = rows.groupBy("bucket").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi"))
    several = land(ends.where("_lo <> _hi").select("bucket"), "buckets")
    return land(rows.join(bounded(several), "bucket", "left_semi").distinct(), "members")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge in (a, b).

    Alternates two star steps until nothing changes: each node hands its larger, then its
    smaller neighbours to the smallest one. Rounds grow with the logarithm of the longest chain.
    """
    now = land(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        root = large.groupBy("u").agg(F.min("v").alias("v"))
        small = large.join(root.withColumnRenamed("v", "m"), "u").where("v <> m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = land(root.unionByName(small).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) rows after further links: only the roots that these join are searched again."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
    joined = links.join(a, "a", "left").join(b, "b", "left")
    joined = joined.select(F.coalesce("_ra", "a").alias("a"), F.coalesce("_rb", "b").alias("b"))
    upper = components(joined)
    up = upper.select(F.col("node").alias("root"), F.col("root").alias("_top"))
    old = roots.join(up, "root", "left").select("node", F.coalesce("_top", "root").alias("root"))
    return old.unionByName(upper.join(roots.select("node"), "node", "left_anti"))


def shingles_alike(k: int, percent: int) -> tuple[Callable, Callable]:
    """Exact Jaccard similarity of k-word shingle sets, as (prepare, compare)."""
    return (lambda text: exact_shingles(text, k)), (lambda a, b: alike(a, b, percent))


def words_alike(percent: int) -> tuple[Callable, Callable]:
    """Exact word edit distance, as (prepare, compare)."""
    return split_words, (lambda a, b: few_edits(a, b, percent))


#: Texts of so many words and more are joined on neighbouring word pairs, shorter ones on rare words.
LONG = 20
#: Rows of a word pair outside its main root from which on they are first compared with leaders.
MANY = 4
#: Words by which a crowded bucket is split at once.
STEP = 8
#: A bucket is split by a further word if that makes so many times fewer rows than its pairs are.
CROWD = 32


def _bits(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The words of each text as a set of 128 bits, in two lanes."""
    size = np.diff(bounds)
    full = bounds[:-1][size > 0]
    low, bit = (hashes >> np.uint64(57)) & np.uint64(1), np.uint64(1) << (hashes >> np.uint64(58))
    lanes = []
    for lane in (np.uint64(0), np.uint64(1)):
        held = np.zeros(len(size), np.uint64)
        if len(full):
            held[size > 0] = np.bitwise_or.reduceat(np.where(low == lane, bit, np.uint64(0)), full)
        lanes.append(held.view(np.int64))
    return lanes


def _word_lists(batch: pa.RecordBatch):
    """Turns (node, text) into node, number of words, the words' bits and hashes; the hashes of long texts are left out."""
    texts, nodes = texts_of(batch.column("text")), batch.column("node")
    for i, j in chunked(texts):
        hashes, bounds, *_ = document_words(texts[i:j])
        size = np.diff(bounds)
        w0, w1 = _bits(hashes, bounds)
        short = size < LONG
        ends = np.concatenate([[0], np.cumsum(np.where(short, size, 0))]).astype(np.int32)
        words = hashes[np.repeat(short, size)].view(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "node": nodes.slice(i, j - i),
                "n": pa.array(size, pa.int64()),
                "w0": pa.array(w0),
                "w1": pa.array(w1),
                "words": pa.ListArray.from_arrays(pa.array(ends), pa.array(words)),
            }
        )


def _word_pairs(percent: int):
    """Turns (node, text) into rows of its distinct word pairs, with the number of words, how many pairs to index, the words' bits.

    What a pair repeats comes in rows that stand for 1, 1, 2, 4, 8... further occurrences (`weight`),
    each under a hash of its own; `lo` and `hi` are the places of the pair's first and last occurrence.
    """

    def work(batch: pa.RecordBatch):
        texts, nodes = texts_of(batch.column("text")), batch.column("node").to_numpy(zero_copy_only=False)
        for i, j in chunked(texts):
            hashes, bounds, *_ = document_words(texts[i:j])
            size = np.diff(bounds)
            longest = size * 100 // percent
            need = size - 1 - 2 * (size * (100 - percent) // 100)
            for more in (1, 2, 3):  # the need falls by one where the edits grow, every third word at most
                other = np.minimum(size + more, longest)
                need = np.minimum(need, other - 1 - 2 * (other * (100 - percent) // 100))
            each = np.maximum(size - 1, 0)
            text = np.repeat(np.arange(len(size)), each)
            at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            pair = shingle_hashes(hashes, 2)[at + bounds[:-1][text]]
            order = np.lexsort((pair, text))  # stable: places of one pair ascend
            text, at, pair = text[order], at[order], pair[order]
            new = np.ones(len(pair) + 1, bool)
            new[1:-1] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
            edges = np.flatnonzero(new)
            first, last = np.repeat(edges[:-1], np.diff(edges)), np.repeat(edges[1:] - 1, np.diff(edges))
            step = np.frexp(np.arange(len(pair)) - first)[1]
            new[1:-1] |= step[1:] != step[:-1]
            edges = np.flatnonzero(new)
            own = edges[:-1]
            step, text = step[own].astype(np.uint64), text[own]
            w0, w1 = _bits(hashes, bounds)
            yield pa.RecordBatch.from_pydict(
                {
                    "node": pa.array(nodes[i:j][text]),
                    "pair": pa.array(np.where(step == 0, pair[own], mix(pair[own] * np.uint64(3) + step)).view(np.int64)),
                    "weight": pa.array(np.diff(edges)),
                    "lo": pa.array(at[first[own]]),
                    "hi": pa.array(at[last[own]]),
                    "n": pa.array(size[text]),
                    "reach": pa.array((size - need)[text]),
                    "w0": pa.array(w0[text]),
                    "w1": pa.array(w1[text]),
                }
            )

    return per_batch(work)


def _apart(percent: int) -> tuple[str, str]:
    """SQL of the edits that two texts of n and _n words may have, and of whether their lengths and words allow so few."""
    most = f"(greatest(n, _n) * {100 - percent} div 100)"
    # Every word that only one of them holds costs an edit.
    words = " and ".join(f"bit_count({a}w0 & ~{b}w0) + bit_count({a}w1 & ~{b}w1) <= {most}" for a, b in (("", "_"), ("_", "")))
    return most, f"abs(n - _n) <= {most} and {words}"


def _other(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows with an underscore before all names but the keys'."""
    return rows.select(*keys, *(F.col(c).alias(f"_{c}") for c in rows.columns if c not in keys))


def _mains(rows: DataFrame, key: str, *sums: str) -> DataFrame:
    """Of keys that several roots hold: the root that holds most rows as `main`, and the number of rows of all and of the others."""
    held = rows.groupBy(key, "root").agg(F.count("*").alias("c"), *(F.sum(s).alias(s) for s in sums))
    main = held.groupBy(key).agg(
        F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots"),
        F.sum("c").alias("rows"), (F.sum("c") - F.max("c")).alias("odd"), *(F.sum(s).alias(s) for s in sums),
    )
    return main.where("roots > 1").drop("roots")


def _long_pairs(
    texts: DataFrame, live: DataFrame, percent: int, settle: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(a, b) of `edit_pairs` where the longer text has LONG words at least, and (node, root) of `live` by then.

    k edits leave all but 2k word pairs of the longer text in both, moved by k places at most. With
    a text's pairs put rarest first, the first of those that both hold near enough thus lies early in
    either, counting what a pair repeats. Texts join on such pairs only, if places, numbers of words and
    the sets of words agree as far as k edits must leave them; members of the root that holds most of a
    word pair are not joined with each other. Occurrences of a repeated pair are not joined one by one.
    Where many hold a word pair, they are first compared with leaders by `settle`, if given: each with one
    of about its number of words and one of slightly more, as texts of one repeated word differ by their number only.
    """
    columns = "node long, pair long, weight long, lo long, hi long, n long, reach long, w0 long, w1 long"
    listed = land(texts.mapInArrow(_word_pairs(percent), columns), "listed")
    often = listed.groupBy("pair").agg(F.count("*").alias("often")).where("often > 1")
    before = Window.partitionBy("node").orderBy(F.coalesce("often", F.lit(1)), "pair").rowsBetween(Window.unboundedPreceding, -1)
    place = F.coalesce(F.sum("weight").over(before), F.lit(0)) + 1
    first = listed.join(often, "pair", "left").withColumn("place", place)
    first = first.where("place <= reach and often > 1").select("node", "n", "place", "lo", "hi", "w0", "w1", "pair")
    first = land(first, "prefixes")
    most, near = _apart(percent)
    need = f"(greatest(n, _n) - 1 - 2 * {most})"
    near = (
        f"root <> _root and greatest(n, _n) >= {LONG} and {near}"
        f" and lo - _hi <= {most} and _lo - hi <= {most} and n - place >= {need} and _n - _place >= {need}"
    )

    def shared() -> DataFrame:
        rows = land(first.join(live, "node"), "rooted")
        return land(rows.join(land(_mains(rows, "pair").select("pair", "main", "odd"), "main"), "pair"), "shared")

    rows = shared()
    many = rows.where(f"odd >= {MANY}").drop("main", "odd")
    if settle is not None and not many.isEmpty():
        # Numbers of words of one class, or of two that follow each other, are within the distance.
        many = many.withColumn("class", F.col("n") if percent == 100 else F.expr(f"int(2 * ln(n) / ln(100 / {percent}))"))
        lead = F.min_by(F.struct("node", "root", "n", "place", "lo", "hi", "w0", "w1"), F.xxhash64("node", "pair")).alias("l")
        leads = land(_other(many.groupBy("pair", "class").agg(lead).select("pair", "class", "l.*"), "pair", "class"), "leads")
        by = many.withColumn("class", F.explode(F.array("class", F.col("class") + 1))).join(leads, ["pair", "class"]).where(near)
        roots = settle(by.select(*_pairs(F.col("node"), F.col("_node"))).distinct())
        live = land(live.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "live")
        rows = shared()
    odd = _other(rows.where("root <> main").drop("main", "odd"), "pair")
    both = rows.join(odd, "pair").where(near)
    return both.select(*_pairs(F.col("node"), F.col("_node"))).distinct(), live


def _grown(rows: DataFrame, begin: int, end: int, percent: int) -> DataFrame:
    """Rows of `begin` chosen words with further words, up to `end`; rows that may need no more words stay beside."""
    spare = f"(n * {100 - percent} div 100)"
    out = []
    for depth in range(begin + 1, end + 1):
        place = F.explode(F.expr(f"sequence(place + 1, least(n, {spare} + {depth}))"))
        rows = rows.where("place < n").withColumn("place", place).withColumn("_t", F.expr("order[int(place) - 1]")).where("_t.often > 1")
        # Words that both texts keep stand in one order in both, so it belongs to the key.
        rank = F.expr("size(filter(places, x -> x < _t.at))")
        rows = rows.withColumn("bucket", F.xxhash64("bucket", "_t.word", rank)).withColumn("places", F.expr("array_append(places, _t.at)"))
        rows = rows.drop("_t").withColumn("depth", F.lit(depth))
        out.append(rows if depth == end else rows.where(f"n - {spare} <= {depth}"))
    total = out[0]
    for x in out[1:]:
        total = total.unionByName(x)
    ends = [F.array_min("places").alias("lo"), F.array_max("places").alias("hi")]
    return total.select("bucket", "node", "root", "n", "w0", "w1", "depth", "place", "places", *ends)


def edit_pairs(texts: DataFrame, percent: int) -> Callable[..., DataFrame]:
    """For `linked`: pairs of different roots whose word edit distance can be small enough, percent from 67.

    k edits leave all but k words of the longer text in both, in one order. With a text's words
    put rarest first, the first d words that both keep lie among the first k + d of either, for
    every d up to the number they must keep. Texts join on two such words first. Buckets whose
    pairs would be many are split by STEP further words at a time, until few roots are left in each or the
    words are all that must be kept; a bucket's main root is not joined with itself. Before the first two splits the members are
    compared by `settle`, if given, with a leader of as many words and one of a word more, and pairs of what this joins are left out.
    Nothing is dropped: each pair meets at the depth where its bucket is not split any more.
    Long texts have too many choices of words and go by `_long_pairs`.
    """
    if percent < 67:
        raise ValueError("below 67 percent two texts within the distance may share no word pair")
    spare = f"(n * {100 - percent} div 100)"
    most, near = _apart(percent)
    need = f"(greatest(n, _n) - {most})"
    # Words before, between and after the outermost chosen ones differ in number by the edits at most.
    near += f" and abs(lo - _lo) + abs(hi - lo - _hi + _lo) + abs(n - hi - _n + _hi) <= {most} and greatest(n, _n) < {LONG}"

    def pairs(live: DataFrame, settle: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        given = texts.join(live.select("node"), "node", "left_semi")
        lists = land(given.mapInArrow(per_batch(_word_lists), "node long, n long, w0 long, w1 long, words array<long>"), "lists")
        long = lists.where(f"n * 100 div {percent} >= {LONG}").select("node")
        far, live = _long_pairs(given.join(long, "node", "left_semi"), live, percent, settle)
        found = [land(far, "long")]
        lists = lists.where(f"n < {LONG}")
        words = lists.select("node", F.posexplode("words").alias("at", "word"))
        often = words.groupBy("word").agg(F.count("*").alias("often")).where("often > 1")
        words = words.join(often, "word", "left").select("node", F.struct(F.coalesce("often", F.lit(1)).alias("often"), "word", "at").alias("t"))
        order = words.groupBy("node").agg(F.array_sort(F.collect_list("t")).alias("order"))
        order = land(lists.drop("words").join(order, "node"), "order")
        start = order.join(live, "node").withColumns(
            {"bucket": F.lit(0).cast("long"), "place": F.lit(0).cast("long"), "places": F.expr("cast(array() as array<int>)")}
        )
        begin, depth = 0, 2
        while True:
            rows = land(_grown(start, begin, depth, percent), "rows")
            # How many rows a split would make of one, at most.
            ways = " * ".join(f"({spare} + depth - place + {i}) / {i}" for i in range(1, STEP + 1))
            rows = rows.withColumn("more", F.expr(f"cast(round({ways}) as long)"))
            mains = land(_mains(rows, "bucket", "more"), "mains")
            crowded = F.expr(f"rows * odd > {CROWD} * more")
            calm = rows.join(mains.where(~crowded).select("bucket", "main"), "bucket").withColumn("split", F.lit(False))
            full = land(rows.join(mains.where(crowded).select("bucket"), "bucket", "left_semi"), "full")
            split = not full.isEmpty()
            if split:
                if settle is not None and begin <= 2:
                    lead = F.min_by(F.struct("node", "root", "n", "w0", "w1", "lo", "hi"), F.xxhash64("node", "bucket")).alias("l")
                    leads = full.groupBy("bucket", F.col("n").alias("class")).agg(lead).select("bucket", "class", "l.*")
                    by = full.withColumn("class", F.explode(F.array("n", F.col("n") + 1)))
                    by = by.join(_other(leads, "bucket", "class"), ["bucket", "class"]).where(f"root <> _root and {near}")
                    roots = settle(by.select(*_pairs(F.col("node"), F.col("_node"))).distinct())
                    full = full.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
                    full = land(full, "full")
                mains = land(_mains(full, "bucket", "more"), "mains")
                full = full.join(mains.select("bucket", "main", crowded.alias("split")), "bucket")
                full = land(full, "full")
                calm = calm.unionByName(full)
            calm = calm.drop("more", "place", "places")
            # Many choices among a repeated word's occurrences agree in all that the join looks at.
            calm = land(calm.distinct() if begin else calm, "calm")
            odd = _other(calm.where("root <> main").select("bucket", "node", "root", "n", "w0", "w1", "lo", "hi"), "bucket")
            # A pair is listed at the last depth it surely reaches; in a split bucket only if it needs no more words.
            here = f"if(split, {need} = depth, least({need}, {depth}) = depth)"
            both = calm.join(odd, "bucket").where(f"root <> _root and {near} and {here}")
            found.append(land(both.select(*_pairs(F.col("node"), F.col("_node"))).distinct(), "near"))
            if not split:
                break
            start = full.where(f"split and depth = {depth}").select("bucket", "node", "root", "place", "places").join(order, "node")
            if start.isEmpty():
                break
            begin, depth = depth, depth + STEP
        total = found[0]
        for x in found[1:]:
            total = total.unionByName(x)
        return total.distinct()

    return pairs


def _check(test: tuple[Callable, Callable]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    prepare, compare = test

    def run(batches):
        last = ready = None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            texts_a, texts_b = batch.column("text_a"), batch.column("text_b")
            keep = []
            for i, node in enumerate(a):
                if node != last:
                    last, ready = node, prepare(texts_a[i].as_py())
                if compare(ready, prepare(texts_b[i].as_py())):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a[i] for i in keep], pa.int64()), "b": pa.array([b[i] for i in keep], pa.int64())}
            )

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, test: tuple[Callable, Callable]) -> DataFrame:
    """The pairs (a, b) whose full texts pass the test. texts: (node, text) with UTF-8 bytes, one row a node."""
    small_batches(pairs.sparkSession)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    # Joined on the member first: leaders repeat, so their texts travel once a pair either way.
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_check(test), "a long, b long")


def _pairs(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def linked(
    members: DataFrame,
    texts: DataFrame,
    test: tuple[Callable, Callable],
    rounds: int = 2,
    narrow: Callable[..., DataFrame] | None = None,
) -> DataFrame:
    """(node, root) of the components that confirmed links form within buckets.

    members: landed (bucket, node) rows, texts: landed (node, text). Round one compares each
    member with the smallest one of its bucket, later rounds with another leader drawn by
    hash, and only across components. Buckets that still hold two components are then
    resolved in full: all their untested pairs from different components are compared, or, with
    `narrow`, those it gives. It gets the (node, root) rows of these buckets, and a function that compares
    pairs and returns the roots they lead to, (node, root) rows of linked nodes. It must give (a, b) for every
    pair of different roots that can pass the test, but for those of one root by then.
    Two members of one bucket that are alike thus always end in one component.
    """
    size = members.groupBy("bucket").agg(F.count("*").alias("_n"))
    tested = roots = None

    def settle(pairs: DataFrame) -> DataFrame:
        """The roots after these pairs were compared, but for those compared before."""
        nonlocal tested, roots
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = land(pairs, "pairs")
        new = land(confirmed(pairs, texts, test), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        roots = land(components(new) if roots is None else merged(roots, new), "roots")
        return roots

    for r in range(rounds + 1):
        if roots is not None:
            # Buckets of two were settled by their only pair; the others stay while they hold two components.
            live = members.join(size.where("_n > 2"), "bucket").drop("_n").join(roots, "node", "left")
            live = live.withColumn("root", F.coalesce("root", "node"))
            mixed = live.groupBy("bucket").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"))
            live = land(live.join(mixed.where("_lo <> _hi").select("bucket"), "bucket", "left_semi"), "live")
            if live.isEmpty():
                break
        else:
            live = members.withColumn("root", F.col("node"))
        if r < rounds:
            order = F.col("node") if r == 0 else F.xxhash64("bucket", "node", F.lit(r))
            leads = live.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "node", "root")).alias("_l"))
            leads = leads.select("bucket", F.col("_l.node").alias("_ln"), F.col("_l.root").alias("_lr"))
            found = live.join(leads, "bucket").where("root <> _lr")
            pairs = found.select(*_pairs(F.col("_ln"), F.col("node"))).distinct()
        elif narrow is not None:
            pairs = narrow(live.select("node", "root").distinct(), settle)
        else:
            other = live.select("bucket", F.col("node").alias("_ln"), F.col("root").alias("_lr"))
            found = live.join(other, "bucket").where("root < _lr")
            pairs = found.select(*_pairs(F.col("_ln"), F.col("node"))).distinct()
        settle(pairs)
    return roots
