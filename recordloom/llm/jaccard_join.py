"""Which documents are joined by chains of links, two documents being linked when their sets of word n-grams are alike.

Equal sets are one node from the start. Nodes meet where they can be alike at all: alike sets share some of their first
n-grams in any common order (the order puts n-grams that a sample shows to be frequent last). Nodes that share enough
of their first n-grams with nodes of a fitting size are gathered, each in one block of bounded size, where a signature
tree over their sets is traversed against itself. The clusters found are nodes of an upper level, with their combined bitmaps and size ranges. Clusters of
different blocks that share a first n-gram are paired by a traversal over these, and the pairs that remain possible are
compared by their members. Nothing is capped: a large block is split, and its parts meet again as clusters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm import words
from recordloom.llm.components import components
from recordloom.llm.signature_tree import BITS, Nodes, Threshold, any_link, combined, leaves, linked_groups, possible_pairs, self_pairs, tree
from recordloom.llm.tables import by_batches, by_runs, runs, written

#: One document in so many is looked at for frequent n-grams; the list only orders n-grams, no link depends on it.
SAMPLED = 64
#: Documents of the sample that make an n-gram frequent, and the longest list of them.
FREQUENT_COUNT = 4
FREQUENT_LIST = 65_536
#: A block is split beyond so many n-grams or sets.
BLOCK_GRAMS = 2_000_000
BLOCK_SETS = 2_000
#: Clusters that share an n-gram are split in parts of about so many, every two of which meet.
PART_NODES = 2_000
#: Alike sets share more of longer first parts: of one n-gram in so many beyond the shortest one, all are shared.
SHARED_SHARE = 25
#: Rounds of leaving out sets that share too few of their first n-grams with what is left.
ROUNDS = 2
#: Bits of the map of sets that are wanted, by which texts are passed over before their sets are shuffled.
MAP_BITS = 26
#: Sets a task remembers, so that it sends a set's first n-grams once.
REMEMBERED = 1_000_000


def fingerprints(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64 bits of each set; 0 for the empty one."""
    sizes = np.diff(first)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(value ^ np.uint64(0xA5A5A5A5)), dtype=np.uint64)])
    out = words.mix(sums[first[1:]] - sums[first[:-1]] + sizes.astype(np.uint64))
    out[sizes == 0] = 0
    return out.view(np.int64)


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(f"`{text_column}`").cast("string")
    return docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def frequent_grams(docs: DataFrame, n: int) -> np.ndarray:
    """N-grams found in many documents of the sample, sorted; at most ``FREQUENT_LIST`` come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column(0)):
                value, _ = words.gram_sets(words.words(texts, lower=True), n)
                value, count = np.unique(value, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(count, pa.int64())], ["gram", "n"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(SAMPLED)) == 0).select("text")
    counted = by_batches(sample, run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_COUNT)
    found = counted.orderBy(F.desc("n"), "gram").limit(FREQUENT_LIST).toPandas()
    return np.sort(found["gram"].to_numpy(np.int64).view(np.uint64))


def least_shared(n: int) -> int:
    """How many first n-grams two alike sets share, the smaller of ``n``; the first part is so much longer than the prefix for one."""
    return 1 + n // SHARED_SHARE


def sketches(docs: DataFrame, n: int, threshold: Threshold, frequent: np.ndarray) -> DataFrame:
    """For each document: its text's hash, the set's size and fingerprint, and the first n-grams as bytes."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in words.slices(batch.column(2)):
                value, first = words.gram_sets(words.words(texts, lower=True), n)
                late = np.zeros(len(value), bool)
                if len(frequent):
                    late = frequent[np.minimum(np.searchsorted(frequent, value), len(frequent) - 1)] == value
                prefix = []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    size = threshold.prefix(b - a) + least_shared(b - a) - 1 if b > a else 0
                    own = value[a:b]
                    if late[a:b].any():
                        own = np.concatenate([own[~late[a:b]], own[late[a:b]]])
                    prefix.append(own[:size].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(texts)), batch.column(1).slice(texts.first, len(texts)),
                        pa.array(np.diff(first), pa.int64()), pa.array(fingerprints(value, first)), pa.array(prefix, pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n", "fp", "prefix"],
                )

    return by_batches(docs, run, f"doc_id {schema['doc_id'].dataType.simpleString()}, text_hash long, n long, fp long, prefix binary")


def postings(sketch: DataFrame) -> DataFrame:
    """(gram, fp, n) for the first n-grams of every set, once or a few times each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fps, sizes, prefix = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            new = []
            for k, fp in enumerate(fps):
                if fp not in seen:
                    seen.add(fp)
                    new.append(k)
            if len(seen) > REMEMBERED:
                seen = set()
            lengths = np.array([len(prefix[k]) // 8 for k in new], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(b"".join(prefix[k] for k in new), np.int64)),
                    pa.array(np.repeat(np.array([fps[k] for k in new], np.int64), lengths)),
                    pa.array(np.repeat(np.array([sizes[k] for k in new], np.int64), lengths)),
                ],
                ["gram", "fp", "n"],
            )

    return by_batches(sketch.where("n > 0").select("fp", "n", "prefix"), run, "gram long, fp long, n long")


def _shared(rows: DataFrame, key: str, node: str) -> DataFrame:
    """Keys with at least two different nodes, found by two values a key, and combined before the shuffle."""
    return rows.groupBy(key).agg(F.min(node).alias("a"), F.max(node).alias("b")).where("a <> b").select(key)


def _sharing(posted: DataFrame, percent: int) -> DataFrame:
    """Rows of ``posted`` whose n-gram another set has too, one of a fitting size where there are just two."""
    both = posted.groupBy("gram").agg(*[f(c).alias(f"{name}_{c}") for c in ("fp", "n") for name, f in (("low", F.min), ("high", F.max))], F.count(F.lit(1)).alias("c"))
    kept = both.where("low_fp <> high_fp").where((F.col("c") > 2) | (100 * F.col("low_n") >= percent * F.col("high_n")))
    return posted.join(kept.select("gram"), "gram")


def live_postings(posted: DataFrame, percent: int) -> DataFrame:
    """(gram, fp, n) of sets that share enough of their first n-grams to be alike to any other set.

    A set alike to one of ``n`` n-grams has ``percent`` of ``n`` at least, so it shares ``least_shared`` of that. In the
    order of falling frequency the last n-gram that two alike sets share has all others they share before it, so each
    set can leave out its most frequent ones, one less than it must share.
    """
    needed = 1 + F.floor(F.ceil(F.col("n") * percent / 100) / SHARED_SHARE)
    live = posted
    for _ in range(ROUNDS):
        # dealt by set once: there sets sent by several tasks become one, and few enough rows of a set are counted
        own = _sharing(live, percent).select("gram", "fp", "n").repartition("fp").distinct()
        enough = own.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("fp"))).where(F.col("c") >= needed)
        live = written(enough.select("gram", "fp", "n"), "postings")
    counts = live.groupBy("gram").agg(F.count(F.lit(1)).alias("c"))
    place = F.row_number().over(Window.partitionBy("fp").orderBy(F.desc("c"), "gram"))
    late = live.join(counts, "gram").withColumn("place", place).where(F.col("place") >= needed).select("gram", "fp", "n")
    return written(late.join(_shared(late, "gram", "fp"), "gram"), "postings")


def wanted_map(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap of ``MAP_BITS`` bits in which every key's bit is set; its size does not depend on the number of keys."""
    word = F.shiftright(F.col(key).bitwiseAND(F.lit((1 << MAP_BITS) - 1)), 6).alias("word")
    parts = keys.groupBy(word).agg(F.expr(f"bit_or(shiftleft(1L, CAST({key} & 63 AS INT)))").alias("bits")).toPandas()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[parts["word"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def is_wanted(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys.view(np.uint64) & np.uint64((1 << MAP_BITS) - 1)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0


def blocks(live: DataFrame) -> DataFrame:
    """(fp, gram, part): each set goes to the n-gram that it shares with most others, split into parts of bounded size."""
    counts = live.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("total"))
    best = (
        live.select("gram", "fp").join(counts, "gram").groupBy("fp")
        .agg(F.max(F.struct("c", "total", "gram")).alias("best")).select("fp", "best.*")
    )
    parts = F.greatest(F.ceil(F.col("total") / BLOCK_GRAMS), F.ceil(F.col("c") / BLOCK_SETS))
    return best.select("fp", "gram", F.pmod(F.xxhash64("fp"), parts).alias("part"))


_MEMBER = "fp long, cluster long, n long, grams binary, low long, high long, beyond long, bits binary"


def _set(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def clusters(docs: DataFrame, sketch: DataFrame, live: DataFrame, n: int, threshold: Threshold) -> DataFrame:
    """The sets that share a first n-gram with another one, with their cluster; the row where ``fp = cluster`` describes it."""
    placed = written(blocks(live), "blocks")
    hashes = sketch.join(placed.select("fp"), "fp").groupBy("fp").agg(F.min("text_hash").alias("text_hash"))
    bits = docs.sparkSession.sparkContext.broadcast(wanted_map(hashes, "text_hash"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            hashes = batch.column(1).to_numpy()
            wanted = is_wanted(bits.value, hashes)
            new = [k for k in np.flatnonzero(wanted).tolist() if hashes[k] not in seen]
            seen.update(hashes[k] for k in new)
            if len(seen) > REMEMBERED:
                seen = set()
            if not new:
                continue
            for texts in words.slices(batch.column(2).take(pa.array(new))):
                value, first = words.gram_sets(words.words(texts, lower=True), n)
                cut = [value[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(fingerprints(value, first)), pa.array(cut, pa.binary())], ["fp", "grams"])

    def group(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        for a, b in runs(whole, ["gram", "part"]):
            part = whole.slice(a, b - a)
            fp, at = np.unique(part.column("fp").to_numpy(), return_index=True)  # sent by several tasks
            kept = part.column("grams").take(pa.array(at))
            own = [_set(x.as_py()) for x in kept]
            labels = linked_groups(own, threshold)
            order = np.argsort(labels, kind="stable")
            starts = np.flatnonzero(np.r_[True, labels[order][1:] != labels[order][:-1]])
            node = combined(_take(leaves(own), order), starts)
            cluster = fp[labels]  # the label is the place of the smallest fingerprint
            place = {int(fp[labels[order[s]]]): k for k, s in enumerate(starts)}
            head = [place[int(f)] if f == c else None for f, c in zip(fp, cluster)]
            pick = lambda values: pa.array([None if k is None else int(values[k]) for k in head], pa.int64())  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(fp), pa.array(cluster), pa.array([len(x) for x in own], pa.int64()), kept.combine_chunks() if isinstance(kept, pa.ChunkedArray) else kept,
                    pick(node.low), pick(node.high), pick(node.beyond),
                    pa.array([None if k is None else node.bits[k].tobytes() for k in head], pa.binary()),
                ],
                ["fp", "cluster", "n", "grams", "low", "high", "beyond", "bits"],
            )

    gathered = by_batches(docs, sets, "fp long, grams binary").join(placed, "fp").select("gram", "part", "fp", "grams")
    return by_runs(gathered, ["gram", "part"], group, _MEMBER, rows=2_000)


def _take(nodes: Nodes, order: np.ndarray) -> Nodes:
    return Nodes(nodes.bits[order], nodes.low[order], nodes.high[order], nodes.beyond[order])


def _nodes(part: pa.Table | pa.RecordBatch, suffix: str = "") -> Nodes:
    bits = part.column("bits" + suffix)
    flat = b"".join(bits.to_pylist())
    return Nodes(np.frombuffer(flat, np.uint64).reshape(-1, BITS // 64), *[np.asarray(part.column(c + suffix)) for c in ("low", "high", "beyond")])


_NODE = ("low", "high", "beyond", "bits")


def star_pairs(met: DataFrame, node: DataFrame, threshold: Threshold) -> DataFrame:
    """For each n-gram, its smallest cluster with each other one, where they may have alike sets."""
    first = met.groupBy("gram").agg(F.min("cluster").alias("a"))
    pairs = met.join(first, "gram").where("a <> cluster").select("a", F.col("cluster").alias("b")).distinct()
    side = lambda s: node.select(F.col("cluster").alias(s), *[F.col(c).alias(c + "_" + s) for c in _NODE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                k = np.arange(batch.num_rows)
                keep = possible_pairs(_nodes(batch, "_a"), k, _nodes(batch, "_b"), k, threshold)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return by_batches(pairs.join(side("a"), "a").join(side("b"), "b"), run, "a long, b long")


def tree_pairs(met: DataFrame, node: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs of clusters of different ``group`` that share an n-gram and may have alike sets, by dual traversal."""
    size = met.groupBy("gram").agg(F.count(F.lit(1)).alias("k"))
    parts = F.ceil(F.col("k") / PART_NODES)
    mine = F.pmod(F.xxhash64("cluster"), F.col("parts"))
    spread = (
        met.join(size, "gram").withColumn("parts", parts).withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("gram", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "cluster", "group")
        .join(node, "cluster")
    )

    def group(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        for a, b in runs(whole, ["gram", "x", "y"]):
            part = whole.slice(a, b - a)
            of, label = part.column("cluster").to_numpy(), np.unique(part.column("group").to_numpy(), return_inverse=True)[1]
            flat = _nodes(part)
            order = np.lexsort((of, flat.low))
            of, label = of[order], label[order]
            for i, j in self_pairs(tree(_take(flat, order)), lambda: label, threshold):  # noqa: B023
                pair = np.sort(np.stack([of[i], of[j]]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    return by_runs(spread, ["gram", "x", "y"], group, "a long, b long", rows=4_000).distinct()


def linked_pairs(pairs: DataFrame, member: DataFrame, threshold: Threshold) -> DataFrame:
    """Those pairs of clusters of which two members are alike.

    The larger cluster of a pair is sent once for many smaller ones, not once a pair; smaller ones beyond a bounded
    number of n-grams go to further parts.
    """
    pairs = written(pairs, "pairs")
    sizes = member.groupBy("cluster").agg(F.sum("n").alias("size"))
    side = lambda c: sizes.select(F.col("cluster").alias(c), F.struct("size", F.col("cluster").alias("id")).alias(f"of_{c}"))
    sided = pairs.join(side("a"), "a").join(side("b"), "b").select(F.greatest("of_a", "of_b").alias("large"), F.least("of_a", "of_b").alias("small"))
    sided = sided.select(F.col("large.id").alias("large"), F.col("small.id").alias("small"), F.col("small.size").alias("size"))
    parts = sided.groupBy("large").agg(F.ceil(F.sum("size") / BLOCK_GRAMS).alias("parts"))
    sided = sided.join(parts, "large").withColumn("part", F.pmod(F.xxhash64("small"), "parts")).select("large", "part", "small")
    nowhere = F.lit(None).cast("long")
    once = sided.select("large", "part").distinct().join(member.select(F.col("cluster").alias("large"), "grams"), "large").select("large", "part", nowhere.alias("small"), "grams")
    each = sided.join(member.select(F.col("cluster").alias("small"), "grams"), "small").select("large", "part", "small", "grams")

    def group(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for low, high in runs(whole, ["large", "part"]):
            part = whole.slice(low, high - low)
            large, own = part.column("large")[0].as_py(), {}
            for small, grams in zip(part.column("small").to_pylist(), part.column("grams").to_pylist()):
                own.setdefault(small, []).append(_set(grams))
            center = own.pop(None)
            bottom = leaves(center)
            found += [(large, small) for small, sets in own.items() if any_link(center, bottom, sets, threshold)]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["a", "b"])

    return by_runs(once.unionByName(each), ["large", "part"], group, "a long, b long", rows=2_000)


def _grouped(member: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(fp, cluster, group): the group is the component of clusters known so far."""
    if labels is None:
        return member.select("fp", "cluster", F.col("cluster").alias("group"))
    named = labels.select(F.col("node").alias("cluster"), F.col("component").alias("group"))
    return member.select("fp", "cluster").join(named, "cluster", "left").select("fp", "cluster", F.coalesce("group", "cluster").alias("group"))


def _linked(texts: DataFrame, words_per_gram: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n, group, component_id) for every row of ``texts``; without n-grams, ``group`` is the text's hash."""
    threshold = Threshold(percent)
    sketch = written(sketches(texts, words_per_gram, threshold, frequent_grams(texts, words_per_gram)), "sketches")
    live = live_postings(postings(sketch), percent)
    member = written(clusters(texts, sketch, live, words_per_gram, threshold), "members")
    node = member.where("fp = cluster").select("cluster", *_NODE)
    met = live.select("gram", "fp").join(member.select("fp", "cluster"), "fp").select("gram", "cluster").distinct()
    met = written(met.join(_shared(met, "gram", "cluster"), "gram"), "meetings")
    links = written(linked_pairs(star_pairs(met, node, threshold), member, threshold), "cluster-links")
    labels = components(links)
    groups = met.join(labels.select(F.col("node").alias("cluster"), F.col("component").alias("group")), "cluster", "left")
    groups = groups.select("gram", "cluster", F.coalesce("group", "cluster").alias("group"))
    apart = groups.join(_shared(groups, "gram", "group"), "gram")
    more = written(linked_pairs(tree_pairs(apart, node, threshold), member, threshold), "cluster-links")
    grouped = _grouped(member, components(links.unionByName(more)))
    rows = sketch.select("doc_id", "text_hash", "n", "fp").join(grouped.select("fp", "group"), "fp", "left")
    rows = rows.select("doc_id", "text_hash", "n", F.coalesce("group", "fp").alias("group"))
    # written, so that adaptive execution sees two plain sides and can split a large component or send the other side
    least = written(rows.where("n > 0").groupBy("group").agg(F.min("doc_id").alias("component_id")), "least")
    alone = rows.where("n = 0").select("doc_id", "text_hash", "n", F.col("text_hash").alias("group"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(least, "group").select("doc_id", "text_hash", "n", "group", "component_id").unionByName(alone)


def linked_documents(
    docs: DataFrame, *, words_per_gram: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Two documents are linked when their sets of lower-cased word n-grams have a Jaccard similarity of ``percent`` or
    more. A text with fewer words than an n-gram has its whole sequence as the only one; one without words, or null, has
    none and is linked with nothing. Rows with equal ids are linked by what each of them says; a null id is passed
    over in ``component_id`` unless nothing else is reachable. N-grams and sets are told apart by 64-bit hashes.
    """
    found = _linked(_texts(docs, id_column, text_column), words_per_gram, percent)
    return found.select(F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(
    docs: DataFrame, *, words_per_gram: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, one a component, with all their columns.

    Rows with that id but other texts may belong to other components, and each component keeps its own. Of rows of one
    component with that id the text of the smallest hash stays, and of rows equal in id and text one. Of rows with a null
    id one stays for each text, unless they are linked with a row that has an id.
    """
    found = written(_linked(_texts(docs, id_column, text_column), words_per_gram, percent), "components")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col(f"`{id_column}`").alias("id"), F.xxhash64(F.col(f"`{text_column}`").cast("string")).alias("hash"))
    texts = found.where("doc_id = component_id").groupBy((F.col("n") == 0).alias("empty"), "group", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    heads = texts.groupBy("empty", "group", "doc_id").agg(F.min(F.struct("text_hash", "times")).alias("head"))
    kept = written(heads.select(F.col("doc_id").alias("id"), F.col("head.text_hash").alias("hash"), F.col("head.times").alias("times")), "heads")
    # a row that is there once goes straight through; only repeated ones meet to be made one
    known = keyed.where("id IS NOT NULL")
    once = known.join(kept.where("times = 1").select("id", "hash"), ["id", "hash"], "left_semi")
    again = known.join(kept.where("times > 1").select("id", "hash"), ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"])
    nameless = found.where("doc_id IS NULL AND component_id IS NULL").select(F.col("text_hash").alias("hash")).distinct()
    others = keyed.where("id IS NULL").join(nameless, "hash", "left_semi").dropDuplicates(["hash"])
    rows = once.select("row").unionByName(again.select("row")).unionByName(others.select("row"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
