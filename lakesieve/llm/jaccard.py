"""N-gram Jaccard join with a prefix tree.

One global order of the n-grams: those in fewer texts come first, by a count over
all texts. The counting goes through one exchange of packed hashes; each group of
texts gets back a byte for each of its n-grams, which tells how common it is.

Which texts may be alike: two sets whose Jaccard similarity is num/den or more share
one of the first size - ceil(size * num / den) + 1 n-grams of that order, the sets'
prefixes in the tree. N-grams of one text alone lead nowhere, so that a text that has
as many of its own needs no partner. Where an n-gram begins several texts' prefixes,
these are tied to one of them, and the components of these ties hold every link.

Which are: a component's sets come to one task, in blocks where it is large. There
they are stored in a prefix tree, the n-grams that most of them share first. A set is
matched by walking the tree: sets with a common beginning share its overlap, and a
subtree is left as soon as the elements that remain cannot reach the similarity any
more. Sets that are known to be connected are not compared again, so that copies
cost no pairs.

Components over the block size are first joined in blocks with common pivots;
then what is outside a component's most frequent label is compared with all texts
whose prefix it meets, n-gram by n-gram, or with all other blocks where that moves
fewer rows. Both ways find every link.

Defined results
---------------
null, empty or wordless text   an empty set, linked with nothing
fewer words than n             the whole sequence is the one n-gram
null id                        size only; linked with nothing, null component
repeated rows                  one output row per input row; rows that share an id are one node
empty table                    empty result
other columns                  ignored
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesieve.llm.common import build_filter, cut, filter_hits, give_back, parts, ship, size_mb, some_rows
from lakesieve.llm.graph import UnionFind, components
from lakesieve.llm.shingles import mix, shingle_set

GROUP_MB = 0.5  # of texts whose n-grams are told apart at once, as Catalyst estimates them: packed, that is several times as many
BLOCK = 1024  # sets that are compared in one unit, two blocks of them at most
BLOCK_GRAMS = 1 << 21  # and their n-grams: about as many, one set more at most
PIVOTS = 8


# --- candidates -----------------------------------------------------------------------------------------------------


class Group:
    """The sets of some texts: each distinct one once, and how often each of their n-grams stands in them."""

    def __init__(self, ids: list, texts: list, n: int, buckets: int):
        self.sizes: list[tuple[int, int]] = []
        self.same: list[tuple[int, int]] = []  # ids of equal sets
        self.nodes: list[int] = []
        self.sets: list[np.ndarray] = []
        known: dict[int, list[int]] = {}
        for node, data in zip(ids, texts, strict=True):
            s = shingle_set(data or b"", n)
            self.sizes.append((node, len(s)))
            if len(s):
                alike = known.setdefault(int(mix(s).sum(dtype=np.uint64)), [])
                first = next((k for k in alike if np.array_equal(self.sets[k], s)), None)
                if first is None:
                    alike.append(len(self.sets))
                    self.nodes.append(node)
                    self.sets.append(s)
                elif node != self.nodes[first]:
                    self.same.append((node, self.nodes[first]))
        every = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        self.grams, self.times = np.unique(every, return_counts=True)
        # Buckets are ranges of the hashes; 24 bits more tell the hashes of a bucket apart.
        high, low, b = self.grams >> np.uint64(32), self.grams & np.uint64(0xFFFFFFFF), np.uint64(buckets)
        at = high * b + (low * b >> np.uint64(32))
        self.short = (at >> np.uint64(8) & np.uint64(0xFFFFFF)).astype(np.uint32)
        self.edges = np.searchsorted(at >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))

    def ask(self) -> Iterator[tuple[int, bytes]]:
        """For each bucket its hashes, as steps of two bytes, and a byte a gram for how often it is here, 255 at most."""
        times = np.minimum(self.times, 255).astype(np.uint8)
        for k, (a, b) in enumerate(zip(self.edges.tolist(), self.edges[1:].tolist(), strict=False)):
            if b > a:
                yield k, steps(self.short[a:b]) + times[a:b].tobytes()

    def prefixes(self, answers: Iterable[tuple[int, bytes]], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams, nodes): each set's prefix without the n-grams of this set alone."""
        level = np.zeros(len(self.grams), np.uint8)
        for k, data in answers:
            level[self.edges[k] : self.edges[k + 1]] = np.frombuffer(data, np.uint8)
        grams, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for node, s in zip(self.nodes, self.sets, strict=True):
            mine = level[np.searchsorted(self.grams, s)]
            shared = s[mine > 0]
            take = len(s) + (-num * len(s) // den) + 1 - (len(s) - len(shared))
            if take > 0 and len(shared):
                grams.append(shared[np.lexsort((shared, mine[mine > 0]))[:take]])
                nodes.append(np.full(len(grams[-1]), node, np.int64))
        return np.concatenate(grams), np.concatenate(nodes)


def steps(ascending: np.ndarray) -> bytes:
    """Ascending numbers by their steps; those that two bytes can't hold stand apart."""
    step = np.diff(ascending, prepend=np.uint32(0))
    wide = step[step >= 0xFFFF]
    return np.array([len(step), len(wide)], "<u4").tobytes() + np.minimum(step, 0xFFFF).astype("<u2").tobytes() + wide.astype("<u4").tobytes()


def unstep(data: bytes) -> tuple[np.ndarray, int]:
    """(numbers, where their bytes end)."""
    n, wide = (int(x) for x in np.frombuffer(data, "<u4", 2))
    step = np.frombuffer(data, "<u2", n, 8).astype(np.uint32)
    step[step == 0xFFFF] = np.frombuffer(data, "<u4", wide, 8 + 2 * n)
    return np.cumsum(step, dtype=np.uint32), 8 + 2 * n + 4 * wide


def how_common(rows: list[bytes]) -> list[bytes]:
    """For each group's n-grams of a bucket: 0 for those of one text, else a level that grows with their number.

    Hashes that agree on what is sent are counted as one, which every group sees alike.
    """
    numbers = [unstep(d) for d in rows]
    short = np.concatenate([x for x, _ in numbers])
    times = np.concatenate([np.frombuffer(d, np.uint8, len(x), end) for d, (x, end) in zip(rows, numbers, strict=True)])
    of, at = np.unique(short, return_inverse=True)
    total = np.bincount(at, times, len(of))
    level = np.where(total > 1, np.minimum(255, 1 + np.floor(8 * np.log2(np.maximum(total, 1)))), 0).astype(np.uint8)[at]
    ends = np.cumsum([len(x) for x, _ in numbers])
    return [level[e - len(x) : e].tobytes() for e, (x, _) in zip(ends.tolist(), numbers, strict=True)]


def _pack(sig: np.ndarray, node: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """Postings as (kind, bucket, bytes): ties within the pack, and one posting a hash for the rest of the world."""
    order = np.argsort(sig, kind="stable")
    sig, node = sig[order], node[order]
    new = np.diff(sig, prepend=sig[0] ^ np.uint64(1)) != 0
    lead = node[np.flatnonzero(new)][np.cumsum(new) - 1]
    tie = np.unique(np.stack([node, lead], 1)[~new & (node != lead)], axis=0)
    sig, node = sig[new], node[new]
    bucket = (sig >> np.uint64(20)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in range(buckets):
        own = order[edges[k] : edges[k + 1]]
        if len(own):
            yield 0, k, sig[own].tobytes() + node[own].tobytes()
    if len(tie):
        yield 1, int(sig[0] % np.uint64(buckets)), tie.tobytes()


def _pairs(blobs: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros((0, 2), np.int64), *[np.frombuffer(d, np.int64).reshape(-1, 2) for d in blobs]])


def _unpacked(packed: DataFrame, kind: int, names: tuple[str, str]) -> DataFrame:
    """Pairs of numbers of one kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("data").to_pylist():
                x = np.frombuffer(data, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], names=list(names))

    return packed.where(F.col("kind") == kind).select("data").mapInArrow(run, f"{names[0]} long, {names[1]} long")


PACKED = "kind int, bucket int, data binary"


def prefixes(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, int]:
    """(id, text) -> (kind, bucket, data) and the number of buckets.

    Kinds: 0 postings (n-gram, node) by n-gram, one for each n-gram of a group; 1 ties of nodes that
    share an n-gram; 2 (id, size); 3 (id, id) of equal sets; 4 all postings.
    """
    mb = size_mb(docs)
    buckets = 2 * parts(docs.sparkSession, mb)
    groups = max(docs.sparkSession.sparkContext.defaultParallelism, int(mb / GROUP_MB) + 1)
    # One exchange of the texts serves both steps: the plans of the two are the same up to it.
    dealt = docs.select("id", "text", F.expr(f"cast(pmod(xxhash64(id, text), {groups}) as int)").alias("grp")).repartition(parts(docs.sparkSession, mb, 8 * GROUP_MB), "grp")

    def read(table: pa.Table) -> Group:
        return Group(table.column("id").to_pylist(), table.column("text").cast(pa.binary()).to_pylist(), n, buckets)

    def ask(table: pa.Table) -> pa.Table:
        rows = list(read(table).ask())
        grp = table.column("grp")[0].as_py()
        give_back()
        return pa.table({"bucket": pa.array([k for k, _ in rows], pa.int32()), "grp": pa.array([grp] * len(rows), pa.int32()), "data": pa.array([d for _, d in rows], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        return table.set_column(2, "data", pa.array(how_common(table.column("data").to_pylist()), pa.binary()))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        group = read(left)
        sig, node = group.prefixes(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist(), strict=True), num, den)
        rows = list(_pack(sig, node, buckets)) if len(sig) else []
        for kind, pairs in ((2, group.sizes), (3, group.same), (4, np.stack([sig.view(np.int64), node], 1))):
            if len(pairs):
                rows.append((kind, 0, np.array(pairs, np.int64).tobytes()))
        kind, bucket, data = zip(*rows, strict=True) if rows else ((), (), ())
        give_back()
        return pa.table({"kind": pa.array(kind, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "data": pa.array(data, pa.binary())})

    by = "bucket int, grp int, data binary"
    answers = dealt.groupBy("grp").applyInArrow(ask, by).groupBy("bucket").applyInArrow(answer, by)
    return cut(dealt.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(finish, PACKED), "prefixes"), buckets


def _meet(table: pa.Table) -> pa.Table:
    """Ties of a bucket: nodes that share an n-gram, each with the least of them."""
    rows = list(zip(table.column("kind").to_pylist(), table.column("data").to_pylist(), strict=True))
    ties = [_pairs([d for k, d in rows if k == 1])]
    counts = [len(d) // 16 for k, d in rows if k == 0]
    if counts:
        own = [d for k, d in rows if k == 0]
        sig = np.concatenate([np.frombuffer(d, np.uint64, m) for d, m in zip(own, counts, strict=True)])
        node = np.concatenate([np.frombuffer(d, np.int64, m, 8 * m) for d, m in zip(own, counts, strict=True)])
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.diff(sig, prepend=sig[0] ^ np.uint64(1)) != 0
        lead = node[np.flatnonzero(new)][np.cumsum(new) - 1]
        ties.append(np.stack([node, lead], 1)[~new & (node != lead)])
    out = np.unique(np.concatenate(ties), axis=0)
    return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})


# --- prefix tree ----------------------------------------------------------------------------------------------------


class PrefixTree:
    """Sets as ascending sequences of ranks; a node is a run that its sets share, with what its subtree holds."""

    def __init__(self, sequences: list[np.ndarray]):
        self.sequences = sequences
        self.order = sorted(range(len(sequences)), key=lambda i: sequences[i].tolist())
        self.root = None
        todo = [(0, len(self.order), 0, None)] if sequences else []
        while todo:
            a, b, depth, siblings = todo.pop()
            node, below = self._node(a, b, depth)
            if siblings is None:
                self.root = node
            else:
                siblings.append(node)
            todo += [(x, y, depth + len(node[0]), node[4]) for x, y in below]

    def _node(self, a: int, b: int, depth: int) -> tuple[tuple, list[tuple[int, int]]]:
        """order[a:b], which agree up to depth: (run, shortest, longest, sets that end here, children to come), and the children's ranges."""
        seqs, order = self.sequences, self.order
        first, last = seqs[order[a]], seqs[order[b - 1]]
        m = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:m] != last[depth:m])
        end = depth + int(differ[0]) if len(differ) else m
        lengths = [len(seqs[i]) for i in order[a:b]]
        at = a
        while at < b and len(seqs[order[at]]) == end:
            at += 1
        ends, below = order[a:at], []
        while at < b:
            head, to = seqs[order[at]][end], at + 1
            while to < b and seqs[order[to]][end] == head:
                to += 1
            below.append((at, to))
            at = to
        return (first[depth:end], min(lengths), max(lengths), ends, []), below

    def matches(self, inside: np.ndarray, size: int, num: int, den: int, skip) -> Iterator[int]:
        """Sets with den * overlap >= num * union; inside marks the query's ranks. skip(i): i need not be told."""
        stack = [(self.root, 0, 0)]
        while stack:
            (run, shortest, longest, ends, children), depth, overlap = stack.pop()
            overlap += int(np.count_nonzero(inside[run]))
            depth += len(run)
            # What is left can at best be shared whole; the union is then the least it can be.
            best = min(overlap + longest - depth, size)
            if best < overlap or (den + num) * best < num * (size + max(shortest, best)):
                continue
            for i in ends:
                if (den + num) * overlap >= num * (size + depth) and not skip(i):
                    yield i
            stack += [(c, depth, overlap) for c in children]


def join_sets(sets: list[np.ndarray], nodes: list[int], num: int, den: int, labels: list | None = None, left: list[bool] | None = None) -> list[tuple[int, int]]:
    """Edges that connect what links connect; labels: sets that are connected already; left: who is matched against all."""
    if len(sets) < 2:
        return []
    every, at = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(at, minlength=len(every))
    rank = np.empty(len(every), np.int64)
    rank[np.lexsort((every, -often))] = np.arange(len(every))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    sequences = [np.sort(r) for r in np.split(rank[at], cuts)]
    known = UnionFind()
    tags = [("n", x) for x in nodes]
    for k, tag in enumerate(tags):
        if labels is not None:
            known.union(tag, ("l", labels[k]))
    tree = PrefixTree(sequences)
    inside = np.zeros(len(every), bool)
    edges = []
    for k, s in enumerate(sequences):
        if left is not None and not left[k]:
            continue
        inside[s] = True
        mine = tags[k]
        for i in tree.matches(inside, len(s), num, den, lambda i, mine=mine: known.find(tags[i]) == known.find(mine)):
            known.union(mine, tags[i])
            edges.append((nodes[k], nodes[i]))
        inside[s] = False
    return edges


def _unit(n: int, num: int, den: int):
    """A unit's sets, joined: what groupBy().applyInArrow() calls."""

    def run(table: pa.Table) -> pa.Table:
        names = table.column_names
        rows = {c: table.column(c).to_pylist() for c in names if c != "text"}
        sets = [shingle_set(x or b"", n) for x in table.column("text").cast(pa.binary()).to_pylist()]
        group = rows["group"]
        edges = []
        order = sorted(range(len(sets)), key=lambda k: (group[k], rows["id"][k]))
        at = 0
        while at < len(order):
            to = at
            while to < len(order) and group[order[to]] == group[order[at]]:
                to += 1
            own = [k for k in order[at:to] if len(sets[k])]
            pick = lambda c, own=own: [rows[c][k] for k in own] if c in rows else None
            edges += join_sets([sets[k] for k in own], pick("id"), num, den, pick("label"), pick("left"))
            at = to
        give_back()
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return run


# --- join -----------------------------------------------------------------------------------------------------------


def _member_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The texts of members (id, group, k, size) beside these: a bounded filter first, so that the other texts aren't moved."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(build_filter(members.select(F.xxhash64("id").alias("h"))))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in some_rows(batches):
            hit = filter_hits(shared.value, b.column("h").to_numpy())
            yield b.filter(pa.array(hit)).select(["id", "text"])

    some = docs.withColumn("h", F.xxhash64("id")).mapInArrow(keep, "id long, text string")
    return cut(some.join(members, "id"), "texts")


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """id, n_shingles, component of every document: texts whose n-word shingle sets have a Jaccard similarity of num/den or more are linked.

    The component is the smallest id that links lead to.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = rows.where("id is not null")
    packed, _ = prefixes(named, n, num, den)
    sizes = _unpacked(packed, 2, ("id", "size"))
    ties = packed.where("kind < 2").groupBy("bucket").applyInArrow(_meet, "a long, b long")
    may = cut(components(ties), "may")
    members = may.select(F.col("node").alias("id"), F.col("component").alias("group"))
    members = members.join(sizes.groupBy("id").agg(F.sum("size").alias("size")), "id")
    count = members.groupBy("group").agg(_blocks(F.count("*"), F.sum("size"), block).alias("k"))
    members = cut(members.join(cut(count, "count"), "group").select("id", "group", "k", "size"), "members")
    texts = _member_texts(named, members)
    unit = _unit(n, num, den)
    units = parts(spark, size_mb(texts), 8.0) * 4
    small = texts.where("k = 1").withColumn("unit", F.expr(f"pmod(xxhash64(group), {units})"))
    links = cut(small.select("unit", "group", "id", "text").groupBy("unit").applyInArrow(unit, "a long, b long"), "links")
    large = members.where("k > 1")
    if not large.isEmpty():
        links = cut(links.unionByName(_large(large, texts.where("k > 1"), _unpacked(packed, 4, ("sig", "id")), unit, block)), "links")
    done = cut(components(links.unionByName(_unpacked(packed, 3, ("a", "b")))), "components")
    out = sizes.join(done, F.col("id") == F.col("node"), "left").select("id", F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component"))

    def sizes_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "n_shingles": pa.array([len(shingle_set(x or b"", n)) for x in b.column("text").cast(pa.binary()).to_pylist()], pa.int64()), "component": b.column("id")})

    return out.unionByName(rows.where("id is null").mapInArrow(sizes_only, "id long, n_shingles long, component long"))


def _blocks(count: Column, grams: Column, block: int) -> Column:
    """How many blocks these sets make."""
    return F.greatest(F.lit(1), F.ceil(count / block), F.ceil(grams / BLOCK_GRAMS)).cast("long")


def _large(large: DataFrame, texts: DataFrame, postings: DataFrame, unit, block: int) -> DataFrame:
    """Links of components of k > 1 blocks (id, group, k, size); postings: (sig, id) of the prefixes."""
    # 1: blocks, each with the same pivots, so that what is like them is connected over all blocks
    home = F.expr("pmod(xxhash64(id, 1), k)")
    blocks = texts.select(F.concat_ws("-", "group", home).alias("unit"), "group", "id", "text")
    chance = F.expr(f"pmod(xxhash64(id, 2), greatest(1, k * {block} div {8 * PIVOTS})) = 0")
    pivots = large.groupBy("group", "k").agg(F.slice(F.sort_array(F.collect_set(F.when(chance, F.struct(F.xxhash64("id", F.lit(2)).alias("h"), F.col("id"))))), 1, PIVOTS).alias("p"))
    pivots = pivots.select("group", "k", F.explode("p.id").alias("id")).select("group", "id", home.alias("home"), F.explode(F.expr("sequence(0L, k - 1)")).alias("at"))
    pivots = cut(pivots.where("at <> home").select(F.concat_ws("-", "group", "at").alias("unit"), "group", "id"), "pivots")
    first = blocks.unionByName(texts.select("id", "text").join(pivots, "id").select("unit", "group", "id", "text"))
    links = cut(first.groupBy("unit").applyInArrow(unit, "a long, b long"), "links")
    label = cut(components(links), "label").select(F.col("node").alias("id"), F.col("component").alias("label"))
    label = cut(large.join(label, "id", "left").select("id", "group", "k", "size", F.coalesce("label", "id").alias("label")), "labels")
    main = label.groupBy("group", "label").count().groupBy("group").agg(F.max(F.struct("count", "label")).alias("top"), F.count("*").alias("labels"))
    main = cut(main.where("labels > 1").select("group", F.col("top.label").alias("main")), "main")
    label = cut(label.join(main, "group").select("id", "group", "k", "size", "label", (F.col("label") != F.col("main")).alias("left")), "labels")
    if label.isEmpty():
        return links

    # 2: texts outside their component's most frequent label meet all whose prefix they meet
    shared = cut(postings.distinct().join(label, "id"), "postings")
    outside = F.sum(F.when(F.col("left"), F.col("size")).otherwise(F.lit(0)))
    per = shared.groupBy("group", "k", "sig").agg(F.count("*").alias("m"), F.min("label").alias("l0"), F.max("label").alias("l1"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("h"), F.count_if("left").alias("outside"), _blocks(F.count_if("left"), outside, block).alias("kl"), _blocks(F.count("*"), F.sum("size"), block).alias("kr"))
    # n-grams with the same members tell the same
    open_ = cut(per.where("outside > 0 and l0 <> l1").groupBy("group", "k", "h", "m").agg(F.min(F.struct("sig", "kl", "kr")).alias("s")).select("group", "k", "m", "s.*"), "open")
    rows = open_.groupBy("group").agg(F.sum(F.expr("m * greatest(kl, kr)")).alias("by_gram"))
    way = cut(label.groupBy("group").agg(F.expr("count(*) * (first(k) - 1)").alias("by_block")).join(rows, "group"), "way")
    at = shared.select("sig", "group", "id", "label", "left").join(open_.join(way.where("by_gram < by_block"), "group", "left_semi").select("sig", "group", "kl", "kr"), ["sig", "group"])
    lefts = at.where("left").select("sig", "id", "label", "left", F.expr("pmod(xxhash64(id, 3), kl)").alias("i"), F.explode(F.expr("sequence(0L, kr - 1)")).alias("j"))
    rights = at.select("sig", "id", "label", F.lit(False).alias("left"), F.explode(F.expr("sequence(0L, kl - 1)")).alias("i"), F.expr("pmod(xxhash64(id, 4), kr)").alias("j"))
    by_gram = lefts.unionByName(rights).groupBy("sig", "i", "j", "id", "label").agg(F.max("left").alias("left")).select(F.concat_ws("-", "sig", "i", "j").alias("unit"), "id", "label", "left")
    by_block = label.join(way.where("by_gram >= by_block"), "group", "left_semi").select("group", "id", "label", "left", home.alias("home"), F.explode(F.expr("sequence(0L, k - 1)")).alias("at")).where("at <> home")
    by_block = by_block.select(F.concat_ws("-", F.lit("g"), "group", F.least("home", "at"), F.greatest("home", "at")).alias("unit"), "id", "label", "left")
    second = by_gram.unionByName(by_block).join(texts.select("id", "text"), "id").select("unit", F.lit(0).cast("long").alias("group"), "id", "label", "left", "text")
    return links.unionByName(second.groupBy("unit").applyInArrow(unit, "a long, b long"))
