"""Operator 10: exact Jaccard join of word n-gram sets, as components of linked documents.

Sets equal to each other become one node. Each node enters the inverted lists of
its prefix: its rarest elements, as many as a link must touch one of. Lists are
sorted by set size, so a list is read in blocks, and blocks are skipped whose
sizes or positions rule a link out.

Lists of a few nodes give their pairs. In longer lists answers come from set
relations: first every node meets the leading node of its block only; then, when
components of those links are known, a node takes over the answers of the
similar sets it is linked with, and meets only nodes of other components. (What is
derived from a similar set is its component, which is all that the result needs; a
pair inside a component isn't looked at again.) Pairs pass an exact parity-bitmap
bound before their texts are compared, shingle by shingle.

Hot lists are split. A list that the counts say to be long is dealt out in parts,
whose leading nodes meet in a second step. Where nodes of several components stay
in a list of over ``LIST_PART`` entries, pairs of its blocks go to tasks of their
own, and a component larger than a block never meets itself.

Element order: elements known as frequent go last. Frequencies come from counts
over all documents (each task drops what it saw once); the order decides
work only, never results. Elements are 64-bit hashes, which find candidates; a link
counts only after the words of both texts were compared. Equal sets are told by a
128-bit digest of their elements, of which 64 bits name the node; sets that share
these are named by the other 64.

Defined results: null and empty texts have an empty set and link with nothing;
a text of fewer words than n has one element; repeated documents form one
component; rows with a null or repeated id are rows of their own: a component is
named by its least id that isn't null, or null, and its first row is the one of
that id, of equal ids the one of least text digest; other columns are not carried;
an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, Memo, in_arrow, is_id, materialize, numbered, small_side, text_slices, with_row
from .components import components

#: A list of at most so many nodes gives all its pairs at once.
SHORT_LIST = 8
#: Entries of a list that one task takes.
LIST_PART = 40_000
#: Entries that one bucket of lists should hold.
BUCKET_ENTRIES = 500_000
#: Cells of the broadcast table of frequencies, a byte each at every size of the input.
CELLS = 1 << 22
#: Bytes of texts that are worked on at once.
SLICE = 2_000_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_words = Memo(lambda chunks: [xxhash.xxh3_64_intdigest(c) for c in chunks], 150_000)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], n: int = 5) -> list[np.ndarray]:
    """Sorted distinct element hashes of each text; A-Z count as lower case, words end at ASCII white space."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    table = _words.table(set().union(*words))
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum())
    flat = np.fromiter((table[w] for ws in words for w in ws), np.uint64, total)
    rolled = np.zeros(total, np.uint64)
    if total >= n:
        rolled = flat[: total - n + 1].copy()
        for k in range(1, n):
            rolled = rolled * MULTIPLIER + flat[k : total - n + 1 + k]
        rolled = mixed(rolled)
    out, at = [], 0
    for size in sizes.tolist():
        if size >= n:
            out.append(np.unique(rolled[at : at + size - n + 1]))
        elif size:
            h = np.uint64(size)
            with np.errstate(over="ignore"):
                for w in flat[at : at + size]:
                    h = h * MULTIPLIER + w
            out.append(mixed(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += size
    return out


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set's elements as two signed integers; (0, 0) of the empty set."""
    if not len(s):
        return 0, 0
    both = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(both[8:], "big", signed=True), int.from_bytes(both[:8], "big", signed=True)


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the number of elements in each of 64 or more cells, a cell for each element or two."""
    cells = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits((np.bincount((s >> np.uint64(5)).astype(np.int64) & (cells - 1), minlength=cells) & 1).astype(np.uint8)).tobytes()


def may_link(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """False only where the bitmaps show more differing elements than a link leaves room for.

    Rows of ``a`` and ``b`` are bitmaps, those of ``a`` no wider.
    """
    # the parity of a cell of the small bitmap is that of the cells of the large one that fold on it
    folded = np.bitwise_xor.reduce(b.reshape(len(b), -1, a.shape[1]), axis=1)
    differ = np.bitwise_count(folded ^ a).sum(axis=1, dtype=np.int64)
    # overlap o needs o * (den + num) >= num * (n_a + n_b), and n_a + n_b - 2 o elements differ
    num, den = t
    total = n_a.astype(np.int64) + n_b
    least = -(-num * total // (num + den))
    return differ <= total - 2 * least


def profiles(docs: DataFrame, n: int) -> DataFrame:
    """Mixed rows of ``docs`` (row, text): (row, n, sig, far, sketch) of each, and (h, c): elements that a task saw c > 1 times."""
    names = ["row", "n", "sig", "far", "sketch", "h", "c"]

    def run(batches):
        seen: set[int] = set()
        kept: list[np.ndarray] = []
        held = 0

        def frequent():
            h, c = np.unique(np.concatenate(kept), return_counts=True) if kept else (np.zeros(0, np.uint64), np.zeros(0))
            h, c = h[c > 1], c[c > 1]
            none = pa.nulls(len(h), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none.cast(pa.int32()), none, none, pa.nulls(len(h), pa.binary()), pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=names
            )

        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), SLICE):
                sets = shingle_sets(texts, n)
                both = [digest(s) for s in sets]
                for s, (g, _) in zip(sets, both):
                    if len(s) and g not in seen:
                        seen.add(g)
                        kept.append(s)
                        held += len(s)
                none = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([g for g, _ in both], pa.int64()),
                        pa.array([f for _, f in both], pa.int64()),
                        pa.array([bitmap(s) if len(s) else b"" for s in sets], pa.binary()),
                        none,
                        none,
                    ],
                    names=names,
                )
                if held > 1_500_000:
                    yield frequent()
                    kept.clear()
                    seen.clear()  # what is seen again later is counted again, which only raises a frequency
                    held = 0
        if kept:
            yield frequent()

    return in_arrow(docs.select("row", "text"), run, "row bigint, n int, sig bigint, far bigint, sketch binary, h bigint, c bigint")


def frequencies(rows: DataFrame) -> np.ndarray:
    """Logarithm of the largest count among the frequent elements of each of CELLS cells, in bytes."""
    counts = rows.where("h is not null").groupBy("h").agg(F.sum("c").alias("c"))
    cells = counts.groupBy(F.pmod("h", F.lit(CELLS)).cast("int").alias("cell")).agg(F.max("c").alias("c"))
    found = cells.select("cell", F.least(F.floor(4 * F.log2("c")), F.lit(127)).cast("tinyint").alias("level")).toArrow()  # CELLS rows at most
    table = np.zeros(CELLS, np.uint8)
    table[found["cell"].to_numpy()] = found["level"].to_numpy()
    return table


def levels(s: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[(s & np.uint64(CELLS - 1)).astype(np.int64)]


def prefix(s: np.ndarray, level: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """The first elements of ``s`` in the common order, rare before frequent; sets that link share one of both prefixes."""
    num, den = t
    size = len(s) - -(-num * len(s) // den) + 1
    return s[np.argsort(level, kind="stable")][:size] if level.any() else s[:size]


ENTRY = np.dtype([("h", "<u4"), ("node", "<u2"), ("pos", "<u2")])
NODE = np.dtype([("sig", "<i8"), ("n", "<u4"), ("core", "u1")])


def parts_of(level: np.ndarray) -> np.ndarray:
    """Parts of the lists of elements whose counts have these logarithms."""
    return np.maximum(1, np.ceil(2.0 ** (level / 4.0) / LIST_PART)).astype(np.int64)


def list_entries(docs: DataFrame, table: np.ndarray, n: int, t: tuple[int, int], n_buckets: int, twice: frozenset[int]) -> DataFrame:
    """Packed list entries of ``docs`` (row, text): (bucket, base, nodes, entries), a few rows for each slice of texts.

    Lists are told apart by base and hash. An unsplit list is in the bucket of its
    base; the parts of a split one lie in several buckets, and have a base of
    ``n_buckets`` or more. A node's core is the share of its elements that are
    frequent: of similar sets, the one with most in common with the others has the
    highest. ``twice`` are the signatures that several sets have.
    """
    shared = docs.sparkSession.sparkContext.broadcast((table, twice))

    def run(batches):
        table, twice = shared.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0), SLICE):
                nodes, parts, spread = [], [], []
                for s in shingle_sets(texts, n):
                    g, far = digest(s)
                    g = far if g in twice else g
                    if len(s) and g not in seen:
                        seen.add(g)
                        level = levels(s, table)
                        nodes.append((g, len(s), int(level.astype(np.int64).sum() * 2 // len(s))))
                        parts.append(prefix(s, level, t))
                        spread.append(parts_of(levels(parts[-1], table)))
                if len(seen) > 400_000:
                    seen.clear()  # entries that come twice are told where their list is read
                for at in range(0, len(nodes), 60_000):
                    own, some = np.array(nodes[at : at + 60_000], NODE), parts[at : at + 60_000]
                    counts = [len(p) for p in some]
                    h, split = np.concatenate(some), np.concatenate(spread[at : at + 60_000])
                    node = np.repeat(np.arange(len(own)), counts)
                    pos = np.concatenate([np.arange(c) for c in counts])
                    base = (h % np.uint64(n_buckets)).astype(np.int64)
                    salt = (mixed(own["sig"].view(np.uint64))[node] % split.astype(np.uint64)).astype(np.int64)
                    bucket = (base + salt) % n_buckets
                    base += np.where(split > 1, n_buckets, 0)
                    place = bucket * (2 * n_buckets) + base
                    by = np.argsort(place, kind="stable")
                    first = np.nonzero(np.concatenate([[True], place[by][1:] != place[by][:-1]]))[0]
                    out = []
                    for x, y in zip(first.tolist(), [*first[1:].tolist(), len(by)]):
                        i = by[x:y]
                        used, local = np.unique(node[i], return_inverse=True)
                        e = np.empty(len(i), ENTRY)
                        e["h"], e["node"], e["pos"] = h[i] >> np.uint64(32), local, np.minimum(pos[i], 65535)
                        out.append((int(bucket[i[0]]), int(base[i[0]]), own[used].tobytes(), e.tobytes()))
                    if out:
                        ks, bs, ns, es = zip(*out)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ks, pa.int32()), pa.array(bs, pa.int32()), pa.array(ns, pa.binary()), pa.array(es, pa.binary())],
                            names=["bucket", "base", "nodes", "entries"],
                        )

    return in_arrow(docs.select("text"), run, "bucket int, base int, nodes binary, entries binary")


def fits(n_a, i, n_b, j, t):
    """Where sizes and positions leave room for a link whose first common element stands there; n_a <= n_b."""
    num, den = t
    n_a, i, n_b, j = (np.asarray(x, np.int64) for x in (n_a, i, n_b, j))
    room = 1 + np.minimum(n_a - i - 1, n_b - j - 1)
    return (den * n_a >= num * n_b) & ((num + den) * room >= num * (n_a + n_b))


def unique_pairs(a: list, b: list) -> tuple[np.ndarray, np.ndarray]:
    x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
    x, y = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    first = np.ones(len(x), bool)
    first[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first &= x != y
    return x[first], y[first]


def size_class(n: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    """Classes so wide that linked sets stand in one or in neighbouring ones."""
    return np.floor(np.log(n) / np.log(t[1] / t[0]) + 1e-9).astype(np.int64)


def pairs_of_lists(lst, sig, n, pos, core, split, t):
    """Pairs (a, b) that lists ``lst`` give at once; indices of entries of long or split lists; of the leading ones of split lists.

    Arrays come sorted by list, size and signature, without repeats.
    """
    starts = np.nonzero(np.concatenate([[True], lst[1:] != lst[:-1]]))[0] if len(lst) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(lst)))
    length = np.repeat(sizes, sizes)
    a, b = [], []

    def put(i, j):
        ok = fits(n[i], pos[i], n[j], pos[j], t)
        a.append(sig[i[ok]])
        b.append(sig[j[ok]])

    short = np.nonzero((length > 1) & (length <= SHORT_LIST))[0]
    for d in range(1, SHORT_LIST):
        i = short[short + d < len(lst)]
        i = i[lst[i] == lst[i + d]]
        put(i, i + d)
    long = np.nonzero((length > SHORT_LIST) | split)[0]
    heads = long[:0]
    if len(long):
        i = long
        k = size_class(n[i], t)
        lead = np.concatenate([[True], (lst[i][1:] != lst[i][:-1]) | (k[1:] != k[:-1])])
        block = np.cumsum(lead) - 1
        # of each block the set with the highest core leads, the least signature where several do
        best = np.lexsort((sig[i], -core[i].astype(np.int64), block))
        heads = i[best[np.searchsorted(block[best], np.arange(int(block[-1]) + 1))]]
        put(np.minimum(heads[block], i), np.maximum(heads[block], i))
        later = block > 0
        before = heads[block[later] - 1]
        same = lst[before] == lst[i[later]]
        put(before[same], i[later][same])
        after = heads[np.minimum(block + 1, len(heads) - 1)]
        same = (block + 1 < len(heads)) & (lst[after] == lst[i])
        put(i[same], after[same])
    return unique_pairs(a, b), long, heads[split[heads]] if len(heads) else heads


FOUND = ["a", "b", "base", "h", "sig", "n", "pos", "core", "leads"]
FOUND_DDL = "a bigint, b bigint, base int, h bigint, sig bigint, n int, pos int, core int, leads boolean"


def found_rows(lst, sig, n, pos, core, split, t):
    """Record batches of FOUND: pairs, and entries that a later step needs. Entries may repeat and have any order."""
    order = np.lexsort((sig, n, lst))
    lst, sig, n, pos, core, split = (x[order] for x in (lst, sig, n, pos, core, split))
    first = np.ones(len(lst), bool)
    first[1:] = (lst[1:] != lst[:-1]) | (sig[1:] != sig[:-1])
    lst, sig, n, pos, core, split = (x[first] for x in (lst, sig, n, pos, core, split))
    (a, b), long, heads = pairs_of_lists(lst, sig, n, pos, core, split, t)
    for at in range(0, len(a), 200_000):
        x, y = pa.array(a[at : at + 200_000]), pa.array(b[at : at + 200_000])
        none, wide = pa.nulls(len(x), pa.int32()), pa.nulls(len(x), pa.int64())
        yield pa.RecordBatch.from_arrays([x, y, none, wide, wide, none, none, none, pa.nulls(len(x), pa.bool_())], names=FOUND)
    leads = np.zeros(len(lst), bool)
    leads[heads] = True
    for at in range(0, len(long), 200_000):
        i = long[at : at + 200_000]
        none = pa.nulls(len(i), pa.int64())
        small = [pa.array(v.astype(np.int32)) for v in (n[i], pos[i], core[i])]
        yield pa.RecordBatch.from_arrays(
            [none, none, pa.array((lst[i] >> 32).astype(np.int32)), pa.array(lst[i] & 0xFFFFFFFF), pa.array(sig[i]), *small, pa.array(leads[i])], names=FOUND
        )


def first_pairs(entries: DataFrame, t: tuple[int, int], n_buckets: int) -> DataFrame:
    """Mixed rows: pairs (a, b) of nodes, and (base, h, sig, n, pos, core, leads) of long and split lists."""

    def made(rows):
        nodes = [np.frombuffer(x, NODE) for _, x, _ in rows]
        es = [np.frombuffer(y, ENTRY) for *_, y in rows]
        base = np.repeat(np.array([k for k, *_ in rows], np.int64), [len(e) for e in es])
        lst = base << 32 | np.concatenate([e["h"] for e in es]).astype(np.int64)
        sig, n, core = (np.concatenate([v[k][e["node"]] for v, e in zip(nodes, es)]) for k in ("sig", "n", "core"))
        pos = np.concatenate([e["pos"] for e in es]).astype(np.int64)
        yield from found_rows(lst, sig, n.astype(np.int64), pos, core, base >= n_buckets, t)

    def run(batches):
        bucket, rows = None, []
        for batch in batches:
            # row by row, so that no second copy of the batch is made
            for k, *row in ([c[i].as_py() for c in batch.columns] for i in range(batch.num_rows)):
                if k != bucket and rows:
                    yield from made(rows)
                    rows = []
                bucket = k
                rows.append(row)
        if rows:
            yield from made(rows)

    dealt = entries.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    return in_arrow(dealt, run, FOUND_DDL)


def pairs_of_leads(leads: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) among the leading nodes of the parts of each split list: one node in LIST_PART of it."""

    def run(batches):
        held = [batch for batch in batches if batch.num_rows]
        if held:
            base, h, sig, n, pos, core = (np.concatenate([b.column(i).to_numpy().astype(np.int64) for b in held]) for i in range(6))
            for made in found_rows(base << 32 | h, sig, n, pos, core, np.zeros(len(h), bool), t):
                keep = made.filter(made.column(0).is_valid())
                if keep.num_rows:
                    yield keep.select(["a", "b"])

    return in_arrow(leads.select("base", "h", "sig", "n", "pos", "core").repartition("base", "h"), run, "a bigint, b bigint")


def block_groups(labelled: DataFrame) -> DataFrame:
    """Entries (base, h, sig, n, pos, comp) of lists with several components, as (grp, block, sig, n, pos, comp).

    Nodes of different components of a list meet in one group at least. Lists of at
    most LIST_PART entries are one group. A longer list is cut into blocks: of each
    component that is larger than a block, and of the other components together; a
    group is a pair of blocks, but for those of one component.
    """
    per_comp = labelled.groupBy("base", "h", "comp").agg(F.count("*").alias("size"))
    lists = per_comp.groupBy("base", "h").agg(
        F.count("*").alias("n_comps"), F.sum("size").alias("total"), F.sum(F.when(F.col("size") <= LIST_PART, F.col("size")).otherwise(0)).alias("rest")
    ).where("n_comps > 1")
    lists = materialize(lists, "lists")
    mixed_lists = labelled.join(small_side(lists.select("base", "h", "total", "rest")), ["base", "h"])
    grp = lambda *c: F.xxhash64("base", "h", *c).alias("grp")
    whole = mixed_lists.where(F.col("total") <= LIST_PART).select(grp(), F.lit(0).cast("long").alias("block"), "sig", "n", "pos", "comp")
    big = lists.where(F.col("total") > LIST_PART)
    if big.isEmpty():
        return whole
    giants = per_comp.where(F.col("size") > LIST_PART).join(big.select("base", "h"), ["base", "h"], "left_semi")
    giants = materialize(giants.select("base", "h", "comp", F.ceil(F.col("size") / LIST_PART).alias("n_parts")), "giants")
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    others = big.where("rest > 0").select("base", "h", numbers(F.ceil(F.col("rest") / LIST_PART)).alias("k"), F.lit(None).cast("long").alias("of"))
    blocks = giants.select("base", "h", numbers(F.col("n_parts")).alias("k"), F.col("comp").alias("of")).unionByName(others)
    blocks = materialize(blocks.select("base", "h", F.xxhash64("of", "k").alias("block"), "of"), "blocks")
    two = blocks.alias("x").join(blocks.alias("y"), ["base", "h"]).where(
        "x.block <= y.block and (x.of is null or y.of is null or x.of <> y.of)"
    ).select("base", "h", F.col("x.block").alias("x"), F.col("y.block").alias("y"))
    meets = two.withColumn("grp", grp("x", "y"))
    meets = meets.select("base", "h", "grp", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    entries = mixed_lists.where(F.col("total") > LIST_PART).join(small_side(giants), ["base", "h", "comp"], "left")
    k = F.when(F.col("n_parts").isNull(), F.pmod(F.xxhash64("comp"), F.ceil(F.col("rest") / LIST_PART))).otherwise(F.pmod(F.xxhash64("sig"), "n_parts"))
    of = F.when(F.col("n_parts").isNotNull(), F.col("comp"))
    placed = entries.withColumn("block", F.xxhash64(of, k.cast("long")))
    return whole.unionByName(placed.join(meets, ["base", "h", "block"]).select("grp", "block", "sig", "n", "pos", "comp"))


def later_pairs(groups: DataFrame, t: tuple[int, int], n_parts: int) -> DataFrame:
    """Pairs of nodes of different components that stand in one group of ``groups`` (grp, block, sig, n, pos, comp)."""

    def of_group(block, sig, n, pos, comp):
        order = np.lexsort((sig, n))
        block, sig, n, pos, comp = (x[order] for x in (block, sig, n, pos, comp))
        crossed = (block != block[0]).any()
        end = np.searchsorted(n, n * t[1] // t[0], side="right")  # beyond it, sizes rule a link out
        a, b, held = [], [], 0
        for i in range(len(sig)):
            j = np.arange(i + 1, end[i])
            j = j[comp[j] != comp[i]]
            if crossed:
                j = j[block[j] != block[i]]
            j = j[fits(n[i], pos[i], n[j], pos[j], t)] if len(j) else j
            if len(j):
                a.append(np.full(len(j), sig[i]))
                b.append(sig[j])
                held += len(j)
            if held > 500_000:
                yield unique_pairs(a, b)
                a, b, held = [], [], 0
        if held:
            yield unique_pairs(a, b)

    def run(batches):
        names = ["a", "b"]
        key, rest = None, []

        def flush():
            for a, b in of_group(*(np.concatenate(c) for c in zip(*rest))):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            grp, *cols = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
            edges = [0, *(np.nonzero(grp[1:] != grp[:-1])[0] + 1).tolist(), len(grp)]
            for x, y in zip(edges, edges[1:]):
                if int(grp[x]) != key and rest:
                    yield from flush()
                    rest = []
                key = int(grp[x])
                rest.append([c[x:y] for c in cols])
        if rest:
            yield from flush()

    dealt = groups.select("grp", "block", "sig", "n", "pos", "comp").repartition(n_parts, "grp").sortWithinPartitions("grp")
    return in_arrow(dealt, run, "a bigint, b bigint")


def bounded(pairs: DataFrame, nodes: DataFrame, t: tuple[int, int]) -> DataFrame:
    """Pairs that the parity bitmaps don't rule out."""
    side = lambda c: nodes.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "s_a", "n_b", "s_b")

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            s_a, s_b = (batch.column(c).to_pylist() for c in ("s_a", "s_b"))
            ok = np.zeros(batch.num_rows, bool)
            alike: dict[tuple[int, int], list[int]] = {}
            for k, (x, y) in enumerate(zip(s_a, s_b)):
                alike.setdefault((len(x), len(y)), []).append(k)
            for (x, y), rows in alike.items():
                a, b = (np.frombuffer(b"".join(s[k] for k in rows), np.uint8).reshape(len(rows), -1) for s in (s_a, s_b))
                ok[rows] = may_link(a, n_a[rows], b, n_b[rows], t) if x <= y else may_link(b, n_b[rows], a, n_a[rows], t)
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    return in_arrow(both, run, "a bigint, b bigint")


def linked(a: str | None, b: str | None, n: int, t: tuple[int, int]) -> bool:
    """Whether the shingles of two texts that aren't one set link, by their words."""
    x, y = ((s or "").encode("utf-8", "surrogatepass").lower().split() for s in (a, b))
    if len(x) < n or len(y) < n:
        return False  # a whole sequence as one element links with its equals only
    names: dict[bytes, int] = {}
    word = np.fromiter((names.setdefault(w, len(names)) for w in (*x, *y)), np.int64, len(x) + len(y))
    base, code, most = len(names), word, len(names)
    for k in range(1, n):
        if most * base >= 1 << 62:  # number the beginnings anew, so that one number never stands for two
            _, code = np.unique(code, return_inverse=True)
            most = int(code.max()) + 1
        code, most = code[:-1] * base + word[k:], most * base
    u, v = np.unique(code[: len(x) - n + 1]), np.unique(code[len(x) :])
    z = np.sort(np.concatenate([u, v]))
    common = int((z[1:] == z[:-1]).sum())
    return (t[0] + t[1]) * common >= t[0] * (len(u) + len(v))


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, n: int, t: tuple[int, int]) -> DataFrame:
    """The pairs whose texts link."""
    pairs = materialize(pairs, "candidates")
    needed = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    chosen = materialize(nodes.select("sig", "row").join(needed, "sig"), "needed")
    texts = materialize(docs.select("row", "text").join(small_side(chosen), "row").select("sig", "text"), "texts")
    with_a = pairs.join(texts.select(F.col("sig").alias("a"), F.col("text").alias("t_a")), "a")
    both = with_a.join(texts.select(F.col("sig").alias("b"), F.col("text").alias("t_b")), "b").select("a", "b", "t_a", "t_b")

    def compare(batches):
        for batch in batches:
            ok = [linked(x.as_py(), y.as_py(), n, t) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    return materialize(in_arrow(both, compare, "a bigint, b bigint"), "links")


def name_nodes(rows: DataFrame) -> tuple[DataFrame, frozenset[int]]:
    """``rows`` (sig, far, ...) with signatures that tell sets apart, and those that several sets had.

    Of N sets, N * N / 2 ** 65 pairs share 64 bits by chance: three of ten billion.
    """
    several = lambda df: df.where("n > 0").groupBy("sig").agg(F.min("far").alias("x"), F.max("far").alias("y")).where("x < y")
    shared = several(rows).select("sig").limit(100_001).collect()
    if not shared:
        return rows, frozenset()
    if len(shared) > 100_000:
        raise RuntimeError("more signatures are shared than chance allows")
    twice = frozenset(r["sig"] for r in shared)
    known = rows.sparkSession.createDataFrame([(g, True) for g in twice], "sig bigint, shared boolean")
    named = rows.join(F.broadcast(known), "sig", "left").withColumn("sig", F.when(F.col("shared"), F.col("far")).otherwise(F.col("sig"))).drop("shared")
    if not several(named).isEmpty():
        raise RuntimeError("both halves of digests are shared")
    return named, twice


def jaccard_components(
    docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (3, 4), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, n_shingles, component_id (least id reachable by links) and is_first (it is that id).

    ``threshold`` is a fraction (numerator, denominator).
    """
    base = components_by_row(with_row(docs, id_col, text_col), n, threshold)
    return base.select(F.col("id").alias(id_col), "n_shingles", "component_id", "is_first")


def components_by_row(docs: DataFrame, n: int, t: tuple[int, int]) -> DataFrame:
    """(row, id, n_shingles, component_id, is_first) of ``docs`` (row, id, text)."""
    rows = materialize(profiles(docs, n), "profiles")
    base, twice = name_nodes(rows.where("h is null").select("row", "n", "sig", "far", "sketch"))
    nodes = base.where("n > 0").groupBy("sig").agg(F.min("row").alias("row"), F.max("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = materialize(nodes, "nodes")
    total = nodes.agg(F.sum(F.col("n") * (t[1] - t[0]) / t[1] + 1)).first()[0] or 0
    n_buckets = max(4, int(total // BUCKET_ENTRIES) + 1)
    entries = list_entries(docs, frequencies(rows), n, t, n_buckets, twice)
    found = materialize(first_pairs(entries, t, n_buckets), "pairs")
    pairs = found.where("a is not null").select("a", "b")
    leads = found.where("leads").select("base", "h", "sig", "n", "pos", "core")
    if not leads.isEmpty():
        pairs = pairs.unionByName(pairs_of_leads(leads, t))
    pairs = pairs.distinct()
    links = verified(bounded(pairs, nodes, t), docs, nodes, n, t)
    known = materialize(components(links), "components")

    long = found.where("h is not null").select("base", "h", "sig", "n", "pos")
    labelled = long.join(known.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("component", "sig")).drop("component")
    labelled = materialize(labelled, "labelled")
    more = later_pairs(block_groups(labelled), t, max(n_buckets, 4)).distinct().join(pairs, ["a", "b"], "left_anti")
    more = materialize(bounded(more, nodes, t), "more")
    if not more.isEmpty():
        links = links.unionByName(verified(more, docs, nodes, n, t))
        known = materialize(components(links), "components")

    of_node = nodes.select("sig", F.col("row").alias("least")).join(known.withColumnRenamed("node", "sig"), "sig", "left")
    of_node = of_node.withColumn("comp", F.coalesce("component", "sig"))
    first = of_node.groupBy("comp").agg(F.min("least").alias("first"))
    named = of_node.join(first, "comp").select("sig", "first")
    out = base.select("row", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig")).join(named, "sig", "left")
    out = out.select("row", F.col("n").cast("long").alias("n_shingles"), F.coalesce("first", "row").alias("first"))
    # rows ascend with ids, nulls last: the first row of a component has its least id
    if is_id(docs.select("row", "id")):
        return out.select("row", F.col("row").alias("id"), "n_shingles", F.col("first").alias("component_id"), (F.col("first") == F.col("row")).alias("is_first"))
    own = docs.select("row", "id")
    named = out.join(own, "row").join(own.select(F.col("row").alias("first"), F.col("id").alias("component_id")), "first")
    return named.select("row", "id", "n_shingles", "component_id", (F.col("first") == F.col("row")).alias("is_first"))


def keep_first(docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (3, 4), id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, columns unchanged, that are the first of their component."""
    own = numbered(docs, id_col)
    by_row = components_by_row(own.select(F.col(ROW).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col("text").cast("string")), n, threshold)
    gone = materialize(by_row.where(~F.col("is_first")).select(F.col("row").alias(ROW)), "gone")
    return own.join(small_side(gone), ROW, "left_anti").select(docs.columns)
