"""SimHash near-duplicates: tiled exact comparison of fingerprints with exclusive-or and bit counts."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dealt_anew, parallelism, released, slices
from .components import connected

SHINGLE, RADIUS, SEED = 4, 4, 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mixed(h: np.ndarray) -> np.ndarray:
    """A second hash of each 64-bit hash (the finaliser of splitmix64)."""
    h = h + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _shingles(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 hashes of the text's word shingles, in their order, at most 65536 at once; a text of fewer words is one shingle."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return
    joined, size = memoryview(b" ".join(words)), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1].tolist()
    digest, ends = xxhash.xxh64_intdigest, ends[size - 1 :].tolist()
    for k in range(0, len(starts), 65536):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + 65536], ends[k : k + 65536])], np.uint64)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct hashes of the text's word shingles, in ascending order."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *_shingles(text, shingle)]))


def _votes(hashes: Iterable[np.ndarray], parts: int) -> np.ndarray:
    counts, n = np.zeros((parts, 64), np.int64), 0
    for h in hashes:
        n += len(h)
        for p in range(parts):
            h = _mixed(h) if p else h
            counts[p] += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.uint32)
    return np.packbits(2 * counts > n).view(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE, parts: int = 1) -> np.ndarray:
    """64 bits for each part, signed: a bit is set if it is set in over half of the hashes of the text's word shingles.

    The first part takes XXH64 hashes, each further one hashes of the hashes before it.
    """
    return _votes(_shingles(text, shingle), parts)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, parts: int = 1) -> DataFrame:
    """(doc_id, fp, more) of every row: the first part, and an array of the further ones; a text without words has zeros.

    Null texts are empty ones; null and repeated ids pass through; a text of any length is hashed whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = np.array([fingerprint(x.as_py(), shingle, parts) for x in b["text"]], np.int64).reshape(-1, parts)
            more = pa.ListArray.from_arrays(pa.array(np.arange(len(fp) + 1, dtype=np.int32) * (parts - 1)), pa.array(fp[:, 1:].ravel()))
            yield pa.record_batch({"doc_id": b["doc_id"], "fp": pa.array(fp[:, 0].copy()), "more": more})

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, fp long, more array<long>")


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; a parent is never larger than its child."""
    while len(a):
        while not np.array_equal(up := parent[a], a):
            a = up
        while not np.array_equal(up := parent[b], b):
            b = up
        apart = a != b
        a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        parent[b] = a


def forest(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS, block: int = 256, whole: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (places in left, then right) of a spanning forest over all near pairs of two tiles, or within one.

    Tiles are arrays of unsigned 64-bit parts, one row for each fingerprint. A pair is near if the first parts differ by
    radius bits at most and, where `whole` is given, all parts together by that many. Tiles are cut into blocks by the
    bit count of the upper half of the first part; blocks whose counts differ by over the radius are skipped. The
    pairs of a block go into a union-find at once, so that a tile pair gives at most one link for each fingerprint,
    however many pairs are near.
    """
    upper = lambda x: np.bitwise_count(x[:, 0] >> np.uint64(32)).astype(np.int64)
    at_left = np.argsort(upper(left), kind="stable")
    at_right = at_left if right is None else np.argsort(upper(right), kind="stable")
    a, b = left[at_left], (left if right is None else right)[at_right]
    shift = 0 if right is None else len(left)
    high_a, high_b = upper(a), upper(b)
    first = b[:, 0].copy()
    parent = np.arange(shift + len(b))
    for k in range(0, len(a), block):
        rows = a[k : k + block, 0]
        lo = np.searchsorted(high_b, high_a[k] - radius)
        hi = np.searchsorted(high_b, high_a[min(k + block, len(a)) - 1] + radius, "right")
        lo = max(lo, k) if right is None else lo
        for c in range(lo, hi, 8192):
            i, j = np.nonzero(np.bitwise_count(rows[:, None] ^ first[None, c : min(hi, c + 8192)]) <= radius)
            if whole is not None and len(i):
                apart = np.bitwise_count(a[i + k] ^ b[j + c]).sum(1, dtype=np.int64)
                i, j = i[apart <= whole], j[apart <= whole]
            if len(i):
                _unite(parent, i + k, j + c + shift)
    while not np.array_equal(parent, parent[parent]):
        parent = parent[parent]
    child = np.nonzero(parent != np.arange(len(parent)))[0]
    names = at_left if right is None else np.concatenate([at_left, at_right + shift])
    return names[parent[child]], names[child]


def near_links(groups: DataFrame, radius: int = RADIUS, tile: int = 16384, whole: int | None = None, level: Column | None = None, reach: int | None = None) -> DataFrame:
    """Links (u, v) of nodes that connect the distinct fingerprints of groups(node, fp, more) just as all near pairs do.

    Fingerprints are dealt by hash into tiles of about `tile`, each of one level: the bit count, or another whole number
    of which no near pair's differ by over `reach`. Only tiles whose levels do not are paired, as a join of tile keys;
    each pair of tiles is one row of a mapInArrow. A count for each level comes to the driver.
    """
    level, reach = (F.bit_count("fp"), radius) if level is None else (level, reach)
    levelled = checkpointed(groups.select("node", "fp", "more", level.cast("int").alias("p")))
    sizes = {r[0]: r[1] for r in levelled.groupBy("p").count().collect()}
    last = max(sizes, default=0)
    chunks = [-(-sizes.get(p, 0) // tile) for p in range(last + 1)]
    n_chunks = lambda p: F.element_at(F.array(*map(F.lit, chunks)), F.col(p) + 1)
    tiles = checkpointed(
        levelled.withColumn("c", F.pmod(F.xxhash64("fp", "node"), n_chunks("p")).cast("int"))
        .groupBy("p", "c").agg(F.collect_list(F.struct("node", F.array_prepend("more", F.col("fp")).alias("parts"))).alias("tile"))
    )
    partner = F.explode(F.sequence("p", F.least(F.lit(last), F.col("p") + reach))).alias("q")
    pairs = tiles.select("p", "c", partner).withColumn("n", n_chunks("q"))
    pairs = pairs.where("n > 0").withColumn("d", F.explode(F.expr("sequence(0, n - 1)"))).where("q > p or d >= c").select("p", "c", "q", "d")
    n_pairs = sum(chunks[p] * chunks[q] if q > p else chunks[p] * (chunks[p] + 1) // 2 for p in range(last + 1) for q in range(p, min(last, p + reach) + 1))
    other = tiles.select(F.col("p").alias("q"), F.col("c").alias("d"), F.col("tile").alias("other"))
    met = pairs.join(tiles, ["p", "c"]).join(other, ["q", "d"])
    met = met.select(F.expr("p = q and c = d").alias("own"), "tile", "other").repartition(max(parallelism(groups), n_pairs // 32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                x, y = (b[c][k].values for c in ("tile", "other"))
                own = b["own"][k].as_py()
                x, y = ((z.field("node").to_numpy(), z.field("parts").flatten().to_numpy().view(np.uint64).reshape(len(z), -1)) for z in (x, y))
                nodes = x[0] if own else np.concatenate([x[0], y[0]])
                u, v = forest(x[1], None if own else y[1], radius, whole=whole)
                yield pa.record_batch({"u": pa.array(nodes[u]), "v": pa.array(nodes[v])})

    return met.mapInArrow(run, "u long, v long")


def by_root(rooted: DataFrame) -> DataFrame:
    """(fp, component_id) of rooted(fp, first_id, root): the smallest first_id of each root."""
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(dealt_anew(smallest, "root"), "root").select("fp", "component_id")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tile: int = 16384) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id that is reachable over links of at most `radius` bits, itself included.

    Null and empty texts have fingerprint 0 and are linked like any other. A null doc_id takes part and counts only if the
    group has no other id (component_id null). Repeated rows give a row each. An empty table gives no rows. Other
    columns are ignored.
    """
    fps = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    groups = checkpointed(fps.groupBy("fp", "more").agg(F.min("doc_id").alias("first_id")))
    roots = connected(near_links(groups.withColumn("node", F.col("fp")), radius, tile))
    rooted = groups.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    rooted = rooted.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    by_fp = by_root(rooted)
    return fps.join(dealt_anew(by_fp, "fp"), "fp").select("doc_id", "fp", "component_id")


#: For similarity: parts of a fingerprint, and the bits by which the first part and all parts may differ. Two texts
#: that share 8 of 10 distinct shingles differ in 15 % of the bits on average, unrelated ones in half. The radii are wide:
#: they only find candidates, which shingles confirm. CHUNK texts at most are compared with one another or with as many at once.
PARTS, FIRST_RADIUS, WHOLE_RADIUS, CHUNK = 4, 20, 64, 128
#: Texts with Jaccard 0.8 have sizes in a ratio of 1.25 at most: so many levels of the size make one such ratio. One more level
#: is compared for the sake of rounded logarithms.
LEVELS, SIMILAR_TILE = 4, 65536


def set_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, parts: int) -> DataFrame:
    """(doc_id, fp, more, size) of every row: the fingerprint of a text's distinct shingles, each counted once, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp, size = np.zeros((b.num_rows, parts), np.int64), np.zeros(b.num_rows, np.int64)
            for k, x in enumerate(b["text"]):
                own = shingle_set(x.as_py(), shingle)
                fp[k], size[k] = _votes([own], parts), len(own)
            more = pa.ListArray.from_arrays(pa.array(np.arange(len(fp) + 1, dtype=np.int32) * (parts - 1)), pa.array(fp[:, 1:].ravel()))
            yield pa.record_batch({"doc_id": b["doc_id"], "fp": pa.array(fp[:, 0].copy()), "more": more, "size": pa.array(size)})

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return kept.mapInArrow(run, "doc_id long, fp long, more array<long>, size long")


def confirmed(texts: list[tuple[int, int, bool, set]], own: bool) -> list[tuple[int, int]]:
    """Links of a spanning forest over groups, from the pairs of (node, group, side, shingles) with Jaccard 0.8 or more.

    Nodes of one group are linked already. Unless `own`, only texts of different sides are compared.
    """
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    links = []
    texts = sorted(texts, key=lambda x: len(x[3]))
    low = 0
    for k, (_, g, side, a) in enumerate(texts):
        while 5 * len(texts[low][3]) < 4 * len(a):
            low += 1
        for _, h, other, b in texts[low:k]:
            if (own or side != other) and root(g) != root(h) and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                links.append((g, h))
                g, h = root(g), root(h)
                up[max(g, h)] = min(g, h)
    return links


def _confirmed(jobs: DataFrame, labels: bool) -> DataFrame:
    """confirmed() for each (root, lo, hi) of jobs(root, lo, hi, node, t, side, shingles): links (u, v) of groups t.

    With labels, each node (u) with the smallest group (v) that it is linked to, its own one included. Each job is dealt for itself,
    even where jobs comes from a join by root, whose partitioning would bring all jobs of a root into one task.
    """
    met = dealt_anew(jobs, "root").groupBy("root", "lo", "hi").agg(F.collect_set(F.struct("node", "t", "side", "shingles")).alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for texts, own in zip(b["texts"], b["own"].to_pylist()):
                x = texts.values
                sets = [set(s.values.to_numpy().tolist()) for s in x.field("shingles")]
                nodes, groups, sides = (x.field(c).to_pylist() for c in ("node", "t", "side"))
                links = confirmed(list(zip(nodes, groups, sides, sets)), own)
                if labels:
                    at = {t: k for k, t in enumerate(sorted(set(groups)))}
                    parent = np.arange(len(at))
                    _unite(parent, *(np.array([at[t] for t in side], np.int64) for side in (zip(*links) if links else ((), ()))))
                    while not np.array_equal(parent, parent[parent]):
                        parent = parent[parent]
                    names = sorted(at)
                    links = [(node, names[parent[at[t]]]) for node, t in zip(nodes, groups)]
                out += links
            yield pa.record_batch({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})

    return met.select(F.expr("lo = hi").alias("own"), "texts").mapInArrow(run, "u long, v long")


def _dealt(texts: DataFrame, k: Column) -> DataFrame:
    """Jobs that compare the texts of each chunk, of k in a root, with one another."""
    return texts.withColumn("lo", F.pmod(F.xxhash64("node"), k).cast("int")).withColumn("hi", F.col("lo")).withColumn("side", F.lit(True))


def similar_groups(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, shingle: int, chunk: int = CHUNK) -> DataFrame:
    """(node, t) of members(node, root): the smallest node that all pairs in a root with Jaccard 0.8 or more link it to.

    Three rounds: the texts of a root are cut into chunks by hash, and each chunk is compared within; then one text of each
    group that this gave; at last all texts outside the largest group with all of the root. The pairs that no
    round compares are in one group already. Roots of one chunk are done by the first round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = [shingle_set(x.as_py(), shingle).view(np.int64) for x in b["text"]]
            at = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            shingles = pa.ListArray.from_arrays(at, pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
            yield pa.record_batch({"node": b["node"], "root": b["root"], "n": b["n"], "shingles": shingles})

    n = F.count("*").alias("n")
    many = members.groupBy("root").agg(n).where(F.col("n") > chunk)
    sized = members.join(many, "root", "left").select("node", "root", F.coalesce("n", F.lit(1)).alias("n"))
    kept = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    texts = checkpointed(kept.join(sized, "node").mapInArrow(run, "node long, root long, n long, shingles array<long>"))
    chunks = lambda size: F.ceil(size / F.lit(chunk))
    node_t = lambda df, node, t: df.select(F.col("u").alias(node), F.col("v").alias(t)).distinct()
    first = checkpointed(node_t(_confirmed(_dealt(texts.withColumn("t", F.col("node")), chunks(F.col("n"))), True), "node", "t"))
    texts = texts.where(F.col("n") > chunk)
    released(docs.sparkSession)
    if texts.isEmpty():
        return first
    reps = texts.drop("n").join(first.where("t = node").select("node"), "node").withColumn("t", F.col("node"))
    reps = reps.join(dealt_anew(reps.groupBy("root").agg(n), "root").hint("merge"), "root")
    second = checkpointed(node_t(_confirmed(_dealt(reps, chunks(F.col("n"))), True), "t", "t2"))
    now = texts.drop("n").join(first, "node").join(second, "t").select("root", "node", F.col("t2").alias("t"), "shingles")
    now = checkpointed(now)
    released(docs.sparkSession)
    sizes = now.groupBy("root", "t").agg(n).groupBy("root").agg(F.sum("n").alias("n"), F.max(F.struct("n", "t")).alias("most"))
    sizes = sizes.select("root", F.col("most.t").alias("largest"), chunks(F.col("n") - F.col("most.n")).alias("kr"), chunks(F.col("most.n")).alias("kb"))
    rest = F.col("t") != F.col("largest")
    at = F.when(rest, F.pmod(F.xxhash64("node"), F.col("kr"))).otherwise(F.col("kr") + F.pmod(F.xxhash64("node"), F.col("kb")))
    open_ = now.join(dealt_anew(sizes.where("kr > 0"), "root").hint("merge"), "root").withColumn("c", at.cast("int"))
    last = F.when(rest, F.col("kr") + F.col("kb")).otherwise(F.col("kr")) - 1
    jobs = open_.withColumn("d", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    jobs = jobs.select("root", F.least("c", "d").alias("lo"), F.greatest("c", "d").alias("hi"), "node", "t", F.expr("c <= d").alias("side"), "shingles")
    third = node_t(connected(_confirmed(jobs, False)), "t2", "t3")
    by_t = second.join(third, "t2", "left").select("t", F.coalesce("t3", "t2").alias("t2"))
    return first.join(by_t, "t", "left").select("node", F.coalesce("t2", "t").alias("t"))


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, tile: int = SIMILAR_TILE, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, component_id) of every row with an id: groups over links of texts whose sets of word shingles have Jaccard 0.8 or more.

    Fingerprints have four parts, so that the share of differing bits tells the similarity to a few hundredths: the
    first part is compared between all tiles of sizes that can be similar, the others where it is near. The groups that this gives
    are then compared by their shingles. Texts without words are one group. Rows with a null id are left out, rows of one
    id each have one; a text of any length is taken whole, other columns are ignored, an empty table gives no rows.
    """
    fps = checkpointed(set_fingerprints(docs.where(F.col(id_col).isNotNull()), id_col, text_col, shingle, PARTS))
    groups = checkpointed(fps.groupBy("fp", "more", "size").agg(F.min("doc_id").alias("node")))
    level = F.floor(LEVELS * F.ln(F.greatest("size", F.lit(1))) / math.log(1.25))
    near = connected(near_links(groups, FIRST_RADIUS, tile, WHOLE_RADIUS, level, LEVELS + 1)).select(F.col("u").alias("node"), F.col("v").alias("root"))
    members = checkpointed(near.unionByName(near.select(F.col("root").alias("node"), "root").distinct()))
    rooted = groups.join(similar_groups(docs, members, id_col, text_col, shingle, chunk), "node", "left")
    rooted = rooted.select("fp", "more", "size", F.coalesce("t", "node").alias("component_id"))
    return fps.join(dealt_anew(rooted, "fp"), ["fp", "more", "size"]).select("doc_id", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """`docs` with the smallest doc_id of each group of similar texts, so that no group has a tie.

    Rows of one id stay or go together; those with a null id stay. Null, empty and blank texts are copies of one another. A text
    of any length is taken whole; columns of any name stay as they are; an empty table stays empty.
    """
    goes = similar(docs, id_col, text_col, shingle).where("component_id < doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(goes, id_col, "left_anti").select(*docs.columns)
