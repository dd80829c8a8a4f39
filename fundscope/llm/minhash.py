"""MinHash near-dedup with DartMinHash sketches.

An element (word shingle) of weight x owns the region [0, x) on a weight axis; over it a
hashed Poisson process throws darts along a rank axis. The weight axis is cut into cells
[0, 1), [1, 2), [2, 4), ... and the darts of a cell follow from the element, the cell and
the dart's number alone, so any two documents see the same darts wherever their regions
overlap. A document takes the darts of rank at most T / (its weight); about
T = k (ln k + 3) darts whatever its length. Each dart names one of k coordinates, and each
coordinate keeps its earliest dart: two documents agree on a coordinate with probability
equal to their weighted Jaccard similarity.

Documents are joined on bands of coordinates. Equal texts are one node first. The least
member of a bucket is its leader. Each text is checked, exactly on whole shingle sets, with
the leader it shares most bands with, then with its other leaders where links have not
joined the two already. Texts of buckets that still hold several components are then
compared completely between components, behind exact filters on sizes and parity bitmaps,
so no candidate link between different texts is lost, while groups of copies cost no pairs.

With weights ``set`` (used by the query and the pipeline) every shingle weighs 1 and the
similarity is the Jaccard similarity of shingle sets; with ``count`` it is weighted by the
number of times a shingle occurs.

Cases: null is the empty text. Texts without words match equal texts only. Texts of one to
four words have one shingle, all their words. Ties keep the least id (null ids last). An
empty table gives an empty result. Repeated rows are copies. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscope.llm.common import discard, fresh, key_pair, salted_join, stored
from fundscope.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 40, 7           # a pair of similarity 0.8 shares a band with probability 0.9999
PARITY_BITS = 2048
PAIRS_PER_BLOCK = 64
TOGETHER = 128                # documents sketched by one set of array operations
CACHE_ENTRIES = 200_000
U = np.uint64
GOLD = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (xor-shift and multiply, twice)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _step(number: int) -> np.uint64:
    return U(number * int(GOLD) % (1 << 64))


_WORDS: dict[str, int] = {}                                # of this Python worker (time only)


def _word_hash(word: str) -> int:
    if len(_WORDS) >= CACHE_ENTRIES:
        _WORDS.clear()
    return _WORDS.setdefault(word, xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit hashes of the 5-word shingles of a whole text, and their counts."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    get = _WORDS.get
    h = np.fromiter((get(w) or _word_hash(w) for w in words), np.uint64, len(words))
    size = min(WORDS, len(words))
    key = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        key = (key ^ h[i: len(words) - size + 1 + i]) * GOLD
        key ^= key >> U(29)
    return np.unique(mix(key), return_counts=True)


def _cells(elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Cells of the weight axis under each element: owner, seed, start, width."""
    owner, seed, start, width = [], [], [], []
    alive, low, high, number = np.arange(len(elements)), 0.0, 1.0, 0
    while len(alive):
        owner.append(alive)
        seed.append(mix(elements[alive] + _step(number)))
        start.append(np.full(len(alive), low))
        width.append(np.full(len(alive), high - low))
        alive = alive[weights[alive] > high]
        low, high, number = high, 2 * high, number + 1
    return tuple(np.concatenate(x) for x in (owner, seed, start, width))


def dart_signatures(elements: list[np.ndarray], weights: list[np.ndarray], k: int) -> np.ndarray:
    """Signatures (documents x k) of weighted sets; every set must be non-empty."""
    total = np.array([w.sum() for w in weights], float)
    out = np.empty((len(elements), k), np.uint64)
    todo, reach = np.arange(len(elements)), k * (np.log(k) + 3)
    while len(todo):
        doc = np.repeat(np.arange(len(todo)), [len(elements[i]) for i in todo])
        x = np.concatenate([weights[i] for i in todo]).astype(float)
        owner, seed, start, width = _cells(np.concatenate([elements[i] for i in todo]), x)
        whole = bool((x[owner] >= start + width).all())
        limit = (reach / total[todo])[doc[owner]]
        best = np.full(len(todo) * k, np.iinfo(np.uint64).max, np.uint64)
        rank, number = np.zeros(len(owner)), 0
        row = doc[owner] * k
        top = x[owner]
        while len(seed):                                   # the next dart of every cell
            number += 1
            h = mix(seed + _step(number))
            rank = rank - np.log1p(-(h >> U(11)).astype(float) * 2.0**-53) / width
            near = rank <= limit
            seed, rank, limit, row, width, top, start, h = (
                a[near] for a in (seed, rank, limit, row, width, top, start, h))
            other = mix(h ^ GOLD)
            dart = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << U(32)) | (
                other & U(0xFFFFFFFF))
            at = row + ((other >> U(32)) % U(k)).astype(np.int64)
            if not whole:
                inside = start + (mix(other) >> U(11)).astype(float) * 2.0**-53 * width < top
                at, dart = at[inside], dart[inside]
            np.minimum.at(best, at, dart)
        best = best.reshape(len(todo), k)
        full = (best != np.iinfo(np.uint64).max).all(1)
        out[todo[full]] = best[full]
        todo, reach = todo[~full], 2 * reach               # an empty coordinate: look further
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band (the band's number is part of it)."""
    parts = signatures.reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLD, parts.shape[:2])
    for i in range(rows):
        key = mix((key ^ parts[:, :, i]) * GOLD)
    return key


def _sketcher(bands: int, rows: int, weighting: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            sizes = np.array([len(s) for s, _ in sets])
            keys: list[np.ndarray | None] = [None] * len(sets)
            order = np.argsort(sizes, kind="stable")
            order = order[sizes[order] > 0]
            for i in range(0, len(order), TOGETHER):
                part = order[i: i + TOGETHER]
                weights = [np.ones(sizes[j]) if weighting == "set" else sets[j][1] for j in part]
                found = band_keys(dart_signatures([sets[j][0] for j in part], weights,
                                                  bands * rows), bands, rows)
                for j, row in zip(part, found, strict=True):
                    keys[j] = row.view(np.int64)
            mass = [int(c.sum() if weighting == "count" else len(s)) for s, c in sets]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(mass, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], [*names, "mass", "bands"])
    return run


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS,
             rows: int = ROWS, weighting: str = "set") -> DataFrame:
    """``doc_id, k1, k2, mass, bands`` of every row; (k1, k2) is the text's 128-bit hash."""
    if weighting not in ("set", "count"):
        raise ValueError("weighting is 'set' or 'count'")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows_in = docs.select(F.col(id_col).alias("doc_id"), *key_pair(text), text.alias("text"))
    id_type = rows_in.schema["doc_id"].dataType.simpleString()
    return rows_in.mapInArrow(_sketcher(bands, rows, weighting),
                              f"doc_id {id_type}, k1 long, k2 long, mass long, bands array<long>")


def parity_bits(elements: np.ndarray, counts: np.ndarray, weighting: str) -> np.ndarray:
    """Parity of the number of elements that hash to each of ``PARITY_BITS`` bits.

    By counts, every further copy of a shingle is an element of its own.
    """
    if weighting == "count":
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        elements = mix(np.repeat(elements, counts) + nth.astype(np.uint64) * GOLD)
    odd = np.bincount((elements % U(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _shingle_rows(weighting: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"),
                 pa.array([s.view(np.int64) for s, _ in sets], pa.list_(pa.int64())),
                 pa.array([c.astype(np.int32) if weighting == "count" else [] for _, c in sets],
                          pa.list_(pa.int32())),
                 pa.array([parity_bits(s, c, weighting) for s, c in sets], pa.list_(pa.int64()))],
                ["node", "shingles", "counts", "parity"])
    return run


def _similar(pairs: DataFrame, sets: DataFrame, weighting: str) -> DataFrame:
    """``a, b, similarity`` of each pair, from whole shingle sets."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"),
                      F.col("counts").alias("ca"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"),
                      F.col("counts").alias("cb"))
    # b is a leader and may be hot: its set is repeated once per block of its pairs
    asked = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    dealt = salted_join(pairs, asked, ["b"], F.col("a")).select(
        "a", "b", F.pmod(F.hash("a"), F.ceil(F.col("n") / PAIRS_PER_BLOCK)).alias("block"))
    two = dealt.select("b", "block").distinct().join(two, "b")
    both = dealt.join(one, "a").join(two, ["b", "block"])
    if weighting == "set":
        common = F.size(F.array_intersect("sa", "sb")).cast("double")
        whole = F.size("sa") + F.size("sb") - common
    else:
        map_b = F.map_from_arrays("sb", "cb")
        other = lambda x: F.coalesce(F.try_element_at(map_b, x["sa"]), F.lit(0))
        common = F.aggregate(F.arrays_zip("sa", "ca"), F.lit(0.0),
                             lambda acc, x: acc + F.least(x["ca"], other(x)))
        total = [F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x) for c in ("ca", "cb")]
        whole = total[0] + total[1] - common
    return both.select("a", "b", (common / whole).alias("similarity"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
                    weighting: str = "set") -> DataFrame:
    """``doc_id, k1, k2, class_id, first_id, first_k1, first_k2`` of every row.

    ``class_id`` is the least id of the class; the ``first_`` columns name the text (by id
    and hash) that stands for it.
    """
    table = stored(sketches(docs, id_col, text_col, bands, rows, weighting), "sketches")
    nodes = stored(table.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("least_id"), F.first("mass").alias("mass"),
        F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")   # numbered once, as written
    buckets = nodes.select("node", "mass", F.explode("bands").alias("key"))
    leaders = (buckets.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n"))
               .where("n > 1").drop("n"))
    shared = stored(salted_join(buckets, leaders, ["key"], F.col("node")), "buckets")
    # similar texts have similar masses: similarity s needs a ratio of s at least
    mass = nodes.select(F.col("node").alias("leader"), F.col("mass").alias("leader_mass"))
    pairs = (shared.where("node <> leader").groupBy("node", "leader", "mass")
             .agg(F.count(F.lit(1)).alias("bands")))
    pairs = stored(salted_join(pairs, mass, ["leader"], F.col("node"))
                   .where(F.least("mass", "leader_mass")
                          >= similarity * F.greatest("mass", "leader_mass"))
                   .select(F.col("node").alias("a"), F.col("leader").alias("b"), "bands"), "pairs")
    involved = shared.select("node").distinct()
    text = F.coalesce(F.col(text_col), F.lit(""))
    wanted = (nodes.join(involved, "node")
              .select("node", "k1", "k2", "least_id").hint("shuffle_hash"))
    texts = docs.select(F.col(id_col).alias("least_id"), *key_pair(text), text.alias("text"))
    sets = stored(texts.join(wanted, (texts.k1 == wanted.k1) & (texts.k2 == wanted.k2)
                             & texts.least_id.eqNullSafe(wanted.least_id))
                  .select("node", "text")
                  .mapInArrow(_shingle_rows(weighting), "node long, shingles array<long>, "
                              "counts array<int>, parity array<long>")
                  .dropDuplicates(["node"]), "shingles")
    # first each text with the leader it shares most bands with, one pair a text
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("bands", -F.col("b"))).alias("b"))
    first_checked = stored(_similar(best, sets, weighting), "checked")
    links = first_checked.where(F.col("similarity") >= similarity).select("a", "b")
    comps = components(links)
    # then with its other leaders, as far as they are not joined yet
    others = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    then_checked = stored(_similar(_apart(others, comps), sets, weighting), "checked")
    links = (first_checked.unionByName(then_checked)
             .where(F.col("similarity") >= similarity).select("a", "b"))
    comps = components(links)
    # then whatever shares a bucket with another component
    rest = _unresolved(shared, comps, sets, similarity)
    found = _similar(rest, sets, weighting).where(F.col("similarity") >= similarity)
    found = stored(found.select("a", "b"), "late-links")
    if found.limit(1).count():
        comps = components(links.unionByName(found))
    discard(shared, pairs, sets, first_checked, then_checked, rest, found)
    classed = (nodes.join(comps, "node", "left")
               .select("k1", "k2", "least_id", F.coalesce("comp", "node").alias("comp")))
    first = F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "k1", "k2"))
    heads = classed.groupBy("comp").agg(first.alias("first"))
    named = (salted_join(classed, heads, ["comp"], F.col("k1"))
             .select("k1", "k2", F.col("first.least_id").alias("class_id"),
                     F.col("first.least_id").alias("first_id"),
                     F.col("first.k1").alias("first_k1"), F.col("first.k2").alias("first_k2")))
    return salted_join(table.select("doc_id", "k1", "k2"), named, ["k1", "k2"],
                       F.hash("doc_id"))


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    ca = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    cb = comps.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    both = salted_join(pairs.join(ca, "a", "left"), cb, ["b"], F.col("a"), "left")
    return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _unresolved(shared: DataFrame, comps: DataFrame, sets: DataFrame,
                similarity: float) -> DataFrame:
    """Pairs between components that share a bucket and pass two exact filters, stored.

    The masses of similar sets have a ratio of ``similarity`` at least; and their symmetric
    difference, at most (1 - s) / (1 + s) of the summed masses, is at least the number of
    parity bits in which they differ.
    """
    rows = (shared.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    mixed = (rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo <> hi").select("key"))
    rows = stored(salted_join(rows, mixed, ["key"], F.col("node"))
                  .join(sets.select("node", "parity"), "node"), "mixed-buckets")
    salts = 8
    left = rows.select("key", F.col("node").alias("a"), F.col("mass").alias("ma"),
                       F.col("comp").alias("ca"), F.col("parity").alias("pa"),
                       F.pmod(F.hash("node"), F.lit(salts)).alias("salt"))
    right = rows.select("key", F.col("node").alias("b"), F.col("mass").alias("mb"),
                        F.col("comp").alias("cb"), F.col("parity").alias("pb"),
                        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                         F.lit(0), lambda acc, n: acc + n)
    most = (1 - similarity) / (1 + similarity) * (F.col("ma") + F.col("mb")) + 1e-6
    out = stored(left.join(right, ["key", "salt"])
                 .where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
                        & (F.least("ma", "mb") >= similarity * F.greatest("ma", "mb"))
                        & (differ <= most))
                 .select("a", "b").distinct(), "rest")
    discard(rows)
    return out


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one document of each class, its least id."""
    classes = near_duplicates(docs, id_col, text_col, **options)
    heads = classes.select("first_id", "first_k1", "first_k2").distinct()
    names = [fresh(docs, n) for n in ("near_k1", "near_k2", "near_id")]
    heads = heads.select(F.col("first_k1").alias(names[0]), F.col("first_k2").alias(names[1]),
                         F.col("first_id").alias(names[2]))
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2 = key_pair(text)
    keyed = docs.withColumns({names[0]: k1, names[1]: k2})
    same = ((keyed[names[0]] == heads[names[0]]) & (keyed[names[1]] == heads[names[1]])
            & keyed[id_col].eqNullSafe(heads[names[2]]))
    return (keyed.join(heads.hint("shuffle_hash"), same, "left_semi")
            .dropDuplicates([names[0], names[1], id_col]).drop(*names[:2]))
