"""SimHash near-dedup: vantage-point trees over fingerprints, then connected components.

Fingerprints are hashed from whole texts (see ``fingerprint``). Copies collapse first: the trees hold
each distinct fingerprint once.

Search. Two 64-bit fingerprints that differ in at most 3 bits differ in at most 1 bit in one of their
32-bit halves. Each half is a metric space of its own with radius 1, in which a vantage-point tree prunes well (the
share of points within 1 of a boundary is about 0.14 a level; for whole fingerprints with radius 3 it is about 0.3 a side and most
branches stay open). Each half gets a tree: an inner node has a vantage point and a radius; nearer points
go left, the others right, and by the triangle inequality only right points at a distance of radius + 1 can
have a partner on the left, so those alone are also sent there as queries. A leaf is a shard: a group
of one Spark task, which splits further by trees of its own until blocks are small, then compares whole fingerprints exactly.

The upper levels are fitted on a bounded sample (SAMPLE fingerprints, those with the smallest hashes)
by the driver; it only sets where boundaries lie, never which pairs are found.

A shard emits a spanning forest of its links, not every pair, so a dense group of near copies costs one
row per member. Components come from large-star/small-star rounds, checkpointed in the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm._shared import shared_dir, stored

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
SAMPLE = 8192
LEAF = 4096
#: Trees of a million leaves travel as 6 MB each. Beyond LEAF times that many distinct fingerprints (4e9) leaves grow: 5e10 make about 50,000 residents of a leaf.
MOST_DEPTH = 20
BLOCK = 512
_FOLD = bytes(0x20 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """Bit b is 1 if it is set in over half of the XXH64 values of all k-word shingles, repeats included.

    A-Z are lower-cased and words are runs of anything but ASCII white space. Fewer than k words: the
    whole sequence is the only shingle. No words (or null): 0.
    """
    import xxhash

    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= k:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    view = memoryview(joined)
    half = np.zeros(64, np.int64)
    total = n - k + 1
    first, last = starts[:total].tolist(), ends[k - 1 :].tolist()
    for at in range(0, total, 1 << 16):  # bounded memory for very long texts
        h = np.array([digest(view[a:b], SEED) for a, b in zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)])], dtype="<u8")
        half += _bit_counts(h)
    return int(np.packbits((2 * half > total).astype(np.uint8), bitorder="little").view("<u8")[0])


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How often each of 64 bits is set, summed in bytes of up to 255 rows."""
    bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
    full = len(h) // 128 * 128
    out = np.zeros(64, np.int64)
    if full:
        out += np.add.reduce(bits[:full].reshape(-1, 128, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return out + bits[full:].sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS) -> DataFrame:
    """id, h (a hash of the text), fp (bigint, the 64 bits) for every row."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, k) for t in batch.column(2).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["id", "h", "fp"])

    text = F.col(text_col).cast("string")
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return chosen.mapInArrow(run, "id bigint, h bigint, fp bigint")


# ---- vantage-point trees over 32-bit halves


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def fit_tree(sample: np.ndarray, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree (heap order). sample: uint32 halves."""
    rng = np.random.default_rng(seed)
    # A vantage point far from the crowd splits it more evenly than one amid it.
    points, radii = rng.integers(0, 2**32, 2**depth - 1, dtype=np.uint32), np.full(2**depth - 1, 15, np.int16)
    inside = {0: sample}
    while inside:  # nodes that the sample says nothing of keep the middle radius
        node, own = inside.popitem()
        if node < len(points) and len(own) >= 32:
            points[node] ^= own[rng.integers(len(own))]
            d = _popcount(own ^ points[node])
            radii[node] = _even_radius(d)
            left = d <= radii[node]
            inside[2 * node + 1], inside[2 * node + 2] = own[left], own[~left]
    return points, radii


def _even_radius(d: np.ndarray) -> int:
    """The radius that cuts nearest to the middle."""
    counts = np.cumsum(np.bincount(d, minlength=33))
    return int(np.argmin(np.abs(counts - len(d) / 2)))


def route(halves: np.ndarray, points: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, home): each row's own leaf, and the leaves that it must also ask."""
    rows, nodes = np.arange(len(halves)), np.zeros(len(halves), np.int64)
    home = np.ones(len(halves), bool)
    depth = (len(points) + 1).bit_length() - 1
    for _ in range(depth):
        d = _popcount(halves[rows] ^ points[nodes])
        left = d <= radii[nodes]
        asks_left = d == radii[nodes] + 1
        # whoever is a guest here meets residents only, so it must ask on both sides
        asks_right = ~home & (d == radii[nodes])
        rows = np.concatenate([rows, rows[asks_left], rows[asks_right]])
        home = np.concatenate([home, np.zeros(len(rows) - len(home), bool)])
        nodes = np.concatenate([np.where(left, 2 * nodes + 1, 2 * nodes + 2), 2 * nodes[asks_left] + 1, 2 * nodes[asks_right] + 2])
    return rows, nodes - len(points), home


class _Forest:
    """Component labels of positions, and the links that joined two of them."""

    def __init__(self, n: int):
        self.label, self.links = np.arange(n), []

    def join(self, one: int, others: np.ndarray) -> None:
        """Link one with all others; a link inside a component is not kept."""
        own, labels = self.label[one], self.label[others]
        labels, at = np.unique(labels, return_index=True)
        new = labels != own
        if new.any():
            self.links += [(one, int(q)) for q in others[at[new]]]
            self.label[np.isin(self.label, labels[new])] = own


def _compare(fps: np.ndarray, homes: np.ndarray, asks: np.ndarray, bits: int, forest: _Forest) -> None:
    """Exact pairs home-home and ask-home, in blocks."""
    for i in range(0, len(homes), BLOCK):
        a = homes[i : i + BLOCK]
        for others in (homes[i:], asks):
            for j in range(0, len(others), BLOCK * 8):
                b = others[j : j + BLOCK * 8]
                x, y = np.nonzero(np.bitwise_count(fps[a][:, None] ^ fps[b][None, :]) <= bits)
                cuts = np.flatnonzero(np.diff(x, prepend=-1))
                for p, near in zip(x[cuts], np.split(y, cuts[1:]) if len(cuts) else []):
                    if len(near) > 1 or b[near[0]] != a[p]:
                        forest.join(int(a[p]), b[near])


def search_leaf(fps: np.ndarray, half: np.ndarray, homes: np.ndarray, asks: np.ndarray, bits: int, forest: _Forest, rng, tries: int = 0) -> None:
    """Links among homes and between asks and homes; splits by further vantage points while that helps."""
    if not len(homes) or len(homes) + len(asks) < 2:
        return
    if len(homes) <= BLOCK or tries > 24:
        _compare(fps, homes, asks, bits, forest)
        return
    point = rng.integers(0, 2**32, dtype=np.uint32)
    d, e = _popcount(half[homes] ^ point), _popcount(half[asks] ^ point)
    r = _even_radius(d)
    left = d <= r
    if left.all() or not left.any():
        search_leaf(fps, half, homes, asks, bits, forest, rng, tries + 1)
        return
    search_leaf(fps, half, homes[left], np.concatenate([homes[d == r + 1], asks[e <= r + 1]]), bits, forest, rng, tries)
    search_leaf(fps, half, homes[~left], asks[e >= r], bits, forest, rng, tries)


def near_links(distinct: DataFrame, bits: int = MAX_BITS, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """distinct: fp bigint (each once), id. Links (a, b) of ids: a spanning forest per shard; their
    transitive closure is that of all pairs at ``bits`` or fewer."""
    import pandas as pd

    if bits > 3:
        raise ValueError("halves with radius 1 cover up to 3 bits")
    rows = distinct.count()
    depth = max(0, min(MOST_DEPTH, int(np.ceil(np.log2(max(1, rows / leaf))))))
    picked = np.array([r[0] for r in distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()], np.int64).view(np.uint64)
    shift = (0, 32)
    trees = [fit_tree((picked >> np.uint64(s)).astype(np.uint32), depth, s + 1) for s in shift]

    def send(frames):
        for f in frames:
            fps = f["fp"].to_numpy(np.int64)
            for band, s in enumerate(shift):
                at, where, home = route((fps.view(np.uint64) >> np.uint64(s)).astype(np.uint32), *trees[band])
                yield pd.DataFrame({"shard": where + band * (1 << depth), "band": band, "fp": fps[at], "id": f["id"].to_numpy()[at], "home": home})

    def search(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["home", "fp"], ascending=[False, True])
        fps = f["fp"].to_numpy(np.int64).view(np.uint64)
        half = (fps >> np.uint64(shift[int(f["band"].iloc[0])])).astype(np.uint32)
        n, forest = int(f["home"].sum()), _Forest(len(f))
        search_leaf(fps, half, np.arange(n), np.arange(n, len(f)), bits, forest, np.random.default_rng(7))
        ids = f["id"].to_numpy()
        a = np.array(forest.links, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": ids[a[:, 0]], "b": ids[a[:, 1]]})

    sent = distinct.select("fp", "id").mapInPandas(send, "shard bigint, band int, fp bigint, id bigint, home boolean")
    return sent.groupBy("shard").applyInPandas(search, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b): component is the smallest id reachable.

    Large-star and small-star rounds; each halves the longest chains, and a hub's neighbours never meet
    in one task: the smallest neighbour is an aggregate, joined back.
    """
    spark = links.sparkSession
    shared_dir(spark)

    def measure(e: DataFrame):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = measure(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = small.select("e.*").filter(F.col("a") != F.col("b")).distinct().checkpoint()
        after = measure(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def _fingerprinted(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """id, h (a hash of the text, which with the id tells rows apart), fp; written once."""
    return stored(fingerprints(docs, id_col, text_col, k), "simhash")


def _labelled(fps: DataFrame, bits: int) -> DataFrame:
    """fps with component_id. Every distinct fingerprint is a node, rows with a null id or not, so that any can link others; a component's name is then its smallest id."""
    distinct = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    found = components(near_links(distinct.select("fp", F.col("fp").alias("id")), bits))
    named = distinct.join(found, distinct["fp"] == found["id"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return fps.join(named.join(names, "component").select("fp", "component_id"), "fp", "left")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint 0 and link like any other. Rows with a null id get a
    fingerprint, link others, and have the component of the rows with ids that they reach (null if there are none). Repeated
    rows stay repeated. An empty table gives an empty result. Other columns are ignored.
    """
    return _labelled(_fingerprinted(docs, id_col, text_col, k), bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """docs, all columns, without the rows whose component has a smaller id.

    The verdict is a row's, by id and text: of two rows with one id and different texts each goes or stays with its own component. Rows of a component
    that share its smallest id all stay. Rows with a null id are never dropped.
    """
    labelled = _labelled(_fingerprinted(docs, id_col, text_col, k), bits)
    gone = labelled.filter("id <> component_id").select(F.col("id").alias("gone_id"), F.col("h").alias("gone_h")).distinct()
    same = (docs[id_col].cast("long") == gone["gone_id"]) & (F.xxhash64(docs[text_col].cast("string")) == gone["gone_h"])
    return docs.join(gone, same, "left_anti")
