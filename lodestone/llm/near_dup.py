"""Near-duplicate classes by BagMinHash signatures of word shingles, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.exact_dedup import ROW, held_rows
from lodestone.llm.shared import discard, masked_salts, salt_masks, salt_of, set_aside, staged
from lodestone.llm.tokens import Tokens, mixed, run_hashes, text_runs

WORDS = 5
BANDS, PER_BAND = 26, 5
SLOTS = BANDS * PER_BAND
#: Up to so many row numbers (8 bytes each) are broadcast to pick texts; beyond, the texts are shuffled instead.
BROADCAST_ROWS = 2_000_000
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(t: Tokens, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and 64-bit hash of every shingle of five words; a shorter text that has words is one shingle."""
    h, doc = t.lower_hash, t.doc
    counts = np.bincount(doc, minlength=n_docs)
    if len(h) >= WORDS:
        last = len(h) - WORDS + 1
        out = np.zeros(last, dtype=np.uint64)
        for k in range(WORDS):
            out = (out ^ h[k : k + last]) * _K[0]
            out ^= out >> np.uint64(31)
        same = doc[:last] == doc[WORDS - 1 :]
        docs, hashes = doc[:last][same], mixed(out[same])
    else:
        docs, hashes = doc[:0], h[:0]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        starts = np.searchsorted(doc, short, "left")
        docs = np.concatenate([docs, short.astype(docs.dtype)])
        hashes = np.concatenate([hashes, run_hashes(h, starts, starts + counts[short])])
    return docs, hashes


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """BagMinHash: SLOTS minima a document, equal in a slot for two documents with probability their weighted Jaccard.

    A weight's range is cut hierarchically into [0,1), [1,2), [2,4), [4,8)...
    Each part of an element is a Poisson process in time whose rate is the
    part's length; a point falls on a slot and on a place of the part, and
    counts where the place is under the weight. A slot keeps its first point.
    Processes run only up to a time by which all slots are likely filled;
    documents for which that fails run on to twice that time.
    """
    items, lows, highs = [], [], []
    level = 0
    while True:
        low, high = (0, 1) if level == 0 else (2 ** (level - 1), 2**level)
        take = np.flatnonzero(weight > low)
        if not len(take):
            break
        items.append(np.stack([take, np.full(len(take), level)]))
        lows.append(np.full(len(take), low))
        highs.append(np.full(len(take), high))
        level += 1
    out = np.full(n_docs * SLOTS, np.inf)
    if not items:
        return out.reshape(n_docs, SLOTS)
    at, lev = np.concatenate(items, axis=1)
    low, high = np.concatenate(lows), np.concatenate(highs)
    seed = mixed(element[at] + lev.astype(np.uint64) * _K[2])
    owner, rate = doc[at].astype(np.int64), (high - low).astype(float)
    share = (np.minimum(weight[at], high) - low) / rate
    mass = np.bincount(doc, weights=weight, minlength=n_docs)
    limit = SLOTS * (np.log(SLOTS) + 4.0) / np.maximum(mass, 1.0)
    todo = np.arange(len(at))
    while len(todo):
        # processes with like numbers of points go together, so that arrays stay narrow
        expected = rate[todo] * limit[owner[todo]]
        for least, most in ((-1.0, 1.0), (1.0, 8.0), (8.0, 64.0), (64.0, 512.0), (512.0, np.inf)):
            part = todo[(expected > least) & (expected <= most)]
            width = 3 if most == 1.0 else int(min(most, 2048.0) * 1.3) + 4
            for a in range(0, len(part), max(1, 400_000 // width)):
                live, step = part[a : a + max(1, 400_000 // width)], 0
                time = np.zeros(len(live))
                while len(live):
                    ks = np.arange(step, step + width, dtype=np.uint64)
                    point = mixed(seed[live][:, None] + ks[None, :] * _K[1])
                    gaps = -np.log(((point >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[live][:, None]
                    gaps[:, 0] += time
                    times = np.cumsum(gaps, axis=1)
                    row, col = np.nonzero(times <= limit[owner[live]][:, None])
                    second = mixed(point[row, col] ^ _K[2])
                    hit = ((second >> np.uint64(40)).astype(np.float64) * 2.0**-24) < share[live[row]]
                    slot = (second & np.uint64(0xFFFFFFFF)).astype(np.int64) % SLOTS
                    np.minimum.at(out, owner[live[row[hit]]] * SLOTS + slot[hit], times[row[hit], col[hit]])
                    on = times[:, -1] <= limit[owner[live]]
                    live, time, step = live[on], times[on, -1], step + width
        open_ = np.isinf(out.reshape(n_docs, SLOTS)).any(axis=1) & (mass > 0)
        limit = np.where(open_, limit * 2, limit)
        todo = np.flatnonzero(open_[owner])
    return out.reshape(n_docs, SLOTS)


def signed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: number of words, two hashes of its word sequence, and its signature as 32-bit integers."""
    n = len(texts)
    t = Tokens(texts, only_words=True)
    words = np.bincount(t.doc, minlength=n)
    starts = np.searchsorted(t.doc, np.arange(n), "left")
    key1 = run_hashes(t.lower_hash, starts, starts + words)
    key2 = run_hashes(mixed(t.lower_hash ^ _K[1]), starts, starts + words)
    d, h = shingles(t, n)
    both, counts = np.unique((d.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)), return_counts=True)
    doc, element = (both >> np.uint64(44)).astype(np.int64), both & np.uint64((1 << 44) - 1)
    low = signatures(doc, mixed(element), counts, n)
    sig = (mixed(low.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    return words, key1.view(np.int64), key2.view(np.int64), sig


def bag(text: str) -> np.ndarray:
    """The multiset of a text's shingles as a sorted set: the k-th copy of a shingle is an element of its own."""
    t = Tokens([text], only_words=True)
    _, h = shingles(t, 1)
    h = np.sort(h)
    if not len(h):
        return h
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    nth = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    return np.sort(mixed(h + nth.astype(np.uint64) * _K[0]))


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two bags."""
    if not len(a) or not len(b):
        return 0.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return both / (len(a) + len(b) - both)


def _sign(docs: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.asarray(batch.column("row"))
            for first, texts in text_runs(batch.column("text"), 500_000):
                words, k1, k2, sig = signed(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[first : first + len(texts)]),
                        pa.array(words, pa.int64()),
                        pa.array(k1),
                        pa.array(k2),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                    ],
                    ["row", "words", "k1", "k2", "sig"],
                )

    rows = docs.select(F.col(ROW).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "row long, words long, k1 long, k2 long, sig binary")


def _bags(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells, size = [], [], 0
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
                rows.append(row)
                cells.append(bag(text.as_py()).tobytes())
                size += len(cells[-1])
                if size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(cells, pa.binary())], ["row", "bag"])
                    rows, cells, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(cells, pa.binary())], ["row", "bag"])

    texts = docs.select(F.col(ROW).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(wanted, "row", "left_semi").mapInArrow(run, "row long, bag binary")


def _spread(many: DataFrame, one: DataFrame, key: str, by: str) -> DataFrame:
    """many joined with one (a row a key), a hot key of many being spread over salts of `by`. many is planned twice."""
    salted = many.withColumn("salt", salt_of(by))
    needed = salted.groupBy(key).agg(*salt_masks())
    copies = needed.join(one, key).withColumn("salt", masked_salts()).drop("mask_hi", "mask_lo")
    return salted.join(copies, [key, "salt"]).drop("salt")


def _verified(pairs: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """(a, b, j): the pairs whose bags have a similarity j of at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            j = np.array(
                [
                    overlap(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64))
                    for x, y in zip(batch.column("bag_a"), batch.column("bag_b"), strict=True)
                ],
                dtype=float,
            )
            got = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(j)], ["a", "b", "j"])
            yield got.filter(pa.array(j >= least))

    with_a = pairs.join(bags.select(F.col("row").alias("a"), F.col("bag").alias("bag_a")), "a")
    with_b = _spread(with_a, bags.select(F.col("row").alias("b"), F.col("bag").alias("bag_b")), "b", "a")
    return with_b.select("a", "b", "bag_a", "bag_b").mapInArrow(run, "a long, b long, j double")


def _narrowed(rows: DataFrame, most: int) -> DataFrame:
    """rows (hub, row, sig, ...) with `hub` replaced by a smaller meeting place where more than `most` rows have it.

    Rows of a crowded hub meet only where they share one more band: a row then
    stands in up to BANDS places, and a pair at 0.8 that shares one band has
    another one in common with probability 0.99995.
    """
    counts = rows.groupBy("hub").agg((F.count(F.lit(1)) > most).alias("crowded"))
    bands = F.array(*(F.xxhash64("hub", F.lit(b), F.substring("sig", b * 4 * PER_BAND + 1, 4 * PER_BAND)) for b in range(BANDS)))
    return (
        _spread(rows, counts, "hub", "row")
        .withColumn("hub", F.explode(F.when(F.col("crowded"), bands).otherwise(F.array("hub"))))
        .drop("crowded")
    )


def _agreeing(sig: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    """Which rows of `sig` agree with `other` in as many slots as the similarity asks for, less five standard deviations."""
    return np.flatnonzero((sig == other).sum(axis=1) >= int(SLOTS * (similarity - 0.18)))


def _against_stars(missed: DataFrame, stars: DataFrame, signs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """(a, b): a link of each row that missed a hub to a row that the hub has, if there is one.

    missed and stars: (hub, row, j). A row that hub has lies within the distance
    1 - similarity of it, and the distance 1 - j is a metric: so only rows that
    missed a hub by less than twice that distance can be linked to its star, and
    only pairs whose distances to the hub differ by no more need a look. Both
    sides come in blocks of like distances, bounded in rows and bytes; two
    blocks that are near enough are a tile, which is one row. Signatures are
    compared before bags.
    """
    slack = 1.0 - similarity + 1e-9
    sig = signs.select("row", "sig")

    def blocks(rows: DataFrame, size: int, name: str, mass: int = 8_000_000) -> DataFrame:
        rows = rows.join(sig, "row").join(bags, "row").withColumn("ring", F.floor(F.col("j") / (slack / 4)))
        counts = rows.groupBy("hub", "ring").agg(
            F.ceil(F.greatest(F.count(F.lit(1)) / size, F.sum(F.length("bag")) / mass)).cast("int").alias("k")
        )
        return (
            rows.join(counts, ["hub", "ring"])
            .withColumn("block", F.pmod(F.xxhash64("row"), F.col("k")))
            .groupBy("hub", "ring", "block")
            .agg(
                F.collect_list(F.struct("row", "j", "sig", "bag")).alias(name),
                F.min("j").alias(f"{name}_from"),
                F.max("j").alias(f"{name}_to"),
            )
            .drop("ring", "block")
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for missed_, star in zip(batch.column("missed"), batch.column("star"), strict=True):
                star = star.as_py()
                at = np.array([m["j"] for m in star])
                sigs = np.frombuffer(b"".join(m["sig"] for m in star), np.uint32).reshape(-1, SLOTS)
                for o in missed_.as_py():
                    own = np.frombuffer(o["bag"], np.uint64)
                    for k in _agreeing(sigs, np.frombuffer(o["sig"], np.uint32), similarity):
                        if abs(at[k] - o["j"]) <= slack and overlap(own, np.frombuffer(star[k]["bag"], np.uint64)) >= similarity:
                            found.append((o["row"], star[k]["row"]))
                            break
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"]
            )

    near = F.col("star_from") - F.col("missed_to") <= slack
    tiles = blocks(missed, 64, "missed").join(blocks(stars, 128, "star"), "hub").where(near)
    return tiles.select("missed", "star").mapInArrow(run, "a long, b long").distinct()


def _links_among(placed: DataFrame, bags: DataFrame, similarity: float, size: int = 128, mass: int = 8_000_000) -> DataFrame:
    """(a, b): links between rows (hub, row, root, sig) of one hub whose roots differ, enough to connect all that are linked.

    placed: a written table of _narrowed() rows; hubs whose rows all have one
    root are passed over. The rows of a hub are cut into blocks of about `size`
    rows and `mass` bytes, and each two of its blocks meet in a tile, so that no
    task holds more than two. Pairs whose signatures agree in too few slots for
    the similarity, by five standard deviations, are passed over; so are pairs
    that links of the tile already connect. The others are checked on the full
    bags.
    """
    sized = placed.select("hub", "row", "root").join(bags.select("row", F.length("bag").alias("size")), "row")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / size, F.sum("size") / mass)).cast("int")
    hubs = sized.groupBy("hub").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), blocks.alias("k")).where("r1 <> r2").select("hub", "k")
    cut = (
        _spread(placed, staged(hubs, "hubs"), "hub", "row")
        .join(bags, "row")
        .withColumn("i", F.pmod(F.xxhash64("row"), F.col("k")).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("hub", F.least("i", "o").alias("lo"), F.greatest("i", "o").alias("hi"), "i", "row", "root", "sig", "bag")
        .repartition("hub", "lo", "hi")
        .sortWithinPartitions("hub", "lo", "hi", "row")
    )

    def tile(key: tuple, parts: list) -> pa.RecordBatch:
        i, row, root = (np.concatenate([p[k] for p in parts]) for k in range(3))
        sig = np.frombuffer(b"".join(x for p in parts for x in p[3]), np.uint32).reshape(-1, SLOTS)
        bags = [np.frombuffer(x, np.uint64) for p in parts for x in p[4]]
        first = np.flatnonzero(i == key[1])
        second = first if key[1] == key[2] else np.flatnonzero(i == key[2])
        with_ = {int(r): int(r) for r in set(root.tolist())}

        def top(r: int) -> int:
            while with_[r] != r:
                with_[r] = r = with_[with_[r]]
            return r

        a, b = [], []
        for x in first:
            near = second[_agreeing(sig[second], sig[x], similarity)]
            for y in near[near > x] if second is first else near:
                p, q = top(int(root[x])), top(int(root[y]))
                if p != q and overlap(bags[x], bags[y]) >= similarity:
                    with_[p] = q
                    a.append(row[x])
                    b.append(row[y])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            hub, lo, hi, i, row, root = (np.asarray(batch.column(c)) for c in ("hub", "lo", "hi", "i", "row", "root"))
            change = np.flatnonzero((np.diff(hub) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0)) + 1
            for x, y in zip([0, *change], [*change, len(hub)], strict=True):
                key = (hub[x], lo[x], hi[x])
                if held is not None and key != held:
                    yield tile(held, parts)
                    parts = []
                held = key
                cells = (batch.column(c)[x:y].to_pylist() for c in ("sig", "bag"))
                parts.append((i[x:y], row[x:y], root[x:y], *cells))
        if held is not None:
            yield tile(held, parts)

    return cut.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of every node of the edges (a, b), by contraction.

    In a turn every node points to the least of itself and its neighbours, the
    pointers are doubled until each ends at a node that points to itself, and
    the edges follow to these ends. Of two neighbours one at most is an end, so
    a turn leaves half of the nodes or fewer, and a path of n nodes in order of
    their numbers is one turn of log n doublings. A turn's tables are written to
    the shared folder, which cuts the lineage.
    """
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    roots = staged(nodes.withColumn("root", F.col("node")), "roots")
    edges = staged(edges.where("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = staged(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("p"), F.lit(True).alias("moved")), "ends")
        while not ends.where("moved").isEmpty():
            onward = ends.select(F.col("node").alias("p"), F.col("p").alias("q"))
            doubled = staged(
                ends.select("node", "p").join(onward, "p").select("node", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")),
                "ends",
            )
            discard(ends)
            ends = doubled
        to = lambda name, new: ends.select(F.col("node").alias(name), F.col("p").alias(new))  # noqa: E731, B023
        moved = (
            edges.join(to("a", "pa"), "a")
            .join(to("b", "pb"), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        fresh = staged(moved, "edges")
        further = staged(
            roots.join(to("root", "p"), "root", "left").select("node", F.coalesce("p", "root").alias("root")), "roots"
        )
        for old in (edges, roots, ends):
            discard(old)
        edges, roots = fresh, further
    discard(edges)
    return roots


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """One row per row of docs (with `__row`): its near-duplicate class.

    Two texts are linked when the multisets of their five-word shingles, of
    words in lower case without other signs, have a Jaccard similarity of
    `similarity` or more; classes are what links connect.

    1. Texts of equal word sequences are one node (128-bit hash, salted join).
    2. BagMinHash signatures of 130 slots are cut into 26 bands of 5: a pair at
       0.8 shares a band with probability 0.99995.
    3. Of a band's bucket the member that shares most buckets with others is
       the hub; each member is checked against it on the full multisets, so the
       work is linear in the bucket.
    4. Members that missed the hub, but by less than twice the distance that
       links, are checked against those that the hub has, in tiles of blocks
       (the distance is a metric, so no others can be linked to those).
    5. Members that missed a hub and are still in different components are
       held against one another, in tiles of blocks, by signatures (62 % of
       slots or more: five standard deviations under 0.8) and then on the full
       multisets. So no link between classes is lost to hubs.

    In step 5 the rows of a crowded hub meet only where they share one more
    band, so a hot bucket falls into small ones. Blocks are bounded in rows and
    in bytes.

    Columns: __row, doc_id, class_id (least doc_id of the class), class_size,
    kept (one row of each class).

    Defined results: null and wordless texts are classes of their own; texts of
    fewer than five words are one shingle; texts are read whole at any length;
    repeated rows fall in one class, of which one row is kept; null ids come
    last within a class; an empty table gives an empty table; other columns are
    ignored.
    """
    signs = staged(_sign(docs, text_col), "signs")
    salted = signs.where("words > 0").select("row", "k1", "k2", salt_of("row").alias("salt"))
    firsts = (
        salted.groupBy("k1", "k2")
        .agg(F.min("row").alias("node"), *salt_masks())
        .select("k1", "k2", "node", masked_salts().alias("salt"))
    )
    members = staged(salted.join(firsts, ["k1", "k2", "salt"]).select("row", "node"), "members")
    nodes = members.where("row = node").select("row")
    bands = F.array(
        *(F.xxhash64(F.lit(b), F.substring("sig", b * 4 * PER_BAND + 1, 4 * PER_BAND)) for b in range(BANDS))
    )
    in_band = signs.join(nodes, "row", "left_semi").select("row", F.explode(bands).alias("h"))
    in_band = in_band.withColumn("salt", salt_of("row"))
    shared = (
        in_band.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), *salt_masks())
        .where("n > 1")
        .select("h", "n", masked_salts().alias("salt"))
    )
    crowded = staged(in_band.join(shared, ["h", "salt"]).select("h", "row", "n"), "crowded")
    density = crowded.groupBy("row").agg(F.sum("n").alias("d"))
    ranked = staged(crowded.join(density, "row").select("h", "row", "d"), "ranked")
    hubs = ranked.groupBy("h").agg(F.max(F.struct("d", -F.col("row"))).alias("top")).select(
        "h", (-F.col("top.col2")).alias("hub")
    )
    pairs = staged(
        _spread(ranked.select("h", "row"), hubs, "h", "row")
        .where("row <> hub")
        .select(F.col("row").alias("a"), F.col("hub").alias("b"))
        .distinct(),
        "pairs",
    )
    wanted = staged(ranked.select("row").distinct(), "wanted")
    few = wanted.count() <= BROADCAST_ROWS
    bags = staged(_bags(docs, F.broadcast(wanted) if few else wanted, text_col), "bags")
    judged = staged(_verified(pairs, bags, 2 * similarity - 1 - 1e-9), "judged")
    links = judged.where(F.col("j") >= similarity).select("a", "b")
    first_roots = components(links)
    root_of = lambda roots, name, new: roots.select(F.col("node").alias(name), F.col("root").alias(new))
    missed = (
        judged.where(F.col("j") < similarity)
        .join(root_of(first_roots, "a", "ra"), "a", "left")
        .join(root_of(first_roots, "b", "rb"), "b")
        .where(F.coalesce("ra", "a") != F.col("rb"))
        .select(F.col("b").alias("hub"), F.col("a").alias("row"), "j")
    )
    missed = staged(missed, "missed")
    stars = judged.where(F.col("j") >= similarity).select(F.col("b").alias("hub"), F.col("a").alias("row"), "j")
    stars = stars.join(missed.select("hub").distinct(), "hub", "left_semi")
    links = staged(links.unionByName(_against_stars(missed, stars, signs, bags, similarity)), "links")
    roots = components(links)
    left = (
        pairs.join(links, ["a", "b"], "left_anti")
        .select(F.col("a").alias("row"), F.col("b").alias("hub"))
        .join(root_of(roots, "row", "root"), "row", "left")
        .select("hub", "row", F.coalesce("root", "row").alias("root"))
    )
    left = staged(left, "left")
    split = left.groupBy("hub").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("hub")
    rest = staged(_spread(left, split, "hub", "row").join(signs.select("row", "sig"), "row"), "rest")
    placed = staged(_narrowed(rest, 4096), "placed")
    more = staged(_links_among(placed, bags, similarity), "more")
    used = [signs, crowded, ranked, pairs, wanted, bags, judged, missed, left, rest, placed, links, first_roots, more]
    if not more.isEmpty():
        used.append(roots)
        roots = components(links.unionByName(more))
    for old in used:
        discard(old)
    ids = docs.select(F.col(ROW).alias("row"), F.col(id_col).cast("long").alias("doc_id"))
    of = (
        members.join(roots.select("node", "root"), "node", "left")
        .select("row", F.coalesce("root", "node").alias("root"))
    )
    classed = ids.join(of, "row", "left").select("row", "doc_id", F.coalesce("root", "row").alias("root"))
    best = classed.groupBy("root").agg(
        F.min("doc_id").alias("class_id"),
        F.count(F.lit(1)).alias("class_size"),
    )
    joined = _spread(classed, best, "root", "row")
    # of the rows that carry the class's id, repeated ones included, the first is kept
    firsts_of = joined.where("doc_id <=> class_id").groupBy("root").agg(F.min("row").alias("first"))
    return (
        joined.join(firsts_of.select(F.col("first").alias("row"), F.lit(True).alias("kept")), "row", "left")
        .select(
            F.col("row").alias(ROW),
            "doc_id",
            "class_id",
            "class_size",
            F.coalesce("kept", F.lit(False)).alias("kept"),
        )
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each near-duplicate class.

    Defined results are those of near_classes(); a column of docs named like the row's identity is kept.
    """
    rows, own = set_aside(docs, ROW)
    new = {old: renamed for renamed, old in own.items()}
    rows = held_rows(rows)
    stay = near_classes(rows, new.get(id_col, id_col), new.get(text_col, text_col), similarity).where("kept").select(ROW)
    return rows.join(stay, ROW, "left_semi").drop(ROW).withColumnsRenamed(own).select(*docs.columns)
