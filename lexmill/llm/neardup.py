"""MinHash near-duplicates by an inverted join of signature coordinates.

1. Every text becomes the set of its word shingles (64-bit hashes) and a
   signature of K coordinates, each a hash of R minima. Equal sets form one
   class, whatever their number.
2. Each class is posted under each of its K coordinate-value pairs. Sets of
   similarity s agree in a binomial number of coordinates (K, s^R). The match
   threshold T is the largest one below which a pair of the wanted similarity
   falls once in a million times; it follows from ``percent``, and where R minima
   leave no threshold of LEAST_MATCHES, fewer are joined. R keeps the posting
   lists short and should grow with the logarithm of the corpus.
3. Skip: a class that has fewer than T pairs in common with others, with any at
   all, can be nobody's partner and leaves, and its postings with it, which may
   make others leave.
4. Leaders: under every pair the posted classes meet two leaders, not each other.
   Each class is held against the leader with the most collisions, T at least,
   and links join into components; a few rounds with other leaders shrink large
   groups to a few components at a cost that grows with the postings alone.
5. Prefix: what is left are links between components. A class that has m pairs
   in common with other components shares, with each partner, one of its
   m - T + 1 rarest at least; only those are joined. The collisions of two
   classes that meet are counted over the whole signatures, and pairs of T at
   least are retained. Long posting lists are joined in blocks.

Collisions are counted on six bits of each coordinate, kept as bit planes: none
is missed, and one in 64 places agrees by chance. Two further tests spare the
full sets: four bits of each of 128 minima, with a threshold of the same kind,
and a map of 1,024 parities, which rules pairs out for certain: the places in
which two maps differ are no more than the shingles in one set alone, of which a
link allows (100 - percent) / (100 + percent) of both sizes at most.

Links are verified on the full sets: 100 * intersection >= percent * union. The
sets meet in buckets by their least minimum, so that a set is sent once to each
pair of buckets that has pairs for it, not once for each pair. No list of links,
partners or candidates is cut short.

``exact=True`` takes the shingles themselves for coordinates and, for each set,
the overlap that its size demands for the threshold: the same join without any
loss, at a cost that grows with the common shingles.

Defined cases: a null text or one without words has an empty set, is linked
with nothing and is its own component; a text of fewer words than a shingle has
all of them as its one shingle; long texts count whole; equal rows are in one
component; rows with a null id take part, and a component's id is the least id
that is not null; an empty table gives an empty one; columns other than the id
and the text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .staging import cleared, maybe_in, spread_join, staged
from .words import mix, shingle_sets

#: K, R and the least T of the signature; chance that one filter loses a pair of the wanted similarity.
COORDINATES, MINIMA, LEAST_MATCHES, LOSS = 48, 3, 5, 1e-6
#: Minima of the sketch; bits that are kept of a coordinate and of a minimum of the sketch.
SKETCHED, PLACE_BITS, SKETCH_BITS = 128, 6, 4
#: Columns of bit planes: of the coordinates, of the first and of the second 64 minima.
PLACES = tuple(f"place{k}" for k in range(PLACE_BITS))
SKETCH = tuple(tuple(f"sketch{g}{k}" for k in range(SKETCH_BITS)) for g in (0, 1))
WORDS = (*PLACES, *SKETCH[0], *SKETCH[1])
#: Rounds of leaders at most, and the share of all links so far that a round must add for another one.
ROUNDS, WORTH = 10, 0.03
PARITIES = 1024
#: Postings of a list that are joined in one block, and shingles (4 MB) and sets of a bucket.
LIST_BLOCK, BUCKET_SHINGLES, BUCKET_SETS = 1024, 500_000, 256
_BLOCK = 4096
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def least_agreed(places: int, chance: float, loss: float = LOSS) -> int:
    """The largest threshold below which a binomial count (places, chance) falls with a probability of ``loss`` at most."""
    below = 0.0
    for k in range(places + 1):
        below += comb(places, k) * chance**k * (1 - chance) ** (places - k)
        if below > loss:
            return k
    return places


def signature_form(percent: int, most: int = MINIMA) -> tuple[int, int, int]:
    """R (``most``, or as many as leave a threshold) and T of the coordinates, and the agreement of the sketch, for a similarity of ``percent``."""
    s = percent / 100
    for minima in range(most, 0, -1):
        matches = least_agreed(COORDINATES, s**minima)
        if matches >= LEAST_MATCHES:
            return minima, matches, least_agreed(SKETCHED, s + (1 - s) / (1 << SKETCH_BITS))
    raise ValueError(f"signatures of {COORDINATES} coordinates can't tell pairs of {percent} percent; use exact=True")


def _planes(values: np.ndarray, bits: int) -> list[int]:
    """The lowest bits of up to 64 values, a word for each bit."""
    return [int(((values >> np.uint64(k) & np.uint64(1)) * _BITS[: len(values)]).sum(dtype=np.uint64).view(np.int64)) for k in range(bits)]


class MinHash:
    def __init__(self, minima: int = MINIMA) -> None:
        n = max(SKETCHED, COORDINATES * minima)
        rng = np.random.Generator(np.random.PCG64(977))
        self.minima = minima
        self.factors = rng.integers(1, 2**64, n, np.uint64, endpoint=False) | np.uint64(1)
        self.terms = rng.integers(0, 2**64, n, np.uint64, endpoint=False)
        self.weights = rng.integers(1, 2**64, minima, np.uint64, endpoint=False) | np.uint64(1)

    def signature(self, values: np.ndarray) -> tuple:
        """The coordinates as 32 bits, the home (of the least minimum), and the words of the planes."""
        least = np.full(len(self.factors), np.iinfo(np.uint64).max)
        for k in range(0, len(values), _BLOCK):
            table = values[k : k + _BLOCK, None] * self.factors + self.terms
            table ^= table >> np.uint64(32)
            np.minimum(least, (table * np.uint64(0x9E3779B97F4A7C15)).min(axis=0), out=least)
        least = mix(least)
        joined = mix((least[: COORDINATES * self.minima].reshape(COORDINATES, self.minima) * self.weights).sum(axis=1, dtype=np.uint64)) >> np.uint64(32)
        words = [*_planes(joined, PLACE_BITS), *_planes(least[:64], SKETCH_BITS), *_planes(least[64:SKETCHED], SKETCH_BITS)]
        return joined.astype(np.uint32).view(np.int32), int(least[0] >> np.uint64(1)), *words


def parities(values: np.ndarray) -> np.ndarray:
    """For each of the places that hashes fall on, whether an odd number does, as 64-bit words."""
    odd = np.bincount((values & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def shingled(docs: DataFrame, width: int, minima: int, id_col: str, text_col: str, sets: bool = False) -> DataFrame:
    """Id, n_shingles, digest (of the whole set), signature, home, planes and parities; with ``sets``, the set in their place."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = MinHash(minima)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sizes, digests, rest = [], [], [[] for _ in range(2 + len(WORDS))]
                odd = []
                for values in shingle_sets([(t or "").encode() for t in part.column(1).to_pylist()], width):
                    sizes.append(len(values))
                    digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                    if sets:
                        rest[0].append(values.view(np.int64))
                        continue
                    own = hashes.signature(values) if len(values) else (np.empty(0, np.int32), 0, *[0] * len(WORDS))
                    odd.append(parities(values))
                    for x, column in zip(own, rest):
                        column.append(x)
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
                names = ["id", "n_shingles", "digest"]
                if sets:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(rest[0], pa.list_(pa.int64()))], names=[*names, "shingles"])
                else:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(rest[0], pa.list_(pa.int32())), *[pa.array(x, pa.int64()) for x in rest[1:]], pa.array(odd, pa.list_(pa.int64()))], names=[*names, "signature", "home", *WORDS, "parity"])

    last = "shingles array<long>" if sets else f"signature array<int>, home long, {', '.join(f'{w} long' for w in WORDS)}, parity array<long>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_shingles long, digest binary, {last}")


#: What goes with a posting: the places, the size of the set and its bucket; in the last join, all.
KNOWN = (*PLACES, "n_shingles", "bucket")
ALL_KNOWN = (*WORDS, "n_shingles", "bucket", "parity")


def _agreed(a: str, b: str, words: tuple[str, ...], places: int) -> Column:
    """Of up to 64 places, those in which the planes of two rows agree."""
    differ = F.lit(0).cast("long")
    for word in words:
        differ = differ.bitwiseOR(F.col(f"{a}{word}").bitwiseXOR(F.col(f"{b}{word}")))
    return places - F.bit_count(differ)


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    sizes = F.col(f"{a}n_shingles"), F.col(f"{b}n_shingles")
    return 100 * F.least(*sizes) >= percent * F.greatest(*sizes)


def _may_overlap(a: str, b: str, percent: int) -> Column:
    """Whether the maps of parities allow a link; never false for one."""
    differ = F.aggregate(F.zip_with(F.col(f"{a}parity"), F.col(f"{b}parity"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    return differ * (100 + percent) <= (100 - percent) * (F.col(f"{a}n_shingles") + F.col(f"{b}n_shingles"))


def _post(nodes: DataFrame, *columns: str) -> DataFrame:
    return nodes.select("node", *columns, F.explode("pairs").alias("pair"))


def _common(nodes: DataFrame) -> DataFrame:
    """The nodes, with the pairs that others have too, as far as there are as many as they need."""
    shared = _post(nodes).groupBy("pair").agg(F.count(F.lit(1)).alias("posted")).filter(F.col("posted") > 1).select("pair")
    kept = _post(nodes, "needed").join(shared, "pair")
    return kept.groupBy("node", "needed").agg(F.collect_list("pair").alias("pairs")).filter(F.size("pairs") >= F.col("needed"))


def _housed(nodes: DataFrame) -> DataFrame:
    """Add bucket: nodes of one least minimum share a home, homes share a bucket, and full buckets are split by a hash."""
    total = nodes.agg(F.sum("n_shingles"), F.count(F.lit(1))).first()
    homes = max(-(-(total[0] or 0) // BUCKET_SHINGLES), -(-total[1] // BUCKET_SETS), 1)
    placed = nodes.withColumn("house", F.pmod("home", F.lit(homes)))
    rooms = F.ceil(F.greatest(F.sum("n_shingles") / BUCKET_SHINGLES, F.count(F.lit(1)) / BUCKET_SETS))
    loads = placed.groupBy("house").agg(rooms.alias("rooms"), F.count(F.lit(1)).alias("_many"))
    joined = spread_join(placed, loads, "house", total[1], "_many")
    return joined.withColumn("bucket", F.shiftleft("house", 24).bitwiseOR(F.pmod(F.xxhash64("node"), F.col("rooms")))).drop("house", "rooms", "_many", "home")


def _checked(percent: int):
    """Over rows in order of the two buckets and the role: sets (0), then the pairs (1), of which the similar ones are returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sets = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            home, other, role, a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            shingles, links = batch.column(5), []
            for k in range(batch.num_rows):
                if key != (home[k], other[k]):
                    key, sets = (home[k], other[k]), {}
                if role[k] == 0:
                    sets[a[k]] = shingles[k].values.to_numpy()
                    continue
                x, y = sets[a[k]], sets[b[k]]
                same = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * same >= percent * (len(x) + len(y) - same):
                    links.append((a[k], b[k]))
            flat = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["a", "b"])

    return run


def _verified(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b, a_bucket, b_bucket), those whose sets are similar enough. A set goes once to each pair of buckets that asks for it."""
    turned = F.col("a_bucket") > F.col("b_bucket")
    pick = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x))
    pairs = staged(candidates.select(pick("a_bucket", "b_bucket").alias("home"), pick("b_bucket", "a_bucket").alias("other"), "a", "b").distinct(), "candidates")
    asked = pairs.select("home", "other", F.explode(F.array("a", "b")).alias("node")).distinct()
    sent = asked.join(sets, "node").select("home", "other", F.lit(0).alias("role"), F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "shingles")
    listed = pairs.select("home", "other", F.lit(1).alias("role"), "a", "b", F.lit(None).cast("array<long>").alias("shingles"))
    dealt = sent.union(listed).repartition("home", "other").sortWithinPartitions("home", "other", "role")
    return dealt.mapInArrow(_checked(percent), "a long, b long")


def _leaders(posted: DataFrame, total: int, turn: int, percent: int, matches: int) -> DataFrame:
    """For each node the leader of another component that it has most collisions with, where a link is possible.

    Every pair has two leaders, the least and the greatest in an order that
    changes with the turn. posted: pair, node, label and KNOWN, ``total`` rows.
    """
    order = F.xxhash64(F.lit(turn), "node")
    ends = F.struct(order.alias("order"), "node", "label", *KNOWN)
    lead = posted.groupBy("pair").agg(F.min(ends).alias("least"), F.max(ends).alias("most"), F.count(F.lit(1)).alias("posted"))
    met = spread_join(posted, lead, "pair", total, "posted").withColumn("lead", F.explode(F.array("least", "most")))
    collisions = _agreed("", "lead.", PLACES, COORDINATES)
    met = met.filter((F.col("label") != F.col("lead.label")) & (collisions >= matches) & _sizes_allow("", "lead.", percent))
    best = met.groupBy("node", "bucket").agg(F.max(F.struct(collisions, F.xxhash64("lead.node", F.lit(turn)), F.col("lead.node").alias("leader"), F.col("lead.bucket").alias("bucket"))).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.leader").alias("b"), F.col("bucket").alias("a_bucket"), F.col("best.bucket").alias("b_bucket"))


def _mixed(nodes: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """Of the pairs that nodes share with other components, the rarest ones that a partner must have one of, as far as there are enough."""
    posted = _post(nodes, "needed").join(labels, "node")
    several = posted.groupBy("pair").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("posted")).filter(F.col("low") != F.col("high"))
    own = spread_join(posted, several.select("pair", "posted"), "pair", total, "posted").groupBy("node", "label", "needed").agg(F.sort_array(F.collect_list(F.struct("posted", "pair"))).alias("listed"))
    enough = own.filter(F.size("listed") >= F.col("needed"))
    return enough.select("node", "label", F.slice("listed", F.lit(1), (F.size("listed") - F.col("needed") + 1).cast("int")).alias("rare"))


def _met(cross: DataFrame, nodes: DataFrame, percent: int, matches: int | None, agreed: int) -> DataFrame:
    """Pairs of nodes that meet in their prefixes and pass the tests; without ``matches``, only those that hold for all sets."""
    posted = cross.join(nodes.select("node", *ALL_KNOWN), "node").select("node", "label", *ALL_KNOWN, F.explode("rare").alias("listed"))
    posted = posted.withColumn("blocks", F.ceil(F.col("listed.posted") / LIST_BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    posted = staged(posted.select(F.col("listed.pair").alias("pair"), "blocks", "own", "node", "label", *ALL_KNOWN), "postings")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rest = lambda x: [F.col(c).alias(f"{x}_{c}") for c in ("node", "label", *ALL_KNOWN)]
    a, b = posted.select("pair", F.col("own").alias("i"), every.alias("j"), *rest("a")), posted.select("pair", every.alias("i"), F.col("own").alias("j"), *rest("b"))
    fits = _sizes_allow("a_", "b_", percent)
    if matches is not None:
        sketch = _agreed("a_", "b_", SKETCH[0], 64) + _agreed("a_", "b_", SKETCH[1], 64)
        fits = fits & (_agreed("a_", "b_", PLACES, COORDINATES) >= matches) & (sketch >= agreed)
    met = a.join(b, ["pair", "i", "j"]).filter((F.col("a_label") != F.col("b_label")) & (F.col("a_node") < F.col("b_node")) & fits & _may_overlap("a_", "b_", percent))
    return met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), "a_bucket", "b_bucket")


def near_links(docs: DataFrame, classes: DataFrame, width: int, percent: int, exact: bool = False, most: int = MINIMA) -> DataFrame:
    """Node and label (of its component) for the classes that may have a link.

    docs: id, text. classes: node, least (an id of the class), digest, home, n_shingles, parity and, but for ``exact``, signature and WORDS.
    """
    spark = classes.sparkSession
    _, matches, agreed = (1, None, 0) if exact else signature_form(percent, most)
    pair = lambda x, k: F.shiftleft(k.cast("long"), 32).bitwiseOR(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    if exact:
        every = _sets(docs, classes.select("node", "least", "digest"), width)
        nodes = every.select("node", F.ceil(percent * F.size("shingles") / 100).cast("int").alias("needed"), F.col("shingles").alias("pairs"))
    else:
        nodes = classes.select("node", F.lit(matches).alias("needed"), F.transform("signature", pair).alias("pairs"))
    nodes = staged(_common(nodes), "postings")
    left = nodes.count()
    while left:  # skip: those left may have shared pairs only with those that went
        nodes, before = staged(_common(nodes), "postings"), left
        left = nodes.count()
        if left > 0.9 * before:
            break
    if not left:
        return spark.createDataFrame([], "node long, label long")
    known = nodes.join(classes.select("node", "least", "digest", "home", "n_shingles", "parity", *WORDS), "node")
    nodes = staged(_housed(known), "postings")
    sets = staged(_sets(docs, nodes.select("node", "least", "digest"), width, left), "sets")
    labels = staged(nodes.select("node", F.col("node").alias("label")), "labels")
    postings = nodes.agg(F.sum(F.size("pairs").cast("long"))).first()[0]
    total = 0
    for turn in range(0 if exact else ROUNDS):
        posted = nodes.join(labels, "node").select("node", "label", *KNOWN, F.explode("pairs").alias("pair"))
        links = staged(_verified(_leaders(posted, postings, turn, percent, matches), sets, percent), "links")
        n = links.count()
        total += n
        if n:
            labels = _joined(labels, links)
        if n <= WORTH * total:
            break
    met = _met(_mixed(nodes, labels, postings), nodes, percent, matches, agreed)
    return _joined(labels, staged(_verified(met, sets, percent), "links"))


def _sets(docs: DataFrame, found: DataFrame, width: int, count: int | None = None) -> DataFrame:
    """The full sets of the nodes; texts are hashed again for those that are left, as keeping all sets would take more than the texts do."""
    texts = docs if count is None else maybe_in(docs, "id", found, "least", count)
    wanted = found.select("node", "digest", F.col("least").alias("id"))
    own = shingled(texts, width, 1, "id", "text", sets=True).join(wanted, ["digest", "id"])
    return own.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after linked nodes' components have become one."""
    of = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"of_{x}"))
    merged = components(links.join(of("a"), "a").join(of("b"), "b").select("of_a", "of_b"))
    now = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("_many")).join(now, "label", "left")
    return staged(spread_join(labels, sizes, "label", labels.count(), "_many").select("node", F.coalesce("new", "label").alias("label")), "labels")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", exact: bool = False, most_minima: int = MINIMA) -> DataFrame:
    """Return id, n_shingles, component_id (the least id reachable) and kept (whether that is its own).

    Without ``exact``, a pair of a similarity of ``percent`` is missed twice in a
    million times, more similar ones less. ``most_minima`` is R, for which three
    serve some millions of documents and four some billions; the threshold
    follows, and no link is lost by either.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and 100 at most")
    minima = 1 if exact else signature_form(percent, most_minima)[0]

    def make() -> DataFrame:
        rows = staged(shingled(docs, width, minima, id_col, text_col), "shingled")
        full = rows.filter(F.col("n_shingles") > 0)
        grouped = full.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("many"), *[F.first(c).alias(c) for c in ("signature", "home", "n_shingles", "parity", *WORDS)])
        classes = staged(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
        labels = near_links(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), classes, width, percent, exact, most_minima)
        known = classes.select("digest", "node", "least", "many").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        known = staged(known, "labels")
        least = known.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_many"))
        by_class = staged(spread_join(known, least, "label", known.count(), "_many").select("digest", "many", "component_id"), "labels")
        ids = rows.select("id", "n_shingles", "digest")
        linked = spread_join(ids.filter(F.col("n_shingles") > 0), by_class, "digest", rows.count(), "many").select("id", "n_shingles", "component_id")
        out = linked.union(ids.filter(F.col("n_shingles") == 0).select("id", "n_shingles", F.col("id").alias("component_id")))
        component = F.coalesce("component_id", "id")
        return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))

    return cleared(docs.sparkSession, "near-duplicates", make)
