"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Equal vectors form one class. The classes are dealt over shards, as large as a
task's memory allows; a task builds the graph of a shard, layer by layer from
the sparsest, and streams queries through it, many in lock step. Where there are
more cores than shards, several tasks build the same graph and share its queries.

A node hangs below the nearest nodes of the layer above. A beam of queries goes
down the layers: the children of a node meet all the queries that have it in
their beam in one product of matrices. What they reach in the lowest layer is
where a beam along its links starts. A query's beam is widened until its worst
member lies below the threshold, so that groups of any size are found whole.

Before any query is answered, the shard's beam is audited against all its
vectors and widened until the audit passes; a beam as wide as the shard is
exact. The audit asks two kinds of query: planted ones, at a cosine just above
the threshold from a vector of the shard, so that every audit holds true hits of
the hardest kind, and a sample of the real ones. Recall is taken for each query
that has a hit other than itself and then averaged, so that the many hits of a
large group can't hide the few of a small one.

Cosines of hits are verified in double precision. A task returns, for each
query, the number of its verified links, and the edges that join what it found
into components, at most one for each query or vector.

Defined cases: vectors that are null, empty, zero, or hold a null or a
non-finite component link with nothing and are their own component; vectors of
another length are never compared; equal vectors link; rows that repeat an id
are rows of their own that share it; an empty table gives an empty one; labels
and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .staging import cleared, kept, spread_join, staged

LOG = logging.getLogger(__name__)
#: Classes to a shard, and shards at least; links per node, twice as many in the lowest layer.
SHARD_CLASSES, SHARDS, LINKS = 200_000, 6, 12
#: Nodes that one hangs below, and those of the top layer at most; queries at least for each of several tasks that ask one shard.
HANG, TOP, PART = 4, 1024, 20_000
#: Bytes of a shard's vectors, so that long ones go into more shards.
SHARD_BYTES = 128 << 20
#: Beams while building and at first while searching; queries in lock step.
BUILD_BEAM, BEAM, BLOCK = 40, 16, 512
#: All cosines of a query are taken where a beam would be as wide as one in so many of the nodes; pairs that are verified at once.
GATHER, SURE = 720, 1 << 18
#: Planted queries of an audit, sampled real ones, and the mean recall that it must show.
PLANTED, SAMPLED, RECALL = 256, 512, 0.999
MARGIN = 1e-5  # of single precision


def _best(sims: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n best of each row, in falling order."""
    if sims.shape[1] > n:
        part = np.argpartition(-sims, n - 1, axis=1)[:, :n]
        sims, ids = np.take_along_axis(sims, part, 1), np.take_along_axis(ids, part, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(sims, order, 1), np.take_along_axis(ids, order, 1)


class Graph:
    """Vectors of length one in layers, the sparsest first: a node hangs below the HANG nearest of the layer above, and those of the lowest have neighbours (-1: none)."""

    def __init__(self, vectors: np.ndarray, seed: int = 7) -> None:
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        order = np.random.Generator(np.random.PCG64(seed)).permutation(n)
        sizes = [n]
        while sizes[-1] > TOP or len(sizes) == 1:
            sizes.append(max(1, sizes[-1] // LINKS))
        #: The nodes of the top layer, and for every layer below it where the children of each node start, and the children.
        self.top, self.below = order[: sizes[-1]], []
        for size in reversed(sizes[:-1]):
            self._hang(order[:size])
        self.links = np.full((n, 2 * LINKS), -1, np.int32)
        self._join()

    def _hang(self, nodes: np.ndarray) -> None:
        """Add a layer below the others."""
        parents = []
        many = self.many(2 * HANG)
        for k in range(0, len(nodes), many):
            own = nodes[k : k + many]
            found = self._descend(self.x[own], 2 * HANG)[1][:, :HANG]
            child, c = np.nonzero(found >= 0)
            parents.append((found[child, c], own[child]))
        parent, child = (np.concatenate(c) for c in zip(*parents))
        by = np.argsort(parent, kind="stable")
        self.below.append((np.searchsorted(parent[by], np.arange(len(self.x) + 1)), child[by]))

    def _join(self) -> None:
        """Neighbours in the lowest layer: of the nearest that the layers lead to, then links the other way."""
        nodes, many = np.arange(len(self.x)), self.many(BUILD_BEAM)
        for k in range(0, len(nodes), many):
            own = nodes[k : k + many]
            sims, ids = self._descend(self.x[own], BUILD_BEAM)[:2]
            sims = np.where(ids == own[:, None], -2, sims)
            for j in range(0, len(own), BLOCK):
                near, who = _best(sims[j : j + BLOCK], ids[j : j + BLOCK], BUILD_BEAM)
                self.links[own[j : j + BLOCK]] = self._diverse(near, who, self.links.shape[1])
        self._back()

    def many(self, width: int) -> int:
        """Queries that are led down together, so that they share the children that they open; fewer where beams are wide or vectors long."""
        return max(1, min((1 << 17) // width, (8 << 20) // max(1, self.x.shape[1])))

    def _open(self, queries: np.ndarray, parents: np.ndarray, layer: tuple, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """Query, node and similarity of the children of each query's parents that are at its ``least`` or above, each once, by query and in falling order; a parent's children meet all its queries at once."""
        starts, children = layer
        q, c = np.nonzero(parents >= 0)
        by = np.argsort(parents[q, c], kind="stable")
        q = q[by]
        heads, first = np.unique(parents[q, c[by]], return_index=True)
        found = []
        for parent, a, z in zip(heads, first, [*first[1:], len(q)]):
            own, nodes = q[a:z], children[starts[parent] : starts[parent + 1]]
            sims = queries[own] @ self.x[nodes].T
            at = np.flatnonzero(sims >= least[own][:, None])
            found.append((own[at // len(nodes)], nodes[at % len(nodes)], sims.ravel()[at]))
        who, node, sims = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))
        _, first = np.unique(who * len(self.x) + node, return_index=True)
        who, node, sims = who[first], node[first], sims[first]
        by = np.lexsort((-sims, who))
        return who[by], node[by], sims[by]

    def _descend(self, queries: np.ndarray, width: int, threshold: float = 2.0) -> tuple[np.ndarray, ...]:
        """Similarity and id of the ``width`` best nodes of the lowest layer so far that the layers lead to, in falling order (-2 and -1: none); and query and node of all that are met at ``threshold`` or above."""
        m = len(queries)
        sims, ids = np.empty((m, min(width, len(self.top))), np.float32), np.empty((m, min(width, len(self.top))), np.int64)
        for k in range(0, m, BLOCK):
            near = queries[k : k + BLOCK] @ self.x[self.top].T
            sims[k : k + BLOCK], at = _best(near, np.broadcast_to(np.arange(len(self.top)), near.shape), width)
            ids[k : k + BLOCK] = self.top[at]
        who = node = np.empty(0, np.int64)
        for depth, layer in enumerate(self.below):
            # a node is its own child, so that those of the last layer are among the found
            least = sims[:, min(sims.shape[1], -(-width // 4)) - 1]
            last = depth == len(self.below) - 1
            q, n, near = self._open(queries, ids, layer, np.minimum(least, threshold) if last else least)
            place = np.arange(len(q)) - np.searchsorted(q, q)
            kept = place < width
            sims, ids = np.full((m, width), -2.0, np.float32), np.full((m, width), -1, np.int64)
            sims[q[kept], place[kept]], ids[q[kept], place[kept]] = near[kept], n[kept]
            if last:
                who, node = q[near >= threshold], n[near >= threshold]
        return sims, ids, who, node

    def _diverse(self, sims: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
        """Of candidates in falling order, those nearer to the node than to any chosen one; then the nearest others."""
        valid = (ids >= 0) & (sims > -1.5)
        y = self.x[np.maximum(ids, 0)]
        between = np.matmul(y, y.transpose(0, 2, 1))
        nearest = np.full(sims.shape, -2.0, np.float32)
        taken = np.zeros(sims.shape, bool)
        for c in range(sims.shape[1]):
            pick = valid[:, c] & (nearest[:, c] < sims[:, c]) & (taken.sum(1) < width)
            taken[:, c] = pick
            np.maximum(nearest, np.where(pick[:, None], between[:, c], -2.0), out=nearest)
        rank = np.where(taken, 0, np.where(valid, 1, 2)) * sims.shape[1] + np.arange(sims.shape[1])
        first = np.argsort(rank, axis=1)[:, :width]
        out = np.where(np.take_along_axis(valid, first, 1), np.take_along_axis(ids, first, 1), -1)
        return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1).astype(np.int32)

    def _back(self) -> None:
        """Links the other way; lists are chosen anew from both."""
        links, width = self.links.copy(), self.links.shape[1]
        source, at = np.nonzero(links >= 0)
        target = links[source, at]
        by = np.argsort(target, kind="stable")
        source, starts = source[by], np.searchsorted(target[by], np.arange(len(links) + 1))
        for k in range(0, len(links), BLOCK):
            part = np.arange(k, min(k + BLOCK, len(links)))
            counts = np.diff(starts[k : k + len(part) + 1])
            own = source[starts[k] : starts[k + len(part)]]
            row = np.repeat(np.arange(len(part)), counts)
            near = np.einsum("ij,ij->i", self.x[part[row]], self.x[own])
            by = np.lexsort((-near, row))
            place = np.arange(len(own)) - np.repeat(starts[k : k + len(part)] - starts[k], counts)
            kept = place < width
            added = np.full((len(part), width), -1, np.int32)
            added[row[kept], place[kept]] = own[by][kept]
            ids = np.concatenate([links[part], added], 1)
            ids = np.where(self._repeated(ids), -1, ids)
            sims = np.where(ids >= 0, np.einsum("ij,ikj->ik", self.x[part], self.x[np.maximum(ids, 0)]), -2)
            self.links[part] = self._diverse(*_best(sims, ids, ids.shape[1]), width)

    @staticmethod
    def _repeated(ids: np.ndarray) -> np.ndarray:
        """Where an id stands in its row a second time."""
        order = np.argsort(ids, axis=1, kind="stable")
        inside = np.take_along_axis(ids, order, 1)
        again = np.zeros(ids.shape, bool)
        np.put_along_axis(again, order, np.concatenate([np.zeros((len(ids), 1), bool), inside[:, 1:] == inside[:, :-1]], 1), 1)
        return again

    def _beam(self, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Similarity and id of the ``width`` best nodes that a beam from ``entry`` finds, in falling order (-2 and -1: none)."""
        m, n = len(queries), len(self.x)
        sims, ids = np.full((m, width), -2.0, np.float32), np.full((m, width), -1, np.int32)
        opened = np.ones((m, width), bool)
        seen = np.zeros((m, n), bool)
        rows = np.arange(m)
        step = max(4, width // 12)
        new, live = np.array(entry, np.int32), rows
        first = True
        while len(live):
            if not first:
                closed = ~opened[live] & (ids[live] >= 0)
                rank = np.where(closed, np.arange(width), width)
                picks = np.sort(np.argpartition(rank, min(step, width) - 1, axis=1)[:, :step], 1) if width > step else np.broadcast_to(np.arange(width), (len(live), width))
                use = np.take_along_axis(closed, picks, 1)
                opened[live[:, None], picks] |= use
                some = use.any(1)
                live, picks, use = live[some], picks[some], use[some]
                if not len(live):
                    break
                around = np.where(use[:, :, None], self.links[np.maximum(ids[live[:, None], picks], 0)], -1)
                new = around.reshape(len(live), -1)
            first = False
            fresh = (new >= 0) & ~seen[live[:, None], np.maximum(new, 0)]
            new = np.where(fresh, new, -1)
            new = np.where(self._repeated(new), -1, new)
            r, c = np.nonzero(new >= 0)
            seen[live[r], new[r, c]] = True
            # pack to the left: most neighbours have been seen
            counts = np.bincount(r, minlength=len(live))
            wide = int(counts.max()) if len(r) else 0
            if not wide:
                continue
            place = np.arange(len(r)) - np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)
            found, near = np.full((len(live), wide), -1, np.int32), np.full((len(live), wide), -2.0, np.float32)
            found[r, place] = new[r, c]
            near[r, place] = np.einsum("ij,ij->i", queries[live[r]], self.x[new[r, c]])
            all_sims, all_ids = np.concatenate([sims[live], near], 1), np.concatenate([ids[live], found], 1)
            all_open = np.concatenate([opened[live], np.zeros(near.shape, bool)], 1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            sims[live], ids[live], opened[live] = (np.take_along_axis(a, order, 1) for a in (all_sims, all_ids, all_open))
        return sims, ids

    def step(self) -> int:
        """Queries whose cosines with all vectors fit into some 120 MB."""
        return max(1, 30_000_000 // max(1, len(self.x)))

    def dense(self, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Query and node of every pair at ``threshold`` or above, by all cosines, in blocks that a processor's cache holds."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for k in range(0, len(queries), BLOCK):
            for j in range(0, len(self.x), 8 * BLOCK):
                near = queries[k : k + BLOCK] @ self.x[j : j + 8 * BLOCK].T >= threshold
                if near.any():
                    q, n = np.nonzero(near)
                    found.append((k + q, j + n))
        return tuple(np.concatenate(x) for x in zip(*found))

    def pieces(self, queries: np.ndarray, threshold: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Query and node of every pair found at ``threshold`` or above, those of some queries at a time; beams widen while their worst member is, in the end to the whole shard."""
        rest, widened, size = np.arange(len(queries)), False, len(self.x)
        while len(rest):
            # so wide a beam gathers so many nodes that all cosines, which need no gathering, take less time
            if width >= size or (widened and GATHER * width >= size):
                most = max(16, min(BLOCK, 8_000_000 // size))
                for k in range(0, len(rest), most):
                    q, n = self.dense(queries[rest[k : k + most]], threshold)
                    yield rest[k + q], n
                return
            again, many = [], self.many(width)
            most = max(1, min(BLOCK, 60_000_000 // max(size, 40 * width)))
            for k in range(0, len(rest), many):
                own = queries[rest[k : k + many]]
                _, entry, q, n = self._descend(own, width, threshold)
                full, pairs = np.zeros(len(own), bool), [q * size + n]
                for j in range(0, len(own), most):
                    sims, ids = self._beam(own[j : j + most], entry[j : j + most], width)
                    full[j : j + most] = sims[:, -1] >= threshold
                    q, c = np.nonzero(sims >= threshold)
                    pairs.append((j + q) * size + ids[q, c])
                q, n = np.divmod(np.unique(np.concatenate(pairs)), size)
                yield rest[k + q[~full[q]]], n[~full[q]]
                again.append(rest[k + np.flatnonzero(full)])
            rest, widened = np.concatenate(again), True
            width *= 4

    def within(self, queries: np.ndarray, threshold: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """All :meth:`pieces` at once."""
        none = np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip((none, none), *self.pieces(queries, threshold, width)))

    def planted(self, threshold: float, seed: int = 11) -> np.ndarray:
        """Queries at a cosine just above the threshold from vectors of the shard."""
        rng = np.random.Generator(np.random.PCG64(seed))
        base = self.x[rng.choice(len(self.x), min(PLANTED, len(self.x)), replace=False)].astype(np.float64)
        aside = rng.standard_normal(base.shape)
        aside -= (aside * base).sum(axis=1, keepdims=True) * base
        length = np.sqrt((aside * aside).sum(axis=1, keepdims=True))
        cosine = np.minimum(1.0, threshold + 10 * MARGIN + rng.random((len(base), 1)) * 0.02 * (1 - threshold))
        cosine = np.where(length > 1e-9, cosine, 1.0)  # in one dimension nothing is aside
        return (cosine * base + np.sqrt(1 - cosine * cosine) * aside / np.maximum(length, 1e-12)).astype(np.float32)

    def audit(self, queries: np.ndarray, own: np.ndarray, threshold: float, width: int, recall: float = RECALL) -> tuple[int, float, int]:
        """The least width from ``width`` on at which the queries' recall passes, that recall, and how many queries had a hit. own: a query's node, or -1."""
        while True:
            many, got = np.zeros(len(queries)), np.zeros(len(queries))
            for k in range(0, len(queries), self.step()):
                part, mine = queries[k : k + self.step()], own[k : k + self.step()]
                true = part @ self.x.T >= threshold + MARGIN
                true[np.flatnonzero(mine >= 0), mine[mine >= 0]] = False
                q, n = self.within(part, threshold, width)
                many[k : k + len(part)] = true.sum(axis=1)
                got[k : k + len(part)] = np.bincount(q, true[q, n], len(part))
            telling = many > 0
            mean = float((got[telling] / many[telling]).mean()) if telling.any() else 1.0
            if width >= len(self.x) or mean >= recall:
                return width, mean, int(telling.sum())
            width *= 2


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one in double precision."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


class Forest:
    """Labels of a shard's nodes; new unions give the edges that return them."""

    def __init__(self, uids: np.ndarray) -> None:
        self.uids, self.label = uids, np.arange(len(uids))
        self.query: dict[int, int] = {}

    def join(self, uid: int, nodes: np.ndarray) -> Iterator[tuple[int, int]]:
        labels = np.unique(self.label[nodes])
        for other in labels[1:]:
            yield int(self.uids[labels[0]]), int(self.uids[other])
            self.label[self.label == other] = labels[0]
        if int(self.uids[labels[0]]) != uid:
            yield uid, int(self.uids[labels[0]])


#: What a task returns: an edge (0) of two uids, the links (1) of a uid, an audit (2) of a shard: its width, recall and telling queries.
FOUND = ("kind", "a", "b", "recall", "queries")


def _search(threshold: float, beam: int, parts: int):
    """Over rows in order of (size, task, role): a shard's vectors (0), a sample of the queries (1), then those of all that fall to this one of the shard's ``parts`` tasks (2)."""

    class Shard:
        def __init__(self) -> None:
            self.uids, self.many, self.vectors, self.sample, self.sampled = [], [], [], [], []
            self.graph: Graph | None = None
            self.asked: list[tuple[np.ndarray, np.ndarray]] = []

        def ready(self) -> tuple:
            """Build the graph and audit its beam."""
            self.uids, self.many, self.vectors = (np.concatenate(x) for x in (self.uids, self.many, self.vectors))
            self.graph, self.forest = Graph(self.vectors), Forest(self.uids)
            self.order = np.argsort(self.uids)
            planted = self.graph.planted(threshold)
            queries = np.concatenate([planted, *[x.astype(np.float32) for x in self.sample]])
            own = np.concatenate([np.full(len(planted), -1), *map(self.nodes, self.sampled)])
            self.width, recall, telling = self.graph.audit(queries, own, threshold - MARGIN, beam)
            self.sample, self.sampled = [], []
            return self.width, recall, telling

        def nodes(self, uids: np.ndarray) -> np.ndarray:
            """The node of each uid, -1 where it is in another shard."""
            at = self.order[np.minimum(np.searchsorted(self.uids, uids, sorter=self.order), len(self.uids) - 1)]
            return np.where(self.uids[at] == uids, at, -1)

        def answer(self) -> Iterator[tuple]:
            """What the queries find that have been put by."""
            if not self.asked:
                return
            uids, x = (np.concatenate(c) for c in zip(*self.asked))
            self.asked = []
            own = self.nodes(uids)
            for q, n in self.graph.pieces(x.astype(np.float32), threshold - MARGIN, self.width):
                sure = np.concatenate([np.einsum("ij,ij->i", x[q[k : k + SURE]], self.vectors[n[k : k + SURE]]) >= threshold for k in range(0, len(q), SURE)] or [np.empty(0, bool)]) & (n != own[q])
                q, n = q[sure], n[sure]
                order = np.argsort(q, kind="stable")
                q, n = q[order], n[order]
                heads = np.flatnonzero(np.diff(q, prepend=-1))
                for h, t in zip(heads, [*heads[1:], len(q)]):
                    uid = int(uids[q[h]])
                    yield 1, uid, int(self.many[n[h:t]].sum()), None, None
                    for a, b in self.forest.join(uid, n[h:t]):
                        yield 0, a, b, None, None

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [()] * 5
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=list(FOUND))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shard = None, Shard()
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            cuts = np.flatnonzero((np.diff(codes, axis=0) != 0).any(1)) + 1
            found: list[tuple] = []
            for a, z in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(a, z - a)
                if key != tuple(codes[a][:2]):
                    found += shard.answer()
                    key, shard = tuple(codes[a][:2]), Shard()
                role, own, x = codes[a][2], part.column(3).to_numpy(), unit(matrix(part.column(5)))
                if role == 0:
                    shard.uids.append(own)
                    shard.many.append(part.column(4).to_numpy())
                    shard.vectors.append(x)
                elif role == 1:
                    shard.sampled.append(own)
                    shard.sample.append(x)
                elif len(shard.vectors):
                    if shard.graph is None:
                        width, recall, telling = shard.ready()
                        if key[1] % parts == 0:  # the others have the same graph and audit
                            found.append((2, int(key[1]) // parts, width, recall, telling))
                    shard.asked.append((own, x))
                    if sum(len(own) for own, _ in shard.asked) >= shard.graph.many(shard.width):
                        found += shard.answer()
            yield rows(found)
        yield rows([*shard.answer()])

    return run


def audited_near_vectors(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", shards: int = SHARDS, shard_classes: int = SHARD_CLASSES, beam: int = BEAM
) -> tuple[DataFrame, DataFrame]:
    """The result of :func:`near_vectors`, and shard, beam, recall and queries of every shard's audit."""

    def make() -> DataFrame:
        rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        good = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
        rows = staged(rows.withColumn("good", good), "vectors")
        grouped = rows.filter("good").groupBy("vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("many"))
        classes = staged(grouped.withColumn("uid", F.monotonically_increasing_id()).withColumn("size", F.size("vector")), "classes")
        count, entries = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        n = max(shards, -(-count // shard_classes), -(-8 * entries // SHARD_BYTES))
        shard = F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
        sampled = F.pmod(F.xxhash64("uid", F.lit(17)), F.lit(max(1, count // SAMPLED))) == 0
        # where there are more cores than shards, the queries of a shard are dealt over tasks that each build its graph
        parts = max(1, min(-(-vectors.sparkSession.sparkContext.defaultParallelism // n), count // PART))
        own_part = F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(parts)).cast("int")
        every = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.struct((k * parts + own_part).alias("task"), F.lit(2).alias("role")))
        first = F.transform(F.sequence(F.lit(0), F.lit(n * parts - 1)), lambda k: F.struct(k.alias("task"), F.lit(1).alias("role")))
        held = classes.select("size", F.explode(F.sequence(shard * parts, shard * parts + (parts - 1))).alias("task"), F.lit(0).alias("role"), "uid", "many", "vector")
        asked = classes.select("size", F.inline(F.when(sampled, F.concat(first, every)).otherwise(every)), "uid", "many", "vector")
        dealt = held.union(asked).repartitionById(n * parts, F.col("task")).sortWithinPartitions("size", "task", "role", "uid")
        found = staged(dealt.mapInArrow(_search(threshold, beam, parts), "kind int, a long, b long, recall double, queries long"), "found")
        audits.append(kept(found.filter("kind = 2").select(F.col("a").cast("int").alias("shard"), F.col("b").alias("beam"), "recall", "queries"), "audits"))
        counts = found.filter("kind = 1").groupBy(F.col("a").alias("uid")).agg(F.sum("b").alias("found"))
        labels = components(found.filter("kind = 0").select("a", "b")).withColumnRenamed("node", "uid")
        known = classes.select("uid", "vector", "many", "least").join(labels, "uid", "left").join(counts, "uid", "left")
        known = staged(known.withColumn("label", F.coalesce("label", "uid")), "labels")
        least = known.groupBy("label").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_many"))
        placed = spread_join(known, least, "label", count, "_many").select("vector", "many", (F.col("many") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"), "component_id")
        linked = spread_join(rows.filter("good").select("id", "vector"), staged(placed, "members"), "vector", rows.count(), "many").select("id", "n_links", "component_id")
        alone = rows.filter(~F.col("good")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
        return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))

    audits: list[DataFrame] = []
    return cleared(vectors.sparkSession, "near-vectors", make), audits[0]


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", shards: int = SHARDS, shard_classes: int = SHARD_CLASSES, beam: int = BEAM) -> DataFrame:
    """Return id, n_links (other vectors linked directly), component_id (the least id reachable) and kept. The audits' recall goes to the log."""
    result, audits = audited_near_vectors(vectors, threshold, id_col, vector_col, shards, shard_classes, beam)
    seen = audits.agg(F.count(F.lit(1)).alias("n"), F.min("recall").alias("least"), F.max("beam").alias("beam")).first()
    LOG.info("audits of %s shards: recall %s at least, beams up to %s", seen["n"], seen["least"], seen["beam"])
    return result
