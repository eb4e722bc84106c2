"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Equal vectors are one node with a number of its own (the rows with the smallest
ids stand for it), so a vector that a third of all rows share costs one node. The graph starts with the best of
cells: so many times, nodes are dealt to the nearest of sampled vectors, twice over, and compared inside
their cell. It is then improved by rounds of NN-descent: every node brings
together some of its neighbours and of the nodes that it is a neighbour of, the
pairs among them (neighbours of neighbours) are measured, and each node keeps
the best ``K``. Vectors travel as 8-bit codes while the graph is built.

A query starts from its nearest pivots, and from its own node if the index has
its vector. Each hop takes the nodes of its beam that were not yet expanded
to their neighbours, measures those in double precision on the original
vectors, and keeps the best ones (the beam), until nothing in the beam is new.
The beam starts at ``BEAM`` and is doubled until the recall of ``PROBED``
queries, measured against all vectors, reaches ``AIM``. A wider beam goes on
from the nodes of the narrower one, all expanded once more, as it keeps neighbours that were cut before.

Nodes lie in blocks by number, queries in homes. What a block has to tell another one in a
step of a round or a hop is one row, a packet of packed columns; so Spark joins and shuffles
packets, and numpy works on whole blocks. A neighbour that is not nearer to a query
than the last of its full beam is not sent back.

Defined results: rows with a null id, and vectors that are null, empty, zero or
hold null or non-finite components, take no part, nor do vectors whose length
is not the most frequent one; a row is a candidate for every other row, also for
one with its id or vector, and repeated rows are queries of their own; ties go
to the smaller id; a query without candidates has no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType
from pyspark.sql.window import Window

from tidemark.llm.common import stored

#: Neighbours of a node in the graph.
K = 20
#: Neighbours, and reverse neighbours, of each of new and old that a node brings together in a round.
PART = 8
#: The start: so many times, one for each ``DEALT`` nodes within these bounds, nodes are dealt into cells of about ``CELL``
#: or less, in two steps: to sampled vectors, one for each ``COARSE`` nodes, and inside a task to vectors of that cell.
#: Several deals connect the cells of one.
LEAST_DEALS = 4
DEALS = 12
DEALT = 2048
CELL = 1024
COARSE = 4096
MOST_COARSE = 1024
#: A cell proposes so many of the nearest to each member, and a group of a round so many.
FIRST = 8
PROPOSED = 4
#: Rounds end when fewer than this share of all neighbours changed.
STILL = 0.002
#: The narrowest beam; it is doubled while the probed queries miss the recall aimed at.
BEAM = 320
PROBED = 256
AIM = 0.93
REACHED = 10
#: Nodes are numbered in so many groups.
GROUPS = 4096
#: Nodes of a block at least, and at most if there are more than ``BLOCKS`` blocks; queries of a home. Each block and home is a task.
BLOCK = 2048
BLOCKS = 72
MOST_NODES = 32768
HOME = 64
#: A hop that expands so many nodes or fewer, of all queries together, leaves the blocks where they are.
FEW = 1 << 16
#: Nodes that searches start from; queries are taken in blocks of this size, whose vectors are broadcast.
PIVOTS = 1024
STARTS = 8
QUERY_BLOCK = 8192

#: kind: which of a step's inputs a packet belongs to; parts: columns of numbers, as bytes.
SENT = "block int, kind int, parts array<binary>"
STATE, TOLD = 0, 1
#: Numbers of nodes are below this (a query and a node are one 64-bit number).
NODES = 1 << 46


@dataclass(frozen=True)
class Index:
    nodes: DataFrame  # node, ids (the smallest, each with the number of its rows), embedding
    packed: DataFrame  # by block: nodes, how many neighbours each has, the neighbours in both directions
    vectors: DataFrame  # by block: nodes, vectors
    width: int
    blocks: int
    dtype: str  # of the vectors

    @property
    def links(self) -> DataFrame:
        """node, near: array of nodes, both directions."""
        return self.packed.mapInArrow(_unpacked_links, "node long, near array<long>")


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("embedding")).filter("id is not null and embedding is not null")
    return rows.filter(F.forall("embedding", lambda x: F.coalesce(number(x), F.lit(False))) & F.exists("embedding", lambda x: F.coalesce(x != 0, F.lit(False))))


def _matrix(column, width: int):
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _coded(x):
    """8-bit codes with a scale for each vector, as rows of bytes."""
    import numpy as np

    scale = (np.abs(x).max(axis=1) / 127).astype("<f4")
    scale[scale == 0] = np.finfo("<f4").tiny
    return np.hstack([scale.view(np.uint8).reshape(-1, 4), np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8).view(np.uint8)])


def _decoded(raw):
    import numpy as np

    return raw[:, 4:].view(np.int8).astype(np.float32) * np.ascontiguousarray(raw[:, :4]).view("<f4")


def _distances(x, y):
    import numpy as np

    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T, 0))


def _table(packets: list):
    import pyarrow as pa

    block, kind, parts = zip(*packets) if packets else ((), (), ())
    return pa.table([pa.array(block, pa.int32()), pa.array(kind, pa.int32()), pa.array([[bytes(p) for p in x] for x in parts], pa.list_(pa.binary()))], names=["block", "kind", "parts"])


def _opened(table) -> dict[int, list]:
    """The parts of each packet, by kind, in an order that is the same in every run."""
    out = defaultdict(list)
    for kind, parts in zip(table.column("kind").to_pylist(), table.column("parts").to_pylist()):
        out[kind].append(parts)
    return {k: sorted(x) if len(x) > 1 else x for k, x in out.items()}


def _column(packets: list, at: int, dtype: str):
    import numpy as np

    return np.frombuffer(packets[0][at] if len(packets) == 1 else b"".join(p[at] for p in packets), dtype)


def _mailed(kind: int, to, blocks: int, *columns) -> Iterator[tuple]:
    """A packet for each block that has some of the nodes ``to``: their places in it, and the columns."""
    import numpy as np

    block = to % blocks
    order = np.argsort(block.astype(np.uint16) if blocks <= 1 << 16 else block, kind="stable")
    block, parts = block[order], [(to[order] // blocks).astype("<u4"), *(c[order] for c in columns)]
    cuts = np.flatnonzero(np.diff(block, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(block)]):
        yield int(block[a]), kind, [p[a:b].tobytes() for p in parts]


def _to(packets: list, block: int, blocks: int):
    import numpy as np

    return _column(packets, 0, "<u4").astype(np.int64) * blocks + block


def _each(step: Callable) -> Callable:
    """For mapInArrow: ``step(block, kind, parts)`` gives the packets that follow from a packet."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if out := list(step(row["block"], row["kind"], row["parts"])):
                    yield from _table(out).to_batches()

    return run


def _met(packets: DataFrame, step: Callable, tasks: int, numbered: bool = True) -> DataFrame:
    """``step(block, packets by kind)`` for each block; blocks are numbered from 0 to ``tasks``, or dealt to tasks by hash."""

    def run(table):
        return _table(list(step(table.column("block")[0].as_py(), _opened(table))))

    dealt = packets.repartitionById(tasks, F.col("block")) if numbered else packets.repartition(tasks, "block")
    return dealt.groupBy("block").applyInArrow(run, SENT)


def _met_there(stay: DataFrame, told: DataFrame, step: Callable) -> DataFrame:
    """As ``_met`` of both, for few packets ``told``: they are broadcast, so that what lies in ``stay`` is not shuffled."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if out := list(step(row["block"], {STATE: [row["parts"]], TOLD: sorted(row["told"])})):
                    yield from _table(out).to_batches()

    return stay.join(F.broadcast(told.groupBy("block").agg(F.collect_list("parts").alias("told"))), "block").select("block", "parts", "told").mapInArrow(run, SENT)


def _places(sorted_keys):
    """The place of each row among those with its key."""
    import numpy as np

    n = len(sorted_keys)
    first = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))) if n else np.zeros(0, int)
    return np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))


def _ranges(starts, counts):
    """The numbers from each start on, so many as counts."""
    import numpy as np

    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _shuffled(node, salt):
    """A hash of nodes, 44 bits."""
    import numpy as np

    return (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ salt) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(20)


def _code_packets(blocks: int, width: int, dtype: str):
    def run(batches: Iterator) -> Iterator:
        """Rows of (node, embedding): packets of codes and of vectors."""
        import numpy as np

        for batch in batches:
            if batch.num_rows:
                node, x = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
                raw = np.ascontiguousarray(x.astype(dtype)).view(np.uint8).reshape(len(x), -1)
                yield from _table([*_mailed(STATE, node, blocks, _coded(x)), *_mailed(TOLD, node, blocks, raw)]).to_batches()

    return run


def _laid(blocks: int):
    def step(block: int, got: dict) -> Iterator:
        """A packet of the nodes' codes and one of their vectors, in the order of the nodes."""
        import numpy as np

        for kind, packets in got.items():
            node = _to(packets, block, blocks)
            order = np.argsort(node)
            yield block, kind, [node[order].tobytes(), _column(packets, 1, "u1").reshape(len(node), -1)[order].tobytes()]

    return step


def _to_cells(sent):
    def step(block: int, kind: int, parts: list) -> Iterator:
        """The nodes of a block, dealt to the nearest sampled vector, deal after deal."""
        import numpy as np

        node = np.frombuffer(parts[0], np.int64)
        raw = np.frombuffer(parts[1], "u1").reshape(len(node), -1)
        x = _decoded(raw)
        for deal, centres in enumerate(sent.value):
            cell = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)
            for c in np.unique(cell):
                own = cell == c
                yield deal * MOST_COARSE + int(c), STATE, [node[own].tobytes(), raw[own].tobytes()]

    return step


def _cells(x, size: int, draw) -> Iterator:
    """Rows of ``x`` in cells of at most twice ``size``, each row in one."""
    import numpy as np

    todo = [np.arange(len(x))]
    while todo:
        some = todo.pop()
        if len(some) <= 2 * size:
            yield some
            continue
        c = min(64, -(-len(some) // size))
        centres = x[draw.choice(some, c, replace=False)]
        cell = ((centres * centres).sum(1) - 2 * x[some] @ centres.T).argmin(1)
        if np.bincount(cell).max() > 0.9 * len(some):
            cell = draw.permutation(len(some)) % c
        todo += [some[cell == j] for j in np.unique(cell)]


def _near_in_cells(blocks: int, size: int, top: int):
    def step(cell: int, got: dict) -> Iterator:
        """To each node of a cell its nearest in it."""
        import numpy as np

        node = _column(got[STATE], 0, "<i8")
        order = np.argsort(node)
        node, x = node[order], _decoded(_column(got[STATE], 1, "u1").reshape(len(node), -1)[order])
        out = []
        for some in _cells(x, size, np.random.default_rng(cell)):
            k = min(top, len(some) - 1)
            if k > 0:
                d = _distances(x[some], x[some])
                np.fill_diagonal(d, np.inf)
                at = np.argpartition(d, k - 1, axis=1)[:, :k]
                out.append((np.repeat(node[some], k), node[some][at].ravel(), np.take_along_axis(d, at, 1).ravel().astype("<f4")))
        if out:
            to, near, apart = (np.concatenate(c) for c in zip(*out))
            yield from _mailed(TOLD, to, blocks, near, apart)

    return step


def _picks(node, near, fresh, turn: int, part: int) -> list:
    """The neighbours that each node brings together in this round, as (places, which are some): ``part``
    new and ``part`` old ones, drawn by hash."""
    import numpy as np

    salt = (node.astype(np.uint64) + np.uint64(turn * 2654435761)) * np.uint64(0xC2B2AE3D27D4EB4F)
    draw = _shuffled(near, salt[:, None])
    out = []
    for wanted in (fresh, ~fresh & (near >= 0)):
        at = np.argsort(np.where(wanted, draw, np.uint64(1 << 63)), axis=1, kind="stable")[:, :part]
        out.append((at, np.take_along_axis(wanted, at, 1)))
    return out


def _graph(parts: list, k: int) -> tuple:
    import numpy as np

    node = np.frombuffer(parts[0], np.int64)
    n = len(node)
    return node, np.frombuffer(parts[1], "u1").reshape(n, -1), np.frombuffer(parts[2], "<i8").reshape(n, k), np.frombuffer(parts[3], "<f4").reshape(n, k), np.frombuffer(parts[4], "?").reshape(n, k)


def _members(k: int, turn: int, part: int, blocks: int):
    def step(block: int, kind: int, parts: list) -> Iterator:
        """Tells each picked neighbour whose neighbour it is, and the own block which were picked."""
        import numpy as np

        node, _, near, _, fresh = _graph(parts, k)
        own, member, new = [], [], []
        for is_new, (at, some) in zip((True, False), _picks(node, near, fresh, turn, part)):
            own.append(np.broadcast_to(node[:, None], at.shape)[some])
            member.append(np.take_along_axis(near, at, 1)[some])
            new.append(np.full(len(own[-1]), is_new))
        own, member, new = map(np.concatenate, (own, member, new))
        yield from _mailed(TOLD, member, blocks, own, new)
        yield from _mailed(STATE, own, blocks, member, new)

    return step


def _groups(turn: int, part: int, blocks: int):
    def step(block: int, got: dict) -> Iterator:
        """Asks the members of each group that has a new one: the picked neighbours, and ``part`` new and ``part`` old nodes that picked it."""
        import numpy as np

        group, member, new = [], [], []
        for kind, packets in got.items():
            g, m, f = _to(packets, block, blocks), _column(packets, 1, "<i8"), _column(packets, 2, "?")
            if kind == TOLD:
                key = g * 2 + f
                order = np.lexsort((m, _shuffled(m, np.uint64(turn * 0xC2B2AE3D27D4EB4F % (1 << 64))), key))
                order = order[_places(key[order]) < part]
                g, m, f = g[order], m[order], f[order]
            group.append(g), member.append(m), new.append(f)
        group, member, new = map(np.concatenate, (group, member, new))
        order = np.lexsort((~new, member, group))
        group, member, new = group[order], member[order], new[order]
        once = np.concatenate(([True], (group[1:] != group[:-1]) | (member[1:] != member[:-1]))) if len(group) else new
        group, member, new = group[once], member[once], new[once]
        awake = np.isin(group, np.unique(group[new]))
        yield from _mailed(TOLD, member[awake], blocks, group[awake], new[awake])

    return step


def _answers(k: int, blocks: int):
    def step(block: int, got: dict) -> Iterator:
        """Sends each group the codes of its members, and how far the last neighbour of each is."""
        import numpy as np

        if TOLD not in got:
            return
        node, raw, apart = (np.frombuffer(p, t) for p, t in zip(got[STATE][0], ("<i8", "u1", "<f4")))
        at = np.searchsorted(node, _to(got[TOLD], block, blocks))
        group, new = _column(got[TOLD], 1, "<i8"), _column(got[TOLD], 2, "?")
        yield from _mailed(TOLD, group, blocks, node[at], new, apart.reshape(len(node), k)[at, -1], raw.reshape(len(node), -1)[at])

    return step


def _join_locally(blocks: int, top: int, most: int):
    def step(block: int, got: dict) -> Iterator:
        """Pairs of a group with a new one that are nearer than what a member has."""
        import numpy as np

        group = _to(got[TOLD], block, blocks)
        member, new, worst = (_column(got[TOLD], c, t) for c, t in ((1, "<i8"), (2, "?"), (3, "<f4")))
        order = np.lexsort((member, group))
        group, member, new, worst = group[order], member[order], new[order], worst[order]
        raw = _column(got[TOLD], 4, "u1").reshape(len(order), -1)
        place, starts = _places(group), np.flatnonzero(np.diff(group, prepend=-1))
        row, ends = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(group)))), np.append(starts, len(group))
        out = []
        for first in range(0, len(starts), 512):
            a, b = ends[first], ends[min(first + 512, len(starts))]
            r, p, g = row[a:b] - first, place[a:b], min(512, len(starts) - first)
            x = _decoded(raw[order[a:b]])
            full = np.zeros((g, most, x.shape[1]), np.float32)
            full[r, p] = x
            fresh, here, limit = (np.zeros((g, most), t) for t in (bool, bool, np.float32))
            fresh[r, p], here[r, p], limit[r, p] = new[a:b], True, worst[a:b]
            square = (full * full).sum(2)
            d = square[:, :, None] + square[:, None, :] - 2 * full @ full.transpose(0, 2, 1)
            d[:, np.arange(most), np.arange(most)] = np.inf
            d[~((fresh[:, :, None] | fresh[:, None, :]) & here[:, None, :])] = np.inf
            k = min(top, most - 1)
            at = np.argpartition(d, k - 1, axis=2)[:, :, :k]
            near = np.sqrt(np.maximum(np.take_along_axis(d, at, 2), 0))
            fine = (near < limit[:, :, None]) & here[:, :, None]
            names = np.zeros((g, most), np.int64)
            names[r, p] = member[a:b]
            i, j, _ = np.nonzero(fine)
            out.append((names[i, j], names[i, at[fine]], near[fine].astype("<f4")))
        to, near, apart = (np.concatenate(c) for c in zip(*out))
        yield from _mailed(TOLD, to, blocks, near, apart)

    return step


def _merge(k: int, blocks: int, turn: int | None, part: int):
    def step(block: int, got: dict) -> Iterator:
        """The k best of each node's neighbours and what was proposed; those that the round brought together count as old."""
        import numpy as np

        if turn is None:
            node = np.frombuffer(got[STATE][0][0], np.int64)
            raw = got[STATE][0][1]
            near, apart, fresh = (np.full((len(node), k), v, t) for v, t in ((-1, np.int64), (np.inf, np.float32), (False, bool)))
        else:
            node, raw, near, apart, fresh = _graph(got[STATE][0], k)
            at, some = _picks(node, near, fresh, turn, part)[0]
            fresh = fresh.copy()
            r, c = np.nonzero(some)
            fresh[r, at[r, c]] = False
        r, c = np.nonzero(near >= 0)
        rows, ids, far, new = [r], [near[r, c]], [apart[r, c]], [fresh[r, c]]
        if TOLD in got:
            rows.append(np.searchsorted(node, _to(got[TOLD], block, blocks)))
            ids.append(_column(got[TOLD], 1, "<i8")), far.append(_column(got[TOLD], 2, "<f4"))
            new.append(np.ones(len(ids[-1]), bool))
        rows, ids, far, new = map(np.concatenate, (rows, ids, far, new))
        # of equal ids an old one stays old: it comes first, and the sort is stable
        key = rows * NODES + ids
        order = np.argsort(key, kind="stable")
        order = order[np.diff(key[order], prepend=-1) != 0]
        order = order[np.lexsort((ids[order], far[order], rows[order]))]
        place = _places(rows[order])
        order, place = order[place < k], place[place < k]
        near, apart, fresh = (np.full((len(node), k), v, t) for v, t in ((-1, np.int64), (np.inf, np.float32), (False, bool)))
        at = rows[order], place
        near[at], apart[at], fresh[at] = ids[order], far[order], new[order]
        yield block, STATE, [p if isinstance(p, bytes) else p.tobytes() for p in (node, raw, near, apart, fresh, fresh.sum(dtype=np.int64))]

    return step


def _back(k: int, blocks: int):
    def step(block: int, kind: int, parts: list) -> Iterator:
        """Tells each neighbour whose neighbour it is."""
        import numpy as np

        node, _, near, apart, _ = _graph(parts, k)
        r, c = np.nonzero(near >= 0)
        yield from _mailed(TOLD, near[r, c], blocks, node[r], apart[r, c])

    return step


def _linked(k: int, blocks: int):
    def step(block: int, got: dict) -> Iterator:
        """The neighbours in both directions; back links of a hub are cut to its nearest, the forward link of the other end stays."""
        import numpy as np

        node, near = np.frombuffer(got[STATE][0][0], np.int64), np.frombuffer(got[STATE][0][1], np.int64).reshape(-1, k)
        r, c = np.nonzero(near >= 0)
        rows, ids = [r], [near[r, c]]
        if TOLD in got:
            to, back, far = np.searchsorted(node, _to(got[TOLD], block, blocks)), _column(got[TOLD], 1, "<i8"), _column(got[TOLD], 2, "<f4")
            order = np.lexsort((back, far, to))
            order = order[_places(to[order]) < 2 * k]
            rows.append(to[order]), ids.append(back[order])
        key = np.unique(np.concatenate(rows) * NODES + np.concatenate(ids))
        yield block, STATE, [node.tobytes(), np.bincount(key // NODES, minlength=len(node)).tobytes(), (key % NODES).tobytes()]

    return step


def _unpacked_links(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for node, counts, near in batch.column("parts").to_pylist():
            ends = np.cumsum(np.frombuffer(counts, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(np.frombuffer(near, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(node, np.int64)), lists], names=["node", "near"])


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int | None = None, found: int = REACHED) -> Index:
    import numpy as np

    rows = _valid(vectors, id_col, vector_col)
    top = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = top["n"] if top else 0
    each = rows.filter(F.size("embedding") == width).groupBy("id", "embedding").agg(F.count("*").alias("times"))
    # the smallest ids of each vector; cut before the shuffle, so no vector's ids gather in a task
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("id"))
    few = each.withColumn("rank", rank).filter(F.col("rank") <= found + 1)
    nodes = few.groupBy("embedding").agg(F.array_sort(F.collect_list(F.struct("id", "times"))).alias("ids"))
    group = F.pmod(F.xxhash64("embedding"), F.lit(GROUPS))
    place = F.row_number().over(Window.partitionBy("group").orderBy(F.xxhash64("embedding"), "embedding"))
    nodes = nodes.withColumn("group", group).select((place.cast("long") * GROUPS + F.col("group")).alias("node"), "ids", "embedding")
    nodes = stored(nodes.repartition("node"), "nodes")
    n = nodes.count()
    blocks = max(1, min(n // BLOCK, BLOCKS), -(-n // MOST_NODES))
    dtype = "<f4" if isinstance(nodes.schema["embedding"].dataType.elementType, FloatType) else "<f8"

    packets = nodes.select("node", "embedding").mapInArrow(_code_packets(blocks, width, dtype), SENT)
    laid = stored(_met(packets, _laid(blocks), blocks), "laid", 1)
    codes, vectors = laid.filter(F.col("kind") == STATE), laid.filter(F.col("kind") == TOLD).withColumn("kind", F.lit(STATE))

    deals, coarse = max(LEAST_DEALS, min(DEALS, n // DEALT)), max(1, min(MOST_COARSE, n // COARSE))
    sample = nodes.select("node", "embedding").orderBy(F.xxhash64("node", F.lit(11))).limit(deals * coarse).collect()
    centres = [np.array([r["embedding"] for r in sample[d::deals]], np.float32) for d in range(min(deals, len(sample)))]
    sent = nodes.sparkSession.sparkContext.broadcast(centres)
    size = max(32, min(CELL, n // 32))
    first = _met(codes.mapInArrow(_each(_to_cells(sent)), SENT), _near_in_cells(blocks, size, min(k, FIRST)), max(blocks, deals), False)
    graph = stored(_met(codes.union(first), _merge(k, blocks, None, PART), blocks), "graph", 1)
    parts = F.col("parts")
    for turn in count() if rounds is None else range(rounds):
        member = graph.mapInArrow(_each(_members(k, turn, PART, blocks)), SENT)
        asked = _met(member, _groups(turn, PART, blocks), blocks)
        known = graph.select("block", "kind", F.array(parts[0], parts[1], parts[3]).alias("parts"))
        group = _met(known.union(asked), _answers(k, blocks), blocks)
        better = _met(group, _join_locally(blocks, PROPOSED, 4 * PART), blocks)
        graph = stored(_met(graph.union(better), _merge(k, blocks, turn, PART), blocks), "graph", 1)
        changed = sum(int.from_bytes(r[0], "little") for r in graph.select(parts[5]).collect())
        if changed <= STILL * k * n:
            break
    near = graph.select("block", "kind", F.array(parts[0], parts[2]).alias("parts"))
    links = stored(_met(near.union(graph.mapInArrow(_each(_back(k, blocks)), SENT)), _linked(k, blocks), blocks), "links", 1)
    return Index(nodes, links, vectors, width, blocks, dtype)


def _blocks(queries: DataFrame) -> Iterator[list]:
    """The queries in the order of a hash; the first block holds those that are probed."""
    block, full = [], PROBED
    for r in queries.orderBy(F.xxhash64("query"), "query").toLocalIterator():
        block.append(r)
        if len(block) >= full:
            yield block
            block, full = [], QUERY_BLOCK
    if block:
        yield block


def _exact(x, q):
    import numpy as np

    return np.sqrt(((x - q) ** 2).sum(axis=1))


def _measure(sent, bounds, dtype: str, blocks: int, homes: int):
    def step(block: int, got: dict) -> Iterator:
        """The exact distance of each query to the nodes that it came to, if it isn't above the query's bound."""
        import numpy as np

        if TOLD not in got:
            return
        node = np.frombuffer(got[STATE][0][0], np.int64)
        x = np.frombuffer(got[STATE][0][1], dtype).reshape(len(node), -1)
        queries, bound = sent.value, bounds.value
        reach, q_square, out = bound * bound, (queries * queries).sum(1), []
        came = np.zeros(len(node) * len(queries), bool)
        for packet in got[TOLD]:
            came[np.searchsorted(node, _to([packet], block, blocks)) * len(queries) + _column([packet], 1, "<i4")] = True
        span = max(1, (1 << 22) // len(queries))
        for k in range(0, len(node), span):
            own, asked = x[k : k + span].astype(np.float64), came[k * len(queries) : (k + span) * len(queries)]
            if np.count_nonzero(asked) * 24 > len(asked):  # dense: a product tells the near ones, with room for its rounding
                square = (own * own).sum(1)
                with np.errstate(over="ignore", invalid="ignore"):
                    far = square[:, None] + q_square - 2 * own @ queries.T > reach + 1e-9 * (square[:, None] + q_square + reach)
                asked[far.ravel()] = False
            i, j = np.divmod(np.flatnonzero(asked), len(queries))
            for c in range(0, len(i), 1 << 15):
                ii, jj = i[c : c + (1 << 15)], j[c : c + (1 << 15)]
                d = _exact(own[ii], queries[jj])
                near = d <= bound[jj]
                out.append((jj[near], node[k + ii[near]], d[near]))
        q, node, apart = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        yield from _mailed(TOLD, q, homes, node, apart)

    return step


def _expand(blocks: int):
    def step(block: int, got: dict) -> Iterator:
        """Takes each query from the nodes that it expands to their neighbours."""
        import numpy as np

        if TOLD not in got:
            return
        node, counts, near = (np.frombuffer(p, np.int64) for p in got[STATE][0])
        at, q = np.searchsorted(node, _to(got[TOLD], block, blocks)), _column(got[TOLD], 1, "<i4")
        order = np.argsort(at, kind="stable")
        at, q = at[order], q[order]
        starts, each = np.cumsum(counts) - counts, counts[at]
        for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(np.cumsum(each) >> 21)) + 1):
            yield from _mailed(TOLD, near[_ranges(starts[at[part]], each[part])], blocks, np.repeat(q[part], each[part]))

    return step


def _frontier(blocks: int, again: bool):
    def step(home: int, kind: int, parts: list) -> Iterator:
        """The nodes of the beams that are not yet expanded, or all."""
        import numpy as np

        q, node, done = (np.frombuffer(parts[c], t) for c, t in ((0, "<i4"), (1, "<i8"), (3, "?")))
        todo = np.full(len(q), True) if again else ~done
        yield from _mailed(TOLD, node[todo], blocks, q[todo])

    return step


def _keep(beam: int, homes: int):
    def step(home: int, got: dict) -> Iterator:
        """The ``beam`` nearest nodes of each query; what it had before is expanded."""
        import numpy as np

        q, node, apart, done = [], [], [], []
        if STATE in got:
            for c, t, to in ((0, "<i4", q), (1, "<i8", node), (2, "<f8", apart)):
                to.append(np.frombuffer(got[STATE][0][c], t).astype(np.int64 if c < 2 else float))
            done.append(np.ones(len(q[0]), bool))
        if TOLD in got:
            q.append(_to(got[TOLD], home, homes)), node.append(_column(got[TOLD], 1, "<i8")), apart.append(_column(got[TOLD], 2, "<f8"))
            done.append(np.zeros(len(q[-1]), bool))
        q, node, apart, done = map(np.concatenate, (q, node, apart, done))
        key = q * NODES + node
        order = np.argsort(key, kind="stable")
        order = order[np.diff(key[order], prepend=-1) != 0]
        order = order[np.lexsort((node[order], apart[order], q[order]))]
        place = _places(q[order])
        order, place = order[place < beam], place[place < beam]
        q, node, apart, done = q[order], node[order], apart[order], done[order]
        last = place == beam - 1
        yield home, STATE, [q.astype("<i4").tobytes(), node.tobytes(), apart.tobytes(), done.tobytes(), q[last].astype("<i4").tobytes(), apart[last].tobytes(), int((~done).sum()).to_bytes(8, "little")]

    return step


def _reach(index: Index, block: list, sent, found: int) -> DataFrame:
    """(q, reach, others): by brute force over all nodes, the distance of the
    ``found``-th nearest other node of each query, and how many that are."""

    width, ids = index.width, [r["node"] for r in block]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = np.array([-1 if i is None else i for i in ids])
        known = np.array([i is not None for i in ids])
        for batch in batches:
            for k in range(0, len(batch), 1 << 12):
                part = batch.slice(k, 1 << 12)
                d = _distances(sent.value, _matrix(part.column(1), width))
                d[known[:, None] & (own[:, None] == part.column(0).to_numpy())] = np.inf
                top = min(found, d.shape[1])
                near = np.partition(d, top - 1, axis=1)[:, :top]
                at, col = np.nonzero(near < np.inf)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(near[at, col])], names=["q", "reach"])

    near = index.nodes.select("node", "embedding").mapInArrow(run, "q int, reach double")
    place = F.row_number().over(Window.partitionBy("q").orderBy("reach"))
    return stored(near.withColumn("place", place).filter(F.col("place") <= found).groupBy("q").agg(F.max("reach").alias("reach"), F.count("*").alias("others")), "reach")


def _nearest(kept: DataFrame, most: int) -> DataFrame:
    """(q, node, apart): of each query the ``most`` nearest nodes, and those tied with the last."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for parts in batch.column("parts").to_pylist():
                q, node, apart = (np.frombuffer(p, t) for p, t in zip(parts, ("<i4", "<i8", "<f8")))
                place = _places(q)
                last = apart[np.maximum.accumulate(np.where(place < most, np.arange(len(q)), 0))]
                near = (place < most) | (apart == last)
                yield pa.RecordBatch.from_arrays([pa.array(q[near]), pa.array(node[near]), pa.array(apart[near])], names=["q", "node", "apart"])

    return kept.mapInArrow(run, "q int, node long, apart double")


def _recall(kept: DataFrame, reach: DataFrame, block: list, found: int) -> float:
    """The share of the nearest other nodes that a search has kept."""
    own = kept.sparkSession.createDataFrame([(j, r["node"]) for j, r in enumerate(block)], "q int, own long")
    near = F.coalesce(F.col("node") != F.col("own"), F.lit(True)) & (F.col("apart") <= F.col("reach") + 1e-6 * F.col("reach"))
    hits = _nearest(kept, found + 1).join(reach, "q").join(own, "q").filter(near).groupBy("q").agg(F.count("*").alias("hits"))
    share = reach.join(hits, "q", "left").agg(F.sum(F.least(F.coalesce("hits", F.lit(0)), "others")), F.sum("others")).first()
    return share[0] / share[1] if share[1] else 1.0


def _walk(index: Index, start: list | DataFrame, sent, beam: int) -> DataFrame:
    """The beam of each query, by home, when nothing in it is new; ``start`` is (query, node) pairs, or the narrower beams to go on from."""
    import numpy as np

    spark, asked = index.nodes.sparkSession, len(sent.value)
    homes = max(1, min(asked // HOME, BLOCKS) if asked > 16 * HOME else asked // 16)
    kept, bound, again, todo = None, np.full(asked, np.inf), True, 0
    met = lambda stay, told, step: _met_there(stay, told, step) if todo <= FEW else _met(stay.union(told), step, index.blocks)
    if isinstance(start, DataFrame):
        kept, todo = start, asked * beam
    else:
        pairs = np.array(start, np.int64).reshape(-1, 2)
        told = spark.createDataFrame([(b, k, [bytearray(p) for p in parts]) for b, k, parts in _mailed(TOLD, pairs[:, 1], index.blocks, pairs[:, 0].astype("<i4"))], SENT)
        todo = len(pairs)
    while True:
        if kept is not None:
            told = met(index.packed, kept.mapInArrow(_each(_frontier(index.blocks, again)), SENT), _expand(index.blocks))
        again = False
        bounds = spark.sparkContext.broadcast(bound)
        near = met(index.vectors, told, _measure(sent, bounds, index.dtype, index.blocks, homes))
        kept = stored(_met(near if kept is None else kept.union(near), _keep(beam, homes), homes), "beam", 1)
        todo, bound = 0, np.full(asked, np.inf)
        for q, apart, new in kept.select(*[F.col("parts")[c] for c in (4, 5, 6)]).collect():
            bound[np.frombuffer(q, "<i4")] = np.frombuffer(apart, "<f8")
            todo += int.from_bytes(new, "little")
        if not todo:
            return kept


def nearest_nodes(index: Index, queries: DataFrame, beam: int = BEAM, found: int = REACHED, aim: float = AIM) -> DataFrame:
    """(query, node, apart): for each row of queries(query, embedding) its
    ``found`` + 1 nearest nodes, its own included, and those tied with the last."""
    import numpy as np

    spark = index.nodes.sparkSession
    out = spark.createDataFrame([], "query long, node long, apart double")
    if not index.width:
        return out
    pivots = index.nodes.select("node", "embedding").orderBy(F.xxhash64("node", F.lit(7))).limit(PIVOTS).collect()
    at = np.array([p["embedding"] for p in pivots], float)
    nodes = index.nodes.count()
    narrow = beam = max(beam, found + 1)
    for number, block in enumerate(_blocks(queries)):
        x = np.array([r["embedding"] for r in block], float)
        sent = spark.sparkContext.broadcast(x)
        start = [(j, pivots[p]["node"]) for j, d in enumerate(_distances(x, at)) for p in np.argsort(d)[:STARTS].tolist()]
        start += [(j, r["node"]) for j, r in enumerate(block) if r["node"] is not None]
        kept = _walk(index, start, sent, narrow)
        if not number:
            reach = _reach(index, block, sent, found)
            while beam < nodes and _recall(kept, reach, block, found) < aim:
                beam *= 2
                kept = _walk(index, kept, sent, beam)
        elif beam > narrow:
            kept = _walk(index, kept, sent, beam)
        names = spark.createDataFrame([(j, r["query"]) for j, r in enumerate(block)], "q int, query long")
        out = out.union(stored(_nearest(kept, found + 1).join(names, "q").select("query", "node", "apart"), "found"))
    return out


def search(vectors: DataFrame, every: int = 100, found: int = REACHED, beam: int = BEAM, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``found`` nearest of each row whose
    id is divisible by ``every`` among all other rows."""
    index = build(vectors, id_col, vector_col, found=found)
    asked = _valid(vectors, id_col, vector_col).filter((F.pmod("id", F.lit(every)) == 0) & (F.size("embedding") == index.width))
    asked = asked.groupBy("id", "embedding").agg(F.count("*").cast("int").alias("asked"))
    asked = stored(asked.join(index.nodes.select("node", "embedding"), "embedding").select("id", "node", "asked"), "asked")
    # equal queries are searched once
    nodes = asked.select("node").distinct().join(index.nodes.select("node", "embedding"), "node").select(F.col("node").alias("query"), "node", "embedding")
    near = nearest_nodes(index, nodes, beam, found).join(index.nodes.select("node", "ids"), "node").select("query", (F.col("query") == F.col("node")).alias("own"), "apart", F.inline("ids"))
    near = near.withColumnRenamed("id", "vec_id")
    best = near.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("apart", "vec_id"))).filter(F.col("place") <= found + 1)
    rows = asked.join(best.withColumnRenamed("query", "node"), "node")
    # a row is no candidate of its own; others with its id are
    copies = F.least(F.col("times") - (F.col("own") & (F.col("vec_id") == F.col("id"))).cast("long"), F.lit(found)).cast("int")
    rows = rows.withColumn("copies", copies).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rank = F.row_number().over(Window.partitionBy("id", "node").orderBy("apart", "vec_id", "copy"))
    rows = rows.withColumn("rank", rank).filter(F.col("rank") <= found).withColumn("of", F.explode(F.sequence(F.lit(1), F.col("asked"))))
    return rows.select(F.col("id").alias("query_id"), "rank", "vec_id", F.col("apart").alias("score"))
