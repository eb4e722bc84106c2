"""Repeated passages by suffix sorting: every byte under a string of LENGTH
bytes that starts in two places or more.

Suffixes that agree in LENGTH bytes must meet, and most suffixes agree with
none. So they are dealt by content: the anchor of a window of LENGTH bytes is
its GRAM bytes of the smallest hash (the leftmost of them). Equal windows have
equal anchors at the same place, and neighbouring windows share an anchor, so a
document becomes runs of windows, about one for every (LENGTH - GRAM) / 2 bytes.

1. Documents are packed into blocks, with their runs. Anchors are counted over
   all blocks; a run whose anchor is found once holds no repeat and goes.
2. An anchor with over HOT runs (a passage that very many documents share) is not
   sent to one task: its runs are split into single windows, dealt by their own
   hash, equal ones of a block as one. They are counted the same way.
3. What is left of the runs is sent, as bytes, to the bucket of its key. There
   equal runs are joined, and the suffixes of different runs of one anchor are
   sorted: multikey quicksort, eight bytes at a time, to a SHALLOW depth, then
   each group with a longer common prefix is put in a blind trie (branching
   by critical bits; a suffix goes down blindly, is compared with the one leaf it
   meets, and branches where they first differ). A leaf that agrees in LENGTH
   bytes is a repeat. Hashes only deal the work; bytes decide.
4. The windows found are marked in their blocks, and the bytes below them go.

No text leaves its block but the runs of repeated anchors. Each step is stored, so a lost executor costs one step.

Defined results: a null or empty text has no bytes and no spans; texts shorter
than LENGTH have none either; rows are separate documents even if id and text
are equal (so such texts repeat); kept bytes may end inside a character, so they are binary;
an empty table gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored
from tidemark.llm.packed import bits_for, bucket_cuts, pack, rows, tally, unpack, unpacked_levels

LENGTH = 200
GRAM = 64
#: An anchor with more runs than this is dealt window by window.
HOT = 1024
#: Bytes that the quicksort looks at before the tries take over.
SHALLOW = 16
#: A block is closed once it has so many bytes; a bucket gets the runs of about so many bytes of text.
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
SEGMENT = 1 << 16
#: Suffixes sorted at a time; the suffixes of one anchor stay together.
AT_ONCE = 1 << 18


# ---------------------------------------------------------------- runs of windows
@cache
def _powers(n: int):
    import numpy as np

    base = 0x9E3779B97F4A7C15
    up = np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)
    down = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64), dtype=np.uint64)
    return up, down, np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64)


def _sliding_min(x, w: int):
    import numpy as np

    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    cells = padded.reshape(-1, w)
    left = np.minimum.accumulate(cells, axis=1).ravel()
    right = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def runs(buf, ends, length: int, gram: int):
    """(first, last, key) of the runs of window starts in ``buf`` whose windows
    have one anchor; no window crosses one of the documents' ``ends``."""
    import numpy as np

    from tidemark.llm.packed import mixed

    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    n, w = len(buf) - length + 1, length - gram + 1
    if n <= 0:
        return none
    crossed = np.zeros(len(buf) + 1, np.int32)
    np.add.at(crossed, np.maximum(ends - length + 1, 0), 1)
    np.add.at(crossed, ends, -1)
    inside = np.cumsum(crossed)[:n] == 0
    up, down, table = _powers(SEGMENT + length)
    low, out = np.uint64((1 << 24) - 1), [none]
    for s in range(0, n, SEGMENT):
        e = min(s + SEGMENT, n)
        ok = inside[s:e]
        if not ok.any():
            continue
        part = table[buf[s : e + length - 1]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)], dtype=np.uint64)])
        grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1])
        owner = _sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), w) & low
        other = np.concatenate([[True], (owner[1:] != owner[:-1]) | ~ok[:-1]])
        first = np.flatnonzero(ok & other)
        last = np.flatnonzero(ok & np.concatenate([other[1:] | ~ok[1:], [True]]))
        # an anchor's hash is a smallest one: mixed once more, so that keys are spread evenly
        out.append((first + s, last + s, mixed(grams[owner[first].astype(np.int64)])))
    return tuple(np.concatenate(x) for x in zip(*out))


def _blocks(length: int, gram: int, block_bytes: int, id_type):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32

        def block():
            sizes = np.array([len(t) for t in texts], np.int64)
            text = b"".join(texts)
            first, last, key = runs(np.frombuffer(text, np.uint8), np.cumsum(sizes), length, gram)
            order = np.argsort(key, kind="stable")
            keys, times = np.unique(key, return_counts=True)
            row = (number, ids, len(text), pack(sizes), zstandard.compress(text, 3), pack(first[order].astype(np.uint32)),
                   pack((last - first)[order].astype(np.uint32)), pack(key[order]), pack(keys), pack(times.astype(np.uint32)))
            types = (pa.int64(), pa.list_(id_type), pa.int64(), *[pa.binary()] * 7)
            names = ["block", "ids", "bytes", "sizes", "text", "first", "more", "key", "keys", "times"]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names)

        ids, texts, total = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                texts.append((text.as_py() or "").encode())
                ids.append(doc_id)
                total += len(texts[-1])
                if total >= block_bytes or len(ids) >= 1 << 16:
                    yield block()
                    number += 1
                    ids, texts, total = [], [], 0
        if ids:
            yield block()

    return run


# ---------------------------------------------------------------- what is left of a block
def _text(row: dict) -> bytes:
    import zstandard

    return zstandard.decompress(row["text"])


def _of_level(row: dict, levels, wanted: int):
    """(first, last, key) of the runs whose anchor has this level, by key."""
    import numpy as np

    key = unpack(row["key"], np.uint64)
    pick = np.flatnonzero((levels[np.searchsorted(unpack(row["keys"], np.uint64), key)] if len(key) else levels[:0]) == wanted)
    first = unpack(row["first"], np.uint32)[pick].astype(np.int64)
    return first, first + unpack(row["more"], np.uint32)[pick], key[pick]


def _single_windows(row: dict, text: bytes, length: int):
    """(start, key) of the windows of hot runs, by key."""
    import numpy as np
    import xxhash

    first, last, _ = _of_level(row, unpacked_levels(row["levels"]), 2)
    sizes = last - first + 1
    at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    key = np.array([xxhash.xxh3_64_intdigest(text[p : p + length]) for p in at.tolist()], np.uint64)
    order = np.argsort(key, kind="stable")
    return at[order], key[order]


def _windows(length: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for row in rows(batches):
            _, key = _single_windows(row, _text(row), length)
            if len(key):
                keys, times = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((row["block"], pack(keys), pack(times.astype(np.uint32))),
                                                 (pa.int64(), pa.binary(), pa.binary()))], names=["block", "keys", "times"])

    return run


def _classes(row: dict, text: bytes, length: int):
    """The different runs left in a block and where they are: (text, key, class) by
    key of the class, and (first, class) of every run. A function of the row alone."""
    import numpy as np

    found = [_of_level(row, unpacked_levels(row["levels"]), 1)]
    if row.get("window_levels"):
        at, key = _single_windows(row, text, length)
        _, place = np.unique(key, return_inverse=True)
        pick = unpacked_levels(row["window_levels"])[place] > 0
        found.append((at[pick], at[pick], key[pick]))
    first, last, key = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(key, kind="stable")
    first, last, key = first[order], last[order], key[order]
    known: dict[bytes, int] = {}
    place = np.fromiter((known.setdefault(text[a : b + length], len(known)) for a, b in zip(first.tolist(), last.tolist())), np.int64, len(first))
    _, one = np.unique(place, return_index=True)
    return list(known), key[one], np.bincount(place, minlength=len(known)), first, place


def _contexts(length: int, bits: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard

        for row in rows(batches):
            texts, key, times, _, _ = _classes(row, _text(row), length)
            cuts = bucket_cuts(key, bits)
            parts = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[b], cuts[b + 1])
                sizes = np.array([len(t) for t in texts[own]], np.uint32)
                parts.append((b, row["block"], pack(key[own]), pack(sizes), pack((times[own] > 1).astype(np.uint8)), zstandard.compress(b"".join(texts[own]), 3)))
            if parts:
                types = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts), types)], names=["bucket", "block", "key", "sizes", "many", "text"])

    return run


# ---------------------------------------------------------------- deep-shallow sorting
def _bit_length(x):
    """Of 64-bit numbers other than zero."""
    import numpy as np

    high = (x >> np.uint64(32)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp((x & np.uint64(0xFFFFFFFF)).astype(np.float64))[1])


def repeated(buf, starts, group, length: int, shallow: int = SHALLOW):
    """Which of the suffixes at ``starts`` agree in ``length`` bytes with another
    one of their ``group``. ``length`` is a multiple of eight."""
    import numpy as np

    found = np.zeros(len(starts), bool)
    words = np.lib.stride_tricks.as_strided(np.concatenate([buf, np.zeros(8, np.uint8)]), (len(buf), 8), (1, 1))
    words = np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64)
    # multikey quicksort on characters of eight bytes: groups part until they are single or share the shallow prefix
    order = np.argsort(group, kind="stable")
    label = group[order]
    for depth in range(0, shallow, 8):
        letter = words[starts[order] + depth]
        by = np.lexsort((letter, label))
        order, letter, label = order[by], letter[by], label[by]
        new = np.concatenate([[True], (label[1:] != label[:-1]) | (letter[1:] != letter[:-1])]) if len(order) else np.empty(0, bool)
        label = np.cumsum(new) - 1
        stay = np.bincount(label)[label] > 1 if len(label) else new
        order, label = order[stay], label[stay]
    if not len(order):
        return found
    # blind tries, one for each group, all at once: the k-th suffix of every group in step k
    new = np.concatenate([[True], label[1:] != label[:-1]])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(order)))
    by_size = np.argsort(-size, kind="stable")
    head, size = head[by_size], size[by_size]
    at = starts[order]
    root = ~head  # a reference: a branch, or ~ the place of a leaf
    kids, crit = np.zeros((len(order), 2), np.int64), np.zeros(len(order), np.int64)
    branches = 0
    dup = np.zeros(len(order), bool)
    bit = lambda x, c: ((words[at[x] + (c >> 6 << 3)] >> (63 - (c & 63)).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
    for k in range(1, int(size[0])):
        m = int(np.searchsorted(-size, -k))  # groups with more than k suffixes come first
        x, ref = head[:m] + k, root[:m].copy()
        on = np.flatnonzero(ref >= 0)
        while len(on):
            ref[on] = kids[ref[on], bit(x[on], crit[ref[on]])]
            on = on[ref[on] >= 0]
        leaf = ~ref
        first = np.full(m, -1, np.int64)  # the first bit that differs
        on = np.arange(m)
        for depth in range(shallow, length, 8):
            differ = words[at[x[on]] + depth] ^ words[at[leaf[on]] + depth]
            hit = differ != 0
            first[on[hit]] = depth * 8 + 64 - _bit_length(differ[hit])
            on = on[~hit]
            if not len(on):
                break
        same = first < 0
        dup[x[same]] = dup[leaf[same]] = True
        own = np.flatnonzero(~same)
        x, c, ref = x[own], first[own], root[own].copy()
        above, side = np.full(len(own), -1, np.int64), np.zeros(len(own), np.int64)
        on = np.flatnonzero((ref >= 0) & (crit[np.maximum(ref, 0)] < c))
        while len(on):
            above[on], side[on] = ref[on], bit(x[on], crit[ref[on]])
            ref[on] = kids[above[on], side[on]]
            on = on[(ref[on] >= 0) & (crit[np.maximum(ref[on], 0)] < c[on])]
        node = branches + np.arange(len(own))
        branches += len(own)
        mine = bit(x, c)
        crit[node] = c
        kids[node, mine], kids[node, 1 - mine] = ~x, ref
        top = above < 0
        root[own[top]] = node[top]
        kids[above[~top], side[~top]] = node[~top]
    found[order] = dup
    return found


def _sort(length: int, at_once: int):
    def run(table):
        import numpy as np
        import pyarrow as pa
        import zstandard

        known: dict[bytes, int] = {}
        keys, many, places = [], [], []
        for k in range(table.num_rows):
            row = table.slice(k, 1).to_pylist()[0]
            ends = np.cumsum(unpack(row["sizes"], np.uint32), dtype=np.int64).tolist()
            text = zstandard.decompress(row["text"])
            places.append(np.fromiter((known.setdefault(text[a:b], len(known)) for a, b in zip([0, *ends], ends)), np.int64, len(ends)))
            keys.append(unpack(row["key"], np.uint64))
            many.append(unpack(row["many"], np.uint8))
        texts, place = list(known), np.concatenate(places)
        del known
        _, one = np.unique(place, return_index=True)
        key = np.concatenate(keys)[one]
        often = np.bincount(place, weights=1.0 + np.concatenate(many)) > 1  # the whole run is there again
        windows = np.array([len(t) - length + 1 for t in texts], np.int64)
        offset = np.cumsum(windows) - windows
        dup = np.repeat(often, windows)
        # runs of an anchor that differ may still share windows
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        label = np.cumsum(new) - 1
        several = np.bincount(label)[label] > 1
        order, label = order[several], label[several]
        part = np.cumsum(windows[order]) // at_once
        cuts = [0, *(k for k in (np.flatnonzero(np.diff(part)) + 1).tolist()), len(order)]
        for k in range(1, len(cuts) - 1):  # the suffixes of one anchor stay together
            while cuts[k] < len(order) and label[cuts[k]] == label[cuts[k] - 1]:
                cuts[k] += 1
        cuts = np.maximum.accumulate(cuts)
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            runs_here = order[a:b]
            buf = np.frombuffer(b"".join(texts[r] for r in runs_here.tolist()), np.uint8)
            sizes = windows[runs_here]
            begin = np.cumsum(sizes + length - 1) - (sizes + length - 1)
            within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit = repeated(buf, np.repeat(begin, sizes) + within, np.repeat(label[a:b], sizes), length)
            dup[(np.repeat(offset[runs_here], sizes) + within)[hit]] = True
        flags = []
        for p in places:
            w = windows[p]
            within = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            flags.append(zstandard.compress(np.packbits(dup[np.repeat(offset[p], w) + within]).tobytes()))
        return pa.table({"block": table["block"], "bucket": table["bucket"], "flags": pa.array(flags, pa.binary())})

    return run


# ---------------------------------------------------------------- marks
def _marked(length: int, bits: int, id_type):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard

        for row in rows(batches):
            text = _text(row)
            ends = np.cumsum(unpack(row["sizes"], np.int64))
            begins = np.concatenate([[0], ends[:-1]])
            step = np.zeros(len(text) + 1, np.int32)
            if row["flags"]:
                texts, key, _, first, place = _classes(row, text, length)
                windows = np.array([len(t) - length + 1 for t in texts], np.int64)
                cuts = bucket_cuts(key, bits)
                flags = [np.unpackbits(np.frombuffer(zstandard.decompress(x["flags"]), np.uint8), count=int(windows[cuts[x["bucket"]] : cuts[x["bucket"] + 1]].sum()))
                         for x in row["flags"]]
                flags = np.concatenate(flags).astype(bool)
                offset, w = np.cumsum(windows) - windows, windows[place]
                within = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                hit = (np.repeat(first, w) + within)[flags[np.repeat(offset[place], w) + within]]
                np.add.at(step, hit, 1)
                np.add.at(step, hit + length, -1)
            gone = np.cumsum(step)[:-1] > 0
            edge = np.zeros(len(text) + 1, bool)
            edge[ends] = edge[begins] = True
            start = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1]] if len(gone) else [[]]).astype(bool) | gone & edge[:-1])
            stop = np.flatnonzero(gone & (np.concatenate([~gone[1:], [True]] if len(gone) else [[]]).astype(bool) | edge[1:])) + 1
            a, b = np.searchsorted(start, begins), np.searchsorted(start, ends)
            spans, kept = [], []
            for d in range(len(ends)):
                lo, hi = int(begins[d]), int(ends[d])
                own = list(zip((start[a[d] : b[d]] - lo).tolist(), (stop[a[d] : b[d]] - lo).tolist())) if hi > lo else []
                spans.append([{"start": s, "end": e} for s, e in own])
                cut = [0, *(x for s in own for x in s), hi - lo]
                kept.append(b"".join(text[lo + s : lo + e] for s, e in zip(cut[::2], cut[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], id_type), pa.array(ends - begins, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"])

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
            block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, at_once: int = AT_ONCE) -> DataFrame:
    """(id, n_bytes, spans: byte ranges that are repeated, kept: the other bytes) per row of ``docs``.
    ``length``: a multiple of eight above ``gram`` and SHALLOW."""
    from pyspark.sql.pandas.types import to_arrow_type

    if length % 8 or length <= max(gram, SHALLOW):
        raise ValueError("length must be a multiple of eight, above gram and the shallow depth")
    quoted = [F.col(f"`{c}`").alias(name) for c, name in ((id_col, "id"), (text_col, "text"))]
    source = docs.select(*quoted)
    spark_type = source.schema["id"].dataType
    id_type = to_arrow_type(spark_type)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(spark_type)), T.StructField("bytes", T.LongType()),
                           *[T.StructField(c, T.BinaryType()) for c in ("sizes", "text", "first", "more", "key", "keys", "times")]])
    blocks = stored(source.mapInArrow(_blocks(length, gram, block_bytes, id_type), schema), "blocks", group_rows=8)
    bits = bits_for(blocks.agg(F.sum("bytes")).first()[0] or 0, bucket_bytes)
    anchors = stored(tally(blocks.select("block", "keys", "times"), (2, hot + 1), bits), "anchors")
    known = blocks.select("block", "text", "sizes", "first", "more", "key", "keys").join(anchors, "block")
    # single windows of hot anchors: nothing to do where no block has any
    none = anchors.select("block", F.col("levels").alias("window_levels")).limit(0)
    windows = stored(tally(known.mapInArrow(_windows(length), "block long, keys binary, times binary"), (2,), bits), "windows") if _any_hot(anchors) else None
    window_levels = none if windows is None else windows.withColumnRenamed("levels", "window_levels")
    answers = anchors.join(window_levels, "block", "left")
    known = blocks.select("block", "text", "first", "more", "key", "keys").join(answers, "block")
    contexts = known.mapInArrow(_contexts(length, bits), "bucket int, block long, key binary, sizes binary, many binary, text binary")
    flags = contexts.groupBy("bucket").applyInArrow(_sort(length, at_once), "block long, bucket int, flags binary")
    flags = stored(flags.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "flags"))).alias("flags")), "flags")
    known = blocks.drop("bytes", "times").join(answers.join(flags, "block", "left"), "block", "left")
    out = T.StructType([T.StructField("id", spark_type), *T._parse_datatype_string("n_bytes long, spans array<struct<start:long,end:long>>, kept binary").fields])
    return known.mapInArrow(_marked(length, bits, id_type), out)


def _any_hot(anchors: DataFrame) -> bool:
    def hot(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for row in rows(batches):
            if (unpacked_levels(row["levels"]) == 2).any():
                yield pa.RecordBatch.from_arrays([pa.array([row["block"]], pa.int64())], names=["block"])

    return not anchors.mapInArrow(hot, "block long").isEmpty()


def digest(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return repeats(docs).select(F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                                F.sha2("kept", 256).alias("kept_sha256"))
