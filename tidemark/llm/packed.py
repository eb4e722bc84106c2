"""Keys of blocks, packed in binary columns: dealt by key, counted over all blocks, answered per block."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pack(values) -> bytes:
    """An array of whole numbers as compressed planes of bytes, the lowest first."""
    import numpy as np
    import zstandard

    values = np.ascontiguousarray(values)
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes(), 3)


def unpack(data: bytes, dtype):
    import numpy as np
    import zstandard

    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def mixed(x):
    """A bijection of 64-bit numbers that spreads them evenly."""
    import numpy as np

    x = x.astype(np.uint64)
    for shift, by in ((32, 0xD6E8FEB86659FD93), (29, 0x9E3779B97F4A7C15)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(by)
    x ^= x >> np.uint64(32)
    return x


def rows(batches: Iterator) -> Iterator[dict]:
    """The rows of Arrow batches, one at a time: a row may hold several MB."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def bucket_cuts(keys, bits: int):
    """Where each of the ``1 << bits`` buckets begins and ends in sorted ``keys``; a bucket is a range of keys."""
    import numpy as np

    firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
    return np.append(np.searchsorted(keys, firsts), len(keys))


def bits_for(units: int, each: int) -> int:
    """So many bits that ``units``, dealt evenly, give buckets of ``each`` or less."""
    return max(1, (max(units, 1) - 1) // each + 1).bit_length()


def _deal(bits: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for row in rows(batches):
            keys, times = unpack(row["keys"], np.uint64), unpack(row["times"], np.uint32)
            cuts = bucket_cuts(keys, bits)
            filled = np.flatnonzero(np.diff(cuts))
            parts = [(pack(np.diff(keys[cuts[b] : cuts[b + 1]], prepend=np.uint64(0))), pack(times[cuts[b] : cuts[b + 1]])) for b in filled]
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled, pa.int32()), pa.array([row["block"]] * len(filled), pa.int64()), pa.array([p[0] for p in parts], pa.binary()),
                 pa.array([p[1] for p in parts], pa.binary())], names=["bucket", "block", "keys", "times"])

    return run


def _levels(levels: tuple):
    def run(table):
        import numpy as np
        import pyarrow as pa

        keys = [np.cumsum(unpack(x.as_py(), np.uint64), dtype=np.uint64) for x in table["keys"]]
        times = np.concatenate([unpack(x.as_py(), np.uint32) for x in table["times"]])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=times)  # exact up to 2^53
        level = np.searchsorted(np.array(levels), total, side="right").astype(np.uint8)[place]
        parts = np.split(level, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({"block": table["block"], "bucket": table["bucket"], "levels": pa.array([pack(p) for p in parts], pa.binary())})

    return run


def tally(items: DataFrame, levels: tuple, bits: int) -> DataFrame:
    """``items``: (block, keys: sorted distinct evenly spread 64-bit keys, times: how often the block has each).

    Gives (block, levels: array of (bucket, levels)): for every key, in order,
    how many of ``levels`` its count over all blocks reaches. A block sends a
    key once, however often it has it, so a bucket holds at most one entry of a
    key for each block.
    """
    dealt = items.mapInArrow(_deal(bits), "bucket int, block long, keys binary, times binary")
    counted = dealt.groupBy("bucket").applyInArrow(_levels(levels), "block long, bucket int, levels binary")
    return counted.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "levels"))).alias("levels"))


def unpacked_levels(found: list | None):
    """The levels of one block's keys, in the order of the keys."""
    import numpy as np

    return np.concatenate([np.empty(0, np.uint8), *(unpack(x["levels"], np.uint8) for x in found or [])])
