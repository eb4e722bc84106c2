"""Spelling variants: frequent words one edit apart, found through Bloom filters.

1. Runs of letters are counted; words of MIN_LENGTH letters and MIN_COUNT
   occurrences are the vocabulary.
2. The vocabulary is put into blocked Bloom filters (256-bit blocks, one bit in each
   of eight lanes), one or more for each length: a length with over SHARD_WORDS
   words has several, by hash.
3. Every word is edited in every way, as hashes only: a word's hash is a polynomial,
   so a replaced or deleted letter changes it by one sum. A pair of neighbours
   is generated once: deletions from the longer word, replacements by greater letters.
   The edits are probed against filters that are broadcast, PASS_BYTES of them
   at a time; a larger vocabulary takes more passes, all the same otherwise.
4. Only positives become words and are shuffled, to an exact join with the
   vocabulary, which removes the false ones.
5. A word's form is its most frequent neighbour, if frequent enough. Counts grow along
   forms, so they end in a root; pointers are doubled until all have reached it.

What is broadcast or collected: PASS_BYTES of filters, the letters (the
pattern allows 116) and the number of words of each length.

Defined results: null and empty texts have no words; a null id counts as an empty string; repeated
rows count as often as they are there; an empty table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.packed import bits_for, mixed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, TIMES = 6, 5, 5
#: One run in so many loses a letter.
ODDS = 199
#: Words of one filter, and its bits for each of them.
SHARD_WORDS = 1 << 20
WORD_BITS = 16
PASS_BYTES = 32 << 20
#: Edits that are hashed at a time.
AT_ONCE = 1 << 19
LANES = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
BASE = 0x9E3779B97F4A7C15


def runs(docs: DataFrame, id_col: str, text_col: str) -> Column:
    return F.explode(F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), UPPER, LOWER), F.lit(LETTERS), F.lit(0)))


def noisy_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", odds: int = ODDS) -> DataFrame:
    """(word): every run of letters, one in ``odds`` of (id, run) without one of its letters."""
    run = F.col("run")
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    each = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), runs(docs, id_col, text_col).alias("run"))
    # runs too short for a word don't count, whatever is cut
    return each.filter(F.length("run") >= MIN_LENGTH).select(F.when(h % odds == 0, cut).otherwise(run).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the frequent words."""
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# ---------------------------------------------------------------- hashes and filters
def _letter(code):
    """A letter's number in the polynomial."""
    return mixed(code.astype("uint64") + 1)


def _powers(n: int):
    import numpy as np

    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, BASE, np.uint64), dtype=np.uint64)])


def _codes(words: list[str]):
    """Letters of words of one length, a row each."""
    import numpy as np

    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(len(w), []).append(k)
    return out


def _hashes(words: list[str]):
    """The hash of every word: its polynomial, mixed."""
    import numpy as np

    out = np.empty(len(words), np.uint64)
    for length, places in _by_length(words).items():
        out[places] = mixed((_letter(_codes([words[p] for p in places])) * _powers(length)[:length]).sum(axis=1, dtype=np.uint64))
    return out


def _block_of(h, n_blocks: int):
    """The block of a hash, and what its bits are taken from."""
    import numpy as np

    h = mixed(h)
    return ((h >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32), h & np.uint64(0xFFFFFFFF)


def bloom(h):
    """A blocked filter of the hashes ``h``: rows of eight 32-bit lanes."""
    import numpy as np

    n_blocks = max(1, len(h) * WORD_BITS // 256)
    block, low = _block_of(h, n_blocks)
    out = np.zeros((n_blocks, 8), np.uint32)
    for lane, salt in enumerate(LANES):
        bit = ((low * np.uint64(salt)) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
        np.bitwise_or.at(out[:, lane], block.astype(np.int64), np.uint32(1) << bit.astype(np.uint32))
    return out


def probe(lanes, h):
    """The places of the hashes that ``lanes`` may hold."""
    import numpy as np

    block, low = _block_of(h, len(lanes))
    block, on = block.astype(np.int64), np.arange(len(h))
    for lane, salt in enumerate(LANES):
        bit = ((low * np.uint64(salt)) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
        hit = (lanes[block, lane] >> bit.astype(np.uint32)) & np.uint32(1) == 1
        on, block, low = on[hit], block[hit], low[hit]
    return on


def _shard(h, bits: int):
    import numpy as np

    return h >> np.uint64(64 - bits) if bits else np.zeros(len(h), np.uint64)


def _dealt(bits: dict[int, int]):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            words = batch.column(0).to_pylist()
            h = _hashes(words)
            shard = np.zeros(len(words), np.int64)
            for length, places in _by_length(words).items():
                shard[places] = _shard(h[places], bits[length])
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(w) for w in words], pa.int32()), pa.array(shard, pa.int32()), pa.array(h.view(np.int64))], names=["length", "shard", "h"])

    return run


def _filter(table):
    import numpy as np
    import pyarrow as pa

    lanes = bloom(table["h"].to_numpy().view(np.uint64))
    return pa.table({"length": table["length"][:1], "shard": table["shard"][:1], "lanes": pa.array([lanes.tobytes()], pa.binary())})


# ---------------------------------------------------------------- edits
def _edits(codes, letters, at_once: int):
    """Hashes of the edits of words of one length, in blocks: (length of the result, row, place, new letter or 0 for none, hash)."""
    import numpy as np

    n, length = codes.shape
    power = _powers(length)
    down = np.uint64(pow(BASE, -1, 1 << 64))
    terms = _letter(codes) * power[:length]
    whole = terms.sum(axis=1, dtype=np.uint64)
    new = _letter(letters)
    step = max(1, at_once // (length * len(letters)))
    for s in range(0, n, step):
        part, own, total = codes[s : s + step], terms[s : s + step], whole[s : s + step]
        row, place, letter = np.nonzero(part[:, :, None] < letters)
        yield length, row + s, place, letters[letter], mixed(total[row] - own[row, place] + new[letter] * power[place])
        # of a run of one letter only the first is deleted: the others give the same word
        row, place = np.nonzero(np.concatenate([np.ones((len(part), 1), bool), part[:, 1:] != part[:, :-1]], axis=1))
        before = np.cumsum(own, axis=1, dtype=np.uint64)
        yield length - 1, row + s, place, np.zeros(len(row), np.uint32), mixed(before[row, place] - own[row, place] + (total[row] - before[row, place]) * down)


def _positives(filters, bits: dict[int, int], letters: list[int], at_once: int):
    """(word, n, near) for the edits that the broadcast ``filters`` {(length, shard): lanes} may hold."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        have = {k: np.frombuffer(v, np.uint32).reshape(-1, 8) for k, v in filters.value.items()}
        lengths, alphabet = {length for length, _ in have}, np.array(letters, np.uint32)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for length, places in _by_length(words).items():
                if length not in lengths and length - 1 not in lengths:
                    continue
                own = [words[p] for p in places]
                for out_length, row, place, letter, h in _edits(_codes(own), alphabet, at_once):
                    if out_length not in lengths or not len(h):
                        continue
                    shard = _shard(h, bits[out_length])
                    for key in [k for k in have if k[0] == out_length]:
                        mine = np.flatnonzero(shard == key[1]) if bits[out_length] else np.arange(len(h))
                        hit = mine[probe(have[key], h[mine])]
                        source = row[hit].tolist()
                        near = [own[r][:p] + (chr(c) if c else "") + own[r][p + 1 :] for r, p, c in zip(source, place[hit].tolist(), letter[hit].tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([own[r] for r in source], pa.string()), pa.array(counts[np.array(places)[row[hit]]], pa.int64()), pa.array(near, pa.string())],
                            names=["word", "n", "near"])

    return run


def near_pairs(words: DataFrame, shard_words: int = SHARD_WORDS, pass_bytes: int = PASS_BYTES, at_once: int = AT_ONCE) -> DataFrame:
    """(word, n, near, m), each pair of neighbours in ``words(word, n)`` once; ``words`` must be stored."""
    spark = words.sparkSession
    sizes = {r.length: r["count"] for r in words.groupBy(F.length("word").alias("length")).count().collect()}
    letters = sorted(ord(r[0]) for r in words.select(F.explode(F.split("word", ""))).distinct().collect() if r[0])
    bits = {length: bits_for(n, shard_words) - 1 for length, n in sizes.items()}
    built = words.select("word").mapInArrow(_dealt(bits), "length int, shard int, h long").groupBy("length", "shard").applyInArrow(_filter, "length int, shard int, lanes binary")
    built = stored(built, "filters")
    found = None
    for keys in _passes(sizes, bits, pass_bytes):
        lengths = sorted({length for length, _ in keys})
        rows = built.filter(F.col("length").isin(lengths) & F.struct("length", "shard").isin([F.struct(F.lit(a), F.lit(b)) for a, b in keys])).collect()
        filters = spark.sparkContext.broadcast({(r.length, r.shard): bytes(r.lanes) for r in rows})
        part = words.filter(F.length("word").isin(sorted({*lengths, *(n + 1 for n in lengths)}))).select("word", "n")
        part = stored(part.mapInArrow(_positives(filters, bits, letters, at_once), "word string, n long, near string"), "positives")
        filters.destroy()
        found = part if found is None else found.union(part)
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("m"))
    if found is None:
        found = words.select("word", "n", F.col("word").alias("near")).limit(0)
    return found.join(exact, "near").select("word", "n", "near", "m")


def _passes(sizes: dict[int, int], bits: dict[int, int], pass_bytes: int) -> Iterator[list[tuple[int, int]]]:
    """The filters in lists of about ``pass_bytes`` each, at least one filter."""
    now, held = [], 0
    for length in sorted(sizes):
        each = sizes[length] * WORD_BITS // 8 >> bits[length]
        for shard in range(1 << bits[length]):
            if now and held + each > pass_bytes:
                yield now
                now, held = [], 0
            now.append((length, shard))
            held += each
    if now:
        yield now


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: where the chain of forms ends."""
    up = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if up.join(further, "root", "left_semi").isEmpty():
            return up
        up = stored(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(words: DataFrame, times: int = TIMES, **kw) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the stored ``words(word, n)``."""
    pairs = stored(near_pairs(words, **kw), "pairs")
    both = pairs.select("word", "near", "m").union(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("b"))
    form = (-F.col("b.m")) >= F.lit(times) * F.col("n")
    out = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(form, F.col("b.near")).alias("form"), F.when(form, -F.col("b.m")).alias("form_n")), "forms")
    up = roots(out.filter("form IS NOT NULL").select("word", "form"))
    return out.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    return variants(stored(vocabulary(noisy_words(docs)), "vocabulary"))
