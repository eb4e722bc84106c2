"""Benchmark decontamination over a distributed positional inverted index.

The training documents are tokenised once into *segments*. A segment is an
immutable inverted index over a bounded run of documents: its terms, and for
each term the sorted token positions (the posting list). Segments are rows of
a Parquet table, so the index is stored, split and scheduled by Spark, and a
search is one narrow pass over it without any shuffle of postings.

A phrase is looked up in a segment by subtracting each word's offset from its
posting list and intersecting the adjusted lists from the rarest word on. The
same intersection with a tolerance gives proximity matches: a start for which
every word lies within ``slop`` positions of its place in the phrase.

Defined results: a null or empty text has no words and no hits; a null
``doc_id`` stays null; repeated rows are judged row by row; an item without
words has no windows; a null ``item_id`` counts as one item, hashed as the
empty string; items that share an id are one item.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import as_bytes, stored, whole
from tidemark.session import scratch_dir

#: Bytes to word bytes: A-Z lower-cased; everything but 0-9, a-z and bytes from 0x80 becomes a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
WINDOW = 13
#: Positions left free between documents; a match with a slop under half of it can't span two documents.
GAP = 64
#: A segment is closed once it has so many tokens or documents.
SEGMENT_TOKENS = 1 << 20
SEGMENT_DOCS = 1 << 16
#: Longest piece of an item in a query block, and words in a block: what one broadcast may hold.
PIECE_WORDS = 4096
BLOCK_WORDS = 1 << 20

INDEX_SCHEMA = "segment long, terms binary, counts binary, deltas binary, doc_ids array<long>, n_words array<int>"
MATCH_SCHEMA = "segment long, ordinal int, item_id long, exact boolean, word_from int, word_to int"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def _segment(number: int, doc_ids: list, lengths: list[int], tokens: list[bytes]) -> dict:
    import numpy as np

    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in tokens), np.int32, len(tokens))
    n = np.array(lengths, np.int64)
    starts = np.concatenate(([0], np.cumsum(n + GAP)[:-1])) if len(n) else n
    place = np.arange(len(tokens)) + np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    order = np.argsort(codes, kind="stable")
    return {
        "segment": number,
        "terms": b" ".join(ids),
        "counts": np.bincount(codes, minlength=len(ids)).astype(np.int32).tobytes(),
        "deltas": np.diff(place[order], prepend=0).astype(np.int32).tobytes(),
        "doc_ids": doc_ids,
        "n_words": lengths,
    }


def _build(segment_tokens: int):
    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([
            ("segment", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary()), ("deltas", pa.binary()),
            ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
        ])
        number = TaskContext.get().partitionId() << 32
        doc_ids, lengths, tokens = [], [], []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                found = words(text)
                doc_ids.append(doc_id)
                lengths.append(len(found))
                tokens += found
                if len(tokens) >= segment_tokens or len(doc_ids) >= SEGMENT_DOCS:
                    yield pa.RecordBatch.from_pylist([_segment(number, doc_ids, lengths, tokens)], schema)
                    number += 1
                    doc_ids, lengths, tokens = [], [], []
        if doc_ids:
            yield pa.RecordBatch.from_pylist([_segment(number, doc_ids, lengths, tokens)], schema)

    return build


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """The stored index: one row per segment, all tokens of all documents."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_build(segment_tokens), INDEX_SCHEMA)
    return stored(rows, "postings", group_rows=8)


def _near(cand, postings, offset: int, slop: int):
    """The candidate starts that have a posting within ``slop`` of start + offset."""
    import numpy as np

    at = np.searchsorted(postings, cand + (offset - slop))
    return cand[(at < len(postings)) & (postings[np.minimum(at, len(postings) - 1)] <= cand + (offset + slop))]


def _intersect(lists: list, slop: int):
    """Starts of a phrase, given its words' posting lists in phrase order:
    offset-adjusted lists are intersected from the rarest on."""
    import numpy as np

    order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
    cand = lists[order[0]] - order[0]
    if slop:
        cand = np.unique(cand[:, None] + np.arange(-slop, slop + 1))
    for k in order[1:]:
        if not len(cand):
            break
        cand = _near(cand, lists[k], k, slop)
    if not slop or not len(cand):
        return cand, cand
    exact = cand
    for k in order:
        exact = _near(exact, lists[k], k, 0)
    return exact, cand


def _runs(starts, length: int):
    """Overlapping or touching ``[start, start + length)`` merged."""
    import numpy as np

    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return zip(starts[np.concatenate(([0], cut))], starts[np.concatenate((cut - 1, [len(starts) - 1]))] + length)


def _search(pieces, window: int, slop: int):
    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([
            ("segment", pa.int64()), ("ordinal", pa.int32()), ("item_id", pa.int64()), ("exact", pa.bool_()),
            ("word_from", pa.int32()), ("word_to", pa.int32()),
        ])
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                ids = {w: k for k, w in enumerate(row["terms"].split(b" "))} if row["terms"] else {}
                ends = np.cumsum(np.frombuffer(row["counts"], np.int32))
                place = np.cumsum(np.frombuffer(row["deltas"], np.int32), dtype=np.int64)
                starts = np.cumsum(np.array([0, *row["n_words"]], np.int64) + GAP)[:-1] - GAP
                postings = lambda k: place[ends[k - 1] if k else 0 : ends[k]]
                out = []
                for item_id, item in pieces.value:
                    known = [ids.get(w, -1) for w in item]
                    n = min(window, len(item))
                    exact, near, bad = [], [], -1
                    for k, code in enumerate(known):
                        bad = k if code < 0 else bad
                        if k >= n - 1 and bad <= k - n:
                            both = _intersect([postings(c) for c in known[k - n + 1 : k + 1]], slop)
                            exact.append(both[0])
                            near.append(both[1])
                    for kind, found in ((True, exact), (False, near)):
                        if any(map(len, found)) and (kind or slop):
                            for a, b in _runs(np.concatenate(found), n):
                                d = int(np.searchsorted(starts, a + slop, "right")) - 1
                                span = np.clip((a - starts[d], b - starts[d]), 0, row["n_words"][d])
                                out.append((row["segment"], d, item_id, kind, int(span[0]), int(span[1])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return search


def _pieces(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[tuple[int | None, list[bytes]]]:
    """Items as word lists; a long item comes in pieces that overlap by window - 1 words."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for item_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                item = words(text)
                for k in range(0, max(1, len(item) - window + 1), PIECE_WORDS) if item else ():
                    piece = b" ".join(item[k : k + PIECE_WORDS + window - 1])
                    yield pa.RecordBatch.from_pydict({"item_id": pa.array([item_id], pa.int64()), "words": pa.array([piece], pa.binary())})

    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, "item_id long, words binary")
    for r in rows.toLocalIterator():
        yield r["item_id"], bytes(r["words"]).split(b" ")


def _blocks(pieces: Iterator) -> Iterator[list]:
    block, size = [], 0
    for item in pieces:
        block.append(item)
        size += len(item[1])
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0,
           id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """All phrase matches (``exact``) and, with ``slop`` > 0, proximity
    matches: (segment, ordinal, item_id, exact, word_from, word_to).

    The benchmark is taken in blocks of about ``BLOCK_WORDS`` words; only one
    block is broadcast at a time, and its matches are stored before the next.
    """
    if not 0 <= 2 * slop < GAP - 1:
        raise ValueError(f"slop must be from 0 to {GAP // 2 - 1}")
    spark = index.sparkSession
    path = scratch_dir(spark, "matches")
    for block in _blocks(_pieces(benchmark, id_col, text_col, window)):
        sent = spark.sparkContext.broadcast(block)
        index.mapInArrow(_search(sent, window, slop), MATCH_SCHEMA).write.mode("append").parquet(path)
        sent.unpersist()
    spark.createDataFrame([], MATCH_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(MATCH_SCHEMA).parquet(path)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit (distinct words in exact
    matches), n_items, items (their ids as sorted strings), n_near_items
    (items with a proximity match)."""
    index = build_index(docs)
    found = search(index, benchmark, window, slop)
    key = ["segment", "ordinal"]
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    # words under the union of the exact runs: what each run adds beyond the furthest end before it
    before = Window.partitionBy(*key).orderBy("word_from", "word_to").rowsBetween(Window.unboundedPreceding, -1)
    added = F.greatest(F.lit(0), F.col("word_to") - F.greatest("word_from", F.coalesce(F.max("word_to").over(before), F.lit(0))))
    hit = found.filter("exact").select(*key, "word_from", "word_to").distinct().withColumn("added", added).groupBy(*key).agg(F.sum("added").alias("n_hit"))
    items = found.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), item))).alias("items"),
        F.countDistinct(F.when(~F.col("exact"), item)).alias("n_near_items"),
    )
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "d"))
    return (
        rows.join(hit, key, "left").join(items, key, "left")
        .select(
            F.col("d.doc_ids").alias("doc_id"),
            F.col("d.n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items", F.array().cast(T.ArrayType(T.StringType()))).alias("items"),
            F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
        )
    )


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest: contaminated if at least a twentieth of the words are hit."""
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns. The
    verdict depends on the text alone, so a hash of the text serves as its id."""
    verdict = judged(docs.select(F.xxhash64("text").alias("doc_id"), "text"), benchmark)
    bad = stored(verdict.filter("contaminated").select(F.col("doc_id").alias("text_key")).distinct(), "contaminated")
    rows = docs.select(whole(docs), F.xxhash64("text").alias("text_key"))
    return rows.join(bad, "text_key", "left_anti").select("row.*")
