"""Token counts: every distinct pre-token is counted once.

Documents are cut into pre-tokens in blocks. A block keeps its dictionary of
distinct pre-tokens and, for each document, the frequencies by place in that
dictionary, packed. The dictionaries' entries are dealt by pre-token and sorted,
so each distinct pre-token is counted once with the tokenizer, for all blocks
that have it. The counts go back to their blocks, joined to the frequencies
there, and a document's count is the sum of frequency times count. No token
ids are kept, and no document goes through the tokenizer's merges.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a special
string in a text is one token, as is the library's default; repeated rows are
counted row by row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: A block is closed once it has so many pre-tokens or documents.
BLOCK_TOKENS = 1 << 22
BLOCK_DOCS = 1 << 16
LIMIT = 1024
BLOCK_SCHEMA = "block long, doc_ids array<long>, n_bytes array<long>, sizes binary, places binary, times binary, special array<int>, pieces array<string>"


def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PreTokens:
    """A text's pre-tokens and the number of special strings in it. The
    pre-tokenizer's own pattern runs in the regex module; both see classes of
    characters only, so each character is compared once, and a text with one
    on which they differ goes through the library's pre-tokenizer."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.tokenizer = _tokenizer(path)
        self.find = regex.compile(pattern).findall
        special = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.same: set[str] = set()
        self.odd: set[str] = set()

    def _library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _agree(self, text: str) -> bool:
        for c in set(text) - self.same:
            probe = f"a{c}a1{c}1!{c}! {c} {c}{c}a"
            (self.same if self.find(probe) == self._library(probe) else self.odd).add(c)
        return not self.odd or self.odd.isdisjoint(text)

    def __call__(self, text: str) -> tuple[list[str], int]:
        parts = self.special.split(text) if self.special else [text]
        cut = self.find if self._agree(text) else self._library
        return [p for part in parts for p in cut(part)], len(parts) - 1


def _packed(values) -> bytes:
    """Whole numbers as compressed planes of bytes, the lowest first."""
    import numpy as np
    import zstandard

    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _unpacked(data: bytes):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _blocks(path: str, pattern: str, block_tokens: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        cut = PreTokens(path, pattern)
        number = TaskContext.get().partitionId() << 32

        def block():
            # a document's places ascend: their steps, from its first place on, pack well
            join = lambda xs: _packed(np.concatenate([np.empty(0, np.int32), *xs]))
            row = (number, ids, n_bytes, _packed(np.array([len(x) for x in places])), join(places), join(times), special, list(known))
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])

        ids, n_bytes, places, times, special, known, tokens = [], [], [], [], [], {}, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                pieces, specials = cut(text)
                codes = np.fromiter((known.setdefault(p, len(known)) for p in pieces), np.int32, len(pieces))
                place, n = np.unique(codes, return_counts=True)
                ids.append(doc_id)
                n_bytes.append(len(text.encode()))
                places.append(np.diff(place, prepend=0).astype(np.int32))
                times.append(n.astype(np.int32))
                special.append(specials)
                tokens += len(pieces)
                if tokens >= block_tokens or len(ids) >= BLOCK_DOCS:
                    yield block()
                    number += 1
                    ids, n_bytes, places, times, special, known, tokens = [], [], [], [], [], {}, 0
        if ids:
            yield block()

    return run


def _count(path: str):
    def run(batches: Iterator) -> Iterator:
        """Rows of (block, place, piece), sorted by piece: each piece's tokens."""
        import numpy as np
        import pyarrow as pa

        tokenizer = _tokenizer(path)
        last, tokens = None, 0
        for batch in batches:
            pieces = batch.column(2).to_pylist()
            first = np.array([p != q for p, q in zip(pieces, [last, *pieces])], bool)
            new = [pieces[k] for k in np.flatnonzero(first)]
            each = [tokens, *(len(e) for e in tokenizer.encode_batch(new, add_special_tokens=False))]
            last, tokens = pieces[-1] if pieces else last, each[-1]
            n = np.array(each, np.int32)[np.cumsum(first)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n)], names=["block", "place", "n"])

    return run


def _sum(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            each = np.array(row["counts"] or [], np.int64)
            sizes, steps, times = _unpacked(row["sizes"]), _unpacked(row["places"]), _unpacked(row["times"])
            ends = np.cumsum(sizes)
            starts = ends - sizes
            run = np.concatenate(([0], np.cumsum(steps)))
            places = run[1:] - np.repeat(run[starts], sizes)
            total = np.concatenate(([0], np.cumsum(each[places] * times)))
            tokens = total[ends] - total[starts] + np.array(row["special"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_bytes"], pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per document row. ``path``: a byte-level BPE
    file of the tokenizers library; ``pattern``: the expression it pre-tokenizes by."""
    blocks = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_blocks(path, pattern, block_tokens), BLOCK_SCHEMA), "blocks", group_rows=8)
    pieces = blocks.select("block", F.posexplode("pieces").alias("place", "piece"))
    # a piece has one row for each block that has it, however often it is there
    each = pieces.repartition("piece").sortWithinPartitions("piece").mapInArrow(_count(path), "block long, place int, n int")
    counts = each.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("c"))
    rows = blocks.drop("pieces").join(counts.select("block", F.col("c.n").alias("counts")), "block", "left")
    return rows.mapInArrow(_sum, "doc_id long, n_bytes long, n_tokens long")


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    return token_counts(docs, path, pattern).withColumn("over_limit", F.col("n_tokens") > LIMIT)
