"""Best-two-fit packing of token sequences.

Texts become token ids in one narrow pass (chunks between single spaces are
tokenized once per task and remembered; no pre-token of the byte-level BPE
spans such a boundary, so the ids are those of the whole text). Only piece
lengths travel on: they are dealt by hash into blocks of about
``block_pieces`` pieces, and each block is packed on its own, which costs at
most about one unfilled sequence per block. Inside a block a bin is filled
greedily with the longest piece that fits; then its smallest piece gives way
to two unpacked pieces that fit the expanded gap more tightly, if there are.

Defined cases: NULL text is the empty text, which is one piece holding only
the end id; a document longer than the sequence is cut into full pieces with
the remainder first; repeated rows and NULL ids are packed like any row, each
for itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

END_ID = 2
TEXT_SLICE = 4_000_000  # characters encoded together
SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class ChunkTokenizer:
    """Token ids of whole texts as little-endian uint32 bytes.

    ``tokenizer_path`` is a ``tokenizers`` file; ``ranks_path`` the same
    vocabulary as ranks, which yields the same ids faster and is used for every
    chunk without the marks of a special token. At most ``remembered`` chunks
    are kept."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
                 remembered: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.remembered = remembered
        self.spaced: dict[str, bytes] = {}
        self.unclean: set[str] = set()
        self.fast = None
        if ranks_path and pattern:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.begins = np.zeros(max(ranks.values()) + 1, dtype=bool)
            self.begins[[i for token, i in ranks.items() if token[:1] == b" "]] = True

    def ids(self, text: str) -> bytes:
        if self.fast is not None and "<|" not in text:
            found = self.fast.encode_ordinary(text)
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def _learn(self, chunks: list[str]) -> None:
        """Remember the ids of clean chunks (no white space inside but line
        ends). They are encoded as one text; a chunk begins at each token that
        begins with a space."""
        ids = np.array(self.fast.encode_ordinary(" " + " ".join(chunks)), dtype="<u4")
        edges = (np.flatnonzero(self.begins[ids]) * 4).tolist()
        data = ids.tobytes()
        self.spaced.update(zip(chunks, map(data.__getitem__, map(slice, edges, [*edges[1:], len(data)])), strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        parts = [t.split(" ") for t in texts]
        wanted = set(chain.from_iterable(parts))
        missing = [c for c in wanted if c not in self.spaced]
        self.unclean.update(c for c in missing if not c or c[0].isspace() or c[-1].isspace())
        if not self.unclean.isdisjoint(wanted):  # white space beside a space: cut only at lone spaces
            parts = [p if self.unclean.isdisjoint(p) else SINGLE_SPACE.split(t) for p, t in zip(parts, texts, strict=True)]
            wanted = set(chain.from_iterable(parts))
            missing = [c for c in wanted if c not in self.spaced]
        if len(self.spaced) + len(missing) > self.remembered:
            self.spaced = {}
            missing = list(wanted)
        odd = [c for c in missing if self.fast is None or not c or "<|" in c or " " in c or c[0].isspace() or c[-1].isspace()]
        self.unclean = set() if len(self.unclean) > self.remembered else self.unclean
        for c in odd:
            self.spaced[c] = self.ids(" " + c)
        clean = [c for c in missing if c not in self.spaced] if odd else missing
        if clean:
            self._learn(clean)
        get = self.spaced.__getitem__
        return [(self.ids(p[0]) if p[0] else b"") + b"".join(map(get, p[1:])) for p in parts]


def token_pieces(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    rows = common.pick(docs, id=id_col, text=text_col)
    id_type = rows.schema["id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = ChunkTokenizer(tokenizer_path, ranks_path, pattern)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for lo, hi in common.slices(texts, TEXT_SLICE):
                for i, data in enumerate(tok.encode_all(texts[lo:hi]), lo):
                    data += end
                    n = len(data) // 4
                    begin, edge, number = 0, n % capacity or capacity, 0
                    while begin < n:
                        at.append(i)
                        piece.append(number)
                        start.append(begin)
                        length.append(edge - begin)
                        crc.append(zlib.crc32(data[4 * begin : 4 * edge]))
                        begin, edge, number = edge, edge + capacity, number + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])

    common.ship(docs.sparkSession)
    return rows.mapInArrow(cut, f"id {id_type}, piece int, start long, length long, ids_crc32 long")


def best_two_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each piece; every length is 1 to ``capacity``."""
    order = sorted(range(len(lengths)), key=lambda i: (lengths[i], -i))
    stock: dict[int, list[int]] = {}
    for i in order:
        stock.setdefault(lengths[i], []).append(i)
    present = 0  # bit n is set while a piece of length n is unpacked
    for n in stock:
        present |= 1 << n

    def longest(limit: int) -> int:
        return (present & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 else -1

    def take(n: int) -> int:
        nonlocal present
        pile = stock[n]
        i = pile.pop()
        if not pile:
            present &= ~(1 << n)
        return i

    def tighter(gap: int, smallest: int) -> tuple[int, int] | None:
        """The two unpacked lengths with the largest sum up to ``gap``, if above ``smallest``."""
        best, pair = smallest, None
        x = longest(gap - 1)
        while x > 0 and 2 * x > best:
            y = longest(min(x, gap - x))
            if y == x and len(stock[x]) < 2:
                y = longest(x - 1)
            if y > 0 and x + y > best:
                best, pair = x + y, (x, y)
                if best == gap:
                    break
            x = longest(x - 1)
        return pair

    where, offset, n_bins = [0] * len(lengths), [0] * len(lengths), 0
    while present:
        members, gap = [], capacity
        while (n := longest(gap)) > 0:
            members.append(take(n))
            gap -= n
        if gap and len(members) > 1:
            smallest = lengths[members[-1]]
            pair = tighter(gap + smallest, smallest)
            if pair:
                back = members.pop()
                members += [take(pair[0]), take(pair[1])]
                stock[smallest].append(back)
                present |= 1 << smallest
        at = 0
        for i in members:
            where[i], offset[i] = n_bins, at
            at += lengths[i]
        n_bins += 1
    return where, offset


def pack(pieces: DataFrame, capacity: int = 1024, block_pieces: int = 20_000) -> DataFrame:
    """Pieces (as from ``token_pieces``) with sequence_id and offset. ``pieces``
    is read twice (count, then pack): pass a stored table. Blocks go by hash
    and place in that table, so equal rows spread over all blocks too."""
    blocks = max(1, -(-pieces.count() // block_pieces))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("id", "piece", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def one(block: pd.DataFrame) -> pd.DataFrame:
        number = int(block["block"].iloc[0])
        block = block.drop(columns="block").sort_values(["length", "id", "piece"], ignore_index=True)
        where, offset = best_two_fit(block["length"].tolist(), capacity)
        block["sequence_id"] = [(number << 32) + w for w in where]
        block["offset"] = offset
        return block

    common.ship(pieces.sparkSession)
    return dealt.groupBy("block").applyInPandas(one, schema)


def public_vocabulary() -> dict[str, str]:
    """Places of the public byte-level BPE vocabulary in both forms."""
    import public_tokenizers as public

    return {"tokenizer_path": public.path("byte_bpe_50k.json"), "ranks_path": public.path("byte_bpe_50k.tiktoken"),
            "pattern": public.PATTERN}


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = common.stored(token_pieces(common.documents(spark, sf_dir), **public_vocabulary()))
    return pack(pieces).withColumnRenamed("id", "doc_id")
